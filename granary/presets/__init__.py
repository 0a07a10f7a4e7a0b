"""Ready-made settings for particular sources."""
