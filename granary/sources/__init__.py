"""Reading and writing: landed files, delimited text, parquet tables, reports, models."""
