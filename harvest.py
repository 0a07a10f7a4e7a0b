"""Entry script: spark-submit --py-files granary.zip harvest.py BASE STAGE [STAGE ...]"""

from granary.__main__ import main

if __name__ == "__main__":
    main()
