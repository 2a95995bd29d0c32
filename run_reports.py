"""``spark-submit --py-files tollbook.zip run_reports.py batch|stream ...``"""

from tollbook.cli import main

if __name__ == "__main__":
    main()
