"""Entry script for spark-submit."""

from medallion.cli import main

if __name__ == "__main__":
    main()
