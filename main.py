"""Entry point for ``spark-submit``; see ``monthlake.cli``."""

from monthlake.cli import main

if __name__ == "__main__":
    main()
