"""Entry script for spark-submit; see ``changeloom.streaming.job``."""

from changeloom.streaming.job import main

if __name__ == "__main__":
    main()
