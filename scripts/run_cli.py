"""Launcher for spark-submit: ``spark-submit --py-files shelfwise.zip scripts/run_cli.py insights ...``."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwise.cli import main  # noqa: E402

if __name__ == "__main__":
    main(sys.argv[1:])
