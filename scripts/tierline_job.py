"""spark-submit entry point: ``spark-submit scripts/tierline_job.py <job> [options]``."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierline.cli import run  # noqa: E402

if __name__ == "__main__":
    sys.exit(run())
