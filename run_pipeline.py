"""Launcher for spark-submit: ``spark-submit --py-files martforge.zip run_pipeline.py ...``
(same arguments as ``python -m martforge.plans.pipeline``)."""

import sys

from martforge.plans.pipeline import main

if __name__ == "__main__":
    sys.exit(main())
