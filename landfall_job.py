"""spark-submit launcher: ``spark-submit --py-files landfall.zip landfall_job.py <task> …``."""

import sys

from landfall.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
