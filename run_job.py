"""spark-submit launcher: ``spark-submit --py-files clicklake.zip run_job.py <job> [args]``."""

import sys

from clicklake.cli import main

if __name__ == "__main__":
    sys.exit(main())
