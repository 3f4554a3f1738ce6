"""Entry script for spark-submit: ``spark-submit run_job.py <job> <file.properties>``.

Ship the package with ``--py-files`` (a zip of ``livestats/``) on a cluster.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from livestats.plans.run import main  # noqa: E402

if __name__ == "__main__":
    main(sys.argv[1:])
