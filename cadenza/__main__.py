"""``python -m cadenza <stage> ...``: the stage-by-stage command line."""

import sys

from cadenza.plans.cli import main

main(sys.argv[1:])
