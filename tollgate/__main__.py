"""``python -m tollgate <job> ...``: the command-line jobs (see tollgate.jobs)."""

import sys

from tollgate.jobs import main

main(sys.argv[1:])
