"""``python -m strata --raw <dir> --root <dir>``: run bronze, silver and gold."""

import sys

from strata.plans.cli import main

main(sys.argv[1:])
