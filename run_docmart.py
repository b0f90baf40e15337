"""``spark-submit`` script; see ``docmart/__main__.py``."""

import sys

from docmart.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
