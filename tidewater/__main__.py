"""``python -m tidewater sync ...`` - the command-line sync job."""

import sys

from tidewater.cli import main

if __name__ == "__main__":
    main(sys.argv[1:])
