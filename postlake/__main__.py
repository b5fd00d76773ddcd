import sys

from postlake.cli import main

sys.exit(main())
