import sys

from postlens.cli import main

sys.exit(main())
