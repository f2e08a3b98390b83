import sys

from readloom.cli import main

sys.exit(main())
