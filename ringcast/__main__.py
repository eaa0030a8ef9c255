import sys

from ringcast.cli import main

sys.exit(main())
