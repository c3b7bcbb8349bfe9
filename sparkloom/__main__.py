import sys

from sparkloom.cli import main

sys.exit(main())
