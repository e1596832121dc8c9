import sys

from tessera.plans.pipeline import main

sys.exit(main())
