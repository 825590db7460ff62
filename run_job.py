"""Entry script for spark-submit; see `ticketloom/__main__.py` for the commands."""

from ticketloom.__main__ import main

raise SystemExit(main())
