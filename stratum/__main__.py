"""``python -m stratum <flow> ...``: the command-line runner."""

from stratum.run import main

main()
