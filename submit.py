"""spark-submit launcher: ``spark-submit --py-files odgraph.zip submit.py TRIPS --out OUT``."""

from odgraph.__main__ import main

if __name__ == "__main__":
    main()
