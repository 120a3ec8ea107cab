"""odgraph — origin/destination trip graphs analysed with Spark DataFrames.

Trips (pickup zone, dropoff zone, fare, tip, distance) are cleaned, folded
into a directed weighted zone graph and analysed: degree profiles, PageRank
(plain and weighted), HITS, label propagation and Louvain communities,
connectivity between communities, report tables and scaling sweeps.

Every operator is a plain function ``DataFrame -> DataFrame`` that takes the
caller's ``SparkSession`` implicitly through its inputs.  Nothing prints, and
the only eager actions are the size checks and checkpoints of the iterative
algorithms (see :mod:`odgraph.plans.iterate`).
"""

from odgraph.params import Params, DEFAULTS
from odgraph.graph import Graph

__all__ = ["Params", "DEFAULTS", "Graph"]
__version__ = "0.1.0"
