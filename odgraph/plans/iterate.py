"""Shared machinery of the iterative graph algorithms.

Three concerns live here:

1. **How per-vertex state meets the edges** (:class:`VertexJoin`).  Each
   round of PageRank / label propagation / HITS / Louvain / hop distance
   joins the edge table with a per-vertex state on one endpoint and
   aggregates on the other.

   * ``copartition``: the edge table is hash-partitioned on the join key
     once (same partition count as the state's ``groupBy``) and persisted;
     each round the state produced by the previous aggregation meets it in
     a shuffle-hash join without any exchange, so a round costs one shuffle
     (its aggregation) and nothing passes through the driver.  At sf0.1
     this beat broadcasting the state every round (20 PageRank rounds 6.0 s
     vs 10.2 s).
   * ``salted``: vertices whose fan-out exceeds ``salt_rows`` edges are
     "hot".  Their edges are spread over ``ceil(fanout / salt_rows)`` salts
     chosen by a deterministic hash of the other endpoint, and their state
     row is replicated once per salt.  The hot list has at most
     ``n_edges / salt_rows`` rows (``salt_rows`` is raised so that this
     stays within ``hot_list_limit``), so it is broadcast with a proven
     bound.  The salted edge table is hash-partitioned and sorted on
     ``(key, salt)`` and checkpointed once (the checkpoint keeps both
     properties); every round's sort-merge join shuffles only the state.
   * ``broadcast``: one-off attaches (``reuse=False``) broadcast the state
     when its row count is within ``broadcast_vertex_limit``.

   The aggregation on the receiving side needs no salting: Spark's partial
   aggregation folds a hot receiver's messages inside each map task.

2. **Lineage** (:func:`run_rounds`).  Rounds are chained lazily and the state
   is cut with a reliable ``checkpoint()`` every ``checkpoint_every`` rounds
   (and after the last), written to the session's ``spark.checkpoint.dir``.
   A lost executor therefore costs at most ``checkpoint_every`` rounds of
   recomputation, and the plan never grows beyond that many rounds.

3. **Loop settings** (:func:`graph_loop`).  The loop's partition count is
   derived from the edge count, shared by the partitioned edge table and
   every round's aggregation, and AQE is off while the loop runs; both
   settings are restored afterwards.
"""

from __future__ import annotations

import math
from contextlib import contextmanager
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odgraph.params import DEFAULTS, Params
from odgraph.session import checkpoint_dir

SALT = "_salt"
NSALT = "_nsalt"


@contextmanager
def fixed_plans(spark, p: Params = DEFAULTS, partitions: int | None = None):
    """Run a loop's actions with fixed plans; restore the settings afterwards.

    * AQE off: round plans are fixed by construction (the state join is
      co-partitioned or salted, skew is removed by salting), so AQE's
      stage-by-stage re-optimisation only adds latency (20 PageRank rounds
      took ~2x longer with it at sf0.1).
    * ``partitions``: the loop's shuffle partition count (see
      :func:`loop_partitions`), so that the partitioned edge table and every
      round's state aggregation agree, and a small graph is not spread over
      a cluster-sized default (32 partitions made 20 rounds 3x slower than
      2 at sf0.1).

    The caller's settings are restored on exit, so frames returned to the
    caller are planned with the session's own configuration.
    """
    keys = {}
    if not p.adaptive_in_loops:
        keys["spark.sql.adaptive.enabled"] = "false"
    if partitions is not None:
        keys["spark.sql.shuffle.partitions"] = str(int(partitions))
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def loop_partitions(spark, n_edges: int, p: Params = DEFAULTS) -> int:
    """Partitions for a graph loop: about ``edges_per_partition`` edges per task
    at every size, so partitions never grow with the graph."""
    return max(1, math.ceil(n_edges / max(p.edges_per_partition, 1)))


@contextmanager
def graph_loop(edges: DataFrame, p: Params = DEFAULTS):
    """Context for one iterative operator: counts the edges once, then fixes
    plans and the loop partition count for everything built inside."""
    spark = edges.sparkSession
    parts = loop_partitions(spark, edges.count(), p)
    with fixed_plans(spark, p, parts):
        yield parts


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and cut lineage.

    The frame is persisted first so that the checkpoint write reads the
    computed blocks instead of recomputing the plan a second time.
    """
    checkpoint_dir(df.sparkSession)
    df = df.persist()
    out = df.checkpoint(eager=True)
    df.unpersist()
    return out


def materialize(df: DataFrame) -> tuple[DataFrame, int]:
    """Persist a static loop input and count it (one job).

    Used for inputs that every round re-reads (vertex sets, transition and
    vote tables).  They derive from an already checkpointed edge list through
    a short lineage, so a lost block is recomputed from there; only the
    round state, whose lineage grows, needs reliable checkpoints.
    """
    df = df.persist()
    return df, df.count()


def release(*dfs: DataFrame) -> None:
    for d in dfs:
        d.unpersist()


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet in the shared checkpoint folder.

    Used at the big-scan boundary (the edge list): the plan is computed once
    by the write job (a persisted checkpoint would also compute it once, but
    a cached plan keeps its full shuffle partition count, AQE cannot
    coalesce it), and the table can be read by later applications, like the
    reference's HDFS hand-off between steps.
    """
    from odgraph.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class VertexJoin:
    """Attach per-vertex state to edges on the ``key`` endpoint, skew-safe.

    Modes (``self.mode``):

    * ``copartition`` — for state re-joined every round.  The edge table is
      hash-partitioned on ``key`` into ``spark.sql.shuffle.partitions``
      partitions once and persisted; the state, produced by the previous
      round's ``groupBy(id)`` with the same partition count, meets it in a
      shuffle-hash join with no exchange on either side.  Edges never move
      and no state passes through the driver.
    * ``salted`` — as above, but some vertex has more than ``salt_rows``
      edges: those hot vertices' edges are spread over several salts and
      their state rows replicated per salt (see the module docstring).
    * ``broadcast`` — one-off attaches (``reuse=False``) of a state whose row
      count is within ``broadcast_vertex_limit``.
    """

    def __init__(self, edges: DataFrame, key: str, other: str, n_vertices: int,
                 p: Params = DEFAULTS, n_edges: int | None = None, reuse: bool = True):
        self.key = key
        self.hot = None
        self._owned: list[DataFrame] = []
        spark = edges.sparkSession
        wants_broadcast = not reuse or p.round_join == "broadcast"
        if wants_broadcast and n_vertices <= p.broadcast_vertex_limit:
            self.mode, self.edges = "broadcast", edges
            return
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # exact hash partitioning with the session's partition count, planned
        # without AQE so that the persisted/checkpointed plan keeps it
        with fixed_plans(spark, p.with_(adaptive_in_loops=False)):
            co = edges.repartition(parts, F.col(key)).persist()
            n_edges = co.count()
            # keep the hot list within the broadcast bound whatever the edge count
            salt_rows = max(p.salt_rows, math.ceil(n_edges / max(p.hot_list_limit, 1)))
            hot_n = 0
            if n_edges > salt_rows:  # otherwise no vertex can be hot
                fan = co.groupBy(F.col(key).alias("_hid")).agg(F.count(F.lit(1)).alias("_fan"))
                hot = fan.filter(F.col("_fan") > salt_rows).select(
                    "_hid", F.ceil(F.col("_fan") / F.lit(salt_rows)).cast("int").alias(NSALT)
                )
                self.hot = reliable_checkpoint(hot)
                hot_n = self.hot.count()
            if hot_n == 0:
                self.mode, self.edges = "copartition", co
                self._owned.append(co)
                return
            salted = (
                edges.join(F.broadcast(self.hot), edges[key] == F.col("_hid"), "left")
                .withColumn(
                    SALT,
                    F.pmod(F.xxhash64(F.col(other)), F.coalesce(F.col(NSALT), F.lit(1))).cast("int"),
                )
                .drop("_hid", NSALT)
            )
            self.mode = "salted"
            self.edges = reliable_checkpoint(
                salted.repartition(parts, F.col(key), F.col(SALT)).sortWithinPartitions(key, SALT)
            )
            co.unpersist()

    def attach(self, state: DataFrame, id_col: str = "id") -> DataFrame:
        """Edges joined with the state columns of their ``key`` endpoint."""
        s = state.withColumnRenamed(id_col, "_vid")
        if self.mode == "broadcast":
            return self.edges.join(F.broadcast(s), self.edges[self.key] == F.col("_vid")).drop("_vid")
        if self.mode == "copartition":
            return self.edges.join(s.hint("shuffle_hash"), self.edges[self.key] == F.col("_vid")).drop("_vid")
        s = (
            s.join(F.broadcast(self.hot), F.col("_vid") == F.col("_hid"), "left")
            .withColumn(
                SALT,
                F.explode(F.sequence(F.lit(0), F.coalesce(F.col(NSALT), F.lit(1)) - 1)),
            )
            .drop("_hid", NSALT)
            .withColumnRenamed(SALT, "_vsalt")
        )
        cond = (self.edges[self.key] == F.col("_vid")) & (self.edges[SALT] == F.col("_vsalt"))
        return self.edges.join(s, cond).drop("_vid", "_vsalt", SALT)

    @property
    def holds_cache(self) -> bool:
        return bool(self._owned)

    def release(self) -> None:
        release(*self._owned)
        self._owned.clear()


def meet(rows: DataFrame, key: str, other: str, table: DataFrame, n: int, p: Params = DEFAULTS) -> DataFrame:
    """``rows`` (those whose ``key`` is in ``table``) with the columns of ``table``,
    whose first column is unique and matches ``key``; ``n`` bounds its rows.

    The table is broadcast within the bound; beyond it a ``key`` with many rows
    is salted by ``other``, and the result is checkpointed.
    """
    join = VertexJoin(rows, key, other, n, p, reuse=False)
    out = join.attach(table.withColumnRenamed(table.columns[0], "_key"), "_key")
    if join.mode != "broadcast":
        out = reliable_checkpoint(out)
        join.release()
    return out


def run_rounds(
    state: DataFrame,
    step: Callable[[DataFrame, int], DataFrame],
    rounds: int,
    p: Params = DEFAULTS,
    after_checkpoint: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Apply ``step`` ``rounds`` times, checkpointing every few rounds."""
    every = max(1, p.checkpoint_every)
    with fixed_plans(state.sparkSession, p):
        for i in range(rounds):
            state = step(state, i)
            if (i + 1) % every == 0 or i + 1 == rounds:
                state = reliable_checkpoint(state)
                if after_checkpoint is not None and i + 1 < rounds:
                    # a projection over the checkpoint: lineage stays one step long
                    state = after_checkpoint(state)
        if rounds == 0:
            state = reliable_checkpoint(state)
    return state
