"""Mixing sources to target weights with a time-varying curriculum.

Every source has a token target (its share of the mix, by water-filling under
a repetition limit) and a weight schedule over training time ``t`` in [0, 1]:

    w(t) = target * (1 + slope * (2 t - 1)),   -1 < slope < 1

The cumulative demand of the source is the integral
``W(t) = target * (t + slope * (t*t - t))``, and ``W(1) = target``.  A
document's tokens occupy an interval of its source's token stream (hash
order, repeated as often as the target asks); inverting W at the start of the
interval gives the training position at which the mix calls for it.  Sorting
by position by range gives the training order.

Only DataFrame functions are used.  A source's running total is built in two
steps - sums per (source, slice of the hash order), a window over those few
sums, a window inside each slice - so that no source is ever in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odgraph.llm.common import WORD, cut

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
SLOPES = (-0.5, 0.0, 0.5)
#: Hexadecimal digits of the order hash that name a slice (16^3 slices).
SLICE_DIGITS = 3


def token_count(text) -> F.Column:
    """Number of words in a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _cycle(values, rank):
    """values[rank mod n] as an expression."""
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(rank, F.lit(len(values))) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST,
                   slopes=SLOPES) -> DataFrame:
    """``(source, source_size, target, slope)`` from a table of ``(source, source_size)``.

    Sources in code point order (null last) take the weights in turn and share
    ``share`` times all sizes; a target stops at ``most`` times its source's
    size and the excess is shared again by weight.

    Water-filling in closed form: in order of ``size / weight`` the first
    sources are full, the others get ``weight * level``.  With L(k) the level
    left when the first k are full, the source at k is full exactly when its
    limit per weight is at most L(k).  The window runs over one row a source.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = (ranked.withColumn("weight", _cycle([float(w) for w in weights], F.col("rank")))
              .withColumn("slope", _cycle([float(s) for s in slopes], F.col("rank")))
              .withColumn("bound", F.lit(float(most)) * F.col("source_size")))
    order = Window.orderBy(F.col("bound") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = (ranked
              .withColumn("full_before", F.coalesce(F.sum("bound").over(before), F.lit(0.0)))
              .withColumn("weight_left", F.sum("weight").over(whole)
                          - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("total", F.lit(float(share)) * F.sum("source_size").over(whole)))
    level = F.greatest(F.col("total") - F.col("full_before"), F.lit(0.0)) / F.col("weight_left")
    filled = filled.withColumn("level", level).withColumn(
        "is_full", F.col("bound") <= F.col("weight") * F.col("level"))
    # the level of the first source that is not full holds for all after it
    final = F.min(F.when(~F.col("is_full"), F.struct(F.col("bound") / F.col("weight"), F.col("rank"), F.col("level")))
                  ).over(whole)["level"]
    target = F.when(F.col("is_full"), F.col("bound")).otherwise(F.col("weight") * final)
    return filled.select("source", "source_size", target.alias("target"), "slope")


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights=WEIGHTS, share: float = SHARE, most: float = MOST, slopes=SLOPES) -> DataFrame:
    """``(row, id, source, size, source_size, target, slope, start, taken)`` for every row.

    ``row`` is a number of the row's own; ``start`` is where the document's tokens begin in its source's stream,
    ``taken`` how many words the mix takes of it over all passes: every pass
    runs through the source in the order of md5(id), and the last ends in the
    middle of the document in which the target is reached.  Null texts have
    size 0 and take 0, a null source is a source of its own, rows that repeat
    an id are documents of their own, an empty table gives an empty result.
    """
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    sized = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        token_count(F.col(text_col).cast("string")).alias("size"), key.alias("key"),
        F.monotonically_increasing_id().alias("row"))
    sized = cut(sized, "curriculum")
    slice_ = F.substring("key", 1, SLICE_DIGITS).alias("slice")
    sums = sized.groupBy("source", slice_).agg(F.sum("size").alias("slice_size"))
    targets = source_targets(
        sums.groupBy("source").agg(F.sum("slice_size").alias("source_size")), weights, share, most, slopes)
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sums.withColumn("offset", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)))
               .drop("slice_size")
               .join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s"))
    offsets = offsets.select(F.col("source").alias("o_source"), F.col("slice").alias("o_slice"),
                             "offset", "source_size", "target", "slope")
    inside = (Window.partitionBy("source", "slice").orderBy("key", "id", "size", "row")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (sized.withColumn("slice", F.substring("key", 1, SLICE_DIGITS))
              .withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("slice") == F.col("o_slice"))))
    start = F.col("offset") + F.col("within")
    goal = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    rest = goal - passes * F.col("source_size")
    part = F.least(F.col("size"), F.greatest(rest - start, F.lit(0).cast("long")))
    return placed.select("row", "id", "source", "size", "source_size", "target", "slope", start.alias("start"),
                         (passes * F.col("size") + part).alias("taken"))


def positions(assigned: DataFrame) -> DataFrame:
    """One row for each pass over a document that the mix takes something of:
    the columns of :func:`assign` with ``epoch``, ``words`` taken in that pass
    and ``position`` in [0, 1), the time at which demand reaches it."""
    times = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    each = (assigned.where("taken > 0")
            .withColumn("epoch", F.explode(F.sequence(F.lit(0), times - 1)))
            .withColumn("words", F.least(F.col("size"), F.col("taken") - F.col("epoch") * F.col("size"))))
    y = (F.col("epoch") * F.col("source_size") + F.col("start")) / F.col("target")
    # slope * t^2 + (1 - slope) * t = y, in the form without cancellation
    b = 1 - F.col("slope")
    t = 2 * y / (b + F.sqrt(b * b + 4 * F.col("slope") * y))
    return each.withColumn("position", F.least(t, F.lit(1.0)))


def sequence(assigned: DataFrame) -> DataFrame:
    """:func:`positions` in training order, sorted by range on ``position``."""
    return positions(assigned).orderBy("position", "source", "epoch", "id")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, most: float = MOST, slopes=SLOPES) -> DataFrame:
    """The training sequence: a row for each pass over a document, sorted by
    range on ``position``, with ``epoch`` and the ``words`` to read of it."""
    placed = sequence(assign(docs, id_col, text_col, source_col, weights, share, most, slopes))
    return placed.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "target",
                         "epoch", "words", "position")
