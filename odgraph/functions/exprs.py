"""Column expressions shared by the operators (all built-in, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from odgraph.params import DEFAULTS, DROPOFF, FARE, PICKUP, Params


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_trip(p: Params = DEFAULTS, pickup: str = PICKUP, dropoff: str = DROPOFF,
               fare: str = FARE) -> Column:
    """Ids present and in range, no self-loop, fare >= 0.

    Written on bare columns so Catalyst pushes every conjunct into the Parquet
    scan.  ``BETWEEN`` already rejects nulls; the explicit ``isNotNull`` is
    kept so the pushed filter list shows it too.  A null fare fails
    ``fare >= 0`` under three-valued logic and is dropped.
    """
    return (
        F.col(pickup).isNotNull()
        & F.col(dropoff).isNotNull()
        & F.col(pickup).between(p.min_zone, p.max_zone)
        & F.col(dropoff).between(p.min_zone, p.max_zone)
        & (F.col(pickup) != F.col(dropoff))
        & (F.col(fare) >= 0)
    )


def pct(part: str | Column, whole: str | Column) -> Column:
    """``part / whole * 100``; null instead of an error when whole is 0."""
    return F.try_divide(col(part).cast("double"), col(whole).cast("double")) * F.lit(100.0)


def hash_bucket(*keys: str | Column, buckets: int = 100) -> Column:
    """Deterministic 0..buckets-1 bucket from the md5 of ``k1-k2-...``.

    Same value in DuckDB: ``('0x'||substr(md5(k),1,8))::BIGINT % 100``.
    Unlike ``sample()``, the choice is a function of the row, so re-running a
    lost task selects the same rows and the oracle can reproduce the sample.
    """
    parts = []
    for i, k in enumerate(keys):
        if i:
            parts.append(F.lit("-"))
        parts.append(col(k).cast("string"))
    key = F.concat(*parts) if len(parts) > 1 else parts[0]
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % buckets


def round_cols(df, places: dict[str, int]):
    """Round the named double columns in place (keeps column order)."""
    return df.select(
        *[F.round(F.col(c), places[c]).alias(c) if c in places else F.col(c) for c in df.columns]
    )


def ntz_as_utc_instant(name: str) -> Column:
    """TIMESTAMP_NTZ wall clock → the TIMESTAMP instant with that UTC wall clock.

    Pure arithmetic on microseconds since the epoch, so the result does not
    depend on ``spark.sql.session.timeZone`` (a cast would).
    """
    return F.expr(
        f"timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`))"
    )


def utc_day(c: str | Column) -> Column:
    """UTC calendar day (``yyyy-MM-dd``) of a TIMESTAMP instant, zone-independent."""
    return F.date_from_unix_date(F.floor(F.unix_micros(col(c)) / F.lit(86_400_000_000)).cast("int")).cast("string")


def correlation(x: Column, y: Column) -> Column:
    """Aggregate: Pearson correlation of the rows that have both values; NaN where
    either value is the same in all of them, null without such rows.

    ``corr`` itself divides by zero there, an error under ANSI rules.
    """
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.when(spread == 0, F.lit(float("nan"))).otherwise(F.try_divide(F.covar_pop(x, y), spread))
