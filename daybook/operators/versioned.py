"""Latest version per key — dedup on read (AGG-13, SEM-20, SEM-22)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_version(df: DataFrame, keys: Sequence[str], version: str | Sequence[str],
                      tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``version``.

    Implemented as an aggregate of ``max(struct(version, tiebreak, rest))``
    (Spark plans a sort aggregate for it) rather than a ``row_number`` window:
    it combines map-side, so a key holding a third of all rows is reduced to
    one row per input partition before the shuffle. A table laid out by key
    (``sources.versioned_table``) needs neither aggregate nor shuffle. Ties on the version are broken by ``tiebreak`` and then
    by the remaining columns, so the result is deterministic.
    """
    keys = list(keys)
    order = [version] if isinstance(version, str) else list(version)
    order += [c for c in tiebreak if c not in order]
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = order + rest
    packed = F.max(F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(fields)]))
    agg = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(packed.alias("__latest"))
    cols = {k: F.col(f"`{k}`") for k in keys}
    cols.update({c: F.col(f"__latest.f{i}").alias(c) for i, c in enumerate(fields)})
    return agg.select(*[cols[c].alias(c) for c in df.columns])


def latest_row_number(df: DataFrame, keys: Sequence[str], version: str,
                      tiebreak: Sequence[str] = ()) -> DataFrame:
    """Window form of the same rule, for callers that need the other rows too."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(F.col(version).desc(), *[F.col(c).desc() for c in tiebreak])
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
