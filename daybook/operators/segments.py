"""Ordered-event operators: transition filter and dwell segmentation
(STM-01 batch twin, STM-05, STM-06, WIN-03..05)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.timefn import seconds_between


def _chunked(df: DataFrame, chunk: Column | None) -> DataFrame:
    return df.withColumn("__chunk", chunk if chunk is not None else F.lit(0))


def neighbour_in_order(df: DataFrame, entity: Sequence[str], order: Sequence[str], cols: Sequence[str],
                       chunk: Column | None, direction: str = "prev", prefix: str = "prev_") -> DataFrame:
    """Values of ``cols`` on the previous (or next) row of the same entity.

    Two levels so that one entity holding a large share of all rows is
    split over tasks: a window per (entity, chunk) — ``chunk`` must be a
    monotone function of the ordering, e.g. the day of the timestamp —
    and, for the first (last) row of a chunk, the last (first) row of the
    nearest earlier (later) non-empty chunk, taken from a per-chunk summary
    whose size is entities × chunks, not rows. With ``chunk=None`` it is a
    plain ``lag``/``lead`` over the entity."""
    c = _chunked(df, chunk)
    packed = F.struct(*[F.col(x).alias(x) for x in cols])
    ordering = F.struct(*[F.col(x) for x in order])
    w = Window.partitionBy(*entity, "__chunk").orderBy(*[F.col(x) for x in order])
    inside = F.lag(packed).over(w) if direction == "prev" else F.lead(packed).over(w)
    c = c.withColumn("__in", inside)
    if chunk is None:
        nb = F.col("__in")
        out = c
    else:
        edge = (F.max_by(packed, ordering) if direction == "prev" else F.min_by(packed, ordering)).alias("__edge")
        summary = c.groupBy(*entity, "__chunk").agg(edge)
        ws = (Window.partitionBy(*entity) if entity else Window.partitionBy()).orderBy("__chunk")
        carry = summary.select(*entity, "__chunk", (F.lag("__edge").over(ws) if direction == "prev"
                                                    else F.lead("__edge").over(ws)).alias("__carry"))
        # null-safe: rows without an entity are one entity, as in the windows
        right = carry.toDF(*[f"__r_{x}" for x in carry.columns])
        out = c.join(right, [c[x].eqNullSafe(right[f"__r_{x}"]) for x in [*entity, "__chunk"]], "left") \
            .withColumnRenamed("__r___carry", "__carry")
        nb = F.coalesce(F.col("__in"), F.col("__carry"))
    return out.select(*df.columns, *[nb[x].alias(prefix + x) for x in cols])


def transitions(df: DataFrame, entity: Sequence[str], ts: str, state: Sequence[str],
                tiebreak: Sequence[str] = (), chunk: Column | None = None) -> DataFrame:
    """Keep a row only when its state differs from the previous row of the
    same entity (the first row of an entity always counts). ``chunk`` (a
    monotone bucket of ``ts``) enables the two-level scan for hot entities."""
    order = [ts, *tiebreak]
    n = neighbour_in_order(df.withColumn("__one", F.lit(1)), entity, order, [*state, "__one"], chunk)
    changed: Column | None = None
    for c in state:
        diff = ~F.col(c).eqNullSafe(F.col("prev_" + c))
        changed = diff if changed is None else (changed | diff)
    first = F.col("prev___one").isNull()
    return n.filter(first | changed).select(*df.columns)


def dwell_segments(df: DataFrame, entity: Sequence[str], ts: str, key: str, duration_ms: str,
                   as_of, dwell_s: int = 30, slack_s: int = 15,
                   lookback_days: int | None = None, end_col: str = "played_at",
                   chunk: Column | None = None, unknown_s: int | None = None) -> DataFrame:
    """Turn state-transition events into plays (the speed layer).

    * a segment starts whenever ``key`` differs from the previous event's
      key (pause/resume of the same key fold into one segment); empty keys
      never start one;
    * its end is the next segment's start (``as_of`` for the open tail),
      clamped to start + duration/1000 + ``slack_s`` seconds when the
      duration is known;
    * when the duration is unknown, ``unknown_s`` (if given) is the most it
      lasts;
    * segments shorter than ``dwell_s`` (second boundaries) are dropped.

    Ordered by (ts, key) within ``entity`` so same-instant ties are
    reproducible. ``lookback_days`` bounds the window sort (STM-10);
    ``chunk`` (a monotone bucket of ``ts``) splits a hot entity over tasks.
    """
    t = df.schema[ts].dataType
    as_of_c = F.lit(as_of).cast(t)
    src = df
    if lookback_days is not None:
        src = src.filter(F.col(ts) >= F.timestamp_add("DAY", F.lit(-lookback_days), as_of_c))
    order = [ts, key]
    p = neighbour_in_order(src, entity, order, [key], chunk, "prev", "__p_")
    seg = p.filter((F.col(key) != F.coalesce(F.col("__p_" + key), F.lit("__none__"))) & (F.col(key) != "")) \
        .drop("__p_" + key)
    nx = neighbour_in_order(seg, entity, order, [ts], chunk, "next", "__n_")
    clamp = F.when(F.col(duration_ms) > 0,
                   F.timestamp_add("SECOND", (F.floor(F.col(duration_ms) / 1000) + slack_s).cast("long"),
                                   F.col(ts))).otherwise(
        as_of_c if unknown_s is None else F.least(as_of_c, F.timestamp_add("SECOND", F.lit(unknown_s), F.col(ts))))
    bounded = nx.withColumn(end_col, F.least(F.coalesce(F.col("__n_" + ts), as_of_c), clamp)).drop("__n_" + ts)
    return bounded.filter(seconds_between(F.col(ts), F.col(end_col)) >= dwell_s)


def transition_events(df: DataFrame, entity: Sequence[str], ts: str, key: str, playing: str,
                      skip_s: int = 30) -> DataFrame:
    """Label stream transitions as started / paused / resumed / skipped
    (WIN-10, an extension the design documents): a key change after less
    than ``skip_s`` seconds marks the previous key as skipped."""
    w = Window.partitionBy(*entity).orderBy(F.col(ts), F.col(key))
    prev_key, prev_play = F.lag(key).over(w), F.lag(playing).over(w)
    nxt_key, nxt_ts = F.lead(key).over(w), F.lead(ts).over(w)
    kind = (F.when(prev_key.isNull() | (prev_key != F.col(key)), F.lit("started"))
            .when(prev_play & ~F.col(playing), F.lit("paused"))
            .when(~prev_play & F.col(playing), F.lit("resumed")).otherwise(F.lit("continued")))
    skipped = (nxt_key.isNotNull() & (nxt_key != F.col(key))
               & (seconds_between(F.col(ts), nxt_ts) < skip_s))
    return df.withColumn("transition", kind).withColumn("skipped", skipped)
