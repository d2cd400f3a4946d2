"""Threshold-scaled document fingerprints, with DataFrame functions only.

A fingerprint keeps every shingle hash below a fixed fraction of the hash
space (and the least hash of a text that has none below it, so that a text
with words never has an empty fingerprint). Two fingerprints of the same
fraction can be united or intersected as sets, whatever the lengths of their
texts, so the share of the smaller one found in the larger one estimates
containment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import written

#: Words of a shingle, and kept hashes: one in so many.
SHINGLE, ONE_IN = 5, 8


def _hashes(words: Column, shingle: int) -> Column:
    n = F.size(words)
    each = F.transform(F.sequence(F.lit(0), n - shingle),
                       lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(shingle)]))
    none = F.array().cast("array<bigint>")
    return F.when(n >= shingle, each).when(n > 0, F.array(F.xxhash64(words))).otherwise(none)


def with_sketch(df: DataFrame, text: str, out: str, shingle: int = SHINGLE, one_in: int = ONE_IN) -> DataFrame:
    """``df`` with the sorted kept hashes (array of long) of the shingles of
    column ``text`` (not null) as column ``out``. A text of fewer words than a
    shingle has one shingle, the whole sequence; one without words has none."""
    limit = -(1 << 63) + (1 << 64) // one_in
    words, hashes, below = f"{out}_words", f"{out}_hashes", f"{out}_below"
    return (df.withColumn(words, F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
            .withColumn(hashes, _hashes(F.col(words), shingle))
            .withColumn(below, F.filter(F.col(hashes), lambda h: h < limit))
            .withColumn(out, F.when((F.size(below) == 0) & (F.size(hashes) > 0), F.array(F.array_min(hashes)))
                        .otherwise(F.array_sort(F.array_distinct(below))))
            .drop(words, hashes, below))


def as_text(sketch: Column) -> Column:
    """16 lowercase hex digits for each kept hash."""
    return F.lower(F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def containment(a: Column, b: Column) -> Column:
    """Share of the smaller sketch found in the larger, 0 to 1; two empty ones
    are alike (1), an empty one is unlike any other (0)."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least) \
        .otherwise(F.when(F.size(a) == F.size(b), 1.0).otherwise(0.0))


def _successors(keys: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """For each distinct key the next one in ``order``, in a ring: columns
    ``key``, ``next`` (struct). Keys are dealt to ranges; only the first key
    of each range crosses ranges."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(keys.repartitionByRange(parts, *order).withColumn("area", F.spark_partition_id()), "ring")
    inside = Window.partitionBy("area").orderBy(*order)
    row = ranged.withColumn("next", F.lead(F.struct(*key)).over(inside)).withColumn("at", F.row_number().over(inside))
    firsts = row.filter("at = 1").select("area", F.struct(*key).alias("first"))
    # one row per range: a window over all of them is bounded by the partitions
    chain = Window.orderBy("area")
    after = firsts.select("area", F.coalesce(
        F.lead("first").over(chain),
        F.first("first").over(chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("over"))
    return row.join(after, "area").withColumn("next", F.coalesce("next", "over")).drop("at", "over", "area")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        shingle: int = SHINGLE, one_in: int = ONE_IN) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last third
    (rounded down) is replaced by as many first code points of the next
    document in descending id order (after the last: the first).

    Returns ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. Null text counts as empty. Null ids come after
    all others; rows of the same id follow each other by the hash of their
    text, and rows that repeat id and text are one document, returned as often
    as it occurs. With one document the next is itself. An empty table gives
    an empty result.

    The texts cross the network once, keyed by (id, hash), and the heads of
    the next documents once more. The order itself is found on keys alone.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    number = F.col(id_col).cast("long")
    rows = docs.select(number.isNull().alias("k0"), F.coalesce(number, F.lit(0)).alias("k1"),
                       F.xxhash64(text).alias("k2"), text.alias("t"))
    key = ["k0", "k1", "k2"]
    order = [F.col("k0").asc(), F.col("k1").desc(), F.col("k2").asc()]
    ring = _successors(rows.select(*key, F.char_length("t").alias("n")).distinct(), key, order)
    # what each document owes to the one before it
    owed = ring.select(*[F.col(f"next.{k}").alias(k) for k in key], F.struct(*key).alias("before"),
                       F.floor(F.col("n") / 3).cast("int").alias("wanted"))
    # both joins below use all columns of this table, so they share one exchange of it
    sketched = with_sketch(rows, "t", "sketch", shingle, one_in)
    heads = sketched.join(owed, key).groupBy(*key).agg(
        F.first("before").alias("before"), F.first(F.substr("t", F.lit(1), F.col("wanted"))).alias("head"),
        F.first("sketch").alias("next_sketch")).select(
        *[F.col(f"before.{k}").alias(k) for k in key], "head", "next_sketch")
    n = F.char_length("t")
    both = sketched.join(heads, key).withColumn(
        "edited", F.concat(F.substr("t", F.lit(1), (n - F.floor(n / 3)).cast("int")), "head"))
    both = with_sketch(both, "edited", "edited_sketch", shingle, one_in)
    return both.select(
        F.when(~F.col("k0"), F.col("k1")).alias("id"), n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
