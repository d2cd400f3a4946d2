"""URL filters as a sort-merge range join.

A host is turned round label by label (``blog.example.org`` becomes
``org.example.blog.``), so a rule's host and all its subdomains are one
interval of the sorted keys. URLs and rules are dealt to the same key ranges;
a task sweeps its range in key order and keeps the stack of rule hosts whose
intervals are open, the innermost on top. A rule whose interval began in an
earlier range is copied to the ranges it reaches into.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Above every character that a key holds.
TOP = "\U0010ffff"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; null or without ``://``: empty."""
    rest = F.substring_index(url, "://", 1)
    after = F.substr(url, F.length(rest) + 4)
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.instr(url, "://") > 0, lowered).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    after = F.substr(url, F.length(F.substring_index(url, "://", 1)) + 4)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, path).otherwise("")


def host_key(host: Column) -> Column:
    """Labels in reverse order, each ended by a dot; empty for no host."""
    return F.when(host == "", "").otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


@dataclass
class Frame:
    """An open host interval: its key, its rules by path, and the lengths of
    those paths, longest first."""
    key: str
    rules: dict[str, tuple[str, str]] = field(default_factory=dict)
    lengths: list[int] = field(default_factory=list)

    def add(self, path: str, rule: str, verdict: str) -> None:
        if path not in self.rules:
            self.lengths = sorted({*self.lengths, len(path)}, reverse=True)
        elif self.rules[path][1] == "block":
            return  # the same rule twice: block wins
        self.rules[path] = rule, verdict


def _best(stack: list[Frame], path: str) -> tuple[str | None, str | None]:
    """The longest rule whose host encloses the key and whose path starts the
    url's path; of equally long ones that of the longer host."""
    found: tuple[str | None, str | None] = (None, None)
    size = -1
    for frame in reversed(stack):
        for n in frame.lengths:
            if len(frame.key) + n <= size:
                break
            hit = frame.rules.get(path[:n]) if n <= len(path) else None
            if hit:
                found, size = hit, len(frame.key) + n
                break
    return found


def _sweep(default: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stack: list[Frame] = []
    area = None
    for batch in batches:
        ids, hosts, paths, rules, verdicts = [], [], [], [], []
        cols = [batch.column(n).to_pylist() for n in ("area", "key", "rule", "id", "host", "path", "verdict")]
        for a, key, rule, i, host, path, verdict in zip(*cols):
            if a != area:
                area, stack = a, []
            while stack and not key.startswith(stack[-1].key):
                stack.pop()
            if rule is not None:
                if not stack or stack[-1].key != key:
                    stack.append(Frame(key))
                stack[-1].add(path, rule, verdict)
                continue
            best = _best(stack, path)
            ids.append(i)
            hosts.append(host)
            paths.append(path)
            rules.append(best[0])
            verdicts.append(best[1] or default)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *(pa.array(x, pa.string()) for x in (hosts, paths, rules, verdicts))],
            names=["id", "host", "path", "rule", "verdict"])


def _bounds(keys: DataFrame, areas: int, sample: int) -> list[tuple[str, str, int]]:
    """At most ``areas - 1`` cuts of the sorted (key, path, id), from a
    bounded sample. They decide only where rows are worked on."""
    n = keys.count()
    if areas < 2 or not n:
        return []
    share = min(1.0, sample / n)
    drawn = (keys.sample(False, share, 11) if share < 1 else keys).limit(2 * sample)
    at = sorted((r.key, r.path, r.id or 0) for r in drawn.collect())
    return sorted({at[len(at) * i // areas] for i in range(1, areas)}) if at else []


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow", areas: int | None = None, sample: int = 20_000) -> DataFrame:
    """``(id, host, path, rule, verdict)`` for every row of ``pages``.

    ``rules``: columns ``rule`` (host, then from the first ``/`` the start of
    the path) and ``verdict`` (``allow`` or ``block``). A rule fits its host
    and all subdomains when the url's path starts with the rule's; the longest
    wins (equal lengths: the longer host; the same rule twice: block). Without
    a rule the verdict is ``default`` and ``rule`` is null.

    Null urls and urls without ``://`` have empty host and path and meet no
    rule. Rows with null rules, or rules without a host, are left out. Ids may
    be null or repeat; each row is judged by itself. Empty tables give the
    default everywhere, or an empty result.

    Rows are cut into ranges by (key, path, id), so one host or one url that
    holds a large share of the rows is divided. A rule is copied to the ranges
    its interval reaches into. A task holds the rules of the open hosts only.
    """
    spark = pages.sparkSession
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("key", host_key(F.col("host")))
    areas = areas or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = _bounds(rows.select("key", "path", "id"), areas, sample)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect_right(cuts, (k, p, i or 0)) for k, p, i in
                  zip(batch.column("key").to_pylist(), batch.column("path").to_pylist(), batch.column("id").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *batch.columns],
                                             names=["area", *batch.schema.names])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                key = row[batch.schema.names.index("key")]
                lo = bisect_right(cuts, (key, "", -(1 << 63)))
                hi = bisect_right(cuts, (key + TOP, "", 0))
                out += [(area, *row) for area in range(lo, hi + 1)]
            cols = list(zip(*out)) if out else [[] for _ in range(batch.num_columns + 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), *(pa.array(c, f.type) for c, f in zip(cols[1:], batch.schema))],
                names=["area", *batch.schema.names])

    text = F.col("rule")
    host = F.lower(F.substring_index(text, "/", 1))
    listed = rules.filter(text.isNotNull() & (host != "")).select(
        F.lit(None).cast("long").alias("id"), host.alias("host"),
        F.substr(text, F.length(host) + 1).alias("path"), host_key(host).alias("key"),
        text.alias("rule"), "verdict")
    kind = "area int, id long, host string, path string, key string, rule string, verdict string"
    urls = rows.select("id", "host", "path", "key", F.lit(None).cast("string").alias("rule"),
                       F.lit(None).cast("string").alias("verdict"))
    both = urls.mapInArrow(dealt, kind).unionByName(listed.mapInArrow(spread, kind))
    # rules (not null) come before the urls of the same key
    swept = both.repartition(areas, "area").sortWithinPartitions("area", "key", F.col("rule").isNull(), "path")
    return swept.mapInArrow(lambda it: _sweep(default, it),
                            "id long, host string, path string, rule string, verdict string")
