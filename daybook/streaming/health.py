"""Stream health that survives a restart (STM-14).

Two kinds of rows are written as the stream runs, one small JSON file each, in
a folder that all runs of a query share:

* ``batch``: what became of a micro-batch: rows accepted and rejected, rejects
  by kind of contract error, the newest accepted capture time;
* ``poll``: what a ``StreamingQueryListener`` saw: every trigger with its input
  rows (also triggers without any), and the end of the query with the kind of
  its error.

A retried batch writes the file of the same name again, so it counts once.
Totals are an aggregation over the files: nothing lives in driver memory.
"""

from __future__ import annotations

import datetime as dt
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from daybook.sources.snapshot import _fs

SCHEMA = ("kind string, at timestamp, run string, batch long, input long, ok long, rejected long, "
          "by_kind map<string,long>, last_ok timestamp, error string")


def _put(spark: SparkSession, folder: str, name: str, row: dict) -> None:
    fs, p = _fs(spark, f"{folder}/{name}.json")
    stream = fs.create(p, True)
    stream.write(bytearray(json.dumps(row).encode()))
    stream.close()


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).isoformat()


#: Contract errors without the field they name.
ERROR_KINDS = ("not a JSON object", "missing required field", "is not of type", "out of range", "does not match pattern",
               "items are not of type", "unexpected field")


def reject_kind(error):
    """The kind of a contract error."""
    kind = F.lit("other")
    for text in ERROR_KINDS:  # "items are not of type" after "is not of type": the last that fits
        kind = F.when(error.contains(text), F.lit(text)).otherwise(kind)
    return kind


def record_batch(spark: SparkSession, folder: str, epoch: int, checked: DataFrame, counts: dict[str, int], last_ok) -> None:
    """The outcome of a micro-batch; ``checked`` has the ``errors`` of each
    message. A message is counted under the kind of its first error."""
    kinds = (checked.filter(F.size("errors") > 0).groupBy(reject_kind(F.col("errors")[0]).alias("k")).count().collect()
             if counts["rejected"] else [])
    _put(spark, folder, f"batch-{epoch:012d}", {
        "kind": "batch", "at": _now(), "batch": epoch, "ok": counts["ok"], "rejected": counts["rejected"],
        "by_kind": {r["k"]: r["count"] for r in kinds},
        "last_ok": last_ok.astimezone(dt.timezone.utc).isoformat() if last_ok is not None else None})


def error_kind(message: str) -> str:
    """The class of an exception that ended a query, from its message: the
    innermost Python or Java class named in it."""
    named = re.findall(r"^(?:[\w$]+\.)*([A-Z]\w*(?:Error|Exception|Interrupt))\b", message, re.MULTILINE)
    named = named or re.findall(r"\b([A-Z]\w*(?:Error|Exception|Interrupt))\b", message)
    return named[-1] if named else "unknown"


class HealthListener(StreamingQueryListener):
    """Writes a row for every trigger and for the end of the query with ``name``."""

    def __init__(self, spark: SparkSession, folder: str, name: str):
        self.spark, self.folder, self.name = spark, folder, name
        self.runs: set[str] = set()
        self.triggers = 0

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.runs.add(str(event.runId))

    def _poll(self, run: str, batch: int | None, rows: int | None, error: str | None) -> None:
        self.triggers += 1
        _put(self.spark, self.folder, f"poll-{run}-{self.triggers:09d}", {
            "kind": "poll", "at": _now(), "run": run, "batch": batch, "input": rows, "error": error})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name == self.name:
            self._poll(str(p.runId), p.batchId, p.numInputRows, None)

    def onQueryIdle(self, event) -> None:
        if str(event.runId) in self.runs:
            self._poll(str(event.runId), None, 0, None)

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self.runs and event.exception:
            self._poll(str(event.runId), None, None, error_kind(event.exception))


def totals(spark: SparkSession, folder: str) -> DataFrame:
    """One row over all runs: ``polls`` (triggers), ``runs``, ``batches``,
    ``ok``, ``rejected``, ``rejects`` and ``errors`` (maps from kind to count)
    and ``last_ok``. A folder without files gives zeros."""
    fs, p = _fs(spark, folder)
    rows = spark.read.schema(SCHEMA).json(folder) if fs.exists(p) else spark.createDataFrame([], SCHEMA)
    by_kind = rows.select(F.explode("by_kind").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n"))
    errors = rows.filter("error IS NOT NULL").groupBy(F.col("error").alias("k")).agg(F.count("*").alias("n"))

    def as_map(counts: DataFrame):
        return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias("m")).scalar()

    return rows.agg(
        F.count_if((F.col("kind") == "poll") & F.col("error").isNull()).alias("polls"), F.countDistinct("run").alias("runs"),
        F.count_if(F.col("kind") == "batch").alias("batches"), F.coalesce(F.sum("ok"), F.lit(0)).alias("ok"),
        F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected"), F.max("last_ok").alias("last_ok"),
    ).withColumn("rejects", as_map(by_kind)).withColumn("errors", as_map(errors))
