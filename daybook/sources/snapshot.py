"""Warehouse snapshots: snapshot → list → restore → prune (PIP-19,
SNK-06..09, SRC-33).

Layout: ``{root}/dt=YYYY-MM-DD/{table}/`` (Parquet, zstd) per table and a
``_MANIFEST.json`` written last; a snapshot without a manifest is
incomplete. Writes are distributed (no table passes through the driver);
only the manifest — a few numbers per table — is written by the driver.

The manifest holds checksums of every table that don't depend on the order of
rows: rows fall into ``RANGES`` ranges of their hash, each with its count, the
exclusive or and the sum of its hashes. A restore compares them with the
target's and reads on only in ranges that differ; a target whose files have not
changed since the last restore of the same snapshot is not read at all.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import materialize
from daybook.session import run_parallel as _parallel

MANIFEST = "_MANIFEST.json"
RANGES = 32
#: Folder (beside the snapshots) that says which targets hold which snapshot.
DONE = "_restored"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _files(spark, path: str) -> list[int]:
    """Bytes and files of a folder, and when its newest file was written."""
    fs, p = _fs(spark, path)
    summary = fs.getContentSummary(p)
    newest = max((st.getModificationTime() for st in fs.listStatus(p)), default=0)
    return [int(summary.getLength()), int(summary.getFileCount()), int(newest)]


def _dir_bytes(spark, path: str) -> int:
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def _read_json(spark: SparkSession, path: str) -> dict | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _write_json(spark: SparkSession, path: str, value: dict) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    stream.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    stream.close()


def _row_hash(df: DataFrame):
    """A hash of all columns (maps as JSON)."""
    return F.xxhash64(*[F.to_json(F.col(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`")
                        for f in df.schema.fields])


def _range(df: DataFrame):
    return F.pmod(_row_hash(df), F.lit(RANGES)).cast("int")


def checksums(df: DataFrame) -> dict[str, list[int]]:
    """Count, exclusive or and sum (of the upper halves) of the row hashes of
    each range; one pass with partial sums, a few numbers come back."""
    hashed = df.select(_row_hash(df).alias("h"))
    found = hashed.groupBy(F.pmod("h", F.lit(RANGES)).alias("r")).agg(
        F.count("*").alias("n"), F.bit_xor("h").alias("x"), F.sum(F.shiftrightunsigned("h", 32)).alias("s")).collect()
    return {str(row["r"]): [int(row["n"]), int(row["x"]), int(row["s"])] for row in found}


def snapshot(spark: SparkSession, tables: dict[str, DataFrame], root: str, day: dt.date,
             dedup: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> dict:
    """Write every table (deduplicated by its read rule when given) under
    ``dt=day``; rerunning the same day overwrites. Returns the manifest."""
    base = f"{root.rstrip('/')}/dt={day.isoformat()}"
    fs, mp = _fs(spark, f"{base}/{MANIFEST}")
    if fs.exists(mp):
        fs.delete(mp, False)  # the snapshot is incomplete until rewritten
    def write_one(name: str, df: DataFrame) -> tuple[str, dict]:
        out = df if not dedup or name not in dedup else dedup[name](df)
        path = f"{base}/{name}"
        out.write.mode("overwrite").option("compression", "zstd").parquet(path)
        sums = checksums(spark.read.schema(out.schema).parquet(path))  # of what was written
        return name, {"rows": sum(x[0] for x in sums.values()), "bytes": _dir_bytes(spark, path), "sums": sums}
    # tables are independent jobs: submit them concurrently so small tables
    # do not leave the cluster idle one after another (OPT-16)
    entries = dict(_parallel([(write_one, (n, df)) for n, df in tables.items()]))
    manifest = {"dt": day.isoformat(), "tables": entries}
    _write_json(spark, f"{base}/{MANIFEST}", manifest)
    return manifest


def list_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """(dt, complete) per snapshot folder, newest first (SNK-07)."""
    fs, p = _fs(spark, root)
    rows = []
    if fs.exists(p):
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("dt="):
                done = fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), MANIFEST))
                rows.append((name[3:], bool(done)))
    return spark.createDataFrame(rows, "dt string, complete boolean").orderBy(F.col("dt").desc())


def latest_complete(spark: SparkSession, root: str) -> str | None:
    r = list_snapshots(spark, root).filter("complete").first()
    return r["dt"] if r else None


def read_snapshot(spark: SparkSession, root: str, day: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/dt={day}/{table}")


def _missing(rows: DataFrame, held: DataFrame) -> DataFrame:
    """``rows`` less ``held``, counting repeats (maps are compared as JSON)."""
    plain = [F.to_json(c).alias(f.name) if "map<" in f.dataType.simpleString() else F.col(f.name)
             for f in rows.schema.fields for c in [F.col(f.name)]]
    if not any("map<" in f.dataType.simpleString() for f in rows.schema.fields):
        return rows.exceptAll(held)
    left = rows.select(*plain).exceptAll(held.select(*plain))
    return left.select(*[F.from_json(f.name, f.dataType.simpleString()).alias(f.name)
                         if "map<" in f.dataType.simpleString() else F.col(f.name) for f in rows.schema.fields])


def restore(spark: SparkSession, root: str, target: Callable[[str], str | None],
            day: str | None = None, tables: Sequence[str] | None = None) -> dict[str, int]:
    """Append snapshot tables into their targets (SNK-08).

    ``day`` defaults to the latest complete snapshot. ``tables`` may be bare
    (``t``) or qualified (``layer.t``). A snapshot table whose target is
    unknown (``target`` returns None) is skipped; a requested table that is
    missing, or an empty selection, raises. Restore is additive: only rows
    that the target doesn't hold yet are appended (compared over all columns,
    with their number), so restoring twice changes nothing, also in tables
    without a version. Ranges whose checksums agree are not compared, and a
    target that is as the last restore of this snapshot left it is not read.
    Returns the rows appended per table."""
    day = day or latest_complete(spark, root)
    if day is None:
        raise FileNotFoundError(f"no complete snapshot under {root}")
    fs, p = _fs(spark, f"{root.rstrip('/')}/dt={day}")
    present = sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())

    def bare(n: str) -> str:
        return n.split(".")[-1]
    wanted = None if tables is None else {bare(t) for t in tables}
    if wanted is not None:
        missing = wanted - {bare(n) for n in present}
        if missing:
            raise FileNotFoundError(f"tables not in snapshot {day}: {sorted(missing)}")
    entries = (_read_json(spark, f"{root.rstrip('/')}/dt={day}/{MANIFEST}") or {}).get("tables", {})

    def restore_one(name: str, dest: str) -> tuple[str, int]:
        done = f"{root.rstrip('/')}/{DONE}/{hashlib.md5(dest.encode()).hexdigest()}.json"
        entry = {"dt": day, "table": name, "sums": entries.get(name, {}).get("sums")}
        fs_, d_ = _fs(spark, dest)
        there = fs_.exists(d_)
        if there and entry["sums"] and _read_json(spark, done) == entry | {"files": _files(spark, dest)}:
            return name, 0
        rows = read_snapshot(spark, root, day, name)
        if there:
            held = spark.read.schema(rows.schema).parquet(dest)
            if entry["sums"]:
                sums = checksums(held)
                differ = [int(r) for r, x in entry["sums"].items() if sums.get(r) != x]
                rows, held = (df.filter(_range(df).isin(differ)) for df in (rows, held))
            rows = materialize(_missing(rows, held)) if not entry["sums"] or differ else rows.limit(0)
        n = rows.count()
        if n or not there:
            rows.write.mode("append").parquet(dest)
        _write_json(spark, done, entry | {"files": _files(spark, dest)})
        return name, n
    jobs = [(restore_one, (name, target(name))) for name in present
            if (wanted is None or bare(name) in wanted) and target(name) is not None]
    done: dict[str, int] = dict(_parallel(jobs))
    if not done:
        raise ValueError("restore selected no tables")
    return done


def prune(spark: SparkSession, root: str, retention_days: int, today: dt.date) -> list[str]:
    """Delete snapshot folders older than ``today - retention_days``
    (SNK-09); ``retention_days <= 0`` disables pruning."""
    if retention_days <= 0:
        return []
    cutoff = today - dt.timedelta(days=retention_days)
    fs, p = _fs(spark, root)
    gone = []
    if not fs.exists(p):
        return gone
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if not name.startswith("dt="):
            continue
        try:
            d = dt.date.fromisoformat(name[3:])
        except ValueError:
            continue
        if d < cutoff:
            fs.delete(st.getPath(), True)
            gone.append(name[3:])
    return sorted(gone)


def snapshot_warehouse(spark: SparkSession, cfg, root: str, day: dt.date) -> dict:
    """Snapshot every registered warehouse table that exists, read latest
    version per key (the deduplicated state), one ``layer.table`` folder each."""
    from daybook.schemas import TABLES
    from daybook.sources.tables import _exists, path_of, read_table
    tables = {f"{t.layer}.{t.name}": read_table(spark, cfg, t.name)
              for t in TABLES.values() if _exists(spark, path_of(cfg, t.name))}
    return snapshot(spark, tables, root, day)


def restore_warehouse(spark: SparkSession, cfg, root: str, day: str | None = None,
                      tables: Sequence[str] | None = None) -> dict[str, int]:
    """Restore a warehouse snapshot into ``cfg``'s tables (appends; reads
    dedup, so a repeated restore changes nothing). Folders of tables the
    registry does not know are skipped."""
    from daybook.schemas import TABLES
    from daybook.sources.tables import path_of

    def target(name: str) -> str | None:
        t = name.split(".")[-1]
        return path_of(cfg, t) if t in TABLES else None
    return restore(spark, root, target, day, tables)
