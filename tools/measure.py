"""
stream landing rows/s (events as JSON files, availableNow) and snapshot +
restore seconds for all driver tables. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from daybook.session import build_session, scratch_path
    from daybook.sources.driver import DRIVER_COLUMNS, read
    from daybook.sources.snapshot import restore, snapshot
    from daybook.streaming.landing import land_json
    import datetime as dt

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(cores=os.environ.get("BENCH_CPUS", "8"), app="daybook-measure")
    base = scratch_path(spark, "measure")
    ev = read(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    micros = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    ev.write.options(**micros).json(f"{base}/in")
    n = ev.count()
    t0 = time.perf_counter()
    land_json(spark, f"{base}/in", ev.schema, f"{base}/out", f"{base}/ckpt", options=micros)
    stream_s = time.perf_counter() - t0
    tables = {t: read(spark, sf, t) for t in DRIVER_COLUMNS}
    t0 = time.perf_counter()
    snapshot(spark, tables, f"{base}/snap", dt.date(2024, 1, 31))
    restore(spark, f"{base}/snap", lambda t: f"{base}/restored/{t}")
    snap_s = time.perf_counter() - t0
    print(json.dumps({"sf_dir": sf, "stream_rows": n, "stream_seconds": round(stream_s, 2),
                      "stream_rows_per_s": round(n / stream_s), "snapshot_restore_seconds": round(snap_s, 2)}))
    spark.stop()


if __name__ == "__main__":
    main()
