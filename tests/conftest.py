import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daybook.config import Cfg  # noqa: E402
from daybook.schemas import TABLES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from daybook.session import build_session
    s = build_session(cores="*", shuffle_partitions=8, app="daybook-tests", memory="8g")
    yield s
    s.stop()


@pytest.fixture()
def cfg():
    root = tempfile.mkdtemp(prefix="daybook-wh-")
    return Cfg(as_of=dt.datetime(2025, 6, 30, 12, 0, 0), kpi_start_date=dt.date(2025, 1, 1), root=root)


def put(spark, cfg, table, rows, ingested_at=None):
    """Append dict rows to a warehouse table (missing fields → defaults)."""
    spec = TABLES[table]
    defaults = {"string": "", "int": 0, "bigint": 0, "double": 0.0, "float": 0.0, "boolean": False}
    recs = []
    for r in rows:
        rec = {}
        for f in spec.schema.fields:
            if f.name in r:
                rec[f.name] = r[f.name]
            elif f.name == spec.version:
                rec[f.name] = ingested_at or cfg.as_of
            elif f.dataType.simpleString().startswith("array"):
                rec[f.name] = []
            else:
                rec[f.name] = defaults.get(f.dataType.simpleString())
        recs.append(rec)
    df = spark.createDataFrame(recs, spec.schema)
    df.write.mode("append").parquet(cfg.table_path(spec.layer, spec.name))


@pytest.fixture()
def put_rows(spark):
    def _put(cfg, table, rows, ingested_at=None):
        put(spark, cfg, table, rows, ingested_at)
    return _put


def T(s):
    return dt.datetime.fromisoformat(s)
