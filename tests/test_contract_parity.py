"""Contract parity (PIP-22): wire contract ↔ bronze table ↔ DLQ envelope."""

import json

from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, TimestampType

from daybook.schemas import TABLES
from daybook.streaming import now_playing

TYPE_OF = {"string": (StringType, TimestampType), "integer": (IntegerType,), "boolean": (BooleanType,),
           "array": (ArrayType,)}


def test_contract_fields_match_bronze_table(spark):
    bronze = {f.name: f.dataType for f in TABLES["spotify_player_current"].schema.fields if f.name != "_ingested_at"}
    assert [f.name for f in now_playing.CONTRACT] == list(bronze)        # same names, same order, closed
    for f in now_playing.CONTRACT:
        assert isinstance(bronze[f.name], TYPE_OF[f.type]), f.name
        if f.type == "array":
            assert isinstance(bronze[f.name].elementType, StringType)


def test_dlq_envelope_matches_dlq_table(spark):
    msgs = spark.createDataFrame([("{}",)], "value string")
    rows = now_playing.dlq_rows(now_playing.with_errors(msgs), F.current_timestamp())
    dlq = [f.name for f in TABLES["spotify_player_current_dlq"].schema.fields if f.name != "_ingested_at"]
    assert rows.columns == dlq
    r = rows.first()
    assert r["topic"] == now_playing.TOPIC and r["payload"] == "{}" and "missing required field" in r["error"]


def test_wire_form_round_trip(spark):
    import datetime as dt
    row = {f.name: None for f in now_playing.CONTRACT}
    row.update(captured_at=dt.datetime(2025, 1, 1, 10, 0, 0, 123000), track_id="t", track_name="n", track_uri="u",
               track_duration_ms=1, progress_ms=2, is_playing=True, album_id="", album_name="", album_uri="",
               album_images=[], artists_ids=["a"], artists_names=["A"], device_id="d", device_name="", device_type="",
               device_volume_percent=3, context_type="", context_uri="")
    spec = TABLES["spotify_player_current"]
    df = spark.createDataFrame([row], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spec.schema.fields
                                                   if f.name != "_ingested_at"))
    wire = df.select(now_playing.wire_json(df).alias("value"))
    assert json.loads(wire.first()["value"])["captured_at"] == "2025-01-01 10:00:00.123"
    assert now_playing.with_errors(wire).first()["errors"] == []
    back = now_playing.parse_valid(wire).first()
    assert back["captured_at"] == dt.datetime(2025, 1, 1, 10, 0, 0, 123000) and back["artists_ids"] == ["a"]
