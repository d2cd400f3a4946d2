"""Now-playing stream end to end (PIP-20; STM-01..04, STM-14/15, JSN-03).

messages (Kafka ``value`` or JSON-lines files) → contract errors per
message → ``foreachBatch``: valid rows → ``bronze.spotify_player_current``,
rejects → ``bronze.spotify_player_current_dlq`` (envelope) → the speed
layer reads the landed table. Redelivered messages are harmless: both
tables are read latest-version-per-key.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from daybook.config import Cfg
from daybook.functions.contract import Field, contract_errors
from daybook.functions.timefn import wire_ms
from daybook.schemas import TABLES
from daybook.sources import tables
from daybook.streaming.health import HealthListener, record_batch

TOPIC = "spotify.player.current"  # fixed value: stream topic name
WIRE_TS_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\\.[0-9]{3}$"  # fixed value

# fixed values: the wire contract (closed, every field required; int32 bounds)
CONTRACT = [
    Field("captured_at", "string", pattern=WIRE_TS_PATTERN),
    Field("track_id", "string"), Field("track_name", "string"), Field("track_uri", "string"),
    Field("track_duration_ms", "integer"), Field("progress_ms", "integer"), Field("is_playing", "boolean"),
    Field("album_id", "string"), Field("album_name", "string"), Field("album_uri", "string"),
    Field("album_images", "array", items="string"), Field("artists_ids", "array", items="string"),
    Field("artists_names", "array", items="string"), Field("device_id", "string"), Field("device_name", "string"),
    Field("device_type", "string"), Field("device_volume_percent", "integer"), Field("context_type", "string"),
    Field("context_uri", "string"),
]
WIRE_COLUMNS = [f.name for f in CONTRACT]


def wire_json(rows: DataFrame) -> Column:
    """Serialize normalised rows to the wire form (captured_at as
    ``YYYY-MM-DD HH:MM:SS.mmm``, DAT-09)."""
    cols = [wire_ms("captured_at").alias("captured_at")] + [F.col(c) for c in WIRE_COLUMNS[1:]]
    return F.to_json(F.struct(*cols))


def with_errors(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``errors`` (array of contract violations) to each message."""
    return messages.withColumn("errors", contract_errors(F.col(value), CONTRACT, closed=True))


def parse_valid(valid: DataFrame, value: str = "value") -> DataFrame:
    """Valid wire messages → bronze rows (typed, timestamps parsed)."""
    spec = TABLES["spotify_player_current"]
    wire = _parse_datatype_string(", ".join(
        ["captured_at string"] + [f"{f.name} {f.dataType.simpleString()}" for f in spec.schema.fields
                                  if f.name not in ("captured_at", "_ingested_at")]))
    p = valid.select(F.from_json(F.col(value), wire).alias("m")).select("m.*")
    return p.withColumn("captured_at", F.to_timestamp("captured_at", "yyyy-MM-dd HH:mm:ss.SSS"))


def dlq_rows(rejected: DataFrame, rejected_at: Column, value: str = "value") -> DataFrame:
    """Dead-letter envelope (rejected_at, topic, error, payload)."""
    return rejected.select(rejected_at.alias("rejected_at"), F.lit(TOPIC).alias("topic"),
                           F.array_join("errors", "; ").alias("error"), F.col(value).alias("payload"))


def route_batch(spark: SparkSession, cfg: Cfg, batch: DataFrame, value: str = "value", health: str | None = None,
                epoch: int = 0) -> dict[str, int]:
    """One micro-batch: validate, append valid rows and rejects. Returns
    the counts; with ``health`` (a folder) they are recorded there, with the
    kinds of rejects and the newest accepted time (STM-14)."""
    b = with_errors(batch, value).persist()
    ok = b.filter(F.size("errors") == 0)
    bad = b.filter(F.size("errors") > 0)
    n_ok, n_bad = ok.count(), bad.count()
    if n_ok:
        tables.append(parse_valid(ok, value), cfg, "spotify_player_current")
    if n_bad:
        # the message's own time, so that a retried batch writes the same keys
        at = F.col("received_at") if "received_at" in batch.columns else F.lit(cfg.as_of).cast("timestamp")
        tables.append(dlq_rows(bad, at, value), cfg, "spotify_player_current_dlq")
    counts = {"ok": n_ok, "rejected": n_bad}
    if health:
        micros = parse_valid(ok, value).agg(F.max(F.unix_micros("captured_at"))).first()[0] if n_ok else None
        last = None if micros is None else dt.datetime.fromtimestamp(micros / 1_000_000, dt.timezone.utc)
        record_batch(spark, health, epoch, b, counts, last)
    b.unpersist()
    return counts


def run(spark: SparkSession, cfg: Cfg, source_dir: str, checkpoint: str, available_now: bool = True,
        kafka_options: dict[str, str] | None = None, health: str | None = None):
    """Start the landing query. With ``kafka_options`` the source is Kafka
    (``value`` cast to string); otherwise JSON-lines files in
    ``source_dir`` (one message per line). Its health is kept in the folder
    ``health`` (beside the checkpoint unless given) and read by
    ``streaming.health.totals``, over all runs."""
    if kafka_options:
        src = (spark.readStream.format("kafka").options(**kafka_options).load()
               .select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("received_at")))
    else:
        src = spark.readStream.text(source_dir).select(
            "value", F.col("_metadata.file_modification_time").alias("received_at"))
    counters: deque[dict] = deque(maxlen=1_000)  # of the latest batches of this run
    folder = health or f"{checkpoint.rstrip('/')}_health"

    def sink(batch: DataFrame, epoch: int) -> None:
        counters.append({"epoch": epoch, **route_batch(spark, cfg, batch, health=folder, epoch=epoch)})

    name = f"now-playing-{uuid.uuid4().hex[:8]}"
    listener = HealthListener(spark, folder, name)
    spark.streams.addListener(listener)
    w = src.writeStream.queryName(name).foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    q = w.start()
    q.counters = counters  # type: ignore[attr-defined]
    q.health_folder = folder  # type: ignore[attr-defined]
    if available_now:
        try:
            q.awaitTermination()
        finally:
            # its last events are delivered before the listener goes
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
            spark.streams.removeListener(listener)
    return q


# ------------------------------------------------------------------ STM-01
def transition_filter_stream(rows: DataFrame, key: str = "device_id", ts: str = "captured_at",
                             state: tuple[str, ...] = ("track_id", "is_playing"), watermark: str = "10 minutes") -> DataFrame:
    """Streaming twin of the producer's transition filter: per device, emit a
    row only when the track or the playing flag changes, in the order of the
    capture times (``streaming.ordered``): rows wait until the watermark has
    passed them, so that shuffled ones give what the batch twin gives."""
    from daybook.streaming.ordered import Transitions, ordered
    machine = Transitions([rows.columns.index(c) for c in state])
    return ordered(rows, key, ts, list(state[:1]), machine, rows.schema, watermark)


# ------------------------------------------------------------------ STM-15
def lag_alerts(lag: DataFrame, most: int = 50, minutes: int = 10) -> DataFrame:
    """Alert rows from consumer-lag samples ``(sampled_at, lag)``: a stretch
    of at least ``minutes`` in which every sample was over ``most`` gives one
    row, at the time when it has lasted that long, also when it runs over
    midnight or over many days.

    A stretch is known by the last sample at or under the limit before it.
    That sample is looked for within the day and, failing that, taken from a
    summary of earlier days, so no window holds more than a day of samples or
    one row a day. Samples without a time are left out; a sample without a lag
    counts as at the limit."""
    rows = lag.filter("sampled_at IS NOT NULL").select(
        "sampled_at", "lag", F.to_date("sampled_at").alias("__day"), F.coalesce(F.col("lag") > most, F.lit(False)).alias("__over"))
    calm = F.when(~F.col("__over"), F.col("sampled_at"))
    days = rows.groupBy("__day").agg(F.max(calm).alias("__calm"))
    before = Window.orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select("__day", F.max("__calm").over(before).alias("__before"))
    inside = Window.partitionBy("__day").orderBy("sampled_at").rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.withColumn("__calm", F.max(calm).over(inside)).join(carried, "__day").filter("__over")
    runs = marked.groupBy(F.coalesce("__calm", "__before").alias("__since")).agg(
        F.min("sampled_at").alias("a"), F.max("sampled_at").alias("b"), F.max("lag").alias("n"))
    return runs.filter(F.col("b") >= F.timestamp_add("MINUTE", F.lit(minutes), F.col("a"))).select(
        F.timestamp_add("MINUTE", F.lit(minutes), F.col("a")).alias("raised_at"), F.lit("stream_lag").alias("kind"),
        F.lit("").alias("account_email"),
        F.concat(F.lit("consumer lag up to "), F.col("n").cast("string"), F.lit(f" messages for over {minutes} minutes"))
        .alias("message"))


def alert_rules(landed: DataFrame, dlq: DataFrame, as_of, silence_hours: int = 24) -> DataFrame:
    """Alert rows from the landed tables: rejects in any 15-minute window,
    and silence (no message for ``silence_hours`` up to ``as_of``)."""
    rej = (dlq.groupBy(F.window("rejected_at", "15 minutes")).agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
           .select(F.col("window.end").alias("raised_at"), F.lit("stream_rejects").alias("kind"),
                   F.lit("").alias("account_email"),
                   F.concat(F.col("n").cast("string"), F.lit(" rejected messages in 15 minutes")).alias("message")))
    last = landed.agg(F.max("captured_at").alias("last"))
    silent = last.filter(F.col("last").isNull() | (F.col("last") < F.timestamp_add(
        "HOUR", F.lit(-silence_hours), F.lit(as_of).cast("timestamp")))).select(
        F.lit(as_of).cast("timestamp").alias("raised_at"), F.lit("stream_silence").alias("kind"),
        F.lit("").alias("account_email"),
        F.concat(F.lit("no now-playing message since "), F.coalesce(F.col("last").cast("string"), F.lit("ever")))
        .alias("message"))
    return rej.unionByName(silent)
