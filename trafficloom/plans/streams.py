"""Streams over the given tables, run to their end into a table; their SQL is that of the batch twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficloom.functions.weather import utc_instant, utc_ntz
from trafficloom.operators import ingest, stateful
from trafficloom.operators.normalize import deserialize
from trafficloom.operators.windows import segment_window_agg
from trafficloom.sources import scratch, sinks, topics
from trafficloom.streaming import counters, ordered, silver, state

from . import bindings as B
from . import ingestion
from .common import registry, rounded
from .space import IN_BOX, POINTS, boxes, point_columns

QUERIES, ORACLES, query = registry()
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _scratch(spark: SparkSession) -> str:
    return scratch.folder(spark, "stream")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of its files, with event times as instants of UTC."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(_folder(spark, path))
    return rows.withColumn("ts", utc_instant(F.col("ts")))


def _folder(spark: SparkSession, path: str) -> str:
    """A path that a file stream can read: a table of one file is named by a pattern."""
    return path if spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path").count() != 1 else path.replace("events.parquet", "events.parque[t]")


def run_to_end(df: DataFrame, where: str, mode: str = "append", once: bool = False) -> DataFrame:
    """Starts the stream, waits until its input is read, and returns the table it wrote.

    Processing-time state asks for batches without end, so those streams run one batch.
    """
    spark = df.sparkSession
    target = f"{where}/out"
    if mode == "append":
        q = df.writeStream.outputMode("append").format("parquet").option("path", target).option("checkpointLocation", f"{where}/ck").trigger(**({"once": True} if once else {"availableNow": True})).start()
    else:
        q = silver.start_silver(df, silver.table_sink(target), f"{where}/ck", mode, available_now=True)
    q.awaitTermination()
    return spark.read.parquet(target)


def _stateful(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)


@query(f"WITH {B.events_cte(10)} SELECT road_segment_id, source_type, time_bucket(INTERVAL '10 seconds', event_time) AS bucket, 1::BIGINT AS n_rows, true AS is_input_row FROM ev GROUP BY 1, 2, 3")
def stream_dedup(spark, sf_dir):
    """One row stays of each key and bucket, and it is one of the rows that came."""
    e = event_stream(spark, sf_dir)
    rows = e.select((F.col("user_id") % 10).alias("road_segment_id"), _source().alias("source_type"), F.col("ts").alias("event_time"), "event_id")
    out = run_to_end(silver.dedup_stream(rows), _scratch(spark))
    came = B.traffic_events(spark, sf_dir, 10).select("event_id", F.col("road_segment_id").alias("_seg"), F.col("source_type").alias("_src"), F.col("event_time").alias("_at"))
    at = utc_ntz(F.col("event_time"))
    own = (F.col("_seg") == F.col("road_segment_id")) & (F.col("_src") == F.col("source_type")) & (F.col("_at") == at)
    kept = out.join(came, "event_id", "left").select("road_segment_id", "source_type", F.window(at, "10 seconds")["start"].alias("bucket"), F.coalesce(own, F.lit(False)).alias("own"))
    return kept.groupBy("road_segment_id", "source_type", "bucket").agg(F.count("*").alias("n_rows"), F.bool_and("own").alias("is_input_row"))


def _source():
    t = F.col("event_type")
    return F.when(t == "click", "telecom").when(t == "view", "cctv").when(t == "purchase", "fleet_gps").when(t == "error", "incident").otherwise("weather")


@query(f"WITH {B.events_cte(10)} SELECT road_segment_id, time_bucket(INTERVAL '30 seconds', event_time) AS event_time, count(*) AS vehicle_count, round(avg(avg_speed_kmh), 6) AS avg_speed_kmh, round(sum(flow_rate), 6) AS flow_rate FROM ev GROUP BY 1, 2")
def stream_silver(spark, sf_dir):
    e = event_stream(spark, sf_dir).withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    rows = e.select((F.col("user_id") % 10).alias("road_segment_id"), F.col("ts").alias("event_time"), F.when(F.col("k") % 13 != 0, F.col("value")).alias("speed_kmh"), (F.col("k") * 12.0).alias("flow"))
    out = run_to_end(segment_window_agg(rows.withWatermark("event_time", "30 seconds")), _scratch(spark), "update")
    return rounded(out.select("road_segment_id", utc_ntz(F.col("event_time")).alias("event_time"), "vehicle_count", "avg_speed_kmh", "flow_rate"))


@query(f"""WITH {POINTS}, placed AS (SELECT DISTINCT id, event_type, time_bucket(INTERVAL '1 hour', ts) AS hour FROM pts JOIN e USING (event_id) JOIN edges ON {IN_BOX}),
steps AS (SELECT *, (epoch(hour)::BIGINT // 3600 % 70) * 1.60934::DOUBLE AS speed FROM placed), last AS (SELECT max(ts) AS ts FROM pts JOIN e USING (event_id) JOIN edges ON {IN_BOX})
SELECT id AS road_segment_id, time_bucket(INTERVAL '6 hours', hour) AS event_time, count(*) AS vehicle_count, round(avg(speed), 6) AS avg_speed_kmh, count(*) * 12.0::DOUBLE AS flow_rate FROM steps GROUP BY 1, 2
HAVING time_bucket(INTERVAL '6 hours', hour) + INTERVAL 6 HOUR <= (SELECT ts FROM last) - INTERVAL 2 HOUR""")
def stream_silver_chain(spark, sf_dir):
    """The whole silver stream: points are normalised, placed on roads, counted once an hour and source, and summed up in windows that the watermark has passed.

    Rows that repeat in an hour have one speed, so it does not matter which of them came first.
    """
    e = event_stream(spark, sf_dir).withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    speed = (F.floor(F.unix_seconds("ts") / 3600) % 70).cast("double").alias("speed_mph")
    rows = e.select("event_id", _source().alias("source_type"), F.col("ts").alias("timestamp"), speed, F.lit(12.0).alias("flow"), *point_columns())
    out = run_to_end(silver.silver_stream(rows, "fleet_gps", boxes(spark, sf_dir), duration="6 hours", bucket="1 hour", watermark="2 hours"), _scratch(spark))
    return rounded(out.select("road_segment_id", utc_ntz(F.col("event_time")).alias("event_time"), "vehicle_count", "avg_speed_kmh", "flow_rate"))


def _pings(spark, sf_dir):
    e = event_stream(spark, sf_dir).withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return e.select("event_id", F.col("user_id").cast("string").alias("device_id_hash"), F.concat(F.lit("t"), F.floor(F.col("k") / 50)).alias("tower_id"), F.col("ts").alias("timestamp"))


_RESIDENTIAL = f"""WITH {B.PINGS}, n AS (SELECT *, CASE WHEN lag(tower_id) OVER w IS DISTINCT FROM tower_id THEN 1 ELSE 0 END AS new FROM pings WINDOW w AS (PARTITION BY device_id ORDER BY timestamp, event_id)),
st AS (SELECT *, sum(new) OVER (PARTITION BY device_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING) AS stay FROM n)
SELECT event_id, timestamp >= min(timestamp) OVER (PARTITION BY device_id, stay) + INTERVAL 15 MINUTE AS residential FROM st"""


@query(_RESIDENTIAL)
def stream_residential(spark, sf_dir):
    _stateful(spark)
    return run_to_end(state.flag_residential_stream(_pings(spark, sf_dir)).select("event_id", "residential"), _scratch(spark), once=True)


@query(_RESIDENTIAL)
def residential(spark, sf_dir):
    rows = B.pings(spark, sf_dir).withColumnRenamed("device_id", "device_id_hash")
    return stateful.flag_residential(rows).select("event_id", "residential")


@query(f"""WITH RECURSIVE {B.REPORTS}, o AS (SELECT id, reported_at, row_number() OVER (PARTITION BY id ORDER BY reported_at, event_id) AS rn FROM reports),
f AS (SELECT id, rn, reported_at AS last, true AS kept FROM o WHERE rn = 1 UNION ALL SELECT o.id, o.rn, CASE WHEN o.reported_at >= f.last + INTERVAL 12 HOUR THEN o.reported_at ELSE f.last END, o.reported_at >= f.last + INTERVAL 12 HOUR FROM f JOIN o ON o.id = f.id AND o.rn = f.rn + 1)
SELECT id, last AS reported_at FROM f WHERE kept""")
def stream_first_report(spark, sf_dir):
    """Which times of a report's id are kept: the first, and each first one 12 hours or more after the last that was kept."""
    _stateful(spark)
    rows = event_stream(spark, sf_dir).select(F.col("user_id").cast("string").alias("id"), F.col("ts").alias("reported_at"))
    out = run_to_end(state.dedup_ttl_stream(rows, ttl_min=12 * 60), _scratch(spark), once=True)
    return out.select("id", utc_ntz(F.col("reported_at")).alias("reported_at"))


@query(f"""WITH RECURSIVE {B.REPORTS}, o AS (SELECT id, event_id, reported_at, row_number() OVER (PARTITION BY id ORDER BY reported_at, event_id) AS rn FROM reports),
f AS (SELECT id, event_id, rn, [reported_at] AS taken, true AS accepted FROM o WHERE rn = 1 UNION ALL
 SELECT id, event_id, rn, CASE WHEN len(alive) < 2 THEN list_append(alive, reported_at) ELSE alive END, len(alive) < 2 FROM (SELECT o.id, o.event_id, o.rn, o.reported_at, list_filter(f.taken, lambda x: o.reported_at < x + INTERVAL 1 DAY) AS alive FROM f JOIN o ON o.id = f.id AND o.rn = f.rn + 1))
SELECT event_id, accepted FROM f""")
def stream_rate_limit(spark, sf_dir):
    _stateful(spark)
    rows = event_stream(spark, sf_dir).select("event_id", F.col("user_id").cast("string").alias("id"), F.col("ts").alias("reported_at"))
    return run_to_end(state.rate_limit_stream(rows, "id", "reported_at", 2, 86_400).select("event_id", "accepted"), _scratch(spark), once=True)


@query(f"WITH {B.events_cte()} SELECT strftime(event_time, '%Y-%m-%d') AS checkpoint_date, strftime(event_time, '%H') AS checkpoint_hour, count(*) AS n_rows, sum(vehicle_count)::BIGINT AS vehicles FROM ev GROUP BY 1, 2")
def archive_hours(spark, sf_dir):
    root = f"{_scratch(spark)}/archive"
    rows = B.traffic_events(spark, sf_dir)
    sinks.write_hour_partitions(rows, 7, root)
    kept = spark.read.schema("vehicle_count int, checkpoint_date string, checkpoint_hour string, batch_id int").parquet(root)
    return kept.groupBy("checkpoint_date", "checkpoint_hour").agg(F.count("*").alias("n_rows"), F.sum("vehicle_count").alias("vehicles"))


@query(f"WITH {B.events_cte()} SELECT strftime(event_time, '%Y-%m-%d') AS event_date, count(*) AS n_rows FROM ev WHERE event_time::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-09' GROUP BY 1")
def lake_dates(spark, sf_dir):
    from trafficloom.sources.readers import read_lake

    root = f"{_scratch(spark)}/lake"
    sinks.replace_table(B.traffic_events(spark, sf_dir).withColumn("event_date", F.to_date("event_time")), root, ["event_date"])
    return read_lake(spark, root, "2024-01-05", "2024-01-09").groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("event_date")).agg(F.count("*").alias("n_rows"))


@query(f"""WITH {B.E}, days AS (SELECT ts::DATE AS day, count(*) AS n FROM e GROUP BY 1)
SELECT event_id, user_id::VARCHAR AS vehicle_id_hash, k::DOUBLE AS speed_kmh, false AS corrupt FROM e WHERE day(ts) % 5 <> 0 UNION ALL SELECT -1, 'none', -1, true FROM days WHERE day(day) % 5 = 0""")
def landed_json(spark, sf_dir):
    """Bodies of a day's points, landed as files and read back: an array gives its rows, an object (every fifth day) is corrupt."""
    from trafficloom.sources.readers import read_landing_json

    e = B._events(spark, sf_dir).select(F.to_date("ts").alias("day"), F.struct("event_id", F.col("user_id").cast("string").alias("vehicle_id_hash"), F.col("k").cast("double").alias("speed_kmh")).alias("r"))
    body = F.when(F.day("day") % 5 != 0, F.to_json(F.collect_list("r"))).otherwise(F.to_json(F.struct(F.count("*").alias("n"))))
    root = f"{_scratch(spark)}/landing"
    e.groupBy("day").agg(body.alias("value")).repartition("day").write.partitionBy("day").text(root)
    rows = read_landing_json(spark, root, "event_id long, vehicle_id_hash string, speed_kmh double")
    known = [F.coalesce("event_id", F.lit(-1)).alias("event_id"), F.coalesce("vehicle_id_hash", F.lit("none")).alias("vehicle_id_hash"), F.coalesce("speed_kmh", F.lit(-1.0)).alias("speed_kmh")]
    return rows.select(*known, F.col("_corrupt").isNotNull().alias("corrupt"))


#: Rows of a file of a stream at most, or about so many; groups of keys that a rule in event-time order keeps together.
FILE_ROWS, SHARDS = 1_000_000, 256


def _in_files(spark: SparkSession, rows: DataFrame, ts: str, root: str) -> DataFrame:
    """A stream of `rows` in two halves by time, a micro-batch each, and then a last row, far ahead, whose time lets the watermark pass all others.

    The halves have as many files each, as files come in the order they were written in and a micro-batch is a number of them.
    """
    files = 1 + rows.count() // (2 * FILE_ROWS)
    cut = rows.stat.approxQuantile("_s", [0.5], 0.01)
    for some in [rows.where(F.col("_s") <= cut[0]), rows.where(F.col("_s") > cut[0])] if cut else [rows]:
        some = some.drop("_s")
        (some.repartition(files) if files > 1 else some.coalesce(1)).write.mode("append").parquet(root)
    last = rows.groupBy().agg(*[(F.max(c) + F.expr("INTERVAL 100 DAYS") if c == ts else F.max(c)).alias(c) for c in rows.columns])
    last.drop("_s").withColumn("event_id", F.lit(-1).cast("long")).write.mode("append").parquet(root)
    return spark.readStream.schema(rows.drop("_s").schema).option("maxFilesPerTrigger", files).parquet(root)


def _timed(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(ts, utc_instant(F.col(ts))).withColumn("_s", F.unix_seconds(ts).cast("double"))


@query(ORACLES["stream_first_report"])
def ordered_first_report(spark, sf_dir):
    """The same rule in event-time order, over several micro-batches."""
    _stateful(spark)
    where = _scratch(spark)
    rows = _timed(B.reports(spark, sf_dir).select("event_id", "id", "reported_at"), "reported_at")
    stream = _in_files(spark, rows, "reported_at", f"{where}/in").withColumn("id", F.when(F.col("event_id") >= 0, F.col("id")).otherwise("beat"))
    out = run_to_end(ordered.dedup_ttl_ordered(stream, ttl_min=12 * 60, bucket_s=86_400, delay="1 day", order=["event_id"], shards=SHARDS), where)
    return out.where(F.col("id") != "beat").select("id", utc_ntz(F.col("reported_at")).alias("reported_at"))


@query(ORACLES["stream_rate_limit"])
def ordered_rate_limit(spark, sf_dir):
    _stateful(spark)
    where = _scratch(spark)
    rows = _timed(B.reports(spark, sf_dir).select("event_id", "id", "reported_at"), "reported_at")
    stream = _in_files(spark, rows, "reported_at", f"{where}/in").withColumn("id", F.when(F.col("event_id") >= 0, F.col("id")).otherwise("beat"))
    out = run_to_end(ordered.rate_limit_ordered(stream, "id", "reported_at", 2, 86_400, bucket_s=86_400, delay="1 day", order=["event_id"], shards=SHARDS), where)
    return out.where("event_id >= 0").select("event_id", "accepted")


def _telecom_stream(spark, sf_dir, where: str) -> DataFrame:
    """Pings with their outcomes, counted as they pass."""
    rows = _timed(B.pings(spark, sf_dir), "timestamp")
    stream = _in_files(spark, rows, "timestamp", f"{where}/in")
    stream = stream.withColumns({"device_id": F.when(F.col("event_id") >= 0, F.col("device_id")).otherwise("beat"), "lat": F.when(F.col("event_id") >= 0, F.col("lat")).otherwise(-6.8), "lon": F.when(F.col("event_id") >= 0, F.col("lon")).otherwise(39.2)})
    judged = ingest.telecom_judged(stream, F.lit(B.SALT_DATE).cast("date"))
    dwelling = ordered.flag_residential_ordered(judged.where(F.col("outcome").isNull()), bucket_s=86_400, delay="1 day", order=["event_id"], shards=SHARDS)
    dwelling = dwelling.withColumn("outcome", F.when(F.col("residential"), "residential").otherwise("published")).drop("residential")
    return counters.counted(judged.where(F.col("outcome").isNotNull()).unionByName(dwelling).where("event_id >= 0"), "telecom", ingest.TELECOM_OUTCOMES)


@query(ingestion.ORACLES["ingest_counts"])
def stream_ingest_counts(spark, sf_dir):
    """Counts that a listener wrote for each micro-batch of a stream of pings, summed up."""
    _stateful(spark)
    where = _scratch(spark)
    with counters.CounterLog(spark, f"{where}/counts"):
        run_to_end(_telecom_stream(spark, sf_dir, where), where)
    return counters.read_counters(spark, f"{where}/counts").groupBy("source", "outcome").agg(F.sum("n_rows").alias("n_rows"))


@query(f"""WITH {B.events_cte(10)} SELECT road_segment_id, time_bucket(INTERVAL '6 hours', event_time) AS event_time, count(*) AS n_rows FROM ev GROUP BY 1, 2
HAVING time_bucket(INTERVAL '6 hours', event_time) + INTERVAL 6 HOUR > (SELECT max(event_time) FROM ev) - INTERVAL 2 HOUR""")
def stream_state_left(spark, sf_dir):
    """The windows that a stream still holds when its input has ended: those that the watermark has not passed."""
    _stateful(spark)
    where = _scratch(spark)
    e = event_stream(spark, sf_dir)
    rows = e.select((F.col("user_id") % 10).alias("road_segment_id"), F.col("ts").alias("event_time")).withWatermark("event_time", "2 hours")
    run_to_end(rows.groupBy("road_segment_id", F.window("event_time", "6 hours").alias("window")).agg(F.count("*").alias("n")).select("road_segment_id", "window.start", "n"), where)
    left = counters.state_left(spark, f"{where}/ck")
    return left.select("road_segment_id", utc_ntz(F.col("window.start")).alias("event_time"), F.col("value_count").alias("n_rows"))


@query(f"WITH {B.PINGS} SELECT vehicle_id AS vehicle_id_hash, count(*) AS n_rows, round(max(speed_kmh), 6) AS top_speed_kmh, max(timestamp) AS last_seen FROM pings GROUP BY 1")
def topic_stream(spark, sf_dir):
    """Fleet points recorded as messages of a topic of four partitions, read as a stream and parsed; it is stopped after the first half and goes on from its offsets."""
    where = _scratch(spark)
    rows = B.pings(spark, sf_dir).select(F.lit("fleet_gps").alias("source_type"), "event_id", F.col("vehicle_id").alias("vehicle_id_hash"), "provider", "lat", "lon", "speed_kmh", "heading", utc_instant(F.col("timestamp")).alias("timestamp"))
    for half in (0, 1):
        topics.record_topics(sinks.to_kafka_rows(rows.where(F.col("event_id") % 2 == half), "source_type"), f"{where}/log", 4)
        stream = deserialize(topics.read_topics(spark, f"{where}/log", ["traffic.raw.fleet"], streaming=True), "fleet_gps")
        out = run_to_end(stream.where("parsed").select("vehicle_id_hash", "speed_kmh", "timestamp"), where)
    seen = out.groupBy("vehicle_id_hash").agg(F.count("*").alias("n_rows"), F.max("speed_kmh").alias("top_speed_kmh"), F.max("timestamp").alias("last_seen"))
    return rounded(seen.withColumn("last_seen", utc_ntz(F.col("last_seen"))))
