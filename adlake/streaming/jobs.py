"""Structured Streaming jobs: the message stream into listing state and change log, snapshots that close listings, pages that complete makes, rejects.

State is Spark's own (keyed.py): a query's checkpoint holds the offsets, the state's versions and what was committed together, so a killed or restarted query goes
on where it was, a replayed batch changes nothing, and two queries can't write one state. A `ListingStream` reads two sources, messages and closings: a snapshot is
compared with the state as committed, and what it doesn't show is sent back to the state as closings.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.operators import ingest as I
from adlake.operators import state as S
from adlake.sources import tables as T
from adlake.streaming import keyed as K
from adlake.streaming import maintained as M
from adlake.streaming import sink

CLOSINGS = "id_ad string, offset long, closed_at timestamp_ntz"


def shared_dir(spark: SparkSession) -> str:
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile

        d = tempfile.mkdtemp(prefix="adlake-stream-")
    return f"{d.rstrip('/')}/stream-{uuid.uuid4().hex}"


def from_events(df: DataFrame) -> DataFrame:
    e = F.col("event_id")
    return df.select(
        e.alias("offset"), F.col("user_id").cast("string").alias("id_ad"), F.concat(F.lit("src"), (F.col("user_id") % 3).cast("string")).alias("source_name"), F.col("event_type").alias("make_name"),
        F.when(e % 29 != 0, F.floor(F.col("value") / 10).cast("int")).alias("price"), F.lit("PLN").alias("currency_code"), F.col("ts").cast("timestamp_ntz").alias("created_at"),
    )


def kafka_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The message bus as a stream (needs Spark's Kafka connector) of raw values, read from the earliest offset."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest").load()
    return raw.select("offset", F.col("value").cast("string").alias("value"))


def ad_messages(raw: DataFrame) -> DataFrame:
    """Raw ad values (offset, value) -> valid messages under table column names, with the keys they hold."""
    parsed = I.from_json_messages(raw).drop("value")
    valid = I.validate(parsed, I.REQUIRED_AD).where("valid").drop("valid", "reason")
    return I.project(valid).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


def snapshot_messages(raw: DataFrame) -> DataFrame:
    """Raw snapshot values (offset, value) -> snapshots, as apply_snapshot takes them."""
    return raw.select("offset", F.from_json("value", T.SNAPSHOT_MESSAGE).alias("m")).select("offset", "m.*")


def kafka_sink(items: DataFrame, key: str, fallback: str | None, servers: str, topic: str, checkpoint: str):
    """Items as enveloped messages: their key, and the item as JSON."""
    out = I.envelope(items, key, fallback).writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    return out.option("checkpointLocation", checkpoint).start()


class ListingStream:
    """Listing state under one path, by a query that may be stopped and started again."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.checkpoint = f"{self.base}/checkpoint"

    def run(self, messages: DataFrame) -> None:
        """messages (a stream under table column names) and closings, as far as they go now."""
        first = f"{self.base}/closings/none"  # the folder has to be there
        self.spark.createDataFrame([], CLOSINGS).write.mode("overwrite").parquet(first)
        closings = self.spark.readStream.schema(CLOSINGS).parquet(f"{self.base}/closings/*")
        both = messages.unionByName(closings, allowMissingColumns=True)
        with K.state_store(self.spark):
            out = K.listing_log(both).writeStream.format("parquet").option("path", f"{self.base}/log").option("checkpointLocation", self.checkpoint)
            out.trigger(availableNow=True).start().awaitTermination()

    def current(self) -> DataFrame:
        return K.current(self.spark, self.checkpoint)

    def history(self) -> DataFrame:
        return self.spark.read.schema(K.LOG).parquet(f"{self.base}/log")

    def close_unseen(self, snapshots: DataFrame, at: str) -> None:
        """Compares a stream of snapshots with the committed state; the closings take effect with the next run().

        Snapshots of one micro-batch count one by one: an ad stays open only if each that covers it shows it. A batch that is replayed writes its closings
        again, which changes nothing, as an ad closes once."""

        def step(df: DataFrame, batch: int) -> None:
            shown = I.exploded_ids(I.validate(df, I.REQUIRED_SNAPSHOT).where("valid"))
            gone = S.gone(self.current(), shown)
            rows = gone.select("id_ad", F.coalesce("seq", F.lit(0)).cast("long").alias("offset"), F.lit(at).cast("timestamp_ntz").alias("closed_at"))
            rows.write.mode("overwrite").parquet(f"{self.base}/closings/{batch}")

        query = snapshots.writeStream.foreachBatch(step).option("checkpointLocation", f"{self.base}/checkpoint-snapshots").trigger(availableNow=True).start()
        query.awaitTermination()


def files(spark: SparkSession, path: str, schema=None, each_batch: int | None = None) -> DataFrame:
    """A folder's (or one file's) Parquet rows as a stream."""
    folder, name = path.rsplit("/", 1)
    schema = schema or spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name) if name.endswith(".parquet") else spark.readStream.schema(schema)
    if each_batch:
        reader = reader.option("maxFilesPerTrigger", each_batch)
    return reader.parquet(folder if name.endswith(".parquet") and not _is_folder(spark, path) else path)


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def run_upserts(spark: SparkSession, events_path: str, base: str) -> ListingStream:
    """The whole folder or file of events as a stream, to its end."""
    listing = ListingStream(spark, base)
    listing.run(from_events(files(spark, events_path)))
    return listing


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = run_upserts(spark, f"{sf_dir}/events.parquet", shared_dir(spark))
    return listing.current().select("id_ad", "source_name", "make_name", "price", "currency_code", "created_at")


def stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log that the state's stream emits."""
    listing = run_upserts(spark, f"{sf_dir}/events.parquet", shared_dir(spark))
    return listing.history().select(F.col("auto_ad_id").alias("id_ad"), "offset", "price", "status")


def stream_sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upserts, then the snapshot of the last 12 hours as a stream of its own, whose closings go into the same state."""
    base = shared_dir(spark)
    listing = run_upserts(spark, f"{sf_dir}/events.parquet", base)
    m = T.messages(spark, sf_dir)
    end = m.agg(F.max("scraped_at").alias("end"))
    late = m.join(end, F.col("scraped_at") > F.col("end") - F.expr("INTERVAL 12 HOURS")).withColumn("make_str", F.lit(""))
    I.active_ids(I.snapshot_rows(late)).write.parquet(f"{base}/snapshots")
    listing.close_unseen(files(spark, f"{base}/snapshots", "source_name string, make_str string, ad_ids array<string>"), "2024-01-31 00:00:00")
    listing.run(from_events(files(spark, f"{sf_dir}/events.parquet")))
    return listing.current().select("id_ad", "source_name", "price", "sold_at")


def crawled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a crawl, as its results come: the messages of a source and make by runs of their offsets."""
    m = T.messages(spark, sf_dir).withColumn("page", F.floor(F.col("offset") / 500).cast("int"))
    pages = m.groupBy("source_name", "make_str", "page").agg(F.collect_set("source_ad_id").alias("ids"))
    total = pages.groupBy("source_name", "make_str").agg(F.count("*").cast("int").alias("pages"))
    return pages.join(total, ["source_name", "make_str"]).select("source_name", F.lit("run 1").alias("run"), "make_str", "page", "pages", "ids", F.lit("2024-02-01").cast("timestamp").alias("at"))


def stream_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of makes, each sent when its last page is there; pages come in no order over several micro-batches, each twice."""
    base = shared_dir(spark)
    pages = crawled_pages(spark, sf_dir)
    twice = pages.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    twice.repartitionByRange(6, F.xxhash64("source_name", "make_str", "page", "n")).drop("n").write.parquet(f"{base}/pages")
    with K.state_store(spark):
        rows = K.completion(files(spark, f"{base}/pages", pages.schema, 2))
        out = rows.writeStream.format("parquet").option("path", f"{base}/snapshot").option("checkpointLocation", f"{base}/checkpoint-pages")
        out.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(K.SNAPSHOT).parquet(f"{base}/snapshot")


def raw_messages(events: DataFrame) -> DataFrame:
    """Messages as text, of a batch or a stream of events; every 11th lacks its url, every 13th its id."""
    e = F.col("event_id")
    return events.select(
        e.alias("offset"), F.when(e % 13 != 0, F.col("user_id").cast("string")).alias("source_ad_id"), F.when(e % 11 != 0, F.concat(F.lit("https://ad.invalid/"), e)).alias("url"),
        F.concat(F.lit("src"), (F.col("user_id") % 3).cast("string")).alias("source_name"), F.lit("PL").alias("country_code"), F.col("ts").cast("timestamp_ntz").alias("scraped_at"),
        F.when(e % 7 == 0, "n/a").when(e % 29 != 0, F.floor(F.col("value") / 10).cast("int").cast("string")).alias("price"), F.col("event_type").alias("make_str"),
    )


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What validation turns away from the message stream, as the transactional sink keeps it."""
    base = shared_dir(spark)
    routed = sink.split(I.coerce(raw_messages(files(spark, f"{sf_dir}/events.parquet"))), I.REQUIRED_AD, "parsed_car_ads")
    sink.start(routed, f"{base}/tables", f"{base}/checkpoint-routed").trigger(availableNow=True).start().awaitTermination()
    return sink.committed(spark, f"{base}/tables", sink.REJECTED, routed.schema).select("offset", "source_ad_id", "url", "reason", "price")


def stream_make_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of makes as the message stream leaves them, kept by retractions."""
    stats = M.MaintainedStats(spark, shared_dir(spark))
    stats.run(from_events(files(spark, f"{sf_dir}/events.parquet")))
    return M.makes(stats.counts())


def stream_price_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price histogram as the message stream leaves it, kept by retractions."""
    stats = M.MaintainedStats(spark, shared_dir(spark))
    stats.run(from_events(files(spark, f"{sf_dir}/events.parquet")))
    return M.price_distribution(stats.counts())
