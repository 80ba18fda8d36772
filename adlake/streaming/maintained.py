"""Statistics kept up to date from changes: what a message alters is taken out of the counts as it was and put in as it is now.

`changes` turns the message stream into signed rows of the listing (before: -1, after: +1, an ad's net change of a micro-batch), in the state store of keyed.py. `measures`
counts values by statistic and group in a second stateful query: a multiset (stat, key, value) -> n, from which counts, sums, averages, medians' ranks
and also least and greatest values follow, as a value whose count returns to 0 is gone. A micro-batch costs what it changes; reading the
statistics costs the multiset (different values), not the listings.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions.columns import price_bucket, rounded
from adlake.operators.state import UPDATED
from adlake.streaming import keyed as K


class RowChanges(K.ListingState):
    """One ad: its row before and after a micro-batch, where they differ."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = tuple(self.row.get()) if self.row.exists() else None
        for _ in super().handleInputRows(key, rows, timerValues):
            pass
        after = tuple(self.row.get()) if self.row.exists() else None
        if before != after:
            for sign, values in ((-1, before), (1, after)):
                if values is not None:
                    yield Row(id_ad=key[0], sign=sign, **dict(zip(self.kept.names, values, strict=True)))


def changes(messages: DataFrame) -> DataFrame:
    """A stream of messages, as keyed.listing_log takes them -> (id_ad, sign, the row's columns, sold_at)."""
    columns = [c for c in messages.columns if c in UPDATED]
    kept = T.StructType([*[T.StructField(f.name, f.dataType) for f in messages.schema if f.name in columns or f.name == "source_name"], T.StructField("sold_at", T.TimestampNTZType())])
    out = T.StructType([T.StructField("id_ad", T.StringType()), T.StructField("sign", T.IntegerType()), *kept.fields])
    if "closed_at" not in messages.columns:
        messages = messages.withColumn("closed_at", F.lit(None).cast("timestamp_ntz"))
    return messages.groupBy("id_ad").transformWithState(RowChanges(columns, kept), out, "Append", "None")


def _facts(rows: DataFrame) -> list[Column]:
    """(stat, key, value) of one listing, NULL for what it is no part of."""
    held, price = set(rows.columns), F.col("price")
    fact = lambda stat, key, value, when: F.when(when, F.struct(F.lit(stat).alias("stat"), key.cast("string").alias("key"), value.cast("long").alias("value")))
    none, yes = F.lit(None), F.lit(True)
    out = [
        fact("state", F.when(F.col("sold_at").isNull(), "active").otherwise("sold"), none, yes),
        fact("price", none, price, price > 0), fact("bucket", price_bucket(price), none, price > 0),
        fact("day", F.to_date("created_at"), price, (price > 0) & F.col("created_at").isNotNull()),
    ]
    for name, column in (("make", "make_name"), ("region", "region")):
        if column in held:
            out.append(fact(name, F.col(column), price, F.col(column).isNotNull() & (price > 0)))
    if "mileage" in held:
        out.append(fact("mileage", none, F.col("mileage"), F.col("mileage") > 0))
    if "year" in held:
        out.append(fact("year", F.col("year"), none, F.col("year").isNotNull()))
    return out


def measures(changed: DataFrame) -> DataFrame:
    """A stream of changes -> (stat, key, value, n), in update mode."""
    facts = changed.select("sign", F.explode(F.array_compact(F.array(*_facts(changed)))).alias("f")).select("sign", "f.*")
    return facts.groupBy("stat", "key", "value").agg(F.sum("sign").alias("n"))


class MaintainedStats:
    """The two queries under one path; run() takes in what is there, counts() are the multiset as last committed."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def run(self, messages: DataFrame) -> None:
        with K.state_store(self.spark):
            changed = changes(messages)
            first = changed.writeStream.format("parquet").option("path", f"{self.base}/changes").option("checkpointLocation", f"{self.base}/checkpoint-changes")
            first.trigger(availableNow=True).start().awaitTermination()
            rows = self.spark.readStream.schema(changed.schema).parquet(f"{self.base}/changes")
            second = measures(rows).writeStream.outputMode("update").format("noop").option("checkpointLocation", f"{self.base}/checkpoint-counts")
            second.trigger(availableNow=True).start().awaitTermination()

    def counts(self) -> DataFrame:
        rows = self.spark.read.format("statestore").option("path", f"{self.base}/checkpoint-counts").load()
        return rows.select("key.stat", "key.key", "key.value", F.col("value.*")).toDF("stat", "key", "value", "n").where("n <> 0")


def _priced(counts: DataFrame, stat: str, name: str) -> DataFrame:
    total = F.sum("n")
    average = (F.sum(F.col("n") * F.col("value")) / total).cast("double")
    return counts.where(F.col("stat") == stat).groupBy(F.col("key").alias(name)).agg(total.alias("count"), rounded(average).alias("avg_price"), F.min("value").cast("int").alias("min_price"), F.max("value").cast("int").alias("max_price"))


def makes(counts: DataFrame, limit: int = 10) -> DataFrame:
    """stats.makes, from the counts."""
    return _priced(counts, "make", "make_name").orderBy(F.desc("count"), "make_name").limit(limit)


def regions(counts: DataFrame, limit: int = 10) -> DataFrame:
    """stats.regions, from the counts."""
    return _priced(counts, "region", "region").select("region", "count", "avg_price").orderBy(F.desc("count"), "region").limit(limit)


def price_distribution(counts: DataFrame) -> DataFrame:
    """stats.price_distribution, from the counts."""
    return counts.where("stat = 'bucket'").groupBy(F.col("key").alias("price_range")).agg(F.sum("n").alias("count"))


def trends(counts: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """stats.trends by day, from the counts; as_of is midnight."""
    since = F.lit(as_of).cast("timestamp_ntz") - F.make_interval(days=F.lit(days))
    by = _priced(counts, "day", "period").select(F.col("period").cast("timestamp_ntz").alias("period"), "count", "avg_price")
    return by.where(F.col("period") >= since).orderBy("period")


def year_distribution(counts: DataFrame, newest: int = 20) -> DataFrame:
    """stats.year_distribution, from the counts."""
    by = counts.where("stat = 'year'").groupBy(F.col("key").cast("int").alias("year")).agg(F.sum("n").alias("count"))
    return by.where("year > 1990").orderBy(F.desc("year")).limit(newest)


def general(counts: DataFrame) -> DataFrame:
    """stats.general but for the median, from the counts."""
    state = lambda key: F.coalesce(F.sum(F.when((F.col("stat") == "state") & ((F.col("key") == key) if key else F.lit(True)), F.col("n"))), F.lit(0))
    mean = lambda stat: rounded((F.sum(F.when(F.col("stat") == stat, F.col("n") * F.col("value"))) / F.sum(F.when(F.col("stat") == stat, F.col("n")))).cast("double"))
    return counts.agg(state(None).alias("total_ads"), state("active").alias("active_ads"), state("sold").alias("sold_ads"), mean("price").alias("avg_price"), mean("mileage").alias("avg_mileage"))
