"""Schemas of the engine's own tables, and the projections that make listings and messages out of the given ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AD_COLUMNS = (
    "id_ad title make_name model_name version generation year price currency_code fuel_type gearbox mileage engine_capacity color transmission engine_power "
    "city region url_ad created_at source_name sold_at"
).split()
#: The response's names, where they differ from the table's.
RESPONSE_NAMES = {"currency_code": "currencyCode", "created_at": "createdAt"}
AD_MESSAGE = (
    "source_ad_id string, url string, source_name string, country_code string, scraped_at timestamp, title string, description string, posted_on_source_at timestamp, "
    "price double, currency string, make_str string, model_str string, version_str string, generation_str string, year int, mileage int, fuel_type_str string, "
    "engine_capacity_cm3 int, engine_power_hp int, gearbox_str string, transmission_str string, color_str string, city_str string, region_str string, seller_link string, image_urls array<string>"
)
SNAPSHOT_MESSAGE = "source_name string, ad_ids array<string>, make_str string"
HISTORY = "auto_ad_id string, timestamp timestamp, price int, currency_code string, status string"
#: Message key -> column of the listing table, where they differ.
ALIASES = {
    "source_ad_id": "id_ad", "url": "url_ad", "posted_on_source_at": "created_at", "currency": "currency_code", "make_str": "make_name", "model_str": "model_name",
    "version_str": "version", "generation_str": "generation", "fuel_type_str": "fuel_type", "engine_capacity_cm3": "engine_capacity", "engine_power_hp": "engine_power",
    "gearbox_str": "gearbox", "transmission_str": "transmission", "color_str": "color", "city_str": "city", "region_str": "region",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str, columns: list[str] | None = None, only: str | None = None, among: DataFrame | None = None) -> DataFrame:
    """One listing per order; see FIXTURES.md. `columns`: those asked for; sides that serve none of them are neither read nor joined.
    `only`: the one listing of that id, told before its key becomes text, so that the scan prunes by it. `among`: those of a page's few id_ads; all sides are cut down to
    them before they are joined."""
    key, size = F.col("o_orderkey"), F.col("p_size")
    unless = lambda n, x: F.when(key % n != 0, x)
    made = {
        "id_ad": key.cast("string"),
        "title": F.when(F.col("p_brand").isNotNull(), F.concat_ws(" ", "p_brand", "p_name", "p_type")),
        "make_name": F.col("p_brand"),
        "model_name": F.col("p_name"),
        "version": F.col("p_type"),
        "generation": F.when(size % 4 != 0, F.concat(F.lit("Mk "), (size % 4).cast("string"))),
        "year": unless(13, (1985 + key % 40).cast("int")),
        "price": unless(17, F.when(key % 19 == 0, 0).otherwise(F.floor(F.col("o_totalprice") / 4).cast("int"))),
        "currency_code": F.lit("PLN"),
        "fuel_type": F.col("c_mktsegment"),
        "gearbox": F.col("o_orderpriority"),
        "mileage": (F.col("o_custkey") * 137 % 250000).cast("int"),
        "engine_capacity": (900 + size * 40).cast("int"),
        "color": unless(7, F.concat(F.lit("shade "), (F.col("o_custkey") % 9).cast("string"))),
        "transmission": F.when(F.col("o_custkey") % 5 == 0, "all-wheels").otherwise("front-wheels"),
        "engine_power": (60 + size * 3).cast("int"),
        "city": F.col("n_name"),
        "region": unless(23, F.col("r_name")),
        "url_ad": F.concat(F.lit("https://ad.invalid/"), key.cast("string")),
        "created_at": F.col("o_orderdate").cast("timestamp_ntz"),
        "source_name": F.concat(F.lit("src"), (F.col("o_custkey") % 3).cast("string")),
        "sold_at": F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast("timestamp_ntz") + F.expr("INTERVAL 30 DAYS")),
    }
    wanted = [c for c in AD_COLUMNS if columns is None or c in columns]
    rows = read(spark, sf_dir, "orders")
    if only is not None:
        rows = rows.where((key == F.lit(only).try_cast("long")) & (key.cast("string") == only))
    keys = None if among is None else F.broadcast(among.select(F.col("id_ad").cast("long").alias("only_key")))
    if keys is not None:
        rows = rows.join(keys, rows.o_orderkey == keys.only_key, "left_semi")
    if {"title", "make_name", "model_name", "version", "generation", "engine_capacity", "engine_power"} & set(wanted):
        lines = read(spark, sf_dir, "lineitem")
        lines = lines if keys is None else lines.join(keys, lines.l_orderkey == keys.only_key, "left_semi")
        lines = lines.groupBy("l_orderkey").agg(F.min("l_partkey").alias("p_partkey"))
        part = read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_type", "p_size")
        rows = rows.join(lines, rows.o_orderkey == lines.l_orderkey, "left").join(part, "p_partkey", "left")
    if {"fuel_type", "city", "region"} & set(wanted):
        rows = rows.join(read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"), "left")
    if {"city", "region"} & set(wanted):
        where = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
        rows = rows.join(where, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.select(*[made[c].alias(c) for c in wanted])


def response(ads: DataFrame) -> DataFrame:
    """The listing as the API shows it: all its fields under the response's names."""
    return ads.select(*[F.col(c).alias(RESPONSE_NAMES.get(c, c)) for c in AD_COLUMNS])


def history(ads: DataFrame) -> DataFrame:
    """Change log of the projection, in one pass: `active` when listed, `sold` when closed."""
    event = lambda at, status: F.struct(F.col(at).alias("timestamp"), F.lit(status).alias("status"))
    rows = ads.select(F.col("id_ad").alias("auto_ad_id"), "price", "currency_code", F.explode(F.array(event("created_at", "active"), event("sold_at", "sold"))).alias("e"))
    return rows.select("auto_ad_id", "e.timestamp", "price", "currency_code", "e.status").where("timestamp IS NOT NULL")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ad message stream over events, in arrival order of `offset`."""
    e = F.col("event_id")
    return read(spark, sf_dir, "events").select(
        e.alias("offset"),
        F.col("ts").cast("timestamp_ntz").alias("scraped_at"),
        F.col("user_id").cast("string").alias("source_ad_id"),
        F.concat(F.lit("src"), (F.col("user_id") % 3).cast("string")).alias("source_name"),
        F.col("event_type").alias("make_str"),
        F.when(e % 29 != 0, F.floor(F.col("value") / 10).cast("int")).alias("price"),
        "props",
    )
