"""From nested responses to validated messages: flatten, parameters, guards, validation with a dead-letter side, routing, envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions.columns import catalogue_slug, guarded_int
from adlake.sources.tables import AD_MESSAGE, ALIASES

RESPONSE = (
    "data struct<advertSearch: struct<totalCount: int, edges: array<struct<node: struct<id: string, url: string, title: string, shortDescription: string, createdAt: string, "
    "price: struct<amount: struct<units: string, currencyCode: string>>, parameters: array<struct<key: string, value: string>>, "
    "location: struct<city: struct<name: string>, region: struct<name: string>>, sellerLink: struct<id: string>, mainPhoto: struct<url: string>>>>>>, errors array<struct<message: string>>"
)
#: Constants on every scraped ad, required fields of both message kinds, ads on a page of the source.
SOURCE_NAME, COUNTRY = "otomoto.pl", "PL"
REQUIRED_AD = ["source_ad_id", "url", "source_name", "country_code", "scraped_at"]
REQUIRED_SNAPSHOT = ["source_name", "ad_ids", "make_str"]
PAGE = 50


def parse(responses: DataFrame, column: str = "body") -> DataFrame:
    """The response text as a struct `r`, and `outcome`: ok, retry (the source reports errors), or error (no JSON, nothing searched)."""
    r = F.from_json(column, RESPONSE)
    parsed = responses.withColumn("r", r)
    outcome = F.when(F.size("r.errors") > 0, "retry").when(F.col("r.data.advertSearch").isNull(), "error").otherwise("ok")
    return parsed.withColumn("outcome", outcome)


def params_map(pairs: Column) -> Column:
    """Key -> value of the parameters with a key and a value; the last of a repeated key wins, without a session setting."""
    held = F.filter(pairs, lambda p: (p["key"] != "") & p["value"].isNotNull())
    last = F.filter(held, lambda p, i: ~F.exists(F.slice(held, i + 2, F.size(held)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def flatten(parsed: DataFrame) -> DataFrame:
    """One flat row per advert of the `ok` responses."""
    nodes = parsed.where("outcome = 'ok'").select(F.explode("r.data.advertSearch.edges.node").alias("n")).where("n IS NOT NULL")
    rows = nodes.withColumn("p", F.coalesce(params_map(F.col("n.parameters")), F.create_map().cast("map<string,string>")))
    p = lambda k: F.try_element_at("p", F.lit(k))
    photo = F.col("n.mainPhoto.url")
    return rows.select(
        F.col("n.id").alias("source_ad_id"),
        F.col("n.url").alias("url"),
        F.lit(SOURCE_NAME).alias("source_name"),
        F.lit(COUNTRY).alias("country_code"),
        F.current_timestamp().alias("scraped_at"),
        F.col("n.title").alias("title"),
        F.col("n.shortDescription").alias("description"),
        F.col("n.createdAt").alias("posted_on_source_at"),
        F.col("n.price.amount.units").alias("price"),
        F.col("n.price.amount.currencyCode").alias("currency"),
        *[p(k).alias(f"{k}_str") for k in ("make", "model", "version", "generation")],
        guarded_int(p("year")).alias("year"),
        guarded_int(p("mileage")).alias("mileage"),
        p("fuel_type").alias("fuel_type_str"),
        guarded_int(p("engine_capacity")).alias("engine_capacity_cm3"),
        guarded_int(p("engine_power")).alias("engine_power_hp"),
        p("gearbox").alias("gearbox_str"),
        p("transmission").alias("transmission_str"),
        p("color").alias("color_str"),
        F.col("n.location.city.name").alias("city_str"),
        F.col("n.location.region.name").alias("region_str"),
        F.col("n.sellerLink.id").alias("seller_link"),
        F.when(photo.isNotNull() & (photo != ""), F.array(photo)).otherwise(F.array().cast("array<string>")).alias("image_urls"),
    )


def validate(messages: DataFrame, required: list[str]) -> DataFrame:
    """messages with `valid` and `reason` (the missing required fields): split it into the table's side and the dead-letter side."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    return messages.withColumn("reason", F.array_join(missing, ",")).withColumn("valid", F.col("reason") == "")


def coerce(raw: DataFrame) -> DataFrame:
    """Text fields to the message's types: a number or a time that doesn't parse is NULL."""
    kinds = {"price": "double", "year": "int", "mileage": "int", "engine_capacity_cm3": "int", "engine_power_hp": "int"}
    at = {"scraped_at", "posted_on_source_at"}
    return raw.select(*[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.try_to_timestamp(c).alias(c) if c in at and dict(raw.dtypes)[c] == "string" else F.col(c) for c in raw.columns])


def from_json_messages(raw: DataFrame, column: str = "value") -> DataFrame:
    """JSON texts -> the message's columns and `keys`, those that the text holds (be it with a null).

    A field may come under its message key or under the table's column name; the message key goes first, if it is there.
    """
    kinds = {f.name: f.dataType for f in T._parse_datatype_string(AD_MESSAGE)}
    other = T.StructType([T.StructField(ALIASES[c], t) for c, t in kinds.items() if c in ALIASES])
    whole = raw.withColumn("m__", F.from_json(F.col(column).cast("string"), T.StructType([*[T.StructField(c, t) for c, t in kinds.items()], *other])))
    whole = whole.withColumn("k__", F.coalesce(F.json_object_keys(F.col(column).cast("string")), F.array().cast("array<string>")))
    held = lambda k: F.array_contains("k__", k)
    fields = [F.when(held(c), F.col(f"m__.{c}")).otherwise(F.col(f"m__.{ALIASES[c]}")).alias(c) if c in ALIASES else F.col(f"m__.{c}").alias(c) for c in kinds]
    names = {ALIASES[c]: c for c in kinds if c in ALIASES}
    canonical = F.transform("k__", lambda k: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in names.items() for x in p]), k), k))
    return whole.select(*raw.columns, *fields, F.array_distinct(canonical).alias("keys"))


def presence(columns: list[str]) -> dict[str, Column]:
    """For each table column of messages with `keys`: whether the message holds it."""
    keys = {v: k for k, v in ALIASES.items()}
    return {c: F.array_contains("keys", keys.get(c, c)) for c in columns}


def project(messages: DataFrame) -> DataFrame:
    """Message keys to table columns; what the table doesn't keep is dropped, the price narrowed to a whole number."""
    dropped = {"description", "country_code", "scraped_at", "image_urls"}
    cols = [c for c in messages.columns if c not in dropped]
    return messages.select(*[(F.col(c).cast("int") if c == "price" else F.col(c)).alias(ALIASES.get(c, c)) for c in cols])


def route(items: DataFrame) -> DataFrame:
    """topic for each item by its kind; unknown kinds are skipped."""
    topic = F.when(F.col("kind") == "ad", "parsed_car_ads").when(F.col("kind") == "active_ids", "active_car_ids")
    return items.withColumn("topic", topic).where("topic IS NOT NULL")


def envelope(items: DataFrame, key: str, fallback: str | None = None) -> DataFrame:
    """(key, value): the item as JSON. The fallback key serves only where the key's column is absent."""
    name = key if key in items.columns else fallback
    return items.select(F.col(name).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def snapshot_rows(messages: DataFrame) -> DataFrame:
    """The snapshot of a run as rows: the distinct (source_name, make_str, id_ad). The aggregation is the barrier that completes a make."""
    return messages.select("source_name", "make_str", F.col("source_ad_id").alias("id_ad")).distinct()


def active_ids(rows: DataFrame) -> DataFrame:
    """Snapshot rows as the sink's messages, one array of ids for a source and make; a message is bounded by what the source lists of one make."""
    return rows.groupBy("source_name", "make_str").agg(F.array_sort(F.collect_set("id_ad")).alias("ad_ids"))


def exploded_ids(snapshots: DataFrame) -> DataFrame:
    """Snapshot messages as rows with `seq`, the message's offset (where there is none, a hash of it); an empty snapshot is a row with a null id."""
    seq = F.col("offset") if "offset" in snapshots.columns else F.xxhash64("source_name", "make_str", "ad_ids")
    return snapshots.select("source_name", "make_str", seq.alias("seq"), F.explode_outer("ad_ids").alias("id_ad")).distinct()


def page_plan(makes: DataFrame, page: int = PAGE) -> DataFrame:
    """(make, page): pages 1..ceil(total / page) of each make; none for a total of 0."""
    last = F.ceil(F.col("total") / page).cast("int")
    pages = F.when(F.col("total") > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return makes.select("make", F.explode(pages).alias("page"))


def request_urls(plan: DataFrame, base: str = "https://source.invalid/graphql", filters: list[dict] | None = None, persisted: str = "0" * 64) -> DataFrame:
    """Persisted-query URLs of a page plan: the given filters with the make's own filter put in its place."""
    kept = [f for f in filters or [] if f.get("name") != "filter_enum_make"]
    pair = lambda name, value: F.struct(F.lit(name).alias("name"), (value if isinstance(value, Column) else F.lit(value)).alias("value"))
    variables = F.to_json(F.struct(F.array(*[pair(f["name"], f["value"]) for f in kept], pair("filter_enum_make", F.col("make"))).alias("filters"), F.col("page").alias("page"), F.lit(PAGE).alias("itemsPerPage")))
    extensions = F.to_json(F.struct(F.struct(F.lit(1).alias("version"), F.lit(persisted).alias("sha256Hash")).alias("persistedQuery")))
    quoted = lambda c: F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    return plan.select("make", "page", F.concat(F.lit(f"{base}?operationName=listingScreen&variables="), quoted(variables), F.lit("&extensions="), quoted(extensions)).alias("url"))


def catalogue(texts: DataFrame) -> DataFrame:
    """Whole JSON texts (comment lines allowed) -> (name, slug) of the make filter's entries, one a slug."""
    bare = F.regexp_replace("value", r"(?m)^\s*//.*$", "")
    rows = texts.select(F.explode(F.from_json(bare, "array<struct<name:string,value:string,canonical:string,`__typename`:string>>")).alias("e"))
    own = rows.where("e.name = 'filter_enum_make' AND e.value IS NOT NULL")
    slug = F.coalesce(F.col("e.canonical"), catalogue_slug(F.col("e.value")))
    return own.select(F.col("e.value").alias("name"), slug.alias("slug")).groupBy("slug").agg(F.min("name").alias("name"))


def plan_catalogue(entries: DataFrame, known: DataFrame) -> DataFrame:
    """entries with `action`: added, or skipped where the slug is known."""
    have = known.select("slug", F.lit(True).alias("have__"))
    return entries.join(have, "slug", "left").withColumn("action", F.when(F.col("have__"), "skipped").otherwise("added")).drop("have__")


def load_catalogue(entries: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries to add, counters): insert-if-absent by slug."""
    planned = plan_catalogue(entries, known)
    return planned.where("action = 'added'").drop("action"), planned.agg(F.count_if(F.col("action") == "added").alias("added"), F.count_if(F.col("action") == "skipped").alias("skipped"))


def catalogue_errors(texts: DataFrame) -> DataFrame:
    """One row, `errors`: entries of the make filter without a name."""
    bare = F.regexp_replace("value", r"(?m)^\s*//.*$", "")
    rows = texts.select(F.explode(F.from_json(bare, "array<struct<name:string,value:string>>")).alias("e"))
    return rows.agg(F.count_if((F.col("e.name") == "filter_enum_make") & (F.coalesce("e.value", F.lit("")) == "")).alias("errors"))


def store_catalogue(texts: DataFrame, path: str) -> dict[str, int]:
    """Adds the catalogue's makes (name, slug) that the table at `path` lacks, all in one commit or, if an entry has no name, none; the counters."""
    spark = texts.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    known = spark.read.schema("slug string, name string").parquet(path) if there else spark.createDataFrame([], "slug string, name string")
    new, counts = load_catalogue(catalogue(texts).where("name <> ''"), known)
    done = counts.first().asDict() | catalogue_errors(texts).first().asDict()
    if done["errors"]:
        return done | {"added": 0}
    if done["added"]:
        new.select("slug", "name").write.mode("append").parquet(path)
    return done


def by_make(flat: DataFrame) -> DataFrame:
    """A run's totals by make: ads, those with a price, and their share."""
    priced = F.count_if(F.col("price").isNotNull())
    return flat.groupBy("make_str").agg(F.count("*").alias("items"), priced.alias("priced"), (priced / F.count("*")).alias("share"))


def run_metrics(parsed: DataFrame) -> DataFrame:
    """Counters of a crawl: pages, errors, retries and items."""
    items = F.when(F.col("outcome") == "ok", F.size(F.filter("r.data.advertSearch.edges", lambda e: e["node"].isNotNull()))).otherwise(0)
    return parsed.agg(F.count("*").alias("pages"), F.count_if(F.col("outcome") == "error").alias("errors"), F.count_if(F.col("outcome") == "retry").alias("retries"), F.coalesce(F.sum(items), F.lit(0)).alias("items"))
