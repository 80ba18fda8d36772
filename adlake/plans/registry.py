"""queries() of the listing engine: every key over the listing, history and message projections of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.functions.columns import guarded_int
from adlake.operators import filters as L
from adlake.operators import ingest as I
from adlake.operators import state as S
from adlake.operators import stats as A
from adlake.operators import trigrams as G
from adlake.sources import layout
from adlake.sources import tables as T
from adlake.streaming import jobs

AS_OF = "2001-08-01 00:00:00"
SOLD_AT = "2024-01-31 00:00:00"
SOME = L.AdFilters(make="brand#1", price_from=5000, price_to=100000, sold=False)


def ads(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The listings; with columns, only these are built."""
    return T.listings(spark, sf_dir, list(columns) or None)


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message stream under table column names."""
    m = T.messages(spark, sf_dir)
    return m.select("offset", F.col("source_ad_id").alias("id_ad"), "source_name", F.col("make_str").alias("make_name"), "price", F.lit("PLN").alias("currency_code"), F.col("scraped_at").alias("created_at"), F.lit(True).alias("price_set"))


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing state after the whole stream."""
    return S.upsert(stream(spark, sf_dir)).withColumn("sold_at", F.lit(None).cast("timestamp_ntz"))


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids seen in the stream's last 12 hours, by source; the empty make stands for all makes."""
    m = T.messages(spark, sf_dir)
    end = m.agg(F.max("scraped_at").alias("end"))
    return I.snapshot_rows(m.join(end, F.col("scraped_at") > F.col("end") - F.expr("INTERVAL 12 HOURS")).withColumn("make_str", F.lit("")))


def closing(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(state, snapshot, what the snapshot doesn't show), each built once; Spark reuses their exchanges."""
    now, shown = state(spark, sf_dir), snapshot(spark, sf_dir)
    return now, shown, S.gone(now, shown)


def at() -> F.Column:
    return F.lit(SOLD_AT).cast("timestamp_ntz")


def whole(spark: SparkSession, d: str, picked: DataFrame, *order: F.Column) -> DataFrame:
    """A page's listings with all their fields: the sides are joined to the page's few rows, not to all listings."""
    return T.response(T.listings(spark, d, among=picked.select("id_ad")).orderBy(*order))


def ads_list_filtered(spark, d):
    picked = L.page(ads(spark, d, "id_ad", "make_name", "price", "sold_at"), SOME, sort_by="price", sort_order="asc")
    return whole(spark, d, picked, *L.order_by("price", "asc"))


def ads_page_2(spark, d):
    return whole(spark, d, L.page(ads(spark, d, "id_ad", "created_at"), number=2), *L.order_by())


def ads_page_deep(spark, d):
    """A page past 10,000 rows."""
    return whole(spark, d, L.deep_page(ads(spark, d, "id_ad", "created_at"), number=520), *L.order_by())


def ads_page_meta(spark, d):
    return L.page_meta(ads(spark, d, "id_ad", "make_name", "price", "sold_at"), SOME)


def ads_search(spark, d):
    return whole(spark, d, L.search(ads(spark, d, "id_ad", "title", "created_at"), "ring"), *L.order_by())


def ads_search_indexed(spark, d):
    """The search by an index of its titles, which is built here first."""
    base = jobs.shared_dir(spark)
    titles = ads(spark, d, "id_ad", "title", "created_at")
    G.build(titles, "id_ad", "title", f"{base}/titles")
    found = G.matching(titles, "id_ad", "title", f"{base}/titles", "ring")
    return whole(spark, d, found.orderBy(*L.order_by()).limit(L.PAGE_SIZE), *L.order_by())


def clustered(spark, d) -> DataFrame:
    """The listings in a layout of their own, written here first."""
    path = f"{jobs.shared_dir(spark)}/ads"
    layout.write(ads(spark, d), path, ["year", "price", "mileage"], ("id_ad",))
    return layout.table(spark, path)


def ad_clustered(spark, d):
    return T.response(clustered(spark, d).where("id_ad = '1'"))


def flt_range_clustered(spark, d):
    return L.filtered(clustered(spark, d), L.AdFilters(year_from=1995, year_to=2010, price_from=0, mileage_to=100000)).select(*SHORT)


def ad_history(spark, d):
    return L.history_of(T.history(T.listings(spark, d, ["id_ad", "created_at", "sold_at", "price", "currency_code"], only="1")), "1")


def ad_detail(spark, d):
    one = T.listings(spark, d, only="1")
    found = L.detail(one, T.history(one.select("id_ad", "created_at", "sold_at", "price", "currency_code")), "1")
    named = {c: T.RESPONSE_NAMES.get(c, c) for c in T.AD_COLUMNS}
    rows = found.select(*[F.col(c).alias(n) for c, n in named.items()], F.explode_outer("history").alias("h"))
    return rows.select(*named.values(), F.col("h.timestamp").alias("history_timestamp"), F.col("h.price").alias("history_price"), F.col("h.currency_code").alias("history_currencyCode"), F.col("h.status").alias("history_status"))


def ads_with_dims(spark, d):
    a = ads(spark, d, "id_ad", "make_name", "model_name")
    return S.with_dims(a, S.dim_make(a, "id_ad"), S.dim_model(a, "id_ad")).select("id_ad", "make_slug", "make_dim", "model_slug", "model_dim")


SHORT = ["id_ad", "make_name", "year", "price", "mileage", "source_name"]


def flt(*more: str, **kw):
    return lambda spark, d: L.filtered(ads(spark, d, *SHORT, *more), L.AdFilters(**kw)).select(*SHORT)


def makes_list(spark, d):
    return L.makes_list(ads(spark, d, "make_name"))


def models_by_make(spark, d):
    return L.models_of(ads(spark, d, "make_name", "model_name"), "Brand#1")


def stat(f, columns: str, *args, **kw):
    return lambda spark, d: f(ads(spark, d, *columns.split()), *args, **kw)


def dashboard_body(spark, d):
    """The dashboard's nested row as (section, pos, field, number, text) rows."""
    path = f"{jobs.shared_dir(spark)}/dashboard"  # one row, which each section is read from
    A.dashboard_body(ads(spark, d, "id_ad", "make_name", "model_name", "region", "price", "mileage", "created_at", "sold_at"), AS_OF).write.parquet(path)
    body = spark.read.parquet(path)
    kinds = dict(body.dtypes)
    out = None
    for section in body.columns:
        inner = body.schema[section].dataType
        nested = kinds[section].startswith("array")
        names = [(f.name, f.dataType.typeName()) for f in (inner.elementType if nested else inner)]
        rows = body.select(F.posexplode(section).alias("pos", "x")) if nested else body.select(F.lit(0).alias("pos"), F.col(section).alias("x"))
        number = lambda n, t: (F.col(f"x.{n}").cast("double") if t not in ("string", "timestamp_ntz") else F.lit(None).cast("double")).alias("number")
        text = lambda n, t: (F.col(f"x.{n}").cast("string") if t in ("string", "timestamp_ntz") else F.lit(None).cast("string")).alias("text")
        cells = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), number(n, t), text(n, t)) for n, t in names])).alias("c")
        part = rows.select(F.lit(section).alias("section"), F.col("pos").cast("long").alias("pos"), cells).select("section", "pos", "c.*")
        out = part if out is None else out.union(part)
    return out


def table_counts(spark, d):
    a, s = ads(spark, d, "id_ad", "make_name", "model_name"), stream(spark, d)
    return A.table_counts({"auto_ad": ads(spark, d, "id_ad"), "auto_ad_history": S.price_history(s), "car_make": S.dim_make(a, "id_ad"), "car_model": S.dim_model(a, "id_ad")})


def crawl_totals(spark, d) -> DataFrame:
    return ads(spark, d, "make_name").where("make_name IS NOT NULL").groupBy(F.lower("make_name").alias("make")).agg(F.count("*").alias("total"))


def crawl_page_plan(spark, d):
    return I.page_plan(crawl_totals(spark, d))


def crawl_urls(spark, d):
    return I.request_urls(I.page_plan(crawl_totals(spark, d)), filters=[{"name": "category", "value": "29"}])


def digit_guard(spark, d):
    x = F.get_json_object("props", "$.k")
    return T.messages(spark, d).select(F.col("offset").alias("event_id"), guarded_int(x).alias("plain"), guarded_int(F.concat(x, F.lit("\n"))).alias("with_newline"), guarded_int(F.concat(F.lit("1 "), x)).alias("with_space"))


def raw_messages(spark, d) -> DataFrame:
    return jobs.raw_messages(T.read(spark, d, "events"))


def message_validation(spark, d):
    done = I.validate(I.coerce(raw_messages(spark, d)), I.REQUIRED_AD)
    return done.select("offset", "valid", "reason", "price")


def message_project(spark, d):
    done = I.validate(I.coerce(raw_messages(spark, d)), I.REQUIRED_AD).where("valid").drop("valid", "reason")
    return I.project(done)


def message_route(spark, d):
    kind = F.when(F.col("make_str") == "error", "unknown").when(F.col("make_str") == "signup", "active_ids").otherwise("ad")
    return I.route(T.messages(spark, d).select("offset", kind.alias("kind"))).groupBy("topic").agg(F.count("*").alias("n"))


def kafka_envelope(spark, d):
    return I.envelope(T.messages(spark, d), "source_ad_id", "url")


def active_ids_snapshot(spark, d):
    return I.snapshot_rows(T.messages(spark, d))


def price_history(spark, d):
    return S.price_history(stream(spark, d)).select("id_ad", "offset", "price", "status")


def upsert_state(spark, d):
    return state(spark, d).select("id_ad", "source_name", "make_name", "price", "currency_code", "created_at")


def sold_ids(spark, d):
    return closing(spark, d)[2].select("source_name", "id_ad")


def sold_state(spark, d):
    now, _, gone = closing(spark, d)
    return S.mark_sold(now, gone, at()).select("id_ad", "source_name", "price", "sold_at")


def sold_history(spark, d):
    now, _, gone = closing(spark, d)
    return S.sold_history(now, gone, at())


def sold_probe(spark, d):
    now, _, gone = closing(spark, d)
    few = gone.select("id_ad").orderBy("id_ad").limit(10)
    return S.mark_sold(now, gone, at()).join(few, "id_ad", "left_semi").select("id_ad", "sold_at", "source_name", "make_name")


def sold_reconcile(spark, d):
    return S.reconciliation(*closing(spark, d)).select("source_name", "active", "in_db", "deactivated", "new")


def responses(spark, d) -> DataFrame:
    """Response bodies of the source's shape, one for every 50 listings, written by Spark from the listing table."""
    a = ads(spark, d)
    par = lambda k, c: F.struct(F.lit(k).alias("key"), c.cast("string").alias("value"))
    node = F.struct(
        F.col("id_ad").alias("id"), F.concat(F.lit("https://ad.invalid/"), "id_ad").alias("url"), "title", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss").alias("createdAt"),
        F.struct(F.struct(F.col("price").cast("string").alias("units"), F.lit("PLN").alias("currencyCode")).alias("amount")).alias("price"),
        F.array(par("make", F.col("make_name")), par("model", F.col("model_name")), par("version", F.col("version")), par("year", F.col("year")), par("mileage", F.col("mileage")), par("fuel_type", F.col("fuel_type")), par("gearbox", F.col("gearbox"))).alias("parameters"),
        F.struct(F.struct(F.col("city").alias("name")).alias("city"), F.struct(F.col("region").alias("name")).alias("region")).alias("location"),
        F.when(F.col("id_ad").cast("long") % 4 == 1, F.struct(F.concat(F.lit("https://photo.invalid/"), "id_ad").alias("url"))).alias("mainPhoto"),
    )
    edges = a.groupBy(F.floor(F.col("id_ad").cast("long") / I.PAGE).alias("page")).agg(F.collect_list(F.struct(node.alias("node"))).alias("edges"))
    body = F.to_json(F.struct(F.struct(F.struct(F.size("edges").alias("totalCount"), "edges").alias("advertSearch")).alias("data")))
    good = edges.select("page", body.alias("body"))
    # beside every tenth page a body that is no JSON, and beside every seventh one in which the source reports an error
    bad = edges.select("page", F.explode(F.array(F.when(F.col("page") % 10 == 9, "not json"), F.when(F.col("page") % 7 == 3, '{"errors":[{"message":"Internal Error"}]}'))).alias("body"))
    return good.union(bad.where("body IS NOT NULL"))


def graphql_flatten(spark, d):
    flat = I.flatten(I.parse(responses(spark, d))).drop("scraped_at")
    return flat.withColumn("image_urls", F.to_json("image_urls"))


def ingest_by_make(spark, d):
    return I.by_make(I.flatten(I.parse(responses(spark, d))))


def result_counts(spark, d):
    a = ads(spark, d, "id_ad", "title", "make_name", "model_name", "created_at")
    return L.counted({("search", "ring"): L.search(a, "ring"), ("makes", ""): L.makes_list(a), ("models", "Brand#1"): L.models_of(a, "Brand#1")})


def trends_iso(spark, d):
    """Daily trends as the response writes them: dates as ISO text."""
    t = A.trends(ads(spark, d, "created_at", "price"), AS_OF, "daily", 30)
    return t.select(F.date_format("period", "yyyy-MM-dd'T'HH:mm:ss").alias("date"), "count", "avg_price")


def ingest_metrics(spark, d):
    return I.run_metrics(I.parse(responses(spark, d)))


def params_map(spark, d):
    m = T.messages(spark, d)
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in (("make", F.col("make_str")), ("price", F.col("price")), ("", F.col("offset")), ("make", F.upper("make_str")))])
    return m.select("offset", I.params_map(pairs).alias("params")).select("offset", F.to_json("params").alias("params"))


def make_catalogue(spark, d):
    """A catalogue text of the listings' makes and cities, planned against the makes known already. Both are bounded name lists, and one text is what the source gives."""
    a = ads(spark, d, "id_ad", "make_name", "city")
    names = a.select(F.explode(F.array(F.lower("make_name"), F.lower("city"))).alias("value")).where("value IS NOT NULL").distinct()
    entry = F.struct(F.lit("filter_enum_make").alias("name"), "value", F.lit(None).cast("string").alias("canonical"))
    text = names.agg(F.concat(F.lit("// makes\n"), F.to_json(F.sort_array(F.collect_list(entry)))).alias("value"))
    known = S.dim_make(a, "id_ad").select(F.regexp_replace("slug", "[^\\w-]", "").alias("slug"))
    return I.plan_catalogue(I.catalogue(text), known)


QUERIES = {
    "active_ids_snapshot": active_ids_snapshot, "ad_clustered": ad_clustered, "ads_search_indexed": ads_search_indexed, "flt_range_clustered": flt_range_clustered, "ad_detail": ad_detail, "ad_history": ad_history, "ads_list_filtered": ads_list_filtered, "ads_page_2": ads_page_2, "ads_page_deep": ads_page_deep,
    "ads_page_meta": ads_page_meta, "ads_search": ads_search, "ads_with_dims": ads_with_dims, "crawl_page_plan": crawl_page_plan, "crawl_urls": crawl_urls,
    "dashboard_body": dashboard_body, "dashboard_summary": stat(A.dashboard, "id_ad make_name price mileage sold_at"), "digit_guard": digit_guard,
    "dim_make": stat(S.dim_make, "id_ad make_name", "id_ad"), "dim_model": stat(S.dim_model, "id_ad make_name model_name", "id_ad"),
    "filter_options": stat(L.options, "fuel_type gearbox city region source_name"), "filter_ranges": stat(L.ranges, "price year"), "flt_ilike": flt("city", make="brand#1", city="nation_1"),
    "flt_range": flt(year_from=1995, year_to=2010, price_from=0, mileage_to=100000), "flt_sold": flt("sold_at", sold=True), "flt_source": flt(source_name="src1"),
    "graphql_flatten": graphql_flatten, "ingest_by_make": ingest_by_make, "ingest_metrics": ingest_metrics, "kafka_envelope": kafka_envelope, "make_catalogue": make_catalogue,
    "make_loader": stat(L.make_loader, "make_name"), "make_stats": stat(A.makes, "make_name price"), "makes_list": makes_list, "message_project": message_project,
    "message_route": message_route, "message_validation": message_validation, "model_stats": stat(A.models, "make_name model_name price"), "models_by_make": models_by_make, "params_map": params_map,
    "popular_make": stat(A.popular_make, "make_name"), "popular_model": stat(A.popular_model, "make_name model_name"), "price_distribution": stat(A.price_distribution, "price"),
    "price_history": price_history, "result_counts": result_counts, "trends_iso": trends_iso, "region_stats": stat(A.regions, "region price"), "sold_history": sold_history, "sold_ids": sold_ids, "sold_probe": sold_probe,
    "sold_reconcile": sold_reconcile, "sold_state": sold_state, "stats_general": stat(A.general, "id_ad sold_at price mileage"), "stream_completion": jobs.stream_completion, "stream_history": jobs.stream_history, "stream_make_stats": jobs.stream_make_stats, "stream_price_distribution": jobs.stream_price_distribution,
    "stream_rejects": jobs.stream_rejects, "stream_sold": jobs.stream_sold, "stream_upsert": jobs.stream_upsert, "table_counts": table_counts, "trends_daily": stat(A.trends, "created_at price", AS_OF, "daily", 30),
    "trends_monthly": stat(A.trends, "created_at price", AS_OF, "monthly", 365), "trends_weekly": stat(A.trends, "created_at price", AS_OF, "weekly", 180),
    "upsert_state": upsert_state, "year_distribution": stat(A.year_distribution, "year"),
}
