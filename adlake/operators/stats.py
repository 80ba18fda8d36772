"""Market statistics. Each is one aggregation with map-side partial sums. The exact median is selected in two steps: a histogram of fixed size tells the one range
that holds the middle ranks, and only its values are counted, so no task sees more than a range's different values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adlake.functions.columns import contains, price_bucket, rounded

PERIODS = {"daily": "day", "weekly": "week", "monthly": "month"}


def _positive(c: str) -> Column:
    return F.when(F.col(c) > 0, F.col(c))


#: Values in a range of the median's histogram; 2^31 of them make 2^15 ranges.
RANGE = 1 << 16


def median(rows: DataFrame, c: str, width: int = RANGE) -> DataFrame:
    """One row, `median`: the exact median of a column of positive whole numbers (others are left out), the mean of both middle ones of an even count; NULL of none."""
    values = rows.where(F.col(c) > 0).select(F.col(c).cast("long").alias("v"))
    ranges = values.groupBy(F.floor(F.col("v") / width).alias("r")).agg(F.count("*").alias("n"))
    # at most 2^31 / width rows meet in one task
    below = F.coalesce(F.sum("n").over(Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(Window.partitionBy())
    ranked = ranges.select("r", "n", below.alias("below"), total.alias("total"))
    low, high = F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1
    middle = ranked.where(((F.col("below") < low) & (low <= F.col("below") + F.col("n"))) | ((F.col("below") < high) & (high <= F.col("below") + F.col("n")))).drop("n")
    # one range, or two where the middle ranks lie in different ones
    counts = values.withColumn("r", F.floor(F.col("v") / width)).join(F.broadcast(middle), "r").groupBy("r", "v", "below", "total").agg(F.count("*").alias("n"))
    upto = F.col("below") + F.sum("n").over(Window.partitionBy("r").orderBy("v"))
    at = counts.withColumn("upto", upto).where(((F.col("upto") - F.col("n") < low) & (low <= F.col("upto"))) | ((F.col("upto") - F.col("n") < high) & (high <= F.col("upto"))))
    return at.agg(((F.min("v") + F.max("v")) / 2).alias("median"))


def general(ads: DataFrame) -> DataFrame:
    active, on = F.count_if(F.col("sold_at").isNull()), F.lit(1).alias("one")
    numbers = ads.agg(
        F.count("id_ad").alias("total_ads"),
        active.alias("active_ads"),
        (F.count("id_ad") - active).alias("sold_ads"),
        rounded(F.avg(_positive("price"))).alias("avg_price"),
        rounded(F.avg(_positive("mileage"))).alias("avg_mileage"),
    )
    both = numbers.select("*", on).join(median(ads, "price").select("median", on), "one")
    return both.select("total_ads", "active_ads", "sold_ads", "avg_price", F.coalesce("median", F.lit(0.0)).alias("median_price"), "avg_mileage")


def popular_make(ads: DataFrame) -> DataFrame:
    return ads.where("make_name IS NOT NULL").groupBy("make_name").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "make_name").limit(1)


def popular_model(ads: DataFrame) -> DataFrame:
    both = ads.where("make_name IS NOT NULL AND model_name IS NOT NULL").groupBy("make_name", "model_name").agg(F.count("*").alias("count"))
    top = both.orderBy(F.desc("count"), "make_name", "model_name").limit(1)
    return top.select(F.coalesce(F.concat_ws(" ", "make_name", "model_name"), F.lit("N/A")).alias("model"), "count")


def price_distribution(ads: DataFrame) -> DataFrame:
    return ads.where("price > 0").groupBy(price_bucket(F.col("price")).alias("price_range")).agg(F.count("*").alias("count"))


def year_distribution(ads: DataFrame, newest: int = 20) -> DataFrame:
    return ads.where("year > 1990").groupBy("year").agg(F.count("*").alias("count")).orderBy(F.desc("year")).limit(newest)


def regions(ads: DataFrame, limit: int = 10) -> DataFrame:
    by = ads.where("region IS NOT NULL AND price > 0").groupBy("region").agg(F.count("*").alias("count"), rounded(F.avg("price")).alias("avg_price"))
    return by.orderBy(F.desc("count"), "region").limit(limit)


def _priced(ads: DataFrame, *keys: str) -> DataFrame:
    return ads.groupBy(*keys).agg(F.count("*").alias("count"), rounded(F.avg("price")).alias("avg_price"), F.min("price").alias("min_price"), F.max("price").alias("max_price"))


def makes(ads: DataFrame, limit: int = 10) -> DataFrame:
    return _priced(ads.where("make_name IS NOT NULL AND price > 0"), "make_name").orderBy(F.desc("count"), "make_name").limit(limit)


def models(ads: DataFrame, make: str | None = None, limit: int = 10) -> DataFrame:
    rows = ads.where("make_name IS NOT NULL AND model_name IS NOT NULL AND price > 0")
    if make:
        rows = rows.where(contains(F.col("make_name"), make))
    return _priced(rows, "make_name", "model_name").orderBy(F.desc("count"), "make_name", "model_name").limit(limit)


def trends(ads: DataFrame, as_of: str, period: str = "daily", days: int = 30) -> DataFrame:
    """Count and average price by time bucket over the last days before as_of; an unknown period is a day, weeks begin on Monday."""
    if not 7 <= days <= 365:
        raise ValueError("days is 7 to 365")
    at = F.date_trunc(PERIODS.get(period, "day"), "created_at").cast("timestamp_ntz")
    since = F.lit(as_of).cast("timestamp_ntz") - F.make_interval(days=F.lit(days))
    rows = ads.where((F.col("created_at") >= since) & (F.col("price") > 0))
    return rows.groupBy(at.alias("period")).agg(F.count("*").alias("count"), rounded(F.avg("price")).alias("avg_price")).orderBy("period")


def dashboard(ads: DataFrame) -> DataFrame:
    """The five summary fields; data_sources counts the makes of the top five, as the label has always meant."""
    numbers = ads.agg(F.count("id_ad").alias("total_ads"), F.count_if(F.col("sold_at").isNull()).alias("active_ads"), rounded(F.avg(_positive("price"))).alias("avg_price"))
    top = popular_make(ads).select(F.col("make_name").alias("most_popular_make"))
    sources = makes(ads, 5).agg(F.count_distinct("make_name").alias("data_sources"))
    on = F.lit(1).alias("one")
    return numbers.select("*", on).join(top.select("*", on), "one", "left").join(sources.select("*", on), "one").drop("one")


def dashboard_body(ads: DataFrame, as_of: str) -> DataFrame:
    """The whole dashboard as one row of nested values: general, top_makes, top_regions, recent_trends (seven days), summary."""
    on = F.lit(1).alias("one")
    model = popular_model(ads).select("model", on)
    make = popular_make(ads).select("make_name", on)
    numbers = general(ads).select("*", on).join(make, "one", "left").join(model, "one", "left")
    named = numbers.select("one", "total_ads", "active_ads", "sold_ads", "avg_price", "median_price", "avg_mileage", F.coalesce("make_name", F.lit("N/A")).alias("most_popular_make"), F.coalesce("model", F.lit("N/A")).alias("most_popular_model"))
    whole = named.select("one", F.struct(*[c for c in named.columns if c != "one"]).alias("general"))

    def listed(df: DataFrame, name: str, *order: Column) -> DataFrame:
        """Up to a few rows as one array, in their order."""
        keyed = df.select(F.struct(*order, F.struct(*df.columns).alias("row")).alias("r"))
        return keyed.agg(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["row"]).alias(name)).select("*", on)

    most = (-F.col("count")).alias("o")
    for df in (listed(makes(ads, 5), "top_makes", most, F.col("make_name")), listed(regions(ads, 5), "top_regions", most, F.col("region")), listed(trends(ads, as_of, "daily", 7), "recent_trends", F.col("period"))):
        whole = whole.join(df, "one")
    g = lambda c: F.col(f"general.{c}").alias(c)
    sources = F.size(F.array_distinct("top_makes.make_name")).cast("long").alias("data_sources")
    return whole.withColumn("summary", F.struct(g("total_ads"), g("active_ads"), g("avg_price"), g("most_popular_make"), sources)).drop("one")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = one if out is None else out.union(one)
    return out
