"""Filters, sorting and pages over listings. Parameters are checked where a request enters; predicates fold into one conjunction."""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.columns import contains

#: Limits of the request parameters.
PAGE_SIZE, MAX_PAGE_SIZE, YEARS, MIN_QUERY = 20, 100, (1900, 2030), 2
SORTABLE = {"created_at", "price", "year", "mileage", "make_name", "model_name", "city", "id_ad", "title", "sold_at"}


def _check(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


@dataclass(frozen=True)
class AdFilters:
    make: str | None = None
    model: str | None = None
    fuel_type: str | None = None
    gearbox: str | None = None
    city: str | None = None
    region: str | None = None
    source_name: str | None = None
    year_from: int | None = None
    year_to: int | None = None
    price_from: int | None = None
    price_to: int | None = None
    mileage_from: int | None = None
    mileage_to: int | None = None
    sold: bool | None = None

    def __post_init__(self) -> None:
        for f in fields(self):
            v = getattr(self, f.name)
            if v is None or not f.name.endswith(("_from", "_to")):
                continue
            low, high = YEARS if f.name.startswith("year") else (0, None)
            _check(v >= low and (high is None or v <= high), f"{f.name} out of range")

    def condition(self) -> Column:
        """All that is set, joined by AND. A bound of 0 or an empty text is not set; sold=None keeps both kinds."""
        parts = []
        for name, column in {"make": "make_name", "model": "model_name", "fuel_type": "fuel_type", "gearbox": "gearbox", "city": "city", "region": "region"}.items():
            if term := getattr(self, name):
                parts.append(contains(F.col(column), term))
        if self.source_name:
            parts.append(F.col("source_name") == F.lit(self.source_name))
        for name in ("year", "price", "mileage"):
            if low := getattr(self, f"{name}_from"):
                parts.append(F.col(name) >= low)
            if high := getattr(self, f"{name}_to"):
                parts.append(F.col(name) <= high)
        if self.sold is not None:
            parts.append(F.col("sold_at").isNotNull() if self.sold else F.col("sold_at").isNull())
        return functools.reduce(operator.and_, parts, F.lit(True))


def filtered(ads: DataFrame, filters: AdFilters) -> DataFrame:
    return ads.where(filters.condition())


def order_by(sort_by: str = "created_at", sort_order: str = "desc") -> list[Column]:
    """Rising order puts NULLs last, falling order first; an unknown column means created_at, and id_ad settles ties."""
    _check(sort_order in ("asc", "desc"), "sort_order")
    c = F.col(sort_by if sort_by in SORTABLE else "created_at")
    return [c.asc_nulls_last() if sort_order == "asc" else c.desc_nulls_first(), F.col("id_ad").asc()]


def page(ads: DataFrame, filters: AdFilters = AdFilters(), number: int = 1, size: int = PAGE_SIZE, sort_by: str = "created_at", sort_order: str = "desc") -> DataFrame:
    """A page of listings: top-k with an offset, never a full sort."""
    _check(number >= 1 and size >= 1, "page and page_size start at 1")
    size = min(size, MAX_PAGE_SIZE)
    return filtered(ads, filters).orderBy(*order_by(sort_by, sort_order)).offset((number - 1) * size).limit(size)


def _bucket(ads: DataFrame, c: str) -> Column:
    """A coarse step of a sortable column, which rises with it and has a bounded number of values: months, 2^11 numbers, or two letters."""
    kind = dict(ads.dtypes)[c]
    if kind.startswith("timestamp"):
        return F.date_trunc("month", c).cast("timestamp_ntz")
    return F.substring(c, 1, 2) if kind == "string" else F.floor(F.col(c) / 2048)


def deep_page(ads: DataFrame, filters: AdFilters = AdFilters(), number: int = 1, size: int = PAGE_SIZE, sort_by: str = "created_at", sort_order: str = "desc") -> DataFrame:
    """page() for pages far back: counts by steps of the sorted column tell which steps the page lies in, and only their rows are read and sorted.

    The driver gets one count a step, so the bounds reach the scan as plain filters. A step that holds very many rows is still a top-k of its own, never more."""
    _check(number >= 1 and size >= 1, "page and page_size start at 1")
    size, column = min(size, MAX_PAGE_SIZE), sort_by if sort_by in SORTABLE else "created_at"
    first, last = (number - 1) * size, number * size
    step, rows = _bucket(ads, column), filtered(ads, filters)
    order = F.col("step").asc_nulls_last() if sort_order == "asc" else F.col("step").desc_nulls_first()
    begin, before, steps = 0, 0, []
    for value, n in rows.groupBy(step.alias("step")).agg(F.count("*").alias("n")).orderBy(order).collect():
        if begin < last and begin + n > first:
            before = begin if not steps else before
            steps.append(value)
        begin += n
    if not steps:
        return rows.limit(0)
    held, c = [v for v in steps if v is not None], F.col(column)
    # a range of the column itself, as wide as its steps, for the scan; the steps, for what lies exactly in them
    if held and dict(ads.dtypes)[column].startswith("timestamp"):
        wide = (c >= F.lit(min(held))) & (c < F.lit(max(held)) + F.expr("INTERVAL 1 MONTH"))
    elif held and dict(ads.dtypes)[column] == "string":
        wide = c >= F.lit(min(held))
    elif held:
        wide = (c >= min(held) * 2048) & (c < (max(held) + 1) * 2048)
    inside = (wide & step.isin(held)) if held else F.lit(False)
    inside = inside | c.isNull() if None in steps else inside
    return rows.where(inside).orderBy(*order_by(column, sort_order)).offset(first - before).limit(size)


def page_meta(ads: DataFrame, filters: AdFilters = AdFilters(), number: int = 1, size: int = PAGE_SIZE) -> DataFrame:
    size = min(size, MAX_PAGE_SIZE)
    total = filtered(ads, filters).agg(F.count("*").alias("total"))
    return total.select("total", F.lit(number).cast("long").alias("page"), F.lit(size).cast("long").alias("page_size"), F.ceil(F.col("total") / size).cast("long").alias("total_pages"))


def search(ads: DataFrame, query: str, limit: int = PAGE_SIZE) -> DataFrame:
    _check(len(query) >= MIN_QUERY and 1 <= limit <= MAX_PAGE_SIZE, "q has at least two characters, limit is 1 to 100")
    return ads.where(contains(F.col("title"), query)).orderBy(*order_by()).limit(limit)


def history_of(history: DataFrame, ad_id: str) -> DataFrame:
    return history.where(F.col("auto_ad_id") == ad_id).orderBy(F.desc("timestamp"), "status").select("auto_ad_id", "timestamp", "price", "currency_code", "status")


def detail(ads: DataFrame, history: DataFrame, ad_id: str) -> DataFrame:
    """The listing with its history nested, newest first; no row if there is none."""
    one = ads.where(F.col("id_ad") == ad_id)
    events = history.where(F.col("auto_ad_id") == ad_id).groupBy("auto_ad_id").agg(F.sort_array(F.collect_list(F.struct("timestamp", "price", "currency_code", "status")), asc=False).alias("history"))
    return one.join(events, one.id_ad == events.auto_ad_id, "left").drop("auto_ad_id")


def makes_list(ads: DataFrame) -> DataFrame:
    return ads.where("make_name IS NOT NULL AND make_name <> ''").select("make_name").distinct()


def models_of(ads: DataFrame, make: str) -> DataFrame:
    return ads.where(contains(F.col("make_name"), make) & F.col("model_name").isNotNull() & (F.col("model_name") != "")).select("model_name").distinct()


def counted(results: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(endpoint, argument, count): how many results each named query gives, as their answers carry it."""
    out = None
    for (endpoint, argument), rows in results.items():
        one = rows.agg(F.count("*").alias("count")).select(F.lit(endpoint).alias("endpoint"), F.lit(argument).alias("argument"), "count")
        out = one if out is None else out.union(one)
    return out


def options(ads: DataFrame, cities: int = 50) -> DataFrame:
    """(facet, value): the distinct values of each facet in one pass; cities are the first 50 in order."""
    facets = {"fuel_types": "fuel_type", "gearboxes": "gearbox", "cities": "city", "regions": "region", "sources": "source_name"}
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("facet"), F.col(c).alias("value")) for k, c in facets.items()])).alias("x")
    found = ads.select(pairs).select("x.*").where("value IS NOT NULL AND value <> ''").distinct()
    few = found.where("facet = 'cities'").orderBy("value").limit(cities)
    return found.where("facet <> 'cities'").union(few)


def ranges(ads: DataFrame) -> DataFrame:
    price = F.when(F.col("price") > 0, F.col("price"))
    zero = lambda x, d: F.coalesce(x, F.lit(d))
    return ads.agg(zero(F.min(price), 0).alias("min_price"), zero(F.max(price), 0).alias("max_price"), zero(F.min("year"), 1990).alias("min_year"), zero(F.max("year"), 2024).alias("max_year"))


def make_loader(ads: DataFrame, limit: int = 1000) -> DataFrame:
    """Makes to crawl: non-blank names in order, at most `limit`, then lower-cased and trimmed, each once."""
    names = ads.where(F.length(F.trim("make_name")) > 0).select("make_name").distinct().orderBy("make_name").limit(limit)
    return names.select(F.lower(F.trim("make_name")).alias("make")).distinct()
