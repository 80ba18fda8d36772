"""Listing state: upserts with a change log, dimensions, and closing what a snapshot no longer shows.

One set of functions serves batches and the streams' foreachBatch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adlake.functions.columns import model_slug, slug

#: Columns a later message may overwrite; the others keep what the first one said.
UPDATED = ["title", "url_ad", "created_at", "price", "currency_code", "make_name", "model_name", "version", "generation", "year", "mileage", "fuel_type", "engine_capacity", "engine_power", "gearbox", "transmission", "color", "city", "region", "sellerLink"]


def price_history(messages: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The change log, message by message in arrival order: `active` at first sight, `price_changed` where the price differs.

    messages: id_ad, offset, price, price_set (the key is there, even with a null), and what else the log should carry. stored: the
    prices before, by id_ad. A change between NULL and a number counts, as does every step within a batch.
    """
    order = Window.partitionBy("id_ad").orderBy("offset")
    told = messages.withColumn("n", F.row_number().over(order))
    if stored is not None:
        told = told.join(stored.select("id_ad", F.col("price").alias("stored_price"), F.lit(True).alias("known")), "id_ad", "left")
    else:
        told = told.withColumn("stored_price", F.lit(None).cast("int")).withColumn("known", F.lit(None).cast("boolean"))
    first_unknown = F.col("known").isNull() & (F.col("n") == 1)
    # the price in force before a message: that of the last message that had the key, else the stored one
    said = F.when(F.col("price_set"), F.struct(F.col("price").alias("v")))
    before = F.last(said, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    chained = told.withColumn("before", F.when(before.isNotNull(), before["v"]).otherwise(F.col("stored_price")))
    changed = F.col("price_set") & ~F.col("price").eqNullSafe(F.col("before"))
    status = F.when(first_unknown, "active").when(changed, "price_changed")
    return chained.withColumn("status", status).where("status IS NOT NULL").drop("n", "before", "stored_price", "known")


def _newest(c: str, present: Column) -> Column:
    """The last value among messages that hold the key, wrapped so that a held null counts."""
    return F.max_by(F.struct(F.col(c).alias("v")), F.when(present, F.col("offset")))


def upsert(messages: DataFrame, stored: DataFrame | None = None, presence: dict[str, Column] | None = None, insert_only: tuple[str, ...] = ("source_name",), as_of: str | None = None) -> DataFrame:
    """State after a batch of messages (id_ad, offset, columns): the last held value of each updatable column wins.

    presence: how to tell that a message holds a column's key (default: always). One aggregation by id and one full-outer join with the
    stored state. created_at falls back to as_of on insert, and keeps the old value on a null update.
    """
    columns = [c for c in messages.columns if c in UPDATED]
    held = presence or {}
    yes = F.lit(True)
    batch = messages.groupBy("id_ad").agg(
        *[_newest(c, held.get(c, yes)).alias(c) for c in columns],
        *[F.max(held.get(c, yes)).alias(f"has_{c}") for c in columns],
        *[F.min_by(c, "offset").alias(c) for c in insert_only if c in messages.columns],
    )
    now = F.lit(as_of).cast("timestamp_ntz") if as_of else F.current_timestamp().cast("timestamp_ntz")
    value = lambda c: F.col(f"{c}.v")
    if stored is None:
        new = [F.coalesce(value(c), now).alias(c) if c == "created_at" else value(c).alias(c) for c in columns]
        return batch.select("id_ad", *new, *[c for c in insert_only if c in messages.columns])
    s, b = stored.alias("s"), batch.alias("b")
    both = s.join(b, F.col("s.id_ad") == F.col("b.id_ad"), "full")
    known, touched = F.col("s.id_ad").isNotNull(), F.col("b.id_ad").isNotNull()
    out = []
    for c in stored.columns:
        old = F.col(f"s.{c}")
        if c == "id_ad":
            out.append(F.coalesce("s.id_ad", "b.id_ad").alias(c))
        elif c == "created_at" and c in columns:
            out.append(F.when(known, F.coalesce(F.col(f"b.{c}.v"), old)).otherwise(F.coalesce(F.col(f"b.{c}.v"), now)).alias(c))
        elif c in columns:
            out.append(F.when(touched & F.col(f"b.has_{c}"), F.col(f"b.{c}.v")).otherwise(old).alias(c))
        elif c in insert_only and c in messages.columns:
            out.append(F.when(known, old).otherwise(F.col(f"b.{c}")).alias(c))
        else:
            out.append(old.alias(c))
    return both.select(*out)


def dim_make(ads: DataFrame, order: str = "offset") -> DataFrame:
    """(slug, name): the first spelling of a slug wins."""
    return ads.where("make_name IS NOT NULL AND make_name <> ''").groupBy(slug(F.col("make_name")).alias("slug")).agg(F.min_by("make_name", order).alias("name"))


def dim_model(ads: DataFrame, order: str = "offset") -> DataFrame:
    """(slug, name, make_slug); skipped where make or model is empty."""
    rows = ads.where("make_name IS NOT NULL AND make_name <> '' AND model_name IS NOT NULL AND model_name <> ''")
    keyed = rows.groupBy(model_slug(F.col("make_name"), F.col("model_name")).alias("slug"))
    return keyed.agg(F.min_by("model_name", order).alias("name"), F.min_by(slug(F.col("make_name")), order).alias("make_slug"))


def grow_dimension(known: DataFrame, found: DataFrame) -> DataFrame:
    """known plus the slugs it lacks, numbered on from its largest id in the order of slugs. Slugs are numbered within their first two letters;
    only the counts of those beginnings meet in one task."""
    base = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("base"))
    fresh = found.join(known.select("slug"), "slug", "left_anti").withColumn("head__", F.substring("slug", 1, 2))
    before = Window.orderBy("head__").rowsBetween(Window.unboundedPreceding, -1)
    starts = fresh.groupBy("head__").agg(F.count("*").alias("n")).select("head__", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")).join(base)
    rank = F.row_number().over(Window.partitionBy("head__").orderBy("slug"))
    numbered = fresh.withColumn("rank", rank).join(F.broadcast(starts), "head__").withColumn("id", (F.col("rank") + F.col("start") + F.col("base")).cast("long"))
    return known.unionByName(numbered.select(*known.columns))


def with_dims(ads: DataFrame, makes: DataFrame, models: DataFrame) -> DataFrame:
    """Each ad with the slugs of its make and model; Spark broadcasts the dimensions while they are small."""
    one = ads.withColumn("make_slug", slug(F.col("make_name"))).withColumn("model_slug", model_slug(F.col("make_name"), F.col("model_name")))
    makes = makes.select(F.col("slug").alias("make_slug"), F.col("name").alias("make_dim"))
    models = models.select(F.col("slug").alias("model_slug"), F.col("name").alias("model_dim"))
    return one.join(makes, "make_slug", "left").join(models, "model_slug", "left")


def gone(ads: DataFrame, snapshot: DataFrame, exact_make: bool = False, min_active: int = 0) -> DataFrame:
    """(source_name, make_str, id_ad[, seq]): open ads of a snapshot's source and make that it doesn't show.

    snapshot: one row for each id shown (source_name, make_str, id_ad), and a row with a null id for a snapshot without any. A snapshot
    covers every make that contains its make's name, unless exact_make; min_active spares makes whose snapshot holds fewer ids.
    With `seq`, rows of different seq are different snapshots, applied one after the other: an ad closes at the first that covers and doesn't show it.
    """
    own = ["source_name", "make_str", *(["seq"] if "seq" in snapshot.columns else [])]
    covered = snapshot.groupBy(*own).agg(F.count_distinct("id_ad").alias("n")).where(F.col("n") >= min_active).drop("n")
    makes = ads.where("sold_at IS NULL").select("source_name", "make_name").distinct()
    match = F.col("make_name") == F.col("make_str") if exact_make else F.ilike(F.col("make_name"), F.concat(F.lit("%"), F.col("make_str"), F.lit("%")))
    pairs = makes.join(covered, "source_name").where(match)
    open_ads = ads.where("sold_at IS NULL").join(pairs, ["source_name", "make_name"]).select(*own, "id_ad")
    shown = snapshot.where("id_ad IS NOT NULL").select(*own, "id_ad")
    missing = open_ads.join(shown, [*own, "id_ad"], "left_anti")
    return missing if "seq" not in own else missing.groupBy("source_name", "id_ad").agg(F.min_by("make_str", "seq").alias("make_str"), F.min("seq").alias("seq"))


def mark_sold(ads: DataFrame, sold: DataFrame, at: Column) -> DataFrame:
    """ads with sold_at set for those in `sold` (source_name, id_ad) that are still open."""
    flags = sold.select("source_name", "id_ad").distinct().withColumn("flag", F.lit(True))
    marked = ads.join(flags, ["source_name", "id_ad"], "left")
    return marked.withColumn("sold_at", F.when(F.col("flag") & F.col("sold_at").isNull(), at).otherwise(F.col("sold_at"))).select(*ads.columns)


def sold_history(ads: DataFrame, sold: DataFrame, at: Column) -> DataFrame:
    """One `sold` row for every id found gone, with the ad's price and currency (NULL if there is no such ad)."""
    prices = ads.select("id_ad", "price", "currency_code")
    return sold.select("id_ad").distinct().join(prices, "id_ad", "left").select(F.col("id_ad").alias("auto_ad_id"), at.alias("timestamp"), "price", "currency_code", F.lit("sold").alias("status"))


def reconciliation(ads: DataFrame, snapshot: DataFrame, sold: DataFrame) -> DataFrame:
    """By source and make of the snapshot: active ids, open ads before, ads closed, and the new ones: active - (open - closed)."""
    keys = ["source_name", "make_str"]
    makes = ads.where("sold_at IS NULL").groupBy("source_name", "make_name").agg(F.count("*").alias("n"))
    covered = snapshot.groupBy(*keys).agg(F.count_distinct("id_ad").alias("active"))
    before = makes.join(covered, "source_name").where(F.ilike(F.col("make_name"), F.concat(F.lit("%"), F.col("make_str"), F.lit("%")))).groupBy(*keys).agg(F.sum("n").alias("in_db"))
    closed = sold.groupBy(*keys).agg(F.count("*").alias("deactivated"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    out = covered.join(before, keys, "left").join(closed, keys, "left").select(*keys, "active", zero("in_db"), zero("deactivated"))
    return out.withColumn("new", F.col("active") - (F.col("in_db") - F.col("deactivated")))
