"""An index for `%term%`: which letters in threes a text holds.

The index is a table of postings (gram, key), written in the order of grams, so that the row groups of other grams are ruled out by Parquet's own statistics. A term is
looked up by its rarest grams (their counts are a small table of their own): keys under all of these are candidates, and ILIKE on the candidates' texts decides. Terms
of fewer than three letters, and those with a wildcard of LIKE in them, are looked for by the scan they would be without an index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.functions.columns import contains

#: Grams of a term that are looked up, at most: the rarest say nearly all.
GRAMS = 4


def grams_of(text: Column) -> Column:
    """A text's different letters in threes, lower-cased."""
    low = F.lower(text)
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(low) - 2), lambda i: F.substring(low, i, 3)))


def build(rows: DataFrame, key: str, column: str, path: str, files: int = 16) -> None:
    """Writes the postings of a text column and the counts of its grams under `path`. Shorter texts than three letters have none."""
    long = rows.where(F.length(F.lower(column)) >= 3)
    postings = long.select(F.explode(grams_of(F.col(column))).alias("gram"), F.col(key).alias("key"))
    postings.repartitionByRange(files, "gram", "key").sortWithinPartitions("gram", "key").write.mode("overwrite").parquet(f"{path}/postings")
    spark = rows.sparkSession
    spark.read.parquet(f"{path}/postings").groupBy("gram").agg(F.count("*").alias("n")).repartitionByRange(1, "gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}/counts")


def indexable(term: str) -> bool:
    return len(term) >= 3 and not set(term) & set("%_\\") and len(term.lower()) == len(term)


def rarest(spark: SparkSession, path: str, term: str, most: int = GRAMS) -> list[str] | None:
    """The term's rarest grams; None if one of them is in no text at all."""
    low = term.lower()
    own = sorted({low[i : i + 3] for i in range(len(low) - 2)})
    counts = {r.gram: r.n for r in spark.read.parquet(f"{path}/counts").where(F.col("gram").isin(own)).collect()}  # as many as the term has
    return None if len(counts) < len(own) else sorted(own, key=lambda g: (counts[g], g))[:most]


def candidates(spark: SparkSession, path: str, term: str, most: int = GRAMS) -> DataFrame:
    """(key): texts that hold the term's rarest grams."""
    postings = spark.read.parquet(f"{path}/postings")
    grams = rarest(spark, path, term, most)
    if grams is None:
        return postings.select("key").limit(0)
    return postings.where(F.col("gram").isin(grams)).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") == len(grams)).select("key")


def matching(rows: DataFrame, key: str, column: str, path: str, term: str, most: int = GRAMS) -> DataFrame:
    """The rows whose column contains the term, by the index where it can tell, else by the scan."""
    hit = contains(F.col(column), term)
    if not indexable(term):
        return rows.where(hit)
    found = candidates(rows.sparkSession, path, term, most).withColumnRenamed("key", "key__")
    return rows.join(found, F.col(key) == F.col("key__"), "left_semi").where(hit)
