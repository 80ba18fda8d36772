"""A table's layout in place of indexes: rows clustered along a space-filling curve over several columns, and Bloom filters for keys.

Parquet keeps the least and greatest value of each column for every row group; along the curve rows of near values in *any* of the columns lie together, so a range of one
of them, or of several, rules most row groups out. A key that has no order worth keeping gets a Bloom filter instead, which rules out all but the group that holds it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _number(df: DataFrame, c: str) -> Column:
    """A column as a number that rises with it: text by its first six bytes."""
    kind = dict(df.dtypes)[c]
    if kind == "string":
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return F.unix_micros(F.col(c).cast("timestamp")).cast("double") if kind.startswith("timestamp") else F.col(c).cast("double")


def _at_most(edges: Column, v: Column) -> Column:
    return F.when(v.isNotNull(), F.size(F.filter(edges, lambda x: x <= v)))


def curve(df: DataFrame, by: list[str], bits: int = 6, error: float = 0.002) -> Column:
    """The place of a row on the Z-order curve: the interleaved bits of its columns' ranks among 2^bits quantiles (NULL counts as the least)."""
    numbers = df.select(*[_number(df, c).alias(f"c{k}") for k, c in enumerate(by)])
    cuts = numbers.approxQuantile([f"c{k}" for k in range(len(by))], [q / (1 << bits) for q in range(1, 1 << bits)], error)
    out = []
    for k, (c, own) in enumerate(zip(by, cuts, strict=True)):
        v = _number(df, c)
        edges = F.array(*[F.lit(x) for x in sorted(set(own))]) if own else F.array().cast("array<double>")
        rank = F.coalesce(_at_most(edges, v), F.lit(0))
        out += [F.shiftleft(F.shiftright(rank, i).bitwiseAND(1).cast("long"), i * len(by) + k) for i in range(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), out)


def write(df: DataFrame, path: str, by: list[str], keys: tuple[str, ...] = (), files: int = 32, distinct: int = 100_000) -> None:
    """df in about `files` files (one at least for each some 100 MB is right), clustered by the columns, with Bloom filters for up to `distinct` values of each key in a row group."""
    z = "z__"
    while z in df.columns:
        z += "_"
    placed = df.withColumn(z, curve(df, by)).repartitionByRange(files, z).sortWithinPartitions(z).drop(z)
    writer = placed.write.mode("overwrite")
    for k in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true").option(f"parquet.bloom.filter.expected.ndv#{k}", str(distinct))
    writer.parquet(path)


def rows_read(df: DataFrame) -> int:
    """Rows that the scans of a query gave out when it ran: those of the row groups that were not ruled out. Call after an action on df."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaves, total = plan.collectLeaves(), 0
    for k in range(leaves.size()):
        found = leaves.apply(k).metrics().get("numOutputRows")
        total += found.get().value() if found.isDefined() else 0
    return total


def table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
