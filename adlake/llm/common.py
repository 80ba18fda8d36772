"""What the text operators share: reading tables, the shared folder, Arrow batches as Python lists."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string) of a documents table; whatever else it has is left in the file."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share (spark.checkpoint.dir); where none is named, a temporary one on a local master, else an error."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if d:
        return d
    d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="adlake-shared-")
        spark.sparkContext.setCheckpointDir(d)
    return d


_made: list[list[str]] = []  # tables written within scratch(), innermost last


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that checkpointed() writes within go at the end; for work whose result is written before that."""
    made: list[str] = []
    _made.append(made)
    try:
        yield
    finally:
        _made.remove(made)
        for path in made:
            delete(spark, path)


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a table written to the shared folder."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/adlake-{uuid.uuid4().hex}"
    if _made:
        _made[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def skew_joined(left: DataFrame, right: DataFrame, key: str, crowd: int = 100_000, salts: int = 64) -> DataFrame:
    """left joined with right on `key`, where right has each key once and in a column `n` how often left has it.

    Keys with more than `crowd` rows on the left (or a hundred-thousandth of all rows, if that is more: at most 100,000 keys) are
    dealt to `salts` partitions by their rows' hash, and right's row goes to each of them; others join as they are.
    """
    total, most = right.agg(F.sum("n"), F.max("n")).first()
    limit = max(crowd, (total or 0) // 100_000)
    hot = F.broadcast(right.where(F.col("n") > limit).select(key, F.lit(True).alias("hot__")))
    right = right.drop("n")
    if (most or 0) <= limit:
        return left.join(right, key)
    salt = F.when(F.col("hot__"), F.pmod(F.xxhash64(*[c for c in left.columns if c != key]), F.lit(salts))).otherwise(0)
    dealt = left.join(hot, key, "left").withColumn("salt__", salt.cast("int")).drop("hot__")
    copies = F.when(F.col("hot__"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread = right.join(hot, key, "left").withColumn("salt__", F.explode(copies)).drop("hot__")
    return dealt.join(spread, [key, "salt__"]).drop("salt__")


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """mapInArrow for a function that takes one Arrow batch and yields dicts of columns (lists or Arrow arrays)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kind = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for out in f(b):
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, t.type) for x, t in ((out[t.name], t) for t in arrow)], schema=arrow)

    return df.mapInArrow(run, kind)


def pieces(b: pa.RecordBatch, column: str = "text", most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch cut so that each part holds about most_bytes of text (one longer text alone), to bound a worker's memory."""
    import numpy as np
    import pyarrow.compute as pc

    n = np.asarray(pc.fill_null(pc.binary_length(b.column(column)), 0)).astype(np.int64)
    total = np.cumsum(n)
    at = 0
    while at < b.num_rows:
        end = int(np.searchsorted(total, (total[at - 1] if at else 0) + most_bytes, "right"))
        end = max(end, at + 1)
        yield b.slice(at, end - at)
        at = end


def kept_rows(docs: DataFrame, keeps: Callable[[pa.RecordBatch], list]) -> DataFrame:
    """The rows of docs for which keeps(batch) says so, all columns as they are, whatever their names (Spark's mapInArrow takes no dots in them)."""
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(pa.RecordBatch.from_arrays(batch.columns, names=names)):
                kept = b.filter(pa.array(keeps(b), pa.bool_()))
                yield pa.RecordBatch.from_arrays(kept.columns, schema=batch.schema)

    return plain.mapInArrow(run, plain.schema).toDF(*names)


def bitmap(ids: DataFrame, bits: int = 1 << 27) -> bytes:
    """ids (id long) -> one bit for each id's remainder; at most bits / 8 bytes come to the driver, whatever there is of ids. `bits` is a power of two."""
    at = F.pmod("id", F.lit(bits)).cast("long") + 1
    parts = ids.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("part"))
    out = bytearray(bits // 8)
    for k, part in parts.toLocalIterator():
        begin = (k - 1) * len(part)
        out[begin : begin + len(part)] = part[: max(0, len(out) - begin)]
    return bytes(out)


def passes(ids, bitmap):
    """Which of the unsigned ids have their bit in a bitmap (an array of bytes): all that it was made of, and others by chance."""
    import numpy as np

    at = (ids & np.uint64(len(bitmap) * 8 - 1)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def is_held_out(doc_id, folds: int, fold: int):
    """crc32 of the doc_id written as text, modulo folds, is fold."""
    return F.crc32(doc_id.cast("string")) % folds == fold
