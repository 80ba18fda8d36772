"""A transactional sink for streams: rows go to the table that their `topic` names, rejected ones among them, and count when their micro-batch is committed.

spark.dataSource.register(RoutedTables); stream.writeStream.format("routed").option("path", ...).start(). Each task writes Parquet files of its own, retries what the
storage refuses (`tries`, `pause` seconds, doubled each time) and reports their names; the commit writes one list of them for the micro-batch, once. Files that no
commit names (of a task or a query that died) are never read, and those of an aborted batch are deleted. Rows without a topic are of an unknown kind and are skipped.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

from adlake.operators import ingest as I
from adlake.sources.shared_files import Folder

REJECTED = "rejected"


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str, int]]  # topic, name, rows


def retried(work: Callable[[], None], tries: int, pause: float) -> None:
    for attempt in range(tries):
        try:
            return work()
        except OSError:
            if attempt == tries - 1:
                raise
            time.sleep(pause * 2**attempt)


class RoutedWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict, folder: Folder | None = None):
        self.path, self.tries, self.pause = options["path"], int(options.get("tries", 3)), float(options.get("pause", 1.0))
        self._folder = folder

    @property
    def folder(self) -> Folder:
        return self._folder or Folder(self.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        folder, files = self.folder, []
        for batch in iterator:
            for topic in pc.unique(batch.column("topic")).to_pylist():
                if topic is None:
                    continue
                rows = pa.Table.from_batches([batch.filter(pc.equal(batch.column("topic"), topic))])
                name = f"{topic}/part-{uuid.uuid4().hex}.parquet"

                def put(name: str = name, topic: str = topic, rows: pa.Table = rows) -> None:
                    folder.fs.create_dir(folder.at(topic), recursive=True)
                    pq.write_table(rows, folder.at(name), filesystem=folder.fs)

                retried(put, self.tries, self.pause)
                files.append((topic, name, rows.num_rows))
        return Written(files)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        folder, files = self.folder, [f for m in messages if m is not None for f in m.files]
        if f"{batchId:09d}.json" in folder.names("_commits"):  # a batch that was committed, but not in the checkpoint, and came again
            return self.abort(messages, batchId)
        lines = "\n".join(json.dumps({"topic": t, "file": n, "rows": k}) for t, n, k in files)
        retried(lambda: folder.write(f"_commits/{batchId:09d}.json", lines), self.tries, self.pause)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        for m in messages:
            for _, name, _ in m.files if m is not None else ():
                self.folder.delete(name)


class RoutedTables(DataSource):
    @classmethod
    def name(cls) -> str:
        return "routed"

    def streamWriter(self, schema, overwrite: bool) -> RoutedWriter:
        return RoutedWriter(self.options)


def committed(spark: SparkSession, path: str, topic: str, schema) -> DataFrame:
    """The rows of a topic's table, of committed micro-batches only."""
    names = spark.read.schema("topic string, file string").json(f"{path}/_commits").where(F.col("topic") == topic)
    files = [f"{path}/{r.file}" for r in names.select("file").collect()]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def split(messages: DataFrame, required: list[str], topic: str) -> DataFrame:
    """Messages with `topic`: valid ones under the given, others under REJECTED with the reason."""
    done = I.validate(messages, required)
    return done.withColumn("topic", F.when(F.col("valid"), topic).otherwise(REJECTED)).drop("valid")


def start(routed: DataFrame, path: str, checkpoint: str, **options: str):
    """The writer of a stream with a `topic`, still without a trigger."""
    routed.sparkSession.dataSource.register(RoutedTables)
    return routed.writeStream.format("routed").option("path", path).options(**options).option("checkpointLocation", checkpoint)
