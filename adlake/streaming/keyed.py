"""Listing state and make completion in Spark's own state store (transformWithState over RocksDB with changelog checkpoints).

`listing_log` keeps one value an ad, its row with the price in force, and emits the change log: a micro-batch touches the ads of its messages only, whatever the
size of the state. The engine commits state, log and offsets together, so a restart goes on from the checkpoint and a replayed batch
changes nothing; `current` reads the rows back from the checkpoint. Closings (what snapshots no longer show, see jobs.py) come as messages with `closed_at`.
`completion` keeps, for a source's make in a run, the pages seen and their ids, and sends the make's snapshot once, when all its pages are there.

A key's messages of one micro-batch are sorted in memory; admission (maxFilesPerTrigger, maxOffsetsPerTrigger) bounds them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from adlake.operators.state import UPDATED
from adlake.sources.tables import ALIASES

STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
LOG = "auto_ad_id string, offset long, timestamp timestamp_ntz, price int, currency_code string, status string"
SNAPSHOT = "source_name string, make_str string, id_ad string"
_KEYS = {v: k for k, v in ALIASES.items()}


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state in RocksDB; the session's own settings come back."""
    before = {k: spark.conf.get(k, None) for k in STORE}
    try:
        for k, v in STORE.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class ListingState(StatefulProcessor):
    """One ad: its row, changed message by message in the order of offsets, then by the closings of the same micro-batch."""

    def __init__(self, columns: list[str], kept: T.StructType):
        self.columns, self.kept = columns, kept

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.row = handle.getValueState("row", self.kept)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = dict(zip(self.kept.names, self.row.get(), strict=True)) if self.row.exists() else None
        log = lambda at, price, currency, status, offset: Row(auto_ad_id=key[0], offset=offset, timestamp=at, price=price, currency_code=currency, status=status)
        for m in sorted(rows, key=lambda m: (m["closed_at"] is not None, m["offset"])):
            if m["closed_at"] is not None:
                if now is not None and now["sold_at"] is None:  # an ad is sold once, and stays so when it is seen again
                    now["sold_at"] = m["closed_at"]
                    yield log(m["closed_at"], now.get("price"), now.get("currency_code"), "sold", m["offset"])
                continue
            held = set(m["keys"]) if "keys" in m and m["keys"] is not None else None
            has = lambda c, held=held: held is None or _KEYS.get(c, c) in held
            status = "active" if now is None else "price_changed" if has("price") and m["price"] != now["price"] else None
            if now is None:
                now = {c: None if c == "sold_at" or (c in self.columns and not has(c)) else m[c] for c in self.kept.names}
            else:
                # an update never empties created_at, and source_name stays as it first was
                now |= {c: m[c] for c in self.columns if has(c) and not (c == "created_at" and m[c] is None)}
            if status:
                yield log(m["created_at"], m["price"], m["currency_code"], status, m["offset"])
        if now is not None:
            self.row.update(tuple(now[c] for c in self.kept.names))

    def close(self) -> None:
        pass


def listing_log(messages: DataFrame) -> DataFrame:
    """A stream of messages under table column names (with `keys`, only held fields are written; with closed_at, that closes the ad) -> LOG; the state is kept on the way."""
    columns = [c for c in messages.columns if c in UPDATED]
    kept = T.StructType([*[T.StructField(f.name, f.dataType) for f in messages.schema if f.name in columns or f.name == "source_name"], T.StructField("sold_at", T.TimestampNTZType())])
    if "closed_at" not in messages.columns:
        messages = messages.withColumn("closed_at", F.lit(None).cast("timestamp_ntz"))
    return messages.groupBy("id_ad").transformWithState(ListingState(columns, kept), T._parse_datatype_string(LOG), "Append", "None")


def current(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The ads' rows as the last committed batch left them."""
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "row").load().select(F.col("key.id_ad").alias("id_ad"), "value.*")


class Completion(StatefulProcessor):
    """One make of a source in one run: the pages that have come, their ids, and how many pages there are."""

    def __init__(self, patience_ms: int):
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.make = handle.getValueState("make", "pages int, done boolean")
        self.pages = handle.getMapState("pages", "page int", "seen boolean")
        self.ids = handle.getMapState("ids", "id string", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.make.get() if self.make.exists() else None
        pages, done = (known[0], known[1]) if known else (None, False)
        if done:  # a page that comes again after the snapshot
            return
        first = None
        for r in rows:
            first = r["at"] if first is None else min(first, r["at"])
            # a make without ads still has its one empty page
            pages = max(pages or 1, r["pages"] or 1)
            self.pages.updateValue((r["page"],), (True,))
            for i in r["ids"] or []:
                if i is not None:
                    self.ids.updateValue((i,), (True,))
        seen = sum(1 for _ in self.pages.keys())
        done = seen >= pages
        self.make.update((pages, done))
        if known is None:
            self.handle.registerTimer(round(first.timestamp() * 1000) + self.patience_ms)
        if done:
            empty = True
            for (i,) in self.ids.keys():
                empty = False
                yield Row(source_name=key[0], make_str=key[2], id_ad=i)
            if empty:
                yield Row(source_name=key[0], make_str=key[2], id_ad=None)
            self.pages.clear()
            self.ids.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """The make is forgotten: a complete one has been sent, one whose pages never came is sent not at all."""
        self.make.clear()
        self.pages.clear()
        self.ids.clear()
        return iter(())

    def close(self) -> None:
        pass


def completion(pages: DataFrame, patience_seconds: int = 3600) -> DataFrame:
    """A stream of pages (source_name, run, make_str, page, pages, ids, at) -> the snapshot's rows (SNAPSHOT) of every make of a run, once its pages are all there, in
    any order and however often. An empty make is one row without an id. What isn't complete when `at` has gone on by twice the patience is given up and forgotten."""
    rows = pages.select("source_name", "run", "make_str", "page", "pages", "ids", "at").withWatermark("at", f"{patience_seconds} seconds")
    return rows.groupBy("source_name", "run", "make_str").transformWithState(Completion(patience_seconds * 1000), T._parse_datatype_string(SNAPSHOT), "Append", "EventTime")
