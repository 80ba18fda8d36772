"""Operator 9: harmonic packing of tokenized documents into fixed-length training sequences.

A document's ids (byte-level BPE, then the end id) are cut into pieces of reciprocal-capacity sizes: whole sequences first, then
for what is left the largest floor(capacity / k) that fits, at most `cuts` times, and a tail. A piece of length L belongs to class
k = floor(capacity / L), and a bin of class k takes exactly k pieces, whatever else the corpus holds: workers fill their bins alone,
without an exchange. A piece cut to floor(capacity / k) leaves under k ids of padding in its bin. Bins that a worker could not
complete are emptied into a few mixed bins by first fit (at most one open bin of each class a worker, so a bounded number of pieces).

Cases: null text and empty text are the end id alone; a text holding the tokenizer's special string gets the special id, as the
JSON tokenizer gives it; equal rows are packed one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame

from .common import pieces, texts

#: The capacity in the contract, the id that ends a document, the vocabulary's special string and id.
CAPACITY, END_ID, SPECIAL, SPECIAL_ID = 2048, 1, "<|endoftext|>", 50256
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


_encoders: dict = {}


def encoder(path: str | None = None):
    """The byte-level BPE; its rank file holds the vocabulary of byte_bpe_50k.json, id for id, and encodes five times faster."""
    path = path or default_vocabulary()
    if path not in _encoders:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID})
    return _encoders[path]


def cut(n: int, capacity: int = CAPACITY, cuts: int = 3) -> list[int]:
    """The lengths of a document's pieces: full sequences, then at most `cuts` reciprocal sizes, then the tail."""
    whole, left = divmod(n, capacity)
    out = [capacity] * whole
    for _ in range(cuts):
        if left < 2:
            break
        k = -(-capacity // left)  # the smallest k for which capacity // k <= left
        while capacity // k > left:
            k += 1
        out.append(size := capacity // k)
        left -= size
        if not left:
            break
    if left:
        out.append(left)
    return out


class Bins:
    """One worker's bins: a class's open bin closes when it holds its fixed count."""

    def __init__(self, worker: int, capacity: int, harmonic: int):
        self.next, self.capacity, self.harmonic, self.open = worker << 36, capacity, harmonic, {}

    def put(self, piece: list, length: int) -> list | None:
        """piece: [length, row]. Returns the bin (sequence id, pieces) it completes, if any."""
        k = self.capacity // length
        if k > self.harmonic:  # the smallest sizes share one class, filled up to the capacity
            k = 0
        row = self.open.setdefault(k, [0, []])
        done = None
        if not k and row[0] + length > self.capacity:
            done, row = self.close(row[1]), self.open.__setitem__(0, [0, []]) or self.open[0]
        row[1].append(piece)
        row[0] += length
        if k and len(row[1]) == k:
            done = self.close(self.open.pop(k)[1])
        return done

    def close(self, members: list) -> tuple:
        self.next += 1
        return self.next - 1, members

    def rest(self) -> Iterator[tuple]:
        """The incomplete bins' pieces, longest first, each into the first bin with room."""
        left = sorted((p for _, row in sorted(self.open.items()) for p in row[1]), key=lambda p: -p[0])
        bins: list = []
        for p in left:
            for b in bins:
                if b[0] + p[0] <= self.capacity:
                    break
            else:
                bins.append(b := [0, []])
            b[0] += p[0]
            b[1].append(p)
        for b in bins:
            yield self.close(b[1])


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, cuts: int = 3, harmonic: int = 128) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset). One pass, no exchange."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        enc, bins = encoder(vocabulary), Bins(TaskContext.get().partitionId(), capacity, harmonic)
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        rows: list = []

        def emit(done) -> None:
            sequence, members = done
            at = 0
            for length, row in members:
                rows.append((*row, sequence, at))
                at += length

        def flush():
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)
                rows.clear()

        for batch in batches:
            for b in pieces(batch):
                for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                    ids = enc.encode(text, allowed_special="all") if text else []
                    ids.append(END_ID)
                    data, n, at = np.asarray(ids, "<u4"), len(ids), 0
                    for length in cut(n, capacity, cuts):
                        if done := bins.put([length, (doc_id, at, length, zlib.crc32(data[at : at + length]), n)], length):
                            emit(done)
                        at += length
                if len(rows) > 20_000:
                    yield from flush()
        for done in bins.rest():
            emit(done)
        yield from flush()

    return texts(docs).mapInArrow(run, SCHEMA)


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: sequences, ids, padded positions (a sequence whose length is a power of two takes none)."""
    from pyspark.sql import functions as F

    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    power = F.expr("bit_count(used)") == 1
    return used.agg(F.count("*").alias("sequences"), F.sum("used").alias("ids"), F.sum(F.when(power, 0).otherwise(capacity - F.col("used"))).alias("padded"))
