"""Operator 6: benchmark decontamination by training suffix arrays.

The benchmark (words as ids) is the query set; it is broadcast in blocks of about `block_words` words, checked by counting: the driver makes one block
after another, and a task holds one at a time (the others lie on its disk). Each task turns its documents into shards of about 4 MB of text and builds a suffix array of each over words, for those suffixes
whose first three words occur in that order in the benchmark (no other suffix can begin a match), ordered by their first ten
words. Every benchmark suffix is then searched in each shard by bisection, all at once: the range of training suffixes that share
its window gives items, documents and locations; each location is extended to its longest verbatim match, and what the matches cover is hit.
No exchange: a document's matches are found where it is read. `report` tells of each document what is hit and its longest match (the words, the
item, and the places in both; ties: the first place in the document, then the first item), `matches` gives all of them.

Cases: null and empty texts have no words and are clean; an item without words matches nothing; an item of fewer than ten words is
one window; equal documents and equal items count each by themselves; an empty benchmark leaves all documents clean, empty
documents give no rows; other columns are ignored (`decontaminate` keeps them).
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_rows, map_batches, pieces, texts

#: Fixed value: words in a window, from the contract.
WINDOW = 10
RESULT = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
    "longest_words long, longest_item long, longest_item_start long, longest_doc_start long"
)
MATCHES = "item_id long, item_start long, doc_id long, doc_start long, n_words long"
#: Words are lower-cased runs of [0-9a-z] and characters beyond ASCII.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class Benchmark:
    """The query set: word ids of all items one after another, and one query for each distinct window."""

    def __init__(self, items: list[tuple[int, str | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        ids, lengths, self.item_ids = [], [], []
        for item_id, text in items:
            w = words(text)
            if w:
                self.item_ids.append(item_id)
                lengths.append(len(w))
                ids += [self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in w]
        self.window = window
        self.ids = np.array(ids + [0] * window, np.int64)
        self.ends = np.cumsum(lengths, dtype=np.int64) if lengths else np.zeros(0, np.int64)
        starts, owners, depth = [], [], []
        for k, (end, n) in enumerate(zip(self.ends.tolist(), lengths, strict=True)):
            count = max(1, n - window + 1)
            starts += range(end - n, end - n + count)
            owners += [k] * count
            depth += [min(n, window)] * count
        self.starts, self.owners, self.depth = (np.array(x, np.int64) for x in (starts, owners, depth))
        self.first = self.heads(self.ids, self.starts, self.depth)

    def heads(self, ids: np.ndarray, at: np.ndarray, depth: np.ndarray | int = WINDOW) -> np.ndarray:
        """A number for the first three words at each place; shorter items use as many as they have, and match by their own table."""
        v = len(self.vocabulary) + 2
        d = np.minimum(depth, 3)
        out = ids[at]
        for j in (1, 2):
            out = out * v + np.where(j < d, ids[np.minimum(at + j, len(ids) - 1)], v - 1)
        return out


def _ranges(rows: np.ndarray, order: np.ndarray, want: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each wanted row, the part of the sorted suffixes that agrees on its first `depth` words, by bisection."""
    n, m, width = len(order), len(want), rows.shape[1]
    cols = np.arange(width)

    def bisect(upper: bool) -> np.ndarray:
        lo, hi = np.zeros(m, np.int64), np.full(m, n, np.int64)
        for _ in range(n.bit_length() + 1):
            live = lo < hi
            if not live.any():
                break
            mid = (lo + hi) >> 1
            have = rows[order[np.minimum(mid, n - 1)]]
            differ = (have != want) & (cols < depth[:, None])
            at = differ.argmax(1)
            r = np.arange(m)
            less = np.where(differ.any(1), have[r, at] < want[r, at], upper)
            lo, hi = np.where(live & less, mid + 1, lo), np.where(live & ~less, mid, hi)
        return lo

    return bisect(False), bisect(True)


def _shard(per_doc: list[list[bytes]], bench: Benchmark):
    """(first words of the shard's documents, word ids, matches): matches are arrays of owner, place in the item, place in the shard and length, each longest."""
    w = bench.window
    counts = np.array([len(x) for x in per_doc], np.int64)
    total = int(counts.sum()) + w * len(per_doc)  # the documents lie one after another
    ids = np.zeros(total + w, np.int64)  # `w` zeros end each document: no window crosses into the next one
    get, at, begins = bench.vocabulary.get, 0, np.zeros(len(per_doc), np.int64)
    for k, x in enumerate(per_doc):
        begins[k] = at
        ids[at : at + len(x)] = np.fromiter(map(get, x, repeat(0)), np.int64, len(x))
        at += len(x) + w
    hits = (np.zeros(0, np.int64),) * 2
    if len(bench.starts):
        v = len(bench.vocabulary) + 2
        places = np.flatnonzero(ids[:-w])
        pair, ok = None, np.zeros(len(places), bool)
        for d in (1, 2, 3):  # the shortest items, by as many words as they have
            if (np.minimum(bench.depth, 3) == d).any():
                heads = np.unique(bench.first[np.minimum(bench.depth, 3) == d])
                pair = bench.heads(ids, places, d)
                k = np.minimum(np.searchsorted(heads, pair), len(heads) - 1)
                ok |= heads[k] == pair
        places = places[ok]
        if len(places):
            rows = ids[places[:, None] + np.arange(w)]
            order = np.lexsort(rows.T[::-1])  # the shard's suffix array
            want = bench.ids[bench.starts[:, None] + np.arange(w)]
            lo, hi = _ranges(rows, order, want, bench.depth)
            n = hi - lo
            query = np.repeat(np.arange(len(lo)), n)
            rank = np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            hits = (query, places[order[rank]])
        del v
    query, place = hits
    start, owner = bench.starts[query], bench.owners[query]
    first = np.concatenate([[0], bench.ends[:-1]])[owner] if len(owner) else start
    # a match goes on from one that begins a word earlier: only the first of each is extended
    head = (start == first) | (ids[place - 1] != bench.ids[start - 1]) | (place == 0)
    start, place, owner, first, length = start[head], place[head], owner[head], first[head], bench.depth[query][head]
    live = np.arange(len(start))
    while len(live):
        s, p = start[live] + length[live], np.minimum(place[live] + length[live], len(ids) - 1)
        on = (s < bench.ends[owner[live]]) & (ids[p] == bench.ids[np.minimum(s, len(bench.ids) - 1)])
        live = live[on]
        length[live] += 1
    return begins, ids, (owner, start - first, place, length)


def _blocks(benchmark: DataFrame, block_words: int, window: int) -> list:
    """Broadcasts of the benchmark's items, about block_words words each. The driver holds one block at a time."""
    context = benchmark.sparkSession.sparkContext
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator(prefetchPartitions=False)
    out, block, size = [], [], 0
    for r in rows:
        n = len(r[1] or "") // 4
        if block and size + n > block_words:
            out.append(context.broadcast(Benchmark(block, window)))
            block, size = [], 0
        block.append((r[0], r[1]))
        size += n
    return [*out, context.broadcast(Benchmark(block, window))]


def _found(texts_: list, blocks: list):
    """(word counts, for each block its items' ids and a shard's matches: owner, item place, document number, document place, length)."""
    per_doc = [words(t) for t in texts_]
    out = []
    for shared in blocks:
        bench = shared.value
        begins, _, (owner, item, place, length) = _shard(per_doc, bench)
        doc = np.searchsorted(begins, place, "right") - 1
        out.append((bench.item_ids, owner, item, doc, place - begins[doc] if len(doc) else place, length))
        if len(blocks) > 1:
            shared.__dict__.pop("_value", None)  # the next batch reads it again; one block is held at a time
    return np.array([len(x) for x in per_doc], np.int64), out


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = 2_000_000) -> DataFrame:
    """RESULT: what the benchmark hits in each document, and the longest match."""
    blocks = _blocks(benchmark, block_words, window)

    def run(batch):
        for b in pieces(batch):
            counts, found = _found(b.column("text").to_pylist(), blocks)
            begins = np.cumsum(counts + 1) - counts - 1
            delta = np.zeros(int((counts + 1).sum()) + 1, np.int64)
            items, longest = [set() for _ in counts], [None] * len(counts)
            for item_ids, owner, item, doc, at, length in found:
                np.add.at(delta, begins[doc] + at, 1)
                np.add.at(delta, begins[doc] + at + length, -1)
                for d, k in set(zip(doc.tolist(), owner.tolist(), strict=True)):
                    items[d].add(str(item_ids[k]))
                order = np.lexsort((owner, at, -length, doc))
                for j in order[np.concatenate([[True], doc[order][1:] != doc[order][:-1]])].tolist() if len(order) else []:
                    d, one = int(doc[j]), (-int(length[j]), int(at[j]), item_ids[owner[j]], int(item[j]))
                    if longest[d] is None or one[:2] < longest[d][:2]:
                        longest[d] = one
            covered = np.concatenate([[0], np.cumsum(np.cumsum(delta) > 0)])
            n_hit = covered[begins + counts] - covered[begins]
            names = [sorted(str(x) for x in v) for v in items]
            part = lambda k, sign=1: [None if x is None else x[k] * sign for x in longest]
            yield {
                "doc_id": b.column("doc_id"), "n_words": counts.tolist(), "n_hit": n_hit.tolist(), "n_items": [len(x) for x in names],
                "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in names], "contaminated": (n_hit > 0).tolist(),
                "longest_words": [0 if x is None else -x[0] for x in longest], "longest_item": [None if x is None else x[2] for x in longest], "longest_item_start": part(3), "longest_doc_start": part(1),
            }

    return map_batches(texts(docs), run, RESULT)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = 2_000_000) -> DataFrame:
    """MATCHES: the maximal verbatim matches that hold a window (of each item and document the places and the length in words)."""
    blocks = _blocks(benchmark, block_words, window)

    def run(batch):
        for b in pieces(batch):
            doc_ids = b.column("doc_id").to_pylist()
            for item_ids, owner, item, doc, at, length in _found(b.column("text").to_pylist(), blocks)[1]:
                yield {"item_id": [item_ids[k] for k in owner], "item_start": item.tolist(), "doc_id": [doc_ids[d] for d in doc], "doc_start": at.tolist(), "n_words": length.tolist()}

    return map_batches(texts(docs), run, MATCHES)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the affected documents, all columns kept. The verdict is made beside the text, so nothing is exchanged."""
    blocks = _blocks(benchmark, 2_000_000, WINDOW)

    def clean(b):
        out = np.ones(b.num_rows, bool)
        for *_, doc, _, _ in _found(b.column("text").to_pylist(), blocks)[1]:
            out[doc] = False
        return out

    return kept_rows(docs, clean)
