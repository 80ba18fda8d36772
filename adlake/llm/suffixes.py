"""Operator 8: exact removal of repeated 100-byte strings by a common-prefix-aware distributed merge sort of suffixes.

1. Documents are packed into blocks of about `block_bytes`, written once to the shared folder.
2. Every 100-byte window holds an anchor: the 32-byte string of the smallest hash in it, leftmost. Equal windows hold the same anchor
   at the same place, so a window can repeat only where its anchor does. Blocks send the hashes of their anchors, each once, to shards that
   tell which occur twice; the others' suffixes are never sorted.
3. Each block sorts the suffixes at its repeated anchors (100 bytes on, and up to 68 bytes back, read from the anchor leftwards) and
   sends every shard a front-coded sorted run: the length shared with the entry before, and the rest. Entries with equal bytes are one: the
   later ones are settled within the block.
4. A shard merges its runs with a loser tree whose nodes keep the length they share with the last winner; comparisons begin beyond it. In
   the merged order, suffixes of an anchor lie together; what an entry shares with an earlier one to both sides, 100 bytes or more,
   is covered.
5. Covered intervals go back to their blocks and are cut out.

An anchor of more than `hot` occurrences (a line that a large part of all documents share) would be one task's work. There every
100-byte window around it is a suffix of its own, dealt by the window's hash; equal windows of a block are one entry, so a shard gets each at
most once a block. All of this is exact: hashes only deal out and filter, bytes decide.

Cases: null and empty texts have no bytes (0 removed, the hash of nothing); texts under 100 bytes stay; long texts are scanned in slices; among
rows of the same doc_id (or with a null one, which comes first) the order is that of the blocks; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, pieces, texts

#: Fixed value of the contract: the length of a repeated string. The anchor's length; the bytes before an anchor in a window.
LENGTH, GRAM = 100, 32
BACK = LENGTH - GRAM
#: A key: the bytes from the anchor on, how many they are, the bytes before it read backwards, how many they are.
WIDTH = LENGTH + 1 + BACK + 1
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
BLOCKS = "block long, n long, data binary"
_FIRST = -(1 << 63)
_BASE, _WORD = 0x9E3779B97F4A7C15, (1 << 64) - 1
_SLICE = 1 << 20


def _compress(parts: list[bytes]) -> bytes:
    import zstandard

    head = np.array([len(parts), *map(len, parts)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))


def _expand(data: bytes) -> list[bytes]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, n, 8).tolist()
    out, at = [], 8 + 8 * n
    for s in sizes:
        out.append(raw[at : at + s])
        at += s
    return out


def blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """BLOCKS: doc ids, text lengths and texts of neighbouring documents."""

    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for b in pieces(batch, most_bytes=block_bytes):
                data = [(t or "").encode("utf-8", "surrogatepass") for t in b.column("text").to_pylist()]
                null = np.array([d is None for d in b.column("doc_id").to_pylist()])
                ids = np.array([_FIRST if d is None else d for d in b.column("doc_id").to_pylist()], np.int64)
                sizes = np.array(list(map(len, data)), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([int(sizes.sum())]), pa.array([_compress([ids.tobytes(), sizes.tobytes(), null.tobytes(), b"".join(data)])], pa.binary())], names=["block", "n", "data"])
                block += 1

    return texts(docs).mapInArrow(run, BLOCKS)


def _open(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc ids, where each text ends, null ids, bytes)."""
    ids, sizes, null, raw = _expand(data)
    return np.frombuffer(ids, np.int64), np.cumsum(np.frombuffer(sizes, np.int64)), np.frombuffer(null, bool), np.frombuffer(raw, np.uint8)


def _rolling(x: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all strings of `length` bytes (a sum of powers of two), by doubling."""
    h, size, power, out, done = x.astype(np.uint64) + np.uint64(0x51ED), 1, _BASE, None, 0
    while size <= length:
        if length & size:
            n = len(x) - length + 1
            part = h[done : done + n]
            out = part.copy() if out is None else out * np.uint64(power) + part
            done += size
        if size * 2 <= length:
            h = h[: len(h) - size] * np.uint64(power) + h[size:]
            power = power * power * 3 + 2 & _WORD | 1
        size *= 2
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def anchors(ends: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of every anchor, in order."""
    places, hashes = [], []
    n = len(raw)
    for lo in range(0, max(0, n - LENGTH + 1), _SLICE):
        hi = min(lo + _SLICE, n - LENGTH + 1)  # windows that begin in [lo, hi)
        h = _rolling(raw[lo : hi + LENGTH - 1], GRAM)
        m = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
        span, want = 1, LENGTH - GRAM + 1
        while span * 2 <= want:
            m = np.minimum(m[: len(m) - span], m[span:])
            span *= 2
        rest = want - span
        m = np.minimum(m[: hi - lo], m[rest : rest + hi - lo]) if rest else m[: hi - lo]
        # a window must lie in one document: the last LENGTH - 1 places of each begin none
        first, last = np.searchsorted(ends, [lo, hi + LENGTH])
        inside = np.ones(hi - lo, bool)
        for end in ends[first : last + 1].tolist():
            inside[max(0, end - LENGTH + 1 - lo) : max(0, end - lo)] = False
        at = (m & np.uint64(0xFFFFFFFF))[inside].astype(np.int64)  # never falls from one window to the next
        at = at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at
        places.append(at + lo)
        hashes.append(h[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[first]


def _dealt(key: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, indices in order) by hash."""
    shard = (key >> np.uint64(8)) % np.uint64(shards)
    order = np.argsort(shard, kind="stable")
    edge = np.flatnonzero(np.concatenate([[True], shard[order][1:] != shard[order][:-1], [True]]))
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        yield int(shard[order[a]]), order[a:b]


def repeated(packed: DataFrame, shards: int, hot: int) -> DataFrame:
    """(block, data): of each block, the hashes of its anchors that occur twice or more, and which of them are hot."""

    def send(batches):
        for b in batches:
            for block, data in zip(b.column("block").to_pylist(), b.column("data").to_pylist(), strict=True):
                _, ends, _, raw = _open(data)
                h, n = np.unique(anchors(ends, raw)[1], return_counts=True)
                rows = [(s, block, _compress([h[i].tobytes(), n[i].astype(np.int32).tobytes()])) for s, i in _dealt(h, shards)] if len(h) else []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["shard", "block", "data"])

    def judge(table: pa.Table) -> pa.Table:
        blocks_, data = table.column("block").to_pylist(), [_expand(x) for x in table.column("data").to_pylist()]
        parts = [np.frombuffer(d[0], np.uint64) for d in data]
        own = [np.frombuffer(d[1], np.int32) for d in data]
        h, back = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(back, weights=np.concatenate(own))
        out, at = [], 0
        for block, part in zip(blocks_, parts, strict=True):
            n = total[back[at : at + len(part)]]
            at += len(part)
            if (n > 1).any():
                out.append((block, _compress([part[n > 1].tobytes(), part[n > hot].tobytes()])))
        return pa.table({"block": pa.array([x[0] for x in out], pa.int64()), "data": pa.array([x[1] for x in out], pa.binary())})

    sent = packed.select("block", "data").mapInArrow(send, "shard int, block long, data binary")
    return sent.groupBy("shard").applyInArrow(judge, "block long, data binary")


def _keys(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, place: np.ndarray, back: int) -> np.ndarray:
    """Fixed-width keys of suffixes, with up to `back` bytes before each."""
    n = len(place)
    key = np.zeros((n, WIDTH), np.uint8)
    on, before = np.minimum(end - place, LENGTH), np.minimum(place - begin, back)
    cols = np.arange(LENGTH)
    at = place[:, None] + cols
    key[:, :LENGTH] = np.where(cols < on[:, None], raw[np.minimum(at, len(raw) - 1)], 0)
    key[:, LENGTH] = on
    cols = np.arange(BACK)
    at = place[:, None] - 1 - cols
    key[:, LENGTH + 1 : -1] = np.where(cols < before[:, None], raw[np.maximum(at, 0)], 0)
    key[:, -1] = before
    return key


def _shared(a: bytes, b: bytes, at: int, to: int) -> int:
    """How far a and b agree, known to agree up to `at`, looked at up to `to`."""
    if at >= to or a[at] != b[at]:
        return at
    x = int.from_bytes(a[at:to], "big") ^ int.from_bytes(b[at:to], "big")
    return to if not x else to - (x.bit_length() + 7) // 8


def front_coded(key: np.ndarray) -> tuple[bytes, bytes]:
    """(shared lengths, rests) of sorted keys."""
    shared = np.zeros(len(key), np.uint8)
    if len(key) > 1:
        differ = key[1:] != key[:-1]
        shared[1:] = np.where(differ.any(1), differ.argmax(1), WIDTH)
    return shared.tobytes(), key[np.arange(WIDTH) >= shared[:, None]].tobytes()


def _decoded(shared: bytes, rest: bytes) -> Iterator[tuple[bytes, int]]:
    key, at = b"", 0
    for s in shared:
        key = key[:s] + rest[at : at + WIDTH - s]
        at += WIDTH - s
        yield key, s


class LoserTree:
    """Merges sorted runs of (key, length shared with the key before). A node keeps a loser and the length it shares with the last
    winner above it, so two contenders are compared from the length both are known to share."""

    def __init__(self, runs: list[Iterator[tuple[bytes, int]]]):
        self.runs, k = runs, 1
        while k < len(runs):
            k *= 2
        self.k = k
        self.key: list = [None] * k  # None: the run has ended
        for i, r in enumerate(runs):
            self.key[i] = next(r, (None, 0))[0]
        self.loser, self.length = [0] * k, [0] * k
        self.top = self._build(1)

    def _build(self, node: int) -> tuple[int, int]:
        if node >= self.k:
            return node - self.k, 0
        return self._play(node, self._build(2 * node), self._build(2 * node + 1))

    def _play(self, node: int, x: tuple[int, int], y: tuple[int, int]) -> tuple[int, int]:
        """The winner of two contenders (run, shared length); the loser stays at the node."""
        (i, n), (j, m) = x, y
        a, b = self.key[i], self.key[j]
        if a is None or b is None:
            win = x if b is None else y
            lose = y if b is None else x
        elif n != m:  # the one that shares more with the last winner is smaller
            win, lose = (x, y) if n > m else (y, x)
        else:
            s = _shared(a, b, n, WIDTH)
            if s == WIDTH or a[s] < b[s]:
                win, lose = x, (j, s)
            else:
                win, lose = y, (i, s)
        self.loser[node], self.length[node] = lose
        return win

    def __iter__(self) -> Iterator[tuple[int, bytes, int]]:
        """(run, key, length shared with the key given before)."""
        k, key, loser, length, runs = self.k, self.key, self.loser, self.length, self.runs
        while True:
            run, n = self.top
            now = key[run]
            if now is None:
                return
            yield run, now, n
            key[run], n = next(runs[run], (None, 0))
            node, mine = (run + k) >> 1, run
            while node:
                other, m = loser[node], length[node]
                a, b = key[mine], key[other]
                if b is None:
                    pass
                elif a is None or m > n:
                    loser[node], length[node], mine, n = mine, n, other, m
                elif m == n:
                    s = _shared(a, b, n, WIDTH)
                    if s < WIDTH and b[s] < a[s]:
                        loser[node], length[node], mine, n = mine, s, other, m
                    else:
                        length[node] = s
                node >>= 1
            self.top = mine, n


def _covered(group: list[tuple[bytes, int, tuple]]) -> Iterator[tuple[tuple, int, int]]:
    """(entry, bytes back, bytes on) that an anchor's entries share with earlier ones. group: sorted (key, shared length, entry);
    entries compare by their order in the corpus."""
    back = slice(LENGTH + 1, -1)
    if len(group) <= 16:
        for i, (a, _, x) in enumerate(group):
            on = LENGTH
            for b, n, y in group[i + 1 :]:
                on = min(on, n)  # the smallest shared length on the way is what the two share
                r = min(on, a[LENGTH], b[LENGTH])
                most = min(a[-1], b[-1])
                if r + most < LENGTH:
                    continue
                left = min(_shared(a[back], b[back], 0, BACK), most)
                if left + r >= LENGTH:
                    yield (x if y < x else y), left, r
        return
    first: dict = {}  # every window of the group, and the earliest entry that has it
    windows = [(range(max(0, LENGTH - a[LENGTH]), a[-1] + 1), a, x) for a, _, x in group]
    for offsets, a, x in windows:
        left = a[back]
        for o in offsets:
            w = (o, left[:o] + a[: LENGTH - o])
            if w not in first or x < first[w]:
                first[w] = x
    for offsets, a, x in windows:
        left, low, before = a[back], None, 0
        for o in offsets:  # neighbouring windows are one interval
            if first[o, left[:o] + a[: LENGTH - o]] != x:
                low, before = o if low is None else low, o
            elif low is not None:
                yield x, before, LENGTH - low
                low = None
        if low is not None:
            yield x, before, LENGTH - low


def _joined(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals merged where they overlap or touch."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > end[:-1]])
    return start[new], end[np.concatenate([new[1:], [True]])]


def _intervals(start: np.ndarray, end: np.ndarray) -> bytes:
    start, end = _joined(start, end)
    return _compress([start.astype(np.int64).tobytes(), end.astype(np.int64).tobytes()])


def _runs(block: int, data: bytes, known: list[bytes], shards: int) -> Iterator[tuple]:
    """(shard, block, kind, data): the block's front-coded runs (kind 0), and what it settles itself (kind 1)."""
    ids, ends, _, raw = _open(data)
    place, h = anchors(ends, raw)
    rep = np.sort(np.concatenate([np.frombuffer(x[0], np.uint64) for x in known]))
    hot = np.sort(np.concatenate([np.frombuffer(x[1], np.uint64) for x in known]))
    is_in = lambda x, s: s[np.minimum(np.searchsorted(s, x), len(s) - 1)] == x if len(s) else np.zeros(len(x), bool)
    held, heated = is_in(h, rep), is_in(h, hot)
    starts = np.concatenate([[0], ends[:-1]])
    settled: list = [[], []]
    for kind, at, key_hash, back in ((0, place[held & ~heated], h[held & ~heated], BACK), (1, place[heated], None, 0)):
        if not len(at):
            continue
        if kind:  # every window that holds a hot anchor
            at = np.unique((at[:, None] - np.arange(BACK + 1)).ravel())
            at = at[at >= 0]
            doc = np.searchsorted(ends, at, "right")
            at = at[at + LENGTH <= ends[np.minimum(doc, len(ends) - 1)]]
        for lo in range(0, len(at), 60_000) if kind else (0,):
            part = at[lo : lo + 60_000] if kind else at
            hashes = _rolling_at(raw, part) if kind else key_hash
            yield from _sorted_runs(block, ids, starts, ends, raw, part, hashes, back, shards, settled, kind)
    if settled[0]:
        yield block % shards, block, 2, _intervals(np.concatenate(settled[0]), np.concatenate(settled[1]))


def _rolling_at(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The hashes of the 100-byte strings at given places, in order."""
    lo = int(at.min())
    return _rolling(raw[lo : int(at.max()) + LENGTH], LENGTH)[at - lo]


def _sorted_runs(block, ids, starts, ends, raw, at, hashes, back, shards, settled, kind):
    doc = np.searchsorted(ends, at, "right")
    key = _keys(raw, starts[doc], ends[doc], at, back)
    flat = key.view(f"S{WIDTH}").ravel()
    # sorted by key, equal ones by document and place: the first of them stands for all
    order = np.lexsort((at, ids[doc], flat))
    key, at, doc, hashes = key[order], at[order], doc[order], hashes[order]
    same = np.zeros(len(at), bool)
    same[1:] = flat[order][1:] == flat[order][:-1]
    on, before = key[:, LENGTH].astype(np.int64), key[:, -1].astype(np.int64)
    again = same & (on + before >= LENGTH)
    settled[0].append((at - before)[again])
    settled[1].append((at + on)[again])
    key, at, doc, hashes = key[~same], at[~same], doc[~same], hashes[~same]
    for shard, i in _dealt(hashes, shards):
        i = np.sort(i)
        shared, rest = front_coded(key[i])
        yield shard, block, kind, _compress([shared, rest, ids[doc[i]].tobytes(), at[i].tobytes()])


def _merge(table: pa.Table) -> pa.Table:
    """A shard's runs merged; (block, data): covered intervals by block."""
    found: dict[int, list] = {}
    passed = []
    rows = list(zip(table.column("block").to_pylist(), table.column("kind").to_pylist(), table.column("data").to_pylist(), strict=True))
    for kind in (0, 1):
        runs, where = [], []
        for block, k, data in rows:
            if k == kind:
                shared, rest, ids, at = _expand(data)
                runs.append(_decoded(shared, rest))
                where.append((block, iter(zip(np.frombuffer(ids, np.int64).tolist(), np.frombuffer(at, np.int64).tolist(), strict=True))))
        if not runs:
            continue
        need = LENGTH if kind else GRAM
        group: list = []

        def settle(group: list) -> None:
            if kind:
                least = min(x for _, _, x in group)
                for _, _, x in group:
                    if x != least:
                        found.setdefault(x[1], []).append((x[2], x[2] + LENGTH))
                return
            for x, left, on in _covered(group):
                found.setdefault(x[1], []).append((x[2] - left, x[2] + on))

        for run, key, n in LoserTree(runs):
            block, entries = where[run]
            doc_id, at = next(entries)
            if n < need and group:
                if len(group) > 1:
                    settle(group)
                group = []
            group.append((key, n, (doc_id, block, at)))
        if len(group) > 1:
            settle(group)
    for block, k, data in rows:
        if k == 2:
            passed.append((block, data))
    for block, spans in found.items():
        x = np.array(spans, np.int64)
        passed.append((block, _intervals(x[:, 0], x[:, 1])))
    return pa.table({"block": pa.array([p[0] for p in passed], pa.int64()), "data": pa.array([p[1] for p in passed], pa.binary())})


def covered(packed: DataFrame, total: int, hot: int) -> DataFrame:
    """(block, data): what is to be cut out of each block."""
    shards = max(24, total // (16 << 20))

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if right.num_rows:
            known = [_expand(x) for x in right.column("data").to_pylist()]
            for block, data in zip(left.column("block").to_pylist(), left.column("data").to_pylist(), strict=True):
                out += _runs(block, data, known, shards)
        cols = list(zip(*out, strict=True)) or [[]] * 4
        return pa.table({k: pa.array(c, t) for k, c, t in zip(("shard", "block", "kind", "data"), cols, (pa.int32(), pa.int64(), pa.int32(), pa.binary()), strict=True)})

    told = repeated(packed, max(24, total // (64 << 20)), hot)
    runs = packed.select("block", "data").groupBy("block").cogroup(told.groupBy("block")).applyInArrow(send, "shard int, block long, kind int, data binary")
    return runs.groupBy("shard").applyInArrow(_merge, "block long, data binary")


def _cut(data: bytes, spans: list[bytes]) -> Iterator[tuple]:
    """(doc id, bytes, [(start, end)], text bytes) of each of a block's documents."""
    ids, ends, null, raw = _open(data)
    both = [_expand(x) for x in spans]
    start, end = _joined(np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(x[0], np.int64) for x in both]]), np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(x[1], np.int64) for x in both]]))
    begin = 0
    whole = raw.tobytes()
    lo = np.searchsorted(end, np.concatenate([[0], ends[:-1]]), "right")
    hi = np.searchsorted(start, ends, "left")
    for k, (doc_id, stop) in enumerate(zip(ids.tolist(), ends.tolist(), strict=True)):
        # an interval may join two documents' ends: each gets its own part
        own = [(max(int(s), begin) - begin, min(int(e), stop) - begin) for s, e in zip(start[lo[k] : hi[k]], end[lo[k] : hi[k]], strict=True)]
        yield (None if null[k] else doc_id), stop - begin, own, whole[begin:stop]
        begin = stop


def _apply(docs: DataFrame, each, schema: str, block_bytes: int, hot: int) -> DataFrame:
    packed = checkpointed(blocks(docs, block_bytes))
    total = packed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    names = [c.split()[0] for c in schema.split(", ")]

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        spans = right.column("data").to_pylist()
        rows = [r for data in left.column("data").to_pylist() for x in _cut(data, spans) for r in each(*x)]
        kinds = {"long": pa.int64(), "string": pa.string()}
        return pa.table({n: pa.array([r[k] for r in rows], kinds[c.split()[1]]) for k, (n, c) in enumerate(zip(names, schema.split(", "), strict=True))})

    return packed.select("block", "data").groupBy("block").cogroup(covered(packed, total, hot).groupBy("block")).applyInArrow(cut, schema)


def deduplicate(docs: DataFrame, block_bytes: int = 4 << 20, hot: int = 50_000) -> DataFrame:
    """RESULT: what is removed from each document."""

    def each(doc_id, n, own, text):
        at, kept = 0, hashlib.sha256()
        for s, e in own:
            kept.update(text[at:s])
            at = e
        kept.update(text[at:])
        yield doc_id, n, sum(e - s for s, e in own), len(own), kept.hexdigest()

    return _apply(docs, each, RESULT, block_bytes, hot)


def spans(docs: DataFrame, block_bytes: int = 4 << 20, hot: int = 50_000) -> DataFrame:
    """(doc_id, start, end): the maximal removed runs, in bytes."""

    def each(doc_id, n, own, text):
        for s, e in own:
            yield doc_id, s, e

    return _apply(docs, each, "doc_id long, start long, end long", block_bytes, hot)
