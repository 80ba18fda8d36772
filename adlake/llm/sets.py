"""Similar sets of shingles, for operator 11 and the pipeline's near-duplicate stage: signatures, sequential Bayesian pruning, exact verification.

A text's set of shingles gets a signature of 256 minima. Nodes (different sets) that share a key are candidates. Their signatures are compared batch by batch: after
each, with a uniform prior, the posterior chance that the pair's similarity reaches the bound is a binomial tail, and the pair is pruned when that falls under `miss` (in all
batches together). Survivors are verified exactly, on the full sets of words; only such pairs are links. Sets whose sizes alone rule a link out aren't compared.

For scale: rows of one set are one node, however many copies there are. (key, node) is shuffled once; equal groups of nodes are compared once; a key of more than `block`
nodes is cut into blocks as it is read. A task compares the signatures of one block, and sends for exact verification only a spanning forest of the
survivors, likeliest first. Blocks of a large key are joined through their hubs (the nodes likest to all others), level by level. Once the links so far have made
components, most groups lie within one; in the others the nodes outside of the largest component are compared with all of the group (in blocks, a
bounded number of nodes at a time). Nodes with a survivor in another component then meet once more with their texts, and the task verifies such pairs, likeliest first,
until components are joined or all are refuted, so no link is lost that signatures did not prune. Pairs are never sent: a group of n nodes costs n rows, and the m nodes
outside its component some n m / (block / 2) + m n / block more; families of the same nodes are one. Texts are fetched for nodes with survivors only (a bitmap of fixed size filters the scan). Components come from contraction
(graph.py), copies and hubs are salted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bitmap, checkpointed, map_batches, passes, pieces, skew_joined, texts
from .graph import components

#: Places of a signature, places compared at a time, the chance to miss a pair at the bound, nodes of a block.
PLACES, BATCH, MISS, BLOCK = 256, 32, 1e-6, 512
_PAIRS = 1 << 17  # compared at a time
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []


def rows_by_key(batches, names: list[str], most: int | None = None) -> Iterator[tuple[list[np.ndarray], bool]]:
    """Sorted rows as arrays of whole keys. A last key of more than `most` rows isn't held back: its rows come as they are read, marked True."""
    held, open_ = [np.zeros(0, np.int64) for _ in names], None
    for batch in batches:
        held = [np.concatenate([x, batch.column(c).to_numpy()]) for x, c in zip(held, names, strict=True)]
        if open_ is not None:
            n = int(np.searchsorted(held[0], open_, "right"))
            if n:
                yield [x[:n] for x in held], True
                held = [x[n:] for x in held]
        if not len(held[0]):
            continue
        n = int(np.searchsorted(held[0], held[0][-1]))  # the last key may go on in the next batch
        if n:
            yield [x[:n] for x in held], False
            held = [x[n:] for x in held]
        if most is not None and len(held[0]) > most:
            open_ = held[0][0]
            yield held, True
            held = [x[:0] for x in held]
    if len(held[0]):
        yield held, False


def edges_of(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key's rows begin, and how many they are."""
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    return edge[:-1], np.diff(edge)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FACTORS = (_mixed(np.arange(1, PLACES + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_OFFSETS = (_mixed(np.arange(1, PLACES + 1, dtype=np.uint64) << np.uint64(20)) >> np.uint64(32)).astype(np.uint32)


def shingles(text: str | None, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The whole text's set of shingles as sorted 128-bit hashes, in two halves."""
    import xxhash

    w, digest = words_of(text), xxhash.xxh3_128_digest
    size = min(shingle, len(w))
    n, parts = len(w) - size + 1 if w else 0, [np.zeros((0, 2), np.uint64)]
    for at in range(0, n, 16_384):
        part = w[at : min(at + 16_384, n) + size - 1]
        parts.append(np.frombuffer(b"".join([digest(x) for x in map(b" ".join, zip(*(part[k:] for k in range(size)), strict=False))]), "<u8").reshape(-1, 2))
    a, b = np.concatenate(parts).T
    order = np.argsort(a)
    a, b = a[order], b[order]
    same = a[1:] == a[:-1]
    if (same & (b[1:] != b[:-1])).any():  # a half alone doesn't tell them apart
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        same = a[1:] == a[:-1]
    first = np.concatenate([[True] * min(len(a), 1), ~same | (b[1:] != b[:-1])]).astype(bool)
    return a[first], b[first]


def signature(halves: tuple[np.ndarray, np.ndarray]) -> bytes:
    """A byte of each place's least hash."""
    low, h = np.full(PLACES, 0xFFFFFFFF, np.uint32), (halves[1] >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(h), 1024):
        np.minimum(low, (h[at : at + 1024, None] * _FACTORS + _OFFSETS).min(0), out=low)
    return ((low * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def needs(least: int, miss: float = MISS) -> list[int]:
    """After each batch, the fewest agreeing places with which the posterior chance of a similarity of `least` per cent is not under its share of `miss`.

    A place agrees with chance p = s + (1 - s) / 256. With m of n agreeing and a uniform prior, p is beta distributed, and p reaches the bound's with the chance that a
    binomial variable of n + 1 draws is at most m."""
    p = least / 100 + (1 - least / 100) / 256
    out = []
    for n in range(BATCH, PLACES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss * BATCH / PLACES:
            m += 1
            tail += math.comb(n + 1, m) * p**m * (1 - p) ** (n + 1 - m)
        out.append(m)
    return out


def _survivors(p: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray, need: list[int], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs i, j of rows, those that no batch of places prunes: i, j, agreeing places."""
    keep = 100 * np.minimum(size[i], size[j]) >= least * np.maximum(size[i], size[j])
    i, j = i[keep], j[keep]
    agree = np.zeros(len(i), np.int64)
    for k, m in enumerate(need):
        part = slice(k * BATCH, (k + 1) * BATCH)
        agree = agree + (p[i, part] == p[j, part]).sum(1)
        keep = agree >= m
        i, j, agree = i[keep], j[keep], agree[keep]
    return i, j, agree


def _in_parts(begin: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs i < j within each range of rows, about _PAIRS at a time."""
    held_i, held_j, n = [], [], 0
    for b, s in zip(begin.tolist(), size.tolist(), strict=True):
        i, j = np.triu_indices(s, 1)
        held_i.append(i + b)
        held_j.append(j + b)
        n += len(i)
        if n >= _PAIRS:
            yield np.concatenate(held_i), np.concatenate(held_j)
            held_i, held_j, n = [], [], 0
    if held_i:
        yield np.concatenate(held_i), np.concatenate(held_j)


def prints_of(source: DataFrame, shingle: int) -> DataFrame:
    """source (..., text) -> (..., n_shingles, digest, places) of every row; the digest tells sets apart, and an empty set has no places."""
    import xxhash

    def run(batch):
        for b in pieces(batch):
            n, digests, places = [], [], []
            for t in b.column("text").to_pylist():
                halves = shingles(t, shingle)
                n.append(len(halves[0]))
                digests.append(xxhash.xxh3_128_digest(halves[0].tobytes() + halves[1].tobytes()))
                places.append(signature(halves) if n[-1] else None)
            yield {c: b.column(c) for c in others} | {"n_shingles": n, "digest": digests, "places": places}

    others = [c for c in source.columns if c != "text"]
    schema = [*[f for f in source.schema if f.name in others], T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("places", T.BinaryType())]
    return map_batches(source, run, T.StructType(schema))


def _groups(keyed: DataFrame, block: int) -> DataFrame:
    """keyed (key, node) -> (group, block, single, node) of nodes that share a key: of equal groups one, of more than `block` nodes in blocks (single: there is but one)."""

    def run(batches):
        def out(group, at, single, node):
            return pa.RecordBatch.from_arrays([pa.array(group.view(np.int64)), pa.array(np.broadcast_to(np.int64(at), len(node)) if np.isscalar(at) else at), pa.array(np.full(len(node), single)), pa.array(node)], names=["group", "block", "single", "node"])

        last, done = None, 0
        for (key, node), crowded in rows_by_key(batches, ["key", "node"], block):
            begin, size = edges_of(key)
            large = np.ones(len(size), bool) if crowded else size > block
            for s, n in zip(begin[large].tolist(), size[large].tolist(), strict=True):
                done, last = done if key[s] == last else 0, key[s]
                blocks = done + np.arange(n) // block
                done = int(blocks[-1]) + 1
                yield out(np.full(n, key[s]), blocks, False, node[s : s + n])
            fits = (size > 1) & ~large
            if fits.any():
                own, s = node[np.repeat(fits, size)], size[fits]
                starts = np.cumsum(s) - s
                group = _mixed(np.add.reduceat(_mixed(own.view(np.uint64)), starts) + s.astype(np.uint64))  # equal groups get equal numbers
                yield out(np.repeat(group, s), 0, True, own)

    dealt = keyed.repartition("key").sortWithinPartitions("key", "node")
    return checkpointed(dealt.mapInArrow(run, "group long, block long, single boolean, node long").distinct())


def _whole_groups(batches, keys: list[str], names: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Rows sorted by keys as arrays of whole groups, `begin` and `length` with them; places as a matrix. A batch's last group may go on in the next."""
    held: list[pa.RecordBatch] = []

    def arrays(b: pa.Table) -> dict[str, np.ndarray]:
        x = {c: b.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in names if c != "places"}
        x["places"] = np.frombuffer(b"".join(b.column("places").to_pylist()), np.uint8).reshape(-1, PLACES)
        new = np.concatenate([[True], np.logical_or.reduce([x[c][1:] != x[c][:-1] for c in keys]), [True]])
        edge = np.flatnonzero(new)
        return x | {"begin": edge[:-1], "length": np.diff(edge)}

    for batch in batches:
        if not len(batch):
            continue
        ends = np.zeros(len(batch) - 1, bool)
        for c in keys:
            v = batch.column(c).to_numpy(zero_copy_only=False)
            ends |= v[1:] != v[:-1]
        goes_on = bool(held) and all(held[-1].column(c)[-1] == batch.column(c)[0] for c in keys)
        if held and not goes_on:
            yield arrays(pa.Table.from_batches(held))
            held = []
        cut = int(np.flatnonzero(ends)[-1]) + 1 if ends.any() else 0
        if cut:
            yield arrays(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held = []
        held.append(batch.slice(cut))
    if held:
        yield arrays(pa.Table.from_batches(held))


def _forest(n: int, i: np.ndarray, j: np.ndarray, agree: np.ndarray) -> tuple[list[int], list[int]]:
    """Kruskal's forest, likest pairs first: which pairs, and each row's root."""
    root, picked = list(range(n)), []
    for k in np.argsort(-agree, kind="stable").tolist():
        a, b = int(i[k]), int(j[k])
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        if a != b:
            root[max(a, b)] = min(a, b)
            picked.append(k)
    for a in range(n):
        while root[a] != root[root[a]]:
            root[a] = root[root[a]]
    return picked, root


_KINDS = "kind int, x long, block long, y long"


def _proposed(groups: DataFrame, nodes: DataFrame, need: list[int], least: int) -> DataFrame:
    """Of each block of a group: kind 0, x-y: a spanning forest of its surviving pairs; 1, family x, block, node y: nodes that may have other links; 2, group x, node y: a large group's hub."""

    def run(batches):
        def out(kind, x, block, y):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(x), kind, np.int32)), pa.array(x), pa.array(np.broadcast_to(np.int64(block), len(x))), pa.array(y)], names=["kind", "x", "block", "y"])

        for g in _whole_groups(batches, ["group", "block"], ["group", "block", "single", "node", "n_shingles", "places"]):
            node, begin, length = g["node"], g["begin"], g["length"]
            owner = np.repeat(np.arange(len(begin)), length)
            found = [_survivors(g["places"], g["n_shingles"], i, j, need, least) for i, j in _in_parts(begin, length)]
            i, j, agree = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))
            of = owner[i]
            edges, links, families = np.searchsorted(of, np.arange(len(begin) + 1)), [], []
            for k in np.flatnonzero((np.diff(edges) > 0) | ~g["single"][begin]).tolist():
                s, n, at = int(begin[k]), int(length[k]), slice(edges[k], edges[k + 1])
                picked, root = _forest(n, i[at] - s, j[at] - s, agree[at])
                links.append(np.array(picked, np.int64) + edges[k])
                if not g["single"][s]:
                    likest = np.bincount(i[at] - s, agree[at], n) + np.bincount(j[at] - s, agree[at], n)
                    yield out(1, g["group"][s : s + n], g["block"][s], node[s : s + n])
                    yield out(2, g["group"][s : s + 1], 0, node[s + int(likest.argmax())][None])
                elif len(i[at]) > len(picked):
                    r = np.array(root)
                    extra = np.bincount(r[i[at] - s], minlength=n) > np.bincount(r, minlength=n) - 1  # of a tree, beyond its own links
                    in_family = np.flatnonzero(extra[r])
                    families.append((_mixed(g["group"][s].view(np.uint64) + node[s + r[in_family]].view(np.uint64)).view(np.int64), node[s + in_family]))
            if links and len(pick := np.concatenate(links)):
                yield out(0, np.minimum(node[i[pick]], node[j[pick]]), 0, np.maximum(node[i[pick]], node[j[pick]]))
            if families:
                yield out(1, np.concatenate([f[0] for f in families]), 0, np.concatenate([f[1] for f in families]))

    rows = groups.join(nodes.select("node", "n_shingles", "places"), "node").select("group", "block", "single", "node", "n_shingles", "places")
    return checkpointed(rows.repartition("group", "block").sortWithinPartitions("group", "block", "node").mapInArrow(run, _KINDS).distinct())


_MEETING = ["family", "block", "chunk"]


def _meetings(families: DataFrame, tree: DataFrame, chunk: int, block: int = BLOCK) -> DataFrame:
    """(family, block, chunk, out, node, part) of families whose nodes belong to different components (part) so far.

    The nodes outside of the family's largest component (out), in chunks, meet all of its nodes, in their blocks. Families of one largest component, which mostly hold the
    same nodes under other keys, are one where that takes fewer rows."""
    labelled = families.join(tree.select("node", "root"), "node", "left").select("family", "block", "node", F.coalesce("root", "node").alias("part"))
    each = labelled.groupBy("family", "part").agg(F.count("*").alias("n"), F.max("block").alias("last"))
    top = each.groupBy("family").agg(F.max_by("part", F.struct("n", "part")).alias("top"), F.count("*").alias("parts"), F.sum("n").alias("n"), (F.sum("n") - F.max("n")).alias("outside"), (F.max("last") + 1).alias("blocks"))
    top = checkpointed(top.where("parts > 1").drop("parts"))
    chunks, size = F.ceil(F.col("outside") / chunk).cast("long"), F.col("n")
    sent = size * chunks + F.col("outside") * F.col("blocks")
    members = checkpointed(labelled.join(top.select("family", "top"), "family").select("top", "node", "part").distinct())
    united = members.groupBy("top").agg(F.count("*").alias("n"), F.count_if(F.col("part") != F.col("top")).alias("outside")).withColumn("blocks", F.ceil(size / block).cast("long"))
    united = united.withColumn("sent", sent).join(top.groupBy("top").agg(F.sum(sent).alias("apart")), "top")
    united = checkpointed(united.where("sent < apart").select("top", "n", "outside", "blocks"))
    names = ["family", "block", "node", "part", "top", "outside", "blocks"]
    single = labelled.join(checkpointed(top.join(united.select("top"), "top", "left_anti")), "family").select(*names)
    one = skew_joined(members, united, "top").withColumn("family", F.xxhash64("top")).withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), "blocks")).select(*names)
    open_ = checkpointed(single.union(one).withColumn("out", F.col("part") != F.col("top")))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    inner = open_.select("family", "block", upto(chunks).alias("chunk"), F.lit(False).alias("out"), "node", "part")
    outer = open_.where("out").select("family", upto(F.col("blocks")).alias("block"), F.pmod(F.xxhash64("node"), chunks).alias("chunk"), "out", "node", "part")
    return inner.union(outer)


def _across(g: dict[str, np.ndarray], s: int, n: int, need: list[int], least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """A meeting's surviving pairs of different parts, an outer and an inner node each."""
    out = g["out"][s : s + n].astype(bool)
    ours, theirs = np.flatnonzero(out) + s, np.flatnonzero(~out) + s
    step = max(1, _PAIRS // max(1, len(theirs)))
    for at in range(0, len(ours), step):
        some = ours[at : at + step]
        i, j = np.repeat(some, len(theirs)), np.tile(theirs, len(some))
        apart = g["part"][i] != g["part"][j]
        yield _survivors(g["places"], g["n_shingles"], i[apart], j[apart], need, least)


def _crossing(meetings: DataFrame, nodes: DataFrame, need: list[int], least: int) -> DataFrame:
    """The meetings' rows that have a survivor of another part."""
    names = [*_MEETING, "out", "node", "part"]

    def run(batches):
        for g in _whole_groups(batches, _MEETING, [*names, "n_shingles", "places"]):
            hit = np.zeros(len(g["node"]), bool)
            for s, n in zip(g["begin"].tolist(), g["length"].tolist(), strict=True):
                for i, j, _ in _across(g, s, n, need, least):
                    hit[i] = hit[j] = True
            if hit.any():
                yield pa.RecordBatch.from_arrays([pa.array(g[c][hit].astype(bool) if c == "out" else g[c][hit]) for c in names], names=names)

    rows = meetings.join(nodes.select("node", "n_shingles", "places"), "node").select(*names, "n_shingles", "places")
    return checkpointed(rows.repartition(*_MEETING).sortWithinPartitions(*_MEETING, "out").mapInArrow(run, "family long, block long, chunk long, out boolean, node long, part long"))


def _joined(crossing: DataFrame, known: DataFrame, shingle: int, need: list[int], least: int) -> DataFrame:
    """(a, b): of each meeting, links that join its parts, verified on the full sets; likeliest pairs first, and none between parts that are joined already."""

    def run(batches):
        refuted: set[tuple[int, int]] = set()  # pairs that meet again under another key
        for g in _whole_groups(batches, _MEETING, [*_MEETING, "out", "node", "part", "n_shingles", "places", "text"]):
            if len(refuted) > 1 << 20:
                refuted.clear()
            for s, n in zip(g["begin"].tolist(), g["length"].tolist(), strict=True):
                found = [np.concatenate(x) for x in zip(*_across(g, s, n, need, least), strict=True)] or [np.zeros(0, np.int64)] * 3
                top = {p: p for p in g["part"][s : s + n].tolist()}
                sets: dict[int, set] = {}
                links = []
                for k in np.argsort(-found[2], kind="stable").tolist():
                    i, j = int(found[0][k]), int(found[1][k])
                    x, y = int(g["part"][i]), int(g["part"][j])
                    while top[x] != x:
                        x = top[x]
                    while top[y] != y:
                        y = top[y]
                    pair = (int(g["node"][i]), int(g["node"][j]))
                    if x != y and pair not in refuted:
                        for r in (i, j):
                            if r not in sets:
                                sets[r] = _word_set(g["text"][r], shingle)
                        if _is_link(sets[i], sets[j], least):
                            top[x] = y
                            links.append(pair)
                        else:
                            refuted.add(pair)
                if links:
                    a, b = zip(*links, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    rows = crossing.join(known, "node").select(*_MEETING, "out", "node", "part", "n_shingles", "places", "text")
    return checkpointed(rows.repartition(*_MEETING).sortWithinPartitions(*_MEETING, "out").mapInArrow(run, "a long, b long"))


def _texts_of(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """wanted (id, node, digest, n_shingles, places) -> (node, n_shingles, places, text): each node with a text, id its doc_id (-1 without one).

    Only rows of wanted ids (and a few by chance) leave the scan."""
    import xxhash

    key = F.coalesce("doc_id", F.lit(-1).cast("long"))
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(wanted.select("id")))

    def held(batch):
        for b in pieces(batch):
            hit = passes(b.column("id").to_numpy().view(np.uint64), np.frombuffer(bits.value, np.uint8))
            part = b.filter(pa.array(hit))
            yield {"id": part.column("id"), "text": part.column("text")}

    def own(batch):
        for b in pieces(batch):
            same = []
            for t, d in zip(b.column("text").to_pylist(), b.column("digest").to_pylist(), strict=True):
                x, y = shingles(t, shingle)
                same.append(xxhash.xxh3_128_digest(x.tobytes() + y.tobytes()) == d)
            part = b.filter(pa.array(same, pa.bool_()))
            yield {c: part.column(c) for c in ("node", "n_shingles", "places", "text")}

    found = map_batches(texts(docs).where("text IS NOT NULL").select(key.alias("id"), "text"), held, "id long, text string").join(wanted, "id")
    rows = found.select("node", "n_shingles", "places", "text", "digest")
    return checkpointed(map_batches(rows, own, "node long, n_shingles long, places binary, text string").dropDuplicates(["node"]))


def _word_set(text: str, shingle: int) -> set:
    w = words_of(text)
    size = min(shingle, len(w))
    return set(map(b" ".join, zip(*(w[k:] for k in range(size)), strict=False)))


def _is_link(one: set, two: set, least: int) -> bool:
    both = len(one & two)
    return 100 * both >= least * (len(one) + len(two) - both)


def _linked(pairs: DataFrame, known: DataFrame, shingle: int, least: int) -> DataFrame:
    """The pairs (a, b) whose full sets, of words, are as similar as a link asks for."""

    def run(batches):
        last, one = None, set()
        for batch in batches:
            hit = []
            for a, s, t in zip(batch.column("a").to_pylist(), batch.column("s"), batch.column("t"), strict=True):
                if a != last:
                    last, one = a, _word_set(s.as_py(), shingle)
                hit.append(_is_link(one, _word_set(t.as_py(), shingle), least))
            yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    text = lambda c, t: known.select(F.col("node").alias(c), F.col("text").alias(t))
    rows = pairs.join(text("b", "t"), "b").join(text("a", "s"), "a").select("a", "b", "s", "t")
    return checkpointed(rows.mapInArrow(run, "a long, b long"))


def joined_sets(docs: DataFrame, nodes: DataFrame, keys: list[Column], shingle: int, least: int, miss: float, block: int) -> DataFrame:
    """(node, root): the components of nodes whose sets are `least` per cent similar, of those that share a key; nodes without a link don't appear.

    nodes: (node, id, digest, n_shingles, places), a row for each different set that isn't empty, id the doc_id (-1 without one) of a text of it."""
    need = needs(least, miss)
    groups = _groups(nodes.select(F.explode(F.array(*keys)).alias("key"), "node"), block)
    found = _proposed(groups, nodes, need, least)
    pairs, families, hubs = found.where("kind = 0").select(F.col("x").alias("a"), F.col("y").alias("b")), found.where("kind = 1").select(F.col("x").alias("family"), "block", F.col("y").alias("node")), found.where("kind = 2")
    while not hubs.isEmpty():  # a level joins `block` times as many blocks
        level = _proposed(_groups(hubs.select(F.col("x").alias("key"), F.col("y").alias("node")), block), nodes, need, least)
        pairs, hubs = pairs.union(level.where("kind = 0").select("x", "y")), level.where("kind = 2")
    pairs = checkpointed(pairs.distinct())
    reached = pairs.select(F.explode(F.array("a", "b")).alias("node")).union(families.select("node")).distinct()
    known = _texts_of(docs, checkpointed(nodes.select("id", "node", "digest", "n_shingles", "places").join(reached, "node")), shingle)
    links = _linked(pairs, known, shingle, least)
    tree = checkpointed(components(links))
    crossing = _crossing(_meetings(families, tree, block // 2 or 1, block), nodes, need, least)
    more = _joined(crossing, known, shingle, need, least)
    return tree if more.isEmpty() else checkpointed(components(links.union(more)))
