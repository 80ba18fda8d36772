"""Operator 3: near-duplicates by deletion-variant signatures.

A signature is cut into few enough segments that one of them differs in at most one place; each segment is indexed under its
variants with one place deleted (a wildcard), so such a pair meets under an equal key; equality of keys brings pairs together and whole
signatures are verified.

`near_duplicates` links 64-bit SimHash fingerprints at most 3 bits apart: 2 segments of 32 bits, 64 variants. Only distinct fingerprints are
indexed: exact copies, however many, are one row. (key, fingerprint) is shuffled once a level; the task that finds a key's rows side by
side drops single ones, unites what it verifies and sends a tree of links, and hands on the rows of a key that holds more than `bucket`. Those agree
on 31 bits of one segment, so the other segment's two 16-bit halves are indexed in the same way (one of them differs by at most one bit),
and once more with 8-bit halves; then about 2^11 different fingerprints at most can share a key, whatever the corpus. Every level is exact,
so links don't depend on `bucket`. For up to 5 bits there are 3 segments, and so on. Components come from contraction (graph.py).

`representatives`, the pipeline's stage, keeps one document of each group of five-word similarity (Jaccard) 0.8 or more. Two such texts
differ in some 10 of 64 SimHash bits, where a 32-bit segment agrees but for a bit in 3.5 % of pairs only; so there the signature's places are
not majority bits but minima of hashes (a place agrees with the similarity's chance), and the deletion variants are those of ten segments of eight places, which
99.9 % of the pairs at 0.8 share. Candidates are pruned by their signatures and every link is verified on the full sets (sets.py), whatever a key's size.

Cases: null, empty and blank texts have fingerprint zero and link like any other; fewer words than a shingle are one shingle;
equal rows share a component; an empty table gives no rows; other columns are ignored (`representatives` keeps them). Different texts under
one doc_id are rows of their own: the lesser hash of the row counts as the smaller; rows without a doc_id come last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, map_batches, pieces, skew_joined, texts
from .graph import components
from .sets import BLOCK, MISS, edges_of, joined_sets, prints_of, rows_by_key, words_of

#: Fixed values of the contract: the hash's seed, words in a shingle there, differing bits that link.
SEED, SHINGLE, BITS = 42, 3, 3
#: The pipeline's near-duplicate stage: words in a shingle, similarity (per cent), segments and places in a segment.
STAGE_SHINGLE, SIMILAR, SEGMENTS, WIDTH = 5, 80, 10, 8
_SEGMENT_BITS = 3  # of a key, its lowest: the number of the segment


def _hashes(w: list[bytes], shingle: int) -> Iterator[np.ndarray]:
    """The hashes of the words' shingles, a block at a time."""
    import xxhash

    size = min(shingle, len(w))
    n, digest = len(w) - size + 1, xxhash.xxh64_digest
    for at in range(0, n if w else 0, 16_384):
        part = w[at : min(at + 16_384, n) + size - 1]
        yield np.frombuffer(b"".join([digest(x, SEED) for x in map(b" ".join, zip(*(part[k:] for k in range(size)), strict=False))]), ">u8")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit by bit the majority of the shingles' XXH64 hashes, over the whole text."""
    votes, n = np.zeros(64, np.int64), 0
    for h in _hashes(words_of(text), shingle):
        votes += np.unpackbits(h.view(np.uint8).reshape(len(h), 8), axis=1).sum(0, dtype=np.int32)
        n += len(h)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def _variants(df: DataFrame, bits: int, parts: int) -> DataFrame:
    """(key, node[, rest]) of every one-wildcard variant of every segment of rest, `bits` bits that earlier cuts have not fixed (without rest: node).

    A variant's key hashes the key it refines, the deleted place and the segment without it; its lowest bits are the segment's number.
    """
    edges = [bits * k // parts for k in range(parts + 1)]
    rest, out = F.col("rest" if "rest" in df.columns else "node"), []
    for j, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
        segment = F.shiftrightunsigned(rest, lo).bitwiseAND((1 << (hi - lo)) - 1)
        for k in range(hi - lo):
            key = F.xxhash64("key", F.lit(j), F.lit(k), segment.bitwiseAND(((1 << (hi - lo)) - 1) & ~(1 << k)))
            out.append(key.bitwiseAND(-1 << _SEGMENT_BITS).bitwiseOR(j))
    return df.select(F.explode(F.array(*out)).alias("key"), *[c for c in df.columns if c != "key"])


def _left(rows: DataFrame, bits: int, parts: int) -> tuple[DataFrame, int]:
    """Crowded rows with the bits that their key's segment doesn't hold, and how many these are at most."""
    edges = [bits * k // parts for k in range(parts + 1)]
    rest, j, out = F.col("rest"), F.col("key").bitwiseAND((1 << _SEGMENT_BITS) - 1), None
    for k, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
        above = F.shiftleft(F.shiftrightunsigned(rest, hi), lo) if hi < 64 else F.lit(0).cast("long")
        now = above.bitwiseOR(rest.bitwiseAND((1 << lo) - 1))
        out = F.when(j == k, now) if out is None else out.when(j == k, now)
    return rows.select("key", "node", out.alias("rest")), bits - min(y - x for x, y in zip(edges, edges[1:], strict=False))


def _united(n: int, near) -> tuple[list[int], list[int]]:
    """Links that span the components of n rows: near(i, rows) tells which are near row i; each is compared with those that no link has reached yet."""
    left, a, b = np.arange(n), [], []
    while len(left):
        reached, left = [int(left[0])], left[1:]
        while reached and len(left):
            i = reached.pop()
            is_near = near(i, left)
            if is_near.any():
                hit = left[is_near].tolist()
                a += [i] * len(hit)
                b += hit
                reached += hit
                left = left[~is_near]
    return a, b


def _level(variants: DataFrame, most: int, bucket: int | None) -> DataFrame:
    """variants (key, node[, rest]) -> (crowded, a, b, rest): the verified links a-b of each key, a spanning tree, or for one of more than `bucket` rows those, as key, node, rest."""
    names = variants.columns

    def run(batches):
        import pyarrow as pa

        def out(crowded: bool, a: np.ndarray, b: np.ndarray, rest: np.ndarray):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), crowded)), pa.array(a), pa.array(b), pa.array(rest)], names=["crowded", "a", "b", "rest"])

        for columns, crowded in rows_by_key(batches, names, bucket):
            key, node, rest = columns[0], columns[1], columns[-1]
            if crowded:
                yield out(True, key, node, rest)
                continue
            begin, size = edges_of(key)
            fp = node.view(np.uint64)
            two = begin[size == 2]  # most keys that hold more than one hold two
            two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= most]
            a, b = [node[two]], [node[two + 1]]
            more = size > 2 if bucket is None else (size > 2) & (size <= bucket)
            for s, n in zip(begin[more].tolist(), size[more].tolist(), strict=True):
                f = fp[s : s + n]
                x, y = _united(n, lambda i, left, f=f: np.bitwise_count(f[left] ^ f[i]) <= most)
                a.append(node[s : s + n][x])
                b.append(node[s : s + n][y])
            a, b = np.concatenate(a), np.concatenate(b)
            if len(a):
                yield out(False, a, b, np.zeros(len(a), np.int64))
            if bucket is not None and (size > bucket).any():
                over = np.repeat(size > bucket, size)
                yield out(True, key[over], node[over], rest[over])

    return checkpointed(variants.repartition("key").sortWithinPartitions("key", "node").mapInArrow(run, "crowded boolean, a long, b long, rest long"))


def links(nodes: DataFrame, most: int = BITS, bucket: int = 256, depth: int = 3) -> DataFrame:
    """nodes (node long: a fingerprint, each once) -> (a, b) links that span the components of fingerprints at most `most` bits apart."""
    parts, bits, out = most // 2 + 1, 64, None
    rows = nodes.select(F.lit(0).cast("long").alias("key"), "node")
    for level in range(depth):
        found = _level(_variants(rows, bits, parts), most, bucket if level < depth - 1 else None)
        tree = found.where("not crowded").select("a", "b")
        out = tree if out is None else out.union(tree)
        crowded = found.where("crowded").select(F.col("a").alias("key"), F.col("b").alias("node"), "rest")
        if level == depth - 1 or crowded.isEmpty():
            break
        rows, bits = _left(crowded, bits, parts)
    return out.distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most: int = BITS, bucket: int = 256) -> DataFrame:
    """(doc_id, fingerprint, component_id): 16 hex digits, and the smallest doc_id that links reach."""

    def run(batch):
        for b in pieces(batch):
            f = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield {"doc_id": b.column("doc_id"), "node": f.tolist()}

    prints = checkpointed(map_batches(texts(docs), run, "doc_id long, node long"))
    groups = checkpointed(prints.groupBy("node").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    tree = checkpointed(components(links(groups.select("node"), most, bucket)))
    linked = tree.join(groups, "node")
    lowest = linked.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("n"))
    moved = skew_joined(linked.select("root", "node"), checkpointed(lowest), "root").select("node", F.col("component_id").alias("lower"))
    named = checkpointed(groups.join(moved, "node", "left").select("node", F.coalesce("lower", "first").alias("component_id"), "n"))
    return skew_joined(prints, named, "node").select("doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")


def _free(docs: DataFrame, name: str) -> str:
    """A name that no column of docs has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _identified(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """docs with two more columns, and their names: doc_id (-1 without one) and a hash of all columns; together they tell rows apart, but for equal ones."""
    own, row, mark = _free(docs, "id__"), _free(docs, "row__"), F.lit("\x00")
    columns = [F.coalesce(F.col(_quoted(c)).cast("string"), mark) for c in docs.columns]
    return docs.select("*", F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long")).alias(own), F.xxhash64(*columns).alias(row)), own, row


def _quoted(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def similar(docs: DataFrame, shingle: int = STAGE_SHINGLE, least: int = SIMILAR, miss: float = MISS, block: int = BLOCK) -> DataFrame:
    """(id, row) of the rows that are the first of their group, by doc_id (rows without one last) and then by hash; equal rows are one."""
    marked, own, row = _identified(docs)
    source = marked.select(F.col("doc_id").isNull().alias("last"), F.col(own).alias("id"), F.col(row).alias("row"), F.col("text").cast("string").alias("text"))
    prints = checkpointed(prints_of(source, shingle))
    sets = prints.groupBy("digest").agg(F.min(F.struct("last", "id", "row")).alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("places").alias("places"))
    # written once, so a node keeps its number
    nodes = checkpointed(sets.withColumn("node", F.monotonically_increasing_id()).withColumn("id", F.col("first.id")))
    keys = []
    for j in range(SEGMENTS):
        for k in range(WIDTH):
            before, after = F.substring("places", WIDTH * j + 1, k), F.substring("places", WIDTH * j + k + 2, WIDTH - 1 - k)
            keys.append(F.xxhash64(F.lit(j * WIDTH + k), before, after))
    tree = joined_sets(docs, nodes.where("n_shingles > 0"), keys, shingle, least, miss, block)
    linked = tree.join(nodes.select("node", "first"), "node")
    lowest = linked.groupBy("root").agg(F.min("first").alias("lowest"), F.count("*").alias("n"))
    later = skew_joined(linked.select("root", "node", "first"), checkpointed(lowest), "root").where("first <> lowest").select("node")
    return nodes.join(later, "node", "left_anti").select("first.id", "first.row")


def representatives(docs: DataFrame, shingle: int = STAGE_SHINGLE, least: int = SIMILAR, miss: float = MISS, block: int = BLOCK) -> DataFrame:
    """docs with one row of each group of similar texts."""
    first = checkpointed(similar(docs, shingle, least, miss, block))
    marked, own, row = _identified(docs)
    kept = marked.join(first.select(F.col("id").alias(own), F.col("row").alias(row)), [own, row], "left_semi")
    return kept.dropDuplicates([own, row]).drop(own, row)
