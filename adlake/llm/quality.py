"""Operator 7: quality by nearest-neighbour voting in a latent-semantic space.

Features of a whole text: its words (lower-cased, hashed into 2^14 bins), trigrams over 32 character shapes (letters fold to two,
symbols stay apart), logarithmic counts times inverse document frequency, and the share of its five-word windows that repeat, as three of its
own. A bounded sample of labelled rows (`sample`, those of the smallest mixed doc_id) is a sparse matrix of such features (its numbers lie in the
driver's memory once, by rows and by columns); a randomized truncated SVD reduces it to `rank` dimensions, the latent-semantic space. Those vectors
and labels, at most sample x rank numbers, are broadcast. Every document's exact cosines with all of them come from blocked matrix
products, and its `neighbours` nearest vote with the square of their similarity, next to one vote of the sample's base rate.

Cases: null and empty texts have no features, no similarity to anything, and score the base rate; labels that contradict each other
for a doc_id count as their mean, rounded; without labels, or with one kind of label only, the score is the base rate (0.5 if none);
equal texts score alike; an empty table gives no rows; other columns are ignored (`keep` passes them on).
"""

from __future__ import annotations

from collections import Counter
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_held_out, kept_rows, map_batches, pieces, texts

#: Fixed values of the contract: the folds of doc_id's crc32, the one held out, the threshold.
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
RESULT = "doc_id long, held_out boolean, score double, predicted int"
_SYMBOLS = b" \n.,;:!?-'\"()/|#*$%&<>=+@_"
_SHAPES = np.full(256, 30, np.uint16)
for _k, _c in enumerate(_SYMBOLS):
    _SHAPES[_c] = _k + 4
_SHAPES[97:123] = 0
_SHAPES[128:] = 0
_SHAPES[65:91] = 1
_SHAPES[48:58] = 2
WORD_BINS, WORD_WEIGHT = 1 << 14, 0.5
BINS = 32**3 + 3 + WORD_BINS


def features(b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the batch, bin, weight) of an Arrow batch's texts; rows ascend."""
    rows, bins, weights = [], [], []
    for k, t in enumerate(b.column("text").to_pylist()):
        if not t:
            continue
        raw = t.encode("utf-8", "surrogatepass")
        s = _SHAPES[np.frombuffer(raw, np.uint8)]
        if len(s) >= 3:
            n = np.bincount((s[:-2] << 10) + (s[1:-1] << 5) + s[2:], minlength=32**3)
            at = np.flatnonzero(n)
            rows.append(np.full(len(at), k))
            bins.append(at)
            weights.append(np.log1p(n[at] * (1000.0 / len(s))))
        w = raw.split()
        if w:
            seen = Counter(raw.lower().split())
            rows.append(np.full(len(seen), k))
            bins.append(np.fromiter((32**3 + 3 + crc32(x) % WORD_BINS for x in seen), np.int64, len(seen)))
            weights.append(WORD_WEIGHT * np.log1p(np.fromiter(seen.values(), float, len(seen)) * (100.0 / len(w))))
        if len(w) > 5:
            grams = list(map(hash, zip(w, w[1:], w[2:], w[3:], w[4:], strict=False)))
            share = 1 - len(set(grams)) / len(grams)
            level = [x for x in range(3) if share > (0.4, 0.6, 0.8)[x]]
            rows.append(np.full(len(level), k))
            bins.append(np.array([32**3 + x for x in level], np.int64))
            weights.append(np.full(len(level), 6.0))
    if not rows:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
    return np.concatenate(rows), np.concatenate(bins), np.concatenate(weights)


def embed(n: int, rows, bins, weights, basis: np.ndarray) -> np.ndarray:
    """n unit vectors (zero for a text without known features)."""
    out = np.zeros((n, basis.shape[1]), np.float32)
    if len(rows):
        start = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        out[rows[start]] = np.add.reduceat(basis[bins] * weights[:, None].astype(np.float32), start, axis=0)
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, size, out=out, where=size > 0)


def _sums(index: np.ndarray, size: int, values: np.ndarray, from_: np.ndarray, x: np.ndarray, step: int = 50_000) -> np.ndarray:
    """A sparse matrix (entries in the order of `index`, its row numbers; `from_`, its column numbers) times x, some entries at a time."""
    out = np.zeros((size, x.shape[1]), np.float32)
    for at in range(0, len(index), step):
        i = index[at : at + step]
        edge = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))
        out[i[edge]] += np.add.reduceat(x[from_[at : at + step]] * values[at : at + step, None], edge, axis=0)
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = 3000, rank: int = 48) -> dict:
    """The broadcast model, from at most `sample` labelled rows outside the held-out fold."""
    doc_id = F.col("doc_id").cast("long")
    rows = labels.where("quality is not null and doc_id is not null").groupBy(doc_id.alias("doc_id")).agg(F.bround(F.avg("quality")).cast("int").alias("label"))
    rows = rows.where(~is_held_out(F.col("doc_id"), FOLDS, HELD_OUT))
    ids = docs.select(doc_id.alias("doc_id")).where("doc_id is not null")
    chosen = rows.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    known = {r.doc_id: r.label for r in chosen.collect()}  # at most `sample` rows
    small = docs.sparkSession.createDataFrame(list(known.items()) or [], "doc_id long, label int").select("doc_id")

    def run(batch):
        for b in pieces(batch):
            r, i, w = features(b)
            order = np.lexsort((i, r))
            r, i, w = r[order], i[order].astype(np.int32), w[order].astype(np.float32)
            at = np.searchsorted(r, np.arange(b.num_rows + 1))
            parts = list(zip(at, at[1:], strict=False))
            yield {"doc_id": b.column("doc_id"), "bins": [i[x:y].tobytes() for x, y in parts], "weights": [w[x:y].tobytes() for x, y in parts]}

    got = map_batches(texts(docs).join(F.broadcast(small), "doc_id", "left_semi"), run, "doc_id long, bins binary, weights binary").collect()
    got = sorted({r.doc_id: r for r in got}.values(), key=lambda r: r.doc_id)
    label = np.array([known[r.doc_id] for r in got], np.float32)
    base = float(label.mean()) if len(label) else 0.5
    col = np.frombuffer(b"".join(r.bins for r in got), np.int32)
    basis = np.zeros((BINS, rank), np.float32)
    if not len(col) or label.min() == label.max():
        return {"basis": basis, "vectors": np.zeros((1, rank), np.float32), "label": np.array([base], np.float32), "base": base}
    value = np.frombuffer(b"".join(r.weights for r in got), np.float32)
    row = np.repeat(np.arange(len(got), dtype=np.int32), [len(r.bins) // 4 for r in got])
    idf = (np.log((1 + len(got)) / (1 + np.bincount(col, minlength=BINS))) + 0.05).astype(np.float32)
    value = value * idf[col]
    turn = np.argsort(col, kind="stable")
    by_row = lambda x: _sums(row, len(got), value, col, x)
    by_col = lambda x: _sums(col[turn], BINS, value[turn], row[turn], x)
    start = np.random.default_rng(7).standard_normal((BINS, min(rank + 8, len(got)))).astype(np.float32)
    q = np.linalg.qr(by_row(start))[0]
    for _ in range(3):
        q = np.linalg.qr(by_row(by_col(q)))[0]
    v = np.linalg.svd(by_col(q).T, full_matrices=False)[2][:rank].T
    basis[:, : v.shape[1]] = idf[:, None] * v
    vectors = np.concatenate([embed(1, np.zeros(len(r.bins) // 4, np.int64), np.frombuffer(r.bins, np.int32), np.frombuffer(r.weights, np.float32), basis) for r in got])
    return {"basis": basis, "vectors": vectors, "label": label, "base": base}


def votes(b, model: dict, neighbours: int) -> np.ndarray:
    """Scores of a batch, its cosines taken block by block."""
    x = embed(b.num_rows, *features(b), model["basis"])
    refs, label = model["vectors"], model["label"]
    k = min(neighbours, len(label))
    out = np.empty(b.num_rows)
    for at in range(0, len(x), 512):
        cos = x[at : at + 512] @ refs.T
        near = np.argpartition(cos, len(label) - k, axis=1)[:, len(label) - k :]
        w = np.maximum(np.take_along_axis(cos, near, 1), 0).astype(float) ** 2
        out[at : at + 512] = ((w * label[near]).sum(1) + model["base"]) / (w.sum(1) + 1)
    return np.clip(out, 0, 1)


def classify(docs: DataFrame, labels: DataFrame, sample: int = 3000, rank: int = 48, neighbours: int = 25) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample, rank))

    def run(batch):
        for b in pieces(batch):
            s = votes(b, shared.value, neighbours)
            yield {"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "score": s.tolist(), "predicted": (s >= THRESHOLD).astype(int).tolist()}

    return map_batches(texts(docs).withColumn("held_out", F.coalesce(is_held_out(F.col("doc_id"), FOLDS, HELD_OUT), F.lit(False))), run, RESULT)


def keep(docs: DataFrame, labels: DataFrame, sample: int = 3000, rank: int = 48, neighbours: int = 25) -> DataFrame:
    """docs without those the vote rejects, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample, rank))

    return kept_rows(docs, lambda b: votes(b, shared.value, neighbours) >= THRESHOLD)
