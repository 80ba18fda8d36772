"""Operator 10: language identification by multilingual mixture inference.

Letter trigrams (with word edges) of a bounded sample of documents, about `per_language` of each, give every language a smoothed
distribution over 2^16 hashed trigrams. A document is a mixture of them: expectation-maximisation estimates its proportions from the
trigrams' likelihoods, for a whole batch of documents at once; languages under `least_share` are dropped. From the set that is left the language of
the smallest proportion goes, one after another, with proportions estimated again each time, down to the single best language; of
these sets the one of the largest likelihood after a penalty of log(trigrams) for every further language is chosen. lang_pred is its largest
language, score that one's proportion, languages and shares the whole set, largest first.

Cases: null texts and texts without a letter are `und` with score 0; without anything to learn from, all are; a text of a single
letter has its trigrams with edges; ties go to the first language by name; equal texts score alike; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_held_out, map_batches, pieces, texts

#: Fixed values of the contract: the folds of doc_id's crc32, the one held out, the answer without letters.
FOLDS, HELD_OUT, UNKNOWN = 4, 2, "und"
RESULT = "doc_id long, held_out boolean, lang_pred string, score double, languages array<string>, shares array<double>"
BINS = 1 << 16
_TOP = 0x110000
_mask: list = []


def _letters() -> np.ndarray:
    if not _mask:
        _mask.append(np.fromiter((chr(k).isalpha() for k in range(_TOP)), bool, _TOP))
    return _mask[0]


def trigrams(text: str | None) -> np.ndarray:
    """Hashed trigrams of the letters, words set off by single spaces; none if there is no letter."""
    if not text:
        return np.zeros(0, np.uint16)
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[np.minimum(cp, _TOP - 1)]
    if not letter.any():
        return np.zeros(0, np.uint16)
    held = letter.copy()
    held[1:] |= letter[:-1]  # the first other character after a letter stands for the space
    c = np.where(letter, cp, 32)[held]
    c = np.concatenate([[32], c, [32]]).astype(np.uint32)
    h = c[:-2] * np.uint32(0x9E3779B1) ^ c[1:-1] * np.uint32(0x85EBCA6B) ^ c[2:] * np.uint32(0xC2B2AE35)
    return ((h ^ (h >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> np.uint32(16)).astype(np.uint16)


def fit(docs: DataFrame, per_language: int = 2000) -> tuple[list[str], np.ndarray]:
    """(languages, likelihood of each trigram in each): at most languages x 2^16 counts come to the driver."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where("lang is not null and doc_id is not null and text is not null").where(~is_held_out(F.col("doc_id"), FOLDS, HELD_OUT))
    share = {r.lang: min(1.0, per_language / r.n) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not share:
        return [], np.zeros((BINS, 0), np.float32)
    names = sorted(share)
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    picked = rows.where(spread < F.create_map(*[F.lit(x) for k in names for x in (k, share[k])])[F.col("lang")])

    def run(batches):
        import pyarrow as pa

        total = {k: np.zeros(BINS, np.int64) for k in names}
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                total[lang] += np.bincount(trigrams(text), minlength=BINS)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "bin", "n"])

    got = picked.select("lang", "text").mapInArrow(run, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((BINS, len(names)))
    counts[got["bin"].to_numpy(int), got["lang"].map({k: i for i, k in enumerate(names)}).to_numpy(int)] = got["n"].to_numpy(float)
    # a share of all languages' mean keeps unseen trigrams possible
    own = counts / np.maximum(counts.sum(0), 1)
    return names, (0.97 * own + 0.02 * own.mean(1, keepdims=True) + 0.01 / BINS).astype(np.float32)


def _mixture(p: np.ndarray, times: np.ndarray, start: np.ndarray, count: np.ndarray, share: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log-likelihood) of each document after EM steps. p: likelihoods of all documents' different trigrams, one document
    after another; times: how often each occurs; start, count: each document's part."""
    size = np.add.reduceat(times, start)[:, None]
    for step in range(steps + 1):
        w = p * np.repeat(share, count, axis=0)
        total = w.sum(1)
        if step == steps:
            return share, np.add.reduceat(times * np.log(total, dtype=np.float64), start)
        share = np.add.reduceat(w * (times / total)[:, None], start, axis=0) / size


def infer(batch_texts: list, model: np.ndarray, least_share: float = 0.1, steps: int = 8) -> np.ndarray:
    """Each text's proportions of the languages of its chosen set, 0 for the others; all 0 for a text without letters."""
    grams, n = [trigrams(t) for t in batch_texts], model.shape[1]
    out = np.zeros((len(grams), n))
    held = np.array([k for k, g in enumerate(grams) if len(g)], np.int64)
    if not len(held) or not n:
        return out
    sizes = np.array([len(grams[k]) for k in held], np.int64)
    key, times = np.unique(np.repeat(np.arange(len(held), dtype=np.uint64) << np.uint64(16), sizes) | np.concatenate([grams[k] for k in held]), return_counts=True)
    count = np.bincount((key >> np.uint64(16)).astype(np.int64), minlength=len(held))
    start, times = np.cumsum(count) - count, times.astype(np.float32)
    p = model[(key & np.uint64(0xFFFF)).astype(np.int64)]
    share, _ = _mixture(p, times, start, count, np.full((len(held), n), 1.0 / n, np.float32), steps)
    own = np.add.reduceat(times[:, None] * np.log(p), start, axis=0, dtype=np.float64)
    one = own.argmax(1)
    best, chosen = own.max(1), np.zeros((len(held), n))
    chosen[np.arange(len(held)), one] = share[np.arange(len(held)), one]
    kept = share >= np.minimum(least_share, share.max(1, keepdims=True))
    while len(several := np.flatnonzero(kept.sum(1) > 1)):
        sub = np.concatenate([np.arange(start[k], start[k] + count[k]) for k in several])
        again = np.where(kept[several], share[several], 0)
        again /= again.sum(1, keepdims=True)
        c = count[several]
        again, like = _mixture(p[sub], times[sub], np.cumsum(c) - c, c, again.astype(np.float32), 4)
        like = like - (kept[several].sum(1) - 1) * np.log(sizes[several])
        better = like > best[several]
        best[several[better]], chosen[several[better]] = like[better], again[better]
        share[several] = again
        # the smallest goes; sets of one are done, as the single best language is known
        kept[several, np.where(kept[several], again, np.inf).argmin(1)] = False
    out[held] = np.clip(chosen, 0, 1)
    return out


def identify(docs: DataFrame, per_language: int = 2000) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, per_language))

    def run(batch):
        names, model = shared.value
        for b in pieces(batch, most_bytes=max(1 << 18, (8 << 20) // max(4, len(names)))):
            share = infer(b.column("text").to_pylist(), model)
            order = np.argsort(-share, axis=1, kind="stable")
            sets = [[k for k in row.tolist() if v[k] > 0] for row, v in zip(order, share, strict=True)]
            yield {
                "doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "lang_pred": [names[k[0]] if k else UNKNOWN for k in sets], "score": [float(v[k[0]]) if k else 0.0 for k, v in zip(sets, share, strict=True)],
                "languages": [[names[j] for j in k] for k in sets], "shares": [[float(v[j]) for j in k] for k, v in zip(sets, share, strict=True)],
            }

    return map_batches(texts(docs).withColumn("held_out", F.coalesce(is_held_out(F.col("doc_id"), FOLDS, HELD_OUT), F.lit(False))), run, RESULT)
