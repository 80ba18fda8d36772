"""Operator 5: toxicity by a subsequence string-kernel support vector machine with Nyström landmarks, trained on labelled sentences.

The kernel counts the letter triples two strings share as subsequences, each triple weighted by `decay` for every letter it
skips (spans up to `SPAN`), so a gapped or padded insult keeps most of its likeness. Its strings are windows of up to `WINDOW`
letters of a token, with the token's ends as letters of their own; each is scaled by the norm of a string of its length. Letters of the Latin
script are folded (case, accents, common look-alikes), letters of all others are hashed into the same alphabet of 31; other characters inside
a token are dropped, and single letters spaced out join up.

A sentence's image is the sum of its windows', over the root of their number. Sentences of a bounded sample of labelled documents take their
document's label; as not every sentence of a toxic document is toxic, the machine is fitted again with those of its sentences only
that pass nearly all clean ones, or are the document's worst. Landmarks are words that tell the labels apart (log-likelihood ratio) and
differ, and frequent ones; the machine is linear in the Nyström features K_mm^-1/2 k(x). As the kernel is an inner product over
triples, the fitted machine folds into one table of 32^3 weights, and each window of a whole text is scored exactly by array look-ups.

A document's score pools its windows: how many pass each of a few levels (quantiles of the clean sample), their share, and the worst; a
logistic regression fitted on the sample, weighted to the labels' base rate, makes them a probability.

Cases: null, empty and letterless texts have no window and get the score of no finding; contradicting labels for a doc_id count as
their mean, rounded; without labels, or with one kind only, all scores are the base rate (0.5 if none), kept under 0.5 when no row is
toxic; equal texts score alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, is_held_out, map_batches, pieces, texts

#: Fixed values of the contract: the folds of doc_id's crc32, the one held out, the threshold.
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.5
RESULT = "doc_id long, held_out boolean, score double, predicted int"
WINDOW, SPAN, LETTERS, DECAY = 10, 5, 32, 0.5
EDGE = LETTERS - 1  # a token's end
#: Shares of the clean sample's windows below each level that the pooling counts.
LEVELS = (0.98, 0.995, 0.999, 0.9998)
#: Characters that stand in for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "@": "a", "$": "s", "!": "i"}
_STOPS = ".!?\n|。！？؟।"


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its letter's number from 1 on, or 0; and 1 for white space, 2 for what ends a sentence."""
    code, kind = np.zeros(0x110000, np.int8), np.zeros(0x110000, np.int8)
    for k in range(0x110000):
        c = chr(k)
        if c in _STOPS:
            kind[k] = 2
        elif c.isspace():
            kind[k] = 1
        elif c.isalpha():
            base = unicodedata.normalize("NFD", c.lower())[0]
            base = {"ß": "s", "æ": "a", "ø": "o", "œ": "o"}.get(base, base)
            code[k] = ord(base) - 96 if "a" <= base <= "z" else 1 + (ord(base) * 0x9E3779B1 >> 16) % (LETTERS - 1)
    return code, kind


_tables: list = []


def _alphabet() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters, letters with look-alikes, kinds), built once in each process that scores."""
    if not _tables:
        code, kind = _letters()
        folded = code.copy()
        for a, b in LOOKALIKES.items():
            folded[ord(a)] = ord(b) - 96
        _tables.extend((code, folded, kind))
    return _tables[0], _tables[1], _tables[2]


def stream(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters, with EDGE at both ends of each token; token of each; sentence of each). A look-alike counts only beside a letter."""
    letters, folded, kinds = _alphabet()
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    plain, kind = letters[cp], kinds[cp]
    is_letter = plain > 0
    beside = np.zeros(len(cp), bool)
    beside[1:] |= is_letter[:-1]
    beside[:-1] |= is_letter[1:]
    code = np.where(beside, folded[cp], plain)
    token, sentence = np.cumsum(kind > 0), np.cumsum((kind == 2) & ~((code > 0) & beside))
    held = code > 0
    code, token, sentence = code[held].astype(np.int32) - 1, token[held], sentence[held]
    if not len(code):
        return code, token, sentence
    # single letters in a row become one token
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    size = np.diff(np.concatenate([first, [len(code)]]))
    single = size == 1
    begins = np.ones(len(first), bool)
    begins[1:] = ~(single[1:] & single[:-1])
    starts = first[begins]
    size = np.diff(np.concatenate([starts, [len(code)]]))
    at = np.arange(len(code)) + 1 + 2 * np.repeat(np.arange(len(starts)), size)  # places once the ends are put in
    out = np.full(len(code) + 2 * len(starts), EDGE, np.int32)
    out[at] = code
    return out, np.repeat(np.arange(len(starts)), size + 2), np.repeat(sentence[starts], size + 2)


def _norms() -> np.ndarray:
    """The kernel norm of a string of n letters whose triples all differ."""
    n2 = np.zeros(WINDOW + 1)
    for n in range(WINDOW + 1):
        for s in range(2, SPAN + 1):
            n2[n] += max(0, n - s) * (s - 1) * DECAY ** (2 * (s - 2))
    return np.sqrt(np.maximum(n2, 1e-9))


_NORMS = _norms()


def _windows(token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, widths) of the windows: those of full width, and whole tokens that are shorter; and where each letter's token ends."""
    n = len(token)
    begin = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    length = np.diff(np.concatenate([begin, [n]]))
    end, at = np.repeat(begin + length, length), np.arange(n)
    q = np.sort(np.concatenate([at[at + WINDOW <= end], begin[length < WINDOW]]))
    return q, np.minimum(end[q] - q, WINDOW), end


def margins(text: str | None, weights: np.ndarray) -> np.ndarray:
    """weights . phi(window) / norm of every window of the text, in order, to three digits, so that equal windows are equal wherever they stand."""
    c, token, _ = stream(text or "")
    n = len(c)
    if not n:
        return np.zeros(0, np.float32)
    q, width, end = _windows(token)
    out, pair, at = np.zeros(len(q)), c * LETTERS, np.arange(n)
    for s in range(2, SPAN + 1):
        m = n - s
        if m <= 0:
            break
        part = np.zeros(m, np.float32)
        left, right = c[:m] * LETTERS**2, c[s : s + m]
        for d in range(1, s):
            part += weights[left + pair[d : d + m] + right]
        part *= DECAY ** (s - 2)
        part[at[:m] + s >= end[:m]] = 0
        total = np.concatenate([[0.0], np.cumsum(part, dtype=np.float64)])
        out += total[np.minimum(q + np.maximum(width - s, 0), m)] - total[np.minimum(q, m)]
    return np.round(out / _NORMS[width], 3).astype(np.float32)


def triples(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sentence, triple, weight) of the images of all windows, in the sentences' order, and each sentence's number of windows."""
    c, token, sentence = stream(text or "")
    n = len(c)
    if n < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0, np.int64)
    sentence = np.unique(sentence, return_inverse=True)[1]
    q, width, end = _windows(token)
    begin = np.concatenate([[0], np.cumsum(np.diff(token) != 0)])  # token's number
    start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))[begin]
    length, at = end - start, np.arange(n)
    which, code, weight = [], [], []
    for s in range(2, min(SPAN, n - 1) + 1):
        i = at[: n - s]
        i = i[i + s < end[: n - s]]
        # how many windows hold the letters i to i + s
        many = np.minimum(i, end[i] - WINDOW) - np.maximum(start[i], i + s - WINDOW + 1) + 1
        short = length[i] < WINDOW
        share = np.where(short, 1.0, many) / _NORMS[np.where(short, length[i], WINDOW)] * DECAY ** (s - 2)
        for d in range(1, s):
            which.append(sentence[i])
            code.append(c[i] * LETTERS**2 + c[i + d] * LETTERS + c[i + s])
            weight.append(share)
    which, code, weight = np.concatenate(which), np.concatenate(code).astype(np.int64), np.concatenate(weight).astype(np.float32)
    order = np.argsort(which, kind="stable")
    return which[order], code[order], weight[order], np.bincount(sentence[q], minlength=sentence[-1] + 1)


def images(text: str | None, table: np.ndarray, step: int = 20_000) -> np.ndarray:
    """A row a sentence: its image times the table (triples x columns), over the root of its number of windows."""
    which, code, weight, size = triples(text)
    out = np.zeros((len(size), table.shape[1]), np.float32)
    for at in range(0, len(which), step):
        w = which[at : at + step]
        edge = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
        out[w[edge]] += np.add.reduceat(table[code[at : at + step]] * weight[at : at + step, None], edge, axis=0)
    return out / np.sqrt(np.maximum(size, 1))[:, None].astype(np.float32)


def _hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, reg: float = 1e-4, steps: int = 12, block: int = 4096) -> np.ndarray:
    """A linear machine with squared hinge loss, by Newton's steps over blocks of rows; rows of weight 0 don't count. x's last column is 1, its weight the bias."""
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], reg)
    ridge[-1] = 1e-6
    for _ in range(steps):
        left, right, now = np.diag(ridge), np.zeros(len(w)), w.astype(x.dtype)
        for at in range(0, len(x), block):
            part, t, v = x[at : at + block], y[at : at + block], weight[at : at + block]
            on = (t * (part @ now) < 1) & (v > 0)
            part = part[on]
            left += (part * v[on, None].astype(x.dtype)).T @ part
            right += part.T @ (v[on] * t[on]).astype(x.dtype)
        new = np.linalg.solve(left, right)
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, reg: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Logistic regression by Newton's steps, halved until they lessen the loss. The last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], reg)
    ridge[-1] = 1e-6

    def loss(w: np.ndarray) -> float:
        m = x @ w
        return float((weight * (np.logaddexp(0, m) - y * m)).sum() + (ridge * w * w).sum() / 2)

    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        move = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (weight * (y - p)) - ridge * w)
        rate = 1.0
        while loss(w + rate * move) > now and rate > 1e-4:
            rate /= 2
        w, before = w + rate * move, now
        now = loss(w)
        if before - now < 1e-9 * max(1.0, before):
            break
    return w


def pooled(m: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """What a document's score looks at: windows over each level, their share, and the worst margin."""
    if not len(m):
        return np.zeros(2 * len(levels) + 1)
    over = np.array([(m > v).sum() for v in levels], float)
    return np.concatenate([np.log1p(over), np.sqrt(over / len(m)), [max(0.0, float(m.max() - levels[0]))]])


def _landmarks(found: list[str], common: list[str], most: int) -> tuple[np.ndarray, np.ndarray]:
    """(table of the landmarks' triples, K_mm^-1/2): words that tell, unlike each other, then frequent ones."""
    table, n = np.zeros((LETTERS**3, most), np.float32), 0
    for k, word in enumerate([*found, *common]):
        _, code, weight, _ = triples(word)
        if n == most or not len(code):
            continue
        v = np.bincount(code, weight, LETTERS**3).astype(np.float32)
        at = np.flatnonzero(v)
        v = v[at] / np.linalg.norm(v)
        if n and (k < len(found) and n >= most * 4 // 5 or (v @ table[at, :n]).max() > 0.95):
            continue
        table[at, n] = v
        n += 1
    table = table[:, :n]
    value, vector = np.linalg.eigh((table.T @ table).astype(np.float64))
    return table, (vector * np.where(value > 1e-6, np.maximum(value, 1e-6) ** -0.5, 0)) @ vector.T


def machine(x: np.ndarray, bag: np.ndarray, label: np.ndarray, rounds: int = 3) -> np.ndarray:
    """Weights over the features (x's last column is 1, its weight the bias) from sentences x of documents `bag` with the document's label."""
    bad = label > 0
    keep, y = bad.copy(), np.where(label > 0, 1.0, -1.0)
    for _ in range(rounds):
        w = _hinge(x, y, np.where(bad, keep * 0.5 / max(1, keep.sum()), 0.5 / max(1, (~bad).sum())))
        m = x @ w.astype(x.dtype)
        order = np.lexsort((-m, bag))
        worst = np.zeros(len(m), bool)
        worst[order[np.concatenate([[True], bag[order][1:] != bag[order][:-1]])]] = True
        keep = bad & ((m > np.quantile(m[~bad], 0.99)) | worst)
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = 1000, landmarks: int = 320) -> dict:
    """The model, from at most `sample` labelled rows of each kind outside the held-out fold; the driver gets their sentences' features (landmarks numbers each)."""
    spark, doc_id = docs.sparkSession, F.col("doc_id").cast("long")
    rows = labels.where("toxic is not null and doc_id is not null").groupBy(doc_id.alias("doc_id")).agg(F.bround(F.avg("toxic")).cast("int").alias("label"))
    rows = rows.where(~is_held_out(F.col("doc_id"), FOLDS, HELD_OUT))
    ids = docs.select(doc_id.alias("doc_id")).where("doc_id is not null")
    rows = checkpointed(rows.join(ids, "doc_id", "left_semi"))
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    total = sum(sizes.values())
    base = sizes.get(1, 0) / total if total else 0.5
    flat = {"base": base, "weights": None}
    if not total or not 0 < base < 1:
        return flat
    first = lambda k: rows.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    picked = checkpointed(texts(docs).join(F.broadcast(first(0).union(first(1))), "doc_id").select("doc_id", "label", "text").repartition(32, "doc_id"))  # 2 x sample rows
    word = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}[\p{L}\p{M}'-]{1,39}"), F.lit(0)))).alias("word")
    tally = picked.select("label", word).groupBy("word").agg(F.sum("label").alias("b"), F.count("*").alias("n"))
    toxic, clean = min(sizes[1], sample), min(sizes[0], sample)
    p, b, n = toxic / (toxic + clean), F.col("b"), F.col("n")
    ratio = 2 * (F.when(b > 0, b * F.log(b / (n * p))).otherwise(0) + F.when(n > b, (n - b) * F.log((n - b) / (n * (1 - p)))).otherwise(0))
    tally = checkpointed(tally.withColumn("ratio", F.when(b / n > p, ratio).otherwise(-ratio)))
    few = lambda *order: [r.word for r in tally.orderBy(*order, "word").limit(4 * landmarks).collect()]
    table, root = _landmarks(few(F.desc("ratio")), few(F.desc("n")), landmarks)
    if not table.shape[1]:
        return flat
    shared = spark.sparkContext.broadcast(table @ root.astype(np.float32))

    def featured(batch):
        for x in pieces(batch, most_bytes=1 << 20):
            z = [images(t, shared.value) for t in x.column("text").to_pylist()]
            n = [len(v) for v in z]
            yield {"doc_id": np.repeat(x.column("doc_id").to_numpy(), n).tolist(), "label": np.repeat(x.column("label").to_numpy(), n).tolist(), "z": [r.tobytes() for r in np.concatenate(z).astype(np.float16)]}

    got = map_batches(picked, featured, "doc_id long, label int, z binary").toArrow()
    if not got.num_rows:
        return flat
    x = np.ones((got.num_rows, table.shape[1] + 1), np.float32)
    for k, z in enumerate(got.column("z")):
        x[k, :-1] = np.frombuffer(z.as_py(), np.float16)
    label = got.column("label").to_numpy()
    if not 0 < label.mean() < 1:
        return flat
    w = machine(x, got.column("doc_id").to_numpy(), label)
    del x, got
    weights = (shared.value @ w[:-1].astype(np.float32)).astype(np.float32)
    model = spark.sparkContext.broadcast(weights)

    def scored(batch):
        for x in pieces(batch):
            yield {"label": x.column("label"), "m": [margins(t, model.value).tobytes() for t in x.column("text").to_pylist()]}

    found = map_batches(picked, scored, "label int, m binary").toArrow()
    bags = [(k, np.frombuffer(m, np.float32)) for k, m in zip(found.column("label").to_pylist(), found.column("m").to_pylist(), strict=True)]
    quiet = np.concatenate([m for k, m in bags if not k])
    levels = np.round(np.quantile(quiet, LEVELS) if len(quiet) else np.zeros(len(LEVELS)), 3) + 0.0005  # between two margins
    x, y = np.stack([pooled(m, levels) for _, m in bags]), np.array([float(k) for k, _ in bags])
    mean, spread = x.mean(0), np.maximum(x.std(0), 1e-6)
    curve = _logistic((x - mean) / spread, y, np.where(y > 0, base / max(1, y.sum()), (1 - base) / max(1, (1 - y).sum())) * len(y) / 10)
    return {"base": base, "weights": weights, "levels": levels, "mean": mean, "spread": spread, "curve": curve}


def score(text: str | None, model: dict) -> float:
    if model["weights"] is None:
        return model["base"]
    x = (pooled(margins(text, model["weights"]), model["levels"]) - model["mean"]) / model["spread"]
    return float(1 / (1 + np.exp(-np.clip(x @ model["curve"][:-1] + model["curve"][-1], -30, 30))))


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **options))

    def run(batch):
        for b in pieces(batch):
            s = np.array([score(t, shared.value) for t in b.column("text").to_pylist()])
            yield {"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "score": s.tolist(), "predicted": (s >= THRESHOLD).astype(int).tolist()}

    return map_batches(texts(docs).withColumn("held_out", F.coalesce(is_held_out(F.col("doc_id"), FOLDS, HELD_OUT), F.lit(False))), run, RESULT)
