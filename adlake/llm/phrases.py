"""Operator 13: phrase collocations by set-oriented relational mining (SETM).

R1 is the persisted relation of word occurrences, sorted by text and position; a piece's end leaves a gap in the positions. R(k) merge-joined with itself
on the piece and the adjacent position gives the occurrences of phrases one word longer (a phrase is told by its two overlapping parts); they are
group-counted, groups below the least count go, and occurrences are semi-joined with the frequent groups before they are extended again.

For scale: a text's occurrences are one row of two sorted arrays, so the merge-join needs no exchange, and is cut into no more than a batch of texts;
tasks count before they shuffle packed numbers, dealt out by remainders. Before each count, tasks add up how many occurrences fall on each
bucket of numbers (sent as bytes, a few bits a number); a bucket with less than the least count holds no frequent phrase, so only the others' numbers are counted one by one. There are
as many buckets as a quarter of the words, up to `bits`; fewer let more rare phrases through to the count, and lose none. The semi-join passes a bitmap of `bits` bits (16 MB, whatever
the corpus), built by Spark; what passes by chance is counted and goes at the next exact count. Frequent groups are never collected or broadcast.
Occurrences are known by numbers of `width` bits, mixed from the parts' numbers; each count checks that a frequent number stands for one phrase, and if one
ever stands for two, all is done again with the next seed (and twice the bits, up to 64): counts are exact, but for phrases that share number and sign, 96 bits.
A frequent number's parts are told by one of the tasks that hold it.

Cases: a null text is empty; a null lang is `und` (as is that text itself); texts without words give nothing; equal rows count each; a phrase never crosses a
piece; very long texts are one row; an empty table, or one without frequent phrases, gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bitmap, checkpointed, map_batches, passes, pieces

#: Fixed values of the contract: longest phrase, least count, rows of each language.
LONGEST, LEAST, TOP = 5, 100, 2000
#: Bits of the semi-join's bitmap; words that a task holds before it sends their counts on; buckets in a row that is sent, numbers that a task holds before it
#: sends or adds them up, rows of packed numbers that it sends.
BITS, HELD = 1 << 27, 400_000
RANGE, MOST, SHARES = 1 << 16, 1 << 21, 1024
_MARK = b"."  # stands for every end of a piece: no word holds it
_TABLE = bytes(c + 32 if 65 <= c <= 90 else ord(_MARK) if chr(c) in ".,;:!?\n\v\f\r" else 32 if c == 9 else c for c in range(256))
_OCCURRENCES = "pos array<int>, id array<long>"


def _tokens(text: str | None) -> list[bytes]:
    """The whole text's words, and a mark for every end of a piece."""
    if not text:
        return []
    # only blanks part words, so what else bytes.split() would cut at must have gone: the table has made it a mark or a blank
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).replace(_MARK, b" . ").split()


def _ids(words: list[bytes], lang: str, seed: int, width: int) -> np.ndarray:
    import xxhash

    mixed, digest = xxhash.xxh64_intdigest(lang.encode(), seed), xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(w, mixed) for w in words]), ">u8").astype(np.uint64) >> np.uint64(64 - width)


def _mixed(a: np.ndarray, b: np.ndarray, seed: int, width: int) -> np.ndarray:
    """The number of the phrase whose first part is a and whose last is b."""
    x = (a ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29)) ^ b) * np.uint64(0x94D049BB133111EB)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) >> np.uint64(64 - width)


def _word_counts(docs: DataFrame, seed: int, width: int) -> DataFrame:
    """(lang, id, word, n): counts of a task's words, over and over; and those of all words under no word."""

    def run(batches):
        held: dict[str, Counter] = {}

        def out():
            for lang, c in held.items():
                words = list(c)
                ids = _ids(words, lang, seed, width).view(np.int64).tolist()
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([lang] * (len(words) + 1)), "id": pa.array([*ids, 0], pa.int64()), "word": pa.array([*words, None], pa.binary()), "n": pa.array([*c.values(), c.total()], pa.int64())}
                )
            held.clear()

        for batch in batches:
            for b in pieces(batch):
                for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
                    c = held.setdefault(lang, Counter())
                    c.update(_tokens(text))
                    del c[_MARK]
                if sum(map(len, held.values())) > HELD:
                    yield from out()
        yield from out()

    return docs.mapInArrow(run, "lang string, id long, word binary, n long")


def _parts(b: pa.RecordBatch, most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The batch cut so that each part holds about `most` occurrences (one longer text alone), to bound a worker's memory."""
    ends = np.asarray(b.column("id").offsets).astype(np.int64)
    at = 0
    while at < len(b):
        end = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield b.slice(at, end - at)
        at = end


def _lists(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A batch's occurrences as flat arrays: row, position, id; sorted by row and position."""
    ids, pos = b.column("id"), b.column("pos")
    size = np.diff(np.asarray(ids.offsets).astype(np.int64))
    return np.repeat(np.arange(len(b)), size), np.asarray(pos.flatten()), np.asarray(ids.flatten()).view(np.uint64)


def _nested(rows: int, row: np.ndarray, pos: np.ndarray, ids: np.ndarray) -> dict[str, pa.Array]:
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int32))
    return {"pos": pa.ListArray.from_arrays(offsets, pa.array(pos.astype(np.int32))), "id": pa.ListArray.from_arrays(offsets, pa.array(ids.view(np.int64)))}


def _joined(b: pa.RecordBatch, seed: int, width: int) -> tuple[np.ndarray, ...]:
    """The merge-join of a batch's occurrences with themselves at adjacent positions: row, position, id, first part, last part."""
    row, pos, ids = _lists(b)
    k = np.flatnonzero((row[1:] == row[:-1]) & (pos[1:] == pos[:-1] + 1))
    return row[k], pos[k], _mixed(ids[k], ids[k + 1], seed, width), ids[k], ids[k + 1]


def _first(docs: DataFrame, frequent, seed: int, width: int) -> DataFrame:
    """R1: the occurrences of frequent words."""

    def run(batch):
        for b in pieces(batch):
            rows, poss, idss = [], [], []
            for k, (text, lang) in enumerate(zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True)):
                words = _tokens(text)
                ids = _ids(words, lang, seed, width)
                at = np.flatnonzero(passes(ids, np.frombuffer(frequent.value, np.uint8)))
                at = at[[words[x] != _MARK for x in at.tolist()]] if len(at) else at
                rows.append(np.full(len(at), k))
                poss.append(at)  # a mark has a position of its own, so pieces don't touch
                idss.append(ids[at])
            yield _nested(len(b), np.concatenate(rows), np.concatenate(poss), np.concatenate(idss))

    return map_batches(docs, run, _OCCURRENCES).where("size(id) > 1")


def _sign(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """32 bits of a phrase's two parts, mixed unlike its number."""
    return ((_mixed(b, a, 1, 64) >> np.uint64(32)).astype(np.uint32)).view(np.int32)


def _planes(x: np.ndarray) -> bytes:
    """The numbers' first bytes, then their second ones, and so on, which packs well: most are small."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def _numbers(planes: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _crowded(occurrences: DataFrame, least: int, seed: int, width: int, buckets: int) -> bytes:
    """A bit for each bucket (remainder of a number) that `least` occurrences of phrases one word longer, or more, fall on. `buckets` is a power of two."""

    def tell(batches):
        held, n = [], 0

        def out():
            at, own = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            # up to `least` of each, so sums reach `least` if those of all would
            count = np.minimum(np.bincount(own, np.concatenate([h[1] for h in held]), len(at)), least).astype("<u4")
            edges = np.flatnonzero(np.concatenate([[True], at[1:] // RANGE != at[:-1] // RANGE, [True]]))
            parts = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
            gaps = [_planes(np.diff(at[i:j] % RANGE, prepend=0).astype("<u2")) for i, j in parts]
            return pa.RecordBatch.from_pydict({"range": pa.array((at[edges[:-1]] // RANGE).astype(np.int64)), "gaps": pa.array(gaps, pa.binary()), "counts": pa.array([_planes(count[i:j]) for i, j in parts], pa.binary())})

        for batch in batches:
            for part in _parts(batch):
                at, count = np.unique((_joined(part, seed, width)[2] & np.uint64(buckets - 1)).astype(np.int64), return_counts=True)
                if len(at):
                    held.append((at, count))
                    n += len(at)
                if n > MOST:
                    yield out()
                    held, n = [], 0
        if held:
            yield out()

    def add(batches):
        last, total = None, np.zeros(RANGE, np.int64)

        def out():
            bits = np.packbits(total >= least, bitorder="little").tobytes()
            return pa.RecordBatch.from_pydict({"range": pa.array([last], pa.int64()), "bits": pa.array([bits], pa.binary())})

        for batch in batches:
            for k, gaps, counts in zip(*(batch.column(c).to_pylist() for c in ("range", "gaps", "counts")), strict=True):
                if k != last:
                    if last is not None:
                        yield out()
                    last, total = k, np.zeros(RANGE, np.int64)
                total[np.cumsum(_numbers(gaps, "<u2").astype(np.int64))] += _numbers(counts, "<u4")
        if last is not None:
            yield out()

    rows = occurrences.mapInArrow(tell, "range long, gaps binary, counts binary").repartition("range").sortWithinPartitions("range")
    bits = bytearray(max(1, buckets // 8))
    for k, part in rows.mapInArrow(add, "range long, bits binary").collect():
        begin = k * RANGE // 8
        bits[begin : begin + len(part)] = part[: len(bits) - begin]
    return bytes(bits)


def _summed(rows: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Rows of number, count, least and greatest sign, least task: one for each number."""
    x = [np.concatenate(c) for c in zip(*rows, strict=True)]
    order = np.argsort(x[0], kind="stable")
    x = [c[order] for c in x]
    at = np.flatnonzero(np.concatenate([[True] * min(1, len(order)), x[0][1:] != x[0][:-1]]).astype(bool))
    if not len(at):
        return tuple(x)
    return x[0][at], np.add.reduceat(x[1], at), np.minimum.reduceat(x[2], at), np.maximum.reduceat(x[3], at), np.minimum.reduceat(x[4], at)


def _counts(occurrences: DataFrame, crowded, seed: int, width: int) -> DataFrame:
    """(id, f, sign, sign2, task) of the phrases one word longer in crowded buckets: the count of a number, least and greatest sign of the phrases under it, and a task that holds it.

    A task adds up what it holds and sends a row of packed numbers for each of `SHARES` remainders."""
    names, kinds = ["id", "f", "sign", "sign2", "task"], ["<i8", "<i8", "<i4", "<i4", "<i4"]

    def tell(batches):
        from pyspark import TaskContext

        task, held, n = TaskContext.get().partitionId(), [], 0

        def out():
            x = _summed(held)
            share = x[0] & (SHARES - 1)
            order = np.argsort(share, kind="stable")
            edges = np.flatnonzero(np.concatenate([[True], share[order][1:] != share[order][:-1], [True]]))
            parts = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
            packed = {c: pa.array([_planes(v[order[i:j]].astype(k)) for i, j in parts], pa.binary()) for c, v, k in zip(names, x, kinds, strict=True)}
            return pa.RecordBatch.from_pydict({"share": pa.array(share[order][edges[:-1]])} | packed)

        for batch in batches:
            for part in _parts(batch):
                _, _, ids, a, b = _joined(part, seed, width)
                passed = passes(ids, np.frombuffer(crowded.value, np.uint8))
                if passed.any():
                    ids, sign = ids[passed].view(np.int64), _sign(a[passed], b[passed])
                    held.append(_summed([(ids, np.ones(len(ids), np.int64), sign, sign, np.full(len(ids), task, np.int32))]))
                    n += len(held[-1][0])
                if n > MOST:
                    yield out()
                    held, n = [], 0
        if held:
            yield out()

    def add(batches):
        last, held, n = None, [], 0
        for batch in batches:
            for k, *packed in zip(*(batch.column(c).to_pylist() for c in ["share", *names]), strict=True):
                if held and (k != last or n > MOST):
                    held = [_summed(held)]
                    n = len(held[0][0])
                    if k != last:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=names)
                        held, n = [], 0
                last = k
                held.append(tuple(_numbers(x, kind) for x, kind in zip(packed, kinds, strict=True)))
                n += len(held[-1][0])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(held)], names=names)

    rows = occurrences.mapInArrow(tell, "share long, id binary, f binary, sign binary, sign2 binary, task binary").repartition("share").sortWithinPartitions("share")
    return rows.mapInArrow(add, "id long, f long, sign int, sign2 int, task int")


_TASK = 0x9E3779B1  # odd: sets a number's bits for one task apart from those for another


def _makings(occurrences: DataFrame, frequent, seed: int, width: int, own: bool) -> DataFrame:
    """(id, a, b): of which two parts the phrases are made whose numbers pass, once from each task; own: a number as its one task's alone."""

    def run(batches):
        from pyspark import TaskContext

        task, sent = np.uint64(TaskContext.get().partitionId() * _TASK if own else 0), set()
        for batch in batches:
            for part in _parts(batch):
                _, _, ids, a, b = _joined(part, seed, width)
                found, at = np.unique(ids, return_index=True)
                at = at[passes(found ^ task, np.frombuffer(frequent.value, np.uint8))]
                at = at[[x not in sent for x in ids[at].tolist()]] if sent and len(at) else at
                sent = set() if len(sent) > 1 << 20 else sent
                sent.update(ids[at].tolist())
                yield pa.RecordBatch.from_arrays([pa.array(x[at].view(np.int64)) for x in (ids, a, b)], names=["id", "a", "b"])

    return occurrences.mapInArrow(run, "id long, a long, b long").dropDuplicates(["id"])


def _longer(occurrences: DataFrame, frequent, seed: int, width: int) -> DataFrame:
    """R(k+1): the occurrences one word longer of frequent phrases."""

    def run(batch):
        for part in _parts(batch):
            row, pos, ids, _, _ = _joined(part, seed, width)
            keep = passes(ids, np.frombuffer(frequent.value, np.uint8))
            yield _nested(len(part), row[keep], pos[keep], ids[keep])

    return map_batches(occurrences, run, _OCCURRENCES).where("size(id) > 1")


class _Clash(Exception):
    """A frequent number stands for two phrases."""


def _frequent(docs: DataFrame, longest: int, least: int, bits: int, seed: int, width: int) -> tuple[DataFrame, DataFrame]:
    """((lang, n) of all words, (lang, k, id, phrase, f) of all frequent phrases of 1 to `longest` words)."""
    spark = docs.sparkSession
    every = F.col("word").isNull()
    words = _word_counts(docs, seed, width).groupBy(every.alias("all"), F.when(every, F.col("lang")).alias("of"), "id")
    words = words.agg(F.sum("n").alias("f"), F.min("lang").alias("lang"), F.max("lang").alias("lang2"), F.min("word").alias("word"), F.max("word").alias("word2"))
    words = checkpointed(words.where(F.col("all") | (F.col("f") >= least)))
    if not words.where("NOT all AND (word <> word2 OR lang <> lang2)").isEmpty():  # a word's number is its language's own, too
        raise _Clash
    totals = words.where("all").select("lang", F.col("f").alias("n"))
    known = words.where("NOT all").select("lang", F.lit(1).alias("k"), "id", F.col("word").cast("string").alias("phrase"), "f")
    share = lambda groups: spark.sparkContext.broadcast(bitmap(groups.select("id"), bits))
    frequent = share(known)
    buckets = min(bits, 1 << max(16, ((totals.agg(F.sum("n")).first()[0] or 0) // 4).bit_length()))
    occurrences, found = checkpointed(_first(docs, frequent, seed, width)), known
    for k in range(2, longest + 1):
        crowded = spark.sparkContext.broadcast(_crowded(occurrences, least, seed, width, buckets))
        counted = checkpointed(_counts(occurrences, crowded, seed, width).where(F.col("f") >= least))
        crowded.destroy()
        if not counted.where("sign <> sign2").isEmpty():
            raise _Clash
        frequent.destroy()
        frequent = share(counted)
        at = share(counted.select(F.col("id").bitwiseXOR(F.col("task").cast("long") * _TASK).alias("id")))
        made = checkpointed(counted.join(_makings(occurrences, at, seed, width, True), "id"))
        if made.count() < counted.count():  # the texts were dealt to tasks in another way
            made = checkpointed(counted.join(_makings(occurrences, frequent, seed, width, False), "id"))
        at.destroy()
        # what passed the bitmap by chance is no part of a frequent phrase: a part is as frequent as the whole
        first = known.select(F.col("id").alias("a"), "lang", F.col("phrase").alias("head"))
        last = known.select(F.col("id").alias("b"), F.substring_index("phrase", " ", -1).alias("tail"))
        known = checkpointed(made.join(first, "a").join(last, "b").select("lang", F.lit(k).alias("k"), "id", F.concat_ws(" ", "head", "tail").alias("phrase"), "f"))
        found = found.union(known)
        if k < longest:
            occurrences = checkpointed(_longer(occurrences, frequent, seed, width))
            if occurrences.isEmpty():
                break
    return totals, found


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, bits: int = BITS, seed: int = 0, width: int = 64) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases of 2 to `longest` words found `least` times, by score.

    A phrase goes if a phrase one word longer holds it and is as frequent (a longer one that is as frequent holds such a one). `bits` is a power of two."""
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    while True:
        try:
            totals, found = _frequent(texts, longest, least, bits, seed, width)
            break
        except _Clash:
            seed, width = seed + 1, min(64, width * 2)
    whole = found.where("k > 1").withColumn("w", F.split("phrase", " "))
    part = lambda begin, size: F.array_join(F.slice("w", begin, size), " ")
    inner = whole.where("k > 2").select("lang", F.explode(F.array(part(F.lit(1), F.col("k") - 1), part(F.lit(2), F.col("k") - 1))).alias("phrase"), F.col("f").alias("of"))
    beaten = inner.groupBy("lang", "phrase").agg(F.max("of").alias("of"))
    left = whole.join(beaten, ["lang", "phrase"], "left").where("of IS NULL OR of < f").drop("of")
    cuts = left.select("lang", "phrase", F.col("f").alias("a"), "k", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("head"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail"))
    count = lambda name, c: found.select("lang", F.col("phrase").alias(name), F.col("f").alias(c))
    both = cuts.join(count("head", "l"), ["lang", "head"]).join(count("tail", "r"), ["lang", "tail"]).join(totals, "lang")
    # up to 38 digits, so exact for any corpus: 1000 a n < 10^38
    both = both.withColumn("score", F.expr("CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0)) DIV (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))").cast("long"))
    low = both.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low")).select("lang", "phrase", "a", "n", "low.score", "low.l", "low.r")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = low.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle(longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> str:
    """collocations() in DuckDB's SQL."""
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS k, array_to_string(list_slice(w, i, i + {k - 1}), ' ') AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) - {k} + 2)) AS i FROM pieces WHERE len(w) >= {k})" for k in range(1, longest + 1)
    )
    return f"""WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, list_filter(string_split_regex(p, '[ \\t]+'), lambda x: x <> '') AS w FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM texts)),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY 1),
found AS (SELECT lang, k, phrase, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING count(*) >= {least}),
whole AS (SELECT *, string_split(phrase, ' ') AS w FROM found WHERE k > 1),
beaten AS (SELECT s.lang, s.phrase FROM whole s JOIN whole b ON s.lang = b.lang AND s.k < b.k AND b.f >= s.f AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')),
cuts AS (SELECT lang, phrase, f AS a, cut, array_to_string(list_slice(w, 1, cut), ' ') AS head, array_to_string(list_slice(w, cut + 1, k), ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM whole WHERE (lang, phrase) NOT IN (SELECT lang, phrase FROM beaten))),
scored AS (SELECT c.lang, c.phrase, a, cut, h.f AS l, t.f AS r, n, CAST(1000::HUGEINT * a * n // (h.f::HUGEINT * t.f) AS BIGINT) AS score
  FROM cuts c JOIN found h ON h.lang = c.lang AND h.phrase = head JOIN found t ON t.lang = c.lang AND t.phrase = tail JOIN totals ON totals.lang = c.lang),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM low QUALIFY rank <= {top}"""
