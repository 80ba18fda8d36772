import random
import re
from collections import Counter
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from adlake.llm import phrases as P
from adlake.llm.queries import QUERIES

from .fixtures import EDGES, frame


def plain(rows, longest, least, top):
    """(lang, text) rows by the definition, phrase by phrase."""
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", t):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            counts.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    held = {p: n for p, n in counts.items() if len(p[1]) > 1 and n >= least}
    inside = lambda s, b: any(b[i : i + len(s)] == s for i in range(len(b) - len(s) + 1))
    out = []
    for (lang, w), a in held.items():
        if any(x == lang and len(b) > len(w) and n >= a and inside(w, b) for (x, b), n in held.items()):
            continue
        cuts = [(1000 * a * total[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]], total[lang]))
    ranked, seen = [], Counter()
    for lang, score, a, phrase, left, right, n in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase.decode(), -a, left, right, n, -score))
    return ranked


def texts():
    r = random.Random(4)
    words = ["The", "the", "cat", "sat", "on", "a", "mat\x1c", "é", "\U0001f642", "zz"]
    made = []
    for _ in range(150):
        parts = [r.choice(["the cat sat", "on a mat\x1c", "a a a a", "zz é \U0001f642", *words]) + r.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "-"]) for _ in range(r.randrange(40))]
        made.append("".join(parts))
    return [*EDGES, *made, "the cat " * 3000, made[3], made[3]]


@pytest.mark.parametrize(("longest", "least", "top", "bits"), [(5, 3, 2000, 1 << 27), (5, 9, 6, 64), (3, 3, 2000, 1 << 16), (2, 1, 50, 8)])
def test_equals_the_definition(spark, longest, least, top, bits):
    docs = frame(spark, texts(), clashing=True)
    rows = [(x.lang, x.text) for x in docs.collect()]
    got = sorted(tuple(x) for x in P.collocations(docs, longest, least, top, bits).collect())
    assert got == sorted(plain(rows, longest, least, top)) and got


def test_a_number_for_two_phrases_is_found(spark):
    """With numbers of a few bits words clash, with some more phrases do; the counts still are those of the phrases."""
    docs = frame(spark, texts())
    plainer = docs.selectExpr("coalesce(text, '') AS text", "coalesce(lang, 'und') AS lang")
    want = sorted(plain([(x.lang, x.text) for x in docs.collect()], 3, 3, 2000))
    for width in (2, 9):
        with pytest.raises(P._Clash):
            P._frequent(plainer, 3, 3, 64, 0, width)
        assert sorted(tuple(x) for x in P.collocations(docs, 3, 3, width=width).collect()) == want


def test_rare_phrases_are_not_sent(spark):
    """Frequent words in ever new pairs: the pairs are counted by buckets, and but for the frequent ones only those of an unlucky bucket go to the exact count."""
    r = random.Random(8)
    made = [" ".join([*r.choices([f"w{k}" for k in range(300)], k=200), "of the"]) for _ in range(60)]
    docs = frame(spark, made).repartition(3)
    everything = spark.sparkContext.broadcast(b"\xff")
    first = P._first(docs.selectExpr("text", "'en' AS lang"), everything, 0, 64).cache()
    pairs = Counter(p for t in made for p in zip(t.split(), t.split()[1:], strict=False))
    want = sorted(n for n in pairs.values() if n >= 20)
    for buckets, most in ((1 << 20, len(want) + 20), (64, len(pairs)), (8, len(pairs))):
        crowded = spark.sparkContext.broadcast(P._crowded(first, 20, 0, 64, buckets))
        counted = P._counts(first, crowded, 0, 64)
        assert sorted(x.f for x in counted.where("f >= 20").collect()) == want and counted.count() <= most < 2 * len(pairs)
    first.unpersist()


@pytest.mark.parametrize("held", [1, 1 << 20])
def test_counts_are_packed(spark, monkeypatch, held):
    """Numbers, counts, signs and tasks equal plain ones, however often a task sends; a number of two phrases shows both signs."""
    monkeypatch.setattr(P, "MOST", held)
    r = random.Random(10)
    rows = [(list(range(300)), [r.randrange(40) for _ in range(300)]) for _ in range(30)]
    df = spark.createDataFrame(rows, P._OCCURRENCES).repartition(3).cache()
    everything = spark.sparkContext.broadcast(b"\xff")
    for width in (64, 6):
        want = {}
        for x in df.withColumn("task", F.spark_partition_id()).collect():
            a, b = (P.np.array(v, "u8") for v in (x.id[:-1], x.id[1:]))
            for k, sign in zip(P._mixed(a, b, 0, width).view("i8").tolist(), P._sign(a, b).tolist(), strict=True):
                f, low, high, task = want.get(k, (0, sign, sign, x.task))
                want[k] = (f + 1, min(low, sign), max(high, sign), min(task, x.task))
        got = P._counts(df, everything, 0, width)
        assert {x.id: tuple(x)[1:] for x in got.collect()} == want and got.count() == len(want)
    df.unpersist()


@pytest.mark.parametrize("held", [1, 50])
def test_buckets_equal_plain_sums(spark, monkeypatch, held):
    """However few occurrences a task holds before it sends them."""
    monkeypatch.setattr(P, "MOST", held)
    r = random.Random(9)
    rows = [sorted(r.sample(range(2000), 300)) for _ in range(40)]
    ids = [[r.randrange(6) for _ in x] for x in rows]
    joined = Counter()
    for x, y in zip(rows, ids, strict=True):
        for k in range(299):
            if x[k + 1] == x[k] + 1:
                joined[int(P._mixed(*(P.np.array([v], "u8") for v in y[k : k + 2]), 0, 64)[0]) % 262144] += 1
    df = spark.createDataFrame(list(zip(rows, ids, strict=True)), P._OCCURRENCES).repartition(3)
    for least in (2, 40, 48):
        bits = P.np.unpackbits(P.np.frombuffer(P._crowded(df, least, 0, 64, 262144), "u1"), bitorder="little")
        assert set(P.np.flatnonzero(bits).tolist()) == {k for k, n in joined.items() if n >= least}


def test_whole_small_table_equals_sql(spark):
    d = "/root/testdata/sf0.01"
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    got = QUERIES["op13_setm_collocations"](spark, d)
    want = c.sql(P.oracle())
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_empty_and_rare(spark):
    assert P.collocations(frame(spark, ["x"]).limit(0)).count() == 0
    assert P.collocations(frame(spark, ["one two", "", None])).count() == 0
