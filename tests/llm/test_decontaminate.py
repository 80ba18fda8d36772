import hashlib
import random
import re

from pyspark.sql import functions as F

from adlake.llm import decontaminate as D

from .fixtures import EDGES, frame


def tokens(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(texts, items):
    windows = []
    for i, t in items:
        w = tokens(t)
        windows += [(i, w[k : k + 10]) for k in range(max(1, len(w) - 9))] if w else []
    out = []
    for d, t in enumerate(texts):
        w, hit, found = tokens(t), set(), set()
        for i, x in windows:
            for p in range(len(w) - len(x) + 1):
                if w[p : p + len(x)] == x:
                    hit |= set(range(p, p + len(x)))
                    found.add(str(i))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def brute_longest(text, items):
    """Words of the longest match that holds a window, and all (item, item place, document place) of that length."""
    w, best = tokens(text), (0, set())
    for i, t in items:
        x = tokens(t)
        for a in range(len(x)):
            for b in range(len(w)):
                n = 0
                while a + n < len(x) and b + n < len(w) and x[a + n] == w[b + n]:
                    n += 1
                if n >= min(10, len(x)) and n >= best[0]:
                    best = (n, (best[1] if n == best[0] else set()) | {(i, a, b)})
    return best


def corpus(seed):
    r = random.Random(seed)
    vocab = ["The", "of", "a", "Zé", "x1", "and", "in"]
    items = [(k, " ".join(r.choices(vocab, k=n))) for k, n in enumerate([0, 1, 3, 9, 10, 11, 25, 40])] + [(9, None), (10, "-- ..")]
    texts = list(EDGES)
    for _ in range(40):
        w = r.choices(vocab, k=r.randint(0, 60))
        if r.random() < 0.6:
            src = tokens(r.choice(items[3:8])[1])
            a = r.randrange(len(src))
            w[len(w) // 2 : len(w) // 2] = src[a : a + r.randint(5, 25)]
        texts.append("-".join(w))
    return texts, items


def test_equals_brute_force(spark):
    for seed in (1, 2):
        texts, items = corpus(seed)
        docs, bench = frame(spark, texts, clashing=seed == 2), spark.createDataFrame(items, "item_id long, text string")
        want = brute(texts, items)
        for block_words in (2_000_000, 20):
            got = sorted(map(tuple, D.report(docs, bench, block_words=block_words).collect()))
            assert [x[:6] for x in got] == want
            for x in got:
                n, places = brute_longest(texts[x[0]], items)
                assert x[6] == n and (x[7:] in places and x[9] == min(p[2] for p in places) if n else x[7:] == (None,) * 3), (x, n, places)
        assert {r.doc_id for r in D.decontaminate(docs, bench).collect()} == {w[0] for w in want if not w[5]}
        assert {(r.item_id, r.doc_id) for r in D.matches(docs, bench).collect()} >= {(3 + 3, w[0]) for w in want if w[3] == 1 and w[4] == hashlib.sha256(b"6").hexdigest()}


def test_longest_match(spark):
    item = " ".join(f"w{k}" for k in range(30))
    docs = frame(spark, ["zero " + " ".join(f"w{k}" for k in range(5, 27)) + " end"])
    got = D.matches(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [tuple(r) for r in got] == [(7, 5, 0, 1, 22)]


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert D.report(frame(spark, []), bench).count() == 0
    assert [r.contaminated for r in D.report(frame(spark, ["a b c"]), bench).collect()] == [False]


def test_very_long_document_and_item(spark):
    r = random.Random(3)
    item = [f"w{r.randrange(400)}" for _ in range(30_000)]
    docs = frame(spark, [" ".join(item), " ".join(item[500:20_000]), " ".join(f"w{r.randrange(400)}" for _ in range(30_000))])
    got = {x.doc_id: x for x in D.report(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()}
    assert (got[0].longest_words, got[0].n_hit) == (30_000, 30_000) and (got[1].longest_words, got[1].longest_item_start, got[1].longest_doc_start) == (19_500, 500, 0)
    assert not got[2].contaminated and got[2].longest_words == 0


def test_null_and_repeated_rows(spark):
    docs = frame(spark, ["a b c", "a b c", None]).withColumn("doc_id", F.lit(None).cast("long"))
    bench = spark.createDataFrame([(None, "b c"), (3, "b c"), (3, "b c")], "item_id long, text string")
    assert sorted((x.n_hit, x.n_items, x.longest_words) for x in D.report(docs, bench).collect()) == [(0, 0, 0), (2, 2, 2), (2, 2, 2)]
    assert D.decontaminate(docs, bench).count() == 1
