import random
import re
from collections import Counter

import duckdb

from adlake.llm import hosts as H

from .fixtures import EDGES, frame


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + d for k in range(len(w) - 2) if n[tuple(w[k : k + 3])] > 1 for d in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def corpus(n=60):
    r = random.Random(2)
    bits = ["the", "of", "a", "é", "x#", "<b>", "word", "\n", "\t", "the of a", "🙂"]
    return EDGES + [" ".join(r.choices(bits, k=r.randint(0, 150))) for _ in range(n)]


def test_equals_brute_force_and_sql(spark):
    texts = corpus()
    docs = frame(spark, texts, clashing=True)
    rows = H.judge(docs).collect()
    got = {r.doc_id: tuple(r)[1:6] for r in rows}
    assert got == {k: brute(t) for k, t in enumerate(texts)}
    c = duckdb.connect()
    c.register("documents", docs.select("doc_id", "text", "source").toPandas())
    assert sorted(c.sql(H.oracle()).fetchall()) == sorted(map(tuple, rows))
    assert sorted(map(tuple, H.judge(docs, broadcast_hosts=0).collect())) == sorted(map(tuple, rows))


def test_bad_host_is_refused_and_good_one_forgives(spark):
    good = " ".join(f"word{k}" for k in range(80))
    junk = " ".join(f"#{k}#word|" for k in range(80))
    rows = [(k, good, "good") for k in range(300)] + [(300, junk, "good")] + [(400 + k, junk if k < 90 else good, "bad") for k in range(100)] + [(600 + k, good, f"h{k % 9}") for k in range(90)]
    kept = {r.doc_id: r.kept for r in H.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert kept[300] and all(kept[k] for k in range(300)) and not any(kept[400 + k] for k in range(100))


def test_empty_table(spark):
    assert H.judge(frame(spark, [])).count() == 0
