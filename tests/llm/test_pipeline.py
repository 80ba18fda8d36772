"""The pipeline's stages against plain versions of themselves on a small corpus."""

import os
import random
import re

import corpus_pipeline as C
import pytest
from pyspark.sql import functions as F

from adlake.llm import pii
from adlake.llm.common import shared_dir

from .fixtures import EDGES, frame


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(9)
    vocab = [f"{a}{b}" for a in ("ther", "lo", "mi", "sta", "en") for b in ("ing", "ed", "on", "s", "al")]
    item = " ".join(r.choices(vocab, k=25))
    texts = list(EDGES)
    texts += [" ".join(r.choices(vocab, k=80)) + "." for _ in range(60)]
    texts += ["### $$$ ".join(r.choices(vocab, k=60)) for _ in range(20)]
    base = " ".join(r.choices(vocab, k=3000))
    texts += [base, base, base.upper(), base + " end"]
    texts += ["start " + item + " end of it", "write to a.b@example.com or +1 (555) 123-4567 soon " + " ".join(r.choices(vocab, k=40))]
    docs = frame(spark, texts)
    first = len(EDGES)
    d = tmp_path_factory.mktemp("sf")
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(k, int(k < first + 60), 0) for k in range(first, first + 80)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(5, item), (6, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), texts


def test_stages(spark, corpus, tmp_path):
    d, texts = corpus
    docs, kept = spark.read.parquet(f"{d}/documents.parquet"), []
    columns = docs.columns
    for k, (_, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, d)
        if k < len(C.STAGES) - 1:
            assert out.columns == columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    first, n = len(EDGES), len(texts)
    assert not kept[0] & set(range(first + 60, first + 80)) and set(range(first, first + 60)) <= kept[0]
    copies = set(range(n - 6, n - 2))
    assert copies & kept[1] == {n - 6}
    assert {6, 7} & kept[1] == {6} and {0, 1, 2} & kept[1] == {0}
    assert n - 2 in kept[1] and n - 2 not in kept[2] and kept[2] | {n - 2} == kept[1]
    assert kept[3] == kept[2] == kept[4]
    clean = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "3")).collect()}
    assert clean[n - 1].text.startswith("write to [EMAIL] or [PHONE] soon") and clean[n - 1].n_chars == len(clean[n - 1].text)
    assert not any(re.search(pii.BASE["phone"], r.text or "") for r in clean.values())
    whole = spark.read.parquet(str(tmp_path / "4"))
    assert sorted(map(tuple, C.run(spark, d).select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(map(tuple, whole.select("doc_id", "start", "length", "ids_crc32").collect()))


def test_stages_keep_clashing_columns_and_empty_tables(spark, corpus):
    d, _ = corpus
    for texts in ([], ["", None, "some words of one text that is kept whole", "other words"]):
        docs = frame(spark, texts, clashing=True)
        for k, (_, stage) in enumerate(C.STAGES[:-1]):
            out = stage(spark, docs, d)
            assert out.columns == docs.columns and out.count() <= len(texts), k
        assert C.STAGES[-1][1](spark, docs, d).select("doc_id").distinct().count() == len(texts)


def test_stages_keep_columns_of_any_name(spark, corpus):
    """Names that the stages use within, a name with a dot, and names that differ by case only from those."""
    d, _ = corpus
    docs = frame(spark, ["", None, "some words of one text that is kept whole", "some words of one text that is kept whole", "mail a@b.example now"])
    for name in ("id__", "ROW__", "row__", "a.b", "clean__", "node", "first", "places", "digest", "spans", "p"):
        docs = docs.withColumn(name, F.lit(name)) if name.lower() not in {c.lower() for c in docs.columns} else docs
    for k, (_, stage) in enumerate(C.STAGES[:-1]):
        out = stage(spark, docs, d)
        rows = out.collect()
        assert out.columns == docs.columns and all(r["a.b"] == "a.b" and r["ROW__"] == "ROW__" for r in rows) and len(rows) >= (3 if k == 1 else 1), k
    assert C.STAGES[-1][1](spark, docs, d).count() > 0


def test_run_leaves_one_table_behind(spark, corpus):
    d, _ = corpus
    shared = shared_dir(spark)
    before = set(os.listdir(shared))
    assert C.run(spark, d).count() > 0
    assert [os.listdir(f"{shared}/{x}") for x in set(os.listdir(shared)) - before] == [["3"]]
