"""What the layout and the trigram index leave out, and that nothing is lost by it."""

import random

import pytest
from pyspark.sql import functions as F

from adlake.functions.columns import contains
from adlake.operators import trigrams as G
from adlake.plans import registry
from adlake.sources import layout

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def ads(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "ads")
    layout.write(registry.ads(spark, SF), path, ["year", "price", "mileage"], ("id_ad",), files=64)
    return layout.table(spark, path)


def test_nothing_is_lost(spark, ads):
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(ads, registry.ads(spark, SF).select(*ads.columns))


def test_a_key_reads_under_a_tenth(spark, ads):
    total = ads.count()
    for key in ("1", "777", "14999"):
        one = ads.where(F.col("id_ad") == key)
        assert len(one.collect()) == 1 and layout.rows_read(one) < total / 10
    none = ads.where("id_ad = 'no such'")
    assert not none.collect() and layout.rows_read(none) < total / 10


@pytest.mark.parametrize("where", ["price > 0 AND price < 9000", "mileage >= 190000", "year BETWEEN 1990 AND 1999 AND mileage < 60000"])
def test_each_column_of_the_curve_prunes(spark, ads, where):
    rows = ads.where(where)
    n = len(rows.collect())
    assert n and layout.rows_read(rows) < 0.6 * ads.count() and n == registry.ads(spark, SF).where(where).count()


def test_search_by_the_index(spark, tmp_path):
    r = random.Random(2)
    words = ["Ring", "string", "gnir", "AB", "İstanbul", "ćma", "50%", "a_b", "x"]
    texts = [None, "", "ab", *(" ".join(r.choices(words, k=r.randrange(1, 5))) for _ in range(300))]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    G.build(rows, "id", "t", str(tmp_path), 4)
    for term in ("ring", "RING", "tring g", "ab", "a_b", "50%", "g str", "ćma", "none such", "xyz", "stan", "İst"):
        for most in (1, 4):
            got = {x.id for x in G.matching(rows, "id", "t", str(tmp_path), term, most).collect()}
            assert got == {x.id for x in rows.where(contains(F.col("t"), term)).collect()}, term


def test_search_reads_less_than_the_scan(spark, tmp_path):
    r = random.Random(7)
    texts = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=30)) for _ in range(4000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    G.build(rows, "id", "t", str(tmp_path), 64)
    found = G.candidates(spark, str(tmp_path), texts[5][3:12])
    assert 5 in {x.key for x in found.collect()}
    assert layout.rows_read(found) < spark.read.parquet(f"{tmp_path}/postings").count() / 8
