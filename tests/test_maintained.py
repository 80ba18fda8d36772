"""Statistics kept by retractions equal those of the whole state, after each micro-batch."""

import random
import time

import pytest

from adlake.operators import state as S
from adlake.operators import stats as A
from adlake.operators.filters import AdFilters, deep_page, page
from adlake.streaming import maintained as M

SCHEMA = "offset long, id_ad string, source_name string, make_name string, region string, price int, mileage int, year int, currency_code string, created_at timestamp_ntz"


def messages(r, n, start):
    out = []
    for k in range(n):
        day = f"2024-01-{1 + r.randrange(28):02d} 0{r.randrange(10)}:00:00"
        out.append((start + k, str(r.randrange(25)), "s", r.choice(["audi", "seat", "zuk", None]), r.choice(["north", "south", None]), r.choice([None, 0, *range(3000, 120000, 9000)]), r.choice([None, 0, 10, 5000]), r.choice([None, 1980, *range(1995, 2020)]), "PLN", day))
    return out


def test_equal_after_each_of_ten_batches(spark, tmp_path):
    r, stats, said = random.Random(3), M.MaintainedStats(spark, str(tmp_path / "stats")), []
    stamped = SCHEMA.replace("timestamp_ntz", "string")
    for k in range(10):
        new = messages(r, 12, 12 * k)
        said += new
        frame = lambda rows: spark.createDataFrame(rows, stamped).selectExpr(*[c.split()[0] for c in SCHEMA.split(", ") if "created" not in c], "CAST(created_at AS timestamp_ntz) AS created_at")
        frame(new).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.02)
        stats.run(spark.readStream.schema(frame(new).schema).parquet(str(tmp_path / "in")))
        state = S.upsert(frame(said)).selectExpr("*", "CAST(NULL AS timestamp_ntz) AS sold_at").cache()
        counts = stats.counts().cache()
        same = lambda a, b: [tuple(x) for x in a.collect()] == [tuple(x) for x in b.select(*a.columns).collect()]
        assert same(M.makes(counts), A.makes(state)) and same(M.regions(counts), A.regions(state))
        assert same(M.general(counts), A.general(state).drop("median_price"))
        if k in (0, 4, 9):
            assert same(M.year_distribution(counts), A.year_distribution(state))
            assert same(M.trends(counts, "2024-01-29 00:00:00", 20), A.trends(state, "2024-01-29 00:00:00", "daily", 20))
            assert same(M.price_distribution(counts).orderBy("price_range"), A.price_distribution(state).orderBy("price_range"))
        state.unpersist(), counts.unpersist()


@pytest.mark.parametrize("values", [[], [None, 0, -4], [7], [3, 3], [1, 2], [5, 1, 9], [1, 70_000], [1, 1, 1, 2_000_000_000], [65_535, 65_536, 65_536, 131_072], list(range(1, 200)), [10, 10, 20, 20]])
def test_median_by_selection(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "price int").repartition(3)
    held = sorted(v for v in values if v is not None and v > 0)
    n = len(held)
    want = None if not n else (held[(n - 1) // 2] + held[n // 2]) / 2
    assert A.median(rows, "price").first().median == want
    assert A.median(rows, "price", 4).first().median == want if n < 50 and max(held, default=0) < 10**6 else True


@pytest.mark.parametrize(("by", "order"), [("created_at", "desc"), ("created_at", "asc"), ("price", "asc"), ("price", "desc"), ("make_name", "asc"), ("make_name", "desc")])
def test_deep_pages(spark, by, order):
    r = random.Random(5)
    rows = [(str(k), r.choice([None, "aa", "ab", "b", "Zz", "éa"]), r.choice([None, 0, -5000, *range(0, 9000, 700)]), r.choice([None, *(f"20{10 + y}-0{m}-11 00:00:00" for y in range(5) for m in (1, 2, 9))])) for k in range(150)]
    ads = spark.createDataFrame(rows, "id_ad string, make_name string, price int, created_at string").selectExpr("id_ad", "make_name", "price", "CAST(created_at AS timestamp_ntz) AS created_at")
    for number in (1, 3, 8, 9, 22):
        want = page(ads, AdFilters(), number, 7, by, order).collect()
        assert deep_page(ads, AdFilters(), number, 7, by, order).collect() == want
    assert deep_page(ads, AdFilters(price_from=1000), 2, 10, by, order).collect() == page(ads, AdFilters(price_from=1000), 2, 10, by, order).collect()


def test_a_deep_page_reads_its_range(spark, tmp_path):
    """Files of other months aren't opened."""
    rows = spark.range(2000).selectExpr("CAST(id AS string) AS id_ad", "CAST(timestampadd(DAY, CAST(id AS int), TIMESTAMP_NTZ '2015-01-01 00:00:00') AS timestamp_ntz) AS created_at")
    rows.repartitionByRange(20, "created_at").sortWithinPartitions("created_at").write.parquet(str(tmp_path / "ads"))
    ads = spark.read.parquet(str(tmp_path / "ads"))
    got = deep_page(ads, AdFilters(), 50, 20)
    assert [x.id_ad for x in got.collect()] == [x.id_ad for x in page(ads, AdFilters(), 50, 20).collect()]
    plan = got._jdf.queryExecution().executedPlan()
    scan = [p for p in str(plan.toString()).split("\n") if "FileScan" in p]
    assert scan and "GreaterThanOrEqual(created_at" in scan[0] and "LessThan(created_at" in scan[0]
    read = spark.read.parquet(str(tmp_path / "ads")).where(got.select("created_at").agg({"created_at": "min"}).first()[0].strftime("created_at >= TIMESTAMP_NTZ '%Y-%m-01 00:00:00'"))
    assert read.count() < 2000
