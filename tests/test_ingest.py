import json

import pytest
from pyspark.sql import functions as F

from adlake.functions import columns as C
from adlake.operators import filters as L
from adlake.operators import ingest as I
from adlake.operators import state as S
from adlake.operators import stats as A
from adlake.sources.cached import CachedFrame
from adlake.sources import paged
from adlake.sources.paged import PagedResponses, crawl
from adlake.sources.shared_files import Breaker


def node(i, make, model, **kw):
    params = [("make", make), ("model", model)] + [(k, v) for k, v in kw.items()]
    return {"node": {"id": i, "url": f"https://ad.invalid/{i}", "title": f"{make} {model}", "price": {"amount": {"units": "4150", "currencyCode": "CZK"}}, "parameters": [{"key": k, "value": v} for k, v in params], "location": {"city": {"name": "Brno"}, "region": None}, "mainPhoto": None}}


def body(*edges, total=None):
    return json.dumps({"data": {"advertSearch": {"totalCount": len(edges) if total is None else total, "edges": list(edges)}}})


def test_flatten_golden(spark):
    one = node("k-7", "tatra", "613", year="1988", mileage="1 200", engine_capacity="3495", engine_power="168\n", make2="x")
    one["node"]["parameters"] += [{"key": "make", "value": "TATRA"}, {"key": "", "value": "x"}, {"key": "fuel_type", "value": None}]
    one["node"]["mainPhoto"] = {"url": "https://p.invalid/7.png"}
    bodies = [body(one, {"node": None}), body(total=0), "<html>", json.dumps({"errors": [{"message": "Internal Error"}]}), body(node("k-8", "aero", "30", year="1936"))]
    parsed = I.parse(spark.createDataFrame([(b,) for b in bodies], "body string"))
    assert [r.outcome for r in parsed.collect()] == ["ok", "ok", "error", "retry", "ok"]
    rows = {r.source_ad_id: r for r in I.flatten(parsed).collect()}
    a = rows["k-7"]
    assert set(rows) == {"k-7", "k-8"}
    assert (a.make_str, a.year, a.mileage, a.engine_capacity_cm3, a.engine_power_hp, a.fuel_type_str) == ("TATRA", 1988, None, 3495, None, None)
    assert (a.price, a.currency, a.city_str, a.region_str, a.image_urls, rows["k-8"].image_urls) == ("4150", "CZK", "Brno", None, ["https://p.invalid/7.png"], [])
    assert tuple(I.run_metrics(parsed).first()) == (5, 1, 1, 2)


def test_validation_splits(spark):
    rows = [("1", "u", "s", "PL", "2024-01-01T00:00:00", "75000"), (None, "u", "s", "PL", "2024-01-01T00:00:00", "x"), ("2", None, None, "PL", "no time", "75000.5")]
    df = spark.createDataFrame(rows, "source_ad_id string, url string, source_name string, country_code string, scraped_at string, price string")
    got = I.validate(I.coerce(df), I.REQUIRED_AD).collect()
    assert [(r.valid, r.reason, r.price) for r in got] == [(True, "", 75000.0), (False, "source_ad_id", None), (False, "url,source_name,scraped_at", 75000.5)]
    assert I.project(df.limit(1)).columns == ["id_ad", "url_ad", "source_name", "price"]


def test_guards_and_patterns(spark):
    x = spark.createDataFrame([("2020",), ("2020\n",), ("",), ("25 000",), (None,), ("99999999999",)], "x string")
    assert [r[0] for r in x.select(C.guarded_int(F.col("x"))).collect()] == [2020, None, None, None, None, None]
    assert [r[0] for r in spark.createDataFrame([("Land  Rover",)], "x string").select(C.slug(F.col("x"))).collect()] == ["land--rover"]
    assert C.like_pattern("a\\z%") == "%az%%" and C.like_pattern("a\\%") == "%a\\%%"
    assert spark.createDataFrame([("a_b",)], "x string").where(C.contains(F.col("x"), "A\\zb")).count() == 0


@pytest.mark.parametrize("bad", [{"year_from": 1800}, {"price_to": -1}, {"mileage_from": -5}])
def test_parameters_are_checked(bad):
    with pytest.raises(ValueError):
        L.AdFilters(**bad)


def test_null_order_and_pages(spark):
    ads = spark.createDataFrame([("1", 5), ("2", None), ("3", 7), ("4", 5)], "id_ad string, price int").withColumn("created_at", F.lit(None).cast("timestamp_ntz")).withColumn("sold_at", F.lit(None).cast("timestamp_ntz"))
    ids = lambda **kw: [r.id_ad for r in L.page(ads, sort_by="price", **kw).collect()]
    assert ids(sort_order="asc") == ["1", "4", "3", "2"] and ids(sort_order="desc") == ["2", "3", "1", "4"]
    assert ids(sort_order="asc", number=2, size=3) == ["2"]
    assert tuple(L.page_meta(ads, size=3).first()) == (4, 1, 3, 2)
    assert L.filtered(ads, L.AdFilters(price_from=0)).count() == 4


def messages(spark, *prices, start=0, held=None):
    rows = [("a", start + k, p, True if held is None else held[k], "src") for k, p in enumerate(prices)]
    return spark.createDataFrame(rows, "id_ad string, offset long, price int, price_set boolean, source_name string")


@pytest.mark.parametrize(
    "prices,held,log,last",
    [
        ((100,), None, ["active"], 100),
        ((100, 100), None, ["active"], 100),
        ((100, 90), None, ["active", "price_changed"], 90),
        ((100, 90, 100), None, ["active", "price_changed", "price_changed"], 100),
        ((100, None), None, ["active", "price_changed"], None),
        ((100, None), (True, False), ["active"], 100),
        ((100, None, 100), (True, False, True), ["active"], 100),
    ],
)
def test_upsert_sequences(spark, prices, held, log, last):
    m = messages(spark, *prices, held=held)
    assert [r.status for r in S.price_history(m).orderBy("offset").collect()] == log
    state = S.upsert(m.drop("price_set") if held is None else m, presence=None if held is None else {"price": F.col("price_set")})
    assert state.first().price == last


def test_batches_equal_one_by_one(spark):
    prices = [100, None, None, 90, 90, 100]
    whole = [r.status for r in S.price_history(messages(spark, *prices)).orderBy("offset").collect()]
    stored, log = None, []
    for k, p in enumerate(prices):
        m = messages(spark, p, start=k)
        log += [r.status for r in S.price_history(m, stored).collect()]
        stored = spark.createDataFrame(S.upsert(m.drop("price_set"), stored).collect(), "id_ad string, price int, source_name string")
    assert log == whole and stored.first().price == 100


def test_snapshot_cases(spark):
    ads = spark.createDataFrame([("1", "s", "rover", 5), ("2", "s", "land-rover", 6), ("3", "t", "rover", 7), ("4", "s", "bmw", 8)], "id_ad string, source_name string, make_name string, price int")
    ads = ads.withColumn("currency_code", F.lit("PLN")).withColumn("sold_at", F.when(F.col("id_ad") == "0", F.lit("2020-01-01")).cast("timestamp_ntz"))
    snap = lambda ids, make="rover": I.exploded_ids(spark.createDataFrame([("s", ids, make)], "source_name string, ad_ids array<string>, make_str string"))
    gone = lambda *a, **kw: sorted(r.id_ad for r in S.gone(ads, *a, **kw).collect())
    assert gone(snap(["1", "2"])) == [] and gone(snap(["1"])) == ["2"] and gone(snap([])) == ["1", "2"]
    assert gone(snap(["9"]), exact_make=True) == ["1"] and gone(snap([]), min_active=1) == []
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    sold = S.gone(ads, snap(["1"]))
    assert {r.id_ad: r.sold_at is not None for r in S.mark_sold(ads, sold, at).collect()} == {"1": False, "2": True, "3": False, "4": False}
    assert [(r.auto_ad_id, r.price, r.status) for r in S.sold_history(ads, sold, at).collect()] == [("2", 6, "sold")]
    assert not I.validate(spark.createDataFrame([("s", ["1"], None)], "source_name string, ad_ids array<string>, make_str string"), I.REQUIRED_SNAPSHOT).first().valid


def test_page_plan_and_urls(spark):
    plan = I.page_plan(spark.createDataFrame([("a", 150), ("b", 0), ("c", 51)], "make string, total long"))
    assert sorted(map(tuple, plan.collect())) == [("a", 1), ("a", 2), ("a", 3), ("c", 1), ("c", 2)]
    url = I.request_urls(plan.limit(1), filters=[{"name": "filter_enum_make", "value": "old"}, {"name": "x", "value": "y z"}]).first().url
    assert "old" not in url and "+" not in url and "y%20z" in url


def test_catalogue(spark):
    text = '// list\n[{"name":"filter_enum_make","value":"Alfa Romeo","canonical":null,"__typename":"t"},{"name":"other","value":"x"},{"name":"filter_enum_make","value":"other","canonical":"inny"}]'
    entries = I.catalogue(spark.createDataFrame([(text,)], "value string"))
    assert sorted(map(tuple, entries.collect())) == [("alfa-romeo", "Alfa Romeo"), ("inny", "other")]
    fresh, counters = I.load_catalogue(entries, spark.createDataFrame([("inny",)], "slug string"))
    assert fresh.count() == 1 and tuple(counters.first()) == (1, 1)


def test_dimension_ids_grow(spark):
    known = spark.createDataFrame([(7, "audi", "Audi")], "id long, slug string, name string")
    got = S.grow_dimension(known, spark.createDataFrame([("audi", "AUDI"), ("bmw", "BMW"), ("zuk", "Zuk")], "slug string, name string"))
    assert sorted(map(tuple, got.collect())) == [(7, "audi", "Audi"), (8, "bmw", "BMW"), (9, "zuk", "Zuk")]


def test_paged_source(spark, tmp_path):
    for p in (1, 2):
        (tmp_path / f"tatra-{p}.json").write_text(body(node(str(p), "tatra", "613"), total=120))
    (tmp_path / "aero-1.json").write_text(body(total=0))
    spark.dataSource.register(PagedResponses)
    template = f"file://{tmp_path}/{{make}}-{{page}}.json"
    df = spark.read.format("paged").options(url_template=template, plan="tatra:3", pause="0").load()
    rows = {r.page: r for r in df.collect()}
    assert rows[1].error is None and rows[3].body is None and rows[3].error
    assert I.flatten(I.parse(df)).count() == 2
    # the first pages' totals say that there are three of one make, none of the other
    got = sorted((r.make, r.page, r.body is not None) for r in crawl(spark, ["tatra", "aero"], template, pause="0").collect())
    assert got == [("aero", 1, True), ("tatra", 1, True), ("tatra", 2, True), ("tatra", 3, False)]


def test_retries_and_circuit_breaker(monkeypatch):
    import io
    import urllib.error
    import urllib.request

    naps, answers = [], []

    def answer(url, timeout):
        x = answers.pop(0)
        if isinstance(x, int):
            raise urllib.error.HTTPError(url, x, "", None, None)
        return io.BytesIO(x.encode())

    monkeypatch.setattr(urllib.request, "urlopen", answer)
    monkeypatch.setattr(paged.time, "sleep", naps.append)
    monkeypatch.setattr(Breaker, "_alone", {"refused": 0, "until": 0.0})
    reader = paged.PagedReader({"url_template": "http://s.invalid/{make}/{page}", "plan": "a:1-2", "pause": "1", "long_pause": "60"})
    broken = json.dumps({"errors": [{"message": "Internal Error"}]})
    answers += [broken, body()]
    assert list(reader.read(paged.Page("a", 1)))[0][2:] == (body(), None) and naps == [1.0]
    answers += [broken] * 3  # it stays: the body goes on, to be counted as a retry
    assert list(reader.read(paged.Page("a", 1)))[0][2] == broken
    naps.clear()
    answers += [500, 403, 403, 403, body()]
    assert list(reader.read(paged.Page("a", 1)))[0][3] == "HTTP 403" and naps == [1.0, 1.0]
    # the third refusal in a row comes with the next page: the long pause, then it goes on
    assert list(reader.read(paged.Page("a", 2)))[0][2] == body() and [round(n) for n in naps] == [1, 1, 60]


def test_dashboard_of_nothing(spark):
    ads = spark.createDataFrame([], "id_ad string, make_name string, model_name string, region string, price int, mileage int, created_at timestamp_ntz, sold_at timestamp_ntz")
    row = A.dashboard_body(ads, "2024-01-01 00:00:00").first()
    assert row.general.most_popular_make == row.general.most_popular_model == "N/A" and row.top_makes == row.recent_trends == [] and row.summary.data_sources == 0


def test_cache_is_kept_and_refreshed(spark):
    calls = []
    cache = CachedFrame(lambda: calls.append(1) or spark.range(2).toDF("x"))
    assert cache.get().count() == 2 and cache.get() is cache.get() and len(calls) == 1
    cache.refresh()
    assert len(calls) == 2 and cache.info()["cached"]
    with pytest.raises(ValueError):
        CachedFrame(lambda: spark.range(0).toDF("x")).get()


def test_catalogue_is_stored_whole_or_not_at_all(spark, tmp_path):
    text = lambda *entries: spark.createDataFrame([("// makes\n" + json.dumps([{"name": "filter_enum_make", **e} for e in entries]),)], "value string")
    path = str(tmp_path / "makes")
    assert I.store_catalogue(text({"value": "fiat"}, {"value": "Alfa Romeo", "canonical": "alfa"}), path) == {"added": 2, "skipped": 0, "errors": 0}
    assert I.store_catalogue(text({"value": "seat"}, {"value": ""}), path) == {"added": 0, "skipped": 0, "errors": 1}
    assert I.store_catalogue(text({"value": "fiat"}, {"value": "seat"}), path) == {"added": 1, "skipped": 1, "errors": 0}
    assert sorted(r.slug for r in spark.read.parquet(path).collect()) == ["alfa", "fiat", "seat"]
