"""The streams end in what the batch forms give; a replayed, killed or restarted batch changes nothing, and micro-batch borders don't show."""

import json
import shutil
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pyarrow as pa
import pyarrow.fs as pf
import pytest
from pyspark.sql import functions as F

from adlake.operators import state as S
from adlake.plans import registry
from adlake.sources.paged import PagedResponses, crawl, crawl_stream
from adlake.sources.shared_files import Breaker, Folder
from adlake.streaming import jobs, sink
from adlake.streaming import keyed as K

SF = "/root/testdata/sf0.001"


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet").cache()


def part(events, batch):
    return events.where((F.col("event_id") >= batch * 400) & (F.col("event_id") < (batch + 1) * 400 if batch < 2 else F.lit(True)))


def put(events, path, batch):
    part(events, batch).coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.02)  # files are taken by their times


def run(spark, path, base, events):
    listing = jobs.ListingStream(spark, base)
    listing.run(jobs.from_events(jobs.files(spark, path, events.schema, 1)))
    return listing


def whole(listing, events):
    m = jobs.from_events(events)
    assert same(listing.current().select("id_ad", "make_name", "price", "source_name", "created_at"), S.upsert(m).select("id_ad", "make_name", "price", "source_name", "created_at"))
    log = S.price_history(m.withColumn("price_set", F.lit(True))).select(F.col("id_ad").alias("auto_ad_id"), "offset", "price", "status")
    assert same(listing.history().select("auto_ad_id", "offset", "price", "status"), log)


def test_stream_equals_batch(spark):
    assert same(jobs.stream_upsert(spark, SF), registry.upsert_state(spark, SF))
    assert same(jobs.stream_sold(spark, SF), registry.sold_state(spark, SF))


def test_goes_on_from_the_checkpoint(spark, tmp_path, events):
    """Stopped between batches and started again, and started with nothing new."""
    path, base = str(tmp_path / "in"), str(tmp_path / "table")
    put(events, path, 0)
    run(spark, path, base, events)
    put(events, path, 1)
    put(events, path, 2)
    listing = run(spark, path, base, events)
    whole(listing, events)
    whole(run(spark, path, base, events), events)


def test_killed_batch_is_replayed(spark, tmp_path, events):
    """The last micro-batch wrote its log and its state, but died before its commit."""
    path, base = str(tmp_path / "in"), str(tmp_path / "table")
    for batch in (0, 1, 2):
        put(events, path, batch)
    run(spark, path, base, events)
    commits = sorted((tmp_path / "table" / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (tmp_path / "table" / "checkpoint" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    whole(run(spark, path, base, events), events)


def messages(spark, path, texts, start=0):
    spark.createDataFrame([(start + k, json.dumps(t)) for k, t in enumerate(texts)], "offset long, value string").coalesce(1).write.mode("append").parquet(path)
    return jobs.ad_messages(jobs.files(spark, path, "offset long, value string"))


def test_only_held_fields_are_written(spark, tmp_path):
    base = {"source_ad_id": "1", "url": "u", "source_name": "s", "country_code": "PL", "scraped_at": "2024-01-01T00:00:00Z"}
    texts = [
        base | {"price": 100, "make_str": "audi", "city_str": "Gdynia"},
        base | {"price": None, "make_name": "seat"},  # a held null, and the table's own spelling
        base | {"year": 2020},  # no price: it stays, and no change is logged
        {k: v for k, v in base.items() if k != "url"} | {"price": 1},  # not valid
    ]
    one = jobs.ListingStream(spark, str(tmp_path / "one"))
    one.run(messages(spark, str(tmp_path / "all"), texts))
    many = jobs.ListingStream(spark, str(tmp_path / "many"))
    for k, t in enumerate(texts):
        many.run(messages(spark, str(tmp_path / "each"), [t], k))
    for listing in (one, many):
        row = listing.current().first()
        assert (row.price, row.make_name, row.city, row.year) == (None, "seat", "Gdynia", 2020)
        assert sorted((r.status, r.price) for r in listing.history().collect()) == [("active", 100), ("price_changed", None)]


@pytest.mark.parametrize("each_batch", [None, 1])
def test_snapshots_count_one_by_one(spark, tmp_path, each_batch):
    """Snapshots [1, 2] and [1] of one source and make close 2 and 3, whether they come in one batch or in two."""
    ad = {"url": "u", "source_name": "s", "country_code": "PL", "scraped_at": "2024-01-01T00:00:00Z", "make_str": "land-rover", "price": 7}
    listing = jobs.ListingStream(spark, str(tmp_path / "table"))
    ads = messages(spark, str(tmp_path / "ads"), [ad | {"source_ad_id": str(i)} for i in (1, 2, 3)] + [ad | {"source_ad_id": "9", "make_str": "zuk"}])
    listing.run(ads)
    for k, ids in enumerate((["1", "2"], ["1"])):
        text = json.dumps({"source_name": "s", "make_str": "rover", "ad_ids": ids})
        spark.createDataFrame([(k, text)], "offset long, value string").coalesce(1).write.mode("append").parquet(str(tmp_path / "shown"))
        time.sleep(0.02)
    shown = jobs.snapshot_messages(jobs.files(spark, str(tmp_path / "shown"), "offset long, value string", each_batch))
    listing.close_unseen(shown, "2024-02-01 00:00:00")
    listing.run(ads)
    assert sorted(r.id_ad for r in listing.current().where("sold_at IS NOT NULL").collect()) == ["2", "3"]
    assert sorted((r.auto_ad_id, r.price) for r in listing.history().where("status = 'sold'").collect()) == [("2", 7), ("3", 7)]
    # seen again, an ad stays sold; a snapshot that doesn't show it closes it no second time
    listing.run(messages(spark, str(tmp_path / "ads"), [ad | {"source_ad_id": "2", "price": 8}], 10))
    spark.createDataFrame([(5, '{"source_name":"s","make_str":"rover","ad_ids":["1"]}')], "offset long, value string").write.mode("append").parquet(str(tmp_path / "shown"))
    listing.close_unseen(shown, "2024-03-01 00:00:00")
    listing.run(ads)
    assert listing.history().where("status = 'sold'").count() == 2 and str(listing.current().where("id_ad = '2'").first().sold_at) == "2024-02-01 00:00:00"


def test_snapshot_messages(spark):
    raw = spark.createDataFrame([(0, '{"source_name":"s","ad_ids":["1","1"],"make_str":"m"}')], "offset long, value string")
    assert tuple(jobs.snapshot_messages(raw).first())[1:] == ("s", ["1", "1"], "m")


PAGES = "source_name string, run string, make_str string, page int, pages int, ids array<string>, at timestamp"


def complete(spark, base, patience=3600):
    with K.state_store(spark):
        rows = K.completion(jobs.files(spark, f"{base}/pages", PAGES, 1), patience)
        rows.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/cp").trigger(availableNow=True).start().awaitTermination()
    return Counter((r.source_name, r.make_str, r.id_ad) for r in spark.read.schema(K.SNAPSHOT).parquet(f"{base}/out").collect())


def test_makes_complete_once(spark, tmp_path):
    base = str(tmp_path)

    def add(*rows, at="2024-01-01 00:00:00"):
        spark.createDataFrame([(*r, at) for r in rows], PAGES.replace("timestamp", "string")).withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{base}/pages")
        time.sleep(0.02)

    add(("s", "r", "fiat", 2, 3, ["c", "d"]), ("s", "r", "seat", 1, 2, ["x"]))
    assert complete(spark, base) == {}
    add(("s", "r", "fiat", 1, 3, ["a", "b"]), ("s", "r", "fiat", 1, 3, ["a", "b"]), ("s", "r", "tatra", 1, 0, []))
    assert complete(spark, base) == {("s", "tatra", None): 1}  # two of three pages, one of them twice; an empty make has one page
    add(("s", "r", "fiat", 3, 3, ["d", "e"]), ("s", "r2", "fiat", 1, 1, ["a"]))
    want = {("s", "tatra", None): 1, **{("s", "fiat", i): 1 for i in "bcde"}, ("s", "fiat", "a"): 2}  # another run is another snapshot
    assert complete(spark, base) == want
    add(("s", "r", "fiat", 3, 3, ["d", "e"]))  # again, after the snapshot
    add(("s", "r", "skoda", 1, 2, ["k"]), at="2024-01-01 09:00:00")  # time goes on: seat is given up
    add(("s", "r", "skoda", 1, 2, ["k"]), at="2024-01-01 09:00:01")
    add(("s", "r", "seat", 2, 2, ["y"]), at="2024-01-01 09:00:02")
    assert complete(spark, base) == want


def body(ids, total):
    return json.dumps({"data": {"advertSearch": {"totalCount": total, "edges": [{"node": {"id": i}} for i in ids]}}})


class Source(ThreadingHTTPServer):
    """Makes with pages of 50; counts requests, and refuses where `refuse` says so."""

    def __init__(self, totals, refuse=lambda make, page, n: False, ready=lambda make: True):
        self.asked, self.when, self.lock = Counter(), [], threading.Lock()
        server = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                _, make, page = self.path.split("/")
                with server.lock:
                    server.asked[make, int(page)] += 1
                    n = server.asked[make, int(page)]
                    server.when.append((time.time(), make, int(page)))
                while not ready(make):
                    time.sleep(0.01)
                bad = refuse(make, int(page), n)
                data = b"" if bad else body([f"{make}{page}"], totals[make]).encode()
                self.send_response(403 if bad else 200)
                self.send_header("Content-Length", str(len(data)))
                self.end_headers()
                self.wfile.write(data)

            def log_message(self, *a):
                pass

        super().__init__(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.serve_forever, daemon=True).start()
        self.template = f"http://127.0.0.1:{self.server_port}/{{make}}/{{page}}"


def read_on(df, base, batches=None):
    """Runs the stream for so many micro-batches, or until nothing has come for three seconds."""
    query = df.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/cp").trigger(processingTime="0 seconds").start()
    try:
        end = time.time() + 90
        while batches is not None and time.time() < end and sum(1 for p in query.recentProgress if p.numInputRows) < batches:
            time.sleep(0.05)
        seen, since = -1, time.time()
        while batches is None and time.time() < end and time.time() - since < 3:
            time.sleep(0.05)
            if (n := sum(1 for p in query.recentProgress if p.numInputRows)) != seen:
                seen, since = n, time.time()
    finally:
        query.stop()


def test_paged_stream_equals_the_crawl_and_goes_on(spark, tmp_path):
    totals = {"fiat": 320, "tatra": 0, "seat": 51, "zuk": 50}
    source, base = Source(totals), str(tmp_path)
    stream = crawl_stream(spark, list(totals), source.template, f"{base}/plan", pages_per_batch="3", pause="0")
    read_on(stream, base, 2)
    before = Counter(source.asked)
    committed = spark.read.parquet(f"{base}/out").select("make", "page").collect()
    assert before and len(committed) >= 6
    read_on(crawl_stream(spark, list(totals), source.template, f"{base}/plan", pages_per_batch="3", pause="0"), base)
    assert all(source.asked[r.make, r.page] == before[r.make, r.page] for r in committed)  # what was committed is not asked for again
    got = spark.read.parquet(f"{base}/out")
    assert same(got.select("make", "page", "body", "error"), crawl(spark, list(totals), source.template, pause="0"))
    assert {(r.make, r.pages) for r in got.collect()} == {("fiat", 7), ("tatra", 1), ("seat", 2), ("zuk", 1)}
    source.shutdown()


def test_refusals_on_one_worker_pause_the_other(spark, tmp_path):
    """Three refusals of one make's page hold the requests of all tasks."""
    # b's first answers come after a's three refusals, as an answer in between would start the count again
    source = Source({"a": 50, "b": 50}, lambda make, page, n: make == "a" and n <= 3, lambda make: make == "a" or source.asked["a", 1] >= 3)
    spark.dataSource.register(PagedResponses)
    options = {"url_template": source.template, "plan": "a:1-1,b:1-40", "pause": "0.1", "long_pause": "2", "breaker_path": str(tmp_path / "breaker")}
    rows = spark.read.format("paged").options(**options).load().collect()
    assert [r.error for r in rows if r.make == "a"] == ["HTTP 403"] and all(r.error is None for r in rows if r.make == "b")
    times = sorted(t for t, _, _ in source.when)
    assert max(b - a for a, b in zip(times, times[1:], strict=False)) > 1.0  # nobody asked meanwhile
    source.shutdown()


def test_breaker(tmp_path):
    one, other = Breaker(str(tmp_path), 3, 60), Breaker(str(tmp_path), 3, 60)
    one.refused(), other.refused(), other.succeeded(), one.refused(), one.refused()
    assert not one.held()
    other.refused()
    assert 50 < one.held() <= 60 and 50 < other.held() <= 60


class Flaky(pf.FileSystemHandler if hasattr(pf, "FileSystemHandler") else object):
    """The local file system, whose first openings fail."""

    def __init__(self, failures):
        self.local, self.failures = pf.LocalFileSystem(), failures

    def open_output_stream(self, path, metadata):
        if self.failures:
            self.failures -= 1
            raise OSError("not now")
        return self.local.open_output_stream(path)

    def __getattr__(self, name):
        return getattr(self.local, name)

    def create_dir(self, path, recursive):
        self.local.create_dir(path, recursive=recursive)

    def move(self, src, dest):
        self.local.move(src, dest)

    def delete_file(self, path):
        self.local.delete_file(path)

    def get_file_info(self, paths):
        return self.local.get_file_info(paths)

    def get_file_info_selector(self, selector):
        return self.local.get_file_info(selector)

    def open_input_stream(self, path):
        return self.local.open_input_stream(path)

    def normalize_path(self, path):
        return path

    def get_type_name(self):
        return "flaky"

    copy_file = delete_dir = delete_dir_contents = delete_root_dir_contents = open_append_stream = open_input_file = None


Flaky.__abstractmethods__ = frozenset()


@pytest.mark.parametrize(("failures", "works"), [(2, True), (3, False)])
def test_failing_writes_are_tried_again(spark, tmp_path, failures, works):
    folder = Folder(str(tmp_path), pf.PyFileSystem(Flaky(failures)))
    writer = sink.RoutedWriter({"path": str(tmp_path), "tries": "3", "pause": "0.01"}, folder)
    batch = pa.RecordBatch.from_pydict({"topic": ["a", None, "a", "rejected"], "x": [1, 2, 3, 4]})
    if not works:
        with pytest.raises(OSError):
            writer.write(iter([batch]))
        return
    done = writer.write(iter([batch]))
    assert [(t, n) for t, _, n in done.files] == [("a", 2), ("rejected", 1)]
    writer.commit([done, None], 0)
    assert [r.x for r in sink.committed(spark, str(tmp_path), "a", "topic string, x long").orderBy("x").collect()] == [1, 3]


def test_a_death_before_the_commit(spark, tmp_path, events):
    """Its files are there, but count for nothing; the batch comes again, and once."""
    path, out, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    put(events, path, 0)
    routed = lambda: sink.split(jobs.I.coerce(jobs.raw_messages(jobs.files(spark, path, events.schema))), jobs.I.REQUIRED_AD, "ads")
    go = lambda: sink.start(routed(), out, cp).trigger(availableNow=True).start().awaitTermination()
    go()
    shutil.rmtree(f"{out}/_commits")  # the files are written, the commit is not
    for name in ("0", ".0.crc"):
        (tmp_path / "cp" / "commits" / name).unlink(missing_ok=True)
    schema = routed().schema
    assert sum(1 for _ in (tmp_path / "out" / "ads").iterdir()) >= 1
    go()
    put(events, path, 1)
    go()
    both = events.where("event_id < 800")
    bad = (F.col("event_id") % 13 == 0) | (F.col("event_id") % 11 == 0)
    assert sorted(r[0] for r in sink.committed(spark, out, "ads", schema).select("offset").collect()) == sorted(r[0] for r in both.where(~bad).select("event_id").collect())
    assert sorted(r[0] for r in sink.committed(spark, out, sink.REJECTED, schema).select("offset").collect()) == sorted(r[0] for r in both.where(bad).select("event_id").collect())
    # a batch whose commit is there but not in the checkpoint leaves no second copy
    for name in ("1", ".1.crc"):
        (tmp_path / "cp" / "commits" / name).unlink(missing_ok=True)
    go()
    assert sink.committed(spark, out, "ads", schema).count() == both.where(~bad).count()
    assert sink.committed(spark, out, "none", schema).count() == 0
