"""A data source of paged responses, in batches and as a stream: one partition a page, retries with a pause, one body a row.

spark.dataSource.register(PagedResponses); spark.read.format("paged").options(...).load() reads `url_template` with {make} and
{page}. file:// templates serve recorded responses; http(s) ones are fetched by the tasks.

As a stream the makes are crawled one after the other: a make's first page tells how many there are, and each micro-batch takes up to `pages_per_batch` of them.
What is planned is logged in `plan_path`, a shared folder, before it is handed out, so offsets are numbers of steps in that log and a restarted query goes on with the next
one. While the crawl's breaker (`breaker_path`) holds, nothing is admitted.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from adlake.operators.ingest import PAGE, page_plan
from adlake.sources.shared_files import Breaker, Folder

#: Tries of a page, seconds between them, refusals in a row before the long pause, and that pause.
TRIES, PAUSE, REFUSALS, LONG_PAUSE = 3, 5.0, 3, 300.0


@dataclass
class Page(InputPartition):
    make: str
    page: int
    pages: int | None = None
    body: str | None = None  # what planning has fetched already
    error: str | None = None


def _reported(body: str) -> bool:
    """The source answers 200 but reports an internal error, which another try may mend."""
    try:
        errors = json.loads(body).get("errors") or []
        return any("Internal Error" in str(e.get("message")) for e in errors)
    except (ValueError, AttributeError):
        return False


def _total(body: str | None) -> int:
    try:
        return int(json.loads(body or "")["data"]["advertSearch"]["totalCount"])
    except (ValueError, TypeError, KeyError):
        return 0


class _Fetcher:
    def __init__(self, options: dict):
        self.template = options["url_template"]
        self.pause, self.long_pause = float(options.get("pause", PAUSE)), float(options.get("long_pause", LONG_PAUSE))
        self.breaker_path = options.get("breaker_path")

    def breaker(self) -> Breaker:
        return Breaker(self.breaker_path, REFUSALS, self.long_pause)

    def fetch(self, make: str, page: int) -> tuple[str | None, str | None]:
        """(body, error) after up to TRIES tries, none of them while the breaker holds."""
        import urllib.error
        import urllib.request

        url, body, error, breaker = self.template.format(make=make, page=page), None, None, self.breaker()
        for attempt in range(TRIES):
            breaker.wait()
            try:
                with urllib.request.urlopen(url, timeout=30) as r:
                    body, error = r.read().decode("utf-8", "replace"), None
                breaker.succeeded()
                if not _reported(body):
                    break
            except urllib.error.HTTPError as e:
                breaker.refused() if e.code == 403 else breaker.succeeded()
                body, error = None, f"HTTP {e.code}"
            except OSError as e:
                body, error = None, str(e)[:200]
            if attempt < TRIES - 1 and not breaker.held():
                time.sleep(self.pause)
        return body, error


class PagedReader(DataSourceReader, _Fetcher):
    def __init__(self, options: dict):
        _Fetcher.__init__(self, options)
        # "make:first-last" (or "make:pages") items, as the page plan gives them
        self.plan = []
        for make, pages in (x.rsplit(":", 1) for x in options["plan"].split(",") if x):
            first, _, last = pages.rpartition("-")
            self.plan.append((make, int(first or 1), int(last)))

    def partitions(self) -> list[Page]:
        return [Page(m, p) for m, first, last in self.plan for p in range(first, last + 1)]

    def read(self, partition: Page) -> Iterator[tuple]:
        yield partition.make, partition.page, *self.fetch(partition.make, partition.page)


class PagedStream(DataSourceStreamReader, _Fetcher):
    """Steps {"make", "first", "last", "pages"[, "body", "error"]}, each a file of the plan's log; the offset {"step": n} stands after n steps."""

    def __init__(self, options: dict):
        _Fetcher.__init__(self, options)
        self.makes = [m for m in options["makes"].split(",") if m]
        self.log, self.most, self.began = Folder(options["plan_path"]), int(options.get("pages_per_batch", 20)), False

    def initialOffset(self) -> dict:
        return {"step": 0}

    def latestOffset(self) -> dict:
        done = len(self.log.names())
        if not self.began and done:  # a restart: what was planned comes first
            self.began = True
            return {"step": done}
        self.began = True
        if self.breaker().held():
            return {"step": done}
        step = self._next(json.loads(self.log.read(f"{done:09d}")) if done else None)
        if step is None:
            return {"step": done}
        self.log.write(f"{done + 1:09d}", json.dumps(step))
        return {"step": done + 1}

    def _next(self, last: dict | None) -> dict | None:
        if last is not None and last["last"] < last["pages"]:
            first = last["last"] + 1
            return {"make": last["make"], "first": first, "last": min(first + self.most - 1, last["pages"]), "pages": last["pages"]}
        at = 0 if last is None else last["make"] + 1
        if at == len(self.makes):
            return None
        body, error = self.fetch(self.makes[at], 1)
        pages = max(1, math.ceil(_total(body) / PAGE))
        return {"make": at, "first": 1, "last": min(self.most, pages), "pages": pages, "body": body, "error": error}

    def partitions(self, start: dict, end: dict) -> list[Page]:
        out = []
        for n in range(start["step"] + 1, end["step"] + 1):
            s = json.loads(self.log.read(f"{n:09d}"))
            for p in range(s["first"], s["last"] + 1):
                fetched = p == 1 and (s.get("body") is not None or s.get("error") is not None)
                out.append(Page(self.makes[s["make"]], p, s["pages"], s["body"] if fetched else None, s["error"] if fetched else None))
        return out

    def read(self, partition: Page) -> Iterator[tuple]:
        p = partition
        body, error = (p.body, p.error) if p.body is not None or p.error is not None else self.fetch(p.make, p.page)
        yield p.make, p.page, body, error, p.pages


class PagedResponses(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "make string, page int, body string, error string" + (", pages int" if "plan_path" in self.options else "")

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)

    def streamReader(self, schema) -> PagedStream:
        return PagedStream(self.options)


def crawl(spark: SparkSession, makes: list[str], url_template: str, **options: str) -> DataFrame:
    """All pages of the makes: the first pages tell how many there are, then the others are read. The driver gets one total a make."""
    spark.dataSource.register(PagedResponses)
    load = lambda plan: spark.read.format("paged").options(url_template=url_template, plan=plan, **options).load()
    first = load(",".join(f"{m}:1" for m in makes)).persist()
    total = F.get_json_object("body", "$.data.advertSearch.totalCount").try_cast("int")
    last = {r.make: r.last for r in page_plan(first.select("make", total.alias("total"))).groupBy("make").agg(F.max("page").alias("last")).collect()}
    return first.union(load(",".join(f"{m}:2-{n}" for m, n in sorted(last.items()) if n > 1)))


def crawl_stream(spark: SparkSession, makes: list[str], url_template: str, plan_path: str, **options: str) -> DataFrame:
    """The same pages as a stream (make, page, body, error, pages), make by make."""
    spark.dataSource.register(PagedResponses)
    return spark.readStream.format("paged").options(url_template=url_template, makes=",".join(makes), plan_path=plan_path, **options).load()
