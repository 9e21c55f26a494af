"""Paged trip source (S17) as a Python Data Source, batch and stream.

``spark.read.format("trip_pages")`` plans one input partition per (service,
year, month); each task requests pages 1, 2, ... until a page comes back
empty, yielding rows as it goes (a month is never held whole).  Filters on the
service, year or month are pushed down, so only the months that pass are
planned and requested.

``spark.readStream.format("trip_pages")`` keeps the next page of every month as
its offset.  A micro-batch asks how far each month goes now (``head`` requests
only), reads the new pages in tasks of ``pages_per_task`` and never requests a
page of an earlier batch again; a replayed batch reads the pages of its range.

``fetch`` and ``head`` are ``module:function`` names, or one of the built-in
pairs ``http`` (GET / HEAD on the url template) and ``landed`` (pages landed as
JSON lines: a folder each, or ``RUN_PAGES`` pages to a folder where the template
names ``{run}``; the lines then hold their ``page``).  fetch(url, taxi, year,
month, page, page_size) gives the rows of a page, an empty list behind the last
one; head(the same) says whether the page exists.
"""

from __future__ import annotations

import importlib
import json
import operator
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import datasource as ds

SCHEMA = (
    "taxi_type string, year int, month int, page int, "
    "pickup_datetime string, dropoff_datetime string, PULocationID long, DOLocationID long, "
    "fare_amount double, tip_amount double, total_amount double, payment_type long"
)
FIELDS = ["pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID",
          "fare_amount", "tip_amount", "total_amount", "payment_type"]
_TYPES = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
ARROW = pa.schema([(name, _TYPES[kind]) for name, kind in (c.split() for c in SCHEMA.split(", "))])
#: Tasks of a micro-batch, about: those of a larger one read more pages each.
BATCH_TASKS = 1000
#: Rows of a batch that a task hands on, at least.
BATCH_ROWS = 4000


def http_fetch(url: str, taxi: str, year: int, month: int, page: int, page_size: int) -> list[dict]:
    from urllib.request import urlopen

    with urlopen(url.format(taxi=taxi, year=year, month=month, page=page, page_size=page_size), timeout=60) as r:  # noqa: S310 - caller-provided endpoint
        body = json.loads(r.read().decode("utf-8"))
    return body if isinstance(body, list) else body.get("data", [])


def http_head(url: str, taxi: str, year: int, month: int, page: int, page_size: int) -> bool:
    from urllib.error import HTTPError
    from urllib.request import Request, urlopen

    try:
        with urlopen(Request(url.format(taxi=taxi, year=year, month=month, page=page, page_size=page_size), method="HEAD"), timeout=60):  # noqa: S310
            return True
    except HTTPError as e:
        if e.code == 404:
            return False
        raise


#: Pages of a ``{run}`` folder: 1 .. RUN_PAGES lie in run 0, and so on.
RUN_PAGES = 20


def run_of(page):
    """Run of a page (a number or a column of them)."""
    return (page - 1) // RUN_PAGES if isinstance(page, int) else ((page - 1) / RUN_PAGES).cast("int")


def _landed(url: str, taxi: str, year: int, month: int, page: int, page_size: int):
    """File system and JSON files of a landed page, or of its run."""
    from pyarrow import fs

    folder = url.format(taxi=taxi, year=year, month=month, page=page, page_size=page_size, run=run_of(page))
    store, path = fs.FileSystem.from_uri(folder) if ":" in folder.split("/", 1)[0] else (fs.LocalFileSystem(), folder)
    files = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return store, sorted((f for f in files if f.base_name.endswith(".json")), key=lambda f: f.path)


def _bytes(store, file) -> bytes:
    with store.open_input_stream(file.path) as s:
        return s.read()


#: The run read last: its files, and its rows by page.  Pages are asked for in turn.
_run: tuple[list, dict[int, list[dict]]] = ([], {})


def landed_fetch(url: str, *page) -> list[dict]:
    global _run
    store, files = _landed(url, *page)
    if "{run}" not in url:
        return [json.loads(line) for f in files for line in _bytes(store, f).splitlines()]
    held = [(f.path, f.size, f.mtime_ns) for f in files]
    if _run[0] != held:
        rows: dict[int, list[dict]] = {}
        for f in files:
            for line in _bytes(store, f).splitlines():
                row = json.loads(line)
                rows.setdefault(row["page"], []).append(row)
        _run = held, rows
    return _run[1].get(page[3], [])


def landed_head(url: str, *page) -> bool:
    store, files = _landed(url, *page)
    if "{run}" not in url:
        return bool(files)
    mark = re.compile(rb'"page"\s*:\s*%d\s*[,}]' % page[3])
    return any(mark.search(_bytes(store, f)) for f in files)


@dataclass
class PageRange(ds.InputPartition):
    """Pages first .. last of a month; ``last`` None: up to the first empty one."""

    taxi: str
    year: int
    month: int
    first: int = 1
    last: int | None = None


class PageClient:
    """The options of a read, and the pages behind them."""

    def __init__(self, options: dict):
        self.url = options.get("url", "")
        self.page_size = int(options.get("page_size", "1000"))
        self.pages_per_task = int(options.get("pages_per_task", "20"))
        pair = {"http": (http_fetch, http_head), "landed": (landed_fetch, landed_head)}
        name = options.get("fetch", "http")
        self.fetch, self.head = pair.get(name, (name, options.get("head", "")))
        taxis = [t for t in options.get("taxi", "green").split(",") if t]
        months = [tuple(map(int, m.split("-"))) for m in options.get("months", "").split(",") if m]
        self.months = [(t, y, m) for t in taxis for y, m in months]

    @staticmethod
    def _function(spec):
        if callable(spec):
            return spec
        module, _, name = spec.partition(":")
        return getattr(importlib.import_module(module), name)

    def exists(self, month: tuple, page: int) -> bool:
        return bool(self._function(self.head)(self.url, *month, page, self.page_size))

    def next_page(self, month: tuple, page: int) -> int:
        """First page from ``page`` on that does not exist, in a number of
        ``head`` requests that grows with the logarithm of the new pages."""
        step = 1
        while self.exists(month, page + step - 1):
            step *= 2
        low, high = page + step // 2, page + step - 1  # low: first page not known to exist
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if self.exists(month, middle) else (low, middle)
        return low

    def rows(self, part: PageRange):
        """Arrow batches of at least ``BATCH_ROWS`` rows, but for the last."""
        fetch, page, held, pages = self._function(self.fetch), part.first, [], []
        while part.last is None or page <= part.last:
            rows = fetch(self.url, part.taxi, part.year, part.month, page, self.page_size)
            if not rows:
                break
            held += rows
            pages += [page] * len(rows)
            page += 1
            if len(held) >= BATCH_ROWS:
                yield _batch(part, pages, held)
                held, pages = [], []
        if held:
            yield _batch(part, pages, held)


def _text(value):
    return value if value is None or isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


def _batch(part: PageRange, pages: list[int], rows: list[dict]) -> pa.RecordBatch:
    n = len(rows)
    cols = [[part.taxi] * n, [part.year] * n, [part.month] * n, pages]
    for f in FIELDS:
        values = [r.get(f) for r in rows]
        cols.append([_text(v) for v in values] if pa.types.is_string(ARROW.field(f).type) else values)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, ARROW.types)], schema=ARROW)


COMPARED = {
    ds.EqualTo: operator.eq, ds.GreaterThan: operator.gt, ds.GreaterThanOrEqual: operator.ge,
    ds.LessThan: operator.lt, ds.LessThanOrEqual: operator.le, ds.In: lambda x, values: x in values,
}


class TripPagesReader(ds.DataSourceReader):
    def __init__(self, options: dict):
        self.client = PageClient(options)

    def pushFilters(self, filters):
        """Uses the filters on the service, year and month; Spark applies the others."""
        place = {("taxi_type",): 0, ("year",): 1, ("month",): 2}
        for f in filters:
            compare = COMPARED.get(type(f))
            at = place.get(getattr(f, "attribute", None))
            if at is not None and isinstance(f, ds.IsNotNull):
                continue  # these columns are never null
            if at is None or compare is None:
                yield f
                continue
            self.client.months = [m for m in self.client.months if compare(m[at], f.value)]

    def partitions(self):
        return [PageRange(*m) for m in self.client.months]

    def read(self, partition: PageRange):
        if partition is None:  # no month left: zero partitions planned
            return iter(())
        return self.client.rows(partition)


class TripPagesStreamReader(ds.DataSourceStreamReader):
    """Offsets: ``taxi/year/month`` -> next page to read."""

    def __init__(self, options: dict):
        self.client = PageClient(options)
        self.seen: dict[str, int] = {}

    @staticmethod
    def _key(month: tuple) -> str:
        return "/".join(map(str, month))

    def initialOffset(self) -> dict:
        return {self._key(m): 1 for m in self.client.months}

    def latestOffset(self) -> dict:
        self.seen = {self._key(m): self.client.next_page(m, self.seen.get(self._key(m), 1)) for m in self.client.months}
        return self.seen

    def partitions(self, start: dict, end: dict):
        parts, ranges = [], [(m, start.get(self._key(m), 1), end.get(self._key(m), 1)) for m in self.client.months]
        least, pages = self.client.pages_per_task, sum(max(0, stop - first) for _, first, stop in ranges)
        size = least * max(1, -(-pages // (BATCH_TASKS * least)))
        for month, first, stop in ranges:
            for turn in range((first - 1) // size, -(-(stop - 1) // size)):  # cut where runs of pages are
                parts.append(PageRange(*month, max(first, turn * size + 1), min(stop - 1, (turn + 1) * size)))
        return parts

    def read(self, partition: PageRange):
        return self.client.rows(partition)

    def commit(self, end: dict) -> None:
        self.seen = {k: max(self.seen.get(k, 1), v) for k, v in end.items()}


class TripPagesSource(ds.DataSource):
    """Options: ``url`` (template with {taxi} {year} {month} {page}
    {page_size}), ``taxi`` (comma list), ``months`` (comma list of YYYY-MM),
    ``page_size`` (default 1000), ``pages_per_task`` (streams, default 20),
    ``fetch`` and ``head``."""

    @classmethod
    def name(cls):
        return "trip_pages"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return TripPagesReader(self.options)

    def streamReader(self, schema):
        return TripPagesStreamReader(self.options)


def register(spark) -> None:
    """Makes the format known to the session; filters are pushed into it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TripPagesSource)
