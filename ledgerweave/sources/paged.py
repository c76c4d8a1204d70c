"""A paged remote API as a Spark data source: one partition per page range, batch or stream.

The transport is a function ``fetch(url) -> str``; ``file:`` URLs are read from disk, so that the source is
tested without a network. Pages are ``{"rows": [...], "total": n}`` JSON documents.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, InputPartition
from pyspark.sql.types import StructType


def with_retry(fetch: Callable[[], str], tries: int = 3, pause: float = 1.0) -> str:
    """Call again on failure, with a pause that grows with the attempt."""
    for attempt in range(tries):
        try:
            return fetch()
        except OSError:
            if attempt == tries - 1:
                raise
            time.sleep(pause * (attempt + 1))
    raise AssertionError


def fetch_page(base: str, term: str, skip: int, top: int, tries: int, pause: float, where: str = "", order: str = "") -> dict:
    """One page. A filter and an order go to the remote side; stored pages (``file:``) are as they were asked for."""
    asked = {"search": term, "$skip": skip, "$top": top, **({"$filter": where} if where else {}), **({"$orderby": order} if order else {})}
    url = f"{base}?" + urllib.parse.urlencode(asked)
    if base.startswith("file:"):
        url = f"{base}/{urllib.parse.quote(term, safe='')}/{skip}.json" if term else f"{base}/{skip}.json"

    def read() -> str:
        with urllib.request.urlopen(url, timeout=45) as answer:  # noqa: S310
            return answer.read().decode("utf-8")

    try:
        return json.loads(with_retry(read, tries, pause))
    except urllib.error.URLError as error:
        # a folder of stored pages ends where there is no further file; anything else is an error
        if base.startswith("file:") and skip and isinstance(error.reason, FileNotFoundError):
            return {"rows": []}
        raise


class _Pages(InputPartition):
    def __init__(self, first: int, last: int | None) -> None:
        self.first, self.last = first, last


def _rows(page: dict, schema: StructType) -> Iterator[tuple]:
    for row in page.get("rows", []):
        yield tuple(None if row.get(f.name) is None else str(row[f.name]) for f in schema.fields)


class PagedReader(DataSourceReader):
    """All rows there are: the first page says how many (``total``), and page ranges are read by different tasks; without a
    total one task reads on until a page is short. ``max_rows`` is a limit only if it is given."""

    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema = schema
        self.base, self.term = options["url"], options.get("term", "")
        self.where, self.order = options.get("filter", ""), options.get("orderby", "")
        self.top, self.most = int(options.get("page_size", 100)), int(options["max_rows"]) if "max_rows" in options else None
        self.per_task, self.tries, self.pause = int(options.get("pages_per_task", 10)), int(options.get("tries", 3)), float(options.get("pause", 1.0))

    def page(self, skip: int) -> dict:
        return fetch_page(self.base, self.term, skip, self.top, self.tries, self.pause, self.where, self.order)

    def partitions(self) -> list[InputPartition]:
        total = self.page(0).get("total")
        total = min((x for x in (total, self.most) if x is not None), default=None)
        if total is None:
            return [_Pages(0, None)]
        pages = -(-int(total) // self.top)
        return [_Pages(i, min(i + self.per_task, pages)) for i in range(0, pages, self.per_task)]

    def read(self, partition: _Pages) -> Iterator[tuple]:
        number = partition.first
        while partition.last is None or number < partition.last:
            rows = list(_rows(self.page(number * self.top), self.schema))
            if self.most is not None:
                rows = rows[: max(0, self.most - number * self.top)]
            yield from rows
            if len(rows) < self.top:  # a short or empty page is the last
                return
            number += 1


class PushingReader(PagedReader):
    """Needs ``spark.sql.python.filterPushdown.enabled``."""

    def pushFilters(self, filters: list) -> Iterator:  # noqa: N802
        """Equality with a text is asked of the remote side, except of stored pages; Spark applies the rest."""
        for f in filters:
            if isinstance(f, EqualTo) and isinstance(f.value, str) and not self.base.startswith("file:"):
                quoted = f.value.replace("'", "''")
                self.where = " and ".join(x for x in (self.where, f"{'/'.join(f.attribute)} eq '{quoted}'") if x)
            else:
                yield f


class PagedStream(DataSourceStreamReader):
    """Offsets are how many rows of the term have been read; a batch is one page."""

    def __init__(self, schema: StructType, options: dict) -> None:
        self.reader = PagedReader(schema, options)
        self.next = int(options.get("start", 0))

    def initialOffset(self) -> dict:  # noqa: N802
        return {"skip": self.next}

    def latestOffset(self) -> dict:  # noqa: N802
        r = self.reader
        self.next += len(r.page(self.next).get("rows", []))
        if r.most is not None:
            self.next = min(self.next, r.most)
        return {"skip": self.next}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        top = self.reader.top
        return [_Pages(s, min(s + top, end["skip"])) for s in range(start["skip"], end["skip"], top)]

    def read(self, partition: _Pages) -> Iterator[tuple]:
        r = self.reader
        rows = list(_rows(r.page(partition.first), r.schema))
        yield from rows[: partition.last - partition.first]


class PagedSource(DataSource):
    """``spark.read.format("paged").option("url", ...).schema(...)``; all columns are text. With ``push_filters`` equality filters are asked of the remote side."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def reader(self, schema: StructType) -> DataSourceReader:
        return (PushingReader if self.options.get("push_filters") == "true" else PagedReader)(schema, self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return PagedStream(schema, self.options)
