"""Source adapters: an open registry, a Spark data source that pages through what an adapter lists, and fetching as rows of attempts."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sedimark.operators import runs


class Fetched(NamedTuple):
    """A page as it came."""

    body: str
    url: str
    status: int | None = 200
    content_type: str | None = "text/html"


class SourceAdapter(ABC):
    """A source: its listing pages and the postings that a page refers to."""

    code: str

    @abstractmethod
    def listing_urls(self) -> Iterator[str]: ...

    @abstractmethod
    def fetch(self, url: str) -> str | Fetched:
        """A page; a failure with an HTTP status is a runs.StatusError."""

    @abstractmethod
    def parse_listing(self, body: str, base_url: str) -> list[tuple[str, str]]:
        """(source_posting_id, url) in page order."""

    def discover(self, limit: int) -> list[tuple[str, str]]:
        """References in order, the first of each id, up to ``limit``; ends at a page that adds none."""
        found: dict[str, str] = {}
        for url in self.listing_urls():
            before = len(found)
            page = as_fetched(self.fetch(url), url)
            for id_, link in self.parse_listing(page.body, page.url):
                found.setdefault(id_, link)
                if len(found) >= limit:
                    return list(found.items())
            if found and len(found) == before:
                break
        return list(found.items())


def as_fetched(page: str | Fetched, url: str) -> Fetched:
    return page if isinstance(page, Fetched) else Fetched(page, url)


#: By code; sedimark.sources.boards adds the sources known by name.
ADAPTERS: dict[str, SourceAdapter] = {}

_FETCHED = {
    "source_code": pa.string(), "source_posting_id": pa.string(), "requested_url": pa.string(), "attempt_no": pa.int32(), "outcome": pa.string(), "failure_type": pa.string(),
    "http_status": pa.int32(), "error_message": pa.string(), "body": pa.string(), "final_url": pa.string(), "content_type": pa.string(),
}


def fetched(refs: DataFrame, fetch: Callable[[str], str | Fetched], backoff: runs.Backoff = runs.Backoff(3, 0.25), pause: float = 0.0) -> DataFrame:
    """One row for each attempt at each of ``refs`` (source_code, source_posting_id, url); a success has the page.

    Each partition fetches one page after another, ``pause`` seconds apart. Fetching again gives other rows: write the
    result before it is used twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import time

        for batch in batches:
            out: list[tuple] = []
            for code, id_, url in zip(*(batch.column(c).to_pylist() for c in ("source_code", "source_posting_id", "url"))):
                for a in runs.attempts(lambda: as_fetched(fetch(url), url), backoff):  # noqa: B023
                    page = a.value or Fetched(None, None, a.http_status, None)
                    out.append((code, id_, url, a.attempt_no, a.outcome, a.failure_type, page.status, a.error_message, page.body, page.url, page.content_type))
                time.sleep(pause)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(_FETCHED.values())], list(_FETCHED))

    kinds = {pa.string(): "string", pa.int32(): "int"}
    return refs.select("source_code", "source_posting_id", "url").mapInArrow(run, ", ".join(f"{n} {kinds[t]}" for n, t in _FETCHED.items()))


def register(spark: SparkSession, adapter: SourceAdapter) -> None:
    """Makes an adapter known by its code, and the data source known to Spark."""
    ADAPTERS[adapter.code] = adapter
    name = adapter.code

    class _Listing(DataSource):
        @classmethod
        def name(cls) -> str:
            return f"listing_{name}"

        def schema(self) -> str:
            return "source_code string, source_posting_id string, url string"

        def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
            return _Reader(adapter, int(self.options.get("limit", "50")))

    spark.dataSource.register(_Listing)


class _Reader(DataSourceReader):
    def __init__(self, adapter: SourceAdapter, limit: int):
        self.adapter, self.limit = adapter, limit

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]  # pages depend on those before them

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str, str]]:
        for id_, url in self.adapter.discover(self.limit):
            yield self.adapter.code, id_, url
