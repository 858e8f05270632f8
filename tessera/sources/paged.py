"""A paged rows API as a Python data source: one partition a page, retries with back-off.

A source that names no total is one partition that reads page after page.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from urllib.parse import urlencode
from urllib.request import urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def with_retries(call: Callable[[], dict], retries: int = 3, most: float = 8.0, wait: Callable[[float], None] = time.sleep) -> dict:
    """The call's result; after a failure it waits 1, 2, 4... seconds, ``most`` at most, and tries again."""
    for attempt in range(retries + 1):
        try:
            return call()
        except (OSError, ValueError):
            if attempt == retries:
                raise
            wait(min(2.0**attempt, most))
    raise AssertionError


class Page(InputPartition):
    """``length`` rows from ``offset`` on, all of which must come; without ``exact``, as many as the source has, up to ``length`` if not None."""

    def __init__(self, offset: int, length: int | None, exact: bool = True):
        self.offset, self.length, self.exact = offset, length, exact


class PagedReader(DataSourceReader):
    """Options: url (http, https or file; {offset} and {length} are filled in, else they are query arguments), page (100), limit, retries (3), timeout (60)."""

    def __init__(self, options):
        self.url = options["url"]
        self.page, self.retries, self.timeout = int(options.get("page", 100)), int(options.get("retries", 3)), float(options.get("timeout", 60))
        self.limit = int(options["limit"]) if options.get("limit") else None

    def fetch(self, offset: int, length: int) -> dict:
        url = self.url.replace("{offset}", str(offset)).replace("{length}", str(length))
        if url == self.url:
            url += ("&" if "?" in url else "?") + urlencode({"offset": offset, "length": length})

        def call() -> dict:
            with urlopen(url, timeout=self.timeout) as answer:
                return json.load(answer)

        return with_retries(call, self.retries)

    def partitions(self):
        """Pages up to the total that the first page names; the limit cuts them. Without a total, one partition for all."""
        first = self.fetch(0, min(self.page, self.limit or self.page))
        total = first.get("num_rows_total")
        if total is None:
            return [Page(0, self.limit or None, exact=False)]
        total = min(int(total), self.limit) if self.limit else int(total)
        return [Page(k, min(self.page, total - k)) for k in range(0, total, self.page)] or [Page(0, 0)]

    def read(self, partition) -> Iterator[tuple[int, str]]:
        """The rest of a short page is asked for again; no rows before a known total are an error. Without a total an empty or short page ends the source."""
        offset, left, total = partition.offset, partition.length, None
        while left is None or left > 0:
            asked = self.page if left is None else min(self.page, left)
            answer = self.fetch(offset, asked)
            rows = answer.get("rows", [])[:asked]
            for k, row in enumerate(rows):
                yield int(row.get("row_idx", offset + k)), json.dumps(row.get("row", row), ensure_ascii=False)
            offset += len(rows)
            left = None if left is None else left - len(rows)
            if not partition.exact:
                total = answer.get("num_rows_total", total)
                if offset >= int(total) if total is not None else len(rows) < asked:
                    break
            if not rows and left != 0:
                raise ValueError(f"no rows from {offset} on, though the source has more")


class PagedRows(DataSource):
    """spark.dataSource.register(PagedRows); spark.read.format("paged_rows").option("url", ...).load() -> (row_idx, value)."""

    @classmethod
    def name(cls) -> str:
        return "paged_rows"

    def schema(self) -> str:
        return "row_idx long, value string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)
