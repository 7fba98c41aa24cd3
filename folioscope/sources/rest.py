"""A cursor-paged REST source of work records as a Python data source, one partition per month."""

from __future__ import annotations

import calendar
import json
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThanOrEqual, InputPartition, LessThanOrEqual

MONTH = re.compile(r"\d{4}-\d{2}")


@dataclass
class Month(InputPartition):
    year: int
    month: int


def months(start: str, end: str) -> list[Month]:
    """The months from ``yyyy-mm`` to ``yyyy-mm``."""
    (y0, m0), (y1, m1) = (map(int, x.split("-")) for x in (start, end))
    return [Month(n // 12, n % 12 + 1) for n in range(y0 * 12 + m0 - 1, y1 * 12 + m1)]


def page_url(base: str, part: Month, cursor: str, affiliation: str | None, rows: int, has_abstract: bool = False) -> str:
    last = calendar.monthrange(part.year, part.month)[1]
    wanted = f"from-pub-date:{part.year}-{part.month:02d}-01,until-pub-date:{part.year}-{part.month:02d}-{last}"
    if has_abstract:
        wanted += ",has-abstract:true"
    query = {"filter": wanted, "rows": rows, "cursor": cursor, "sort": "published", "order": "asc"}
    if affiliation:
        query["query.affiliation"] = affiliation
    return f"{base}?{urllib.parse.urlencode(query)}"


def fetch(url: str, retries: int = 5, wait: float = 3.0, opener=urllib.request.urlopen) -> dict:
    """A page; when the service asks to slow down, wait and try again."""
    for attempt in range(retries + 1):
        try:
            with opener(url) as reply:
                return json.load(reply)
        except urllib.error.HTTPError as refused:
            if refused.code != 429 or attempt == retries:
                raise
            time.sleep(wait)
    raise AssertionError("unreachable")


def pages(base: str, part: Month, affiliation: str | None, rows: int, get=fetch, has_abstract: bool = False):
    """Every item of a month: cursors are followed until a page is empty."""
    cursor = "*"
    while True:
        message = get(page_url(base, part, cursor, affiliation, rows, has_abstract))["message"]
        yield from message["items"]
        if not message["items"] or not message.get("next-cursor"):
            return
        cursor = message["next-cursor"]


class WorksReader(DataSourceReader):
    """Rows of the asked columns: ``value`` (a record's JSON), ``month`` (yyyy-mm) and ``has_abstract``."""

    def __init__(self, options: dict, names: list[str]):
        self.options, self.names = options, names
        self.has_abstract = options.get("hasabstract", options.get("hasAbstract", "false")) == "true"
        self.first, self.last = options["from"], options["until"]

    def partitions(self):
        return months(self.first, self.last)

    def read(self, partition: Month):
        label = f"{partition.year}-{partition.month:02d}"
        for item in pages(self.options["url"], partition, self.options.get("affiliation"), int(self.options.get("rows", 1000)), has_abstract=self.has_abstract):
            columns = {"value": json.dumps(item), "month": label, "has_abstract": bool(item.get("abstract"))}
            yield tuple(columns[n] for n in self.names)


class PushingReader(WorksReader):
    """Takes conditions on ``month`` and ``has_abstract`` into the requests; the others go back to Spark."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if column == ("has_abstract",) and isinstance(f, EqualTo) and value is True:
                self.has_abstract = True
            elif column == ("month",) and isinstance(f, EqualTo | GreaterThanOrEqual | LessThanOrEqual) and MONTH.fullmatch(value or ""):
                if not isinstance(f, LessThanOrEqual):
                    self.first = max(self.first, value)
                if not isinstance(f, GreaterThanOrEqual):
                    self.last = min(self.last, value)
            else:
                yield f


class WorksStream(DataSourceStreamReader):
    """Months as offsets: a batch reads the months after the last finished one, up to ``until``, a partition each."""

    def __init__(self, options: dict, names: list[str]):
        self.batch = WorksReader(options, names)

    def initialOffset(self) -> dict:
        y, m = map(int, self.batch.first.split("-"))
        return {"month": f"{y - (m == 1)}-{(m - 2) % 12 + 1:02d}"}

    def latestOffset(self) -> dict:
        return {"month": self.batch.last}

    def partitions(self, start: dict, end: dict):
        return [m for m in months(start["month"], end["month"])][1:]

    def read(self, partition: Month):
        return self.batch.read(partition)

    def commit(self, end: dict) -> None:
        """The checkpoint holds the offsets."""


class WorksSource(DataSource):
    """``spark.read.format("works").option("url", ...).option("from", "2020-01").option("until", "2020-12")``: a JSON text per record.

    With the schema ``value string, month string, has_abstract boolean`` (or some of these) records can be filtered; option
    ``pushdown`` and the session's ``spark.sql.python.filterPushdown.enabled`` send such filters to the service. As a stream, a later ``until`` brings the
    months since the last run.
    """

    @classmethod
    def name(cls) -> str:
        return "works"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> DataSourceReader:
        return (PushingReader if self.options.get("pushdown") == "true" else WorksReader)(self.options, getattr(schema, "names", ["value"]))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return WorksStream(self.options, getattr(schema, "names", ["value"]))
