"""Paged REST endpoints as a Spark data source: one row per response body.

The endpoints are the partitions. Numbered pages of one endpoint are dealt out over further
partitions; a next link or a continuation token is only known from the page before, so those
pages stay in one partition per endpoint. Bodies are handed on page by page, never gathered.

A failed request is tried again (``retries``) after a wait that doubles. Each page comes with the
cursor of the one after it, from which a later read can go on (:mod:`tarnkeep.sinks.pages`).
"""

from __future__ import annotations

import json
import sys
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tarnkeep.operators.records import extract_items

Fetch = Callable[[str, Mapping[str, Any]], str]

# Option names with the defaults of the paging protocols.
DEFAULTS = {
    "method": "GET",
    "headers": "{}",
    "pagination": "None",
    "page_param": "page",
    "start_page": "1",
    "page_size_param": "pageSize",
    "page_size": "100",
    "next_link_json_path": "next",
    "items_json_path": "items",
    "token_param": "continuation",
    "next_token_path": "nextToken",
    "timeout": "30",
    "parallelism": "8",
    "max_pages": "0",
    "retries": "1",
    "retry_wait": "1",
    # where to go on: cursors by feed and lane; pages a feed gives at most; failures as rows
    "cursors": "",
    "round_pages": "0",
    "land_errors": "false",
}

PROTOCOLS = ("None", "NextLink", "PageNumber", "Token")


def http_fetch(url: str, options: Mapping[str, Any]) -> str:
    """One request; returns the response text."""
    request = urllib.request.Request(
        url, headers=json.loads(options["headers"]), method=options["method"]
    )
    with urllib.request.urlopen(request, timeout=float(options["timeout"])) as response:
        charset = response.headers.get_content_charset() or "utf-8"
        return response.read().decode(charset)


def with_params(url: str, params: Mapping[str, Any]) -> str:
    parts = urllib.parse.urlsplit(url)
    query = urllib.parse.parse_qsl(parts.query, keep_blank_values=True)
    query += [(k, str(v)) for k, v in params.items()]
    return urllib.parse.urlunsplit(parts._replace(query=urllib.parse.urlencode(query)))


def _at(document: Any, dotted: str) -> Any:
    for key in dotted.split("."):
        if not isinstance(document, dict) or key not in document:
            return None
        document = document[key]
    return document


def _is_empty(document: Any, items_path: str) -> bool:
    """Whether a page holds no record, by the rules of ``extract_items``."""
    if isinstance(document, list):
        return not document
    if not isinstance(document, dict):
        return True
    found = _at(document, items_path) if items_path else document
    if found is None:
        found = next((v for v in document.values() if isinstance(v, list)), [])
    return found == []


def _may_pass(error: Exception) -> bool:
    """Whether a request that failed so is worth another try."""
    if isinstance(error, urllib.error.HTTPError):
        return error.code in (408, 429) or error.code >= 500
    return isinstance(error, OSError)


@dataclass
class Feed(InputPartition):
    """The pages one task reads: an endpoint, its first page and the step between pages.

    ``page`` pages were read before, and ``cursor`` tells the next: a link, a token or a number.
    """

    url: str
    first: int = 0
    step: int = 1
    page: int = 0
    cursor: str | None = None


def lane_of(url: str, first: int) -> str:
    """What names a feed among those of all endpoints."""
    return json.dumps([url, first])


class RestPagesReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str], fetch: Fetch):
        given = {str(k).lower(): v for k, v in dict(options).items()}
        self.options = {k: given.get(k, v) for k, v in DEFAULTS.items()}
        self.urls = json.loads(given["urls"]) if "urls" in given else [given["url"]]
        self.fetch = fetch
        if self.options["pagination"] not in PROTOCOLS:
            raise ValueError(f"Unsupported pagination type: {self.options['pagination']}")

    def partitions(self) -> list[Feed]:
        if self.options["pagination"] != "PageNumber":
            feeds = [Feed(url) for url in self.urls]
        else:
            first, tasks = int(self.options["start_page"]), int(self.options["parallelism"])
            feeds = [Feed(url, first + i, tasks) for url in self.urls for i in range(tasks)]
        known = json.loads(self.options["cursors"] or "{}")
        for feed in feeds:
            feed.page, feed.cursor = known.get(lane_of(feed.url, feed.first), (0, None))
        # a feed that has been read to its end has a cursor that is false
        return [f for f in feeds if f.cursor is not False]

    def read(self, feed: Feed) -> Iterator[tuple]:
        pages = {
            "None": self._single, "NextLink": self._linked,
            "PageNumber": self._numbered, "Token": self._tokens,
        }[self.options["pagination"]]
        limit, in_round = int(self.options["max_pages"]), int(self.options["round_pages"])
        numbered = self.options["pagination"] == "PageNumber"
        last = limit + (int(self.options["start_page"]) - 1 if numbered else 0)
        land_errors = self.options["land_errors"] == "true"
        given, cursor, found = 0, feed.cursor, pages(feed)
        while not in_round or given < in_round:
            try:
                page, body, empty, following = next(found)
                if limit and page > last:
                    raise ValueError(f"{feed.url}: more than {limit} pages")
            except StopIteration:
                return
            except Exception as error:
                if not land_errors:
                    raise
                # what was read before is kept; a later read goes on from here
                yield feed.url, None, None, None, feed.first, cursor, f"{type(error).__name__}: {error}"
                return
            given, cursor = given + 1, following
            yield feed.url, page, body, empty, feed.first, following, None

    def _get(self, url: str) -> tuple[str, Any, bool]:
        tries, wait = int(self.options["retries"]), float(self.options["retry_wait"])
        for attempt in range(tries + 1):
            try:
                body = self.fetch(url, self.options)
                break
            except Exception as error:
                if attempt == tries or not _may_pass(error):
                    raise
                time.sleep(wait * 2**attempt)
        document = json.loads(body)
        return body, document, _is_empty(document, self.options["items_json_path"])

    def _single(self, feed: Feed):
        body, _, empty = self._get(feed.url)
        yield 1, body, empty, None

    def _numbered(self, feed: Feed):
        page, empty = int(feed.cursor or feed.first), False
        while not empty:
            body, _, empty = self._get(with_params(feed.url, {
                self.options["page_param"]: page,
                self.options["page_size_param"]: self.options["page_size"],
            }))
            following = page + feed.step
            yield page, body, empty, None if empty else str(following)
            page = following

    def _linked(self, feed: Feed):
        url, page, visited = feed.cursor or feed.url, feed.page, set()
        while url:
            if url in visited:
                raise ValueError(f"{feed.url}: the next link {url} was read before")
            visited.add(url)
            page += 1
            body, document, empty = self._get(url)
            following = _at(document, self.options["next_link_json_path"]) or _at(document, "next")
            url = (following and urllib.parse.urljoin(url, following)) or None
            yield page, body, empty, url

    def _tokens(self, feed: Feed):
        token, page, used = feed.cursor, feed.page, set()
        while True:
            if token in used:
                raise ValueError(f"{feed.url}: the next token {token} was used before")
            used.add(token)
            page += 1
            params = {self.options["page_size_param"]: self.options["page_size"]}
            if token:
                params[self.options["token_param"]] = token
            body, document, empty = self._get(with_params(feed.url, params))
            following = _at(document, self.options["next_token_path"])
            token = str(following) if following else None
            yield page, body, empty, token
            if not token:
                break


def rest_source(fetch: Fetch = http_fetch, name: str = "rest_pages") -> type[DataSource]:
    """The data source class over a way of fetching; register it with ``spark.dataSource``."""

    class RestPages(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return (
                "feed STRING, page BIGINT, body STRING, is_empty BOOLEAN, lane INT, following STRING, error STRING"
            )

        def reader(self, schema) -> DataSourceReader:
            return RestPagesReader(self.options, fetch)

    return RestPages


def read_pages(
    spark: SparkSession,
    options: Mapping[str, Any],
    fetch: Fetch = http_fetch,
    name: str = "rest_pages",
) -> DataFrame:
    """Response bodies of the endpoints in ``options`` (``url``, or ``urls`` as a JSON list).

    The reader travels to the workers by value, so this package need not be installed there.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(rest_source(fetch, name))
    return spark.read.format(name).options(**{k: str(v) for k, v in options.items()}).load()


def until_first_empty(landed: DataFrame) -> DataFrame:
    """Pages before the first one without records, per endpoint.

    Numbered pages are fetched by several tasks at once, each up to its own first empty page.
    Reading stops for good at the first empty page of all. Works on landed pages, since
    asking twice would fetch twice.
    """
    ends = landed.filter("is_empty").groupBy("feed").agg(F.min("page").alias("end"))
    # one row per endpoint, and the endpoints are listed in the options: small by construction
    return (
        landed.join(F.broadcast(ends), "feed", "left")
        .filter(F.col("end").isNull() | (F.col("page") < F.col("end")))
        .drop("end")
    )


def page_items(landed: DataFrame, options: Mapping[str, Any]) -> DataFrame:
    """The records of landed pages as variants in ``item``."""
    if options.get("pagination") == "PageNumber":
        landed = until_first_empty(landed)
    path = options.get("items_json_path", DEFAULTS["items_json_path"])
    return extract_items(landed, "body", path)
