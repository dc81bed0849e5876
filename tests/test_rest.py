import json
import sys
import urllib.parse

import pytest
from pyspark import cloudpickle

from tarnkeep.plans.jobs import rest_ingest_job
from tarnkeep.session import scratch_dir
from tarnkeep.sinks.pages import PageStore
from tarnkeep.sources.rest import RestPagesReader, read_pages, with_params

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAGES = {1: [{"a": 1}, {"a": 2}], 2: [{"a": 3}], 3: [], 4: [{"a": 99}], 5: []}


def api(url, options):
    parts = urllib.parse.urlsplit(url)
    query = dict(urllib.parse.parse_qsl(parts.query))
    if parts.netloc == "numbered":
        assert query["size"] == "2"
        return json.dumps({"data": {"rows": PAGES.get(int(query["p"]), [])}})
    if parts.netloc == "linked":
        at = int(query.get("at", 1))
        more = {"links": {"next": f"?at={at + 1}"}} if at < 3 else {"links": {"next": None}}
        return json.dumps({"data": {"rows": [{"a": at}]}} | more)
    if parts.netloc == "plainly-linked":
        return json.dumps({"rows": [{"a": 1}], "next": None if "at" in query else url + "?at=2"})
    if parts.netloc == "circular":
        return json.dumps({"rows": [{"a": 1}], "next": "?again=1" if "again" not in query else url})
    if parts.netloc == "tokens":
        at = int(query.get("continuation", 0))
        return json.dumps({"rows": [{"a": at}], "nextToken": at + 1 if at < 3 else None})
    if parts.netloc == "stuck":
        return json.dumps({"rows": [{"a": 1}], "nextToken": "same"})
    if parts.netloc == "nothing":
        return json.dumps({"rows": []})
    return json.dumps([{"a": 1}, {"a": 2}])


def ingest(spark, **options):
    target = scratch_dir(spark)
    count = rest_ingest_job(spark, options, target, "a BIGINT", api)
    if count == 0:
        return []
    values = sorted(r.a for r in spark.read.parquet(target).collect())
    assert len(values) == count
    return values


def test_single(spark):
    assert ingest(spark, url="http://single/") == [1, 2]
    assert ingest(spark, urls='["http://single/", "http://single/x"]') == [1, 1, 2, 2]
    assert ingest(spark, url="http://nothing/") == []


@pytest.mark.parametrize("tasks", [1, 3, 8])
def test_numbered_pages_stop_at_the_first_empty_one(spark, tasks):
    values = ingest(
        spark, url="http://numbered/", pagination="PageNumber", page_param="p",
        page_size_param="size", page_size=2, items_json_path="data.rows", parallelism=tasks,
    )
    assert values == [1, 2, 3]


def test_next_links(spark):
    dotted = {"items_json_path": "data.rows", "next_link_json_path": "links.next"}
    assert ingest(spark, url="http://linked/", pagination="NextLink", **dotted) == [1, 2, 3]
    assert ingest(spark, url="http://linked/", pagination="NextLink", max_pages=3, **dotted) == [1, 2, 3]
    with pytest.raises(Exception, match="more than 2 pages"):
        ingest(spark, url="http://linked/", pagination="NextLink", max_pages=2, **dotted)
    rows = {"items_json_path": "rows"}
    assert ingest(spark, url="http://plainly-linked/", pagination="NextLink", **rows) == [1, 1]
    with pytest.raises(Exception, match="was read before"):
        ingest(spark, url="http://circular/", pagination="NextLink", **rows)


def test_tokens(spark):
    rows = {"items_json_path": "rows"}
    assert ingest(spark, url="http://tokens/", pagination="Token", **rows) == [0, 1, 2, 3]
    with pytest.raises(Exception, match="was used before"):
        ingest(spark, url="http://stuck/", pagination="Token", **rows)


def test_appends_and_infers(spark):
    target = scratch_dir(spark)
    for _ in range(2):
        assert rest_ingest_job(spark, {"url": "http://single/"}, target, fetch=api) == 2
    assert spark.read.parquet(target).dtypes == [("a", "bigint")]
    assert spark.read.parquet(target).count() == 4


def test_unknown_paging_and_failures(spark):
    with pytest.raises(Exception, match="Unsupported pagination"):
        RestPagesReader({"url": "http://single/", "pagination": "Cursor"}, api)

    def broken(url, options):
        raise OSError("no answer")

    with pytest.raises(Exception, match="no answer"):
        read_pages(spark, {"url": "http://single/"}, broken).collect()


def test_partitions_and_params():
    reader = RestPagesReader(
        {"urls": '["u", "v"]', "pagination": "PageNumber", "parallelism": "3"}, api
    )
    assert [(f.url, f.first, f.step) for f in reader.partitions()] == [
        (u, p, 3) for u in "uv" for p in (1, 2, 3)
    ]
    assert len(RestPagesReader({"urls": '["u", "v"]'}, api).partitions()) == 2
    assert with_params("http://h/p?a=1#f", {"b": "x y"}) == "http://h/p?a=1&b=x+y#f"


def test_files_can_stand_for_endpoints(spark, tmp_path):
    (tmp_path / "page.json").write_text('{"items": [{"a": "é"}]}', encoding="utf-8")
    pages = read_pages(spark, {"url": (tmp_path / "page.json").as_uri()})
    row = pages.first()
    assert (row.page, row.is_empty, json.loads(row.body)) == (1, False, {"items": [{"a": "é"}]})


class Watched:
    """The test endpoints, noting what is asked for, and failing for pages listed in a file."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __call__(self, url, options):
        import os
        import urllib.error

        with open(f"{self.folder}/asked", "a") as out:
            out.write(url + "\n")
        failures = f"{self.folder}/failures"
        listed = open(failures).read().split() if os.path.exists(failures) else []
        if any(x in url for x in listed):
            raise OSError("no answer")
        if "forbidden" in url:
            raise urllib.error.HTTPError(url, 403, "forbidden", {}, None)
        return api(url, options)

    def asked(self):
        with open(f"{self.folder}/asked") as found:
            return found.read().split()


KINDS = {
    "numbered": {"pagination": "PageNumber", "page_param": "p", "page_size_param": "size", "page_size": 2,
                 "items_json_path": "data.rows", "parallelism": 2},
    "linked": {"pagination": "NextLink", "items_json_path": "data.rows", "next_link_json_path": "links.next"},
    "tokens": {"pagination": "Token", "items_json_path": "rows"},
}


@pytest.mark.parametrize("kind, failing, want", [
    ("numbered", "p=2", [1, 2, 3]), ("linked", "at=3", [1, 2, 3]), ("tokens", "continuation=2", [0, 1, 2, 3]),
])
def test_a_failed_ingest_goes_on_where_it_stopped(spark, tmp_path, kind, failing, want):
    fetch, store, target = Watched(tmp_path), PageStore(scratch_dir(spark)), scratch_dir(spark)
    options = {"url": f"http://{kind}/", "retry_wait": 0, "round_pages": 2, **KINDS[kind]}
    (tmp_path / "failures").write_text(failing)
    with pytest.raises(RuntimeError, match="no answer"):
        rest_ingest_job(spark, options, target, "a BIGINT", fetch, store=store)
    before = fetch.asked()
    assert sum(failing in url for url in before) == 2  # one more try
    assert not store.is_complete(spark) and store.pages(spark).count() > 0
    (tmp_path / "failures").write_text("")
    assert rest_ingest_job(spark, options, target, "a BIGINT", fetch, store=store) == len(want)
    after = fetch.asked()
    answered = [u for u in before if failing not in u] + after[len(before):]
    assert len(answered) == len(set(answered))  # no page was answered twice
    assert sorted(r.a for r in spark.read.parquet(target).collect()) == want
    # another run asks for nothing and appends nothing
    assert rest_ingest_job(spark, options, target, "a BIGINT", fetch, store=store) == len(want)
    assert fetch.asked() == after and spark.read.parquet(target).count() == len(want)


def test_retries(spark, tmp_path):
    fetch = Watched(tmp_path)
    (tmp_path / "failures").write_text("single")
    with pytest.raises(Exception, match="no answer"):
        read_pages(spark, {"url": "http://single/", "retries": 3, "retry_wait": 0}, fetch).collect()
    assert len(fetch.asked()) == 4
    with pytest.raises(Exception, match="403"):
        read_pages(spark, {"url": "http://forbidden/", "retries": 3, "retry_wait": 0}, fetch).collect()
    assert len(fetch.asked()) == 5  # refused: not tried again


def test_long_circles_end(spark):
    store = PageStore(scratch_dir(spark))
    options = {"url": "http://circular/", "pagination": "NextLink", "items_json_path": "rows", "round_pages": 1}
    with pytest.raises(ValueError, match="was read before"):
        store.land(spark, options, api)


def test_one_of_several_endpoints_fails(spark, tmp_path):
    fetch, store = Watched(tmp_path), PageStore(scratch_dir(spark))
    options = {"urls": '["http://single/a", "http://single/b"]', "retry_wait": 0}
    (tmp_path / "failures").write_text("/b")
    with pytest.raises(RuntimeError, match="single/b: OSError"):
        store.land(spark, options, fetch)
    (tmp_path / "failures").write_text("")
    assert sorted(r.feed for r in store.land(spark, options, fetch).collect()) == ["http://single/a", "http://single/b"]
    assert sum(u.endswith("/a") for u in fetch.asked()) == 1
