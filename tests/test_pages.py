"""Landed pages: elements one by one, chains of pages, the periodic job; documents through a connector."""

import json
import random

import pytest

from learnsilver.operators.ingestion import load_collections
from learnsilver.operators.pagechains import page_gaps
from learnsilver.operators.rawstore import RawStore
from learnsilver.schemas import RAW
from learnsilver.sources.documents import (
    parse_documents,
    read_collection,
    rejected_documents,
    table_of,
    valid_documents,
)
from learnsilver.sources.statements import flatten_pages, page_links, rejected_elements, rejected_parts
from learnsilver.streaming.loader import load_landed_pages


def statement(key):
    at = "2024-01-01T00:00:00Z"
    return {"id": key, "timestamp": at, "stored": at, "verb": {"id": "v", "display": {"en-US": "did"}}}


def test_a_bad_element_costs_itself_alone(frame):
    a, b = statement("a"), statement("b")
    pages = frame(
        [(json.dumps([a, 5, b]),), (json.dumps({"statements": [None, "words", [a], True, b]}),),
         (json.dumps([]),), ("{broken",), (json.dumps({"statements": [json.dumps(a)]}),)],
        "value string",
    )
    rows = flatten_pages(pages).collect()
    assert sorted(r.id for r in rows) == ["a", "a", "b", "b"]
    assert {r.verb for r in rows} == {json.dumps(a["verb"], separators=(",", ":"))}
    rejected = sorted(map(tuple, rejected_elements(pages).collect()))
    assert [(place, text[:5]) for place, text in rejected] == [(0, "null"), (1, "5"), (1, "words"), (2, '[{"id'), (3, "true")]
    assert sorted(((p is None, p or 0) for p, _ in rejected_parts(pages).collect())) == [
        (False, 0), (False, 1), (False, 1), (False, 2), (False, 3), (True, 0)
    ]


def links(frame, *rows):
    return frame(rows, "address string, more string")


def gaps(found):
    return {(r.address, r.problem) for r in found.collect()}


def test_missing_successors_and_circles(frame):
    assert gaps(page_gaps(links(frame))) == set()
    whole = [("a", "b"), ("b", "c"), ("c", None), ("x", None)]
    assert gaps(page_gaps(links(frame, *whole))) == set()
    assert gaps(page_gaps(links(frame, ("a", "b"), ("c", None)))) == {("a", "missing")}
    circle = [("p", "q"), ("q", "r"), ("r", "q"), ("s", "s")]
    found = page_gaps(links(frame, *whole, *circle, ("m", "gone"), (None, "q"), ("p", "q")))
    assert gaps(found) == {("p", "endless"), ("q", "endless"), ("r", "endless"), ("s", "endless"), ("m", "missing")}
    assert found.count() == 5


@pytest.mark.parametrize("seed", range(3))
def test_gaps_against_following_each_page(frame, seed):
    rng = random.Random(seed)
    pages = {f"p{k}": rng.choice([None, *[f"p{rng.randrange(45)}"] * 6]) for k in range(40)}
    wanted = {(a, "missing") for a, more in pages.items() if more and more not in pages}
    for page in pages:
        at, steps = page, 0
        while at in pages and pages[at] and steps <= len(pages):
            at, steps = pages[at], steps + 1
        if steps > len(pages):
            wanted.add((page, "endless"))
    assert gaps(page_gaps(links(frame, *pages.items()))) == wanted


def test_links_of_pages_are_without_host(frame):
    pages = frame(
        [("https://lrs.example:8080/xapi/statements?x=1", json.dumps({"statements": [], "more": "/xapi/more/1"})),
         ("/xapi/more/1", json.dumps({"statements": [statement("a")], "more": "https://lrs.example/xapi/more/2"})),
         ("/xapi/more/2", json.dumps([statement("b")])), ("/xapi/more/3", json.dumps({"more": ""}))],
        "address string, value string",
    )
    assert {(r.address, r.more) for r in page_links(pages).collect()} == {
        ("/xapi/statements?x=1", "/xapi/more/1"), ("/xapi/more/1", "/xapi/more/2"),
        ("/xapi/more/2", None), ("/xapi/more/3", None),
    }


@pytest.mark.parametrize("page_per_file", [False, True])
def test_landed_pages_are_loaded_in_pieces_and_once(spark, tmp_path, page_per_file):
    store = RawStore(spark, f"{tmp_path}/raw")
    indent = 1 if page_per_file else None

    def land(name, *pages):
        folder = tmp_path / "landing"
        folder.mkdir(exist_ok=True)
        for k, page in enumerate(pages):
            (folder / f"{name}{k}.json").write_text(json.dumps(page, indent=indent))

    def run():
        load_landed_pages(
            spark, store, f"{tmp_path}/landing", f"{tmp_path}/seen", files_at_once=1, page_per_file=page_per_file
        ).awaitTermination()
        return sorted(r.id for r in store.read("lrs_statements").collect()), store.version("lrs_statements")

    land("one", [statement("a"), 7], {"statements": [statement("b")]}, [statement("a")])
    ids, version = run()
    assert ids == ["a", "b"] and version == 3
    assert run() == (ids, version)
    land("two", [statement("c"), "no"])
    assert run()[0] == ["a", "b", "c"]
    assert sorted(r.text for r in store.read("lrs_statements_rejected").collect()) == ["7", "no"]


def test_a_connector_table_needs_no_preparation(spark, tmp_path):
    """The recipe of the README, for a collection that a connector yields by columns."""
    spark.sql("select '1' as _id, 'Mira' as first_name, timestamp_ntz'2024-01-01' as modified_on").write.parquet(
        f"{tmp_path}/users"
    )
    store = RawStore(spark, f"{tmp_path}/raw")
    read = lambda name: valid_documents(
        read_collection(spark, f"{tmp_path}/{name}", table_of(name), fmt="parquet"))
    assert load_collections(store, read, ["users"]) == {"lms_users": 1}
    row = store.read("lms_users").first()
    assert (row["_id"], row.first_name, row.last_name) == ("1", "Mira", None)
    assert rejected_documents(read_collection(spark, f"{tmp_path}/users", "lms_users", fmt="parquet")).count() == 0


@pytest.mark.parametrize("moment", ['{"$date":1704164645500}', '{ "$date" : 1704164645500 }', '{"$date":{"$numberLong":"1704164645500"}}'])
def test_counted_times_are_read(frame, moment):
    text = '{"_id":{"$oid":"1"},"updatedAt":' + moment + ',"maxScore":{"$numberInt":"3"},"title":"{\\"$date\\":5}"}'
    row = valid_documents(parse_documents(frame([(text,)], "value string"), RAW["lms_exercises"])).first()
    assert str(row.updatedAt) == "2024-01-02 03:04:05.500000"
    assert (row.maxScore, row.title, row._rejected) == (3.0, '{"$date":5}', [])


def test_times_before_1970_and_documents_without_signs(frame):
    texts = ['{"_id":"1","updatedAt":{"$date":-1000}}', '{"_id":"2","title":"plain"}', '{"_id":"3","title":"a $date b"}']
    rows = valid_documents(parse_documents(frame([(t,) for t in texts], "value string"), RAW["lms_exercises"]))
    found = {r["_id"]: (str(r.updatedAt), r.title) for r in rows.collect()}
    assert found == {"1": ("1969-12-31 23:59:59", None), "2": ("None", "plain"), "3": ("None", "a $date b")}
