"""Builds over a raw store: what later loads change, against a build of everything."""

import json
import random

import pytest

from learnsilver.operators import rawstore
from learnsilver.operators.rawstore import STORED_DAY, RawStore
from learnsilver.operators.warehouse import GROUPED, Warehouse
from learnsilver.sources.statements import flatten_pages

IRI = "https://host.example/xapi/extensions/"
OPTIONS = {
    "extension_prefix": IRI,
    "extension_map": {"sessionId": "session_id", "ltiToolId": "lti_tool_id", "aiToolId": "ai_tool_id"},
}


def page(spark, *statements):
    return flatten_pages(spark.createDataFrame([(json.dumps(statements),)], "value string"))


def statement(key, day=1, **extensions):
    at = f"2024-01-{day:02}T10:00:00.{key % 1000:03}Z"
    return {
        "id": str(key), "timestamp": at, "stored": at, "actor": {"account": {"name": f"u{key % 3}"}},
        "verb": {"id": "http://v/did"}, "object": {"id": f"x{key % 5}"}, "result": {"success": key % 2 == 0},
        "context": {"extensions": {IRI + name: value for name, value in extensions.items()}},
    }


def rows(warehouse, name):
    frame = warehouse.table(name)
    kept = [c for c in frame.columns if c not in ("created_at", "updated_at")]
    return sorted(map(str, frame.select(kept).collect()))


@pytest.fixture
def store(spark, tmp_path):
    return RawStore(spark, f"{tmp_path}/raw", parts={"lrs_statements": STORED_DAY}, most_loads=3)


def check(spark, tmp_path, store, silver, turn):
    whole = Warehouse(spark, f"{tmp_path}/whole{turn}", store.read, **OPTIONS)
    whole.build_all(list(GROUPED))
    for name in GROUPED:
        assert rows(silver, name) == rows(whole, name), name


def test_patched_models_equal_a_build_of_everything(spark, tmp_path, store):
    """Events change their session, lose it, lose their tool, and change their day."""
    chance = random.Random(4)
    silver = Warehouse(spark, f"{tmp_path}/lake", store.read, statements=store, **OPTIONS)
    for turn in range(4):
        changed = []
        for key in chance.sample(range(40), 40 if not turn else 8):
            own = {name: f"{name[0]}{chance.randrange(4)}" for name in
                   ("session_id", "lti_tool_id", "ai_tool_id", "course_id") if chance.random() < 0.7}
            changed.append(statement(key, chance.randrange(1, 6), **own))
        store.merge("lrs_statements", page(spark, *changed), "id", changed_only=False)
        silver.build_all(list(GROUPED))
        if turn in (1, 3):
            check(spark, tmp_path, store, silver, turn)
    versions = {name: silver.patched.version(name) for name in GROUPED}
    silver.build_all(list(GROUPED))
    assert versions == {name: silver.patched.version(name) for name in GROUPED}


def test_a_build_that_broke_off_between_two_tables_is_mended(spark, tmp_path, store, monkeypatch):
    silver = Warehouse(spark, f"{tmp_path}/lake", store.read, statements=store, **OPTIONS)
    load = lambda *s: store.merge("lrs_statements", page(spark, *s), "id", changed_only=False)
    load(*[statement(k, session_id=f"s{k % 3}") for k in range(9)])
    silver.build_all(["dim_session"])
    load(statement(1, session_id="s2"), statement(9, session_id="s7"))
    merge = silver.patched.merge
    monkeypatch.setattr(silver.patched, "merge", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        silver.build_all(["dim_session"])
    monkeypatch.setattr(silver.patched, "merge", merge)
    load(statement(4, session_id="s0"))
    silver.build_all(["dim_session"])
    load(statement(9, session_id="s0"))
    silver.build_all(["dim_session"])
    whole = Warehouse(spark, f"{tmp_path}/whole", store.read, **OPTIONS)
    whole.build_all(["dim_session"])
    assert rows(silver, "dim_session") == rows(whole, "dim_session")
    assert not any("s7" in row for row in rows(silver, "dim_session"))


def test_a_load_of_one_day_writes_one_day(spark, tmp_path, store):
    silver = Warehouse(spark, f"{tmp_path}/lake", store.read, statements=store, **OPTIONS)
    load = lambda *s: store.merge("lrs_statements", page(spark, *s), "id", changed_only=False)
    load(*[statement(k, 1 + k % 9) for k in range(90)])
    silver.build_all(["fact_learning_event"])
    silver.patched.compact("fact_learning_event")
    before = set(silver.table("fact_learning_event").inputFiles())
    load(statement(100, 3), statement(2, 3))
    silver.build_all(["fact_learning_event"])
    silver.patched.compact("fact_learning_event")
    after = set(silver.table("fact_learning_event").inputFiles())
    assert {f.split("_part=")[1].split("/")[0] for f in after - before} == {"2024-01-03"}
    assert silver.table("fact_learning_event").count() == 91


def test_staging_looks_for_versions_only_where_statements_may_have_them(spark, tmp_path, store, monkeypatch):
    """Merged statements have an id of their own each; appended ones may come twice."""
    silver = Warehouse(spark, f"{tmp_path}/lake", store.read, statements=store, **OPTIONS)
    sifted, latest = [], rawstore.latest_per_key
    monkeypatch.setattr(rawstore, "latest_per_key", lambda df, key, **k: sifted.append(key) or latest(df, key, **k))
    for keys in (range(9), (3, 3, 9)):
        pages = page(spark, *[statement(k, 1 + k % 3, session_id=f"s{k % 2}") for k in keys])
        store.merge("lrs_statements", pages, "id", changed_only=False)
        silver.build_all(["fact_session_summary"])
    assert sifted == ["id", "id"]
    store.append("lrs_statements", page(spark, statement(4, 5, session_id="s9"), statement(4, 6, session_id="s9")))
    silver.build_all(["fact_session_summary"])
    assert sifted == ["id", "id", "event_id"]
    assert sorted(r.event_id for r in silver.table("stg_lrs_events").collect()) == [str(k) for k in range(10)]
    events = silver.table("fact_session_summary").groupBy("session_id").sum("total_events")
    assert dict(map(tuple, events.collect())) == {"s0": 4, "s1": 5, "s9": 1}


def test_keys_of_types_that_widened_may_be_the_same(spark, store):
    one = lambda ddl, *k: store.merge("t", spark.createDataFrame([(x,) for x in k], ddl), "k", changed_only=False)
    one("k bigint", 2**53, 2**53 + 1)
    assert not store.has_one_each("t")
    one("k string", "a")
    assert not store.has_one_each("t")
    store.merge("u", spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, n int"), "k")
    assert store.has_one_each("u") and store.read("u").count() == store.set_aside("u").count() == 1
    store.replace("u", spark.createDataFrame([("b", 1), ("b", 2)], "k string, n int"), "k", spark.createDataFrame([("b",)], "k string"))
    assert not store.has_one_each("u")
    store.merge("u", spark.createDataFrame([("b", 1)], "k string, n int"), "k", changed_only=False)
    assert not store.has_one_each("u")


def test_replacing_takes_away_what_has_no_rows_any_more(spark, store):
    frame = lambda *r: spark.createDataFrame(r, "g string, n int")
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "g string")
    store.replace("t", frame(("a", 1), ("a", 2), ("b", 3), ("c", 4)), "g", keys("a", "b", "c"))
    for fold in (False, True):
        store.replace("t", frame(("a", 5)), "g", keys("a", "b"))
        if fold:
            store.compact("t")
        assert sorted(map(tuple, store.read("t").collect())) == [("a", 5), ("c", 4)]
    store.replace("t", frame(), "g", keys("c"))
    assert [tuple(r) for r in store.read("t").collect()] == [("a", 5)]
    store.compact("t")
    assert [tuple(r) for r in store.read("t").collect()] == [("a", 5)]
    assert store.replace("t", frame(("z", 1)), "g", keys("z"), batch="q#3") == 1
    assert store.replace("t", frame(("z", 2)), "g", keys("z"), batch="q#3") == 0
    store.vacuum("t")
    assert store.read("t").count() == 2
