import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from learnsilver.operators import incremental as inc
from learnsilver.operators.ingestion import load_collections, load_statements
from learnsilver.operators.rawstore import STORED_DAY, RawStore, hashed_parts
from learnsilver.operators.report import load_report
from learnsilver.schemas import RAW
from learnsilver.sources.catalog import layer_name, register_views, with_alias
from learnsilver.sources.documents import (
    default_tables,
    parse_documents,
    read_collection,
    rejected_documents,
    table_of,
    valid_documents,
)
from learnsilver.sources.statements import flatten_pages, rejected_pages
from learnsilver.streaming.loader import landed_stream, load_landed, merge_stream


def test_table_names():
    assert table_of("submissions") == "lms_exercise_submissions"
    assert table_of("project-enrollments") == "lms_project_enrollments"
    assert table_of("users") == "lms_users"
    assert len(default_tables()) == 17
    assert set(default_tables()) | {"lrs_statements"} == set(RAW)


def test_layer_names():
    assert layer_name("raw") == "raw"
    assert layer_name("raw", "dev") == layer_name("raw", "dev_") == "dev_raw"


def test_documents_are_normalised_at_any_depth(frame):
    document = (
        '{"_id":{"$oid":"65a"},"items":[{"ref":{ "$oid" : "65b" },"n":{"$numberLong":"5"}}],'
        '"title":"a {\\"$oid\\":\\"x\\"} b","createdAt":{"$date":"2024-01-02T03:04:05.5Z"},'
        '"maxScore":3,"metadata":{"a":[1]}}'
    )
    row = parse_documents(frame([(document,)], "value string"), RAW["lms_exercises"]).first()
    assert row["_id"] == "65a"
    assert json.loads(row["items"]) == [{"ref": "65b", "n": 5}]
    assert row["title"] == 'a {"$oid":"x"} b'
    assert str(row["createdAt"]) == "2024-01-02 03:04:05.500000"
    assert (row["maxScore"], row["metadata"], row["updatedAt"]) == (3.0, '{"a":[1]}', None)


def test_unreadable_documents_are_set_aside(frame):
    lines = frame([('{"_id":"1"}',), ("{broken",)], "value string")
    parsed = parse_documents(lines, RAW["lms_users"])
    assert [r["_corrupt_record"] for r in parsed.filter("_corrupt_record is not null").collect()] \
        == ["{broken"]
    assert [r["_id"] for r in valid_documents(parsed).collect()] == ["1"]


def test_read_collection(spark, tmp_path):
    path = f"{tmp_path}/users"
    spark.createDataFrame([('{"_id":{"$oid":"1"},"role":["student"]}',)], "v string").write.text(
        path
    )
    row = read_collection(spark, path, "lms_users").first()
    assert (row["_id"], row["role"]) == ("1", '["student"]')


def statement(key, stored="2024-01-01T00:00:00Z"):
    return {"id": key, "timestamp": stored, "stored": stored, "verb": {"id": "v"}}


def test_both_page_shapes_give_the_same_rows(frame):
    statements = [statement("a"), statement("b")]
    pages = frame(
        [(json.dumps({"statements": statements, "more": "/x"}),), ("  " + json.dumps(statements),),
         (json.dumps({"statements": []}),), ("[]",), ('{"more":""}',)],
        "value string",
    )
    rows = flatten_pages(pages).collect()
    assert sorted(r.id for r in rows) == ["a", "a", "b", "b"]
    assert {r.verb for r in rows} == {'{"id":"v"}'}


def test_unreadable_pages_are_set_aside(frame):
    good = json.dumps([statement("a")])
    rows = [good, '{"more":""}', "[]", '{"statements":[]}', '[{"id":"a"},', "words", "5", None, '{"statements":3}']
    pages = frame([(row,) for row in rows], "value string")
    assert [r.id for r in flatten_pages(pages).collect()] == ["a"]
    rejected = sorted((r.value for r in rejected_pages(pages).collect()), key=str)
    assert rejected == sorted(['[{"id":"a"},', "words", "5", None, '{"statements":3}'], key=str)


def test_a_bad_value_costs_the_value_alone(frame):
    documents = [
        {"_id": "1", "maxScore": "many", "createdAt": "2024-01-02T03:04:05Z", "title": "kept"},
        {"_id": "2", "maxScore": {"$numberInt": "7"}, "createdAt": {"$date": "soon"}},
        {"_id": "3", "maxScore": [1], "title": {"a": 1}},
        {"_id": {"$oid": "4"}, "maxScore": 2.5},
    ]
    parsed = parse_documents(
        frame([(json.dumps(d),) for d in documents] + [("{no",)], "value string"), RAW["lms_exercises"]
    )
    rows = {r["_id"]: r for r in valid_documents(parsed).collect()}
    assert {k: (r.maxScore, r.title, r._rejected) for k, r in rows.items()} == {
        "1": (None, "kept", ["maxScore"]), "2": (7.0, None, ["createdAt"]),
        "3": (None, '{"a":1}', ["maxScore"]), "4": (2.5, None, []),
    }
    rejects = sorted((r.field or "", r.document) for r in rejected_documents(parsed).collect())
    assert [field for field, _ in rejects] == ["", "createdAt", "maxScore", "maxScore"]
    assert rejects[0][1] == "{no"


@pytest.mark.parametrize(
    "moment", ['{"$date":"2024-01-02T03:04:05.500Z"}', '{"$date":{"$numberLong":"1704164645500"}}',
               '{ "$date" : { "$numberLong" : "1704164645500" } }', '"2024-01-02T04:04:05.5+01:00"']
)
def test_canonical_extended_json(frame, moment):
    text = (
        '{"_id":{"$oid":"1"},"maxScore":{"$numberDouble":"2.5"},"updatedAt":' + moment
        + ',"items":[{"at":' + moment + ',"n":{ "$numberLong" : "-5" },"d":{"$numberDecimal":"1.50"}}]}'
    )
    row = valid_documents(parse_documents(frame([(text,)], "value string"), RAW["lms_exercises"])).first()
    assert (row["_id"], row.maxScore, str(row.updatedAt)) == ("1", 2.5, "2024-01-02 03:04:05.500000")
    assert str(row._changed_at) == "2024-01-02 03:04:05.500000"
    (item,) = json.loads(row["items"])
    assert (item["n"], item["d"]) == (-5, 1.5) and item["at"].startswith("2024-01-02T0")


DAYS = "_id string, modified_on timestamp_ntz"


def users(spark, *rows):
    """Rows (id, day, name) as users; a day of None has no cursor."""
    return spark.createDataFrame(rows, "_id string, day int, name string").selectExpr(
        "_id", "timestamp_ntz'2024-01-01' + make_dt_interval(day) as modified_on", "name"
    )


def test_cursor_fields_in_order_of_preference(spark):
    df = spark.sql("select 1 as modifiedAt, 2 as updatedAt, 3 as created_on")
    assert inc.cursor_column(df) == "updatedAt"
    assert inc.cursor_column(spark.sql("select 1 as created_on")) is None


def test_cursor_is_strict_and_first_run_takes_all(spark):
    df = users(spark, ("a", 1, ""), ("b", 2, ""), ("c", None, ""))
    assert [r._id for r in inc.changed_since(df, "2024-01-02T00:00:00Z").collect()] == ["b", "c"]
    assert inc.changed_since(df, None).count() == 3
    assert inc.changed_since(df, "nonsense").count() == 3
    assert inc.changed_since(df, "2024-01-02T00:00:00Z", overlap="1 hour").count() == 3
    assert inc.changed_since(df.drop("modified_on"), "2024-01-02").count() == 3


def test_cursor_filter_reaches_the_scan(spark, tmp_path):
    users(spark, ("a", 1, "")).write.parquet(f"{tmp_path}/users")
    changed = inc.changed_since(spark.read.parquet(f"{tmp_path}/users"), "2024-01-02T00:00:00Z")
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(modified_on,2024-01-02T00:00)" in plan


def test_any_of_several_cursors(spark):
    df = spark.sql(
        "select * from values (1, timestamp_ntz'2024-01-01', timestamp_ntz'2024-02-01'), "
        "(2, timestamp_ntz'2024-02-01', null), (3, timestamp_ntz'2024-01-01', null), (4, null, null) "
        "as t(id, updatedAt, modifiedAt)"
    )
    found = inc.changed_since(df, "2024-01-15", ["updatedAt", "modifiedAt"])
    assert sorted(r.id for r in found.collect()) == [1, 2, 4]


def test_cursor_state_falls_back_to_creation(spark):
    df = spark.sql(
        "select * from values (timestamp_ntz'2024-01-01', timestamp_ntz'2024-03-01'), "
        "(null, timestamp_ntz'2024-02-01') as t(modified_on, created_on)"
    )
    assert str(inc.cursor_state(df, "t").first().last_cursor) == "2024-02-01 00:00:00"


def test_rows_told_by_their_key_are_not_sorted_again_to_be_parted(spark, tmp_path):
    users(spark, ("a", 1, "x"), ("a", 2, "y"), (None, 1, "z"), (None, 1, "z")).write.parquet(f"{tmp_path}/users")
    told = inc.latest_per_key(spark.read.parquet(f"{tmp_path}/users"), "_id", keyless="_none")
    found = sorted(((r._id, r.name, r._none) for r in told.collect()), key=str)
    assert found == [("a", "y", False), (None, "z", True), (None, "z", True)]
    # One sort on each side of the shuffle.
    plan = told.sortWithinPartitions("_none")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 2


def test_latest_per_key_limits_on_the_map_side(spark, tmp_path):
    users(spark, ("a", 1, "")).write.parquet(f"{tmp_path}/users")
    latest = inc.latest_per_key(spark.read.parquet(f"{tmp_path}/users"), "_id")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange")
    assert plan.count("WindowGroupLimit") == 2


def test_rows_without_key_are_no_versions_of_each_other(spark):
    rows = users(spark, ("a", 1, "x"), ("a", 2, "y"), (None, 1, "x"), (None, 1, "x"), (None, 2, "z"))
    found = sorted(((r._id, r.name) for r in inc.latest_per_key(rows, "_id").collect()), key=str)
    assert found == [("a", "y"), (None, "x"), (None, "x"), (None, "z")]


def test_ties_are_broken_by_maps_too(spark):
    rows = spark.sql(
        "select 'a' as _id, timestamp_ntz'2024-01-01' as modified_on, map('k', v) as m "
        "from explode(sequence(1, 9)) as t(v)"
    )
    kept = {inc.latest_per_key(rows.repartition(n), "_id").first().m["k"] for n in (1, 2, 5)}
    assert len(kept) == 1


def test_raw_load_of_all_collections(spark, tmp_path):
    """Collections side by side, without a cursor and with one, then the statements."""
    store = RawStore(spark, f"{tmp_path}/raw", parts={"lrs_statements": STORED_DAY})

    def read(collection):
        change = "updatedAt" if collection == "rules" else "modified_on"
        document = {"_id": {"$oid": "1"}, change: {"$date": "2024-01-01T00:00:00Z"}, "extra": 1}
        if collection == "surveys":
            del document[change]
        lines = spark.createDataFrame([(json.dumps(document),)], "value string")
        return valid_documents(parse_documents(lines, RAW[table_of(collection)]))

    loaded = load_collections(store, read)
    # A document that does not say when it changed comes again with each load.
    again = load_collections(store, read)
    assert set(loaded) == set(default_tables()) and set(loaded.values()) == {1}
    assert {t for t, n in again.items() if n} == {"lms_surveys"}
    assert json.loads(store.read("lms_users").first()["_document"])["extra"] == 1
    pages = spark.createDataFrame(
        [(json.dumps([statement("a"), statement("b", "2024-01-02T00:00:00Z")]),)], "value string"
    )
    assert load_statements(store, pages) == 2
    assert load_statements(store, pages) == 0
    assert load_statements(store, pages, since="2024-01-01T12:00:00Z") == 1
    assert load_statements(store, pages, overlap="1 day") == 1
    assert store.read("lrs_statements").count() == 2
    assert store.state().count() == 18
    assert store.read("lms_surveys").count() == 1


def test_small_batch_is_merged_without_a_shuffle_of_the_target(spark, tmp_path):
    users(spark, *[(str(n), 1, "") for n in range(1000)]).write.parquet(f"{tmp_path}/target")
    users(spark, ("1", 2, "new")).write.parquet(f"{tmp_path}/batch")
    merged = inc.upsert(
        spark.read.parquet(f"{tmp_path}/target"), spark.read.parquet(f"{tmp_path}/batch"), "_id"
    )
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


ROWS = st.lists(
    st.tuples(
        st.sampled_from("abcd"), st.integers(0, 5), st.sampled_from(["x", "y", "z"])
    ),
    min_size=1,
    max_size=12,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(old=ROWS, new=ROWS, data=st.data())
def test_upsert_properties(spark, old, new, data):
    """Against a dictionary: the batch wins, order does not matter, twice is once."""
    target = inc.latest_per_key(users(spark, *old), "_id")
    shuffled = data.draw(st.permutations(new))

    def merged(batch, onto):
        return inc.upsert(onto, inc.latest_per_key(users(spark, *batch), "_id"), "_id")

    once = sorted(map(tuple, merged(new, target).collect()))
    assert once == sorted(map(tuple, merged(shuffled, target).collect()))
    assert once == sorted(map(tuple, merged(new, merged(new, target)).collect()))
    assert len({r[0] for r in once}) == len(once)
    assert {r[0] for r in once} == {r[0] for r in old} | {r[0] for r in new}
    for key in {r[0] for r in new}:
        last = max(r[1] for r in new if r[0] == key)
        (row,) = [r for r in once if r[0] == key]
        assert row[1].day == 1 + last
        assert (key, last, row[2]) in new


@pytest.fixture
def store(spark, tmp_path):
    return RawStore(spark, f"{tmp_path}/raw", parts={"users": hashed_parts("_id", 4)})


def test_merge_uses_and_writes_the_cursor(spark, store):
    assert store.merge("users", users(spark, ("a", 1, "old"), ("b", 2, "old")), "_id") == 2
    assert store.cursor("users") == "2024-01-03 00:00:00"
    later = users(spark, ("a", 1, "ignored"), ("b", 3, "new"), ("c", 4, "new"))
    assert store.merge("users", later, "_id") == 2
    rows = {r._id: r.name for r in store.read("users").collect()}
    assert rows == {"a": "old", "b": "new", "c": "new"}
    assert store.merge("users", later, "_id") == 0
    assert store.merge("users", later, "_id", since="2024-01-01") == 3
    assert {r._id: r.name for r in store.read("users").collect()}["a"] == "ignored"
    (state,) = store.state().collect()
    assert (state.table, state.last_cursor) == ("users", "2024-01-05 00:00:00")
    assert RawStore(spark, store.root).cursor("users") == state.last_cursor


def test_rewritten_cursor_never_goes_back(spark, store):
    store.merge("users", users(spark, ("a", 9, "x")), "_id")
    store.merge("users", users(spark, ("b", 1, "x")), "_id", since="1970-01-01")
    assert store.cursor("users") == "2024-01-10 00:00:00"


def folders(frame):
    return {path.rsplit("/", 1)[0] for path in frame.inputFiles()}


def test_a_batch_writes_what_it_holds(spark, store):
    store.merge("users", users(spark, *[(str(n), 1, "x") for n in range(200)]), "_id")
    store.compact("users")
    before = folders(store.read("users"))
    store.merge("users", users(spark, *[(str(n), 2, "y") for n in range(100)]), "_id")
    after = folders(store.read("users"))
    assert len(before) == 4 and before < after and len(after) == 5
    names = [r.name for r in store.read("users").collect()]
    assert (names.count("x"), names.count("y")) == (100, 100)


def test_compaction_rewrites_the_parts_that_hold_a_key(spark, store):
    store.merge("users", users(spark, *[(str(n), 1, "x") for n in range(50)]), "_id")
    store.compact("users")
    before = folders(store.read("users"))
    store.merge("users", users(spark, ("7", 2, "y")), "_id")
    rows = sorted(map(tuple, store.read("users").collect()))
    store.compact("users")
    after = folders(store.read("users"))
    assert len(before) == len(after) == 4 and len(before & after) == 3
    assert sorted(map(tuple, store.read("users").collect())) == rows and len(rows) == 50
    store.compact("users")
    assert folders(store.read("users")) == after


def test_a_row_that_changes_its_part_replaces_the_old_one(spark, tmp_path):
    store = RawStore(spark, f"{tmp_path}/raw", parts={"lrs_statements": STORED_DAY})

    def load(*statements):
        pages = spark.createDataFrame([(json.dumps(list(statements)),)], "value string")
        load_statements(store, pages, since="1970-01-01")
        return sorted((r.id, str(r.stored)[:10]) for r in store.read("lrs_statements").collect())

    no_time = {"id": "b", "timestamp": "2024-01-01T00:00:00Z"}
    assert load(statement("a"), no_time) == [("a", "2024-01-01"), ("b", "None")]
    store.compact("lrs_statements")
    expected = [("a", "2024-01-05"), ("b", "2024-01-02")]
    assert load(statement("a", "2024-01-05T00:00:00Z"), statement("b", "2024-01-02T00:00:00Z")) == expected
    store.compact("lrs_statements")
    assert load() == expected
    assert store.vacuum("lrs_statements") == 1  # of the empty load; kept states name the others


def test_rows_without_key_are_set_aside_and_counted(spark, store):
    rows = users(spark, ("a", 1, "x"), (None, 1, "y"), (None, 1, "y"))
    assert store.merge("users", rows, "_id") == 1
    assert store.merge("users", rows, "_id", since="1970-01-01") == 1
    assert [r._id for r in store.read("users").collect()] == ["a"]
    assert store.set_aside("users").count() == 4
    assert store.state().first().rows_aside == 4
    assert store.merge("users", users(spark, (None, 9, "z")), "_id") == 0
    assert store.set_aside("users").count() == 5


def test_many_loads_stay_bounded(spark, tmp_path):
    store = RawStore(spark, f"{tmp_path}/raw", most_loads=5)
    for n in range(50):
        store.merge("users", users(spark, ("a", n, f"v{n}"), (str(n), n, "x")), "_id")
    assert store.read("users").count() == 51
    assert [r.name for r in store.read("users").filter("_id = 'a'").collect()] == ["v49"]
    assert len(folders(store.read("users"))) <= 5
    states = store._states.folder.names("users")
    assert len([name for name in states if name.endswith(".json")]) <= 5
    assert store.vacuum("users") > 30
    assert len(store._folder.names("users")) <= 10
    assert store.read("users").count() == 51


def test_two_writers_find_each_other(spark, store):
    store.merge("users", users(spark, ("a", 1, "x")), "_id")
    state = store._states.latest("users")
    with pytest.raises(RuntimeError, match="another writer"):
        store._states.publish("users", state)
    assert store.read("users").count() == 1


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(loads=st.lists(ROWS, min_size=1, max_size=4), compact=st.sets(st.integers(0, 3)))
def test_reading_over_loads_is_the_same_as_one_dictionary(spark, tmp_path_factory, loads, compact):
    store = RawStore(spark, str(tmp_path_factory.mktemp("raw")), parts={"users": "name"})
    wanted = {}
    for k, rows in enumerate(loads):
        store.merge("users", users(spark, *rows), "_id", changed_only=False)
        for r in inc.latest_per_key(users(spark, *rows), "_id").collect():
            wanted[r._id] = tuple(r)
        if k in compact:
            store.compact("users")
    assert sorted(map(tuple, store.read("users").collect())) == sorted(wanted.values())


def test_append_keeps_all_rows(spark, store):
    store.append("users", users(spark, ("a", 1, "x")))
    store.append("users", users(spark, ("a", 1, "x")))
    assert store.read("users").count() == 2
    store.merge("users", users(spark, ("a", 5, "y")), "_id")
    assert [r.name for r in store.read("users").collect()] == ["y"]


def test_folders_the_log_does_not_name_are_never_read(spark, store):
    store.merge("users", users(spark, ("a", 1, "x")), "_id")
    store._land("users", users(spark, ("left", 1, "over")), "_id")
    assert [r._id for r in store.read("users").collect()] == ["a"]


def test_parts_without_value_and_with_odd_signs(spark, tmp_path):
    store = RawStore(spark, f"{tmp_path}/raw", parts={"users": "name"})
    rows = users(spark, ("a", 1, None), ("b", 1, "x/y:z"), ("c", 1, "__"))
    store.merge("users", rows, "_id")
    store.merge("users", users(spark, ("a", 2, None), ("b", 2, "x/y:z")), "_id")
    assert sorted((r._id, r.modified_on.day) for r in store.read("users").collect()) == [
        ("a", 3), ("b", 3), ("c", 2),
    ]


def test_statement_without_stored_time_is_not_lost(spark, store):
    page = json.dumps([{"id": "a", "timestamp": "2024-01-01T00:00:00Z"}, statement("b")])
    pages = spark.createDataFrame([(page,)], "value string")
    assert load_statements(store, pages) == 2
    assert load_statements(store, pages) == 1
    assert store.read("lrs_statements").count() == 2


def test_known_batch_is_not_loaded_twice(spark, store):
    assert store.append("users", users(spark, ("a", 1, "x")), batch="q#1") == 1
    assert store.append("users", users(spark, ("a", 1, "x")), batch="q#1") == 0
    assert store.merge("users", users(spark, ("a", 2, "x")), "_id", batch="q#1") == 0


def test_new_columns_join_in(spark, store):
    store.merge("users", users(spark, ("a", 1, "x")), "_id")
    wider = users(spark, ("b", 2, "x")).selectExpr("*", "'de' as lang")
    store.merge("users", wider, "_id")
    assert {r._id: r.lang for r in store.read("users").collect()} == {"a": None, "b": "de"}


def test_stream_of_pages_by_stored_day(spark, tmp_path):
    """Files arrive between runs; each batch is merged once, repeats replace."""
    store = RawStore(spark, f"{tmp_path}/raw", parts={"lrs_statements": STORED_DAY})
    landing, checkpoint = f"{tmp_path}/pages", f"{tmp_path}/checkpoint"

    def land(*statements):
        page = json.dumps({"statements": list(statements)})
        spark.createDataFrame([(page,)], "v string").coalesce(1).write.mode("append").text(landing)

    def run():
        merge_stream(
            landed_stream(spark, landing, maxFilesPerTrigger="1"), store, "lrs_statements", "id",
            checkpoint, prepare=flatten_pages,
        ).awaitTermination()
        return sorted((r.id, str(r.stored)[:10]) for r in store.read("lrs_statements").collect())

    land(statement("a"), statement("b", "2024-01-02T00:00:00Z"))
    land(statement("c"))
    expected = [("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-01")]
    assert run() == expected
    assert run() == expected
    land(statement("a"), statement("d", "2024-01-03T00:00:00Z"))
    assert run() == [*expected, ("d", "2024-01-03")]


def test_landed_files_are_read_once_and_rejects_kept(spark, tmp_path):
    store = RawStore(spark, f"{tmp_path}/raw")

    def land(collection, *lines):
        rows = spark.createDataFrame([(line,) for line in lines], "v string").coalesce(1)
        rows.write.mode("append").text(f"{tmp_path}/landing/{collection}")

    def run():
        load_landed(spark, store, f"{tmp_path}/landing", f"{tmp_path}/seen", ["users", "schools", "rules"])
        return store.cursor("lms_users"), store._states.latest("lms_users")["version"]

    land("users", '{"_id":"1"}', "{broken", '{"_id":"2","created_on":"soon"}', '{"role":"student"}')
    land("schools", '{"_id":"s"}')
    first = run()
    assert sorted(r._id for r in store.read("lms_users").collect()) == ["1", "2"]
    assert store.set_aside("lms_users").count() == 1
    rejected = store.read("lms_users_rejected").collect()
    assert sorted((r.field or "", r.document[:3]) for r in rejected) == [("", "{br"), ("created_on", '{"_')]
    assert run() == first
    land("users", '{"_id":"3"}')
    run()
    assert store.read("lms_users").count() == 3 and store.read("lms_users_rejected").count() == 2
    assert set(store.tables()) == {"lms_schools", "lms_users", "lms_users_rejected"}


def test_load_report_names_missing_tables(spark):
    report = load_report(spark, lambda t: spark.range(3) if t == "x" else None, ["x", "y"])
    assert sorted(map(tuple, report.collect())) == [("x", 3, True), ("y", None, False)]


def test_load_report_looks_at_the_store(spark, store):
    store.merge("users", users(spark, ("a", 1, "x"), ("b", 1, "x")), "_id")
    report = load_report(spark, store.read, ["users", "courses"])
    assert sorted(map(tuple, report.collect())) == [("courses", None, False), ("users", 2, True)]


def test_views_and_alias(spark):
    read = with_alias(lambda t: spark.createDataFrame([(t,)], "name string"))
    register_views(read, ["lrs_statements"])
    assert spark.sql("select name from xapi_statements").first()[0] == "lrs_statements"
    assert read("xapi_statements").first()[0] == "lrs_statements"
