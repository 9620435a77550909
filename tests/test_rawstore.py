"""The raw store: feed, levels, types and index."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnsilver.operators import keyindex, levels
from learnsilver.operators.drift import as_type, merged, storable, wider
from learnsilver.operators.rawstore import RawStore, hashed_parts
from learnsilver.operators.warehouse import Warehouse
from learnsilver.plans.staging import staging_rejects
from learnsilver.sources.statements import flatten_pages


def users(spark, *rows):
    return spark.createDataFrame(rows, "_id string, day int, name string").selectExpr(
        "_id", "timestamp_ntz'2024-01-01' + make_dt_interval(day) as modified_on", "name"
    )


@pytest.fixture
def store(spark, tmp_path):
    return RawStore(spark, f"{tmp_path}/raw", parts={"users": hashed_parts("_id", 4)}, most_loads=4)


# -- levels ------------------------------------------------------------------------


def test_a_thousand_appends_leave_few_loads():
    loads, written, most = [], 0, 0
    for n in range(1, 1001):
        loads.append({"mode": "append", "version": n, "rows": 1, "level": 0})
        while run := levels.due(loads):
            at = loads.index(run[0])
            loads[at : at + len(run)] = [levels.joined(run)]
            written += sum(load["rows"] for load in run)
        most = max(most, len(loads))
        assert sum(load["rows"] for load in loads) == n
        assert [load["version"] for load in loads] == sorted(load["version"] for load in loads)
    assert most <= 30 and written <= 4 * 1000


def test_a_merge_keeps_appends_before_and_after_it_apart():
    loads = [{"mode": "append", "version": n, "rows": 1} for n in range(5)]
    loads.append({"mode": "merge", "version": 5, "rows": 1})
    loads += [{"mode": "append", "version": n, "rows": 1} for n in range(6, 11)]
    assert levels.due(loads) is None
    assert [load["version"] for load in levels.due([*loads, *[{**loads[-1], "version": v} for v in (11, 12, 13)]])] == list(range(6, 14))


def test_appended_loads_are_written_together(spark, store):
    for n in range(20):
        store.append("log", users(spark, (str(n), n, "x"), (str(n), n, "x")))
    assert store.read("log").count() == 40
    state = store._states.latest("log")
    assert len(state["loads"]) == 6 and not state["feed"]
    store.vacuum("log")
    assert len(store._folder.names("log")) <= 12
    # A merge counts for the rows before it alone.
    store.merge("log", users(spark, ("3", 30, "new")), "_id")
    store.append("log", users(spark, ("3", 31, "after")))
    assert sorted(r.name for r in store.read("log").filter("_id = '3'").collect()) == ["after", "new"]
    assert store.read("log").count() == 40


def test_rows_without_key_are_written_together_too(spark, store):
    for n in range(9):
        store.merge("users", users(spark, (None, n, "x"), (str(n), n, "x")), "_id", changed_only=False)
    assert store.set_aside("users").count() == 9
    assert len(store._states.latest("users")["aside"]) == 2


# -- feed --------------------------------------------------------------------------


def test_a_consumer_sees_each_load_once_whatever_is_folded(spark, store):
    seen, after = [], 0
    store.mark("users", "reader", 0)
    for n in range(11):
        store.merge("users", users(spark, ("a", n, f"v{n}"), (str(n), n, "x")), "_id")
        if n % 5 == 4:
            changes = store.changes("users", after).collect()
            seen.append(sorted((r._id, r.name) for r in changes))
            after = store.version("users")
            store.mark("users", "reader", after)
    assert seen[0] == [("0", "x"), ("1", "x"), ("2", "x"), ("3", "x"), ("4", "x"), ("a", "v4")]
    assert seen[1] == [("5", "x"), ("6", "x"), ("7", "x"), ("8", "x"), ("9", "x"), ("a", "v9")]
    assert len(store._states.latest("users")["feed"]) <= 6
    assert store.changes("users", after).count() == 2


def test_appends_that_were_written_together_stay_in_the_feed(spark, store):
    store.mark("log", "reader", 0)
    store.append("log", users(spark, ("first", 1, "x")))
    after = store.version("log")
    store.mark("log", "reader", after)
    for n in range(10):
        store.append("log", users(spark, (str(n), n, "x")))
    assert sorted(r._id for r in store.changes("log", after).collect()) == sorted(map(str, range(10)))


def test_without_a_mark_what_is_folded_is_read_whole(spark, store):
    store.merge("users", users(spark, ("a", 1, "x")), "_id")
    after = store.version("users")
    for n in range(3):
        store.merge("users", users(spark, ("b", n + 2, "x")), "_id")
    assert not store._states.latest("users")["loads"]
    assert sorted(r._id for r in store.changes("users", after).collect()) == ["a", "b"]


def test_marks_only_go_forward_and_can_be_forgotten(store):
    store.mark("users", "one", 5)
    store.mark("users", "one", 3)
    store.mark("users", "two", 0)
    assert store.marks("users") == {"one": 5, "two": 0}
    store.mark("users", "two", 7)
    store.forget("users", "one")
    assert store.marks("users") == {"two": 7}


def pages(spark, *ids):
    statements = [
        {"id": i, "timestamp": f"2024-01-0{1 + n % 9}T00:00:00Z", "stored": "2024-01-01T00:00:00Z",
         "result": {"score": {"raw": "many" if n % 2 else 3}}}
        for n, i in enumerate(ids)
    ]
    return flatten_pages(spark.createDataFrame([(json.dumps(statements),)], "value string"))


def test_a_build_parses_its_own_loads_and_counts_as_it_writes(spark, tmp_path):
    """Many loads and folds, a build after each; what a build met is counted in the same pass."""
    store = RawStore(spark, f"{tmp_path}/raw", most_loads=3)
    silver = Warehouse(spark, f"{tmp_path}/lake", store.read, statements=store)
    store.merge("lrs_statements", pages(spark, *[f"s{n}" for n in range(200)]), "id", changed_only=False)
    silver.build("stg_lrs_events")
    met = []
    for n in range(7):
        store.merge("lrs_statements", pages(spark, f"n{n}", f"m{n}"), "id", changed_only=False)
        silver.build("stg_lrs_events")
        met.append({r.column: (r.given, r.rejected) for r in silver.rejects().collect()}["scoreRaw"])
    assert met == [(2, 1)] * 7
    assert silver.table("stg_lrs_events").count() == 214
    whole = Warehouse(spark, f"{tmp_path}/whole", store.read)
    whole.build("stg_lrs_events")
    wanted = sorted(map(tuple, staging_rejects(store.read("lrs_statements")).collect()))
    assert sorted(map(tuple, whole.rejects().collect())) == wanted


def test_a_load_is_one_pass(spark, store):
    """The rows of a load are made once; counts come from the write."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = users(spark, *[(str(n), n, "x") for n in range(50)]).mapInArrow(
        count, "_id string, modified_on timestamp_ntz, name string"
    )
    assert store.merge("users", rows, "_id") == 50
    assert made.value == 50


# -- cursor ------------------------------------------------------------------------


def test_late_rows_at_the_cursor_are_loaded_once(spark, store):
    assert store.merge("users", users(spark, ("a", 1, "x"), ("b", 2, "x")), "_id") == 2
    late = users(spark, ("a", 1, "y"), ("b", 2, "y"), ("c", 2, "x"), (None, 2, "x"))
    assert store.merge("users", late, "_id") == 1
    assert store.merge("users", late, "_id") == 0
    for n in range(12):
        assert store.merge("users", late.union(users(spark, (f"d{n}", 2, "x"))), "_id") == 1
    assert store.merge("users", late, "_id") == 0
    assert len(store._states.latest("users")["ties"]) <= 9
    assert {r.name for r in store.read("users").collect()} == {"x"}
    assert store.merge("users", users(spark, ("e", 3, "x"), ("b", 2, "y")), "_id") == 1
    assert store.merge("users", users(spark, ("e", 3, "x"), ("f", 3, "x")), "_id") == 1


# -- types -------------------------------------------------------------------------

INT, LONG, DOUBLE, TEXT = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


def test_the_lattice():
    types = [T.ByteType(), INT, LONG, DOUBLE, T.FloatType(), T.DecimalType(10, 2), T.BooleanType(), T.DateType(),
             T.TimestampNTZType(), TEXT, T.ArrayType(INT), T.ArrayType(TEXT)]
    for a in types:
        assert wider(a, a) == a and wider(a, TEXT) == TEXT
        for b in types:
            assert wider(a, b) == wider(b, a)
            assert wider(wider(a, b), b) == wider(a, b)
    assert (wider(INT, LONG), wider(INT, DOUBLE), wider(LONG, T.BooleanType())) == (LONG, DOUBLE, TEXT)
    assert wider(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType()
    assert wider(T.DecimalType(10, 2), T.DecimalType(5, 4)) == T.DecimalType(12, 4)
    one, two = T.StructType().add("a", INT).add("b", TEXT), T.StructType().add("c", INT).add("a", DOUBLE)
    assert merged(one, two) == T.StructType().add("a", DOUBLE).add("b", TEXT).add("c", INT)
    assert storable(T.StructType([T.StructField("x", T.NullType(), False)])) == T.StructType().add("x", TEXT)


def test_text_of_a_number_does_not_depend_on_the_way(spark):
    row = spark.sql("select 1 as i, cast(1 as bigint) as l, 1.0D as d, 1.5D as h, 1e300 as big, double('nan') as n, "
                    "cast(null as double) as z, cast(1.50 as decimal(5,2)) as dec, -0.0D as minus").select(
        *[as_type(F.col(c), t, TEXT).alias(c) for c, t in [
            ("i", INT), ("l", LONG), ("d", DOUBLE), ("h", DOUBLE), ("big", DOUBLE), ("n", DOUBLE), ("z", DOUBLE),
            ("dec", T.DecimalType(5, 2)), ("minus", DOUBLE)]]
    ).first()
    assert tuple(row) == ("1", "1", "1", "1.5", "1.0E300", "NaN", None, "1.5", "0")


@pytest.mark.parametrize("fold", [False, True])
def test_types_change_between_loads(spark, store, fold):
    loads = ["1 as v, named_struct('a', 1) as s, array(1) as l", "2.5D as v, named_struct('b', 'x') as s, array(1.5D) as l",
             "'three' as v, named_struct('a', 'y') as s, cast(null as array<int>) as l", "null as v, null as s, null as l"]
    for n, load in enumerate(loads):
        df = spark.sql(f"select '{n}' as _id, {load} union all select 'k', {load}")
        store.merge("users", df, "_id", changed_only=False)
        if fold:
            store.compact("users")
    rows = {r._id: r for r in store.read("users").collect()}
    assert {i: r.v for i, r in rows.items()} == {"0": "1", "1": "2.5", "2": "three", "3": None, "k": None}
    assert dict(store.read("users").dtypes)["v"] == "string"
    assert json.loads(rows["0"].s) == {"a": "1"} if isinstance(rows["0"].s, str) else rows["0"].s.a == "1"


def test_a_key_that_becomes_text(spark, store):
    store.merge("users", spark.sql("select id as _id, 'old' as name from range(50)"), "_id")
    store.compact("users")
    store.merge("users", spark.sql("select '7' as _id, 'new' as name union all select 'x', 'new'"), "_id")
    rows = store.read("users")
    assert rows.count() == 51 and rows.filter("_id = '7'").first().name == "new"
    store.compact("users")
    assert store.read("users").count() == 51
    store.merge("users", spark.sql("select '8' as _id, 'new' as name"), "_id")
    store.compact("users")
    assert sorted(r._id for r in store.read("users").filter("name = 'new'").collect()) == ["7", "8", "x"]


# -- index -------------------------------------------------------------------------


def test_the_index_misses_no_key_and_few_files_too_many(spark):
    rows = spark.range(40_000).selectExpr(
        "'all' as _part", "'file' || (id % 200) as _file", "sha1(cast(id as string)) as _id"
    )
    index = keyindex.built(rows, "_id").cache()
    keys = spark.range(0, 40_000, 997).selectExpr("sha1(cast(id as string)) as _id")
    wanted = {f"file{i % 200}" for i in range(0, 40_000, 997)}
    found = {r._file for r in keyindex.candidates(index, keys).collect()}
    assert wanted <= found and len(found - wanted) <= 3
    others = spark.range(100).selectExpr("sha1('other' || id) as _id")
    assert keyindex.candidates(index, others).count() <= 4
    assert index.filter(F.expr("w0 = 0 and w1 = 0 and w2 = 0 and w3 = 0")).isEmpty()
    index.unpersist()


def test_the_keys_of_a_file_are_not_brought_together(spark):
    keys = spark.range(1000).selectExpr("'all' as _part", "'f' as _file", "cast(id as string) as _id")
    plan = keyindex.built(keys, "_id")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("block#" in line for line in exchanges)
    assert not any("_file#" in line and "block#" not in line for line in exchanges)


def test_rows_under_merges_are_joined_in_all_partitions(spark, store):
    for name in ("a", "b"):
        store.merge("t", spark.createDataFrame([("1", name), (name, name)], "_id string, v string"), "_id", changed_only=False)
    plan = store.read("t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1
    assert {tuple(r) for r in store.read("t").collect()} == {("1", "b"), ("a", "a"), ("b", "b")}


def test_a_fold_opens_files_that_may_hold_a_key(spark, tmp_path):
    """By ranges and filters: a hundred keys of one corner of the table are in a few of its files."""
    store = RawStore(spark, f"{tmp_path}/raw", parts={"log": "floor(n / 1000)"})
    rows = spark.range(40_000).selectExpr("sha1(cast(id as string)) as _id", "id as n")
    store.merge("log", rows, "_id")
    store.compact("log")
    files = store.read("log").inputFiles()
    assert len(files) >= 40
    keys = rows.filter("n >= 5000 and n < 5100").select("_id")
    opened = store.files_that_may_hold("log", keys)
    assert 1 <= len(opened) <= 4 and any("_part=5/" in f for f in opened)
    # Ranges and filters of parts that were written anew are the new ones.
    store.merge("log", rows.filter("n < 100").selectExpr("_id", "n + 39000 as n"), "_id", changed_only=False)
    before = set(store.read("log").inputFiles())
    store.compact("log")
    after = set(store.read("log").inputFiles())
    assert len([f for f in after if f in before]) >= 36
    assert store.read("log").count() == 40_000 and store.read("log").filter("n < 100").isEmpty()
    moved = store.files_that_may_hold("log", rows.filter("n < 100").select("_id"))
    assert any("_part=39/" in f for f in moved) and len(moved) <= 4
    assert store.files_that_may_hold("log", rows.limit(0).select("_id")) == []
