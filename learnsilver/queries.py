"""The registered queries: every model and operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnsilver.operators import incremental, quality
from learnsilver.operators.pagechains import page_gaps
from learnsilver.operators.ingestion import load_collections
from learnsilver.operators.rawstore import STORED_DAY, RawStore, hashed_parts
from learnsilver.operators.report import load_report
from learnsilver.operators.states import Folder
from learnsilver.operators.warehouse import Warehouse
from learnsilver.plans import REGISTRY, build_model
from learnsilver.plans.bridges import rejected_skill_weights
from learnsilver.plans.staging import staging_rejects
from learnsilver.schemas import MODELS, RAW, SILVER, STAGING
from learnsilver.session import scratch_path
from learnsilver.sources.documents import (
    default_tables,
    parse_documents,
    read_collection,
    rejected_documents,
    table_of,
    valid_documents,
)
from learnsilver.sources.fixtures import (
    EXTENSION_PREFIX,
    EXTRA_EXTENSIONS,
    raw_reader,
    table_reader,
)
from learnsilver.sources.statements import (
    flatten_pages,
    page_links,
    rejected_elements,
    rejected_pages,
)
from learnsilver.streaming.loader import landed_stream, load_landed_pages, merge_stream

Query = Callable[[SparkSession, str], DataFrame]
RUN_TS = "timestamp_ntz'2024-02-01 00:00:00'"
STAGING_OPTIONS = {"extension_map": EXTRA_EXTENSIONS, "extension_prefix": EXTENSION_PREFIX}
# Models that are typed and empty by nature read no table, and are no queries.
TYPED_EMPTY = ("dim_device", "ref_signal_type", "fact_learning_signal", "fact_variant_exposure")
_QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


_WAREHOUSES: dict[tuple, Warehouse] = {}
_BUILDING = Lock()


def warehouse(spark: SparkSession, folder: str, models: Iterable[str]) -> Warehouse:
    """The tables of a data folder, in the shared folder; builds the models not yet built.

    One per application and state of the data folder (times and sizes of its
    files), so that the staging table that most event models read is written
    once and not parsed anew by each of them, and anew when a file changes.
    """
    data = Folder(spark, folder)
    files = tuple((name, data.stamp(name)) for name in data.names() if name.endswith(".parquet"))
    key = (spark.sparkContext.applicationId, folder, files)
    with _BUILDING:
        if key not in _WAREHOUSES:
            _WAREHOUSES[key] = Warehouse(
                spark, scratch_path(spark, "warehouse"), raw_reader(spark, folder),
                run_ts=RUN_TS, **STAGING_OPTIONS,
            )
        _WAREHOUSES[key].build_missing(models)
    return _WAREHOUSES[key]


def _model(name: str) -> Query:
    """A model as a lazy DataFrame; the event models read the written staging table."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        raw = raw_reader(spark, folder)
        if name in STAGING:
            return build_model(name, raw, **STAGING_OPTIONS)
        staged = [i for i in REGISTRY[name].inputs if i in STAGING]
        read = warehouse(spark, folder, staged).table if staged else raw
        return build_model(name, read, run_ts=RUN_TS)

    return run


@_query
def staging_rejects_query(spark: SparkSession, folder: str) -> DataFrame:
    """Some events carry a word where a number belongs."""
    statements = raw_reader(spark, folder)("lrs_statements")
    key = EXTENSION_PREFIX + "attempts"
    spoilt = statements.withColumn(
        "context", F.expr(f"replace(context, '\"{key}\":4', '\"{key}\":\"four\"')")
    )
    return staging_rejects(spoilt, extension_prefix=EXTENSION_PREFIX)


@_query
def staging_after_second_load(spark: SparkSession, folder: str) -> DataFrame:
    """Staging after two loads, of which the second has new and resent statements."""
    store = RawStore(spark, scratch_path(spark, "raw"), parts={"lrs_statements": STORED_DAY})
    built = Warehouse(
        spark, scratch_path(spark, "warehouse"), store.read, statements=store, **STAGING_OPTIONS
    )
    statements = raw_reader(spark, folder)("lrs_statements")
    number = "cast(id as long)"
    early = statements.filter(f"{number} % 4 <> 0").withColumn(
        "result", F.expr(f"if({number} % 4 = 1, null, result)")
    )
    store.merge("lrs_statements", early, "id", changed_only=False)
    built.build("stg_lrs_events")
    late = statements.filter(f"{number} % 4 in (0, 1)")
    store.merge("lrs_statements", late, "id", changed_only=False)
    built.build("stg_lrs_events")
    return built.table("stg_lrs_events")


@_query
def staging_after_fold(spark: SparkSession, folder: str) -> DataFrame:
    """Staging built between loads that the store folds in meanwhile, some of them unseen by it."""
    store = RawStore(spark, scratch_path(spark, "raw"), most_loads=3)
    built = Warehouse(
        spark, scratch_path(spark, "warehouse"), store.read, statements=store, **STAGING_OPTIONS
    )
    statements = raw_reader(spark, folder)("lrs_statements")
    for k in range(5):
        load = statements.filter(f"cast(id as long) % 5 = {k} or cast(id as long) % 50 = 0")
        store.merge("lrs_statements", load, "id", changed_only=False)
        if k != 1:
            built.build("stg_lrs_events")
    return built.table("stg_lrs_events")


def _patched(model: str) -> Query:
    """A model built after each of two loads; the second has new and resent statements, some in other sessions."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        store = RawStore(spark, scratch_path(spark, "raw"), parts={"lrs_statements": STORED_DAY})
        built = Warehouse(
            spark, scratch_path(spark, "warehouse"), store.read, statements=store, run_ts=RUN_TS, **STAGING_OPTIONS
        )
        statements = raw_reader(spark, folder)("lrs_statements")
        number = "cast(id as long)"
        moved = "replace(replace(context, 'session_id\":\"', 'session_id\":\"old-'), '_tool_id', '_no_id')"
        early = statements.filter(f"{number} % 4 <> 0").withColumn(
            "context", F.expr(f"if({number} % 8 = 1, {moved}, context)")
        )
        for load in (early, statements.filter(f"{number} % 4 = 0 or {number} % 8 = 1")):
            store.merge("lrs_statements", load, "id", changed_only=False)
            built.build_all([model])
        return built.table(model)

    return run


_QUERIES["silver_after_second_load"] = _patched("fact_learning_event")
_QUERIES["launches_after_second_load"] = _patched("fact_launch")
_QUERIES["sessions_after_second_load"] = _patched("fact_session_summary")


@_query
def staging_view(spark: SparkSession, folder: str) -> DataFrame:
    """Built tables as views, asked in SQL."""
    warehouse(spark, folder, ["stg_lrs_events"]).register_views(["stg_lrs_events"])
    return spark.sql(
        "SELECT eventType, count(*) AS events, count(DISTINCT userId) AS users, max(scoreRaw) AS best "
        "FROM stg_lrs_events GROUP BY eventType"
    )


@_query
def skill_weight_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks give some weights as words."""
    read = raw_reader(spark, folder)
    spoilt = read("lms_blocks").withColumn(
        "metadata", F.expr("replace(metadata, '\"skillWeight\":0.5', '\"skillWeight\":\"heavy\"')")
    )
    return rejected_skill_weights(read("lms_pages"), spoilt, read("lms_lessons"))


@_query
def silver_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per written table, after a full build."""
    built = warehouse(spark, folder, MODELS)
    return reduce(
        DataFrame.unionByName,
        [
            built.table(m).agg(F.lit(m).alias("model"), F.count(F.lit(1)).alias("rows"))
            for m in ("stg_lrs_events", *SILVER)
        ],
    )


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """Every event gives a page of none to three statements, in one of the two shapes."""
    statement = (
        "named_struct('id', cast(event_id * 4 + n as string), 'timestamp', "
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\"), 'stored', "
        "date_format(ts + make_dt_interval(0, 0, n), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\"), "
        "'actor', named_struct('account', named_struct('name', cast(user_id as string))), "
        "'verb', named_struct('id', 'http://verbs.example/' || event_type))"
    )
    return (
        table_reader(spark, folder)("events")
        .selectExpr(
            "event_id",
            f"transform(slice(array(1, 2, 3), 1, cast(event_id % 4 as int)), n -> {statement}) "
            "as statements",
        )
        .selectExpr(
            "event_id",
            "if(event_id % 2 = 0, to_json(named_struct('statements', statements, 'more', '')), "
            "to_json(statements)) as value"
        )
    )


@_query
def ingest_page_flatten(spark: SparkSession, folder: str) -> DataFrame:
    statements = flatten_pages(_pages(spark, folder))
    return statements.select("id", "timestamp", "stored", "actor", "verb")


def _exported_users(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as exported documents, with wrapped ids and times."""
    day = "cast(date_add(date'2023-01-01', cast(c_custkey % 365 as int)) as timestamp_ntz)"
    later = f"{day} + make_dt_interval(0, 0, 0, c_custkey % 60)"
    stamp = "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")"
    pieces = [
        "'{\"_id\":{\"$oid\":\"'", "c_custkey", "'\"},\"role\":[\"student\"],\"last_name\":\"'",
        "c_name", "'\",\"school\":{ \"$oid\": \"n'", "c_nationkey",
        "'\" },\"created_on\":{\"$date\":\"'", stamp.format(day), "'\"}'",
        "if(c_custkey % 4 = 0, '', concat(',\"modified_on\":{\"$date\":\"', "
        f"{stamp.format(later)}, '\"}}'))", "'}'",
    ]
    return table_reader(spark, folder)("customer").selectExpr(
        f"concat({', '.join(pieces)}) as value"
    )


def _exported_in_all_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Times as text for some documents and counted for others, and a wrapped number."""
    users = _exported_users(spark, folder)
    day = "regexp_extract(value, '\"created_on\":.\"\\\\$date\":\"([^\"]*)Z', 1)"
    counted = (
        f"timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01', cast({day} as timestamp_ntz))"
    )
    return users.selectExpr(
        "if(value like '%0\"},\"role\"%', "
        f"regexp_replace(value, '\"created_on\":.\"\\\\$date\":\"[^\"]*\"', "
        f"concat('\"created_on\":{{ \"\\\\$date\" : {{\"\\\\$numberLong\": \"', {counted}, '\"}}')), value) as value"
    ).selectExpr("replace(value, '\"last_name\"', '\"grade\":{\"$numberInt\":\"7\"},\"last_name\"') as value")


@_query
def ingest_document_normalise(spark: SparkSession, folder: str) -> DataFrame:
    users = parse_documents(_exported_in_all_forms(spark, folder), RAW["lms_users"])
    return users.select("_id", "role", "last_name", "school", "grade", "created_on", "modified_on")


def _counts(**rows: DataFrame) -> DataFrame:
    """One row per table: its name here, and how many rows it has."""
    return reduce(
        DataFrame.unionByName,
        [df.agg(F.lit(what).alias("what"), F.count(F.lit(1)).alias("rows")) for what, df in rows.items()],
    )


@_query
def ingest_document_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Some documents are cut off, and some have a word for a time."""
    spoilt = _exported_users(spark, folder).selectExpr(
        "case when value like '%7\"},\"role\"%' then left(value, length(value) - 3) "
        "when value like '%5\"},\"role\"%' then replace(value, '\"created_on\":{\"$date\":\"', "
        "'\"created_on\":{\"$date\":\"about ') else value end as value"
    )
    parsed = parse_documents(spoilt, RAW["lms_users"])
    rejects = rejected_documents(parsed)
    return _counts(
        given=spoilt,
        loaded=valid_documents(parsed),
        unreadable=rejects.filter("field is null"),
        created_on=rejects.filter("field = 'created_on'"),
    )


@_query
def ingest_page_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Some pages are cut off."""
    pages = _pages(spark, folder).selectExpr(
        "if(event_id % 9 = 0, left(value, length(value) - 1), value) as value"
    )
    return _counts(given=pages, rejected=rejected_pages(pages), statements=flatten_pages(pages))


@_query
def ingest_page_elements(spark: SparkSession, folder: str) -> DataFrame:
    """A number stands among the statements of some pages: it alone is lost, and shown."""
    pages = _pages(spark, folder).selectExpr(
        "if(event_id % 5 = 0, replace(value, '[{', '[5,{'), value) as value"
    )
    return flatten_pages(pages).selectExpr("'statement' as what", "id as text").unionByName(
        rejected_elements(pages).selectExpr("'element ' || place as what", "element as text")
    )


@_query
def ingest_page_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Chains of a hundred pages, of which some were not landed and some lead round in a circle."""
    following = (
        "case when event_id % 1000 = 599 then event_id - 50 when event_id % 100 = 99 then null else event_id + 1 end"
    )
    pages = table_reader(spark, folder)("events").filter("event_id % 250 <> 7").selectExpr(
        "'https://lrs.example/more/' || event_id as address",
        f"to_json(named_struct('statements', array(), 'more', coalesce('/more/' || ({following}), ''))) as value",
    )
    return page_gaps(page_links(pages))


@_query
def ingest_cursor_tie(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that come late, at the time that the first load had come to, are loaded, and once."""
    store = RawStore(spark, scratch_path(spark, "raw"))
    users = _users(spark, folder)
    numbers = [
        store.merge("lms_users", users.filter("c_custkey % 2 = 0").drop("c_custkey"), "_id"),
        *[store.merge("lms_users", users.drop("c_custkey"), "_id") for _ in range(2)],
    ]
    loads = spark.createDataFrame(list(enumerate(numbers)), "load long, rows long")
    return store.read("lms_users").selectExpr("_id", "cast(modified_on as string) as what").unionByName(
        loads.selectExpr("'load ' || load as _id", "cast(rows as string) as what")
    )


@_query
def ingest_since_override(spark: SparkSession, folder: str) -> DataFrame:
    """Rows taken again from a given time on, whatever the state says."""
    store = RawStore(spark, scratch_path(spark, "raw"))
    users = _users(spark, folder).drop("c_custkey")
    store.merge("lms_users", users, "_id")
    renamed = users.withColumn("last_name", F.lit("renamed"))
    store.merge("lms_users", renamed, "_id", since="2023-09-01T00:00:00Z")
    return store.read("lms_users")


@_query
def ingest_clean_start(spark: SparkSession, folder: str) -> DataFrame:
    """A load that breaks off leaves nothing that is read, and the next one has it all."""
    store = RawStore(spark, scratch_path(spark, "raw"))
    users = _users(spark, folder).drop("c_custkey")
    half = users.filter("cast(_id as long) % 2 = 0")
    store.merge("lms_users", half, "_id")
    broken = users.withColumn("last_name", F.expr("if(_id = '1', raise_error('broken off'), 'never')"))
    try:
        store.merge("lms_users", broken, "_id", changed_only=False)
    except Exception as error:  # noqa: BLE001  the failure is the point
        if "broken off" not in str(error):
            raise
    store.merge("lms_users", users, "_id", changed_only=False)
    return store.read("lms_users")


@_query
def ingest_append_folded(spark: SparkSession, folder: str) -> DataFrame:
    """More appended loads than stay apart, and rows that a merge between them replaces."""
    store = RawStore(spark, scratch_path(spark, "raw"))
    statements = raw_reader(spark, folder)("lrs_statements").select("id", "timestamp")
    number = "cast(id as long)"
    for k in range(9):
        store.append("lrs_statements", statements.filter(f"{number} % 10 = {k}"))
    again = statements.filter(f"{number} % 10 < 2").withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    store.merge("lrs_statements", again, "id", changed_only=False)
    store.append("lrs_statements", statements.filter(f"{number} % 10 = 9"))
    return store.read("lrs_statements")


@_query
def ingest_type_drift(spark: SparkSession, folder: str) -> DataFrame:
    """A field is a whole number at first, a fraction later and a word in the end."""
    store = RawStore(spark, scratch_path(spark, "raw"), parts={"lms_users": hashed_parts("_id", 4)})
    users = _users(spark, folder)
    grades = ["cast(c_custkey % 7 as int)", "c_custkey / 2", "'grade ' || c_custkey % 7"]
    for k, grade in enumerate(grades):
        load = users.filter(f"c_custkey % 3 = {k} or c_custkey % 30 = 0").selectExpr("_id", f"{grade} as grade")
        store.merge("lms_users", load, "_id", changed_only=False)
        if k < 2:
            store.compact("lms_users")
    return store.read("lms_users")


@_query
def ingest_cursor_null(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that do not say when they changed come with every load."""
    users = _users(spark, folder).withColumn(
        "modified_on", F.expr("if(c_custkey % 4 = 0, null, modified_on)")
    )
    return incremental.changed_since(users.drop("c_custkey"), "2023-06-01T00:00:00Z")


@_query
def ingest_merge_resent(spark: SparkSession, folder: str) -> DataFrame:
    """Statements come again, stored on a later day: another part of the table, the same row."""
    store = RawStore(spark, scratch_path(spark, "raw"), parts={"lrs_statements": STORED_DAY})
    first = raw_reader(spark, folder)("lrs_statements").select("id", "timestamp", "stored")
    again = first.filter("cast(id as long) % 3 = 0").withColumn(
        "stored", F.expr("stored + make_dt_interval(9)")
    )
    store.merge("lrs_statements", first, "id")
    store.compact("lrs_statements")
    store.merge("lrs_statements", again, "id", changed_only=False)
    return store.read("lrs_statements")


@_query
def ingest_merge_no_key(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without key are neither versions of each other nor lost."""
    store = RawStore(spark, scratch_path(spark, "raw"))
    users = _users(spark, folder).withColumn("_id", F.expr("if(c_custkey % 5 = 0, null, _id)"))
    for _ in range(2):
        store.merge("lms_users", users, "_id", changed_only=False)
    return _counts(loaded=store.read("lms_users"), aside=store.set_aside("lms_users"))


@_query
def stg_lrs_events_any_host(spark: SparkSession, folder: str) -> DataFrame:
    """Staging without a prefix: extension keys of whatever host."""
    return build_model("stg_lrs_events", raw_reader(spark, folder), extension_map=EXTRA_EXTENSIONS)

@_query
def ingest_cursor_filter(spark: SparkSession, folder: str) -> DataFrame:
    enrollments = raw_reader(spark, folder)("lms_enrollments")
    changed = incremental.changed_since(enrollments, "1998-01-01T00:00:00Z")
    return changed.select("_id", "student", "modified_on")


@_query
def ingest_cursor_filter_any(spark: SparkSession, folder: str) -> DataFrame:
    """Changed by any of several cursor columns."""
    courses = raw_reader(spark, folder)("lms_courses").selectExpr(
        "_id", "modified_on as updatedAt", "created_on as modifiedAt"
    )
    columns = incremental.present(courses, incremental.CHANGE_FIELDS)
    return incremental.changed_since(courses, "2022-08-01T00:00:00Z", columns)


@_query
def ingest_cursor_state(spark: SparkSession, folder: str) -> DataFrame:
    read = raw_reader(spark, folder)
    return reduce(
        DataFrame.unionByName,
        [
            incremental.cursor_state(read(table), table)
            for table in ("lms_enrollments", "lms_blocks", "lms_lessons", "lrs_statements")
        ],
    )


def _users(spark: SparkSession, folder: str) -> DataFrame:
    return table_reader(spark, folder)("customer").selectExpr(
        "cast(c_custkey as string) as _id",
        "c_name as last_name",
        "cast(date_add(date'2023-01-01', cast(c_custkey % 365 + c_custkey % 30 as int)) "
        "as timestamp_ntz) as modified_on",
        "c_custkey",
    )


def _changed_users(spark: SparkSession, folder: str) -> DataFrame:
    """Two later versions of every third user, and new users."""
    users = _users(spark, folder)
    ids = (
        users.filter("c_custkey % 3 = 0")
        .select("_id", "last_name", "c_custkey")
        .unionByName(
            users.filter("c_custkey % 50 = 0").selectExpr(
                "'new' || _id as _id", "last_name", "c_custkey"
            )
        )
    )
    return ids.selectExpr("*", "explode(array(1, 2)) as v").selectExpr(
        "_id",
        "last_name || ' v' || v as last_name",
        "timestamp_ntz'2024-02-01' + make_dt_interval(c_custkey % 30 + 29 * (v - 1)) "
        "as modified_on",
    )


@_query
def ingest_upsert(spark: SparkSession, folder: str) -> DataFrame:
    incoming = incremental.latest_per_key(_changed_users(spark, folder), "_id")
    return incremental.upsert(_users(spark, folder).drop("c_custkey"), incoming, "_id")


@_query
def ingest_incremental_load(spark: SparkSession, folder: str) -> DataFrame:
    """A first load, then a second one that takes only what changed after it."""
    store = RawStore(
        spark, scratch_path(spark, "raw"), parts={"lms_users": hashed_parts("_id", 8)}
    )
    users = _users(spark, folder).drop("c_custkey")
    store.merge("lms_users", users, "_id")
    store.merge("lms_users", users.unionByName(_changed_users(spark, folder)), "_id")
    return store.read("lms_users").select("_id", "last_name", "modified_on")


@_query
def ingest_collection_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Collections read from exported files, and one through a connector, loaded as a job."""
    landing = scratch_path(spark, "landing")
    _exported_users(spark, folder).write.text(f"{landing}/users")
    courses = raw_reader(spark, folder)("lms_courses")
    courses.write.parquet(f"{landing}/courses")
    store = RawStore(spark, scratch_path(spark, "raw"))

    def read(collection: str) -> DataFrame:
        fmt = "parquet" if collection == "courses" else "text"
        return valid_documents(read_collection(spark, f"{landing}/{collection}", table_of(collection), fmt))

    load_collections(store, read, ["users", "courses"])
    return store.read("lms_users").selectExpr("'lms_users' as table", "_id", "modified_on").unionByName(
        store.read("lms_courses").selectExpr("'lms_courses' as table", "_id", "modified_on")
    )


@_query
def ingest_landed_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Landed pages, some of them cut off, loaded by the periodic job; a second run finds nothing new."""
    landing, seen = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    _pages(spark, folder).selectExpr(
        "if(event_id % 9 = 0, left(value, length(value) - 1), value) as value"
    ).repartition(3).write.text(landing)
    store = RawStore(spark, scratch_path(spark, "raw"), parts={"lrs_statements": STORED_DAY})
    for _ in range(2):
        load_landed_pages(spark, store, landing, seen, files_at_once=2).awaitTermination()
    return _counts(
        statements=store.read("lrs_statements"), rejected=store.read("lrs_statements_rejected")
    )


@_query
def ingest_stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Exported documents landed as files, read as a stream and merged batch by batch."""
    landing = scratch_path(spark, "landing")
    _exported_users(spark, folder).write.text(landing)
    store = RawStore(spark, scratch_path(spark, "raw"))
    merge_stream(
        landed_stream(spark, landing),
        store,
        "lms_users",
        "_id",
        scratch_path(spark, "stream"),
        prepare=lambda batch: valid_documents(parse_documents(batch, RAW["lms_users"])),
    ).awaitTermination()
    return store.read("lms_users").select("_id", "last_name", "created_on", "modified_on")


@_query
def ingest_append(spark: SparkSession, folder: str) -> DataFrame:
    statements = raw_reader(spark, folder)("lrs_statements").select("id", "timestamp")
    early = statements.filter("timestamp < timestamp_ntz'2024-01-15'")
    late = statements.filter("timestamp >= timestamp_ntz'2024-01-15'")
    return incremental.append(early, late)


@_query
def ingest_load_report(spark: SparkSession, folder: str) -> DataFrame:
    """All raw tables but one, against all that are expected."""
    read = raw_reader(spark, folder)
    expected = [*default_tables(), "lrs_statements"]
    return load_report(spark, lambda table: None if table == "lms_surveys" else read(table), expected)


def _check(check: Callable[..., DataFrame]) -> Query:
    return lambda spark, folder: check(warehouse(spark, folder, MODELS).table)


def queries() -> dict[str, Query]:
    named = dict(_QUERIES)
    named["staging_rejects"] = named.pop("staging_rejects_query")
    checks = {
        "dq_unique": quality.unique_keys,
        "dq_not_null": quality.filled_keys,
        "dq_composite_unique": quality.unique_columns,
        "dq_required": quality.required_columns,
        "dq_accepted_values": quality.accepted_values,
        "dq_referential": quality.referential,
        "dq_failing_rows": quality.failing_values,
    }
    return {
        **{name: _model(name) for name in REGISTRY if name not in TYPED_EMPTY},
        **named,
        **{name: _check(check) for name, check in checks.items()},
    }
