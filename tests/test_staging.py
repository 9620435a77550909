import json
import re

import pytest
from pyspark.sql import Observation

from learnsilver.plans import build_model
from learnsilver.plans.staging import staging_rejects
from learnsilver.sources.fixtures import EXTENSION_PREFIX, EXTRA_EXTENSIONS, raw_reader

IRI = "https://host.example/xapi/extensions/"


def statement(**parts):
    row = {"id": "s1", "timestamp": "2024-01-07T10:11:12.5Z", **parts}
    return tuple(
        json.dumps(row[k]) if isinstance(row.get(k), dict) else row.get(k)
        for k in ("id", "timestamp", "actor", "verb", "object", "result", "context")
    )


@pytest.fixture
def stage(frame):
    schema = "id string, timestamp string, actor string, verb string, object string, " \
        "result string, context string"

    def run(*statements, **options):
        raw = frame([statement(**s) for s in statements], schema)
        return build_model("stg_lrs_events", lambda _: raw, **options).collect()

    return run


def context(**extensions):
    return {"extensions": {IRI + k: v for k, v in extensions.items()}}


@pytest.mark.parametrize(
    "ms, seconds", [(500, 1), (1500, 2), (2500, 3), (250, 0), (-500, -1), (None, None)]
)
@pytest.mark.parametrize("prefix", [None, IRI])
def test_duration_rounds_halves_away_from_zero(stage, ms, seconds, prefix):
    row = stage({"context": context(time_taken_ms=ms)}, extension_prefix=prefix)[0]
    assert row.durationSeconds == seconds


@pytest.mark.parametrize("prefix", [None, IRI])
def test_extension_keys_with_dots_and_slashes_are_found(stage, prefix):
    row = stage({"context": context(course_id="c1", attempts=3)}, extension_prefix=prefix)[0]
    assert (row.courseId, row.attemptNumber) == ("c1", 3)


def test_extension_of_another_host_is_read_only_without_prefix(stage):
    other = {"extensions": {"http://other.example/course_id": "c9"}}
    assert stage({"context": other})[0].courseId == "c9"
    assert stage({"context": other}, extension_prefix=IRI)[0].courseId is None


def test_extra_extensions_fill_further_columns(stage):
    row = stage(
        {"context": context(session="x", latency="17")},
        extension_map={"sessionId": "session", "latencyMs": "latency"},
        extension_prefix=IRI,
    )[0]
    assert (row.sessionId, row.latencyMs, row.platformId) == ("x", 17, None)


@pytest.mark.parametrize(
    "value, expected",
    [
        ({"x": 1}, None),
        ([1], None),
        ("{x", "{x"),
        ('{"x":1}', '{"x":1}'),
        ("[1,2]", "[1,2]"),
        ("", ""),
        (7, "7"),
        (True, "true"),
        (None, None),
    ],
)
def test_only_scalars_are_extracted(stage, value, expected):
    row = stage({"verb": {"id": value}, "result": {"response": value}})[0]
    assert row.verbId == expected
    assert row.response == expected


@pytest.mark.parametrize("prefix", [None, IRI])
@pytest.mark.parametrize("value, expected", [({"x": 1}, None), ("{x", "{x"), ("[1]", "[1]")])
def test_only_scalar_extensions_are_extracted(stage, value, expected, prefix):
    row = stage({"context": context(course_id=value)}, extension_prefix=prefix)[0]
    assert row.courseId == expected


def test_bad_number_is_null_or_an_error(stage):
    bad = {"context": context(attempts="abc")}
    assert stage(bad)[0].attemptNumber is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage(bad, strict=True)


def test_bad_boolean_is_null_or_an_error(stage):
    bad = {"result": {"success": "yes"}}
    assert stage(bad)[0].success is None
    with pytest.raises(Exception, match="not a boolean"):
        stage(bad, strict=True)


def test_fixed_paths(stage):
    row = stage(
        {
            "actor": {"account": {"name": "u1"}},
            "verb": {"id": "http://v", "display": {"en-US": "did"}},
            "object": {"id": "o1", "objectType": "Activity"},
            "result": {
                "success": True, "completion": False, "response": "r",
                "score": {"raw": 1.5, "min": 0, "max": 2, "scaled": 0.75},
            },
        }
    )[0]
    assert (row.userId, row.verbId, row.verbIri, row.eventType) == ("u1", *["http://v"] * 3)
    assert (row.verbDescription, row.objectId, row.contentId) == ("did", "o1", "o1")
    assert (row.objectType, row.success, row.isCorrect, row.completion) == (
        "Activity", True, True, False,
    )
    assert (row.scoreRaw, row.scoreMin, row.scoreMax, row.scoreScaled) == (1.5, 0.0, 2.0, 0.75)
    assert (row.actorType, row.scorePercent, row.response) == ("learner", None, "r")


def test_full_statement_keeps_the_nesting_and_nulls(stage):
    row = stage({"id": 'a"b', "verb": {"id": "v", "display": None}})[0]
    parsed = json.loads(row.fullStatement)
    assert parsed["id"] == 'a"b'
    assert parsed["timestamp"] == "2024-01-07T10:11:12.5Z"
    assert parsed["verb"] == {"id": "v", "display": None}
    assert parsed["actor"] is None and parsed["context"] is None


def test_time_zone_offsets_are_applied(stage):
    rows = stage(
        {"timestamp": "2024-01-07T10:00:00+02:00"},
        {"timestamp": "2024-01-07T10:00:00"},
        {"timestamp": "nonsense"},
    )
    assert [str(r.event_timestamp) for r in rows] == [
        "2024-01-07 08:00:00", "2024-01-07 10:00:00", "None",
    ]


def test_times_do_not_depend_on_the_session_time_zone(spark, stage):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # The last two fall into the hour that New York has twice.
        rows = stage(
            {"timestamp": "2024-01-07T10:00:00+02:00"},
            {"timestamp": "2024-11-03T05:30:00Z"},
            {"timestamp": "2024-11-03T06:30:00Z"},
        )
        assert [str(r.event_timestamp) for r in rows] == [
            "2024-01-07 08:00:00", "2024-11-03 05:30:00", "2024-11-03 06:30:00",
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parts_may_be_nested_columns(spark):
    raw = spark.sql(
        "select 'a' as id, timestamp_ntz'2024-01-01' as timestamp, "
        "named_struct('id', 'v1') as verb, parse_json('{\"id\":\"o1\"}') as object"
    )
    row = build_model("stg_lrs_events", lambda _: raw).first()
    assert (row.verbId, row.objectId, row.userId) == ("v1", "o1", None)


def test_rejects_are_counted(frame):
    raw = frame(
        [
            ("1", json.dumps(context(attempts="x")), '{"success":"maybe"}'),
            ("2", json.dumps(context(attempts=2)), '{"success":true}'),
            ("3", None, None),
        ],
        "id string, context string, result string",
    ).selectExpr("*", "timestamp_ntz'2024-01-01' as timestamp", "'' as actor", "'' as verb",
                 "'' as object")
    found = {r.column: (r.given, r.rejected) for r in staging_rejects(raw).collect()}
    assert found["attemptNumber"] == (2, 1)
    assert found["success"] == (2, 1)
    assert found["durationSeconds"] == (0, 0)


def test_statement_is_parsed_once_per_part(frame):
    raw = frame([], "id string, timestamp timestamp_ntz, actor string, verb string, "
                    "object string, result string, context string")
    staged = build_model("stg_lrs_events", lambda _: raw, extension_prefix=IRI)
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    # An empty input folds away, so look at the analysed plan.
    plan = staged._jdf.queryExecution().analyzed().toString()
    assert plan.count("from_json(") == 5


def test_statements_are_made_by_many_tasks_of_one_row_group(spark, tmp_path):
    spark.range(25_000, numPartitions=1).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01' as ts", "id % 7 as user_id", "'view' as event_type",
        "0.5D as value", "'{\"k\": 3}' as props",
    ).write.parquet(f"{tmp_path}/events.parquet")
    statements = raw_reader(spark, str(tmp_path))("lrs_statements")
    assert statements.rdd.getNumPartitions() == 3
    # A load of some of them is spread too, and is no less than those.
    load = statements.filter("cast(id as long) % 4 <> 0")
    assert load.rdd.getNumPartitions() == 3
    assert load.selectExpr("count(*) as n", "count(distinct id) as ids").first() == (18_750, 18_750)


def test_the_generated_code_is_short_enough_to_be_compiled(spark, tmp_path, capsys):
    """The JVM interprets methods of more than 8,000 bytes, however often they run."""
    raw_reader(spark, "/root/testdata/sf0.001")("lrs_statements").limit(20).write.parquet(f"{tmp_path}/raw")
    build_model(
        "stg_lrs_events", lambda _: spark.read.parquet(f"{tmp_path}/raw"), observation=Observation(),
        extension_map=EXTRA_EXTENSIONS, extension_prefix=EXTENSION_PREFIX,
    ).explain("codegen")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8_000
