import pytest

from learnsilver.operators import quality
from learnsilver.operators.lineage import (
    assert_schema,
    lineage,
    schema_registry,
    with_comments,
)
from learnsilver.operators.warehouse import Warehouse
from learnsilver.plans import REGISTRY, build_model
from learnsilver.schemas import CONTRACTS, MODELS, SILVER, references
from learnsilver.sources.fixtures import EXTENSION_PREFIX, EXTRA_EXTENSIONS, raw_reader

FOLDER = "/root/testdata/sf0.001"


def reader(spark, **tables):
    return lambda name: tables.get(name, spark.createDataFrame([], CONTRACTS[name].ddl))


def failures(result):
    return {(r.model, r.check, r.column): r.failures for r in result.collect()}


def people(spark, *rows):
    return spark.createDataFrame(rows, "person_id string, person_type string").selectExpr(
        "*", "'o1' as home_organization_id"
    )


def test_unique_and_not_null(spark):
    read = reader(spark, dim_person=people(spark, ("1", "A"), ("1", "B"), ("1", "C"), (None, "D")))
    assert failures(quality.unique_keys(read, ["dim_person", "dim_course"])) == {
        ("dim_person", "unique", "person_id"): 1,
        ("dim_course", "unique", "course_id"): 0,
    }
    assert failures(quality.filled_keys(read, ["dim_person"])) == {
        ("dim_person", "not_null", "person_id"): 1
    }


def test_composite_unique_lets_nulls_pass(spark):
    verbs = spark.createDataFrame([("1", "x"), ("2", "x"), ("3", None), ("4", None)],
                                  "verb_id string, iri string")
    read = reader(spark, ref_verb=verbs)
    assert failures(quality.unique_columns(read, ["ref_verb"])) == {
        ("ref_verb", "composite_unique", "iri"): 1
    }
    assert failures(quality.required_columns(read, ["ref_verb"])) == {
        ("ref_verb", "required", "iri"): 2
    }


def test_accepted_values(spark):
    read = reader(spark, dim_person=people(spark, ("1", "LEARNER"), ("2", "CAT"), ("3", None)))
    assert failures(quality.accepted_values(read)) == {
        ("dim_person", "accepted_values", "person_type"): 1
    }


def test_references_count_rows_without_parent(spark):
    organizations = spark.createDataFrame([("o2",)], "organization_id string").selectExpr(
        "*", "cast(null as string) as parent_organization_id"
    )
    read = reader(spark, dim_person=people(spark, ("1", "A"), ("2", "A")),
                  dim_organization=organizations)
    found = failures(quality.referential(read, ["dim_person", "dim_organization"]))
    assert found == {
        ("dim_person", "references dim_organization", "home_organization_id"): 2,
        ("dim_organization", "references dim_organization", "parent_organization_id"): 0,
    }


def test_references_are_declared_for_the_right_columns():
    declared = references()
    assert len(declared) == len(set(declared)) == 124
    assert ("fact_launch", "lti_tool_id", "dim_lti_tool", "lti_tool_id") in declared
    assert ("dim_skill", "parent_skill_id", "dim_skill", "skill_id") in declared
    assert not any(c == "bridge_course_membership" and k == "role_key" for c, k, *_ in declared)
    assert not any(k == SILVER[c].key for c, k, *_ in declared)


def test_all_checks_run_over_a_full_build(spark, tmp_path):
    built = Warehouse(
        spark, str(tmp_path), raw_reader(spark, FOLDER), prefix="dev",
        extension_map=EXTRA_EXTENSIONS, extension_prefix=EXTENSION_PREFIX,
    )
    built.build_all()
    assert (tmp_path / "dev_silver" / "dim_person").is_dir()
    assert (tmp_path / "dev_staging" / "stg_lrs_events").is_dir()
    for name in MODELS:
        assert_schema(built.table(name), MODELS[name])
    found = failures(quality.run_checks(built.table))
    assert len(found) == 36 + 36 + 8 + 56 + 124 + 1
    # Keys that hold on this data, and those the models are known to repeat.
    repeated = {m for (m, check, _), n in found.items() if check == "unique" and n}
    assert repeated == {"dim_platform", "dim_lti_tool", "dim_ai_tool"} | (
        repeated & {"dim_session", "fact_session_summary"}
    )
    assert all(n == 0 for (_, check, _), n in found.items() if check == "not_null")
    # One to one models keep the row count of their input.
    raw = raw_reader(spark, FOLDER)
    for model, source in {
        "stg_lrs_events": "lrs_statements", "fact_learning_event": "lrs_statements",
        "dim_person": "lms_users", "dim_organization": "lms_schools",
        "dim_course": "lms_courses", "fact_assessment_attempt": "lms_exercise_submissions",
    }.items():
        assert built.table(model).count() == raw(source).count()
    assert built.table("dim_content").count() == sum(
        raw(t).count() for t in ("lms_pages", "lms_blocks", "lms_lessons")
    )
    # A second build replaces the first.
    built.build("dim_person")
    assert built.table("dim_person").count() == raw("lms_users").count()


def test_lineage(spark):
    edges = {(r.parent, r.child): r.layer for r in lineage(spark).collect()}
    assert edges[("lrs_statements", "stg_lrs_events")] == "staging"
    assert edges[("stg_lrs_events", "fact_launch")] == "silver"
    assert edges[("lms_users", "bridge_course_membership")] == "silver"
    assert {c for _, c in edges} == set(MODELS) == set(REGISTRY)


def test_schema_registry(spark):
    rows = schema_registry(spark).filter("table = 'dim_date'").orderBy("position").collect()
    assert [r.column for r in rows] == SILVER["dim_date"].names
    assert {r.field_count for r in rows} == {12}
    assert rows[0].comment == "Days since 1970-01-01"


def test_written_tables_carry_comments(spark):
    df = with_comments(spark.createDataFrame([], SILVER["dim_date"].ddl), SILVER["dim_date"])
    assert df.schema["date_id"].metadata == {"comment": "Days since 1970-01-01"}


def test_schema_differences_are_named(spark):
    with pytest.raises(ValueError, match="dim_course: .*missing"):
        assert_schema(spark.range(1), SILVER["dim_course"])


def test_hot_student_is_split_over_tasks(spark):
    """A student with a third of all enrolments: the skewed partition is split, rows are whole."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        enrollments = spark.range(0, 60000, 1, 8).selectExpr(
            "'e' || id as _id", "if(id % 3 = 0, '7', '' || (id % 5000)) as student",
            "'g' as `group`", "'c' || id as course",
        )
        users = spark.range(5000).selectExpr("'' || id as _id", "'teacher' as role")
        read = reader(spark, lms_enrollments=enrollments, lms_users=users)
        for model in ("bridge_section_membership", "bridge_course_membership"):
            result = build_model(model, read)
            assert result.filter("role_key = 'Instructor'").count() == 60000
            rows = result.collect()
            assert len(rows) == 60000
            plan = result._jdf.queryExecution().executedPlan().toString()
            assert "isFinalPlan=true" in plan and "skew=true" in plan, model
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_session_summary_spreads_a_hot_session(spark):
    """The first shuffle is by session and content, and nothing is expanded."""
    plan = build_model("fact_session_summary", reader(
        spark, stg_lrs_events=spark.range(10).selectExpr(
            "'s' as sessionId", "'' || id as contentId", "true as isCorrect",
            "1 as durationSeconds", "'t' as aiToolId", "'m' as metadata",
        )
    ))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text
    row = plan.first()
    assert (row.items_attempted, row.items_mastered, row.ai_interactions) == (10, 10, 10)


def test_failing_values_and_the_mode_that_fails(spark):
    read = reader(
        spark, dim_person=people(spark, ("1", "LEARNER"), ("1", "CAT"), ("1", "CAT"), (None, "LEARNER"))
    )
    found = {tuple(r) for r in quality.failing_values(read, ["dim_person"]).collect()}
    assert {
        ("dim_person", "unique", "person_id", "1", 3),
        ("dim_person", "not_null", "person_id", None, 1),
        ("dim_person", "accepted_values", "person_type", "CAT", 2),
        ("dim_person", "references dim_organization", "home_organization_id", "o1", 4),
    } <= found
    with pytest.raises(quality.ChecksFailed, match="person_type accepted_values: 2"):
        quality.assert_checks(read, ["dim_person"])
    quality.assert_checks(reader(spark), ["dim_person"])


def test_values_that_stand_alone_are_not_put_together_in_few_tasks(spark):
    read = reader(spark, dim_person=people(spark, ("1", "LEARNER"), ("1", "CAT"), ("2", "CAT")))
    for found in (quality.unique_keys(read), quality.unique_columns(read)):
        assert found._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") == 1
    rules = [("dim_person", ("person_id",)), ("dim_course", ("course_id",))]
    assert [tuple(r) for r in quality._repeated(read, rules).collect()] == [(0, "1", 2)]
    assert quality._repeated(read, rules).rdd.getNumPartitions() == 4


def test_the_parents_of_references_are_not_put_together_in_few_tasks(spark):
    read = reader(spark, dim_person=people(spark, ("1", "LEARNER"), ("2", "CAT")))
    known = quality.referential(read, ["dim_person"])._jdf.queryExecution().executedPlan().toString()
    assert known.count("REPARTITION_BY_NUM") == 1


def test_what_fails_is_counted_by_task_and_what_repeats_by_value(spark):
    rows = people(spark, *[(None, "CAT")] * 40, ("1", "CAT"), ("1", "CAT"), ("2", "CAT"))
    read = reader(spark, dim_person=rows)
    plan = quality.failing_values(read, ["dim_person"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2
    found = {tuple(r) for r in quality.failing_values(read, ["dim_person"]).collect() if r.check != "required"}
    assert found == {
        ("dim_person", "unique", "person_id", "1", 2),
        ("dim_person", "not_null", "person_id", None, 40),
        ("dim_person", "accepted_values", "person_type", "CAT", 43),
        ("dim_person", "references dim_organization", "home_organization_id", "o1", 43),
    }


def test_a_failed_build_leaves_the_table_as_it_was(spark, tmp_path):
    users = spark.createDataFrame([("1",), ("2",)], "_id string")
    tables = {"lms_users": users}
    built = Warehouse(spark, str(tmp_path), lambda name: tables.get(name))
    built.build("dim_person")
    before = built.path("dim_person")
    assert built.table("dim_person").count() == 2
    tables["lms_users"] = users.selectExpr("raise_error('broken') as _id")
    with pytest.raises(Exception, match="broken"):
        built.build("dim_person")
    assert built.path("dim_person") == before and built.table("dim_person").count() == 2
    tables["lms_users"] = users.limit(1)
    built.build("dim_person")
    assert built.path("dim_person") != before and built.table("dim_person").count() == 1
    assert built.vacuum("dim_person") == 1  # what the failed build left


@pytest.mark.parametrize("name", ["dim_session", "fact_session_summary"])
def test_numbers_of_sessions_are_not_sorted(spark, name):
    from learnsilver.plans import REGISTRY  # noqa: F401

    events = spark.createDataFrame([], CONTRACTS["stg_lrs_events"].ddl)
    plan = build_model(name, lambda _: events)._jdf.queryExecution().sparkPlan().toString()
    lines = [line for line in plan.splitlines() if "SortAggregate" in line]
    assert lines and all("max(metadata" in line and "event_timestamp" not in line for line in lines)
    assert any("HashAggregate" in line and "durationSeconds" in line for line in plan.splitlines())


def test_staging_parses_only_what_came_since(spark, tmp_path):
    from learnsilver.operators.rawstore import STORED_DAY, RawStore

    store = RawStore(spark, f"{tmp_path}/raw", parts={"lrs_statements": STORED_DAY})
    built = Warehouse(spark, f"{tmp_path}/lake", store.read, statements=store)

    def statements(*rows):
        return spark.createDataFrame(rows, "id string, day int").selectExpr(
            "id", *[f"timestamp_ntz'2024-01-01' + make_dt_interval(day) as {c}" for c in ("timestamp", "stored")],
            *[f"cast(null as string) as {c}" for c in ("actor", "verb", "object", "result", "context", "authority")],
        )

    def staged():
        built.build("stg_lrs_events")
        rows = built.table("stg_lrs_events").select("event_id", "event_timestamp").collect()
        return sorted((r.event_id, r.event_timestamp.day) for r in rows)

    store.merge("lrs_statements", statements(("a", 0), ("b", 0)), "id")
    assert staged() == [("a", 1), ("b", 1)]
    store.merge("lrs_statements", statements(("b", 3), ("c", 3)), "id")
    assert store.changes("lrs_statements", 1).count() == 2
    assert staged() == [("a", 1), ("b", 4), ("c", 4)]
    assert staged() == [("a", 1), ("b", 4), ("c", 4)]
    version = built.staging.version("stg_lrs_events")
    assert staged() and built.staging.version("stg_lrs_events") == version  # nothing new, nothing written
    store.merge("lrs_statements", statements(("d", 5)), "id")
    store.compact("lrs_statements")
    assert store.changes("lrs_statements", 2).count() == 1  # folded in, and kept for staging
    assert staged() == [("a", 1), ("b", 4), ("c", 4), ("d", 6)]
