"""Raw tables derived with Spark from the test tables, row by row.

Every derivation is arithmetic on one row (only the schools look up their
nation), so a raw table grows with the table it comes from. Only events are
shuffled, still narrow, so that many tasks make statements of them. JSON text holds integers and short decimals only, so that the same
values can be computed independently in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EXTENSION_PREFIX = "https://xapi.example/extensions/"
# Extensions the fixture carries besides the default ones.
EXTRA_EXTENSIONS = {
    "sessionId": "session_id",
    "platformId": "platform_id",
    "ltiToolId": "lti_tool_id",
    "aiToolId": "ai_tool_id",
    "schoolId": "school_id",
}

# Events that one task makes statements of: an event is a few bytes in its file, and a thousand and more as JSON.
EVENTS_AT_ONCE = 10_000

Read = Callable[[str], DataFrame]
FIXTURES: dict[str, Callable[[Read], DataFrame]] = {}


def _fixture(build: Callable[[Read], DataFrame]) -> Callable[[Read], DataFrame]:
    FIXTURES[build.__name__] = build
    return build


def _id(prefix: str, number: Column | str) -> Column:
    number = F.col(number) if isinstance(number, str) else number
    return F.concat(F.lit(prefix), number.cast("string"))


def _unless(condition: Column, value: Column) -> Column:
    """The value, NULL where the condition holds."""
    return F.when(~condition, value)


def _day(base: str, days: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), days.cast("int")).cast("timestamp_ntz")


def _plus(ts: Column, **units: Column) -> Column:
    return ts + F.make_dt_interval(**{u: v.cast("int") for u, v in units.items()})


def _first(count: Column, limit: int, element: Callable[[Column], Column]) -> Column:
    """An array of the elements 1..count, where count is at most limit."""
    numbers = F.array(*[F.lit(n) for n in range(1, limit + 1)])
    return F.transform(F.slice(numbers, F.lit(1), count.cast("int")), element)


def _times(number: Column) -> dict[str, Column]:
    return {
        "createdAt": _day("2023-01-01", number % 365),
        "updatedAt": _day("2023-06-01", number % 300),
    }


def _select(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(*[column.alias(name) for name, column in columns.items()])


def _spread(rows: DataFrame, at_once: int, *columns: str) -> DataFrame:
    """Narrow rows dealt by some columns, before they are made wide: a file's row group is one task, whatever it holds."""
    tasks = ceil(rows.count() / at_once)
    return rows.repartition(tasks, *columns) if tasks > 1 else rows


@_fixture
def lrs_statements(read: Read) -> DataFrame:
    k = F.regexp_extract("props", r"\d+", 0).cast("int")
    events = _spread(read("events"), EVENTS_AT_ONCE, "event_id", "ts", "user_id").select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))
    k, kind = F.col("k"), F.col("event_type")

    def extensions(**values: Column) -> Column:
        return F.struct(*[v.alias(EXTENSION_PREFIX + n) for n, v in values.items()])

    silent = k % 10 == 0
    return _select(
        events,
        id=F.col("event_id").cast("string"),
        timestamp=F.col("ts"),
        stored=_plus(F.col("ts"), mins=F.col("event_id") % 7),
        actor=F.to_json(
            F.struct(
                F.struct(
                    F.lit("https://lms.example").alias("homePage"),
                    F.col("user_id").cast("string").alias("name"),
                ).alias("account"),
                F.lit("Agent").alias("objectType"),
            )
        ),
        verb=F.to_json(
            F.struct(
                F.struct(kind.alias("en-US")).alias("display"),
                F.concat(F.lit("http://verbs.example/"), kind).alias("id"),
            )
        ),
        object=F.to_json(
            F.struct(
                _id("content-", k).alias("id"),
                F.when(k % 3 == 0, "Activity").when(k % 3 == 1, "Agent").alias("objectType"),
            )
        ),
        result=F.to_json(
            F.struct(
                _unless(silent, k % 3 == 0).alias("completion"),
                F.struct(
                    F.lit(50000).alias("max"),
                    F.lit(0).alias("min"),
                    F.round(F.col("value") * 100).cast("bigint").alias("raw"),
                    (k / 100).cast("decimal(3,2)").alias("scaled"),
                ).alias("score"),
                _unless(silent, k % 2 == 0).alias("success"),
            )
        ),
        context=F.to_json(
            F.struct(
                extensions(
                    ai_tool_id=F.when(kind == "view", _id("ai", k % 3)),
                    attempts=k % 4 + 1,
                    course_id=_id("c", k % 25),
                    lti_tool_id=F.when(kind == "click", _id("t", k % 7)),
                    platform_id=_id("p", k % 5),
                    school_id=_id("n", F.col("user_id") % 25),
                    session_id=F.concat(
                        F.col("user_id").cast("string"),
                        F.lit("-"),
                        F.unix_date(F.to_date("ts")).cast("string"),
                    ),
                    time_taken_ms=k * 250,
                ).alias("extensions")
            )
        ),
    )


@_fixture
def lms_users(read: Read) -> DataFrame:
    key = F.col("c_custkey")
    # One role per remainder of the key: lists, plain words, an unknown word, none.
    roles = [
        '["student"]', "student", '["teacher","student"]', '["teacher"]',
        "teacher", '["staff"]', "admin", None,
    ]
    created = _day("2023-01-01", key % 365)
    return _select(
        read("customer"),
        _id=key.cast("string"),
        role=F.element_at(F.array(*[F.lit(r) for r in roles]), (key % 8).cast("int") + 1),
        first_name=_unless(key % 9 == 0, F.col("c_mktsegment")),
        last_name=_unless(key % 10 == 0, F.col("c_name")),
        school=_id("n", "c_nationkey"),
        grade=(key % 12 + 1).cast("string"),
        created_on=created,
        modified_on=_plus(created, days=key % 30),
    )


@_fixture
def lms_schools(read: Read) -> DataFrame:
    key = F.col("s_suppkey")
    schools = read("supplier").join(
        read("nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left"
    )
    return _select(
        schools,
        _id=_id("n", key),
        name=F.col("s_name"),
        location=F.col("n_name"),
        created_on=_day("2022-01-01", key % 365),
        modified_on=_day("2022-06-01", key % 300),
    )


@_fixture
def lms_courses(read: Read) -> DataFrame:
    key = F.col("p_partkey")
    return _select(
        read("part"),
        _id=_id("c", key),
        caption=F.col("p_name"),
        disciplines=F.when(key % 11 == 0, F.array().cast("array<string>")).otherwise(
            F.array("p_type", "p_brand")
        ),
        grades=_unless(key % 7 == 0, F.array(F.col("p_size").cast("string"))),
        created_on=_day("2022-01-01", key % 365),
        modified_on=_day("2022-06-01", key % 300),
    )


@_fixture
def lms_enrollments(read: Read) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    known = F.col("o_custkey").cast("string")
    return _select(
        read("orders"),
        _id=_id("e", key),
        student=_unless(
            key % 29 == 0, F.when(key % 19 == 0, _id("x", "o_custkey")).otherwise(known)
        ),
        course=_id("c", key % 2000),
        group=_unless(key % 13 == 0, _id("g", key % 10)),
        year=_unless(key % 17 == 0, F.year(day)),
        status=F.col("o_orderstatus"),
        created_on=day,
        modified_on=_plus(day, days=key % 5),
    )


def _skills_json(key: Column) -> Column:
    """``{"skills":[..]}`` with none to three entries: with weight, without, and a plain id."""

    def entry(number: Column) -> Column:
        skill = _id("s", ((key + number) % 25) * 3)
        return (
            F.when(number == 1, F.concat(F.lit('{"skillId":"'), skill, F.lit('","skillWeight":0.5}')))
            .when(number == 2, F.concat(F.lit('{"skillId":"'), skill, F.lit('"}')))
            .otherwise(F.concat(F.lit('"'), skill, F.lit('"')))
        )

    entries = F.array_join(_first(key % 4, 3, entry), ",")
    return _unless(key % 11 == 0, F.concat(F.lit('{"skills":['), entries, F.lit("]}")))


def _content_table(df: DataFrame, prefix: str, key: Column, title: Column, text: Column):
    kinds = F.array(F.lit("choice"), F.lit("essay"), F.lit("numeric"))
    return _select(
        df,
        _id=_id(prefix, key),
        schoolId=_id("n", key % 25),
        courseId=_id("c", key % 2000),
        sectionId=_id("g", key % 10),
        interactionType=F.element_at(kinds, (key % 3).cast("int") + 1),
        title=title,
        description=text,
        difficultyEstimate=(key % 10) / 10,
        metadata=_skills_json(key),
        **_times(key),
    )


@_fixture
def lms_pages(read: Read) -> DataFrame:
    return _content_table(read("pages"), "pg-", F.col("page_id"), F.col("url"), F.col("html"))


def _documents(read: Read, prefix: str, remainder: int) -> DataFrame:
    key = F.col("doc_id")
    title = F.concat("lang", F.lit(" "), "source")
    return _content_table(
        read("documents").filter(key % 2 == remainder), prefix, key, title, F.col("text")
    )


@_fixture
def lms_blocks(read: Read) -> DataFrame:
    return _documents(read, "bl-", 0)


@_fixture
def lms_lessons(read: Read) -> DataFrame:
    return _documents(read, "le-", 1)


@_fixture
def lms_exercises(read: Read) -> DataFrame:
    """Items are JSON text here; profiles and submissions hold native arrays."""
    key, size = F.col("p_partkey"), F.col("p_size")

    def item(number: Column) -> Column:
        return F.struct(
            _id("pg-", (key + number) % 50).alias("contentId"),
            F.when(number == 1, "mcq").otherwise("short-answer").alias("type"),
            F.when(number % 2 == 1, "choice").alias("interactionType"),
            F.repeat(F.concat("p_name", F.lit(".")), ((key + number) % 40 + 1).cast("int")).alias(
                "prompt"
            ),
            (number / 4).cast("decimal(3,2)").alias("difficulty"),
            number.alias("maxScore"),
            F.struct(number.alias("n")).alias("metadata"),
            F.slice(
                F.array(_id("s", (key % 25) * 3), _id("s", ((key + 1) % 25) * 3)),
                F.lit(1),
                number - 1,
            ).alias("skills"),
        )

    return _select(
        read("part"),
        _id=_id("ex", key),
        schoolId=_id("n", key % 25),
        courseId=_id("c", key),
        sectionId=_id("g", key % 10),
        termId=F.concat((key % 3 + 2022).cast("string"), F.lit("_default")),
        title=F.col("p_name"),
        description=F.col("p_type"),
        maxScore=_unless(key % 5 == 0, size.cast("double")),
        passingScore=size / 2,
        metadata=F.to_json(F.struct(F.col("p_brand").alias("brand"))),
        items=F.to_json(_first(size % 4, 3, item)),
        **_times(key),
    )


@_fixture
def lms_assessment_profiles(read: Read) -> DataFrame:
    key = F.col("s_suppkey")

    def item(number: Column) -> Column:
        # The third item repeats the first, with less position and more points.
        again = number == 3
        return F.struct(
            _id("it", (key + F.when(again, 1).otherwise(number)) % 50).alias("itemId"),
            F.when(again, 0).otherwise(number).alias("position"),
            (number * 2).cast("double").alias("points"),
        )

    return _select(
        read("supplier"),
        _id=_id("ap", key),
        schoolId=_id("n", key % 25),
        courseId=_id("c", key % 2000),
        sectionId=_id("g", key % 10),
        termId=F.lit("2023_default"),
        contentId=_id("pg-", key % 50),
        title=F.col("s_name"),
        description=F.lit(None).cast("string"),
        assessmentType=F.when(key % 2 == 0, "quiz").otherwise("exam"),
        gradingScheme=F.lit("percent"),
        maxScore=F.lit(100.0),
        passingScore=F.lit(60.0),
        metadata=F.lit(None).cast("string"),
        items=_first(key % 4, 3, item),
        **_times(key),
    )


@_fixture
def lms_exercise_submissions(read: Read) -> DataFrame:
    key = F.col("o_orderkey")
    start = _plus(F.col("o_orderdate"), secs=key % 86400)
    submitted = _plus(start, secs=key % 3600)
    count = (key % 4).cast("int")

    def answer(number: Column) -> Column:
        stamp = F.date_format(_plus(start, secs=number * 7), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        return F.struct(
            _id("it", (key + number) % 50).alias("itemId"),
            _id("pg-", (key + number) % 50).alias("itemContentId"),
            F.when(number != 2, _id("s", (key % 25) * 3)).alias("itemSkillId"),
            number.alias("itemPosition"),
            F.concat(F.lit("answer "), number.cast("string")).alias("response"),
            F.when(number != 3, (key + number) % 2 == 0).alias("isCorrect"),
            ((key + number) % 10).cast("double").alias("itemScore"),
            (((key + number) % 10) / 10).alias("itemScoreScaled"),
            (key % 1000 + number).cast("int").alias("latencyMs"),
            (number % 2).alias("hintsUsed"),
            stamp.alias("responseTime"),
        )

    return _select(
        read("orders"),
        _id=_id("sub", key),
        userId=F.col("o_custkey").cast("string"),
        sessionId=_id("ss", key % 5000),
        schoolId=_id("n", key % 25),
        termId=F.concat(F.year("o_orderdate").cast("string"), F.lit("_default")),
        courseId=_id("c", key % 2000),
        sectionId=_id("g", key % 10),
        exerciseId=_id("ex", key % 2000),
        startedAt=start,
        submittedAt=submitted,
        scoreRaw=F.col("o_totalprice"),
        scoreScaled=(key % 101) / 100,
        scorePercent=(key % 101).cast("double"),
        passed=_unless(key % 7 == 0, key % 101 >= 60),
        attemptNumber=(key % 3 + 1).cast("int"),
        itemCount=count,
        completedItemCount=F.least(count, F.lit(2)),
        metadata=F.to_json(F.struct(F.col("o_orderpriority").alias("priority"))),
        sourcePayload=F.to_json(F.struct(key.alias("order"))),
        itemId=F.when(key % 3 == 0, _id("it", key % 50)),
        itemPosition=count,
        itemPoints=(key % 5).cast("double"),
        itemResponses=_first(count, 3, answer),
    )


@_fixture
def lms_rules(read: Read) -> DataFrame:
    key = F.col("p_partkey")
    is_skill, is_standard = key % 3 == 0, key % 3 == 1

    def mapping(number: Column) -> Column:
        # The first mapping is complete, the second lacks weight and source,
        # the third lacks the standard.
        return F.struct(
            _id("s", key).alias("skillId"),
            F.when(number != 3, _id("std", key + number * 3 - 2)).alias("standardId"),
            F.when(number == 1, F.lit(0.25).cast("decimal(3,2)")).alias("weight"),
            F.when(number == 1, "import").alias("source"),
        )

    return _select(
        read("part"),
        _id=F.concat(
            F.when(is_skill, "s").when(is_standard, "std").otherwise("bd"), key.cast("string")
        ),
        type=F.when(is_skill, "skill").when(is_standard, "standard").otherwise("badge"),
        externalCode=F.col("p_brand"),
        name=F.col("p_name"),
        description=F.col("p_type"),
        domain=F.col("p_type"),
        strand=F.lit(None).cast("string"),
        level=F.col("p_size").cast("string"),
        parentSkillId=F.when(key % 6 == 0, _id("s", F.floor(key / 6) * 3)),
        framework=F.lit("local"),
        gradeBand=(key % 12 + 1).cast("string"),
        subject=F.col("p_type"),
        parentStandardId=F.when(key % 6 == 1, F.lit("std1")),
        metadata=F.when(
            is_skill & (key % 5 != 0),
            F.to_json(F.struct(_first(key % 4, 3, mapping).alias("standardMappings"))),
        ),
        **_times(key),
    )


def _support_table(df: DataFrame, prefix: str, key: str, title: Column) -> DataFrame:
    return _select(
        df,
        _id=_id(prefix, key),
        title=title,
        metadata=F.lit(None).cast("string"),
        **_times(F.col(key)),
    )


@_fixture
def lms_modules(read: Read) -> DataFrame:
    return _support_table(read("part"), "mo", "p_partkey", F.col("p_name"))


@_fixture
def lms_projects(read: Read) -> DataFrame:
    return _support_table(read("supplier"), "pr", "s_suppkey", F.col("s_name"))


@_fixture
def lms_project_enrollments(read: Read) -> DataFrame:
    return _support_table(read("customer"), "pe", "c_custkey", F.col("c_name"))


@_fixture
def lms_surveys(read: Read) -> DataFrame:
    return _support_table(read("benchmark"), "sv", "item_id", F.col("text"))


@_fixture
def lms_survey_enrollments(read: Read) -> DataFrame:
    return _support_table(read("labels"), "se", "doc_id", F.col("quality").cast("string"))


@_fixture
def lms_survey_submissions(read: Read) -> DataFrame:
    turns = read("conversations").withColumn("key", F.col("conv_id") * 1000 + F.col("turn"))
    return _support_table(turns, "su", "key", F.col("text"))


def table_reader(spark: SparkSession, folder: str) -> Read:
    """Reads the test tables of a folder by name."""
    return lambda name: spark.read.parquet(f"{folder}/{name}.parquet")


def raw_reader(spark: SparkSession, folder: str) -> Read:
    """Reads the derived raw tables by name."""
    tables = table_reader(spark, folder)
    return lambda name: FIXTURES[name](tables)
