"""Dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnsilver.functions.columns import conform, joined_key, utc, with_last_metadata
from learnsilver.functions.jsonx import explode_records, json_text
from learnsilver.functions.timeids import date_id, time_of_day_id
from learnsilver.plans.registry import model
from learnsilver.schemas import SILVER


def snake_times(df: DataFrame) -> dict[str, str]:
    return {"created_at": utc(df, "created_on"), "updated_at": utc(df, "modified_on")}


def camel_times(df: DataFrame) -> dict[str, str]:
    return {"created_at": utc(df, "createdAt"), "updated_at": utc(df, "updatedAt")}


@model("lrs_statements")
def dim_date(statements: DataFrame) -> DataFrame:
    """One row per day on which a statement was made. Weeks are ISO, Sunday is day 1."""
    days = (
        statements.selectExpr(f"to_date({utc(statements, 'timestamp')}) as date")
        .filter("date is not null")
        .distinct()
    )
    return conform(
        days,
        SILVER["dim_date"],
        date_id=date_id("date"),
        date="date",
        year="year(date)",
        month="month(date)",
        day="dayofmonth(date)",
        quarter="quarter(date)",
        week_of_year="weekofyear(date)",
        day_of_week="dayofweek(date)",
        day_name="date_format(date, 'EEEE')",
        is_weekend="dayofweek(date) in (1, 7)",
        is_holiday="false",
    )


@model("lrs_statements")
def dim_time_of_day(statements: DataFrame) -> DataFrame:
    """One row per second of the day at which a statement was made; 86,400 at most."""
    seconds = (
        statements.selectExpr(f"{utc(statements, 'timestamp')} as ts")
        .selectExpr(f"{time_of_day_id('ts')} as id")
        .filter("id is not null")
        .distinct()
    )
    parts = {"hour": "id div 3600", "minute": "id div 60 % 60", "second": "id % 60"}
    return conform(
        seconds,
        SILVER["dim_time_of_day"],
        time_of_day_id="id",
        label=" || ':' || ".join(f"lpad(cast({p} as string), 2, '0')" for p in parts.values()),
        **parts,
    )


@model("lms_schools")
def dim_organization(schools: DataFrame) -> DataFrame:
    return conform(
        schools,
        SILVER["dim_organization"],
        organization_id="_id",
        source_system="'lms'",
        source_organization_key="_id",
        name="name",
        organization_type="'school'",
        region="location",
        **snake_times(schools),
    )


# Role word -> person type, in order of precedence.
PERSON_TYPES = {"student": "LEARNER", "teacher": "TEACHER", "staff": "STAFF"}


def person_type(role: str) -> str:
    """LEARNER, TEACHER or STAFF by precedence, else UNKNOWN.

    The role is a JSON list, of which any entry counts, or a plain word. A
    plain word is no JSON and so never matches as a list. The list is parsed
    once, whatever number of words it is compared with.
    """
    as_list = " ".join(
        f"when contains(listed, '\"{word}\"') then '{kind}'" for word, kind in PERSON_TYPES.items()
    )
    as_word = " ".join(
        f"when {role} = '{word}' then '{kind}'" for word, kind in PERSON_TYPES.items()
    )
    cases = f"case {as_list} {as_word} else 'UNKNOWN' end"
    return f"transform(array(to_json(try_parse_json({role}))), listed -> {cases})[0]"


@model("lms_users")
def dim_person(users: DataFrame) -> DataFrame:
    return conform(
        users,
        SILVER["dim_person"],
        person_id="_id",
        source_system="'lms'",
        source_person_key="_id",
        external_user_id="_id",
        person_type=person_type(json_text(users, "role")),
        full_name="concat(coalesce(first_name, ''), ' ', coalesce(last_name, ''))",
        given_name="first_name",
        family_name="last_name",
        home_organization_id="school",
        grade_level="grade",
        **snake_times(users),
    )


@model("lms_enrollments")
def dim_academic_term(enrollments: DataFrame) -> DataFrame:
    """One default term per enrolment year. Both times come from the creation time."""
    years = (
        enrollments.filter("year is not null")
        .selectExpr("cast(year as string) as year", f"{utc(enrollments, 'created_on')} as ts")
        .groupBy("year")
        .agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    )
    return conform(
        years,
        SILVER["dim_academic_term"],
        term_id="year || '_default'",
        source_system="'lms'",
        source_term_key="year || '_default'",
        school_year="year",
        term_type="'default'",
        name="'Default Term ' || year",
        created_at="first",
        updated_at="last",
    )


@model("lms_courses")
def dim_course(courses: DataFrame) -> DataFrame:
    return conform(
        courses,
        SILVER["dim_course"],
        course_id="_id",
        source_system="'lms'",
        source_course_key="_id",
        name="caption",
        subject="try_element_at(disciplines, 1)",
        grade_band="try_element_at(grades, 1)",
        **snake_times(courses),
    )


@model("lms_enrollments")
def dim_section(enrollments: DataFrame) -> DataFrame:
    """One row per teaching group, course and year that enrolments name."""
    keys = ["group", "course", "year"]
    sections = (
        enrollments.dropna(subset=keys)
        .selectExpr("`group`", "course", "year", f"{utc(enrollments, 'created_on')} as ts")
        .groupBy(*keys)
        .agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    )
    return conform(
        sections,
        SILVER["dim_section"],
        section_id=joined_key("`group`", "course", "year"),
        source_system="'lms'",
        source_section_key="`group`",
        course_id="course",
        term_id="cast(year as string) || '_default'",
        code="`group`",
        name="`group`",
        created_at="first",
        updated_at="last",
    )


def _content(df: DataFrame, kind: str) -> DataFrame:
    return conform(
        df,
        SILVER["dim_content"],
        content_id="_id",
        source_system="'lms'",
        source_content_key="_id",
        owner_organization_id="schoolId",
        course_id="courseId",
        section_id="sectionId",
        content_type=f"'{kind}'",
        interaction_type="interactionType",
        title="title",
        description="description",
        difficulty_estimate="difficultyEstimate",
        metadata=json_text(df, "metadata"),
        **camel_times(df),
    )


@model("lms_pages", "lms_blocks", "lms_lessons")
def dim_content(pages: DataFrame, blocks: DataFrame, lessons: DataFrame) -> DataFrame:
    return (
        _content(pages, "page")
        .unionByName(_content(blocks, "block"))
        .unionByName(_content(lessons, "lesson"))
    )


def _assessment(df: DataFrame, **own: str) -> DataFrame:
    return conform(
        df,
        SILVER["dim_assessment"],
        assessment_id="_id",
        source_system="'lms'",
        source_assessment_key="_id",
        organization_id="schoolId",
        course_id="courseId",
        section_id="sectionId",
        term_id="termId",
        title="title",
        description="description",
        max_score="maxScore",
        passing_score="passingScore",
        metadata=json_text(df, "metadata"),
        **camel_times(df),
        **own,
    )


@model("lms_assessment_profiles", "lms_exercises")
def dim_assessment(profiles: DataFrame, exercises: DataFrame) -> DataFrame:
    """Profiles, and the exercises that carry a score; an exercise is its own content."""
    from_profiles = _assessment(
        profiles,
        content_id="contentId",
        assessment_type="assessmentType",
        grading_scheme="gradingScheme",
    )
    from_exercises = _assessment(
        exercises.filter("maxScore is not null"),
        content_id="_id",
        assessment_type="'exercise'",
    )
    return from_profiles.unionByName(from_exercises)


def exercise_items(exercises: DataFrame, fields: dict[str, str], *keep: str) -> DataFrame:
    """One row per item: exercise id, kept expressions, position from 0, item id, item fields."""
    items = explode_records(
        exercises, "items", fields, keep=["_id as exercise_id", *keep], position="position"
    )
    return items.selectExpr("*", f"{joined_key('exercise_id', 'position')} as item_id")


@model("lms_exercises")
def dim_assessment_item(exercises: DataFrame) -> DataFrame:
    fields = {
        "contentId": "string",
        "type": "string",
        "interactionType": "string",
        "prompt": "string",
        "difficulty": "double",
        "maxScore": "double",
        "metadata": "string",
    }
    times = camel_times(exercises)
    items = exercise_items(exercises, fields, *[f"{e} as {name}" for name, e in times.items()])
    return conform(
        items,
        SILVER["dim_assessment_item"],
        item_id="item_id",
        source_system="'lms'",
        source_item_key="item_id",
        assessment_id="exercise_id",
        content_id="contentId",
        item_type="type",
        interaction_type="interactionType",
        prompt_summary="substring(prompt, 1, 200)",
        difficulty_estimate="difficulty",
        max_score="maxScore",
        metadata="metadata",
        **{name: name for name in times},
    )


@model("lms_rules")
def dim_skill(rules: DataFrame) -> DataFrame:
    return conform(
        rules.filter("type = 'skill'"),
        SILVER["dim_skill"],
        skill_id="_id",
        external_skill_code="externalCode",
        name="name",
        description="description",
        domain="domain",
        strand="strand",
        level="level",
        parent_skill_id="parentSkillId",
        metadata=json_text(rules, "metadata"),
        **camel_times(rules),
    )


@model("lms_rules")
def dim_standard(rules: DataFrame) -> DataFrame:
    return conform(
        rules.filter("type = 'standard'"),
        SILVER["dim_standard"],
        standard_id="_id",
        framework="framework",
        external_code="externalCode",
        name="name",
        description="description",
        grade_band="gradeBand",
        subject="subject",
        parent_standard_id="parentStandardId",
        metadata=json_text(rules, "metadata"),
        **camel_times(rules),
    )


@model("stg_lrs_events")
def dim_session(events: DataFrame) -> DataFrame:
    """One row per session and the setting it was seen in."""
    keys = ["sessionId", "userId", "schoolId", "courseId", "sectionId", "platformId"]
    seen = events.filter("sessionId is not null")
    sessions = seen.groupBy(F.struct(*keys).alias("session")).agg(
        F.min("event_timestamp").alias("first"),
        F.max("event_timestamp").alias("last"),
        F.sum("durationSeconds").alias("seconds"),
    )
    return conform(
        with_last_metadata(sessions, seen, keys),
        SILVER["dim_session"],
        session_id="sessionId",
        source_system="'xapi'",
        source_session_key="sessionId",
        learner_id="userId",
        organization_id="schoolId",
        course_id="courseId",
        section_id="sectionId",
        platform_id="platformId",
        session_start="first",
        session_end="last",
        session_duration_seconds="seconds",
        metadata="metadata",
    )


def _seen(events: DataFrame, key: str, *others: str) -> DataFrame:
    """The distinct settings in which a tool or platform was seen."""
    return events.filter(f"{key} is not null").select(key, *others).distinct()


@model("stg_lrs_events")
def dim_platform(events: DataFrame) -> DataFrame:
    return conform(
        _seen(events, "platformId", "metadata"),
        SILVER["dim_platform"],
        platform_id="platformId",
        metadata="metadata",
    )


@model("stg_lrs_events")
def dim_lti_tool(events: DataFrame) -> DataFrame:
    return conform(
        _seen(events, "ltiToolId", "platformId", "metadata"),
        SILVER["dim_lti_tool"],
        lti_tool_id="ltiToolId",
        platform_id="platformId",
        metadata="metadata",
    )


@model("stg_lrs_events")
def dim_ai_tool(events: DataFrame) -> DataFrame:
    return conform(
        _seen(events, "aiToolId", "metadata"),
        SILVER["dim_ai_tool"],
        ai_tool_id="aiToolId",
        metadata="metadata",
    )


@model("stg_lrs_events")
def dim_device(events: DataFrame) -> DataFrame:
    """Typed and empty: statements carry no device."""
    return conform(events, SILVER["dim_device"], metadata="metadata").limit(0)
