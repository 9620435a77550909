"""Bridges between dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnsilver.functions.columns import cases, conform, joined_key
from learnsilver.functions.jsonx import explode_records, json_text
from learnsilver.plans.dims import exercise_items, snake_times
from learnsilver.plans.refs import ROLE_NAMES
from learnsilver.plans.registry import model
from learnsilver.schemas import SILVER

# Fixed value: the role words a membership tells apart; all others are learners.
# The role is compared as written, so a list of roles is a learner.
_MEMBER_ROLES = {word: ROLE_NAMES[word] for word in ("student", "teacher", "staff")}


def _with_role(members: DataFrame, users: DataFrame) -> DataFrame:
    """Members with the role of their user as ``role_key``.

    Only key and role of the users take part, once each. The join carries no
    hint: Spark broadcasts the users when their measured size allows, and
    else splits the partitions of students with very many rows (AQE skew join).
    """
    roles = users.selectExpr("_id as student", f"{json_text(users, 'role')} as role").distinct()
    return members.join(roles, "student", "left").selectExpr(
        "* except (role)", f"{cases('role', _MEMBER_ROLES, 'Learner')} as role_key"
    )


@model("lms_enrollments", "lms_users")
def bridge_section_membership(enrollments: DataFrame, users: DataFrame) -> DataFrame:
    members = enrollments.filter("`group` is not null and student is not null").selectExpr(
        "_id",
        "`group`",
        "student",
        "status",
        *[f"{expr} as {name}" for name, expr in snake_times(enrollments).items()],
    )
    return conform(
        _with_role(members, users),
        SILVER["bridge_section_membership"],
        section_membership_id="_id",
        source_system="'lms'",
        source_membership_key="_id",
        section_id="`group`",
        person_id="student",
        role_key="role_key",
        status="status",
        created_at="created_at",
        updated_at="updated_at",
    )


@model("lms_enrollments", "lms_users")
def bridge_course_membership(enrollments: DataFrame, users: DataFrame) -> DataFrame:
    """One row per course, student and role.

    The role hangs on the student alone, so enrolments are aggregated before
    the join: repeats of a course and student are reduced on the map side and
    never meet the join.
    """
    members = (
        enrollments.filter("course is not null and student is not null")
        .selectExpr(
            "course",
            "student",
            "status",
            *[f"{expr} as {name}" for name, expr in snake_times(enrollments).items()],
        )
        .groupBy("course", "student")
        .agg(
            F.max("status").alias("status"),
            F.min("created_at").alias("created_at"),
            F.max("updated_at").alias("updated_at"),
        )
    )
    return conform(
        _with_role(members, users),
        SILVER["bridge_course_membership"],
        course_membership_id=joined_key("course", "student"),
        source_system="'lms'",
        source_membership_key=joined_key("course", "student"),
        course_id="course",
        person_id="student",
        role_key="role_key",
        status="status",
        created_at="created_at",
        updated_at="updated_at",
    )


def _skill_fields(df: DataFrame) -> DataFrame:
    """Skill id and weight of a skill entry: a record, or a plain text that is the id itself."""
    record = "from_json(entry, 'struct<skillId:string,skillWeight:string>')"
    return df.selectExpr("*", f"if(startswith(entry, '{{'), {record}, null) as record").selectExpr(
        "* except (entry, record)",
        "if(startswith(entry, '{'), record.skillId, entry) as skill_id",
        "try_cast(record.skillWeight as double) as weight",
        "record.skillWeight as weight_text",
    )


def _content_skills(df: DataFrame) -> DataFrame:
    metadata = json_text(df, "metadata")
    entries = df.selectExpr(
        "_id as content_id",
        f"explode(from_json({metadata}, 'struct<skills:array<string>>').skills) as entry",
    )
    return _skill_fields(entries).filter("skill_id is not null")


def rejected_skill_weights(*tables: DataFrame) -> DataFrame:
    """(content_id, skill_id, weight) of weights that are no numbers; they count as 1."""
    skills = reduce(DataFrame.unionByName, map(_content_skills, tables))
    return skills.filter("weight is null and weight_text is not null").selectExpr(
        "content_id", "skill_id", "weight_text as weight"
    )


@model("lms_pages", "lms_blocks", "lms_lessons", stamped=True)
def bridge_content_skill_map(
    pages: DataFrame, blocks: DataFrame, lessons: DataFrame, run_ts: str
) -> DataFrame:
    skills = reduce(DataFrame.unionByName, map(_content_skills, (pages, blocks, lessons)))
    return conform(
        skills,
        SILVER["bridge_content_skill_map"],
        content_skill_map_id=joined_key("content_id", "skill_id"),
        content_id="content_id",
        skill_id="skill_id",
        weight="coalesce(weight, 1.0D)",
        source="'authoring'",
        created_at=run_ts,
        updated_at=run_ts,
    )


@model("lms_exercises", stamped=True)
def bridge_item_skill_map(exercises: DataFrame, run_ts: str) -> DataFrame:
    entries = exercise_items(exercises, {"skills": "string"}).selectExpr(
        "item_id", "explode(from_json(skills, 'array<string>')) as entry"
    )
    return conform(
        _skill_fields(entries).filter("skill_id is not null"),
        SILVER["bridge_item_skill_map"],
        item_skill_map_id=joined_key("item_id", "skill_id"),
        item_id="item_id",
        skill_id="skill_id",
        weight="1.0D",
        source="'authoring'",
        created_at=run_ts,
        updated_at=run_ts,
    )


@model("lms_rules", stamped=True)
def bridge_skill_standard_map(rules: DataFrame, run_ts: str) -> DataFrame:
    """Mappings of skill rules; skill, standard, weight and source are those of the mapping."""
    mappings = (
        rules.filter("type = 'skill'")
        .selectExpr(
            f"from_json({json_text(rules, 'metadata')}, 'struct<standardMappings:array<struct<"
            "skillId:string,standardId:string,weight:string,source:string>>>') as metadata"
        )
        .selectExpr("inline(metadata.standardMappings)")
        .dropna(subset=["skillId", "standardId"])
    )
    return conform(
        mappings,
        SILVER["bridge_skill_standard_map"],
        skill_standard_map_id=joined_key("skillId", "standardId"),
        skill_id="skillId",
        standard_id="standardId",
        weight="coalesce(try_cast(weight as double), 1.0D)",
        source="coalesce(source, 'manual')",
        created_at=run_ts,
        updated_at=run_ts,
    )


@model("lms_assessment_profiles", "lms_exercise_submissions", stamped=True)
def bridge_assessment_item_map(
    profiles: DataFrame, submissions: DataFrame, run_ts: str
) -> DataFrame:
    """Items of profiles, and items that submissions name.

    Position and points are each the smallest seen, so repeats need no
    distinct before the grouping.
    """
    listed = explode_records(
        profiles,
        "items",
        {"itemId": "string", "position": "int", "points": "double"},
        keep=["_id as assessment_id"],
    )
    named = submissions.filter("itemId is not null").selectExpr(
        "exerciseId as assessment_id",
        "itemId",
        "cast(itemPosition as int) as position",
        "cast(itemPoints as double) as points",
    )
    items = (
        listed.unionByName(named)
        .groupBy("assessment_id", "itemId")
        .agg(F.min("position").alias("position"), F.min("points").alias("points"))
    )
    return conform(
        items,
        SILVER["bridge_assessment_item_map"],
        assessment_item_map_id=joined_key("assessment_id", "itemId"),
        assessment_id="assessment_id",
        item_id="itemId",
        position="position",
        points="points",
        created_at=run_ts,
        updated_at=run_ts,
    )
