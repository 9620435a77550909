"""Reference vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame

from learnsilver.functions.columns import cases, conform
from learnsilver.functions.jsonx import json_text, key_path, scalar, value_at
from learnsilver.plans.registry import model
from learnsilver.schemas import SILVER

# Role word -> name of the role.
ROLE_NAMES = {
    "student": "Learner",
    "teacher": "Instructor",
    "staff": "TeachingAssistant",
    "admin": "Administrator",
    "observer": "Observer",
    "proctor": "Proctor",
}


@model("stg_lrs_events")
def ref_event_type(events: DataFrame) -> DataFrame:
    found = (
        events.filter("eventType is not null").select("eventType", "verbDescription").distinct()
    )
    return conform(
        found,
        SILVER["ref_event_type"],
        event_type_key="eventType",
        description="verbDescription",
    )


@model("lrs_statements")
def ref_verb(statements: DataFrame) -> DataFrame:
    """Verbs by IRI; the IRI also serves as the key."""
    parsed = statements.selectExpr(f"{json_text(statements, 'verb')} as verb").selectExpr(
        "verb", "from_json(verb, 'struct<id:string,display:struct<`en-US`:string>>') as parsed"
    )
    name = key_path("display", "en-US")
    found = (
        parsed.selectExpr(
            f"{scalar('parsed.id', value_at('verb', '$.id'))} as iri",
            f"{scalar('parsed.display.`en-US`', value_at('verb', name))} as description",
        )
        .filter("iri is not null")
        .distinct()
    )
    return conform(found, SILVER["ref_verb"], verb_id="iri", iri="iri", description="description")


@model("stg_lrs_events")
def ref_object_type(events: DataFrame) -> DataFrame:
    found = events.filter("objectType is not null").select("objectType").distinct()
    return conform(
        found,
        SILVER["ref_object_type"],
        object_type_key="objectType",
        description="objectType",
    )


@model("lms_users")
def ref_membership_role(users: DataFrame) -> DataFrame:
    """Every role as written on a user, with the name of the known ones."""
    found = (
        users.selectExpr(f"{json_text(users, 'role')} as role").filter("role is not null").distinct()
    )
    return conform(
        found,
        SILVER["ref_membership_role"],
        role_key="role",
        description=cases("role", ROLE_NAMES, "Unknown"),
    )


@model("stg_lrs_events")
def ref_signal_type(events: DataFrame) -> DataFrame:
    """Typed and empty: statements carry no signal."""
    return conform(events, SILVER["ref_signal_type"]).limit(0)
