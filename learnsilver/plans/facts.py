"""Facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnsilver.functions.columns import conform, joined_key, utc, utc_from_text, with_last_metadata
from learnsilver.functions.jsonx import explode_records, json_text
from learnsilver.functions.timeids import date_id, micros_text, time_of_day_id
from learnsilver.plans.registry import model
from learnsilver.schemas import SILVER

# Columns that facts on statements take over from staging, under their own name.
_SETTING = {
    "session_id": "sessionId",
    "organization_id": "schoolId",
    "course_id": "courseId",
    "section_id": "sectionId",
}
_WHAT = {"content_id": "contentId", "skill_id": "skillId"}


@model("stg_lrs_events")
def fact_learning_event(events: DataFrame) -> DataFrame:
    """One row per statement. A verb id that is no number, such as an IRI, is NULL."""
    ts = "event_timestamp"
    return conform(
        events,
        SILVER["fact_learning_event"],
        event_id="event_id",
        source_system="'xapi'",
        source_event_key="event_id",
        event_timestamp_utc=ts,
        date_id=date_id(ts),
        time_of_day_id=time_of_day_id(ts),
        timezone="timezone",
        event_type_key="eventType",
        # The pattern first: a failing cast is slow, and verb ids are mostly IRIs.
        verb_id="if(verbId rlike '^[+-]?[0-9]+$', try_cast(verbId as int), null)",
        verb_raw="verbIri",
        person_id="userId",
        actor_type="actorType",
        impersonated_person_id="impersonatedUserId",
        platform_id="platformId",
        lti_tool_id="ltiToolId",
        ai_tool_id="aiToolId",
        device_id="deviceId",
        term_id="termId",
        membership_id="membershipId",
        object_type_key="objectType",
        object_id="objectId",
        target_type_key="targetType",
        target_id="targetId",
        generated_type_key="generatedType",
        generated_id="generatedId",
        assessment_id="assessmentId",
        item_id="itemId",
        standard_id="standardId",
        attempt_number="attemptNumber",
        success="success",
        completion="completion",
        is_correct="isCorrect",
        score_raw="scoreRaw",
        score_min="scoreMin",
        score_max="scoreMax",
        score_scaled="scoreScaled",
        score_percent="scorePercent",
        response="response",
        duration_seconds="durationSeconds",
        latency_ms="latencyMs",
        event_source="eventSource",
        metadata="metadata",
        **_SETTING,
        **_WHAT,
    )


@model("lms_exercise_submissions")
def fact_assessment_attempt(submissions: DataFrame) -> DataFrame:
    """One row per submission; an exercise is both the assessment and its content."""
    return conform(
        submissions,
        SILVER["fact_assessment_attempt"],
        assessment_attempt_id="_id",
        source_system="'lms'",
        source_attempt_key="_id",
        attempt_start=utc(submissions, "startedAt"),
        attempt_end=utc(submissions, "submittedAt"),
        learner_id="userId",
        assessment_id="exerciseId",
        content_id="exerciseId",
        score_raw="scoreRaw",
        score_scaled="scoreScaled",
        score_percent="scorePercent",
        passed="passed",
        attempt_number="attemptNumber",
        item_count="itemCount",
        completed_item_count="completedItemCount",
        metadata=json_text(submissions, "metadata"),
        **_SETTING,
    )


# Columns an answer takes from its submission, and how they are called there.
_FROM_SUBMISSION = {
    "assessment_attempt_id": "_id",
    "person_id": "userId",
    "term_id": "termId",
    "assessment_id": "exerciseId",
    "attempt_number": "attemptNumber",
    **_SETTING,
}


# Fields of an answer and their types.
_ANSWER = {
    "itemId": "string",
    "itemContentId": "string",
    "itemSkillId": "string",
    "itemPosition": "int",
    "response": "string",
    "isCorrect": "boolean",
    "itemScore": "double",
    "itemScoreScaled": "double",
    "latencyMs": "int",
    "hintsUsed": "int",
    "responseTime": "string",
}


@model("lms_exercise_submissions")
def fact_item_response(submissions: DataFrame) -> DataFrame:
    """One row per answered item of a submission; the item's own fields win over its parent's."""
    answers = explode_records(
        submissions,
        "itemResponses",
        _ANSWER,
        keep=[
            *[f"{source} as {name}" for name, source in _FROM_SUBMISSION.items()],
            f"{json_text(submissions, 'metadata')} as metadata",
            f"{json_text(submissions, 'sourcePayload')} as source_payload",
        ],
    ).selectExpr("*", f"{utc_from_text('responseTime')} as ts")
    key = joined_key("assessment_attempt_id", "itemId")
    return conform(
        answers,
        SILVER["fact_item_response"],
        item_response_id=key,
        source_system="'lms'",
        source_response_key=key,
        response_timestamp_utc="ts",
        date_id=date_id("ts"),
        time_of_day_id=time_of_day_id("ts"),
        item_id="itemId",
        content_id="itemContentId",
        skill_id="itemSkillId",
        item_position="itemPosition",
        response="response",
        is_correct="isCorrect",
        score_raw="itemScore",
        score_scaled="itemScoreScaled",
        latency_ms="latencyMs",
        hints_used="hintsUsed",
        metadata="metadata",
        source_payload="source_payload",
        **{name: name for name in _FROM_SUBMISSION},
    )


@model("stg_lrs_events")
def fact_session_summary(events: DataFrame) -> DataFrame:
    """Totals per session and setting.

    Counted in two steps, per session and content, then per session: the
    second step counts contents without a distinct, each event is read once,
    and a session with very many events is spread over its contents.
    """
    keys = ["sessionId", "userId", "schoolId", "courseId", "sectionId"]
    seen = events.filter("sessionId is not null")
    per_content = seen.groupBy(F.struct(*keys).alias("session"), "contentId").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("durationSeconds").alias("seconds"),
        F.expr("coalesce(max(isCorrect), false)").alias("mastered"),
        F.count("aiToolId").alias("ai_events"),
    )
    sessions = per_content.groupBy("session").agg(
        F.sum("events").alias("events"),
        F.sum("seconds").alias("seconds"),
        F.count("contentId").alias("contents"),
        F.expr("count_if(mastered and contentId is not null)").alias("mastered"),
        F.sum("ai_events").alias("ai_events"),
    )
    return conform(
        with_last_metadata(sessions, seen, keys),
        SILVER["fact_session_summary"],
        session_summary_id="sessionId",
        learner_id="userId",
        total_events="events",
        active_seconds="seconds",
        items_attempted="contents",
        items_mastered="mastered",
        hints_requested="0",
        ai_interactions="ai_events",
        signals_generated="0",
        metadata="metadata",
        **_SETTING,
    )


@model("stg_lrs_events")
def fact_ai_interaction(events: DataFrame) -> DataFrame:
    return conform(
        events.filter("aiToolId is not null"),
        SILVER["fact_ai_interaction"],
        ai_interaction_id="event_id",
        interaction_timestamp="event_timestamp",
        learner_id="userId",
        ai_tool_id="aiToolId",
        latency_ms="latencyMs",
        metadata="metadata",
        **_SETTING,
        **_WHAT,
    )


@model("stg_lrs_events")
def fact_launch(events: DataFrame) -> DataFrame:
    """Launches of LTI tools; without a session there is no id."""
    ts = "event_timestamp"
    return conform(
        events.filter("ltiToolId is not null"),
        SILVER["fact_launch"],
        launch_id=joined_key("sessionId", micros_text(ts)),
        source_system="'xapi'",
        launch_timestamp_utc=ts,
        date_id=date_id(ts),
        time_of_day_id=time_of_day_id(ts),
        platform_id="platformId",
        lti_tool_id="ltiToolId",
        person_id="userId",
        launch_type="'lti'",
        metadata="metadata",
        source_payload="fullStatement",
        **_SETTING,
    )


@model("stg_lrs_events")
def fact_learning_signal(events: DataFrame) -> DataFrame:
    """Typed and empty: statements carry no computed signal."""
    return conform(
        events,
        SILVER["fact_learning_signal"],
        learning_signal_id="event_id",
        signal_timestamp="event_timestamp",
        learner_id="userId",
        metadata="metadata",
        **_SETTING,
        **_WHAT,
    ).limit(0)


@model("stg_lrs_events")
def fact_variant_exposure(events: DataFrame) -> DataFrame:
    """Typed and empty: statements carry no experiment."""
    return conform(
        events,
        SILVER["fact_variant_exposure"],
        variant_exposure_id="event_id",
        exposure_timestamp="event_timestamp",
        learner_id="userId",
        metadata="metadata",
        **_SETTING,
        **_WHAT,
    ).limit(0)
