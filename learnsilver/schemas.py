"""Table contracts: columns, types, keys, references and descriptions.

Columns are written as Spark DDL; names, order and types are fixed values. Silver contracts list the output
columns in order; raw contracts list the columns the models read, and a raw
table that lacks one of them gets it as a typed NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

Columns = tuple[tuple[str, str], ...]


def _columns(ddl: str) -> Columns:
    """The columns of a DDL string, in order; none of the types here has a comma."""
    return tuple(tuple(column.split(maxsplit=1)) for column in " ".join(ddl.split()).split(","))


@dataclass(frozen=True)
class Contract:
    name: str
    key: str
    columns: Columns
    description: str
    required: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{name}` {dtype}" for name, dtype in self.columns)


# ---------------------------------------------------------------------------
# Raw layer
# ---------------------------------------------------------------------------

# The collections loaded by default, under their source spelling.
DEFAULT_COLLECTIONS = (
    "users",
    "schools",
    "courses",
    "modules",
    "lessons",
    "pages",
    "blocks",
    "exercises",
    "submissions",
    "enrollments",
    "projects",
    "project-enrollments",
    "surveys",
    "survey-enrollments",
    "survey-submissions",
    "assessment-profiles",
    "rules",
)

STATEMENTS_TABLE = "lrs_statements"
STATEMENTS_ALIAS = "xapi_statements"

_SNAKE_TIMES = "created_on timestamp_ntz, modified_on timestamp_ntz"
_CAMEL_TIMES = "createdAt timestamp_ntz, updatedAt timestamp_ntz"
_CONTENT = f"""
    _id string, schoolId string, courseId string, sectionId string, interactionType string,
    title string, description string, difficultyEstimate double, metadata string, {_CAMEL_TIMES}
"""
_RAW = {
    "lms_users": (
        f"""
        _id string, role string, first_name string, last_name string, school string, grade string,
        {_SNAKE_TIMES}
        """,
        "People known to the learning platform, with their role or list of roles",
    ),
    "lms_schools": (
        f"""
        _id string, name string, location string, {_SNAKE_TIMES}
        """,
        "Schools taking part",
    ),
    "lms_courses": (
        f"""
        _id string, caption string, disciplines array<string>, grades array<string>,
        {_SNAKE_TIMES}
        """,
        "Course catalogue",
    ),
    "lms_enrollments": (
        f"""
        _id string, student string, course string, group string, year int, status string,
        {_SNAKE_TIMES}
        """,
        "Which student attends which course, in which group and year",
    ),
    "lms_pages": (_CONTENT, "Content pages"),
    "lms_blocks": (_CONTENT, "Content blocks"),
    "lms_lessons": (_CONTENT, "Lessons"),
    "lms_exercises": (
        f"""
        _id string, schoolId string, courseId string, sectionId string, termId string,
        title string, description string, maxScore double, passingScore double, metadata string,
        items string, {_CAMEL_TIMES}
        """,
        "Exercises and their items",
    ),
    "lms_assessment_profiles": (
        f"""
        _id string, schoolId string, courseId string, sectionId string, termId string,
        contentId string, title string, description string, assessmentType string,
        gradingScheme string, maxScore double, passingScore double, metadata string, items string,
        {_CAMEL_TIMES}
        """,
        "Assessment definitions and the items they are made of",
    ),
    "lms_exercise_submissions": (
        """
        _id string, userId string, sessionId string, schoolId string, termId string,
        courseId string, sectionId string, exerciseId string, startedAt timestamp_ntz,
        submittedAt timestamp_ntz, scoreRaw double, scoreScaled double, scorePercent double,
        passed boolean, attemptNumber int, itemCount int, completedItemCount int, metadata string,
        sourcePayload string, itemId string, itemPosition int, itemPoints double,
        itemResponses string
        """,
        "Handed-in attempts with one entry per answered item",
    ),
    "lms_rules": (
        f"""
        _id string, type string, externalCode string, name string, description string,
        domain string, strand string, level string, parentSkillId string, framework string,
        gradeBand string, subject string, parentStandardId string, metadata string, {_CAMEL_TIMES}
        """,
        "Skill and standard definitions",
    ),
    "lms_modules": (
        f"""
        _id string, schoolId string, courseId string, title string, description string, order int,
        metadata string, {_CAMEL_TIMES}
        """,
        "Course modules; loaded, read by no model",
    ),
    "lms_projects": (
        f"""
        _id string, schoolId string, courseId string, title string, description string,
        metadata string, {_CAMEL_TIMES}
        """,
        "Projects; loaded, read by no model",
    ),
    "lms_project_enrollments": (
        f"""
        _id string, userId string, projectId string, status string, metadata string,
        {_CAMEL_TIMES}
        """,
        "Project members; loaded, read by no model",
    ),
    "lms_surveys": (
        f"""
        _id string, schoolId string, title string, description string, metadata string,
        {_CAMEL_TIMES}
        """,
        "Surveys; loaded, read by no model",
    ),
    "lms_survey_enrollments": (
        f"""
        _id string, userId string, surveyId string, status string, metadata string, {_CAMEL_TIMES}
        """,
        "Survey members; loaded, read by no model",
    ),
    "lms_survey_submissions": (
        f"""
        _id string, userId string, surveyId string, responses string, metadata string,
        submittedAt timestamp_ntz, createdAt timestamp_ntz, updatedAt timestamp_ntz
        """,
        "Survey answers; loaded, read by no model",
    ),
    STATEMENTS_TABLE: (
        """
        id string, timestamp timestamp_ntz, stored timestamp_ntz, actor string, verb string,
        object string, result string, context string, authority string, version string,
        attachments string
        """,
        "xAPI statements as received, JSON parts kept as text",
    ),
}

RAW = {
    name: Contract(
        name=name,
        key="id" if name == STATEMENTS_TABLE else "_id",
        columns=_columns(text),
        description=description,
    )
    for name, (text, description) in _RAW.items()
}

# ---------------------------------------------------------------------------
# Staging
# ---------------------------------------------------------------------------

STAGING = {
    "stg_lrs_events": Contract(
        name="stg_lrs_events",
        key="event_id",
        columns=_columns(
            """
            event_id string, event_timestamp timestamp_ntz, userId string, verbId string,
            verbIri string, verbShortCode string, verbDescription string, objectId string,
            objectType string, sessionId string, schoolId string, courseId string,
            sectionId string, assessmentId string, skillId string, platformId string,
            ltiToolId string, aiToolId string, deviceId string, deviceType string, os string,
            browser string, userAgent string, termId string, membershipId string,
            targetType string, targetId string, generatedType string, generatedId string,
            contentId string, itemId string, standardId string, attemptNumber int,
            success boolean, completion boolean, isCorrect boolean, scoreRaw double,
            scoreMin double, scoreMax double, scoreScaled double, scorePercent double,
            response string, durationSeconds int, latencyMs int, eventType string,
            eventSource string, timezone string, actorType string, impersonatedUserId string,
            toolName string, provider string, modelName string, capabilityType string,
            platformName string, vendor string, version string, environment string,
            launchType string, ltiLaunchId string, variantId string, experimentId string,
            signalType string, signalValue string, metadata string, fullStatement string
            """
        ),
        description="One row per statement, flattened",
    )
}

# ---------------------------------------------------------------------------
# Silver
# ---------------------------------------------------------------------------

_RECORD_TIMES = "created_at timestamp_ntz, updated_at timestamp_ntz"
_MEMBERSHIP = f"""
    role_key string, begin_date date, end_date date, status string, metadata string,
    {_RECORD_TIMES}
"""
_MAP_TAIL = f"""
    weight double, source string, metadata string, {_RECORD_TIMES}
"""

# name -> (columns, description, required columns, unique column lists); the
# first column is the key.
_SILVER: dict[str, tuple] = {
    "dim_date": (
        """
        date_id int, date date, year int, month int, day int, quarter int, week_of_year int,
        day_of_week int, day_name string, is_weekend boolean, is_holiday boolean,
        holiday_name string
        """,
        "Calendar days on which something happened",
        "date year month day quarter week_of_year day_of_week day_name is_weekend is_holiday",
        ("date",),
    ),
    "dim_time_of_day": (
        """
        time_of_day_id int, hour int, minute int, second int, label string
        """,
        "Seconds of the day at which something happened",
        "hour minute second label",
        ("hour minute second",),
    ),
    "dim_organization": (
        f"""
        organization_id string, source_system string, source_organization_key string, name string,
        organization_type string, parent_organization_id string, country_code string,
        region string, timezone string, external_ref_uri string, metadata string, {_RECORD_TIMES}
        """,
        "Schools and other organisations",
        "name",
    ),
    "dim_person": (
        f"""
        person_id string, source_system string, source_person_key string, external_user_id string,
        person_type string, full_name string, given_name string, family_name string,
        primary_language string, secondary_language string, birth_date date,
        home_organization_id string, grade_level string, employment_type string,
        demographics string, enrollment_status string, metadata string, {_RECORD_TIMES}
        """,
        "Learners, teachers and staff in one dimension",
        "person_type",
    ),
    "dim_academic_term": (
        f"""
        term_id string, source_system string, source_term_key string, organization_id string,
        school_year string, term_type string, name string, start_date date, end_date date,
        metadata string, {_RECORD_TIMES}
        """,
        "Terms, one default term per enrolment year",
    ),
    "dim_course": (
        f"""
        course_id string, source_system string, source_course_key string, organization_id string,
        code string, name string, subject string, grade_band string, academic_year string,
        metadata string, {_RECORD_TIMES}
        """,
        "Courses",
        "name",
    ),
    "dim_section": (
        f"""
        section_id string, source_system string, source_section_key string,
        organization_id string, course_id string, term_id string, code string, name string,
        start_date date, end_date date, delivery_mode string, metadata string, {_RECORD_TIMES}
        """,
        "Teaching groups of a course in a year",
    ),
    "dim_content": (
        f"""
        content_id string, source_system string, source_content_key string,
        owner_organization_id string, course_id string, section_id string, content_type string,
        interaction_type string, title string, description string, difficulty_estimate double,
        metadata string, {_RECORD_TIMES}
        """,
        "Pages, blocks and lessons",
    ),
    "dim_assessment": (
        f"""
        assessment_id string, source_system string, source_assessment_key string,
        organization_id string, course_id string, section_id string, term_id string,
        content_id string, title string, description string, assessment_type string,
        max_score double, passing_score double, grading_scheme string, metadata string,
        {_RECORD_TIMES}
        """,
        "Assessment profiles and scored exercises",
    ),
    "dim_assessment_item": (
        f"""
        item_id string, source_system string, source_item_key string, assessment_id string,
        content_id string, item_type string, interaction_type string, prompt_summary string,
        difficulty_estimate double, max_score double, metadata string, {_RECORD_TIMES}
        """,
        "Items of exercises, numbered within the exercise",
    ),
    "dim_skill": (
        f"""
        skill_id string, external_skill_code string, name string, description string,
        domain string, strand string, level string, parent_skill_id string, metadata string,
        {_RECORD_TIMES}
        """,
        "Skills",
        "name",
    ),
    "dim_standard": (
        f"""
        standard_id string, framework string, external_code string, name string,
        description string, grade_band string, subject string, parent_standard_id string,
        metadata string, {_RECORD_TIMES}
        """,
        "Curriculum standards",
    ),
    "dim_session": (
        """
        session_id string, source_system string, source_session_key string, learner_id string,
        organization_id string, course_id string, section_id string, platform_id string,
        device_type string, user_agent string, ip_hash string, session_start timestamp_ntz,
        session_end timestamp_ntz, session_duration_seconds bigint, metadata string
        """,
        "Learning sessions seen in the statements",
    ),
    "dim_platform": (
        "platform_id string, name string, vendor string, version string, environment string, metadata string",
        "Platforms seen in the statements",
        "name",
    ),
    "dim_lti_tool": (
        "lti_tool_id string, platform_id string, issuer string, client_id string, name string, deployment_id string, metadata string",
        "LTI tools seen in the statements",
    ),
    "dim_ai_tool": (
        "ai_tool_id string, name string, provider string, model_name string, capability_type string, metadata string",
        "AI tools seen in the statements",
        "name",
    ),
    "dim_device": (
        "device_id string, device_type string, os string, browser string, user_agent string, metadata string",
        "Devices; statements carry none, so the table is typed and empty",
    ),
    "ref_event_type": (
        "event_type_key string, description string",
        "Event types in use",
    ),
    "ref_verb": (
        "verb_id string, iri string, short_code string, description string",
        "Verbs in use",
        "iri",
        ("iri",),
    ),
    "ref_object_type": (
        "object_type_key string, description string",
        "Object types in use",
    ),
    "ref_membership_role": (
        "role_key string, description string",
        "Roles in use and their names",
    ),
    "ref_signal_type": (
        "signal_type_key string, description string, category string",
        "Signal types; statements carry none, so the table is typed and empty",
    ),
    "bridge_section_membership": (
        f"""
        section_membership_id string, source_system string, source_membership_key string,
        section_id string, person_id string, {_MEMBERSHIP}
        """,
        "Members of teaching groups",
        "section_id person_id role_key",
        ("section_id person_id role_key begin_date",),
    ),
    "bridge_course_membership": (
        f"""
        course_membership_id string, source_system string, source_membership_key string,
        course_id string, person_id string, {_MEMBERSHIP}
        """,
        "Members of courses",
        "course_id person_id role_key",
    ),
    "bridge_content_skill_map": (
        f"""
        content_skill_map_id string, content_id string, skill_id string, {_MAP_TAIL}
        """,
        "Skills tagged on content",
        "content_id skill_id",
        ("content_id skill_id",),
    ),
    "bridge_item_skill_map": (
        f"""
        item_skill_map_id string, item_id string, skill_id string, {_MAP_TAIL}
        """,
        "Skills tagged on items",
        "item_id skill_id",
        ("item_id skill_id",),
    ),
    "bridge_skill_standard_map": (
        f"""
        skill_standard_map_id string, skill_id string, standard_id string, {_MAP_TAIL}
        """,
        "Standards a skill answers to",
        "skill_id standard_id",
        ("skill_id standard_id",),
    ),
    "bridge_assessment_item_map": (
        f"""
        assessment_item_map_id string, assessment_id string, item_id string, position int,
        points double, metadata string, {_RECORD_TIMES}
        """,
        "Items of an assessment with position and points",
        "assessment_id item_id",
        ("assessment_id item_id",),
    ),
    "fact_learning_event": (
        """
        event_id string, source_system string, source_event_key string,
        event_timestamp_utc timestamp_ntz, date_id int, time_of_day_id int, timezone string,
        event_type_key string, verb_id int, verb_raw string, person_id string, actor_type string,
        impersonated_person_id string, session_id string, platform_id string, lti_tool_id string,
        ai_tool_id string, device_id string, organization_id string, term_id string,
        course_id string, section_id string, membership_id string, object_type_key string,
        object_id string, target_type_key string, target_id string, generated_type_key string,
        generated_id string, content_id string, assessment_id string, item_id string,
        skill_id string, standard_id string, attempt_number int, success boolean,
        completion boolean, is_correct boolean, score_raw double, score_min double,
        score_max double, score_scaled double, score_percent double, response string,
        duration_seconds int, latency_ms int, event_source string, metadata string
        """,
        "One row per learning event",
        "event_timestamp_utc date_id",
    ),
    "fact_assessment_attempt": (
        """
        assessment_attempt_id string, source_system string, source_attempt_key string,
        time_id int, attempt_start timestamp_ntz, attempt_end timestamp_ntz, learner_id string,
        session_id string, organization_id string, course_id string, section_id string,
        assessment_id string, content_id string, score_raw double, score_scaled double,
        score_percent double, passed boolean, attempt_number int, item_count int,
        completed_item_count int, metadata string
        """,
        "One row per attempt at an assessment",
        "learner_id assessment_id",
    ),
    "fact_item_response": (
        """
        item_response_id string, source_system string, source_response_key string,
        response_timestamp_utc timestamp_ntz, date_id int, time_of_day_id int,
        assessment_attempt_id string, person_id string, session_id string, organization_id string,
        term_id string, course_id string, section_id string, membership_id string,
        assessment_id string, item_id string, content_id string, skill_id string,
        standard_id string, attempt_number int, item_position int, response string,
        is_correct boolean, score_raw double, score_scaled double, latency_ms int, hints_used int,
        metadata string, source_payload string
        """,
        "One row per answered item",
        "response_timestamp_utc date_id assessment_attempt_id person_id item_id",
    ),
    "fact_session_summary": (
        """
        session_summary_id string, session_id string, learner_id string, organization_id string,
        course_id string, section_id string, total_events int, active_seconds int,
        idle_seconds int, items_attempted int, items_mastered int, hints_requested int,
        ai_interactions int, signals_generated int, metadata string
        """,
        "Totals per session",
        "session_id",
    ),
    "fact_ai_interaction": (
        """
        ai_interaction_id string, time_id int, interaction_timestamp timestamp_ntz,
        learner_id string, teacher_id string, session_id string, organization_id string,
        course_id string, section_id string, content_id string, skill_id string,
        ai_tool_id string, interaction_role string, input_tokens bigint, output_tokens bigint,
        latency_ms bigint, feedback_rating double, feedback_label string,
        transcript_snippet string, metadata string
        """,
        "Events in which an AI tool took part",
        "interaction_timestamp ai_tool_id",
    ),
    "fact_launch": (
        """
        launch_id string, source_system string, launch_timestamp_utc timestamp_ntz, date_id int,
        time_of_day_id int, platform_id string, lti_tool_id string, session_id string,
        registration_id string, person_id string, organization_id string, term_id string,
        course_id string, section_id string, membership_id string, launch_type string,
        launch_context string, metadata string, source_payload string
        """,
        "Tool launches",
        "launch_timestamp_utc date_id",
    ),
    "fact_learning_signal": (
        """
        learning_signal_id string, time_id int, signal_timestamp timestamp_ntz,
        signal_type_key string, learner_id string, organization_id string, course_id string,
        section_id string, skill_id string, content_id string, session_id string,
        signal_value double, value_explanation string, window_start timestamp_ntz,
        window_end timestamp_ntz, metadata string
        """,
        "Computed signals; statements carry none, so the table is typed and empty",
        "signal_timestamp signal_type_key learner_id",
    ),
    "fact_variant_exposure": (
        """
        variant_exposure_id string, time_id int, exposure_timestamp timestamp_ntz,
        learner_id string, session_id string, organization_id string, course_id string,
        section_id string, content_id string, skill_id string, experiment_key string,
        variant_key string, is_control boolean, metadata string
        """,
        "Experiment exposures; statements carry none, so the table is typed and empty",
        "exposure_timestamp learner_id experiment_key variant_key",
    ),
}


def _silver(name: str, text: str, description: str, required: str = "", unique=()) -> Contract:
    columns = _columns(text)
    return Contract(
        name=name,
        key=columns[0][0],
        columns=columns,
        description=description,
        required=tuple(required.split()),
        unique=tuple(tuple(keys.split()) for keys in unique),
    )


SILVER = {name: _silver(name, *spec) for name, spec in _SILVER.items()}
MODELS = {**STAGING, **SILVER}
CONTRACTS = {**RAW, **MODELS}

# Accepted values of a column, where the target model names them.
ACCEPTED_VALUES = {("dim_person", "person_type"): ("LEARNER", "TEACHER", "STAFF", "UNKNOWN")}

# A column of this name refers to the key of the table, wherever it stands,
# except in the table whose own key it is.
_REFERENCE_BY_COLUMN = {
    "dim_organization": ("organization_id", "owner_organization_id", "home_organization_id", "parent_organization_id",),
    "dim_person": ("person_id", "learner_id", "teacher_id", "impersonated_person_id",),
    "dim_academic_term": ("term_id",),
    "dim_course": ("course_id",),
    "dim_section": ("section_id",),
    "dim_platform": ("platform_id",),
    "dim_lti_tool": ("lti_tool_id",),
    "dim_ai_tool": ("ai_tool_id",),
    "dim_device": ("device_id",),
    "dim_content": ("content_id",),
    "dim_assessment": ("assessment_id",),
    "dim_assessment_item": ("item_id",),
    "dim_skill": ("skill_id", "parent_skill_id",),
    "dim_standard": ("standard_id", "parent_standard_id",),
    "dim_session": ("session_id",),
    "dim_date": ("date_id",),
    "dim_time_of_day": ("time_of_day_id",),
    "ref_event_type": ("event_type_key",),
    "ref_verb": ("verb_id",),
    "ref_object_type": ("object_type_key", "target_type_key", "generated_type_key",),
    "ref_signal_type": ("signal_type_key",),
    "ref_membership_role": ("role_key",),
    "bridge_section_membership": ("membership_id",),
    "fact_assessment_attempt": ("assessment_attempt_id",),
}
# The target model declares no role reference on course membership.
_NO_REFERENCE = {("bridge_course_membership", "role_key")}


def references() -> list[tuple[str, str, str, str]]:
    """(child, child column, parent, parent key) for every reference the models can carry."""
    parents = {
        column: parent
        for parent, columns in _REFERENCE_BY_COLUMN.items()
        for column in columns
    }
    return [
        (child, column, parents[column], SILVER[parents[column]].key)
        for child, contract in SILVER.items()
        for column in contract.names
        if column in parents and column != contract.key and (child, column) not in _NO_REFERENCE
    ]


# Comments of columns whose meaning is the same in every table.
COLUMN_COMMENTS = {
    "_id": "Document id, as text",
    "id": "Statement id",
    "timestamp": "When the event happened",
    "stored": "When the statement was received; the cursor of incremental loads",
    "actor": "JSON: who",
    "verb": "JSON: did what",
    "object": "JSON: to what",
    "result": "JSON: with which outcome",
    "context": "JSON: in which setting, with extensions",
    "source_system": "System the row comes from",
    "metadata": "Further attributes, as JSON text",
    "created_at": "Creation time",
    "updated_at": "Time of the last change",
    "date_id": "Days since 1970-01-01",
    "time_of_day_id": "Seconds since midnight",
    "organization_id": "Organisation",
    "person_id": "Person",
    "learner_id": "Learning person",
    "course_id": "Course",
    "section_id": "Teaching group",
    "term_id": "Term",
    "session_id": "Session",
    "content_id": "Content object",
    "assessment_id": "Assessment",
    "item_id": "Assessment item",
    "skill_id": "Skill",
    "standard_id": "Curriculum standard",
    "platform_id": "Platform",
    "lti_tool_id": "LTI tool",
    "ai_tool_id": "AI tool",
    "device_id": "Device",
    "role_key": "Role in the group or course",
    "weight": "Strength of the mapping",
    "score_raw": "Score as given",
    "score_scaled": "Score scaled to -1..1",
    "score_percent": "Score in percent",
    "is_correct": "Whether the answer was right",
    "latency_ms": "Time to answer, in milliseconds",
    "duration_seconds": "Time spent, in seconds",
}
