"""The expected results of the queries, as DuckDB SQL over the test tables.

Everything is computed from the base tables; no raw table is rebuilt. Only
``metadata`` and the statement text repeat the JSON text, as they are output.
"""

from __future__ import annotations

from learnsilver.schemas import ACCEPTED_VALUES, MODELS, SILVER, references

_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}
_PREFIX = "https://xapi.example/extensions/"
_RUN_TS = "TIMESTAMP '2024-02-01 00:00:00'"


def _epoch_day(ts: str) -> str:
    return f"date_diff('day', DATE '1970-01-01', CAST({ts} AS DATE))"


def _second(ts: str) -> str:
    return f"hour({ts}) * 3600 + minute({ts}) * 60 + CAST(floor(second({ts})) AS INTEGER)"


def _day(base: str, key: str) -> str:
    return f"DATE '{base}' + CAST({key} AS INTEGER)"


def _extension(name: str, value: str, text: bool = True, when: str = "TRUE") -> str:
    shown = f"'\"' || {value} || '\"'" if text else f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {when} THEN ',\"{_PREFIX}{name}\":' || {shown} ELSE '' END"


_DAY = _epoch_day("ts")
_CONTEXT = (
    "'{\"extensions\":{' || substr("
    + " || ".join(
        [
            _extension("ai_tool_id", "'ai' || (k % 3)", when="event_type = 'view'"),
            _extension("attempts", "(k % 4 + 1)", text=False),
            _extension("course_id", "'c' || (k % 25)"),
            _extension("lti_tool_id", "'t' || (k % 7)", when="event_type = 'click'"),
            _extension("platform_id", "'p' || (k % 5)"),
            _extension("school_id", "'n' || (user_id % 25)"),
            _extension("session_id", f"user_id || '-' || {_DAY}"),
            _extension("time_taken_ms", "(k * 250)", text=False),
        ]
    )
    + ", 2) || '}}'"
)
_STAMP = "replace(CAST(ts AS VARCHAR), ' ', 'T') || 'Z'"
_STATEMENT = (
    f"""'{{"id":"' || event_id || '","timestamp":"' || {_STAMP} || '","actor":"""
    """{"account":{"homePage":"https://lms.example","name":"' || user_id || '"},"""
    """"objectType":"Agent"},"verb":{"display":{"en-US":"' || event_type || '"},"""
    """"id":"http://verbs.example/' || event_type || '"},"object":{"id":"content-' || k || '"' || """
    """CASE k % 3 WHEN 0 THEN ',"objectType":"Activity"' WHEN 1 THEN ',"objectType":"Agent"' """
    """ELSE '' END || '},"result":{' || """
    """CASE WHEN k % 10 <> 0 THEN '"completion":' || (k % 3 = 0) || ',' ELSE '' END || """
    """'"score":{"max":50000,"min":0,"raw":' || CAST(round(value * 100) AS BIGINT) || """
    """',"scaled":0.' || lpad(CAST(k AS VARCHAR), 2, '0') || '}' || """
    """CASE WHEN k % 10 <> 0 THEN ',"success":' || (k % 2 = 0) ELSE '' END || """
    f"""'}},"context":' || {_CONTEXT} || '}}'"""
)

# The statements, flattened, with the extra extensions read.
_EVENTS = f"""(
  SELECT CAST(event_id AS VARCHAR) AS event_id, ts, CAST(user_id AS VARCHAR) AS user_id,
    'http://verbs.example/' || event_type AS verb, event_type AS verb_name,
    'content-' || k AS content_id,
    CASE k % 3 WHEN 0 THEN 'Activity' WHEN 1 THEN 'Agent' END AS object_type,
    user_id || '-' || {_DAY} AS session_id,
    'n' || (user_id % 25) AS school_id, 'c' || (k % 25) AS course_id,
    'p' || (k % 5) AS platform_id,
    CASE WHEN event_type = 'click' THEN 't' || (k % 7) END AS lti_tool_id,
    CASE WHEN event_type = 'view' THEN 'ai' || (k % 3) END AS ai_tool_id,
    k % 4 + 1 AS attempt,
    CASE WHEN k % 10 <> 0 THEN k % 2 = 0 END AS success,
    CASE WHEN k % 10 <> 0 THEN k % 3 = 0 END AS completion,
    round(value * 100) AS score_raw, CAST(k AS DOUBLE) / 100 AS score_scaled,
    CAST(round(k * 250 / 1000.0) AS INTEGER) AS seconds,
    {_CONTEXT} AS context, {_STATEMENT} AS statement
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)
)"""


def _select(model: str, source: str, /, **columns: str) -> str:
    """A select of the model's columns, those not given being NULL."""
    contract = MODELS[model]
    assert set(columns) <= set(contract.names), set(columns) - set(contract.names)
    listed = ", ".join(
        f"CAST({columns.get(name, 'NULL')} AS {_TYPES[dtype]}) AS \"{name}\""
        for name, dtype in contract.columns
    )
    return f"SELECT {listed} FROM {source}"


_SETTING = {
    "session_id": "session_id",
    "organization_id": "school_id",
    "course_id": "course_id",
}
_TIMES = {
    "created_at": _day("2023-01-01", "key % 365"),
    "updated_at": _day("2023-06-01", "key % 300"),
}
_EARLIER = {
    "created_at": _day("2022-01-01", "key % 365"),
    "updated_at": _day("2022-06-01", "key % 300"),
}
_STAMPED = {"created_at": _RUN_TS, "updated_at": _RUN_TS}

_ENROLLMENTS = """(
  SELECT 'e' || o_orderkey AS id,
    CASE WHEN o_orderkey % 29 = 0 THEN NULL
      WHEN o_orderkey % 19 = 0 THEN 'x' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS student,
    'c' || (o_orderkey % 2000) AS course,
    CASE WHEN o_orderkey % 13 <> 0 THEN 'g' || (o_orderkey % 10) END AS grp,
    CASE WHEN o_orderkey % 17 <> 0 THEN year(o_orderdate) END AS yr,
    o_orderstatus AS status, o_orderdate AS created,
    o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER)) AS modified
  FROM orders)"""
# Role of a user by the remainder of the key, as the memberships see it.
_MEMBER_ROLE = """CASE WHEN c_custkey % 8 = 4 THEN 'Instructor' ELSE 'Learner' END"""


def _content(kind: str, prefix: str, source: str, key: str, title: str, text: str) -> str:
    return _select(
        "dim_content",
        f"(SELECT *, {key} AS key FROM {source})",
        content_id=f"'{prefix}' || key",
        source_system="'lms'",
        source_content_key=f"'{prefix}' || key",
        owner_organization_id="'n' || (key % 25)",
        course_id="'c' || (key % 2000)",
        section_id="'g' || (key % 10)",
        content_type=f"'{kind}'",
        interaction_type="CASE key % 3 WHEN 0 THEN 'choice' WHEN 1 THEN 'essay' ELSE 'numeric' END",
        title=title,
        description=text,
        difficulty_estimate="CAST(key % 10 AS DOUBLE) / 10",
        metadata="""CASE WHEN key % 11 <> 0 THEN '{"skills":[' || CASE key % 4 WHEN 0 THEN ''
          ELSE '{"skillId":"s' || ((key + 1) % 25 * 3) || '","skillWeight":0.5}' END ||
          CASE WHEN key % 4 >= 2 THEN ',{"skillId":"s' || ((key + 2) % 25 * 3) || '"}' ELSE '' END ||
          CASE WHEN key % 4 = 3 THEN ',"s' || ((key + 3) % 25 * 3) || '"' ELSE '' END || ']}' END""",
        **_TIMES,
    )


_CONTENT_KEYS = """(
  SELECT 'pg-' || page_id AS id, page_id AS key FROM pages
  UNION ALL
  SELECT CASE doc_id % 2 WHEN 0 THEN 'bl-' ELSE 'le-' END || doc_id, doc_id FROM documents)"""

_ITEMS = """(
  SELECT p_partkey AS key, p_name, n FROM part, (VALUES (1), (2), (3)) AS numbers(n)
  WHERE n <= p_size % 4)"""

_ATTEMPTS = """(
  SELECT *, o_orderkey AS key,
    o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS INTEGER)) AS started
  FROM orders)"""


def _models() -> dict[str, str]:
    out: dict[str, str] = {}

    def add(model: str, source: str, /, **columns: str) -> None:
        out[model] = _select(model, source, **columns)

    add(
        "stg_lrs_events", _EVENTS,
        event_id="event_id", event_timestamp="ts", userId="user_id", verbId="verb",
        verbIri="verb", verbDescription="verb_name", objectId="content_id",
        objectType="object_type", sessionId="session_id", schoolId="school_id",
        courseId="course_id", platformId="platform_id", ltiToolId="lti_tool_id",
        aiToolId="ai_tool_id", contentId="content_id", attemptNumber="attempt",
        success="success", completion="completion", isCorrect="success",
        scoreRaw="score_raw", scoreMin="0", scoreMax="50000", scoreScaled="score_scaled",
        durationSeconds="seconds", eventType="verb", actorType="'learner'",
        metadata="context", fullStatement="statement",
    )
    add(
        "dim_date", "(SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)",
        date_id=_epoch_day("d"), date="d", year="year(d)", month="month(d)", day="day(d)",
        quarter="quarter(d)", week_of_year="weekofyear(d)", day_of_week="dayofweek(d) + 1",
        day_name="dayname(d)", is_weekend="dayofweek(d) IN (0, 6)", is_holiday="FALSE",
    )
    add(
        "dim_time_of_day",
        "(SELECT DISTINCT hour(ts) AS h, minute(ts) AS m, "
        "CAST(floor(second(ts)) AS INTEGER) AS s FROM events)",
        time_of_day_id="h * 3600 + m * 60 + s", hour="h", minute="m", second="s",
        label="lpad(CAST(h AS VARCHAR), 2, '0') || ':' || lpad(CAST(m AS VARCHAR), 2, '0') "
        "|| ':' || lpad(CAST(s AS VARCHAR), 2, '0')",
    )
    add(
        "dim_organization",
        "(SELECT *, s_suppkey AS key FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)",
        organization_id="'n' || key", source_system="'lms'",
        source_organization_key="'n' || key", name="s_name", organization_type="'school'",
        region="n_name", **_EARLIER,
    )
    add(
        "dim_person",
        "(SELECT *, c_custkey AS key, CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS given, "
        "CASE WHEN c_custkey % 10 <> 0 THEN c_name END AS family FROM customer)",
        person_id="key", source_system="'lms'", source_person_key="key", external_user_id="key",
        person_type="CASE WHEN key % 8 <= 2 THEN 'LEARNER' WHEN key % 8 <= 4 THEN 'TEACHER' "
        "WHEN key % 8 = 5 THEN 'STAFF' ELSE 'UNKNOWN' END",
        full_name="coalesce(given, '') || ' ' || coalesce(family, '')",
        given_name="given", family_name="family", home_organization_id="'n' || c_nationkey",
        grade_level="key % 12 + 1", created_at=_TIMES["created_at"],
        updated_at=f"{_TIMES['created_at']} + CAST(key % 30 AS INTEGER)",
    )
    add(
        "dim_academic_term",
        f"(SELECT yr, min(created) AS lo, max(created) AS hi FROM {_ENROLLMENTS} "
        "WHERE yr IS NOT NULL GROUP BY yr)",
        term_id="yr || '_default'", source_system="'lms'", source_term_key="yr || '_default'",
        school_year="yr", term_type="'default'", name="'Default Term ' || yr",
        created_at="lo", updated_at="hi",
    )
    add(
        "dim_course", "(SELECT *, p_partkey AS key FROM part)",
        course_id="'c' || key", source_system="'lms'", source_course_key="'c' || key",
        name="p_name", subject="CASE WHEN key % 11 <> 0 THEN p_type END",
        grade_band="CASE WHEN key % 7 <> 0 THEN p_size END", **_EARLIER,
    )
    add(
        "dim_section",
        f"(SELECT grp, course, yr, min(created) AS lo, max(created) AS hi FROM {_ENROLLMENTS} "
        "WHERE grp IS NOT NULL AND yr IS NOT NULL GROUP BY grp, course, yr)",
        section_id="grp || '_' || course || '_' || yr", source_system="'lms'",
        source_section_key="grp", course_id="course", term_id="yr || '_default'", code="grp",
        name="grp", created_at="lo", updated_at="hi",
    )
    out["dim_content"] = " UNION ALL ".join(
        [
            _content("page", "pg-", "pages", "page_id", "url", "html"),
            _content("block", "bl-", "documents WHERE doc_id % 2 = 0", "doc_id",
                     "lang || ' ' || source", "text"),
            _content("lesson", "le-", "documents WHERE doc_id % 2 = 1", "doc_id",
                     "lang || ' ' || source", "text"),
        ]
    )
    profiles = _select(
        "dim_assessment", "(SELECT *, s_suppkey AS key FROM supplier)",
        assessment_id="'ap' || key", source_system="'lms'", source_assessment_key="'ap' || key",
        organization_id="'n' || (key % 25)", course_id="'c' || (key % 2000)",
        section_id="'g' || (key % 10)", term_id="'2023_default'",
        content_id="'pg-' || (key % 50)", title="s_name",
        assessment_type="CASE key % 2 WHEN 0 THEN 'quiz' ELSE 'exam' END",
        max_score="100", passing_score="60", grading_scheme="'percent'", **_TIMES,
    )
    exercises = _select(
        "dim_assessment", "(SELECT *, p_partkey AS key FROM part WHERE p_partkey % 5 <> 0)",
        assessment_id="'ex' || key", source_system="'lms'", source_assessment_key="'ex' || key",
        organization_id="'n' || (key % 25)", course_id="'c' || key",
        section_id="'g' || (key % 10)", term_id="(key % 3 + 2022) || '_default'",
        content_id="'ex' || key", title="p_name", description="p_type",
        assessment_type="'exercise'", max_score="p_size",
        passing_score="CAST(p_size AS DOUBLE) / 2",
        metadata="""'{"brand":"' || p_brand || '"}'""", **_TIMES,
    )
    out["dim_assessment"] = f"{profiles} UNION ALL {exercises}"
    add(
        "dim_assessment_item", _ITEMS,
        item_id="'ex' || key || '_' || (n - 1)", source_system="'lms'",
        source_item_key="'ex' || key || '_' || (n - 1)", assessment_id="'ex' || key",
        content_id="'pg-' || ((key + n) % 50)",
        item_type="CASE n WHEN 1 THEN 'mcq' ELSE 'short-answer' END",
        interaction_type="CASE WHEN n % 2 = 1 THEN 'choice' END",
        prompt_summary="substr(repeat(p_name || '.', (key + n) % 40 + 1), 1, 200)",
        difficulty_estimate="CAST(n AS DOUBLE) / 4", max_score="n",
        metadata="""'{"n":' || n || '}'""", **_TIMES,
    )
    rules = {"name": "p_name", "description": "p_type", **_TIMES}
    add(
        "dim_skill", "(SELECT *, p_partkey AS key FROM part WHERE p_partkey % 3 = 0)",
        skill_id="'s' || key", external_skill_code="p_brand", domain="p_type", level="p_size",
        parent_skill_id="CASE WHEN key % 6 = 0 THEN 's' || (key // 6 * 3) END",
        metadata="""CASE WHEN key % 5 <> 0 THEN '{"standardMappings":[' ||
          CASE WHEN key % 4 >= 1 THEN '{"skillId":"s' || key || '","standardId":"std' || (key + 1)
            || '","weight":0.25,"source":"import"}' ELSE '' END ||
          CASE WHEN key % 4 >= 2 THEN ',{"skillId":"s' || key || '","standardId":"std' || (key + 4)
            || '"}' ELSE '' END ||
          CASE WHEN key % 4 = 3 THEN ',{"skillId":"s' || key || '"}' ELSE '' END || ']}' END""",
        **rules,
    )
    add(
        "dim_standard", "(SELECT *, p_partkey AS key FROM part WHERE p_partkey % 3 = 1)",
        standard_id="'std' || key", framework="'local'", external_code="p_brand",
        grade_band="key % 12 + 1", subject="p_type",
        parent_standard_id="CASE WHEN key % 6 = 1 THEN 'std1' END", **rules,
    )
    add(
        "dim_session",
        "(SELECT session_id, user_id, school_id, course_id, platform_id, min(ts) AS lo, "
        f"max(ts) AS hi, sum(seconds) AS secs, max(context) AS ctx FROM {_EVENTS} "
        "GROUP BY session_id, user_id, school_id, course_id, platform_id)",
        source_system="'xapi'", source_session_key="session_id", learner_id="user_id",
        platform_id="platform_id", session_start="lo", session_end="hi",
        session_duration_seconds="secs", metadata="ctx", **_SETTING,
    )
    add(
        "dim_platform", f"(SELECT DISTINCT platform_id, context FROM {_EVENTS})",
        platform_id="platform_id", metadata="context",
    )
    add(
        "dim_lti_tool",
        f"(SELECT DISTINCT lti_tool_id, platform_id, context FROM {_EVENTS} "
        "WHERE lti_tool_id IS NOT NULL)",
        lti_tool_id="lti_tool_id", platform_id="platform_id", metadata="context",
    )
    add(
        "dim_ai_tool",
        f"(SELECT DISTINCT ai_tool_id, context FROM {_EVENTS} WHERE ai_tool_id IS NOT NULL)",
        ai_tool_id="ai_tool_id", metadata="context",
    )
    verbs = "(SELECT DISTINCT 'http://verbs.example/' || event_type AS iri, event_type FROM events)"
    add("ref_event_type", verbs, event_type_key="iri", description="event_type")
    add("ref_verb", verbs, verb_id="iri", iri="iri", description="event_type")
    add(
        "ref_object_type",
        f"(SELECT DISTINCT object_type FROM {_EVENTS} WHERE object_type IS NOT NULL)",
        object_type_key="object_type", description="object_type",
    )
    add(
        "ref_membership_role",
        """(SELECT DISTINCT CASE c_custkey % 8 WHEN 0 THEN '["student"]' WHEN 1 THEN 'student'
          WHEN 2 THEN '["teacher","student"]' WHEN 3 THEN '["teacher"]' WHEN 4 THEN 'teacher'
          WHEN 5 THEN '["staff"]' ELSE 'admin' END AS role
          FROM customer WHERE c_custkey % 8 <> 7)""",
        role_key="role",
        description="CASE role WHEN 'student' THEN 'Learner' WHEN 'teacher' THEN 'Instructor' "
        "WHEN 'admin' THEN 'Administrator' ELSE 'Unknown' END",
    )
    add(
        "bridge_section_membership",
        f"(SELECT e.*, {_MEMBER_ROLE} AS role FROM {_ENROLLMENTS} e LEFT JOIN customer "
        "ON student = CAST(c_custkey AS VARCHAR) WHERE grp IS NOT NULL AND student IS NOT NULL)",
        section_membership_id="id", source_system="'lms'", source_membership_key="id",
        section_id="grp", person_id="student", role_key="role", status="status",
        created_at="created", updated_at="modified",
    )
    add(
        "bridge_course_membership",
        f"(SELECT course, student, {_MEMBER_ROLE} AS role, max(status) AS st, "
        f"min(created) AS lo, max(modified) AS hi FROM {_ENROLLMENTS} LEFT JOIN customer "
        "ON student = CAST(c_custkey AS VARCHAR) WHERE student IS NOT NULL "
        "GROUP BY course, student, role)",
        course_membership_id="course || '_' || student", source_system="'lms'",
        source_membership_key="course || '_' || student", course_id="course",
        person_id="student", role_key="role", status="st", created_at="lo", updated_at="hi",
    )
    add(
        "bridge_content_skill_map",
        f"(SELECT id, 's' || ((key + n) % 25 * 3) AS skill, n FROM {_CONTENT_KEYS}, "
        "(VALUES (1), (2), (3)) AS numbers(n) WHERE n <= key % 4 AND key % 11 <> 0)",
        content_skill_map_id="id || '_' || skill", content_id="id", skill_id="skill",
        weight="CASE n WHEN 1 THEN 0.5 ELSE 1 END", source="'authoring'", **_STAMPED,
    )
    add(
        "bridge_item_skill_map",
        "(SELECT 'ex' || key || '_' || (n - 1) AS item, 's' || ((key + j) % 25 * 3) AS skill "
        f"FROM {_ITEMS}, (VALUES (0), (1)) AS more(j) WHERE j < n - 1)",
        item_skill_map_id="item || '_' || skill", item_id="item", skill_id="skill", weight="1",
        source="'authoring'", **_STAMPED,
    )
    add(
        "bridge_skill_standard_map",
        "(SELECT 's' || p_partkey AS skill, 'std' || (p_partkey + n * 3 - 2) AS std, n FROM part, "
        "(VALUES (1), (2)) AS numbers(n) "
        "WHERE p_partkey % 3 = 0 AND p_partkey % 5 <> 0 AND n <= p_partkey % 4)",
        skill_standard_map_id="skill || '_' || std", skill_id="skill", standard_id="std",
        weight="CASE n WHEN 1 THEN 0.25 ELSE 1 END",
        source="CASE n WHEN 1 THEN 'import' ELSE 'manual' END", **_STAMPED,
    )
    add(
        "bridge_assessment_item_map",
        """(SELECT assessment, item, min(position) AS pos, min(points) AS pts FROM (
          SELECT 'ap' || s_suppkey AS assessment,
            'it' || ((s_suppkey + CASE n WHEN 3 THEN 1 ELSE n END) % 50) AS item,
            CASE n WHEN 3 THEN 0 ELSE n END AS position, n * 2 AS points
          FROM supplier, (VALUES (1), (2), (3)) AS numbers(n) WHERE n <= s_suppkey % 4
          UNION ALL
          SELECT 'ex' || (o_orderkey % 2000), 'it' || (o_orderkey % 50), o_orderkey % 4,
            o_orderkey % 5 FROM orders WHERE o_orderkey % 3 = 0) GROUP BY assessment, item)""",
        assessment_item_map_id="assessment || '_' || item", assessment_id="assessment",
        item_id="item", position="pos", points="pts", **_STAMPED,
    )
    ids = {"date_id": _epoch_day("ts"), "time_of_day_id": _second("ts")}
    add(
        "fact_learning_event", _EVENTS,
        event_id="event_id", source_system="'xapi'", source_event_key="event_id",
        event_timestamp_utc="ts", event_type_key="verb", verb_raw="verb", person_id="user_id",
        actor_type="'learner'", platform_id="platform_id", lti_tool_id="lti_tool_id",
        ai_tool_id="ai_tool_id", object_type_key="object_type", object_id="content_id",
        content_id="content_id", attempt_number="attempt", success="success",
        completion="completion", is_correct="success", score_raw="score_raw", score_min="0",
        score_max="50000", score_scaled="score_scaled", duration_seconds="seconds",
        metadata="context", **ids, **_SETTING,
    )
    attempt_setting = {
        "session_id": "'ss' || (key % 5000)", "organization_id": "'n' || (key % 25)",
        "course_id": "'c' || (key % 2000)", "section_id": "'g' || (key % 10)",
        "assessment_id": "'ex' || (key % 2000)",
    }
    add(
        "fact_assessment_attempt", _ATTEMPTS,
        assessment_attempt_id="'sub' || key", source_system="'lms'",
        source_attempt_key="'sub' || key", attempt_start="started",
        attempt_end="started + to_seconds(CAST(key % 3600 AS INTEGER))", learner_id="o_custkey",
        content_id="'ex' || (key % 2000)", score_raw="o_totalprice",
        score_scaled="CAST(key % 101 AS DOUBLE) / 100", score_percent="key % 101",
        passed="CASE WHEN key % 7 <> 0 THEN key % 101 >= 60 END", attempt_number="key % 3 + 1",
        item_count="key % 4", completed_item_count="least(key % 4, 2)",
        metadata="""'{"priority":"' || o_orderpriority || '"}'""", **attempt_setting,
    )
    add(
        "fact_item_response",
        f"(SELECT *, started + to_seconds(n * 7) AS ts FROM {_ATTEMPTS}, "
        "(VALUES (1), (2), (3)) AS numbers(n) WHERE n <= key % 4)",
        item_response_id="'sub' || key || '_it' || ((key + n) % 50)", source_system="'lms'",
        source_response_key="'sub' || key || '_it' || ((key + n) % 50)",
        response_timestamp_utc="ts", assessment_attempt_id="'sub' || key", person_id="o_custkey",
        term_id="year(o_orderdate) || '_default'", item_id="'it' || ((key + n) % 50)",
        content_id="'pg-' || ((key + n) % 50)",
        skill_id="CASE WHEN n <> 2 THEN 's' || (key % 25 * 3) END",
        attempt_number="key % 3 + 1", item_position="n", response="'answer ' || n",
        is_correct="CASE WHEN n <> 3 THEN (key + n) % 2 = 0 END", score_raw="(key + n) % 10",
        score_scaled="CAST((key + n) % 10 AS DOUBLE) / 10", latency_ms="key % 1000 + n",
        hints_used="n % 2", metadata="""'{"priority":"' || o_orderpriority || '"}'""",
        source_payload="""'{"order":' || key || '}'""", **ids, **attempt_setting,
    )
    add(
        "fact_session_summary",
        "(SELECT session_id, user_id, school_id, course_id, count(*) AS n, sum(seconds) AS secs, "
        "count(DISTINCT content_id) AS items, "
        "count(DISTINCT CASE WHEN success THEN content_id END) AS mastered, "
        f"count(ai_tool_id) AS ai, max(context) AS ctx FROM {_EVENTS} "
        "GROUP BY session_id, user_id, school_id, course_id)",
        session_summary_id="session_id", learner_id="user_id", total_events="n",
        active_seconds="secs", items_attempted="items", items_mastered="mastered",
        hints_requested="0", ai_interactions="ai", signals_generated="0", metadata="ctx",
        **_SETTING,
    )
    add(
        "fact_ai_interaction", f"{_EVENTS} WHERE ai_tool_id IS NOT NULL",
        ai_interaction_id="event_id", interaction_timestamp="ts", learner_id="user_id",
        content_id="content_id", ai_tool_id="ai_tool_id", metadata="context", **_SETTING,
    )
    add(
        "fact_launch", f"{_EVENTS} WHERE lti_tool_id IS NOT NULL",
        launch_id="session_id || '_' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f')",
        source_system="'xapi'", launch_timestamp_utc="ts", platform_id="platform_id",
        lti_tool_id="lti_tool_id", person_id="user_id", launch_type="'lti'", metadata="context",
        source_payload="statement", **ids, **_SETTING,
    )
    for empty in ("dim_device", "ref_signal_type", "fact_learning_signal",
                  "fact_variant_exposure"):
        add(empty, "events WHERE FALSE")
    return out


def _ingest() -> dict[str, str]:
    text = "CAST({} AS VARCHAR)".format
    tables = {
        "lms_users": "customer", "lms_schools": "supplier", "lms_courses": "part",
        "lms_modules": "part", "lms_lessons": "documents WHERE doc_id % 2 = 1",
        "lms_pages": "pages", "lms_blocks": "documents WHERE doc_id % 2 = 0",
        "lms_exercises": "part", "lms_exercise_submissions": "orders",
        "lms_enrollments": "orders", "lms_projects": "supplier",
        "lms_project_enrollments": "customer", "lms_survey_enrollments": "labels",
        "lms_survey_submissions": "conversations",
        "lms_assessment_profiles": "supplier", "lms_rules": "part", "lrs_statements": "events",
    }
    report = " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS rows, TRUE AS present FROM {source}"
        for t, source in tables.items()
    )
    created = _day("2023-01-01", "c_custkey % 365")
    exported = (
        f"CAST({created} AS TIMESTAMP) AS created_on, CASE WHEN c_custkey % 4 <> 0 THEN "
        f"CAST({created} AS TIMESTAMP) + to_seconds(CAST(c_custkey % 60 AS INTEGER)) END "
        "AS modified_on"
    )
    users = (
        f"SELECT CAST(c_custkey AS VARCHAR) AS _id, c_name AS last_name, "
        f"CAST({created} + CAST(c_custkey % 30 AS INTEGER) AS TIMESTAMP) AS modified_on "
        "FROM customer"
    )
    # What is left of the changes: the second version of every third user, and new users.
    changed = (
        "SELECT CAST(c_custkey AS VARCHAR) AS _id, c_name || ' v2' AS last_name, "
        "TIMESTAMP '2024-03-01' + to_days(CAST(c_custkey % 30 AS INTEGER)) AS modified_on "
        "FROM customer WHERE c_custkey % 3 = 0 UNION ALL "
        "SELECT 'new' || c_custkey, c_name || ' v2', "
        "TIMESTAMP '2024-03-01' + to_days(CAST(c_custkey % 30 AS INTEGER)) "
        "FROM customer WHERE c_custkey % 50 = 0"
    )
    merged = f"{users} WHERE c_custkey % 3 <> 0 UNION ALL {changed}"
    return {
        "ingest_page_flatten": f"""
            SELECT {text('event_id * 4 + n')} AS id, ts AS timestamp,
              ts + to_minutes(n) AS stored, '{{"account":{{"name":"' || user_id || '"}}}}' AS actor,
              '{{"id":"http://verbs.example/' || event_type || '"}}' AS verb
            FROM events, (VALUES (1), (2), (3)) AS numbers(n) WHERE n <= event_id % 4""",
        "ingest_document_normalise": f"""
            SELECT {text('c_custkey')} AS _id, '["student"]' AS role, c_name AS last_name,
              'n' || c_nationkey AS school, '7' AS grade, {exported} FROM customer""",
        "ingest_cursor_filter": f"""
            SELECT id AS _id, student, modified AS modified_on FROM {_ENROLLMENTS}
            WHERE modified > TIMESTAMP '1998-01-01'""",
        "ingest_cursor_filter_any": f"""
            SELECT 'c' || key AS _id, CAST({_EARLIER['updated_at']} AS TIMESTAMP) AS "updatedAt",
              CAST({_EARLIER['created_at']} AS TIMESTAMP) AS "modifiedAt"
            FROM (SELECT p_partkey AS key FROM part)
            WHERE {_EARLIER['updated_at']} > DATE '2022-08-01'
              OR {_EARLIER['created_at']} > DATE '2022-08-01'""",
        "ingest_cursor_state": f"""
            SELECT 'lms_enrollments' AS "table", max(modified) AS last_cursor FROM {_ENROLLMENTS}
            UNION ALL SELECT if(doc_id % 2 = 1, 'lms_lessons', 'lms_blocks'),
              max(CAST({_day('2023-06-01', 'doc_id % 300')} AS TIMESTAMP))
              FROM documents GROUP BY 1
            UNION ALL SELECT 'lrs_statements',
              max(ts + to_minutes(CAST(event_id % 7 AS INTEGER))) FROM events""",
        "ingest_document_rejects": """
            SELECT 'given' AS what, count(*) AS rows FROM customer
            UNION ALL SELECT 'loaded', count(*) FROM customer WHERE c_custkey % 10 <> 7
            UNION ALL SELECT 'unreadable', count(*) FROM customer WHERE c_custkey % 10 = 7
            UNION ALL SELECT 'created_on', count(*) FROM customer WHERE c_custkey % 10 = 5""",
        "ingest_page_rejects": """
            SELECT 'given' AS what, count(*) AS rows FROM events
            UNION ALL SELECT 'rejected', count(*) FROM events WHERE event_id % 9 = 0
            UNION ALL SELECT 'statements', CAST(sum(event_id % 4) AS BIGINT) FROM events
              WHERE event_id % 9 <> 0""",
        "ingest_page_elements": """
            SELECT 'statement' AS what, CAST(event_id * 4 + n AS VARCHAR) AS text
            FROM events, (VALUES (1), (2), (3)) AS numbers(n) WHERE n <= event_id % 4
            UNION ALL SELECT 'element 0', '5' FROM events WHERE event_id % 5 = 0 AND event_id % 4 > 0""",
        "ingest_page_gaps": """
            WITH pages AS (
              SELECT event_id, CASE WHEN event_id % 1000 = 599 THEN event_id - 50
                WHEN event_id % 100 = 99 THEN NULL ELSE event_id + 1 END AS following
              FROM events WHERE event_id % 250 <> 7)
            SELECT '/more/' || event_id AS address, '/more/' || following AS more, 'missing' AS problem
            FROM pages WHERE following NOT IN (SELECT event_id FROM pages)
            UNION ALL SELECT '/more/' || event_id, '/more/' || following, 'endless' FROM pages
            WHERE event_id % 1000 BETWEEN 508 AND 599
              AND event_id - event_id % 1000 + 599 IN (SELECT event_id FROM pages)""",
        "ingest_cursor_tie": f"""
            WITH users AS ({users}),
            first AS (SELECT * FROM users WHERE CAST(_id AS BIGINT) % 2 = 0),
            late AS (SELECT * FROM users WHERE CAST(_id AS BIGINT) % 2 = 1
              AND modified_on >= (SELECT max(modified_on) FROM first))
            SELECT _id, CAST(modified_on AS VARCHAR) AS what FROM first
            UNION ALL SELECT _id, CAST(modified_on AS VARCHAR) FROM late
            UNION ALL SELECT 'load 0', CAST(count(*) AS VARCHAR) FROM first
            UNION ALL SELECT 'load 1', CAST((SELECT count(*) FROM late) + (SELECT count(*) FROM first
              WHERE modified_on > (SELECT max(modified_on) FROM first)) AS VARCHAR)
            UNION ALL SELECT 'load 2', '0'""",
        "ingest_since_override": f"""
            SELECT _id, if(modified_on > TIMESTAMP '2023-09-01', 'renamed', last_name) AS last_name, modified_on
            FROM ({users})""",
        "ingest_clean_start": users,
        "ingest_append_folded": f"""
            SELECT {text('event_id')} AS id, if(event_id % 10 < 2, NULL, ts) AS timestamp FROM events""",
        "ingest_type_drift": """
            SELECT CAST(c_custkey AS VARCHAR) AS _id, CASE
              WHEN c_custkey % 3 = 2 OR c_custkey % 30 = 0 THEN 'grade ' || c_custkey % 7
              WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 7 AS VARCHAR)
              WHEN c_custkey % 2 = 0 THEN CAST(c_custkey // 2 AS VARCHAR)
              ELSE c_custkey // 2 || '.5' END AS grade FROM customer""",
        "ingest_collection_scan": f"""
            SELECT 'lms_users' AS "table", _id, modified_on FROM (
              SELECT {text('c_custkey')} AS _id, {exported} FROM customer)
            UNION ALL SELECT 'lms_courses', 'c' || p_partkey,
              CAST({_EARLIER['updated_at'].replace('key', 'p_partkey')} AS TIMESTAMP) FROM part""",
        "ingest_landed_pages": """
            SELECT 'statements' AS what, CAST(sum(event_id % 4) AS BIGINT) AS rows FROM events
              WHERE event_id % 9 <> 0
            UNION ALL SELECT 'rejected', count(*) FROM events WHERE event_id % 9 = 0""",
        "staging_view": f"""
            SELECT "eventType", count(*) AS events, count(DISTINCT "userId") AS users, max("scoreRaw") AS best
            FROM ({_models()["stg_lrs_events"]}) GROUP BY ALL""",
        "ingest_cursor_null": f"""
            SELECT _id, last_name, if(CAST(_id AS BIGINT) % 4 = 0, NULL, modified_on) AS modified_on
            FROM ({users}) WHERE CAST(_id AS BIGINT) % 4 = 0 OR modified_on > TIMESTAMP '2023-06-01'""",
        "ingest_merge_resent": f"""
            SELECT {text('event_id')} AS id, ts AS timestamp,
              ts + to_minutes(CAST(event_id % 7 AS INTEGER))
                + to_days(if(event_id % 3 = 0, 9, 0)) AS stored FROM events""",
        "skill_weight_rejects": """
            SELECT 'bl-' || doc_id AS content_id, 's' || ((doc_id + 1) % 25 * 3) AS skill_id,
              'heavy' AS weight FROM documents
            WHERE doc_id % 2 = 0 AND doc_id % 11 <> 0 AND doc_id % 4 <> 0""",
        "ingest_merge_no_key": """
            SELECT 'loaded' AS what, count(*) AS rows FROM customer WHERE c_custkey % 5 <> 0
            UNION ALL SELECT 'aside', 2 * count(*) FROM customer WHERE c_custkey % 5 = 0""",
        "ingest_upsert": merged,
        "ingest_incremental_load": merged,
        "ingest_stream_upsert": f"SELECT {text('c_custkey')} AS _id, c_name AS last_name, "
        f"{exported} FROM customer",
        "ingest_append": f"SELECT {text('event_id')} AS id, ts AS timestamp FROM events",
        "ingest_load_report": report
        + " UNION ALL SELECT 'lms_surveys', CAST(NULL AS BIGINT), FALSE",
        "staging_rejects": _rejects(),
        "silver_row_counts": " UNION ALL ".join(
            f"SELECT '{m}' AS model, count(*) AS rows FROM ({sql}) AS t"
            for m, sql in _models().items()
        ),
    }


def _rejects() -> str:
    """Attempts are given as words for some events, which are no numbers."""
    silent = "k % 10 = 0"
    given = {
        "attemptNumber": ("TRUE", "k % 4 = 3"),
        "durationSeconds": ("TRUE", "FALSE"),
        "success": (f"NOT {silent}", "FALSE"),
        "isCorrect": (f"NOT {silent}", "FALSE"),
        "completion": (f"NOT {silent}", "FALSE"),
        **{c: ("TRUE", "FALSE") for c in ("scoreRaw", "scoreMin", "scoreMax", "scoreScaled")},
    }
    source = "(SELECT CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)"
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {g}) AS given, "
        f"count(*) FILTER (WHERE {b}) AS rejected FROM {source}"
        for c, (g, b) in given.items()
    )


def _checks(models: dict[str, str]) -> dict[str, str]:
    """The data-quality results, computed on the expected models."""
    tables = "WITH " + ", ".join(f"m_{m} AS ({models[m]})" for m in SILVER)

    def repeated(model: str, columns: tuple[str, ...], check: str) -> str:
        listed = ", ".join(f'"{c}"' for c in columns)
        filled = " AND ".join(f'"{c}" IS NOT NULL' for c in columns)
        return (
            f"SELECT '{model}' AS model, '{check}' AS \"check\", '{', '.join(columns)}' AS "
            f"\"column\", count(*) AS failures FROM (SELECT {listed} FROM m_{model} WHERE {filled} "
            f"GROUP BY {listed} HAVING count(*) > 1) AS t"
        )

    def counted(model: str, column: str, check: str, condition: str) -> str:
        return (
            f"SELECT '{model}' AS model, '{check}' AS \"check\", '{column}' AS \"column\", "
            f"count(*) AS failures FROM m_{model} WHERE {condition}"
        )

    def union(parts) -> str:
        return f"{tables} " + " UNION ALL ".join(parts)

    def failing(model: str, column: str, check: str, condition: str, having: str = "TRUE") -> str:
        return (
            f"SELECT '{model}' AS model, '{check}' AS \"check\", '{column}' AS \"column\", "
            f"CAST(\"{column}\" AS VARCHAR) AS value, count(*) AS rows FROM m_{model} "
            f"WHERE {condition} GROUP BY ALL HAVING {having}"
        )

    def repeated_lists(model: str, columns: tuple[str, ...]) -> str:
        if len(columns) == 1:
            return failing(
                model, columns[0], "composite_unique", f'"{columns[0]}" IS NOT NULL', "count(*) > 1"
            )
        record = ", ".join(f"'{c}': \"{c}\"" for c in columns)
        filled = " AND ".join(f'"{c}" IS NOT NULL' for c in columns)
        return (
            f"SELECT '{model}', 'composite_unique', '{', '.join(columns)}', "
            f"CAST(to_json({{{record}}}) AS VARCHAR), count(*) FROM m_{model} WHERE {filled} "
            f"GROUP BY ALL HAVING count(*) > 1"
        )

    def orphan(child: str, column: str, parent: str, key: str) -> str:
        return failing(
            child, column, f"references {parent}",
            f'"{column}" IS NOT NULL AND NOT EXISTS (SELECT 1 FROM m_{parent} AS p '
            f'WHERE CAST(p."{key}" AS VARCHAR) = CAST(m_{child}."{column}" AS VARCHAR))',
        )

    failing_rows = [
        *[failing(m, c.key, "unique", f'"{c.key}" IS NOT NULL', "count(*) > 1") for m, c in SILVER.items()],
        *[repeated_lists(m, columns) for m, c in SILVER.items() for columns in c.unique],
        *[failing(m, c.key, "not_null", f'"{c.key}" IS NULL') for m, c in SILVER.items()],
        *[failing(m, column, "required", f'"{column}" IS NULL') for m, c in SILVER.items() for column in c.required],
        *[failing(m, column, "accepted_values", f'"{column}" NOT IN {values}')
          for (m, column), values in ACCEPTED_VALUES.items()],
        *[orphan(*rule) for rule in references()],
    ]

    return {
        "dq_failing_rows": union(failing_rows),
        "dq_unique": union(repeated(m, (c.key,), "unique") for m, c in SILVER.items()),
        "dq_not_null": union(
            counted(m, c.key, "not_null", f'"{c.key}" IS NULL') for m, c in SILVER.items()
        ),
        "dq_composite_unique": union(
            repeated(m, columns, "composite_unique")
            for m, c in SILVER.items()
            for columns in c.unique
        ),
        "dq_required": union(
            counted(m, column, "required", f'"{column}" IS NULL')
            for m, c in SILVER.items()
            for column in c.required
        ),
        "dq_accepted_values": union(
            counted(m, column, "accepted_values", f'"{column}" NOT IN {values}')
            for (m, column), values in ACCEPTED_VALUES.items()
        ),
        "dq_referential": union(
            counted(
                child, column, f"references {parent}",
                f'"{column}" IS NOT NULL AND NOT EXISTS (SELECT 1 FROM m_{parent} AS p '
                f'WHERE CAST(p."{key}" AS VARCHAR) = CAST(m_{child}."{column}" AS VARCHAR))',
            )
            for child, column, parent, key in references()
        ),
    }


#: Models that are empty by nature; they read no table and are no queries.
EMPTY = ("dim_device", "ref_signal_type", "fact_learning_signal", "fact_variant_exposure")


def oracle_sql() -> dict[str, str]:
    models = _models()
    shown = {name: sql for name, sql in models.items() if name not in EMPTY}
    any_host = dict.fromkeys(
        ("stg_lrs_events_any_host", "staging_after_second_load", "staging_after_fold"), models["stg_lrs_events"]
    )
    patched = {
        "silver_after_second_load": models["fact_learning_event"],
        "launches_after_second_load": models["fact_launch"],
        "sessions_after_second_load": models["fact_session_summary"],
    }
    return {**shown, **any_host, **patched, **_ingest(), **_checks(models)}
