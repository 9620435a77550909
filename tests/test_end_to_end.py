import json

from learnsilver.operators.ingestion import load_collections, load_statements
from learnsilver.operators.quality import run_checks
from learnsilver.operators.rawstore import STORED_DAY, RawStore, hashed_parts
from learnsilver.operators.warehouse import Warehouse
from learnsilver.schemas import SILVER
from learnsilver.sources.documents import parse_documents, table_of, valid_documents
from learnsilver.schemas import RAW

IRI = "https://host.example/xapi/extensions/"
CHANGED = {"$date": "2024-01-01T00:00:00Z"}
DOCUMENTS = {
    "users": [
        {"_id": {"$oid": "u1"}, "first_name": "Mira", "last_name": "Brandt", "role": ["student"],
         "school": {"$oid": "o1"}, "modified_on": CHANGED},
        {"_id": {"$oid": "u2"}, "role": "teacher", "school": {"$oid": "o9"}, "modified_on": CHANGED},
    ],
    "schools": [{"_id": {"$oid": "o1"}, "name": "One", "location": "North", "modified_on": CHANGED}],
    "enrollments": [
        {"_id": {"$oid": "e1"}, "student": {"$oid": "u1"}, "course": {"$oid": "c1"}, "group": "g",
         "year": 2024, "status": "started", "created_on": CHANGED, "modified_on": CHANGED},
    ],
    "submissions": [
        {"_id": {"$oid": "s1"}, "userId": {"$oid": "u1"}, "exerciseId": {"$oid": "x1"},
         "submittedAt": CHANGED, "passed": True, "updatedAt": CHANGED,
         "itemResponses": [{"itemId": "x1_0", "isCorrect": True, "responseTime": CHANGED}]},
    ],
}


def statement(key, minute, **extensions):
    at = f"2024-01-07T10:{minute:02}:00Z"
    return {
        "id": key, "timestamp": at, "stored": at, "actor": {"account": {"name": "u1"}},
        "verb": {"id": "http://v/did", "display": {"en-US": "did"}},
        "object": {"id": "x1", "objectType": "Activity"}, "result": {"success": True},
        "context": {"extensions": {IRI + k: v for k, v in extensions.items()}},
    }


def test_from_exports_to_checked_tables(spark, tmp_path):
    """Two loads, with a changed document and a repeated statement, then a build each."""
    documents = {name: list(docs) for name, docs in DOCUMENTS.items()}
    store = RawStore(
        spark, f"{tmp_path}/raw",
        parts={"lrs_statements": STORED_DAY, "lms_users": hashed_parts("_id", 4)},
    )

    def read(collection):
        lines = [(json.dumps(d),) for d in documents.get(collection, [])]
        frame = spark.createDataFrame(lines, "value string")
        return valid_documents(parse_documents(frame, RAW[table_of(collection)]))

    def pages(*statements):
        return spark.createDataFrame([(json.dumps({"statements": statements}),)], "value string")

    silver = Warehouse(
        spark, f"{tmp_path}/lake", store.read,
        extension_prefix=IRI, extension_map={"sessionId": "session_id"},
    )
    load_collections(store, read)
    load_statements(store, pages(
        statement("a", 1, session_id="z", time_taken_ms=1500, course_id="c1"),
        statement("b", 2, session_id="z", time_taken_ms=500, course_id="c1"),
    ))
    silver.build_all()
    (summary,) = silver.table("fact_session_summary").collect()
    assert (summary.total_events, summary.active_seconds, summary.items_mastered) == (2, 3, 1)
    people = {r.person_id: r for r in silver.table("dim_person").collect()}
    assert (people["u1"].full_name, people["u1"].person_type) == ("Mira Brandt", "LEARNER")
    assert people["u2"].person_type == "TEACHER"
    (answer,) = silver.table("fact_item_response").collect()
    assert (answer.item_response_id, answer.date_id, answer.is_correct) == ("s1_x1_0", 19723, True)
    (section,) = silver.table("dim_section").collect()
    assert section.section_id == "g_c1_2024"

    documents["users"] = [{**DOCUMENTS["users"][1], "role": "staff",
                           "modified_on": {"$date": "2024-02-01T00:00:00Z"}}]
    assert load_collections(store, read)["lms_users"] == 1
    assert load_statements(store, pages(statement("b", 2), statement("c", 3))) == 1
    silver.build_all()
    people = {r.person_id: r.person_type for r in silver.table("dim_person").collect()}
    assert people == {"u1": "LEARNER", "u2": "STAFF"}
    assert silver.table("fact_learning_event").count() == 3

    found = {(r.model, r.check, r.column): r.failures for r in run_checks(silver.table).collect()}
    assert found[("dim_person", "references dim_organization", "home_organization_id")] == 1
    assert all(found[(m, "unique", SILVER[m].key)] == 0 for m in SILVER)
    silver.register_views(["dim_person"])
    assert spark.sql("select count(*) from dim_person").first()[0] == 2
