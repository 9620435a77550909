import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from learnsilver.llm import chat_prefix_targets as chat

SCHEMA = "conv_id long, turn long, role string, text string, example long, last boolean, mark string"


def turns(spark, rows):
    return spark.createDataFrame([(*row, 7, True, "x") for row in rows], SCHEMA)


def formatted(spark, rows):
    found = chat.examples(turns(spark, rows)).collect()
    return sorted(found, key=lambda r: (r.conv_id is not None, r.conv_id, r.example))


def test_every_reply_is_an_example_with_all_that_came_before(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"),
        (1, 3, "user", "bye"), (1, 4, "assistant", "see you"),
    ]
    first, second = formatted(spark, rows)
    assert first.text == "[SYS]be kind</s>[INST]hi</s>[ANS]hello</s>"
    assert second.text == first.text + "[INST]bye</s>[ANS]see you</s>"
    masked = [r.text[r.loss_start : r.loss_start + r.loss_length] for r in (first, second)]
    assert masked == ["hello", "see you"]


def test_marks_inside_texts_are_escaped(spark):
    rows = [(-1, 0, "user", chat.TRAP), (-1, 1, "assistant", chat.TRAP + "\\")]
    (row,) = formatted(spark, rows)
    assert row.text.count("</s>") == 2 and row.text.count("[INST]") == 1
    (digest,) = chat.digests(chat.examples(turns(spark, rows))).collect()
    assert digest.loss_chars == len(chat.TRAP) + 1
    assert digest.loss_sha256 == hashlib.sha256((chat.TRAP + "\\").encode()).hexdigest()


def expected(rows):
    found = {}
    key = lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or "")
    for row in sorted(rows, key=key):
        found.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    out = set()
    for conv, said in found.items():
        told = "".join(f"{role}\n{text}\n" for role, text in said)
        loss = "".join(text for role, text in said if role == "assistant")
        digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
        out.add((conv, len(said), digest(told), len(loss), digest(loss)))
    return out


def check(spark, rows):
    got = chat.digests(chat.examples(turns(spark, rows))).drop("formatted_chars").collect()
    assert {tuple(r) for r in got} == expected(rows)


def test_nulls_ties_repeated_rows_other_roles_and_long_texts(spark):
    check(spark, [
        (1, 0, "user", None), (1, 0, "user", None), (1, None, None, "no role"),
        (1, 2, "tool[:]<x>", "a[:]b"), (1, 3, "assistant", ""), (1, 4, "assistant", "😀" * 100_000),
        (None, 1, "assistant", "x"), (None, 1, "assistant", "x"),
        (2, 0, "user", "only a question"), (3, 0, "assistant", "\n\r\n[ANS]\\[ANS]"),
    ])


def test_no_rows(spark):
    assert chat.digests(chat.examples(turns(spark, []))).count() == 0


piece = st.text(alphabet="[]<>/\\sINTAY: a\n", max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3), st.sampled_from(["user", "assistant", "ro[le"]), piece), min_size=1, max_size=12))
def test_any_text_is_read_back(spark, rows):
    check(spark, rows)
