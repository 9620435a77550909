import random

import duckdb

from learnsilver.llm import line_chunks
from learnsilver.llm.queries import op10_line_chunks


def run(frame):
    rows = line_chunks.remove_repeated(frame).collect()
    return sorted((tuple(r) for r in rows), key=str), rows


def cut(spark, text):
    frame = spark.createDataFrame([(text,)], "text string")
    return frame.select(line_chunks.chunks(frame.text).alias("c")).first().c


def lines(seed, n):
    chance = random.Random(seed)
    return ["".join(chance.choices("abcdefgh ", k=20)) for _ in range(n)]


def test_chunks_hold_the_whole_text(spark):
    for text in ("", "\n", "one", "one\n", "a\nb\nc\n\n", "\n".join(lines(1, 200)), "same\n" * 99):
        found = cut(spark, text)
        assert "\n".join(c.text for c in found) == text
        assert sum(c.lines for c in found) == text.count("\n") + 1
        assert len(found) == 1 or min(c.lines for c in found) >= 2


def test_text_in_front_moves_no_boundary_behind_it(spark):
    body = lines(2, 60)
    plain = [c.text for c in cut(spark, "\n".join(body))]
    moved = [c.text for c in cut(spark, "\n".join(lines(3, 7) + body))]
    assert plain[2:] == moved[-len(plain[2:]):]


def test_a_shared_passage_stays_in_the_first_document(documents):
    passage = lines(4, 40)
    rows = [(i, "\n".join(lines(10 + i, 9) + passage + lines(30 + i, 9))) for i in (5, 3, 8)]
    _, found = run(documents(rows))
    left = {r.doc_id: r for r in found}
    assert left[3].text == dict(rows)[3] and left[3].removed_lines == 0
    for i in (5, 8):
        assert left[i].removed_lines >= 30
        assert left[i].text.startswith("\n".join(lines(10 + i, 9)[:6]))
        assert left[i].text.endswith("\n".join(lines(30 + i, 9)[-6:]))


def test_copies_lose_all_and_repeats_inside_a_text_stay_once(documents):
    block = lines(5, 30)
    _, found = run(documents([(1, "\n".join(block * 3)), (2, "\n".join(block)), (3, "short"), (4, "short")]))
    left = {r.doc_id: r for r in found}
    assert left[1].removed_lines > 30 and left[2].removed_lines > 20
    assert left[3].text == left[4].text == "short"


def test_nulls_repeated_rows_and_clashing_columns(spark, documents):
    text = "\n".join(lines(6, 12))
    frame = documents([(None, text), (4, text), (4, text), (9, None), (10, "")])
    frame = frame.selectExpr("*", "'mine' AS gone", "1 AS n_lines", "2 AS first_doc", "3 AS _id")
    _, found = run(frame)
    got = {(r.doc_id, r.text, r.n_lines, r.removed_lines) for r in found}
    assert got == {(None, "", 12, 12), (4, text, 12, 0), (9, None, 0, 0), (10, "", 1, 0)}
    assert len(found) == 5 and {r.gone for r in found} == {"mine"}


def test_no_rows(documents):
    assert run(documents([]))[1] == []


def test_whole_query_against_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = {tuple(r) for r in op10_line_chunks(spark, folder).collect()}
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet'")
        assert found == set(db.sql(line_chunks.ORACLE_SQL).fetchall())
    assert sum(row[3] for row in found) > 50
