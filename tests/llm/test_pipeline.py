import re

import duckdb
import numpy as np
import pytest
import sentencepiece

import corpus_pipeline as pipe
from learnsilver.llm import block_mixture, line_chunks
from learnsilver.llm import positive_unlabelled as pu
from learnsilver.llm.queries import VOCABULARY
from learnsilver.llm.shared import read, stored, with_row_numbers

from test_group_prefix_join import brute  # noqa: I001

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """What goes into the pipeline, and what each stage makes of it."""
    docs = read(spark, FOLDER, "documents")
    out = [docs]
    for name, stage in pipe.STAGES:
        docs = stored(stage(spark, docs, FOLDER), name)
        out.append(docs)
    return out


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_columns(steps):
    assert [frame.columns for frame in steps[:-1]] == [steps[0].columns] * 5
    assert steps[-1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]


def test_quality_keeps_what_the_model_scores_high(spark, steps):
    model = pu.fit_on(steps[0], read(spark, FOLDER, "labels"))
    wanted = [r for r in steps[0].collect() if model.score(pu.features([r.text or ""]))[0] >= 0.3]
    assert rows(steps[1]) == sorted(map(tuple, wanted), key=str)
    good = read(spark, FOLDER, "labels").filter("quality = 1").join(steps[0], "doc_id")
    assert good.join(steps[1], "doc_id").count() > 0.95 * good.count()
    assert steps[1].count() < steps[0].count()


def test_line_dedup_against_its_sql(steps):
    with duckdb.connect() as db:
        db.register("documents", steps[1].toPandas())
        wanted = db.sql(f"SELECT doc_id, text FROM ({line_chunks.ORACLE_SQL})").fetchall()
    assert rows(steps[2].select("doc_id", "text")) == sorted(wanted, key=str)
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())


def test_one_document_of_each_group_stays(steps):
    before = [(r.doc_id, r.text) for r in steps[2].collect()]
    wanted = [i for i, _, component in brute(before) if i == component]
    assert sorted(r.doc_id for r in steps[3].collect()) == sorted(wanted)


def test_the_mixture_is_near_its_targets(steps):
    words = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    size, got = {}, {}
    for r in steps[3].collect():
        size[r.source] = size.get(r.source, 0) + words(r.text)
    for r in steps[4].collect():
        got[r.source] = got.get(r.source, 0) + words(r.text)
    names = sorted(size)
    weights = np.resize(np.array(block_mixture.WEIGHTS, dtype=float), len(names))
    aims = block_mixture.targets(np.array([size[n] for n in names]), weights, 1.5, 2)
    for name, aim in zip(names, aims):
        assert abs(got.get(name, 0) - aim) <= 3 * pipe.BLOCK_WORDS


def test_encoding_is_the_librarys(steps):
    library = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    wanted = sorted((r.doc_id, library.encode(r.text or "", add_eos=True)) for r in steps[4].collect())
    assert sorted((r.doc_id, r.ids) for r in steps[5].collect()) == wanted


def test_the_whole_run_gives_the_same(spark, steps):
    assert rows(pipe.run(spark, FOLDER).drop("ids")) == rows(steps[-1].drop("ids"))


def test_stages_on_odd_rows(spark, documents):
    odd = [(1, "Some plain text, with words enough to be a sentence."), (1, "Some plain text, with words enough to be a sentence."),
           (2, None), (3, ""), (None, "A text without an id, of some words."), (4, "\n".join(["one line", "two lines"] * 9))]
    for frame in (documents(odd), documents([])):
        columns = frame.columns
        for name, stage in pipe.STAGES:
            frame = stored(stage(spark, frame, FOLDER), name)
            assert name == "encoding" or frame.columns == columns
        assert frame.filter("n_tokens < 1").count() == 0


def test_rows_of_one_id_lose_no_text_of_their_own(spark, documents):
    """A copy of another document goes, what else has its id stays; of equal rows one stays."""
    chance = np.random.default_rng(3)
    one, two, three = (" ".join(f"{c}{k}" for k in chance.integers(0, 999, 60)) for c in "abc")
    rows = [(3, one), (5, one), (5, two), (7, three), (7, three), (None, two + " end"), (None, "short"), (9, ""), (9, None)]
    left = pipe.near_duplicates(spark, documents(rows), FOLDER)
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(3, one), (5, two), (7, three), (None, "short"), (9, ""), (9, None)], key=str
    )


def test_rows_without_id_take_part_in_line_dedup(spark, documents):
    text = "\n".join(f"line {k} of what both have" for k in range(12))
    rows = [(None, text), (None, text), (4, "other\n" + text + "\nend"), (4, text), (6, None)]
    left = pipe.line_dedup(spark, documents(rows), FOLDER)
    assert left.columns == documents(rows).columns
    texts = sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.n_chars) for r in left.collect())
    whole = [row for row in texts if len(row[2]) >= len(text)]
    assert len(texts) == 5 and len(whole) == 1 and not whole[0][0]
    assert all(n == (len(t) if t else n) for _, _, t, n in texts)


def test_rows_have_numbers_of_their_own(spark, documents):
    path = stored(documents([(k % 3, "same") for k in range(50)]).repartition(4), "numbers")
    found = [r._row for r in with_row_numbers(path).collect()]
    assert len(set(found)) == 50
    again = [r._row for r in with_row_numbers(path.select("text").filter("text = 'same'")).collect()]
    assert sorted(found) == sorted(again)
    assert with_row_numbers(path.limit(0)).count() == 0
