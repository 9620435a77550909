import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from learnsilver.llm import block_mixture as mix
from learnsilver.llm.queries import op5_block_mixture
from learnsilver.llm.shared import WORD, read

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def whole(spark):
    return op5_block_mixture(spark, FOLDER).toPandas()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 63, 64, 65, 1000])
def test_permutations_hit_every_index_once(n):
    for key in (1, 2**40):
        found = mix.permute(np.arange(n), np.full(n, n), np.full(n, key))
        assert sorted(found) == list(range(n))
    if n > 60:
        other = mix.permute(np.arange(n), np.full(n, n), np.full(n, 5))
        assert (other != found).any() and (found != np.arange(n)).any()


def test_targets_stop_at_the_limit_and_reshare_the_rest():
    sizes = np.array([10, 1000, 0, 500, 100_000])
    found = mix.targets(sizes, np.resize(np.array([5.0, 2, 1]), 5), 1.5, 2)
    assert found[0] == 20 and found[2] == 0 and (found <= 2 * sizes).all()
    assert found.sum() == pytest.approx(1.5 * sizes.sum())
    free = found < 2 * sizes
    assert len({round(x, 6) for x in (found / np.array([5, 2, 1, 5, 2]))[free]}) == 1
    assert mix.targets(np.array([], dtype=int), np.array([]), 1.5, 2).sum() == 0
    assert mix.targets(np.array([0, 0]), np.array([5.0, 2]), 1.5, 2).tolist() == [0, 0]


def test_sizes_targets_and_taken_words(spark, whole):
    docs = {r.doc_id: r for r in read(spark, FOLDER, "documents").collect()}
    sizes = {i: len(re.findall(WORD, d.text or "")) for i, d in docs.items()}
    assert dict(zip(whole.doc_id, whole["size"])) == sizes
    of = defaultdict(int)
    for i, d in docs.items():
        of[d.source] += sizes[i]
    assert {docs[r.doc_id].source: r.source_size for r in whole.itertuples()} == of
    names = sorted(of)
    aim = dict(zip(names, mix.targets(
        np.array([of[n] for n in names]), np.resize(np.array([5.0, 2, 1]), len(names)), 1.5, 2)))
    assert {docs[r.doc_id].source: r.target for r in whole.itertuples()} == pytest.approx(aim)
    got = defaultdict(int)
    for row in whole.itertuples():
        got[docs[row.doc_id].source] += row.taken
        assert 0 <= row.taken <= 2 * row.size
    for name in names:
        assert abs(got[name] - aim[name]) <= 3 * mix.BLOCK_WORDS


def test_taken_is_what_the_mixture_holds(spark, whole):
    rows = mix.mixture(read(spark, FOLDER, "documents")).toPandas()
    held = (rows.end - rows.start).groupby(rows.doc_id).sum()
    assert held.to_dict() == {r.doc_id: r.taken for r in whole.itertuples() if r.taken}
    slots = rows.drop_duplicates(["shard", "slot"])
    assert len(slots) == len(rows.drop_duplicates(["source_no", "pass", "block"]))
    for shard, some in slots.groupby("shard"):
        assert sorted(some.slot) == list(range(len(some)))


def test_reruns_agree_however_the_rows_are_dealt(spark, whole):
    docs = read(spark, FOLDER, "documents").repartition(7, "text")
    again = mix.taken(docs).toPandas()
    order = lambda frame: frame.sort_values(list(frame)).reset_index(drop=True)
    assert order(again).equals(order(whole))


def test_mixed_documents_hold_the_mixture(spark, whole):
    docs = read(spark, FOLDER, "documents")
    mixed = mix.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = defaultdict(int)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in mixed.collect():
        words = re.findall(WORD, row.text)
        got[row.doc_id] += len(words)
        assert row.n_chars == len(row.text)
        every = iter(re.findall(WORD, texts[row.doc_id]))
        assert all(word in every for word in words)  # in order
    assert got == {r.doc_id: r.taken for r in whole.itertuples() if r.taken}


def test_nulls_empty_texts_repeated_rows_and_no_rows(spark):
    schema = "doc_id long, text string, source string, size long, target string, offset int"
    rows = [
        (1, "a b c", "x"), (1, "a b c", "x"), (2, None, "x"), (None, "w " * 300, None),
        (3, "", "empty"), (4, "one\x0btwo\xa0three", "y"), (5, "v " * 5000, "z"),
    ]
    frame = spark.createDataFrame([(*row, 1, "t", 2) for row in rows], schema)
    found = mix.taken(frame).toPandas()
    assert len(found) == len(rows)
    by = {i: some for i, some in found.groupby("doc_id", dropna=False)}
    assert by[1]["size"].tolist() == [3, 3] and by[1].source_size.tolist() == [6, 6]
    assert by[3].target.item() == 0 and by[3].taken.item() == 0
    assert by[4]["size"].item() == 2
    assert found["size"].isna().sum() == 0 and (found.taken <= 2 * found["size"]).all()
    assert mix.taken(frame.limit(0)).count() == 0
    assert mix.mixed_documents(frame.limit(0)).count() == 0
    assert mix.mixed_documents(frame).columns == frame.columns


def test_rows_of_one_id_and_source_keep_their_own_texts(spark):
    schema = "doc_id long, text string, source string, n_chars long, at timestamp_ntz, note string"
    said = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    rows = [
        (None, said("a", 90), "x", "1", None), (None, said("b", 90), "x", "1", None), (None, said("c", 7), "x", "1", None),
        (1, said("d", 50), "x", "1", None), (1, said("e", 150), "x", "1", None), (1, said("f", 50), None, "1", None),
        (1, said("g", 50), None, "1", None), (2, said("h", 40), "y", "1", None), (2, said("h", 40), "y", "1", None),
        (2, said("h", 40), "y", "2", None), (2, said("h", 40), "y", "2", "n"), (None, said("i", 30), None, "1", None),
        (None, None, "x", "1", None),
    ]
    made = spark.createDataFrame(
        [(i, text, source, len(text or ""), at, note) for i, text, source, at, note in rows],
        schema.replace("timestamp_ntz", "string"),
    ).withColumn("at", F.concat(F.lit("2024-01-01 00:00:00.00000"), "at").cast("timestamp_ntz"))
    found = mix.mixed_documents(made, 16).collect()
    # The first pass over a source holds every word of it, so every row comes whole at least once.
    whole = [r.asDict() for r in made.collect() if r.text]
    got = [r.asDict() for r in found]
    for row in whole:
        assert got.count(row) >= whole.count(row), row
    held = mix.mixture(made, 16).toPandas()
    assert sum(len(r.text.split()) for r in found) == (held.end - held.start).sum()
    again = mix.mixed_documents(made.repartition(5, "text"), 16).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
