import itertools
import zlib

import pytest

from learnsilver.llm import string_kernel_toxicity as tox
from learnsilver.llm.queries import op3_string_kernel_toxicity
from learnsilver.llm.shared import read

FOLDER = "/root/testdata/sf0.1"


def brute_kernel(s, t):
    """Over all pairs of subsequences of three characters."""

    def product(a, b):
        total = 0.0
        for i in itertools.combinations(range(len(a)), 3):
            for j in itertools.combinations(range(len(b)), 3):
                if i[2] - i[0] < tox.SPAN and j[2] - j[0] < tox.SPAN:
                    if all(a[x] == b[y] for x, y in zip(i, j)):
                        total += tox.DECAY ** (i[2] - i[0] - 2 + j[2] - j[0] - 2)
        return total

    size = (product(s, s) * product(t, t)) ** 0.5
    return product(s, t) / size if size else 0.0


def test_kernel_against_all_pairs_of_subsequences():
    words = ["loser", "loxser", "lloseer", "aaaa", "closers", "ab", "", "moronmoron"]
    for s, t in itertools.combinations_with_replacement(words, 2):
        assert tox.kernel(s, t) == pytest.approx(brute_kernel(s, t))
    assert tox.kernel("^loser$", "^loxser$") > tox.kernel("^loser$", "^house$") + 0.3


def test_batch_margins_are_the_machines():
    machine = tox.Machine({"los": 2.0, "ose": 1.0, "ser": 1.5, "^lo": 0.5, "aaa": 1.0}, -0.7)
    strings = ["^loser$", "^loxser$", "^l$", "^aaaaaa$", "^nothing$", "^" + "los" * 10 + "$"]
    found = tox.Scorer(machine).margins(strings)
    wanted = {s: machine.margin(s) for s in strings if machine.margin(s) > tox.NOTHING and len(s) > 4}
    assert found == pytest.approx(wanted) and "^loser$" in found


def test_strings_of_tokens():
    assert tox.strings_of("loser,") == ["^loser$"]
    assert tox.strings_of("l.o.s.e.r") == ["^loser$"]
    assert "^loser$" in tox.strings_of("lo-ser")
    assert set(tox.strings_of("well/idiot")) >= {"^well$", "^idiot$"}
    assert tox.strings_of("...") == []
    long = tox.strings_of("x" * 100 + "loser" + "y" * 100)
    assert max(map(len, long)) <= tox.WINDOW + 2 and any("loser" in s for s in long)
    assert tox.spelled_out("you l o s e r, a b") == ["loserab"] or "loser" in tox.spelled_out("you l o s e r there")


def small_machine():
    toxic = [f"here {a} stands a{i} loser{b} in {c}" for i, (a, b, c) in enumerate(
        itertools.product(["one", "two", "red"], ["", "s"], ["town", "wood", "sand", "rain"]))]
    clean = [f"here {a} stands a{i} tree in {c} of {b} close house" for i, (a, b, c) in enumerate(
        itertools.product(["one", "two", "red", "low"], ["old", "new"], ["town", "wood", "sand", "rain"]))]
    return tox.fit(toxic, clean)


def test_gapped_and_inserted_characters_are_tolerated():
    machine = small_machine()
    scorer = tox.Scorer(machine)
    score = lambda text: machine.probability(scorer.worst([text])[0])
    for word in ("loser", "LOSER!", "l o s e r", "l.o.s.e.r", "lo-ser", "looser", "loxser"):
        assert score(f"here two {word} stands") >= 0.5, word
    for text in ("here two stands a tree", "", "close house", "the lowest horse " * 1000):
        assert score(text) < 0.5, text


def test_held_out_labels_are_told(spark):
    found = op3_string_kernel_toxicity(spark, FOLDER).toPandas()
    assert len(found) == read(spark, FOLDER, "documents").count()
    assert found.held_out.tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]
    assert found.score.between(0, 1).all()
    assert ((found.score >= 0.5) == (found.predicted == 1)).all()
    both = found.merge(read(spark, FOLDER, "labels").toPandas(), on="doc_id")
    held = both[both.held_out]
    assert (held.predicted == held.toxic).mean() > 0.95
    assert (held[held.toxic == 1].predicted == 1).mean() > 0.8
    assert (held[held.toxic == 0].predicted == 0).mean() > 0.96


@pytest.mark.parametrize("rows", [[], [(1, "some text"), (1, "some text"), (2, None), (None, "")]])
def test_small_and_odd_tables(spark, documents, rows):
    docs = documents(rows)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 0)], "doc_id long, toxic int")
    machine = tox.fit_on(docs, labels.limit(len(rows)))
    found = tox.score(docs, machine)
    assert found.columns == [*docs.columns, "score"]
    scores = [r.score for r in found.collect()]
    assert len(scores) == len(rows) and all(0 <= s < 0.5 for s in scores)
