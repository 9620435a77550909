import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from learnsilver.llm import permuterm_variants as permuterm
from learnsilver.llm.queries import op13_permuterm_variants


def near(a, b):
    """Whether one edit makes one word of the other."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    n = {word: count for word, count in counts.items() if len(word) >= 5 and count >= 3}
    out, form = [], {}
    others = {word: [o for o in n if near(word, o)] for word in n}
    for word in n:
        best = min(others[word], key=lambda o: (-n[o], o), default=None)
        form[word] = best if best is not None and n[best] >= 2 * n[word] else None
    for word in n:
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, form[word], root, n[word], len(others[word]), n.get(form[word])))
    return set(out)


def check(documents, rows):
    found = [tuple(r) for r in permuterm.variants(documents(rows)).collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute(rows)
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_all_pairs_of_words_of_few_letters(documents, seed):
    """Runs of equal letters, ties and chains of forms."""
    rng = random.Random(seed)
    words = ["".join(p) for size in (4, 5, 6) for p in itertools.product("aàb", repeat=size)]
    words = rng.sample(words, 300)
    texts = [" ".join(w for w in words for _ in range(int(rng.paretovariate(0.7)) % 90)) for _ in range(6)]
    found = check(documents, list(enumerate(texts)))
    assert any(r[1] and r[2] != r[1] for r in found)


def test_deleted_code_points_and_odd_letters(documents):
    """``×`` and ``÷`` are in the range, ``ß`` and ``Ÿ`` stand at and beyond its ends; large Umlauts stay large."""
    rng = random.Random(3)
    words = ["straße", "Übergang", "übergang", "a×b÷c", "naïveté", "naïvete", "noŸend", "ÿÀÿÀÿ", "hello"]
    texts = [(i, " ".join(rng.choices(words, k=40))) for i in range(200)]
    found = check(documents, texts)
    assert {"Übergang", "übergang", "a×b÷c", "ÿÀÿÀÿ"} <= {r[0] for r in found}
    assert any(len(r[0]) == 5 and r[0] != "hello" for r in found)


def test_odd_rows(documents):
    assert check(documents, []) == []
    assert check(documents, [(1, None), (2, ""), (3, " 12, ... ")]) == []
    long = ("variant " * 50_000 + "varient " * 3) + "z" * 100_000
    assert len(check(documents, [(None, "HOUSE house mouse"), (None, "mouse mouse House"), (5, long), (5, long)])) == 4


def test_whole_query_against_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = [tuple(r) for r in op13_permuterm_variants(spark, folder).collect()]
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet'")
        wanted = db.sql(permuterm.ORACLE_SQL).fetchall()
    assert len(found) == len(wanted) and set(found) == set(wanted)
    assert sum(r[1] is not None for r in found) > 20
