import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from learnsilver.llm import signed_fingerprints as signed
from learnsilver.llm.queries import op12_signed_fingerprints
from learnsilver.llm.shared import hashed_words, mixed, read


def agree(a, b):
    return 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128


def plain_fingerprint(text):
    """By a vote for every bit and term, one at a time."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return "0" * 32
    counts = {}
    lane = np.array([hashed_words(word)[1][0] for word in words])
    single = np.stack([lane, mixed(lane * signed._FIRST[0] + signed._SECOND[0])], axis=1)
    pairs = mixed(single[:-1] * signed._FIRST + single[1:] * signed._SECOND)
    for term in [r.tobytes() for r in single] + [r.tobytes() for r in pairs]:
        counts[term] = counts.get(term, 0) + 1
    votes = [0] * 128
    for term, count in counts.items():
        value = int.from_bytes(term, "big")
        for bit in range(128):
            votes[bit] += count.bit_length() * (1 if value >> (127 - bit) & 1 else -1)
    return "".join(f"{int(''.join('1' if v > 0 else '0' for v in votes[k : k + 8]), 2):02x}" for k in range(0, 128, 8))


def brute(rows, asks=lambda i: i is not None and i % 50 == 0):
    """Of (id, text) rows in falling order of ids, what the query returns."""
    rows = [(i, t or "") for i, t in rows]
    prints = [plain_fingerprint(t) for _, t in rows]
    out = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        close = sum(agree(prints[k], p) >= 1 - signed.RADIUS / 128 for p in prints) - 1
        out.append((
            i, len(text), hashlib.sha256(changed.encode()).hexdigest(), prints[k], plain_fingerprint(changed),
            agree(prints[k], plain_fingerprint(changed)), agree(prints[k], prints[(k + 1) % len(rows)]),
            close if asks(i) else None,
        ))
    return sorted(out, key=str)


def run(frame):
    return sorted(map(tuple, signed.fingerprints(frame, F.col("doc_id") % 50 == 0).collect()), key=str)


def test_whole_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = read(spark, folder, "documents").orderBy(F.desc("doc_id")).collect()
    found = sorted(map(tuple, op12_signed_fingerprints(spark, folder).collect()), key=str)
    assert found == brute([(r.doc_id, r.text) for r in docs])
    # Half of the edited text is the document's, little of the next one is.
    assert sum(r[5] > r[6] for r in found) > 0.95 * len(found)


@pytest.mark.parametrize("parts", [1, 7])
def test_many_ranges(spark, documents, parts):
    """The order does not hang on how rows lie; copies and near copies are counted."""
    rng = random.Random(parts)
    base = " ".join(f"w{rng.randrange(999)}" for _ in range(400))
    rows = [(10 * k, rng.choice([base, base + " tail", base.replace("w1", "v1", 1), f"other {k}"])) for k in range(300)]
    frame = documents(rng.sample(rows, len(rows))).repartition(parts)
    found = run(frame)
    assert found == brute(rows[::-1])
    assert max(r[7] or 0 for r in found) > 150


def test_radius_is_exact(spark):
    rng = random.Random(5)
    prints = set()
    for _ in range(30):
        centre = rng.getrandbits(128)
        for flips in range(8):
            value = centre
            for bit in rng.sample(range(128), flips):
                value ^= 1 << bit
            prints.add(value)
    halves = [tuple((v >> s & 2**64 - 1) - (v >> s + 63 & 1) * 2**64 for s in (64, 0)) for v in prints]
    frame = spark.createDataFrame(halves, "f0 long, f1 long")
    for radius in (0, 3, 5):
        met = [tuple(r) for r in signed.within(frame, frame, radius).select("q0", "q1", "f0", "f1").collect()]
        wanted = {(*p, *q) for p, a in zip(halves, prints) for q, b in zip(halves, prints) if (a ^ b).bit_count() <= radius}
        assert len(met) == len(wanted) and set(met) == wanted
    with pytest.raises(ValueError):
        signed.within(frame, frame, 6)


def test_odd_rows(documents):
    assert run(documents([])) == []
    assert run(documents([(50, "all alone here")])) == brute([(50, "all alone here")])
    long = "words and more " * 100_000
    rows = [(200, long), (150, "é\t"), (150, ""), (100, None), (50, " \n "), (7, "x"), (None, "a b c d")]
    ties = [brute(rows), brute([rows[0], rows[2], rows[1], *rows[3:]])]
    found = run(documents(rows))
    assert found in ties and found == run(documents(rows[::-1]))
    assert [r[3] for r in found if r[1] == 0] == ["0" * 32] * 2
