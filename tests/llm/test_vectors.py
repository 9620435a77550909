import math

import numpy as np
import pytest

from learnsilver.llm import permutation_index as index
from learnsilver.llm import sorted_projections as near
from learnsilver.llm.components import components
from learnsilver.llm.queries import op1_sorted_projections, op7_permutation_index
from learnsilver.llm.shared import read

FOLDER = "/root/testdata/sf0.1"
NAN, INF = math.nan, math.inf
SCHEMA = "vec_id long, embedding array<float>, label int, id long, turn string, asks int, copies double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "t", 2, 0.5) for i, v, label in rows], SCHEMA)


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def brute_links(rows):
    """Links of (id, vector, label) rows, by comparing all of them; a row that takes no part has none."""
    able = []
    for place, (i, v, label) in enumerate(rows):
        good = i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
        if good and any(v):
            able.append((place, label, np.float32(v).astype(float)))
    out = []
    for k, (p, label, v) in enumerate(able):
        for q, other, w in able[k + 1 :]:
            if label == other and len(v) == len(w):
                if v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= near.LEAST_COSINE:
                    out.append((p, q))
    return out


def check_links(spark, rows):
    found = near.near_duplicates(frame(spark, rows)).collect()
    linked = brute_links(rows)
    degree = [0] * len(rows)
    for p, q in linked:
        degree[p] += 1
        degree[q] += 1
    ids = [i for i, _, _ in rows]
    component = union([(ids[p], ids[q]) for p, q in linked], {i for i in ids if i is not None})
    wanted = [
        (i, n, None if i is None else component[i], i is not None and component[i] == i)
        for i, n in zip(ids, degree)
    ]
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)


def test_links_with_nulls_ties_copies_and_odd_vectors(spark):
    v, w = [1.0, 2.0, 3.0], [1.0, 2.0, 3.01]
    check_links(spark, [
        (1, v, 0), (2, v, 0), (2, v, 0), (3, w, 0), (4, w, 1), (5, v, None), (None, v, 0), (6, None, 0),
        (7, [], 0), (8, [0.0, 0.0, 0.0], 0), (9, [1.0, None, 3.0], 0), (10, [1.0, NAN, 3.0], 0),
        (11, [1.0, INF, 3.0], 0), (12, [1.0, 2.0], 0), (13, [2.0, 4.0, 6.0], 0), (14, [-1.0, -2.0, -3.0], 0),
        (15, [0.0, -0.0, 1.0], 2), (16, [-0.0, 0.0, 2.0], 2),
    ])
    assert near.near_duplicates(frame(spark, [])).count() == 0


def test_a_dense_group_wider_than_all_windows_keeps_its_links(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_ROWS", 64)
    chance = np.random.default_rng(1)
    centre = chance.normal(size=16)
    group = [(i, (centre + chance.normal(size=16) * 0.12).tolist(), 3) for i in range(300)]
    others = [(1000 + i, chance.normal(size=16).tolist(), 3) for i in range(200)]
    check_links(spark, group + others)


def test_borders_between_sorted_parts(spark, monkeypatch):
    monkeypatch.setattr(near, "PART_ROWS", 100)
    monkeypatch.setattr(near, "PASSES", 6)
    chance = np.random.default_rng(2)
    rows = []
    for i in range(150):
        v = chance.normal(size=24)
        rows += [(2 * i, v.tolist(), i % 2), (2 * i + 1, (v + chance.normal(size=24) * 0.1).tolist(), i % 2)]
    check_links(spark, rows)


def test_passes_follow_the_rows_so_that_few_pairs_are_missed():
    chance = np.random.default_rng(7)
    n, pairs = 200_000, 2_000
    rows = chance.normal(size=(n, 64))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    one, off = rows[:pairs], chance.normal(size=(pairs, 64))
    off -= (off * one).sum(1, keepdims=True) * one
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    rows[pairs : 2 * pairs] = near.LEAST_COSINE * one + math.sqrt(1 - near.LEAST_COSINE**2) * off
    met = np.zeros(pairs, dtype=bool)
    for turn in range(near.passes(n)):
        place = np.argsort(np.argsort(near.signatures(rows, turn), kind="stable"))
        met |= np.abs(place[:pairs] - place[pairs : 2 * pairs]) <= near.WINDOW
    assert met.mean() >= 0.985
    assert near.passes(0) == near.passes(near.WINDOW) == near.PASSES < near.passes(n) < near.passes(10**9)


def test_more_passes_are_run_where_a_label_needs_them(spark, monkeypatch):
    monkeypatch.setattr(near, "PASSES", 1)
    monkeypatch.setattr(near, "WINDOW", 2)
    chance = np.random.default_rng(8)
    rows = []
    for i in range(400):
        v = chance.normal(size=24)
        rows += [(2 * i, v.tolist(), 0), (2 * i + 1, (v + chance.normal(size=24) * 0.2).tolist(), 0)]
    found = near.near_duplicates(frame(spark, rows)).collect()
    assert sum(r.n_links for r in found) >= 0.97 * 2 * len(brute_links(rows))


def test_whole_table_with_near_copies_against_all_pairs(spark):
    table = read(spark, FOLDER, "embeddings").toPandas()[["vec_id", "embedding", "label"]]
    chance = np.random.default_rng(4)
    copies = table.iloc[::4].assign(vec_id=lambda t: t.vec_id + 100_000)
    copies["embedding"] = [v + chance.normal(size=len(v)) * 0.035 for v in copies.embedding]
    ids = [*table.vec_id, *copies.vec_id]
    label = np.array([*table.label, *copies.label])
    units = np.stack([*table.embedding, *copies.embedding]).astype(np.float32).astype(float)
    rows = list(zip(ids, units.tolist(), label.tolist()))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    linked = (units @ units.T >= near.LEAST_COSINE) & (label[:, None] == label)
    np.fill_diagonal(linked, False)
    found = near.near_duplicates(frame(spark, rows)).toPandas().set_index("vec_id").loc[ids]
    assert len(found) == len(rows) and linked.sum() > 500
    assert found.n_links.sum() >= 0.99 * linked.sum()
    assert (found.n_links.to_numpy() <= linked.sum(1)).all()
    component = union([(ids[p], ids[q]) for p, q in zip(*np.nonzero(linked))], ids)
    assert (found.component_id == [component[i] for i in ids]).mean() > 0.99


def test_the_query_has_a_row_for_every_vector(spark):
    found = op1_sorted_projections(spark, FOLDER)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert found.count() == read(spark, FOLDER, "embeddings").count()


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    chance = np.random.default_rng(seed)
    pairs = [tuple(map(int, p)) for p in chance.integers(0, 90, (60, 2))]
    pairs += [(i + 100, i + 101) for i in range(40)] + [(7, 7), pairs[0]]
    table = spark.createDataFrame([*pairs, (None, 3)], "a long, b long")
    found = {r.node: r.component for r in components(table).collect()}
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    assert found == union([p for p in pairs if p[0] != p[1]], nodes)


def test_no_components(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_footrule_against_its_definition():
    chance = np.random.default_rng(3)
    orders = np.stack([chance.permutation(12)[:5] for _ in range(30)])
    files = index.inverted_files(orders, 12)
    for query in orders[:4]:
        place = {p: k for k, p in enumerate(query)}
        for row, far in zip(orders, index.footrules(query, files, 30)):
            own = {p: k for k, p in enumerate(row)}
            assert far == sum(abs(place.get(p, 5) - own.get(p, 5)) for p in place.keys() | own.keys())


def brute_nearest(rows, query):
    (own,) = {tuple(v) for i, v in rows if i == query}
    scored = {(i, float(np.dot(np.array(v, float), np.array(own, float)))) for i, v in rows if i != query}
    return sorted(scored, key=lambda pair: (-pair[1], pair[0]))[: index.NEIGHBOURS]


def test_recall_of_the_whole_search(spark):
    table = read(spark, FOLDER, "embeddings").toPandas()
    found = op7_permutation_index(spark, FOLDER).toPandas()
    queries = sorted(i for i in table.vec_id if i % 20 == 0)
    assert sorted(set(found.query_id)) == queries
    hits = 0
    rows = list(zip(table.vec_id.tolist(), table.embedding))
    exact = dict(rows)
    for query, some in found.groupby("query_id"):
        assert sorted(some["rank"]) == list(range(1, 21)) and query not in set(some.vec_id)
        some = some.sort_values("rank")
        assert list(zip(-some.score, some.vec_id)) == sorted(zip(-some.score, some.vec_id))
        for i, score in zip(some.vec_id, some.score):
            product = np.dot(np.array(exact[i], float), np.array(exact[query], float))
            assert score == pytest.approx(product, abs=1e-12)
        hits += len(set(some.vec_id) & {i for i, _ in brute_nearest(rows, query)})
    assert hits / len(found) >= 0.93


def test_search_with_nulls_ties_copies_and_few_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (0, v, 1), (0, v, 1), (1, v, 1), (2, v, 2), (3, [2.0, 4.0, 6.0], None), (4, [-1.0, 0.0, 0.0], 1),
        (None, v, 1), (6, None, 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 1.0], 1), (9, [1.0, NAN, 1.0], 1),
        (10, [1.0, 2.0], 1), (20, v, 1), (40, None, 1),
    ]
    import pyspark.sql.functions as F

    found = index.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    able = [(i, x) for i, x, _ in rows if i in (0, 1, 2, 3, 4, 20)]
    assert got == {q: brute_nearest(able, q) for q in (0, 20)}
    assert index.nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("spread", [0.5, 1.0])
def test_recall_where_norms_differ(spark, spread):
    import pyspark.sql.functions as F

    chance = np.random.default_rng(9)
    vectors = chance.normal(size=(6_000, 64))
    vectors *= np.exp(chance.normal(size=(6_000, 1)) * spread) / np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = vectors.astype(np.float32).astype(float)
    rows = [(i, v, 0) for i, v in enumerate(vectors.tolist())]
    found = index.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0).toPandas()
    assert len(found) == 120 * index.NEIGHBOURS
    hits = 0
    for query, some in found.groupby("query_id"):
        scores = vectors @ vectors[query]
        scores[query] = -np.inf
        hits += len(set(some.vec_id) & set(np.argsort(-scores)[: index.NEIGHBOURS]))
    assert hits / len(found) >= 0.95


def test_queries_of_every_length_are_answered(spark):
    import pyspark.sql.functions as F

    chance = np.random.default_rng(10)
    sizes = {i: 3 if i < 600 else 2 if i < 630 else 5 for i in range(631)}
    rows = [(i, chance.integers(-9, 9, size).astype(float).tolist(), 0) for i, size in sizes.items()]
    rows = [(i, [1.0, *v[1:]], label) for i, v, label in rows]
    found = index.nearest(frame(spark, rows), F.col("vec_id").isin(5, 605, 610, 630)).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {5, 605, 610}
    for query in (605, 610):
        assert got[query] == brute_nearest([(i, v) for i, v, _ in rows if len(v) == 2], query)
    assert all(sizes[i] == 3 for i, _ in got[5]) and len(got[5]) == index.NEIGHBOURS


@pytest.mark.parametrize("kind, labels", [
    ("string", ["x", "x", "y", "", None]), ("double", [1.2, 1.2, 1.9, -0.0, 0.0]), ("boolean", [True, True, False, False, None]),
])
def test_labels_of_other_types_are_equal_or_not(spark, kind, labels):
    vectors = [(k, [1.0, 2.0, 3.0 + k / 1000], label) for k, label in enumerate(labels)]
    found = near.near_duplicates(spark.createDataFrame(vectors, f"vec_id long, embedding array<double>, label {kind}"))
    linked = [
        sum(a is not None and a == b for j, b in enumerate(labels) if j != k) for k, a in enumerate(labels)
    ]
    assert [r.n_links for r in found.orderBy("vec_id").collect()] == linked
