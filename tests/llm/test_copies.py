import hashlib
import random

import numpy as np
import pyarrow as pa
from helpers import BLANK, awkward, empty, probability_jaccard, shingle_weights

from swingframe.llm import exact, graph, near


def test_exact_groups_of_awkward_rows(spark):
    docs = awkward(spark)
    got = exact.exact_groups(docs).collect()
    rows = [(r.doc_id, BLANK.sub(" ", r.text or "")) for r in docs.collect()]
    assert len(got) == len(rows)
    groups = {}
    for i, text in rows:
        groups.setdefault(hashlib.sha256(text.encode()).hexdigest(), []).append(i)
    for r in got:
        ids = groups[r.text_sha256]
        named = [i for i in ids if i is not None]
        assert (r.keep_id, r.group_size) == (min(named) if named else None, len(ids))
        assert not r.kept or r.doc_id == r.keep_id
    assert sum(r.kept for r in got) == len(groups)
    left = exact.drop_copies(docs)
    assert left.columns == docs.columns and left.count() == len(groups)
    assert exact.exact_groups(empty(spark)).count() == 0 and exact.drop_copies(empty(spark)).count() == 0


def test_a_hot_group_is_spread_over_runs(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS text")
    leaf = exact.leaves(docs, 2)
    most = leaf.groupBy("run", "sha").count().agg({"count": "max"}).first()[0]
    assert most < 60
    hot = exact.exact_groups(docs).filter("group_size > 1")
    assert {(r.keep_id, r.group_size) for r in hot.collect()} == {(0, 1000)}


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(5, 5)]
    got = {r.u: r.root for r in graph.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(got[k] == 0 for k in range(1, 41)) and all(got[k] == 100 for k in range(101, 130))


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(2)
    shared = rng.integers(1, 1 << 48, 300).astype(np.uint64)
    a = np.unique(np.concatenate([shared, rng.integers(1, 1 << 48, 60).astype(np.uint64)]))
    b = np.unique(np.concatenate([shared, rng.integers(1, 1 << 48, 40).astype(np.uint64)]))
    wa, wb = 1 + rng.random(len(a)), 1 + rng.random(len(b))
    won = near.registers(np.concatenate([np.zeros(len(a), int), np.ones(len(b), int)]), np.concatenate([a, b]), np.concatenate([wa, wb]), 2)
    true = near.similarity((a, wa), (b, wb))
    assert abs((won[0] == won[1]).mean() - true) < 0.09
    x, y = dict(zip(a.tolist(), wa)), dict(zip(b.tolist(), wb))
    assert abs(true - probability_jaccard(x, y)) < 1e-9


def test_one_shingle_fills_every_register():
    won = near.registers(np.array([0]), np.array([7], np.uint64), np.array([1.0]), 1)
    assert (won == 7).all()


def test_similarity_of_texts():
    a, b = "one two three four five six seven eight nine ten", "One two three four five six seven eight nine eleven"
    sets = list(near.weighted_sets(pa.array([a, b, "", None, "x y"])))
    assert abs(near.similarity(sets[0], sets[1]) - probability_jaccard(shingle_weights(a), shingle_weights(b))) < 1e-12
    assert near.similarity(sets[2], sets[3]) == 1.0 and near.similarity(sets[2], sets[4]) == 0.0


def planted(seed=4):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(4000)]
    texts = []
    for _ in range(6):
        base = [draw.choice(vocabulary) for _ in range(200)]
        for _ in range(7):
            copy = list(base)
            for _ in range(draw.choice([0, 1, 2, 3, 6])):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [" ".join(draw.choice(vocabulary) for _ in range(150)) for _ in range(20)]
    return texts


def test_near_classes_are_the_components_of_all_similar_pairs(spark):
    texts = planted()
    docs = awkward(spark, [(100 + k, t) for k, t in enumerate(texts)])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = [shingle_weights(t) if len(t or "") < 50000 else {t: 1.0} for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if probability_jaccard(sets[i], sets[j]) >= 0.8:
                root[max(find(i), find(j))] = min(find(i), find(j))
    classes = {}
    for k, (i, _) in enumerate(rows):
        classes.setdefault(find(k), []).append(i)
    want = sorted((min((i for i in ids if i is not None), default=None) or -1, len(ids)) for ids in classes.values())
    got = near.near_classes(docs).collect()
    assert len(got) == len(rows)
    assert sorted((r.class_id or -1, r.class_size) for r in got if r.kept) == want
    left = near.drop_near_copies(docs)
    assert left.columns == docs.columns and left.count() == len(classes)


def test_near_classes_of_nothing(spark):
    assert near.near_classes(empty(spark)).count() == 0
    alone = spark.createDataFrame([(1, "just one text here today")], "doc_id long, text string")
    assert [(r.class_id, r.kept) for r in near.near_classes(alone).collect()] == [(1, True)]


def test_components_end_as_soon_as_they_are_stars(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(graph, "written", lambda df, name, keep=graph.written: rounds.append(name) or keep(df, name))
    star = spark.createDataFrame([(1, 5), (7, 1), (5, 1), (2, 9), (3, 3)], "u long, v long")
    assert {r.u: r.root for r in graph.components(star).collect()} == {5: 1, 7: 1, 9: 2} and not rounds
    middle = spark.createDataFrame([(1, 5), (5, 8), (4, 9), (3, 9)], "u long, v long")
    assert {r.u: r.root for r in graph.components(middle).collect()} == {5: 1, 8: 1, 9: 3, 4: 3} and 1 <= len(rounds) <= 2
