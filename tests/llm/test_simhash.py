import random

import xxhash
from helpers import awkward, empty, words

from swingframe.llm import simhash


def plain_fingerprint(text):
    w = words(text)
    parts = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in parts]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(rows, reach=4):
    """Smallest reachable id by comparing all pairs of fingerprints."""
    different = sorted({fp for _, fp in rows})
    root = {fp: fp for fp in different}

    def find(fp):
        while root[fp] != fp:
            fp = root[fp]
        return fp

    for i, a in enumerate(different):
        for b in different[:i]:
            if (a ^ b).bit_count() <= reach:
                root[find(a)] = find(b)
    least = {}
    for i, fp in rows:
        if i is not None:
            least[find(fp)] = min(least.get(find(fp), i), i)
    return [(i, f"{fp:016x}", least.get(find(fp))) for i, fp in rows]


def test_fingerprints_and_components_of_awkward_rows(spark):
    draw = random.Random(1)
    texts = []
    for _ in range(12):
        base = [f"w{draw.randrange(900)}" for _ in range(300)]
        for _ in range(5):
            copy = list(base)
            for _ in range(draw.choice([0, 1, 2, 4])):
                copy[draw.randrange(len(copy))] = "Other"
            texts.append("  ".join(copy) + "\n")
    docs = awkward(spark, [(100 + k, t) for k, t in enumerate(texts)])
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_components(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain_components(rows)))
    assert simhash.near_components(empty(spark)).count() == 0


def drawn(spark, count=3000, centres=6, seed=5):
    """Balls of linked fingerprints, one of them with a third of all, spread ones, and a chain."""
    draw = random.Random(seed)
    found = {draw.getrandbits(64) for _ in range(count // 3)}
    for k in range(centres):
        centre = draw.getrandbits(64)
        for _ in range(count // 3 if k == 0 else count // 30):
            fp = centre
            for _ in range(draw.randrange(9)):
                fp ^= 1 << draw.randrange(64)
            found.add(fp)
    fp = draw.getrandbits(64)
    for k in range(16):
        fp ^= 0b1111 << (4 * k)
        found.add(fp)
    return sorted(found)


def test_components_of_hot_places_are_those_of_all_pairs(spark):
    different = drawn(spark)
    nodes = spark.createDataFrame([(simhash.signed(fp),) for fp in different], "fp long")
    got = {r.fp: r.component for r in simhash.connected(nodes).collect()}
    want = plain_components([(k, fp) for k, fp in enumerate(different)])
    classes, expected = {}, {}
    for (k, _, component), fp in zip(want, different):
        expected.setdefault(component, set()).add(fp)
        classes.setdefault(got.get(simhash.signed(fp), simhash.signed(fp)), set()).add(fp)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, expected.values()))
    assert max(map(len, expected.values())) > 500


def test_more_blocks_find_the_same(spark, monkeypatch):
    different = drawn(spark, 600, 3, 8)
    nodes = spark.createDataFrame([(simhash.signed(fp),) for fp in different], "fp long")
    few = {(r.fp, r.component) for r in simhash.connected(nodes).collect()}
    monkeypatch.setattr(simhash, "FEWEST_BLOCKS", 8)
    assert few and {(r.fp, r.component) for r in simhash.connected(nodes).collect()} == few


def test_reference_distances_bound_the_distance(spark):
    draw = random.Random(3)
    assert {(simhash.walsh(a) ^ simhash.walsh(b)).bit_count() for a in range(17) for b in range(a)} == {32}
    pairs = []
    for _ in range(300):
        x = y = draw.getrandbits(64)
        for bit in draw.sample(range(64), draw.choice([0, 1, 4, 5, 9, 20])):
            y ^= 1 << bit
        pairs.append((simhash.signed(x), simhash.signed(y), (x ^ y).bit_count()))
    frame = spark.createDataFrame(pairs, "x long, y long, far int")
    for side in "xy":
        frame = frame.select("*", *(c.alias(f"{side}t{k}") for k, c in enumerate(simhash.distances(side))))
    rows = frame.withColumn("held", simhash.within("xt", "yt")).collect()
    assert all(r.held for r in rows if r.far <= 4) and sum(not r.held for r in rows) > 40


def test_blocks_grow_with_the_number_of_fingerprints():
    assert simhash.blocks_for(10 ** 5) == 6 and simhash.blocks_for(10 ** 8) > 6
    assert simhash.blocks_for(10 ** 10) >= simhash.blocks_for(10 ** 8)


def test_extra_columns_and_hot_texts(spark):
    docs = spark.range(900).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'one hot text of five words', CONCAT('t', id)) AS text",
                                       "id AS fp", "id AS place", "id AS component_id")
    got = simhash.near_components(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.filter("component_id = 0 AND doc_id % 3 = 0").count() == 300


def test_members_of_places_are_not_broadcast(spark, monkeypatch):
    """They are many times the fingerprints by whose file Spark sizes them."""
    plans, written = {}, simhash.written

    def noted(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return written(df, name)

    monkeypatch.setattr(simhash, "written", noted)
    docs = spark.range(60).selectExpr("id AS doc_id", "CONCAT('text ', id DIV 2, ' has some more words ', id) AS text")
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_components(docs).collect()]
    assert sorted(got) == sorted(plain_components(rows))
    assert "Generate" in plans["simhash-members"] and "Broadcast" not in plans["simhash-members"]
