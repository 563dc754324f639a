import base64
import hashlib
import io
import random
import zipfile

import numpy as np
from helpers import awkward, empty
from pyspark.sql import functions as F

from swingframe.llm import mixing, neighbours, warc


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 24))
    x[300:420] = x[300]  # one vector many times
    rows = [(k, v.tolist(), "e") for k, v in enumerate(x)]
    rows += [(2000, None, "e"), (2050, [], "e"), (2100, [0.0] * 24, "e"), (2150, [float("nan")] + [1.0] * 23, "e"),
             (2200, [None] + [1.0] * 23, "e"), (2250, [float("inf")] + [1.0] * 23, "e"), (2300, [1.0, 2.0], "e"), (None, [1.0] * 24, "e")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string")
    got = {}
    for r in neighbours.nearest(table, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    assert sorted(got) == list(range(0, 900, 50))
    hit = whole = 0
    for q, found in got.items():
        score = unit @ unit[q]
        score[q] = -9
        want = np.lexsort((np.arange(900), -score.round(12)))[:5]
        hit, whole = hit + len(set(want) & {found[k][0] for k in found}), whole + 5
        for vec, value in found.values():
            assert abs(value - score[vec]) < 1e-12
    assert hit / whole >= 0.95
    assert [got[300][k][0] for k in range(1, 6)] == [301, 302, 303, 304, 305]


def test_few_vectors_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [2.0, 0.0])], schema)
    got = [(r.rank, r.vec_id, round(r.score, 6)) for r in neighbours.nearest(few, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(1, 2, 1.0), (2, 1, 0.707107)]
    assert neighbours.nearest(few.limit(0), F.col("vec_id") == 0).count() == 0
    assert neighbours.nearest(few, F.col("vec_id") == 77).count() == 0


def test_upper_bounds_hold_for_most_pairs():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    coder = neighbours.Coder(x[:300])
    guess, high = coder.estimates(coder.encode(x), x[:40])
    true = x @ x[:40].T
    assert (true <= high).mean() > 0.98 and abs((guess - true).mean()) < 0.01


def test_pages_come_back_from_packages(spark):
    rows = [(k, f"http://h/{k}", f"<p>{k % 7}é</p>") for k in range(60)] + [
        (100, None, None), (101, "a b\r\nc", ""), (102, "u", "x" * 300000), (103, "u", "x" * 300000), (103, "u", "x" * 300000), (None, "u", "<p>1é</p>")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, best string")
    got = warc.read_records(warc.write_pages(pages)).collect()
    largest = {}
    for i, _, html in rows:
        largest[html or ""] = max(largest.get(html or "", -1), -1 if i is None else i)
    want = []
    for i, _, html in rows:
        raw, best = (html or "").encode(), largest[html or ""]
        want.append((-1 if i is None else i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     "response" if i == best else "revisit", -1 if i == best else best))
    assert sorted((-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.record_type,
                   -1 if r.refers_to is None else r.refers_to) for r in got) == sorted(want)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert warc.read_records(warc.write_pages(pages.limit(0))).count() == 0
    short = warc.read_records(warc.write_pages(pages, least=100)).filter("record_type = 'revisit'").collect()
    assert {r.page_id for r in short} == {102}


def test_package_directories_with_and_without_zip64():
    sink = io.BytesIO()
    assert warc.write_package(sink, iter([("a", b"one"), ("b", b"two" * 50)])) == 2
    package = warc.Package(sink, len(sink.getvalue()))
    with zipfile.ZipFile(sink) as plain:
        for name in (warc.ARCHIVE, warc.INDEX):
            at, size = package.place(name)
            assert package.range(at, size) == plain.read(name)
    many = io.BytesIO()
    with zipfile.ZipFile(many, "w", zipfile.ZIP_STORED) as plain:  # more members than the short directory can count
        for k in range(66000):
            plain.writestr(str(k), b"")
        plain.writestr("last", b"here")
        plain.comment = b"note"
    package = warc.Package(many, len(many.getvalue()))
    at, size = package.place("last")
    assert len(package.members) == 66001 and package.range(at, size) == b"here"


def labelled_corpus(spark):
    draw = random.Random(2)
    rows, labels = [], []
    for k in range(400):
        kind = draw.choices(["a", "b", "c"], [0.6, 0.3, 0.1])[0]
        mixed = draw.random() < 0.2
        words = [draw.choice("abc" if mixed else kind) + str(draw.randint(0, 30)) for _ in range(draw.randint(3, 80))]
        rows.append((k, " ".join(words)))
        if k % 2:
            labels.append((k, kind))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, domain string")


def nonnegative_least_squares(tokens, p, wanted, floor):
    """Plain projected gradient over all documents, many small steps."""
    rate, total = np.ones(len(tokens)), tokens.sum()
    mass = (tokens[:, None] * p * p).sum(axis=0) / total
    for _ in range(20000):
        miss = (rate * tokens) @ p / total - wanted
        rate = np.maximum(floor, rate - 0.3 * p @ (miss / mass))
    return rate


def test_rates_meet_targets_and_equal_plain_projected_gradient(spark):
    docs, labels = labelled_corpus(spark)
    targets = {"a": 0.3, "b": 0.3, "c": 0.4}
    rows = mixing.mixture(docs, labels, targets).toPandas()
    p, tokens = rows[["p_a", "p_b", "p_c"]].to_numpy(), rows["n_tokens"].to_numpy(float)
    assert np.allclose(p.sum(axis=1), 1) and rows["converged"].all()
    got = (rows["rate"].to_numpy() * tokens) @ p / tokens.sum()
    want = nonnegative_least_squares(tokens, p, np.array(list(targets.values())), 0.0)
    assert np.abs(got - (want * tokens) @ p / tokens.sum()).max() < 5e-4
    assert np.abs(got - list(targets.values())).max() < 5e-4 and rows["rate"].min() >= 0
    assert (np.abs(rows["copies"] - rows["rate"]) < 1).all()


def test_floor_keeps_every_document(spark):
    docs, labels = labelled_corpus(spark)
    left = mixing.mixed(docs, labels, {"a": 0.4, "b": 0.3, "c": 0.3})
    assert left.columns == docs.columns and left.select("doc_id").distinct().count() == 400 and left.count() > 400


def test_out_of_reach_and_awkward_mixes(spark):
    docs, labels = labelled_corpus(spark)
    rows = mixing.mixture(docs, labels, {"a": 0.5, "b": 0.3, "nowhere": 0.2}).toPandas()
    assert len(rows) == 400 and rows["residual"].max() > 0.1 and (rows["p_nowhere"] == 0).all()
    odd = awkward(spark)
    got = mixing.mixture(odd, spark.createDataFrame([(1, "a"), (6, "b"), (None, "b"), (8, None)], "doc_id long, domain string"), {"a": 0.5, "b": 0.5})
    assert got.count() == odd.count() and got.filter("n_tokens = 0 AND rate <> 1").count() == 0
    none = labels.limit(0)
    assert mixing.mixture(odd, none, {"a": 0.5, "b": 0.5}).count() == odd.count()
    assert mixing.mixture(empty(spark), none, {"a": 1.0}).count() == 0
    assert mixing.mixed(odd, none, {"a": 0.5, "b": 0.5}).columns == odd.columns
