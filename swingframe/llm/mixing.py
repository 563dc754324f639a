"""Mixing documents to target weights of domains they only partly belong to.

A classifier trained on a labelled table gives every document a posterior over domains
(multinomial over BUCKETS hashed words; posteriors are tempered by length, so that a long text
is no surer than a text of EVIDENCE words). With t tokens and posterior p, a document at rate r
gives r * t * p[k] expected tokens to domain k. Nonnegative rates are fitted so that the
domains' expected totals match the targets, by projected gradient on

    1/2 * sum_k (sum_d r_d t_d p_dk / T - target_k)**2 / m_k,      r_d >= floor,

m_k = sum_d t_d p_dk**2 / T, which makes the problem well conditioned where few documents are
between domains; started at rate 1 and accelerated. A step needs K totals over all documents and changes a
rate by a combination of K numbers only, so a document's rate is a function of its
posterior and of the steps so far: each iteration is one aggregation over a compact table
(tokens and posterior), nothing is shuffled but partial sums, and the driver holds K numbers.

Only DataFrame expressions run here. Words are exploded, matched with the BUCKETS rows of the
model (a fixed bound, so broadcast) and summed per row before anything is shuffled.

Copies are rate rounded up or down by a hash of the identifier, so that their expectation is
the rate. With floor 1 no document goes; domains short of their target are repeated.

Defined results: null and empty texts have no tokens, the prior as posterior and rate 1.
Repeated rows are rows of their own. Domains without a labelled row get no posterior, and
their target is then out of reach: the fit is the nearest mix, and ``residual`` says how far.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swingframe.llm.store import free_name, written

BUCKETS = 4096
SAMPLE = 20000  # labelled documents that training may see
EVIDENCE = 60.0
STEPS = 200
TOLERANCE = 1e-4  # of all tokens, by domain
TARGETS = {"en": 0.50, "fr": 0.15, "de": 0.15, "es": 0.10, "junk": 0.10}
BLANKS = r"[\x20\x09-\x0D]+"


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and domain of the labelled documents: junk by its label, else the language on record."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = docs.filter("lang IS NOT NULL").groupBy("doc_id").agg(F.min("lang").alias("lang")).join(known, "doc_id")
    return rows.select("doc_id", F.when(F.col("quality") == 0, "junk").otherwise(F.col("lang")).alias("domain"))


def word_rows(rows: DataFrame) -> DataFrame:
    """One row per word of ``text``, with its bucket; a wordless text gives one row with bucket -1."""
    word = F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), BLANKS)).alias("word")
    return rows.withColumn("word", word).drop("text").withColumn(
        "bucket", F.when(F.col("word") == "", -1).otherwise(F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int")))


def train(docs: DataFrame, labelled: DataFrame, domains: list[str], most: int) -> tuple[DataFrame, list[float]]:
    """Log weights by bucket (BUCKETS rows, columns w0, w1, ...) and log priors."""
    count = labelled.filter(F.col("domain").isin(domains)).count()
    share = min(1.0, most / max(count, 1))
    lucky = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    picked = labelled.filter(F.col("domain").isin(domains) & lucky)
    rows = docs.filter(lucky).select("doc_id", "text").join(F.broadcast(picked) if share < 1 else picked, "doc_id")
    seen = word_rows(rows).groupBy("domain", "bucket").agg(F.count("*").alias("n"))
    wide = seen.filter("bucket >= 0").groupBy("bucket").agg(
        *[F.sum(F.when(F.col("domain") == d, F.col("n")).otherwise(0)).alias(f"n{k}") for k, d in enumerate(domains)])
    docs_of = {r["domain"]: r["n"] for r in picked.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    whole = sum(docs_of.values())
    prior = [docs_of.get(d, 0) / whole if whole else 1 / len(domains) for d in domains]
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(wide, "bucket", "left").na.fill(0)
    every = written(every, "mixing-counts")
    totals = every.agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(len(domains))]).first()
    return every.select("bucket", *[
        F.log((F.col(f"n{k}") + 0.5) / (float(totals[k] or 0) + 0.5 * BUCKETS)).alias(f"w{k}") for k in range(len(domains))]), prior


def posteriors(docs: DataFrame, weights: DataFrame, prior: list[float]) -> DataFrame:
    """row, doc_id, tokens and p (an array over the domains) of every row."""
    size = len(prior)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    logs = word_rows(rows).join(F.broadcast(weights), "bucket", "left").groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.sum((F.col("bucket") >= 0).cast("long")).alias("tokens"),
        *[F.sum(F.coalesce(f"w{k}", F.lit(0.0))).alias(f"s{k}") for k in range(size)])
    calm = F.lit(EVIDENCE) / F.greatest(F.col("tokens").cast("double"), F.lit(EVIDENCE))
    live = [k for k in range(size) if prior[k] > 0]
    score = {k: F.log(F.lit(prior[k])) + F.col(f"s{k}") * calm for k in live}
    top = F.greatest(*score.values()) if len(live) > 1 else score[live[0]]
    logs = logs.select("row", "doc_id", "tokens", *[
        (F.exp(score[k] - top) if k in score else F.lit(0.0)).alias(f"e{k}") for k in range(size)])
    whole = sum((F.col(f"e{k}") for k in range(size)), F.lit(0.0))
    return logs.select("row", "doc_id", "tokens", F.array(*[F.col(f"e{k}") / whole for k in range(size)]).alias("p"))


def rate_after(p: Column, path: list[tuple[list[float], float]], floor: float) -> Column:
    """The pair (rate, extrapolated rate) after the steps of ``path``, as a fold over its literals.

    A step is a direction g and a momentum m: r' = max(floor, y - p.g), y' = r' + m * (r' - r)."""
    start = F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("y"))
    if not path:
        return start
    steps = F.from_json(F.lit(json.dumps([{"g": g, "m": m} for g, m in path])), "array<struct<g:array<double>,m:double>>")

    def move(at: Column, step: Column) -> Column:
        shift = F.aggregate(F.zip_with(p, step["g"], lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        after = F.greatest(F.lit(floor), at["y"] - shift)
        # the fold's state is (r', y'); y' needs r' and the former r
        return F.struct(after.alias("r"), (after + step["m"] * (after - at["r"])).alias("y"))

    return F.aggregate(steps, start, move)


def fit(known: DataFrame, targets: list[float], floor: float) -> tuple[list[tuple[list[float], float]], float, bool]:
    """The steps of the fit, the largest miss of a domain's share, and whether it got below TOLERANCE
    or came to rest at the nearest mix."""
    size = len(targets)
    part = [F.element_at("p", k + 1) * F.col("tokens") for k in range(size)]
    sums = known.agg(F.sum("tokens").alias("t"), *[F.sum(x).alias(f"s{k}") for k, x in enumerate(part)], *[
        F.sum(part[i] * F.element_at("p", j + 1)).alias(f"m{i}_{j}") for i in range(size) for j in range(size)]).first()
    total = float(sums["t"] or 0)
    if not total:
        return [], max(targets), False
    share = [sums[f"s{k}"] / total for k in range(size)]
    scale = 1.0
    if floor > 0:  # the smallest total that leaves no domain above its target at the floor, and a little room
        scale = 1.02 * max([floor * s / w for s, w in zip(share, targets) if w > 0], default=1.0)
    wanted = [w * scale for w in targets]
    mass = [sums[f"m{k}_{k}"] / total for k in range(size)]
    scaling = [1 / m if m > 1e-9 else 0.0 for m in mass]  # nobody can serve a domain without mass
    norm = max(sum(sums[f"m{i}_{j}"] for j in range(size)) / total * scaling[i] for i in range(size))
    path: list[tuple[list[float], float]] = []
    speed, before, rest, miss = 1.0, None, 0, max(abs(s - w) for s, w in zip(share, wanted))
    while len(path) < STEPS:
        state = known.select("tokens", "p", rate_after(F.col("p"), path, floor).alias("at"))
        got = state.agg(*[F.sum(F.col("at.y") * x).alias(f"y{k}") for k, x in enumerate(part)],
                        *[F.sum(F.col("at.r") * x).alias(f"r{k}") for k, x in enumerate(part)]).first()
        misses = [got[f"r{k}"] / total - wanted[k] for k in range(size)]
        miss = max(map(abs, misses))
        loss = sum(x * x * c for x, c in zip(misses, scaling))
        if miss < TOLERANCE * scale:
            return path, miss / scale, True
        rest = rest + 1 if before is not None and abs(before - loss) <= 1e-5 * loss else 0
        if rest >= 3:
            return path, miss / scale, True
        if before is not None and loss > before:
            speed = 1.0  # start the momentum anew
        before = loss
        after = (1 + (1 + 4 * speed * speed) ** 0.5) / 2
        path.append(([(got[f"y{k}"] / total - wanted[k]) * scaling[k] / norm for k in range(size)], (speed - 1) / after))
        speed = after
    return path, miss / scale, False


def mixture(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], floor: float = 0.0, most: int = SAMPLE) -> DataFrame:
    """doc_id, n_tokens, p_<domain>, rate, copies, residual and converged of every row of ``docs``.

    labelled: doc_id and domain, a row per labelled document; targets: share of tokens by domain."""
    if not targets or min(targets.values()) < 0 or abs(sum(targets.values()) - 1) > 1e-9:
        raise ValueError("targets must be shares that add up to 1")
    domains = list(targets)
    weights, prior = train(docs, labelled, domains, most)
    known = written(posteriors(docs, weights, prior), "mixing-posteriors")
    path, miss, rested = fit(known, list(targets.values()), floor)
    rate = F.when(F.col("tokens") == 0, 1.0).otherwise(rate_after(F.col("p"), path, floor)["r"])
    luck = F.pmod(F.xxhash64(F.lit(7), "doc_id", "row"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rows = known.withColumn("rate", rate)
    return rows.select(
        "doc_id", F.col("tokens").alias("n_tokens"), *[F.element_at("p", k + 1).alias(f"p_{d}") for k, d in enumerate(domains)],
        "rate", (F.floor("rate") + (luck < F.col("rate") - F.floor("rate")).cast("long")).alias("copies"),
        F.lit(miss).alias("residual"), F.lit(rested).alias("converged"))


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], floor: float = 1.0) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say. Rows that share a doc_id share the
    largest number of copies of any of them."""
    key, times, copy = (free_name(docs.columns, x) for x in ("copied_id", "copies", "copy"))
    copies = mixture(docs, labelled, targets, floor).groupBy("doc_id").agg(F.max("copies").cast("int").alias(times))
    copies = copies.select(F.col("doc_id").alias(key), times)
    rows = docs.join(copies, docs["doc_id"].eqNullSafe(copies[key])).filter(F.col(times) > 0)
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), times))).select(*docs.columns)
