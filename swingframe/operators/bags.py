"""Player bags: selections, reported statistics and reference scaling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swingframe import constants as K
from swingframe.functions import cleaning as C
from swingframe.functions import units as U
from swingframe.operators.joins import lookup
from swingframe.operators.quantiles import (
    exact_median,
    exact_percentiles,
    ordinal_rank,
    value_counts,
)
from swingframe.session import written

CLUB_KEYS = ["source", "player", "club"]
LAUNCH_SI = ["ball_speed_ms", "launch_angle_rad", "launch_direction_rad", "spin_rate_rad_s", "spin_axis_rad"]


# ---- row selections -----------------------------------------------------
def launch_ready(shots: DataFrame) -> DataFrame:
    """Shots with the three launch inputs."""
    return shots.dropna(subset=["ball_speed_mph", "launch_angle_deg", "spin_rate_rpm"])


def hash_sample(df: DataFrame, key: str, one_in: int = 20) -> DataFrame:
    """A repeatable 1-in-n sample by the key's md5."""
    bucket = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % one_in
    return df.where(bucket == 0)


def driver_band(facts: DataFrame) -> DataFrame:
    """Measured radar drives inside plausible launch bands, sampled 1 in 20."""
    band = facts.where(
        (F.col("source") == "trackman") & (F.col("carry_method") == "measured")
        & F.col("carry_yards").isNotNull() & F.col("ball_speed_mph").between(130, 175)
        & F.col("spin_rate_rpm").between(1500, 4000) & F.col("launch_angle_deg").between(7, 18)
    )
    return hash_sample(band, "shot_id")


def player_shots(shots: DataFrame, source: str, player: str) -> DataFrame:
    """One player's launch-ready shots; the two values are bound, never spliced into SQL."""
    return launch_ready(shots).where((F.col("source") == F.lit(source)) & (F.col("player") == F.lit(player)))


def to_si(shots: DataFrame) -> DataFrame:
    """Launch records in m/s, radians and rad/s; missing axis and direction are 0."""
    ready = shots.select(
        "shot_id", "source", "player", "club",
        *[F.nanvl(F.col(c), C.null_of("double")).alias(c) for c in K.MEASURES])
    return launch_ready(ready).select(
        "shot_id", "source", "player", "club",
        U.ms_from_mph(F.col("ball_speed_mph")).alias("ball_speed_ms"),
        F.radians("launch_angle_deg").alias("launch_angle_rad"),
        F.radians(F.coalesce("launch_direction_deg", F.lit(0.0))).alias("launch_direction_rad"),
        U.rad_s_from_rpm(F.col("spin_rate_rpm")).alias("spin_rate_rad_s"),
        F.radians(F.coalesce("spin_axis_deg", F.lit(0.0))).alias("spin_axis_rad"),
        F.col("carry_yards").alias("measured_carry_yards"),
        F.col("total_yards").alias("measured_total_yards"))


def with_roll(si: DataFrame, firmness: float = 1.0) -> DataFrame:
    """Roll-out and total distance from measured carry and spin."""
    roll = U.roll_yards(F.col("measured_carry_yards"), F.col("spin_rate_rad_s"), firmness)
    return si.withColumn("roll_yards", roll).withColumn(
        "total_yards", F.col("measured_carry_yards") + F.col("roll_yards"))


# ---- who has a bag ------------------------------------------------------
def club_counts(shots: DataFrame) -> DataFrame:
    return launch_ready(shots).groupBy(*CLUB_KEYS).agg(F.count(F.lit(1)).alias("club_shots"))


def player_bags(shots: DataFrame, min_shots: int = K.MIN_SHOTS) -> DataFrame:
    """(source, player) with a club of enough shots: clubs that clear the bar, all shots."""
    return (
        club_counts(shots).groupBy("source", "player")
        .agg(F.count_if(F.col("club_shots") >= min_shots).alias("clubs"), F.sum("club_shots").alias("shots"))
        .where("clubs >= 1")
    )


def ranked_bags(shots: DataFrame) -> DataFrame:
    return player_bags(shots).orderBy(F.desc("clubs"), F.desc("shots"), "source", "player")


def richest_player(shots: DataFrame, min_shots: int = K.MIN_SHOTS) -> DataFrame:
    """The one (source, player) with most qualified clubs, then most shots; where no
    club qualifies anywhere the shot totals decide. Ties go to the first by name."""
    totals = club_counts(shots).groupBy("source", "player").agg(
        F.count_if(F.col("club_shots") >= min_shots).alias("clubs"), F.sum("club_shots").alias("shots"))
    best = totals.agg(F.min(F.struct(
        (-F.col("clubs")).alias("less_clubs"), (-F.col("shots")).alias("less_shots"),
        "source", "player", "clubs", "shots")).alias("b"))
    return best.where("b IS NOT NULL").select("b.source", "b.player", "b.clubs", "b.shots")


def top_clubs(counts: DataFrame, k: int = K.MAX_CLUBS, min_shots: int = K.MIN_SHOTS) -> DataFrame:
    """A player's k most-hit clubs among those with enough shots."""
    order = Window.partitionBy("source", "player").orderBy(F.desc("club_shots"), "club")
    return (
        counts.where(F.col("club_shots") >= min_shots)
        .withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    )


# ---- mishit trims -------------------------------------------------------
def trim_percentiles(
    shots: DataFrame, keys: list[str] = CLUB_KEYS, value: str = "ball_speed_mph",
    min_shots: int = K.MIN_SHOTS,
) -> DataFrame:
    """Keep each group's 5th to 95th percentile of `value` when enough rows remain,
    else keep the group whole. How many remain is read off the value counts that the
    percentiles come from, so the rows themselves are joined once."""
    limits = exact_percentiles(
        shots, keys, value, {"_lo": K.TRIM_LOW, "_hi": K.TRIM_HIGH}, count="_sized")
    inside = F.col("_v").between(F.col("_lo"), F.col("_hi"))
    kept = lookup(value_counts(shots, keys, value), limits, keys, "inner", null_safe=True).groupBy(
        *keys).agg(F.sum(F.when(inside, F.col("_n")).otherwise(0)).alias("_kept"))
    whole = (F.col("_sized") < min_shots) | (F.col("_kept") < min_shots)
    rules = one_to_one(limits, kept, keys).select(*keys, "_lo", "_hi", whole.alias("_whole"))
    marked = lookup(shots, rules, keys, null_safe=True)
    # A group without a single value has no rule and is kept as it is.
    return marked.where(
        F.coalesce("_whole", F.lit(True)) | F.col(value).between(F.col("_lo"), F.col("_hi"))).select(*shots.columns)


def one_to_one(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join two tables that both have one row per key (null keys match)."""
    renamed = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return left.join(renamed, match).drop(*[f"_k_{k}" for k in keys])


def trim_median(
    shots: DataFrame, keys: list[str], value: str, min_shots: int = K.MIN_SHOTS
) -> DataFrame:
    """Keep rows within 30 % of the group's median when the group has enough rows."""
    stats = exact_percentiles(shots, keys, value, {"_median": 0.5}, count="_rows")
    low, high = K.MEDIAN_BAND
    marked = lookup(shots, stats, keys, null_safe=True)
    inside = F.col(value).between(F.col("_median") * low, F.col("_median") * high)
    return marked.where((F.col("_rows") < min_shots) | inside).select(*shots.columns)


# ---- statistics ---------------------------------------------------------
def launch_distribution(si: DataFrame, min_shots: int = K.MIN_SHOTS) -> DataFrame:
    """Mean vector and 5x5 sample covariance of the launch conditions per club."""
    means = [F.avg(c).alias(f"mean_{c}") for c in LAUNCH_SI]
    covariances = [
        F.covar_samp(a, b).alias(f"cov_{i}{j}")
        for i, a in enumerate(LAUNCH_SI) for j, b in enumerate(LAUNCH_SI) if i <= j
    ]
    return si.groupBy(*CLUB_KEYS).agg(F.count(F.lit(1)).alias("n_observed"), *means, *covariances).where(
        F.col("n_observed") >= min_shots)


def reported_stats(shots: DataFrame, keys: list[str] = CLUB_KEYS) -> DataFrame:
    """Mean and population deviation of what the monitor reported, null below two values."""
    def stat(fn, c: str) -> Column:
        return F.when(F.count(c) >= 2, fn(c))

    return shots.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("shots"),
        stat(F.avg, "carry_yards").alias("measured_carry_mean"),
        stat(F.stddev_pop, "carry_yards").alias("measured_carry_std"),
        stat(F.stddev_pop, "side_dispersion").alias("measured_side_std"))


def cloud_summary(
    clouds: DataFrame, keys: list[str], carry: str = "carry", lateral: str = "lateral"
) -> DataFrame:
    """Mean, population deviation and p10/p90 of carry, and the 1-sigma landing ellipse
    from the 2x2 covariance, per cloud."""
    moments = clouds.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.avg(carry).alias("carry_mean_yards"), F.stddev_pop(carry).alias("carry_std_yards"),
        F.avg(lateral).alias("lateral_mean_yards"), F.stddev_pop(lateral).alias("lateral_std_yards"),
        F.var_samp(carry).alias("_a"), F.covar_samp(carry, lateral).alias("_b"),
        F.var_samp(lateral).alias("_c"))
    tails = exact_percentiles(clouds, keys, carry, {"carry_p10_yards": 0.1, "carry_p90_yards": 0.9})
    half = (F.col("_a") + F.col("_c")) / 2
    radius = F.hypot((F.col("_a") - F.col("_c")) / 2, F.col("_b"))
    # Axis direction is modulo 180 degrees: half the angle of (a - c, 2b).
    tilt = F.degrees(F.atan2(2 * F.col("_b"), F.col("_a") - F.col("_c")) / 2)
    return one_to_one(moments, tails, keys).select(
        *keys, "n_samples", "carry_mean_yards", "carry_std_yards", "lateral_mean_yards",
        "lateral_std_yards", "carry_p10_yards", "carry_p90_yards",
        F.sqrt(F.greatest(half + radius, F.lit(0.0))).alias("ellipse_semi_major_yards"),
        F.sqrt(F.greatest(half - radius, F.lit(0.0))).alias("ellipse_semi_minor_yards"),
        tilt.alias("ellipse_angle_deg"))


def error_report(rows: DataFrame, by: str, predicted: str, measured: str) -> DataFrame:
    """Mean and median absolute error by group and over everything (group `all`)."""
    errors = rows.select(F.col(by).alias("group"), F.abs(F.col(predicted) - F.col(measured)).alias("error"))
    both = errors.withColumn("group", F.explode(F.array("group", F.lit("all"))))
    means = both.groupBy("group").agg(F.count("error").alias("n"), F.avg("error").alias("mean_abs_error"))
    return one_to_one(means, exact_median(both, ["group"], "error", "median_abs_error"), ["group"])


def spread_report(simulated: DataFrame, reported: DataFrame, key: str = "club") -> DataFrame:
    """Spread of a landing cloud beside the spread the monitor reported, per club."""
    left = simulated.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_pop("carry").alias("cloud_carry_sigma"),
        F.stddev_pop("lateral").alias("cloud_side_sigma"))
    right = reported.groupBy(key).agg(
        F.stddev_pop("carry_yards").alias("measured_carry_sigma"),
        F.stddev_pop("side_dispersion").alias("measured_side_sigma"))
    return left.join(right, key)


# ---- clouds -------------------------------------------------------------
def recentre(
    clouds: DataFrame, keys: list[str], targets: DataFrame | None = None,
    value: str = "carry", target: str = "target",
) -> DataFrame:
    """Shift each cloud so that its mean is the target (0 without one), spread unchanged."""
    means = clouds.groupBy(*keys).agg(F.avg(value).alias("_mean"))
    if targets is not None:
        means = one_to_one(means, targets.select(*keys, F.col(target).alias("_target")), keys)
        goal = F.coalesce("_target", "_mean")
    else:
        goal = F.lit(0.0)
    means = means.select(*keys, (goal - F.col("_mean")).alias("_shift"))
    shifted = lookup(clouds, means, keys, "inner", null_safe=True)
    return shifted.withColumn(value, F.col(value) + F.col("_shift")).drop("_shift")


def even_subsample(clouds: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """`n` rows of each cloud spaced evenly over its row order (all rows if fewer):
    the rows at positions floor(k (N-1)/(n-1))."""
    ranked = ordinal_rank(clouds, keys, order)
    last = F.col("size") - 1
    # A row is taken when the smallest k whose position reaches it lands on it exactly.
    k = F.ceil(F.try_divide(F.col("rank") * (n - 1), last))
    taken = F.floor(k * last / max(n - 1, 1)) == F.col("rank")
    keep = (F.col("size") <= n) | (taken if n > 1 else F.col("rank") == 0)
    return ranked.where(keep).drop("rank", "size")


def anchor_to_measured(clouds: DataFrame, measured: DataFrame, keys: list[str]) -> DataFrame:
    """Recentre each cloud on the median measured carry; a club without one keeps its place."""
    targets = exact_median(measured, keys, "carry_yards", "target")
    known = clouds.select(*keys).distinct()
    match = [known[k].eqNullSafe(targets[k]) for k in keys]
    full = known.join(targets, match, "left").select(*[known[k] for k in keys], "target")
    return recentre(clouds, keys, full)


# ---- reference scaling --------------------------------------------------
def profile_stock(tours: DataFrame, profiles: DataFrame) -> DataFrame:
    """Each profile's stock table: its tour's clubs with speed and carry scaled."""
    return profiles.join(tours, "tour").select(
        "profile", "club", (F.col("ball_speed_mph") * F.col("dist_scale")).alias("ball_speed_mph"),
        (F.col("carry_yards") * F.col("dist_scale")).alias("carry_yards"))


def bag_stock(bags: DataFrame, tour: DataFrame) -> DataFrame:
    """A bag's stock table from its measured carries; clubs the tour lacks drop out."""
    reference = tour.select("club", F.col("carry_yards").alias("_tour"), F.col("ball_speed_mph").alias("_speed"))
    return bags.join(reference, "club").where("_tour <> 0").select(
        "bag_id", "club", (F.col("_speed") * F.col("measured_carry") / F.col("_tour")).alias("ball_speed_mph"),
        F.col("measured_carry").alias("carry_yards"))


def scale_ratio(bags: DataFrame, tour: DataFrame) -> DataFrame:
    """Per bag, the median ratio of measured to tour carry (1 without a shared club).
    A bag has one row per club, so its ratios are few."""
    reference = tour.select("club", F.col("carry_yards").alias("_tour"))
    return bags.join(reference, "club", "left").groupBy("bag_id").agg(
        F.coalesce(F.median(F.col("measured_carry") / F.nullif(F.col("_tour"), F.lit(0.0))), F.lit(1.0)).alias("scale"))


def gap_fill(base: DataFrame, measured: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Base clubs with measured values where there are any, flagged `is_real`."""
    own = measured.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(value).alias("_own"))
    match = F.lit(True)
    for k in keys:
        match = match & (F.col(k) == F.col(f"_k_{k}"))
    return base.join(own, match, "left").select(
        *keys, F.coalesce("_own", F.col(value)).alias(value), F.col("_own").isNotNull().alias("is_real"))


def bag_from_shots(
    shots: DataFrame, tours: DataFrame, bag: str = "bag_id", tour: str = "pga"
) -> DataFrame:
    """Per bag, a full set of clubs from its shots; `tours` is `(tour, club, carry_yards, ...)`.

    Clubs with enough clean strikes are real: trimmed to the median band and placed on
    their median measured carry with the spread of their own landings. The rest come
    from the reference table scaled by the bag's median ratio.
    """
    keys = [bag, "club"]
    labelled = launch_ready(shots).withColumn("club", C.bag_label(F.col("club"))).select(
        *keys, "ball_speed_mph", "carry_yards", "side_dispersion")
    clean = written(trim_median(written(labelled, "bag-shots"), keys, "ball_speed_mph"), "bag-clean")
    stats = clean.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_observed"), F.avg("carry_yards").alias("_mean"),
        F.stddev_pop("carry_yards").alias("carry_std_yards"),
        F.stddev_pop("side_dispersion").alias("lateral_std_yards"),
    ).where(F.col("n_observed") >= K.MIN_SHOTS)
    middle = exact_median(clean, keys, "carry_yards", "_median")
    real = written(one_to_one(stats, middle, keys).withColumn("measured_carry", F.coalesce("_median", "_mean")), "bag-real")
    reference = tours.where(F.col("tour") == tour)
    scale = scale_ratio(real.select(F.col(bag).alias("bag_id"), "club", "measured_carry"), reference)
    listed = reference.agg(F.collect_list(F.struct("club", "carry_yards"))).scalar()  # a tour's dozen clubs
    base = scale.withColumn("_clubs", listed).select(F.col("bag_id").alias(bag), "scale", F.inline("_clubs")).select(
        bag, "club", (F.col("carry_yards") * F.col("scale")).alias("_scaled"))
    found = real.select(F.col(bag).alias("_b"), F.col("club").alias("_c"), "n_observed", "measured_carry",
                        "carry_std_yards", "lateral_std_yards")
    joined = base.join(found, (F.col(bag) == F.col("_b")) & (F.col("club") == F.col("_c")), "left")
    return joined.select(
        bag, "club", F.coalesce("measured_carry", "_scaled").alias("carry_yards"),
        "carry_std_yards", "lateral_std_yards", "n_observed", F.col("_b").isNotNull().alias("is_real"))


def richest_bag(shots: DataFrame) -> DataFrame:
    """The richest player's most-hit clubs with reported statistics after trimming."""
    pick = richest_player(shots).select("source", "player")
    own = launch_ready(shots).join(F.broadcast(pick), ["source", "player"])
    clubs = top_clubs(own.groupBy(*CLUB_KEYS).agg(F.count(F.lit(1)).alias("club_shots")))
    chosen = own.join(F.broadcast(clubs.select(*CLUB_KEYS)), CLUB_KEYS)
    return reported_stats(trim_percentiles(chosen))
