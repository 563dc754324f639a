"""Course geometry: map features to holes in a tee-to-pin frame.

Features meet holes by place (`cells`), never a whole course with a whole course, so a map with
very many features is spread like any other table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swingframe.constants import YARDS_PER_METRE
from swingframe.functions import geometry as G
from swingframe.operators import cells
from swingframe.operators.joins import lookup
from swingframe.session import written

RING_KINDS = ["green", "fairway", "bunker", "water_hazard", "water", "tee"]


# ---- features -----------------------------------------------------------
def outer_rings(geometry: Column, members: Column, kind: Column) -> Column:
    """A way's own ring or a relation's outer members, rings of three points or more."""
    outers = F.transform(
        F.filter(F.coalesce(members, F.array().cast("array<struct<role:string,geometry:array<struct<lat:double,lon:double>>>>")),
                 lambda m: m["role"] == "outer"), lambda m: m["geometry"])
    rings = F.when(kind == "way", F.array(geometry)).otherwise(outers)
    return F.filter(rings, lambda r: F.size(r) >= 3)


def box_area(ring: Column) -> Column:
    lats, lons = F.transform(ring, lambda p: p["lat"]), F.transform(ring, lambda p: p["lon"])
    return (F.array_max(lats) - F.array_min(lats)) * (F.array_max(lons) - F.array_min(lons))


def largest_ring(rings: Column) -> Column:
    """The ring with the largest bounding box, the first one on a tie."""
    ranked = F.transform(rings, lambda r, i: F.struct(-box_area(r), i, r.alias("ring")))
    return F.array_min(ranked)["ring"]


def vertex_mean(ring: Column) -> Column:
    def mean(side: str) -> Column:
        return F.aggregate(ring, F.lit(0.0), lambda a, p: a + p[side]) / F.size(ring)

    return F.struct(mean("lat").alias("lat"), mean("lon").alias("lon"))


def ring_features(elements: DataFrame) -> DataFrame:
    """Polygon features `(course_id, element_id, golf, rings, ring, centre)`."""
    golf = F.col("tags")["golf"]
    shaped = elements.where(golf.isin(*RING_KINDS)).select(
        "course_id", "element_id", golf.alias("golf"),
        outer_rings(F.col("geometry"), F.col("members"), F.col("type")).alias("rings"))
    main = shaped.where(F.size("rings") > 0).withColumn("ring", largest_ring(F.col("rings")))
    return main.withColumn("centre", vertex_mean(F.col("ring")))


def hole_lines(elements: DataFrame) -> DataFrame:
    """Centrelines `(course_id, ref, par, line)` of features tagged as holes with a par."""
    tags = F.col("tags")
    ref, par = tags["ref"].try_cast("int"), tags["par"].try_cast("int")
    return elements.where((tags["golf"] == "hole") & ref.isNotNull() & par.isNotNull() & (F.size("geometry") >= 2)).select(
        "course_id", ref.alias("ref"), par.alias("par"), F.col("geometry").alias("line"))


def rejected_features(elements: DataFrame) -> DataFrame:
    """`(course_id, element_id, reason)` of mapped features that no later step can use: holes
    without a whole number as ref or par or with a line of one point, areas without a ring of
    three points."""
    tags = F.col("tags")
    rings = outer_rings(F.col("geometry"), F.col("members"), F.col("type"))
    reason = F.when(tags["golf"] == "hole", F.when(tags["ref"].try_cast("int").isNull(), "ref").when(
        tags["par"].try_cast("int").isNull(), "par").when(~(F.coalesce(F.size("geometry"), F.lit(0)) >= 2), "line")).when(
        tags["golf"].isin(*RING_KINDS) & ~(F.coalesce(F.size(rings), F.lit(0)) > 0), "ring")
    return elements.select("course_id", "element_id", reason.alias("reason")).where("reason IS NOT NULL")


# ---- nearest features ---------------------------------------------------
def line_vertices(lines: DataFrame) -> DataFrame:
    """`(course_id, ref, vertex, lat, lon)` of every centreline."""
    return lines.select("course_id", "ref", F.posexplode("line").alias("vertex", "p")).select(
        "course_id", "ref", "vertex", F.col("p.lat").alias("lat"), F.col("p.lon").alias("lon"))


def centres(features: DataFrame, name: str = "element_id") -> DataFrame:
    return features.select("course_id", F.col("element_id").alias(name), F.col("centre.lat").alias("lat"), F.col("centre.lon").alias("lon"))


def assign_to_holes(features: DataFrame, lines: DataFrame) -> DataFrame:
    """Each feature's nearest hole of its course by centreline vertex (lowest ref on a tie)."""
    keys = ["course_id", "element_id"]
    near = cells.nearest(centres(features), line_vertices(lines), ["course_id"], keys, ["ref"])
    return lookup(features, near.select(*keys, "ref"), keys, "inner")


def nearest_fairway(lines: DataFrame, features: DataFrame) -> DataFrame:
    """Per hole the fairway whose centre is closest to its centreline (first by id on a tie)."""
    fairways = features.where("golf = 'fairway'")
    near = cells.nearest(line_vertices(lines), centres(fairways), ["course_id"], ["course_id", "ref", "vertex"], ["element_id"])
    best = near.groupBy("course_id", "ref").agg(F.min(F.struct("metres", "element_id")).alias("b")).select(
        "course_id", "ref", F.col("b.element_id").alias("fairway_id"))
    chosen = lookup(lines.select("course_id", "ref"), best, ["course_id", "ref"])
    return lookup(chosen, fairways.select("course_id", F.col("element_id").alias("fairway_id"), F.col("ring").alias("fairway_ring")),
                  ["course_id", "fairway_id"])


def pair_greens(lines: DataFrame, features: DataFrame, size: float = 2 * cells.DEGREES) -> DataFrame:
    """Holes in ref order take the nearest green not yet taken to either end of their line;
    one that finds none has a null `green_id`.

    By deferred acceptance: all holes without a green ask for the nearest one that has not refused
    them, and a green keeps the lowest ref that asks. As all greens rank holes alike, the result
    is that of choosing in ref order, while rounds follow the longest chain of refusals and
    not the number of holes. Greens are listed as far as the cells around a hole reach; cells grow only while a
    hole has asked all of its list. A round's answers are written before the next one reads them.
    """
    hole, pick = ["course_id", "ref"], F.struct("metres", "green_id")
    ends = lines.select(*hole, F.posexplode(F.array(F.col("line")[0], F.element_at("line", -1))).alias("end", "p")).select(
        *hole, "end", F.col("p.lat").alias("lat"), F.col("p.lon").alias("lon"))
    ends, greens = written(ends, "line-ends"), written(centres(features.where("golf = 'green'"), "green_id"), "greens")
    totals = greens.groupBy("course_id").agg(F.count(F.lit(1)).alias("_greens"))
    last = [F.lit(-1.0).alias("metres"), F.lit(0).cast("bigint").alias("green_id")]
    asking = lookup(lines.select(*hole).distinct(), totals, ["course_id"], "inner").select(*hole, *last)
    held: DataFrame | None = None
    while True:
        listed = cells.close_pairs(ends, greens, ["course_id"], size).groupBy(*hole, "green_id").agg(
            F.min(F.struct(F.round("metres", 6).alias("metres"), "end")).alias("b"))
        seen = listed.groupBy(*hole).agg(F.count(F.lit(1)).alias("_seen"))
        bounds = ends.groupBy(*hole).agg(F.min(cells.reach(F.col("lat"), size)).alias("_reach"))
        bounds = lookup(lookup(bounds, seen, hole), totals, ["course_id"], "inner").select(
            *hole, F.when(F.col("_seen") == F.col("_greens"), float("inf")).otherwise(F.col("_reach") - 1e-5).alias("_reach"))
        bounds = written(bounds, "pairing-bounds")
        wishes = written(lookup(listed, bounds, hole, "inner").where(F.col("b.metres") < F.col("_reach")).select(
            *hole, "green_id", "b.metres", "b.end"), "pairing-wishes")
        while True:
            before = asking.select(*hole, pick.alias("_last"))
            asked = lookup(wishes, before, hole, "inner").where(pick > F.col("_last")).groupBy(*hole).agg(
                F.min(F.struct("metres", "green_id", "end")).alias("b")).select(*hole, "b.*")
            rivals = asked.withColumn("_new", F.lit(True))
            if held is not None:
                rivals = rivals.unionByName(held.withColumn("_new", F.lit(False)))
            best = rivals.groupBy("course_id", "green_id").agg(F.min("ref").alias("_best"))
            judged = written(lookup(rivals, best, ["course_id", "green_id"], "inner").withColumn(
                "won", F.col("ref") == F.col("_best")).drop("_best"), "pairing-answers")
            if judged.where("_new").isEmpty():
                break
            held = judged.where("won").drop("won", "_new")
            waiting = asking.join(judged.where("_new").select(*hole), hole, "left_anti")
            asking = written(waiting.unionByName(judged.where("NOT won").select(*asking.columns)), "pairing-asking")
        # who has asked every green of the course goes without
        asking = lookup(asking, bounds, hole, "inner").where(F.col("_reach") < float("inf")).drop("_reach")
        if asking.isEmpty():
            break
        asking, size = written(asking, "pairing-asking"), size * cells.WIDER
    every = lines.select(*hole)
    if held is None:
        return every.withColumns({"green_id": F.lit(None).cast("bigint"), "end": F.lit(None).cast("int")})
    return lookup(every, held.drop("metres"), hole)


def hole_frames(lines: DataFrame, features: DataFrame, pairs: DataFrame) -> DataFrame:
    """Holes with their tee-to-pin frame: the pin is the paired green, the tee the far end.
    A hole without a green is kept, with a null frame."""
    greens = features.where("golf = 'green'").select(
        "course_id", F.col("element_id").alias("green_id"), F.col("centre").alias("pin"),
        F.col("ring").alias("green_ring"))
    tee = F.when(F.col("end") == 0, F.element_at("line", -1)).otherwise(F.col("line")[0])
    joined = lines.join(pairs, ["course_id", "ref"]).join(greens, ["course_id", "green_id"], "left").withColumn("tee", tee)
    frame = G.axis(F.col("tee.lat"), F.col("tee.lon"), F.col("pin.lat"), F.col("pin.lon"))
    return joined.withColumn("frame", F.when(F.col("pin").isNotNull(), frame))


def project_ring(frame: Column, ring: Column) -> Column:
    return F.transform(ring, lambda p: G.project(frame, p["lat"], p["lon"]))


def tee_boxes(frames: DataFrame, assigned: DataFrame) -> DataFrame:
    """Plausible tees of each hole: near the start, on line, long enough; longest first."""
    tees = assigned.where("golf = 'tee'").select("course_id", "ref", "element_id", "centre")
    spots = tees.join(frames.select("course_id", "ref", "frame"), ["course_id", "ref"]).withColumn(
        "at", G.project(F.col("frame"), F.col("centre.lat"), F.col("centre.lon")))
    down, side, pin = F.col("at")[0], F.col("at")[1], F.col("frame.pin_yards")
    kept = spots.withColumn("yards", F.hypot(pin - down, side)).where(
        down.between(-25.0, 0.45 * pin) & (F.abs(side) <= 45.0) & (F.col("yards") >= 70.0))
    order = Window.partitionBy("course_id", "ref").orderBy(F.desc("yards"), "element_id")
    return kept.select(
        "course_id", "ref", "element_id", F.round(down, 1).alias("downrange"), F.round(side, 1).alias("lateral"),
        F.round("yards", 1).alias("yards"), F.row_number().over(order).alias("place"))


# ---- ground -------------------------------------------------------------
def resample_line(line: Column, n: int) -> Column:
    """`n` points evenly spaced along a line by cumulative length, as (k, lat, lon)."""
    last = F.size(line) - 1
    steps = F.transform(F.sequence(F.lit(0), last - 1), lambda i: G.metres(
        F.get(line, i)["lat"], F.get(line, i)["lon"], F.get(line, i + 1)["lat"], F.get(line, i + 1)["lon"]))
    reach = F.transform(F.sequence(F.lit(0), last), lambda i: F.aggregate(
        F.slice(steps, 1, i), F.lit(0.0), lambda a, s: a + s))

    def place(k: Column) -> Column:
        goal = F.get(reach, last) * k / (n - 1)
        # First stretch whose end is at or past the goal.
        at = F.coalesce(F.get(F.filter(F.sequence(F.lit(0), last - 1), lambda i: F.get(reach, i + 1) >= goal),
                              F.lit(0)), F.lit(0))
        share = F.coalesce((goal - F.get(reach, at)) / F.nullif(F.get(steps, at), F.lit(0.0)), F.lit(0.0))
        a, b = F.get(line, at), F.get(line, at + 1)
        return F.struct(k.alias("k"), (a["lat"] + share * (b["lat"] - a["lat"])).alias("lat"),
                        (a["lon"] + share * (b["lon"] - a["lon"])).alias("lon"))

    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), place)


def elevation_profile(frames: DataFrame, samples: DataFrame) -> DataFrame:
    """Height against the tee in yards per rounded downrange, the last sample of a place
    winning. `samples` has `(course_id, ref, ord, lat, lon, metres)`; order 0 is the tee."""
    tee = samples.where("ord = 0").select("course_id", "ref", F.col("metres").alias("tee_metres"))
    placed = samples.join(tee, ["course_id", "ref"]).join(
        frames.select("course_id", "ref", "frame"), ["course_id", "ref"])
    down = F.rint(G.project(F.col("frame"), F.col("lat"), F.col("lon"))[0]).cast("int")
    rise = F.round((F.col("metres") - F.col("tee_metres")) * YARDS_PER_METRE, 1)
    return placed.withColumns({"downrange": down, "height": rise}).groupBy("course_id", "ref", "downrange").agg(
        F.max_by("height", "ord").alias("height"))


def green_samples(frames: DataFrame, side: int = 4) -> DataFrame:
    """Sample places inside each green: the cell centres of a lattice over its box."""
    flat = F.transform("green_ring", lambda p: F.array(p["lon"], p["lat"]))
    layered = frames.withColumn("_layer", G.layer(F.array(flat)))

    def along(low: str, high: str, k: str) -> Column:
        return F.col(f"_layer.{low}") + (F.col(k) + 0.5) / side * (F.col(f"_layer.{high}") - F.col(f"_layer.{low}"))

    return (
        layered.withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(side - 1))))
        .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(side - 1))))
        .withColumns({"lon": along("min_x", "max_x", "a"), "lat": along("min_y", "max_y", "b")})
        .where(G.inside_layer(F.col("_layer"), F.col("lon"), F.col("lat")))
        .select("course_id", "ref", "a", "b", "lat", "lon", G.project(F.col("frame"), F.col("lat"), F.col("lon")).alias("at"))
    )


def fit_planes(samples: DataFrame, keys: list[str], x: str, y: str, z: str) -> DataFrame:
    """Least-squares plane z = a x + b y + c per group from second moments; (0, 0) below
    four samples or where the samples lie on a line."""
    moments = samples.groupBy(*keys).agg(
        F.count(z).alias("n"), F.var_samp(x).alias("xx"), F.var_samp(y).alias("yy"), F.covar_samp(x, y).alias("xy"),
        F.covar_samp(x, z).alias("xz"), F.covar_samp(y, z).alias("yz"))
    det = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    solvable = (F.col("n") >= 4) & (F.abs(det) > 1e-12)
    a = (F.col("xz") * F.col("yy") - F.col("yz") * F.col("xy")) / det
    b = (F.col("yz") * F.col("xx") - F.col("xz") * F.col("xy")) / det
    return moments.select(*keys, "n", F.when(solvable, F.round(a, 4)).otherwise(0.0).alias("slope_x"),
                          F.when(solvable, F.round(b, 4)).otherwise(0.0).alias("slope_y"))


def green_planes(samples: DataFrame) -> DataFrame:
    """Green tilt from sampled elevations in metres, as rise per yard."""
    flat = samples.select("course_id", "ref", F.col("at")[0].alias("x"), F.col("at")[1].alias("y"),
                          (F.col("metres") * YARDS_PER_METRE).alias("z"))
    return fit_planes(flat, ["course_id", "ref"], "x", "y", "z")


# ---- records ------------------------------------------------------------
def hole_records(
    frames: DataFrame, assigned: DataFrame, fairways: DataFrame, tees: DataFrame,
    profile: DataFrame | None = None, planes: DataFrame | None = None,
) -> DataFrame:
    """One nested record per hole, everything in its own frame; without a frame, a null green,
    distance and bearing, and nothing in the lists."""
    keys = ["course_id", "ref"]
    framed = frames.where("frame IS NOT NULL")

    def rings(kinds: list[str], name: str) -> DataFrame:
        own = assigned.where(F.col("golf").isin(*kinds)).join(framed.select(*keys, "frame"), keys)
        ordered = F.array_sort(F.collect_list(F.struct(
            "element_id", project_ring(F.col("frame"), F.col("ring")).alias("ring"))))
        return own.groupBy(*keys).agg(F.transform(ordered, lambda r: r["ring"]).alias(name))

    boxes = tees.groupBy(*keys).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("place", "downrange", "lateral", "yards"))),
        lambda t: F.struct(t["downrange"].alias("downrange"), t["lateral"].alias("lateral"), t["yards"].alias("yards"))).alias("tees"))
    record = frames.join(fairways, keys, "left").join(boxes, keys, "left")
    for part in (rings(["bunker"], "bunkers"), rings(["water_hazard", "water"], "water")):
        record = record.join(part, keys, "left")
    if profile is not None:
        heights = profile.groupBy(*keys).agg(F.transform(
            F.array_sort(F.collect_list(F.struct("downrange", "height"))),
            lambda p: F.array(p["downrange"].cast("double"), p["height"])).alias("elevation"))
        record = record.join(heights, keys, "left")
    else:
        record = record.withColumn("elevation", F.lit(None).cast("array<array<double>>"))
    if planes is not None:
        record = record.join(planes.select(*keys, F.array("slope_x", "slope_y").alias("green_slope")), keys, "left")
    else:
        record = record.withColumn("green_slope", F.lit(None).cast("array<double>"))
    lists = "array<array<array<double>>>"
    return record.select(
        "course_id", "ref", "par", F.round("frame.pin_yards", 1).alias("pin_distance_yards"),
        F.round("frame.bearing", 1).alias("bearing_deg"),
        F.coalesce("green_slope", F.array(F.lit(0.0), F.lit(0.0))).alias("green_slope"),
        F.coalesce("elevation", F.array().cast("array<array<double>>")).alias("elevation"),
        F.coalesce("tees", F.array().cast("array<struct<downrange:double,lateral:double,yards:double>>")).alias("tees"),
        project_ring(F.col("frame"), F.col("green_ring")).alias("green"),
        F.when(F.col("fairway_ring").isNotNull() & F.col("frame").isNotNull(), project_ring(F.col("frame"), F.col("fairway_ring"))).otherwise(
            F.array().cast("array<array<double>>")).alias("fairway"),
        F.coalesce("bunkers", F.array().cast(lists)).alias("bunkers"),
        F.coalesce("water", F.array().cast(lists)).alias("water"))


def record_rows(records: DataFrame, keys: list[str]) -> DataFrame:
    """Nested hole records as flat rows `(keys, part, ring, ord, x, y)`: par, frame (pin distance and bearing), slope,
    and every point of the profile, tees (their yards as a part of its own), green, fairway, bunkers and water."""
    def row(part: str, ring: Column, at: Column, x: Column, y: Column) -> Column:
        return F.struct(F.lit(part).alias("part"), ring.cast("int").alias("ring"), at.cast("int").alias("ord"),
                        x.cast("double").alias("x"), y.cast("double").alias("y"))

    def points(part: str, line: str) -> Column:
        return F.transform(line, lambda p, i: row(part, F.lit(0), i, p[0], p[1]))

    def rings(part: str, name: str) -> Column:
        return F.flatten(F.transform(name, lambda r, k: F.transform(r, lambda p, i: row(part, k, i, p[0], p[1]))))

    zero, none = F.lit(0), F.lit(None)
    single = F.array(
        row("par", zero, zero, F.col("par"), none), row("frame", zero, zero, F.col("pin_distance_yards"), F.col("bearing_deg")),
        row("slope", zero, zero, F.col("green_slope")[0], F.col("green_slope")[1]))
    tees = [F.transform("tees", lambda t, i: row("tee", zero, i, t["downrange"], t["lateral"])),
            F.transform("tees", lambda t, i: row("tee yards", zero, i, t["yards"], none))]
    parts = [points("elevation", "elevation"), *tees, points("green", "green"), points("fairway", "fairway"),
             rings("bunker", "bunkers"), rings("water", "water")]
    empty = F.array().cast("array<struct<part:string,ring:int,ord:int,x:double,y:double>>")
    return records.select(*keys, F.inline(F.concat(single, *[F.coalesce(p, empty) for p in parts])))


def ground_places(frames: DataFrame) -> DataFrame:
    """`(course_id, ref, ord, lat, lon)` whose height a record wants: the tee (order 0), six along
    the line, the pin, and without an order the lattice of the green."""
    framed = frames.where("frame IS NOT NULL")
    along = F.transform(resample_line(F.col("line"), 6), lambda p: F.struct(
        (p["k"] + 1).alias("ord"), p["lat"].alias("lat"), p["lon"].alias("lon")))
    ends = [F.array(F.struct(F.lit(k).alias("ord"), F.col(f"{c}.lat").alias("lat"), F.col(f"{c}.lon").alias("lon")))
            for k, c in ((0, "tee"), (7, "pin"))]
    line = framed.select("course_id", "ref", F.inline(F.concat(ends[0], along, ends[1])))
    return line.unionByName(green_samples(framed).select("course_id", "ref", F.lit(None).cast("int").alias("ord"), "lat", "lon"))


def build_course(elements: DataFrame, heights: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Map elements of many courses to hole records.

    `heights` adds `metres` to `ground_places`, null where unknown, as a join with a table of
    ground samples does; without it, records have no elevation and level greens."""
    # Written once: read many times below, and the plans stay small for the driver.
    lines, features = written(hole_lines(elements), "lines"), written(ring_features(elements), "features")
    frames = written(hole_frames(lines, features, pair_greens(lines, features)), "frames")
    assigned = assign_to_holes(features.where("golf <> 'green' AND golf <> 'fairway'"), lines)
    profile = planes = None
    if heights is not None:
        samples = heights(ground_places(frames)).where("metres IS NOT NULL")
        profile = elevation_profile(frames, samples.where("ord IS NOT NULL"))
        on_green = samples.where("ord IS NULL").join(frames.select("course_id", "ref", "frame"), ["course_id", "ref"])
        planes = green_planes(on_green.withColumn("at", G.project(F.col("frame"), F.col("lat"), F.col("lon"))))
    return hole_records(frames, assigned, nearest_fairway(lines, features), tee_boxes(frames, assigned), profile, planes)
