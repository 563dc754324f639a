import pytest

from swingframe import schemas
from swingframe.constants import SESSION_COLUMNS
from swingframe.functions.cleaning import header_text
from swingframe.sources import bronze, seeds
from swingframe.sources.registry import SOURCES, Source, get_source


def _write(path, text, bom=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())


def _source(**kw):
    return Source("cart", r"^range/.*\.csv$", "cart_raw", **kw)


def test_header_rule():
    assert [header_text(h) for h in ("Club Speed", "Dyn. Loft", "Max Height - Dist.", "Launch Angle V (°)", "  Spin Rate  ", "*")] == [
        "club_speed", "dyn_loft", "max_height_dist", "launch_angle_v", "spin_rate", "unnamed"]


def test_header_columns(spark):
    from pyspark.sql import functions as F

    lines = ["Hole,,Hole", '"Lie, start",Gust "x","a ""b"" c",Hole,Hole,Hole', "", "*,*"]
    got = [r.n for r in spark.createDataFrame([(k, v) for k, v in enumerate(lines)], "k int, v string").select("k", bronze.header_columns(F.col("v")).alias("n")).orderBy("k").collect()]
    assert got == [["hole", "unnamed_1", "hole_1"], ["lie_start", "gust_x", "a_b_c", "hole", "hole_1", "hole_2"], ["unnamed_0"], ["unnamed", "1"]]


@pytest.mark.parametrize("multi_line", [True, False])
def test_units_row_union_and_lineage(spark, tmp_path, multi_line):
    _write(tmp_path / "range/a.csv", "Lie,Gust Speed,Remark\n,[kn],\nbunker,14,wet\nbunker,,\"a \"\"q\"\", b\"\n")
    _write(tmp_path / "range/b.csv", "Lie,Gust Speed\n,\nfringe,9\n", bom=True)
    _write(tmp_path / "other/c.csv", "Lie,Gust Speed\n,\ncart path,3\n")
    df = bronze.read_bronze(spark, str(tmp_path), _source(has_units_row=True, multi_line=multi_line))
    assert df.columns == ["_source", "_source_file", "_row_index", "lie", "gust_speed", "remark", "_ingested_at_utc"]
    rows = {r._row_index: r for r in df.collect()}
    assert sorted(rows) == [0, 1, 2]
    assert (rows[0].lie, rows[0].gust_speed, rows[0].remark) == ("bunker", "14", "wet")
    assert (rows[1].gust_speed, rows[1].remark) == ("", 'a "q", b')  # a blank cell stays blank
    assert (rows[2]._source_file, rows[2].lie, rows[2].remark) == ("range/b.csv", "fringe", None)


@pytest.mark.parametrize("multi_line", [True, False])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_two_byte_encoding(spark, tmp_path, multi_line, end):
    (tmp_path / "range").mkdir()
    (tmp_path / "range/a.csv").write_bytes(end.join(["Lie,Größe", ",[m]", "grün,3", "água,4", ""]).encode("utf-16-le"))
    (tmp_path / "range/b.csv").write_bytes("\ufeffLie".encode("utf-16-le") + end.join(["", "", "fairway", ""]).encode("utf-16-le"))
    df = bronze.read_bronze(spark, str(tmp_path), _source(has_units_row=True, multi_line=multi_line, encoding="UTF-16LE"))
    rows = [(r._row_index, r.lie.strip(), r.gr_e) for r in df.orderBy("_row_index").collect()]
    assert rows == [(0, "grün", "3"), (1, "água", "4"), (2, "fairway", None)]


def test_a_header_line_of_any_length(spark, tmp_path):
    names = [f"measure number {k:05d} {'x' * 300}" for k in range(300)]
    _write(tmp_path / "range/a.csv", ",".join(names) + "\n" + ",".join(str(k) for k in range(300)) + "\n")
    row = bronze.read_bronze(spark, str(tmp_path), _source()).first()
    assert row[-2] == "299" and len(row) == 304


def test_blank_second_line_is_not_taken_for_data(spark, tmp_path):
    _write(tmp_path / "range/a.csv", "Lie,Gust Speed\n\nbunker,14\nfringe,9\n")
    _write(tmp_path / "range/b.csv", "Lie,Gust Speed\n")
    df = bronze.read_bronze(spark, str(tmp_path), _source(has_units_row=True))
    assert sorted(r.lie for r in df.collect()) == ["bunker", "fringe"]


def test_big_file_is_split_and_numbered_in_order(spark, tmp_path):
    lines = "\n".join(f"{i},{i * 2}" for i in range(20000))
    _write(tmp_path / "range/big.csv", "Shot,Speed\n" + lines + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = bronze.read_bronze(spark, str(tmp_path), _source(multi_line=False))
        assert df.where("_row_index <> cast(shot as bigint)").count() == 0
        assert df.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_declared_header_needs_no_header_pass(spark, tmp_path):
    _write(tmp_path / "range/a.csv", "Lie,Gust\nfringe,1\n")
    rows = bronze.read_bronze(spark, str(tmp_path), _source(header=("Lie", "Gust"))).collect()
    assert [(r.lie, r.gust, r._row_index) for r in rows] == [("fringe", "1", 0)]


def test_no_file_and_unknown_source(spark, tmp_path):
    _write(tmp_path / "other/a.csv", "Club\nDriver\n")
    with pytest.raises(FileNotFoundError):
        bronze.read_bronze(spark, str(tmp_path), _source())
    with pytest.raises(LookupError, match="caddieset, flightscope, foresight, trackman"):
        get_source("nope")


def test_ingest_writes_every_source_and_is_repeatable(spark, tmp_path):
    for name, folder in (("trackman", "trackman"), ("foresight", "foresight"), ("caddieset", "caddieset"), ("flightscope", "range")):
        units = "[u],[u]\n" if SOURCES[name].has_units_row else ""
        _write(tmp_path / f"in/{folder}/s.csv", f"Club,Ball Speed\n{units}Driver,1{len(name)}\n")
    for _ in range(2):
        bronze.ingest_and_write(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    for name, source in SOURCES.items():
        rows = bronze.read_table(spark, str(tmp_path / "out" / source.bronze_table)).collect()
        assert [(r._source, r.club, r._row_index) for r in rows] == [(name, "Driver", 0)]


def test_personal_session(spark, tmp_path):
    lines = ["Club,Ball Speed,Launch Angle,Spin Rate,Carry,Junk"]
    lines += [f"7 Iron,{120 + i % 3},17,6500,165,x" for i in range(5)] + ["Sand Wedge,,30,9000,90,x"]
    _write(tmp_path / "session.csv", "\n".join(lines), bom=True)
    df = bronze.land_session(spark, str(tmp_path / "session.csv"), "Tester")
    assert [c for c in df.columns if not c.startswith("_")] == SESSION_COLUMNS
    rows = sorted(df.collect(), key=lambda r: r._row_index)
    assert [r._row_index for r in rows] == list(range(6))
    assert {r.player for r in rows} == {"Tester"} and rows[0].ball_speed_mph == "120" and rows[0].total_yards == ""
    _write(tmp_path / "useless.csv", "Club,Note\nDriver,x\n")
    with pytest.raises(ValueError, match="ball speed"):
        bronze.land_session(spark, str(tmp_path / "useless.csv"), "Tester")


def test_a_write_that_fails_leaves_the_old_table(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "table")
    rows = spark.range(100, numPartitions=4)
    bronze.write_table(rows, path)
    broken = rows.select(F.when(F.col("id") == 70, F.raise_error(F.lit("lost"))).otherwise(F.col("id") + 1000).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        bronze.write_table(broken, path)
    assert bronze.read_table(spark, path).agg(F.sum("id")).first()[0] == 4950
    bronze.write_table(rows.select((F.col("id") * 2).alias("id")), path)
    assert bronze.read_table(spark, path).agg(F.sum("id")).first()[0] == 9900
    assert len(bronze.drop_old_versions(spark, path)) == 2 and bronze.read_table(spark, path).count() == 100
    assert bronze.read_optional(spark, path, rows.schema).count() == 100


def test_absent_source_is_empty(spark, tmp_path):
    df = bronze.read_optional(spark, str(tmp_path / "none"), schemas.MANUAL_RAW)
    assert df.count() == 0 and df.schema == schemas.MANUAL_RAW


def test_seed_types_are_pinned(spark, tmp_path):
    _write(tmp_path / "s.csv", "player,club_type,make,model,year,is_custom,reported_loft_deg,reported_length_in,reported_shaft,effective_from\n"
           "unknown,Driver,unknown,unknown,,false,,,,1900-01-01\n")
    df = seeds.read_seed(spark, "player_clubs", str(tmp_path / "s.csv"))
    assert df.schema == schemas.PLAYER_CLUBS and df.first().effective_from == "1900-01-01"
    assert seeds.tour_averages(spark, "pga").count() == 12 and seeds.tour_averages(spark, "lpga").count() == 11
