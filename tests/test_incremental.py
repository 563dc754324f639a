import pytest
from pyspark.sql import functions as F

from swingframe.sources import incremental
from swingframe.sources.registry import Source

CART = Source("cart", r"^cart/.*\.csv$", "cart_raw", header=("Cart Id", "Lie", "Metres"))


def _land(path, name, rows):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("Cart Id,Lie,Metres\n" + "".join(f"{a},{b},{c}\n" for a, b, c in rows))


def test_two_arrivals_are_one_table(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        incremental.land_new(spark, str(root), CART, out, str(tmp_path / "state"), fingerprint=["lie", "metres"],
                             conform=lambda rows: rows.withColumn("metres", F.col("metres").try_cast("double")))

    _land(root / "cart", "a.csv", [(1, "bunker", "3.0"), (2, "bunker", "3"), (3, "", "x")])
    _land(root / "shed", "z.csv", [(9, "shed", "1")])
    run()
    first = {(r.lie, r.metres) for r in spark.read.parquet(out).collect()}
    assert first == {("bunker", 3.0), ("", None)}
    run()  # nothing new
    assert spark.read.parquet(out).count() == 2
    _land(root / "cart", "b.csv", [(4, "bunker", "3.00"), (5, "fringe", "4"), (6, "", "y")])
    run()
    rows = spark.read.parquet(out).collect()
    assert {(r.lie, r.metres, r._source_file.split("/")[0]) for r in rows} == {("bunker", 3.0, "cart"), ("", None, "cart"), ("fringe", 4.0, "cart")} and len(rows) == 3


def test_a_source_without_a_header_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="header"):
        incremental.new_rows(spark, str(tmp_path), Source("cart", ".*", "cart_raw"))
