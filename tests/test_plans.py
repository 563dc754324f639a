import duckdb
import pytest

import __spark_entry__ as entry_module
from swingframe.plans.registry import expand

SMALL = ["club_gapping", "dim_club", "shot_optimizer", "approach_aim", "bellman_sweep", "mapping_review", "tee_boxes", "bag_from_shots"]


def _plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SMALL)
def test_query_equals_its_sql(spark, folder, duck, name):
    got = entry_module.queries()[name](spark, folder).toArrow()
    want = duck.sql(entry_module.oracle_sql()[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names) and got.num_rows == want.num_rows

    def rows(table):
        return sorted(map(str, zip(*[table.column(c).to_pylist() for c in columns])))

    assert rows(got) == rows(want)


def test_registry_is_consistent():
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    assert set(oracles) <= set(queries)
    from swingframe.plans import QUERIES

    assert set(QUERIES) - set(oracles) == {"hole_records", "course_files", "map_extracts", "course_reader"}
    assert expand("SELECT 1") == "SELECT 1"


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0


def test_scans_are_pruned_and_filters_pushed(spark, folder):
    plan = _plan(entry_module.queries()["stg_trackman"](spark, folder))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string,props:string>" in plan


def test_camera_dedup_merges_before_the_shuffle(spark, folder):
    plan = _plan(entry_module.queries()["first_camera_view"](spark, folder)).split("== Physical Plan ==")[1]
    assert "partial_min" in plan and "Window" not in plan


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_products(spark, folder):
    for name in ("fct_shots", "shot_optimizer", "conditions", "gap_fill", "nearest_hole"):
        assert "CartesianProduct" not in _plan(entry_module.queries()[name](spark, folder))


def test_a_hot_key_is_split_at_run_time(spark):
    from pyspark.sql import functions as F

    from swingframe.operators.joins import lookup

    rows = spark.range(60000).select("id", F.md5(F.col("id").cast("string")).alias("load"), F.lit("hot").alias("k")).unionAll(
        spark.range(3000).selectExpr("id", "'x' AS load", "CAST(id AS STRING) AS k"))
    table = spark.range(3000).selectExpr("CAST(id AS STRING) AS k", "id AS v").unionAll(spark.sql("SELECT 'hot', 1L"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = lookup(rows.repartition(8), table, ["k"])
        # every column is kept, as the size in bytes decides what is split
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max(F.struct("*"))).collect()]
        assert "skew=true" in _final_plan(joined) and sum(sizes) == 63000 and max(sizes) < 30000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _shape(df):
    """Exchanges and the folders that are scanned, before anything ran."""
    import re

    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange(?! hashpartitioning.*Reused)", plan)), re.findall(r"InMemoryFileIndex\(.*?\)\[([^\],]*)", plan)


def test_the_fact_scans_and_shuffles_little(spark, folder):
    for name, most in (("fct_shots", 8), ("club_gapping", 12), ("bag_from_shots", 15)):
        df = entry_module.queries()[name](spark, folder)
        exchanges, scans = _shape(df)
        assert "NestedLoop" not in _plan(df) and exchanges <= most, (name, exchanges)
        assert not any("events.parquet" in s for s in scans), name  # shots are at rest


def test_keys_are_counted_before_they_meet_their_parents(spark, folder):
    plan = _plan(entry_module.queries()["contract_relationships"](spark, folder)).split("== Physical Plan ==")[1]
    assert "LeftAnti" not in plan and "NestedLoop" not in plan and plan.count("LeftOuter") == 1


def test_aims_are_averaged_before_the_shuffle(spark, folder):
    plan = _plan(entry_module.queries()["shot_optimizer"](spark, folder)).split("== Physical Plan ==")[1]
    assert "partial_sum" in plan and "CartesianProduct" not in plan
