"""Operators not covered through the registered queries."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from crashgrid.functions import enrich, formatting
from crashgrid.operators import matrix, ranking, rollups
from crashgrid.plans import batch
from crashgrid.sources import readers

from .conftest import SF_SMALL, have_data
from .fixtures import rows


def test_enrich_from_timestamp(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 12, 1, 18, 5),)], "ts timestamp_ntz")
    r = enrich.enrich_from_timestamp(df, "ts").collect()[0]
    assert (r.Hour, r.Time_of_Day, r.Season, r.Day_of_Week, r.Is_Weekend, r.Year, r.Month) == (
        18, "Evening Rush", "Winter", "Sunday", True, 2024, 12)
    assert r.Date_Occurred == dt.date(2024, 12, 1)


def test_hour_text(spark):
    assert spark.range(1).select(formatting.hour_text(F.lit(7)).alias("t")).collect()[0].t == "07:00"


def test_read_parquet_validates_and_normalises(spark):
    df = rows(spark, [{"Area_Name": "A"}]).drop("Victim_Age")
    path = tempfile.mkdtemp(prefix="crashgrid-pq-") + "/t"
    df.write.parquet(path)
    back = readers.read_collisions_parquet(spark, path)
    assert "Victim_Age" in back.columns and back.count() == 1
    df.drop("Hour").write.mode("overwrite").parquet(path)
    with pytest.raises(Exception, match="Hour"):
        readers.read_collisions_parquet(spark, path)


def test_write_batch(spark):
    if not have_data(SF_SMALL):
        pytest.skip("driver tables absent")
    out = tempfile.mkdtemp(prefix="crashgrid-batch-")
    written = batch.write_batch(spark, SF_SMALL, out, names=["count_by_area", "hotspot_addresses"])
    assert set(written) == {"count_by_area", "hotspot_addresses"}
    for path in written.values():
        assert [f for f in os.listdir(path) if f.startswith("part-")]


def test_envelope_counts_absent_keys_as_zero(spark):
    cube = spark.createDataFrame([("A", 1, 4), ("B", 1, 2), ("C", 2, 6)], "a string, Hour int, n long")
    env = {r.Hour: r for r in matrix.envelope(cube, "a", "Hour", "n").collect()}
    assert (env[1].Total, env[1].Max, env[1].Min, env[1].Mean) == (6, 4, 0, 2.0)
    assert (env[2].Total, env[2].Max, env[2].Min, env[2].Mean) == (6, 6, 0, 2.0)


def test_row_and_partition_counts(spark):
    r = rollups.row_and_partition_counts(spark.range(0, 100, numPartitions=4)).collect()[0]
    assert (r.Rows, r.Partitions) == (100, 4)


def test_partition_count_includes_empty_ones(spark):
    r = rollups.row_and_partition_counts(spark.range(0, 2, numPartitions=2).repartition(5)).collect()[0]
    assert (r.Rows, r.Partitions) == (2, 5)


@pytest.mark.parametrize("values, mean", [
    ([float("nan"), 10.0], 10.0), ([float("inf"), None, 4.0], 4.0), ([1e17, 1e17], 1e17),
    ([0.004, 0.004, 0.005], 0.013 / 3), ([float("nan")], None), ([-float("inf")], None),
])
@pytest.mark.parametrize("scale", [None, 6])
def test_means_skip_what_is_no_number(spark, values, mean, scale):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.agg(rollups.exact_mean("v", scale)).first()[0]
    assert got == pytest.approx(mean) if mean is not None else got is None
    cube = rollups.weighted_cube(df.withColumn("id", F.lit(1)), [], id_col="id", measure="v", scale=scale)
    got = cube.agg(rollups.mean_col(cube, "v")).first()[0]
    assert got == pytest.approx(mean) if mean is not None else got is None


def test_envelope_gathers_no_keys(spark):
    cube = spark.createDataFrame([("A", 1, 4)], "a string, Hour int, n long")
    plan = matrix.envelope(cube, "a", "Hour", "n")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "collect_list" not in plan


def test_global_rank_equals_row_number(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "user_id", "event_type")
    order = [F.col("user_id").desc_nulls_last(), F.col("event_id").asc_nulls_last()]
    ranked = ranking.with_global_rank(events, order)
    assert "SinglePartition" not in ranked._jdf.queryExecution().toString()
    want = events.withColumn("Want", F.row_number().over(Window.orderBy(*order)))
    both = ranked.join(want.select("event_id", "Want"), "event_id")
    assert both.where("Rank = Want").count() == events.count() == ranked.count()


def test_global_rank_within_groups_and_over_equal_rows(spark):
    df = spark.createDataFrame(
        [(None, 1), (None, 1), ("a", 2), ("a", None), ("a", 1), ("b", 5)] + [("a", 7)] * 50, "g string, v int")
    got = ranking.with_global_rank(df, ["v"], alias="n", within=["g"], total="size").collect()
    for g in (None, "a", "b"):
        group = sorted((r.n, r.v if r.v is not None else 99, r.size) for r in got if r.g == g)
        assert [n for n, _, _ in group] == list(range(1, len(group) + 1))
        assert [v for _, v, _ in group] == sorted(v for _, v, _ in group) and {s for *_, s in group} == {len(group)}
    assert ranking.with_global_rank(df.limit(0), ["v"]).collect() == []
