"""A site holding a third of all rows: results stay whole and equal on the
shuffle-join path (pre-aggregation for aggregates, AQE split for row output)."""

import tempfile

import pytest
from pyspark.sql import functions as F

from crashgrid.plans import catalogue
from crashgrid.plans import reports as R
from crashgrid.sources import adapters

from .conftest import SF_SMALL, have_data

QUERIES = sorted(n for n, q in catalogue.QUERIES.items() if q.source is catalogue.SHORT and adapters.JOINED & set(q.columns))


@pytest.fixture(scope="module")
def skewed_dir(spark):
    if not have_data(SF_SMALL):
        pytest.skip("driver tables absent")
    d = tempfile.mkdtemp(prefix="crashgrid-skew-")
    for t in ("customer", "nation", "orders"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id"))
    ev.withColumn("user_id", hot).repartition(4).write.parquet(f"{d}/events.parquet")
    return d


@pytest.fixture
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.getAll.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v else spark.conf.unset(k)


@pytest.fixture(scope="module")
def wanted(spark, skewed_dir):
    return {n: sorted(map(tuple, catalogue.run(spark, skewed_dir, n).collect()), key=repr) for n in QUERIES}


@pytest.mark.parametrize("name", QUERIES)
def test_hot_site_same_results_without_broadcast(spark, skewed_dir, wanted, no_broadcast, name):
    df = catalogue.run(spark, skewed_dir, name)
    assert sorted(map(tuple, df.collect()), key=repr) == wanted[name]
    if name not in ("evening_rush_rows", "hotspot_address_ranks", "severity_matrix", "severity_matrix_top10"):
        # the fact reaches the join already aggregated by site (three of these checkpoint what follows)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "_w_rows" in plan or "_w_id" in plan


def test_rows_do_not_depend_on_the_join(spark, skewed_dir, no_broadcast):
    """One row per event with the columns asked for, site or not."""
    df = adapters.incidents(spark, skewed_dir)
    assert df.columns == adapters.ALL_COLUMNS
    events = spark.read.parquet(f"{skewed_dir}/events.parquet")
    assert df.count() == events.count()
    assert df.where("Area_Name is null").count() == events.where("user_id is null").count() + events.where("user_id is not null").join(
        spark.read.parquet(f"{skewed_dir}/customer.parquet"), F.col("user_id") == F.col("c_custkey"), "left_anti").count()


def test_rows_of_a_hot_site_are_spread(spark, skewed_dir, no_broadcast):
    """With AQE off, one site at 40 % and rows without a site at 10 % leave no
    partition over 3 x the median; rows are as a plain join gives them."""
    fact = spark.range(0, 40_000, numPartitions=8).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 10 < 4, F.lit(7)).when(F.col("id") % 10 == 4, F.lit(None)).otherwise(100 + F.xxhash64("id") % 3000).alias("site"))
    dim = spark.range(-3000, 4000).select(F.col("id").alias("c_custkey"), F.concat(F.lit("n"), F.col("id") % 25).alias("Area_Name"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        joined = adapters.join_sites(fact, dim, "site", "row")
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 32 and sizes[-1] <= 3 * sizes[16], sizes
        want = fact.join(dim, F.col("site") == F.col("c_custkey"), "left").select("row", "site", "Area_Name")
        got = joined.select("row", "site", "Area_Name")
        assert got.count() == 40_000 and got.exceptAll(want).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_scale_is_honoured(spark, skewed_dir):
    whole = adapters.incident_cube(spark, skewed_dir, adapters.EVENTS, ["Area_Name", "Victim_Age"], scale=0)
    exact = adapters.incident_cube(spark, skewed_dir, adapters.EVENTS, ["Area_Name", "Victim_Age"], scale=None)
    a, b = ([r[0] for r in R.area_stats(c.withColumn("Is_Hotspot", F.lit(False))).select("Avg_Victim_Age").collect()] for c in (whole, exact))
    assert a != b and all(abs(x - y) < 0.5 for x, y in zip(a, b))


def test_appended_files_are_read(spark, skewed_dir):
    d = tempfile.mkdtemp(prefix="crashgrid-append-")
    events = spark.read.parquet(f"{skewed_dir}/events.parquet")
    events.write.parquet(f"{d}/events.parquet")
    count = lambda: sum(r[1] for r in catalogue.run(spark, d, "hourly_rows").collect())
    first = count()
    events.write.mode("append").parquet(f"{d}/events.parquet")
    assert count() == 2 * first
