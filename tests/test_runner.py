"""End to end over a collision CSV: read, check, one cube, write every result once;
each written result equals the same report run directly on the table."""

import hashlib
import os
import tempfile

import pytest

from crashgrid.__main__ import main
from crashgrid.plans import runner
from crashgrid.sources import adapters, schema

from .conftest import SF_SMALL, have_data


def _digest(rows, cols):
    """Order-insensitive; a mean of plain doubles may differ in its last digits
    with the order they were added in."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_shown(r[i]) for i in order) for r in rows)).encode()).hexdigest()


def _shown(v):
    try:
        return f"{float(v):.10g}"
    except ValueError:
        return str(v)


@pytest.fixture(scope="module")
def collision_csv(spark):
    if not have_data(SF_SMALL):
        pytest.skip("driver tables absent")
    d = tempfile.mkdtemp(prefix="crashgrid-csv-")
    table = adapters.incidents(spark, SF_SMALL, schema.REQUIRED_COLUMNS + ["Victim_Age"])
    table.write.option("header", True).csv(f"{d}/collisions.csv")
    return f"{d}/collisions.csv"


def test_cli_writes_every_result(spark, collision_csv):
    out = tempfile.mkdtemp(prefix="crashgrid-run-")
    assert main(["--input", collision_csv, "--output", out]) == 0
    assert sorted(os.listdir(out)) == sorted(runner.RESULTS)
    table = runner.read_table(spark, collision_csv)
    for name in runner.RESULTS:
        direct = runner.report(name, table)
        back = spark.read.option("header", True).csv(f"{out}/{name}")
        assert back.columns == direct.columns, name
        want = [tuple("" if v is None else str(v).lower() if isinstance(v, bool) else str(v) for v in r)
                for r in direct.collect()]
        got = [tuple("" if v is None else v for v in r) for r in back.collect()]
        assert len(got) == len(want), name
        assert _digest(got, back.columns) == _digest(want, direct.columns), name


def test_unknown_result_name(spark, collision_csv):
    with pytest.raises(KeyError):
        runner.results(runner.read_table(spark, collision_csv), ["nope"])


def test_bad_rows_are_reported(spark, tmp_path):
    header = ",".join(schema.REQUIRED_COLUMNS)
    line = "A12,2024-01-06,{},X,Saturday,Late Night,Winter,true,2024,1,Injury Involved,Road,True,Low,1 Main,34.0,-118.2"
    (tmp_path / "c.csv").write_text("\n".join([header, line.format("3.0"), line.format("noon")]) + "\n")
    with pytest.warns(UserWarning, match="1 rows"):
        written = runner.run(spark, str(tmp_path / "c.csv"), str(tmp_path / "out"), ["obj2_dangerous_areas", "pattern2_agg_hourly_count"])
    assert [tuple(r) for r in spark.read.option("header", True).csv(written["obj2_dangerous_areas"]).collect()] == [("X", "2")]
    assert [tuple(r) for r in spark.read.option("header", True).csv(written["pattern2_agg_hourly_count"]).collect()] == [("3", "1")]
