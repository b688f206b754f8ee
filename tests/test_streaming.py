"""Incremental counts over arriving files equal the batch roll-up."""

import datetime as dt
import os
import tempfile

from crashgrid.plans import reports as R
from crashgrid.sources.schema import collision_schema
from crashgrid.streaming import incremental

from .fixtures import hour_rows, rows


def test_running_counts_match_batch(spark):
    src = tempfile.mkdtemp(prefix="crashgrid-stream-src-")
    out = tempfile.mkdtemp(prefix="crashgrid-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="crashgrid-stream-ckpt-")
    first = rows(spark, hour_rows(spark, "A", {7: 3, 18: 2}), derive=False)
    second = rows(spark, hour_rows(spark, "B", {7: 1}, start_id=100) +
                  [{"Area_Name": "A", "Hour": 18, "DR_Number": 200, "Date_Occurred": dt.date(2024, 1, 6)}],
                  derive=False)
    first.write.parquet(os.path.join(src, "part1"))
    stream = incremental.read_stream(spark, os.path.join(src, "*"), collision_schema())
    counts = incremental.running_counts(stream, ["Area_Name", "Hour"], "Collision_Count")
    q = incremental.start(counts, ckpt, sink="parquet", path=out)
    try:
        q.processAllAvailable()
        second.write.parquet(os.path.join(src, "part2"))
        q.processAllAvailable()
    finally:
        q.stop()
    got = {(r.Area_Name, r.Hour): r.Collision_Count for r in incremental.current(spark, out).collect()}
    both = first.unionByName(second)
    want = {(r.Area_Name, r.Hour): r.Collision_Count for r in R.hourly_flow(both).collect()}
    assert got == want == {("A", 7): 3, ("A", 18): 3, ("B", 7): 1}
