import base64
import hashlib
import io
import random

import pytest

from crashgrid.llm import warc


def slow(rows):
    last = {}
    for i, body in rows:
        b = (body or "").encode()
        if i is not None:
            last[b] = max(last.get(b, i), i)
    out = []
    for i, body in rows:
        b = (body or "").encode()
        again = i is not None and last[b] != i
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", last[b] if again else None))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a.org/x", "<p>é😀</p>"), (2, "http://a.org/x", "<p>é😀</p>"), (2, "http://a.org/x", "<p>é😀</p>"), (3, None, None), (4, "", ""), (None, "http://b.org", ""),
    (5, "https://www.Ä.de:443/q?a=1#f", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"), (6, "http://a b\n.org/\x00", "x" * 300_000), (-9, "http://[bad", "\r\n"),
    ((1 << 62) + 3, "ftp://z.org:21/", "<p>é😀</p>"), (7, "http://a.org/y", "\x00\x01"),
]


def test_round_trip_and_cases(spark):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, archive string")
    got = warc.capture_histories(pages).collect()
    assert sorted(((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == slow([(a, c) for a, _, c in ROWS])
    assert warc.capture_histories(pages.limit(0)).count() == 0
    small = warc.capture_histories(pages, min_bytes=1000)
    assert small.where("record_type = 'revisit'").count() == 0


def test_histories_are_in_one_order(spark):
    r = random.Random(3)
    rows = [(i, f"http://{'hot' if i % 3 else r.choice('abcdef')}.org/{r.randint(0, 3)}", str(r.randint(0, 40))) for i in range(900)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    path = warc.Scratch(spark, "test")
    warc.write_archives(pages, path.path("a"), records_per_file=50)
    runs = warc.read_runs(spark, path.path("a"))
    assert runs.select("archive").distinct().count() > 15
    got = [(x.url_key, x.captured, x.id) for x in warc.merge_runs(runs, 4).collect()]
    assert len(got) == 900 and got == sorted(got)


def test_ranges_and_archives_go_by_bytes(spark, monkeypatch):
    r = random.Random(4)
    pages = spark.createDataFrame([(i, f"http://{r.choice('abc')}.org/{i % 50}", "y" * r.randint(0, 4000)) for i in range(600)], "page_id long, url string, html string").coalesce(1)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 100_000)
    monkeypatch.setattr(warc, "RANGE_BYTES", 20_000)
    at = warc.Scratch(spark, "test")
    warc.write_archives(pages, at.path("a"))
    runs = warc.read_runs(spark, at.path("a"))
    sizes = [x["count"] for x in runs.groupBy("archive").count().collect()]
    assert 25 <= max(sizes) <= 60 and sum(sizes) == 600
    merged = warc.merge_runs(runs)
    got = [(x.url_key, x.captured, x.id) for x in merged.collect()]
    assert merged.rdd.getNumPartitions() > 4 and len(got) == 600 and got == sorted(got)


def test_offsets_are_where_records_stand(spark):
    import gzip
    import os

    pages = spark.createDataFrame([(i, f"http://é{i}.org/ä", f"<p>ü{i}</p>" * (i + 1)) for i in range(20)], "page_id long, url string, html string").coalesce(1)
    at = warc.Scratch(spark, "test")
    warc.write_archives(pages, at.path("a"))
    folder = at.path("a").removeprefix("file:")
    whole = {f: gzip.open(os.path.join(folder, f)).read() for f in os.listdir(folder) if f.endswith(".gz")}
    for x in warc.read_runs(spark, at.path("a")).collect():
        record = whole[x.archive][x.offset : x.offset + x.length]
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(f"<p>ü{x.id}</p>".encode())
        assert whole[x.archive][x.offset + x.length : x.offset + x.length + 4] == b"\r\n\r\n"


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 8])
def test_loser_tree_merges(k):
    r = random.Random(k)
    runs = [sorted((((r.randint(0, 9), "u", f"k{r.randint(0, 9)}", "t", 0, "", "", None, f"run{j}", n, 0)) for n in range(r.randint(0, 12))), key=warc._order) for j in range(k)]
    assert list(warc.LoserTree(runs)) == sorted((x for run in runs for x in run), key=warc._order)


def test_corrupt_payloads_are_noticed(spark):
    pages = spark.createDataFrame([(1, "http://a.org", "abc")], "page_id long, url string, html string")
    text = warc.records(pages, "page_id", "url", "html", None, 0).first()[0] + "\r\n\r\n"
    assert [x[4] for x in warc.parse(io.BytesIO(text.encode()), "a")] == [3]
    with pytest.raises(ValueError, match="digest"):
        list(warc.parse(io.BytesIO(text.replace("abc", "abd").encode()), "a"))


def test_ids_survive_record_ids(spark):
    ids = [0, 1, -1, 1 << 62, -(1 << 63), (1 << 63) - 1, None]
    rows = spark.createDataFrame([(i,) for i in ids], "i long").select("i", warc.record_id(warc.F.col("i")).alias("r")).collect()
    assert all(warc.id_of(x.r) == x.i for x in rows) and len({x.r for x in rows}) == len(ids)
