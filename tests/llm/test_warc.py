import base64
import gzip
import hashlib
import io
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from medallion.llm.warc import arc_record, arc_version_block, convert_arc, read_arc, warc_index, warc_roundtrip, write_arc, write_warc


def brute(rows, least):
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[html or ""].append(i)
    out = []
    for i, _, html in rows:
        b = (html or "").encode()
        lead = max(groups[html or ""])
        kept = i == lead or len(b) < least
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if kept else "revisit",
                    None if kept else lead))
    return sorted(out)


PAGES = [(0, "http://a/x y", "<p>é</p>"), (1, "http://b", "<p>é</p>"), (2, None, None), (3, "http://c", ""), (4, "u", "WARC/1.1\r\n\r\n\r\nx"),
         (5, "u", "a\nhttp://x 0 0 0 5\n\n"), (6, "é", "z" * 300_000), (7, "é", "z" * 300_000), (8, "", "<p>é</p>")]


@pytest.mark.parametrize("least", [0, 5])
def test_pages_come_back(spark, least):
    df = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, record_type string")
    rows = warc_roundtrip(df, min_bytes=least).collect()
    assert all(r.intact for r in rows)
    assert sorted(tuple(r)[:5] for r in rows) == brute(PAGES, least)


def test_empty_null_and_repeated_ids(spark):
    schema = "page_id long, url string, html string"
    assert warc_roundtrip(spark.createDataFrame([], schema)).count() == 0
    rows = warc_roundtrip(spark.createDataFrame([(1, "u", "x"), (1, "u", "x"), (None, "u", "x")], schema)).collect()
    assert sorted((str(r.page_id), r.record_type, r.refers_to) for r in rows) == [
        ("1", "response", None), ("1", "revisit", 1), ("None", "revisit", 1)]


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    data = arc_version_block(version, "f.arc", "20000101000000") + b"\n"
    data += arc_record(version, "f.arc", "http://a/old url", "1.2.3.4", "19990101000000", "text/html", b"HTTP/1.0 200\r\n\r\nbody", 9) + b"\n"
    got = list(read_arc(io.BytesIO(data), "f"))
    assert [(r["url"], r["ip"], r["date"], r["mime"], r["doc"], r["version"]) for r in got] == [
        ("http://a/old url", "1.2.3.4", "19990101000000", "text/html", b"HTTP/1.0 200\r\n\r\nbody", version)]
    with pytest.raises(ValueError, match="declared"):
        list(read_arc(io.BytesIO(data[:-6]), "f"))
    with pytest.raises(ValueError, match="version block"):
        list(read_arc(io.BytesIO(b"http://a 0 0 t 3\nabc"), "f"))


def test_conversion_fields(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    write_arc(df.repartition(3), str(tmp_path / "arc"))
    rows = convert_arc(spark, str(tmp_path / "arc")).collect()
    assert len({r.record_id for r in rows}) == len(PAGES) and {r.date for r in rows} == {"2024-01-01T00:00:00Z"}
    assert {(int(r.page), r.uri) for r in rows} >= {(0, "http://a/x%20y"), (2, "urn:unknown"), (6, "%C3%A9")}
    assert convert_arc(spark, str(tmp_path / "arc"), payloads=False).filter(F.col("payload").isNotNull()).count() == 0


def test_files_are_cut_by_bytes(spark, tmp_path):
    """Files end soon after their bytes are reached, and every record is read once."""
    rows = [(k, f"http://a/{k}", "x" * (k % 7) * 1000 + str(k)) for k in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    write_arc(df, str(tmp_path / "arc"), file_bytes=50_000)
    files = list((tmp_path / "arc").rglob("*.gz"))
    sizes = [len(gzip.decompress(f.read_bytes())) for f in files]
    assert len(files) > 15 and max(sizes) < 58_000
    records = convert_arc(spark, str(tmp_path / "arc"))
    got = records.collect()
    assert len({r.record_id for r in got}) == 300 and {int(r.page) for r in got} == set(range(300))
    for f in files:  # the offsets that version 2 states are true
        data = gzip.decompress(f.read_bytes())
        for r in read_arc(io.BytesIO(data), f.name):
            if r["version"] == 2:
                line = data[r["offset"]:].split(b"\n", 1)[0].split(b" ")
                assert int(line[-3]) == r["offset"]
    leads = records.withColumn("lead_record_id", F.lit(None).cast("string")).withColumn("lead_uri", F.lit("")).withColumn("lead_date", F.lit(""))
    write_warc(leads, str(tmp_path / "warc"), file_bytes=50_000)
    back = warc_index(spark, str(tmp_path / "warc"))
    assert back.filter("intact").count() == 300 and len(list((tmp_path / "warc").rglob("*.gz"))) > 15


def test_unique_pages_do_not_meet_in_one_task(spark):
    """Without a broadcast no task of the last join gets the pages that refer to none."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(2000).selectExpr("id as page_id", "concat('http://a/', id) as url", "concat('<p>', id % 1990) as html")
        out = warc_roundtrip(df)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert out.filter("record_type = 'revisit'").count() == 10 and "Union" in plan
        join = plan[plan.index("Join LeftOuter"):]
        assert "(record_type" in join and "= revisit)" in join
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
