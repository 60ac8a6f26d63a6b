import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.sources.csv import enforce_schema, read_typed_csv
from medallion.sources.tables import overwrite_partitions, write_partitioned
from medallion.streaming.incremental import bronze_incremental

SCHEMA = T.StructType([T.StructField("id", T.StringType(), False), T.StructField("ano", T.IntegerType(), False),
                       T.StructField("nota", T.DoubleType())])


def _write(d, name, text):
    with open(os.path.join(d, name), "w") as fh:
        fh.write(text)


def test_quarantine_and_failfast(spark):
    d = tempfile.mkdtemp(prefix="csv-")
    _write(d, "extract_2020.csv", "id,ano,nota\na,2020,1.5\nb,2020,abc\n,2020,3.0\nc,2020,\n")
    good, bad = enforce_schema(spark, f"{d}/extract_2020.csv", SCHEMA)
    assert sorted(r["id"] for r in good.collect()) == ["a", "c"]
    reasons = sorted(((r["_raw_id"], r["_reject_reason"], tuple(r["_bad_fields"])) for r in bad.collect()), key=str)
    assert reasons == sorted([(None, "null_required", ()), ("b", "unparsable", ("nota",))], key=str)
    # selecting only some columns must not hide the bad cell
    assert good.select("id").count() == 2
    df, _ = enforce_schema(spark, f"{d}/extract_2020.csv", SCHEMA, mode="failfast")
    with pytest.raises(Exception):
        df.collect()
    assert read_typed_csv(spark, f"{d}/extract_2020.csv", SCHEMA).count() == 4


def test_overwrite_partitions_idempotent(spark):
    path = tempfile.mkdtemp(prefix="part-") + "/t"
    df = spark.createDataFrame([("a", 2020, 1.0), ("b", 2021, 2.0)], "id string, ano int, nota double")
    write_partitioned(df, path, ["ano"])
    redo = spark.createDataFrame([("z", 2021, 9.0)], "id string, ano int, nota double")
    overwrite_partitions(redo, path, ["ano"], expected={"ano": 2021})
    overwrite_partitions(redo, path, ["ano"], expected={"ano": 2021})
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("a", 1.0, 2020), ("z", 9.0, 2021)]
    wrong = spark.createDataFrame([("q", 2020, 1.0)], "id string, ano int, nota double")
    with pytest.raises(Exception):
        overwrite_partitions(wrong, path, ["ano"], expected={"ano": 2021})


def test_lines_of_the_wrong_width_are_rejected(spark):
    d = tempfile.mkdtemp(prefix="wide-")
    _write(d, "extract_2020.csv", "id,ano,nota\na,2020,1.0\nb,2020\nc,2020,1.0,EXTRA\nd,2020,x\n")
    good, bad = enforce_schema(spark, f"{d}/extract_2020.csv", SCHEMA)
    assert [r["id"] for r in good.select("id").collect()] == ["a"]
    assert {r["_raw_line"] or r["id"]: r["_reject_reason"] for r in bad.collect()} == {
        "b,2020": "malformed", "c,2020,1.0,EXTRA": "malformed", "d": "unparsable"}


def test_files_split_over_batches_and_runs_lose_nothing(spark):
    src, tgt, ck = (tempfile.mkdtemp(prefix=p) for p in ("in-", "out-", "ck-"))
    for run in range(2):
        for k in range(3):
            _write(src, f"part_{run}_{k}.csv", f"id,ano,nota\n{run}{k},2020,1.0\n")
        bronze_incremental(spark, src, SCHEMA, tgt + "/t", ["ano"], ck, max_files_per_trigger=1)
    assert sorted(r["id"] for r in spark.read.parquet(tgt + "/t").select(F.col("id").cast("string")).collect()) == [
        "00", "01", "02", "10", "11", "12"]


def test_an_emptied_partition_and_stale_rejects_go(spark):
    from medallion import jobs
    path = tempfile.mkdtemp(prefix="ow-") + "/t"
    rows = spark.createDataFrame([("a", 2020), ("b", 2021)], "id string, ano int")
    overwrite_partitions(rows, path, ["ano"])
    overwrite_partitions(rows.where("false"), path, ["ano"], expected={"ano": 2021})
    assert [r["id"] for r in spark.read.parquet(path).collect()] == ["a"]
    d = tempfile.mkdtemp(prefix="rej-")
    for nota, rejected in (("x", 1), ("2.0", 0)):
        _write(d, "extract_2020.csv", f"id,ano,nota\na,2020,1.0\nb,2020,{nota}\n")
        out = jobs.bronze(spark, d, d + "-bronze", SCHEMA)
        assert out == {"rows": 2 - rejected, "rejected": rejected}
        import os
        assert sum(f.endswith(".parquet") for _, _, fs in os.walk(d + "-bronze_rejects") for f in fs) == rejected


def test_incremental_picks_up_new_files_once(spark):
    src, tgt, ck = (tempfile.mkdtemp(prefix=p) for p in ("in-", "out-", "ck-"))
    _write(src, "extract_2020.csv", "id,ano,nota\na,2020,1.0\n")
    bronze_incremental(spark, src, SCHEMA, tgt + "/t", ["ano"], ck)
    _write(src, "extract_2021.csv", "id,ano,nota\nb,2021,2.0\n")
    bronze_incremental(spark, src, SCHEMA, tgt + "/t", ["ano"], ck)
    bronze_incremental(spark, src, SCHEMA, tgt + "/t", ["ano"], ck)
    got = sorted((r["id"], r["ano"]) for r in spark.read.parquet(tgt + "/t").collect())
    assert got == [("a", 2020), ("b", 2021)]


def test_absent_years_skipped_with_warning(spark):
    import warnings as w
    from medallion.sources.csv import existing_year_paths
    d = tempfile.mkdtemp(prefix="yrs-")
    _write(d, "extract_2020.csv", "id,ano,nota\na,2020,1.0\n")
    with w.catch_warnings(record=True) as caught:
        w.simplefilter("always")
        paths = existing_year_paths(spark, d, [2020, 2021])
    assert paths == [f"{d}/extract_2020.csv"] and any("2021" in str(c.message) for c in caught)
