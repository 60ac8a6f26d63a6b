"""Property tests (hypothesis) on small generated inputs."""

import decimal
import json
import os
import tempfile

from hypothesis import given, settings
from hypothesis import strategies as st

from medallion.functions import snap_round
from medallion.operators import sets
from medallion.sources.commit_log import history_from_log

SETTINGS = settings(max_examples=15, deadline=None)


@SETTINGS
@given(st.lists(st.integers(min_value=-10**7, max_value=10**7), min_size=1, max_size=30),
       st.integers(min_value=0, max_value=3))
def test_snap_round_is_decimal_half_up(spark, values, digits):
    xs = [v / 1000 for v in values]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double")
           .select(snap_round("x", digits)).collect()]
    q = decimal.Decimal(1).scaleb(-digits)
    want = [float(decimal.Decimal(repr(x)).quantize(q, rounding=decimal.ROUND_HALF_UP)) for x in xs]
    assert got == want


rows = st.lists(st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "a", "b"])), max_size=12)


@SETTINGS
@given(rows, rows)
def test_symmetric_difference_strategies_agree(spark, a, b):
    sch = "k int, v string"
    da, db = spark.createDataFrame(a, sch), spark.createDataFrame(b, sch)
    x = sorted(map(tuple, sets.symmetric_difference(da, db).collect()), key=str)
    y = sorted(map(tuple, sets.symmetric_difference(da, db, strategy="except").collect()), key=str)
    assert x == y
    assert sets.symmetric_difference(da, da).count() == 0


def test_history_from_flat_log(spark):
    """A log with one file per version named by the version, whose commit
    records may lack the version field."""
    d = tempfile.mkdtemp(prefix="flatlog-")
    for v, op in enumerate(["WRITE", "MERGE"]):
        lines = [{"commitInfo": {"timestamp": 1700000000000 + v, "operation": op,
                                 "operationParameters": {"mode": "Overwrite"}}},
                 {"metaData": {"schemaString": '{"type":"struct","fields":[]}'}}]
        with open(os.path.join(d, f"{v:020d}.json"), "w") as fh:
            fh.write("\n".join(json.dumps(x) for x in lines) + "\n")
    h = history_from_log(spark, d).orderBy("version").select("version", "operation").collect()
    assert [tuple(r) for r in h] == [(0, "WRITE"), (1, "MERGE")]
