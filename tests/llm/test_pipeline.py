import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from medallion.llm.common import table
from tests.llm.helpers import documents, prose


def test_stages_keep_columns_and_their_order(spark, sf001):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mixing", "bpe"]
    docs = table(spark, sf001, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(30), sf001).columns == docs.columns


def test_decisions_take_effect(spark, tmp_path):
    clean = [prose(k, 120) for k in range(12)]
    near = clean[0].split()
    near[60] = "changed"
    texts = [*clean, clean[1].upper(), " ".join(near), "too short", "\n".join(w + "!!" for w in prose(50, 90).split())]
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in rows}
    # 12 and 1 are equal: the largest id stays; 13 is near 0: one of them stays; 14 and 15 are rejected
    assert ids == {0, *range(2, 12), 12}
    for r in rows:
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


CLASHES = ["__t", "__id", "__n", "__key", "__kept", "__node", "__place", "__row", "__in", "text.raw", "Text2"]


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]])
def test_columns_of_any_name_come_out_as_they_went_in(spark, sf001, stage):
    docs = documents(spark, [prose(k, 80) for k in range(6)], sources=list("aabbcc"))
    docs = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in CLASHES])
    out = stage(spark, docs, sf001)
    assert out.columns == docs.columns
    rows = out.collect()
    assert {r.doc_id for r in rows} == set(range(6))
    for r in rows:
        assert [r[c] for c in CLASHES] == [f"{c}{r.doc_id}" for c in CLASHES]


def test_pipeline_of_clashing_columns_nulls_and_long_texts(spark, tmp_path):
    long = " ".join(prose(k, 400) for k in range(50))
    texts = [prose(1, 100), None, "", long, long.upper(), " ".join([long, "more"])]
    docs = documents(spark, texts).select("*", *[F.lit(c).alias(c) for c in CLASHES if "." not in c])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(rows) in ({0, 4}, {0, 5}) and max(r.n_tokens for r in rows.values()) > 20_000


def test_pipeline_of_an_empty_table(spark, tmp_path):
    documents(spark, [prose(1, 60)]).filter("false").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
