import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from medallion.llm.bpe import bpe_decode, bpe_digest, bpe_encode, codec_of, read_spec
from tests.llm.helpers import documents, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(PATH)


def samples():
    rnd = random.Random(6)
    out = ["", " ", "\n\n \t a", "<|endoftext|>x <|endoftext|>", "<|endoftext", "日本語 😀👍🏽 á", "don't we'LL 12345", "-" * 700,
           "a" * 999 + " " * 50, prose(1, 400), "\x00\x7f\ufeff\u2028\u3000x"]
    return out + ["".join(rnd.choice("abe th\n.'1é−") for _ in range(80)) for _ in range(300)]


def test_ids_and_text_are_the_librarys(theirs):
    codec = codec_of(read_spec(PATH))
    for text, want in zip(samples(), theirs.encode_batch(samples(), add_special_tokens=False)):
        got = codec.encode(text)
        assert got == want.ids
        assert codec.decode(got) == theirs.decode(got, skip_special_tokens=False)
    cut = [theirs.encode("é日", add_special_tokens=False).ids[0]]  # part of a character
    assert codec.decode(cut) == theirs.decode(cut, skip_special_tokens=False)


def test_documents(spark, theirs):
    texts = [*samples()[:20], None, "long " * 40_000]
    df = documents(spark, texts, ids=[*range(len(texts) - 1), None])
    spec = read_spec(PATH)
    by_id = dict(zip([*range(len(texts) - 1), None], texts))
    rows = bpe_digest(df, spec).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = theirs.encode(by_id[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((by_id[r.doc_id] or "").encode()).hexdigest()
    back = {r.doc_id: r.text for r in bpe_decode(bpe_encode(df, spec), spec).collect()}
    assert back == {k: v or "" for k, v in by_id.items()}
    assert bpe_digest(df.filter("false"), spec).count() == 0


@pytest.mark.parametrize("change", [{"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}},
                                    {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "use_regex": True}}])
def test_other_tokenizer_files_are_refused(change):
    import json

    with pytest.raises(ValueError):
        codec_of(json.dumps(json.loads(read_spec(PATH)) | change))


def test_repeated_ids_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    df = documents(spark, ["a b", "a b", None], ids=[1, 1, None]).withColumn("n_tokens", F.lit("x")).withColumn("__t", F.lit(1))
    rows = bpe_digest(df, read_spec(PATH)).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == [("1", 2), ("1", 2), ("None", 0)]
    assert bpe_digest(df.filter("false"), read_spec(PATH)).count() == 0
