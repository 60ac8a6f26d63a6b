import json

import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from medallion.llm import token_counts as tc
from medallion.llm.bpe import read_spec
from tests.llm.helpers import documents, prose

SPEC = read_spec(public_tokenizers.path("word_bpe_49k.json"))
BYTES = read_spec(public_tokenizers.path("byte_bpe_50k.json"))

ODD = [None, "", " \t\n ", "Hello WORLD's  it'LL x1234", "<|startoftext|>a<|endoftext|><|endoftext|> b", "ΟΔΟΣ ΣΊΣΥΦΟΣ İstanbul ǅ",
       "Café and Café", "日本語の文 ﬁ ² ½", "\U0001f389\U0001f3fd!!", "Ꟍ Ᲊ \U00010d50", "\x00\x1c\x85a\xa0b c", "a" * 3000,
       "xq" * 4000 + "." * 2000, "''''s's 's", "9" * 500, "<|endoftext|", "ÀÉÎõü ß ẞ"]


@pytest.mark.parametrize("spec", [SPEC, BYTES])
def test_counts_against_library(spark, spec):
    texts = ODD + [prose(k, 200) for k in range(10)] + [prose(1, 5)] * 2
    df = documents(spark, texts).withColumn("id", F.lit("x")).withColumn("n_tokens", F.lit(0)).repartition(3)
    lib = tokenizers.Tokenizer.from_str(spec)
    got = {r.doc_id: r for r in tc.token_counts(df, spec, limit=50).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        want = len(lib.encode(t or "", add_special_tokens=False).ids)
        assert (got[k].n_tokens, got[k].n_bytes, got[k].over_limit) == (want, len((t or "").encode()), want > 50), t


def test_known_characters_agree_with_library():
    lib, own = tokenizers.Tokenizer.from_str(SPEC), tc.TokenCounter(SPEC, frozenset())
    back = own.counts.merger.back
    for i in range(0x530):
        for t in (chr(i), f"a{chr(i)}1{chr(i)}.{chr(i)} '{chr(i)}s"):
            want = [bytes(back[c] for c in p).decode() for p, _ in lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(t))]
            assert own.split.findall(own.normal(t)) == want, hex(i)


def test_whole_tokens_are_proved(spark):
    whole = tc.whole_tokens(SPEC)
    lib = tokenizers.Tokenizer.from_str(SPEC)
    vocab = json.loads(SPEC)["model"]["vocab"]
    letter = {b: c for c, b in tc._byte_alphabet().items()}
    some = sorted(whole)[::97]
    assert len(whole) > 30_000
    for t in some:
        if lib.normalizer.normalize_str(t) == t and len(lib.pre_tokenizer.pre_tokenize_str(t)) == 1:
            assert lib.encode(t, add_special_tokens=False).ids == [vocab["".join(letter[b] for b in t.encode()) + "</w>"]]
    # a merge changes nothing where the shortcut counts: without it all counts are the same
    bare, full = tc.TokenCounter(SPEC, frozenset()), tc.TokenCounter(SPEC, whole)
    for t in [t or "" for t in ODD] + ["the cat sat on the mat"]:
        assert bare.count(t)[0] == full.count(t)[0] and bare.count(t)[2] == 0
    assert full.count("the cat sat on the mat") == (6, 6, 6)


def test_empty_table_repeated_and_null_ids(spark):
    df = documents(spark, ["a b", "a b", "c"], ids=[None, 3, 3])
    assert tc.token_counts(df.filter("false"), SPEC).count() == 0
    assert sorted(r.n_tokens for r in tc.token_counts(df, SPEC).collect()) == [1, 2, 2]


@pytest.mark.parametrize("change", [{"normalizer": {"type": "NFKD"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": None}])
def test_other_files_are_refused(change):
    with pytest.raises(ValueError):
        tc.TokenCounter(json.dumps(json.loads(SPEC) | change), frozenset())
