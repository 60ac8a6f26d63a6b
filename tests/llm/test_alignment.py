import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from medallion.llm import alignment
from medallion.llm.alignment import align_links, align_report, lanes, linked, lockstep
from medallion.llm.bpe import read_spec
from tests.llm.helpers import documents, prose

SPEC = read_spec(public_tokenizers.path("byte_bpe_50k.json"))
with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
    MODEL = f.read()

ODD = [None, "", " ", "  two  spaces ", "\n\n\ta\n b\r\n", "<|endoftext|> plain", "<s> </s> <0x0A> <unk>", "a▁b", "ﬁ café café",
       "\U0001f389\U0001f389\U0001f3fd x", "日本語の文", "x" * 5000, "a1" * 1500, "same text", "same text", "\x00z", "... !!! ???"]


def brute(texts):
    a = tokenizers.Tokenizer.from_str(SPEC)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    back = alignment._byte_alphabet()
    names = {i: t for t, i in a.get_vocab(with_added_tokens=False).items()}
    rows, held = [], Counter()
    for t in texts:
        x, y = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        bx = [bytes(back[c] for c in names[i]) for i in x]
        by = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if not t or not b"".join(bx) == b"".join(by) == (" " + t).encode():
            rows.append(None)
            continue
        ex, ey = np.cumsum([len(v) for v in bx]).tolist(), np.cumsum([len(v) for v in by]).tolist()
        groups, i, j = [], 0, 0
        at_x, at_y = ({e: k + 1 for k, e in enumerate(es)} for es in (ex, ey))
        for cut in sorted(set(ex) & set(ey)):
            i2, j2 = at_x[cut], at_y[cut]
            groups.append((x[i:i2], y[j:j2]))
            i, j = i2, j2
        links = Counter((p, q) for g in groups for p in g[0] for q in g[1])
        held.update(links.keys())
        rows.append((len(x), len(y), groups, links))
    top = {}
    for (p, _), n in held.items():
        top[p] = max(top.get(p, 0), n)
    out = []
    for r in rows:
        if r is None:
            out.append((0,) * 6 + ("",))
            continue
        n_a, n_b, groups, links = r
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((n_a, n_b, len(groups), sum(links.values()), sum(n for k, n in links.items() if held[k] == top[k[0]]),
                    sum(n * held[k] for k, n in links.items()), hashlib.sha256(said.encode()).hexdigest()))
    return out


def test_report_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BATCH_TOKENS", 3000)  # several batches and blocks a task
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", 500)
    texts = ODD + [prose(k, 40 + k) for k in range(20)] + [prose(3, 60)] * 3
    df = documents(spark, texts).withColumn("block", F.lit("b")).withColumn("count", F.lit(1)).repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in align_report(df, SPEC, MODEL).collect()}
    assert got == dict(enumerate(brute(texts)))
    assert align_report(df, SPEC, MODEL).columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_empty_table_null_and_repeated_ids(spark):
    df = documents(spark, ["one two", "one two", "x"], ids=[None, 4, 4])
    assert align_report(df.filter("false"), SPEC, MODEL).count() == 0
    got = sorted((r.doc_id is None, r.n_a) for r in align_report(df, SPEC, MODEL).collect())
    assert len(got) == 3 and got[-1][0]


def test_lanes_and_lockstep_against_sets():
    rng = np.random.default_rng(5)
    ends_a, ends_b, starts = [], [], []
    for size in (1, 2, 7, 400, 3000, 20000):
        a, b = (np.unique(np.append(rng.integers(1, size + 1, size // 3 + 1), size)) for _ in range(2))
        starts.append((len(ends_a), len(ends_b), len(ends_a) + len(a), len(ends_b) + len(b)))
        ends_a += a.tolist()
        ends_b += b.tolist()
    ends_a, ends_b, starts = np.array(ends_a), np.array(ends_b), np.array(starts)
    cut = lanes(ends_a, ends_b, starts, 50)
    assert len(cut) > len(starts) and (cut[:, 2] - cut[:, 0]).max() < 200
    *runs, cut_a, cut_b = lockstep(ends_a, ends_b, cut)
    got = {(int(x), int(y)) for i, j in linked(runs, 100) for x, y in zip(i, j)}
    assert sum(len(i) for i, _ in linked(runs)) == len(got)
    want, cuts = set(), []
    for a, b, a_end, b_end in starts.tolist():
        i, j = a, b
        for end in sorted(set(ends_a[a:a_end].tolist()) & set(ends_b[b:b_end].tolist())):
            i2 = a + int(np.searchsorted(ends_a[a:a_end], end)) + 1
            j2 = b + int(np.searchsorted(ends_b[b:b_end], end)) + 1
            want |= {(x, y) for x in range(i, i2) for y in range(j, j2)}
            cuts.append((i2 - 1, j2 - 1))
            i, j = i2, j2
    assert got == want and sorted(zip(cut_a.tolist(), cut_b.tolist())) == cuts


def test_groups_spell_the_text(spark):
    texts = [prose(2, 30), "", None, "café \U0001f389"]
    got = {r.doc_id: r.groups for r in align_links(documents(spark, texts), SPEC, MODEL).collect()}
    b = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    assert got[1] == got[2] == []
    assert b.decode([i for g in got[0] for i in g.b]) == texts[0]
    assert [i for g in got[3] for i in g.b] == b.encode(texts[3])


def test_very_long_text(spark):
    text = " ".join(prose(k, 500) for k in range(40))
    got = align_report(documents(spark, [text]), SPEC, MODEL).first()
    assert tuple(got)[1:] == brute([text])[0]


def test_ranks_agree_with_the_merges_of_the_file():
    """Side A by ranks and by the file's own library give the same ids."""
    pair = alignment._Pair(SPEC, MODEL)
    assert pair.fast is not None
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghij ABC019.,'\n\t-éüßñ<|>"))
    texts = [prose(k, 300) for k in range(20)] + ["".join(rng.choice(letters, 400)) for _ in range(300)] + [t for t in ODD if t]
    texts += ["a" + " " * 50_000 + "b", "x" * 50_000, "." * 50_000, "\n\t" * 20_000]
    by_file = [e.ids for e in pair.a.encode_batch_fast(texts, add_special_tokens=False)]
    assert pair._encode_a(texts) == by_file
    pair.fast = None
    assert pair._encode_a(texts) == by_file
