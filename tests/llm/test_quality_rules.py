import re
from collections import Counter

from pyspark.sql import functions as F

from medallion.llm.quality_rules import quality_clean, quality_report
from tests.llm.helpers import documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLEAN = "\n".join(prose(k, 24) for k in range(4))
TEXTS = [
    CLEAN, None, "", " \t\n ", "one two three " * 40, "the cat sat on the mat the cat sat on the rug " + prose(1, 60),
    " | ".join(prose(2, 60).split()), "\n".join(["All rights reserved. " + prose(3, 30)] * 3),
    CLEAN + "\nHome | About | News | Contact | Help\nThis site uses cookies.", "\n".join(w + "!!" for w in prose(4, 80).split()),
    "line a b\nline a b\n\nline a b\r\n" + prose(5, 60), "# $ % & | < >\n" + prose(6, 60), prose(7, 30_000), "a b a b a b a b",
]


def base(text):
    t = text or ""
    w = WORD.findall(t)
    tri = Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if tri[x] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit), failed)


def test_base_measures_against_brute_force(spark):
    df = documents(spark, TEXTS).withColumn("n_words", F.lit("clash"))
    for r in quality_report(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(TEXTS[r.doc_id])


def test_verdicts(spark):
    kept = {r.doc_id: r.kept for r in quality_report(documents(spark, TEXTS)).collect()}
    assert {i for i, k in kept.items() if k} == {0, 5, 8, 10, 11, 12}


def test_many_repeated_windows_take_the_sorted_path(spark):
    text = " ".join(prose(k % 40, 12) for k in range(80))
    r = quality_report(documents(spark, [text])).first()
    assert r.n_repeat_words == base(text)[4]


def test_cleaning_takes_lines_out(spark):
    df = documents(spark, TEXTS)
    out = {r.doc_id: r for r in quality_clean(df).collect()}
    assert out[0].text == CLEAN and out[8].text == CLEAN and out[8].n_chars == len(CLEAN)
    assert quality_clean(df).columns == df.columns
    assert quality_clean(df.filter("false")).count() == 0


FAILING = ["Tous droits réservés, Paris.", "ALLE RECHTE VORBEHALTEN", "Utiliza cookies propias", "Conditions d'utilisation", "© Beispiel Verlag",
           "(c) 1999 by someone", "Inicio > Noticias > Deportes > Tenis", "https://a.b/c  www.d.e/f", "<div class=x>text", "a { color: red }",
           "onload = function (x) {", "SPDX-License-Identifier: MIT", "GPL-3.0 or later", "Home | About | News | Contact | Help", "***", "wow!!!! so??"]
PASSING = ["Er sagte: alles ist gut; sie ging.", "See https://a.b/c for more.", "5 < 6 and 7 > 3, he said.", "The function (of x) is clear.",
           "Le chat (noir) dort.", "Apache helicopters flew.", "El precio es 3/4 de antes.", "Rates rose from 3.5 to 4.0 percent"]


def test_lines_fail_by_form_and_by_phrases_of_four_languages(spark):
    body = "\n".join(prose(k, 60) for k in range(6))
    docs = documents(spark, [body + "\n" + x for x in FAILING + PASSING])
    out = {r.doc_id: r.text for r in quality_clean(docs).collect()}
    for k, x in enumerate(FAILING + PASSING):
        assert (out[k] == body) == (x in FAILING) and (x in FAILING or out[k] == body + "\n" + x), x
