"""Line-first cleaning with built-in expressions; no shuffle, one row at a time.

Every line that holds a word is tested against three rules; failing lines are
removed, and a document that loses more than ``max_lost`` of its word characters
is rejected, as is one that fails the base measures:

* punctuation: hardly anything but marks (no letter or digit, or marks that
  close no clause make up more than ``max_marks`` of its characters);
* navigation: more than ``max_separators`` menu separators;
* boilerplate: script, cookie, licence and copyright notices, by phrases of the corpus's
  four languages and, whatever the language, by their form (``structure``: rows of links,
  copyright signs and years, names of licences, tags, script and style code, breadcrumbs).

Null text has no words.  Blank lines are neither tested nor removed.  A
document without a word loses nothing and fails on its word count.  Windows of three
words are told apart by a 64-bit hash, so repeats are exact up to its collisions.  Rows
that repeat an id are judged each, an empty table gives no rows, and columns of any name
come out as they went in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import WORD, col, packed, text_or_empty, unpacked, words

SYMBOLS = r"[#*$%&|<>]"
SPACE = r"[\x20\x09-\x0D]"
MARKS = r"[!?#*$%&|<>=~^_\\/+{}\[\]@•»«›‹…]"


@dataclass(frozen=True)
class LineRules:
    max_marks: float = 0.15
    separators: str = r"[|•»›]"
    max_separators: int = 3
    boilerplate: tuple[str, ...] = (
        "enable javascript", "javascript is disabled", "uses cookies", "accept cookies", "cookie policy",
        "privacy policy", "terms of use", "terms of service", "all rights reserved", "lorem ipsum",
        "licensed under", "spdx-license-identifier", "permission is hereby granted", "copyright (c)",
        "subscribe to our newsletter", "click here to", "skip to content",
        "tous droits réservés", "mentions légales", "politique de confidentialité", "conditions d'utilisation", "accepter les cookies",
        "utilise des cookies", "abonnez-vous à", "cliquez ici pour", "aller au contenu",
        "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "verwendet cookies", "cookies akzeptieren",
        "newsletter abonnieren", "klicken sie hier", "zum inhalt springen",
        "todos los derechos reservados", "aviso legal", "política de privacidad", "condiciones de uso", "aceptar cookies", "utiliza cookies",
        "suscríbete a", "haga clic aquí", "saltar al contenido")
    structure: str = (
        r"(?:https?://|www\.)[^ \t\n]+[ \t]+(?:https?://|www\.)|©|\([cC]\)[ \t]*[12][0-9]{3}"
        r"|(?:GPL|SPDX|AGPL|LGPL|CC[ -]BY(?:[ -][A-Z]{2})*|Apache|Mozilla Public)[ -](?:[Ll]icen[sc]e|[0-9]+\.[0-9])"
        r"|</?[a-zA-Z][a-zA-Z0-9]*(?:[ \t][^<>\n]*)?>|function[ \t]*\([^()\n]*\)[ \t]*\{|\{[^{}\n]*[:;][^{}\n]*\}"
        r"|(?:[ \t][>/·][ \t][^>/·\n]+){3}")
    #: Every match of ``structure`` holds one of these.
    signs: tuple[str, ...] = ("http", "www.", "©", "(c)", "(C)", "GPL", "SPDX", "CC", "Apache", "Mozilla", "<", "{", ">", "·", " /", "\t/")
    max_lost: float = 0.5
    min_words: int = 50
    max_repeat_pct: int = 50


def _line_fails(line: Column, low: Column, said: Column, formed: Column, r: LineRules) -> Column:
    """``said`` and ``formed``: whether any line of the text can fail by a phrase or by form."""
    phrases = F.array(*[F.lit(p) for p in r.boilerplate])
    return (~line.rlike(r"[\p{L}\p{N}]")
            | (F.regexp_count(line, F.lit(MARKS)) > F.char_length(line) * F.lit(r.max_marks))
            | (F.regexp_count(line, F.lit(r.separators)) > r.max_separators)
            | (formed & line.rlike(r.structure))
            | (said & F.exists(phrases, lambda p: F.contains(low, p))))


# Up to so many repeated windows are looked up one by one, more by a sort.
_FEW = 48


def _repeat_words() -> Column:
    """Words covered by a 3-word window found at least twice.  ``__hash`` holds
    the 64-bit hash of each window and ``__rep`` the repeated ones.  With many of
    them, sorting (hash, place) puts equal windows side by side.  The covered
    places are counted once each."""
    few = "filter(transform(__hash, (x, i) -> if(array_contains(__rep, x), i, -1)), i -> i >= 0)"
    pairs = "sort_array(transform(__hash, (x, i) -> struct(x as h, i as i)))"
    many = (f"transform(array({pairs}), s -> transform(filter(s, (x, i) -> (i > 0 and s[i - 1].h = x.h) "
            "or (i < size(s) - 1 and s[i + 1].h = x.h)), x -> x.i))[0]")  # array(...)[0] binds the pairs once
    return F.expr("case when size(__rep) = 0 then 0 else size(array_distinct(flatten(transform("
                  f"if(size(__rep) <= {_FEW}, {few}, {many}), i -> array(i, i + 1, i + 2))))) end").cast("long")


def _holds(text: str, any_of: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for part in any_of:
        out = out | F.contains(F.col(text), F.lit(part))
    return out


def quality_measures(df: DataFrame, text_col: str = "text", rules: LineRules | None = None) -> DataFrame:
    """``df`` plus ``__``-columns: the base measures, cleaned text, verdicts."""
    r = rules or LineRules()
    d = df.withColumn("__t", text_or_empty(text_col))
    d = d.withColumns({"__w": words(F.col("__t")), "__lines": F.split("__t", "\n")})
    d = d.withColumns({
        "__n_words": F.size("__w").cast("long"),
        "__word_chars": (F.char_length("__t") - F.regexp_count("__t", F.lit(SPACE))).cast("long"),
        "__n_symbols": F.regexp_count("__t", F.lit(SYMBOLS)).cast("long"),
        "__full": F.filter("__lines", lambda x: x.rlike(WORD)),
        "__hash": F.expr("case when size(__w) < 3 then array() else "
                         "transform(slice(__w, 1, size(__w) - 2), (x, i) -> xxhash64(x, __w[i + 1], __w[i + 2])) end"),
        "__both": F.transform("__lines", lambda x: F.struct(x.alias("l"), F.lower(x).alias("low"))),
        "__low": F.lower("__t"),
    })
    # one look at the whole text for fixed strings spares most texts the look at every line;
    # held in a struct, it is taken once and not for each line
    seen = F.struct(_holds("__low", r.boilerplate).alias("said"), _holds("__t", r.signs).alias("formed"), F.col("__both").alias("lines"))
    d = d.drop("__w", "__lines").withColumns({
        "__n_dup_lines": (F.size("__full") - F.size(F.array_distinct("__full"))).cast("long"),
        "__sorted": F.sort_array("__hash"),
        "__good": F.transform(F.array(seen), lambda s: F.filter(
            s["lines"], lambda x: ~(x["l"].rlike(WORD) & _line_fails(x["l"], x["low"], s["said"], s["formed"], r))))[0],
    })
    d = d.drop("__both", "__full", "__low").withColumns({
        "__rep": F.expr("case when size(array_distinct(__hash)) = size(__hash) then array() else "
                        "array_distinct(filter(__sorted, (x, i) -> i > 0 and __sorted[i - 1] = x)) end"),
        "__clean": F.array_join(F.col("__good.l"), "\n"),
    })
    d = d.drop("__good", "__sorted").withColumns({
        "__n_repeat_words": _repeat_words(),
        "__left": (F.char_length("__clean") - F.regexp_count("__clean", F.lit(SPACE))).cast("long")})
    d = d.drop("__hash", "__rep")
    failed = ((F.col("__n_words") < r.min_words)
              | (100 * F.col("__n_repeat_words") > r.max_repeat_pct * F.col("__n_words")))
    lost = F.col("__word_chars") - F.col("__left")
    return d.withColumns({"__base_failed": failed,
                          "__kept": ~failed & (lost <= F.lit(r.max_lost) * F.col("__word_chars"))})


_OUT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def quality_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   rules: LineRules | None = None) -> DataFrame:
    """One row per document: id, the base measures, both verdicts and the word
    characters its removed lines took."""
    d = quality_measures(df.select(col(id_col).alias("__id"), col(text_col).alias("__in")), "__in", rules)
    return d.select(F.col("__id").alias(id_col), *[F.col(f"__{c}").alias(c) for c in _OUT],
                    (F.col("__word_chars") - F.col("__left")).alias("lost_chars"))


def quality_clean(df: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars",
                  rules: LineRules | None = None) -> DataFrame:
    """The documents kept, failing lines removed, with their own columns;
    ``chars_col``, if there, is brought up to date."""
    d = quality_measures(packed(df, __in=col(text_col)), "__in", rules)
    # a column that is not a pure function of its row keeps the filter above the
    # measures; pushed below them it would hold, and work out, all of them again
    d = d.withColumn("__go", F.col("__kept") & (F.monotonically_increasing_id() >= 0)).filter("__go")
    new = {text_col: F.col("__clean")}
    if chars_col in df.columns:
        new[chars_col] = F.char_length("__clean").cast(df.schema[chars_col].dataType)
    return unpacked(d, df.columns, **new)
