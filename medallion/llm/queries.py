"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import public_tokenizers

from medallion.llm.alignment import align_report
from medallion.llm.bpe import bpe_digest, read_spec
from medallion.llm.common import WORD, table
from medallion.llm.conversations import damage_and_repair
from medallion.llm.exact_dedup import exact_labels
from medallion.llm.line_dedup import line_membership
from medallion.llm.lm_scoring import lm_scores
from medallion.llm.minhash import near_labels
from medallion.llm.mixing import mixing_report
from medallion.llm.quality_rules import MARKS, SPACE, SYMBOLS, LineRules, quality_report
from medallion.llm.sharding import shard_rows
from medallion.llm.token_counts import token_counts
from medallion.llm.url_filters import HOST_RULES, PATTERN_RULES, WORD_RULES, url_verdicts
from medallion.llm.warc import warc_roundtrip


def op1_lm_scoring(spark, sf_dir):
    return lm_scores(table(spark, sf_dir, "documents"))


def op2_url_filters(spark, sf_dir):
    return url_verdicts(table(spark, sf_dir, "pages"))


def op4_line_dedup(spark, sf_dir):
    return line_membership(table(spark, sf_dir, "documents"))


def op7_arc_to_warc(spark, sf_dir):
    return warc_roundtrip(table(spark, sf_dir, "pages"))


def op10_minimax_sharding(spark, sf_dir):
    return shard_rows(table(spark, sf_dir, "documents"), 8)


def op5_exact_dedup(spark, sf_dir):
    return exact_labels(table(spark, sf_dir, "documents"), keep="largest")


def op6_quality_rules(spark, sf_dir):
    return quality_report(table(spark, sf_dir, "documents"))


def op3_bagminhash(spark, sf_dir):
    return near_labels(table(spark, sf_dir, "documents")).drop("__node")


def op8_bpe(spark, sf_dir):
    return bpe_digest(table(spark, sf_dir, "documents"), read_spec(public_tokenizers.path("byte_bpe_50k.json")))


def op9_temperature_mixing(spark, sf_dir):
    return mixing_report(table(spark, sf_dir, "documents"))


def op11_lockstep_alignment(spark, sf_dir):
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    return align_report(table(spark, sf_dir, "documents"), read_spec(public_tokenizers.path("byte_bpe_50k.json")), model)


def op12_conversation_repair(spark, sf_dir):
    return damage_and_repair(table(spark, sf_dir, "conversations"))


def op13_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), read_spec(public_tokenizers.path("word_bpe_49k.json")))


QUERIES = {f.__name__: f for f in (
    op1_lm_scoring, op2_url_filters, op3_bagminhash, op4_line_dedup, op5_exact_dedup, op6_quality_rules,
    op7_arc_to_warc, op8_bpe, op9_temperature_mixing, op10_minimax_sharding, op11_lockstep_alignment, op12_conversation_repair,
    op13_token_counts)}

_NORM = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _url_sql() -> str:
    """Host rules by length, then words and patterns, tried in their order of preference."""
    by_length = sorted(HOST_RULES, key=lambda r: (len(r.name), r.name), reverse=True)
    words = sorted(WORD_RULES + PATTERN_RULES, key=lambda r: (len(r.name), r.name), reverse=True)

    def fits(rule):
        host, path = rule.name.split("/", 1)
        return f"((host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '/{path}'))"

    def says(rule):
        return f"regexp_matches(host || path, '{rule.pattern}')"

    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.name}'" for r in by_length) + " END"
    verdict = ("CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.verdict}'" for r in by_length)
               + " ".join(f" WHEN {says(r)} THEN '{r.verdict}'" for r in words) + " ELSE 'allow' END")
    matched = ("CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.name}'" for r in by_length)
               + " ".join(f" WHEN {says(r)} THEN '{r.name}'" for r in words) + " END")
    host = _NORM.format("regexp_extract(rest, '(?s)^([^/?#]*)', 1)")
    return f"""
        WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
                   FROM pages),
             h AS (SELECT page_id, {host} AS host, regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM u)
        SELECT page_id, host, path, {rule} AS rule, {verdict} AS verdict, {matched} AS matched FROM h"""


def _quality_sql(r: LineRules) -> str:
    said = " OR ".join("contains(lower(line), '{}')".format(p.replace("'", "''")) for p in r.boilerplate)
    said += f" OR regexp_matches(line, '{r.structure}')"
    return rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
             g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS tri
                   FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
             c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, tri) AS n FROM g),
             rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM
                     (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM c WHERE n > 1) GROUP BY doc_id),
             l AS (SELECT doc_id, line, length(regexp_replace(line, '{SPACE}', '', 'g')) AS chars
                   FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
             ln AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup,
                           sum(CASE WHEN NOT regexp_matches(line, '[\p{{L}}\p{{N}}]')
                                      OR len(regexp_extract_all(line, '{MARKS}')) > length(line) * {r.max_marks}
                                      OR len(regexp_extract_all(line, '{r.separators}')) > {r.max_separators}
                                      OR {said} THEN chars ELSE 0 END) AS lost
                    FROM l WHERE chars > 0 GROUP BY doc_id),
             m AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
                          CAST(length(regexp_replace(t, '{SPACE}', '', 'g')) AS BIGINT) AS word_chars,
                          CAST(len(regexp_extract_all(t, '{SYMBOLS}')) AS BIGINT) AS n_symbols,
                          CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
                          CAST(coalesce(lost, 0) AS BIGINT) AS lost_chars
                   FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN ln USING (doc_id)),
             f AS (SELECT *, n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_pct} * n_words AS base_failed FROM m)
        SELECT *, NOT base_failed AND lost_chars <= {r.max_lost} * word_chars AS kept FROM f"""


def _warc_sql() -> str:
    """SHA-1 as base 32: forty hexadecimal digits to bits, five bits a letter."""
    digits = ", ".join(f"'{i:04b}'" for i in range(16))
    five = " + ".join(f"CASE WHEN substr(bits, CAST(5 * i + {k + 1} AS INTEGER), 1) = '1' THEN {16 >> k} ELSE 0 END" for k in range(5))
    return f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
             b AS (SELECT *, sha1(t) AS h, max(page_id) OVER (PARTITION BY t) AS lead FROM p),
             x AS (SELECT *, array_to_string([[{digits}][strpos('0123456789abcdef', substr(h, CAST(j AS INTEGER), 1))]
                                                    FOR j IN range(1, 41)], '') AS bits FROM b)
        SELECT page_id, CAST(octet_length(encode(t)) AS BIGINT) AS payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {five}, 1) FOR i IN range(0, 32)], '') AS payload_digest,
               CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> lead THEN lead END AS refers_to, true AS intact FROM x"""


ORACLE = {
    "op7_arc_to_warc": _warc_sql(),
    "op2_url_filters": _url_sql(),
    "op5_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_NORM.format("text")} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d""",
    "op6_quality_rules": _quality_sql(LineRules()),
}
