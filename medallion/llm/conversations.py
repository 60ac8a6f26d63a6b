"""Repair of conversation structure by a suffix-shared automaton.

Faults.  In order of turn (nulls first) a row is *blank* (no character but the six ASCII
spaces), else a *duplicate* (its role and text stand in an earlier row), else *truncated*
(it does not end in one of . ! ?).

Edits.  Keep costs 0, Rerole to user or assistant 1, Delete 2 (blank and duplicate rows
must go), Insert an empty user or assistant row 5; a truncated row that stays adds 5.  The
first letters of the roles must then read ``(s?(ua)+)?``.  Of the cheapest edits those are
taken whose letters D I K R sort first.  In each grammar state every letter leads to one
state, so a choice per state settles roles as well.

Method.  A row is one letter for its role and fault, a conversation a word of such letters.
Different words only are solved.  Read from their ends they form an automaton in which a
node is a suffix; its cost-to-go and first edit for each grammar state are computed once,
for all words that share it: words are dealt and sorted by their reversed letters, so a
task keeps the path of one word and computes only what the next word does not share.

Scale.  Copies of a row combine before the first shuffle; text travels once, in the last
step.  The order within a conversation is found by ranges, so a conversation with a large
share of all rows is many segments; what is held whole is one letter a row, as much as the
audit that the result must have.  Its digest runs over its rows in order, a row at a time.
Texts are told apart by MD5 of role and text.

Null roles and texts count as one space.  Null turns come first; rows of one turn are
ordered by that MD5, copies stay together.  Null conversation ids form one conversation.
A role's initial is its first character; roles starting otherwise than s, u, a are never
legal.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import col, staged
from medallion.plans.ranged import add_range_bucket

_SPACES = " \t\n\x0b\x0c\r"
# Letters of a row: role s, u, a or other, by fault: none, truncated, duplicate, blank.
_CLASSES, _OK, _CUT, _TWICE, _BLANK = "suax", "ABCD", "abcd", "EFGH", "efgh"
DELETE, INSERT, RECUT, REROLE = 2, 5, 5, 1
_FAR = 1 << 40
# Grammar states: 0 start, 1 after s, 2 after u, 3 after a; where a role's initial leads,
# and where the role that the grammar asks for next leads.
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NEXT, _ASKED = (2, 2, 3, 2), ("user", "user", "assistant", "user")


class Suffixes:
    """Cost-to-go and first edit of every suffix on the path of the last word, by grammar
    state; words should come sorted by their reversed letters."""

    def __init__(self):
        self.word = ""  # reversed
        self.cost, self.move = array("q", [0, 2 * INSERT, INSERT, 0]), bytearray(b".II.")

    def solve(self, word: str) -> tuple[int, str]:
        """(cost, audit) of a word of row letters."""
        back = word[::-1]
        lo, hi = 0, min(len(back), len(self.word))
        while lo < hi:  # longest common start, by halves
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if back[:mid] == self.word[:mid] else (lo, mid - 1)
        del self.cost[4 * lo + 4:], self.move[4 * lo + 4:]
        for letter in back[lo:]:
            self._grow(letter)
        self.word = back
        at, state, audit = len(word), 0, []
        while (edit := chr(self.move[4 * at + state])) != ".":
            audit.append(edit)
            if edit == "K":
                state = _STEP[state, _class(back[at - 1])]
            elif edit != "D":
                state = _NEXT[state]
            at -= edit != "I"
        return self.cost[4 * len(word)], "".join(audit)

    def _grow(self, letter: str) -> None:
        """One row before all rows of the path."""
        go = self.cost[-4:]
        best = []
        stays = RECUT if letter in _CUT else 0
        for q in range(4):
            options = [(DELETE + go[q], "D")]
            if letter in _OK or letter in _CUT:
                if (to := _STEP.get((q, _class(letter)))) is not None:
                    options.append((stays + go[to], "K"))
                options.append((REROLE + stays + go[_NEXT[q]], "R"))
            best.append(min(options))
        # two inserts in a row only cost, so one look at the asked state is enough
        best[2], best[3] = min(best[2], (INSERT + best[3][0], "I")), min(best[3], (INSERT + best[2][0], "I"))
        best[0], best[1] = min(best[0], (INSERT + best[2][0], "I")), min(best[1], (INSERT + best[2][0], "I"))
        self.cost.extend(min(c, _FAR) for c, _ in best)
        self.move.extend("".join(m for _, m in best).encode())


def _class(letter: str) -> str:
    return _CLASSES["ABCD".find(letter.upper())]


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path = Suffixes()
    for batch in batches:
        words = batch.column(0).to_pylist()
        costs, audits = zip(*map(path.solve, words))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(costs, pa.int64()), pa.array(audits)], names=["word", "cost", "audit"])


def _read(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, copies: Column | None) -> DataFrame:
    """(conv, turn, h, role, text, n) with nulls replaced; n copies of each row."""
    src = df.select(col(conv_col).alias("conv"), col(turn_col).alias("turn"), F.coalesce(col(role_col).cast("string"), F.lit(" ")).alias("role"),
                    F.coalesce(col(text_col).cast("string"), F.lit(" ")).alias("text"),
                    (F.lit(1) if copies is None else copies).cast("int").alias("n"))
    h = F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"))
    return src.select("conv", "turn", h.alias("h"), "role", "text", "n")


def _letters(rows: DataFrame) -> DataFrame:
    """(conv, turn, h, n, piece): the letters of the copies of a row, '' for none."""
    kind = F.array_position(F.array(*map(F.lit, _CLASSES[:3])), F.substring("role", 1, 1))
    kind = F.when(kind == 0, 3).otherwise(kind - 1).cast("int")
    solid = F.rtrim("text", F.lit(_SPACES))
    fault = F.when(solid == "", 2).when(F.right(solid, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    narrow = (rows.select("conv", "turn", "h", "n", (kind + 4 * fault).alias("code"))
              .groupBy("conv", "turn", "h").agg(F.min("code").alias("code"), F.sum("n").cast("int").alias("n")))
    narrow = staged(narrow, "conv-rows")
    first = (narrow.filter("n > 0").groupBy(F.col("conv").alias("f_conv"), F.col("h").alias("f_h"))
             .agg(F.bool_or(F.col("turn").isNull()).alias("f_null"), F.min("turn").alias("f_turn"), F.count(F.lit(1)).alias("f_n"))
             # rows found in one turn only need no look
             .filter("f_n > 1"))
    out = narrow.join(first, narrow["conv"].eqNullSafe(first["f_conv"]) & (narrow["h"] == first["f_h"]), "left")
    leads = F.when(F.col("f_h").isNull(), True).when(F.col("f_null"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("f_turn"))
    at = (F.col("code") % 4 + 1).cast("int")

    def letter(of: str) -> Column:
        return F.substring(F.lit(of), at, F.lit(1))

    twice = letter(_TWICE)
    piece = (F.when(F.col("n") <= 0, "").when(F.col("code") >= 8, F.repeat(letter(_BLANK), F.col("n")))
             .when(~leads, F.repeat(twice, F.col("n")))
             .otherwise(F.concat(F.when(F.col("code") >= 4, letter(_CUT)).otherwise(letter(_OK)), F.repeat(twice, F.col("n") - 1))))
    return out.select("conv", "turn", "h", "n", piece.alias("piece"))


def _words(letters: DataFrame) -> DataFrame:
    """(conv, word, gaps): the letters of each conversation in order."""
    dealt = add_range_bucket(letters, ["turn", "h"], partition_cols=["conv"])
    row = F.struct(F.col("turn").isNotNull().alias("has"), "turn", "h", "piece", "n")
    live = F.when(F.col("n") > 0, F.col("turn"))
    parts = dealt.groupBy("conv", F.col("_rng_bucket").alias("part")).agg(
        F.array_sort(F.collect_list(row)).alias("rows"), F.min(live).alias("lo"), F.max(live).alias("hi"))
    turns = F.transform(F.filter("rows", lambda r: r["has"] & (r["n"] > 0)), lambda r: r["turn"])
    parts = parts.select("conv", F.struct("part", F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("word"), "lo", "hi",
                                          F.size(F.array_distinct(turns)).cast("long").alias("turns")).alias("p"))
    kind = dict(letters.dtypes)["turn"]
    # a turn may end one segment and begin the next
    one = F.aggregate("ps", F.struct(F.lit(0).cast("long").alias("turns"), F.lit(None).cast(kind).alias("hi")),
                      lambda s, p: F.struct((s["turns"] + p["turns"] - F.when(s["hi"] == p["lo"], 1).otherwise(0)).alias("turns"),
                                            F.coalesce(p["hi"], s["hi"]).alias("hi")))
    convs = parts.groupBy("conv").agg(F.array_sort(F.collect_list("p")).alias("ps"), F.min("p.lo").alias("lo"), F.max("p.hi").alias("hi"))
    return convs.select("conv", F.array_join(F.transform("ps", lambda p: p["word"]), "").alias("word"),
                        F.coalesce((F.col("hi") - F.col("lo") + 1 - one["turns"]).cast("long"), F.lit(0)).alias("gaps"))


def repair_plans(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (see ``_read``): conv, ``gaps``, ``blank``,
    ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``."""
    words = staged(_words(_letters(rows)), "conv-words")
    # what has to go has one letter, whatever its role
    word = F.translate("word", _TWICE + _BLANK, "-" * 8)
    distinct = words.select(word.alias("word")).distinct()
    back = F.reverse("word")
    solved = distinct.repartitionByRange(back).sortWithinPartitions(back).mapInArrow(_solved, "word string, cost long, audit string")
    roles = F.translate("word", _OK + _CUT + _TWICE + _BLANK, _CLASSES * 4)
    adjacent = F.greatest(F.char_length("word") - 1, F.lit(0)) - F.regexp_count(roles, F.lit("(?=su|ua|au)"))
    told = words.select("conv", word.alias("w"), "gaps", *(F.regexp_count("word", F.lit(f"[{of}]")).cast("long").alias(name)
                        for name, of in (("blank", _BLANK), ("duplicate", _TWICE), ("truncated", _CUT))), adjacent.cast("long").alias("illegal"))
    return told.join(solved, told["w"] == solved["word"]).drop("w", "word")


_STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _streamed(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Every conversation's plan, then its rows in order, in one task."""
    n, types = F.lit(None), dict(rows.dtypes)
    head = plans.select("conv", F.lit(0).alias("k"), n.cast(types["turn"]).alias("turn"), n.cast("string").alias("h"), n.cast("string").alias("role"),
                        n.cast("string").alias("text"), n.cast("int").alias("n"), *_STATS, "audit")
    body = rows.filter("n > 0").select("conv", F.lit(1).alias("k"), "turn", "h", "role", "text", "n", *(n.cast("long").alias(s) for s in _STATS),
                                       n.cast("string").alias("audit"))
    return (head.unionByName(body).repartition("conv")
            .sortWithinPartitions("conv", "k", F.col("turn").asc_nulls_first(), "h").drop("k", "h"))


class _Repair:
    """Applies an audit to the rows of a conversation as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def added(self) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of rows inserted here."""
        while self.audit[self.at:self.at + 1] == "I":
            yield self._asked("")

    def _asked(self, text: str) -> tuple[str, str, str]:
        edit, role = self.audit[self.at], _ASKED[self.state]
        self.at, self.state = self.at + 1, _NEXT[self.state]
        return edit, role, text

    def row(self, role: str, text: str) -> tuple[str, str, str] | None:
        """(edit, role, text) of the next row, None if it is deleted."""
        edit = self.audit[self.at]
        if edit == "R":
            return self._asked(text)
        self.at += 1
        if edit == "D":
            return None
        self.state = _STEP[self.state, role[:1]]
        return edit, role, text


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation, with the digest of its repaired rows."""
    conv = stats = plan = None
    digest, first = hashlib.sha256(), True
    schema = None

    def say(edits) -> None:
        nonlocal first
        for _, role, text in edits:
            digest.update((("" if first else "\n") + role + ":" + text).encode("utf-8"))
            first = False

    def closed():
        say(plan.added())
        return [conv, *stats, plan.audit, digest.hexdigest()]

    for batch in batches:
        if schema is None:
            schema = pa.schema([("conv", batch.schema.field("conv").type), *((s, pa.int64()) for s in _STATS),
                                ("audit", pa.string()), ("repaired_sha256", pa.string())])
        out = []
        for this, _, role, text, n, *told, audit in zip(*(c.to_pylist() for c in batch.columns)):
            if audit is not None:
                if plan is not None:
                    out.append(closed())
                conv, stats, plan = this, told, _Repair(audit)
                digest, first = hashlib.sha256(), True
                continue
            for _ in range(n):
                say(plan.added())
                row = plan.row(role, text)
                say([row] if row else [])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    if plan is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(closed(), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired rows in order."""
    conv = plan = None
    place, schema = 0, None
    for batch in batches:
        if schema is None:
            schema = pa.schema([("conv", batch.schema.field("conv").type), ("place", pa.int64()), ("turn", batch.schema.field("turn").type),
                                ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
        out = []

        def put(edits, turn=None) -> None:
            nonlocal place
            for e in edits:
                out.append([conv, place, turn, *e])
                place += 1

        for this, turn, role, text, n, *_, audit in zip(*(c.to_pylist() for c in batch.columns)):
            if audit is not None:
                if plan is not None:
                    put(plan.added())
                conv, plan, place = this, _Repair(audit), 0
                continue
            for _ in range(n):
                put(plan.added())
                row = plan.row(role, text)
                put([row] if row else [], turn)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    if plan is not None:
        out = [[conv, place + k, None, *e] for k, e in enumerate(plan.added())]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def repair_report(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                  copies: Column | None = None) -> DataFrame:
    """One row per conversation: id, ``gaps`` (turns missing between the least and the
    greatest), rows by fault, ``illegal`` (neighbours other than su, ua, au), ``cost``,
    ``audit`` and the SHA-256 of the repaired ``role:text`` lines.  ``copies``: how often
    a row stands there; conversations whose rows all have none are reported too."""
    rows = _read(df, conv_col, turn_col, role_col, text_col, copies)
    types = dict(rows.dtypes)
    out = _streamed(rows, repair_plans(rows)).mapInArrow(
        _reports, f"conv {types['conv']}, " + ", ".join(f"{s} long" for s in _STATS) + ", audit string, repaired_sha256 string")
    return out.withColumnRenamed("conv", conv_col)


def repaired_conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                           text_col: str = "text", copies: Column | None = None) -> DataFrame:
    """The repaired rows: id, ``place`` from 0, turn (null where inserted), ``edit`` (K, R
    or I), role and text."""
    rows = _read(df, conv_col, turn_col, role_col, text_col, copies)
    types = dict(rows.dtypes)
    out = _streamed(rows, repair_plans(rows)).mapInArrow(
        _rows, f"conv {types['conv']}, place long, turn {types['turn']}, edit string, role string, text string")
    return out.select(F.col("conv").alias(conv_col), "place", F.col("turn").alias(turn_col), "edit", F.col("role").alias(role_col),
                      F.col("text").alias(text_col))


def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations with planted faults, by crc32 of ``id:turn`` modulo 20: 0 drops the
    row, 1 empties its text, 2 takes out . ! ?, 3 repeats it, 4 makes its role user.
    ``copies`` tells how often a row stands there; nulls are one space."""
    def said(name: str) -> Column:
        return F.coalesce(col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(said(conv_col), F.lit(":"), said(turn_col)).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said(text_col), "[.!?]", "")).otherwise(said(text_col))
    return df.select(col(conv_col).alias(conv_col), col(turn_col).alias(turn_col), F.when(kind == 4, "user").otherwise(said(role_col)).alias(role_col),
                     text.alias(text_col), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def damage_and_repair(df: DataFrame) -> DataFrame:
    d = damaged(df)
    return repair_report(d, copies=F.col("copies"))
