import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from medallion.llm.conversations import Suffixes, damage_and_repair, damaged, repair_report, repaired_conversations

DDL = "conv_id long, turn long, role string, text string"
STEP = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """Least (cost, audit) by search over (row, grammar state)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, q, out = heapq.heappop(heap)
        if i == len(rows) and q in ("", "a"):
            return cost, audit, out
        if (i, q) in done:
            continue
        done.add((i, q))
        for c, name in (("u", "user"), ("a", "assistant")):
            if c in STEP[q]:
                heapq.heappush(heap, (cost + 5, audit + "I", i, c, (*out, f"{name}:")))
        if i == len(rows):
            continue
        role, text = rows[i]
        heapq.heappush(heap, (cost + 2, audit + "D", i + 1, q, out))
        if fault[i] in ("blank", "duplicate"):
            continue
        more = 5 if fault[i] else 0
        if role[:1] in STEP[q]:
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[0], (*out, f"{role}:{text}")))
        for c, name in (("u", "user"), ("a", "assistant")):
            if c in STEP[q]:
                heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, c, (*out, f"{name}:{text}")))


def brute(table):
    convs = defaultdict(list)
    for conv, turn, role, text in table:
        convs[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, rows in convs.items():
        live = []
        for turn, role, text in rows:
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
            role = "user" if kind == 4 else role
            h = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            live += [((turn is not None, turn or 0), h, turn, role, text)] * (2 if kind == 3 else 1)
        live.sort(key=lambda r: r[:2])
        turns = {r[2] for r in live} - {None}
        pairs = [r[3:] for r in live]
        f = faults(pairs)
        initials = [p[0][:1] if p[0][:1] in tuple("sua") else "x" for p in pairs]
        cost, audit, said = cheapest(pairs, f)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, f.count("blank"), f.count("duplicate"), f.count("truncated"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def table(seed, n):
    rng, rows = random.Random(seed), []
    texts = ["Yes.", "No", "Why?", " ", "", None, "Go on!\n", "café…", "x. "]
    roles = ["user"] * 6 + ["assistant"] * 6 + ["system", "system", "tool", "", None]
    for conv in [*range(n), None]:
        for turn in rng.sample([None, *range(-2, 12)], rng.randrange(1, 10)):
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts) if rng.random() < 0.7 else f"Text {rng.random()}."))
        if rng.random() < 0.3:  # repeated rows
            rows += rows[-2:]
    rows += [(10**6, t, "user" if t % 2 == 0 else "assistant", f"Turn {t % 90}.") for t in range(700)]
    return rows


def test_report_against_search(spark):
    rows = table(4, 150)
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, DDL).withColumn("conv", F.lit(1)).withColumn("n", F.lit("x")).repartition(3)
    got = damage_and_repair(df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = got.collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == brute(rows) and len(got) == 152


def test_conversation_without_rows_left(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = damage_and_repair(spark.createDataFrame([(conv, 0, "user", "Hi.")], DDL)).collect()
    assert [tuple(r) for r in got] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert damage_and_repair(spark.createDataFrame([], DDL)).count() == 0
    assert damaged(spark.createDataFrame([(conv, 0, None, None)], DDL)).first().role == " "


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello."), (1, 2, "user", "Are you there?"), (1, 3, "assistant", "Yes."),
            (2, 0, "assistant", "Hm."), (2, 1, "user", " "), (3, 0, "user", "Only a question?")]
    got = defaultdict(list)
    for r in repaired_conversations(spark.createDataFrame(rows, DDL)).orderBy("conv_id", "place").collect():
        got[r.conv_id].append((r.edit, r.role, r.text, r.turn))
    assert [e[0] for e in got[1]] == ["K", "K", "K"] and [e[1] for e in got[1]] == ["system", "user", "assistant"]
    assert got[2] == [] and got[3] == []
    audits = {r.conv_id: (r.cost, r.audit) for r in repair_report(spark.createDataFrame(rows, DDL)).collect()}
    assert audits == {1: (2, "KDKK"), 2: (4, "DD"), 3: (2, "D")}


def test_suffixes_are_computed_once(monkeypatch):
    grown = []
    grow = Suffixes._grow
    monkeypatch.setattr(Suffixes, "_grow", lambda self, letter: (grown.append(letter), grow(self, letter)))
    words = sorted({"".join(random.Random(k).choices("ABCabc-", k=k % 9)) for k in range(600)}, key=lambda w: w[::-1])
    path, alone = Suffixes(), []
    got = [path.solve(w) for w in words]
    assert len(grown) == len({w[k:] for w in words for k in range(len(w))})  # one node a suffix
    assert got == [Suffixes().solve(w) for w in words]


@pytest.mark.parametrize("n", [60_000])
def test_very_long_conversation(spark, n):
    df = spark.range(n).selectExpr("7L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('Text ', id, '.') as text")
    r = repair_report(df).first()
    assert (r.cost, r.audit, r.gaps, r.illegal) == (0, "K" * n, 0, 0)
    said = "\n".join(f"{'assistant' if k % 2 else 'user'}:Text {k}." for k in range(n))
    assert r.repaired_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_very_long_text(spark):
    text = "word " * 200_000 + "end."
    r = repair_report(spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text)], DDL)).first()
    assert r.audit == "KK" and r.repaired_sha256 == hashlib.sha256(f"user:{text}\nassistant:{text}".encode()).hexdigest()
