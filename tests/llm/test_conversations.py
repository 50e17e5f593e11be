"""Conversation repair: damage, faults, cheapest edits by exhaustive search, odd rows."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from staylens.llm import conversations as V
from staylens.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = re.compile("[^\x20\x09-\x0d]")
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def sp(v):
    return " " if v is None else str(v)


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        what = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        role, text = sp(role), sp(text)
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        role = "user" if what == 4 else role
        kept += [(turn, role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def by_definition(rows):
    """Least (cost, audit) by best-first search over (row, last role) with whole audits."""
    seen, marks = set(), []
    for _, role, text in rows:
        found = BLANK.findall(text)
        marks.append("blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else "")
        seen.add((role, text))
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, last, made = heapq.heappop(queue)
        if i == len(rows) and last in ("", "a"):
            break
        if (i, last) in done:
            continue
        done.add((i, last))
        for r in "ua":
            if (last, r) in NEXT:
                heapq.heappush(queue, (cost + 5, audit + "I", i, r, (*made, ("user:" if r == "u" else "assistant:"))))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(queue, (cost + 2, audit + "D", i + 1, last, made))
            if marks[i] not in ("blank", "duplicate"):
                more = 5 * (marks[i] == "truncated")
                if (last, role[:1]) in NEXT:
                    heapq.heappush(queue, (cost + more, audit + "K", i + 1, role[:1], (*made, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if (last, new[0]) in NEXT:
                        heapq.heappush(queue, (cost + 1 + more, audit + "R", i + 1, new[0], (*made, f"{new}:{text}")))
    turns = {t for t, _, _ in rows if t is not None}
    firsts = [r[:1] for _, r, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        marks.count("blank"), marks.count("duplicate"), marks.count("truncated"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])),
        cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest(),
    )


def as_row(r):
    return (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)


def random_rows(seed, conversations):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, 11)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "u", "Assistant"])
            text = rng.choice(["Yes.", "No!", "why?", "cut", "Étoile. ", "", " \t", None, "a.b", "Yes.", "end.\n", "x\x85"])
            rows.append((conv, rng.choice([turn, turn, turn, 3, None, turn + 5]), role, text))
    return rows


@pytest.mark.parametrize("batch", [3, 1000])
def test_random_conversations_against_search(spark, batch, monkeypatch):
    monkeypatch.setattr(V, "BATCH_ROWS", batch)
    rows = random_rows(batch, 300)
    want = {c: by_definition(r) for c, r in damaged(rows).items()}
    got = V.diagnose(V.damage(spark.createDataFrame(rows, SCHEMA))).collect()
    assert len(got) == len(want)
    for r in got:
        assert as_row(r) == want[r.conv], (r.conv, damaged(rows)[r.conv])


def test_all_conversations_of_a_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {c: by_definition(r) for c, r in damaged(rows).items()}
    got = {r.conv_id: as_row(r) for r in QUERIES["op13_conversation_structure_repair"](spark, sf).collect()}
    assert got == want and any(w[5] for w in want.values())


def test_repaired_turns_have_the_digest(spark):
    rows = spark.createDataFrame(random_rows(9, 150), SCHEMA)
    hurt = V.damage(rows)
    reports = V.diagnose(hurt)
    turns = {}
    for r in sorted(V.repair(hurt, reports).collect(), key=lambda r: (r.conv, r.place)):
        turns.setdefault(r.conv, []).append(r)
    for r in reports.collect():
        lines = turns.get(r.conv, [])
        assert [x.place for x in lines] == list(range(len(lines)))
        assert re.fullmatch("(s?(ua)+)?", "".join(x.role[:1] for x in lines))
        assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in lines).encode()).hexdigest() == r.repaired_sha256


def test_giant_conversation_spills_and_matches(spark, monkeypatch):
    rng = random.Random(4)
    steps, plain = V.Steps(), []
    monkeypatch.setattr(V, "SPILL", 64)
    whole = V.Conversation(steps)
    for turn in range(1000):
        role, text = rng.choice(["user", "assistant", "system"]), rng.choice(["", "a.", "b", f"t{turn}!"])
        plain.append((turn, role, text))
    seen = set()
    for turn, role, text in plain:
        fault = "blank" if not text else "duplicate" if (role, text) in seen else None if text[-1] in ".!" else "truncated"
        seen.add((role, text))
        whole.add(turn, role, text, fault)
    assert whole.spilled >= 15
    assert whole.report() == by_definition(plain)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", "hi."), (1, None, "user", None), (2, 5, "assistant", "only."),
        (3, 0, "user", "same."), (3, 0, "user", "same."), (4, 0, "s", "s."), (5, 0, "user", "w. " * 100000),
        (6, 2**62, "user", "a."), (6, -(2**62), "assistant", "b."),
    ]
    extra = spark.createDataFrame(rows, SCHEMA).withColumns({"conv": F.lit(1), "live": F.lit("no"), "fault": F.lit("x")})
    got = {r.conv: as_row(r) for r in V.diagnose(V.damage(extra)).collect()}
    assert got == {c: by_definition(r) for c, r in damaged(rows).items()}
    empty = V.diagnose(V.intact(extra.limit(0)))
    assert empty.count() == 0
    assert {r.conv for r in V.diagnose(V.intact(extra)).collect()} == {None, 1, 2, 3, 4, 5, 6}
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    only = V.diagnose(V.damage(spark.createDataFrame([(dropped, 0, "user", "gone.")], SCHEMA))).collect()
    assert as_row(only[0]) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
