"""Conversation structure repair by a dynamic program over secondary-sorted turns.

Turns are repartitioned by conversation and sorted by turn inside the partition;
``mapInPandas`` then streams each conversation once and carries the program's state across
Arrow batches.  A repaired conversation has the role initials ``(s?(ua)+)?``, so the state
is one of four positions in that pattern.  Edits of a row: Keep, Rerole to user or
assistant, Delete; empty user or assistant turns can be Inserted anywhere.

Of the cheapest edits the one whose initials are least in ASCII order is wanted.  After i
rows every partial audit holds exactly i row edits and ends with one, so no partial audit
is a prefix of another, and their order decides later ties for good.  A configuration is
therefore the list of live positions in audit order with their costs above the cheapest:
few exist, so every step is one lookup of (configuration, kind of row).  A row leaves one
four-byte back pointer; beyond ``SPILL`` rows those go to the task's scratch file.  The
digest of each position's partial result is carried along, so a conversation of any length
is read once and needs memory for its audit alone.

One conversation is one stream, as its digest is of all its text in order: a giant
conversation takes one task long, but not much memory.  Deriving the rows, their faults
and their repair before and after that step is spread over all tasks.

Cases: null texts, roles, conversation ids and turns count as one space where they are
text; null turns come first and count for no gap; rows of one turn come in the order of
role and text; repeated rows are duplicates; conversations without a row left have zeros,
an empty audit and the digest of the empty string; an empty table gives no rows; other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 2, 1, 5, 5
LEGAL_PAIRS = {"su", "ua", "au"}

# Positions in (s?(ua)+)?: nothing yet, after s, after u, after a.
NONE_YET, AFTER_S, AFTER_U, AFTER_A = range(4)
WANTED = {NONE_YET: "u", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}
AFTER = {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}
ROLE = {"u": "user", "a": "assistant"}
ENDS = (NONE_YET, AFTER_A)

# Back pointers of one conversation that are held in memory.
SPILL = 1 << 20
BATCH_ROWS = 1024


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, live): every row damaged by the CRC-32 of ``conv:turn``;
    a dropped row stays as one that is not live, so that its conversation is still known."""
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    what = F.crc32(F.concat(spaced(conv_col), F.lit(":"), spaced(turn_col))) % 20
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.when(what == 4, "user").otherwise(spaced(role_col)).alias("role"),
        F.when(what == 1, "").when(what == 2, F.translate(spaced(text_col), ".!?", "")).otherwise(spaced(text_col)).alias("text"),
        (what != 0).alias("live"), what.alias("what"),
    )
    twice = F.when(F.col("what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(twice)).select("conv", "turn", "role", "text", "live")


def intact(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, live) of rows as they are."""
    return turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"), F.lit(True).alias("live"),
    )


def _turn_order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` dealt by conversation, with ``fault``: blank, duplicate, truncated or null.
    The window needs no exchange of its own: it runs in the partitions of the stream."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    dealt = rows.repartition("conv").withColumn("h", F.xxhash64("text"))
    same = Window.partitionBy("conv").orderBy("live", "role", "h", "text", F.col("turn").asc_nulls_first())
    seen = F.lag("live").over(same) & (F.lag("role").over(same) == F.col("role")) & (F.lag("text").over(same) == F.col("text"))
    fault = (
        F.when(trimmed == "", "blank")
        .when(F.coalesce(seen, F.lit(False)), "duplicate")
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "truncated")
    )
    return dealt.withColumn("fault", F.when(F.col("live"), fault)).drop("h")


class Steps:
    """Configurations and the steps between them, made when first met."""

    def __init__(self) -> None:
        self.configs: list[tuple[tuple[int, int], ...]] = []
        self.ids: dict = {}
        self.steps: list[tuple[int, int, tuple]] = []  # (next configuration, cost, back per slot)
        self.made: dict[tuple[int, str, bool, bool], int] = {}
        self.start = self._config(((NONE_YET, 0),))

    def _config(self, config) -> int:
        if config not in self.ids:
            self.ids[config] = len(self.configs)
            self.configs.append(config)
        return self.ids[config]

    def step(self, config: int, initial: str, must_go: bool, truncated: bool) -> int:
        """The step from ``config`` over a row of that kind."""
        key = (config, initial, must_go, truncated)
        if key not in self.made:
            best: dict[int, tuple] = {}
            for slot, (state, cost) in enumerate(self.configs[config]):
                for inserts in range(3):
                    at, put = state, []
                    for _ in range(inserts):
                        put.append(WANTED[at])
                        at = AFTER[put[-1]]
                    so_far = cost + INSERT_COST * inserts
                    options = [("D", at, DELETE_COST, None)]
                    if not must_go:
                        more = TRUNCATED_COST * truncated
                        if initial == WANTED[at] or (initial == "s" and at == NONE_YET):
                            options.append(("K", AFTER[initial], more, ""))
                        options.append(("R", AFTER[WANTED[at]], REROLE_COST + more, WANTED[at]))
                    for edit, to, price, role in options:
                        found = (so_far + price, slot, "I" * inserts + edit, tuple(put), role)
                        if to not in best or found[:3] < best[to][:3]:
                            best[to] = found
            order = sorted(best, key=lambda to: best[to][1:3])
            least = min(b[0] for b in best.values())
            after = self._config(tuple((to, best[to][0] - least) for to in order))
            back = tuple(best[to][1:] for to in order)
            self.made[key] = len(self.steps)
            self.steps.append((after, least, back))
        return self.made[key]

    def finish(self, config: int) -> tuple[int, int, str]:
        """(cost, slot, inserts at the end) of the best way to end in ``config``."""
        ends = []
        for slot, (state, cost) in enumerate(self.configs[config]):
            more = 0
            while state not in ENDS:
                state, more = AFTER[WANTED[state]], more + 1
            ends.append((cost + INSERT_COST * more, slot, "I" * more))
        return min(ends)


class Conversation:
    """One conversation's stream: counts, costs, back pointers and digests."""

    def __init__(self, steps: Steps) -> None:
        self.table = steps
        self.config, self.cost = steps.start, 0
        self.digests = [hashlib.sha256()]
        self.back, self.spilled, self.file = array("I"), 0, None
        self.low = self.high = self.last_turn = None
        self.distinct, self.illegal, self.initial = 0, 0, None
        self.count = {"blank": 0, "duplicate": 0, "truncated": 0}

    def add(self, turn: int | None, role: str, text: str | None, fault: str | None) -> None:
        if turn is not None and turn != self.last_turn:
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn
            self.distinct += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL_PAIRS:
            self.illegal += 1
        self.initial = initial
        if fault:
            self.count[fault] += 1
        states = self.table.configs[self.config]
        kind = initial if initial in AFTER else "?"
        number = self.table.step(self.config, kind, fault in ("blank", "duplicate"), fault == "truncated")
        self.config, cost, back = self.table.steps[number]
        self.cost += cost
        self.back.append(number)
        if len(self.back) >= SPILL:
            self._spill()
        body = b":" + text.encode("utf-8", "surrogatepass") if text is not None else b""
        digests = []
        for slot, _, put, new_role in back:
            made = self.digests[slot]
            if put or new_role is not None:
                made = made.copy()
                begun = states[slot][0] != NONE_YET
                for p in put:
                    made.update((b"\n" if begun else b"") + ROLE[p].encode() + b":")
                    begun = True
                if new_role is not None:
                    made.update((b"\n" if begun else b"") + (ROLE[new_role] if new_role else role).encode("utf-8", "surrogatepass") + body)
            digests.append(made)
        self.digests = digests

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        self.file.write(self.back.tobytes())
        self.spilled += 1
        self.back = array("I")

    def _chunks_backwards(self) -> Iterator[array]:
        yield self.back
        size = SPILL * self.back.itemsize
        for i in range(self.spilled - 1, -1, -1):
            self.file.seek(i * size)
            chunk = array("I")
            chunk.frombytes(self.file.read(size))
            yield chunk

    def report(self) -> tuple:
        cost, slot, tail = self.table.finish(self.config)
        digest = self.digests[slot].copy()
        at = self.table.configs[self.config][slot][0]
        for _ in tail:
            digest.update((b"\n" if at != NONE_YET else b"") + ROLE[WANTED[at]].encode() + b":")
            at = AFTER[WANTED[at]]
        parts = [tail]
        for chunk in self._chunks_backwards():
            edits = []
            for number in reversed(chunk):
                slot, text, _, _ = self.table.steps[number][2][slot]
                edits.append(text)
            parts.append("".join(reversed(edits)))
        if self.file is not None:
            self.file.close()
        gaps = self.high - self.low + 1 - self.distinct if self.distinct else 0
        return (
            gaps, self.count["blank"], self.count["duplicate"], self.count["truncated"], self.illegal,
            self.cost + cost, "".join(reversed(parts)), digest.hexdigest(),
        )


_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _reports(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    steps, done = Steps(), []
    name, open_one = None, None
    for batch in batches:
        for conv, turn, role, text, fault, live in zip(
            batch["conv"], batch["turn"], batch["role"], batch["text"], batch["fault"], batch["live"], strict=True
        ):
            if open_one is None or conv != name:
                if open_one is not None:
                    done.append((name, *open_one.report()))
                name, open_one = conv, Conversation(steps)
            if live:
                open_one.add(None if turn is None else int(turn), role, text, fault)
        if done:
            yield pd.DataFrame(done, columns=["conv", *_REPORT])
            done = []
    if open_one is not None:
        yield pd.DataFrame([(name, *open_one.report())], columns=["conv", *_REPORT])


def diagnose(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (from :func:`damage` or :func:`intact`): conv,
    the counts of its faults, the cost and audit of the cheapest repair and the SHA-256 of
    the repaired ``role:text`` lines."""
    arrow_batches(rows.sparkSession, BATCH_ROWS)
    goes = F.col("fault").isin("blank", "duplicate")
    lines = (
        faults(rows)
        .sortWithinPartitions("conv", *_turn_order())
        .select(
            F.col("conv").cast("string").alias("conv"), F.col("turn").cast("string").alias("turn"), "role",
            F.when(F.coalesce(goes, F.lit(False)), None).otherwise(F.col("text")).alias("text"), "fault", "live",
        )
    )
    schema = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    made = lines.mapInPandas(_reports, schema)
    return made.withColumn("conv", F.col("conv").cast(rows.schema["conv"].dataType))


class _Editor:
    """Applies the audit of one conversation to its turns as they pass."""

    def __init__(self, conv, audit: str) -> None:
        self.conv, self.audit, self.at, self.state, self.place = conv, audit, 0, NONE_YET, 0

    def _put(self, edit: str, initial: str, role: str, text: str) -> tuple:
        row = (self.conv, self.place, edit, role, text)
        self.state, self.place = AFTER[initial], self.place + 1
        return row

    def inserted(self) -> Iterator[tuple]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            initial = WANTED[self.state]
            yield self._put("I", initial, ROLE[initial], "")

    def edited(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            yield self._put("K", role[:1], role, text)
        elif edit == "R":
            initial = WANTED[self.state]
            yield self._put("R", initial, ROLE[initial], text)


def _edited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Turns after the edits of the audit that precedes them."""
    editor = None

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["conv", "place", "edit", "role", "text"])

    for batch in batches:
        out: list[tuple] = []
        for conv, audit, role, text in zip(batch["conv"], batch["audit"], batch["role"], batch["text"], strict=True):
            if audit is None:
                out.extend(editor.edited(role, text))
                continue
            if editor is not None:
                out.extend(editor.inserted())
            editor = _Editor(conv, audit)  # the report's row opens its conversation
        yield frame(out)
    if editor is not None:
        yield frame(list(editor.inserted()))


def repair(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The repaired turns of ``rows``: (conv, place, edit, role, text), from the audits that
    :func:`diagnose` gave.  A second stream: each conversation's audit comes first, its
    turns follow in the order in which the audit was made."""
    arrow_batches(rows.sparkSession, BATCH_ROWS)
    told = reports.select(
        "conv", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"), "audit",
    )
    both = told.unionByName(rows.where("live").select("conv", "turn", "role", "text", F.lit(None).cast("string").alias("audit")))
    lines = (
        both.repartition("conv")
        .sortWithinPartitions("conv", F.col("audit").isNull(), *_turn_order())
        .select(F.col("conv").cast("string").alias("conv"), "audit", "role", "text")
    )
    made = lines.mapInPandas(_edited, "conv string, place long, edit string, role string, text string")
    return made.withColumn("conv", F.col("conv").cast(rows.schema["conv"].dataType))
