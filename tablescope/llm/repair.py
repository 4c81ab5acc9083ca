"""Repair of conversation structure at least cost.

Rows of a conversation arrive in one task as a stream ordered by turn
(repartition by conversation, sort within partitions). Dynamic programming
over the four states a valid prefix can end in (nothing yet, after s, after u,
after a) carries, from Arrow batch to Arrow batch, each state's least cost, the
rank of its audit string among the states', and the running hash of its
repaired text. One number per row says where each state came from; these
backpointers go to a spooled file of the task, so a giant conversation needs
no memory that grows with it beyond its own audit string.

Prefixes of equal length in rows end with a row's letter, so none is a prefix
of another; their order is decided once and is not changed by what follows.
That is why ranks suffice to find the least of the cheapest audit strings.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import table

# Costs and roles.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"
SPACES, STOPS = " \t\n\v\f\r", (".", "!", "?")

#: State after a row of initial i, by the state before; others are not allowed.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
#: Bytes of backpointers kept in memory before they go to the task's own file.
SPOOL_BYTES, BACK_ROWS = 8 << 20, 1 << 16


def after(state: int, inserts: int) -> int:
    """The state after so many insertions; each has one legal role."""
    for _ in range(inserts):
        state = 3 if state == 2 else 2
    return state


@lru_cache(maxsize=1 << 16)
def step(costs: tuple, ranks: tuple, initial: str, deleted: bool, truncated: bool) -> tuple:
    """One row: (costs, ranks, what all costs grew by, back, back in bits) of
    the states after it. ``costs`` are
    relative to their least, None where a state cannot be reached; ``back``
    holds for each state the state before, the insertions before the row and
    the letter. The arguments take few values, so steps are looked up."""
    best: dict[int, tuple] = {}
    for state, inserts in product(range(4), range(3)):
        if costs[state] is None:
            continue
        at, base = after(state, inserts), costs[state] + INSERT * inserts
        ways = [("D", at, DELETE)]
        if not deleted:
            more = TRUNCATED if truncated else 0
            if (at, initial) in NEXT:
                ways.append(("K", NEXT[at, initial], KEEP + more))
            # A row that has the role already is kept at less cost.
            ways += [("R", NEXT[at, role], REROLE + more) for role in "ua" if (at, role) in NEXT]
        for letter, to, cost in ways:
            way = (base + cost, ranks[state], "I" * inserts + letter, state)
            if to not in best or way < best[to]:
                best[to] = way
    least = min(way[0] for way in best.values())
    # States of unequal cost are ranked too: they may meet again at equal cost.
    order = sorted(best, key=lambda s: best[s][1:3])
    rank = tuple(order.index(s) if s in best else 0 for s in range(4))
    cost = tuple(best[s][0] - least if s in best else None for s in range(4))
    back = tuple((best[s][3], len(best[s][2]) - 1, best[s][2][-1]) if s in best else None for s in range(4))
    return cost, rank, least, back, code_of(back)


def code_of(back: tuple) -> int:
    """Backpointers of four states in 32 bits: before, insertions, letter."""
    code = 0
    for s, way in enumerate(back):
        before, inserts, letter = way or (3, 3, "D")
        code |= (before | inserts << 2 | "DKR".index(letter) << 4) << 8 * s
    return code


class Conversation:
    """The state of one conversation while its rows stream by."""

    def __init__(self, key):
        self.key = key
        self.cost, self.ranks, self.total = (0, None, None, None), (0, 0, 0, 0), 0
        self.hashes: list = [hashlib.sha256(), None, None, None]
        self.back = tempfile.SpooledTemporaryFile(max_size=SPOOL_BYTES)
        self.buffer: list[int] = []
        self.rows = self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.least = self.most = self.turn = self.initial = self.last = None

    def add(self, turn, role: str, text: str, digest, first: bool, blank: bool, cut: bool) -> None:
        # A repeated row is next to its like: its turn is the first one as well.
        again = not first or (digest is not None and digest == self.last)
        self.last = digest
        deleted = blank or again
        truncated = cut and not deleted
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += truncated
        initial = role[:1]
        if self.rows and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        self.rows += 1
        if turn is not None:
            self.distinct += turn != self.turn
            self.least = turn if self.least is None else self.least
            self.most = self.turn = turn
        self.cost, self.ranks, least, back, code = step(self.cost, self.ranks, initial, deleted, truncated)
        self.total += least
        self.hashes = [self.extended(s, way, role, text) for s, way in enumerate(back)]
        self.buffer.append(code)
        if len(self.buffer) == BACK_ROWS:
            self.spill()

    def extended(self, state: int, way, role: str, text: str):
        if way is None:
            return None
        before, inserts, letter = way
        h = self.hashes[before]
        if letter == "D" and not inserts:
            return h
        lines = self.inserted(before, inserts)
        if letter != "D":
            lines.append((role if letter == "K" else {2: USER, 3: ASSISTANT}[state]) + ":" + text)
        return self.hashed(h, before, lines)

    @staticmethod
    def inserted(before: int, inserts: int) -> list[str]:
        return [{2: USER, 3: ASSISTANT}[after(before, k + 1)] + ":" for k in range(inserts)]

    @staticmethod
    def hashed(h, before: int, lines: list[str]):
        h = h.copy()
        h.update((("\n" if before else "") + "\n".join(lines)).encode())
        return h

    def spill(self) -> None:
        self.back.write(np.array(self.buffer, "<u4").tobytes())
        self.buffer = []

    def audit(self, state: int) -> str:
        """Letters from the backpointers, read from the end in blocks."""
        self.spill()
        parts: list[str] = []
        end = self.back.tell()
        while end:
            start = max(0, end - 4 * BACK_ROWS)
            self.back.seek(start)
            codes = np.frombuffer(self.back.read(end - start), "<u4").tolist()
            letters = []
            for code in reversed(codes):
                way = code >> 8 * state & 255
                letters.append("DKR"[way >> 4] + "I" * (way >> 2 & 3))
                state = way & 3
            parts.append("".join(letters))
            end = start
        return "".join(parts)[::-1]

    def result(self) -> tuple:
        """The row of the conversation. The state after the last row and its
        insertions are chosen like any other way."""
        ends = [(c + INSERT * k, self.ranks[s], "I" * k, s) for s, c in enumerate(self.cost) if c is not None for k in range(3) if after(s, k) in (0, 3)]
        cost, _, more, state = min(ends)
        h = self.hashes[state]
        if more:
            h = self.hashed(h, state, self.inserted(state, len(more)))
        audit = self.audit(state) + more
        self.back.close()
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.distinct
        return (self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.total + cost, audit, h.hexdigest())


RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def faults(turns: DataFrame) -> DataFrame:
    """Adds ``digest``, ``blank``, ``cut`` (the last character that is no
    space ends no sentence) and ``first`` (no row of an earlier turn has this
    role and text) to (conv, has_turn, t, role, text, present).

    First turns are one aggregate by conversation, role and digest, combined
    before its shuffle; only those of rows that occur again are joined back.
    """
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    # Without a turn a row is before every turn.
    place = F.struct("has_turn", "t")
    own = turns.withColumns({"digest": digest, "place": place, "solid": F.rtrim("text", F.lit(SPACES))})
    own = own.withColumns({"blank": F.col("solid") == "", "cut": ~F.right("solid", F.lit(1)).isin(*STOPS)}).drop("solid")
    again = own.filter("present").groupBy("conv", "digest").agg(F.min("place").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = again.select(F.col("conv").alias("again_conv"), F.col("digest").alias("again_digest"), "least")
    met = own.join(again, F.col("conv").eqNullSafe(F.col("again_conv")) & (F.col("digest") == F.col("again_digest")), "left")
    return met.withColumn("first", F.col("least").isNull() | (F.col("place") == F.col("least"))).drop("again_conv", "again_digest", "least", "place")


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None) -> DataFrame:
    """One row per conversation: its id, ``gaps``, ``blank``, ``duplicate``,
    ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``.

    ``audit`` has a letter per edit in order: K keeps a row, R gives it the
    role user or assistant, D deletes it, I inserts an empty row; the roles
    that result are nothing, or pairs of user and assistant after at most one
    system row. Cheapest edits, the ASCII-least audit of them. Blank and
    repeated rows must go; a row that breaks off costs more if it stays.

    Rows are taken by turn (null first), those of one turn by role and text.
    A null role or text is one space. Equal rows are repeats of each other.
    Rows where the boolean column ``present`` is false do not count, but their
    conversation has a row of the result: zeros, an empty audit and the hash
    of nothing. Null ids are one conversation. Further columns are ignored; an
    empty table gives no row. All rows of a conversation pass through one
    task, as a stream: memory is a batch, 8 MB of backpointers, and the audit.
    """
    id_type = turns.schema[conv].dataType.simpleString()
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    own = turns.select(
        F.col(conv).cast("string").alias("conv"), F.col(turn).isNotNull().alias("has_turn"), F.coalesce(F.col(turn).cast("bigint"), F.lit(0)).alias("t"),
        blank(role).alias("role"), blank(text).alias("text"), (F.coalesce(present, F.lit(False)) if present else F.lit(True)).alias("present"),
    )
    names = ["conv", "has_turn", "t", "role", "text", "digest", "first", "blank", "cut", "present"]
    slim = [F.when(F.col("present"), F.col(c)).alias(c) if c in ("text", "digest") else F.col(c) for c in names]
    dealt = faults(own).select(*slim).repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "has_turn", "t", "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, out = None, []
        for batch in batches:
            for key, has_turn, t, *rest, there in zip(*[batch[c].tolist() for c in names]):
                if held is None or held.key != key:
                    if held is not None:
                        out.append(held.result())
                    held = Conversation(key)
                if there:
                    held.add(t if has_turn else None, *rest)
            if out:
                yield frame(out)
                out = []
        if held is not None:
            yield frame([held.result()])

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["conv", *[x.split()[0] for x in RESULT.split(", ")]]).astype({"conv": object})

    return dealt.mapInPandas(run, f"conv string, {RESULT}").withColumn("conv", F.col("conv").cast(id_type)).withColumnRenamed("conv", conv)


def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, present): rows damaged by a checksum of
    conversation and turn (nulls: one space), modulo 20: 0 drops the row (it
    stays as not present), 1 empties its text, 2 removes its sentence ends, 3
    repeats it, 4 makes its role user. Null roles and texts are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    way = F.crc32(F.concat(space(conv), F.lit(":"), space(turn))) % 20
    x = space(text)
    new: Column = F.when(way == 1, "").when(way == 2, F.regexp_replace(x, "[.!?]", "")).otherwise(x)
    one = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.when(way == 4, USER).otherwise(space(role)).alias("role"), new.alias("text"),
        (way != 0).alias("present"), F.explode(F.when(way == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return one.drop("copy")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(damage(c), "conv", "turn", "role", "text", "present").withColumnRenamed("conv", "conv_id")
