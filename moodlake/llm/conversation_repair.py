"""Repair of conversation structure by a secondary-sorted stream.

A conversation is a list of turns whose roles must read system (optional),
then user and assistant in turn, ending with assistant, or nothing at all.
Each turn is kept, given the other role, or deleted, and empty turns may be
inserted; the cheapest edits are found by dynamic programming over four states
(nothing yet, after system, after user, after assistant).

Rows are dealt by conversation once. Inside a partition they are sorted by
conversation and turn, last turn first: one pass carries the four costs to go
from batch to batch and gives every row its back pointers, 16 bits in all (what
to do in each state). The rows are sorted the other way round in place, where
Spark spills rows and pointers of a giant conversation to disk; a second pass
follows the pointers and carries one state and one running digest. So Python
holds a batch and a few numbers whatever the length of a conversation, besides
its audit string. A conversation is one stream by nature: its digest is one
SHA-256 over all its text in order.

Cases: a null role or text counts as one space. Turns are taken nulls first,
equal turns by role, then text. A null ``conv_id`` is a conversation of its
own. Ties between cheapest edits go to the least audit string (D < I < K < R).
A row that repeats role and text of an earlier one is a duplicate. Only the
four named columns are read; others, whatever their names, are left out. An
empty table gives an empty result. Gaps beyond the range of a long are given as its largest value.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlake.llm.common import SPACES

# Costs of the edits, and of leaving a truncated turn in.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NONE, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
LETTERS = "DKR"
# Inserted turns that make a valid end from each state, and their cost.
TAIL = (0, 2, 1, 0)
LAST = tuple(n * INSERT for n in TAIL)
LEGAL = ("su", "ua", "au")
MAX_LONG = 2 ** 63 - 1


def _inserted(state: int) -> int:
    """State after one inserted turn: the one that may come next."""
    return ASSISTANT if state == USER else USER


def _said(state: int, initial: str) -> int | None:
    """State after a turn with that initial; None where it may not come."""
    if initial == "s":
        return SYSTEM if state == NONE else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


@lru_cache(maxsize=None)
def _choices(kind: str) -> tuple:
    """Per state: ``(edits, cost, state after, inserts, letter)`` in order of the
    edits' text. ``kind`` is the initial of a turn, ``-`` in front of it where it is
    truncated, or ``x`` where it must go. More than two inserts in a row never pay."""
    out = []
    for state in range(4):
        found, at = [], state
        for n in range(3):
            found.append(("I" * n + "D", n * INSERT + DELETE, at, n, 0))
            if kind != "x":
                extra = n * INSERT + (TRUNCATED if kind[0] == "-" else 0)
                if (to := _said(at, kind[-1])) is not None:
                    found.append(("I" * n + "K", extra + KEEP, to, n, 1))
                found.append(("I" * n + "R", extra + REROLE, _inserted(at), n, 2))
            at = _inserted(at)
        out.append(tuple(sorted(found)))
    return tuple(out)


@lru_cache(maxsize=100_000)
def _back(kind: str, ahead: tuple) -> tuple:
    """Costs to go before a turn (less their smallest, which decides nothing) and
    the turn's pointers, from the costs to go after it. No candidate's text begins
    another's, so the first of the cheapest in text order gives the least audit."""
    costs, pointers = [], 0
    for state, options in enumerate(_choices(kind)):
        _, cost, to, n, letter = min(options, key=lambda o: o[1] + ahead[o[2]])
        costs.append(cost + ahead[to])
        pointers |= (n * 3 + letter) << (4 * state)
    low = min(costs)
    return tuple(c - low for c in costs), pointers


def _initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else "o"


def _key(values) -> list:
    return [None if v is None or v != v else v for v in values]


def _pointers(batches):
    """Backward pass: rows sorted last turn first get their pointers."""
    conv, ahead = object(), LAST
    for rows in batches:
        out = []
        for c, alive, fault, role in zip(_key(rows["conv"]), rows["alive"], rows["fault"], rows["role"]):
            if c != conv:
                conv, ahead = c, LAST
            if not alive:
                out.append(0)
                continue
            kind = "x" if fault in ("blank", "duplicate") else ("-" if fault == "truncated" else "") + _initial(role)
            ahead, pointers = _back(kind, ahead)
            out.append(pointers)
        rows["pointers"] = out
        yield rows


def _follow(state: int, role: str, pointers: int):
    """``[(letter, role)]`` of one turn's edits and the state after them."""
    n, letter = divmod((pointers >> (4 * state)) & 15, 3)
    out = []
    for _ in range(n):
        state = _inserted(state)
        out.append(("I", ROLES[state]))
    if LETTERS[letter] == "K":
        state = _said(state, _initial(role))
        out.append(("K", role))
    elif LETTERS[letter] == "R":
        state = _inserted(state)
        out.append(("R", ROLES[state]))
    else:
        out.append(("D", role))
    return out, state


def _tail(state: int) -> list:
    out = []
    for _ in range(TAIL[state]):
        state = _inserted(state)
        out.append(("I", ROLES[state]))
    return out


def _edited(batches):
    """Forward pass to rows: every edit of every conversation in order."""
    import pandas as pd

    conv, state, at, started = None, NONE, 0, False
    for rows in batches:
        out = []

        def put(letter, role, turn, text, old):
            nonlocal at
            out.append((conv, at, turn, letter, role, text, old))
            at += 1

        for c, turn, alive, role, text, pointers in zip(_key(rows["conv"]), rows["turn_text"], rows["alive"], rows["role"],
                                                        rows["text"], rows["pointers"]):
            if not started or c != conv:
                for letter, r in _tail(state):
                    put(letter, r, None, "", None)
                conv, state, at, started = c, NONE, 0, True
            if not alive:
                continue
            edits, state = _follow(state, role, pointers)
            for letter, r in edits:
                put(letter, r, None if letter == "I" else turn, "" if letter == "I" else text, None if letter == "I" else role)
        yield pd.DataFrame(out, columns=["conv", "position", "turn_text", "edit", "role", "text", "old_role"])
    out = []
    for letter, r in _tail(state):
        out.append((conv, at + len(out), None, letter, r, "", None))
    if out:
        yield pd.DataFrame(out, columns=["conv", "position", "turn_text", "edit", "role", "text", "old_role"])


class _Audit:
    """What a conversation's digest needs while its rows go by."""

    def __init__(self, conv):
        import hashlib
        self.conv, self.state, self.cost = conv, NONE, 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.low = self.high = self.turn = self.before = None
        self.turns = self.illegal = 0
        self.audit, self.sha, self.empty = [], hashlib.sha256(), True

    def put(self, edits, text: str, truncated: bool) -> None:
        for letter, role in edits:
            self.audit.append(letter)
            self.cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[letter]
            if letter == "D":
                continue
            self.cost += TRUNCATED if truncated and letter != "I" else 0
            line = f"{role}:{'' if letter == 'I' else text}"
            self.sha.update((line if self.empty else "\n" + line).encode())
            self.empty = False

    def take(self, turn, role, text, fault, pointers) -> None:
        if turn is not None:
            turn = int(turn)
            self.turns += turn != self.turn
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
        if self.before is not None:
            self.illegal += self.before + role[:1] not in LEGAL
        self.before = role[:1]
        if fault:
            self.faults[fault] += 1
        edits, self.state = _follow(self.state, role, pointers)
        self.put(edits, text, fault == "truncated")

    def row(self) -> tuple:
        self.put(_tail(self.state), "", False)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, min(gaps, MAX_LONG), *self.faults.values(), self.illegal, self.cost, "".join(self.audit),
                self.sha.hexdigest())


AUDIT = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _audited(batches):
    """Forward pass to digests: one row per conversation, given out when it ends."""
    import pandas as pd

    now = None
    for rows in batches:
        out = []
        for c, turn, alive, role, text, fault, pointers in zip(
                _key(rows["conv"]), rows["turn_text"], rows["alive"], rows["role"], rows["text"], rows["fault"],
                rows["pointers"]):
            if now is None or c != now.conv:
                if now is not None:
                    out.append(now.row())
                now = _Audit(c)
            if alive:
                now.take(turn, role, text, fault, pointers)
        yield pd.DataFrame(out, columns=AUDIT)
    if now is not None:
        yield pd.DataFrame([now.row()], columns=AUDIT)


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage by CRC-32 of ``conv_id:turn``: 0 drops the row, 1
    empties its text, 2 takes its end marks, 3 repeats it, 4 makes it the user's.
    Dropped rows stay with ``alive`` false, so that their conversation is known."""
    def plain(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    luck = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"),
                                luck.alias("luck"))
    text = (F.when(F.col("luck") <= 1, "").when(F.col("luck") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    copies = F.when(F.col("luck") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(F.col("luck") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("luck") != 0).alias("alive"), F.explode(copies).alias("copy")).drop("copy")


def pointed(conversations: DataFrame) -> DataFrame:
    """Rows in reading order inside their partition, each with its fault and
    pointers. An ``alive`` column, where given as boolean, marks rows that only name their conversation."""
    alive = F.coalesce("alive", F.lit(True)) if "alive" in conversations.columns else F.lit(True)
    turn = F.col("turn").cast("long")
    rows = conversations.select(
        F.col("conv_id").cast("string").alias("conv"), turn.alias("turn"), turn.cast("string").alias("turn_text"),
        alive.alias("alive"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    rows = rows.repartition("conv")
    # The window's keys begin with the partitioning's, so this is a sort in place.
    again = Window.partitionBy("conv", "role", "text", "alive").orderBy(F.col("turn").asc_nulls_first())
    end = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    fault = (F.when(end == "", "blank").when(F.col("copy") > 1, "duplicate")
             .when(~end.isin(".", "!", "?"), "truncated").otherwise(""))
    rows = rows.withColumn("copy", F.row_number().over(again)).withColumn("fault", fault)
    order = ["turn", "role", "text", "copy"]
    rows = rows.sortWithinPartitions(F.col("conv").asc_nulls_first(), *[F.col(c).desc_nulls_last() for c in order])
    columns = "conv string, turn_text string, alive boolean, role string, text string, copy int, fault string, pointers int"
    rows = rows.select("conv", "turn_text", "alive", "role", "text", "copy", "fault").mapInPandas(_pointers, columns)
    turn = F.col("turn_text").cast("long")
    return rows.sortWithinPartitions(F.col("conv").asc_nulls_first(), turn.asc_nulls_first(), "role", "text", "copy")


def repair(conversations: DataFrame) -> DataFrame:
    """Every edit in order: ``conv_id, position, turn, edit, role, text, old_role``.
    Rows whose ``edit`` is not D are the repaired conversation."""
    rows = pointed(conversations).mapInPandas(
        _edited, "conv string, position long, turn_text string, edit string, role string, text string, old_role string")
    return rows.select(F.col("conv").cast(conversations.schema["conv_id"].dataType).alias("conv_id"), "position",
                       F.col("turn_text").cast("long").alias("turn"), "edit", "role", "text", "old_role")


def audit(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cost and letters of its edits
    and the SHA-256 of the repaired text."""
    longs = ", ".join(f"{c} long" for c in AUDIT[1:7])
    rows = pointed(conversations).mapInPandas(_audited, f"conv string, {longs}, audit string, repaired_sha256 string")
    return rows.select(F.col("conv").cast(conversations.schema["conv_id"].dataType).alias("conv_id"), *AUDIT[1:])
