"""Repairs of the structure of conversations: a cheapest list of edits that makes the roles alternate.

The turns of a conversation are repartitioned to one task, sorted, and stream through it. Four states
say what has been written so far (nothing, a system turn, up to a user turn, up to an assistant
turn); for each the task carries the cost of the cheapest edits, and their rank among the four
as text. That pair is all a turn needs, so memory doesn't grow with a conversation. A turn adds
one byte a state of back-pointers, and its role and text; both go to a spill file of the task once they outgrow
a few megabytes. At the conversation's end the pointers are read backwards, and the turns once more in order.

Texts that occur before in a conversation are found by Spark: repeated digests come as markers
that sort before the turns they concern, so a task holds no set of texts.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
#: What a turn adds that is kept though its text breaks off.
CUT = 5
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT,
        (ASSISTANT, "u"): USER}
WANTED = {NOTHING: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
FULL = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: From any state, whatever another can still write can be written for this much more, by two insertions and a
#: deletion at most. A state that costs more than the cheapest by more than this is on no cheapest path.
BEYOND = 2 * INSERT + DELETE
#: Edits of one turn: insertions before it, and its own letter. Two insertions reach every state there is.
STEPS = ["I" * n + x for n in range(3) for x in "DKR"]
#: Bytes of back-pointers and of turns that stay in memory.
POINTERS_HELD, TURNS_HELD = 1 << 20, 4 << 20
_BLANKS = " \t\n\x0b\x0c\r"
_MARK, _TURN, _GONE = 0, 1, 2


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with planted faults, by crc32 of ``conv_id:turn`` modulo 20: 0 drops a turn (column
    ``gone``), 1 empties its text, 2 removes its full stops, question and exclamation marks, 3 repeats
    it, 4 makes it the user's. Nulls are one space, but for ``turn`` itself, and ``conv_id``."""
    def or_space(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    text = or_space("text")
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(or_space("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"), F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0)))).alias("_copy")).drop("_copy")


def _moves(initial: str, gone: bool, cut: bool) -> list[tuple[int, int, int, str, int]]:
    """What can be done with a turn: from, to, cost, edits, their number."""
    found = []
    for before in range(4):
        state, cost = before, 0
        for inserted in range(3):
            def add(letter, after, more):
                step = "I" * inserted + letter
                found.append((before, after, cost + more, step, STEPS.index(step)))
            add("D", state, DELETE)
            if not gone:
                more = CUT if cut else 0
                if (state, initial) in NEXT:
                    add("K", NEXT[state, initial], KEEP + more)
                add("R", NEXT[state, WANTED[state]], REROLE + more)
            state, cost = NEXT[state, WANTED[state]], cost + INSERT
    return found


class _Steps(dict):
    """(costs and ranks of the states, kind of turn) -> costs and ranks after it, what all of them rose by,
    and back-pointers. Costs count from the least, and states beyond hope go, so there are few such pairs, and
    each is worked out once.

    Edits of as many turns that don't end with an insertion can't begin with one another, so the rank of
    two such texts also orders whatever is added to them.
    """
    START = ((0, None, None, None), (0, 0, 0, 0))

    def __missing__(self, key):
        (costs, ranks), kind = key
        best = {}
        for before, after, cost, step, number in _moves(*kind):
            if costs[before] is not None:
                one = (costs[before] + cost, ranks[before], step, before | number << 2)
                if after not in best or one < best[after]:
                    best[after] = one
        least = min(x[0] for x in best.values())
        best = {s: x for s, x in best.items() if x[0] <= least + BEYOND}
        order = sorted(best, key=lambda s: best[s][1:3])
        self[key] = (
            (tuple(best[s][0] - least if s in best else None for s in range(4)),
             tuple(order.index(s) if s in best else 0 for s in range(4))),
            least, bytes(best[s][3] if s in best else 0 for s in range(4)))
        return self[key]


class _Conversation:
    """One conversation as it streams past."""

    def __init__(self, steps: _Steps):
        self.steps, self.state, self.cost = steps, _Steps.START, 0
        self.pointers = tempfile.SpooledTemporaryFile(POINTERS_HELD)
        self.turns = tempfile.SpooledTemporaryFile(TURNS_HELD)
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.numbers, self.first_number, self.number = 0, None, None
        self.last = self.initial = None
        self.marked: set[bytes] = set()

    def __enter__(self) -> _Conversation:
        return self

    def __exit__(self, *_):
        self.pointers.close()
        self.turns.close()

    def at(self, number: int | None) -> None:
        """A turn number, in order; nulls come first."""
        if number != self.number:
            self.marked, self.number = set(), number

    def mark(self, digest: bytes) -> None:
        self.marked.add(digest)

    def add(self, role: str, text: str, digest: bytes, ending: str) -> None:
        if self.number is not None and (not self.numbers or self.number != self.last[0]):
            self.numbers += 1
            self.first_number = self.number if self.first_number is None else self.first_number
        seen = digest in self.marked or self.last == (self.number, digest)
        blank, cut = not ending, ending not in (".", "!", "?")
        self.blank += blank
        self.duplicate += seen and not blank
        self.truncated += cut and not seen and not blank
        initial = role[:1]
        self.illegal += self.n > 0 and self.initial + initial not in LEGAL
        self.last, self.initial, self.n = (self.number, digest), initial, self.n + 1
        known = initial if initial in FULL or initial == "s" else ""
        self.state, cost, pointers = self.steps[self.state, (known, blank or seen, cut)]
        self.cost += cost
        self.pointers.write(pointers)
        role, text = role.encode(), text.encode()
        self.turns.write(struct.pack("<II", len(role), len(text)) + role + text)

    def finish(self) -> None:
        """The cheapest edits, the first of them in the order of their letters."""
        costs, ranks = self.state
        cost, _, inserted, state = min(
            (costs[s] + n * INSERT, ranks[s], n, s)
            for s, n in ((NOTHING, 0), (ASSISTANT, 0), (USER, 1), (SYSTEM, 2)) if costs[s] is not None)
        self.cost += cost
        letters = bytearray(b"I" * inserted)
        backwards = [s.encode()[::-1] for s in STEPS]
        end = 4 * self.n
        while end:
            start = max(0, end - (1 << 18))
            self.pointers.seek(start)
            some = self.pointers.read(end - start)
            for row in range(len(some) - 4, -1, -4):
                pointer = some[row + state]
                letters += backwards[pointer >> 2]
                state = pointer & 3
            end = start
        letters.reverse()
        self.audit = letters.decode()

    def repaired(self) -> Iterator[tuple[str, str, str]]:
        """Edit, role and text of what stays."""
        self.turns.seek(0)
        state = NOTHING
        for edit in self.audit:
            role, text = "", ""
            if edit != "I":
                sizes = struct.unpack("<II", self.turns.read(8))
                role, text = (self.turns.read(n).decode() for n in sizes)
                if edit == "D":
                    continue
            if edit != "K":
                role = FULL[WANTED[state]]
            state = NEXT[state, role[:1]]
            yield edit, role, text

    def report(self) -> tuple:
        digest, between = hashlib.sha256(), b""
        for _, role, text in self.repaired():
            digest.update(b"%b%b:%b" % (between, role.encode(), text.encode()))
            between = b"\n"
        gaps = self.last[0] - self.first_number + 1 - self.numbers if self.numbers else 0
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, self.audit,
                digest.hexdigest())


def _streamed(emit: Callable, columns: list[str], size: Callable) -> Callable:
    """Sorted rows of conversations -> what ``emit`` gives of each, a frame for about 4 MB."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps, key, one, out, held = _Steps(), None, None, [], 0

        def finished():
            nonlocal out, held
            with one:
                one.finish()
                for row in emit(one):
                    out.append((key, *row))
                    held += size(row)
                    if held > 4 << 20:
                        yield pd.DataFrame(out, columns=columns)
                        out, held = [], 0

        for frame in frames:
            for conv, turn, kind, role, text, digest, ending in zip(*(frame[c].tolist() for c in frame.columns)):
                if conv != key:
                    if one:
                        yield from finished()
                    key, one = conv, _Conversation(steps)
                if kind == _GONE:
                    continue
                one.at(None if turn is None else int(turn))
                if kind == _MARK:
                    one.mark(digest)
                else:
                    one.add(role, text, digest, ending)
        if one:
            yield from finished()
        if out:
            yield pd.DataFrame(out, columns=columns)
    return run


def _sorted(turns: DataFrame, gone: Column) -> DataFrame:
    """Turns and markers, one conversation after the other, each by turn (nulls first), role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    conv = F.concat(F.when(F.col("conv_id").isNull(), "0").otherwise("1"),
                    F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    rows = turns.select(
        conv.alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.when(F.coalesce(gone, F.lit(False)), _GONE).otherwise(_TURN).alias("kind"), role.alias("role"), text.alias("text"))
    digest = F.unhex(F.md5(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text")))
    ending = F.right(F.rtrim("text", F.lit(_BLANKS)), F.lit(1))
    whole = rows.select(
        "conv", "turn", "kind", *(F.when(F.col("kind") == _TURN, F.col(c)).alias(c) for c in ("role", "text")),
        F.when(F.col("kind") == _TURN, digest).alias("digest"), F.when(F.col("kind") == _TURN, ending).alias("ending"))
    # Order of turns with nulls first; a marker stands for all rows of a digest in its turn.
    narrow = whole.filter(F.col("kind") == _TURN).select("conv", F.struct("turn").alias("at"), "digest").groupBy(
        "conv", "digest", "at").agg(F.lit(1).alias("_")).drop("_")
    first = narrow.groupBy("conv", "digest").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).filter(
        "n > 1").select("conv", "digest", "first")
    marks = narrow.join(first, ["conv", "digest"]).filter(F.col("at") > F.col("first")).select(
        "conv", F.col("at.turn").alias("turn"), F.lit(_MARK).alias("kind"),
        *(F.lit(None).cast("string").alias(c) for c in ("role", "text")), "digest",
        F.lit(None).cast("string").alias("ending"))
    both = whole.unionByName(marks).repartition("conv").sortWithinPartitions(
        "conv", F.asc_nulls_first("turn"), "kind", "role", "text")
    return both.select("conv", F.col("turn").cast("string").alias("turn"), "kind", "role", "text", "digest", "ending")


def _with_ids(found: DataFrame, turns: DataFrame) -> DataFrame:
    ids = F.when(F.col("conv").startswith("1"), F.expr("substring(conv, 2)")).cast(turns.schema["conv_id"].dataType)
    return found.select(ids.alias("conv_id"), *(c for c in found.columns if c != "conv"))


def audits(turns: DataFrame, gone: Column | None = None) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): its faults and its repair.

    ``conv_id``, ``gaps`` (turn numbers missing between the least and the largest; nulls don't count),
    ``blank``, ``duplicate``, ``truncated`` (turns by their first fault), ``illegal`` (neighbours whose
    initials are not su, ua or au), ``cost``, ``audit`` (the letters of the edits in order; of equally
    cheap ones the first by ASCII), ``repaired_sha256`` (of the lines ``role:text`` that result).

    A null role or text is one space; a null ``conv_id`` is a conversation of its own. Turns with equal
    numbers (nulls too) are taken by role and text; repeated rows are duplicates. Rows where ``gone`` holds
    don't count, but their conversation is reported: without turns all numbers are zero and the audit is
    empty. Texts may be of any length, conversations too; other columns are ignored; an empty table gives none.
    """
    schema = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
              "audit string, repaired_sha256 string")
    names = [x.split()[0] for x in schema.split(", ")]
    run = _streamed(lambda one: [one.report()], names, lambda row: 200 + len(row[6]))
    return _with_ids(_sorted(turns, F.lit(False) if gone is None else gone).mapInPandas(run, schema), turns)


def repaired(turns: DataFrame, gone: Column | None = None) -> DataFrame:
    """The turns after the repair: ``conv_id``, ``place`` (from 0), ``edit`` (K, R or I), ``role``, ``text``.

    As ``audits`` in all cases; a conversation without remaining turns has no rows.
    """
    def emit(one):
        return ((place, *turn) for place, turn in enumerate(one.repaired()))

    run = _streamed(emit, ["conv", "place", "edit", "role", "text"], lambda row: 100 + 2 * len(row[3]))
    found = _sorted(turns, F.lit(False) if gone is None else gone).mapInPandas(
        run, "conv string, place long, edit string, role string, text string")
    return _with_ids(found, turns)
