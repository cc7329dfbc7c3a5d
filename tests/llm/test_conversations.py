"""Conversation repair against a search over all edits, and the query against its SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import pytest

from tidemark.llm import conversations as conv
from tidemark.llm.queries import QUERIES

BLANKS = " \t\n\x0b\x0c\r"


def damage(rows):
    for conv_id, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        for _ in range((kind != 0) + (kind == 3)):
            yield conv_id, turn, role, text


def search(turns):
    """Least (cost, edits) over every edit of every turn, and the lines that result."""
    @lru_cache(None)
    def best(i, last, insertions):
        # ``last``: n nothing, s system, u or a the turn written last.
        found = [(0, "", ())] if i == len(turns) and last in "na" else []
        new = "assistant" if last == "u" else "user"

        def then(letter, cost, more, *line):
            if more:
                found.append((cost + more[0], letter + more[1], (*line, *more[2])))

        if insertions:
            then("I", 5, best(i, new[0], insertions - 1), f"{new}:")
        if i < len(turns):
            role, text, gone, cut = turns[i]
            then("D", 2, best(i + 1, last, 2))
            if not gone:
                then("R", 1 + 5 * cut, best(i + 1, new[0], 2), f"{new}:{text}")
                if role and role[0] in {"n": "su", "s": "u", "u": "a", "a": "u"}[last]:
                    then("K", 5 * cut, best(i + 1, role[0], 2), f"{role}:{text}")
        return min(found, default=None)

    return best(0, "n", 2)


def brute_force(rows):
    by = defaultdict(list)
    ids = {r[0] for r in rows}
    for conv_id, turn, role, text in damage(rows):
        by[conv_id].append((turn is not None, turn or 0, role, text))
    for conv_id in ids:
        turns, seen, counts, judged = sorted(by[conv_id]), set(), Counter(), []
        numbers = [t for known, t, *_ in turns if known]
        for _, _, role, text in turns:
            end = text.rstrip(BLANKS)[-1:]
            fault = ("blank" if not end else "duplicate" if (role, text) in seen
                     else "truncated" if end not in ".!?" else None)
            seen.add((role, text))
            counts[fault] += 1
            judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, lines = search(judged)
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        yield (conv_id, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
               hashlib.sha256("\n".join(lines).encode()).hexdigest())


def made_up(seed, n=250):
    rng = random.Random(seed)
    rows = []
    for conv_id in [None, *range(n)]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "User", "umpire"])
            text = rng.choice(["Yes.", "No!", "so what", "", " \n", None, "Again? ", f"word {rng.random()}.", "ß" * 40 + "."])
            rows.append((conv_id, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    rows += rows[:40]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    extra = ["conv", "kind", "digest", "ending", "at", "first", "n", "place", "edit", "gone"]
    return spark.createDataFrame([(*r, *range(len(extra))) for r in rows],
                                 "conv_id long, turn long, role string, text string, " + ", ".join(f"`{c}` long" for c in extra))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_search(spark, seed):
    rows = made_up(seed)
    found = conv.audits(conv.damaged(frame(spark, rows).repartition(5)), gone=conv.F.col("gone")).collect()
    assert Counter(map(tuple, found)) == Counter(brute_force(rows))


def test_repaired_turns_make_the_digest(spark):
    turns = conv.damaged(frame(spark, made_up(3, 60)))
    audits = {r.conv_id: r for r in conv.audits(turns, gone=conv.F.col("gone")).collect()}
    lines = defaultdict(list)
    for r in sorted(conv.repaired(turns, gone=conv.F.col("gone")).collect(), key=lambda r: r.place):
        lines[r.conv_id].append(r)
    for conv_id, row in audits.items():
        text = "\n".join(f"{r.role}:{r.text}" for r in lines[conv_id])
        assert hashlib.sha256(text.encode()).hexdigest() == row.repaired_sha256
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in lines[conv_id]))
        assert "".join(r.edit for r in lines[conv_id]) == row.audit.replace("D", "")


def test_giant_conversation_spills(spark, monkeypatch):
    monkeypatch.setattr(conv, "POINTERS_HELD", 100)
    monkeypatch.setattr(conv, "TURNS_HELD", 100)
    rows = [(7, i, "user" if i % 3 else "assistant", f"turn {i}." if i % 10 else "x" * 100_000) for i in range(4000)]
    (found,) = conv.audits(frame(spark, rows)).collect()
    seen, judged = set(), []
    for _, _, role, text in rows:
        judged.append((role, text, (role, text) in seen, not text.endswith(".")))
        seen.add((role, text))
    least = [0, None, None, None]
    for role, _, gone, cut in judged:
        after = [None] * 4
        for before, state, cost, _, _ in conv._moves(role[0], gone, cut):
            if least[before] is not None and (after[state] is None or least[before] + cost < after[state]):
                after[state] = least[before] + cost
        least = after
    assert found.cost == min(least[0], least[3], least[2] + 5)
    assert len(found.audit.replace("I", "")) == 4000 and (found.truncated, found.duplicate) == (2, 398)


def test_few_states_are_worked_out():
    """However long a conversation, the pairs of costs and ranks are few."""
    rng, steps, state = random.Random(8), conv._Steps(), conv._Steps.START
    for _ in range(60_000):
        state = steps[state, (rng.choice(["s", "u", "a", ""]), rng.random() < 0.2, rng.random() < 0.3)][0]
    assert len(steps) < 5000


def test_long_text_and_empty_table(spark):
    rows = [(1, 0, "user", "y" * 3_000_000 + "."), (1, 1, "assistant", "Z" * 3_000_000)]
    (found,) = conv.audits(frame(spark, rows)).collect()
    assert (found.truncated, found.cost, found.audit) == (1, 4, "DD")
    assert conv.audits(frame(spark, rows).filter("false")).count() == 0
    assert conv.repaired(frame(spark, rows).filter("false")).count() == 0


def test_query_equals_sql(spark, equals_sql):
    equals_sql("op11_conversation_repair", "conversations")
    assert "op11_conversation_repair" in QUERIES
