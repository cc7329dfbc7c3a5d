"""Secrets in texts, found through an inverted index of trigrams.

From each rule's pattern follows a Boolean condition on trigrams that every text with a match must
meet, such as ``tok and oke and ken`` for a token. Postings say in which documents a trigram occurs; where
conditions are met by intersecting and uniting postings, documents are candidates, and only
their texts are searched. A pattern that demands no trigram, as one of classes alone, is searched for in all texts.

Postings are kept by blocks of documents, so one of a frequent trigram is many short lists. Only
trigrams that some rule asks for are indexed. All of it is built-in functions.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from itertools import product
from re import _constants as codes, _parser as parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Different strings that a part of a pattern may stand for before it counts as unknown.
MOST_STRINGS = 32
#: Documents whose postings lie together.
BLOCK = 4096


class Rule(NamedTuple):
    """Matches of ``pattern`` (leftmost, not overlapping) of which ``group`` has ``least`` characters or more."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def either_case(words: str) -> str:
    """A pattern's letters as classes of both cases; flags for this fold other letters too in some engines."""
    return re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", words)


#: The kinds of secrets in the order in which equal starts are listed. 32 or more digits in a row
#: are what is left of all runs of digits when those that are too short are dropped.
RULES = (
    Rule("assign", f"({either_case('password|passwd|secret|token|api_?key')})"
                   r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "[0-9a-f]{32,}"),
)

# Conditions: True (no condition), a trigram, or ("and" | "or", conditions).


def _joined(how: str, conditions: Iterable) -> object:
    unique = list(dict.fromkeys(conditions))
    if how == "and":
        unique = [c for c in unique if c is not True]
    elif True in unique:
        return True
    if len(unique) < 2:
        return unique[0] if unique else True
    return (how, tuple(unique))


def _demanded(strings: set[str]) -> object:
    """The condition that one of the strings occurs."""
    return _joined("or", (_joined("and", (s[i:i + 3] for i in range(len(s) - 2))) for s in sorted(strings)))


def _class(items: list) -> set[str] | None:
    found: set[str] = set()
    for what, value in items:
        if what is codes.LITERAL:
            found.add(chr(value).lower())
        elif what is codes.RANGE and value[1] - value[0] < MOST_STRINGS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= MOST_STRINGS else None


def _understood(parsed: Iterable) -> tuple[set[str] | None, object]:
    """The lower-cased strings that a parsed pattern stands for, or None and a condition on trigrams."""
    known, conditions = {""}, []
    whole = True

    def cut(condition=True):
        nonlocal known, whole
        conditions.extend([_demanded(known), condition])
        known, whole = {""}, False

    def add(strings):
        nonlocal known
        if len(known) * len(strings) > MOST_STRINGS:
            cut()
        known = {a + b for a, b in product(known, strings)}

    for what, value in parsed:
        if what is codes.LITERAL:
            add({chr(value).lower()})
        elif what is codes.IN and (strings := _class(value)):
            add(strings)
        elif what is codes.SUBPATTERN:
            strings, condition = _understood(value[-1])
            add(strings) if strings else cut(condition)
        elif what is codes.BRANCH:
            branches = [_understood(b) for b in value[1]]
            if all(strings for strings, _ in branches):
                add(set().union(*(strings for strings, _ in branches)))
            else:
                cut(_joined("or", (_demanded(s) if s else c for s, c in branches)))
        elif what in (codes.MAX_REPEAT, codes.MIN_REPEAT):
            least, most, inner = value
            strings, condition = _understood(inner)
            if strings and most == 1:
                add(strings if least else strings | {""})
            else:
                cut((_demanded(strings) if strings else condition) if least else True)
        elif what is not codes.AT:
            cut()
    return (known, True) if whole else (None, _joined("and", [*conditions, _demanded(known)]))


def trigram_condition(pattern: str) -> object:
    """What a pattern demands of a lower-cased text: True, a trigram, or ("and" | "or", conditions)."""
    strings, condition = _understood(parser.parse(pattern))
    return _demanded(strings) if strings else condition


def trigrams_of(condition: object) -> set[str]:
    if condition is True:
        return set()
    return {condition} if isinstance(condition, str) else set().union(*map(trigrams_of, condition[1]))


def postings(docs: DataFrame, trigrams: Iterable[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``block, trigram, ids``: the documents of a block in whose lower-cased text a trigram occurs, sorted.

    Blocks are a hash of the id, as many as there are times ``BLOCK`` documents. Rows without an id are in
    no posting.
    """
    blocks = docs.count() // BLOCK + 1
    wanted = F.lit(sorted(trigrams))
    named = docs.filter(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("_id"), F.lower(F.col(text)).alias("_text"))
    each = named.select("_id", F.explode(F.filter(wanted, lambda t: F.contains(F.col("_text"), t))).alias("trigram"))
    return each.groupBy(F.pmod(F.xxhash64("_id"), F.lit(blocks)).alias("block"), "trigram").agg(
        F.sort_array(F.collect_set("_id")).alias("ids"))


def _met(condition: object, ids_of: Column, empty: Column) -> Column:
    if isinstance(condition, str):
        return F.coalesce(ids_of[condition], empty)
    how, parts = condition
    combine = F.array_intersect if how == "and" else F.array_union
    return reduce(combine, (_met(c, ids_of, empty) for c in parts))


def candidates(index: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """``_id, kinds``: the documents whose trigrams meet the condition of a rule, and those rules' kinds."""
    kind = index.schema["ids"].dataType
    by_block = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("of"))
    met = [F.struct(F.lit(rule.kind).alias("kind"), _met(
        trigram_condition(rule.pattern), F.col("of"), F.array().cast(kind)).alias("ids")) for rule in rules]
    found = by_block.select(F.explode(F.array(*met)).alias("met")).select(
        F.col("met.kind").alias("kind"), F.explode("met.ids").alias("_id"))
    return found.groupBy("_id").agg(F.collect_set("kind").alias("kinds"))


def _spans(rule: Rule, rank: int, text: Column) -> Column:
    """Sorted structs (start, rank, kind, end) of a rule's matches in a text, by code points.

    A text is its matches and what lies between them, in turn, so starts are sums of their lengths.
    """
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    between = F.split(text, rule.pattern, -1)
    kind = "array<struct<start:int,rank:int,kind:string,end:int>>"
    none = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))

    def step(seen: Column, one: Column) -> Column:
        start = seen["at"] + F.length(one["between"])
        end = start + F.length(one["whole"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(F.length(one["judged"]) >= rule.least, F.array_append(
            seen["spans"], span)).otherwise(seen["spans"]).alias("spans"))

    each = F.arrays_zip(F.slice(between, 1, F.size(whole)).alias("between"), whole.alias("whole"), judged.alias("judged"))
    return F.aggregate(each, none, step, lambda seen: seen["spans"])


def scanned(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``spans``: structs (start, rank, kind, end) of the secrets in their texts.

    Places count code points, ends are exclusive; spans are sorted by start, equal ones in the order of the rules. A null or
    empty text has none. Rows without an id are in no posting, so all their rules are searched for; rows that share an id are searched
    alike, each in its own text. Texts may be of any length. Repeated rows and other columns stay as they are,
    but a column ``spans`` is replaced. An empty table gives an empty one.
    """
    indexed = [r for r in rules if trigram_condition(r.pattern) is not True]
    names = [c for c in docs.columns if c != "spans"]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"))
    kinds = F.array().cast("array<string>")
    if indexed:
        index = staged(postings(docs, set().union(*(trigrams_of(trigram_condition(r.pattern)) for r in indexed)),
                                doc_id, text), "trigram-postings")
        # Candidates have no size bound: they are merged with the rows at every size.
        rows = rows.join(candidates(index, indexed).hint("merge"), F.col("row")[doc_id] == F.col("_id"), "left")
        kinds = F.when(F.col("row")[doc_id].isNull(), F.lit([r.kind for r in indexed])).otherwise(F.col("kinds"))
    whole = F.coalesce(F.col("row")[text], F.lit(""))
    nothing = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    each = []
    for rank, rule in enumerate(rules):
        worth = F.array_contains(kinds, rule.kind) if rule in indexed else F.lit(True)
        each.append(F.when(worth & whole.rlike(rule.pattern), _spans(rule, rank, whole)).otherwise(nothing))
    return rows.select(*(F.col("row")[c].alias(c) for c in names), F.array_sort(F.concat(*each)).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
