"""Many regular-expression rules over many texts: literals that a match must contain are searched for all rules at once, and only rules that can match are tried."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

try:
    from re import _parser as regex_parser  # the standard library's own
except ImportError:  # older Pythons
    import sre_parse as regex_parser

LEAST_LETTERS, MOST_CHOICES, MOST_RULES = 2, 64, 20_000  # of a literal; of a rule; rules searched in one pass
# Constructs that Java and Python read differently; rules with them are tried on every text.
UNLIKE = re.compile(r"\\[^bBdDsSwWntrf.\\+*?()|{}^$/\-\[\]]|\[[^\]]*\[|&&|\(\?[a-zA-Z^-]*[xu]")


def lower(text: str) -> str:
    """A-Z in lower case, as patterns that ignore case are matched."""
    return text.translate(_LOWER)


_LOWER = {c: c + 32 for c in range(65, 91)}
_SPACES = re.compile(r"[ \t\n\r\f\v]{2,}|[\t\n\r\f\v]")


def plain(text: str) -> str:
    """``lower``, and each run of white space as one space, in which literals are searched: a text that holds another holds it in this form too."""
    return _SPACES.sub(" ", lower(text))


# What patterns begin with: they ignore case (A-Z), and lines end with \n alone, whatever the text's script.
FLAGS = "(?id)"
_ASCII = {"b": r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))", "B": r"(?:(?<=\w)(?=\w)|(?<!\w)(?!\w))"}


def ascii_bounds(pattern: str) -> str:
    """A pattern whose ``\\b`` and ``\\B`` tell words of ``\\w`` (ASCII) apart on any JVM, as SQL engines do. By itself Java sees a boundary between ASCII and other letters or not, by its version.

    >>> ascii_bounds(r"\\\\b\\s") == r"\\\\b\\s"
    True
    """

    def bound(m: re.Match) -> str:
        if m[1] == "b" and re.match(r"[A-Za-z0-9_](?![?*{])", pattern[m.end() :]):
            return r"(?<!\w)"  # the same before a letter, and faster
        if m[1] == "b" and re.search(r"(?:^|[^\\])[A-Za-z0-9_]$", pattern[: m.start()]):
            return r"(?!\w)"
        return _ASCII.get(m[1], m[0])

    return re.sub(r"\\(.)", bound, pattern, flags=re.DOTALL)


def _is_space(name: str, value) -> bool:
    """White space, once or more often: one space in a text as ``plain`` gives it."""
    if name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        return value[0] >= 1 and len(value[2]) == 1 and (_is_space(str(value[2][0][0]), value[2][0][1]) or (str(value[2][0][0]), value[2][0][1]) == ("LITERAL", 32))
    return name == "IN" and [(str(k), str(v)) for k, v in value] == [("CATEGORY", "CATEGORY_SPACE")]


def _required(parsed) -> set[str] | None:
    """Literals of which a match holds one at least; of several such sets the one whose shortest literal is longest. None if there is no such set."""
    found: list[set[str]] = []
    run = ""

    def close() -> None:
        nonlocal run
        if run:
            found.append({plain(run)})
        run = ""

    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            run += lower(chr(value))
            continue
        if _is_space(name, value):
            run += " "
            continue
        close()
        if name == "SUBPATTERN":
            inner = _required(value[-1])
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            inner = _required(value[2]) if value[0] >= 1 else None
        elif name == "ATOMIC_GROUP":
            inner = _required(value)
        elif name == "BRANCH":
            each = [_required(x) for x in value[1]]
            inner = set().union(*each) if all(each) else None
        else:
            inner = None  # boundaries, classes, look-arounds
        if inner and len(inner) <= MOST_CHOICES:
            found.append(inner)
    close()
    return max(found, key=lambda s: min(map(len, s)), default=None)


def literals(pattern: str) -> set[str] | None:
    """Literals of which any text that a (Java) pattern matches, ignoring case, holds one at least, both as ``plain`` gives them; None if none can be told.

    >>> literals(r"\\bcold\\s+tea")
    {'cold tea'}
    >>> sorted(literals(r"\\\\b(rice|jasmine)\\\\s+5 ?kg"))
    ['jasmine', 'rice']
    """
    if UNLIKE.search(pattern):
        return None
    try:
        found = _required(regex_parser.parse(pattern))
    except (re.error, RecursionError, OverflowError):
        return None
    return found if found and min(map(len, found)) >= LEAST_LETTERS else None


def _candidates(batches: Iterator[pa.RecordBatch], words: dict[str, list[int]], always: list[int]) -> Iterator[pa.RecordBatch]:
    automaton = ahocorasick.Automaton()
    for word, rules in words.items():
        automaton.add_word(word, rules)
    if words:
        automaton.make_automaton()
    for batch in batches:
        out = []
        for text in batch.column(1).to_pylist():
            hit = set(always)
            if words and text:
                for _, rules in automaton.iter(plain(text)):
                    hit.update(rules)
            out.append(sorted(hit) if text is not None else [])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))], ["row", "text", "rules"])


def rule_hits(items: DataFrame, rules: DataFrame, row: str, name: str) -> DataFrame:
    """``row`` and the columns of ``rules`` (``rule, pattern, negative_pattern`` and more) for all rules that match: the pattern is found in the text, the negative one, if any, is not; both ignore case (A-Z).

    Rules meet texts that hold a literal which their pattern needs, by one automaton over all rules; then they are joined by number and tried.
    Rules without such a literal are tried on every text. More than ``MOST_RULES`` rules take several passes over the texts.
    """
    out = None
    numbered = rules.where("rule IS NOT NULL AND pattern IS NOT NULL")
    passes = max(1, -(-numbered.count() // MOST_RULES))
    for i in range(passes):
        part = numbered.where(F.pmod(F.xxhash64("rule"), F.lit(passes)) == i)
        words: dict[str, list[int]] = {}
        always: list[int] = []
        for r in part.select(F.col("rule").cast("long").alias("rule"), "pattern").collect():
            needed = literals(r["pattern"])
            for word in needed or ():
                words.setdefault(word, []).append(r["rule"])
            if not needed:
                always.append(r["rule"])
        texts = items.select(F.col(row).alias("row"), F.col(name).cast("string").alias("text"))
        form = f"row {texts.schema['row'].dataType.simpleString()}, text string, rules array<bigint>"
        met = texts.mapInArrow(partial(_candidates, words=words, always=always), form).select("row", "text", F.explode("rules").alias("rule"))
        tried = met.join(part.withColumn("rule", F.col("rule").cast("long")), "rule")
        hit = F.expr(f"text RLIKE concat('{FLAGS}', pattern) AND (negative_pattern IS NULL OR NOT text RLIKE concat('{FLAGS}', negative_pattern))")
        found = tried.where(hit).drop("text").withColumnRenamed("row", row)
        out = found if out is None else out.union(found)
    return out


def first_rule(items: DataFrame, rules: DataFrame, row: str, name: str) -> DataFrame:
    """``items`` with the ``label`` of the first rule by ``priority`` (of equal ones the first number) that matches; null without one. ``rules``: ``rule, pattern, negative_pattern, priority, label``."""
    best = rule_hits(items, rules, row, name).groupBy(row).agg(F.min_by("label", F.struct("priority", "rule")).alias("label"))
    return items.join(best, row, "left")
