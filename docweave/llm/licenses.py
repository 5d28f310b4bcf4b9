"""License scan: Aho-Corasick over tags and notice phrases, shunting-yard over expressions."""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common as C
from docweave.session import read_table, ship_package

#: Phrases and labels of the base scan.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notice phrases of the method itself.
NOTICES = {
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "boost",
    "isc license": "isc",
    "creative commons attribution": "cc-by",
    "free and unencumbered software": "unlicense",
    "all rights reserved": "proprietary",
}
#: Words of identifier tags; a licence expression follows on the same line.
TAGS = ("spdx license identifier", "license expression")
#: Identifiers (by start) whose terms are permissive; others count as restrictive.
PERMISSIVE = ("mit", "apache", "bsd", "isc", "boost", "bsl-", "unlicense", "cc0", "cc-by-", "0bsd", "zlib", "python", "psf")

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORDS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in _LOWER)
_TOKEN = re.compile(r"\(|\)|[a-z0-9][a-z0-9.+:-]*")
_RANK = {"or": 1, "and": 2, "with": 3}


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for phrase, label in NOTICES.items():
        a.add_word(f" {phrase} ", (phrase, label, False))
    for phrase, label in BASE.items():
        a.add_word(f" {phrase} ", (phrase, label, True))
    for phrase in TAGS:
        a.add_word(f" {phrase} ", (phrase, None, False))
    a.make_automaton()
    return a


def postfix(expression: str) -> list[str] | None:
    """Shunting-yard: postfix of a licence expression (operators or < and < with, parentheses);
    None if it is not one as a whole."""
    out: list[str] = []
    stack: list[str] = []
    operand = False
    for t in _TOKEN.findall(expression):
        if t in _RANK:
            if not operand:
                return None
            while stack and stack[-1] != "(" and _RANK[stack[-1]] >= _RANK[t]:
                out.append(stack.pop())
            stack.append(t)
            operand = False
        elif t == "(":
            if operand:
                return None
            stack.append(t)
        elif t == ")":
            if not operand:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        else:
            if operand:
                return None
            out.append(t)
            operand = True
    if not operand or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(steps: list[str]) -> tuple[set[str], bool] | None:
    """Identifiers of a postfix expression, and whether its terms are permissive: ``or`` takes either side,
    ``and`` needs both, ``with`` keeps the licence's own terms. None if ``with`` has no plain identifiers."""
    stack: list[tuple[set[str], bool, bool]] = []
    for s in steps:
        if s not in _RANK:
            stack.append(({s}, s.startswith(PERMISSIVE), True))
            continue
        (b, pb, plain_b), (a, pa_, plain_a) = stack.pop(), stack.pop()
        if s == "with":
            if not (plain_a and plain_b):
                return None
            stack.append((a, pa_, False))
        else:
            # the smaller set goes into the larger: linear in all
            a, b = (a, b) if len(a) >= len(b) else (b, a)
            a |= b
            stack.append((a, pa_ or pb if s == "or" else pa_ and pb, False))
    return stack[0][:2]


def leading_expression(line: str) -> str | None:
    """The longest part from a line's start that is a licence expression, in one shunting-yard pass.

    The last place at which all parentheses were closed and an operand had ended is kept. A token that can't follow, or a ``with``
    whose sides aren't plain identifiers, can't be mended by what comes later, so it ends the pass.
    """
    tokens, best, operand = [], 0, False
    # of each open parenthesis: operands so far, whether the last is a plain identifier, whether a ``with`` waits for its right side
    frames = [[0, False, False]]
    for m in _TOKEN.finditer(line):
        t = m[0]
        if t in _RANK:
            if not operand or (t == "with" and not frames[-1][1]):
                break
            operand, frames[-1][2] = False, t == "with"
        elif t == "(":
            if operand:
                break
            frames.append([0, False, False])
        else:
            if t == ")":
                if not operand or len(frames) == 1:
                    break
                inner = frames.pop()
                plain = inner[0] == 1 and inner[1]
            elif operand:
                break
            else:
                plain = True
            top = frames[-1]
            if top[2] and not plain:
                break
            top[:] = [top[0] + 1, plain and not top[2], False]
            operand = True
        tokens.append(t)
        if operand and len(frames) == 1:
            best = len(tokens)
    return " ".join(tokens[:best]) if best else None


_TAG_LINE = re.compile("(?:spdx|license)[^a-z0-9\n]+(?:license[^a-z0-9\n]+identifier|expression)[^a-z0-9(\n]*([^\n]*)")


def scan_text(text: str | None) -> dict:
    """The licence evidence of one text; see licenses()."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    found = raw.translate(_WORDS).split()
    line = " " + b" ".join(found).decode("latin-1") + " "
    starts, labels, base, notices, tagged = [], set(), set(), 0, False
    for end, (phrase, label, is_base) in automaton().iter(line):
        if label is None:
            tagged = True
            continue
        labels.add(label)
        if is_base:
            base.add(label)
            starts.append(end - len(phrase) - 1)
        else:
            notices += 1
    # words before each hit: blanks counted from one to the next
    places, at, n = [], 0, 0
    for x in sorted(starts):
        n += line.count(" ", at, x)
        at = x
        places.append(n)
    expressions, permissive = [], None
    if tagged:
        for m in _TAG_LINE.finditer(raw.translate(_LOWER).decode("utf-8", "surrogatepass")):
            part = leading_expression(m[1])
            if part:
                ids, ok = evaluate(postfix(part))
                expressions.append(part)
                labels |= ids
                permissive = ok if permissive is None else permissive and ok
    evidence = len(places) + notices
    return {"n_words": len(found), "n_base": len(places), "first_word": min(places, default=None), "last_word": max(places, default=None),
            "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)),
            "score": 1.0 if expressions else 1.0 - 0.5 ** evidence, "expressions": expressions, "permissive": permissive}


_SCHEMA = pa.schema([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                     ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                     ("expressions", pa.list_(pa.string())), ("permissive", pa.bool_())])


def _scan(batches):
    for part, _, _ in C.text_blocks(batches, "text"):
        rows = [scan_text(t) for t in part.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([r[f.name] for r in rows], f.type) for f in _SCHEMA)],
                                         ["doc_id", *_SCHEMA.names])


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence evidence of every whole text.

    Words are runs of digits, letters (A-Z in lower case) and non-ASCII characters. Returns one row per
    input row: ``doc_id, n_words, n_base`` (places of the base phrases), ``first_word, last_word``
    (their smallest and largest start; else null), ``base_labels, labels`` (distinct, sorted, comma-joined; ``labels`` adds
    notice phrases and the identifiers of tagged expressions), ``score`` (1 with a valid
    expression, else 1 - 0.5 ** places; 0 without any), ``expressions``, ``permissive``
    (all expressions' terms allow it; null without one). A tag counts with the longest
    expression at the start of its line's rest; a tag without one adds nothing.

    Null and empty texts have no words; null ids and repeated rows stay; other columns are
    ignored; an empty table gives no rows. Nothing is shuffled.
    """
    ship_package(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return base.mapInArrow(_scan, f"doc_id {base.schema['id'].dataType.simpleString()}, n_words long, n_base long, first_word long, "
                                  "last_word long, base_labels string, labels string, score double, expressions array<string>, permissive boolean")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(read_table(spark, sf_dir, "documents"))
