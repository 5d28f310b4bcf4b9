"""Scalar text rules as Column expressions (JVM-side, no Python per row).

Python's ``str.strip``/``\\s`` use Unicode whitespace while Java's ``\\s`` is
ASCII, so every rule uses one explicit class that both Java regex and RE2
understand.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts.
WS = (r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")

STRIP_RE = rf"\A{WS}+|{WS}+\z"
BLANK_RE = rf"\A{WS}*\z"

# The LOCAL TEXT block markers (lazy, across lines, any case).
LOCAL_TEXT_RE = (rf"(?is)\{{{WS}*/\*{WS}*LOCAL TEXT START{WS}*\*/{WS}*\}}.*?"
                 rf"\{{{WS}*/\*{WS}*LOCAL TEXT END{WS}*\*/{WS}*\}}")

# Reply prefixes dropped from a model answer (lower-cased test).
REPLY_PREFIXES = ("translation:", "перевод:", "translated text:", "переведенный текст:")

FENCE = "```"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable.

    A Column referenced inside a higher-order function's lambda is inlined
    and re-evaluated for every element; binding it first avoids that.
    """
    return F.transform(F.array(value), body)[0]


# The same characters as one string (for ``btrim``).
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
            + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")


def strip(c) -> Column:
    """Python ``str.strip()`` (Unicode whitespace both ends): ``btrim`` with
    the whitespace set, which only scans the two ends (a regex alternative
    anchored at the end is tried at every blank of a long text)."""
    return F.btrim(col_(c), F.lit(WS_CHARS))


def is_blank(c) -> Column:
    return col_(c).rlike(BLANK_RE)


def normalize_newlines(c) -> Column:
    """Text-mode read: CRLF and lone CR become LF (PRJ-1)."""
    return F.regexp_replace(col_(c), "\r\n?", "\n")


def remove_local_text(c) -> Column:
    """Drop ``{/* LOCAL TEXT START */} … {/* LOCAL TEXT END */}`` blocks (PRJ-2)."""
    return F.regexp_replace(col_(c), LOCAL_TEXT_RE, "")


def frontmatter_end(c) -> Column:
    """1-based position of the closing ``---`` (searched from offset 3), 0 if none."""
    t = col_(c)
    return F.when(t.startswith("---"), F.locate("---", t, 4)).otherwise(F.lit(0))


def frontmatter_parts(c):
    """Return (has_fm, frontmatter, body) Columns for PRJ-3."""
    t = col_(c)
    end = frontmatter_end(t)
    has = end > 0
    fm = F.when(has, t.substr(F.lit(1), end + 2))
    body = F.when(has, strip(t.substr(end + 3, F.lit(1 << 30)))).otherwise(t)
    return has, fm, body


def restore_frontmatter(fm, text) -> Column:
    """``fm + "\\n\\n" + text`` when there is a non-empty block (PRJ-4)."""
    fm, text = col_(fm), col_(text)
    return F.when(fm.isNotNull() & (fm != ""), F.concat(fm, F.lit("\n\n"), text)).otherwise(text)


def n_chars(c) -> Column:
    """Length in code points, as bigint."""
    return F.length(col_(c)).cast("bigint")


def est_tokens(c) -> Column:
    """Token estimate ``len/4`` (PRJ-8)."""
    return F.length(col_(c)).cast("double") / F.lit(4.0)


def clean_reply(c) -> Column:
    """Model reply clean-up (RSP-1).

    1. a reply starting (case-insensitively) with a known prefix loses
       everything up to its first ``:`` and is stripped;
    2. an opening fence line at the very start is removed;
    3. a closing fence at the very end (optionally followed by one newline)
       is removed.
    """
    t = col_(c)
    low = F.lower(t)
    has_prefix = F.lit(False)
    for p in REPLY_PREFIXES:
        has_prefix = has_prefix | low.startswith(p)
    t = F.when(has_prefix, strip(F.regexp_replace(t, r"(?s)\A[^:]*:", ""))).otherwise(t)
    t = F.regexp_replace(t, r"(?d)\A```.*\n", "")
    t = F.regexp_replace(t, r"\n```(?=\n?\z)", "")
    return t
