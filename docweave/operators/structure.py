"""Structure of documents as block sequences, and how two of them differ (QA-1)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.session import ship_package

# One character per block, in a text free of these characters while blocks are marked.
_MARK = "\ue000-\ue0ff"
#: Block codes and the lines that make them, in the order in which they are tried. Runs of ``p`` and ``t`` lines are one block.
BLOCKS = (
    ("f", r"(?ms)^[ \t]*```[^\n]*(?:\n.*?^[ \t]*```[^\n]*$|(?:\n.*)?\z)"),  # a fenced block, closed or not
    ("1", r"(?m)^#[ \t][^\n]*$"), ("2", r"(?m)^##[ \t][^\n]*$"), ("3", r"(?m)^###[ \t][^\n]*$"),
    ("4", r"(?m)^####[ \t][^\n]*$"), ("5", r"(?m)^#####[ \t][^\n]*$"), ("6", r"(?m)^######[ \t][^\n]*$"),
    ("t", r"(?m)^[ \t]*\|[^\n]*$"),
    ("l", r"(?m)^[ \t]*(?:[-*+]|[0-9]{1,9}[.)])[ \t][^\n]*$"),
    ("i", r"(?m)^import [^\n]*$"),
    ("a", r"(?m)^:::[^\n]*$"),
    ("x", r"(?m)^[ \t]*</?[A-Za-z][^\n]*$"),
    ("b", r"(?m)^[ \t]+$"),
    ("p", rf"(?m)^[^{_MARK}\n][^\n]*$"),
)
MARKS = "".join(chr(0xE000 + k) for k in range(len(BLOCKS)))
CODES = "".join(c for c, _ in BLOCKS)


def block_codes(text: Column | str) -> Column:
    """The block sequence of a markdown text (newlines ``\\n``), one character each: fences ``f``, headers ``1`` to ``6``, tables
    ``t``, list items ``l``, imports ``i``, admonition lines ``a``, tag lines ``x``, paragraphs ``p``. Blank lines only part blocks."""
    t = F.regexp_replace(F.col(text) if isinstance(text, str) else text, f"[{_MARK}]", "")
    for mark, (_, pattern) in zip(MARKS, BLOCKS):
        t = F.regexp_replace(t, "(?d)" + pattern, mark)
    t = F.regexp_replace(F.translate(t, MARKS, CODES), "((?<=p)\np)+|((?<=t)\nt)+", "")
    return F.regexp_replace(t, "[\nb]", "")


def codes_sql(x: str) -> str:
    """:func:`block_codes` in DuckDB."""
    t = f"regexp_replace({x}, '[{_MARK}]', '', 'g')"
    for mark, (_, pattern) in zip(MARKS, BLOCKS):
        t = f"regexp_replace({t}, '{pattern}', '{mark}', 'g')"
    t = f"translate({t}, '{MARKS}', '{CODES}')"
    return f"regexp_replace(regexp_replace(regexp_replace({t}, 'p(\\np)+', 'p', 'g'), 't(\\nt)+', 't', 'g'), '[\\nb]', '', 'g')"


def first_difference(a: Column, b: Column) -> Column:
    """Place (from 0) of the first character in which two strings differ, null if they are equal."""
    unlike = F.array_position(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y), False)
    return F.when(a == b, F.lit(None)).when(unlike > 0, unlike - 1).otherwise(F.least(F.length(a), F.length(b))).cast("bigint")


def structure_diff(pairs: DataFrame, original: str = "original", translated: str = "translated") -> DataFrame:
    """QA-1: how the block sequences of two texts differ.

    Adds ``n_src, n_out`` (blocks), ``first_diff`` (the first block that differs, from 0; null if none does), ``src_block,
    out_block`` (its codes, null past an end) and ``n_edits`` (least blocks put in, left out or changed). JVM only; the edits are
    counted from the first difference on.
    """
    rest = [c for c in pairs.columns if c not in (original, translated)]
    coded = pairs.select(*rest, block_codes(original).alias("_a"), block_codes(translated).alias("_b"))
    coded = coded.withColumn("first_diff", first_difference(F.col("_a"), F.col("_b")))
    at = F.col("first_diff").cast("int") + 1
    tail = lambda c: F.substring(c, at, F.length(c))
    code = lambda c: F.when(at <= F.length(c), F.substring(c, at, F.lit(1)))
    edits = F.when(F.col("first_diff").isNull(), 0).otherwise(F.levenshtein(tail(F.col("_a")), tail(F.col("_b"))))
    return coded.select(*rest, F.length("_a").cast("bigint").alias("n_src"), F.length("_b").cast("bigint").alias("n_out"), "first_diff",
                        code(F.col("_a")).alias("src_block"), code(F.col("_b")).alias("out_block"), edits.cast("bigint").alias("n_edits"))


def _snake(a: str, b: str) -> tuple[int, int, int, int, int]:
    """A middle snake of a shortest edit script: edits in all, and the snake's ends (x, y, u, v)."""
    n, m = len(a), len(b)
    delta, odd = n - m, (n - m) % 2
    forward, backward = {1: 0}, {1: 0}
    for d in range((n + m + 1) // 2 + 1):
        for k in range(-d, d + 1, 2):
            x = forward[k + 1] if k == -d or (k != d and forward[k - 1] < forward[k + 1]) else forward[k - 1] + 1
            y, x0 = x - k, x
            while x < n and y < m and a[x] == b[y]:
                x, y = x + 1, y + 1
            forward[k] = x
            if odd and -(d - 1) <= delta - k <= d - 1 and x + backward.get(delta - k, 0) >= n:
                return 2 * d - 1, x0, x0 - k, x, y
        for k in range(-d, d + 1, 2):
            x = backward[k + 1] if k == -d or (k != d and backward[k - 1] < backward[k + 1]) else backward[k - 1] + 1
            y, x0 = x - k, x
            while x < n and y < m and a[n - x - 1] == b[m - y - 1]:
                x, y = x + 1, y + 1
            backward[k] = x
            if not odd and -d <= delta - k <= d and x + forward.get(delta - k, 0) >= n:
                return 2 * d, n - x, m - y, n - x0, m - (x0 - k)
    raise AssertionError("no snake")


def edit_script(a: str, b: str) -> Iterator[tuple[str, str]]:
    """A shortest script of insertions (``+``) and deletions (``-``) from ``a`` to ``b``, with what stays (``=``): linear memory,
    time by the number of edits."""
    todo: list[tuple[str, str] | None] = [(a, b)]
    while todo:
        a, b = todo.pop()
        start = 0
        while start < min(len(a), len(b)) and a[start] == b[start]:
            start += 1
        if start:
            yield "=", a[:start]
            a, b = a[start:], b[start:]
        if not a or not b:
            if a:
                yield "-", a
            if b:
                yield "+", b
            continue
        d, x, y, u, v = _snake(a, b)
        if d <= 1:
            # one block more on one side, somewhere before a common end
            if len(a) > len(b):
                yield "-", a[0]
                todo.append((a[1:], b))
            else:
                yield "+", b[0]
                todo.append((a, b[1:]))
        else:
            todo += [(a[u:], b[v:]), (a[x:u], b[y:v]), (a[:x], b[:y])]


def script_text(a: str, b: str) -> str:
    """A script as words: ``=12`` blocks that stay, ``-1`` a level-1 header left out, ``+pp`` two paragraphs put in."""
    merged: list[list[str]] = []
    for op, blocks in edit_script(a, b):
        if merged and merged[-1][0] == op:
            merged[-1][1] += blocks
        else:
            merged.append([op, blocks])
    return " ".join(op + (str(len(blocks)) if op == "=" else blocks) for op, blocks in merged)


def _scripts(n: int, names: list[str]):
    def run(batches):
        for batch in batches:
            made = [script_text(a, b) for a, b in zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(made, pa.string())], names)
    return run


def structure_scripts(pairs: DataFrame, original: str = "original", translated: str = "translated") -> DataFrame:
    """QA-1: the edit script (:func:`script_text`) of each pair whose block sequences differ; a null text has no blocks."""
    ship_package(pairs.sparkSession)
    rest = [c for c in pairs.columns if c not in (original, translated)]
    coded = pairs.select(*rest, *(F.coalesce(block_codes(c), F.lit("")).alias(n) for c, n in ((original, "_a"), (translated, "_b")))).where("_a <> _b")
    schema = T.StructType([*(coded.schema[c] for c in rest), T.StructField("script", T.StringType())])
    return coded.mapInArrow(_scripts(len(rest), [*rest, "script"]), schema)
