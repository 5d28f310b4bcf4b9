"""Quality rules: gradient-boosted trees over document statistics, with monotonic constraints."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common as C
from docweave.session import read_table

#: Labelled rows of a task, and trees after which the sums of earlier trees are written.
TASK_ROWS, STEP = 200_000, 10
TREES, DEPTH, RATE, BINS, LEAF_ROWS = 60, 3, 0.15, 64, 20
#: Statistics used by the trees, and the sign in which quality may depend on them (0: free).
FEATURES = {"log_words": 0, "word_length": 0, "symbols": -1, "dup_lines": -1, "repeat_words": -1, "letters": 1, "upper": -1,
            "digits": -1, "distinct_words": 0, "line_words": 0, "non_ascii": 0}

_LUT = np.zeros((4, 256), bool)
_LUT[0, [ord(c) for c in "#*$%&|<>"]] = True
_LUT[1, 65:91] = _LUT[1, 97:123] = _LUT[1, 192:] = True
_LUT[2, 65:91] = True
_LUT[3, 48:58] = True


def _per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[off[1:]] - total[off[:-1]]


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    order = np.argsort(keys)
    s = keys[order]
    same = s[1:] == s[:-1]
    out = np.zeros(len(keys), bool)
    out[order] = np.concatenate((same, [False])) | np.concatenate(([False], same)) if len(keys) else False
    return out


def statistics(buf: np.ndarray, off: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Base counts of each text, and the trees' features (texts, features)."""
    n = len(off) - 1
    starts, ends, first = C.words(buf, off)
    n_words = np.diff(first)
    salt = C.mix64(np.arange(1, n + 1, dtype=np.uint64))
    owner = np.repeat(np.arange(n), n_words)
    points = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
    word_chars = np.bincount(owner, points[ends] - points[starts], n).astype(np.int64)
    counts = [_per_text(lut[buf], off) for lut in _LUT]
    h = C.word_hashes(buf, starts, ends)
    window, at = C.shingles(h, first, 3)
    whole = np.maximum(n_words - 2, 0)  # texts under three words have no window of three
    size = np.diff(at)
    keep = np.repeat(whole > 0, size)
    place = (np.repeat(first[:-1] - at[:-1], size) + np.arange(len(window)))[keep]
    hit = place[_repeats(window[keep] ^ salt[owner[place]])] if keep.any() else place
    covered = np.zeros(len(h) + 2, bool)
    for k in range(3):
        covered[hit + k] = True
    repeat_words = np.bincount(owner, covered[:len(h)], n).astype(np.int64)
    lines = np.union1d(off, np.flatnonzero(buf == 10) + 1) if len(buf) else np.zeros(1, np.int64)
    begin, stop = lines[:-1], lines[1:].copy()
    stop -= buf[stop - 1] == 10 if len(stop) else 0
    worded = np.diff(np.searchsorted(starts, lines)) > 0
    begin, stop = begin[worded], stop[worded]
    text = np.searchsorted(off, begin, side="right") - 1
    n_lines = np.bincount(text, minlength=n)
    line = C.word_hashes(buf, begin, stop) ^ salt[text]
    _, one = np.unique(line, return_index=True)
    n_dup_lines = n_lines - np.bincount(text[one], minlength=n)
    _, one = np.unique(h ^ salt[owner], return_index=True) if len(h) else (h, np.zeros(0, np.int64))
    distinct = np.bincount(owner[one], minlength=n)
    words, chars = np.maximum(n_words, 1), np.maximum(word_chars, 1)
    base = {"n_words": n_words, "word_chars": word_chars, "n_symbols": counts[0], "n_dup_lines": n_dup_lines, "n_repeat_words": repeat_words}
    x = np.stack([np.log1p(n_words), word_chars / words, counts[0] / words, n_dup_lines / np.maximum(n_lines, 1), repeat_words / words,
                  counts[1] / chars, counts[2] / chars, counts[3] / chars, distinct / words, n_words / np.maximum(n_lines, 1),
                  _per_text(buf >= 192, off) / chars], axis=1)
    return base, x


@dataclass
class Trees:
    """Nodes of all trees in flat arrays (heap order within a tree); a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    prior: float
    depth: int
    cut: float = 0.5

    def leaf(self, x: np.ndarray, root: int = 0) -> np.ndarray:
        """The leaf of each row in the tree of ``root``."""
        rows = np.arange(len(x))
        node = np.full(len(x), root)
        for _ in range(self.depth):
            node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return node

    def add(self, total: np.ndarray, x: np.ndarray) -> np.ndarray:
        """``total`` with the values of all trees for rows of features."""
        for root in self.roots:
            total = total + self.value[self.leaf(x, root)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality for rows of features."""
        return 1 / (1 + np.exp(-self.add(np.full(len(x), self.prior), x)))


#: Gradients are summed as multiples of 2**-SCALE, which is exact, so the trees don't depend on how rows are dealt.
SCALE, CHUNK = 36, 10_000


def _coded(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bins of features: the edges that each value is above."""
    return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1).astype(np.uint8)


def _sums(code: np.ndarray, y: np.ndarray, margin: np.ndarray, tree: Trees, fringe: list[int], bins: int) -> np.ndarray:
    """Gradients, their slopes and rows, by leaf of ``tree`` in ``fringe``, feature and bin."""
    p = 1 / (1 + np.exp(-margin))
    slot = np.full(len(tree.left), -1)
    slot[fringe] = np.arange(len(fringe))
    at = slot[tree.leaf(code)]
    code, at, g, h = code[at >= 0], at[at >= 0], (p - y)[at >= 0], (p * (1 - p))[at >= 0]
    parts = [np.rint(g * 2.0 ** SCALE), np.rint(h * 2.0 ** SCALE), None]
    size = len(fringe) * bins
    sums = [[np.bincount(at * bins + c, w, size).astype(np.int64).reshape(len(fringe), bins) for c in code.T] for w in parts]
    return np.array(sums).transpose(2, 1, 3, 0)


def _boost(edges: list[np.ndarray], signs: list[int], prior: float, trees: int, depth: int, rate: float, leaf_rows: int,
           sums: Callable[[Trees, list[int]], np.ndarray], grown: Callable[[Trees], None]) -> Trees:
    """Trees grown level by level: ``sums`` gives the sums of the leaves of a tree (see _sums) and ``grown`` takes each whole tree;
    the trees that both get split bins (see _coded), those returned split values."""
    nodes: list[list] = []
    roots = []

    def coded(first: int) -> Trees:
        own = [[f, k, left - first, right - first, v] for f, k, left, right, v in nodes[first:]]
        return Trees(*(np.array(c) for c in zip(*own)), np.zeros(1, np.int64), 0.0, depth)

    def leaf(weight: float) -> int:
        nodes.append([0, 0, len(nodes), len(nodes), rate * weight])
        return len(nodes) - 1

    for _ in range(trees):
        first = len(nodes)
        roots.append(leaf(0.0))
        fringe = [(first, -np.inf, np.inf)]
        for level in range(depth):
            found = sums(coded(first), [me - first for me, _, _ in fringe]) if fringe else ()
            level_fringe, fringe = fringe, []
            for (me, low, high), node in zip(level_fringe, found):
                g, h, n = (node[0, :, i].sum() for i in range(3))
                g, h = g / 2.0 ** SCALE, h / 2.0 ** SCALE
                if me == first:
                    nodes[me][4] = rate * float(np.clip(-g / (h + 1), low, high))
                if n < 2 * leaf_rows:
                    continue
                best = None
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    gl, hl, nl = np.cumsum(node[f, :len(e) + 1], axis=0)[:-1].T
                    gl, hl = gl / 2.0 ** SCALE, hl / 2.0 ** SCALE
                    gr, hr, nr = g - gl, h - hl, n - nl
                    wl, wr = np.clip(-gl / (hl + 1), low, high), np.clip(-gr / (hr + 1), low, high)
                    gain = gl ** 2 / (hl + 1) + gr ** 2 / (hr + 1) - g ** 2 / (h + 1)
                    gain[(nl < leaf_rows) | (nr < leaf_rows) | (signs[f] * (wr - wl) < 0)] = -1
                    k = int(gain.argmax())
                    if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                        best = (gain[k], f, k, wl[k], wr[k])
                if best is None:
                    continue
                _, f, k, wl, wr = best
                middle = (wl + wr) / 2
                bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[signs[f]]
                children = [leaf(float(np.clip(w, *b))) for w, b in zip((wl, wr), bounds)]
                nodes[me] = [f, k, *children, 0.0]
                fringe += [(c, *b) for c, b in zip(children, bounds)]
        grown(coded(first))
    columns = [np.array(c) for c in zip(*nodes)] if nodes else [np.zeros(1, np.int64), np.zeros(1), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1)]
    if nodes:
        columns[1] = np.array([edges[f][k] if left != i else 0.0 for i, (f, k, left, _, _) in enumerate(nodes)])
    return Trees(*columns, np.array(roots, np.int64), prior, depth)


def _prior(mean: float) -> float:
    p0 = min(max(mean, 1e-3), 1 - 1e-3)
    return float(np.log(p0 / (1 - p0)))


def fit(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = TREES, depth: int = DEPTH, rate: float = RATE,
        bins: int = BINS, leaf_rows: int = LEAF_ROWS) -> Trees:
    """Logistic gradient boosting on histograms. A split on a feature with a sign must order its children's values
    that way, and their middle bounds everything below, so the whole tree is monotone in it."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
    code, prior = _coded(x, edges), _prior(y.mean() if len(y) else 0.5)
    margin = np.full(len(x), prior)

    def sums(tree: Trees, fringe: list[int]) -> np.ndarray:
        return sum(_sums(code[i:i + CHUNK], y[i:i + CHUNK], margin[i:i + CHUNK], tree, fringe, bins) for i in range(0, len(x), CHUNK))

    def grown(tree: Trees) -> None:
        margin[:] = tree.add(margin, code)

    return _boost(edges, signs, prior, trees if len(np.unique(y)) > 1 else 0, depth, rate, leaf_rows, sums, grown)


_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _measure(batches):
    for part, buf, off in C.text_blocks(batches, "text"):
        base, x = statistics(buf, off)
        yield pa.RecordBatch.from_arrays(
            [part.column(0), *(pa.array(base[c].astype(np.int64)) for c in _BASE),
             pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]).cast(pa.list_(pa.float64()))], ["id", *_BASE, "x"])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, the base counts and the feature vector ``x`` of every whole text (null: no words)."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return base.mapInArrow(_measure, f"id {base.schema['id'].dataType.simpleString()}, {', '.join(c + ' long' for c in _BASE)}, x array<double>")


def _judge(trees: Trees):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(trees.score(_features(batch)), pa.float64())], [*batch.schema.names, "quality"])
    return run


def _ordinal(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of floats."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits >> C.U64(63), ~bits, bits | C.U64(1 << 63))


def _floats(ordinal: np.ndarray) -> np.ndarray:
    return np.where(ordinal >> C.U64(63), ordinal & C.U64((1 << 63) - 1), ~ordinal).view(np.float64)


def _quantiles(rows: DataFrame, values, sizes: list[int], q: np.ndarray) -> list[np.ndarray]:
    """Quantiles as np.quantile gives them, of each of the columns (of ``sizes`` rows) that ``values`` takes from a batch.

    The values beside each quantile are found byte by byte: a pass counts the next byte of values that begin like a wanted one.
    """
    virtual = [np.maximum(n - 1, 0) * q for n in sizes]
    rank = [np.stack([np.floor(v), np.minimum(np.floor(v) + 1, max(n - 1, 0))]).astype(np.int64) for v, n in zip(virtual, sizes)]
    begin = [np.zeros(r.shape, np.uint64) for r in rank]
    for step in range(8):
        wanted = [np.unique(b) for b in begin]
        counts = np.zeros((len(sizes), 2 * len(q), 256), np.int64)
        found = rows.mapInArrow(_byte_counts(values, wanted, step, 2 * len(q)), "at long, n long").groupBy("at").sum("n").toArrow()
        counts.reshape(-1)[found.column(0).to_numpy()] = found.column(1).to_numpy()
        for j, (r, b) in enumerate(zip(rank, begin)):
            ends = np.cumsum(counts[j], axis=1)
            which = np.searchsorted(wanted[j], b)
            byte = np.minimum((ends[which] <= r[..., None]).sum(axis=-1), 255)
            r -= np.where(byte > 0, ends[which, np.maximum(byte - 1, 0)], 0)
            begin[j] = (b << C.U64(8)) | byte.astype(np.uint64)
    out = []
    for b, v in zip(begin, virtual):
        (low, high), t = _floats(b), v - np.floor(v)
        out.append(np.where(t < 0.5, low + (high - low) * t, high - (high - low) * (1 - t)))
    return out


def _byte_counts(values, wanted: list[np.ndarray], step: int, slots: int):
    def run(batches):
        total = np.zeros((len(wanted), slots, 256), np.int64)
        for batch in batches:
            for j, (column, known) in enumerate(zip(values(batch), wanted)):
                bits = _ordinal(column)
                head = bits >> C.U64(64 - 8 * step) if step else np.zeros(len(bits), np.uint64)
                slot = np.minimum(np.searchsorted(known, head), len(known) - 1)
                hit = known[slot] == head
                byte = (bits[hit] >> C.U64(56 - 8 * step)) & C.U64(255)
                total[j] += np.bincount(slot[hit] * 256 + byte.astype(np.int64), minlength=slots * 256).reshape(slots, 256)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.reshape(-1)[at])], ["at", "n"])
    return run


def _features(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


_CODED = "code binary, y binary, margin binary"


def _chunk(batches):
    """Bins, labels and sums of trees of each row of _CODED."""
    for batch in batches:
        for code, y, margin in zip(*(batch.column(i).to_pylist() for i in range(3))):
            yield np.frombuffer(code, np.uint8).reshape(-1, len(FEATURES)), np.frombuffer(y), np.frombuffer(margin)


def _row(code: np.ndarray, y: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in (code, y, margin)], ["code", "y", "margin"])


def _code(edges: list[np.ndarray], prior: float):
    def run(batches):
        for batch in batches:
            x, y = _features(batch), batch.column(batch.schema.get_field_index("quality")).to_numpy(zero_copy_only=False).astype(float)
            for i in range(0, len(x), CHUNK):
                yield _row(_coded(x[i:i + CHUNK], edges), y[i:i + CHUNK], np.full(len(y[i:i + CHUNK]), prior))
    return run


def _add(trees: list[Trees]):
    def run(batches):
        for code, y, margin in _chunk(batches):
            for tree in trees:
                margin = tree.add(margin, code)
            yield _row(code, y, margin)
    return run


def _task_sums(trees: list[Trees], tree: Trees, fringe: list[int]):
    def run(batches):
        total = np.zeros((len(fringe), len(FEATURES), BINS, 3), np.int64)
        for code, y, margin in _chunk(batches):
            for t in trees:
                margin = t.add(margin, code)
            total += _sums(code, y, margin, tree, fringe, BINS)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])
    return run


def _good_scores(batch: pa.RecordBatch) -> list[np.ndarray]:
    scores = [1 / (1 + np.exp(-margin[y == 1])) for _, y, margin in _chunk([batch])]
    return [np.concatenate(scores) if scores else np.zeros(0)]


def learn(measured: DataFrame, labels: DataFrame) -> Trees:
    """Trees from all ``labels`` (``doc_id, quality`` 0 or 1; nulls are left out) of measured texts, fitted where the rows are: tasks sum
    gradients by bin, the driver gets a sum per task and level. The verdict's cut is 0.5, or less where that would
    turn away over one in a hundred of the good ones."""
    scratch = C.Scratch(measured.sparkSession, "trees")
    known = labels.filter("doc_id is not null and quality is not null").select(F.col("doc_id").alias("id"), "quality").distinct()
    rows = scratch.save(measured.select("id", "x").join(known, "id").select("x", "quality"), "rows")
    n, total, good, low, high = rows.agg(F.count("quality"), F.sum("quality"), F.count(F.when(F.col("quality") == 1, 1)),
                                         F.min("quality"), F.max("quality")).first()
    prior = _prior(total / n if n else 0.5)
    if not n or low == high:
        edges, coded = [np.zeros(0)] * len(FEATURES), None
    else:
        edges = [np.unique(e) for e in _quantiles(rows, lambda b: _features(b).T, [n] * len(FEATURES), np.linspace(0, 1, BINS + 1)[1:-1])]
        coded = scratch.save(rows.coalesce(-(-n // TASK_ROWS)).mapInArrow(_code(edges, prior), _CODED), "coded_0")
    fresh: list[Trees] = []
    at = 0

    def sums(tree: Trees, fringe: list[int]) -> np.ndarray:
        found = coded.mapInArrow(_task_sums(fresh, tree, fringe), "sums binary").collect()
        return sum(np.frombuffer(r.sums, np.int64) for r in found).reshape(len(fringe), len(FEATURES), BINS, 3)

    def grown(tree: Trees) -> None:
        nonlocal at, coded
        fresh.append(tree)
        at += 1
        if at % STEP == 0 or at == TREES:
            coded = scratch.save(coded.mapInArrow(_add(list(fresh)), _CODED), f"coded_{at}")
            fresh.clear()

    trees = _boost(edges, list(FEATURES.values()), prior, 0 if coded is None else TREES, DEPTH, RATE, LEAF_ROWS, sums, grown)
    if good and coded is not None:
        trees.cut = float(min(0.5, _quantiles(coded, _good_scores, [good], np.array([0.01]))[0][0]))
    scratch.clear()
    return trees


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics and verdict of every document.

    Returns one row per input row: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``
    (words ``[^\\x20\\x09-\\x0D]+``; see _measure), ``base_failed`` (under 50 words, or over half of the words in repeated windows
    of three), ``kept`` (not base_failed, and the trees' probability reaches the cut), ``quality``.
    Null and empty texts have no words and fail the base. Without labels of both kinds
    the trees have no say. Null ids and repeated rows return rows; other columns are ignored;
    an empty table gives no rows. The texts are read once: the small table of statistics is written for fitting and scoring.
    """
    scratch = C.Scratch(docs.sparkSession, "quality")
    measured = scratch.save(measure(docs, id_col, text_col), "measured")
    trees = learn(measured, labels)
    cut = trees.cut if len(trees.roots) else 0.0
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = measured.mapInArrow(_judge(trees), measured.schema.simpleString()[7:-1] + ",quality:double")
    return judged.select(F.col("id").alias("doc_id"), *_BASE, failed.alias("base_failed"), (~failed & (F.col("quality") >= cut)).alias("kept"), "quality")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
