"""Benchmark decontamination by the q-gram lemma and banded alignment."""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common as C
from docweave.session import read_table, ship_package

#: Characters per gram; edits per hundred characters of an item; characters of benchmark items held by a task at a time.
Q, EDIT_PERCENT, SLICE_CHARS = 12, 6, 8_000_000
#: Postings that a task expands at a time (a hit with more makes a chunk of its own).
POSTINGS = 1_000_000
#: Pairs of places in which a text and an item meet beyond which their shared grams aren't counted.
CROWDED = 1 << 16
_TABLE_BITS = 22


def normal(points: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points with A-Z in lower case and white space runs ([\\x20\\x09-\\x0D]) as one blank, none
    at a text's ends: (points, offsets, index of each in the input)."""
    low = np.where((points >= 65) & (points <= 90), points + 32, points).astype(np.uint32)
    space = (low == 32) | ((low >= 9) & (low <= 13))
    low[space] = 32
    first = np.zeros(len(low) + 1, bool)
    first[off] = True
    keep = ~space
    # a blank stays where a word comes before it in its text
    keep[1:] |= space[1:] & ~space[:-1] & ~first[1:-1]
    at = np.flatnonzero(keep)
    low, bounds = low[at], np.searchsorted(at, off)
    ends = bounds[1:][bounds[1:] > bounds[:-1]] - 1
    tail = ends[low[ends] == 32]
    if len(tail):
        stay = np.ones(len(low), bool)
        stay[tail] = False
        bounds = np.concatenate(([0], np.cumsum(stay)))[bounds]
        low, at = low[stay], at[stay]
    return low, bounds, at


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    texts = [t or "" for t in texts]
    data = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return data, np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)


def gram_hashes(points: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q-gram at every position that has one."""
    if len(points) < q:
        return np.zeros(0, np.uint64)
    h, width = C.mix64(points.astype(np.uint64) + C.U64(1)), 1
    while width < q:
        step = min(width, q - width)
        h = h[:-step] * C.U64(pow(C._BASE, step, 1 << 64)) + h[step:]
        width += step
    return C.mix64(h)


class Items:
    """Benchmark items as arrays: normalised points, edit budgets, q-gram thresholds and postings.

    An item of m points may have k = min(m * percent / 100, (m - q) / q) edits; a region within k
    edits shares at least m - q + 1 - k * q >= 1 of its q-grams (q-gram lemma).
    """

    def __init__(self, texts: list[str | None], q: int, percent: int):
        self.q = q
        self.points, self.off, _ = normal(*code_points(texts))
        m = np.diff(self.off)
        #: items without a q-gram, which are looked for as they are
        self.short = {as_text(self.points[a:b]): i for i, (a, b) in enumerate(zip(self.off[:-1], self.off[1:])) if 0 < b - a < q}
        self.m = m
        self.k = np.maximum(np.minimum(m * percent // 100, (m - q) // q), 0)
        self.need = m - q + 1 - self.k * q
        pos = np.arange(max(len(self.points) - q + 1, 0))
        item = np.searchsorted(self.off, pos, side="right") - 1
        ok = pos + q <= self.off[item + 1] if len(pos) else np.zeros(0, bool)
        h, item, pos = gram_hashes(self.points, q)[ok], item[ok], (pos - self.off[item])[ok] if len(pos) else pos
        order = np.argsort(h, kind="stable")
        self.item, self.pos = item[order].astype(np.int64), pos[order].astype(np.int64)
        self.grams, self.first, self.count = np.unique(h[order], return_index=True, return_counts=True)
        # how often each gram stands in each of its items
        code = np.repeat(np.arange(len(self.grams)), self.count) * max(len(m), 1) + self.item
        pair, self.times = np.unique(code, return_counts=True)
        self.of_item = pair % max(len(m), 1)
        self.of_first = np.searchsorted(pair, np.arange(len(self.grams) + 1) * max(len(m), 1))
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self.grams >> C.U64(64 - _TABLE_BITS)] = True

    def candidates(self, points: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, first diagonal of the band) with enough shared q-grams. Bands of 2(k+1)
        diagonals overlap by half, so the k+1 diagonals of an alignment lie in one of them.

        Where a text and an item meet in more than CROWDED pairs of places (both repeat themselves), nothing is counted: all
        their bands are candidates.
        """
        none = np.zeros(0, np.int64)
        h = gram_hashes(points, self.q)
        at = np.flatnonzero(self.table[h >> C.U64(64 - _TABLE_BITS)])
        if not len(at) or not len(self.grams):
            return none, none, none
        g = np.minimum(np.searchsorted(self.grams, h[at]), len(self.grams) - 1)
        text = np.searchsorted(off, at, side="right") - 1
        ok = (self.grams[g] == h[at]) & (at + self.q <= off[text + 1])
        at, g, text = at[ok], g[ok], text[ok]
        crowded = self._crowded(g, text)
        found = []
        for t in np.unique(crowded[0]).tolist():
            busy = crowded[1][crowded[0] == t]
            mine = text == t
            kept = ~np.isin(self.item, busy)
            found.append(self._counted(at[mine] - off[t], g[mine], text[mine], kept))
            for i in busy.tolist():
                k, n = int(self.k[i]), int(off[t + 1] - off[t])
                low = np.arange(-(k + 1), max(n - int(self.m[i]), 0) + k + 2, k + 1)
                found.append((np.full(len(low), t), np.full(len(low), i), low))
        rest = ~np.isin(text, crowded[0])
        found.append(self._counted(at[rest] - off[text[rest]], g[rest], text[rest], None))
        text, item, low = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((low, item, text))
        return text[order], item[order], low[order]

    def _crowded(self, g: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, item) that meet in more than CROWDED pairs of places."""
        code, hits = np.unique(text * max(len(self.grams), 1) + g, return_counts=True)
        t, g = code // max(len(self.grams), 1), code % max(len(self.grams), 1)
        n = self.of_first[g + 1] - self.of_first[g]
        some = hits * self.count[g] > CROWDED // 64  # grams that meet in few places are counted anyway
        t, g, hits, n = t[some], g[some], hits[some], n[some]
        at = np.repeat(self.of_first[g] - np.cumsum(n) + n, n) + np.arange(n.sum())
        pair = np.repeat(t, n) * len(self.m) + self.of_item[at]
        pair, which = np.unique(pair, return_inverse=True)
        load = np.bincount(which, np.repeat(hits, n) * self.times[at], len(pair))
        pair = pair[load > CROWDED]
        return pair // len(self.m), pair % len(self.m)

    def _counted(self, at: np.ndarray, g: np.ndarray, text: np.ndarray, kept: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Candidates by counting, from hits at places ``at`` of their texts and the postings that are ``kept`` (all by default)."""
        none = np.zeros(0, np.int64)
        if kept is None:
            item, pos, first, count = self.item, self.pos, self.first, self.count
        else:
            upto = np.concatenate(([0], np.cumsum(kept)))
            item, pos, first, count = self.item[kept], self.pos[kept], upto[self.first], upto[self.first + self.count] - upto[self.first]
        # hits in chunks of a bounded sum of postings; what bands share adds up over chunks
        load = np.concatenate(([0], np.cumsum(count[g])))
        keys, shared, a = [], [], 0
        while a < len(at):
            b = max(a + 1, int(np.searchsorted(load, load[a] + POSTINGS, side="right")) - 1)
            if load[b] > load[a]:
                n = count[g[a:b]]
                post = np.repeat(first[g[a:b]] - np.cumsum(n) + n, n) + np.arange(n.sum())
                k, n = self._bands(np.repeat(at[a:b], n), np.repeat(text[a:b], n), item[post], pos[post])
                keys.append(k)
                shared.append(n)
            a = b
        if not keys:
            return none, none, none
        key, n = np.concatenate(keys, axis=1), np.concatenate(shared)
        if len(keys) > 1:
            order = np.lexsort(key[::-1])
            key, n = key[:, order], n[order]
            heads = np.flatnonzero(np.concatenate(([True], (key[:, 1:] != key[:, :-1]).any(axis=0))))
            key, n = key[:, heads], np.add.reduceat(n, heads)
        text, item, band = key[:, n >= self.need[key[1]]]
        return text, item, band * (self.k[item] + 1)

    def _bands(self, at: np.ndarray, text: np.ndarray, item: np.ndarray, ipos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, item, band) of the bands that pairs of places meet, and how many places of the item each shares."""
        band = (at - ipos) // (self.k[item] + 1)
        text, item, ipos = (np.concatenate((x, x)) for x in (text, item, ipos))
        band = np.concatenate((band, band - 1))
        order = np.lexsort((ipos, band, item, text))
        text, item, band, ipos = text[order], item[order], band[order], ipos[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
        fresh = new.copy()
        fresh[1:] |= ipos[1:] != ipos[:-1]
        heads = np.flatnonzero(new)
        return np.stack((text[heads], item[heads], band[heads])), np.add.reduceat(fresh.astype(np.int64), heads)


def as_text(points: np.ndarray) -> str:
    return points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def occurrences(text: str, item: str) -> np.ndarray:
    """Starts of an item's occurrences in a text, from the left, none overlapping the one before."""
    found, at = [], text.find(item)
    while at >= 0:
        found.append(at)
        at = text.find(item, at + len(item))
    return np.array(found, np.int64)


_FAR = 1 << 20


def banded(pattern: np.ndarray, size: np.ndarray, window: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Edit distances after the whole pattern, for many pairs at once: (pairs, diagonals).

    ``pattern`` (pairs, longest) padded; ``window`` (pairs, longest + diagonals) so that pattern
    character i meets window character i + d on diagonal d; ``start`` (pairs, diagonals): cost of beginning there.
    """
    width = start.shape[1]
    ramp = np.arange(width)
    row, out = start.astype(np.int64), start.astype(np.int64).copy()
    for i in range(pattern.shape[1]):
        best = row + (pattern[:, i, None] != window[:, i:i + width])
        best[:, :-1] = np.minimum(best[:, :-1], row[:, 1:] + 1)
        row = np.minimum.accumulate(best - ramp, axis=1) + ramp
        out = np.where((size == i + 1)[:, None], row, out)
    return out


def _rows(parts: list[np.ndarray], width: int, fill: int) -> np.ndarray:
    out = np.full((len(parts), width), fill, np.uint32)
    for r, p in zip(out, parts):
        r[:len(p)] = p[:width]
    return out


def align(items: Items, points: np.ndarray, off: np.ndarray, text: np.ndarray, item: np.ndarray,
          low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edits of each candidate's item within its band, and the region (start, end) in the text."""
    k, m = items.k[item], items.m[item]
    low = low - k
    width = int((4 * k + 3).max())
    long = int(m.max())
    pats = [items.points[items.off[i]:items.off[i + 1]] for i in item]
    wins = []
    for t, a in zip(text, low):
        body = points[max(off[t], off[t] + a):min(off[t + 1], off[t] + a + long + width)]
        wins.append(np.concatenate((np.full(max(0, -a), 0xFFFFFFFE, np.uint32), body)) if a < 0 else body)
    n = off[text + 1] - off[text]
    last = banded(_rows(pats, long, 0xFFFFFFFF), m, _rows(wins, long + width, 0xFFFFFFFE), np.zeros((len(item), width)))
    stop = low[:, None] + np.arange(width) + m[:, None]
    last = np.where((stop >= 0) & (stop <= n[:, None]), last, _FAR)
    edits, end = last.min(axis=1), stop[np.arange(len(item)), last.argmin(axis=1)]
    # the same alignment from its end: diagonal width // 2 of the reversed pair starts there
    half = width // 2
    back = [np.concatenate((np.full(half, 0xFFFFFFFE, np.uint32), points[max(off[t], off[t] + e - long - width):off[t] + e][::-1]))
            for t, e in zip(text, end)]
    begin = np.broadcast_to(np.where(np.arange(width) >= half, np.arange(width) - half, _FAR), (len(item), width))
    first = banded(_rows([p[::-1] for p in pats], long, 0xFFFFFFFF), m, _rows(back, long + width, 0xFFFFFFFE), begin)
    used = m[:, None] + np.arange(width) - half
    first = np.where((used <= end[:, None]) & (used >= 0), first, _FAR)
    return edits, end - used[np.arange(len(item)), first.argmin(axis=1)], end


def short_hits(items: Items, text: str) -> list[tuple[int, int]]:
    """(item, start) of the occurrences of items without a q-gram; those of one item don't overlap."""
    if not hasattr(items, "automaton"):
        import ahocorasick
        items.automaton = ahocorasick.Automaton()
        for w, i in items.short.items():
            items.automaton.add_word(w, (i, len(w)))
        items.automaton.make_automaton()
    out, past = [], {}
    for end, (i, n) in items.automaton.iter(text):
        if end + 1 - n >= past.get(i, 0):
            out.append((i, end + 1 - n))
            past[i] = end + 1
    return out


def _scan(shared, block: int):
    def run(batches):
        items, ids = shared.value
        for part, _, _ in C.text_blocks(batches, "text", block):
            points, off, at = normal(*code_points(part.column(1).to_pylist()))
            text, item, low = items.candidates(points, off)
            found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
            if items.short:
                for t in range(part.num_rows):
                    for i, a in short_hits(items, as_text(points[off[t]:off[t + 1]])):
                        found.setdefault((t, i), []).append((0, a, a + int(items.m[i])))
            left = []
            pairs = np.flatnonzero(np.concatenate(([True], (np.diff(text) != 0) | (np.diff(item) != 0)))) if len(text) else []
            for a, b in zip(pairs, [*pairs[1:], len(text)]):
                t, i = int(text[a]), int(item[a])
                m, k = int(items.m[i]), int(items.k[i])
                whole = occurrences(as_text(points[off[t]:off[t + 1]]), as_text(items.points[items.off[i]:items.off[i + 1]]))
                bands = np.arange(a, b)
                if len(whole):
                    found.setdefault((t, i), []).extend((0, int(x), int(x) + m) for x in whole)
                    # all that a band may hold overlaps an occurrence that begins near it, and no alignment is better than that
                    first, last = low[a:b] - k, low[a:b] + 3 * k + 2
                    near = np.searchsorted(whole, last - (m - k), side="right")
                    over = (near < len(whole)) & (whole[np.minimum(near, len(whole) - 1)] < first + (m - k))
                    bands = bands[~over]
                left.append(bands)
            left = np.concatenate(left) if left else np.zeros(0, np.int64)
            text, item, low = text[left], item[left], low[left]
            for c in range(0, len(text), 64):
                t, i = text[c:c + 64], item[c:c + 64]
                edits, start, end = align(items, points, off, t, i, low[c:c + 64])
                for x in np.flatnonzero(edits <= items.k[i]):
                    found.setdefault((int(t[x]), int(i[x])), []).append((int(edits[x]), int(start[x]), int(end[x])))
            raw = np.searchsorted(at, np.arange(0)) if not found else None
            rows = []
            base = np.cumsum([0, *[len(x or "") for x in part.column(1).to_pylist()]]) if found else raw
            for (t, i), spans in found.items():
                taken: list[tuple[int, int]] = []
                for edits, a, b in sorted(spans):
                    # the two bands of one region, or a worse alignment of it
                    n = bisect.bisect(taken, (a, b))
                    if (n == 0 or taken[n - 1][1] <= a) and (n == len(taken) or b <= taken[n][0]):
                        taken.insert(n, (a, b))
                        rows.append((t, i, int(at[off[t] + a] - base[t]), int(at[off[t] + b - 1] + 1 - base[t]), edits, int(items.m[i])))
            rows = [(t, x, *rest) for t, i, *rest in rows for x in ids[i]]
            if rows:
                t, i, *rest = (np.array(c) for c in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(t)), pa.array(i, pa.int64()), *(pa.array(c, pa.int64()) for c in rest)],
                    ["doc_id", "item_id", "start", "end", "edits", "item_chars"])
    return run


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", q: int = Q,
                  edit_percent: int = EDIT_PERCENT, slice_chars: int = SLICE_CHARS, short_items: bool = False) -> DataFrame:
    """Regions of documents that hold a benchmark item within its edit budget.

    Texts are compared with A-Z in lower case and white space runs as one blank; an edit
    inserts, deletes or changes one character, and an item of m characters may have
    m * ``edit_percent`` / 100 of them (fewer for items under some 40 characters, where
    the lemma would allow any region). Returns one row per region: ``doc_id, item_id, start, end`` (code points of the
    whole text), ``edits, item_chars``. Overlapping regions of one item give the best one (then the first).

    The documents are scanned once per slice of the benchmark: slices are
    dealt by hash so that each holds about ``slice_chars`` characters, whose arrays go to
    the tasks; a benchmark below that size is one slice. With more slices, each one's rows are written before the next
    slice is gathered, so one slice at a time is held. Nothing is shuffled. Items under ``q`` characters
    (as compared) are left out, or with ``short_items`` found as they stand, without edits: such an item may be an everyday word. Null and empty texts and items give no rows, nor do empty tables. A null id stays
    null; repeated rows (texts or items) each give their rows. Other columns are ignored. Memory doesn't grow with how
    repetitive a text is; where an item stands as it is, alignments that would overlap it are not computed.
    """
    spark = docs.sparkSession
    ship_package(spark)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.length("text") > 0)
    kind = base.schema["id"].dataType.simpleString()
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).alias("text")).filter(F.length("text") > 0)
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    slices = int(total // slice_chars) + 1
    out = scratch = None
    for s in range(slices):
        # at most about slice_chars characters
        rows = items.filter(F.pmod(F.xxhash64("text"), F.lit(slices)) == s).orderBy("id", "text").collect()
        ids: dict[str, list[int]] = {}
        for r in rows:
            ids.setdefault(r.text, []).append(r.id)
        held = Items(list(ids), q, edit_percent)
        if not short_items:
            held.short = {}
        shared = spark.sparkContext.broadcast((held, list(ids.values())))
        found = base.mapInArrow(_scan(shared, C.BLOCK_BYTES),
                                f"doc_id {kind}, item_id long, start long, end long, edits long, item_chars long")
        if slices > 1:
            scratch = scratch or C.Scratch(spark, "contamination")
            found = scratch.save(found, f"slice-{s}")
            shared.unpersist()
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item. A row without an id is judged by its own text."""
    named = docs.filter("doc_id is not null")
    bad = contamination(named, benchmark, **kw).select("doc_id").distinct()
    bare = docs.filter("doc_id is null")
    key = F.sha2("text", 256)
    texts = contamination(bare.select(key.alias("key"), "text"), benchmark, id_col="key", **kw).select(F.col("doc_id").alias("key")).distinct()
    return named.join(bad, "doc_id", "left_anti").select(*docs.columns).unionByName(
        bare.join(texts, key == texts["key"], "left_anti").select(*docs.columns))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), short_items=True)
