"""Suffix-array dedup: longest previous factors of every byte, over a whole corpus.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier
(smaller document id, or the same document and an earlier start). In the terms
of suffix arrays: position i has a longest previous factor LPF[i], the longest
string at i that also starts earlier; bytes i .. i+LPF[i] go where LPF[i] >= LENGTH.

One suffix array of a corpus does not fit a machine, so suffixes that can share
``LENGTH`` bytes are brought together first. Each window of ``LENGTH`` bytes has one
*anchor*: the leftmost of its ``GRAM``-byte strings with the least hash. Equal
windows have equal anchors at equal offsets, so suffixes meet under their anchor:

1. anchors of all texts (one per ~37 bytes), dealt by hash in packed blocks: those that occur once drop out;
2. for the others the text around the anchor (the windows that it owns) is dealt by its hash;
3. equal contexts are one string; the suffixes of different contexts under an anchor are put into suffix
   order, and previous and next smaller positions give their longest previous factors;
4. spans go back to their documents.

Blocks combine before every exchange: an anchor or a context that a block holds
many times is sent once, so a passage that a third of all documents share adds one entry per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common as C
from docweave.session import read_table

LENGTH, GRAM = 100, 28
#: Text per block of anchors, and text per suffix array.
BLOCK, SUFFIX_BYTES = 4 << 20, 1 << 19
#: A longer text is cut into pieces that overlap by LENGTH - 1 bytes: every window lies in exactly one.
PIECE = 8 << 20


def longest_previous(position: np.ndarray, lcp: np.ndarray, cap: int) -> np.ndarray:
    """LPF of suffixes given in suffix order.

    ``position``: where each suffix starts (its rank in the corpus); ``lcp[k]``:
    the common prefix of suffixes k-1 and k (lcp[0] = 0), counted up to ``cap``. The
    previous and next smaller positions in suffix order hold the longest earlier match:
    links jump over larger positions and keep the least lcp on the way.
    """
    n = len(position)

    def smaller(pos: np.ndarray, near: np.ndarray) -> np.ndarray:
        # near[k]: common prefix of k and its neighbour k-1
        link, least = np.arange(n) - 1, near.copy()
        while True:
            todo = np.flatnonzero((link >= 0) & (least >= cap) & (pos[link] >= pos))
            if not len(todo):
                return np.where(link >= 0, least, 0)
            over = link[todo]
            least[todo], link[todo] = np.minimum(least[todo], least[over]), link[over]

    before = smaller(position, lcp)
    back = np.concatenate(([0], lcp[1:][::-1])) if n else lcp
    after = smaller(position[::-1], back)[::-1]
    return np.maximum(before, after)


def anchors(buf: np.ndarray, off: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window start and anchor of every run of windows with the
    same anchor (indices into ``buf``), and the text's index; windows never cross texts."""
    span = length - gram + 1
    n = len(buf) - length + 1
    none = np.zeros(0, np.int64)
    valid = off[1:] - off[:-1] >= length
    if n <= 0 or not valid.any():
        return none, none, none, none
    h, width = C._BYTE[buf], 1
    while width < gram:
        step = min(width, gram - width)
        h = h[:-step] * C.U64(pow(C._BASE, step, 1 << 64)) + h[step:]
        width += step
    h = (C.mix64(h) & C.U64(0xFFFFFFFFFF000000)) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while width < span:
        step = min(width, span - width)
        h = np.minimum(h[:-step], h[step:])
        width += step
    at = (h & C.U64(0xFFFFFF)).astype(np.int64)
    counts = np.where(valid, off[1:] - off[:-1] - length + 1, 0)
    inside = np.zeros(n + 1, np.int8)
    np.add.at(inside, off[:-1][valid], 1)
    np.add.at(inside, np.minimum(off[:-1][valid] + counts[valid], n), -1)
    start = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    at = at[start]
    new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.concatenate((new[1:], [len(start)])) - 1
    return start[new], start[last], at[new], np.searchsorted(off, start[new], side="right") - 1


def _pieces(batches, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of texts: ids, uids, base offsets, bytes, offsets. Texts over PIECE bytes come in overlapping pieces."""
    for part, buf, off in C.text_blocks(batches, "text", BLOCK):
        ids, uids = (part.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        if len(buf) <= PIECE:
            yield ids, uids, np.zeros(len(ids), np.int64), buf, off
        else:
            for t in range(len(ids)):
                for a in range(0, max(int(off[t + 1] - off[t]), 1), PIECE):
                    end = min(off[t + 1], off[t] + a + PIECE + length - 1)
                    yield ids[t:t + 1], uids[t:t + 1], np.array([a]), buf[off[t] + a:end], np.array([0, end - off[t] - a])


def _deal(bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Rows by bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    columns = [c[order] for c in columns]
    edge = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(bucket) else []
    for a, b in zip(edge[:-1], edge[1:]):
        yield int(bucket[a]), [c[a:b] for c in columns]


def _first_of(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by keys (first key first), and where a row's first key differs from its predecessor's."""
    order = np.lexsort(keys[::-1])
    k = keys[0][order]
    return order, np.concatenate(([True], k[1:] != k[:-1])) if len(k) else np.zeros(0, bool)


def _bucket_rows(rows: list[tuple[int, int, list[np.ndarray]]], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
         *(pa.array([_squeeze(r[2][k]) for r in rows], pa.binary()) for k in range(len(names)))], ["bucket", "kind", *names])


def _squeeze(values: np.ndarray) -> bytes:
    """Packed values: their size in bytes, then zstd."""
    return np.int64(values.nbytes).tobytes() + pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


def _unpack(blob: pa.Buffer, kind) -> np.ndarray:
    size = int(np.frombuffer(blob, np.int64, 1)[0])
    return np.frombuffer(pa.decompress(blob.slice(8), size, codec="zstd"), kind) if size else np.zeros(0, kind)


_ENTRY = ["h", "id", "uid", "spot"]
_ENTRY_SCHEMA = "bucket int, kind int, h binary, id binary, uid binary, spot binary"


def _emit_anchors(length: int, gram: int, buckets: int):
    """Blocks of (hash, document, spot) by bucket. Kind 0: one entry per hash and
    block; kind 1: entries whose hash the block holds twice, already known to recur."""
    @C.bounded
    def run(batches):
        for ids, uids, base, buf, off in _pieces(batches, length):
            first, last, at, owner = anchors(buf, off, length, gram)
            if not len(at):
                continue
            h = C.word_hashes(buf, at, at + gram)
            start = first - off[owner] + base[owner]
            spot = (start << 16) | ((at - first) << 8) | (last - first)
            cols = [h, ids[owner], uids[owner], spot]
            order, new = _first_of(h, spot)
            cols = [c[order] for c in cols]
            group = np.cumsum(new) - 1
            again = np.bincount(group)[group] > 1
            # an entry of kind 0 that is known to recur needs no answer: its spot is void
            spots = np.where(again, -1, cols[3])
            bucket = (cols[0] >> C.U64(40)).astype(np.int64) % buckets
            # the bucket and 32 more bits: a chance match only costs a context
            cols[0] = cols[0].astype(np.uint32)
            rows = [(b, 0, c) for b, c in _deal(bucket[new], [c[new] for c in (*cols[:3], spots)])]
            rows += [(b, 1, c) for b, c in _deal(cols[1][again] % buckets, [c[again] for c in cols])]
            yield _bucket_rows(rows, _ENTRY)
    return run


def _buckets(batches, names: list[str], types: list) -> Iterator[tuple[list, list]]:
    """Per bucket (rows come sorted by it) the arrays of kind 0 and of kind 1."""
    now, held = None, ([], [])

    def joined():
        return [[np.concatenate([x[k] for x in part]) if part else np.zeros(0, t) for k, t in enumerate(types)] for part in held]

    for batch in batches:
        for i in range(batch.num_rows):
            bucket = batch.column(0)[i].as_py()
            if bucket != now and now is not None:
                yield joined()
                held = ([], [])
            now = bucket
            held[batch.column(1)[i].as_py()].append(
                [_unpack(batch.column(2 + k)[i].as_buffer(), t) for k, t in enumerate(types)])
    if now is not None:
        yield joined()


def _per_document(ids: np.ndarray, uids: np.ndarray, values: list[np.ndarray], name: str) -> pa.RecordBatch:
    """One row per document with its values packed."""
    order = np.lexsort((values[0], uids, ids))
    ids, uids = ids[order], uids[order]
    packed = np.stack([v[order] for v in values], axis=1).astype(np.int64)
    edge = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (uids[1:] != uids[:-1]), [True]))) if len(ids) else np.zeros(1, int)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[edge[:-1]]), pa.array(uids[edge[:-1]]),
         pa.array([packed[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary())], ["id", "uid", name])


@C.bounded


def _recurring(batches):
    """Spots whose anchor occurs at two places or more."""
    for fresh, known in _buckets(batches, _ENTRY, [np.uint32, np.int64, np.int64, np.int64]):
        order, new = _first_of(fresh[0])
        group = np.cumsum(new) - 1
        spot = fresh[3][order]
        ok = (np.bincount(group)[group] > 1) & (spot >= 0) if len(group) else np.zeros(0, bool)
        ids, uids, spots = (np.concatenate((fresh[k][order][ok], known[k])) for k in (1, 2, 3))
        if len(ids):
            yield _per_document(ids, uids, [spots], "spots")


_CONTEXT = ["id", "uid", "start", "lead", "windows", "size", "bytes"]
_CONTEXT_SCHEMA = "bucket int, kind int, " + ", ".join(f"{c} binary" for c in _CONTEXT)
_CONTEXT_TYPES = [np.int64, np.int64, np.int64, np.uint8, np.uint8, np.uint8, np.uint8]


def _emit_contexts(length: int, gram: int, buckets: int):
    """Contexts by bucket of their anchor's hash. Kind 0: one per content and block;
    kind 1: later copies in the block, whose windows all start earlier too."""
    @C.bounded
    def run(batches):
        for part, buf, off in C.text_blocks(batches, "text", BLOCK):
            ids, uids = (part.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            spots = [np.unique(np.concatenate([np.frombuffer(x, np.int64) for x in s])) for s in part.column(3).to_pylist()]
            owner = np.repeat(np.arange(len(ids)), [len(s) for s in spots])
            spot = np.concatenate(spots)
            start, lead, windows = spot >> 16, spot >> 8 & 0xFF, (spot & 0xFF) + 1
            begin = off[owner] + start
            size = windows + length - 1
            h = C.word_hashes(buf, begin + lead, begin + lead + gram)
            whole = C.word_hashes(buf, begin, begin + size) ^ C.mix64(lead.astype(np.uint64))
            order = np.lexsort((start, uids[owner], ids[owner], whole))
            same = np.concatenate(([False], whole[order][1:] == whole[order][:-1]))
            head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
            place = np.stack((ids[owner], uids[owner], start))[:, order]
            later = (place != place[:, head]).any(axis=0)
            rows = []
            for kind, chosen in ((0, order[~later]), (1, order[later])):
                by = h[chosen] >> C.U64(40) if kind == 0 else ids[owner[chosen]].astype(np.uint64)
                for b, (c,) in _deal((by % C.U64(buckets)).astype(np.int64), [chosen]):
                    text = [buf[x:y] for x, y in zip(begin[c].tolist(), (begin[c] + size[c]).tolist())] if kind == 0 else [buf[:0]]
                    rows.append((b, kind, [ids[owner[c]], uids[owner[c]], start[c], lead[c].astype(np.uint8),
                                           windows[c].astype(np.uint8), size[c].astype(np.uint8), np.concatenate(text)]))
            yield _bucket_rows(rows, _CONTEXT)
    return run


def _factors(text: np.ndarray, at: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """For suffixes at ``at`` of ``text``: whether their longest previous factor reaches ``length``."""
    head = np.lib.stride_tricks.sliding_window_view(text, length)[at]
    order = np.lexsort((place, np.ascontiguousarray(head).view(f"S{length}").ravel()))
    head = head[order]
    differ = head[1:] != head[:-1]
    lcp = np.concatenate(([0], np.where(differ.any(axis=1), differ.argmax(axis=1), length)))
    found = np.zeros(len(at), bool)
    found[order] = longest_previous(place[order], lcp, length) >= length
    return found


def _solve(ids, uids, start, lead, windows, size, text, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Repeated window ranges of one bucket's contexts: (index, first window, last window)."""
    where = np.concatenate(([0], np.cumsum(size.astype(np.int64))))
    h = C.word_hashes(text, where[:-1] + lead, where[:-1] + lead + gram)
    whole = C.word_hashes(text, where[:-1], where[1:]) ^ C.mix64(lead.astype(np.uint64))
    rank = np.empty(len(h), np.int64)
    by_place = np.lexsort((start, uids, ids))
    step = (np.diff(ids[by_place]) != 0) | (np.diff(uids[by_place]) != 0) | (np.diff(start[by_place]) != 0)
    rank[by_place] = np.concatenate(([0], np.cumsum(step)))
    # equal contexts under an anchor are one string of the suffix array: its first place stands for it
    order = np.lexsort((rank, whole, h))
    new = np.concatenate(([True], (whole[order][1:] != whole[order][:-1]) | (h[order][1:] != h[order][:-1])))
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    copy = order[rank[order] > rank[order][head]]
    yield copy, np.zeros(len(copy), np.int64), windows[copy].astype(np.int64) - 1
    firsts = order[new]
    group = np.cumsum(np.concatenate(([True], h[firsts][1:] != h[firsts][:-1]))) - 1
    several = firsts[np.bincount(group)[group] > 1]
    if not len(several):
        return
    # chunks of whole anchors; an anchor beyond a chunk is dealt again by the hash of each window
    hs, weight = h[several], size[several].astype(np.int64)
    edge = np.flatnonzero(np.concatenate(([True], hs[1:] != hs[:-1], [True])))
    load = np.concatenate(([0], np.cumsum(weight)))
    chunk, k = [], 0
    while k < len(edge) - 1:
        j = k + 1
        while j < len(edge) - 1 and load[edge[j + 1]] - load[edge[k]] <= SUFFIX_BYTES:
            j += 1
        chunk.append(several[edge[k]:edge[j]])
        k = j
    for c in chunk:
        n = windows[c].astype(np.int64)
        owner = np.repeat(c, n)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        at = where[owner] + offset
        # the corpus order of windows: by place of the context, then offset
        place = rank[owner] * 256 + offset
        found = np.zeros(len(at), bool)
        if size[c].astype(np.int64).sum() <= SUFFIX_BYTES:
            found = _factors(text, at, place, length)
        else:
            keys = C.word_hashes(text, at, at + length)
            parts = int(len(at) * length // (8 * SUFFIX_BYTES)) + 1
            for _, (mine,) in _deal((keys % C.U64(parts)).astype(np.int64), [np.arange(len(at))]):
                found[mine] = _factors(text, at[mine], place[mine], length)
        hit = np.flatnonzero(found)
        if len(hit):
            cut = np.concatenate(([True], (np.diff(hit) > 1) | (np.diff(owner[hit]) != 0)))
            ends = np.concatenate((np.flatnonzero(cut)[1:], [len(hit)])) - 1
            yield owner[hit[cut]], offset[hit[cut]], offset[hit[ends]]


def _solve_buckets(length: int, gram: int):
    @C.bounded
    def run(batches):
        for fresh, known in _buckets(batches, _CONTEXT, _CONTEXT_TYPES):
            ids, uids, begin, end = [known[0]], [known[1]], [known[2]], [known[2] + known[4].astype(np.int64) - 1 + length]
            if len(fresh[0]):
                for i, first, last in _solve(*fresh, length, gram):
                    ids.append(fresh[0][i])
                    uids.append(fresh[1][i])
                    begin.append(fresh[2][i] + first)
                    end.append(fresh[2][i] + last + length)
            ids, uids, begin, end = map(np.concatenate, (ids, uids, begin, end))
            if len(ids):
                yield _per_document(ids, uids, [begin, end], "spans")
    return run


def merge_spans(spans: list[bytes] | None) -> np.ndarray:
    """Maximal runs (begin, end) of packed spans."""
    s = np.concatenate([np.frombuffer(x, np.int64) for x in spans]).reshape(-1, 2) if spans else np.zeros((0, 2), np.int64)
    if not len(s):
        return s
    s = s[np.argsort(s[:, 0], kind="stable")]
    top = np.maximum.accumulate(s[:, 1])
    cut = np.concatenate(([True], s[1:, 0] > top[:-1]))
    last = np.concatenate((np.flatnonzero(cut)[1:], [len(s)])) - 1
    return np.stack((s[cut, 0], top[last]), axis=1)


@C.bounded


def _cut(batches):
    """Texts without their spans: kept bytes, and the text in whole characters."""
    for part, buf, off in C.text_blocks(batches, "text"):
        kept, texts, sizes, gone, runs, spans_out = [], [], [], [], [], []
        null = part.column(2).is_null().to_pylist()
        for t, spans in enumerate(part.column(3).to_pylist()):
            raw = buf[off[t]:off[t + 1]]
            spans = merge_spans(spans)
            keep = np.ones(len(raw), bool)
            for a, b in spans.tolist():
                keep[a:b] = False
            data = raw[keep].tobytes()
            # a character stays in the text unless all of its bytes go
            lead = np.flatnonzero((raw & 0xC0) != 0x80)
            if len(spans) and len(lead):
                stay = np.maximum.reduceat(keep, lead)
                keep = np.repeat(stay, np.diff(np.concatenate((lead, [len(raw)]))))
            kept.append(hashlib.sha256(data).hexdigest())
            texts.append(None if null[t] else raw[keep].tobytes().decode("utf-8", "replace"))
            sizes.append(len(raw))
            gone.append(len(raw) - len(data))
            runs.append(len(spans))
            spans_out.append(spans.reshape(-1).tolist())
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
             pa.array(runs, pa.int64()), pa.array(kept, pa.string()), pa.array(spans_out, pa.list_(pa.int64()))],
            ["id", "uid", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


_LAST = (1 << 63) - 1


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM) -> DataFrame:
    """Texts without the strings of ``length`` bytes that also start earlier.

    Returns one row per input row: ``doc_id, text`` (whole characters: one stays unless
    all its bytes go), ``n_bytes, n_removed, n_spans, kept_sha256`` (of the kept
    bytes), ``spans`` (begin, end, begin, end ... of the maximal removed runs, in
    bytes). ``doc_id`` must be integral.

    Null texts are empty (and stay null in ``text``); matches never cross documents; texts
    under ``length`` bytes lose nothing. Rows without an id come after all others. Rows that
    share an id are ordered by a hash of their text; repeated rows (same id, same text) are one document and
    return the same result each. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = C.Scratch(spark, "substring")
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_ = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST))
    shared = docs.select(id_.alias("id")).groupBy("id").count().filter("count > 1").limit(1).count() > 0
    uid = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) if shared else F.lit(0).cast("long")
    base = docs.select(id_.alias("id"), uid.alias("uid"), F.col(text_col).alias("text"))

    entries = base.mapInArrow(_emit_anchors(length, gram, buckets), _ENTRY_SCHEMA)
    spots = scratch.save(entries.repartition("bucket").sortWithinPartitions("bucket")
                         .mapInArrow(_recurring, "id long, uid long, spots binary"), "spots")
    # one exchange of the texts serves both joins
    dealt = base.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "id", "uid")
    listed = spots.groupBy("id", "uid").agg(F.collect_list("spots").alias("spots"))
    contexts = dealt.join(listed, ["id", "uid"]).select("id", "uid", "text", "spots") \
        .mapInArrow(_emit_contexts(length, gram, buckets), _CONTEXT_SCHEMA)
    spans = contexts.repartition("bucket").sortWithinPartitions("bucket") \
        .mapInArrow(_solve_buckets(length, gram), "id long, uid long, spans binary") \
        .groupBy("id", "uid").agg(F.collect_list("spans").alias("spans"))
    out = dealt.join(spans, ["id", "uid"], "left").select("id", "uid", "text", "spans").mapInArrow(
        _cut, "id long, uid long, text string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")
    return out.select(F.when(F.col("id") != _LAST, F.col("id")).alias("doc_id"), "text", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
