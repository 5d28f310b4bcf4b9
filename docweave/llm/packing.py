"""Best-fit decreasing packing of token sequences."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common as C
from docweave.session import read_table, ship_package

#: Tokens of a sequence; tokens that a task holds before it closes all windows; words in a generation of a worker's cache.
LENGTH, HELD_TOKENS, CACHED_WORDS = 1024, 4 << 20, 400_000


class Windows:
    """Open windows by remaining capacity, under a segment tree of counts."""

    def __init__(self, length: int):
        self.size = 1 << max(length - 1, 1).bit_length()
        self.count = [0] * (2 * self.size)
        self.stacks: list[list[int]] = [[] for _ in range(self.size)]

    def _add(self, capacity: int, by: int) -> None:
        i = capacity + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, capacity: int, window: int) -> None:
        if capacity:
            self.stacks[capacity].append(window)
            self._add(capacity, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out the window with the least remaining capacity that is at least ``need``."""
        i = need + self.size
        if not self.count[i]:
            # up to the first ancestor with a non-empty right sibling, then down to its least leaf
            while i > 1 and not (i % 2 == 0 and self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        capacity = i - self.size
        self._add(capacity, -1)
        return capacity, self.stacks[capacity].pop()


def best_fit_decreasing(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset of each piece (1 .. length tokens), and how many windows. Longest pieces
    first (ties in the given order), each into the tightest open window."""
    window, offset, n = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), 0
    open_ = Windows(length)
    for p in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[p])
        fit = open_.tightest(size) if size < length else None
        if fit is None:
            fit, n = (length, n), n + 1
        capacity, w = fit
        window[p], offset[p] = w, length - capacity
        open_.put(capacity - size, w)
    return window, offset, n


def _byte_ranks(path: str) -> tuple[dict[bytes, int], list[str]] | None:
    """Byte sequence -> id of a byte-level vocabulary whose ids are in the order of its merges, and its
    added tokens; None for any other vocabulary."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, merges = spec["model"].get("vocab"), spec["model"].get("merges")
    if (spec["model"]["type"], (spec.get("pre_tokenizer") or {}).get("type"), spec.get("normalizer")) != ("BPE", "ByteLevel", None):
        return None
    ids = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in merges]
    if ids != list(range(256, 256 + len(ids))):
        return None
    # byte-level vocabularies write visible bytes as themselves, the others as characters from 256 on
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(visible))}
    added = [t["content"] for t in spec.get("added_tokens", [])]
    return {bytes(of[c] for c in token): i for token, i in vocab.items() if token not in added}, added


class Encoder:
    """Token ids of whole texts as little-endian 32-bit bytes, by a ``tokenizers`` file.

    The vocabulary's pre-tokenisation always cuts before a single blank that stands between
    non-blank characters and around a line break between them. Texts with only such white space are encoded word by
    word; other texts are encoded whole. Ids are the same either way. Words are kept in two
    generations: when the young one is full it becomes the old one, from which words in use come back.
    New words of many texts are merged in one call, by the same vocabulary's byte ranks where it has them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.merged = None
        if found := _byte_ranks(path):
            ranks, self.added = found
            self.merged = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
            self.sizes[list(ranks.values())] = [len(b) for b in ranks]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes() if text else b""

    def _learn(self, words: set[str]) -> None:
        young, old = self.young, self.old
        if len(young) > CACHED_WORDS:
            young, old = self.young, self.old = {}, young
        new = []
        for w in words - young.keys():
            if (ids := old.get(w)) is not None:
                young[w] = ids
            else:
                new.append(w)
        spelled = [w if w[0] == "\n" else " " + w for w in new]
        if not self.merged or any(t in "".join(spelled) for t in self.added):
            young.update((w, self.whole(s)) for w, s in zip(new, spelled))
        elif new:
            ids = np.array(self.merged.encode_ordinary("".join(spelled)), np.uint32)
            ends = np.cumsum([len(s.encode()) for s in spelled])
            cut = (4 * (np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1)).tolist()
            data = ids.tobytes()
            young.update(zip(new, [data[a:b] for a, b in zip([0, *cut], cut)]))

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        split = [t.replace("\n", " \n").split(" ") if t and len(t.split()) == 1 + t.count(" ") + t.count("\n")
                 and not any(c in t for c in "\x1c\x1d\x1e\x1f") else None for t in texts]
        self._learn(set().union(*(words[1:] for words in split if words)))
        ids = self.young.__getitem__
        return [self.whole(words[0]) + b"".join(map(ids, words[1:])) if words else self.whole(t or "") for t, words in zip(texts, split)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker: its words serve the worker's later tasks too."""
    return Encoder(path)


C.KEPT[__name__] = encoder.cache_clear

_SCHEMA = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _pack(path: str, length: int, end_id: int, held_tokens: int):
    tail = np.array([end_id], np.uint32).tobytes()

    def closed(pieces: list[tuple], base: int) -> tuple[Iterator[pa.RecordBatch], int]:
        window, offset, n = best_fit_decreasing(np.array([len(p[2]) // 4 for p in pieces], np.int64), length)

        def batches():
            for a in range(0, len(pieces), 2048):
                part = pieces[a:a + 2048]
                ids, start, data, total = zip(*part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(start, pa.int64()), pa.array([len(d) // 4 for d in data], pa.int64()), pa.array(data, pa.binary()),
                     pa.array(total, pa.int64()), pa.array(window[a:a + 2048] + base), pa.array(offset[a:a + 2048])],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
        return batches(), n

    @C.bounded

    def run(batches):
        encode = encoder(path)
        base, pieces, held = TaskContext.get().partitionId() << 40, [], 0
        for part, _, _ in C.text_blocks(batches, "text"):
            for doc, data in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                data += tail
                total = len(data) // 4
                for start in range(0, total, length):
                    pieces.append((doc, start, data[4 * start:4 * (start + length)], total))
                held += total
            if held >= held_tokens:
                out, n = closed(pieces, base)
                yield from out
                base, pieces, held = base + n, [], 0
        if pieces:
            yield from closed(pieces, base)[0]
    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
         end_id: int = 0, held_tokens: int = HELD_TOKENS) -> DataFrame:
    """Documents cut and packed into sequences of at most ``length`` tokens.

    A document is its text's ids and then ``end_id``; a null or empty text is ``end_id`` alone. It
    is cut into full windows and a rest; rests go by best-fit decreasing into the tightest open
    window (full windows are sequences of their own). Returns one row per piece: ``doc_id, start`` (its document's tokens
    before it), ``length, ids`` (little-endian unsigned 32-bit), ``doc_tokens, sequence_id, offset``
    (in the sequence, gapless from 0).

    Each task packs what it reads, in groups of about ``held_tokens``: no shuffle, bounded memory, and at most
    the last windows of a group are part full. A rerun task returns the same rows, as
    its input is a table split. Null ids and repeated rows are packed like others; other columns
    are ignored; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return base.mapInArrow(_pack(tokenizer, length, end_id, held_tokens), f"doc_id {base.schema['id'].dataType.simpleString()}, {_SCHEMA}")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer file (the same place on every machine)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(read_table(spark, sf_dir, "documents"), vocabulary()))
