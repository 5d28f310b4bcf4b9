"""Language identification by rank-order n-gram profiles (out-of-place distance)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.llm import common as C
from docweave.llm.decontaminate import code_points
from docweave.session import read_table, ship_package

#: Longest n-gram, length of a profile, documents per language of a sample() (about; a hash
#: threshold), languages that profiles may have (beyond it fit() fails: profiles go to every task).
GRAMS, PROFILE, TRAIN_DOCS, MAX_LANGS = 3, 300, 4000, 2000
#: A language's score bound: SLACK times the score that all but REJECT of its learned texts reach.
REJECT, SLACK = 0.001, 0.75


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Each code point's lower-case letter, 0 for what is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


#: Characters whose n-grams are listed at a time; a longer text is cut for counting.
RUN_CHARS = 1 << 17


def _runs(texts: list[str | None], overlap: int) -> Iterator[list[tuple[int, str, int]]]:
    """Pieces (text index, characters, n-grams' first places) of about RUN_CHARS in all, in order.

    A text begins and ends with an edge (a line feed). A piece goes on for ``overlap`` characters after the places that it
    counts, so that every n-gram of the text begins in exactly one piece.
    """
    run, room = [], RUN_CHARS
    for i, t in enumerate(texts):
        if not t:
            continue
        at, end = 0, len(t) + 1  # places of the text with its edges; the last edge begins nothing
        while at < end:
            n = min(end - at, max(room, 1))
            piece = ("\n" if at == 0 else "") + t[max(at - 1, 0):at + n - 1 + overlap]
            run.append((i, piece + "\n" if at + n - 1 + overlap >= len(t) else piece, n))
            at += n
            room -= n
            if room <= 0:
                yield run
                run, room = [], RUN_CHARS
    if run:
        yield run


def _gram_keys(run: list[tuple[int, str, int]], grams: int) -> np.ndarray:
    """One key (text index, 40-bit hash) per n-gram that begins in a piece's places."""
    points, _ = code_points(["".join(p for _, p, _ in run)])
    x = _letters()[points].astype(np.uint64)
    size = np.array([len(p) for _, p, _ in run])
    text = np.repeat(np.array([i for i, _, _ in run], np.uint64), size) << C.U64(40)
    begins = np.arange(len(x)) - np.repeat(np.cumsum(size) - size, size) < np.repeat(np.array([n for _, _, n in run]), size)
    letter = x > 0
    one = letter & begins
    keys = [text[one] | (C.mix64(x[one]) >> C.U64(24))]
    for n in range(2, grams + 1):
        m = max(len(x) - n + 1, 0)
        h, inner = np.zeros(m, np.uint64), begins[:m].copy()
        for k in range(n):
            h = h * C.U64(0x110000) + x[k:k + m]
            if 0 < k < n - 1:
                inner &= letter[k:k + m]
        inner &= letter[:m] | letter[n - 1:n - 1 + m]
        keys.append(text[:m][inner] | (C.mix64(h[inner] + C.U64(n)) >> C.U64(24)))
    return np.concatenate(keys)


def _tally(key: np.ndarray, count: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each stands (or its sum of counts)."""
    if count is None:
        key.sort()
    else:
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order]
    if not len(key):
        return key, np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[new], np.diff(np.concatenate((new, [len(key)]))) if count is None else np.add.reduceat(count, new)


def ranked_grams(texts: list[str | None], grams: int, profile: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counted n-grams of each text: (text index, gram, count, rank). Letters in lower case; all else is
    a word edge, which is part of grams beside letters. Ranks: most frequent first, ties by
    gram; only ranks under ``profile`` if given. A gram is a 40-bit hash. Whole texts are counted, in runs of
    bounded size: a long text costs memory for its distinct n-grams only."""
    tallies = [_tally(_gram_keys(run, grams)) for run in _runs(texts, grams - 1)]
    if len(tallies) > 1:
        key, count = _tally(np.concatenate([k for k, _ in tallies]), np.concatenate([c for _, c in tallies]))
    else:
        key, count = tallies[0] if tallies else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    doc, gram = (key >> C.U64(40)).astype(np.int64), (key & C.U64((1 << 40) - 1)).astype(np.int64)
    order = np.lexsort((gram, -count, doc))
    doc, gram, count = doc[order], gram[order], count[order]
    rank = np.arange(len(doc)) - np.searchsorted(doc, doc, side="left")
    if profile is not None:
        ok = rank < profile
        doc, gram, count, rank = doc[ok], gram[ok], count[ok], rank[ok]
    return doc, gram, count, rank


def _count(grams: int):
    @C.bounded
    def run(batches):
        for part, _, _ in C.text_blocks(batches, "text"):
            langs, code = np.unique(np.array(part.column(1).to_pylist(), dtype=object), return_inverse=True)
            doc, gram, count, _ = ranked_grams(part.column(0).to_pylist(), grams, None)
            order = np.lexsort((gram, code[doc]))
            lang, gram, count = code[doc][order], gram[order], count[order]
            new = np.flatnonzero(np.concatenate(([True], (lang[1:] != lang[:-1]) | (gram[1:] != gram[:-1])))) if len(gram) else np.zeros(0, int)
            if len(new):
                yield pa.RecordBatch.from_arrays([pa.array(langs[lang[new]].tolist(), pa.string()), pa.array(gram[new]),
                                                  pa.array(np.add.reduceat(count, new).astype(np.int64))], ["lang", "gram", "n"])
    return run


def sample(labelled: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """About ``train_docs`` rows ``id, text, lang`` of each language, chosen by a hash of the id; null texts and langs are left out.

    Rows are counted per language first (a language's rows are never brought together), and the shares go into the scan's filter.
    """
    rows = labelled.filter("text is not null and lang is not null")
    sizes = {r.lang: r.size for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("size")).limit(MAX_LANGS + 1).collect()}
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages to learn")
    if not sizes:
        return rows.select("id", "text", "lang").limit(0)
    size = F.create_map(*(F.lit(x) for pair in sorted(sizes.items()) for x in pair))[F.col("lang")]
    share = F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(1_000_000)) * size < F.lit(train_docs * 1_000_000)
    return rows.filter(share).select("id", "text", "lang")


def fit(labelled: DataFrame, grams: int = GRAMS, profile: int = PROFILE) -> list[tuple[str, list[int]]]:
    """Profiles ``[(lang, grams by rank)]``, by language, from all rows ``text, lang`` (whole texts); null texts and langs are left out.

    Counts are aggregated before they move, and the ranking is cut per (language, salt) first, so a hot language does
    not meet in one task.
    """
    ship_package(labelled.sparkSession)
    rows = labelled.filter("text is not null and lang is not null").select("text", "lang")
    if rows.select("lang").distinct().limit(MAX_LANGS + 1).count() > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages to learn")
    counts = rows.mapInArrow(_count(grams), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = [F.col("n").desc(), "gram"]
    first = counts.withColumn("salt", F.pmod("gram", F.lit(32))).withColumn(
        "r", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).filter(F.col("r") <= profile)
    top = first.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("r") <= profile)
    found: dict[str, list[int]] = {}
    for r in top.select("lang", "gram", "r").orderBy("lang", "r").collect():
        found.setdefault(r.lang, []).append(r.gram)
    return sorted(found.items())


def _predict(profiles: list[tuple[str, list[int]]], grams: int, profile: int):
    names = [n for n, _ in profiles]
    known = np.unique(np.array([g for _, p in profiles for g in p], np.int64))
    ranks = np.full((len(known), len(profiles)), -1, np.int64)
    for j, (_, p) in enumerate(profiles):
        ranks[np.searchsorted(known, p), j] = np.arange(len(p))

    @C.bounded

    def run(batches):
        for part, _, _ in C.text_blocks(batches, "text"):
            doc, gram, _, rank = ranked_grams(part.column(1).to_pylist(), grams, profile)
            n = np.bincount(doc, minlength=part.num_rows)
            if len(known):
                at = np.minimum(np.searchsorted(known, gram), len(known) - 1)
                theirs = np.where((known[at] == gram)[:, None], ranks[at], -1)
                far = np.where(theirs < 0, profile, np.abs(theirs - rank[:, None]))
                total = np.stack([np.bincount(doc, far[:, j], part.num_rows) for j in range(len(names))], axis=1)
                best = total.argmin(axis=1)
                score = 1 - total[np.arange(len(best)), best] / np.maximum(n * profile, 1)
            lang = [names[best[i]] if n[i] and names else "und" for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(lang, pa.string()), pa.array([float(score[i]) if n[i] and names else 0.0 for i in range(part.num_rows)], pa.float64())],
                ["id", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, profiles: list[tuple[str, list[int]]], id_col: str = "doc_id", text_col: str = "text",
             grams: int = GRAMS, profile: int = PROFILE) -> DataFrame:
    """``id, lang_pred, score`` for every row: the language with the least out-of-place distance.

    The text's ``profile`` most frequent n-grams are compared with each language's: a gram costs the difference of its ranks, and
    ``profile`` where the language's profile lacks it. ``score`` is 1 - distance / largest distance. Null
    texts and texts without a letter are ``und`` with score 0; so is every text when no language was learned. Ties go to
    the first language by name. Null ids and repeated rows return rows; an empty table gives none.
    """
    ship_package(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return base.mapInArrow(_predict(profiles, grams, profile), f"id {base.schema['id'].dataType.simpleString()}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Rows that profiles are not learned from; rows without an id are among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _labelled(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"), "text", "lang")


def learn(docs: DataFrame) -> list[tuple[str, list[int]]]:
    return fit(_labelled(docs))


def learn_bounds(labelled: DataFrame, profiles: list[tuple[str, list[int]]]) -> dict[str, float]:
    """The least score of a text in each language, from the texts that profiles were learned from.

    SLACK times the score that all but REJECT of the language's learned texts reach (as many as are identified as it), so at most
    that share of them scores less. A language that no learned text is identified as has no bound.
    """
    if not profiles:
        return {}
    scored = identify(labelled.filter("text is not null and lang is not null"), profiles, "id").filter("lang_pred <> 'und'")
    reach = scored.groupBy("lang_pred").agg(F.percentile_approx("score", REJECT, 100_000).alias("reach"))
    return {r.lang_pred: SLACK * r.reach for r in reach.collect()}


def learn_with_bounds(docs: DataFrame) -> tuple[list[tuple[str, list[int]]], dict[str, float]]:
    """Profiles and score bounds of the languages of ``docs``, both from every labelled text that isn't held out."""
    labelled = _labelled(docs)
    profiles = fit(labelled)
    return profiles, learn_bounds(labelled, profiles)


def _keep(profiles: list[tuple[str, list[int]]], bounds: dict[str, float], at: int):
    judge = _predict(profiles, GRAMS, PROFILE)

    @C.bounded

    def run(batches):
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column(at)], ["id", "text"])
            kept = [lang != "und" and score >= bounds.get(lang, 0.0)
                    for part in judge([texts]) for lang, score in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
            yield batch.filter(pa.array(kept, pa.bool_()))
    return run


def keep_identified(docs: DataFrame, profiles: list[tuple[str, list[int]]],
                    bounds: dict[str, float] | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text has no letter (``und``) or scores less than the bound of its language.

    Where no language was learned, every text with a letter stays. Batches are filtered as they pass: no row moves.
    """
    ship_package(docs.sparkSession)
    # a profile without a gram of any text: only letters count
    return docs.mapInArrow(_keep(profiles or [("any", [-1])], bounds or {}, docs.columns.index(text_col)), docs.schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, learn(docs)).select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")
