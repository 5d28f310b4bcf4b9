"""Circulant MinHash and an exact verified join of near-equal shingle sets."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm import common as C
from docweave.llm.components import components


def _permute32(x: np.ndarray, odd_a: int, odd_b: int) -> np.ndarray:
    """A permutation of the 32-bit universe, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(odd_a)
    x ^= x >> np.uint32(13)
    x *= np.uint32(odd_b)
    x ^= x >> np.uint32(16)
    return x


def _least(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Minimum of each text that has values; 2**32 - 1 for the others."""
    out = np.full(len(first) - 1, 0xFFFFFFFF, np.uint32)
    some = first[:-1] < first[1:]
    if some.any():
        out[some] = np.minimum.reduceat(values, first[:-1][some])
    return out


def circulant_signatures(values: np.ndarray, first: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of the shingle sets of many texts: (coordinates, texts).

    Permutation sigma scatters the shingles over a universe of 2**32 slots; the
    second permutation pi is used in every coordinate, circularly shifted by
    the coordinate's number: h_k = min over the set of pi(sigma(x) + k mod 2**32).
    """
    slots = _permute32((values ^ (values >> C.U64(32))).astype(np.uint32), 0x85EBCA6B, 0xC2B2AE35)
    return np.stack([_least(_permute32(slots + np.uint32(k + 1), 0x7FEB352D, 0x846CA68B), first)
                     for k in range(coordinates)])


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per text and band; the band's number is part of the key."""
    number = np.arange(1, bands + 1, dtype=np.uint64) * C.U64(0x9E3779B97F4A7C15)
    key = np.broadcast_to(number[:, None], (bands, signatures.shape[1]))
    for r in range(rows):
        key = C.mix64(key ^ signatures[r:bands * rows:rows].astype(np.uint64)) + C.U64(r + 1)
    return C.mix64(key).T


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return total[first[1:]] - total[first[:-1]]


SIGNED = "n_shingles long, k1 long, k2 long, bands array<long>"
SIGNED_NAMES = ["n_shingles", "k1", "k2", "bands"]
#: Most bands of which the keys move at a time.
BANDS_MOVED = 8
#: Bits of a coordinate that a sketch keeps, coordinates of a sketch, and classes of a bucket's block.
PLANES, SKETCH, BLOCK = 4, 256, 2000
#: Mean company of a class in its buckets from which classes are seated first, and members of the largest component that each then meets.
CROWD, SEATS = 100, 4


def sketches(signatures: np.ndarray) -> np.ndarray:
    """The last PLANES bits of every coordinate, one bit plane after the other: (texts, longs)."""
    n, texts = signatures.shape
    words = -(-n // 64)
    bits = np.zeros((PLANES, words * 64, texts), np.uint8)
    for j in range(PLANES):
        bits[j, :n] = signatures >> np.uint32(j) & np.uint32(1)
    return np.packbits(bits.reshape(PLANES * words, 64, texts), axis=1, bitorder="little").transpose(2, 0, 1).copy().view(np.uint64)[:, :, 0]


def may_agree(a: Column, b: Column, coordinates: int, percent: int) -> Column:
    """Whether two sketches agree in as many coordinates as similar sets do. A pair at ``percent`` agrees in
    J + (1 - J) / 2**PLANES of them; one in 40,000 such pairs lies 4.1 deviations below."""
    words = -(-coordinates // 64)
    apart = F.lit(0)
    for w in range(words):
        differ = F.lit(0).cast("long")
        for j in range(PLANES):
            differ = differ.bitwiseOR(F.get(a, F.lit(j * words + w)).bitwiseXOR(F.get(b, F.lit(j * words + w))))
        apart = apart + F.bit_count(differ)
    share = percent / 100 + (1 - percent / 100) / 2 ** PLANES
    return F.lit(coordinates) - apart >= int(coordinates * share - 4.1 * (coordinates * share * (1 - share)) ** 0.5)


def _lists(rows: np.ndarray) -> pa.Array:
    """Rows of unsigned 64-bit values as lists of longs."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), C.longs(np.ascontiguousarray(rows).reshape(-1)))


def set_keys(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each distinct shingle set that depend on the set only."""
    return _sums(C.mix64(values), first), _sums(C.mix64(values ^ C.U64(0xA5A5A5A55A5A5A5A)), first)


def signed_columns(values: np.ndarray, first: np.ndarray, bands: int, rows: int) -> list[pa.Array]:
    """Columns SIGNED of distinct shingle sets: size, 128 bits that depend on the
    set only, one key per band (no keys for an empty set)."""
    keys = np.ascontiguousarray(band_keys(circulant_signatures(values, first, bands * rows), bands, rows))
    some = np.diff(first) > 0
    offsets = np.concatenate(([0], np.cumsum(some * bands))).astype(np.int32)
    return [pa.array(np.diff(first).astype(np.int64)), *(C.longs(k) for k in set_keys(values, first)),
            pa.ListArray.from_arrays(pa.array(offsets), C.longs(keys[some].reshape(-1)))]


MEMBERS = "c long, members binary"


def member_batch(values: np.ndarray, first: np.ndarray, wanted: list) -> pa.RecordBatch:
    """Columns MEMBERS of the sets that are among the classes (c, k1, k2) ``wanted`` of their unit; sets as binary."""
    k1, k2 = (k.view(np.int64).tolist() for k in set_keys(values, first))
    found = [(x["c"], n) for n, some in enumerate(wanted) for x in some if (x["k1"], x["k2"]) == (k1[n], k2[n])]
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int64()),
                                       pa.array([values[first[n]:first[n + 1]].tobytes() for _, n in found], pa.binary())], ["c", "members"])


def _sketched(bands: int, rows: int):
    """Sketch and band keys of sets."""
    @C.bounded
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(1)]
                first = np.concatenate(([0], np.cumsum([len(x) for x in sets])))
                signatures = circulant_signatures(np.concatenate(sets), first, max(bands * rows, SKETCH))
                yield pa.RecordBatch.from_arrays([batch.column(0), _lists(sketches(signatures[:SKETCH])), _lists(band_keys(signatures, bands, rows))],
                                                 ["c", "sketch", "bands"])
    return run


def _verify(percent: int):
    @C.bounded
    def run(batches):
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            ok = []
            for x, y in zip(a, b):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate((x, y))
                both.sort()
                same = int((both[1:] == both[:-1]).sum())
                ok.append(100 * same >= percent * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(ok, pa.bool_()))
    return run


@C.bounded


def _each(batches):
    for batch in batches:
        sets = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1)]
        sizes = np.array([len(x) for x in sets])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(np.arange(len(sets)), sizes))),
                                          pa.array(np.concatenate(sets))], ["c", "s"])


#: Words of 64 bits of a filter of ids: 16 million bits, some MB, whatever the ids.
FILTER_WORDS = 1 << 18


def among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The ``rows`` whose ``id`` is among ``ids`` (one column, distinct).

    A bitmap of hashed ids, of fixed size and built by word, drops most other rows where they are read; an exact semi-join
    decides on what is left. So long rows of which few are wanted don't move for being compared. A full bitmap drops none.
    """
    word = f"pmod(shiftright(xxhash64(id), 6), {FILTER_WORDS})"
    bit = "shiftleft(1L, cast(xxhash64(id) & 63 as int))"
    bits = ids.selectExpr(f"{word} AS _word", f"{bit} AS _bit").groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    maybe = rows.join(F.broadcast(bits), F.expr(f"{word} = _word AND (_bits & {bit}) <> 0"), "left_semi")
    return maybe.join(ids, "id", "left_semi")


def near_classes(signed: DataFrame, set_of: Callable[[DataFrame], DataFrame], scratch: C.Scratch,
                 percent: int, bands: int, rows: int, over: str | None = None) -> DataFrame:
    """Classes of equal sets and components of verified near-equal classes.

    ``signed``: ``id`` (not null, any orderable type) and the columns SIGNED (of ``bands`` and ``rows``), one row per unit; rows
    that share an id are one vertex. ``set_of(ids)`` returns the columns MEMBERS (sorted 64-bit shingles) for a table of
    ``id, c, k1, k2``: the set of each class ``c``, that of the rows with the id whose set_keys() are ``k1, k2``.
    Returns ``id, root`` for every id with a set that isn't empty: the least id of its component. ``over``: the table of
    ``scratch`` that ``signed`` is read from, if it may go once it was read.

    * Units with equal sets collapse to one class first (a partial minimum), so a
      hot group of copies is one vertex. Classes are numbered: what moves from then on is a number, not an id.
    * The keys of some bands move at a time, and what isn't shared is left out before the next ones do.
    * In a bucket every class is verified against the bucket's most central class (the one
      with most company in all its buckets): a star, not all pairs.
    * A bucket whose classes then lie in one component is done. In the others, a class needs enough shingles that
      any other open class has too; a group of texts that each differ by their own edits ends here.
    * Only classes that are left then get sketches, from their sets.
    * If buckets are still crowded, each class first meets a few members of its bucket's largest component: most classes
      that belong to a large group join it by that, so the group's other members needn't be met.
    * What is left of a bucket meets in blocks, so a large bucket is spread over tasks; pairs of different
      components whose sketches agree enough are verified. Nothing is capped, and a pair is left out
      only if its classes are linked already, cannot be, or (as with buckets, at a stated chance) differ
      in too many coordinates.
    """
    filled = signed.filter("n_shingles > 0")
    keys = ["k1", "k2", "n_shingles"]
    classes = scratch.save(filled.groupBy(*keys).agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))
                           .withColumn("c", F.monotonically_increasing_id()), "classes")
    member = scratch.save(filled.select("id", *keys).join(classes.select(*keys, "c", "rep"), keys).select("id", "c", "rep"), "member")
    if over:
        scratch.drop(over)
    step = -(-bands // -(-bands // BANDS_MOVED))
    live, parts = None, range(0, bands, step)
    for k in parts:
        cells = classes.select("c", "n_shingles", "k1", F.explode(F.slice("bands", k + 1, step)).alias("cell"))
        shared_cells = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("company")).filter("company > 1")
        some = scratch.save(cells.join(shared_cells, "cell"), f"live-{k}")
        live = some if live is None else live.unionByName(some)
    central = live.groupBy("c").agg(F.sum("company").alias("pull"))
    live = scratch.save(live.drop("company").join(central, "c"), "pulled")
    scratch.drop(*(f"live-{k}" for k in parts))
    hubs = live.groupBy("cell").agg(F.max(F.struct("pull", "k1", "c", "n_shingles")).alias("hub"))
    sets = scratch.save(set_of(classes.join(live.select("c").distinct(), "c").select(F.col("rep").alias("id"), "c", "k1", "k2")), "sets")
    scratch.drop("classes")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        left = sets.select(F.col("c").alias("u"), F.col("members").alias("a"))
        right = sets.select(F.col("c").alias("v"), F.col("members").alias("b"))
        both = pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b")
        with C.small_batches(scratch.spark, 500):
            return scratch.save(both.mapInArrow(_verify(percent), "u long, v long"), name)

    def may(n: Column, m: Column) -> Column:
        return F.least(n, m) * 100 >= F.greatest(n, m) * percent

    first = live.join(hubs, "cell").filter(F.col("c") != F.col("hub.c")).filter(may(F.col("n_shingles"), F.col("hub.n_shingles")))
    links = verified(first.select(F.least("hub.c", "c").alias("u"), F.greatest("hub.c", "c").alias("v")).distinct(), "links-0")
    several = member.groupBy("id").agg(F.min("c").alias("u"), F.max("c").alias("top")).filter("u < top")
    links = links.unionByName(member.join(several, "id").filter("c > u").select("u", F.col("c").alias("v")))
    root = components(links, scratch, "cc-0")

    def mixed(rows: DataFrame) -> DataFrame:
        """Rows of buckets with more than one component left."""
        keep = rows.groupBy("cell").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter(F.col("lo") < F.col("hi")).select("cell")
        return rows.join(keep, "cell")

    def placed(rows: DataFrame) -> DataFrame:
        return rows.drop("root").join(root.withColumnRenamed("id", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))

    open_ = scratch.save(mixed(placed(live)), "open")
    with C.small_batches(scratch.spark, 500):
        each = scratch.save(sets.join(open_.select("c").distinct(), "c").mapInArrow(_each, "c long, s long"), "each")
    common = each.groupBy("s").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("s")
    company = each.join(common, "s").groupBy("c").agg(F.count(F.lit(1)).alias("held"))
    # |x & y| * (100 + percent) >= percent * (|x| + |y|), and |x & y| <= held(x)
    least = open_.groupBy("cell").agg(F.min("n_shingles").alias("smallest"))
    able = open_.join(company, "c").join(least, "cell").filter(
        F.col("held") * (100 + percent) >= (F.col("n_shingles") + F.col("smallest")) * percent).drop("smallest")
    able = scratch.save(mixed(able), "able")
    with C.small_batches(scratch.spark, 500):
        bits = scratch.save(sets.join(able.select("c").distinct(), "c").select("c", "members").dropDuplicates(["c"]).mapInArrow(
            _sketched(bands, rows), "c long, sketch array<long>, bands array<long>"), "bits")
    todo = scratch.save(able.join(bits, "c").withColumn(
        "block", F.floor((F.row_number().over(Window.partitionBy("cell").orderBy("c")) - 1) / F.lit(BLOCK)).cast("int")), "todo")
    scratch.drop("open", "each", "pulled", "able", "bits")
    enough = F.least("held", "p_held") * (100 + percent) >= (F.col("n_shingles") + F.col("p_n")) * percent
    alike = may(F.col("n_shingles"), F.col("p_n")) & enough & may_agree(F.col("sketch"), F.col("p_sketch"), SKETCH, percent)
    crowd = todo.groupBy("cell").agg(F.count(F.lit(1)).cast("double").alias("n")).agg(
        F.sum("n").alias("classes"), F.sum(F.col("n") * F.col("n")).alias("met")).first()
    if (crowd["met"] or 0) > CROWD * (crowd["classes"] or 0):
        top = todo.groupBy("cell", "root").agg(F.count(F.lit(1)).alias("p_size")).groupBy("cell").agg(F.max(F.struct("p_size", "root")).alias("p"))
        split = todo.join(top, "cell")
        seated = split.filter(F.col("root") == F.col("p.root")).select(
            "cell", (F.row_number().over(Window.partitionBy("cell").orderBy(F.xxhash64("k1"), "c")) - 1).cast("long").alias("seat"),
            F.col("c").alias("u"), F.col("n_shingles").alias("p_n"), F.col("held").alias("p_held"), F.col("sketch").alias("p_sketch"))
        seats = F.transform(F.sequence(F.lit(0), F.least(F.lit(SEATS), F.col("p.p_size").cast("int")) - 1),
                            lambda k: F.pmod(F.pmod(F.xxhash64("k1"), F.col("p.p_size")) + k, F.col("p.p_size")))
        met = split.filter(F.col("root") != F.col("p.root")).withColumn("seat", F.explode(seats)).join(seated, ["cell", "seat"])
        more = verified(met.filter(alike).select(F.least("u", "c").alias("u"), F.greatest("u", "c").alias("v")).distinct(), "links-seats")
        if not more.isEmpty():
            root = components(root.select(F.col("id").alias("u"), F.col("root").alias("v")).unionByName(more), scratch, "cc-seats")
            todo = scratch.save(mixed(placed(todo)), "todo-seats")
    pivots = todo.select("cell", "block", F.col("c").alias("u"), F.col("root").alias("p_root"),
                         F.col("n_shingles").alias("p_n"), F.col("held").alias("p_held"), F.col("sketch").alias("p_sketch"), F.col("bands").alias("p_bands"))
    # a pair that shares several buckets is handled in the least of them
    least = F.col("cell") == F.array_min(F.array_intersect("bands", "p_bands"))
    met = todo.withColumn("block", F.explode(F.sequence(F.lit(0), "block"))).join(pivots, ["cell", "block"])
    pairs = met.filter("c > u and root <> p_root").filter(alike & least) \
        .select("u", F.col("c").alias("v")).distinct()
    more = verified(pairs, "links-1")
    if not more.isEmpty():
        root = components(root.select(F.col("id").alias("u"), F.col("root").alias("v")).unionByName(more), scratch, "cc-1")
    scratch.drop("sets", "todo", "todo-seats")
    linked = root.select(F.col("id").alias("c"), "root").unionByName(root.select(F.col("root").alias("c"), "root").distinct())
    firsts = linked.join(member, "c").groupBy("root").agg(F.min("id").alias("first"))
    return member.join(linked.join(firsts, "root").select("c", "first"), "c", "left") \
        .select("id", F.coalesce("first", "rep").alias("root")).distinct()
