"""Near-duplicate groups by SimHash and covering locality-sensitive hashing.

1. A text's fingerprint has the majority bits of the XXH64 values of its word shingles.
   Equal fingerprints are one class from here on.
2. Covering masks: every bit place gets a nonzero vector of ``radius`` + 1 bits, and every
   nonzero vector v of that length a mask, the places whose vector has an odd product
   with v.  At most ``radius`` vectors never span the whole space, so some v is orthogonal
   to all places in which two near fingerprints differ: they agree on its mask.  The
   2**(radius + 1) - 1 tables therefore miss no pair, whatever the fingerprints.
3. In each bucket (table, masked value) every class is compared with the bucket's pivot,
   one of its classes by hash; the links are joined to provisional groups.
4. A bucket whose classes are in several groups then compares every class outside its
   largest group with all its classes, in blocks of bounded size, and returns links
   between groups that form a forest, not all pairs.
5. Union-find over those links gives the groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelens.llm import text as tx
from tracelens.llm.graph import components
from tracelens.llm.store import columns_first, table

BITS = 64
SLICE = 1 << 17  # shingles whose bits are counted at once
PAIRS = 1 << 20  # pairs compared at once


def covering_masks(radius: int) -> list[int]:
    """The masks of all tables as signed 64-bit numbers."""
    size = (1 << (radius + 1)) - 1
    vector = [1 + place % size for place in range(BITS)]
    masks = [sum(1 << place for place in range(BITS) if (vector[place] & v).bit_count() % 2) for v in range(1, size + 1)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def shingle_hashes(texts: list[bytes], k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle, repeats included, and the first shingle of each text (one more at the end)."""
    from xxhash import xxh64_intdigest

    pieces: list[bytes] = []
    first, number = np.zeros(len(texts) + 1, dtype=np.int64), np.zeros(len(texts) + 1, dtype=np.int64)
    for i, t in enumerate(texts):
        own = t.lower().split()  # both concern ASCII bytes only
        pieces += own
        first[i + 1] = len(pieces)
        number[i + 1] = max(len(own) - k + 1, min(len(own), 1))
    number = np.cumsum(number)
    joined = b" ".join(pieces)
    size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    end = np.cumsum(size + 1) - 1
    # Shingle j of a text with first word f covers words f + j .. f + j + k - 1, but none past the text.
    text = np.repeat(np.arange(len(texts)), np.diff(number))
    begin = first[text] + np.arange(len(text)) - number[text]
    last = np.minimum(begin + k, first[text + 1]) - 1
    spans = map(slice, (end[begin] - size[begin]).tolist(), end[last].tolist())
    return np.fromiter(map(xxh64_intdigest, map(joined.__getitem__, spans), repeat(seed)),
                       dtype=np.uint64, count=len(text)), number


def fingerprints(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Bits that over half of a text's values have set; zero for a text without values."""
    count = np.zeros((len(first) - 1, BITS), dtype=np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for lo in range(0, len(hashes), SLICE):
        own = text[lo:lo + SLICE]
        bits = np.unpackbits(hashes[lo:lo + SLICE, None].view(np.uint8), axis=1, bitorder="little")
        at = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        count[own[at]] += np.add.reduceat(bits, at, axis=0, dtype=np.int64)
    return np.packbits(2 * count > np.diff(first)[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]


def _sketch(k: int, seed: int):
    def run(batches):
        for batch in batches:
            for lo, hi, buf, offsets in tx.blocks(batch.column("text")):
                data = buf.tobytes()
                texts = [data[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                values = fingerprints(*shingle_hashes(texts, k, seed))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, hi - lo), pa.array(values.astype(np.int64))], names=["id", "fp"])
    return run


def linked_groups(own: np.ndarray, own_group: np.ndarray, every: np.ndarray, every_group: np.ndarray,
                  radius: int) -> Iterator[tuple[int, int]]:
    """Forest of the links between groups, from comparing all ``own`` with all ``every`` fingerprints."""
    root: dict[int, int] = {}

    def find(g: int) -> int:
        while (up := root.get(g, g)) != g:
            root[g] = root.get(up, up)
            g = up
        return g

    rows = max(1, PAIRS // max(1, len(every)))
    for lo in range(0, len(own), rows):
        near = np.bitwise_count(own[lo:lo + rows, None] ^ every[None, :]) <= radius
        near &= own_group[lo:lo + rows, None] != every_group[None, :]
        a, b = np.nonzero(near)
        for x, y in np.unique(np.stack([own_group[lo + a], every_group[b]], axis=1), axis=0).tolist():
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
                yield x, y


def _compare(radius: int):
    """Links between groups; input sorted by bucket and part, each holding asking and asked classes."""
    def run(batches):
        key, held = None, {True: [], False: []}

        def links():
            a, b = (np.array(held[kind], dtype=np.int64).reshape(-1, 2) for kind in (True, False))
            found = list(linked_groups(a[:, 0].view(np.uint64), a[:, 1], b[:, 0].view(np.uint64), b[:, 1], radius))
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)],
                                              names=["a", "b"])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("bucket", "part", "asks", "fp", "group"))
            for bucket, part, asks, fp, group in zip(*columns):
                if (bucket, part) != key:
                    if key is not None:
                        yield links()
                    key, held = (bucket, part), {True: [], False: []}
                held[asks].append((fp, group))
        if key is not None:
            yield links()
    return run


def _open_parts(member: DataFrame, block: int) -> DataFrame:
    """(bucket, part, asks, fp, group): the comparisons that are left, from (bucket, fp, group) of all members.

    Asking are the classes outside the bucket's largest group, asked are all its classes; each
    side is dealt into blocks of about ``block``, and a part is one block of each.
    """
    groups = member.groupBy("bucket", "group").agg(F.count("*").alias("n"))
    whole = groups.groupBy("bucket").agg(F.max_by("group", F.struct("n", "group")).alias("largest"),
                                         F.max("n").alias("most"), F.sum("n").alias("n")) \
        .where("n > 2 and most < n").select(  # two classes have been compared: one of them was the pivot
            "bucket", "largest", F.ceil((F.col("n") - F.col("most")) / F.lit(block)).cast("int").alias("asking"),
            F.ceil(F.col("n") / F.lit(block)).cast("int").alias("asked"))
    dealt = member.join(whole, "bucket")

    def numbers(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    ask = dealt.where(F.col("group") != F.col("largest")).select(
        "bucket", "fp", "group", F.pmod(F.xxhash64("fp"), "asking").cast("int").alias("own"),
        numbers("asked").alias("other"), F.lit(True).alias("asks"))
    answer = dealt.select(
        "bucket", "fp", "group", numbers("asking").alias("own"),
        F.pmod(F.xxhash64("fp"), "asked").cast("int").alias("other"), F.lit(False).alias("asks"))
    return ask.unionByName(answer).select("bucket", F.concat_ws("-", "own", "other").alias("part"), "asks", "fp", "group")


def near_fingerprints(spark: SparkSession, classes: DataFrame, radius: int = 3, block: int = 4096) -> DataFrame:
    """(fp, component): the smallest fingerprint reachable from each of the distinct ones in ``classes`` (fp: long).

    Two fingerprints are linked when they differ in at most ``radius`` bits.  Exact: every such
    pair meets in a bucket, and there it is compared or already in one group.
    """
    masked = [F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("v"))
              for i, m in enumerate(covering_masks(radius))]
    buckets = table(spark, classes.select("fp", F.explode(F.array(*masked)).alias("bucket")), "simhash-buckets")
    pivots = buckets.groupBy("bucket").agg(
        F.min_by("fp", F.xxhash64("fp", "bucket.t")).alias("pivot"), F.count("*").alias("n")).where("n > 1").drop("n")
    mates = table(spark, buckets.join(pivots, "bucket"), "simhash-mates")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("pivot"))) <= radius
    stars = mates.where(near & (F.col("fp") != F.col("pivot"))).select(F.col("fp").alias("a"), F.col("pivot").alias("b"))
    joined = table(spark, components(spark, stars.distinct(), "simhash-star-links"), "simhash-joined")

    member = mates.select("bucket", "fp").join(joined, mates["fp"] == joined["node"], "left") \
        .select("bucket", "fp", F.coalesce("component", "fp").alias("group"))
    parts = _open_parts(member, block).repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    links = table(spark, parts.mapInArrow(_compare(radius), "a long, b long"), "simhash-links")
    groups = components(spark, links, "simhash-components")
    return classes.select("fp").join(joined, classes["fp"] == joined["node"], "left") \
        .select("fp", F.coalesce("component", "fp").alias("group")) \
        .join(groups.withColumnRenamed("component", "least"), F.col("group") == groups["node"], "left") \
        .select("fp", F.coalesce("least", "group").alias("component"))


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = 3, radius: int = 3, seed: int = 42, block: int = 4096) -> DataFrame:
    r"""Groups of near-duplicates: (id, fingerprint, component_id) for every row of ``docs``.

    A-Z are lower-cased, words are ``[^\x20\x09-\x0D]+``; a text of fewer than ``k`` words has
    one shingle, all its words joined by one space.  Two texts are linked when their
    fingerprints (16 hexadecimal digits) differ in at most ``radius`` bits; ``component_id`` is
    the smallest id reachable, its own included.

    Null, empty or blank text: fingerprint zero, linked like any other.  Null id: has a
    fingerprint and a component, which it neither names nor, being no id, can be the smallest of;
    a component without any id has a null one.  Repeated rows: the same result for each.
    Ids are of type long.  Other columns are ignored.  An empty table gives no rows.

    Copies count once: a class costs 2**(radius + 1) - 1 slim rows, and a bucket one comparison
    a class, whatever its size, but for the classes outside its largest group.
    """
    rows = columns_first(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"),
                                                                F.col("text").cast("string").alias("text"))
    sketch = table(spark, rows.mapInArrow(_sketch(k, seed), "id long, fp long"), "simhash")
    classes = table(spark, sketch.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-classes")
    found = near_fingerprints(spark, classes, radius, block)
    named = found.join(classes, "fp").select("fp", "component", "rep")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of = table(spark, named.join(least, "component").select("fp", "component_id"), "simhash-named")
    return sketch.join(of, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
