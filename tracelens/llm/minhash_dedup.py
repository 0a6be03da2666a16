"""Near-duplicate groups: SuperMinHash signatures, banding, full verification, union-find.

1. Each text's distinct word shingles give a SuperMinHash signature: every shingle
   deals the ranks 0, 1, 2, ... to the slots in the order of its own random
   permutation, each rank plus a uniform draw; a slot keeps its smallest value.
   All shingles of a text advance rank by rank, so a text stops as soon as every
   slot has a value: later ranks are larger than anything in the signature.
2. Texts with equal shingle sets are one class from here on.
3. Classes that agree on a whole band meet in a bucket.  Every member of a bucket
   is verified on the full shingle sets against the bucket's pivot, its smallest
   class; a pair that meets in several buckets is verified once.  The links found
   are joined to provisional groups.
4. What a bucket leaves open are pairs of members that are not yet in one group.
   Such a bucket is dealt into blocks, a large provisional group into blocks of
   its own; each pair of blocks, but those of one large group, is one task group
   of bounded size, which returns a spanning forest of its links instead of all
   pairs.  A group of copies that are near their pivot thus costs one comparison
   per class and bucket, whatever its size.
5. Union-find over the links between provisional groups gives the groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracelens.llm import text as tx
from tracelens.llm.graph import components
from tracelens.llm.store import columns_first, table

U = np.uint64


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, hashes, offsets): each text's sorted distinct shingles.

    A text of fewer than ``k`` words, but at least one, has one shingle: all its words.
    """
    is_word, lower = tx.space_words(), tx.lower_ascii()
    for lo, hi, buf, offsets in tx.blocks(column):
        buf = lower[buf]
        starts, ends, first = tx.words(buf, offsets, is_word)
        h = tx.hash_words(buf, starts, ends)
        doc = np.repeat(np.arange(hi - lo), np.diff(first))
        gram = np.zeros(0, dtype=np.uint64)
        owner = np.zeros(0, dtype=np.int64)
        if len(h) >= k:
            inside = tx.inside_mask(first, k)[:len(h) - k + 1]
            gram, owner = tx.hash_grams(h, k)[inside], doc[:len(h) - k + 1][inside]
        n = np.diff(first)
        short = np.flatnonzero((n > 0) & (n < k))
        if len(short):
            whole = [tx.hash_grams(h[first[d]:first[d + 1]], int(n[d]))[0] + U(n[d]) for d in short]
            gram = np.concatenate([gram, np.array(whole, dtype=np.uint64)])
            owner = np.concatenate([owner, short])
        order = np.lexsort((gram, owner))
        gram, owner = gram[order], owner[order]
        if len(gram):
            new = np.ones(len(gram), dtype=bool)
            new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
            gram, owner = gram[new], owner[new]
        yield lo, hi, gram, np.searchsorted(owner, np.arange(hi - lo + 1))


def superminhash(gram: np.ndarray, offsets: np.ndarray, slots: int, seed: int) -> np.ndarray:
    """One row of ``slots`` values per text (infinite for an empty set)."""
    n = len(offsets) - 1
    signature = np.full((n, slots), np.inf)
    flat = signature.reshape(-1)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    g, chosen, deal = gram, [], None
    for rank in range(slots):
        if not len(g):
            break
        draw = tx.mix(g + U((seed + rank * 0x9E3779B97F4A7C15) & (2**64 - 1)))
        value = rank + (draw >> U(11)).astype(np.float64) * 2.0**-53
        k = rank + ((tx.mix(draw) >> U(32)) * U(slots - rank) >> U(32)).astype(np.int64)
        if deal is None:
            # The slot at place k after the earlier swaps, traced back through them.
            slot = k
            for i in range(rank - 1, -1, -1):
                slot = np.where(slot == chosen[i], i, slot)
            chosen.append(k)
        else:
            rows = np.arange(len(g))
            slot = deal[rows, k].astype(np.int64)
            deal[rows, k] = deal[rows, rank]
        np.minimum.at(flat, doc * slots + slot, value)
        open_doc = np.isinf(signature).any(axis=1)
        keep = open_doc[doc]
        if not keep.all():
            g, doc = g[keep], doc[keep]
            chosen = [c[keep] for c in chosen]
            deal = deal[keep] if deal is not None else None
        if rank == 5 and deal is None and len(g):
            # Few texts are still open (short ones): keep their permutations outright.
            deal = np.tile(np.arange(slots, dtype=np.int32), (len(g), 1))
            rows = np.arange(len(g))
            for i, c in enumerate(chosen):
                swap = deal[rows, c]
                deal[rows, c] = deal[rows, i]
                deal[rows, i] = swap
            chosen = []
    return signature


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per text and band."""
    n, slots = signature.shape
    values = signature.view(np.uint64).reshape(n, bands, slots // bands)
    key = np.zeros((n, bands), dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * U(0x9E3779B97F4A7C15)
    for j in range(values.shape[2]):
        key = tx.mix(key * U(0xD1342543DE82EF95) + values[:, :, j])
    return key


def _sketches(k: int, bands: int, rows: int, seed: int):
    import hashlib

    def run(batches):
        for batch in batches:
            for lo, hi, gram, offsets in shingle_sets(batch.column("text"), k):
                n = np.diff(offsets)
                keys = band_keys(superminhash(gram, offsets, bands * rows, seed), bands).astype(np.int64)
                digest = [hashlib.blake2b(gram[a:b].tobytes(), digest_size=16).digest() if b > a else None
                          for a, b in zip(offsets[:-1], offsets[1:])]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(hi - lo + 1, dtype=np.int32) * bands), pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, hi - lo), pa.array(n.astype(np.int64)),
                     pa.array(digest, pa.binary()), lists], names=["id", "n", "digest", "bands"])
    return run


def linked(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs with a Jaccard similarity of ``percent`` % or more."""
    n = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.ones(len(every), dtype=bool)
    new[1:] = every[1:] != every[:-1]
    column = np.cumsum(new) - 1
    shared = np.bincount(column) > 1  # a shingle of one text meets nothing
    keep = shared[column]
    column, owner = (np.cumsum(shared) - 1)[column[keep]], owner[keep]
    common = np.zeros((n, n), dtype=np.float32)
    width = max(64, min(int(shared.sum()), (1 << 22) // n))  # columns of the 0/1 matrix held at once
    for lo in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [lo, lo + width])
        part = np.zeros((n, width), dtype=np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        common += part @ part.T
    both = np.rint(common).astype(np.int64)
    near = 100 * both >= percent * (size[:, None] + size[None, :] - both)
    np.fill_diagonal(near, True)
    label = np.arange(n)
    while True:
        least = np.where(near, label[None, :], n).min(axis=1)
        if (least == label).all():
            return [(i, int(label[i])) for i in range(n) if label[i] != i]
        label = least


def _verify(k: int, percent: int):
    def run(batches):
        key, ids, sets, seen = None, [], [], set()  # seen: sets of the last id, whose rows follow each other

        def links():
            if len(ids) < 2:
                return None
            found = linked(sets, percent)
            return pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i, _ in found], pa.int64()), pa.array([ids[j] for _, j in found], pa.int64())],
                names=["a", "b"]) if found else None

        for batch in batches:
            keys = list(zip(batch.column("band").to_pylist(), batch.column("part").to_pylist()))
            own = batch.column("id").to_pylist()
            for lo, hi, gram, offsets in shingle_sets(batch.column("text"), k):
                for i in range(lo, hi):
                    if keys[i] != key:
                        if (out := links()) is not None:
                            yield out
                        key, ids, sets = keys[i], [], []
                    found = gram[offsets[i - lo]:offsets[i - lo + 1]]
                    if not ids or ids[-1] != own[i]:
                        seen = set()
                    elif found.tobytes() in seen:
                        continue  # a repeated row
                    seen.add(found.tobytes())
                    ids.append(own[i])
                    sets.append(found.copy())
        if (out := links()) is not None:
            yield out
    return run


def _against_pivot(k: int, percent: int):
    """Links of the members of each (hub, part) to the pivot, whose rows come first; only its sets are held.

    A pivot has several sets only if its id is repeated with different texts.
    """
    def run(batches):
        key, pivots = None, {}
        for batch in batches:
            keys = list(zip(batch.column("hub").to_pylist(), batch.column("part").to_pylist()))
            own = batch.column("id").to_pylist()
            a, b = [], []
            for lo, hi, gram, offsets in shingle_sets(batch.column("text"), k):
                for i in range(lo, hi):
                    found = gram[offsets[i - lo]:offsets[i - lo + 1]]
                    if keys[i] != key:
                        key, pivots = keys[i], {}
                    if own[i] == key[0]:
                        pivots[found.tobytes()] = found.copy()
                        continue
                    for pivot in pivots.values():
                        both = len(np.intersect1d(pivot, found, assume_unique=True))
                        if both and 100 * both >= percent * (len(pivot) + len(found) - both):
                            a.append(own[i])
                            b.append(key[0])
                            break
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def _pivot_pairs(near: DataFrame, block: int) -> DataFrame:
    """(id, hub, part): the classes ``a`` of each pivot ``b``, dealt into parts of about ``block``, the pivot in each."""
    star = near.select("a", F.col("b").alias("hub"))
    hubs = star.groupBy("hub").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("parts"))
    members = star.join(hubs, "hub").select(
        F.col("a").alias("id"), "hub", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"))
    return members.unionByName(hubs.select(
        F.col("hub").alias("id"), "hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))


def _open_pairs(mates: DataFrame, joined: DataFrame, block: int) -> DataFrame:
    """(id, band, part): the classes of buckets with open pairs, in pairs of blocks; part names the two.

    ``mates``: (band, a) of the members of each bucket but its pivot, each once, ``joined``: (node, component)
    of provisional groups.  A group of more than ``block`` members has blocks of its own, which
    are not paired with each other; smaller groups share the bucket's first blocks.  A bucket of
    one group has nothing open; of buckets with the same members one is enough.
    """
    member = mates.select("band", F.col("a").alias("node")) \
        .join(joined.withColumnRenamed("component", "group"), "node", "left") \
        .select("node", "band", F.coalesce("group", "node").alias("group"))
    n_blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    is_large = F.col("n") > block
    groups = member.groupBy("band", "group").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"))
    whole = groups.groupBy("band").agg(
        F.ceil(F.sum(F.when(is_large, 0).otherwise(F.col("n"))) / F.lit(block)).cast("int").alias("shared"),
        F.sum(F.when(is_large, n_blocks).otherwise(0)).cast("int").alias("owned"),
        F.count("*").alias("groups"), F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")) \
        .where("groups > 1").groupBy("n", "x", "y", "shared", "owned").agg(F.min("band").alias("band")) \
        .select("band", "shared", "owned")
    earlier = Window.partitionBy("band").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    large = groups.where(is_large).select("band", "group", n_blocks.alias("blocks")) \
        .withColumn("before", F.coalesce(F.sum("blocks").over(earlier), F.lit(0)).cast("int"))

    def numbers(lo, hi):
        return F.when(lo < hi, F.sequence(lo, hi - 1)).otherwise(F.array().cast("array<int>"))

    zero, total, first = F.lit(0), F.col("shared") + F.col("owned"), F.col("shared") + F.col("before")
    dealt = member.join(whole, "band").join(large, ["band", "group"], "left").select(
        F.col("node").alias("id"), "band",
        (F.coalesce(first, zero) + F.pmod(F.xxhash64("node"), F.coalesce("blocks", "shared"))).cast("int").alias("own"),
        F.explode(F.when(F.col("blocks").isNull(), numbers(zero, total))
                  .otherwise(F.concat(numbers(zero, first), numbers(first + F.col("blocks"), total)))).alias("other"))
    return dealt.select("id", "band", F.concat_ws("-", F.least("own", "other"), F.greatest("own", "other")).alias("part"))


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = 5, percent: int = 75, bands: int = 40, rows: int = 5, block: int = 512,
                    seed: int = 20240229) -> DataFrame:
    """Groups of near-duplicates: (id, n_shingles, component_id, kept) for every row of ``docs``.

    Two texts are linked when 100 * |A and B| >= ``percent`` * |A or B| over their
    sets of ``k``-word shingles (A-Z lower-cased, words split at ASCII white space);
    links are confirmed on full sets (64-bit shingle hashes).  A pair at exactly the
    threshold shares no band with probability (1 - s**rows)**bands, 2e-5 for the
    defaults, and is then still in one group if other texts link them.

    Null or empty text, or one without words: an empty set, linked with nothing,
    its own component.  Ids are whole numbers (cast to long; text that is none is an error).
    Null id: never linked; component_id null and kept true.
    Repeated rows of one id: the same component for each.  Other columns are
    ignored.  An empty table gives no rows.

    A hot bucket costs one row and one comparison per member, what it leaves open is cut into
    blocks of about ``block`` classes; a task holds the sets of two blocks.
    """
    rows_in = columns_first(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    sketch = table(spark, rows_in.mapInArrow(
        _sketches(k, bands, rows, seed), "id long, n long, digest binary, bands array<long>"), "minhash")
    # All of a class share the bands, so any member's do; the smallest id stands for the class.
    classes = sketch.where("id is not null and digest is not null") \
        .groupBy("digest").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))
    class_of, reps = classes.select("digest", "rep"), classes.select("rep", "bands")
    buckets = table(spark, reps.select("rep", F.explode("bands").alias("band")), "minhash-bands")
    hubs = buckets.groupBy("band").agg(F.min("rep").alias("hub"), F.max("rep").alias("top")) \
        .where("hub <> top").drop("top")
    # An id with several texts stands for several classes, and may meet a bucket through each: it counts once.
    mates = table(spark, buckets.join(hubs, "band").where("rep <> hub")
                  .select("band", F.col("rep").alias("a"), F.col("hub").alias("b")).distinct(), "minhash-mates")

    # The same joins at every size: texts are dealt by id rather than the ids copied to all tasks.
    texts = rows_in.where("id is not null and text is not null").hint("merge")
    beside = texts.join(_pivot_pairs(mates.select("a", "b").distinct(), block), "id") \
        .repartition("hub", "part").sortWithinPartitions("hub", "part", F.col("id") != F.col("hub"), "id")
    stars = table(spark, beside.mapInArrow(_against_pivot(k, percent), "a long, b long"), "minhash-stars")
    joined = table(spark, components(spark, stars, "minhash-star-links"), "minhash-joined")
    dealt = texts.join(_open_pairs(mates, joined, block), "id") \
        .repartition("band", "part").sortWithinPartitions("band", "part", "id")
    links = table(spark, dealt.mapInArrow(_verify(k, percent), "a long, b long"), "minhash-links")
    # From here a provisional group counts as its smallest class, so its own links are not followed again.
    between = links
    for end in ("a", "b"):
        between = between.join(joined.select(F.col("node").alias(end), F.col("component").alias("to")), end, "left") \
            .withColumn(end, F.coalesce("to", end)).drop("to")
    groups = components(spark, between.where("a <> b").distinct(), "minhash-components")

    of_class = class_of.join(joined, class_of["rep"] == joined["node"], "left") \
        .select("digest", F.coalesce("component", "rep").alias("first")) \
        .join(groups, F.col("first") == groups["node"], "left") \
        .select("digest", F.coalesce("component", "first").alias("component"))
    found = sketch.select("id", "n", "digest").join(of_class, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return found.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep_one_per_group(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each group, the one with the smallest id.

    Rows without an id stay.  Columns are those of ``docs``.
    """
    groups = near_duplicates(spark, docs, id_col, text_col, **options)
    gone = groups.where("not kept").select(F.col(id_col).alias("__gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
