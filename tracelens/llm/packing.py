"""Packing of tokenised texts into fixed-length sequences by their length histogram.

Shortest-pack-first: lengths are placed from the longest to the shortest, all texts
of a length at once; each goes to the open pack with the most room, and the counts
of packing patterns are updated.  Only the histogram (at most one counter per
length) reaches the driver.  Texts then take the places of their length by rank.
"""

from __future__ import annotations

import heapq
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracelens.llm import tokens
from tracelens.llm.store import columns_first, table

RANK_ROWS = 100_000  # pieces of one length that are ranked together
RANK_LIMIT = 1 << 48  # above any rank: (length, rank) pairs are searched as one number


def patterns(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths in order, how many packs) that hold every piece of the histogram once.

    Every length is between 1 and ``size``.  Each length splits at most one pattern, so
    there are at most about twice as many patterns as lengths.
    """
    open_packs: list[tuple[int, int, tuple[int, ...], int]] = []  # (-room, order, lengths, packs)
    order = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            if not open_packs or -open_packs[0][0] < length:
                # No pack has room: new ones, each filled with as many of this length as fit.
                fit = size // length
                full, rest = divmod(left, fit)
                for packs, times in ((full, fit), (1 if rest else 0, rest)):
                    if packs:
                        order += 1
                        heapq.heappush(open_packs, (times * length - size, order, (length,) * times, packs))
                left = 0
                continue
            room, _, lengths, packs = heapq.heappop(open_packs)
            room = -room
            used = min(left, packs)
            order += 1
            heapq.heappush(open_packs, (length - room, order, lengths + (length,), used))
            if used < packs:
                order += 1
                heapq.heappush(open_packs, (-room, order, lengths, packs - used))
            left -= used
    return [(lengths, packs) for _, _, lengths, packs in sorted(open_packs, key=lambda p: p[1])]


def places(found: list[tuple[tuple[int, ...], int]]) -> SimpleNamespace:
    """The patterns as a table of places, sorted by (length, first rank).

    The pieces of ``length`` with rank ``rank`` .. ``rank`` + packs - 1 are at ``offset`` in
    sequences ``sequence``, ``sequence`` + 1, ...
    """
    rows, next_rank, sequence = [], {}, 0
    for lengths, packs in found:
        offset = 0
        for length in lengths:
            rank = next_rank.get(length, 0)
            rows.append((length, rank, sequence, offset))
            next_rank[length] = rank + packs
            offset += length
        sequence += packs
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 4).T
    return SimpleNamespace(length=columns[0], rank=columns[1], sequence=columns[2], offset=columns[3])


def _pieces(where: SimpleNamespace, size: int, end_id: int):
    def run(batches):
        encode = tokens.encoder(where)
        for batch in batches:
            source, out = [], {"start": [], "length": [], "ids_crc32": [], "doc_tokens": []}
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = [*encode(text or ""), end_id]
                data = tokens.pack_ids(ids, "<u4")
                for start in range(0, len(ids), size):
                    source.append(i)
                    out["start"].append(start)
                    out["length"].append(min(size, len(ids) - start))
                    out["ids_crc32"].append(zlib.crc32(data[4 * start:4 * (start + size)]))
                    out["doc_tokens"].append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(source, pa.int64()))]
                + [pa.array(v, pa.int64()) for v in out.values()], names=["id", *out])
    return run


def _place(where):
    def run(batches):
        at = where.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            # The last place of this length that starts at or before the rank.
            first, last = np.searchsorted(at.length, length, "left"), np.searchsorted(at.length, length, "right")
            row = np.searchsorted(at.length * RANK_LIMIT + at.rank, length * RANK_LIMIT + rank, "right") - 1
            assert ((row >= first) & (row < last)).all(), "a piece has no place"
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names if c != "rank"]
                + [pa.array(at.sequence[row] + rank - at.rank[row]), pa.array(at.offset[row])],
                names=[c for c in names if c != "rank"] + ["sequence_id", "offset"])
    return run


def pack(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 2048,
         end_id: int = 1, where: SimpleNamespace | None = None) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece of every row of ``docs``.

    A text's ids and ``end_id`` are cut every ``size`` ids; a piece is its ids ``start`` ..
    ``start`` + ``length`` - 1, at ``offset`` in sequence ``sequence_id``.  Sequences are numbered
    from 0 without gaps and hold at most ``size`` ids; their pieces leave no gap.

    Null text: empty, so ``end_id`` alone.  Null and repeated ids are passed through; each row is
    a text of its own.  Other columns are ignored.  An empty table gives no rows.  Equal lengths
    are told apart by id, start and checksum; which of two equal pieces comes first is immaterial.

    Pieces of one length are ranked in groups of about ``RANK_ROWS``, so a length that very many
    texts share is spread over tasks.
    """
    where = where or tokens.vocabulary()
    rows = columns_first(docs, id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    schema = "id " + rows.schema["id"].dataType.simpleString() \
        + ", start long, length long, ids_crc32 long, doc_tokens long"
    pieces = table(spark, rows.mapInArrow(_pieces(where, size, end_id), schema), "pack-pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not histogram:
        return pieces.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
                             F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    spot = places(patterns(histogram, size))

    parts = F.element_at(F.array(*[F.lit(-(-histogram.get(i + 1, 1) // RANK_ROWS)) for i in range(size)]),
                         F.col("length").cast("int"))
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("id", "start", "ids_crc32"), parts).cast("int"))
    own = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("length", "part").agg(F.count("*").alias("n")) \
        .select("length", "part", F.coalesce(F.sum("n").over(own), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("length", "part").orderBy("id", "start", "ids_crc32")) - 1
    ranked = dealt.withColumn("own", rank).join(before, ["length", "part"]) \
        .select("id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("own")).alias("rank"))
    placed = ranked.mapInArrow(_place(spark.sparkContext.broadcast(spot)), schema + ", sequence_id long, offset long")
    return placed.withColumnRenamed("id", id_col) if id_col != "id" else placed
