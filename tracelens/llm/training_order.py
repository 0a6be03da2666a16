"""Training order on disk: a keyed permutation gives every sequence its slot in fixed-stride shards.

Texts are tokenised, once, and cut into sequences of at most ``stride`` ids.  A sequence is
known by its row's number in the input files, taken by name, and its own number in the row; how
Spark splits the files plays no part.  A Feistel network on the smallest even number of bits
that holds all such pairs, walked along its cycle until the value is one of them, permutes the
pairs: no table is needed, any task can evaluate it, and one key over the same files reproduces it.
Slots follow the permuted positions.  A shard holds a range of positions, so one shuffle brings
each sequence to its shard, where sorting gives its record; the shards' counts, one number each,
then give the global slots.  All records have the same size, so a reader finds any slot by
arithmetic and resumes anywhere.
"""

from __future__ import annotations

import json
import posixpath
import zlib
from contextlib import ExitStack
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelens.llm import tokens
from tracelens.llm.files import whole_file
from tracelens.llm.store import columns_first, table
from tracelens.llm.text import U, mix

ROUNDS = 6
PIECE_BITS = 22  # sequences of one row
SHARD_BYTES = 64 << 20  # of input files behind one shard, and the share of 16 shards at the least
LEAST_BYTES = 1 << 20


def positions(index: np.ndarray, domain: int, key: int) -> np.ndarray:
    """The position of each index below ``domain``: a permutation of 0 .. ``domain`` - 1."""
    half = max(1, ((domain - 1).bit_length() + 1) // 2)
    mask = U((1 << half) - 1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15) + U(key & (2**64 - 1)))

    def network(x):
        left, right = x >> U(half), x & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        return (left << U(half)) | right

    out = network(index.astype(np.uint64))
    while len(far := np.flatnonzero(out >= U(domain))):
        out[far] = network(out[far])
    return out.astype(np.int64)


def _sequences(where, stride, end_id, kind, key, domain, width, offsets):
    size = np.dtype(kind).itemsize

    def run(batches):
        encode = tokens.encoder(where)
        for batch in batches:
            source, start, ids, index = [], [], [], []
            rows = zip(batch.column("text").to_pylist(), batch.column("file").to_pylist(), batch.column("row").to_pylist())
            for i, (text, file, row) in enumerate(rows):
                own = [*encode(text or ""), end_id]
                data, cuts = tokens.pack_ids(own, kind), range(0, len(own), stride)
                if len(cuts) >> PIECE_BITS:
                    raise ValueError(f"a text has more than {1 << PIECE_BITS} sequences: raise stride")
                source += [i] * len(cuts)
                start += cuts
                ids += [data[size * s:size * (s + stride)] for s in cuts]
                first = (offsets.value[file] + row) << PIECE_BITS
                index += range(first, first + len(cuts))
            position = positions(np.array(index, dtype=np.int64), domain, key)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(source, pa.int64())), pa.array(start, pa.int64()),
                 pa.array(position), pa.array((position // width).astype(np.int32)), pa.array(ids, pa.binary())],
                names=["id", "start", "position", "shard", "ids"])
    return run


def _numbered(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, dict[str, int], int, int]:
    """(id, text, file, row) of every row; the first row number of each file, by name; all rows; bytes of the files.

    Rows that do not come straight from files with row numbers (Parquet) are written to such files first.
    """
    def columns(df: DataFrame, id_name: str, text_name: str) -> DataFrame:
        return df.select(df[id_name].alias("id"), df[text_name].cast("string").alias("text"),
                         F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                         F.col("_metadata.row_index").alias("row"))

    try:
        rows = columns(docs, id_col, text_col)
    except AnalysisException:
        rows = columns(table(spark, columns_first(docs, id=id_col, text=text_col), "training-order-rows"), "id", "text")
    files = rows.groupBy("file").agg(F.max("row").alias("last"), F.max("size").alias("size")).orderBy("file").collect()
    offsets, n = {}, 0
    for f in files:
        offsets[f["file"]] = n
        n += f["last"] + 1
    return rows.drop("size"), offsets, n, sum(f["size"] for f in files)


def _shards(folder, stride, kind, pad_id):
    size = np.dtype(kind).itemsize
    filling = np.full(stride, pad_id, dtype=kind).tobytes()

    def rows(batch, lo, hi, record, out):
        crc, length = [], []
        for data in batch.column("ids").slice(lo, hi - lo).to_pylist():
            out.write(data + filling[len(data):])
            length.append(len(data) // size)
            crc.append(zlib.crc32(np.frombuffer(data, dtype=kind).astype("<u4").tobytes()))
        own = batch.slice(lo, hi - lo)
        return pa.RecordBatch.from_arrays(
            [own.column("id"), own.column("start"), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
             own.column("shard"), pa.array(np.arange(record, record + hi - lo))],
            names=["id", "start", "length", "ids_crc32", "shard", "record"])

    def run(batches):
        shard, record, file = None, 0, None
        with ExitStack() as last:
            for batch in batches:
                shards = batch.column("shard").to_numpy()
                cuts = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(shards)]
                for lo, hi in zip(cuts[:-1], cuts[1:]):
                    if lo == hi:
                        continue
                    if shards[lo] != shard:
                        last.close()  # the shard before is whole
                        shard, record = int(shards[lo]), 0
                        file = last.enter_context(whole_file(folder, f"shard-{shard:06d}.bin"))
                    yield rows(batch, lo, hi, record, file)
                    record += hi - lo
    return run


def materialise(spark: SparkSession, docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                stride: int = 256, shards: int | None = None, key: int = 20240229, end_id: int = 1, pad_id: int = 0,
                kind: str = "<u2", where: SimpleNamespace | None = None) -> DataFrame:
    """Write the shards below ``folder``; (id, start, length, ids_crc32, slot, shard, record, byte_offset) of each sequence.

    A row's ids and ``end_id`` are cut every ``stride`` ids; each piece is one sequence, filled up
    with ``pad_id``.  ``record`` is its place in its shard, ``slot`` its global one; slots run from 0
    without gaps.  By default the number of shards follows the bytes of the input files.  Slots, and with
    equal ``shards`` the files written, are the same however many cores or splits there are.  ``folder``
    also gets ``order.json`` with what a reader needs.

    Null text: empty, so ``end_id`` alone.  Null and repeated ids are passed through; each row is
    a text of its own.  Other columns are ignored.  An empty table gives no rows and no shards.

    ``docs`` should be read straight from Parquet; other rows are written first.  What the driver holds is
    one entry a file and a shard.  Only the ids are shuffled, once.
    """
    where = where or tokens.vocabulary()
    rows, offsets, n, size = _numbered(spark, docs, id_col, text_col)
    shards = shards or max(1, min(16, -(-size // LEAST_BYTES)), -(-size // SHARD_BYTES))
    domain = max(1, n) << PIECE_BITS
    width = -(-domain // shards)
    id_type = rows.schema["id"].dataType.simpleString()
    placed = rows.mapInArrow(
        _sequences(where, stride, end_id, kind, key, domain, width, spark.sparkContext.broadcast(offsets)),
        f"id {id_type}, start long, position long, shard int, ids binary")
    written = placed.repartitionById(shards, "shard").sortWithinPartitions("position") \
        .mapInArrow(_shards(folder, stride, kind, pad_id),
                    f"id {id_type}, start long, length long, ids_crc32 long, shard int, record long")
    # The records' index; writing it writes the shards.
    index = table(spark, written, "training-order-index")
    count = {r["shard"]: r["n"] for r in index.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    first, files = [], []
    for shard in range(shards):
        first.append(sum(files[-1][1:]) if files else 0)
        files.append((shard, first[-1], count.get(shard, 0)))
    facts = {"stride": stride, "kind": kind, "key": key, "end_id": end_id, "pad_id": pad_id,
             "shards": [f for f in files if f[2]]}
    with whole_file(folder, "order.json") as out:
        out.write(json.dumps(facts).encode())
    slot = F.element_at(F.lit(first), F.col("shard") + 1) + F.col("record")
    return index.select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", slot.cast("long").alias("slot"), "shard", "record",
        (F.col("record") * (stride * np.dtype(kind).itemsize)).alias("byte_offset"))


def read_slots(folder: str, first: int, n: int) -> np.ndarray:
    """Records ``first`` .. ``first`` + n - 1 (fewer at the end) as rows of ``stride`` ids."""
    from pyarrow.fs import FileSystem

    store, root = FileSystem.from_uri(folder)
    with store.open_input_file(posixpath.join(root, "order.json")) as file:
        facts = SimpleNamespace(**json.loads(file.read()))
    width, parts = np.dtype(facts.kind).itemsize * facts.stride, []
    for shard, start, count in facts.shards:
        lo, hi = max(first, start), min(first + n, start + count)
        if lo < hi:
            with store.open_input_file(posixpath.join(root, f"shard-{shard:06d}.bin")) as file:
                file.seek((lo - start) * width)
                parts.append(np.frombuffer(file.read((hi - lo) * width), dtype=facts.kind).reshape(-1, facts.stride))
    return np.concatenate(parts) if parts else np.zeros((0, facts.stride), dtype=facts.kind)
