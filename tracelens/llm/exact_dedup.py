"""Exact duplicates by stateful streaming, on DataFrame operations only.

Every row arrives as a slim record: digest of the normalised text, length,
identifier and content locator.  A streaming aggregation keeps one state entry
per digest, without expiry, in RocksDB (on disk, in the shared checkpoint
folder): the size of the group and the record that stays.  More rows may arrive
in later runs on the same checkpoint.  A digest hit is then checked on the full
bytes: texts are grouped by digest and bytes together, and a digest that has two
byte strings is resolved by the bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelens.llm.store import columns_first, scratch_dir, table

# State on disk; many stores share a disk, so none reserves space ahead.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def _normal(column: str):
    r"""The text without any character of ``[\x20\x09-\x0D]``; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(column).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", "")


def _digest(normal):
    return F.unhex(F.sha2(normal.cast("binary"), 256))


def arrivals(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Slim records (digest, n, id, locator, row) of all rows."""
    return columns_first(docs, id=id_col, text=text_col).select(
        _digest(_normal("text")).alias("digest"),
        F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n"), "id",
        F.input_file_name().alias("locator"), F.monotonically_increasing_id().alias("row"))


def keep_state(spark: SparkSession, folder: str, schema, checkpoint: str, files_per_trigger: int = 1000) -> DataFrame:
    """Run all waiting record files of ``folder`` through the keyed state; return it as a table.

    (digest, group_size, best): ``best`` is the record that stays, the one with most code
    points, then smallest id (null last), then first row.  Records that were seen by an
    earlier run on this checkpoint are not read again.
    """
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("id").isNull().alias("no_id"), "id", "row", "locator"))
    groups = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
              .groupBy("digest").agg(F.count("*").alias("group_size"), best.alias("best")))
    before = {name: spark.conf.get(name, None) for name in _STATE}
    for name, value in _STATE.items():
        spark.conf.set(name, value)
    try:
        query = (groups.writeStream.outputMode("update").format("noop")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint).select(
            F.col("key.digest").alias("digest"), F.col("value.count").alias("group_size"),
            F.col("value.min").alias("best"))
        return table(spark, state, "exact-groups")
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _batch_best(rows: DataFrame, *keys: str) -> DataFrame:
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("id").isNull().alias("no_id"), "id", "row", "locator"))
    return rows.groupBy(*keys).agg(F.count("*").alias("group_size"), best.alias("best"))


def digest_clashes(spark: SparkSession, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Digests that stand for more than one normalised text, compared on all bytes.

    Texts are grouped by digest and bytes, combined before the shuffle, so a group of
    copies ships one text per input task.
    """
    texts = columns_first(docs, text=text_col).select(_normal("text").alias("normal")) \
        .select(_digest(F.col("normal")).alias("digest"), "normal")
    return table(spark, texts.groupBy("digest", "normal").agg(F.count("*").alias("n"))
                 .groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").select("digest"),
                 "exact-clashes")


def _decisions(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The record of every row (digest, n, id, locator, row) with its group (group_size, best)."""
    folder = scratch_dir(spark, "exact-arrivals")
    slim = arrivals(docs, id_col, text_col)
    slim.write.parquet(folder)
    records = spark.read.schema(slim.schema).parquet(folder)
    if records.isEmpty():
        state = _batch_best(records, "digest")
    else:
        state = keep_state(spark, folder, slim.schema, scratch_dir(spark, "exact-state"))
    clashes = digest_clashes(spark, docs, text_col)
    joined = records.join(state, "digest")
    if not clashes.isEmpty():
        # Two texts under one digest: these few are grouped by their bytes instead.
        normal = columns_first(docs, id=id_col, text=text_col).withColumn("normal", _normal("text")).select(
            _digest(F.col("normal")).alias("digest"), "normal",
            F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n"), "id",
            F.input_file_name().alias("locator"), F.monotonically_increasing_id().alias("row")).join(clashes, "digest")
        normal = table(spark, normal, "exact-clash-rows")
        apart = normal.join(_batch_best(normal, "digest", "normal"), ["digest", "normal"]).drop("normal")
        joined = joined.join(clashes, "digest", "left_anti").unionByName(apart)
    return joined


def exact_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    r"""(id, keep_id, group_size, kept, text_sha256, keep_locator) of every row of ``docs``.

    Texts are equal when they are identical without the characters of ``[\x20\x09-\x0D]``.
    Of equal texts the row with most code points stays, then the one with the smallest id.

    Null text: empty, equal to other empty texts.  Null id: takes part, loses every tie to
    an id.  Repeated rows (same id and text): exactly one of them stays.  Other columns are
    ignored.  An empty table gives no rows.  ``keep_locator`` names the file of the row that
    stays (empty where the rows do not come straight from files).
    """
    return _decisions(spark, docs, id_col, text_col).select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
        F.col("best.locator").alias("keep_locator"))


def keep_first_copies(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of equal texts.  Columns are those of ``docs``, of any names.

    The row that stays is known by id, digest and code points, which decide it; of rows that
    agree in all three, whatever their other columns hold, one stays.
    """
    found = table(spark, _decisions(spark, docs, id_col, text_col).select(
        "id", "digest", "n", (F.col("row") == F.col("best.row")).alias("kept")), "exact-decisions")
    # The caller's columns travel as one struct, so that no name can meet those used here.
    text = docs[text_col].cast("string")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("whole"), docs[id_col].alias("id"), text.alias("text"))
    rows = rows.select("whole", "id", _digest(_normal("text")).alias("digest"),
                       F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n"))
    keep = found.where("kept").select(F.col("id").alias("keep"), F.col("digest").alias("d"), F.col("n").alias("size"))
    kept = rows.join(keep, rows["id"].eqNullSafe(keep["keep"]) & (F.col("digest") == F.col("d")) & (F.col("n") == F.col("size")),
                     "left_semi")
    repeated = found.groupBy("id", "digest", "n").agg(F.count("*").alias("rows")).where("rows > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates(["id", "digest", "n"])
    return kept.select("whole.*")
