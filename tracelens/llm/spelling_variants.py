"""Groups of spelling variants through permuterm rotations, on DataFrame operations only.

A word and a terminator are written round a ring; its rotations start at every letter.
Two words that differ by one replaced letter have equal rotations once each begins right
after that letter, but for the last letter: the edited one.  A word that lacks one letter
of another has a whole rotation equal to that prefix.  So every word gives

* for each letter, the rotation that begins after it, without it: the prefix range of all
  words that have anything, or another letter, in its place;
* all its rotations as they are: the places where it lacks a letter.

Sorted by rotation, a group of equal prefixes holds at most one word for each letter of
the alphabet and one without, so groups are small by nature.  One scan of a group gives
each member its best neighbour and its number of neighbours.  A word that lacks a letter
which stands several times in a row meets its longer neighbour once for each of them; only
the first letter of a row counts.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tracelens.llm.store import columns_first, table

LETTERS = "A-Za-zÀ-ÿ"
END = "$"  # the terminator, no letter


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", at_least: int = 1) -> DataFrame:
    """(id, run): every maximal run of letters of every text with ``at_least`` letters or more, A-Z lower-cased."""
    rows = columns_first(docs, id=id_col, text=text_col)
    found = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[{LETTERS}]{{{at_least},}}"), F.lit(0))
    run = F.translate("run", string.ascii_uppercase, string.ascii_lowercase)
    return rows.select("id", F.explode(found).alias("run")).select("id", run.alias("run"))


def word_counts(words: DataFrame, min_letters: int = 7, min_count: int = 2) -> DataFrame:
    """(word, n) of the words (word: string) that are long and frequent enough."""
    return words.where(F.char_length("word") >= min_letters).groupBy("word").agg(F.count("*").alias("n")) \
        .where(F.col("n") >= min_count)


def _part(start: Column, length: Column | None = None) -> Column:
    return F.substr("word", start, length) if length is not None else F.substr("word", start)


def rotations(counts: DataFrame) -> DataFrame:
    """(rotation, word, n, skips, counts): the rotations of each word, those that skip a letter and the whole ones.

    ``counts``: does a neighbour that lacks the skipped letter count here?
    """
    at = counts.select("word", "n", F.explode(F.sequence(F.lit(0), F.char_length("word"))).alias("at"))
    before, size = _part(F.lit(1), F.col("at")), F.char_length("word")
    letter, previous = _part(F.col("at") + 1, F.lit(1)), _part(F.col("at"), F.lit(1))
    whole = at.select(F.concat(_part(F.col("at") + 1), F.lit(END), before).alias("rotation"), "word", "n",
                      F.lit(False).alias("skips"), F.lit(False).alias("counts"))
    skipping = at.where(F.col("at") < size).select(
        F.concat(_part(F.col("at") + 2), F.lit(END), before).alias("rotation"), "word", "n",
        F.lit(True).alias("skips"), ((F.col("at") == 0) | (letter != previous)).alias("counts"))
    return whole.unionByName(skipping)


def neighbours(counts: DataFrame) -> DataFrame:
    """(word, n_near, best) of the words that have neighbours; best: (less, word), less is minus its count."""
    group = Window.partitionBy("rotation")
    ranked = group.orderBy(F.col("n").desc(), "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    one, zero = F.lit(1), F.lit(0)
    member = F.struct((-F.col("n")).alias("less"), F.col("word"))
    scanned = rotations(counts).select(
        "word", "skips", "counts", F.first(member).over(ranked).alias("top"),
        F.nth_value(member, 2).over(ranked).alias("next"),
        F.sum(F.when(F.col("skips"), one).otherwise(zero)).over(ranked).alias("skipping"),
        F.sum(F.when(F.col("counts"), one).otherwise(zero)).over(ranked).alias("counting"),
        F.sum(F.when(F.col("skips"), zero).otherwise(one)).over(ranked).alias("whole")).where("next is not null")
    near = F.when(F.col("skips"), F.col("skipping") - 1 + F.when(F.col("counts"), F.col("whole")).otherwise(zero)) \
        .otherwise(F.col("counting"))
    best = F.when(F.col("top.word") == F.col("word"), F.col("next")).otherwise(F.col("top"))
    return scanned.select("word", near.alias("near"), best.alias("best")) \
        .groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """(word, root) of each word that has a form, from (word, form): the last form that can be reached.

    Every round doubles the steps that are done; a form is more frequent than its word, so there is an end.
    """
    to = table(spark, forms.select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        moved = Observation()
        ahead = to.select(F.col("word").alias("root"), F.col("root").alias("further"))
        to = table(spark, to.join(ahead, "root", "left").observe(moved, F.count("further").alias("n"))
                   .select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
        if not moved.get["n"]:
            return to


def variants(spark: SparkSession, counts: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``counts`` (word: string, n: long; words distinct).

    Near words differ by one inserted, deleted or replaced code point; ``n_near`` counts them.
    ``form`` is the near word with the largest n, of equal ones the smallest in code-point
    order, if that n is at least ``ratio`` (2 or more) times the word's; else null, as is ``form_n``.
    ``root``: the word that following forms leads to, the word itself if it has none.

    Words consist of letters (``LETTERS``), so a group of equal prefixes has one word a letter at
    most.  Null or empty words are left out.  An empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, or forms could lead in a circle")
    counts = table(spark, counts.where("word <> ''").select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    found = counts.join(neighbours(counts), "word", "left")
    is_form = -F.col("best.less") >= ratio * F.col("n")
    found = table(spark, found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")),
        "spelling-near")
    roots = _roots(spark, found.where("form is not null"))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
