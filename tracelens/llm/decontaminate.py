"""Benchmark decontamination: suffix arrays over shards of the training texts.

A shard is a block of texts inside a task.  Its suffix array holds the word
suffixes that can match a test suffix at all (those whose first words all occur
in the test set), sorted by their words.  Every test suffix is searched in it by
bisection; the run of equal prefixes gives all places of a match, which is then
joined with its neighbours to the longest verbatim match.

The test items are a stated set that is handled in blocks of bounded size, each
sent to the tasks whole; the texts are read in place and never shuffled for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tracelens.llm import text as tx
from tracelens.llm.store import columns_first, table


KNOWN_LISTS = 64  # lists of item names that a task keeps
LISTED = 1 << 18  # names, or windows of matches, that are put out at once


def match_words() -> np.ndarray:
    r"""Byte table of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` (digits, a-z, all non-ASCII)."""
    out = np.zeros(256, dtype=bool)
    out[0x30:0x3A] = True
    out[0x61:0x7B] = True
    out[0x80:] = True
    return out


def index_items(items: list[tuple[str, str]], window: int) -> SimpleNamespace:
    """The words of a block of test items as numbers, and the classes of their equal windows.

    ``ids``: all items' words, one after the other, each item ended by -1; ``starts``: where a window of the
    class starts in ``ids``; ``lengths``: its words.  ``cut``: where a class begins in ``window_start`` and
    ``window_item`` (its windows in ``ids`` and their items); ``item_first``: an item's first place in ``ids``;
    ``names``: sorted item names, ``name_of``: each item's place among them.
    """
    per_item, lower = [], tx.lower_ascii()
    for lo, hi, buf, offsets in tx.blocks(pa.array([t for _, t in items], pa.string())):
        s, e, first = tx.words(lower[buf], offsets, match_words())
        h = tx.hash_words(lower[buf], s, e)
        per_item += [h[first[d]:first[d + 1]] for d in range(hi - lo)]
    sizes = np.array([len(h) for h in per_item], dtype=np.int64)
    every = np.concatenate(per_item) if per_item else np.zeros(0, dtype=np.uint64)
    vocabulary = np.unique(every)
    item_first = np.cumsum(sizes + 1) - sizes - 1
    ids = np.full(int((sizes + 1).sum()), -1, dtype=np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    ids[np.arange(len(every)) + owner] = np.searchsorted(vocabulary, every)
    # A window starts where an item has that many words left; a shorter item is one window.
    length = np.minimum(window, sizes)
    many = np.where(sizes > 0, sizes - length + 1, 0)
    item = np.repeat(np.arange(len(sizes)), many)
    starts = item_first[item] + np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many)
    key = np.zeros(len(starts), dtype=np.uint64)
    values = ids.astype(np.uint64) + tx.U(2)
    for n in np.unique(length[sizes > 0]).tolist():
        own = np.flatnonzero(length[item] == n)
        key[own] = tx.hash_grams(values, n)[starts[own]] + tx.U(n)
    order = np.lexsort((starts, key))
    starts, item, key = starts[order], item[order], key[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    names = sorted({i for i, _ in items})
    place = {name: k for k, name in enumerate(names)}
    return SimpleNamespace(names=pa.array(names, pa.string()), name_of=np.array([place[i] for i, _ in items], dtype=np.int64),
                           vocabulary=vocabulary, ids=ids, item_first=item_first, starts=starts[at], lengths=length[item[at]],
                           cut=np.append(at, len(key)), window_start=starts, window_item=item)


class SuffixArray:
    """Sorted suffixes of a shard: number sequences over ``depth`` words, each inside one text.

    ``ids``: word numbers of the shard (-1: not a test word); ``text``: each word's text.
    Only suffixes that start with ``least`` test words of one text are held.
    """

    def __init__(self, ids: np.ndarray, text: np.ndarray, first: np.ndarray, least: int, depth: int):
        n = len(ids)
        bad = np.append(np.flatnonzero(ids < 0), n)
        next_bad = bad[np.searchsorted(bad, np.arange(n))]
        run = np.minimum(next_bad, first[1:][text] if n else next_bad) - np.arange(n)
        place = np.flatnonzero(run >= least)
        # A suffix is cut at its text's end or its first foreign word; -1 sorts before any word.
        reach = np.minimum(run[place], depth)
        columns = np.full((depth, len(place)), -1, dtype=np.int64)
        for j in range(depth):
            ok = reach > j
            columns[j, ok] = ids[place[ok] + j]
        order = np.lexsort(columns[::-1])
        self.place, self.columns, self.reach = place[order], columns[:, order], reach[order]

    def find(self, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window ``ids[start:start + length]`` the run of suffixes that start with it.

        All windows are bisected together, one word after the other; a run that is empty
        drops out.
        """
        lo = np.zeros(len(starts), dtype=np.int64)
        hi = np.full(len(starts), len(self.place), dtype=np.int64)
        open_ = np.arange(len(starts))
        for j, column in enumerate(self.columns):
            open_ = open_[(lengths[open_] > j) & (lo[open_] < hi[open_])]
            if not len(open_):
                break
            word = ids[starts[open_] + j]
            a, b = lo[open_], hi[open_]
            lo[open_], hi[open_] = _bisect(column, a, b, word, False), _bisect(column, a, b, word, True)
        return lo, hi


def _bisect(column: np.ndarray, lo: np.ndarray, hi: np.ndarray, word: np.ndarray, after: bool) -> np.ndarray:
    """Per query, the first place in ``column[lo:hi]`` not below ``word`` (``after``: above it)."""
    while (wide := lo < hi).any():
        middle = (lo + hi) // 2
        found = column[np.minimum(middle, len(column) - 1)]
        right = wide & ((found <= word) if after else (found < word))
        lo, hi = np.where(right, middle + 1, lo), np.where(wide & ~right, middle, hi)
    return lo


def _numbers(h: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Each word's number in the sorted vocabulary, or -1."""
    if not len(vocabulary) or not len(h):
        return np.full(len(h), -1, dtype=np.int64)
    # A small table of the low bits turns most foreign words away before the bisection.
    maybe = np.zeros(1 << 16, dtype=bool)
    maybe[vocabulary & tx.U(0xFFFF)] = True
    out = np.full(len(h), -1, dtype=np.int64)
    some = np.flatnonzero(maybe[h & tx.U(0xFFFF)])
    at = np.minimum(np.searchsorted(vocabulary, h[some]), len(vocabulary) - 1)
    out[some] = np.where(vocabulary[at] == h[some], at, -1)
    return out


def shard_matches(column: pa.Array, test: SimpleNamespace) -> Iterator[tuple]:
    """Yield (first row, end row, first, places, classes): where test windows occur in a shard.

    ``places``: word in the shard, ``classes``: class of equal test windows.  A place has at most one class a length.
    """
    least = int(test.lengths.min()) if len(test.lengths) else 1
    depth = int(test.lengths.max()) if len(test.lengths) else 1
    is_word, lower = match_words(), tx.lower_ascii()
    for lo, hi, buf, offsets in tx.blocks(column):
        buf = lower[buf]
        starts, ends, first = tx.words(buf, offsets, is_word)
        ids = _numbers(tx.hash_words(buf, starts, ends), test.vocabulary)
        doc = np.repeat(np.arange(hi - lo), np.diff(first))
        array = SuffixArray(ids, doc, first, least, depth)
        a, b = array.find(test.ids, test.starts, test.lengths)
        n = b - a
        classes = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(classes)) - np.repeat(np.cumsum(n) - n, n)
        places = array.place[a[classes] + nth]
        order = np.argsort(places, kind="stable")
        yield lo, hi, first, places[order], classes[order]


def _listed(cut: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """All places of the lists ``cut[c]:cut[c + 1]`` of the chosen ones, one list after the other."""
    n = cut[chosen + 1] - cut[chosen]
    return np.arange(int(n.sum())) + np.repeat(cut[chosen] - np.cumsum(n) + n, n)


def _hits(test):
    """Per text: its words, the hit ranges of words and the items found."""
    def run(batches):
        items, known = test.value, {}

        def names(classes: np.ndarray) -> pa.Array:
            """Names of the items that have one of the classes; texts with the same classes share the answer."""
            key = classes.tobytes()
            if key not in known:
                if len(known) >= KNOWN_LISTS:
                    known.clear()
                own = np.unique(items.name_of[items.window_item[_listed(items.cut, classes)]])
                known[key] = items.names.take(pa.array(own))
            return known[key]

        for batch in batches:
            for lo, hi, first, places, classes in shard_matches(batch.column("text"), items):
                bounds = np.searchsorted(places, first)
                begin, ranges, found, size = lo, [], [], 0

                def rows(end):
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0] + [len(f) for f in found]), pa.int32()),
                        pa.concat_arrays(found) if found else pa.array([], pa.string()))
                    return pa.RecordBatch.from_arrays(
                        [batch.column("row").slice(begin, end - begin), batch.column("doc").slice(begin, end - begin),
                         pa.array(np.diff(first)[begin - lo:end - lo], pa.int64()),
                         pa.array(ranges, pa.list_(pa.int64())), lists], names=["row", "doc", "n_words", "ranges", "items"])

                for d in range(hi - lo):
                    a, b = bounds[d], bounds[d + 1]
                    if a == b:
                        ranges.append([])
                        found.append(items.names[:0])
                        continue
                    p = places[a:b] - first[d]
                    ranges.append(_union(p, p + items.lengths[classes[a:b]]))
                    found.append(names(np.unique(classes[a:b])))
                    size += len(found[-1])
                    if size >= LISTED:
                        yield rows(lo + d + 1)
                        begin, ranges, found, size = lo + d + 1, [], [], 0
                if begin < hi:
                    yield rows(hi)
    return run


def _union(lo: np.ndarray, hi: np.ndarray) -> list[int]:
    """Ranges as a flat list lo, hi, lo, hi, ... with overlaps merged."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), dtype=bool)
    new[1:] = lo[1:] > hi[:-1]
    at = np.flatnonzero(new)
    return np.column_stack([lo[at], hi[np.append(at[1:], len(lo)) - 1]]).reshape(-1).tolist()


def _longest(test):
    """Maximal verbatim matches of each text: (item, word in item, word in text, words)."""
    def run(batches):
        items = test.value
        for batch in batches:
            for lo, hi, first, places, classes in shard_matches(batch.column("text"), items):
                many = items.cut[classes + 1] - items.cut[classes]
                bounds = np.searchsorted(places, first)
                done = np.concatenate([[0], np.cumsum(many)])[bounds]  # windows of the texts before each one
                d = 0
                while d < hi - lo:
                    end = max(d + 1, int(np.searchsorted(done, done[d] + LISTED, side="right")) - 1)
                    some = slice(bounds[d], bounds[end])
                    at = _listed(items.cut, classes[some])
                    place = np.repeat(places[some], many[some])
                    item, start = items.window_item[at], items.window_start[at]
                    # Windows that follow each other in a text and in an item are one match, and no word
                    # more belongs to it: there would be one more window.
                    order = np.lexsort((place, place - start, item))
                    place, item, start = place[order], item[order], start[order]
                    doc = np.searchsorted(first, place, "right") - 1
                    new = np.ones(len(place), dtype=bool)
                    new[1:] = (item[1:] != item[:-1]) | (place[1:] != place[:-1] + 1) | (start[1:] != start[:-1] + 1) \
                        | (doc[1:] != doc[:-1])
                    one = np.flatnonzero(new)
                    last = np.append(one[1:], len(place)) - 1
                    length = items.lengths[np.repeat(classes[some], many[some])][order]
                    if len(one):
                        yield pa.RecordBatch.from_arrays(
                            [batch.column("id").take(pa.array(lo + doc[one])), items.names.take(pa.array(items.name_of[item[one]])),
                             pa.array(start[one] - items.item_first[item[one]]), pa.array(place[one] - first[doc[one]]),
                             pa.array(place[last] - place[one] + length[last])],
                            names=["id", "item_id", "item_word", "word", "n_words"])
                    d = end
    return run


def test_blocks(test_set: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int) -> Iterator[SimpleNamespace]:
    """The test items in blocks of about ``block_bytes`` of text, in any order.

    Null texts and items without a word have no window.  A null item id counts as ''.
    """
    slim = columns_first(test_set, item=item_col, text=text_col).where("text is not null") \
        .select(F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string"))
    items, size = [], 0
    for row in slim.toLocalIterator():
        items.append((row["item"], row["text"]))
        size += len(row["text"])
        if size >= block_bytes:
            yield index_items(items, window)
            items, size = [], 0
    if items:
        yield index_items(items, window)


def _judged(spark, docs, test_set, text_col, keep, item_col, item_text_col, window, share, block_bytes) -> DataFrame:
    """(doc, n_words, n_hit, items, contaminated); doc: the columns ``keep`` of each row as one struct."""
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("doc"), docs[text_col].cast("string").alias("text"),
                       F.lit(0).cast("long").alias("row"))
    schema = StructType([rows.schema["row"], rows.schema["doc"], StructField("n_words", LongType()),
                         StructField("ranges", ArrayType(LongType())), StructField("items", ArrayType(StringType()))])
    blocks = test_blocks(test_set, item_col, item_text_col, window, block_bytes)
    head = next(blocks, None) or index_items([], window)
    more = next(blocks, None)
    if more is None:
        found = rows.mapInArrow(_hits(spark.sparkContext.broadcast(head)), schema)
    else:
        # Rows are numbered once, in a written table, so that their hits can be joined.
        rows = table(spark, rows.withColumn("row", F.monotonically_increasing_id()), "contamination-rows")
        hits = None
        while head is not None:
            part = rows.mapInArrow(_hits(spark.sparkContext.broadcast(head)), schema)
            if hits is not None:
                part = part.where("size(items) > 0")
            part = table(spark, part.drop("doc"), "contamination-hits")
            hits = part if hits is None else hits.unionByName(part)
            head, more = more, next(blocks, None)
        hits = hits.groupBy("row").agg(
            F.max("n_words").alias("n_words"), F.flatten(F.collect_list("ranges")).alias("ranges"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        found = rows.select("row", "doc").join(hits, "row")
    # Hit words: the length of the union of ranges, taken in order of their starts.
    pairs = F.array_sort(F.transform(
        F.sequence(F.lit(0), (F.size("ranges") / 2).cast("int") - 1),
        lambda i: F.struct(F.get("ranges", i * 2).alias("lo"), F.get("ranges", i * 2 + 1).alias("hi"))))
    zero = F.lit(0).cast("long")
    n_hit = F.when(F.size("ranges") == 0, zero).otherwise(F.aggregate(
        pairs, F.struct(zero.alias("n"), zero.alias("end")),
        lambda acc, r: F.struct((acc["n"] + F.greatest(zero, r["hi"] - F.greatest(r["lo"], acc["end"]))).alias("n"),
                                F.greatest(acc["end"], r["hi"]).alias("end")),
        lambda acc: acc["n"]))
    return found.select("doc", "n_words", n_hit.alias("n_hit"), F.array_sort("items").alias("items")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def contamination(spark: SparkSession, docs: DataFrame, test_set: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  window: int = 13, share: int = 20, block_bytes: int = 16 << 20) -> DataFrame:
    r"""(id, n_words, n_hit, items, contaminated) of every row of ``docs``.

    A-Z are lower-cased; words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.  A test window is
    ``window`` consecutive words of an item; an item of fewer words, but not none, is one
    window.  A word inside any occurrence of a window is hit; ``items`` are the sorted item
    ids with an occurring window.  Contaminated: some word is hit and
    ``share`` * n_hit >= n_words.

    Null or empty text: no words, not contaminated.  Null and repeated ids are passed
    through, each row judged alone.  Other columns are ignored.  An empty table gives no rows;
    an empty test set contaminates nothing.  Words are told apart by 64-bit hashes.

    Equal windows of several items are searched once and count as one class, so a template that
    very many items share costs a place one match; the list of their names is made once for all texts
    that hit the same classes.

    With one block of test items (``block_bytes`` of text) the texts are read once and
    nothing is shuffled; with more, each block reads them again and hits are joined per row.
    """
    found = _judged(spark, docs, test_set, text_col, [id_col], item_col, item_text_col, window, share, block_bytes)
    return found.select(F.col("doc")[id_col].alias(id_col), "n_words", "n_hit", "items", "contaminated")


def drop_contaminated(spark: SparkSession, docs: DataFrame, test_set: DataFrame, text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text", window: int = 13, share: int = 20,
                      block_bytes: int = 16 << 20) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns; each row is judged alone."""
    found = _judged(spark, docs, test_set, text_col, docs.columns, item_col, item_text_col, window, share, block_bytes)
    return found.where("not contaminated").select("doc.*")


def longest_matches(spark: SparkSession, docs: DataFrame, test_set: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                    window: int = 13, block_bytes: int = 16 << 20) -> DataFrame:
    """(id, item_id, item_word, word, n_words): the longest verbatim matches and where they are.

    A match holds at least one test window and cannot be extended on either side; words count
    from 0 in the item and in the text.  Rows without a match give none.
    """
    rows = columns_first(docs, id=id_col, text=text_col)
    schema = "id " + rows.schema["id"].dataType.simpleString() \
        + ", item_id string, item_word long, word long, n_words long"
    out = None
    for block in test_blocks(test_set, item_col, item_text_col, window, block_bytes):
        found = rows.mapInArrow(_longest(spark.sparkContext.broadcast(block)), schema)
        out = found if out is None else out.unionByName(found)
    out = out if out is not None else spark.createDataFrame([], schema)
    return out.withColumnRenamed("id", id_col) if id_col != "id" else out
