"""Removal of repeated passages through prefix-partitioned suffix trees.

A window is ``window`` consecutive words of one text; every word covered by a
window that also starts anywhere else goes.

*Sampled suffixes.*  The ``gram``-word run with the smallest hash in a window is
its anchor.  Equal windows have their anchor at the same place, so it is enough
to compare suffixes around anchors, about one word in fifteen.  An anchor and
the windows it belongs to form a stretch of words.

*Variable-length prefixes.*  Stretches are split by the words at their anchor.
A prefix of ``gram`` words that occurs once is dropped (no window through it can
repeat).  A prefix whose stretches fit into ``group_bytes`` is one group; groups are
handled in chunks of bounded size.  Of a more frequent prefix, equal stretches of
all texts are first collapsed to one; what is left is taken window by window, and each
window's prefix is lengthened, to 2, 4, ... times ``gram`` words, until its group
fits.  At the whole window a group is a single tree node, repeated by definition if it
has two starts.

*Subtrees.*  A stretch travels as the 64-bit hashes of its words, so its size does
not depend on theirs.  In a chunk, all suffixes are ranked by their first ``gram`` words,
then twice as many, and so on up to the window (prefix doubling).  Equal ranks
at a depth are one internal node of the suffix tree; a node at window depth with
two or more starts is a repeat, and all its windows are marked.

Texts that are equal byte for byte are one leaf with a weight, so a group of
copies of any size costs one text per input task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracelens.llm import text as tx
from tracelens.llm.store import columns_first

U = np.uint64
CHUNK_BYTES = 3 << 20  # word hashes of stretches that one subtree pass holds, and those of one group at most
SALTS = 64  # parts of a node at window depth that are judged by themselves first


def least_in_window(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value of each run of ``width`` values, the leftmost of equal ones."""
    value, place, have = h, np.arange(len(h)), 1
    while have < width:
        step = min(have, width - have)
        right = value[step:] < value[:-step]
        value = np.where(right, value[step:], value[:-step])
        place = np.where(right, place[step:], place[:-step])
        have += step
    return place


class Anchors:
    """The anchors of a block of texts and the windows each of them owns.

    ``place``: word of the anchor; ``lo``..``hi``: first and last window start that
    has this anchor; ``key``: the anchor's hash; ``content``: hash of the stretch
    and the anchor's place in it; ``doc``: the text; ``words``: hashes of all words of the block.
    """

    def __init__(self, buf, starts, ends, first, window: int, gram: int):
        self.words = h = tx.hash_words(buf, starts, ends)
        none = np.zeros(0, dtype=np.int64)
        self.place = self.lo = self.hi = self.doc = none
        self.key = self.content = none.astype(np.uint64)
        if len(h) < window:
            return
        grams = tx.hash_grams(h, gram)
        inside = np.flatnonzero(tx.inside_mask(first, window))
        if not len(inside):
            return
        doc_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        owner = least_in_window(grams, window - gram + 1)[inside]
        new = np.ones(len(inside), dtype=bool)
        new[1:] = (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1] + 1) \
            | (doc_of[inside[1:]] != doc_of[inside[:-1]])
        run = np.flatnonzero(new)
        last = np.append(run[1:], len(inside)) - 1
        self.place, self.lo, self.hi = owner[run], inside[run], inside[last]
        self.key = grams[self.place]
        self.doc = doc_of[self.lo]
        end = self.hi + window
        sums = _running(h)
        size = (end - self.lo).astype(np.uint64)
        self.content = tx.mix(_span(sums, self.lo, end) + size * U(0x9E3779B97F4A7C15)) \
            + (self.place - self.lo).astype(np.uint64)


def _running(h):
    """Prefix sums of h[i] * B**i, for hashes of any run of words."""
    power = tx._power_table(tx._BASE, len(h))[:len(h)]
    sums = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * power, out=sums[1:])
    return sums


def _span(sums, lo, hi):
    return (sums[hi] - sums[lo]) * tx._power_table(tx._BASE_INVERSE, len(sums))[lo]


def _blocks(column) -> Iterator[tuple]:
    is_word = tx.space_words()
    for lo, hi, buf, offsets in tx.blocks(column):
        starts, ends, first = tx.words(buf, offsets, is_word)
        yield lo, hi, buf, starts, ends, first


def _prefixes(window: int, gram: int):
    """Rows (prefix, text, bytes, starts): the anchors of each text, equal stretches counted once in bytes."""
    def run(batches):
        for batch in batches:
            weight = batch.column("weight").to_numpy()
            text_key = batch.column("key")
            for lo, hi, buf, starts, ends, first in _blocks(batch.column("text")):
                a = Anchors(buf, starts, ends, first, window, gram)
                if not len(a.key):
                    continue
                order = np.lexsort((a.content, a.key, a.doc))
                key, doc, content = a.key[order], a.doc[order], a.content[order]
                new = np.ones(len(key), dtype=bool)
                new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                other = new.copy()
                other[1:] |= content[1:] != content[:-1]
                at = np.flatnonzero(new)
                count = np.diff(np.append(at, len(key)))
                size = np.add.reduceat(np.where(other, 8 * (a.hi - a.lo + window)[order], 0), at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[at].view(np.int64)), text_key.take(pa.array(lo + doc[at])),
                     pa.array(size), pa.array(count * weight[lo + doc[at]])],
                    names=["prefix", "key", "bytes", "starts"])
    return run


def _stretches(window: int, gram: int):
    """Rows of the stretches of each text whose prefix is among ``chosen``, equal ones counted once.

    ``content`` tells different stretches of all texts apart.
    """
    def run(batches):
        for batch in batches:
            weight = batch.column("weight").to_numpy()
            text_key = batch.column("key").to_pylist()
            chosen = batch.column("chosen").to_pylist()
            for lo, hi, buf, starts, ends, first in _blocks(batch.column("text")):
                a = Anchors(buf, starts, ends, first, window, gram)
                data = a.words.tobytes()
                bounds = np.searchsorted(a.doc, np.arange(hi - lo + 1))
                picked, times, keys = [], [], []
                for doc in range(hi - lo):
                    own = a.key[bounds[doc]:bounds[doc + 1]].view(np.int64)
                    hit = np.flatnonzero(np.isin(own, np.array(chosen[lo + doc], dtype=np.int64))) + bounds[doc]
                    _, one, count = np.unique(a.content[hit], return_index=True, return_counts=True)
                    picked.append(hit[one])
                    times.append(count * weight[lo + doc])
                    keys += [text_key[lo + doc]] * len(one)
                at, n = np.concatenate(picked), np.concatenate(times)
                begin, end = a.lo[at], a.hi[at]
                both = np.stack([a.key[at], a.content[at]], axis=1).tobytes()
                # The place counts from the text's own first word.
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.key[at].view(np.int64)), pa.array([both[i:i + 16] for i in range(0, len(both), 16)], pa.binary()),
                     pa.array(keys, pa.binary()), pa.array((begin - first[a.doc[at]]).astype(np.int32)),
                     pa.array((end - begin + 1).astype(np.int32)), pa.array(n, pa.int64()),
                     pa.array([data[8 * s:8 * (e + window)] for s, e in zip(begin.tolist(), end.tolist())], pa.binary())],
                    names=["prefix", "content", "key", "place", "windows", "starts", "words"])
    return run


def _windows(window: int):
    """Rows (key, place, windows, starts, words) of the single windows of stretches; the key is their content."""
    def run(batches):
        for batch in batches:
            content, starts, words, place = batch.column("content"), batch.column("starts"), [], []
            source = []
            for i, data in enumerate(batch.column("words").to_pylist()):
                n = len(data) // 8 - window + 1
                words += [data[8 * at:8 * (at + window)] for at in range(n)]
                place += range(n)
                source += [i] * n
            source = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [content.take(source), pa.array(place, pa.int32()), pa.array(np.ones(len(place), dtype=np.int32)),
                 starts.take(source), pa.array(words, pa.binary())], names=["key", "place", "windows", "starts", "words"])
    return run


def _ranks(h, ok, gram, window):
    """Rank of every suffix by its first ``window`` words (equal rank: equal words); -1 if shorter.

    Each doubling joins the ranks of two shorter runs; the last step overlaps them.
    """
    n = len(h)
    rank = np.full(n, -1, dtype=np.int64)
    grams = tx.hash_grams(h, gram)
    if len(grams):
        _, inverse = np.unique(grams, return_inverse=True)
        rank[:len(grams)] = inverse
    depth = gram
    while depth < window:
        step = min(depth, window - depth)
        m = n - step
        if m <= 0:
            return np.full(n, -1, dtype=np.int64)
        left, right = rank[:m], rank[step:]
        good = (left >= 0) & (right >= 0)
        _, inverse = np.unique(left[good] * (n + 1) + right[good], return_inverse=True)
        rank = np.full(n, -1, dtype=np.int64)
        rank[:m][good] = inverse
        depth += step
    rank[~ok] = -1
    return rank


def mark_chunk(words: list[bytes], windows: np.ndarray, starts: np.ndarray, window: int, gram: int) -> list[int]:
    """Of each stretch, the repeated windows as bits (bit i: the window that starts at its word i).

    ``words``: the hashes of its words; ``starts``: how often it occurs in all.  Equal stretches may be given several times.
    """
    distinct: dict[bytes, int] = {}
    of = np.array([distinct.setdefault(t, len(distinct)) for t in words], dtype=np.int64)
    n = len(distinct)
    total = np.bincount(of, weights=starts, minlength=n)
    n_windows = np.zeros(n, dtype=np.int64)
    n_windows[of] = windows
    first = np.zeros(n + 1, dtype=np.int64)
    np.cumsum([len(t) // 8 for t in distinct], out=first[1:])
    h = np.frombuffer(b"".join(distinct), dtype=np.uint64)
    owner = np.repeat(np.arange(n), np.diff(first))
    at = np.arange(len(h)) - first[:-1][owner]
    ok = at < n_windows[owner]
    rank = _ranks(h, ok, gram, window)
    good = rank >= 0
    weight = np.bincount(rank[good], weights=total[owner[good]]) if good.any() else np.zeros(0)
    repeated = np.zeros(len(h), dtype=bool)
    repeated[good] = weight[rank[good]] >= 2
    bits = np.zeros(n, dtype=np.uint64)
    hit = np.flatnonzero(repeated)
    np.bitwise_or.at(bits, owner[hit], U(1) << at[hit].astype(np.uint64))
    return bits[of].astype(np.int64).tolist()


def _subtrees(window: int, gram: int):
    """Marks of the stretches; input sorted by prefix, whole prefixes at a time."""
    def run(batches):
        held: dict[str, list] = {"key": [], "place": [], "windows": [], "starts": [], "words": [], "prefix": []}
        size = 0

        def marks():
            # An anchor's other sides differ between occurrences, so stretches of one prefix
            # are compared window by window, in one pass for all prefixes of the chunk.
            bits = mark_chunk(held["words"], np.array(held["windows"]), np.array(held["starts"], dtype=np.float64),
                              window, gram)
            keep = [b != 0 for b in bits]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(compress(held["key"], keep)), pa.binary()),
                 pa.array(list(compress(held["place"], keep)), pa.int32()),
                 pa.array(list(compress(bits, keep)), pa.int64())], names=["key", "place", "bits"])
            for v in held.values():
                v.clear()
            return batch

        for batch in batches:
            rows = {c: batch.column(c).to_pylist() for c in held}
            prefix, words = rows["prefix"], rows["words"]
            lo = 0
            for i in range(len(prefix)):
                before = prefix[i - 1] if i else (held["prefix"][-1] if held["prefix"] else None)
                if size >= CHUNK_BYTES and prefix[i] != before:
                    for c in held:
                        held[c] += rows[c][lo:i]
                    lo, size = i, 0
                    yield marks()
                size += len(words[i])
            for c in held:
                held[c] += rows[c][lo:]
        if held["words"]:
            yield marks()
    return run


def _cut(window: int, gram: int):
    """Kept words of each distinct text, from the marks of its stretches."""
    def run(batches):
        for batch in batches:
            key = batch.column("key")
            ends_n, digests, removed, total = [], [], [], []
            marks = batch.column("marks").to_pylist()
            for lo, hi, buf, starts, ends, first in _blocks(batch.column("text")):
                n_words = np.diff(first)
                goes = np.zeros(len(starts), dtype=bool)
                if any(marks[lo + d] for d in range(hi - lo)):
                    a = Anchors(buf, starts, ends, first, window, gram)
                    bounds = np.searchsorted(a.doc, np.arange(hi - lo + 1))
                    delta = np.zeros(len(starts) + 1, dtype=np.int64)
                    for d in range(hi - lo):
                        if not marks[lo + d]:
                            continue
                        base = int(first[d])
                        own = np.arange(bounds[d], bounds[d + 1])
                        place = np.array([m["place"] for m in marks[lo + d]], dtype=np.int64) + base
                        bits = np.array([m["bits"] for m in marks[lo + d]], dtype=np.int64)
                        window_at = _marked(a, own, place, bits)
                        np.add.at(delta, window_at, 1)
                        np.add.at(delta, window_at + window, -1)
                    goes = np.cumsum(delta[:-1]) > 0
                data = buf.tobytes()
                for d in range(hi - lo):
                    s, e = int(first[d]), int(first[d + 1])
                    gone = int(goes[s:e].sum())
                    if gone == e - s:
                        kept = b""
                    else:
                        pieces = data[starts[s]:ends[e - 1]].split()
                        kept = b" ".join(compress(pieces, (~goes[s:e]).tolist()) if gone else pieces)
                    digests.append(kept)
                    removed.append(gone)
                    total.append(int(n_words[d]))
            yield pa.RecordBatch.from_arrays(
                [key, pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(digests, pa.binary()).cast(pa.string())],
                names=["key", "n_words", "n_removed", "kept"])
    return run


def _marked(a: Anchors, own: np.ndarray, place: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Starts of all repeated windows of one text.

    A mark names the first of several equal stretches, or a single window of one.
    """
    order = np.argsort(place, kind="stable")
    place, bits = place[order], bits[order]
    # Marks of whole stretches sit at a stretch's first window, those of single windows anywhere in it.
    at = np.searchsorted(a.lo[own], place, side="right") - 1
    shift = place - a.lo[own][at]
    content = a.content[own]
    by_content = np.argsort(content, kind="stable")
    sorted_content = content[by_content]
    lo = np.searchsorted(sorted_content, content[at], side="left")
    hi = np.searchsorted(sorted_content, content[at], side="right")
    out = []
    for bit in range(64):
        has = np.flatnonzero((bits >> np.int64(bit)) & 1)
        if not len(has):
            if not (bits >> np.int64(bit)).any():
                break
            continue
        n = hi[has] - lo[has]
        which = np.repeat(has, n)
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        copies = by_content[lo[which] + nth]
        out.append(a.lo[own][copies] + shift[which] + bit)
    return np.unique(np.concatenate(out)) if out else np.zeros(0, dtype=np.int64)


def distinct_texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(id, key) of every row, and (key, text, weight) of every distinct text."""
    rows = columns_first(docs, id=id_col, text=text_col) \
        .withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit(""))) \
        .withColumn("key", F.coalesce(F.substring(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), 1, 16),
                                      F.lit(b"")))  # never null, said so that the optimiser adds no filter
    texts = rows.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("weight"))
    return rows.select("id", "key"), texts


MARKS = "key binary, place int, bits long"


def _in_subtrees(groups: DataFrame, window: int, gram: int) -> DataFrame:
    """MARKS of stretches (prefix, key, place, windows, starts, words) whose prefixes are groups that fit."""
    return groups.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(_subtrees(window, gram), MARKS)


def _at_window_depth(rows: DataFrame) -> DataFrame:
    """MARKS of single windows: whatever starts twice is a repeated node.

    A node's rows are dealt into ``SALTS`` parts.  Two starts in one part settle all its rows; a part
    with a single one is judged beside one row for each of the node's other parts.
    """
    node = rows.withColumn("node", F.unhex(F.md5("words"))).drop("words")
    dealt = node.withColumn("n", F.sum("starts").over(
        Window.partitionBy("node", F.pmod(F.xxhash64("key", "place"), F.lit(SALTS)))))
    settled = dealt.where("n > 1")
    alone = dealt.where("n = 1").select("node", "key", "place", "n")
    beside = settled.groupBy("node").agg(F.lit(None).cast("binary").alias("key"), F.lit(None).cast("int").alias("place"),
                                         F.min("n").alias("n"))
    found = alone.unionByName(beside).withColumn("all", F.sum("n").over(Window.partitionBy("node"))) \
        .where("all > 1 and key is not null")
    one = F.lit(1).cast("long").alias("bits")
    return settled.select("key", "place", one).unionByName(found.select("key", "place", one))


def _lengthened(contents: DataFrame, window: int, gram: int, group_bytes: int) -> DataFrame:
    """(content, bits) of the repeated windows of distinct stretches (content, starts, words) of frequent prefixes."""
    rest = contents.mapInArrow(_windows(window), "key binary, place int, windows int, starts long, words binary")
    marks, depth = [], 2 * gram
    while depth < window:
        grouped = rest.withColumn("prefix", F.xxhash64(F.substring("words", 1, 8 * depth)))
        sizes = grouped.groupBy("prefix").agg(F.sum("starts").alias("n"), F.sum(F.octet_length("words")).alias("bytes")) \
            .where("n > 1").select("prefix", (F.col("bytes") > group_bytes).alias("is_long"))
        grouped = grouped.hint("merge").join(sizes, "prefix")
        marks.append(_in_subtrees(grouped.where("not is_long").drop("is_long"), window, gram))
        rest = grouped.where("is_long").drop("is_long", "prefix")
        depth *= 2
    marks.append(_at_window_depth(rest))
    return reduce(DataFrame.unionByName, marks).groupBy(F.col("key").alias("content")) \
        .agg(F.bit_or(F.expr("shiftleft(bits, place)")).alias("bits"))


def cut_repeats(texts: DataFrame, window: int = 35, gram: int = 5, group_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(key, n_words, n_removed, kept) of distinct texts (key, text, weight).

    One plan: the texts are shuffled once, by key, and that exchange is read by
    each step that needs them.
    """
    if not 0 < gram <= window or window - gram > 62:
        raise ValueError("need 0 < gram <= window and window - gram <= 62")
    texts = texts.select("key", "text", "weight")
    prefixes = texts.mapInArrow(
        _prefixes(window, gram), "prefix long, key binary, bytes long, starts long")
    # A prefix that starts at least twice; long: its stretches do not fit into one group.
    frequent = prefixes.groupBy("prefix").agg(F.sum("starts").alias("n"), F.sum("bytes").alias("bytes")) \
        .where("n >= 2").select("prefix", (F.col("bytes") > group_bytes).alias("is_long"))
    chosen = prefixes.select("prefix", "key").hint("merge").join(frequent, "prefix") \
        .groupBy("key").agg(F.collect_list(F.when(~F.col("is_long"), F.col("prefix"))).alias("short"),
                            F.collect_list(F.when(F.col("is_long"), F.col("prefix"))).alias("long"))

    def stretches(kind: str) -> DataFrame:
        some = chosen.where(F.size(kind) > 0).select("key", F.col(kind).alias("chosen"))
        return texts.hint("merge").join(some, "key").select("key", "text", "weight", "chosen").mapInArrow(
            _stretches(window, gram),
            "prefix long, content binary, key binary, place int, windows int, starts long, words binary")

    at_short = _in_subtrees(stretches("short").drop("content"), window, gram)
    # Equal stretches of all texts are one before their windows are looked at, and share its marks.
    long = stretches("long")
    contents = long.groupBy("content").agg(F.sum("starts").alias("starts"), F.min("words").alias("words"))
    at_long = long.select("content", "key", "place").hint("merge") \
        .join(_lengthened(contents, window, gram, group_bytes), "content").select("key", "place", "bits")
    marks = at_short.unionByName(at_long).groupBy("key") \
        .agg(F.collect_list(F.struct("place", "bits")).alias("marks"))
    return texts.hint("merge").join(marks, "key", "left").select("key", "text", "weight", "marks") \
        .mapInArrow(_cut(window, gram), "key binary, n_words long, n_removed long, kept string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = 35, gram: int = 5, group_bytes: int = CHUNK_BYTES) -> DataFrame:
    r"""Texts without repeated passages: (id, n_words, n_removed, kept) for every row of ``docs``.

    Words are ``[^\x20\x09-\x0D]+``, unchanged.  Every word inside a window of
    ``window`` words that also starts elsewhere (other text or the same one, overlaps
    included) is removed; all windows are judged on the input.  ``kept`` is the
    remaining words joined by one space.

    Null text: no words.  A text of fewer than ``window`` words has no window and is
    kept.  Ids are passed through, null or repeated ones too; every row counts as a
    text of its own, so two rows with one text repeat each other.  Other columns are
    ignored.  An empty table gives no rows.  Windows are told apart by 64-bit hashes
    of their words, texts by 128 bits of their SHA-256.

    ``window`` - ``gram`` must be below 63 (window marks are bits of one long).  A text is
    held whole in its task, at about 30 times its bytes (as measured at 10 MB): a text of some 50 MB is the most that
    a task of 1.5 GB takes.
    """
    rows, texts = distinct_texts(docs, id_col, text_col)
    cut = cut_repeats(texts, window, gram, group_bytes)
    return rows.join(cut, "key").select(F.col("id").alias(id_col), "n_words", "n_removed", "kept")
