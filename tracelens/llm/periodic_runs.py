"""Runs of repeated words, by an enhanced suffix array and the branching-tandem test.

1. All texts of a block share one suffix array over words, by prefix doubling; a
   word counts as a symbol of its own text, so suffixes of two texts never meet.
   The ranks of every doubling stay: equal ranks at level k are equal runs of 2**k words.
2. Each place of the LCP array with value d > 0 parts an LCP interval of depth d into
   a left and a right side.  The suffixes i of the smaller side look up ISA[i + d] and
   ISA[i - d]: if that rank is on the other side, the two suffixes share exactly d
   words, and a square of 2 * d words starts at the earlier one which does not go on
   to the right.  Each suffix is on a smaller side at most log2(n) times.
3. Such a square is rotated to the left as far as its period holds (descending the
   levels), which gives the whole run it ends.  Squares of one run with multiples of
   its period end in the same stretch and merge to the smallest period.

Everything is array work over a block; there are no tree nodes.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelens.llm import text as tx
from tracelens.llm.store import columns_first

CHUNK = 1 << 21  # suffixes looked up at once


def suffix_levels(code: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, up to the level where all differ.

    ``code``: a number for each word, equal for equal words; ``first``: first word of each text, and the end.
    Each array has one more value at its end, which equals no rank.
    """
    n, texts = len(code), len(first) - 1
    text = np.repeat(np.arange(texts), np.diff(first))
    end = first[1:][text]
    key = text * (int(code.max()) + 1) + code
    open_at = np.argsort(key)  # places in suffix order; later only those of ranks that are shared
    key = key[open_at]
    rank = np.full(n + 1, -1, dtype=np.int32)
    base = np.zeros(n, dtype=np.int64)  # of each open place: the rank of its group so far, which starts there
    levels, step = [], 0
    while True:
        new = np.ones(len(open_at), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (base[1:] != base[:-1])
        at = np.arange(len(open_at))
        group = np.maximum.accumulate(np.where(new, at, 0))  # first of equal ones
        old = np.ones(len(open_at), dtype=bool)
        old[1:] = base[1:] != base[:-1]
        rank[open_at] = base + group - np.maximum.accumulate(np.where(old, at, 0))
        levels.append(rank.copy())
        alone = new.copy()
        alone[:-1] &= new[1:]
        open_at = open_at[~alone]
        if not len(open_at):
            return levels
        step = max(1, 2 * step)
        ahead = open_at + step
        inside = ahead < end[open_at]
        follow = np.where(inside, rank[np.minimum(ahead, n)], -1).astype(np.int64)
        base = rank[open_at].astype(np.int64)
        order = np.argsort(base * (n + 2) + follow + 1)
        open_at, base, key = open_at[order], base[order], follow[order]


def common_prefix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes at ``a`` and ``b`` (never the same place) share."""
    a, b = a.copy(), b.copy()
    start = a.copy()
    for k in range(len(levels) - 1, -1, -1):
        step = (levels[k][a] == levels[k][b]).astype(np.int64) << k
        a += step
        b += step
    return a - start


def previous_below(value: np.ndarray, or_equal: bool) -> np.ndarray:
    """For each place with a value above 0: the nearest earlier one with a smaller (or equal) value.

    The first place must have value 0.  Candidates jump to the candidates of what they meet;
    the few that are left after some rounds descend a table of range minima.
    """
    at = np.arange(len(value))
    to = np.where(value > 0, at - 1, at)
    wrong = np.greater if or_equal else np.greater_equal
    rest = np.flatnonzero(value > 0)
    for _ in range(24):
        rest = rest[wrong(value[to[rest]], value[rest])]
        if not len(rest):
            return to
        to[rest] = to[to[rest]]
    rest = rest[wrong(value[to[rest]], value[rest])]
    least, width = [value], 1  # least[k][i]: minimum of the 2**k values that end at i
    while 2 * width <= len(value):
        both = least[-1].copy()
        both[width:] = np.minimum(both[width:], least[-1][:-width])
        least.append(both)
        width *= 2
    pos = to[rest]
    for k in range(len(least) - 1, -1, -1):
        good = (pos >= 1 << k) & wrong(least[k][pos], value[rest])
        pos = pos - (good.astype(np.int64) << k)
    to[rest] = pos
    return to


def branching_squares(levels: list[np.ndarray], first: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, half length) of all squares that do not go on to the right with the same period.

    ``most``: of each text, the longest half length to look for.
    """
    n = len(levels[-1]) - 1
    isa = levels[-1].astype(np.int64)  # all differ: ranks are places in the array
    sa = np.empty(n, dtype=np.int64)
    sa[isa[:n]] = np.arange(n)
    lcp = np.zeros(n + 1, dtype=np.int64)
    lcp[1:n] = common_prefix(levels, sa[:-1], sa[1:])
    left = previous_below(lcp, or_equal=False)
    right = n - previous_below(lcp[::-1].copy(), or_equal=True)[::-1]
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero((lcp[:n] > 0) & (lcp[:n] <= most[text[sa]]))
    lo, hi, depth = left[at], right[at], lcp[at]
    left_is_small = at - lo <= hi - at
    small = np.where(left_is_small, lo, at)
    size = np.where(left_is_small, at - lo, hi - at)
    other, other_end = np.where(left_is_small, at, lo), np.where(left_is_small, hi, at)
    total = np.concatenate([[0], np.cumsum(size)])
    starts, halves = [], []
    begin = 0
    while begin < len(at):
        end = max(begin + 1, int(np.searchsorted(total, total[begin] + CHUNK, side="right")) - 1)
        which = np.repeat(np.arange(begin, end), size[begin:end])
        suffix = sa[small[which] + np.arange(len(which)) - (total[which] - total[begin])]
        d, from_, to = depth[which], other[which], other_end[which]
        rank = isa[suffix + d]
        hit = (rank >= from_) & (rank < to)
        starts.append(suffix[hit])
        halves.append(d[hit])
        rank = isa[np.maximum(suffix - d, 0)]
        hit = (rank >= from_) & (rank < to) & (suffix >= d)
        starts.append(suffix[hit] - d[hit])
        halves.append(d[hit])
        begin = end
    if not starts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(starts), np.concatenate(halves)


def runs_of_block(code: np.ndarray, first: np.ndarray, min_length: int,
                  min_exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of a block's texts, by start, then period; places count over the block."""
    none = np.zeros(0, dtype=np.int64)
    if len(code) < 2:
        return none, none, none
    levels = suffix_levels(code, first)
    square, period = branching_squares(levels, first, np.diff(first) // min_exponent)
    end = square + 2 * period
    lowest = first[np.searchsorted(first, square, side="right") - 1]  # empty texts start at the same place
    start = square.copy()
    for k in range(len(levels) - 1, -1, -1):
        back = start - (1 << k)
        inside = back >= lowest
        back = np.where(inside, back, start)
        start = np.where(inside & (levels[k][back] == levels[k][back + period]), back, start)
    good = end - start >= np.maximum(min_length, min_exponent * period)
    start, end, period = start[good], end[good], period[good]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    keep = np.ones(len(start), dtype=bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _find(min_length: int, min_exponent: int):
    is_word = tx.space_words()
    run_type = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def run(batches):
        for batch in batches:
            for lo, hi, buf, offsets in tx.blocks(batch.column("text")):
                starts, ends, first = tx.words(buf, offsets, is_word)
                _, code = np.unique(tx.hash_words(buf, starts, ends), return_inverse=True)
                begin, end, period = runs_of_block(code, first, min_length, min_exponent)
                gone = np.zeros(len(starts) + 1, dtype=np.int64)
                np.add.at(gone, begin + period, 1)
                np.add.at(gone, end, -1)
                stays = np.cumsum(gone[:-1]) == 0
                of = np.searchsorted(begin, first)
                data, collapsed = buf.tobytes(), []
                for d in range(hi - lo):
                    s, e = int(first[d]), int(first[d + 1])
                    pieces = data[starts[s]:ends[e - 1]].split() if e > s else []
                    collapsed.append(b" ".join(compress(pieces, stays[s:e].tolist()) if of[d + 1] > of[d] else pieces))
                text = np.repeat(np.arange(hi - lo), np.diff(of))
                values = pa.StructArray.from_arrays(
                    [pa.array(begin - first[text]), pa.array(end - begin), pa.array(period)], fields=list(run_type))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(of, pa.int32()), values),
                     pa.array(collapsed, pa.binary()).cast(pa.string())], names=["id", "runs", "collapsed"])
    return run


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6,
              min_exponent: int = 4) -> DataFrame:
    r"""Periodic runs of words: (id, runs, collapsed) of every row of ``docs``.

    Words are ``[^\x20\x09-\x0D]+``, unchanged, numbered from 0 in each text.  A run is a
    stretch of words with smallest period q (words q apart are equal) that no neighbouring
    word extends, of ``min_length`` words and ``min_exponent`` (2 or more) periods at least.
    ``runs``: array of (start, length, period), by start, then period.  ``collapsed``: the
    words that no run contains after its first q words, joined by one space.

    Null, empty or blank text: no runs and an empty ``collapsed``.  Ids are passed through,
    null and repeated ones too; every row is judged by itself.  Other columns are ignored.
    An empty table gives no rows.  Words are told apart by 64-bit hashes.

    One map without a shuffle.  A text is held whole in its task: a block takes some 40 times its
    bytes, a very long text is a block of its own.
    """
    if min_exponent < 2:
        raise ValueError("min_exponent must be 2 or more")
    rows = columns_first(docs, id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    return rows.mapInArrow(
        _find(min_length, min_exponent),
        f"id {rows.schema['id'].dataType.simpleString()}, runs array<struct<start:long,length:long,period:long>>,"
        " collapsed string").withColumnRenamed("id", id_col)
