"""Language identification by multilingual mixture inference.

Training counts byte trigrams of words per language over all labelled texts and
turns them into smoothed log-probabilities.  A text is then a mixture: each of
its words comes from one of the languages, with unknown proportions.
Expectation-maximisation estimates the proportions from the words' trigram
likelihoods; languages are taken away one by one while that costs less
likelihood than the penalty for keeping them, and the largest remaining
proportion names the language.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from tracelens.llm import text as tx

BUCKETS = 1 << 16  # trigrams are hashed into so many counters per language
UNKNOWN = "und"
MOST_LANGS = 256  # 0.25 MB of the model each


def letter_bytes() -> np.ndarray:
    """Byte table: ASCII letters and every byte of a multi-byte character."""
    out = np.zeros(256, dtype=bool)
    out[0x41:0x5B] = True
    out[0x61:0x7B] = True
    out[0x80:] = True
    return out


def trigrams(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Bucket of the trigram around each letter byte, word by word; a word's sides count as spaces."""
    size = ends - starts
    base = np.cumsum(size) - size
    place = np.repeat(starts - base, size) + np.arange(int(size.sum()))
    own = buf[place].astype(np.uint32)
    before, after = np.empty_like(own), np.empty_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[base] = 0x20
    after[base + size - 1] = 0x20
    gram = (before << np.uint32(16)) | (own << np.uint32(8)) | after
    return (gram * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.int64)


def _count(batches):
    """Rows (lang, bucket, n) of one task: at most one per language and bucket."""
    counts: dict[str, np.ndarray] = {}
    lower, letters = tx.lower_ascii(), letter_bytes()
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for lo, hi, buf, offsets in tx.blocks(batch.column("text")):
            buf = lower[buf]
            starts, ends, first = tx.words(buf, offsets, letters)
            if not len(starts):
                continue
            bucket = trigrams(buf, starts, ends)
            at = np.append(0, np.cumsum(ends - starts))[first]
            for d in range(hi - lo):
                have = counts.setdefault(langs[lo + d], np.zeros(BUCKETS, dtype=np.int64))
                np.add.at(have, bucket[at[d]:at[d + 1]], 1)
    for lang, have in counts.items():
        some = np.flatnonzero(have)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(have[some])],
            names=["lang", "bucket", "n"])


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5,
          most_langs: int = MOST_LANGS) -> SimpleNamespace:
    """The trigram model of the labelled texts: languages, sorted, and a (bucket, language) table of log-probabilities.

    All rows with a text and a label count.  What reaches the driver is at most
    ``BUCKETS`` counters per language.  The model is held whole by the driver and every task, so more than
    ``most_langs`` labels (a column that holds no languages) are refused.
    """
    known = labelled.select(F.col(lang_col).cast("string").alias("lang")).where("lang is not null").distinct()
    if (n := known.limit(most_langs + 1).count()) > most_langs:
        raise ValueError(f"{lang_col} has {n} labels or more; at most {most_langs} languages fit the model")
    rows = labelled.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .where("text is not null and lang is not null")
    counts = rows.mapInArrow(_count, "lang string, bucket int, n long") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    own = np.array(counts["lang"].to_pylist(), dtype=object)
    langs = sorted(set(own))
    table = np.full((BUCKETS, len(langs)), smoothing)
    for k, lang in enumerate(langs):
        table[counts["bucket"].to_numpy()[own == lang], k] += counts["n"].to_numpy()[own == lang]
    log_p = np.log(table / table.sum(axis=0)) if langs else table
    return SimpleNamespace(langs=langs, log_p=log_p.astype(np.float32))


def mixture(ll: np.ndarray, first: np.ndarray, allowed: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (text, language) and log-likelihood of each text, by expectation-maximisation.

    ``ll``: likelihood of each word per language, scaled by the word's best one (in (0, 1]);
    ``first``: each text's first word; every text has a word and an allowed language.
    """
    n = np.diff(first)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(steps):
        part = ll * np.repeat(share, n, axis=0)
        part /= part.sum(axis=1, keepdims=True)
        share = np.add.reduceat(part, first[:-1], axis=0) / n[:, None]
    total = (ll * np.repeat(share, n, axis=0)).sum(axis=1)
    return share, np.add.reduceat(np.log(total), first[:-1])


def choose(ll: np.ndarray, first: np.ndarray, penalty: float, steps: int) -> np.ndarray:
    """Proportions of the chosen languages (0 for the others).

    From all languages, the one with the smallest proportion is taken away as long as the
    log-likelihood falls by less than ``penalty`` * log(words + 1).
    """
    n = np.diff(first)
    langs = ll.shape[1]
    allowed = np.ones((len(n), langs), dtype=np.float32)
    share, like = mixture(ll, first, allowed, steps)
    active = np.arange(len(n))
    for left in range(langs - 1, 0, -1):
        if not len(active):
            break
        fewer = allowed[active].copy()
        weakest = np.where(fewer > 0, share[active], np.inf).argmin(axis=1)
        fewer[np.arange(len(active)), weakest] = 0
        words = np.concatenate([np.arange(first[d], first[d + 1]) for d in active])
        own = np.append(0, np.cumsum(n[active]))
        new_share, new_like = mixture(ll[words], own, fewer, steps)
        better = like[active] - new_like < penalty * np.log(n[active] + 1)
        done = active[better]
        share[done], like[done], allowed[done] = new_share[better], new_like[better], fewer[better]
        active = done
    return share


def _predict(model, penalty: float, steps: int):
    def run(batches):
        langs, log_p = model.value.langs, model.value.log_p
        lower, letters = tx.lower_ascii(), letter_bytes()
        for batch in batches:
            column = batch.column("text")
            for lo, hi, buf, offsets in tx.blocks(column):
                starts, ends, first = tx.words(buf, offsets, letters)
                n = np.diff(first)
                known = n > 0
                plain = np.zeros(len(buf) + 1, dtype=np.int64)
                np.cumsum(letters[buf] & (buf < 0x80), out=plain[1:])
                for d in np.flatnonzero(known & (plain[offsets[1:]] == plain[offsets[:-1]])):
                    # Only multi-byte characters: letters, or signs and pictures.
                    own = buf[offsets[d]:offsets[d + 1]].tobytes().decode("utf-8", "replace")
                    known[d] = any(c.isalpha() for c in own)
                share = np.zeros((hi - lo, max(len(langs), 1)), dtype=np.float32)
                some = np.flatnonzero(n > 0)
                if len(some) and langs:
                    bucket = trigrams(lower[buf], starts, ends)
                    size = ends - starts
                    word = np.add.reduceat(log_p[bucket], np.cumsum(size) - size, axis=0)
                    word = np.exp(np.maximum(word - word.max(axis=1, keepdims=True), -60))
                    share[some] = choose(word, np.append(0, np.cumsum(n[some])), penalty, steps)
                best = share.argmax(axis=1)
                pred = [langs[b] if k and langs else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
                score = np.where(known & bool(langs), share[np.arange(hi - lo), best], 0.0)
                order = np.argsort(-share, axis=1, kind="stable")
                mix = [[(langs[j], float(share[i, j])) for j in order[i].tolist() if share[i, j] > 0]
                       if known[i] and langs else [] for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(lo, hi - lo), pa.array(pred, pa.string()),
                     pa.array(np.clip(score, 0.0, 1.0).astype(np.float64)),
                     pa.array([[m[0] for m in row] for row in mix], pa.list_(pa.string())),
                     pa.array([[m[1] for m in row] for row in mix], pa.list_(pa.float64()))],
                    names=["doc", "lang_pred", "score", "langs", "shares"])
    return run


def identify(spark: SparkSession, docs: DataFrame, model: SimpleNamespace, text_col: str = "text",
             keep: list[str] | None = None, penalty: float = 2.0, steps: int = 6) -> DataFrame:
    """(doc, lang_pred, score, langs, shares) of every row of ``docs``; doc: its columns ``keep`` (all) as one struct.

    ``langs`` are the chosen languages, largest share first, ``shares`` their proportions of
    the text's words; ``lang_pred`` is the first one and ``score`` its share.

    Null text, or one without a letter: ``und`` with score 0 and no languages; so is every
    text if the model has no language.  Only the text is looked at, whole; each row is judged
    alone, repeated ones alike.  An empty table gives no rows.  Equal shares: the language
    that sorts first.  Proportions are those after ``steps`` rounds of expectation-maximisation,
    which rarely differ from the limit in more than the second digit, and in the language hardly ever (tested).
    """
    rows = docs.select(F.struct(*[docs[c] for c in keep or docs.columns]).alias("doc"),
                       docs[text_col].cast("string").alias("text"))
    schema = StructType([rows.schema["doc"], StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                         StructField("langs", ArrayType(StringType())), StructField("shares", ArrayType(DoubleType()))])
    return rows.mapInArrow(_predict(spark.sparkContext.broadcast(model), penalty, steps), schema)


def held_out(id_col: str):
    """True for the rows that training leaves out: crc32 of the id as text, modulo 4, is 2 (null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_on_kept_in(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> SimpleNamespace:
    """Model of the labelled rows that are not held out; rows without an id are not learned from."""
    return train(docs.where(F.col(id_col).isNotNull() & ~held_out(id_col)), text_col, lang_col)


def drop_unknown(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, with their columns, whose text has a language.

    Without a usable label no language can be told: every text with a letter stays.
    """
    model = train_on_kept_in(docs, id_col, text_col, lang_col)
    if not model.langs:
        return docs.where(F.col(text_col).cast("string").rlike(r"\p{L}"))
    found = identify(spark, docs, model, text_col)
    return found.where(F.col("lang_pred") != UNKNOWN).select("doc.*")
