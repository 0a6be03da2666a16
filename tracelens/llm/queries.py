"""The operators of this package over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelens.llm import (decontaminate, exact_dedup, html_extract, language_id, minhash_dedup, packing,
                           periodic_runs, simhash_dedup, spelling_variants, substring_dedup, training_order, url_filter,
                           warc_derive)
from tracelens.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_tree_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, texts = substring_dedup.distinct_texts(_table(spark, sf_dir, "documents"), "doc_id", "text")
    cut = substring_dedup.cut_repeats(texts).withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256))
    return rows.join(cut.drop("kept"), "key").select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op3_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, _table(spark, sf_dir, "documents"))


def op2_boosted_tree_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    model = html_extract.train(spark, pages)
    return html_extract.extract(spark, pages, model, keep=["page_id", "url"]) \
        .select("page.page_id", "page.url", "text", F.char_length("text").cast("long").alias("n_chars"))


# Fixed values of the rule list: (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


def op4_bloom_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(str(r) for r in URL_RULES) + " AS t(host, path, verdict)")
    return url_filter.judge_urls(spark, _table(spark, sf_dir, "pages"), rules)


def op5_suffix_array_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    # Where the longest verbatim match of each document lies: in the document, and in the smallest item of equal ones.
    place = F.struct(-F.col("n_words"), "word", "item_id", "item_word")
    longest = decontaminate.longest_matches(spark, docs, bench).groupBy(F.col("doc_id").alias("id")).agg(F.min(place).alias("m"))
    longest = longest.toDF("id", "m").select("id", (-F.col("m.col1")).alias("longest_words"), F.col("m.word").alias("longest_word"),
                                             F.col("m.item_id").alias("longest_item"), F.col("m.item_word").alias("longest_item_word"))
    found = decontaminate.contamination(spark, docs, bench)
    found = found.join(longest, F.col("doc_id").eqNullSafe(F.col("id")), "left")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
                        "longest_words", "longest_word", "longest_item", "longest_item_word")


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = warc_derive.responses_of_pages(_table(spark, sf_dir, "pages"))
    return warc_derive.derive(responses, "key").withColumnRenamed("key", "page_id")


def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "training-order")
    return training_order.materialise(spark, _table(spark, sf_dir, "documents"), folder)


def op8_mixture_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language_id.identify(spark, docs, language_id.train_on_kept_in(docs), keep=["doc_id"])
    return found.select("doc.doc_id", language_id.held_out("doc.doc_id").alias("held_out"), "lang_pred", "score",
                        "langs", "shares")


def op9_streaming_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(spark, _table(spark, sf_dir, "documents")).drop("keep_locator")


def op10_superminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(spark, _table(spark, sf_dir, "documents"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in every tenth document by crc32 of its id, the words go round from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    listed = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g"))
    n = F.greatest(F.size("words"), F.lit(1))
    a = F.col("g") % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("g") % 8))
    dealt = listed.select("doc_id", "text", "words", a.cast("int").alias("a"), p.cast("int").alias("p"))
    turned = F.transform("words", lambda w, i: F.when(
        i >= F.col("a"), F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))).otherwise(w))
    return dealt.select("doc_id", F.when(F.size("words") > 0, F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


def op11_branching_tandem_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_planted_runs(_table(spark, sf_dir, "documents")))
    # Runs come by start, then period: only a larger exponent takes the place of an earlier run.
    best = F.reduce(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)),
                    lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat_ws("", F.transform(line, lambda x: F.concat(x, F.lit("\n"))))
    return found.select("doc_id", "runs", "collapsed", best.alias("best"), listed.alias("listed")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_covering_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(spark, _table(spark, sf_dir, "documents"))


def with_planted_misspellings(runs: DataFrame) -> DataFrame:
    """(word): the runs (id, run), some of which lose one code point by crc32 of id and run."""
    h, size = F.crc32(F.concat_ws(":", F.col("id").cast("string"), "run").cast("binary")), F.char_length("run")
    at = (h % F.greatest(size, F.lit(1))).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return runs.select(F.when(h % 31 == 0, cut).otherwise(F.col("run")).alias("word"))


def op13_permuterm_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A run of fewer letters is no word, with or without one letter less.
    runs = spelling_variants.letter_runs(_table(spark, sf_dir, "documents"), at_least=7)
    counts = spelling_variants.word_counts(with_planted_misspellings(runs), min_letters=7, min_count=2)
    return spelling_variants.variants(spark, counts, ratio=10)


QUERIES: dict[str, Query] = {
    "op1_suffix_tree_repeats": op1_suffix_tree_repeats,
    "op2_boosted_tree_extraction": op2_boosted_tree_extraction,
    "op3_histogram_packing": op3_histogram_packing,
    "op4_bloom_url_filter": op4_bloom_url_filter,
    "op5_suffix_array_decontamination": op5_suffix_array_decontamination,
    "op6_warc_derivatives": op6_warc_derivatives,
    "op7_training_order": op7_training_order,
    "op8_mixture_language_id": op8_mixture_language_id,
    "op9_streaming_exact_dedup": op9_streaming_exact_dedup,
    "op10_superminhash_dedup": op10_superminhash_dedup,
    "op11_branching_tandem_runs": op11_branching_tandem_runs,
    "op12_covering_simhash_dedup": op12_covering_simhash_dedup,
    "op13_permuterm_spelling_variants": op13_permuterm_spelling_variants,
}

# CTEs of the SQL twins: the byte table of CRC-32, and the checksum of the text ``source`` as an expression over it.
CRC_TABLE = """crc_step(i, k, v) AS (
            SELECT i, 0, i FROM range(256) AS t(i)
            UNION ALL
            SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_step WHERE k < 8),
        crc_table AS (SELECT list(v ORDER BY i) AS crc FROM crc_step WHERE k = 8)"""
CRC32 = """xor(4294967295, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(range(0, strlen({source})), lambda b:
                ('0x' || substr(hex(encode({source})), 2 * b + 1, 2))::BIGINT)),
            lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)])))"""

ORACLE_SQL: dict[str, str] = {
    "op1_suffix_tree_repeats": r"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        win AS (
            SELECT doc_id, i, sha256(array_to_string(list_slice(words, i, i + 34), ' ')) AS h
            FROM w, unnest(range(1, greatest(len(words) - 33, 1))) AS t(i)),
        again AS (
            SELECT doc_id, i FROM win WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1)),
        gone AS (
            SELECT DISTINCT doc_id, i + k AS pos FROM again, unnest(range(0, 35)) AS t(k)),
        word AS (
            SELECT doc_id, pos, words[pos] AS word FROM w, unnest(range(1, len(words) + 1)) AS t(pos)),
        kept AS (
            SELECT word.doc_id, count(*) AS n, string_agg(word.word, ' ' ORDER BY word.pos) AS text
            FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.pos = gone.pos GROUP BY word.doc_id)
        SELECT w.doc_id, len(words) AS n_words, len(words) - coalesce(kept.n, 0) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id""",
    "op4_bloom_url_filter": r"""
        WITH rules(rhost, rpath, rverdict) AS (VALUES
            ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
            ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        rest AS (
            SELECT row_number() OVER () AS n, page_id,
                   CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
            FROM pages),
        parts AS (
            SELECT n, page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
        split AS (
            SELECT n, page_id, path,
                   translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM parts),
        fits AS (
            SELECT n, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
                   arg_max(rverdict, length(rhost || rpath)) AS verdict
            FROM split JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
            GROUP BY n)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM split LEFT JOIN fits ON split.n = fits.n""",
    "op5_suffix_array_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
        b AS (
            SELECT row_number() OVER () AS b, item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
        item AS (
            SELECT b, i, item_id, n, array_to_string(list_slice(words, i, i + n - 1), ' ') AS run
            FROM (SELECT b, item_id, words, least(13, len(words)) AS n FROM b WHERE len(words) > 0),
                 unnest(range(1, len(words) - n + 2)) AS t(i)),
        sizes AS (SELECT DISTINCT n FROM item),
        win AS (
            SELECT doc_id, i, n, array_to_string(list_slice(words, i, i + n - 1), ' ') AS run
            FROM d, sizes, unnest(range(1, greatest(len(words) - n + 2, 1))) AS t(i)),
        hit AS (SELECT win.doc_id, win.i, win.n, item.item_id, item.b, item.i AS j FROM win JOIN item ON win.run = item.run),
        diagonal AS (
            SELECT doc_id, b, item_id, i, j, n, i - row_number() OVER (PARTITION BY doc_id, b, i - j ORDER BY i) AS island FROM hit),
        match AS (
            SELECT doc_id, item_id, min(i) - 1 AS word, min(j) - 1 AS item_word, count(*) - 1 + max(n) AS n
            FROM diagonal GROUP BY doc_id, b, item_id, i - j, island),
        longest AS (
            SELECT * FROM match QUALIFY row_number() OVER (
                PARTITION BY doc_id ORDER BY n DESC, word, CAST(item_id AS VARCHAR), item_word) = 1),
        word AS (
            SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, unnest(range(0, n)) AS t(k) GROUP BY doc_id),
        found AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
        SELECT d.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated, longest.n AS longest_words,
               longest.word AS longest_word, CAST(longest.item_id AS VARCHAR) AS longest_item, longest.item_word AS longest_item_word
        FROM d LEFT JOIN word ON d.doc_id = word.doc_id LEFT JOIN found ON d.doc_id = found.doc_id
               LEFT JOIN longest ON d.doc_id = longest.doc_id""",
    "op9_streaming_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "op11_branching_tandem_runs": rf"""
        WITH RECURSIVE {CRC_TABLE},
        d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   {CRC32.format(source="CAST(doc_id AS VARCHAR)")} AS h
            FROM documents, crc_table),
        place AS (SELECT doc_id, w, h, h // 10 % greatest(len(w), 1) AS a FROM d),
        turn AS (SELECT doc_id, w, h, a, 1 + (len(w) - a) // (3 + h // 10 % 8) AS p FROM place),
        t AS (
            SELECT doc_id, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN list_transform(range(0, len(w)), lambda i:
                       w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE w END AS w FROM turn),
        -- A run of four periods holds a multiple of its period that is equal to the next two.
        asked AS (
            SELECT doc_id, w, unnest(list_filter(range(1, len(w) // 4 + 1), lambda p:
                       len(list_filter(range(1, len(w) - 2 * p + 1, p), lambda i:
                           w[i] = w[i + p] AND w[i] = w[i + 2 * p])) > 0)) AS period FROM t),
        same AS (
            SELECT doc_id, period, unnest(list_filter(range(0, len(w) - period), lambda i:
                       w[i + 1] = w[i + period + 1])) AS i FROM asked),
        stretch AS (
            SELECT doc_id, period, i, i - row_number() OVER (PARTITION BY doc_id, period ORDER BY i) AS island FROM same),
        long AS (
            SELECT doc_id, period, min(i) AS start, count(*) + period AS length FROM stretch GROUP BY doc_id, period, island
            HAVING count(*) + period >= greatest(6, 4 * period)),
        runs AS (SELECT doc_id, start, length, min(period) AS period FROM long GROUP BY doc_id, start, length),
        listed AS (
            SELECT doc_id, count(*) AS n, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS line
            FROM runs GROUP BY doc_id),
        best AS (
            SELECT * FROM runs QUALIFY row_number() OVER (
                PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
        word AS (SELECT doc_id, i, w[i + 1] AS word FROM t, unnest(range(0, len(w))) AS u(i)),
        kept AS (
            SELECT word.doc_id, string_agg(word.word, ' ' ORDER BY word.i) AS text
            FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i GROUP BY word.doc_id)
        SELECT t.doc_id, coalesce(listed.n, 0) AS n_runs, best.start, best.length, best.period,
               1000 * best.length // best.period AS exponent_milli, sha256(coalesce(listed.line, '')) AS runs_sha256,
               sha256(coalesce(kept.text, '')) AS collapsed_sha256
        FROM t LEFT JOIN listed ON t.doc_id = listed.doc_id LEFT JOIN best ON t.doc_id = best.doc_id
               LEFT JOIN kept ON t.doc_id = kept.doc_id""",
    "op13_permuterm_spelling_variants": rf"""
        WITH RECURSIVE {CRC_TABLE},
        run AS (
            SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
        counted AS (
            SELECT doc_id, run, count(*) AS n, CAST(doc_id AS VARCHAR) || ':' || run AS named
            FROM run WHERE length(run) >= 7 GROUP BY doc_id, run),
        hashed AS (SELECT run, n, {CRC32.format(source="named")} AS h FROM counted, crc_table),
        word AS (
            SELECT word, sum(n)::BIGINT AS n FROM (
                SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                               ELSE run END AS word FROM hashed)
            WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        less AS (
            SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS rest
            FROM word, unnest(range(1, length(word) + 1)) AS t(i)),
        pair AS (
            SELECT a.word, b.word AS other FROM less AS a JOIN less AS b
            ON a.i = b.i AND a.head = b.head AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT a.word, b.word FROM less AS a JOIN word AS b ON a.head || a.rest = b.word
            UNION SELECT b.word, a.word FROM less AS a JOIN word AS b ON a.head || a.rest = b.word),
        best AS (
            SELECT pair.word, count(*) AS n_near, max(word.n) AS form_n, arg_min(other, (-word.n, encode(other))) AS form
            FROM pair JOIN word ON pair.other = word.word GROUP BY pair.word),
        found AS (
            SELECT word.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form,
                   CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
            FROM word LEFT JOIN best ON word.word = best.word),
        way(word, root, onward) AS (
            SELECT word, word, form FROM found
            UNION ALL
            SELECT way.word, found.word, found.form FROM way JOIN found ON way.onward = found.word)
        SELECT found.*, way.root FROM found JOIN way ON found.word = way.word AND way.onward IS NULL""",
}
