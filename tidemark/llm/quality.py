"""Quality rules: a log-likelihood ratio of hashed word n-grams, and plain measures of a text.

Two multinomials over hashed word unigrams and bigrams are fitted: one on trusted documents, one on the
whole raw corpus.  A document's score is the mean over its n-grams of log p(trusted) - log p(raw).  Every
document is judged by the same threshold on that score.

Everything is built-in expressions.  The measures of one text are computed inside its row, so nothing but
counts per bucket is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import _q, carried

BUCKETS = 1 << 14
TRUSTED = 4096  # documents the trusted multinomial is fitted on at most (those with the smallest hash of their id)
THRESHOLD = -0.1  # of the score; trusted documents lie around +0.02, junk below -0.1
WHITE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text; none of a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def _bucket(*columns: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).cast("int")


def _pairs(words: Column) -> Column:
    """Each word with the next (the last one with null)."""
    return F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               buckets: int = BUCKETS, most_trusted: int = TRUSTED) -> DataFrame:
    """One row with the array `ratios`: log p(trusted) - log p(raw) by bucket.

    The raw counts have one added each; the trusted ones are drawn towards the raw multinomial as if it had
    been seen once per bucket, so a small trusted set says little rather than something wrong.

    `trusted` has ids of trusted documents.  The raw multinomial counts all documents; the trusted one is
    fitted on `most_trusted` of them at most, whose ids are broadcast.
    """
    ids = (trusted.select(F.col(_q(id_col)).alias("trusted_id")).filter("trusted_id IS NOT NULL").distinct()
           .orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(most_trusted))
    rows = docs.select(F.col(_q(id_col)).alias("doc_id"), words_of(F.col(_q(text_col))).alias("words"))
    rows = rows.join(F.broadcast(ids), rows["doc_id"] == ids["trusted_id"], "left")
    grams = F.concat(F.transform("words", lambda w: _bucket(w)), F.zip_with("words", _pairs(F.col("words")), lambda a, b: _bucket(a, b)))
    seen = rows.select(F.col("trusted_id").isNotNull().cast("long").alias("good"), F.explode(grams).alias("bucket"))
    counts = seen.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("good"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("long").alias("raw"),
                                                    F.lit(0).cast("long").alias("good"))
    counts = counts.unionByName(every).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
    whole = counts.agg(F.array_sort(F.collect_list(F.struct("bucket", "raw", "good"))).alias("all"),
                       F.sum("raw").alias("n_raw"), F.sum("good").alias("n_good"))
    def ratio(bucket):
        raw = (bucket["raw"] + 1) / (F.col("n_raw") + buckets)
        return F.log((bucket["good"] + buckets * raw) / (F.col("n_good") + buckets) / raw)

    return whole.select(F.transform("all", ratio).alias("ratios"))


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often `body` uses it and wherever the optimizer moves it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _windows(words: Column) -> Column:
    """Hash and start of each three-word window."""
    n = F.size(words)
    return F.when(n < 3, F.array().cast("array<struct<h:bigint,i:int>>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
        lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i"))))


def repeat_words(words: Column) -> Column:
    """How many words lie in three-word windows that occur twice or more.

    Equal neighbours among the windows in order of their hash give the starts of repeated ones; each start
    covers three words, or those up to the next start.
    """
    def starts(windows):
        repeated = F.filter(windows, lambda w, k: (w["h"] == F.get(windows, k + 1)["h"]) | (
            (k > 0) & (w["h"] == F.get(windows, F.greatest(k - 1, F.lit(0)))["h"])))
        return F.sort_array(F.transform(repeated, lambda w: w["i"]))

    def covered(places):
        reach = F.transform(places, lambda s, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - s, F.lit(3))))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda total, x: total + x)

    return _let(F.sort_array(_windows(words)), lambda windows: _let(starts(windows), covered))


def mean_ratio(words: Column, ratios: Column) -> Column:
    """Mean of the log ratios of a text's unigrams and bigrams; null without words."""
    sums = F.zip_with(words, _pairs(words), lambda a, b: F.get(ratios, _bucket(a)) + F.get(ratios, _bucket(a, b)))
    return F.when(F.size(words) > 0, F.aggregate(sums, F.lit(0.0), lambda total, x: total + x) / (2 * F.size(words)))


def quality_rules(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD, carry: bool = False) -> DataFrame:
    """Measures and verdict of every document.

    Returns doc_id, n_words, word_chars (code points in words), n_symbols (characters of `[#*$%&|<>]`),
    n_dup_lines (lines with a word that equal an earlier line), n_repeat_words (words in three-word windows
    found twice or more in the text), score, base_failed (fewer than 50 words, or more than half of them
    repeated) and kept (not base_failed, and a score of `threshold` or more); one row per row of `docs`,
    with `carry` also the whole input row as the struct `row`.

    Nulls: a null text has no words and fails; a null id is never trusted.  Repeated documents are judged
    alike, and all of them count for the raw corpus; repeated ids in `trusted` count once.  A score equal to
    the threshold is kept.  Empty tables: no rows; without trusted documents every score is 0.  Texts are never cut.
    """
    # As many numbers as there are buckets come to the driver and go into the plan as one constant array.
    ratios = log_ratios(docs, trusted, id_col, text_col).first()["ratios"]
    ratios = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    text = F.coalesce("text", F.lit(""))
    measured = _let(words_of(F.col("text")), lambda words: F.struct(
        F.size(words).cast("long").alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        repeat_words(words).alias("n_repeat_words"), mean_ratio(words, ratios).alias("score")))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    again = _let(lines, lambda some: F.size(some) - F.size(F.array_distinct(some)))
    rows = carried(docs, id_col, text_col, carry).select(
        "doc_id", measured.alias("m"), F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        again.cast("long").alias("n_dup_lines"), *(["row"] if carry else []))
    rows = rows.select("doc_id", "m.n_words", "m.word_chars", "n_symbols", "n_dup_lines", "m.n_repeat_words", "m.score",
                       *(["row"] if carry else []))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # The last term is always true.  It only keeps a filter on `kept` above the measures, which would else be
    # computed once for the filter and once for its result.
    passed = (F.coalesce("score", F.lit(0.0)) >= threshold) & (F.monotonically_increasing_id() >= 0)
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & passed)
