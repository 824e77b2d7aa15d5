"""Quality rules: base checks and a hashed n-gram log-likelihood ratio.

A document's n-grams (single pieces and neighbouring pairs) are hashed to a fixed number of
bins. Two multinomials over the bins, one of the trusted documents and one of the whole
corpus, give each bin the log of their ratio; a document's score is the mean over its n-grams,
so length does not matter. A document is kept when it passes the base checks and its score
reaches a fixed threshold: the same text always gets the same verdict from the same tables.

The trusted rows are a documented, bounded sample (``trusted_ids``); the corpus counts cover
every document. Everything is DataFrame expressions.

Defined results: null and empty texts have no words and fail the base check; repeated rows
are counted and judged each; without trusted rows every score is 0; an empty table gives no
rows; further columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayloom.llm.common import SPACES, named, words, written

#: Pieces of n-grams: runs of letters, of digits, or of other marks.
PIECE = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+"
SYMBOLS = "#*$%&|<>"
BINS = 1 << 14
#: Most trusted rows the target multinomial is fitted on: 160 KB of ids, broadcast.
TRUSTED_ROWS = 20_000
#: Least mean log ratio, in nats for each n-gram, of a document that is kept.
THRESHOLD = -0.25
MIN_WORDS, WINDOW, REPEAT_PERCENT = 20, 8, 30


def trusted_ids(labels: DataFrame, doc_id: str = "doc_id", rows: int = TRUSTED_ROWS) -> DataFrame:
    """Ids of documents labelled good and not toxic; at most ``rows``, by the hash of the id."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0").where(F.col(doc_id).isNotNull())
    return good.select(F.col(doc_id).cast("long").alias("trusted_id")).distinct().orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(rows)


def ngram_bins(text: Column, bins: int = BINS) -> Column:
    """Bins of the pieces and of the neighbouring pairs of a text, as one array."""
    pieces = F.transform(
        F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), F.lit(0)), lambda p: F.xxhash64(p)
    )
    return F.flatten(F.transform(F.array(pieces), lambda h: F.concat(
        F.transform(h, lambda x: F.pmod(x, F.lit(bins)).cast("int")),
        F.transform(F.slice(h, F.lit(2), F.greatest(F.size(h) - 1, F.lit(0))),
                    lambda x, i: F.pmod(F.xxhash64(F.get(h, i), x), F.lit(bins)).cast("int")),
    )))


def bin_weights(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text", bins: int = BINS) -> DataFrame:
    """One row with ``weights``: the log ratio of each bin, add-one smoothed.

    Counts are summed within tasks, so at most ``bins`` rows leave each.
    """
    flagged = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text")).join(
        F.broadcast(trusted), F.col("_id") == F.col("trusted_id"), "left"
    ).select(F.when(F.col("trusted_id").isNotNull(), 1).otherwise(0).alias("trusted"), F.explode(ngram_bins(F.col("_text"), bins)).alias("bin"))
    counts = flagged.groupBy("bin").agg(F.sum("trusted").alias("t"), F.count("*").alias("r"))
    every = docs.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).join(counts, "bin", "left").na.fill(0)
    sums = every.agg(
        F.sum("t").alias("nt"), F.sum("r").alias("nr"),
        F.transform(F.sort_array(F.collect_list(F.struct("bin", "t", "r"))), lambda c: F.struct(c["t"].alias("t"), c["r"].alias("r"))).alias("counts"),
    )
    ratio = lambda c: (
        F.log((c["t"] + 1) / (F.col("nt") + bins)) - F.log((c["r"] + 1) / (F.col("nr") + bins))
    )
    return sums.select(F.when(F.col("nt") > 0, F.transform("counts", ratio)).otherwise(F.array_repeat(F.lit(0.0), bins)).alias("weights"))


def repeated_words(found: Column) -> Column:
    """Words inside windows of eight words that occur twice or more.

    Hashes of the windows tell whether any repeats; only then are the windows themselves
    sorted and compared with their neighbours.
    """
    span = F.sequence(F.lit(1), F.size(found) - WINDOW + 1)
    hashes = F.transform(F.array(F.transform(found, lambda w: F.xxhash64(w))), lambda h: F.transform(
        span, lambda i: F.xxhash64(*(F.get(h, i + (j - 1)) for j in range(WINDOW)))))
    repeats = F.size(F.array_distinct(hashes[0])) < F.size(found) - WINDOW + 1
    ordered = F.sort_array(F.transform(span, lambda i: F.struct(
        F.array_join(F.slice(found, i, F.lit(WINDOW)), " ").alias("w"), i.alias("at"))))
    starts = F.transform(F.array(ordered), lambda s: F.sort_array(F.transform(
        F.filter(F.transform(s, lambda x, i: F.struct(x["at"].alias("at"), (
            F.coalesce(x["w"] == F.get(s, i - 1)["w"], F.lit(False)) | F.coalesce(x["w"] == F.get(s, i + 1)["w"], F.lit(False))
        ).alias("twice"))), lambda x: x["twice"]), lambda x: x["at"])))[0]
    covered = F.transform(F.array(starts), lambda s: F.aggregate(
        F.transform(s, lambda x, i: F.least(F.coalesce(F.get(s, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))), F.lit(0), lambda a, x: a + x))[0]
    return F.when(F.size(found) < WINDOW, 0).when(repeats, covered).otherwise(0).cast("long")


def judge_quality(docs: DataFrame, weights: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                  threshold: float = THRESHOLD, bins: int = BINS) -> DataFrame:
    """``keep`` and a struct column ``quality`` of the base figures, the score and the verdict."""
    table = weights.select("weights").scalar()
    rows = docs.select(*(named(c).alias(f"_keep_{i}") for i, c in enumerate(keep)), F.col(text).alias("_text"))
    rows = rows.withColumn("_found", words(F.col("_text"))).withColumn("_grams", ngram_bins(F.col("_text"), bins))
    full = F.coalesce(F.col("_text"), F.lit(""))
    lines = F.filter(F.split(full, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    rows = rows.select(
        "*", table.alias("_weights"), lines.alias("_lines"), F.size("_found").cast("long").alias("_n"),
        repeated_words(F.col("_found")).alias("_repeat"),
    )
    score = F.aggregate("_grams", F.lit(0.0), lambda a, b: a + F.get("_weights", b)) / F.size("_grams")
    failed = (F.col("_n") < MIN_WORDS) | (100 * F.col("_repeat") > REPEAT_PERCENT * F.col("_n"))
    judged = rows.select(
        "*", failed.alias("_failed"), F.when(F.size("_grams") > 0, score).otherwise(0.0).alias("_score")
    )
    return judged.select(
        *(F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)),
        F.struct(
            F.col("_n").alias("n_words"),
            F.length(F.translate(full, SPACES, "")).cast("long").alias("word_chars"),
            (F.length(full) - F.length(F.translate(full, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.col("_repeat").alias("n_repeat_words"),
            F.col("_failed").alias("base_failed"),
            (~F.col("_failed") & (F.col("_score") >= threshold)).alias("kept"),
            F.col("_score").alias("score"),
        ).alias("quality"),
    )


def quality_rules(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD, bins: int = BINS) -> DataFrame:
    """Fits the ratios on ``docs`` and judges every document of it."""
    weights = written(bin_weights(docs, trusted_ids(labels, doc_id), doc_id, text, bins), "quality-weights")
    return judge_quality(docs, weights, text, keep, threshold, bins)
