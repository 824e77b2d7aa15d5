"""Token counts as a rollup that signed deltas keep up to date.

A batch brings inserts, deletes and revised counts. The ledger knows the last count of each
(document, tokenizer version); a batch takes what it replaces from there with a minus and adds
the new count with a plus, so totals by source, language and tokenizer version are plain sums
of deltas and no earlier document is counted again.

A batch is committed by a marker written last. A batch whose marker exists is skipped, one
that was cut off is written again over its leftovers, and readers see only committed batches.

Defined results: within a batch the row of the greatest ``seq`` counts, of equal ones the
greatest in column order, and repeated rows count once; a null document id is an id like any
other; a null count adds nothing to the tokens; a delete of an unknown document changes
nothing; null sources and languages are groups of their own; an empty batch commits; further
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.llm.common import WORD

KEY = ["doc_id", "tokenizer"]
GROUP = ["source", "lang", "tokenizer"]
LEDGER = "doc_id long, tokenizer string, source string, lang string, tokens long, alive boolean, batch long"
DELTAS = "source string, lang string, tokenizer string, docs long, tokens long, batch long"

#: Tokenizer versions: the pattern of one token. Version 2 takes punctuation apart.
TOKENIZERS = {"words-1": WORD, "words-2": r"[^\x20\x09-\x0D.,;:!?]+|[.,;:!?]"}


def count_tokens(text: Column, version: str) -> Column:
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKENIZERS[version]), F.lit(0))
    return F.size(found).cast("long")


class TokenRollup:
    """A rollup below one folder, which all executors must share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, kind: str, batch: int | None = None) -> str:
        return f"{self.folder}/{kind}" + ("" if batch is None else f"/batch={batch}")

    def _exists(self, path: str) -> bool:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def committed(self) -> list[int]:
        """Numbers of the committed batches, one small row each."""
        if not self._exists(self._path("commits")):
            return []
        rows = self.spark.read.schema("n long").parquet(self._path("commits")).select("n").distinct().collect()
        return sorted(r["n"] for r in rows)

    def _read(self, kind: str, schema: str, batches: list[int]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        parts = self.spark.read.schema(schema).option("basePath", self._path(kind))
        return parts.parquet(*(self._path(kind, b) for b in batches))

    def ledger(self, batches: list[int] | None = None, of: DataFrame | None = None) -> DataFrame:
        """The last state of each document and tokenizer version; only those that ``of`` names, if given.

        Rows of other keys leave before they are grouped, so a batch groups as many rows as it
        has keys and earlier states of them. A small batch is broadcast by Spark's own limit and
        then the ledger is not shuffled for it.
        """
        rows = self._read("ledger", LEDGER, self.committed() if batches is None else batches)
        if of is not None:
            same = reduce(lambda a, b: a & b, (F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in KEY))
            rows = rows.alias("o").join(of.select(*KEY).alias("n"), same, "left_semi")
        last = F.max(F.struct("batch", "source", "lang", "tokens", "alive")).alias("_last")
        return rows.groupBy(*KEY).agg(last).select(*KEY, "_last.source", "_last.lang", "_last.tokens", "_last.alive")

    def apply(self, batch: int, changes: DataFrame) -> bool:
        """Commits a batch of (doc_id, tokenizer, source, lang, tokens, op, seq); false if it was there.

        ``op`` is ``delete``, or anything else to set the count. Changes of one document meet
        by a partial maximum before the shuffle, so one id may hold any share of the rows.
        """
        done = self.committed()
        if batch in done:
            return False
        if done and batch < done[-1]:
            raise ValueError(f"batch {batch} comes after batch {done[-1]}")
        newest = F.max(F.struct("seq", "source", "lang", "tokens", "op")).alias("_new")
        new = changes.groupBy(*KEY).agg(newest).select(
            *KEY, "_new.source", "_new.lang", F.coalesce("_new.tokens", F.lit(0)).cast("long").alias("tokens"),
            (F.coalesce("_new.op", F.lit("")) != "delete").alias("alive"),
        )
        new.write.mode("overwrite").parquet(self._path("ledger", batch))
        new = self.spark.read.schema(new.schema).parquet(self._path("ledger", batch))
        replaced = self.ledger(done, new)
        signed = new.where("alive").select(*GROUP, F.lit(1).alias("docs"), "tokens").unionByName(
            replaced.where("alive").select(*GROUP, F.lit(-1).alias("docs"), (-F.col("tokens")).alias("tokens"))
        )
        deltas = signed.groupBy(*GROUP).agg(F.sum("docs").cast("long").alias("docs"), F.sum("tokens").alias("tokens"))
        deltas.write.mode("overwrite").parquet(self._path("deltas", batch))
        self.spark.range(batch, batch + 1, 1, 1).toDF("n").write.mode("overwrite").parquet(self._path("commits", batch))
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens; groups that came down to nothing are left out."""
        deltas = self._read("deltas", DELTAS, self.committed())
        summed = deltas.groupBy(*GROUP).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
        return summed.where("n_docs != 0")
