"""Delta-maintained rollups of token counts.

Totals by source, language and tokenizer version are never recounted. A batch
is a set of signed changes to documents' counts: +1 document and its tokens for
an insert, the same negated for a delete, both for a revised count. A commit
sums its changes by key and writes them to the folder of its batch id; totals
are the sums over committed batches. Committing a batch id again changes
nothing: the folder is written whole before its marker, and a marked batch is
skipped, so a repeated or restarted job counts once. Compaction folds batches
into one base table that names them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
#: Tokenizer versions whose counts SQL can express: white-space words, and runs of letters or digits or single signs.
TOKENIZERS = {"words-1": r"[^\x20\x09-\x0D]+", "pieces-2": r"[\p{L}]+|[\p{N}]+|[^\x20\x09-\x0D\p{L}\p{N}]"}


def counted(docs: DataFrame, *more: str, tokenizers: dict[str, str] = TOKENIZERS) -> DataFrame:
    """``doc_id, source, lang``, the columns ``more``, ``tokenizer, n_tokens`` for every row and version; a null text has no tokens."""
    versions = F.explode(
        F.array(
            *(
                F.struct(F.lit(name).alias("tokenizer"), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(p)).cast("long").alias("n"))
                for name, p in tokenizers.items()
            )
        )
    )
    rows = docs.select("doc_id", "source", "lang", *more, versions.alias("v"))
    return rows.select("doc_id", "source", "lang", *more, "v.tokenizer", F.col("v.n").alias("n_tokens"))


def inserts(counts: DataFrame) -> DataFrame:
    return _signed(counts, F.lit(1), F.col("n_tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    return _signed(counts, F.lit(-1), -F.col("n_tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Takes the old counts back and adds the new ones: documents whose source or language changed move too."""
    return deletes(old).unionByName(inserts(new))


def _signed(counts: DataFrame, docs: Column, tokens: Column) -> DataFrame:
    return counts.select(*KEYS, docs.cast("long").alias("n_docs"), tokens.alias("n_tokens"))


class Rollup:
    """Totals kept in a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _marker(self, batch_id: str) -> str:
        return f"{self.path}/batches/{batch_id}/_SUCCESS"

    def _exists(self, path: str) -> bool:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Adds a batch; False, and nothing done, if this id is committed already.

        One writer at a time. A run that failed left no marker: its files are
        overwritten.
        """
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", batch_id):
            raise ValueError("a batch id is made of letters, digits, '_', '.' and '-'")
        if self._exists(self._marker(batch_id)) or batch_id in self._folded()[1]:
            return False
        sums = changes.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        changed = sums.where("n_docs != 0 or n_tokens != 0")
        changed.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(
            f"{self.path}/batches/{batch_id}"
        )
        return True

    def _folded(self) -> tuple[str | None, set[str]]:
        """The newest complete base table and the batches in it."""
        bases = [n for n in self._names(f"{self.path}/base") if self._exists(f"{self.path}/base/{n}/batches/_SUCCESS")]
        if not bases:
            return None, set()
        newest = f"{self.path}/base/{max(bases)}"
        rows = self.spark.read.schema("batches string").parquet(f"{newest}/batches").collect()  # one row
        return f"{newest}/totals", set(json.loads(rows[0]["batches"]))

    def _names(self, folder: str) -> Iterator[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def batches(self) -> list[str]:
        """Committed batches that no base table holds."""
        folded = self._folded()[1]
        return sorted(b for b in self._names(f"{self.path}/batches") if b not in folded and self._exists(self._marker(b)))

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, n_docs, n_tokens`` where there is anything."""
        base, _ = self._folded()
        paths = [f"{self.path}/batches/{b}" for b in self.batches()] + ([base] if base else [])
        if not paths:
            return self.spark.createDataFrame([], T._parse_datatype_string(SCHEMA))
        parts = self.spark.read.schema(SCHEMA).parquet(*paths)
        sums = parts.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.where("n_docs != 0 or n_tokens != 0")

    def compact(self) -> None:
        """Folds all batches into a new base table. Readers see the old one until the new one is whole."""
        batches = self.batches()
        if not batches:
            return
        number = f"{len(self._names(f'{self.path}/base')):08d}"
        self.totals().write.mode("overwrite").parquet(f"{self.path}/base/{number}/totals")
        names = json.dumps(sorted({*batches, *self._folded()[1]}))
        self.spark.createDataFrame([(names,)], "batches string").write.mode("overwrite").parquet(f"{self.path}/base/{number}/batches")


def change_feed(docs: DataFrame) -> dict[str, DataFrame]:
    """Batches made from a whole table of documents, by what a corpus goes through.

    All documents come in, counted as they are; counts are revised after table
    bars are taken out of the text; exact copies of a text (of the unrevised
    one) are deleted, except the smallest id's.
    """
    rows = docs.select("doc_id", "source", "lang", F.coalesce("text", F.lit("")).alias("text"))
    revised = F.regexp_replace("text", r"\|", " ")
    before, after = counted(rows), counted(rows.withColumn("text", revised))
    keyed = rows.withColumn("key", F.sha2("text", 256)).withColumn("text", revised)
    first = keyed.groupBy("key").agg(F.min("doc_id").alias("first"))
    # Counted first: no text goes through the join.
    counts = counted(keyed, "key")
    copies = counts.join(first, "key").where(~F.col("doc_id").eqNullSafe(F.col("first")))
    return {"insert": inserts(before), "revise": revisions(before, after), "delete": deletes(copies)}
