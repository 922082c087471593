"""An id of its own for each text, where an id of the source names several.

Corpora that are merged may use one ``doc_id`` for different texts. An operator
that carries only ids through its joins would take these for one document and
lose links, or drop a text for what another one is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import sized, written

#: The largest and smallest long.
TOP, BOTTOM = (1 << 63) - 1, -(1 << 63)


def _digest() -> Column:
    return F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)


def row_ids(docs: DataFrame, name: str = "row_id") -> tuple[DataFrame, bool]:
    """``docs(doc_id, text, ...)`` with the column ``name``: equal for rows of one id and one text, and for no others.

    Also whether any of these differs from its ``doc_id``.

    It is the ``doc_id`` where that has one text, and otherwise a number that no
    ``doc_id`` is. Null ids stay null. Null and empty texts are one text. Ids
    with several texts are found by a hash per row, so that nothing else moves
    when there are none.
    """
    marked = docs.where("doc_id is not null").groupBy("doc_id")
    h = F.xxhash64(F.coalesce("text", F.lit("")))
    several = marked.agg(F.min(h).alias("a"), F.max(h).alias("b")).where("a != b").select("doc_id")
    several = written(several, "ids-of-several-texts")
    if several.isEmpty():
        return docs.withColumn(name, F.col("doc_id")), False
    some = docs.select("doc_id", "text").join(sized(several), "doc_id", "left_semi").select("doc_id", _digest().alias("__digest"))
    numbered = written(some.distinct().withColumn(name, F.monotonically_increasing_id()), "row-ids")
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    last = numbered.agg(F.max(name)).first()[0]
    if high + 1 + last <= TOP:
        numbered = numbered.withColumn(name, F.col(name) + F.lit(high + 1))
    elif low - 1 - last >= BOTTOM:
        numbered = numbered.withColumn(name, F.lit(low - 1) - F.col(name))
    else:
        raise ValueError("doc_id leaves no numbers for the texts of repeated ids")
    named = docs.withColumn("__digest", _digest()).join(sized(numbered), ["doc_id", "__digest"], "left")
    return written(named.select(*[docs[c] for c in docs.columns], F.coalesce(name, "doc_id").alias(name)), "rows-with-ids"), True
