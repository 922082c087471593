"""Language identification by prediction by partial matching over bytes.

Per language a tree of byte contexts, up to three bytes deep, holds how often
each byte followed. A byte's code length is taken in the deepest context that
knows it: every context passed on the way adds the cost of its escape (method
C: the number of different bytes seen against the number of all). Below the
empty context every byte value is equally likely. Statistics are frozen after
training; a text's score in a language is its exact code length, and the
shortest code names the language.

The trees are flattened into one table: a context of three bytes finds its
deepest known node, and a node and a byte find the code lengths of all
languages. Texts are scored from the bytes of Arrow buffers, in slices, so a
very long text needs no more memory than a short one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.tables import written

UNKNOWN = "und"
ORDER = 3
LEAST_SEEN = 8  # a context becomes a node if it was seen so often
MOST_CONTEXTS = 1 << 15  # nodes of three bytes, at most: beyond it, the context must have been seen more often
SLICE = 1 << 18
MOST_KEYS = 1 << 22  # contexts that a task counts at once


def held_out(doc_id: str = "doc_id") -> Column:
    """The rows kept from training: crc32 of the id as text, modulo 4, is 2. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def labelled(docs: DataFrame, held: bool = False) -> DataFrame:
    """``lang, text`` of all labelled rows outside the held-out part; with ``held``, of those in it. Whole texts."""
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (held_out() == held)).select("lang", "text")


def count_contexts(sample: DataFrame) -> DataFrame:
    """``lang, key, n``: how often four bytes (three of context, one that followed) occur.

    ``key`` packs them, the oldest highest; before a text stand zero bytes.
    """

    def counted(lang: str, keys: list[np.ndarray]) -> pa.RecordBatch:
        key, n = np.unique(np.concatenate(keys), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(key), pa.string()), pa.array(key.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "key", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            data, starts = _bytes(batch.column(1))
            for lang in sorted(set(names)):
                keys, size = [], 0
                for name, start, end in zip(names, starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    for at in range(start, end, SLICE) if name == lang else ():
                        keys.append(_keys(data, at, min(at + SLICE, end), start))
                        size += len(keys[-1])
                        if size >= MOST_KEYS:
                            yield counted(lang, keys)
                            keys, size = [], 0
                if keys:
                    yield counted(lang, keys)

    return sample.select("lang", "text").mapInArrow(run, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array and the places where texts start, and the end; a null text has no bytes."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)), starts


def _keys(data: np.ndarray, at: int, end: int, start: int) -> np.ndarray:
    """Packed contexts and bytes for data[at:end] of a text that starts at ``start``."""
    window = np.zeros(end - at + ORDER, dtype=np.uint32)
    back = min(ORDER, at - start)
    window[ORDER - back :] = data[at - back : end]
    key = window[ORDER:].copy()
    for k in range(1, ORDER + 1):
        key |= window[ORDER - k : len(window) - k] << np.uint32(8 * k)
    return key


@dataclass(frozen=True)
class Model:
    """Frozen code lengths. ``byte_class`` numbers the bytes seen in training from 1; 0 is any other, and a text's start."""

    languages: list[str]
    byte_class: np.ndarray  # 256
    node_of: np.ndarray  # classes ** 3: the deepest node of three classes of context
    bits: np.ndarray  # nodes, classes, languages

    def code_lengths(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits of each text in each language."""
        n, size = len(starts) - 1, self.bits.shape[1]
        total = np.zeros((n, len(self.languages)))
        flat = self.bits.reshape(-1, self.bits.shape[2])
        doc = 0
        for at in range(int(starts[0]), int(starts[-1]), SLICE):
            end = min(at + SLICE, int(starts[-1]))
            back = min(ORDER, at - int(starts[0]))
            classes = np.zeros(end - at + ORDER, dtype=np.int32)
            classes[ORDER - back :] = self.byte_class[data[at - back : end]]
            while starts[doc + 1] <= at:
                doc += 1
            last = int(np.searchsorted(starts, end, side="left"))  # texts doc .. last - 1 have bytes here
            here = starts[doc:last]
            context = [classes[ORDER - k : len(classes) - k].copy() for k in range(1, ORDER + 1)]
            for k in range(1, ORDER + 1):  # a text does not see the one before it
                for j in range(k):
                    place = here + j - at
                    place = place[(place >= 0) & (place < end - at)]
                    own = place[starts[np.searchsorted(starts, place + at, side="right") - 1] > place + at - k]
                    context[k - 1][own] = 0
            node = self.node_of[(context[2] * size + context[1]) * size + context[0]]
            bits = flat[node.astype(np.int64) * size + classes[ORDER:]]
            edges = np.maximum(here - at, 0)
            full = np.flatnonzero(np.append(edges[1:], end - at) > edges)
            if len(full):
                total[doc + full] += np.add.reduceat(bits, edges[full], axis=0, dtype=np.float64)
        return total


def fit(counts: list[tuple[str, int, int]], least_seen: int = LEAST_SEEN) -> Model | None:
    """The model from ``(lang, key, n)``; None if there is nothing to learn from."""
    if not counts:
        return None
    lang, key, n = zip(*counts, strict=True)
    return _fit(list(lang), np.array(key, dtype=np.int64), np.array(n, dtype=np.float64), np.ones(len(key), dtype=bool), least_seen)


def _fit(names: list[str], key: np.ndarray, n: np.ndarray, deep: np.ndarray, least_seen: int) -> Model:
    """:func:`fit`; rows that are not ``deep`` count for contexts of up to two bytes only."""
    languages = sorted(set(names))
    number = {x: i for i, x in enumerate(languages)}
    lang = np.array([number[x] for x in names])
    followed = np.unique(key & 255)
    byte_class = np.zeros(256, dtype=np.int32)
    byte_class[followed] = np.arange(1, len(followed) + 1)
    size = len(followed) + 1
    symbol = byte_class[key & 255].astype(np.int64)
    whole, deep = deep, [byte_class[(key >> (8 * k)) & 255].astype(np.int64) for k in (1, 2, 3)]
    zero = [((key >> (8 * k)) & 255) == 0 for k in (1, 2, 3)]
    for d, z in zip(deep, zero, strict=True):
        d[z] = 0

    lower = np.full((1, size, len(languages)), np.log2(257.0))
    index = np.zeros(1, dtype=np.int64)  # of each context of the order below, its row in `lower`
    tables = []
    for order in range(ORDER + 1):
        if order == ORDER:
            key, n, lang, symbol, deep = key[whole], n[whole], lang[whole], symbol[whole], [d[whole] for d in deep]
        context = np.zeros(len(key), dtype=np.int64)
        for k in range(order, 0, -1):
            context = context * size + deep[k - 1]
        seen = np.bincount(context, weights=n, minlength=size**order)
        nodes = np.flatnonzero(seen >= (least_seen if order else 0))
        row = np.full(size**order, -1, dtype=np.int64)
        row[nodes] = np.arange(len(nodes))
        use = row[context] >= 0
        times = np.zeros((len(nodes), size, len(languages)))
        np.add.at(times, (row[context[use]], symbol[use], lang[use]), n[use])
        parent = index[nodes % size ** max(order - 1, 0)] if order else np.zeros(len(nodes), dtype=np.int64)
        below = lower[parent]
        total, kinds = times.sum(axis=1, keepdims=True), (times > 0).sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            known = np.log2((total + kinds) / times)
            escape = np.where(kinds > 0, np.log2((total + kinds) / kinds), 0.0)
        bits = np.where(times > 0, known, escape + below)
        base = sum(len(t) for t in tables)
        tables.append(bits)
        lower = np.concatenate(tables)
        inherited = index[np.arange(size**order) % size ** max(order - 1, 0)] if order else np.zeros(1, dtype=np.int64)
        index = np.where(row >= 0, base + row, inherited)
    return Model(languages, byte_class, index.astype(np.int32), lower.astype(np.float32))


def context_counts(counts: DataFrame, least_seen: int = LEAST_SEEN, most: int | None = None) -> DataFrame:
    """``lang, key, n, deep``: what the model is made from, of ``lang, key, n``, a written table.

    Contexts of three bytes that are too rare for a node are added up by their
    last two bytes (not ``deep``), so no count is lost and the result has as
    many rows as the alphabet and ``most`` ask for, however much text was
    counted. With more than ``most`` contexts seen ``least_seen`` times, those
    seen most often have nodes, and of equally frequent ones all or none.
    """
    most = MOST_CONTEXTS if most is None else most
    context = F.shiftright("key", 8)
    seen = counts.groupBy(context.alias("context")).agg(F.sum("n").alias("seen")).where(F.col("seen") >= least_seen)
    first = seen.select("seen").orderBy(F.desc("seen")).limit(most + 1).toArrow()["seen"].to_pylist()
    if len(first) > most:
        seen = seen.where(F.col("seen") > first[-1])
    frequent = F.broadcast(seen.select("context", F.lit(True).alias("deep")))  # at most `most` rows
    marked = counts.withColumn("context", context).join(frequent, "context", "left")
    deep = F.coalesce("deep", F.lit(False))
    key = F.when(deep, F.col("key")).otherwise(F.col("key").bitwiseAND(F.lit(0xFFFFFF).cast("long")))
    return marked.groupBy("lang", key.alias("key"), deep.alias("deep")).agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> Model | None:
    """Learns from all labelled rows outside the held-out part. What reaches the driver is bounded by the alphabet and :data:`MOST_CONTEXTS`."""
    counted = context_counts(written(count_contexts(labelled(docs)), "language-contexts")).toArrow()
    if not len(counted):
        return None
    key, n, deep = (counted[c].to_numpy() for c in ("key", "n", "deep"))
    return _fit(counted["lang"].to_pylist(), key, n.astype(np.float64), deep.astype(bool), LEAST_SEEN)


def usual_bits(docs: DataFrame, model: Model | None) -> dict[str, float]:
    """The median bits per byte of each language, over all its held-out rows: what text of the language takes that was not learned."""
    rows = predict(labelled(docs, held=True), model, ["lang"], bits=True).where("lang = lang_pred")
    return {r["lang"]: r["m"] for r in rows.groupBy("lang").agg(F.percentile_approx("bits_per_byte", 0.5).alias("m")).collect()}  # one row a language


def predict(docs: DataFrame, model: Model | None, keep: list[str], bits: bool = False) -> DataFrame:
    """The columns ``keep`` of ``docs``, then ``lang_pred`` and ``score``, and with ``bits`` also ``bits_per_byte``.

    ``lang_pred`` is the language of the shortest code (the first by name on a
    tie) and ``score`` its share of the probability of all languages. A null
    text, a text without letters, and any text if nothing was learned, is
    ``und`` with score 0 and no bits. ``score`` compares languages and nears 1
    with the length of any text; bits per byte, of the shortest code, tell
    whether the language explains the text. Rows are neither dropped nor merged.
    """
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(*keep, F.when(letters, F.col("text")).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the alphabet and MOST_CONTEXTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frozen = shared.value
        for batch in batches:
            text = batch.column(len(keep))
            if frozen is None:
                names, score, rate = [UNKNOWN] * len(text), np.zeros(len(text)), np.zeros(len(text))
            else:
                known = ~np.asarray(text.is_null())
                data, starts = _bytes(text)
                lengths = frozen.code_lengths(data, starts)
                best = lengths.argmin(axis=1)
                shortest = lengths[np.arange(len(best)), best]
                score = np.where(known, 1 / np.exp2(np.maximum(shortest[:, None] - lengths, -1000)).sum(axis=1), 0.0)
                rate = shortest / np.maximum(np.diff(starts), 1)
                names = [frozen.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
            columns = [*batch.columns[: len(keep)], pa.array(names, pa.string()), pa.array(score, pa.float64())]
            if bits:
                columns.append(pa.array(rate, pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    schema = T.StructType([docs.schema[c] for c in keep]).add("lang_pred", T.StringType()).add("score", T.DoubleType())
    if bits:
        schema = schema.add("bits_per_byte", T.DoubleType())
    return rows.mapInArrow(run, schema)
