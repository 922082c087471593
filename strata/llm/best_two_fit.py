"""Packing documents into token sequences by best-two-fit.

A document is its token ids and a closing id; only documents longer than a
sequence are cut. Bins are filled greedily with the longest piece that fits
the gap; then the smallest piece of the bin gives way to two unpacked pieces
that fit the gap it leaves more tightly.

Pieces of one length are interchangeable, so the plan is made on the counts by
length: at most ``capacity`` numbers, however large the corpus. A bin is
planned once and repeated as often as the counts allow, so the plan too stays
small. Pieces then find their place by their rank among the pieces of their
length. Ranks come from counts by length and salt, so that one length shared
by a third of all pieces is ranked in many tasks.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.bpe_backtrack import _WHITE, _Cache
from strata.llm.tables import written

CAPACITY = 4096
CLOSING_ID = 1
ROWS_PER_SALT = 20_000
CHUNK_ENTRIES, WORD_ENTRIES = 250_000, 150_000  # bounds of the caches of one worker


class WordIds:
    """Ids of whole texts by the tokenizers library, with a bounded cache of white-space runs.

    The tokenizer drops white space and never joins across it, so a text's
    ids are those of its runs, one after the other. Runs not seen before are
    given to the library many at a time.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(1 + max(vocabulary.values()), dtype=bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.specials = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        self.chunks, self.words = _Cache(CHUNK_ENTRIES), _Cache(WORD_ENTRIES)

    def __call__(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        if any(t in text for t in self.specials) or not text.isascii() and ("Σ" in text or not _composed(text)):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        chunks = _WHITE.split(text.lower()) if _CONTROL.search(text) else text.lower().split()
        young, old = self.chunks.young, self.chunks.old
        ids = [young.get(c) for c in chunks]
        missing = {c for c, x in zip(chunks, ids, strict=True) if x is None}
        if missing:
            found = {c: x for c in missing if (x := old.get(c)) is not None}
            found |= self._encode(missing - found.keys())
            ids = [found[c] if x is None else x for c, x in zip(chunks, ids, strict=True)]
            for c, x in found.items():
                self.chunks.put(c, x)
        return b"".join(ids)

    def _encode(self, chunks: set[str]) -> dict[str, bytes]:
        split = {c: self.pattern.findall(c) for c in chunks}
        words = {w for ws in split.values() for w in ws}
        young, old = self.words.young, self.words.old
        known = {w: x for w in words if (x := young.get(w) or old.get(w)) is not None}
        new = list(words - known.keys())
        for i in range(0, len(new), 256):
            some = new[i : i + 256]
            ids = np.array(self.library.encode(" ".join(some), add_special_tokens=False).ids, dtype="<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(some):
                raise ValueError("the tokenizer splits a word differently")
            data, at = ids.tobytes(), 0
            for w, end in zip(some, ends.tolist(), strict=True):
                known[w] = self.words.put(w, data[4 * at : 4 * end])
                at = end
        return {c: b"".join([known[w] for w in ws]) for c, ws in split.items()}


_CONTROL = regex.compile("[\x1c-\x1f]")


def _composed(text: str) -> bool:
    import unicodedata

    return unicodedata.is_normalized("NFC", text)


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``, one row per piece; a null text is empty (only the closing id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, closing = word_ids(path), CLOSING_ID.to_bytes(4, "little")
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(batch.column(1)):
                data = ids_of(text.as_py() or "") + closing
                for p, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    row.append(k)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Bins as ``(lengths, times)`` that together use each length as often as ``counts`` says.

    Every round uses some length up, or down to less than one bin takes, so
    the work depends on the number of lengths, not of pieces.
    """
    left = {n: k for n, k in counts.items() if k > 0}
    if any(not 1 <= n <= capacity for n in left):
        raise ValueError("lengths must be between 1 and the capacity")
    sizes, plan = sorted(left), []
    while sizes:
        used: Counter[int] = Counter()
        gap = capacity
        at = len(sizes) - 1
        while gap and (at := min(at, bisect_right(sizes, gap) - 1)) >= 0:
            n = sizes[at]
            if take := min(gap // n, left[n] - used[n]):
                used[n] += take
                gap -= take * n
            at -= 1
        if gap:
            smallest = min(used)
            pair = _closest_pair(sizes, left, used, smallest, gap + smallest)
            if pair:
                used[smallest] -= 1
                used.update(pair)
        bin_ = [n for n in sorted(used, reverse=True) for _ in range(used[n])]
        used = Counter(bin_)
        times = min(left[n] // k for n, k in used.items())
        plan.append((bin_, times))
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                sizes.pop(bisect_left(sizes, n))
    return plan


def _closest_pair(sizes: list[int], left: dict[int, int], used: Counter, above: int, gap: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum over ``above`` and within ``gap``; the smaller first."""
    free = np.array([n for n in sizes[: bisect_right(sizes, gap)] if left[n] > used[n]], dtype=np.int64)
    if not len(free):
        return None
    twice = np.array([left[n] - used[n] > 1 for n in free.tolist()])
    index = np.arange(len(free))
    partner = np.searchsorted(free, gap - free, side="right") - 1
    partner = np.minimum(partner, index)  # the partner is the smaller one, or the same length
    partner = np.where((partner == index) & ~twice, partner - 1, partner)
    sums = np.where(partner >= 0, free + free[np.maximum(partner, 0)], 0)
    best = int(np.argmax(sums))
    return (int(free[partner[best]]), int(free[best])) if sums[best] > above else None


def _places(plan: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """For runs of ranks of a length: the run's first rank, its first bin and the offset in each of its bins."""
    rank: Counter[int] = Counter()
    runs, bin_ = [], 0
    for lengths, times in plan:
        offset = 0
        for n in lengths:
            runs.append((n << 44 | rank[n], bin_, offset))
            rank[n] += times
            offset += n
        bin_ += times
    runs.sort()
    columns = np.array(runs, dtype=np.int64).reshape(-1, 3)
    return {"key": columns[:, 0].copy(), "bin": columns[:, 1].copy(), "offset": columns[:, 2].copy()}


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and its ``offset`` there.

    Only ``doc_id`` and ``text`` are read; repeated rows are packed as often
    as they occur; a null ``doc_id`` is kept. An empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    cut = written(pieces(docs, path, capacity), "packing-pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    runs = spark.sparkContext.broadcast(_places(best_two_fit(counts, capacity)))  # bounded by the lengths, not the rows

    salts = max(1, math.ceil(sum(counts.values()) / ROWS_PER_SALT))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    earlier = (
        salted.groupBy("length", "salt")
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n"))
        .drop("n")
    )
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (
        salted.withColumn("rank", F.row_number().over(order) - 1)
        .join(earlier, ["length", "salt"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = runs.value
        for batch in batches:
            n, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            key = n << 44 | rank
            run = np.searchsorted(at["key"], key, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(at["bin"][run] + key - at["key"][run]), pa.array(at["offset"][run])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(
        place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
