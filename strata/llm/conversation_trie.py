"""Prefix trie of conversations, from vertical bitmaps.

A node of the trie is a distinct sequence of first turns; its members are the
conversations that start with it. Conversations are cut into chunks of turns
and taken by shards of a bounded number of chunks. A shard indexes
``(position, turn)`` to a bitmap of its conversations. From the root, depth
first, the bitmap of a node and the posting of the turn that its first
remaining member goes on with intersect in a child; bit counts are members,
what no posting takes are the conversations that end there. Every node is named
by a hash of its path, so the shards' partial tries add up by that name: counts
as sums, the smallest member as a minimum, ends as bitmaps of ranges of ids.

Sums over subtrees need each distinct node once, whichever shards saw it. A node
is given to its smallest member, whose nodes are then the tail of its path; a
second walk adds up tails from the members' side.

Only hashes and lengths of turns move; texts are read once, in the scan. A
conversation of any length is many chunks, a node of any number of members many
partial counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.tables import sized, written

CHUNK = 1024  # turns in a chunk of a conversation, and turn numbers counted together
SHARD_ROWS, SHARD_TURNS = 1024, 200_000  # a shard is closed at so many chunks or turns
SHARD_IDS = 512  # neighbouring ids lie together
SMALL_TABLE = 100_000  # rows of at most some hundred bytes that may be broadcast
RANGE_BITS = 15  # ids of an end bitmap: 4 KiB
MODULUS = (1 << 61) - 1
ROOT = bytes(16)

_NODES = (
    "key binary, parent binary, depth long, n_chars long, n_convs long, conv_id long, all_chars long, ends_range long, ends binary"
)
_SUMS = "key binary, owned_chars long, n_leaves long"


def ordered(conversations: DataFrame) -> DataFrame:
    """``conv_id, position, digest, n_chars`` of each turn: places from 0, by ``turn`` (nulls first).

    Null roles and texts are empty ones. Rows of one ``turn`` are placed by the
    digest of role and text; repeated rows have a place each. Rows without a
    ``conv_id`` belong to no conversation and are left out. Places are counted
    by chunks of turn numbers, so no task holds a long conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    both = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.substring(F.sha2(both, 256), 1, 32)).alias("digest"), F.length(text).cast("long").alias("n_chars"),
        F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(1 << 62))).alias("part"),
    )
    rows = written(rows, "trie-turns")
    counted = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")
    before = counted.select("conv_id", "part", earlier.alias("before")).where("before > 0")
    here = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("turn", "digest")) - 1
    placed = rows.withColumn("here", here).join(before, ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.coalesce("before", F.lit(0)) + F.col("here")).alias("position"), "digest", "n_chars")


def shared_heads(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """``turns`` with each conversation's first turns taken from the conversation that leads its group.

    The first ``h`` turns (all if fewer) of conversation ``c - c % every``,
    none if there is no such one, then the conversation's own after its first
    ``h``; ``h`` is the unsigned CRC-32 of the decimal ``c``, modulo ``most``.
    A conversation may be left without turns. ``turns`` is read three times:
    give it a written table.
    """
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % most).cast("int")
    lead = c - c % every
    heads = turns.where((c % every == 0) & (F.col("position") < most - 1)).groupBy("conv_id")
    heads = heads.agg(F.sort_array(F.collect_list(F.struct("position", "digest", "n_chars"))).alias("head"))
    heads = written(heads.select(F.col("conv_id").alias("lead"), "head"), "trie-heads")
    known = turns.select("conv_id").distinct().withColumns({"lead": lead, "h": h}).join(sized(heads, SMALL_TABLE), "lead")
    first = known.select("conv_id", F.explode(F.slice("head", 1, F.greatest("h", F.lit(0)))).alias("t")).select("conv_id", "t.*")
    own = turns.withColumns({"lead": lead, "h": h}).where("position >= h")
    own = own.join(sized(heads.select("lead", F.size("head").alias("n"))), "lead", "left")
    moved = F.col("position") - F.col("h") + F.least("h", F.coalesce("n", F.lit(0)))
    return first.unionByName(own.select("conv_id", moved.alias("position"), "digest", "n_chars"))


def _hash(seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col("chunk"), F.col("digests")), F.lit(MODULUS)).cast("decimal(38,0)")


def _name(x: str, y: str) -> Column:
    """Two sums as the 16 bytes that name a node on the border of two chunks."""
    parts = [F.lpad(F.hex(F.pmod(F.col(c), F.lit(MODULUS)).cast("long")), 16, "0") for c in (x, y)]
    return F.unhex(F.concat(*parts))


def _chunks(turns: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """``conv_id, chunk, start, finish, last, after, digests, chars``: a row per chunk of a conversation, one without turns included.

    ``start`` names the node that the chunk begins at, ``finish`` the one that a
    full chunk ends at; ``after`` counts the characters of later chunks.
    """
    shard = F.floor(F.col("conv_id") / SHARD_IDS)
    rows = turns.withColumns({"shard": shard, "chunk": F.floor(F.col("position") / size)}).repartition("shard", "chunk")
    rows = rows.groupBy("shard", "chunk", "conv_id")
    rows = rows.agg(F.sort_array(F.collect_list(F.struct("position", "digest", "n_chars"))).alias("t"))
    rows = rows.select("shard", "conv_id", "chunk", F.col("t.digest").alias("digests"), F.col("t.n_chars").alias("chars"))
    rows = written(rows.sortWithinPartitions("shard", "chunk", "conv_id"), "trie-chunks")
    # What long conversations add up to before and after each of their chunks; the others have one chunk, not full.
    total = F.aggregate("chars", F.lit(0).cast("long"), lambda a, x: a + x)
    spine = rows.where((F.size("digests") == size) | (F.col("chunk") > 0)).select(
        "conv_id", "chunk", _hash(1).alias("x"), _hash(2).alias("y"), total.alias("c")
    )
    up, down = Window.partitionBy("conv_id").orderBy("chunk"), Window.partitionBy("conv_id").orderBy(F.desc("chunk"))
    spine = spine.select(
        "conv_id", "chunk", "x", "y", F.sum("x").over(up).alias("sx"), F.sum("y").over(up).alias("sy"),
        (F.sum("c").over(down) - F.col("c")).alias("after"), (F.row_number().over(down) == 1).alias("last"),
    ).withColumns({"bx": F.col("sx") - F.col("x"), "by": F.col("sy") - F.col("y")})
    spine = spine.select("conv_id", "chunk", _name("bx", "by").alias("start"), _name("sx", "sy").alias("finish"), "after", "last")
    rows = rows.join(sized(written(spine, "trie-spine"), SMALL_TABLE), ["conv_id", "chunk"], "left").select(
        "conv_id", "chunk", F.when(F.col("chunk") > 0, F.col("start")).otherwise(F.lit(ROOT)).alias("start"),
        F.when(F.size("digests") == size, F.col("finish")).alias("finish"), F.coalesce("last", F.lit(True)).alias("last"),
        F.coalesce("after", F.lit(0)).alias("after"), "digests", "chars",
    )
    none = ids.select(F.col("conv_id").cast("long").alias("conv_id")).where("conv_id is not null").distinct()
    none = none.join(turns.select("conv_id").distinct(), "conv_id", "left_anti").select(
        "conv_id", F.lit(0).cast("long").alias("chunk"), F.lit(ROOT).alias("start"), F.lit(None).cast("binary").alias("finish"),
        F.lit(True).alias("last"), F.lit(0).cast("long").alias("after"),
        F.array().cast("array<binary>").alias("digests"), F.array().cast("array<bigint>").alias("chars"),
    )
    return rows.unionByName(none)


class Shard:
    """Chunks of conversations with an index from (chunk, place, turn) to the bitmap of those that have that turn there.

    Bit i is row i; rows are in the order of their ids, so the first bit of a
    bitmap is its smallest member.
    """

    def __init__(self, rows: list[dict], size: int):
        self.rows, self.size = sorted(rows, key=lambda r: r["conv_id"]), size
        self.postings: dict[tuple[int, int, bytes], int] = {}
        self.longer: dict[tuple[int, int], int] = {}
        self.roots: dict[tuple[int, bytes], int] = {}
        for i, r in enumerate(self.rows):
            bit, chunk = 1 << i, r["chunk"]
            self.roots[chunk, r["start"]] = self.roots.get((chunk, r["start"]), 0) | bit
            for p, digest in enumerate(r["digests"]):
                self.postings[chunk, p, digest] = self.postings.get((chunk, p, digest), 0) | bit
                self.longer[chunk, p] = self.longer.get((chunk, p), 0) | bit

    def walk(self) -> Iterator[tuple[int, int, bytes, int, int, int, int, int]]:
        """Nodes, parents first: number, parent's number (-1: a root), name, chunk, place, first row, members, those that end here.

        Place p is the node after p turns of the chunk.
        """
        n = 0
        for (chunk, start), members in self.roots.items():
            stack = [(-1, start, 0, members)]
            while stack:
                parent, key, p, members = stack.pop()
                rest = members & self.longer.get((chunk, p), 0)
                yield n, parent, key, chunk, p, _first(members), members, members & ~rest
                while rest:
                    row = self.rows[_first(rest)]
                    child = rest & self.postings[chunk, p, row["digests"][p]]
                    rest ^= child
                    name = row["finish"] if p + 1 == self.size else _step(key, row["digests"][p])
                    stack.append((n, name, p + 1, child))
                n += 1


def _first(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


def _each(bits: int) -> Iterator[int]:
    while bits:
        yield (i := _first(bits))
        bits &= bits - 1


def _step(key: bytes, digest: bytes) -> bytes:
    return hashlib.blake2b(key + digest, digest_size=16).digest()


def _pack(low: list[int]) -> bytes:
    """Sorted ids of a range as two bytes each or, when that is longer, as a bitmap."""
    if 2 * len(low) < 1 << (RANGE_BITS - 3):
        return np.array(low, "<u2").tobytes()
    bits = np.zeros(1 << RANGE_BITS, bool)
    bits[low] = True
    return np.packbits(bits).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    if len(data) < 1 << (RANGE_BITS - 3):
        return np.frombuffer(data, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8)))


def partial_nodes(shard: Shard) -> list[tuple]:
    """Rows of a shard's nodes; more than one for a node whose ends lie in several ranges.

    The node that a later chunk starts at is the earlier chunk's last one.
    """
    nodes, totals = list(shard.walk()), {}
    for n, _, _, chunk, p, first, members, ended in reversed(nodes):
        chars = shard.rows[first]["chars"][p - 1] if p else 0
        total = totals.pop(n, 0) + chars * members.bit_count() + sum(shard.rows[i]["after"] for i in _each(ended))
        nodes[n] = (*nodes[n], chars, total)
        if nodes[n][1] >= 0:
            totals[nodes[n][1]] = totals.get(nodes[n][1], 0) + total
    out = []
    for _, parent, key, chunk, p, first, members, ended, chars, total in nodes:
        if p == 0 and chunk > 0:
            continue
        ranges: dict[int, list[int]] = {}
        for i in _each(ended):
            if (r := shard.rows[i])["last"]:
                ranges.setdefault(r["conv_id"] >> RANGE_BITS, []).append(r["conv_id"] & ((1 << RANGE_BITS) - 1))
        above, depth, conv = nodes[parent][2] if p else None, chunk * shard.size + p, shard.rows[first]["conv_id"]
        count = members.bit_count()
        for at, low in ranges.items() or [(None, None)]:
            out.append((key, above, depth, chars, count, conv, total, at, low and _pack(low)))
            count = total = 0
    return out


def partial_sums(shard: Shard) -> list[tuple]:
    """Characters and childless ones of the distinct nodes below each node of a shard.

    Rows also have ``since``, the first depth at which the conversation is its
    node's smallest member, ``owned``, the characters from there on, and
    ``leaf``, whether its last node is childless.
    """
    nodes, out, totals = list(shard.walk()), [], {}
    for n, parent, key, chunk, p, first, _, ended in reversed(nodes):
        chars, leaves = totals.pop(n, (0, 0))
        depth, row = chunk * shard.size + p, shard.rows[first]
        if p and row["since"] <= depth:
            chars += row["chars"][p - 1]
        for i in _each(ended):
            r = shard.rows[i]
            chars += r["after"] if r["since"] <= depth else r["owned"]
            leaves += r["leaf"]
        if parent >= 0:
            c, k = totals.get(parent, (0, 0))
            totals[parent] = c + chars, k + leaves
        if p or not chunk:
            out.append((key, chars, leaves))
    return out


def _by_shards(chunks: DataFrame, of, ddl: str, size: int) -> DataFrame:
    """``of`` for shards of the chunks as they come, a bounded number at a time."""
    names = [x.split()[0] for x in ddl.split(", ")]
    kinds = [pa.binary() if x.endswith("binary") else pa.int64() for x in ddl.split(", ")]

    def rows(held: list[dict]) -> pa.RecordBatch:
        found = of(Shard(held, size))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                held.append({k: c[i].as_py() for k, c in zip(batch.schema.names, batch.columns, strict=True)})
                n += len(held[-1]["digests"])
                if len(held) >= SHARD_ROWS or n >= SHARD_TURNS:
                    yield rows(held)
                    held, n = [], 0
        if held:
            yield rows(held)

    return chunks.mapInArrow(run, ddl)


def _runs(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Sorted rows by their first ``n`` columns, each with the rest of its rows one after the other."""
    rows = (tuple(c[i].as_py() for c in b.columns) for b in batches for i in range(b.num_rows))
    for key, same in groupby(rows, key=lambda r: r[:n]):
        yield key, (r[n:] for r in same)


def _merged_ends(segments: DataFrame) -> DataFrame:
    """One segment per key and range: what all shards have found of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, at), held in _runs(batches, 2):
            ids = np.unique(np.concatenate([_unpack(x) for (x,) in held]))
            columns = [pa.array([key], pa.binary()), pa.array([at], pa.int64()), pa.array([_pack(ids)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "ends_range", "ends"])

    rows = segments.repartition("key", "ends_range").sortWithinPartitions("key", "ends_range")
    return rows.mapInArrow(run, "key binary, ends_range long, ends binary")


def ends_digests(segments: DataFrame) -> DataFrame:
    """``key, ends_sha256``: the digest of each node's ids, ascending, comma-joined.

    A digest is sequential, so a node's segments go through one task, one range
    after the other; they are two bytes an id at most, a bit at best.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key,), held in _runs(batches, 1):
            sha, comma = hashlib.sha256(), ""
            for at, ends in held:
                sha.update((comma + ",".join(map(str, ((at << RANGE_BITS) + _unpack(ends)).tolist()))).encode())
                comma = ","
            columns = [pa.array([key], pa.binary()), pa.array([sha.hexdigest()], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "ends_sha256"])

    rows = _merged_ends(segments).repartition("key").sortWithinPartitions("key", "ends_range")
    return rows.mapInArrow(run, "key binary, ends_sha256 string")


def trie(turns: DataFrame, ids: DataFrame | None = None, chunk: int = CHUNK) -> DataFrame:
    """A row per node of the trie over ``turns(conv_id, position, digest, n_chars)``, places from 0 without gaps.

    ``ids(conv_id)`` names conversations that may have no turns. Columns, all
    long but the last: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``,
    ``n_leaves`` (childless nodes of the subtree), ``saved_tokens`` (over the
    subtree, each node's ``n_convs - 1`` times its last turn's ``n_chars``),
    ``ends_sha256`` (digest of the ids that end here, ascending and
    comma-joined). No conversations make no nodes, not even a root.
    """
    turns = written(turns, "trie-sequences")
    chunks = written(_chunks(turns, turns if ids is None else ids, chunk), "trie-rows")
    found = written(_by_shards(chunks, partial_nodes, _NODES, chunk), "trie-partial")
    nodes = found.groupBy("key").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("n_chars").alias("n_chars"),
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("all_chars").alias("all_chars"),
    )
    nodes = written(nodes, "trie-nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = written(nodes.join(children, "key", "left").fillna(0, ["n_children"]), "trie-children")
    owners = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("since"), F.sum("n_chars").alias("owned"),
        F.max_by((F.col("n_children") == 0).cast("long"), "depth").alias("leaf"),
    )
    owned = chunks.join(sized(written(owners, "trie-owners")), "conv_id")
    sums = _by_shards(owned, partial_sums, _SUMS, chunk).groupBy("key")
    sums = sums.agg(F.sum("owned_chars").alias("owned_chars"), F.sum("n_leaves").alias("n_leaves"))
    ends = ends_digests(found.where("ends is not null").select("key", "ends_range", "ends"))
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(sums, "key").join(ends, "key", "left").join(above, "parent", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            (F.col("all_chars") - F.col("owned_chars")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of ``conversations(conv_id, turn, role, text)`` as they are; see :func:`ordered` and :func:`trie`."""
    return trie(ordered(conversations))
