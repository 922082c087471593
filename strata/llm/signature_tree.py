"""Jaccard self-join of documents on word shingles, with signature trees.

1. Each text becomes its set of shingle hashes. Equal sets are one class; only
   its smallest id goes on.
2. Two sets of similarity 0.75 share a shingle among the first quarter (and
   one) of each, under any common order. The order here puts the shingles that
   the whole corpus has most often last, so that passages that many documents
   share bring few documents together. Documents that share such a shingle
   form a bucket.
3. Documents that share many of them with their bucket's smallest id are
   compared with it. Connected components of the links found settle nearly all
   buckets: one whose documents are all connected needs no more work.
4. In the other buckets signature trees find the documents that could still
   link: a node holds the OR of its documents' token bitmaps, their range of
   sizes, and the most tokens a document lost to shared bits. Two trees are
   walked together; a pair of nodes is dropped if the sizes or the greatest
   possible overlap rule out a link, or if all their documents are connected
   already. The documents found go through the same walk once more with
   bitmaps of all the shingles they share, so that overlaps are exact. It
   returns only links that connect what was not connected, and components are
   taken over all links.

5. Every link is inside one component. To count them, the classes of each
   component meet pairwise in blocks, in a walk over exact bitmaps that
   leaves out no pair for being connected; a linked class counts with all
   its documents. Counts leave the blocks, not pairs.

No pair with a similarity of 0.75 is lost: the shared prefix shingle, the size
bound and the overlap bound hold for every such pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.components import connected_components
from strata.llm.rowids import row_ids
from strata.llm.shingles import _mix, shingle_sets
from strata.llm.tables import sized, written

PERCENT = 75
FREQUENT_SHINGLES = 50_000  # at most so many shingles are put last in the order: the size of what is broadcast
FREQUENT_TRACKED = 200_000  # counters of the frequency sketch
FREQUENT_LEAST = 100  # a shingle that fewer documents have keeps its place
LEAST_BITS = 64
LEAF = 32
BLOCK = 2000  # documents of a bucket that one task compares with as many others
SHINGLES = 1000  # of a document, for the size of blocks with whole sets: longer ones count as several


def _least_common(n: np.ndarray | int):
    """Shingles that a set of ``n`` has in common with any set it links to, at least."""
    return -(-PERCENT * n // 100)


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    values = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(_signed(values)))


def _set_hashes(s: np.ndarray) -> tuple[int, int]:
    """Two hashes of a whole set."""
    a, b = np.add.reduce(_mix(s)), np.add.reduce(_mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return int(a) & ((1 << 64) - 1), int(b) & ((1 << 64) - 1)


def frequent_shingles(docs: DataFrame) -> list[int]:
    """The shingles that most documents of the whole corpus have, by a frequency sketch; a bounded number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                sets = list(shingle_sets(batch.column(0).slice(i, 500)))
                yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(sets)))], names=["shingle"])

    every = docs.select("text").mapInArrow(run, "shingle long")
    top = every.agg(F.expr(f"approx_top_k(shingle, {FREQUENT_SHINGLES}, {FREQUENT_TRACKED})").alias("top")).first()["top"]
    return [r["item"] for r in top or [] if r["count"] >= FREQUENT_LEAST]


def _bitmap(s: np.ndarray) -> tuple[bytes, int]:
    """The set's token bitmap, with at least a bit per token, and how many tokens found their bit taken.

    A map folds to half its width by OR of its halves: a token's bit is its
    hash modulo the width.
    """
    width = max(LEAST_BITS, 1 << max(len(s) - 1, 0).bit_length())
    on = np.zeros(width, dtype=bool)
    on[s & np.uint64(width - 1)] = True
    return np.packbits(on, bitorder="little").tobytes(), len(s) - int(on.sum())


def sketches(docs: DataFrame, last: list[int]) -> DataFrame:
    """``doc_id, n, set_a, set_b, prefix, late, bitmap, lost`` per row.

    Set size, two hashes of the whole set, the prefix under the common order
    (the frequent shingles in it apart, in ``late``), and the bitmap.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.sort(np.array(last, dtype=np.int64).view(np.uint64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                n, a, b, early, late, maps, lost = [], [], [], [], [], [], []
                for s in shingle_sets(batch.column(1).slice(i, 1000)):
                    size = len(s)
                    n.append(size)
                    set_a, set_b = _set_hashes(s)
                    a.append(set_a)
                    b.append(set_b)
                    bits, gone = _bitmap(s)
                    maps.append(bits)
                    lost.append(gone)
                    take = size - _least_common(size) + 1 if size else 0
                    common = np.zeros(size, dtype=bool)
                    if size and len(frequent):
                        common = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s
                    early.append(s[~common][:take])
                    late.append(s[common][: max(0, take - len(early[-1]))])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, 1000),
                        pa.array(n, pa.int64()),
                        pa.array(_signed(np.array(a, dtype=np.uint64))),
                        pa.array(_signed(np.array(b, dtype=np.uint64))),
                        _lists(early),
                        _lists(late),
                        pa.array(maps, pa.binary()),
                        pa.array(lost, pa.int64()),
                    ],
                    names=["doc_id", "n", "set_a", "set_b", "prefix", "late", "bitmap", "lost"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, set_a long, set_b long, prefix array<long>, late array<long>, bitmap binary, lost long"
    )


def _sets_of(docs: DataFrame, ids: DataFrame, label: str) -> DataFrame:
    """``doc_id, tokens, set_a, set_b`` of the documents ``ids(doc_id)``, read again from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                sets = list(shingle_sets(batch.column(1).slice(i, 500)))
                a, b = (pa.array(_signed(np.array(h, dtype=np.uint64))) for h in zip(*map(_set_hashes, sets), strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 500), _lists(sets), a, b], names=["doc_id", "tokens", "set_a", "set_b"])

    some = docs.select("doc_id", "text").join(sized(ids), "doc_id", "left_semi")
    return written(some.mapInArrow(run, "doc_id long, tokens array<long>, set_a long, set_b long"), label)


def _verified(docs: DataFrame, pairs: DataFrame, label: str) -> DataFrame:
    """Those of the written ``pairs(a, b)`` that link, by their whole sets."""
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    sets = _sets_of(docs, written(ids, f"{label}-ids"), f"{label}-sets")
    few = sized(pairs)
    left = sets.withColumnRenamed("doc_id", "a").join(few, "a").select("a", "b", F.col("tokens").alias("ta"))
    right = sets.withColumnRenamed("doc_id", "b").join(few, "b").select("a", "b", F.col("tokens").alias("tb"))
    common = F.size(F.array_intersect("ta", "tb"))
    both = left.join(right, ["a", "b"]).select("a", "b", common.alias("i"), (F.size("ta") + F.size("tb")).alias("n"))
    links = both.where(F.col("i") * 100 >= (F.col("n") - F.col("i")) * PERCENT).select("a", "b").distinct()
    return written(links, f"{label}-links")


class Tree:
    """Signature tree over documents sorted by size, with bitmaps of one width; a node of a level covers 2 ** level leaves."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, bits: np.ndarray, lost: np.ndarray, component: np.ndarray):
        self.ids, self.n, self.bits, self.lost, self.component = ids, n, bits, lost, component
        edges = np.arange(0, len(n), LEAF)
        self.edges = np.append(edges, len(n))
        one = np.minimum.reduceat(component, edges)
        level = {
            "bits": np.bitwise_or.reduceat(bits, edges, axis=0),
            "low": np.minimum.reduceat(n, edges),
            "high": np.maximum.reduceat(n, edges),
            "lost": np.maximum.reduceat(lost, edges),
            "component": np.where(one == np.maximum.reduceat(component, edges), one, -1),
        }
        self.levels = [level]
        while len(level["low"]) > 1:
            pair = np.arange(0, len(level["low"]), 2)
            same = np.minimum.reduceat(level["component"], pair)
            level = {
                "bits": np.bitwise_or.reduceat(level["bits"], pair, axis=0),
                "low": np.minimum.reduceat(level["low"], pair),
                "high": np.maximum.reduceat(level["high"], pair),
                "lost": np.maximum.reduceat(level["lost"], pair),
                "component": np.where(same == np.maximum.reduceat(level["component"], pair), same, -1),
            }
            self.levels.append(level)

    def folded(self) -> Tree:
        """The same documents with bitmaps of half the width."""
        half = self.bits.shape[1] // 2
        bits = self.bits[:, :half] | self.bits[:, half:]
        lost = self.n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        return Tree(self.ids, self.n, bits, lost, self.component)

    def may_link(self, here: tuple[int, int], other: Tree, there: tuple[int, int]) -> bool:
        x, i, y, j = self.levels[here[0]], here[1], other.levels[there[0]], there[1]
        if x["component"][i] == y["component"][j] != -1:
            return False
        if 100 * x["high"][i] < PERCENT * y["low"][j] or 100 * y["high"][j] < PERCENT * x["low"][i]:
            return False
        need = -(-PERCENT * (int(x["low"][i]) + int(y["low"][j])) // (100 + PERCENT))
        most = int(np.bitwise_count(x["bits"][i] & y["bits"][j]).sum()) + min(int(x["lost"][i]), int(y["lost"][j]))
        return most >= need


def candidates(left: Tree, right: Tree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of pairs that could link, leaf pair by leaf pair; within one tree each pair comes once."""
    same = left is right
    todo = [((len(left.levels) - 1, 0), (len(right.levels) - 1, 0))]
    while todo:
        a, b = todo.pop()
        if not left.may_link(a, right, b):
            continue
        if a[0] or b[0]:
            if same and a == b:
                kids = [(a[0] - 1, k) for k in (2 * a[1], 2 * a[1] + 1) if k < len(left.levels[a[0] - 1]["low"])]
                todo += [(x, y) for i, x in enumerate(kids) for y in kids[i:]]
            elif a[0] >= b[0]:
                todo += [((a[0] - 1, k), b) for k in (2 * a[1], 2 * a[1] + 1) if k < len(left.levels[a[0] - 1]["low"])]
            else:
                todo += [(a, (b[0] - 1, k)) for k in (2 * b[1], 2 * b[1] + 1) if k < len(right.levels[b[0] - 1]["low"])]
            continue
        p, q = slice(*left.edges[a[1] : a[1] + 2]), slice(*right.edges[b[1] : b[1] + 2])
        n = left.n[p][:, None] + right.n[q][None, :]
        common = np.bitwise_count(left.bits[p][:, None, :] & right.bits[q][None, :, :]).sum(axis=2, dtype=np.int64)
        most = np.minimum(common + np.minimum(left.lost[p][:, None], right.lost[q][None, :]), np.minimum(left.n[p][:, None], right.n[q][None, :]))
        fits = (100 * most >= PERCENT * (n - most)) & (left.component[p][:, None] != right.component[q][None, :])
        if same and a == b:
            fits = np.triu(fits, 1)
        i, j = np.nonzero(fits)
        if len(i):
            yield i + p.start, j + q.start


def _trees(rows: pa.Table) -> dict[int, Tree]:
    """A tree per width of bitmap."""
    rows = rows.sort_by([("n", "ascending"), ("doc_id", "ascending")])
    ids, n, lost, component = (rows[c].to_numpy() for c in ("doc_id", "n", "lost", "component"))
    maps = rows["bitmap"].to_pylist()
    widths = np.array([len(m) for m in maps])
    trees = {}
    for w in np.unique(widths).tolist():
        at = np.flatnonzero(widths == w)
        bits = np.frombuffer(b"".join([maps[i] for i in at]), dtype=np.uint64).reshape(len(at), -1)
        trees[w] = Tree(ids[at], n[at], bits, lost[at], component[at])
    return trees


def _bucket_pairs(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one bucket (or pair of blocks) that could link. Linked sets differ by less than one doubling in width."""
    side = rows["side"].to_numpy()
    left = _trees(rows.filter(pa.array(side < 2)))
    right = left if (side == 0).all() else _trees(rows.filter(pa.array(side > 0)))
    for w, tree in left.items():
        meets = [(tree, right[w])] if w in right else []
        if 2 * w in right:
            meets.append((tree, right[2 * w].folded()))
        if right is not left and w % 2 == 0 and w // 2 in right:
            meets.append((tree.folded(), right[w // 2]))
        for x, y in meets:
            for i, j in candidates(x, y):
                yield x.ids[i], y.ids[j]


def _meetings(rows: DataFrame, key: str) -> DataFrame:
    """``rows(key, members, doc_id, ...)`` dealt to groups ``key, i, j``: a group with many members is cut into blocks.

    Every two blocks of a group meet, and every block meets itself, each in a
    task's share of sorted rows. ``side``: 0 for a block that meets itself, 1
    and 2 for two blocks.
    """
    k = F.ceil(F.col("members") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("doc_id"), F.col("_k")).cast("int")
    meeting = F.transform(
        F.sequence(F.lit(0), F.col("_k") - 1),
        lambda j: F.struct(
            F.least("_block", j).alias("i"),
            F.greatest("_block", j).alias("j"),
            F.when(j == F.col("_block"), 0).when(j > F.col("_block"), 1).otherwise(2).cast("long").alias("side"),
        ),
    )
    rest = [c for c in rows.columns if c not in (key, "members")]
    dealt = rows.withColumn("_k", k).withColumn("_block", block).select(key, F.explode(meeting).alias("_m"), *rest)
    return (
        dealt.select(key, "_m.i", "_m.j", "_m.side", *rest).repartition(key, "i", "j").sortWithinPartitions(key, "i", "j")
    )


def _open_documents(rows: DataFrame) -> DataFrame:
    """``low, doc_id`` of documents that have a possible link in ``rows(bucket, members, doc_id, low, component, n, bitmap, lost)``.

    Documents, not pairs, leave the trees: no more rows than went in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["bucket", "i", "j"]):
            found = np.unique(np.concatenate([ids for pair in _bucket_pairs(table) for ids in pair] or [np.empty(0, np.int64)]))
            if len(found):
                low = np.full(len(found), table["low"][0].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(found)], names=["low", "doc_id"])

    return _meetings(rows, "bucket").mapInArrow(run, "low long, doc_id long").distinct()


def _exact_trees(table: pa.Table) -> tuple[Tree, Tree]:
    """Trees whose bitmaps have a bit for each shingle that two documents here share: overlaps are exact."""
    table = table.sort_by([("n", "ascending"), ("doc_id", "ascending")])
    tokens = table["tokens"].combine_chunks()
    edges = tokens.offsets.to_numpy()
    values, place, count = np.unique(tokens.flatten().to_numpy(), return_inverse=True, return_counts=True)
    bit = np.cumsum(count > 1) - 1
    width = 64 * max(1, -(-int((count > 1).sum()) // 64))
    bits = np.zeros((len(table), width // 64), dtype=np.uint64)
    for k in range(len(table)):
        own = place[edges[k] - edges[0] : edges[k + 1] - edges[0]]
        on = np.zeros(width, dtype=bool)
        on[bit[own[count[own] > 1]]] = True
        bits[k] = np.packbits(on, bitorder="little").view(np.uint64)
    side = table["side"].to_numpy()
    ids, n, component = (table[c].to_numpy() for c in ("doc_id", "n", "component"))

    def tree(at: np.ndarray) -> Tree:
        return Tree(ids[at], n[at], bits[at], np.zeros(int(at.sum()), dtype=np.int64), component[at].copy())

    left = tree(side < 2)
    return left, left if (side == 0).all() else tree(side == 2)


def _forest(left: Tree, right: Tree) -> Iterator[tuple[int, int]]:
    """Links between documents of different components, each of which joins two of them."""
    for i, j in candidates(left, right):
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            old, new = left.component[x], right.component[y]
            if old != new:
                yield int(left.ids[x]), int(right.ids[y])
                for t in (left, right):
                    t.component[t.component == old] = new


def _tree_links(rows: DataFrame) -> DataFrame:
    """Links ``(a, b)`` in ``rows(low, members, doc_id, component, n, tokens)`` that connect what was not connected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["low", "i", "j"]):
            sides = table["side"].to_numpy()
            if len(sides) > 1 and not ((sides > 0).all() and (sides == sides[0]).all()):
                links = list(_forest(*_exact_trees(table)))
                if links:
                    a, b = zip(*links, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return _meetings(rows, "low").mapInArrow(run, "a long, b long")


def _link_counts(rows: DataFrame) -> DataFrame:
    """``doc_id, links``: with how many documents each class links, for ``rows(low, members, doc_id, component, n, size, tokens)``.

    A row is a class of ``size`` documents, ``doc_id`` and ``component`` its
    own key, so that no pair of ``low`` counts as connected.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["low", "i", "j"]):
            sides = table["side"].to_numpy()
            if len(sides) < 2 or ((sides > 0).all() and (sides == sides[0]).all()):
                continue
            order = np.argsort(table["doc_id"].to_numpy())
            ids, size = table["doc_id"].to_numpy()[order], table["size"].to_numpy()[order]
            links = np.zeros(len(ids), dtype=np.int64)
            left, right = _exact_trees(table)
            here, there = np.searchsorted(ids, left.ids), np.searchsorted(ids, right.ids)
            for i, j in candidates(left, right):
                np.add.at(links, here[i], size[there[j]])
                np.add.at(links, there[j], size[here[i]])
            some = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some])], names=["doc_id", "links"])

    found = _meetings(rows, "low").mapInArrow(run, "doc_id long, links long")
    return found.groupBy("doc_id").agg(F.sum("links").alias("links"))


def _groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with the same key, each as one table."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        values = np.stack([table[c].to_numpy() for c in key])
        cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        at = 0
        for cut in cuts.tolist():
            yield table.slice(at, cut - at)
            at = cut
        rest = table.slice(at)
    if rest is not None and rest.num_rows:
        yield rest


def _may_meet(rows: DataFrame) -> DataFrame:
    """Rows of a bucket that have a size near enough to the next smaller's or larger's there."""
    by_size = Window.partitionBy("bucket").orderBy("n", "doc_id")
    near = (100 * F.lag("n").over(by_size) >= PERCENT * F.col("n")) | (100 * F.col("n") >= PERCENT * F.lead("n").over(by_size))
    return rows.withColumn("near", near).where("near").drop("near")


def similar_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    The component is the smallest ``doc_id`` reachable by links, itself
    included. Null and blank texts have an empty set and are linked with
    nothing. Rows that repeat an id and its text are one document. Of an id
    with several texts each is a document of its own: it has the links and the
    component of that text, and components of different texts may then be
    called by the same id. A row without an id is linked only through an equal
    set (its component is then that set's), else its component is null.
    Columns other than ``doc_id`` and ``text`` are not read.
    """
    docs, renamed = _documents(docs)
    members, classes, component = _components(docs, renamed)
    return _named(renamed, _labelled(members, classes, component)).select("doc_id", "n_shingles", "component_id")


def similar_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` for every row of ``docs``: `similar_components` and the links of its text.

    ``n_links`` is the number of other documents whose set of shingles has a
    similarity of 0.75 at least with this row's. Rows that repeat an id with
    an equal set are one document, each row without an id is one that only
    equal sets link.
    """
    docs, renamed = _documents(docs)
    members, classes, component = _components(docs, renamed)
    classes = classes.withColumn("key", F.xxhash64("n", "set_a", "set_b"))
    nodes = component.withColumnRenamed("node", "rep")
    # Blocks are cut by documents, or by shingles where documents are long.
    weight = F.greatest(F.count("*"), F.ceil(F.sum("n") / SHINGLES)).alias("members")
    totals = written(classes.join(nodes, "rep").groupBy("component").agg(weight), "component-sizes")
    sets = _sets_of(docs, written(nodes.select(F.col("rep").alias("doc_id")), "linked-ids"), "linked-sets").withColumnRenamed("doc_id", "rep")
    once = sets.withColumn("n", F.size("tokens").cast("long")).join(classes.drop("rows"), ["rep", "n", "set_a", "set_b"]).dropDuplicates(["key"])
    rows = once.join(nodes, "rep").join(sized(totals), "component").select(
        F.col("component").alias("low"), "members", F.col("key").alias("doc_id"), F.col("key").alias("component"), "n", "size", "tokens"
    )
    links = written(_link_counts(rows), "link-counts").withColumnRenamed("doc_id", "key")
    out = _named(renamed, _labelled(members, classes, component)).join(links, "key", "left")
    return out.select(
        "doc_id", "n_shingles", "component_id", (F.coalesce(F.col("size") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).alias("n_links")
    )


def _documents(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``doc_id, text`` with an id of its own for each text of an id that has several, and ``doc_id, given`` of these (None: there are none)."""
    rows, changed = row_ids(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    docs = rows.select(F.col("row_id").alias("doc_id"), "text")
    if not changed:
        return docs, None
    renamed = rows.where("row_id != doc_id").select(F.col("row_id").alias("doc_id"), F.col("doc_id").alias("given")).distinct()
    return docs, written(renamed, "renamed-ids")


def _named(renamed: DataFrame | None, rows: DataFrame) -> DataFrame:
    """``rows`` with the source's ids: of a row, and the smallest one of a component."""
    if renamed is None:
        return rows
    given = F.coalesce("given", "doc_id")
    rows = written(rows.join(sized(renamed), "doc_id", "left").withColumn("doc_id", given).drop("given"), "rows-by-source-id")
    least = rows.where("component_id is not null").groupBy("component_id").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "component_id", "left").withColumn("component_id", F.col("least")).drop("least")


def _labelled(members: DataFrame, classes: DataFrame, component: DataFrame) -> DataFrame:
    """The rows of ``members`` with the columns of their class and ``component_id``."""
    class_of = members.join(classes.drop("rows"), ["n", "set_a", "set_b"], "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    found = class_of.join(component.withColumnRenamed("node", "rep"), "rep", "left")
    return found.withColumn("component_id", F.coalesce("component", "rep")).withColumnRenamed("n", "n_shingles")


def _components(docs: DataFrame, renamed: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sketched rows, their classes of equal sets, and ``node, component`` of the classes' smallest ids that link."""
    sketch = written(sketches(docs, frequent_shingles(docs)), "shingle-sketches")
    members = sketch.select("doc_id", "n", "set_a", "set_b")
    named = members if renamed is None else members.join(sized(renamed), "doc_id", "left")
    given = F.col("doc_id") if renamed is None else F.coalesce("given", "doc_id")
    documents = F.count_distinct(given) + F.count_if(F.col("doc_id").isNull())
    classes = named.where("n > 0").groupBy("n", "set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows"), documents.alias("size"))
    classes = written(classes, "shingle-classes")
    copies = written(
        members.join(classes.where("rows > 1"), ["n", "set_a", "set_b"]).where("doc_id != rep").select("doc_id").distinct(), "shingle-copies"
    )
    first = sketch.where("n > 0 and doc_id is not null").join(sized(copies), "doc_id", "left_anti")
    shared = written(_shared(first), "shingle-buckets")

    sizes = first.select(F.col("doc_id").alias("doc"), (F.size("prefix") + F.size("late")).alias("taken"))
    close = (
        shared.where("doc != low").groupBy("doc", "low").agg(F.count("*").alias("k")).join(sizes, "doc")
        .where("2 * k >= taken").select(F.col("doc").alias("a"), F.col("low").alias("b")).distinct()
    )
    links = _verified(docs, written(close, "near-pairs"), "near")
    settled = written(connected_components(links), "near-components")

    labelled = shared.join(sized(settled).withColumnRenamed("node", "doc"), "doc", "left").select(
        "token", "doc", "low", F.coalesce("component", "doc").alias("component")
    )
    open_buckets = (
        labelled.groupBy("token")
        .agg(
            F.min("component").alias("first"),
            F.max("component").alias("last"),
            F.count("*").alias("members"),
            F.bit_xor(F.xxhash64("doc")).alias("who"),
            F.bit_xor(F.xxhash64("doc", F.lit(1))).alias("who2"),
        )
        .where("first != last")
        .groupBy("members", "who", "who2")  # buckets of the same documents are one
        .agg(F.min("token").alias("token"))
        .select("token", "members")
    )
    rows = labelled.join(sized(written(open_buckets, "open-buckets")), "token")
    facts = first.select(F.col("doc_id").alias("doc"), "n", "bitmap", "lost")
    rows = rows.join(facts.select("doc", "n"), "doc").select(
        F.col("token").alias("bucket"), "low", F.col("doc").alias("doc_id"), "component", "members", "n"
    )
    described = _may_meet(written(rows, "open-rows")).join(facts.select(F.col("doc").alias("doc_id"), "bitmap", "lost"), "doc_id")
    opened = written(_open_documents(described), "open-documents")
    sets = _sets_of(docs, written(opened.select("doc_id").distinct(), "open-ids"), "open-sets")
    labels = opened.join(opened.groupBy("low").agg(F.count("*").alias("members")), "low").join(
        sized(settled).withColumnRenamed("node", "doc_id"), "doc_id", "left"
    )
    whole = labels.join(sets.withColumn("n", F.size("tokens").cast("long")), "doc_id").select(
        "low", "members", "doc_id", F.coalesce("component", "doc_id").alias("component"), "n", "tokens"
    )
    late = written(_tree_links(whole), "tree-links")
    return members, classes, settled if late.isEmpty() else written(connected_components(links.unionByName(late)), "all-components")


def _shared(first: DataFrame) -> DataFrame:
    """``token, doc, low``: prefix shingles that several documents have, with the smallest of these.

    Frequent shingles (known and few) are counted with partial sums and
    joined, so that adaptive execution can split them; the others need only
    one exchange.
    """
    rare = first.select(F.col("doc_id").alias("doc"), F.explode("prefix").alias("token"))
    same = Window.partitionBy("token")
    rare = rare.select("token", "doc", F.min("doc").over(same).alias("low"), F.max("doc").over(same).alias("high"))
    late = first.select(F.col("doc_id").alias("doc"), F.explode("late").alias("token"))
    ends = late.groupBy("token").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    late = late.join(ends, "token").select("token", "doc", "low", "high")
    return rare.unionByName(late).where("low != high").drop("high")
