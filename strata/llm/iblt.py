"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs (long ones at sentence ends), each with a 64-bit
digest. A sketch has three tables of cells; a digest goes into one cell of
each, where counts are added and digests and their checks are combined by
exclusive or. Two versions' sketches subtract cell by cell: what they share
cancels. A cell left with one digest (its check tells) names it; taking that
digest out of its other cells opens more. When everything peels off, the
differing digests of either side are known exactly.

A fingerprint is the sketch of a text in the smallest size, a power of two by
the number of its digests, at which it peels by itself; a size that fails is
doubled. A table of twice the size folds onto the smaller one by adding its
halves, so fingerprints of any two sizes subtract at the smaller. A pair whose
difference is too large for that is solved by peeling each whole fingerprint
and comparing what they hold, which cannot fail. ``differences`` does all this
from two columns of fingerprints; ``fingerprints`` makes them for a table.

Only DataFrame functions. Cells of a pair stay in its partition: peeling is a
chain of aggregations over the same key and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.tables import sized, written

#: 64 characters and on to the end of the sentence, the rest of a line, or the line ends between.
PARAGRAPH = r"[^\n]{64}[^.!?\n]{0,64}[.!?]*|[^\n]+|\n+"
TABLES = 3
LEAST_CELLS = 8  # in each table
DIGESTS_PER_CELL = 2  # of a table, at most: 0.67 for each cell of the three
PEELS_UP_TO = 0.82  # digests for each cell of the three, beyond which three tables do not peel
ROUNDS = 15  # five turns through the three tables
BUCKET_BITS = 8


def digests(text: Column) -> Column:
    """The distinct paragraph digests of a text; an empty one has none."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda p: F.xxhash64(p)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check"))


def _cell(digest: Column, table: int, size: Column) -> Column:
    """Cells of the tables take turns, so that a number modulo three times a smaller size is the cell it folds onto."""
    return F.pmod(F.xxhash64(digest, F.lit(table)), size) * TABLES + table


def least_size(n: Column) -> Column:
    """Cells a table for ``n`` digests: a power of two."""
    power = F.ceil(F.log2(F.greatest(n / DIGESTS_PER_CELL, F.lit(LEAST_CELLS)).cast("double")))
    return F.pow(F.lit(2.0), power).cast("long")


# The next document


def _next_lower(ids: DataFrame) -> DataFrame:
    """``id, lower`` for distinct ``ids(id)``: the next smaller one, null for the smallest.

    By radix: within groups of neighbouring ids, then between groups in the
    same way. No window holds more than ``2 ** BUCKET_BITS`` rows.
    """
    few = ids.limit((1 << BUCKET_BITS) + 1).count() <= 1 << BUCKET_BITS
    ids = ids.withColumn("g", F.lit(0).cast("long") if few else F.shiftright("id", BUCKET_BITS))
    here = ids.withColumn("lower", F.lead("id").over(Window.partitionBy("g").orderBy(F.desc("id"))))
    if few:
        return here.select("id", "lower")
    groups = written(ids.groupBy("g").agg(F.max("id").alias("head"), F.min("id").alias("tail")), "id-groups")
    below = _next_lower(groups.select(F.col("g").alias("id")))
    heads = groups.select(F.col("g").alias("lower"), F.col("head").alias("below"))
    below = below.join(heads, "lower").select(F.col("id").alias("g"), "below")
    tails = groups.select("g", F.col("tail").alias("id")).join(below, "g", "left").select("id", "below")
    return here.join(tails, "id", "left").select("id", F.coalesce("lower", "below").alias("lower"))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, next_text``, a key ``bucket, place``, unique by row, and that of the next, ``next_bucket, next_place``.

    The next document is the one that follows by descending id (rows that
    repeat an id in the order of their texts, rows without an id last), after
    the last the first; a single row is its own next.
    Each text is shuffled once, with its neighbours.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("_order"))
    rows = rows.withColumn("bucket", F.shiftright("_order", BUCKET_BITS))
    within = Window.partitionBy("bucket").orderBy(F.desc("_order"), "text")
    rows = rows.withColumns({"place": F.row_number().over(within), "_next": F.lead("text").over(within)})

    ids = docs.select(F.shiftright(F.coalesce("doc_id", F.lit(-(1 << 63))), BUCKET_BITS).alias("id")).distinct()
    ids = written(ids, "id-buckets")
    last = ids.agg(F.max("id")).first()[0]
    below = _next_lower(ids).select(F.col("id").alias("bucket"), F.coalesce("lower", F.lit(last)).alias("_below"))
    keyed = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("_order"))
    heads = keyed.groupBy(F.shiftright("_order", BUCKET_BITS).alias("_below")).agg(F.max("_order").alias("_order"))
    heads = keyed.join(sized(written(heads, "bucket-heads")), "_order").groupBy("_below").agg(F.min("text").alias("_head"))
    heads = written(heads, "bucket-texts")
    follow = below.join(heads, "_below").select("bucket", "_below", "_head")
    last_here = F.col("_next").isNull()
    return rows.join(follow, "bucket", "left").select(
        "bucket", "place", "doc_id", "text", F.coalesce("_next", "_head").alias("next_text"),
        F.when(last_here, F.col("_below")).otherwise(F.col("bucket")).alias("next_bucket"),
        F.when(last_here, 1).otherwise(F.col("place") + 1).alias("next_place"),
    )


# Sketches as rows: key, size, cell, c, x, h, and the digest d once one is found

FOUND_A, FOUND_B, SIZES = -1, -2, -3  # cells that hold the outcome


def _row(cell: Column, c: Column, x: Column, h: Column, d: Column | None = None) -> Column:
    fields = {"cell": cell, "c": c, "x": x, "h": h, "d": F.lit(None) if d is None else d}
    return F.struct(*(v.cast("long").alias(n) for n, v in fields.items()))


def _sizes(na: Column, nb: Column) -> Column:
    """Keeps a pair whose digests all cancel, and how many each side had."""
    return _row(F.lit(SIZES), F.lit(1), na, nb)


def _summed(rows: DataFrame, key: list[str]) -> DataFrame:
    sums = rows.groupBy(*key, "size", "cell", "d").agg(F.expr("sum(c) as c"), F.expr("bit_xor(x) as x"), F.expr("bit_xor(h) as h"))
    return sums.where("c != 0 or x != 0 or h != 0")


def _put(pairs: DataFrame, key: list[str]) -> DataFrame:
    """The sketch of ``a`` less that of ``b``, lists of digests, in ``size`` cells a table."""
    signed = lambda side, sign: F.transform(side, lambda d: F.struct(d.alias("x"), F.lit(sign).alias("c")))
    none = F.array(F.struct(F.lit(0).cast("long").alias("x"), F.lit(0).alias("c")))
    rows = pairs.select(
        *key, "size", F.size("a").alias("na"), F.size("b").alias("nb"),
        F.explode(F.concat(signed(F.col("a"), 1), signed(F.col("b"), -1), none)).alias("d"),
    )
    x, c = F.col("d.x"), F.col("d.c")
    spread = F.array(*(_row(_cell(x, t, F.col("size")), c, x, _check(x)) for t in range(TABLES)))
    spread = F.when(c == 0, F.array(_sizes(F.col("na"), F.col("nb")))).otherwise(spread)
    return _summed(rows.select(*key, "size", F.inline(spread)), key)


def _round(t: int) -> str:
    """What a row becomes when table ``t`` is looked at: a digest alone in its cell is named and taken out of the others.

    As SQL text: a chain of rounds in column calls takes the driver longer than the cluster.
    """
    row = "named_struct('cell', {}, 'c', {}, 'x', {}, 'h', {}, 'd', {})".format
    none = "cast(null as bigint)"
    named = row(f"if(c > 0, {FOUND_A}L, {FOUND_B}L)", "1L", "0L", "0L", "x")
    others = [row(f"pmod(xxhash64(x, {u}), size) * {TABLES} + {u}", "-c", "x", "h", none) for u in range(TABLES) if u != t]
    found = f"cell >= 0 and cell % {TABLES} = {t} and abs(c) = 1 and xxhash64(x, 'check') = h"
    return f"inline(if({found}, array({', '.join([named, *others])}), array({row('cell', 'c', 'x', 'h', 'd')})))"


def _peel(cells: DataFrame, key: list[str]) -> DataFrame:
    """``key, size, done, only_a, only_b, na, nb`` by one chain of rounds.

    Each round looks at one table, where a digest has one cell, so none is
    taken out twice.
    """
    for r in range(ROUNDS):
        cells = _summed(cells.selectExpr(*key, "size", _round(r % TABLES)), key)
    at = lambda n, value: F.coalesce(F.max(F.when(F.col("cell") == n, F.col(value))), F.lit(0))
    listed = lambda n: F.collect_list(F.when(F.col("cell") == n, F.col("d")))
    out = cells.groupBy(*key, "size").agg(
        listed(FOUND_A).alias("only_a"), listed(FOUND_B).alias("only_b"), at(SIZES, "x").alias("na"), at(SIZES, "h").alias("nb"),
        F.count_if((F.col("cell") >= 0) | (F.col("c") != 1)).alias("left"),
    )
    # What peeled must add up: else a check failed to tell a mixed cell.
    shared = F.col("na") - F.size("only_a")
    done = (F.col("left") == 0) & (shared == F.col("nb") - F.size("only_b")) & (shared >= 0)
    return out.select(*key, "size", done.alias("done"), "only_a", "only_b", "na", "nb")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sketched(lists: DataFrame, key: list[str], near: list[str] | None = None, size: Column | None = None) -> DataFrame:
    """``key, size, digests`` of the list ``digests``: the size at which its sketch peels by itself, and what came off it.

    It starts at ``size`` and is doubled until all do. ``near`` are columns of
    the key by which the work is dealt.
    """
    size = least_size(F.size("digests")) if size is None else size
    todo = lists.select(*key, "digests", size.alias("size"))
    # Lists are short, their cells are not: the first attempt is not coalesced by the size of the lists.
    many = [int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))]
    parts = []
    while True:
        whole = todo.select(*key, "size", F.col("digests").alias("a"), F.array().cast("array<long>").alias("b"))
        tried = written(_peel(_put(whole.repartition(*many, *(near or key)), key), key), "iblt-alone")
        parts.append(tried.where("done").select(*key, "size", F.col("only_a").alias("digests")))
        failed = tried.where("not done").select(*key, (F.col("size") * 2).alias("size"))
        if failed.isEmpty():
            return _union(parts)
        todo, many = lists.select(*key, "digests").join(sized(failed), key), []


# Fingerprints as text


def _rendered(lists: DataFrame, key: list[str]) -> DataFrame:
    """``key, fingerprint`` of ``key, size, digests``: the size, then cell, count, digests and checks of each cell in use, in hexadecimal."""
    cells = _put(lists.select(*key, "size", F.col("digests").alias("a"), F.array().cast("array<long>").alias("b")), key)
    packed = F.when(F.col("cell") >= 0, F.struct("cell", "c", "x", "h"))
    text = lambda s: F.concat_ws(":", *(F.hex(s[n]) for n in ("cell", "c", "x", "h")))
    one = cells.groupBy(*key, "size").agg(F.sort_array(F.collect_list(packed)).alias("cells"))
    return one.select(*key, F.concat_ws(" ", F.hex("size"), F.transform("cells", text)).alias("fingerprint"))


def _number(hexadecimal: Column) -> Column:
    return F.conv(hexadecimal, 16, -10).cast("long")


def _read(fingerprint: Column) -> tuple[Column, Column]:
    """Cells a table, and the cells in use, of a fingerprint."""
    words = F.split(fingerprint, " ")
    cell = lambda w: F.transform(F.split(w, ":"), _number)
    rows = F.transform(F.slice(words, 2, F.size(words) - 1), lambda w: _row(*(cell(w)[i] for i in range(4))))
    return _number(words[0]), rows


def _held(cells: Column) -> Column:
    """How many digests a sketch holds: the counts of its first table."""
    first = F.filter(cells, lambda r: r["cell"] % TABLES == 0)
    return F.aggregate(first, F.lit(0).cast("long"), lambda n, r: n + r["c"])


def differences(pairs: DataFrame, key: list[str]) -> DataFrame:
    """``key, only_a, only_b, na, nb`` of the fingerprints ``a`` and ``b``: the digests that differ, and how many each has.

    ``key`` names a pair. Pairs without one of the fingerprints are left out.
    """
    (size_a, cells_a), (size_b, cells_b) = _read(F.col("a")), _read(F.col("b"))
    read = pairs.where("a is not null and b is not null").repartition(*key).select(
        *key, size_a.alias("size_a"), size_b.alias("size_b"), cells_a.alias("a"), cells_b.alias("b")
    )
    read = written(read.withColumns({"na": _held(F.col("a")), "nb": _held(F.col("b"))}), "iblt-read")
    fold = lambda side, sign: F.transform(
        side, lambda r: _row(r["cell"] % (F.col("size") * TABLES), r["c"] * sign, r["x"], r["h"])
    )
    sizes = F.array(_sizes(F.col("na"), F.col("nb")))
    rows = read.withColumn("size", F.least("size_a", "size_b")).repartition(*key)
    rows = rows.select(*key, "size", F.inline(F.concat(fold(F.col("a"), 1), fold(F.col("b"), -1), sizes)))
    tried = written(_peel(_summed(rows, key), key), "iblt-differences")
    failed = tried.where("not done").select(*key)
    solved = tried.where("done").select(*key, "only_a", "only_b", "na", "nb")
    if failed.isEmpty():
        return solved
    some = read.join(sized(failed), key, "left_semi")
    side = lambda n: some.select(
        *key, F.lit(n == "b").alias("_b"), F.col(f"size_{n}").alias("size"), F.inline(F.concat(n, F.array(_sizes(F.col(f"n{n}"), F.lit(0)))))
    )
    alone = [*key, "_b"]
    both = side("a").unionByName(side("b")).repartition(*key)
    whole = written(_peel(_summed(both, alone), alone), "iblt-whole")
    a = whole.where("not _b").select(*key, F.col("only_a").alias("a"))
    b = whole.where("_b").select(*key, F.col("only_a").alias("b"))
    return solved.unionByName(_compared(a.join(b, key), key))


def _compared(pairs: DataFrame, key: list[str]) -> DataFrame:
    return pairs.select(
        *key, F.array_except("a", "b").alias("only_a"), F.array_except("b", "a").alias("only_b"),
        F.size("a").cast("long").alias("na"), F.size("b").cast("long").alias("nb"),
    )


def likeness_of(differing: DataFrame, key: list[str]) -> DataFrame:
    """``key, likeness``: digests shared over all, two empty texts being alike."""
    union = F.col("na") + F.size("only_b")
    like = F.when(union == 0, 1.0).otherwise((F.col("na") - F.size("only_a")) / union)
    return differing.select(*key, like.cast("double").alias("likeness"))


def _likeness(pairs: DataFrame, key: list[str]) -> DataFrame:
    """``key, likeness`` of texts whose sketches have peeled: ``size_a, a, size_b, b``, as ``differences`` gives from fingerprints.

    What two fingerprints folded to one size subtract to is the sketch of both
    lists of that size, so it is made of them at once. ``pairs`` is read twice.
    """
    size = F.least("size_a", "size_b")
    too_far = F.abs(F.size("a") - F.size("b")) > size * TABLES * PEELS_UP_TO
    tried = _peel(_put(pairs.where(~too_far).withColumn("size", size), key), key)
    # Only what is asked for is kept: no digests.
    tried = written(likeness_of(tried.where("done"), key), "iblt-likeness")
    rest = pairs.join(sized(tried.select(*key)), key, "left_anti")
    return tried.unionByName(likeness_of(_compared(rest, key), key))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` for every row.

    The edited text has its last third of characters replaced by the first as
    many of the next document. A null text is empty. Columns other than
    ``doc_id`` and ``text`` are not read.
    """
    rows = with_next(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third))
    texts = rows.withColumns({"n_chars": n.cast("long"), "edited": edited})
    table = texts.select(
        "bucket", "place", "next_bucket", "next_place", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("changed"),
    )
    table = written(table, "paragraph-digests")
    row = ["bucket", "place"]
    lists = table.select(*row, F.inline(F.array(
        F.struct(F.lit(0).alias("side"), F.col("own").alias("digests")), F.struct(F.lit(1).alias("side"), F.col("changed").alias("digests")),
    )))
    sketches = written(sketched(lists, [*row, "side"], near=row), "iblt-sketches")

    a = sketches.where("side = 0").select(*row, F.col("size").alias("size_a"), F.col("digests").alias("a"))
    b = sketches.where("side = 1").select(*row, F.lit(0).alias("pair"), F.col("size").alias("size_b"), F.col("digests").alias("b"))
    following = a.select(F.col("bucket").alias("next_bucket"), F.col("place").alias("next_place"), F.col("size_a").alias("size_b"), F.col("a").alias("b"))
    after = table.select(*row, "next_bucket", "next_place").join(following, ["next_bucket", "next_place"])
    after = after.select(*row, F.lit(1).alias("pair"), "size_b", "b")
    near = _likeness(a.join(b.unionByName(after), row), [*row, "pair"])
    of = lambda n: F.max(F.when(F.col("pair") == n, F.col("likeness")))
    near = near.groupBy(*row).agg(of(0).alias("near_edited"), of(1).alias("near_next"))

    text = lambda n: F.max(F.when(F.col("side") == n, F.col("fingerprint")))
    prints = _rendered(sketches.repartition(*row), [*row, "side"])
    prints = prints.groupBy(*row).agg(text(0).alias("fingerprint"), text(1).alias("edited_fingerprint"))
    known = table.select(*row, "doc_id", "n_chars", "edited_sha256")
    return prints.join(known, row).join(near, row).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )
