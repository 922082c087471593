import hashlib
import random
import re

from llm_helpers import docs  # noqa: F401
from pyspark.sql import functions as F

from strata.llm import iblt


def pieces(text):
    return set(re.findall(iblt.PARAGRAPH, text))


def jaccard(a, b):
    a, b = pieces(a), pieces(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_next_lower_id_over_many_radix_levels(spark):
    rng = random.Random(3)
    ids = sorted({rng.randrange(-(1 << 40), 1 << 40) for _ in range(300)} | set(range(5000, 5600)) | {-(1 << 63), (1 << 63) - 1})
    got = dict(iblt._next_lower(spark.createDataFrame([(i,) for i in ids], "id long")).collect())
    assert got == dict(zip(ids[1:], ids[:-1])) | {ids[0]: None}


def test_fingerprints_equal_brute_force(spark, docs):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    text = lambda n: ". ".join(" ".join(rng.choices(words, k=rng.randint(3, 30))) for _ in range(n))
    base = text(40)
    rows = [(1, None), (2, ""), (3, "a"), (900, base), (7, base), (1 << 40, base + "\n" + text(3)), (-5, text(600)), (12, "é😀" * 50)]
    extra = docs(rows).withColumn("bucket", F.lit(1)).withColumn("own", F.lit("x")).withColumn("next_text", F.lit(0))
    got = {r.doc_id: r for r in iblt.fingerprints(extra).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for (i, t), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        t, following = t or "", following or ""
        third = len(t) // 3
        edited = t[: len(t) - third] + following[:third]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r.near_edited - jaccard(t, edited)) < 1e-12
        assert abs(r.near_next - jaccard(t, following)) < 1e-12
    assert got[900].fingerprint == got[7].fingerprint != got[3].fingerprint
    assert got[1].fingerprint == got[2].fingerprint


def texts_of_all_sizes():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    text = lambda n: "\n".join(" ".join(rng.choices(words, k=rng.randint(3, 12))) for _ in range(n))
    base = text(300)
    return ["", "a", "a\nb", base, base + "\n" + text(4), base[:3000], text(300), text(5), text(2000), "\n".join([base, text(900), base]), None]


def test_differences_from_returned_columns_alone(spark, docs):
    texts = dict(enumerate(texts_of_all_sizes()))
    digest = {p: spark.range(1).select(F.xxhash64(F.lit(p))).first()[0] for p in ["a", "b", "\n"]}
    got = {r.doc_id: r for r in iblt.fingerprints(docs(list(texts.items()))).collect()}
    prints = [(i, r.fingerprint) for i, r in got.items()]
    pairs = [(i, j, f, g) for i, f in prints for j, g in prints] + [(i, 100, r.fingerprint, r.edited_fingerprint) for i, r in got.items()]
    found = iblt.differences(spark.createDataFrame([*pairs, (-1, 0, None, "8")], "i long, j long, a string, b string"), ["i", "j"])
    found = {(r.i, r.j): r for r in found.collect()}
    likes = iblt.likeness_of(spark.createDataFrame(list(found.values())), ["i", "j"]).collect()
    likes = {(r.i, r.j): r.likeness for r in likes}
    assert len(found) == len(pairs)  # the pair without a fingerprint is left out
    last = max(texts)
    for i, a in texts.items():
        assert abs(likes[i, 100] - got[i].near_edited) < 1e-12
        assert abs(likes[i, (i - 1) % (last + 1)] - got[i].near_next) < 1e-12
        for j, b in texts.items():
            x, y, r = pieces(a or ""), pieces(b or ""), found[i, j]
            assert abs(likes[i, j] - jaccard(a or "", b or "")) < 1e-12
            assert (len(set(r.only_a)), len(set(r.only_b))) == (len(r.only_a), len(r.only_b)) == (len(x - y), len(y - x))
            assert (r.na, r.nb) == (len(x), len(y))
    assert sorted(found[2, 1].only_a) == sorted([digest["b"], digest["\n"]]) and found[2, 1].only_b == []
    assert found[0, 1].only_b == [digest["a"]]


def test_fingerprints_grow_with_the_digests_and_equal_texts_are_equal(spark, docs):
    texts = dict(enumerate(texts_of_all_sizes()))
    got = {r.doc_id: r.fingerprint for r in iblt.fingerprints(docs([*texts.items(), (99, texts[3])])).collect()}
    assert got[3] == got[99] and got[0] == got[len(texts) - 1] == "8"
    for i, t in texts.items():
        n = len(pieces(t or ""))
        size = int(got[i].split()[0], 16)
        assert n / 2 <= size <= max(16, 2 * n) and len(got[i].split()) - 1 <= 3 * n


def test_small_sketches_fail_and_are_sketched_larger(spark):
    lists = [(k, [k * 1000 + i for i in range(k)]) for k in (0, 1, 7, 60, 900)]
    got = iblt.sketched(spark.createDataFrame(lists, "k long, digests array<long>"), ["k"], size=F.lit(2).cast("long"))
    got = {r.k: r for r in got.collect()}
    assert {k: sorted(r.digests) for k, r in got.items()} == dict(lists)
    assert got[0]["size"] == 2 and got[900]["size"] >= 512


def test_repeated_null_and_single_rows(spark, docs):
    same = iblt.fingerprints(docs([(4, "x y"), (4, "x y"), (None, "z")])).collect()
    assert sorted((r.doc_id is None, r.near_next) for r in same) == [(False, 0.0), (False, 1.0), (True, 0.0)]
    one = iblt.fingerprints(docs([(4, "abcdef")])).collect()[0]
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1.0
    assert iblt.fingerprints(docs([])).count() == 0
