import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import ppm_langid as P


class Plain:
    """Prediction by partial matching, one byte after the other, from the definition."""

    def __init__(self, sample, least):
        self.known = {b for _, t in sample for b in t.encode()}
        self.times = defaultdict(Counter)  # language and context: how often each byte followed
        self.seen = Counter()  # context, in any language
        for lang, t in sample:
            for context, byte in self.places(t.encode()):
                for k in range(P.ORDER + 1):
                    self.times[lang, context[P.ORDER - k :]][byte] += 1
                    self.seen[context[P.ORDER - k :]] += 1
        self.least = least

    def places(self, data):
        """Each byte with the three before it; what training never saw is as what stands before a text."""
        row = [None] * P.ORDER + [b if b in self.known else None for b in data]
        return [(tuple(row[i : i + P.ORDER]), data[i]) for i in range(len(data))]

    def bits(self, lang, text):
        total = 0.0
        for context, byte in self.places(text.encode()):
            for k in range(P.ORDER, -1, -1):
                here = context[P.ORDER - k :]
                if k and self.seen[here] < self.least:
                    continue
                times = self.times[lang, here]
                n, kinds = sum(times.values()), len(times)
                if times[byte]:
                    total += math.log2((n + kinds) / times[byte])
                    break
                del times[byte]
                total += math.log2((n + kinds) / kinds) if kinds else 0
            else:
                total += math.log2(257)
        return total


@pytest.mark.parametrize("least", [1, 3, 20])
def test_code_lengths_equal_plain_ppm(spark, least):
    rng = random.Random(least)
    words = {"en": "the quick brown fox jumps over a lazy dog".split(), "de": "der schnelle braune Fuchs läuft über den Hund".split(), "xx": ["ü", "é😀"]}
    sample = [(lang, " ".join(rng.choices(w, k=rng.randint(0, 30)))) for lang, w in words.items() for _ in range(12)]
    counted = P.count_contexts(spark.createDataFrame(sample, "lang string, text string").repartition(3)).collect()
    model = P.fit([(r.lang, r.key, r.n) for r in counted], least)
    plain = Plain(sample, least)
    texts = ["", "the fox", "über", "ZZZ zz", "ж" * 5, "the lazy Hund 😀", *(t for _, t in sample[::5]), "q" * 40]
    data = [t.encode() for t in texts]
    starts = np.concatenate(([0], np.cumsum([len(d) for d in data])))
    got = model.code_lengths(np.frombuffer(b"".join(data), np.uint8), starts)
    want = [[plain.bits(lang, t) for lang in model.languages] for t in texts]
    assert model.languages == sorted(words) and np.allclose(got, want, rtol=1e-5, atol=1e-6)


def test_the_model_learns_from_every_labelled_row(spark):
    """4,500 texts of a language: a sample of 1,500 would miss most words that only one text has."""
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices("abcdefghij", k=5)) + chr(0x100 + i % 1500), "xx" if i % 9 else "yy") for i in range(4500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    learned = [(lang, t) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    counts = Counter()
    for lang, t in learned:
        data = np.frombuffer(t.encode(), np.uint8)
        counts.update((lang, int(k)) for k in P._keys(data, 0, len(data), 0))
    got, want = P.train(docs), P.fit([(lang, k, n) for (lang, k), n in counts.items()])
    assert got.languages == want.languages and np.array_equal(got.byte_class, want.byte_class)
    assert np.array_equal(got.node_of, want.node_of) and np.allclose(got.bits, want.bits)
    # The usual bits, too, are the median of all held-out rows that are recognised.
    model = got
    kept = [(lang, t.encode()) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    starts = np.cumsum([0] + [len(t) for _, t in kept])
    bits = model.code_lengths(np.frombuffer(b"".join(t for _, t in kept), np.uint8), starts)
    rates = defaultdict(list)
    for (lang, t), b in zip(kept, bits, strict=True):
        if model.languages[int(b.argmin())] == lang:
            rates[lang].append(b.min() / len(t))
    usual = P.usual_bits(docs, model)
    assert usual == pytest.approx({lang: sorted(r)[(len(r) - 1) // 2] for lang, r in rates.items()})


@pytest.mark.parametrize("most", [0, 3, 40, 10_000])
def test_a_bound_on_nodes_loses_no_count(spark, most):
    rng = random.Random(most)
    sample = [(lang, "".join(rng.choices(letters, k=60))) for lang, letters in (("a", "abcd"), ("b", "cdeü")) for _ in range(40)]
    counted = P.count_contexts(spark.createDataFrame(sample, "lang string, text string")).cache()
    rows = [(r.lang, r.key, r.n) for r in counted.collect()]
    seen = Counter()
    for _, key, n in rows:
        seen[key >> 8] += n
    least = next(t for t in range(8, 10**6) if sum(n >= t for n in seen.values()) <= most)
    few = P.context_counts(counted, 8, most).collect()
    assert sum(r.n for r in few) == sum(n for _, _, n in rows)
    assert {r.key >> 8 for r in few if r.deep} == {c for c, n in seen.items() if n >= least}
    key, n, deep = (np.array([r[c] for r in few]) for c in ("key", "n", "deep"))
    got = P._fit([r.lang for r in few], key, n.astype(float), deep, 8)
    data = [t.encode() for _, t in sample[::7]]
    lengths = got.code_lengths(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(d) for d in data]))
    assert np.isfinite(lengths).all() and [got.languages[i] for i in lengths.argmin(axis=1)] == [lang for lang, _ in sample[::7]]
    if most == 10_000:
        plain = P.fit(rows, 8)
        assert np.array_equal(got.node_of, plain.node_of) and np.allclose(got.bits, plain.bits)
