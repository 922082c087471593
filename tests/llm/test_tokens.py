import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import docs  # noqa: F401
from tokenizers import Tokenizer

from strata.llm import best_two_fit, bpe_backtrack

ODD = [
    None, "", "   ", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "ΑΣ ΟΔΟΣ", "é é\x1cx\x85y", "it's we'll 12³",
    "a" * 300, "hahahaha" * 40, "!?" * 50, "漢字😀", "word " * 9000, "x" * 20000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe_backtrack.vocabulary_path())


def test_encodes_and_decodes_as_the_library(library):
    rng = random.Random(5)
    bpe = bpe_backtrack.encoder(bpe_backtrack.vocabulary_path())
    texts = ODD + ["".join(rng.choices("aaabcdeéßΣςİI'sStre\t\x1c 漢😀12<|>.!?́", k=rng.randint(0, 20))) for _ in range(3000)]
    for t in texts:
        want, got = library.encode(t or "", add_special_tokens=False).ids, bpe.encode(t)
        assert got.tolist() == want
        assert bpe.decode(got).decode() == library.decode(want, skip_special_tokens=False)


def test_long_words_as_the_library_and_in_linear_time(library):
    import time

    rng = random.Random(6)
    bpe = bpe_backtrack.encoder(bpe_backtrack.vocabulary_path())
    word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1 << 18))
    for part in (word[: 1 << 14], "ab" * 5000, "é" * 3000 + word[:3000], "a" * 9999):
        assert bpe.encode(part).tolist() == library.encode(part, add_special_tokens=False).ids

    def took(n):
        begin = time.process_time()
        bpe._encode_piece(word[:n])
        return time.process_time() - begin

    took(1 << 12)
    assert took(1 << 18) < 12 * max(0.02, took(1 << 16))  # 4 times the letters


def test_encode_digests_rows(docs, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(len(ODD), "twice"), (len(ODD), "twice")]
    got = bpe_backtrack.encode_digests(docs(rows), bpe_backtrack.vocabulary_path()).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    ids = library.encode("漢字😀", add_special_tokens=False).ids
    assert hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest() in {r.ids_sha256 for r in got}
    assert bpe_backtrack.encode_digests(docs([]), bpe_backtrack.vocabulary_path()).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_plan_uses_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 50, 4096])
    counts = {rng.randint(1, capacity): rng.choice([1, 2, 3, 1000]) for _ in range(rng.randint(0, 60))}
    used = Counter()
    plan = best_two_fit.best_two_fit(counts, capacity)
    for bin_, times in plan:
        assert sum(bin_) <= capacity and times > 0
        for n in bin_:
            used[n] += times
    assert used == Counter(counts)


def test_two_pieces_replace_the_smallest_when_they_fit_more_tightly():
    # Greedy takes 6 and 3 (gap 1); 2 + 2 fill what 6 leaves.
    assert best_two_fit.best_two_fit({6: 1, 3: 1, 2: 2}, 10)[0] == ([6, 2, 2], 1)


def test_packing_covers_all_tokens(docs, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "again"), (3, "again"), (None, "no id")]
    got = best_two_fit.pack(docs(rows), bpe_backtrack.vocabulary_path()).collect()
    want = []
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want += [(i, p, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes())) for p, at in enumerate(range(0, len(ids), 4096))]
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in got)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(by) == -(-sum(r.length for r in got) // 4096)
    assert best_two_fit.pack(docs([]), bpe_backtrack.vocabulary_path()).count() == 0
