"""Exact byte-pair encoding by backtracking over longest token matches.

A sequence of tokens is what the merge rules give for a word exactly when
every two neighbours are compatible, that is, when no merge would have joined
them across their border. So a word is encoded from left to right: an
Aho-Corasick automaton names the longest token at a place; if it is not
compatible with the token before, its next shorter prefix token is tried; when
none is left, the token before is shortened. A place that once failed is never
tried again, which keeps the work linear in the length of the word.

Decoding gathers each id's bytes from one table of all token strings through
their offsets.

Splitting into words follows the tokenizer file (composition, white space
dropped, lower case, contractions, runs of letters, single digits, runs of
other signs). Words repeat, so their ids are kept in a bounded cache.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

END = "Ā"  # closes a word: byte strings are held as Latin-1 text, which stops at U+00FF
CHUNK_ENTRIES, WORD_ENTRIES, PAIR_ENTRIES = 200_000, 100_000, 500_000  # bounds of the caches of one worker
_CONTROL_SPACES = re.compile("[\x1c-\x1f]")  # white space for str.split, but not for the tokenizer
_WHITE = regex.compile(r"\p{White_Space}+")


def _byte_letters() -> dict[str, str]:
    """The letters that byte-level vocabularies write for bytes, to those bytes as Latin-1."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): chr(b) for b in shown} | {chr(256 + i): chr(b) for i, b in enumerate(hidden)}


class _Cache:
    """A dictionary of bounded size: two generations, of which the older is dropped."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def put(self, key, value):
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[key] = value
        return value


class BacktrackEncoder:
    """Encodes and decodes as the tokenizer file does, without added start or end tokens."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != "</w>" or model.get("ignore_merges"):
            raise ValueError("a BPE model with </w> word ends is needed")
        letters = _byte_letters()

        def held(token: str) -> str:
            body, end = (token[:-4], END) if token.endswith("</w>") and len(token) > 4 else (token, "")
            return "".join(letters[c] for c in body) + end

        vocabulary = {held(t): i for t, i in model["vocab"].items()}
        self.text_of = {i: t for t, i in vocabulary.items()}
        self.length = {i: len(t) for t, i in vocabulary.items()}
        self.reach = max(self.length.values())
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.automaton = ahocorasick.Automaton()
        for t, i in vocabulary.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        self.shorter = {}
        for t, i in vocabulary.items():
            self.shorter[i] = next((vocabulary[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in vocabulary), -1)
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = (vocabulary[held(x)] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            whole = vocabulary[self.text_of[a] + self.text_of[b]]
            self.rank.setdefault((a, b), rank)
            self.parts.setdefault(whole, (a, b, rank))
        self.pairs: dict[int, bool] = {}  # ids are below 65536: first << 16 | second
        self.words, self.chunks = _Cache(WORD_ENTRIES), _Cache(CHUNK_ENTRIES)
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])

        strings = [b""] * (1 + max([*model["vocab"].values(), *self.special.values()]))
        for t, i in [*model["vocab"].items(), *self.special.items()]:
            strings[i] = t.encode() + b" "
        self.blob = np.frombuffer(b"".join(strings), dtype=np.uint8)
        sizes = np.array([len(x) for x in strings], dtype=np.int64)
        self.offsets = np.concatenate(([0], np.cumsum(sizes)))

    # Compatibility of neighbours

    def _spine(self, token: int, right: bool) -> list[tuple[int, float]]:
        """The token and its parts along one border, each with the rank of the merge that uses it up."""
        out, used = [(token, float("inf"))], float("inf")
        while token in self.parts:
            a, b, used = self.parts[token]
            token = b if right else a
            out.append((token, used))
        return out

    def compatible(self, a: int, b: int) -> bool:
        """Whether no merge joins ``a`` and ``b`` across their border when both are made by merges.

        A part of ``a`` and a part of ``b`` meet if their merge comes before
        the merges that use them up. Among merges of one rank the leftmost
        goes first: the one inside ``a``, but not the one inside ``b``.
        """
        left = self._spine(b, right=False)
        return not any(
            (r := self.rank.get((x, y))) is not None and r < x_used and r <= y_used
            for x, x_used in self._spine(a, right=True)
            for y, y_used in left
        )

    # Encoding

    def _encode_piece(self, piece: str) -> bytes:
        s = piece.encode("utf-8", "replace").decode("latin-1") + END
        n, at, before, out, failed = len(s), 0, -1, [], set()
        longest, length, shorter, pairs = self.automaton.iter_long, self.length, self.shorter, self.pairs
        if len(pairs) > PAIR_ENTRIES:
            pairs.clear()
        # The automaton takes a copy of what it searches: of a long word only as much as a token can be long.
        reach = self.reach
        first = (lambda at: next(longest(s[at : at + reach]))[1]) if n > reach else (lambda at: next(longest(s, at))[1])
        token = first(0)
        while True:
            end = at + length[token]
            if before < 0:
                fits = True
            elif (fits := pairs.get(before << 16 | token)) is None:
                fits = pairs[before << 16 | token] = self.compatible(before, token)
            if fits and end != n - 1 and end not in failed:  # the end mark is no token of its own
                out.append(token)
                if end == n:
                    return struct.pack(f"<{len(out)}I", *out)
                at, before = end, token
                token = first(at)
                continue
            token = shorter[token]
            while token < 0:  # nothing fits here: shorten the token before
                failed.add(at)
                token = out.pop()  # never empty: single letters make every word encodable
                at -= length[token]
                before = out[-1] if out else -1
                token = shorter[token]

    def _encode_chunk(self, chunk: str) -> bytes:
        """Ids of one run without white space, as little-endian 32-bit numbers."""
        known = self.chunks.old.get(chunk)
        if known is None:
            words, out = self.words, []
            for piece in self.pattern.findall(chunk):
                ids = words.young.get(piece)
                if ids is None:
                    ids = words.old.get(piece)
                    ids = words.put(piece, self._encode_piece(piece) if ids is None else ids)
                out.append(ids)
            known = b"".join(out)
        return self.chunks.put(chunk, known)

    def _encode_plain(self, text: str) -> bytes:
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # the tokenizer lowers letter by letter: no special form at a word's end
            text = text.replace("Σ", "σ")
        text = text.lower()
        chunks = _WHITE.split(text) if _CONTROL_SPACES.search(text) else text.split()
        get, miss = self.chunks.young.get, self._encode_chunk
        out = []
        for i in range(0, len(chunks), 4096):  # the young generation can change in between
            get = self.chunks.young.get
            out.extend([get(c) or miss(c) for c in chunks[i : i + 4096]])
        return b"".join(out)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; null gives none."""
        if not text:
            return np.empty(0, dtype="<u4")
        if not self.special or "<|" not in text and not self.special_split.search(text):
            return np.frombuffer(self._encode_plain(text), dtype="<u4")
        parts = self.special_split.split(text)
        ids = [
            np.array([self.special[p]], dtype="<u4") if k % 2 else np.frombuffer(self._encode_plain(p), dtype="<u4")
            for k, p in enumerate(parts)
        ]
        return np.concatenate(ids)

    def decode(self, ids: np.ndarray) -> bytes:
        """Token strings joined by spaces, in UTF-8 (special tokens are not skipped)."""
        out = []
        for i in range(0, len(ids), 1 << 16):
            some = ids[i : i + (1 << 16)].astype(np.int64)
            start, size = self.offsets[some], self.offsets[some + 1] - self.offsets[some]
            ends = np.cumsum(size)
            index = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
            out.append(self.blob[index].tobytes())
        return b"".join(out)[:-1]


@lru_cache(maxsize=2)
def encoder(path: str) -> BacktrackEncoder:
    """The encoder for a tokenizer file, built once in each Python worker."""
    with open(path, encoding="utf-8") as f:
        return BacktrackEncoder(json.load(f))


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Null and empty texts have no tokens: the digests are those of no bytes.
    Every row is kept, repeated rows included. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py())
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
