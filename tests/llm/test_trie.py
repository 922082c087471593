import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from strata.llm import conversation_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth int, digest string"  # the last two clash


def brute(convs):
    """Rows of the trie over ``{conv_id: [(role, text)]}``, every node as the tuple of its turns."""
    nodes = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    inner = {x[:-1] for x in nodes if x}
    out = []
    for path, members in nodes.items():
        d = len(path)
        below = [x for x in nodes if x[:d] == path]
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == d)
        out.append((
            min(members), d, min(nodes[path[:-1]]) if path else None, len(members), sum(len(x) == d + 1 for x in below),
            sum(x not in inner for x in below), sum((len(nodes[x]) - 1) * len(x[-1][1]) for x in below if x),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def rebuilt(convs):
    crc = lambda c: zlib.crc32(str(c).encode()) % 6
    return {c: convs.get(c - c % 100, [])[: crc(c)] + t[crc(c) :] for c, t in convs.items()}


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "clash") for r in rows], SCHEMA).repartition(4)


def made(spark, convs):
    rows = [(c, i, r, t) for c, ts in convs.items() for i, (r, t) in enumerate(ts)]
    return frame(spark, random.Random(1).sample(rows, len(rows)))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("chunk", [3, 1024])
def test_against_all_prefixes(spark, chunk, monkeypatch):
    # Few rows a shard and a few turns a chunk: nodes and their ends meet from many shards.
    monkeypatch.setattr(T, "SHARD_ROWS", 7)
    rnd = random.Random(3)
    ids = [*range(0, 40), *range(95, 112), 200, 201, 32767, 32768, 70000, 70001, 2**40]
    convs = {c: [("u", rnd.choice("ab") * rnd.randint(1, 2)) for _ in range(rnd.choice([1, 2, 3, 4, 6, 9, 13]))] for c in ids}
    convs |= {c: convs[3] for c in range(300, 330)}  # equal ones
    turns = T.ordered(made(spark, convs))
    assert rows(T.trie(turns, chunk=chunk)) == brute(convs)
    assert rows(T.trie(T.shared_heads(turns), turns.select("conv_id"), chunk=chunk)) == brute(rebuilt(convs))


def test_nulls_ties_and_repeated_rows(spark):
    data = [
        (1, None, "user", "a"), (1, 1, None, "b"), (1, 2, "user", None), (2, None, "user", "a"), (2, 5, "", "b"), (2, 9, "user", ""),
        (3, 1, "user", "a"), (3, 1, "user", "a"), (4, 0, "user", "a"), (4, 1, "user", "a"), (None, 0, "user", "a"), (5, 2, "x", "same"), (5, 2, "a", "same"),
        (6, 0, "a", "same"), (6, 1, "x", "same"), (7, 0, "x", "same"), (7, 1, "a", "same"), (8, 0, "user", "é" * 70_000),
    ]
    got = {(r.conv_id, r.depth): r for r in T.prefix_trie(frame(spark, data)).collect()}
    assert got[1, 0].n_convs == 8 and got[1, 3].n_convs == 2  # a null role or text is an empty one
    assert got[3, 2].n_convs == 2 and got[8, 1].saved_tokens == 0
    # Turns of one number are placed the same way every time; the conversation equals one of its two spellings.
    assert got[5, 2].n_convs == 2


def test_long_conversation_and_equal_ones(spark):
    turns = [("u", str(i % 7)) for i in range(2500)]
    convs = {c: turns[: 2500 if c % 2 else 2048] for c in range(6)} | {9: turns[:1024], 10: [("u", "0"), ("u", "x")], 11: [*turns[:1500], ("u", "y")]}
    got = T.prefix_trie(made(spark, convs)).toPandas().set_index(["conv_id", "depth"]).sort_index()
    assert len(got) == 2500 + 1 + 1 + 1
    root = got.loc[(0, 0)]
    assert (root.n_convs, root.n_children, root.n_leaves) == (9, 1, 3)
    members = {d: sum(len(t) >= d and t[:d] == turns[:d] for t in convs.values()) for d in range(1, 2501)}
    assert root.saved_tokens == sum(m - 1 for m in members.values())
    assert got.loc[(0, 2048)].ends_sha256 == hashlib.sha256(b"0,2,4").hexdigest()
    assert got.loc[(0, 1024)].ends_sha256 == hashlib.sha256(b"9").hexdigest()
    assert got.loc[(1, 2049)].parent_conv_id == 0 and got.loc[(11, 1501)].parent_conv_id == 0
    assert got.loc[(0, 1024)].n_leaves == 2 and got.loc[(0, 1024)].n_children == 1


def test_no_conversations(spark):
    assert T.prefix_trie(frame(spark, [])).count() == 0
    assert T.prefix_trie(frame(spark, [(None, 1, "u", "a")])).count() == 0


def test_segments_of_many_ids():
    low = list(range(0, 30_000, 2))
    assert T._unpack(T._pack(low)).tolist() == low and len(T._pack(low)) == 4096
    assert T._unpack(T._pack(low[:2047])).tolist() == low[:2047] and T._unpack(T._pack([])).tolist() == []
    assert T._unpack(T._pack([5, 32767])).tolist() == [5, 32767]
