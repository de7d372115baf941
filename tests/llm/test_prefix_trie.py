"""The prefix trie against a dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest

from starmart.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows, group=5, most=9):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            tie = hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()[:16]
            convs.setdefault(c, []).append((t is not None, t or 0, tie, (r, x)))
    said = {c: [t[3] for t in sorted(ts)] for c, ts in convs.items()}
    if group:
        h = {c: zlib.crc32(str(c).encode()) % most for c in said}
        said = {c: said.get(c - c % group, [])[: h[c]] + ts[h[c]:] for c, ts in said.items()}
    members = {}
    for c, ts in said.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        kids = children.get(p, [])
        leaves[p] = sum(leaves[k] for k in kids) if kids else 1
        saved[p] = sum(saved[k] for k in kids) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    out = set()
    for p, ms in members.items():
        ends = ",".join(map(str, sorted(c for c in ms if len(said[c]) == len(p))))
        out.add((min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), len(children.get(p, [])), leaves[p], saved[p],
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rows_of(df):
    assert df.columns == list(COLUMNS)
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def make(seed, n, longest=12, letters="abc"):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(n * 2), n):
        length = rng.choice([1, 2, 3, 5, longest])
        if rng.random() < 0.3:  # one common conversation
            turns = [("user", "same"), ("assistant", "ü" * 3), ("user", "bye")][: rng.choice([2, 3, 3, 3])]
        else:
            turns = [(rng.choice(["user", "assistant"]), rng.choice(letters)) for _ in range(length)]
        rows += [(c, i, r, x) for i, (r, x) in enumerate(turns)]
    return rows


@pytest.mark.parametrize("group", [5, None])
@pytest.mark.parametrize("shard_rows", [1 << 15, 7])
def test_against_brute_force(spark, group, shard_rows):
    rows = make(1, 120)
    got = rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(3), group=group, shard_rows=shard_rows))
    assert got == brute(rows, group)


@pytest.mark.parametrize("shard_rows", [1 << 15, 5])
def test_long_conversations_cross_bands(spark, shard_rows):
    """Lengths about multiples of a band, and conversations that part only after several bands."""
    rows, rng = [], random.Random(3)
    for c in range(60):
        length = rng.choice([15, 16, 17, 31, 32, 33, 48, 49, 70])
        part = rng.choice([0, 3, 15, 16, 17, 32, 33, 48, 60, 99])
        rows += [(c, i, "user", "x" if i < part else f"{c % 4}") for i in range(length)]
    got = rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), group=None, shard_rows=shard_rows))
    assert got == brute(rows, None)
    got = rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), group=5, shard_rows=shard_rows))
    assert got == brute(rows, 5)


def test_edge_rows(spark):
    """NULL in every column, ties, repeated rows, empty and very long texts, negative ids, clashing columns."""
    rows = [(None, 0, "user", "no id"), (0, None, "user", "first"), (0, 3, None, None), (0, 3, "user", ""), (0, 3, "user", ""), (0, 3, "a", "z"),
            (1, 0, "us", "erx"), (1, 0, "user", "x"), (2, 1, "user", "漢" * 100_000), (7, None, None, None), (7, None, "user", None), (11, 5, "u", "only"),
            (9007199254740993, 0, "user", "big"), (9007199254740992, 0, "user", "big"), (13, 0, "\x00", "a\nb")]
    df = spark.createDataFrame(rows, SCHEMA)
    names = ("id", "size", "at", "band", "ids", "shard", "key", "length", "h", "_run", "left")
    wide = df.selectExpr("*", *(f"'{n}' as `{n}`" for n in names))
    assert rows_of(prefix_trie.prefix_trie(wide, group=5)) == brute(rows)
    assert rows_of(prefix_trie.prefix_trie(df.limit(0), group=5)) == set()
    assert rows_of(prefix_trie.prefix_trie(df.where("conv_id IS NULL"), group=5)) == set()


def test_many_equal_conversations_are_cut(spark):
    """Equal conversations lie in many shards, and their nodes add up."""
    rows = [(c, t, "user", f"t{t}") for c in range(300) for t in range(4)]
    got = rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), group=None, shard_rows=20))
    assert got == brute(rows, None) and len(got) == 5
