"""The trie of conversations against a plain one, and its edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ebbtide.llm import prefixtrie
from ebbtide.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string, depth int, part string, leaves int"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def frame(spark, rows):
    """Turns with extra columns of names that the operator uses inside."""
    return spark.createDataFrame([(*r, 7, "p", 9) for r in rows], TURNS)


def plain_turns(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [t[1:] for t in sorted(turns)] for c, turns in found.items()}


def plain_branched(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    totals = {}
    for prefix in sorted(members, key=len, reverse=True):
        own = (len(members[prefix]) - 1) * len(prefix[-1][1].encode()) if prefix else 0
        below = [totals[c] for c in children[prefix]]
        totals[prefix] = (sum(b[0] for b in below) if below else 1, own + sum(b[1] for b in below))
    rows = set()
    for prefix, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(prefix))
        rows.add(
            (
                min(ids),
                len(prefix),
                min(members[prefix[:-1]]) if prefix else None,
                len(ids),
                len(children[prefix]),
                *totals[prefix],
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    assert len(rows) == len(members)
    return rows


def held(df):
    rows = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def made(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), 150):
        length = rng.choice([0, 1, 2, 5, 8, 12])
        shape = rng.choice(["common", "own", "few"])
        for i in range(length):
            text = {"common": "é" * i, "own": f"{c} {i}", "few": rng.choice("ab")}[shape]
            rows.append((c, rng.choice([i, i, None]), rng.choice(["user", None]), rng.choice([text, text, None])))
    rows += [(900, i, "user", f"long {i % 7}") for i in range(300)] + [(901, i, "user", f"long {i % 7}") for i in range(180)]
    rows += [(None, 1, "user", "lost"), (3000, 1, "a", "x"), (3000, 1, "a", "x"), (3000, 1, "", "z" * 200_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_plain_one(spark, monkeypatch, seed):
    monkeypatch.setattr(prefixtrie, "_BLOCK", 16)
    monkeypatch.setattr(prefixtrie, "_SPELLED", 8)
    rows = made(seed)
    df = frame(spark, rows)
    turns = prefixtrie.ordered_turns(df)
    assert held(prefixtrie.describe(turns, df)) == plain_trie(plain_turns(rows))
    rebuilt = prefixtrie.branched(turns)
    assert held(prefixtrie.describe(rebuilt, df)) == plain_trie(plain_branched(plain_turns(rows)))


def test_trie_edges(spark):
    empty = frame(spark, [])
    assert held(prefixtrie.describe(prefixtrie.branched(prefixtrie.ordered_turns(empty)), empty)) == set()
    # Conversation 1 takes turns of 0, which is absent, and has none after its first h.
    rows = [(1, 0, "user", "only")]
    assert plain_branched(plain_turns(rows)) == {1: []}
    df = frame(spark, rows)
    got = held(prefixtrie.describe(prefixtrie.branched(prefixtrie.ordered_turns(df)), df))
    assert got == plain_trie({1: []})


def test_query_equals_plain_trie(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = QUERIES["op13_conversation_prefix_trie"](spark, folder)
    assert {f.dataType.simpleString() for f in got.schema if f.name != "ends_sha256"} == {"bigint"}
    assert held(got) == plain_trie(plain_branched(plain_turns(map(tuple, rows))))
