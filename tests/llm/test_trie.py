"""The prefix trie against one built in memory."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from graphloom.llm import prefix_trie


def rebuilt(rows):
    """Conversations of the contract, from (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, n, role, text, *_ in rows:
        if c is not None:
            own[c].append((n is not None, n or 0, role or "", len(text or ""), text or ""))
    own = {c: [(r, x) for *_, r, _, x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, who in members.items():
        below = [n for n in members if n[:len(node)] == node]
        leaf = [n for n in below if not any(m[:-1] == n for m in members if m)]
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(node))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), sum(1 for m in members if m and m[:-1] == node), len(leaf),
                    sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns == names
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


SCHEMA = "conv_id long, turn long, role string, text string, pos string, a string, size string, depth string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def some(seed, n):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant", None]) if t > 2 else "user", rng.choice(["a", "bb", "ça va", None, ""]) if t else "hello")
            for c in [*rng.sample(range(0, 900), n), 0, 100, 200] for t in range(rng.randrange(1, 12))]


def test_against_a_trie_in_memory(spark):
    rows = list(dict.fromkeys(some(1, 60)))
    assert result(prefix_trie.shared_head_trie(table(spark, rows))) == brute(rebuilt(rows))


def test_long_conversations_in_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    monkeypatch.setattr(prefix_trie, "PIECE", 4)
    monkeypatch.setattr(prefix_trie, "LIST_BITS", 1)
    rows = list(dict.fromkeys(some(2, 25)))
    rows += [(c, t, "user", "same" if t < 40 else f"own {c}") for c in (301, 302, 700) for t in range(50)]
    rows += [(c, t, "user", "alike") for c in range(400, 440) for t in range(7)]
    assert result(prefix_trie.shared_head_trie(table(spark, rows))) == brute(rebuilt(rows))


def test_awkward_rows(spark):
    rows = [(1, None, None, None), (1, 5, "user", "x"), (1, 5, "user", "x"), (1, 5, "assistant", "x"), (None, 1, "user", "lost"), (-5, 1, "user", ""),
            (-100, 0, "user", "é😀"), (2**40, 0, "a", "b"), (2**40 + 1, 0, "a", "b" * 50_000), (3, 0, "ab", "c"), (4, 0, "a", "bc"), (5, -1, "user", "x")]
    convs = rebuilt(rows)
    for c in (-5, -100):  # SQL's remainder has the sign of the dividend
        h = zlib.crc32(str(c).encode()) % 6
        mine = [(r, x) for i, _, r, x in rows if i == c]
        convs[c] = ([] if c == -5 else mine)[:h] + mine[h:]
    assert result(prefix_trie.shared_head_trie(table(spark, rows))) == brute(convs)
    plain = {c: sorted(t for t in ((r or "", x or "") for i, _, r, x in rows if i == c)) for c in (3, 4, 5)}
    assert result(prefix_trie.conversation_trie(table(spark, [r for r in rows if r[0] in (3, 4, 5)]))) == brute(plain)


@pytest.mark.parametrize("build", [prefix_trie.shared_head_trie, prefix_trie.conversation_trie])
def test_no_conversation_no_node(spark, build):
    assert build(table(spark, [])).count() == 0
    assert build(table(spark, [(None, 1, "a", "b")])).count() == 0
