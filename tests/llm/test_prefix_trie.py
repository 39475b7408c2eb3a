"""The trie of conversation prefixes against a plain one."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from evlake.llm import prefix_trie as trie
from evlake.llm.prefix_trie import prefix_trie, rebuilt, turns_of

COLUMNS = "conv_id long, turn long, role string, text string, conv long, place int, token string, words int, shard long, path string"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "t", 3, 4, "p") for r in rows], COLUMNS)


def sequences(rows):
    """The turns of every conversation, in order."""
    def digest(role, text):
        return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()

    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn, digest(role or "", text or ""), role or "", text or ""))
    return {c: [t[3:] for t in sorted(ts)] for c, ts in found.items()}


def swapped(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = abs(c) // 20 * 20 * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(m) - 1) * words
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in m if len(convs[c]) == len(p)).encode()).hexdigest())
        for p, m in members.items()
    )


def got(df):
    return sorted(tuple(r[c] for c in NODE) for r in df.collect())


@pytest.mark.parametrize("ids", [20, 320])
def test_against_brute_force(spark, monkeypatch, ids):
    monkeypatch.setattr(trie, "SHARD_IDS", ids)
    rng = random.Random(9)
    rows = []
    for c in [*range(-70, 200), 10**15, 10**15 + 1, -(2**63), 2**63 - 1]:
        n = rng.choice([1, 1, 2, 3, 5])
        rows += [(c, t, rng.choice(["user", "assistant"]), f"say {rng.randrange(3)} {'word ' * rng.randrange(3)}") for t in range(n)]
    rows += [(300 + i, t, "user", f"the same {t}") for i in range(60) for t in range(4)]
    rng.shuffle(rows)
    turns = turns_of(table(spark, rows))
    assert got(prefix_trie(turns)) == brute(sequences(rows))
    assert got(prefix_trie(rebuilt(turns))) == brute(swapped(sequences(rows)))


def test_awkward_rows(spark):
    rows = [
        (1, 0, "user", "a b"), (1, 0, "user", "a b"), (1, None, None, None), (2, None, "", ""), (2, 0, "user", "a b"),
        (None, 0, "user", "lost"), (3, 5, "user", ""), (3, 7, None, "x" * 100_000), (4, 1, "us", "er1"), (5, 1, "user", "1"),
        (6, 0, "u", "é \U0001f600\tw"), (7, 1, "user", "z"), (7, 1, "user", "y"), (8, -4, "user", "z"),
    ]
    rows += [(40, t, "user", f"turn {t}") for t in range(700)]
    turns = turns_of(table(spark, rows))
    assert got(prefix_trie(turns)) == brute(sequences(rows))
    assert got(prefix_trie(rebuilt(turns))) == brute(swapped(sequences(rows)))
    assert prefix_trie(rebuilt(turns_of(table(spark, [])))).count() == 0
