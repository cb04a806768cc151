"""The conversation trie against a plain walk over all prefixes."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from wardframe.llm import trie

CONVS = "conv_id long, turn long, role string, text string, d1 string, members int, pos string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            tie = tuple(int.from_bytes(tie[i:i + 8], "big", signed=True) for i in (0, 8))
            own[c].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
        ends[paths[c]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        own_leaf, own_saved = int(not kids[node]), (len(members[node]) - 1) * (len(WORD.findall(node[-1][1])) if node else 0)
        sums[node] = (own_leaf + sum(sums[k][0] for k in kids[node]), own_saved + sum(sums[k][1] for k in kids[node]))
    return sorted(((m[0], len(n), members[n[:-1]][0] if n else None, len(m), len(kids[n]), *sums[n],
                    hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()) for n, m in members.items()), key=repr)


def made():
    rng = np.random.default_rng(7)
    rows = []
    for c in [*range(-45, 130), 10**12, 10**12 + 7]:
        for t in range(int(rng.integers(0, 7))):
            rows.append((c, t, ["user", "assistant", None][int(rng.integers(0, 3))], ["hot words here", "b", "", None, "c  d\te"][min(4, int(rng.integers(0, 12)) // 2)]))
    rows += [(c, t, "user", "the hot first turn" if t == 0 else f"x{t}") for c in range(200, 260) for t in range(4)]  # copies
    rows += [(300, t, "user", f"long {t % 7}") for t in range(900)]  # a long conversation, and one that leaves it late
    rows += [(301, t, "user", f"long {t % 7}" if t < 700 else "other") for t in range(800)]
    rows += [(None, 0, "user", "no id")] * 5 + [(400, None, "user", "first"), (400, 0, "user", "tie"), (400, 0, "user", "tie"), (400, 0, "assistant", "tie")]
    return [r + ("x", 1, "y") for r in rows]


def got_of(frame, **how):
    return sorted((tuple(r) for r in trie.prefix_trie(frame, **how).collect()), key=repr)


@pytest.mark.parametrize("shard", [1 << 16, 40, 1])
def test_against_brute_force(spark, shard):
    rows = made()
    assert got_of(spark.createDataFrame(rows, CONVS).repartition(5), shard=shard) == brute([r[:4] for r in rows])


def test_empty_and_turnless(spark):
    assert trie.prefix_trie(spark.createDataFrame([], CONVS)).collect() == []
    alone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)  # gives its only turn away and borrows none
    rows = [(alone, 0, "user", "gone", "x", 1, "y")]
    assert got_of(spark.createDataFrame(rows, CONVS)) == brute([rows[0][:4]])


def test_walk_has_one_node_for_each_prefix():
    paths = [[(1, 1, 1), (2, 2, 1)], [(1, 1, 1)], [], [(3, 3, 1), (2, 2, 1)], [(1, 1, 1), (2, 2, 1)]]
    nodes = trie.walk([10, 20, 30, 40, 50], paths)
    assert len({n[:2] for n in nodes}) == len(nodes) == 5
    assert {(n[4], n[6], n[7], n[9]) for n in nodes} == {(0, 10, 5, "30"), (1, 10, 3, "20"), (2, 10, 2, "10,50"), (1, 40, 1, ""), (2, 40, 1, "40")}
