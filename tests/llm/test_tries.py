"""The prefix trie against a plain one, and the decomposition against a plain rollup."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from roadlens.llm import tries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n_convs string, depth string, k string, c string, kept boolean"


def rebuild(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            t = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, t), (role, text)))
    own = {c: [x for _, x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(np.fmod(c, 5)), [])[:h] + turns[h:]
    return out


def plain(rows):
    convs = rebuild(rows)
    members, below = defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                below[tuple(turns[:d - 1])].add(tuple(turns[:d]))
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        totals[node] = (sum(totals[x][0] for x in below[node]) if below[node] else 1, own + sum(totals[x][1] for x in below[node]))
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), len(below[node]), *totals[node],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(convs[c]) == len(node)))).encode()).hexdigest())
                  for node, m in members.items())


def shown(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in df.collect())


def agrees(spark, rows, block):
    df = spark.createDataFrame([(*r, "x", "y", "z", "w", True) for r in rows], SCHEMA).repartition(5)
    assert shown(tries.prefix_trie(df, block=block)) == plain(rows)


def chat(seed, convs, turns, texts, sparse=False):
    rnd = random.Random(seed)
    ids = [rnd.randrange(-50, 10**6) if sparse else i for i in range(convs)]
    return [(c, t, rnd.choice(["user", "assistant"]), f"text {rnd.randrange(texts)} é") for c in dict.fromkeys(ids)
            for t in range(rnd.randrange(1, turns))]


@pytest.mark.parametrize("block", [3, 40, 4096])
def test_against_a_plain_trie(spark, block):
    agrees(spark, chat(1, 90, 14, 2), block)


def test_missing_first_conversations_and_turnless_ones(spark):
    agrees(spark, chat(2, 60, 6, 3, sparse=True), 16)


def test_one_very_long_conversation_and_many_copies(spark):
    rows = [(5, i, "user", f"t{i % 7}") for i in range(9000)] + [(100 + c, t, "user", f"t{t}") for c in range(120) for t in range(4)]
    agrees(spark, rows, 700)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (1, 0, "user", "b"), (0, 0, None, "x"), (0, None, "", None),
            (None, 0, "user", "no conversation"), (2, 1, "user", "b" * 50_000), (2, 0, "us", "er1"), (3, 0, "use", "r1"), (-4, 0, "user", "é")]
    agrees(spark, rows * 2, 4)
    assert tries.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_split_in_task_equals_a_rollup():
    rnd = random.Random(3)
    for shape in (lambda i: i - 1, lambda i: 0, lambda i: rnd.randrange(i), lambda i: max(0, i - rnd.randrange(1, 4))):
        n = 400
        parent = np.array([-1 if i in (0, 250) else shape(i) if i < 250 else 250 + max(0, shape(i - 250)) if i > 250 else -1 for i in range(n)])
        comp = (np.arange(n) >= 250).astype(np.int64)
        depth, weight, want = np.zeros(n, np.int64), np.ones(n, np.int64), np.array([[i % 5, i] for i in range(n)])
        values = want.copy()
        for i in range(n):
            depth[i] = 0 if parent[i] < 0 else depth[parent[i]] + 1
        for i in range(n - 1, -1, -1):
            if parent[i] >= 0:
                weight[parent[i]] += weight[i]
                want[parent[i]] += want[i]
        assert (tries.split_in_task(comp, parent, depth, weight, values) == want).all()
