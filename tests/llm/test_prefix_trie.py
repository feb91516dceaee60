"""Prefix trie against a plain dictionary of prefixes."""
import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from riskframe.llm import prefix_trie

ROWS = "conv_id long, turn long, role string, text string, c string, path int, head string"


def plain(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    order = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: x[:2])] for c, v in convs.items()}
    base = lambda c: c - (abs(c) % 5) * (1 if c >= 0 else -1)
    seq = {}
    for c, own in order.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq[c] = tuple(order.get(base(c), [])[:h] + own[h:])
    members = defaultdict(list)
    for c, s in seq.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    out, leaves, saved = set(), {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
        ends = ",".join(map(str, sorted(c for c in members[p] if seq[c] == p)))
        out.add((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def data(rng, n=120):
    texts = ["", "é", "hello", "more words here", "Ж" * 40, None]
    rows = []
    for c in range(n):
        for turn in range(rng.choice([1, 2, 3, 5, 9, 14])):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(texts)))
    opening = [(i, "user", f"same {i}") for i in range(30)]
    for c in range(200, 260):  # copies and forks of a long common opening
        rows += [(c, *x) for x in opening[: rng.choice([30, 30, 30, 7])]]
        if c % 3 == 0:
            rows.append((c, 30, "user", f"tail {c % 4}"))
    rows += [(-7, 1, "user", "neg"), (-5, 1, "a", "b"), (-10, 0, "a", "b"), (None, 0, "user", "none"), (None, None, None, None), (9 * 10**18, 1, "user", "far"), (2**63 - 1, 0, "x", "y")]
    rows += [(300, None, "user", "first"), (300, -4, "user", "second"), (300, 2**40, None, None), (301, 5, "r" * 5000, "long " * 20000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [1, 40, prefix_trie.LIMIT])
def test_equals_plain_prefixes(spark, limit, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 3)
    rows = data(random.Random(13))
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], ROWS).repartition(4)
    got = [tuple(r) for r in prefix_trie.conversation_trie(df, limit=limit).collect()]
    want = plain(rows)
    assert len(got) == len(want) and set(got) == want


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "user", "b")]
    got = {tuple(r) for r in prefix_trie.conversation_trie(spark.createDataFrame([(*r, "x", 1, "y") for r in rows], ROWS)).collect()}
    assert got == plain(rows)
    assert prefix_trie.conversation_trie(spark.createDataFrame([], ROWS)).count() == 0
