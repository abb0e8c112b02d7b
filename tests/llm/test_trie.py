"""Operator 12 against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from newsloom.llm.prefix_trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuild(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(rows):
    convs = rebuild(rows)
    nodes = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for seq, members in nodes.items():
        if seq:
            kids[seq[:-1]] += 1
        for d in range(len(seq) + 1):
            saved[seq[:d]] += (len(members) - 1) * len(seq[-1][1].encode()) if seq else 0
    for seq in nodes:
        if not kids[seq]:
            for d in range(len(seq) + 1):
                leaves[seq[:d]] += 1
    out = []
    for seq, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(seq))
        out.append((min(members), len(seq), min(nodes[seq[:-1]]) if seq else None, len(members), kids[seq], leaves[seq], saved[seq], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in prefix_trie(df).select(*columns).collect()), key=str)


def test_conversations(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    assert got(df) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def odd_conversations():
    rng = random.Random(2)
    rows = []
    for c in [*range(-12, 40), 1000, 2**62, -(2**62), 777]:
        for t in range(rng.randint(1, 14)):
            rows.append((c, None if rng.random() < 0.05 else rng.choice((t, t, t, 3)), rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "b", "ü日本", None, "", "long " * 3000])))
    rows += [r for r in rows if r[0] == 7] + [(None, 1, "user", "no conversation")]
    rows += [(c, t, "user", "same") for c in range(5000, 5060) for t in range(12)]  # copies
    rows += [(9001, t, "user", f"turn {t % 3}") for t in range(700)]  # a long one
    return rows


def test_odd_rows(spark):
    rows = odd_conversations()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({x: F.lit("clash") for x in ("c", "pos", "k1", "g", "n", "at", "part", "length")})
    assert got(df.repartition(13)) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")], [(3, 0, "u", "alone")], [(1, 0, "u", "t")], [(5, 0, None, None), (6, 0, None, None)]])
def test_small_tables(spark, rows):
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_shared_beginnings_end_at_different_turns(spark):
    """Nested conversations, and copies that share a start with others: every class splits at its own depth."""
    rows = [(5 * c, t, "u", f"t{t}") for c in range(30) for t in range(1 + c % 15)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
