"""The prefix trie against a plain one, built node by node."""

import hashlib
import random
import zlib

import llm_data
import numpy as np
import pytest
from pyspark.sql import functions as F

from opsloom.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, depth int, owner string, place long"


def turn_lists(rows):
    """Turns of each conversation in order."""
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            found.setdefault(conv, []).append(((turn is not None, turn or 0), digest, (role, text)))
    return {c: [t[2] for t in sorted(turns)] for c, turns in found.items()}


def with_heads(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        lender = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = convs.get(lender, [])[:h] + own[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), set()).add(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, [])
        leaves[node] = sum(leaves[k] for k in kids) if kids else 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[k] for k in kids)
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(node))
        out.append((
            min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children.get(node, [])),
            leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out)


def rows_of(frame):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert set(names) <= set(frame.columns)
    return sorted(tuple(r) for r in frame.select(*names).collect())


def frame_of(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(partitions)


def trie_of(spark, rows, shard):
    turns = prefix_trie.numbered_turns(frame_of(spark, rows))
    return prefix_trie.prefix_trie(turns, turns.select("conv"), shard=shard)


def random_rows(seed, convs=60, deep=9):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-40, 200), convs):
        for t in range(draw.randint(1, deep)):
            rows.append((c, t, draw.choice(["user", "assistant", None]), draw.choice(["a", "b", "é" * 3, "", None])))
    rows += [(500, t, "user", str(t)) for t in range(70)]                # one long conversation, copied
    rows += [(501, t, "user", str(t)) for t in range(70)] + [(502, t, "user", str(t)) for t in range(66)]
    rows += [(503, None, "user", "n"), (503, None, "user", "n"), (503, 4, None, None), (None, 1, "user", "gone")]
    rows += [(504, 1, "user", "b"), (504, 1, "user", "a"), (504, 1, "system", "a"), (504, 0, "ab", "c"), (505, 0, "a", "bc")]
    return rows


@pytest.mark.parametrize("shard", [1, 3, 17, 1 << 18])
def test_equals_a_plain_trie(spark, shard):
    rows = random_rows(shard)
    assert rows_of(trie_of(spark, rows, shard)) == brute(turn_lists(rows))


@pytest.mark.parametrize("seed", [5, 6])
def test_lent_heads(spark, seed):
    rows = random_rows(seed) + [(601, 0, "user", "gone with its head")]      # 600 is absent
    turns = prefix_trie.numbered_turns(frame_of(spark, rows))
    conv = F.col("conv")
    rebuilt = prefix_trie.with_lent_heads(turns, conv - conv % 5, F.crc32(conv.cast("string").cast("binary")) % 9, 8)
    found = prefix_trie.prefix_trie(rebuilt, turns.select("conv"), shard=5)
    assert rows_of(found) == brute(with_heads(turn_lists(rows)))


def test_one_conversation_holds_most_rows(spark):
    rows = [(7, None, "user", "same")] * 3000 + [(8, None, "user", "same")] * 900 + [(9, 1, "user", "x")]
    assert rows_of(trie_of(spark, rows, 100)) == brute(turn_lists(rows))


def test_empty_table(spark):
    assert trie_of(spark, [], 10).collect() == []
    assert trie_of(spark, [(None, 1, "user", "x")], 10).collect() == []


def test_the_query(spark):
    rows = spark.read.parquet(f"{llm_data.SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text")
    want = brute(with_heads(turn_lists(map(tuple, rows.collect()))))
    assert rows_of(queries.queries()["op13_prefix_trie"](spark, llm_data.SMALL)) == want


def test_findclose_against_a_stack():
    draw = np.random.default_rng(3)
    for size in (1, 2, 63, 64, 65, 500, 3000):
        for lean in (0.4, 0.5, 0.7):
            bits, stack, partner = [], [], {}
            while len(bits) < size:
                if not stack or draw.random() < lean:
                    stack.append(len(bits))
                    bits.append(1)
                else:
                    partner[stack.pop()] = len(bits)
                    bits.append(0)
            bits = np.array(bits, dtype=np.uint8)
            places = np.flatnonzero(bits)
            trie = prefix_trie.Parentheses(bits)
            assert trie.findclose(places).tolist() == [partner.get(p, -1) for p in places.tolist()]
