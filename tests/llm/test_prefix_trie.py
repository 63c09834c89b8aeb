"""The trie against plain Python, with blocks of a few rows so that prefixes cross many of them."""

import hashlib
import math
import random
import re
import zlib

import pytest

from corpuslens.llm.prefix_trie import prefix_trie, rebuilt, sequences
from corpuslens.session import ship_package

SCHEMA = "conv_id long, turn long, role string, text string, TEXT string, first long"


def brute(rows, rebuild=True):
    own = {}
    for conv, turn, role, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own.setdefault(conv, []).append((role or "", text or ""))
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        made[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    kids = {p: [q for q in members if q and q[:-1] == p] for p in members}
    out = {}
    for p, convs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(made[c]) == len(p)))
        out[min(convs), len(p)] = (
            min(members[p[:-1]]) if p else None, len(convs), len(kids[p]), sum(not kids[q] for q in below),
            sum((len(members[q]) - 1) * words(q) for q in below), hashlib.sha256(ends.encode()).hexdigest(),
        )
    return out


def got(trie):
    return {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in trie.nodes.collect()}


def conversations(seed, n):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-40, 4 * n), n):
        # A third of the conversations are the same, and many share beginnings.
        length = 5 if c % 3 == 0 else rng.randrange(1, 7)
        for t in range(length):
            text = f"turn {t} of all" if c % 3 == 0 else rng.choice(["a b", "c", "", None, " x\ty "])
            rows.append((c, t if t else None, "user" if t % 2 else None, text, "other", 1))
    return rows


@pytest.mark.parametrize("width, level", [(1, 2), (3, 2), (7, 3), (1000, 1000)])
def test_blocks(spark, width, level):
    ship_package(spark)
    rows = conversations(width, 70)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    trie = prefix_trie(rebuilt(sequences(table)), width, level)
    expected = brute(rows)
    assert got(trie) == expected
    places = {r.position: r.conv_id for r in trie.order.collect()}
    assert sorted(places) == list(range(len(places)))
    for r in trie.nodes.collect():
        inside = [places[k] for k in range(r["first"], r["last"] + 1)]
        assert len(inside) == r.n_convs and min(inside) == r.conv_id


def test_odd_rows(spark):
    ship_package(spark)
    long = " ".join(["word"] * 5000)
    rows = [(None, 1, "user", "x"), (7, None, None, None), (7, 3, "user", long), (27, 3, "user", long), (27, None, None, None), (9, 1, "", ""), (9, 1, "", "")]
    table = spark.createDataFrame([(*r, "o", 2) for r in rows], SCHEMA)
    assert got(prefix_trie(sequences(table), 2, 2)) == brute(rows, rebuild=False)
    assert prefix_trie(sequences(table.limit(0))).nodes.count() == 0
    only = prefix_trie(rebuilt(sequences(table.where("conv_id = 9"))), 1, 1)
    assert got(only) == brute([r for r in rows if r[0] == 9])


def test_turnless(spark):
    ship_package(spark)
    rows = spark.createDataFrame([(3, None), (1, []), (2, [(1, 1, 4)])], "conv_id long, turns array<struct<h:bigint,g:bigint,words:int>>")
    nodes = {(r.conv_id, r.depth): r for r in prefix_trie(rows, 1, 2).nodes.collect()}
    assert set(nodes) == {(1, 0), (2, 1)}
    assert (nodes[1, 0].n_convs, nodes[1, 0].n_leaves, nodes[1, 0].n_children) == (3, 1, 1)
    assert nodes[1, 0].ends_sha256 == hashlib.sha256(b"1,3").hexdigest()
