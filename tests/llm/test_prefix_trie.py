"""The trie of conversations against a plain one, over one partition and over many."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from millrace.llm import prefix_trie


def plain(conversations):
    """Nodes of the trie of {conv_id: list of (role, text)}, by counting every prefix."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv, said in sorted(conversations.items()):
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(conv)
        ends[tuple(said)].append(conv)
    leaf = {node for node in members} - {node[:-1] for node in members if node}
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        if node:
            children[node[:-1]] += 1
        for d in range(len(node) + 1):
            leaves[node[:d]] += node in leaf
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
    return sorted(((convs[0], len(node), convs and min(members[node[:-1]]) if node else None, len(convs),
                    children[node], leaves[node], saved[node],
                    hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
                   for node, convs in members.items()), key=repr)


def frame(spark, conversations, more=()):
    """Turns in any order, without a number for the first, and columns named like the operator's."""
    rows = [(conv, k if k else None, role, text, b"k", 5, b"n") for conv, said in conversations.items()
            for k, (role, text) in enumerate(said)] + [(*row, None, None, None) for row in more]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key binary, "
                                       "depth int, name binary").orderBy("text")


def trie(spark, conversations, more=()):
    turns = prefix_trie.ordered_turns(frame(spark, conversations, more))
    ids = spark.createDataFrame([(conv, 1) for conv in conversations], "conv_id long, length int")
    out = prefix_trie.prefix_trie(turns, ids)
    assert [f"{n} {'string' if t == 'string' else 'long'}" for n, t in out.dtypes] == prefix_trie.NODE.split(", ")
    return sorted((tuple(row) for row in out.collect()), key=repr)


@pytest.fixture(params=[1, 3, 23])
def partitions(spark, request):
    """So many ranges, none of which is merged."""
    settings = {"spark.sql.shuffle.partitions": str(request.param),
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield request.param
    for name, value in before.items():
        spark.conf.set(name, value)


def test_random_conversations(spark, partitions):
    """Few different turns, so that beginnings are shared at every depth and across ranges."""
    rng = np.random.default_rng(partitions)
    words = [("u", "a"), ("a", "bb"), ("u", ""), ("", "漢字é"), ("s", "x" * 50)]
    convs = {int(c): [words[k] for k in rng.integers(0, 1 + rng.integers(1, 5), rng.integers(0, 6))]
             for c in rng.permutation(np.arange(-20, 180))}
    assert trie(spark, convs) == plain(convs)


def test_hot_beginnings_copies_and_depth(spark, partitions):
    """A third of all are equal, a third begin with the same long text, one is very long."""
    deep = [("u", f"t{k}") for k in range(120)]
    convs = {c: [("u", "hello"), ("a", "hi")] for c in range(60)}
    convs |= {100 + c: deep[:115] + [("a", str(c % 7))] for c in range(60)}
    convs |= {200 + c: deep[:c] for c in range(40)} | {300: deep * 5, 301: [("u", "x" * 100_000)], 302: []}
    assert trie(spark, convs) == plain(convs)


def test_nulls_ties_and_empty_tables(spark):
    convs = {1: [("u", "a"), ("", "")], 2: [("u", "a")], 3: []}
    more = [(2, 1, None, None), (None, 0, "u", "a"), (None, None, None, None)]
    convs_read = {**convs, 2: [("u", "a"), ("", "")]}
    assert trie(spark, convs, more) == plain(convs_read)
    tied = [(c, 5, role, text) for c in (7, 8) for role, text in
            ([("u", "p"), ("u", "q"), ("a", "p")] if c == 7 else [("a", "p"), ("u", "q"), ("u", "p")])]
    assert len(trie(spark, {7: [], 8: []}, tied)) == 4  # equal in whatever order they come
    assert trie(spark, {}) == []


def test_order_of_turns(spark):
    rows = [(1, 2, "u", "c", None, None, None), (1, None, "u", "a", None, None, None), (1, -1, "u", "b", None, None, None)]
    turns = spark.createDataFrame(rows, frame(spark, {}).schema)
    lengths = prefix_trie.ordered_turns(turns).orderBy("nth").collect()
    assert [bytes(r["digest"]) for r in lengths] == [hashlib.md5(b"1:u" + t).digest() for t in (b"a", b"b", b"c")]
