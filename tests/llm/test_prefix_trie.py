"""The prefix trie against a dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from staffmart.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
SMOKE = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def n_words(text: str) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lists_of(rows) -> dict[int, list[tuple[str, str]]]:
    """Each conversation's turns in the operator's order."""
    out: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            out.setdefault(conv, []).append((turn is not None, turn or 0, digest, (role, text)))
    return {c: [t[-1] for t in sorted(ts)] for c, ts in out.items()}


def rebuilt(lists):
    out = {}
    for c, own in lists.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = lists.get(base, [])[:h] + own[h:]
    return out


def nodes_of(lists) -> list[tuple]:
    members: dict[tuple, list[int]] = {}
    for c in sorted(lists):
        for d in range(len(lists[c]) + 1):
            members.setdefault(tuple(lists[c][:d]), []).append(c)
    out = []
    for p, cs in members.items():
        below = [q for q in members if q[:len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(r[:-1] == q for r in members if r)]
        saved = sum((len(members[q]) - 1) * n_words(q[-1][1]) for q in below if q)
        ends = ",".join(str(c) for c in cs if len(lists[c]) == len(p))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(kids), len(leaves),
                    saved, sha(ends)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    """Shared starts, copies of one conversation, deep ones, nulls, ties, repeated rows, a very long text."""
    rng = random.Random(5)
    out = []
    for c in [*range(60), 99, -3, -40, 10**12]:
        for t in range(rng.randint(1, 6)):
            out.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["hi", "hi there", "what now", "a b c"])))
    for c in range(200, 240):  # one conversation, many times
        out += [(c, t, "user", text) for t, text in enumerate(["same start", "same middle part", "same end"])]
    out += [(c, t, "user", f"turn {min(t, c - 300)}") for c in range(300, 304) for t in range(40)]
    out += [(400, None, "user", "first"), (400, 0, None, "second"), (400, 0, "user", None), (400, 0, "user", None),
            (401, None, None, None), (402, 3, "user", "x " * 200_000), (None, 1, "user", "nobody's"),
            (None, None, None, None), (403, 1, "a", "b:c"), (404, 1, "a:b", "c"), (405, 0, "", "   ")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("ranges", [None, 1, 7, 40])
def test_trie_equals_a_dictionary_of_prefixes(spark, rows, ranges):
    turns = spark.createDataFrame(rows, SCHEMA).repartition(3)
    lists = prefix_trie.rebuilt(prefix_trie.turn_lists(turns))
    found = prefix_trie.trie(prefix_trie.sequences(lists), ranges)
    assert found.columns == COLUMNS
    assert sorted((tuple(r) for r in found.collect()), key=str) == nodes_of(rebuilt(lists_of(rows)))


def test_conversations_without_rebuilding(spark, rows):
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{SCHEMA}, n_convs int, block string")
    found = prefix_trie.trie(prefix_trie.sequences(prefix_trie.turn_lists(turns)), 5)
    assert sorted((tuple(r) for r in found.collect()), key=str) == nodes_of(lists_of(rows))


def test_turnless_conversations_are_members(spark):
    # conversation 20 has h > 0 turns of its own taken out and none to take over
    empty = next(c for c in range(21, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 > 0)
    found = prefix_trie.op11_prefix_trie(spark.createDataFrame([(empty, 0, "user", "gone")], SCHEMA))
    assert [tuple(r) for r in found.collect()] == [(empty, 0, None, 1, 0, 1, 0, sha(str(empty)))]


def test_no_conversations(spark):
    assert prefix_trie.op11_prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    nobody = spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)
    assert prefix_trie.op11_prefix_trie(nobody).count() == 0


def test_extents_equal_a_scan():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 17, 64, 65):
        lcp = rng.integers(0, 4, n)
        table = prefix_trie.sparse_table(lcp)
        row = np.repeat(np.arange(n), 4)
        depth = np.tile(np.arange(4), n)
        left, right = prefix_trie.left_end(table, row, depth), prefix_trie.right_end(table, row, depth)
        for r, d, lo, hi in zip(row, depth, left, right, strict=True):
            a = b = r
            while a > 0 and lcp[a] >= d:
                a -= 1
            while b + 1 < n and lcp[b + 1] >= d:
                b += 1
            assert (a, b) == (lo, hi)
        assert prefix_trie.range_minimum(table, left, right).tolist() == [
            lcp[a:b + 1].min() for a, b in zip(left, right, strict=True)]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SMOKE}/conversations.parquet')")
    turns = spark.read.parquet(f"{SMOKE}/conversations.parquet")
    expected = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({prefix_trie.OP11_SQL})").fetchall()
    assert sorted(map(str, (tuple(r) for r in prefix_trie.op11_prefix_trie(turns).collect()))) == sorted(
        map(str, expected))
