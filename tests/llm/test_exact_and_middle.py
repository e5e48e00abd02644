"""Block names and fill-in-the-middle against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from staffmart.llm import block_names, fill_middle

SCHEMA = "doc_id long, text string, row long, form string, kept string"


@pytest.fixture(scope="module")
def rows():
    """Copies with other blanks, texts that share blocks, nulls, sentinels, repeated rows and ids, very long texts."""
    rng = random.Random(2)
    letters = "abc défg\t\n"
    long = "".join(rng.choices(letters, k=60_000))
    texts = ["one two", "onetwo", " one\ttwo\n", "one  two ", "", None, " \t\n", "\x0b\x0c\r", "x" * 64, "x" * 65,
             "x" * 128, "x" * 129, ("x" * 64) + " " + "x" * 64, "a" * 96 + "b" * 96, "b" * 96 + "a" * 96, long,
             long + " ", long[:-1] + "Z", "Z" + long[1:], long[:30_000] + "é" + long[30_000:], "😀 smile 😀", "😀smile😀",
             "has <P> inside", "has <M> inside <S>", "almost <P <S", " one two",
             *("".join(rng.choices(letters, k=rng.randint(1, 300))) for _ in range(60))]
    out = [(i, t, i % 3, "f", None) for i, t in enumerate(texts)]
    copies = [(1000 + i, "copied " * 30 + " " * (i % 5), 0, "f", "k") for i in range(200)]
    return [*out, *copies, out[0], out[0], (None, "one two", None, None, None), (None, None, None, None, None),
            (3, "another text under a used id", 1, "f", "")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


def plain(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected_groups(rows) -> list[tuple]:
    found = defaultdict(list)
    for r in rows:
        found[plain(r[1])].append((-len(r[1] or ""), r[0] is None, r[0] or 0, r))
    out = []
    for text, members in found.items():
        members.sort(key=lambda m: m[:3])
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(m[3][0], members[0][3][0], len(members), i == 0, digest) for i, m in enumerate(members)]
    return sorted(out, key=str)


def colliding(block, seed):
    """Addresses that meet, until the third seed."""
    wide = block_names.two_hashes(block, seed)
    if seed >= 2:
        return wide
    return F.struct(F.pmod(wide["a"], F.lit(3)).alias("a"), F.lit(seed).cast("long").alias("b"))


@pytest.mark.parametrize("options", [{}, {"size": 64}, {"size": 1000}, {"size": 64, "address": colliding}],
                         ids=["default", "short", "long", "collisions"])
def test_exact_groups(docs, rows, options):
    found = block_names.groups(docs, **options).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted((tuple(r) for r in found), key=str) == expected_groups(rows)


def test_identity_is_one_per_text(docs, rows):
    found = block_names.identities(docs, size=64).select("level", "name", "text_sha256").distinct().collect()
    assert len(found) == len({plain(r[1]) for r in rows})
    assert len({(r["level"], r["name"]) for r in found}) == len(found)
    # a text of 129 bytes has three blocks, thus two levels of pairs
    by_text = {r["text_sha256"]: r["level"] for r in found}
    assert [by_text[hashlib.sha256(b"x" * n).hexdigest()] for n in (64, 65, 128, 129)] == [0, 1, 1, 2]


def test_names_follow_the_sort(spark):
    names = block_names.numbered_in_order(spark.createDataFrame([(b,) for b in "dbac"], "block string").coalesce(1),
                                          ["block"], "name")
    assert [tuple(r) for r in names.collect()] == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]


def test_distinct_documents_keep_columns(docs, rows):
    kept = block_names.distinct_documents(docs)
    assert kept.columns == docs.columns
    expected = [(r[0], r[4]) for r in expected_groups(rows) if r[3]]
    assert sorted(((r["doc_id"], hashlib.sha256(plain(r["text"]).encode()).hexdigest()) for r in kept.collect()),
                  key=str) == sorted(expected, key=str)


def test_plan_has_no_python(docs):
    plan = block_names.identities(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ------------------------------------------------------------ fill in the middle


def expected_middle(doc_id, text) -> tuple:
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    hexed = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[i:i + 8], 16) for i in (0, 8, 16, 24))

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


def test_fill_middle(docs, rows):
    found = fill_middle.op13_fill_middle(docs)
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    expected = [expected_middle(r[0], r[1]) for r in rows]
    assert {e[2] for e in expected} == {"plain", "psm", "spm"}
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(expected, key=str)


def test_arranged_and_restored(docs, rows):
    out = fill_middle.arranged(docs)
    assert out.columns == [*docs.columns, "_form"]  # ``form`` is taken
    texts = {(r["doc_id"], r["_form"], r["text"]) for r in out.collect()}
    assert any(f == "psm" and t.startswith("<P>") for _, f, t in texts)
    back = fill_middle.restored(out, "_form")
    assert back.columns == docs.columns
    assert sorted(map(str, map(tuple, back.collect()))) == sorted(map(str, (tuple(r) for r in rows)))


def test_cutting_descriptors():
    whole = [fill_middle.Piece(0, 10, 20)]
    cut = fill_middle.cut(fill_middle.cut(whole, 15), 5)
    assert cut == [fill_middle.Piece(0, 10, 5), fill_middle.Piece(0, 15, 10), fill_middle.Piece(0, 25, 5)]
    assert [p.length for p in fill_middle.cut(whole, 0)] == [0, 20]
    assert [p.length for p in fill_middle.cut(whole, 20)] == [20, 0]
    with pytest.raises(IndexError):
        fill_middle.cut(whole, 21)


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_sentinels_beside_their_parts(form):
    """Pieces that begin or end like a sentinel don't mislead ``restore``."""
    text = b"a<P<S>"[:-1] + b">M<"
    for a in range(len(text) + 1):
        for b in range(a, len(text) + 1):
            parts = [text[:a], text[a:b], text[b:]]
            if any(s in p for s in fill_middle.SENTINELS.values() for p in (*parts, text)):
                continue
            pieces = fill_middle.cut(fill_middle.cut([fill_middle.Piece(0, 0, len(text))], b), a)
            output = b"".join(fill_middle.read(fill_middle.arrange(pieces, form), text))
            assert b"".join(fill_middle.read(fill_middle.restore(output, form), output)) == text


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert block_names.op12_exact_dedup(empty).count() == block_names.distinct_documents(empty).count() == 0
    assert fill_middle.op13_fill_middle(empty).count() == fill_middle.arranged(empty).count() == 0
