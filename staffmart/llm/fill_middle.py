"""Fill-in-the-middle examples from a piece table (operator 13).

The buffers are immutable: the UTF-8 bytes of a text, and the sentinels. A
document is a list of descriptors (buffer, start, length). Cutting splits a
descriptor in two, an arrangement puts sentinel descriptors between the three
pieces and permutes them, the inverse permutation brings them back, and a hash
reads the descriptors one by one: no text is copied until ``arranged`` writes
it out. Cuts lie between tokens (runs of letters A-Z, or single other code
points), so no word and no code point is split.

Every row is worked on alone, in slices of a few MB of text: no shuffle, and a
lost task is simply run again with the same result, for the draws come from a
hash of ``seed`` and the doc_id.

Defined results: a null or empty text has no tokens and stays plain (a null
stays null in ``arranged``); so does a text that holds a sentinel; a very long
text is cut like any other and has to fit one task; rows of equal doc_id have
equal draws, repeated rows equal results; a null doc_id counts as an empty
number; an empty table gives an empty result; extra columns of any name are
kept by ``arranged`` and ``restored`` and ignored by the query.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from staffmart.llm.common import fresh, slices

SEED = "1"
PLAIN_FROM = 90  # of 100: the draws from which a text stays plain
SPM_BELOW = 20  # of 100: the draws below which the suffix comes first

# Fixed values of the contract: the sentinels, and where they stand.
SENTINELS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
# form -> the sentinels in order, each followed by its piece
# (0 prefix, 1 middle, 2 suffix)
ARRANGEMENTS = {"psm": (("P", 0), ("S", 2), ("M", 1)),
                "spm": (("S", 2), ("P", 0), ("M", 1))}
PLAIN = "plain"

TEXT, MARKS = 0, 1
_MARKS = b"".join(SENTINELS.values())
_MARK_AT = {name: _MARKS.index(mark) for name, mark in SENTINELS.items()}


@dataclass(frozen=True)
class Piece:
    buffer: int
    start: int
    length: int


def token_starts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(offset of every token's first byte, offset of every code point's first byte)."""
    data = np.frombuffer(text, np.uint8)
    letter = ((data | 0x20) - np.uint8(ord("a"))) < 26
    first = (data & 0xC0) != 0x80
    starts = first.copy()
    starts[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(starts), np.flatnonzero(first)


def cut(pieces: Sequence[Piece], offset: int) -> list[Piece]:
    """Split the descriptor that ``offset`` (bytes from the document's start) falls into.

    A cut at an end of a descriptor leaves an empty one there, so that every
    cut adds one descriptor.
    """
    out, before = [], 0
    for i, p in enumerate(pieces):
        if before <= offset <= before + p.length:
            head = offset - before
            return [*out, Piece(p.buffer, p.start, head),
                    Piece(p.buffer, p.start + head, p.length - head), *pieces[i + 1:]]
        out.append(p)
        before += p.length
    raise IndexError(f"no byte {offset} in {before} bytes")


def arrange(pieces: Sequence[Piece], form: str) -> list[Piece]:
    """Prefix, middle and suffix in the order of ``form``, behind their sentinels."""
    if form == PLAIN:
        return list(pieces)
    out = []
    for mark, which in ARRANGEMENTS[form]:
        out += [Piece(MARKS, _MARK_AT[mark], len(SENTINELS[mark])), pieces[which]]
    return out


def restore(output: bytes, form: str) -> list[Piece]:
    """Descriptors over ``output`` that give the document again.

    The sentinels are looked for in their order; no piece holds one and none
    overlaps another, so the first found is the one that was put there.
    """
    pieces = [Piece(TEXT, 0, len(output))]
    if form == PLAIN:
        return pieces
    order = ARRANGEMENTS[form]
    at, bounds = 0, []
    for mark, _ in order:
        found = output.index(SENTINELS[mark], at)
        at = found + len(SENTINELS[mark])
        bounds += [found, at]
    for b in bounds:
        pieces = [*pieces[:-1], *cut(pieces[-1:], b - sum(p.length for p in pieces[:-1]))]
    # before each sentinel, the sentinel, ..., and the last piece
    inner = pieces[2::2]
    inverse = {which: inner[i] for i, (_, which) in enumerate(order)}
    return [inverse[which] for which in range(len(order))]


def read(pieces: Iterable[Piece], text: bytes) -> Iterator[memoryview]:
    buffers = {TEXT: memoryview(text), MARKS: memoryview(_MARKS)}
    for p in pieces:
        yield buffers[p.buffer][p.start:p.start + p.length]


def sha256_of(pieces: Iterable[Piece], text: bytes) -> str:
    digest = hashlib.sha256()
    for part in read(pieces, text):
        digest.update(part)
    return digest.hexdigest()


@dataclass(frozen=True)
class Arranged:
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    pieces: list[Piece]


def draws(doc_id: object, seed: str = SEED) -> list[int]:
    """Four numbers below 2^32, from the hash of ``seed:doc_id``."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    hexed = hashlib.sha256(key.encode()).hexdigest()
    return [int(hexed[i:i + 8], 16) for i in range(0, 32, 8)]


def piece_table(doc_id: object, text: bytes, seed: str = SEED, plain_from: int = PLAIN_FROM,
                spm_below: int = SPM_BELOW) -> Arranged:
    """The document's form and its descriptors in that form."""
    whole = [Piece(TEXT, 0, len(text))]
    if not text:
        return Arranged(0, PLAIN, None, None, whole)
    tokens, chars = token_starts(text)
    n = len(tokens)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if h3 % 100 >= plain_from or any(mark in text for mark in SENTINELS.values()):
        return Arranged(n, PLAIN, None, None, whole)
    first, second = (int(tokens[k]) if k < n else len(text)
                     for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    pieces = cut(cut(whole, second), first)
    form = "spm" if h4 % 100 < spm_below else "psm"
    prefix, both = np.searchsorted(chars, [first, second]).tolist()
    return Arranged(n, form, prefix, both - prefix, arrange(pieces, form))


def _field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)


def arranged(docs: DataFrame, form: str = "form", seed: str = SEED, plain_from: int = PLAIN_FROM,
             spm_below: int = SPM_BELOW) -> DataFrame:
    """``docs`` with ``text`` arranged, and a last column that names the form.

    That column is called ``form``, or ``_form`` and so on where a column of
    this name is there; it is the last one in any case.
    """
    schema = T.StructType([*docs.schema.fields, _field(fresh(docs, form), T.StringType())])

    def rewrite(doc_id: object, text: bytes | None) -> tuple[bytes | None, str]:
        table = piece_table(doc_id, text or b"", seed, plain_from, spm_below)
        return (None if text is None else b"".join(read(table.pieces, text))), table.form

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [rewrite(i, t) for i, t in zip(
                    part.column("doc_id").to_pylist(),
                    part.column("text").cast(pa.binary()).to_pylist(), strict=True)]
                columns = [pa.array([t for t, _ in found], pa.binary()).view(pa.string())
                           if name == "text" else part.column(name) for name in part.schema.names]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([f for _, f in found], pa.string())], names=schema.names)

    return docs.mapInArrow(run, schema)


def restored(docs: DataFrame, form: str = "form") -> DataFrame:
    """The inverse of ``arranged``: ``text`` as it was, without the column ``form``."""
    schema = T.StructType([f for f in docs.schema.fields if f.name != form])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [None if t is None else b"".join(read(restore(t, f or PLAIN), t)) for t, f in zip(
                    part.column("text").cast(pa.binary()).to_pylist(),
                    part.column(form).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.binary()).view(pa.string()) if name == "text" else part.column(name)
                     for name in schema.names], names=schema.names)

    return docs.mapInArrow(run, schema)


# --------------------------------------------------------------- the query

RESULT = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, "
          "output_sha256 string, restored_sha256 string")


def op13_fill_middle(docs: DataFrame) -> DataFrame:
    """Digests of the arranged text and of what is read back from it."""
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]

    def row(doc_id: int | None, text: bytes | None) -> tuple:
        text = text or b""
        table = piece_table(doc_id, text)
        output = b"".join(read(table.pieces, text))
        return (doc_id, table.n, table.form, table.prefix_chars, table.middle_chars,
                sha256_of(table.pieces, text), sha256_of(restore(output, table.form), output))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [row(i, t) for i, t in zip(
                    part.column("doc_id").to_pylist(),
                    part.column("text").cast(pa.binary()).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)],
                    names=names)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)


OP13_SQL = f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT doc_id, t, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1,
         CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3,
         CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM cut),
placed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR h3 % 100 >= {PLAIN_FROM} THEN '{PLAIN}'
              WHEN h4 % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
pieces AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
         array_to_string(u[b + 1:n], '') AS suffix
  FROM placed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CAST(CASE WHEN form <> '{PLAIN}' THEN length(prefix) END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> '{PLAIN}' THEN length(middle) END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN '{PLAIN}' THEN t
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM pieces
"""
