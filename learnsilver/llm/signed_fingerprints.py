"""Fingerprints of documents by the signs of weighted votes (SimHash), and search for near ones.

Every term of a text (a word, or two words in a row) has a hash of 128 bits.
Each bit of it is a vote, for 1 or against, with the weight of the term; the
fingerprint has the bits that more weight is for. Texts of much the same terms
so differ in few bits.

Near fingerprints are found exactly: 128 bits are cut into ``BLOCKS`` blocks.
Two fingerprints that differ in ``radius`` bits agree in at least ``BLOCKS -
radius`` blocks. For every choice of so many blocks there is a table of all
fingerprints with those blocks in front, and what meets there is compared
whole. A pair that meets in several tables counts in the first one.

Texts are dealt to tasks by ranges of their ids, so that a document and the
one after it stand side by side; only the two ends of each range are brought
together afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnsilver.llm.shared import hashed_words, mixed, small_batches, stored, text_of

BITS = 128
RADIUS = 4
#: First bit and width of each block, three to a half of the fingerprint.
BLOCKS = [(half, start, width) for half in (0, 1) for start, width in ((0, 21), (21, 21), (42, 22))]
TERMS_AT_ONCE = 20_000
BYTES_AT_ONCE = 300_000  # of text, or one longer text
BATCH_ROWS, BATCH_BYTES = 500, 4_000_000

#: What a byte of a hash votes: +1 or -1 for each of its bits, the highest first.
_VOTES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64) * 2 - 1
_PLACES = np.arange(BITS // 8, dtype=np.int64) * 256
#: Odd multipliers that make one hash of two words' hashes: fixed random values.
_FIRST, _SECOND = np.random.default_rng(12).integers(1, 2**63, (2, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _prints_of(texts: list[bytes]) -> Iterator[bytes]:
    """The fingerprints of some texts (UTF-8, A-Z as a-z)."""
    starts, words = hashed_words(b"\n".join(texts))
    ends = np.searchsorted(starts, np.cumsum([len(text) + 1 for text in texts])).tolist()
    # Terms as two numbers each; pairs that reach over the end of a text are left out below.
    single = np.stack([words, mixed(words * _FIRST[0] + _SECOND[0])], axis=1)
    pairs = mixed(single[:-1] * _FIRST + single[1:] * _SECOND)
    for start, end in zip([0, *ends], ends):
        yield _votes(np.concatenate([single[start:end], pairs[start : max(start, end - 1)]]))


def _votes(terms: np.ndarray) -> bytes:
    """16 bytes; of no terms, zeros."""
    if not len(terms):
        return bytes(BITS // 8)
    terms = terms[np.argsort(terms[:, 0], kind="stable")]
    starts = np.flatnonzero(np.append(True, terms[1:, 0] != terms[:-1, 0]))
    counts = np.diff(np.append(starts, len(terms)))
    weights = np.frexp(counts.astype(np.float64))[1].astype(np.float64)  # binary digits of the count
    octets = np.ascontiguousarray(terms[starts]).view(np.uint8).reshape(-1, BITS // 8)
    weighed = np.zeros(len(_PLACES) * 256)
    for at in range(0, len(octets), TERMS_AT_ONCE):
        cells = (octets[at : at + TERMS_AT_ONCE] + _PLACES).ravel()
        repeated = np.repeat(weights[at : at + TERMS_AT_ONCE], len(_PLACES))
        weighed += np.bincount(cells, repeated, len(weighed))
    votes = weighed.reshape(len(_PLACES), 1, 256) @ _VOTES
    return np.packbits(votes.ravel() > 0).tobytes()


def fingerprints_of(texts: Iterable[str]) -> Iterator[bytes]:
    """16 bytes for each text; of a text without words, zeros."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        held.append(text.encode("utf-8", "surrogatepass").lower())
        size += len(held[-1]) + 1
        if size > BYTES_AT_ONCE:
            yield from _prints_of(held)
            held, size = [], 0
    if held:
        yield from _prints_of(held)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the first as many code points of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _halves(prints: list[bytes | None]) -> list[pa.Array]:
    """Fingerprints as two columns of longs."""
    both = [(None, None) if p is None else np.frombuffer(p, ">i8").tolist() for p in prints]
    return [pa.array([pair[k] for pair in both], pa.int64()) for k in (0, 1)]


#: A row of ``neighbours``: own fingerprint (f), the edited text's (e), the next document's (g).
PRINTS = "f0 long, f1 long, e0 long, e1 long, g0 long, g1 long"
ROWS = f"doc_id long, n_chars long, edited_sha256 string, {PRINTS}"


def _batch(ids: list, texts: list[str], prints: list[bytes], nexts: list[tuple[str, bytes] | None]) -> list[pa.Array]:
    """The columns of ``ROWS``; what hangs on the next document is null where that is not there."""
    changed = [None if n is None else edited(text, n[0]) for text, n in zip(texts, nexts)]
    made = fingerprints_of(c for c in changed if c is not None)
    shas = [None if c is None else hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed]
    return [
        pa.array(ids, pa.int64()), pa.array(list(map(len, texts)), pa.int64()), pa.array(shas, pa.string()),
        *_halves(prints), *_halves([None if c is None else next(made) for c in changed]),
        *_halves([None if n is None else n[1] for n in nexts]),
    ]


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``ROWS`` of a sorted range (doc_id, text); its first and last text go along."""
    part = TaskContext.get().partitionId()
    names = [c.split()[0] for c in ROWS.split(", ")] + ["part", "first", "text"]
    pending, first = None, True

    def out(rows: list, following: list, ends: bool) -> pa.RecordBatch:
        nonlocal first
        ids, texts, prints = map(list, zip(*rows))
        columns = _batch(ids, texts, prints, following)
        marks = [first and k == 0 for k in range(len(rows))]
        kept = [t if mark or (ends and k == len(rows) - 1) else None for k, (t, mark) in enumerate(zip(texts, marks))]
        first = False
        columns += [pa.array([part] * len(rows), pa.int32()), pa.array(marks), pa.array(kept, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        texts = batch.column(1).to_pylist()
        rows = list(zip(batch.column(0).to_pylist(), texts, fingerprints_of(texts)))
        rows = rows if pending is None else [pending, *rows]
        if len(rows) > 1:
            yield out(rows[:-1], [row[1:] for row in rows[1:]], False)
        pending = rows[-1] if rows else pending
    if pending is not None:
        yield out([pending], [None], True)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``ROWS`` of what stands at an end (doc_id, text, f0, f1, next's text, g0, g1)."""
    names = [c.split()[0] for c in ROWS.split(", ")]
    for batch in batches:
        ids, texts, f0, f1, nexts, g0, g1 = (column.to_pylist() for column in batch.columns)
        own, following = (
            [np.array(pair, ">i8").tobytes() for pair in zip(*halves)] for halves in ((f0, f1), (g0, g1))
        )
        yield pa.RecordBatch.from_arrays(_batch(ids, texts, own, list(zip(nexts, following))), names)


def neighbours(docs: DataFrame) -> DataFrame:
    """``ROWS`` of every row of ``docs`` (doc_id, text), in falling order of ids, the first after the last.

    Rows without id come last; rows of one id are in an order of their texts
    that is the same in every run. A null text is empty; an empty text, and one
    of white space, has the fingerprint of zeros. A table of one row has itself
    as the next document; an empty table gives none. Texts are taken whole,
    however long. Other columns are not looked at.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    falling = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    dealt = texts.repartitionByRange(*falling).sortWithinPartitions(*falling, "text")
    with small_batches(spark, BATCH_ROWS, BATCH_BYTES):
        rows = stored(dealt.mapInArrow(_along, f"{ROWS}, part int, first boolean, text string"), "fingerprints")
    ends = rows.filter("text IS NOT NULL")
    firsts = ends.filter("first").select("part", F.col("text").alias("next"), F.col("f0").alias("h0"), F.col("f1").alias("h1"))
    # One number for each range.
    ordered = Window.orderBy("part")
    following = firsts.select(
        F.col("part").alias("before"),
        F.coalesce(F.lead("part").over(ordered), F.first("part").over(ordered)).alias("part"),
    )
    lasts = ends.filter("edited_sha256 IS NULL").withColumnRenamed("part", "before")
    met = lasts.join(following, "before").join(firsts, "part")
    closed = met.select("doc_id", "text", "f0", "f1", "next", "h0", "h1").mapInArrow(_across, ROWS)
    names = [c.split()[0] for c in ROWS.split(", ")]
    return rows.filter("edited_sha256 IS NOT NULL").select(names).union(closed)


def likeness(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """The share of bits that two fingerprints have in common."""
    return 1 - distance(a, b) / F.lit(float(BITS))


def distance(a: tuple[str, str], b: tuple[str, str]) -> Column:
    return reduce(Column.__add__, [F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(a, b)])


def _block(halves: tuple[Column, Column], block: int) -> Column:
    half, start, width = BLOCKS[block]
    return F.shiftrightunsigned(halves[half], start).bitwiseAND(F.lit(2**width - 1))


def tables(prints: DataFrame, radius: int) -> DataFrame:
    """``prints`` (f0, f1, ..) once for each table, with the blocks in front as ``front``."""
    if not 0 <= radius < len(BLOCKS):
        raise ValueError(f"a radius from 0 to {len(BLOCKS) - 1}, not {radius}")
    own = (F.col("f0"), F.col("f1"))
    choices = combinations(range(len(BLOCKS)), len(BLOCKS) - radius)
    rows = [
        F.struct(F.lit(k).alias("table"), F.xxhash64(*[_block(own, b) for b in chosen]).alias("front"))
        for k, chosen in enumerate(choices)
    ]
    return prints.select("*", F.inline(F.array(*rows)))


def within(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(f0, f1, q0, q1, ..): all pairs of ``queries`` and ``prints`` (f0, f1, ..) up to ``radius`` bits apart.

    Both are tables of distinct fingerprints; other columns of ``prints`` go
    along. No pair is lost and none comes twice.
    """
    asked = tables(queries.select("f0", "f1"), radius).withColumnsRenamed({"f0": "q0", "f1": "q1"})
    met = tables(prints, radius).join(asked, ["table", "front"])
    apart = tuple(F.col(f"f{k}").bitwiseXOR(F.col(f"q{k}")) for k in (0, 1))
    firsts = []
    for k, chosen in enumerate(combinations(range(len(BLOCKS)), len(BLOCKS) - radius)):
        # The first table of a pair: the chosen blocks agree, and none before the last of them besides.
        earlier = [_block(apart, b) != 0 for b in range(chosen[-1]) if b not in chosen]
        same = [_block(apart, b) == 0 for b in chosen]
        firsts.append((F.col("table") == k) & reduce(Column.__and__, earlier + same))
    near = distance(("f0", "f1"), ("q0", "q1")) <= radius
    return met.filter(near & reduce(Column.__or__, firsts)).drop("table", "front")


def fingerprints(docs: DataFrame, asks: Column, radius: int = RADIUS) -> DataFrame:
    """Of every row of ``docs`` (doc_id, text) what the query returns, and ``n_near``.

    ``n_near`` is null but for rows where ``asks`` (over doc_id) holds; there it
    is the number of other rows whose fingerprints are within ``radius`` bits.
    Equal fingerprints are searched for once, with how many rows have them.
    """
    rows = stored(neighbours(docs), "neighbours")
    counted = rows.groupBy("f0", "f1").agg(F.count(F.lit(1)).alias("rows"))
    wanted = F.coalesce(asks, F.lit(False))
    asked = rows.filter(wanted).select("f0", "f1").distinct()
    near = within(asked, counted, radius).groupBy("q0", "q1").agg((F.sum("rows") - 1).alias("n_near"))
    near = near.withColumnsRenamed({"q0": "f0", "q1": "f1"})
    answered = rows.filter(wanted).join(near, ["f0", "f1"], "left").select(*rows.columns, "n_near")
    others = rows.filter(~wanted).withColumn("n_near", F.lit(None).cast("long"))
    return answered.union(others).select(
        "doc_id", "n_chars", "edited_sha256",
        _hex("f").alias("fingerprint"), _hex("e").alias("edited_fingerprint"),
        likeness(("f0", "f1"), ("e0", "e1")).alias("near_edited"),
        likeness(("f0", "f1"), ("g0", "g1")).alias("near_next"),
        "n_near",
    )


def _hex(name: str) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(f"{name}{k}"), 16, "0") for k in (0, 1)]))
