"""Line dedup by content-defined chunks, with built-in functions only.

A text is cut into lines. A rolling hash over two neighbouring line hashes is
taken at every line, and a chunk ends where that hash is smaller than those of
the lines before and after. So a boundary hangs on four neighbouring lines
alone: text put in front moves no boundary behind it, and a passage that
documents share is cut alike in all of them. Two boundaries are never on
neighbouring lines, so a chunk has several lines, unless its text has only one.

Chunks are counted by hash over all documents; the texts under a hash are then
compared byte by byte, by grouping on the text itself. Of a repeated chunk,
the first document that has it keeps it, once; all others lose it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_LINES = 2  # lines of a chunk that may be removed


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def chunks(text: Column) -> Column:
    """The chunks of a text in order: an array of (lines, key, text); null for null."""

    def from_lines(lines: Column) -> Column:
        n = F.size(lines)
        hashes = F.transform(lines, F.md5)

        def rolled(own: Column) -> Column:
            return F.transform(
                own, lambda h, i: F.md5(F.concat(F.get(own, F.greatest(i - 1, F.lit(0))), h))
            )

        def cut(rolling: Column) -> Column:
            least = lambda i: (
                (F.get(rolling, i) < F.get(rolling, i - 1))
                & (F.get(rolling, i) < F.get(rolling, i + 1))
            )
            inner = F.when(n > 3, F.filter(F.sequence(F.lit(1), n - 3), least))
            ends = F.concat(F.coalesce(inner, F.array().cast("array<int>")), F.array(n - 1))
            return _let(ends, lambda ends: F.transform(ends, lambda end, k: chunk(ends, end, k)))

        def chunk(ends: Column, end: Column, k: Column) -> Column:
            start = F.when(k == 0, 0).otherwise(F.get(ends, k - 1) + 1)
            joined = F.array_join(F.slice(lines, start + 1, end - start + 1), "\n")
            return F.struct(
                (end - start + 1).alias("lines"), F.md5(joined).alias("key"), joined.alias("text")
            )

        return _let(hashes, lambda own: _let(rolled(own), cut))

    return F.when(text.isNotNull(), _let(F.split(text, "\n"), from_lines))


def _copies(pieces: DataFrame) -> DataFrame:
    """(key, first_doc) of every chunk that several documents have, all byte for byte the same.

    Were there two texts under one key, nothing under it would be removed.
    """
    texts = pieces.groupBy("key", "text").agg(
        F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("copies")
    )
    alike = texts.groupBy("key").agg(
        F.count(F.lit(1)).alias("texts"),
        F.min("first_doc").alias("first_doc"),
        F.sum("copies").alias("copies"),
    )
    return alike.filter("texts = 1 AND copies > 1").select("key", "first_doc")


def remove_repeated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, any others), repeated chunks of several lines taken out.

    ``text`` is what remains, its lines in order, and may be empty; ``n_lines``
    and ``removed_lines`` are added (replacing columns of these names). The
    document with the smallest id keeps a repeated chunk at its first place.
    Rows with the same doc_id count as one document; rows without an id also,
    and come last. Null texts stay null, with no lines. One-line texts are kept.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "removed_lines")]
    cut = docs.select("doc_id", F.explode(chunks(F.col("text"))).alias("chunk"))
    pieces = cut.filter(F.col("chunk.lines") >= LEAST_LINES).select(
        "doc_id", "chunk.key", "chunk.text"
    )
    spread = _copies(pieces)
    owned = pieces.select("doc_id", "key").join(spread, "key")
    lost = owned.filter(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
    gone = lost.groupBy("doc_id").agg(F.collect_set("key").alias("gone"))
    gone = gone.select(F.col("doc_id").alias("_id"), "gone")

    whole = docs.select(F.struct(*columns).alias("_row"))
    joined = whole.join(gone, F.col("_row.doc_id").eqNullSafe(F.col("_id")), "left")

    def kept(own: Column) -> Column:
        keys = F.transform(own, lambda c: c.key)

        def stays(keys: Column, c: Column, i: Column) -> Column:
            first = F.array_position(keys, c.key).cast("int") - 1
            again = (first < i) & (F.get(own, first).text == c.text)
            elsewhere = F.coalesce(F.array_contains(F.col("gone"), c.key), F.lit(False))
            return (c.lines < LEAST_LINES) | ~(again | elsewhere)

        return _let(keys, lambda keys: F.filter(own, lambda c, i: stays(keys, c, i)))

    lines = lambda some: F.aggregate(
        some, F.lit(0).cast("long"), lambda total, c: total + c.lines
    )
    rest = _let(
        chunks(F.col("_row.text")),
        lambda own: _let(
            kept(own),
            lambda left: F.struct(
                F.array_join(F.transform(left, lambda c: c.text), "\n").alias("text"),
                lines(own).alias("n_lines"),
                (lines(own) - lines(left)).alias("removed_lines"),
            ),
        ),
    )
    empty = F.struct(
        F.lit(None).cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("removed_lines"),
    )
    found = joined.select("_row", F.when(F.col("_row.text").isNull(), empty).otherwise(rest).alias("_left"))
    return found.select(
        *[F.col("_left.text" if c == "text" else f"_row.`{c}`").alias(c) for c in columns],
        "_left.n_lines",
        "_left.removed_lines",
    )


ORACLE_SQL = """
WITH lines AS (
  SELECT doc_id, generate_subscripts(s, 1) AS i, unnest(s) AS line, len(s) AS n
  FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL)
), rolled AS (
  SELECT *, md5(md5(coalesce(lag(line) OVER w, line)) || md5(line)) AS r
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), ended AS (
  SELECT *, i BETWEEN 2 AND n - 2 AND r < lag(r) OVER w AND r < lead(r) OVER w AS at_end
  FROM rolled WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (
  SELECT *, coalesce(sum(CAST(at_end AS INT)) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk
  FROM ended
), chunks AS (
  SELECT doc_id, chunk, count(*) AS lines, string_agg(line, chr(10) ORDER BY i) AS piece
  FROM numbered GROUP BY ALL
), marked AS (
  SELECT *, lines < 2 OR row_number() OVER (PARTITION BY piece ORDER BY doc_id, chunk) = 1 AS kept
  FROM chunks
)
SELECT d.doc_id,
  CASE WHEN d.text IS NOT NULL
       THEN coalesce(string_agg(piece, chr(10) ORDER BY chunk) FILTER (kept), '') END AS text,
  CAST(coalesce(sum(lines), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(sum(lines) FILTER (NOT kept), 0) AS BIGINT) AS removed_lines
FROM documents d LEFT JOIN marked m ON d.doc_id = m.doc_id
GROUP BY d.doc_id, d.text
"""
