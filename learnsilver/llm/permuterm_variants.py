"""Spelling variants: words one edit apart, met among the rotations of all words.

A word is closed by a mark (``|``, which no word has) and turned in every way.
With the word cut as ``x c y`` at a code point ``c``, one rotation is ``y|xc``:
all but its end, ``y|x``, is the word without that code point.

* Words that differ in one replaced code point have rotations of one such
  beginning, with other ends.
* A word that lacks the code point has the beginning itself as a rotation.

So all rotations are dealt by their beginnings, each whole rotation also as a
beginning without end, and sorted there. A group is the words of one beginning,
at most one for each code point a word can have; each gets from its group how
many others there are and the most frequent of them, never the pairs. Where a
run of equal code points would bring two words together at several places, only
the place after the run counts.

All is built of SQL functions; groups are windows over the sorted rotations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnsilver.llm.shared import stored, text_of

RUN = "[^a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARK = "|"
#: Of the words and of their forms.
LEAST_LENGTH, LEAST_COUNT, TIMES = 5, 3, 2
#: One run in so many loses a code point (see ``thinned``).
ONE_IN = 97


def thinned(doc_id: Column, run: Column) -> Column:
    """The run, without one code point where ``ONE_IN`` divides the crc32 of ``<doc_id>:<run>``.

    The code point's place is that number modulo the run's length. A null id is empty.
    """
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    code = F.crc32(key.cast("binary"))
    place = (code % F.length(run)).cast("int")
    # place counts from 0, substring from 1
    without = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))
    return F.when(code % ONE_IN == 0, without).otherwise(run)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): how often each word stands in the whole texts of ``docs`` (doc_id, text).

    Words are runs of ASCII letters and U+00C0 to U+00FF, A-Z as a-z, thinned;
    of at least ``LEAST_LENGTH`` code points, ``LEAST_COUNT`` times or more.
    """
    text = F.translate(text_of("text"), UPPER, LOWER)
    runs = docs.select(F.col("doc_id").alias("_doc"), F.explode(F.split(text, RUN)).alias("_run"))
    runs = runs.filter(F.length("_run") >= LEAST_LENGTH)  # thinning makes none longer
    words = runs.select(thinned(F.col("_doc"), F.col("_run")).alias("word"))
    counted = words.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def rotations(words: DataFrame) -> DataFrame:
    """(start, end, word, n): each rotation of ``words`` (word, n) as a beginning and an end.

    Cut before its last code point, unless that is the mark; and uncut, with a
    null end.
    """
    size = F.length("word")
    cut = F.transform(
        F.sequence(F.lit(1), size),
        lambda k: F.struct(
            F.concat(F.substring("word", k + 1, size), F.lit(MARK), F.substring("word", F.lit(1), k - 1)).alias("start"),
            F.substring("word", k, F.lit(1)).alias("end"),
        ),
    )
    whole = F.transform(
        F.sequence(F.lit(0), size),
        lambda k: F.struct(
            F.concat(F.substring("word", k + 1, size), F.lit(MARK), F.substring("word", F.lit(1), k)).alias("start"),
            F.lit(None).cast("string").alias("end"),
        ),
    )
    return words.select(F.inline(F.concat(cut, whole)), "word", "n")


def _ranked() -> Column:
    """Of several, the least is the one of most occurrences, ties by the word."""
    return F.struct((-F.col("n")).alias("minus"), F.col("word").alias("word"))


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best): of each of ``words`` (word, n) that has any, its near words.

    ``n_near`` counts them; ``best`` (minus, word) is the one with the largest n,
    ties by the smaller word in code-point order.
    """
    whole = Window.partitionBy("start")
    sorted_group = whole.orderBy(F.col("end").isNull(), F.desc("n"), "word")
    ended, rank = F.col("end").isNotNull(), _ranked()
    # After a run of equal code points: what follows the cut does not begin with the code point.
    last_of_run = ended & (F.substring("start", 1, 1) != F.col("end"))
    group = rotations(words).select(
        "*",
        last_of_run.alias("last_of_run"),
        F.count(F.lit(1)).over(whole).alias("size"),
        F.row_number().over(sorted_group).alias("place"),
        F.lead(F.when(ended, rank)).over(sorted_group).alias("second"),
        F.min(F.when(ended, rank)).over(whole).alias("first"),
        F.count("end").over(whole).alias("members"),
        F.count(F.when(last_of_run, 1)).over(whole).alias("longer"),
        F.min(F.when(last_of_run, rank)).over(whole).alias("first_longer"),
        F.min(F.when(~ended, rank)).over(whole).alias("shorter"),
    )
    met = group.filter("size > 1")
    replaced = F.struct(
        F.when(ended, F.col("members") - 1).otherwise(0).alias("near"),
        F.when(F.col("place") == 1, F.col("second")).otherwise(F.col("first")).alias("best"),
    )
    lost = F.struct(
        F.when(F.col("last_of_run") & F.col("shorter").isNotNull(), 1).otherwise(0).cast("long").alias("near"),
        F.col("shorter").alias("best"),
    )
    gained = F.struct(F.when(ended, 0).otherwise(F.col("longer")).alias("near"), F.col("first_longer").alias("best"))
    found = met.select("word", F.inline(F.array(replaced, lost, gained))).filter("near > 0")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): of each of ``forms`` (word, form) the end of its chain, by doubled steps.

    A form has twice the occurrences, so chains are shorter than the binary
    digits of the largest count, and the steps are the digits of that.
    """
    known = stored(forms.withColumnRenamed("form", "root"), "roots")
    while True:
        onward = known.select(F.col("word").alias("root"), F.col("root").alias("_on"))
        stepped = known.join(onward, "root", "left").select(
            "word", F.coalesce("_on", "root").alias("root"), F.col("_on").isNotNull().alias("moved")
        )
        stepped = stored(stepped, "roots")
        known = stepped.select("word", "root")
        if not stepped.filter("moved").limit(1).count():
            return known


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs`` (doc_id, text).

    ``form`` is the near word with the largest n (ties: smaller in code-point
    order) if it has at least ``TIMES`` the word's, else null; ``root`` the end
    of the chain of forms, the word itself if it has none. Null and empty texts
    have no words, an empty table gives none, a null id is empty in the key that
    thins. Texts are taken whole, however long; rows that repeat count each
    time. Other columns are not looked at.
    """
    words = stored(vocabulary(docs), "vocabulary")
    near = words.join(neighbours(words), "word", "left")
    form_n = -F.col("best.minus")
    formed = F.when(form_n >= TIMES * F.col("n"), F.struct(F.col("best.word").alias("form"), form_n.alias("form_n")))
    known = near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), formed.alias("_form"))
    known = stored(known.select("word", "n", "n_near", "_form.form", "_form.form_n"), "forms")
    roots = _roots(known.filter("form IS NOT NULL").select("word", "form"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


#: The same by plain means: crc32 from its polynomial (0xEDB88320, a fixed value), near words by patterns.
ORACLE_SQL = """
WITH RECURSIVE bits AS (
    SELECT range AS byte, range AS c, 0 AS k FROM range(256)
    UNION ALL
    SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
),
crc AS (SELECT list(c ORDER BY byte) AS of_byte FROM bits WHERE k = 8),
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents
),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
bytes AS (
    SELECT *, flatten(list_transform(
        string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END
    )) AS octets
    FROM counted
),
hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, octets),
        lambda c, b: xor(c >> 8, of_byte[(xor(c, b) & 255) + 1])
    )) AS h
    FROM bytes, crc
),
thinned AS (
    SELECT n, CASE WHEN h % 97 = 0
        THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
        ELSE run END AS word
    FROM hashed
),
words AS (SELECT word, sum(n)::BIGINT AS n FROM thinned WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words),
patterns AS (SELECT word, n, k, substr(word, 1, k - 1) AS x, substr(word, k + 1) AS y FROM places),
pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n
    FROM patterns a JOIN patterns b ON a.k = b.k AND a.x = b.x AND a.y = b.y AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM patterns a JOIN words b ON b.word = a.x || a.y
    UNION
    SELECT b.word, a.word, a.n FROM patterns a JOIN words b ON b.word = a.x || a.y
),
best AS (
    SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n
    FROM pairs GROUP BY word
),
forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near,
        CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
    FROM words LEFT JOIN best USING (word)
),
chains AS (
    SELECT word, word AS at FROM forms
    UNION ALL
    SELECT chains.word, forms.form FROM chains JOIN forms ON forms.word = chains.at WHERE forms.form IS NOT NULL
),
roots AS (
    SELECT chains.word, chains.at AS root FROM chains JOIN forms ON forms.word = chains.at WHERE forms.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""
