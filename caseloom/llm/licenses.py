"""Licence scan by canonical digests: whole texts, runs of blocks and lines that state a known licence word for word.

Two texts have one canonical form if they differ only in case, punctuation,
white space, lines of copyright and equivalent spellings. Known licences and
candidate texts are compared by the digest of that form, with one hash join.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.license_texts import LICENSES, SPELLINGS
from caseloom.llm.shared import saved, small_side, table, text_key

_COPYRIGHT = r"^[^\p{L}\p{N}]*(copyright\b|\(c\)|©|all rights reserved)"
_GAP = r"[^\p{L}\p{N}]+"
_BLANK = r"\r?\n[ \t]*\r?\n"
#: no spelling rule touches the first letters of a text, so they tell at once what cannot be a licence
_FIRST = 3
#: so many different starts of known texts go into one pattern; with more, every text is looked at closely
_STARTS = 500
#: no spelling rule makes a text longer than by 16/15, or shorter than by half
_LONGER, _SHORTER = 1.07, 0.5


def plain_line(line: Column) -> Column:
    """One line in lower-case words with single spaces between; nothing of a line of copyright."""
    low = F.lower(line)
    return F.when(low.rlike(_COPYRIGHT), F.lit("")).otherwise(F.trim(F.regexp_replace(low, _GAP, " ")))


def plain(text: Column) -> Column:
    lines = F.transform(F.split(text, r"\n", -1), plain_line)
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def _blocks(text: Column) -> Column:
    """The forms of what blank lines part, without those that are empty."""
    return F.filter(F.transform(F.split(text, _BLANK, -1), plain), lambda x: x != "")


def _runs(blocks: str, most: int, likely: str) -> Column:
    """Up to ``most`` blocks in a row as one text, where their start and length are those of a known text in ``likely``."""
    fits = lambda i, n: F.exists(
        likely, lambda w: (w["first"] == F.substring(F.element_at(blocks, i), 1, _FIRST)) & n.between(w["least"], w["most"])
    )
    starts_so = lambda i: F.exists(likely, lambda w: w["first"] == F.substring(F.element_at(blocks, i), 1, _FIRST))
    starts = F.filter(F.sequence(F.lit(1), F.size(blocks)), starts_so)

    def of(i: Column) -> Column:
        here = F.transform(F.slice(blocks, i, most), lambda x: F.length(x))
        none = F.array().cast("array<int>")
        # where the first, second, ... block of the run ends, with a space between each two
        ends = F.aggregate(here, none, lambda a, n: F.concat(a, F.array(F.when(F.size(a) > 0, F.element_at(a, -1) + 1 + n).otherwise(n))))
        lengths = F.filter(F.transform(ends, lambda e, k: F.struct(k.alias("k"), e.alias("e"))), lambda x: fits(i, x["e"]))
        return F.transform(lengths, lambda x: F.array_join(F.slice(blocks, i, x["k"] + 1), " "))

    return F.when(F.size(blocks) > 0, F.flatten(F.transform(starts, of))).otherwise(F.array().cast("array<string>"))


def _start(first: str, second: str = "") -> str:
    """A pattern for the first letters of two words, or of one at the end of its line or that a spelling rule may join to the next."""
    if not second or first in ("sub", "non", "per"):
        return first
    return rf"{first}[\p{{L}}\p{{N}}]*(?:[^\p{{L}}\p{{N}}]+{second}|[^\p{{L}}\p{{N}}]*$)"


def digest(plain_text: Column) -> Column:
    for pattern, to in SPELLINGS:
        plain_text = F.regexp_replace(plain_text, pattern, to)
    return F.md5(plain_text.cast("binary"))


def known_licenses(spark: SparkSession, licenses: dict[str, list[str]] = LICENSES) -> DataFrame:
    rows = [(name, text) for name, texts in licenses.items() for text in texts]
    return spark.createDataFrame(rows, "license string, text string")


def license_hits(docs: DataFrame, known: DataFrame, text: str = "text") -> DataFrame:
    """(text_key, license, whole): each distinct text and each known licence that it or a part of it states.

    Parts are its lines, the blocks that blank lines part, and as many blocks in
    a row as a known text has at most.
    whole: the text is the licence and nothing else. A null or empty text, and
    a known text without words, states nothing.
    """
    forms = known.select("license", plain(F.col("text")).alias("form"), F.size(F.split("text", _BLANK, -1)).alias("n_blocks"))
    forms = saved(forms.where("form <> ''"))
    digests = forms.select("license", digest(F.col("form")).alias("digest"), F.substring("form", 1, _FIRST).alias("first")).distinct()
    digests = saved(digests)
    firsts = saved(digests.select("first").distinct())
    most = forms.select(F.max("n_blocks")).first()[0] or 1
    # whatever states a licence has a line that starts, signs apart, as the licence's first two words do; most texts have none
    two = F.transform(F.slice(F.split("form", " "), 1, 2), lambda x: F.substring(x, 1, _FIRST))
    starts = [r[0] for r in forms.select(two).distinct().limit(_STARTS).collect()]
    start = "|".join(sorted({_start(*words) for words in starts})) if len(starts) < _STARTS else ""
    length = F.length("form")
    window = F.struct(
        F.substring("form", 1, _FIRST).alias("first"),
        F.floor(length * (_SHORTER / _LONGER)).cast("int").alias("least"),
        F.ceil(length * (_LONGER / _SHORTER)).cast("int").alias("most"),
    )
    likely = saved(forms.where("n_blocks > 0").agg(F.collect_set(window).alias("likely")))
    content = F.coalesce(F.col(text), F.lit(""))
    lines = docs.where(F.lower(F.col(text)).rlike(rf"(?m)^[^\p{{L}}\p{{N}}]*(?:{start})") if starts else F.lit(False))
    lines = lines.select(text_key(text).alias("text_key"), content.alias("text")).withColumn(
        "lines", F.filter(F.transform(F.split("text", r"\n", -1), plain_line), lambda x: x != "")
    )
    blocks = F.when(F.col("text").rlike(_BLANK), _blocks(F.col("text"))).otherwise(F.array())
    parts = F.array_distinct(F.concat("lines", _runs("blocks", most, "likely")))
    units = lines.withColumn("blocks", blocks).crossJoin(F.broadcast(likely))
    units = units.select("text_key", F.array_join("lines", " ").alias("form"), parts.alias("parts"))
    units = units.select("text_key", "form", F.explode_outer(F.array_union(F.array("form"), "parts")).alias("unit"))
    close = units.withColumn("first", F.substring("unit", 1, _FIRST)).join(small_side(firsts), "first").drop("first")
    found = close.withColumn("digest", digest(F.col("unit"))).join(small_side(digests.drop("first")), "digest")
    return found.groupBy("text_key", "license").agg(F.max(F.col("unit") == F.col("form")).alias("whole"))


def scan_licenses(docs: DataFrame, known: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_licenses, licenses (their sorted ids) and whole_text."""
    per_text = license_hits(docs, known, text).groupBy("text_key").agg(
        F.array_sort(F.collect_set("license")).alias("licenses"), F.max("whole").alias("whole_text")
    )
    rows = docs.select(F.col(id).alias(id), text_key(text).alias("text_key"))
    return rows.join(small_side(saved(per_text)), "text_key", "left").select(
        id,
        F.when(F.col("licenses").isNull(), 0).otherwise(F.size("licenses")).cast("long").alias("n_licenses"),
        F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
        F.coalesce("whole_text", F.lit(False)).alias("whole_text"),
    )


def op9_licenses(spark, folder: str) -> DataFrame:
    """Every document with the licences it states, joined into one text."""
    docs = table(spark, folder, "documents")
    found = scan_licenses(docs, known_licenses(spark))
    return found.withColumn("licenses", F.array_join("licenses", "|"))


def _sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, texts in LICENSES.items() for text in texts)
    form = "f"
    for pattern, to in SPELLINGS:
        form = f"regexp_replace({form}, {quoted(pattern)}, {quoted(to.replace('$', chr(92)))}, 'g')"
    line = f"""CASE WHEN regexp_matches(lower(x), {quoted(_COPYRIGHT)}) THEN '' ELSE trim(regexp_replace(lower(x), {quoted(_GAP)}, ' ', 'g')) END"""
    plain_sql = f"array_to_string([y FOR y IN [{line} FOR x IN string_split(t, chr(10))] IF y <> ''], ' ')"
    most = max(len(re.split(_BLANK, text)) for texts in LICENSES.values() for text in texts)
    return f"""
WITH known AS (SELECT license, {plain_sql} AS f FROM (VALUES {known}) k(license, t)),
k AS (SELECT DISTINCT license, {form} AS c FROM known),
texts AS (SELECT DISTINCT coalesce(text, '') AS t FROM documents),
parts AS (SELECT t, t AS u, true AS is_whole FROM texts
    UNION ALL SELECT t, unnest(string_split(t, chr(10))), false FROM texts
    UNION ALL SELECT t, unnest([array_to_string(b[i:i + n - 1], chr(10)) FOR i IN range(1, len(b) - n + 2)]), false
      FROM (SELECT t, [x FOR x IN regexp_split_to_array(t, {quoted(_BLANK)}) IF {plain_sql.replace('string_split(t', 'string_split(x').replace('x IN string', 'z IN string').replace('lower(x)', 'lower(z)')} <> ''] AS b FROM texts), range(1, {most} + 1) r(n)),
forms AS (SELECT whole_t, f, bool_or(is_whole) AS is_whole FROM
    (SELECT p.t AS whole_t, is_whole, {plain_sql.replace('string_split(t', 'string_split(p.u')} AS f FROM parts p) GROUP BY ALL),
wholes AS (SELECT whole_t, f AS wf FROM forms WHERE is_whole),
hits AS (SELECT whole_t, k.license, bool_or(f = wf) AS whole FROM (SELECT forms.whole_t, f, wf, {form} AS c FROM forms JOIN wholes USING (whole_t)) x
    JOIN k USING (c) GROUP BY ALL),
per AS (SELECT whole_t, count(DISTINCT license) AS n, array_to_string(list_sort(list(DISTINCT license)), '|') AS l, bool_or(whole) AS w FROM hits GROUP BY ALL)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_licenses, coalesce(l, '') AS licenses, coalesce(w, false) AS whole_text
FROM documents LEFT JOIN per ON coalesce(text, '') = whole_t"""


OP9_SQL = _sql()
