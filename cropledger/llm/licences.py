"""Licence scan: whole texts against known licences by the digest of their canonical form.

The canonical form lower-cases, drops copyright lines and lines of "all rights reserved" alone, turns every run of punctuation and white space into one space and
settles equivalent spellings. Its SHA-256 is looked up among the digests of known texts by a hash join. What is looked up
whole is each document, and each of its lines as a text of its own, so that a notice inside a document is found too.

The known texts are a few dozen rows, whatever the corpus (``known`` refuses more than ``MOST_KNOWN``); that side is
broadcast. A document's lines meet again in one row by a sum that is complete inside the task that split it.

Defined results: null and empty texts, and texts of copyright lines and punctuation alone, match nothing. Rows are
documents of their own, repeated or null doc_ids too. A line that occurs twice counts twice. An empty table gives an empty table.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.llm.licence_texts import KNOWN

MOST_KNOWN = 10_000

#: (pattern, replacement with $1 for the first group), applied in this order after lower-casing; the same in Java and RE2,
#: but that Java needs the flag d for lines that end at \n alone.
#: Words that follow "copyright" in the licences themselves, where a line may break before it: such lines stay.
BODY = (
    r"(?m)^([^\p{L}\p{N}\n©(]*copyright)[ \t\x{A0}]+((?:(?:holder|owner|notice|statement|permission|interest|law|licen[cs]e|doctrine|treat(?:y|ie)|"
    r"disclaimer)s?|ownership|resulting|and|or|on|if|are|of|is|in|to|as|the[ \t]+(?:software|library|program))\b|the[ \t\r]*$)", "$1_$2",
)
COPYRIGHT = (
    r"(?m)^[^\p{L}\p{N}\n©(]*(?:copyright[ \t\x{A0}]*(?::|\(c\)|©|[0-9\[<{])|copyright[ \t\x{A0}]+(?:\([0-9]|[^ \t\r\n\x{A0}(])|"
    r"\(c\)[ \t]*[0-9]{4}|©)[^\n]*", "",
)
RESERVED = (r"(?m)^[^\p{L}\p{N}\n]*all[ \t]+rights[ \t]+reserved[^\p{L}\p{N}\n]*$", "")
LINES = [BODY, COPYRIGHT, RESERVED]
#: A text without any of these has no such line.
SIGNS = ("copyright", "(c)", "©", "reserved")
MARKS = (r"[^\p{L}\p{N}]+", " ")
SPELLINGS = [
    (r"(^| )licenc", "$1licens"),
    (r"(^| )sub licens", "$1sublicens"),
    (r"(^| )(organ|author|recogn|util|custom|initial|capital)is(e|ed|es|er|ing|ation|ations)( |$)", "$1$2iz$3$4"),
    (r"(^| )(behavi|colo|favo|labo|hono)ur", "$1$2or"),
    (r"(^| )copyright owner", "$1copyright holder"),
    (r"(^| )per cent( |$)", "$1percent$2"),
    (r"(^| )whilst( |$)", "$1while$2"),
    (r"(^| )acknowledgement", "$1acknowledgment"),
    (r"(^| )https( |$)", "$1http$2"),
]


def canonical(text: Column) -> Column:
    """Canonical form of a text, words one space apart."""
    low = F.lower(F.coalesce(text, F.lit("")))
    out = low
    for pattern, put in LINES:
        out = F.regexp_replace(out, pattern.replace("(?m)", "(?md)"), put)
    out = F.when(functools.reduce(operator.or_, (F.contains(low, F.lit(sign)) for sign in SIGNS)), out).otherwise(low)
    out = F.trim(F.regexp_replace(out, *MARKS))
    for pattern, put in SPELLINGS:
        out = F.regexp_replace(out, pattern, put)
    return out


def canonical_sql(text: str) -> str:
    """The same as SQL with RE2 patterns."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    step = lambda x, pattern, put: f"regexp_replace({x}, {quoted(pattern)}, {quoted(put.replace('$', chr(92)))}, 'g')"
    out = f"lower(coalesce({text}, {quoted('')}))"
    for line in LINES:
        out = step(out, *line)
    out = f"trim({step(out, *MARKS)})"
    for pattern, put in SPELLINGS:
        out = step(out, pattern, put)
    return out


def known(spark: SparkSession, texts: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """licence, digest: one row per distinct canonical form; of licences with the same form the first by name."""
    if len(texts) > MOST_KNOWN:
        raise ValueError(f"{len(texts)} known texts; at most {MOST_KNOWN} are broadcast")
    table = spark.createDataFrame(texts, "licence string, text string").withColumn("form", canonical(F.col("text")))
    return table.where("form != ''").groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", texts: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """One row per document: doc_id, text_digest, licence (of the whole text), notices (of lines, sorted), n_notices."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_key"), F.col(doc_id).cast("long").alias("doc_id"), whole.alias("whole")
    )
    parts = F.concat(F.array("whole"), F.split("whole", "\n"))
    units = rows.select("row_key", "doc_id", F.posexplode(parts).alias("place", "unit"))
    forms = units.select("row_key", "doc_id", "place", F.sha2(canonical(F.col("unit")), 256).alias("digest"))
    found = forms.join(F.broadcast(known(docs.sparkSession, texts)), "digest", "left")
    line = F.when(F.col("place") > 0, F.col("licence"))
    rows = found.groupBy("row_key", "doc_id").agg(
        F.max(F.when(F.col("place") == 0, F.col("digest"))).alias("text_digest"),
        F.max(F.when(F.col("place") == 0, F.col("licence"))).alias("licence"),
        F.array_join(F.array_sort(F.collect_set(line)), ",").alias("notices"),
        F.count(line).alias("n_notices"),
    )
    return rows.drop("row_key")


def scan_sql(texts: list[tuple[str, str]] = KNOWN) -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in texts)
    return f"""
    WITH known AS (
        SELECT sha256(form) AS digest, min(licence) AS licence
        FROM (SELECT licence, {canonical_sql("text")} AS form FROM (VALUES {values}) AS t(licence, text))
        WHERE form != '' GROUP BY 1
    ), units AS (
        SELECT doc_id, 0 AS place, coalesce(text, '') AS unit FROM documents
        UNION ALL
        SELECT doc_id, 1, unnest(string_split(coalesce(text, ''), chr(10))) FROM documents
    ), forms AS (
        SELECT doc_id, place, sha256({canonical_sql("unit")}) AS digest FROM units
    )
    SELECT doc_id, max(digest) FILTER (place = 0) AS text_digest, max(licence) FILTER (place = 0) AS licence,
           coalesce(string_agg(DISTINCT licence, ',' ORDER BY licence) FILTER (place = 1), '') AS notices,
           count(licence) FILTER (place = 1) AS n_notices
    FROM forms LEFT JOIN known USING (digest) GROUP BY doc_id
    """
