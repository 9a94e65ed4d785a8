"""Canonical digest lookup of whole texts among known licence texts, in DataFrame functions only.

Both sides are put into one canonical form (case, punctuation, copyright lines, white space and spellings that
count as equal are levelled), digested with SHA-256 and joined on the digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.llm.licence_texts import KNOWN_LICENCES
from veritab.llm.staging import let

#: fixed values: (what a word must contain, pattern, replacement) for spellings that count as equal
SPELLINGS = (
    ("licenc", r"\blicenc(e|es|ed|ing|or|ors)\b", "licens$1"),
    ("isation", r"isation(s?)\b", "ization$1"),
    ("favour", r"\bfavour", "favor"),
    ("honour", r"\bhonour", "honor"),
    ("behaviour", r"\bbehaviour", "behavior"),
    ("acknowledgement", r"\backnowledgement", "acknowledgment"),
    ("judgement", r"\bjudgement", "judgment"),
    ("fulfil ", r"\bfulfil ", "fulfill "),
    ("whilst", r"\bwhilst\b", "while"),
    ("sub license", r"\bsub license", "sublicense"),
    ("non commercial", r"\bnon commercial", "noncommercial"),
    ("per cent", r"\bper cent\b", "percent"),
    ("copyright holder", r"\bcopyright holder", "copyright owner"),
)


def _levelled(text: Column, part: str, pattern: str, replacement: str) -> Column:
    return let(text, lambda t: F.when(t.contains(part), F.regexp_replace(t, pattern, replacement)).otherwise(t))


def canonical(text: Column) -> Column:
    """Null stays null; everything else becomes words of letters and digits, one space apart, lower case."""
    notices = r"(?m)^[^\p{L}\p{N}\n©]*(?:copyright\b(?=[^\n]*(?:©|\(c\)|[0-9]{4}|<|\[))|©|\(c\)|all rights reserved)[^\n]*$"
    noticed = lambda t: (t.contains("copyright") | t.contains("©") | t.contains("(c)")
                         | t.contains("all rights reserved"))
    out = let(F.lower(text), lambda t: F.when(noticed(t), F.regexp_replace(t, notices, " ")).otherwise(t))
    out = _levelled(out, "http", r"https?://", " ")
    out = F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))
    for part, pattern, replacement in SPELLINGS:
        out = _levelled(out, part, pattern, replacement)
    return out


def licence_digest(text: Column) -> Column:
    """SHA-256 of the canonical form; null for a null text and for one without letters and digits."""
    return let(canonical(text), lambda form: F.when(F.length(form) > 0, F.sha2(form, 256)))


def known_licences(spark: SparkSession, texts=None) -> DataFrame:
    """``digest`` -> ``licence_id`` for (id, text) pairs; of equal forms the smallest id counts."""
    rows = spark.createDataFrame(list(texts if texts is not None else KNOWN_LICENCES), "licence_id string, text string")
    return rows.select("licence_id", licence_digest(F.col("text")).alias("digest")).where(
        "digest IS NOT NULL").groupBy("digest").agg(F.min("licence_id").alias("licence_id"))


def scan_licences(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``digest`` and the ``licence_id`` of the known text it equals, else null.

    Whole texts are compared, of any length. Null texts and texts without letters and digits have a null digest and
    match nothing; equal rows are looked up each for itself; an empty table gives no rows; other columns are ignored.
    ``known`` has (digest, licence_id); it is broadcast only where Spark's statistics find it small.
    """
    known = known_licences(docs.sparkSession) if known is None else known
    known = known.groupBy("digest").agg(F.min("licence_id").alias("licence_id"))
    rows = docs.select(F.col(id_col).alias("doc_id"), licence_digest(F.col(text_col).cast("string")).alias("digest"))
    return rows.join(known, "digest", "left").select("doc_id", "digest", "licence_id")
