"""Small tables with the awkward cases every operator must stand: nulls, empty and long texts, ties, repeated rows, odd columns."""

import random

from pyspark.sql import functions as F

WORDS = "the of and to in is that for it was on are as with his they at be this from have or by one had not but".split()


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    words = [rnd.choice(WORDS) if rnd.random() < 0.5 else "".join(rnd.choice("abcdeéñßmnrst") for _ in range(rnd.randint(2, 8)))
             for _ in range(n)]
    return "\n".join(" ".join(words[i:i + 12]).capitalize() + "." for i in range(0, n, 12))


def awkward_rows() -> list[tuple]:
    base = prose(1, 120)
    words = base.split(" ")
    near = " ".join(["changed" if i == 40 else w for i, w in enumerate(words)])
    return [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, near, "en", "b"), (4, None, "en", "a"), (5, "", None, None),
        (6, " \n\t ", "de", "a"), (7, "one two", "de", "b"), (8, "One  two", "fr", "b"), (None, base, "en", None),
        (None, "no id at all here", None, "c"), (9, prose(2, 6000), "es", "c"), (10, "x" * 5000, "es", "c"),
        (11, "same same same same same same same same same same same same", "en", "a"),
        (1, base, "en", "a"), (12, "12 34 !!", "en", "b"), (13, prose(3, 60), "fr", None), (14, prose(4, 30), "de", "a"),
        (15, "Mail ann@corp.example.net or call +1 (415) 555-0101 about it today please", "en", "b")]


#: names that operators use themselves
CLASHING = ("n_words", "kept", "rank", "slot", "cls", "th", "component", "_at", "_n", "row_key", "size", "source_key",
            "block", "host", "_text", "digest", "lang_pred", "ids", "draw", "target", "id", "n", "q", "score")


def awkward_docs(spark, clashing: bool = False):
    rows = spark.createDataFrame(awkward_rows(), "doc_id long, text string, lang string, source string")
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    return rows.select("*", *[F.lit("clash").alias(c) for c in CLASHING]) if clashing else rows


def counted(rows, columns=None):
    from collections import Counter

    return Counter(tuple(tuple(v) if isinstance(v, list) else v for v in (r if columns is None else [r[c] for c in columns]))
                   for r in rows)
