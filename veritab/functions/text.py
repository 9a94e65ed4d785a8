"""Tokenisation for TF-IDF: lower-case, word runs of two or more characters, stop words, 1-2-grams.

The token class is written out (``[\\p{L}\\p{N}_]{2,}``) because ``\\w`` is ASCII-only
in Java regex but not in Python; the explicit class means the same thing in
Spark, Python and DuckDB (RE2). Bigrams are formed after stop-word removal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# ---- fixed values: Spark's default English stop-word list (StopWordsRemover, 181 words) ----
STOP_WORDS_EN = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it
its itself they them their theirs themselves what which who whom this that these those am is are was were be been
being have has had having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over under again further
then once here there when where why how all any both each few more most other some such no nor not only own same so
than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't
hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's
ought that's there's what's when's where's who's why's would
""".split())


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


def drop_stop_words(arr: Column, stop_words=STOP_WORDS_EN) -> Column:
    # ``isin`` over many literals is planned as a hash-set lookup (InSet)
    return F.filter(arr, lambda t: ~t.isin(*stop_words)) if stop_words else arr


def bigrams(arr: Column) -> Column:
    """Adjacent pairs joined by a space. ``arr`` should be a column reference (not a computed
    expression) so that it is evaluated once per row."""
    n = F.size(arr)
    pairs = F.zip_with(F.slice(arr, 1, n - 1), F.slice(arr, 2, n - 1), lambda x, y: F.concat(x, F.lit(" "), y))
    return F.when(n >= 2, pairs).otherwise(F.array().cast("array<string>"))


def terms_frame(df, id_col: str, text_col: str, stop_words=STOP_WORDS_EN, ngram_max: int = 2,
                out_col: str = "term"):
    """``(id, term)`` rows: the filtered token array is projected once, then n-grams are built from it."""
    toks = df.select(F.col(id_col), drop_stop_words(tokens(F.coalesce(F.col(text_col), F.lit(""))), stop_words)
                     .alias("_toks"))
    grams = F.concat(F.col("_toks"), bigrams(F.col("_toks"))) if ngram_max >= 2 else F.col("_toks")
    return toks.select(F.col(id_col), F.explode(grams).alias(out_col))


def sql_stop_list() -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS_EN) + "]"
