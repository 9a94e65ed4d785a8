"""Quality rules for documents and for the hosts they come from, in DataFrame functions only.

A document fails when it is too short or repeats itself. A host is judged by the share of its documents that fail,
shrunk towards the corpus by a beta prior fitted to all hosts: a host of three documents is not condemned for two
failures, one of ten thousand is. The verdicts join back to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.llm.sharding import source_key
from veritab.llm.staging import let, staged

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: a host goes when its shrunk failure rate is above this
MAX_HOST_RATE = 0.5


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _covered(keys: Column) -> Column:
    """Words under the windows whose key occurs twice or more; keys in text order."""
    placed = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))

    def positions(s):
        same = lambda i, j: F.coalesce(F.get(s, i)["k"] == F.get(s, j)["k"], F.lit(False))
        return F.array_sort(F.transform(F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                                                 lambda i: same(i, i - 1) | same(i, i + 1)),
                                        lambda i: F.get(s, i)["i"]))

    def cover(p):
        step = lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))
        return F.aggregate(F.transform(p, step), F.lit(0), lambda a, x: a + x)

    return let(let(placed, positions), cover)


def repeated_words(words: Column) -> Column:
    """Words inside five-word windows that occur twice or more, first occurrences included.

    Windows are hashed first; only a text in which a hash repeats is settled by the windows themselves.
    """
    def windows(w):
        starts = F.sequence(F.lit(0), F.size(w) - WINDOW)
        hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)]))
        exact = F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(w, i + j) for j in range(WINDOW)]))
        return F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(
            let(hashed, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(exact))))

    return let(words, windows)


def document_metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    word_chars = F.length(F.translate(text, SPACES, ""))
    metrics = let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                                     repeated_words(w).cast("long").alias("n_repeat_words")))
    out = docs.withColumns({
        "_m": metrics,
        "word_chars": word_chars.cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")})
    out = out.withColumns({"n_words": F.col("_m.n_words"), "n_repeat_words": F.col("_m.n_repeat_words")}).drop("_m")
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def host_verdicts(judged: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``host``, ``n_docs``, ``n_failed``, ``rate`` (shrunk) and ``host_rejected`` from rows (host, base_failed).

    The prior Beta(mean * s, (1 - mean) * s) has the corpus's failure rate as its mean; its strength s follows from
    the spread of the host rates beyond what chance alone gives (method of moments, between 1 and 10,000
    documents).
    """
    hosts = judged.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"),
                                       F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    whole = hosts.agg(F.sum("n_docs").alias("_n"), F.sum("n_failed").alias("_f"), F.count(F.lit(1)).alias("_h"),
                      F.sum(F.pow(F.col("n_failed"), F.lit(2.0)) / F.col("n_docs")).alias("_q"))
    n, h, q = (F.col(c).cast("double") for c in ("_n", "_h", "_q"))
    mean = F.col("_f") / n
    excess = q - n * mean * mean  # sum of n_i (rate_i - mean)^2; (h - 1) * mean * (1 - mean) by chance alone
    chance = mean * (1 - mean)
    spread = (excess - (h - 1) * chance) / F.greatest(n - h, F.lit(1.0))
    strength = F.when(spread > 0, F.least(F.greatest(chance / spread - 1, F.lit(1.0)), F.lit(1e4))).otherwise(F.lit(1e4))
    prior = whole.select(mean.alias("_mean"), strength.alias("_s"))
    row = prior.first()
    m, s = (row["_mean"] or 0.0, row["_s"] or 1e4) if row else (0.0, 1e4)
    rate = (F.col("n_failed") + F.lit(m * s)) / (F.col("n_docs") + F.lit(s))
    return hosts.withColumn("rate", rate).withColumn("host_rejected", F.col("rate") > max_rate)


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                     max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Per row: ``doc_id``, ``host``, the metrics, ``base_failed``, ``host_rate``, ``host_rejected``, ``kept``.

    A null or empty text has no words and fails; a null host is a host of its own; every row is judged, also equal
    ones and those with a null id; an empty table gives no rows; other columns are ignored.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), source_key(F.col(host_col)).alias("host"),
                       F.col(text_col).alias("text"))
    judged = staged(document_metrics(slim).drop("text"), "rule-metrics")
    verdicts = staged(host_verdicts(judged, max_rate), "rule-hosts")
    out = judged.join(verdicts.select("host", F.col("rate").alias("host_rate"), "host_rejected"), "host")
    return out.withColumn("kept", ~(F.col("base_failed") | F.col("host_rejected")))


def apply_rules(docs: DataFrame, text_col: str = "text", host_col: str = "source",
                max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that the rules keep, same columns."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    slim = docs.select(own, source_key(F.col(host_col)).alias("host"), F.col(text_col).alias("text"))
    judged = staged(document_metrics(slim).select("_row", "host", "base_failed"), "rule-rows")
    verdicts = staged(host_verdicts(judged.select("host", "base_failed"), max_rate), "rule-hosts")
    kept = judged.where(~F.col("base_failed")).join(verdicts.where(~F.col("host_rejected")).select("host"), "host")
    return kept.select("_row.*")
