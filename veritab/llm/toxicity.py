"""Toxicity by a weighted lexicon that is matched by one Aho-Corasick automaton over folded text.

Folding takes lookalike letters of other scripts, marks, full-width forms and digits or signs that stand for letters
to one spelling, so that ``1d10t`` and ``idіot`` meet ``idiot``; ``l`` and ``i``, which a 1 may stand for, are one
letter. The lexicon is learned: entries are whole words or beginnings of words, their weight is the log-odds of
toxic against clean documents. Entries must be sure and must stand in varied surroundings, so that the text of many
copies does not become lexicon. Phrases of an entry and a neighbour that clean documents use are exceptions: a match
inside one does not count. The summed weight, normalised by length, is turned into a probability.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.llm.staging import staged

# ---- fixed values: letters that look like Latin ones, digits and signs that stand for letters
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o",
    "р": "p", "ԛ": "q", "ѕ": "s", "с": "c", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "ԁ": "d",
    "α": "a", "β": "b", "ε": "e", "γ": "y", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ʏ": "y", "ɴ": "n", "ʀ": "r", "ß": "b", "ø": "o",
    "đ": "d", "ħ": "h", "ł": "l",
}
STANDS_FOR = str.maketrans({"0": "o", "1": "i", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
                            "9": "g", "@": "a", "$": "s", "!": "i", "|": "i"})

#: lengths of word beginnings that may become entries
STEMS = range(3, 13)
#: an entry's log-odds, those over their standard error, and its share of different surroundings, at least
LEAST_WEIGHT, LEAST_SURENESS, LEAST_VARIED = 2.5, 3.5, 0.25
#: the log-odds of what may become an entry once its exceptions are known
LEAST_CANDIDATE_WEIGHT = 1.0
#: a beginning is replaced by a longer one that has so much of its uses; words of so few letters are matched whole
NEARLY_ALL, WHOLE_LETTERS = 0.9, 4
#: uses of an entry in toxic documents, and different surroundings among them, at least
LEAST_CONTEXTS = 4
#: clean documents that use an exception phrase, at least, and its log-odds at most
LEAST_CLEAN_USES, EXCEPTION_ODDS = 3, -1.0
#: labelled documents the lexicon is learned from, and entries and exceptions it has, at most
MOST_LABELLED, MOST_ENTRIES = 100_000, 20_000
THRESHOLD = 0.7
#: distinct patterns counted before they are handed on
HELD = 400_000

MAY_STAND_FOR = "0123456789@$!|"
_STANDING = re.compile(r"[0-9@$!|]")
_SIGNS = re.compile(r"[@$](?=[^\W_])|(?<=[^\W_])[!|](?=[^\W_])")
_DIGITS = re.compile(r"(?<=[^\W\d_])[0-9]+|[0-9]+(?=[^\W\d_])")
_WORDS = re.compile(r"[^0-9@$!| ]+")


class _Letters(dict):
    """Code point -> folded letters, digits and signs that may stand for letters, else a space; filled as they are met."""

    def __missing__(self, point: int) -> str:
        plain = [c for c in unicodedata.normalize("NFKD", chr(point)) if unicodedata.category(c) not in ("Mn", "Me", "Cf")]
        folded = "".join(LOOKALIKES.get(c, c) for c in "".join(plain).lower()).replace("l", "i")
        folded = "".join(c if c.isalpha() or c in MAY_STAND_FOR else " " for c in folded)
        self[point] = folded
        return folded


_LETTERS = _Letters()


def fold(text: str) -> list[str]:
    """The words of a text in one spelling; white space, numbers and signs between words go."""
    text = text.lower().translate(_LETTERS)
    if not _STANDING.search(text):
        return text.split()
    text = _SIGNS.sub(lambda m: m.group().translate(STANDS_FOR), text)
    return _WORDS.findall(_DIGITS.sub(lambda m: m.group().translate(STANDS_FOR), text))


@dataclass
class Lexicon:
    """``entries``: `` word `` or `` stem`` (folded, after a space) -> weight; ``exceptions``: `` two words ``."""

    entries: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    intercept: float = 0.0
    slope: float = 1.0


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.automaton = lexicon, ahocorasick.Automaton()
        for entry in lexicon.entries:
            self.automaton.add_word(entry, (entry, False))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(phrase, (phrase, True))
        if len(self.automaton):
            self.automaton.make_automaton()

    def matches(self, words: list[str]) -> list[tuple[int, str]]:
        """(place in the joined words, entry): the longest entry that each word begins with, outside of exceptions."""
        if not len(self.automaton):
            return []
        longest, spared = {}, []
        for end, (found, exception) in self.automaton.iter(f" {' '.join(words)} "):
            start = end - len(found) + 1
            if exception:
                spared.append((start, end))
            elif len(found) > len(longest.get(start, "")):
                longest[start] = found
        return [(at, e) for at, e in longest.items() if not any(a <= at < b for a, b in spared)]

    def load(self, words: list[str], matches: list[tuple[int, str]]) -> float:
        """The weights of the entries matched, repeats at their logarithm, over the logarithm of the length."""
        times = Counter(e for _, e in matches)
        return sum(self.lexicon.entries[e] * (1.0 + math.log(n)) for e, n in times.items()) / (1.0 + math.log1p(len(words)))

    def score(self, load: float) -> float:
        odds = self.lexicon.intercept + self.lexicon.slope * load
        return 1.0 / (1.0 + math.exp(-odds)) if odds > -700 else 0.0


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from; a null id is not one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """(text, toxic) of training documents: those of ``most`` ids at most, drawn by the digest of the id.

    Of an id with several labels the majority counts, a tie as toxic; null ids and labels are left out.
    """
    told = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).where(~held_out(F.col("doc_id")))
    told = told.groupBy("doc_id").agg((F.avg(F.col("toxic").cast("double")) >= 0.5).alias("toxic"))
    chosen = told.orderBy(F.md5(F.col("doc_id").cast("string"))).limit(most).select(F.col("doc_id").alias("_label_id"), "toxic")
    chosen = staged(chosen, "toxicity-labels")
    slim = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return slim.join(F.broadcast(chosen), F.col("_id") == F.col("_label_id")).select("text", "toxic")


def _counted(train: DataFrame, keys_of, width: int) -> DataFrame:
    """(k0, k1, ..., n_toxic, n_clean): documents that have each key; ``keys_of(text)`` gives tuples of strings."""
    names = [f"k{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())

        def handed():
            keys = list(dict.fromkeys([*counts[0], *counts[1]]))
            columns = [pa.array([k[i] for k in keys], pa.string()) for i in range(width)]
            numbers = [pa.array([counts[y][k] for k in keys], pa.int64()) for y in (1, 0)]
            for c in counts:
                c.clear()
            return pa.record_batch([*columns, *numbers], [*names, "n_toxic", "n_clean"])

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                counts[toxic.as_py()].update(keys_of(text.as_py()))
                if len(counts[0]) + len(counts[1]) > HELD:
                    yield handed()
        yield handed()

    rows = train.mapInArrow(run, ", ".join(f"{n} string" for n in names) + ", n_toxic long, n_clean long")
    return rows.groupBy(*names).agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))


def _words(text: str) -> set[tuple[str]]:
    return {(w,) for w in set(fold(text)) if len(w) >= STEMS.start}


def _patterns(words: DataFrame) -> DataFrame:
    """(k0, n_toxic, n_clean): uses of whole words and of their beginnings, from the documents that have each word."""
    stems = F.transform(F.sequence(F.lit(STEMS.start), F.least(F.length("k0"), F.lit(STEMS.stop - 1))),
                        lambda n: F.concat(F.lit(" "), F.substring(F.col("k0"), F.lit(1), n)))
    whole = F.array(F.concat(F.lit(" "), F.col("k0"), F.lit(" ")))
    each = words.select(F.explode(F.concat(stems, whole)).alias("k0"), "n_toxic", "n_clean")
    return each.groupBy("k0").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))


def _odds(toxic: Column, clean: Column, n_toxic: int, n_clean: int) -> tuple[Column, Column]:
    """Smoothed log-odds of a key, and their standard error."""
    weight = F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n_clean + 1))
    return weight, F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


def _entries(found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Of patterns (weight, uses in toxic documents) that extend each other those that say the most.

    A beginning goes if a longer one has nearly as many toxic uses (a whole word has to be in more than
    its own letters as a beginning, unless it is short), and a longer one goes if a beginning left is about as strong.
    """
    closed = {}
    for pattern, (weight, n) in found.items():
        longer = [q for q in found if q != pattern and q.startswith(pattern)]
        whole = f"{pattern} "
        if len(whole) > WHOLE_LETTERS + 2:
            longer = [q for q in longer if q != whole]
        if not any(found[q][1] >= NEARLY_ALL * n for q in longer):
            closed[pattern] = weight
    kept: dict[str, float] = {}
    for pattern in sorted(closed, key=lambda p: (len(p), p)):
        shorter = [kept[pattern[:n]] for n in range(1, len(pattern)) if pattern[:n] in kept]
        if not shorter or closed[pattern] > max(shorter) + 1.0:
            kept[pattern] = closed[pattern]
    return kept


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        most: int = MOST_LABELLED) -> Lexicon:
    """A lexicon from ``labels`` (doc_id, toxic) of documents that are not held out.

    Without toxic or without clean training documents the lexicon is empty and every score the share of toxic ones.
    """
    train = labelled(docs, labels, id_col, text_col, most)
    counts = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = counts.get(True, 0), counts.get(False, 0)
    base = math.log((n_toxic + 0.5) / (n_clean + 0.5))
    if not n_toxic or not n_clean:
        return Lexicon(intercept=base, slope=0.0)
    weight, error = _odds(F.col("n_toxic"), F.col("n_clean"), n_toxic, n_clean)
    likely = _patterns(_counted(train, _words, 1)).where(F.col("n_toxic") >= LEAST_CONTEXTS)
    sure = likely.withColumns({"weight": weight, "sureness": weight / error}).where(
        (F.col("weight") >= LEAST_CANDIDATE_WEIGHT) & (F.col("sureness") >= LEAST_SURENESS))
    sure = sure.orderBy(F.col("sureness").desc(), F.length("k0"), "k0").limit(MOST_ENTRIES)
    found = {r["k0"]: (r["weight"], r["n_toxic"]) for r in sure.select("k0", "weight", "n_toxic").collect()}
    entries = _entries(found)

    # the surroundings of entries: how varied they are, and which phrases clean documents use
    matcher_of = Lexicon(entries)

    def surroundings(text: str) -> set[tuple[str, str]]:
        words = fold(text)
        joined, out = f" {' '.join(words)} ", set()
        for at, entry in _matcher(matcher_of).matches(words):
            stop = joined.index(" ", at + 1)
            before, after = joined[:at].rsplit(" ", 1)[-1], joined[stop + 1:joined.find(" ", stop + 1)]
            out.add((entry, f"{before}|{after}"))
            out.update(("", f" {a} {b} ") for a, b in ((before, joined[at + 1:stop]), (joined[at + 1:stop], after)) if a and b)
        return out

    around = staged(_counted(train, surroundings, 2), "toxicity-surroundings")
    varied = {r["k0"]: r["n"] for r in around.where("k0 <> '' AND n_toxic > 0").groupBy("k0").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    entries = {e: w for e, w in entries.items()
               if varied.get(e, 0) >= max(LEAST_CONTEXTS, LEAST_VARIED * found[e][1])}
    spared = around.where((F.col("k0") == "") & (F.col("n_clean") >= LEAST_CLEAN_USES) & (weight <= EXCEPTION_ODDS))
    exceptions = sorted(r["k1"] for r in spared.orderBy(F.col("n_clean").desc(), "k1").limit(MOST_ENTRIES).collect())
    if exceptions:  # what an entry weighs outside of them
        candidates = Lexicon(entries, exceptions)

        def counted_entries(text: str) -> set[tuple[str]]:
            return {(e,) for _, e in _matcher(candidates).matches(fold(text))}

        again = _counted(train, counted_entries, 1).withColumns({"weight": weight, "sureness": weight / error}).where(
            F.col("sureness") >= LEAST_SURENESS)
        entries = {r["k0"]: r["weight"] for r in again.collect()}
    entries = {e: w for e, w in entries.items() if w >= LEAST_WEIGHT}
    return _calibrated(train, Lexicon(entries, exceptions, base, 0.0))


def _calibrated(train: DataFrame, lexicon: Lexicon) -> Lexicon:
    """Intercept and slope of the probability, by a lightly regularised logistic fit over the training documents."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    loads = staged(_scored(train, ["toxic"], "text", lexicon).select("load", F.col("toxic").cast("double").alias("label")), "toxicity-loads")
    if not loads.where("load > 0").take(1):
        return lexicon
    rows = VectorAssembler(inputCols=["load"], outputCol="features").transform(loads)
    model = LogisticRegression(maxIter=200, regParam=1e-5, standardization=False).fit(rows)
    return Lexicon(lexicon.entries, lexicon.exceptions, float(model.intercept), max(0.0, float(model.coefficients[0])))


_BUILT: list[tuple[Lexicon, Matcher]] = []


def _matcher(lexicon: Lexicon) -> Matcher:
    """One automaton for the lexicon a worker is at."""
    if not _BUILT or _BUILT[0][0] is not lexicon:
        _BUILT[:] = [(lexicon, Matcher(lexicon))]
    return _BUILT[0][1]


def _scored(docs: DataFrame, keep: list[str], text_col: str, lexicon: Lexicon) -> DataFrame:
    from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

    slim = docs.select(*keep, F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))
    n_kept = len(keep)
    out = StructType([*slim.schema.fields[:n_kept], StructField("score", DoubleType()), StructField("load", DoubleType()),
                      StructField("n_words", LongType()), StructField("hits", ArrayType(StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            scores, loads, sizes, hits = [], [], [], []
            for text in batch.column(n_kept):
                words = fold(text.as_py())
                found = matcher.matches(words)
                loads.append(matcher.load(words, found))
                scores.append(matcher.score(loads[-1]))
                sizes.append(len(words))
                hits.append([e for _, e in found])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n_kept], pa.array(scores, pa.float64()), pa.array(loads, pa.float64()),
                 pa.array(sizes, pa.int64()), pa.array(hits, pa.list_(pa.string()))], out.fieldNames())

    return slim.mapInArrow(run, out)


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``doc_id``, ``score`` (0 to 1), ``predicted``, ``load``, ``n_words``, ``hits`` (folded entries in order).

    Null and empty texts have no words and the score of a text without matches; whole texts of any length; repeated
    rows are scored each; an empty table gives no rows; other columns are ignored.
    """
    rows = _scored(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("_raw")), ["doc_id"], "_raw", lexicon)
    return rows.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "load", "n_words", "hits")
