"""Collocations against plain counting: cuts, absorbed phrases, ties, overfull pairs, awkward and empty tables."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veritab.llm import collocations

from llm_fixtures import CLASHING, awkward_docs, awkward_rows

LOWER = {c: c + 32 for c in range(65, 91)}


def plainly(rows, least, top=2000):
    counts, totals, out = Counter(), Counter(), []
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i:i + k])] += 1
    candidates = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    most = Counter()
    for (lang, p), a in candidates.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                most[lang, p[i:i + k]] = max(most[lang, p[i:i + k]], a)
    for (lang, p), a in candidates.items():
        if 100 * most[lang, p] >= 80 * a:
            continue
        score, k = min((2_000_000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, counts[lang, p[:k]], counts[lang, p[k:]], totals[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    rank = Counter()
    for lang, *rest in out:
        rank[lang] += 1
        if rank[lang] <= top:
            yield (lang, rank[lang], *rest)


def found(frame, **options):
    return [tuple(r) for r in collocations.collocations(frame, **options).orderBy("lang", "rank").collect()]


def corpus(seed, n=160):
    rnd = random.Random(seed)
    words = ["The", "of", "new", "york", "é", "straße", "x1", "中文", "a\xa0b", "-", "Zeit"]
    def text():
        out = []
        for _ in range(rnd.randint(0, 90)):
            out.append(rnd.choice(words[:rnd.choice([2, 4, 11])]))
            out.append(rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " ; ", "\x0b", "?!"]))
            if rnd.random() < 0.1:
                out.append(" new york city hall ")
        return "".join(out)
    return [(text(), rnd.choice(["en", "de", None, "und"])) for _ in range(n)] + [(None, "en"), ("", "fr"), (" ,. ", None)]


@pytest.mark.parametrize("tasks", [1 << 19, 64])
def test_equals_plain_counting(spark, monkeypatch, tasks):
    """With 64 suffixes to a task nearly every leading pair is overfull and dealt by all its words."""
    monkeypatch.setattr(collocations, "TASK_SUFFIXES", tasks)
    rows = corpus(3)
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    assert found(frame, least=5) == list(plainly(rows, 5))
    assert found(frame, least=4, top=7) == list(plainly(rows, 4, 7))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 12), st.integers(1, 400))
def test_partition_sizes(seed, least, n):
    rnd = np.random.default_rng(seed)
    suffixes = rnd.choice(np.array([1, 2, 3, 5, 1 << 63], np.uint64), (4, n), p=[0.5, 0.2, 0.1, 0.1, 0.1])
    suffixes[rnd.integers(2, 4, n), np.arange(n)] *= rnd.integers(0, 2, n).astype(np.uint64)
    suffixes[3, suffixes[2] == 0] = 0
    counts = rnd.integers(1, 4, n)
    whole = Counter()
    for s, c in zip(suffixes.T.tolist(), counts.tolist()):
        for k in range(2, 5):
            if s[k - 1]:
                whole[tuple(s[:k])] += c
    frequent = {p: c for p, c in whole.items() if c >= least}
    assert collocations.partition_sizes(suffixes, counts, least, np.zeros(n, bool)) == frequent
    # counted in two tasks, shorter phrases of an overfull pair add up
    summed = Counter()
    where = (suffixes[2] + suffixes[3] * np.uint64(3)) % np.uint64(2)
    for part in (where == 0, where == 1):
        summed.update(collocations.partition_sizes(suffixes[:, part], counts[part], least, np.ones(int(part.sum()), bool)))
    assert {p: c for p, c in summed.items() if c >= least} == frequent


def test_ties_and_exact_thresholds(spark):
    rows = [("a b c", "en")] * 24 + [("a b", "en")] * 6 + [("q r", "en")] * 30 + [("q s", "en")] * 30 + [("u v w", "en")] * 29
    frame = spark.createDataFrame(rows, "text string, lang string")
    assert found(frame) == list(plainly(rows, 30))
    assert [r[2] for r in found(frame)] == ["a b", "q r", "q s"]


def test_awkward_and_empty_tables(spark):
    frame = awkward_docs(spark)
    expected = list(plainly([(t, lang) for _, t, lang, _ in awkward_rows()], 3))
    names = dict.fromkeys(CLASHING + ("rank", "phrase", "a", "l", "r", "w0", "word", "route", "suffixes"))
    assert found(frame, least=3) == expected != []
    assert found(frame.select("*", *[F.lit("clash").alias(c) for c in names]), least=3) == expected
    assert found(frame.limit(0)) == []


def test_long_texts_are_cut_between_pieces(monkeypatch):
    import pyarrow as pa

    texts = [("ab c, de\nf " * 40), "no end of a piece " * 30, None, "x y. " * 100, "q"]
    batch = pa.record_batch([pa.array(["en", "de", "en", "en", "fr"]), pa.array(texts)], ["lang", "text"])
    def pieces(size):
        monkeypatch.setattr(collocations, "CHUNK_BYTES", size)
        out = Counter()
        for _, langs, codes, words in collocations._chunks([batch], 1):
            for code, suffix in zip(codes, collocations._followers(words).T.tolist()):
                out[langs[code], tuple(suffix)] += 1
        return out
    assert pieces(50) == pieces(7) == pieces(1 << 20)
