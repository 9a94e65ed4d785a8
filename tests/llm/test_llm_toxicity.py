"""Toxicity: folding, matching against plain search, held-out accuracy, exceptions, copies, awkward and empty tables."""

import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from veritab.llm import toxicity

from llm_fixtures import CLASHING, WORDS, awkward_docs, awkward_rows, counted, prose

BAD = ["blarg", "snarfy", "grotzle", "vexoid"]
DISGUISED = ["bl4rg", "SNARFY!", "gr0tz1e", "vеxоid", "ｂｌａｒｇ", "snárfy", "b|arg", "vex​oid", "$narfy"]


def test_folding_brings_spellings_together():
    folded = {w for d in DISGUISED for w in toxicity.fold(f"it {d} is")} - {"it", "is"}
    assert folded == {toxicity.fold(w)[0] for w in BAD}
    assert toxicity.fold("12 34 5,6 !! @ $ | é") == ["e"]
    assert toxicity.fold("") == []


def plain_load(text, lexicon):
    words = toxicity.fold(text)
    joined, hits = f" {' '.join(words)} ", {}
    for at in range(len(joined)):
        found = [e for e in lexicon.entries if joined.startswith(e, at)]
        spared = any(joined.startswith(x, s) for x in lexicon.exceptions for s in range(max(0, at - len(x) + 2), at + 1))
        if found and not spared:
            best = max(found, key=len)
            hits[best] = hits.get(best, 0) + 1
    return sum(lexicon.entries[e] * (1 + math.log(n)) for e, n in hits.items()) / (1 + math.log1p(len(words)))


def test_matches_equal_plain_search():
    lexicon = toxicity.Lexicon({" ab": 1.0, " abc": 2.5, " abc ": 0.5, " ca ": 3.0, " b": 0.25}, [" ab ca ", " ca ca "], -1.0, 2.0)
    matcher, rnd = toxicity.Matcher(lexicon), random.Random(2)
    for _ in range(500):
        text = " ".join("".join(rnd.choice("abc") for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(0, 12)))
        words = toxicity.fold(text)
        assert matcher.load(words, matcher.matches(words)) == pytest.approx(plain_load(text, lexicon))


def corpus(n=900, disguise=False):
    rnd, rows, labels = random.Random(11), [], []
    for i in range(n):
        words = prose(10_000 + i, rnd.randint(20, 200)).split(" ")
        toxic = rnd.random() < 0.2
        held = zlib.crc32(str(i).encode()) % 3 == 1
        for _ in range(rnd.randint(3, 6) if toxic else 0):
            words[rnd.randrange(len(words))] = rnd.choice(DISGUISED if held and disguise else BAD)
        if not toxic and rnd.random() < 0.1:  # clean uses of a bad word, always beside the same one
            words.insert(rnd.randrange(len(words)), "blarg valley")
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.mark.parametrize("disguise", [False, True])
def test_held_out_accuracy(spark, disguise):
    rows, labels = corpus(disguise=disguise)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    lexicon = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    told, texts = {i: y for i, _, y in labels}, dict(rows)
    got = toxicity.score(docs, lexicon).collect()
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert len(got) == len(rows) and len(held) > 200
    assert sum(r["predicted"] == told[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert any("barg" in x or "biarg" in x for x in lexicon.exceptions)
    for r in got[:80]:
        assert r["load"] == pytest.approx(plain_load(texts[r["doc_id"]], lexicon))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-lexicon.intercept - lexicon.slope * r["load"])))
        assert r["predicted"] == int(r["score"] >= 0.7)


def test_copies_do_not_become_lexicon(spark):
    rows, labels = corpus()
    copied = "unsaid marvel of quartz beside tundra " + " ".join(WORDS)
    rows += [(5000 + i, copied + f" blarg vexoid {i}") for i in range(200)]
    labels += [(5000 + i, 1, 1) for i in range(200)]
    lexicon = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"),
                           spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    for word in ("marvel", "quartz", "tundra", "unsaid"):
        assert not any(f" {toxicity.fold(word)[0]} ".startswith(e) for e in lexicon.entries)


def test_labels_held_out_are_not_learned(spark):
    rows, labels = corpus(300)
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, q, y in labels]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fits = [toxicity.fit(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped)]
    assert fits[0].entries == fits[1].entries != {} and fits[0].exceptions == fits[1].exceptions
    assert fits[0].slope == pytest.approx(fits[1].slope, rel=1e-6)


def test_awkward_and_empty_tables(spark):
    told = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (1, 1, 1), (3, 1, 1), (11, 0, None), (None, 1, 1), (999, 1, 1)],
                                 "doc_id long, quality int, toxic int")
    names = dict.fromkeys(CLASHING + ("toxic", "score", "predicted", "load", "hits", "_raw", "_text", "_id", "k0"))
    docs = awkward_docs(spark)
    plain, clash = ([tuple(r) for r in toxicity.score(d, toxicity.fit(d, told)).collect()]
                    for d in (docs, docs.select("*", *[F.lit("clash").alias(c) for c in names])))
    assert counted(plain) == counted(clash) and len(plain) == len(awkward_rows())
    assert all(0 <= r[1] <= 1 and r[2] in (0, 1) for r in plain)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), told)).collect() == []
    nothing = toxicity.fit(docs, told.limit(0))
    assert nothing.entries == {} and toxicity.score(docs, nothing).count() == len(plain)
