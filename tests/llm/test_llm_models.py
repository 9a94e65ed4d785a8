"""Language identification by held-out accuracy, resampling against a direct count, top-k against all pairs."""

import zlib

import numpy as np
import pytest

from veritab.llm import langid, queries, resampling, topk
from veritab.llm.textvec import PUNCTUATED, SPACED, text_chunks, word_hashes

from llm_fixtures import prose

MIDDLE = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    docs = {r["doc_id"]: r for r in queries.documents(spark, MIDDLE).collect()}
    rows = [r for r in queries.op10_language_id(spark, MIDDLE).collect()]
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 for r in rows)
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    right = np.mean([docs[r["doc_id"]]["lang"] == r["lang_pred"] for r in held])
    sure = [r for r in held if not r["rejected"]]
    assert right > 0.95 and len(sure) > 0.8 * len(held)
    assert np.mean([docs[r["doc_id"]]["lang"] == r["lang_pred"] for r in sure]) >= right


def test_language_edge_cases(spark):
    frame = spark.createDataFrame([(1, "42 !!"), (2, None), (3, ""), (4, "aaa bbb")], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(frame, [("xx", b"aaa bbb ccc"), ("yy", b"zzz qqq ppp")]).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] in ("xx", "yy")
    assert {r["lang_pred"] for r in langid.predict(frame, []).collect()} == {"und"}


def test_held_out_rows_do_not_teach(spark):
    docs = queries.documents(spark, MIDDLE)
    from pyspark.sql import functions as F

    spoiled = docs.withColumn("text", F.when(langid.held_out(F.col("doc_id")), F.lit("zz zz zz")).otherwise(F.col("text")))
    assert langid.fit(docs) == langid.fit(spoiled)


def test_languages_of_little_text_do_not_spoil_the_others(spark):
    from pyspark.sql import functions as F

    docs = queries.documents(spark, MIDDLE).select("doc_id", "text", "lang")
    ids = [i for i in range(10 ** 9, 10 ** 9 + 40) if zlib.crc32(str(i).encode()) % 4 != 2]
    # a language of 20 letters, one of an empty text, one without letters, one with a single document of some length
    rare = "kwezu mbali ngoto wafi shunde lobira tukumo zeph " * 20
    few = [(ids[0], "ngiyabonga kakhulu wena", "s"), (ids[1], "", "t"), (ids[2], "12 34", "u"), (ids[3], rare[:700], "w")]
    learned = langid.fit(docs.unionByName(spark.createDataFrame(few, "doc_id long, text string, lang string")))
    assert [lang for lang, _ in learned] == ["de", "en", "es", "fr", "s", "w"]
    assert len(dict(learned)["en"]) > len(dict(learned)["w"]) > len(dict(learned)["s"])
    held = docs.where(langid.held_out(F.col("doc_id")))
    found = langid.predict(held, learned, ["doc_id", "lang"]).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.95
    asked = spark.createDataFrame([(1, rare[705:1100])], "doc_id long, text string")
    assert langid.predict(asked, learned).first()["lang_pred"] == "w"


@pytest.mark.parametrize("classes", [SPACED, PUNCTUATED])
def test_word_hashes_follow_the_words(classes):
    import pyarrow as pa
    import regex

    texts = ["The the THE", "", None, "a  b\n\tc", "é é É", "x*** y!!! x", prose(1, 400)]
    pattern = r"[^\x20\x09-\x0D]+" if classes is SPACED else r"[^\x20\x09-\x0D!-/:-@\[-^`{-~]+|[!-/:-@\[-^`{-~]+"
    seen = {}
    for first, last, data, offsets in text_chunks(pa.array(texts)):
        hashes, counts = word_hashes(data, offsets, classes)
        words = [regex.findall(pattern, t or "") for t in texts[first:last]]
        assert counts.tolist() == [len(w) for w in words]
        for w, h in zip([w for ws in words for w in ws], hashes.tolist()):
            key = w.translate({c: c + 32 for c in range(65, 91)})
            assert seen.setdefault(key, h) == h
    assert len(set(seen.values())) == len(seen)


def test_resampling_equals_direct_count(spark):
    from veritab.llm.resampling import BUCKETS, _buckets

    docs = queries.documents(spark, MIDDLE).limit(300).cache()
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    own = {}
    for i, t in texts.items():
        data = np.frombuffer(t.encode(), np.uint8)
        own[i] = _buckets(data, np.array([0, len(data)]))[0]
        np.add.at(raw, own[i], 1)
        if i in good:
            np.add.at(target, own[i], 1)
    ratios = np.log(target / target.sum()) - np.log(raw / raw.sum())
    rows = resampling.resample(docs, labels, share=0.6).collect()
    assert sum(r["kept"] for r in rows) == round(0.6 * len(rows))
    for r in rows:
        assert abs(r["log_weight"] - ratios[own[r["doc_id"]]].sum()) < 1e-6 and r["n_features"] == len(own[r["doc_id"]])
    order = sorted(rows, key=lambda r: -r["draw"])
    assert [r["rank"] for r in order] == list(range(len(rows)))


def test_gumbel_draws_follow_the_weights(spark):
    rows = [(i, "good words here" if i % 2 else "bad *** ***") for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 300)], "doc_id long, quality int")
    kept = {r["doc_id"] for r in resampling.resample(frame, labels, share=0.5).where("kept").collect()}
    assert sum(i % 2 for i in kept) > 0.6 * len(kept)


@pytest.mark.parametrize("blocks", [(512, 4096), (7, 40)])
def test_top_k_equals_all_pairs(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "ROW_BLOCK", blocks[1])
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(300, 24)) * rnd.choice([0.1, 1, 30], size=(300, 1))
    x[50:60] = x[50]
    frame = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    q = np.floor(64 * x).astype(int)
    scores = q @ q.T
    expected = []
    for i in range(0, 300, 20):
        order = sorted((j for j in range(300) if j != i), key=lambda j: (-scores[i, j], j))[:20]
        expected += [(i, r + 1, j, int(scores[i, j])) for r, j in enumerate(order)]
    assert [tuple(r) for r in topk.top_k(frame).orderBy("query_id", "rank").collect()] == expected


def test_bounds_hold_at_every_level():
    rnd = np.random.default_rng(9)
    a, b = rnd.integers(-90, 90, (20, 64)).astype(float), rnd.integers(-90, 90, (50, 64)).astype(float)
    exact = a @ b.T
    last = None
    for n in (1, *topk.LEVELS, 64):
        bound = topk.segment_statistics(a, n) @ topk.segment_statistics(b, n).T
        assert (bound >= exact - 1e-6).all()
        assert last is None or bound.sum() <= last + 1e-6
        last = bound.sum()


def test_scores_beyond_exact_floats():
    big = np.array([[2 ** 40 + 1, 3]])
    assert topk.exact_scores(big, np.array([[2 ** 20 + 1, 5]]))[0, 0] == (2 ** 40 + 1) * (2 ** 20 + 1) + 15
