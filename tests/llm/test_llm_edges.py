"""Every operator on the awkward table, on an empty one and with clashing extra columns."""

import pytest

from veritab.llm import bpe, jaccard, langid, licences, mixing, queries, resampling, rules, sharding, surrogates, topk

from llm_fixtures import awkward_docs, awkward_rows, counted

VOCABULARY = bpe.read_vocabulary(queries.vocabulary_path())


def _labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 1, 0), (11, 0, 0), (11, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "bpe": lambda s, d: bpe.round_trip(d, VOCABULARY, ["doc_id"]),
    "surrogates": lambda s, d: surrogates.replace_entities(d).select("doc_id", "text", "pii_count", "pii_kinds"),
    "licences": lambda s, d: licences.scan_licences(d),
    "sharding": lambda s, d: sharding.interleaved_shards(d, 4),
    "rules": lambda s, d: rules.quality_verdicts(d),
    "jaccard": lambda s, d: jaccard.similarity_components(d),
    "resampling": lambda s, d: resampling.resample(d, _labels(s)),
    "mixing": lambda s, d: mixing.mixed(d),
    "langid": lambda s, d: langid.predict(d, langid.fit(d)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows_and_clashing_columns(spark, name):
    plain = OPERATORS[name](spark, awkward_docs(spark)).collect()
    clashing = OPERATORS[name](spark, awkward_docs(spark, clashing=True)).collect()
    assert len(plain) == len(awkward_rows())
    assert counted(plain) == counted(clashing)
    assert counted(plain, ["doc_id"]) == counted([(r[0],) for r in awkward_rows()])


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, awkward_docs(spark).limit(0)).collect() == []


def test_topk_edges(spark):
    rows = [(0, [1.0, 2.0]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (7, []), (8, [1.0]), (9, [1.0, 2.0]), (10, [1.0, 2.0]), (None, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk.top_k(frame, k=3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 9, 20480), (0, 2, 10, 20480), (0, 3, 20, 6144), (20, 1, 0, 6144), (20, 2, 9, 6144), (20, 3, 10, 6144)]
    assert topk.top_k(frame.limit(0)).collect() == []


def test_rules_by_hand(spark):
    got = {(r["doc_id"], r["n_words"]): r for r in rules.quality_verdicts(awkward_docs(spark)).collect()}
    repeated = got[11, 12]
    assert repeated["n_repeat_words"] == 12 and repeated["base_failed"] and not repeated["kept"]
    assert got[4, 0]["base_failed"] and got[5, 0]["word_chars"] == 0
    assert got[12, 3]["n_symbols"] == 0 and got[1, 120]["n_repeat_words"] == 0
    frame = spark.createDataFrame([(1, "a b c d e f g\na b c d e f g\n \nx # $\n", "h")], "doc_id long, text string, source string")
    row = rules.quality_verdicts(frame).first()
    assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == (17, 17, 2, 1, 14)


def test_hosts_are_shrunk_and_rejected(spark):
    good = [(i, "word " + " ".join(f"w{i}x{j}" for j in range(20)), f"h{i % 20}") for i in range(400)]
    bad = [(1000 + i, "short", "bad") for i in range(60)] + [(2000 + i, good[i][1], "bad") for i in range(5)]
    few = [(3000, "short", "few"), (3001, good[7][1], "few")]
    frame = spark.createDataFrame(good + bad + few, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in rules.quality_verdicts(frame).collect()}
    assert got[2000]["host_rejected"] and not got[2000]["kept"] and not got[2000]["base_failed"]
    assert got[0]["kept"] and got[3001]["kept"] and 0 < got[3001]["host_rate"] < 0.5
    kept = {r["doc_id"] for r in rules.apply_rules(frame).collect()}
    assert kept == {i for i, r in got.items() if r["kept"]}


def test_licence_forms(spark):
    from veritab.llm.licence_texts import KNOWN_LICENCES

    mit = dict(KNOWN_LICENCES)["MIT"]
    rows = [(1, "Copyright (c) 2020 A. Person\n" + mit.upper()), (2, mit.replace("sublicense", "sub-license")),
            (3, mit + "\nAnd more."), (4, None), (5, "!!"), (6, "Licenced under the Apache licence -- version 2.0")]
    got = {r["doc_id"]: r["licence_id"] for r in licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: None, 4: None, 5: None, 6: "Apache-2.0-notice"}


def test_shards_hold_the_mixture(spark):
    rows = [(i, f"t{i}", "a" if i % 10 < 7 else ("b" if i % 10 < 9 else None)) for i in range(1000)]
    got = sharding.interleaved_shards(spark.createDataFrame(rows, "doc_id long, text string, source string"), 8).toPandas()
    assert got.groupby("shard").size().between(125, 125).all()
    share = got[got["source_key"] == "+a"].groupby("shard").size() / 125
    assert share.between(0.68, 0.72).all()
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))


def test_mix_meets_targets(spark):
    import random

    rnd = random.Random(3)
    rows = [(i, " ".join(["w"] * rnd.randint(1, 90)), f"s{i % 7}" if i % 3 else "s0") for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(frame).toPandas()
    assert (got["taken"] <= 3 * got["size"]).all()
    by = got.groupby("source_key").agg(taken=("taken", "sum"), target=("target", "first"), size=("source_size", "first"))
    assert ((by["taken"] - by["target"]).abs() <= 0.5).all()
    assert abs(by["target"].sum() - got["size"].sum()) < 1e-6 * got["size"].sum()
    mixed = mixing.apply_mix(frame).toPandas()
    assert mixed["text"].str.split().str.len().sum() == got["taken"].sum()


def test_small_sources_beside_a_large_one_meet_their_targets(spark):
    rows = [(i, "w " * 30, f"s{i:03d}") for i in range(300)] + [(1000 + i, "w " * 3000, "whale") for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(frame).toPandas()
    by = got.groupby("source_key").agg(taken=("taken", "sum"), target=("target", "first"))
    assert len(by) == 301 and ((by["taken"] - by["target"]).abs() <= 0.5).all() and (by["taken"] >= 30).all()


def test_schedule_holds_sources_in_proportion(spark):
    sizes = [("+a", 4000, 12000.0), ("+b", 9000, 9000.0), ("+c", 50, 150.0), ("-", 7, 3.2)]
    targets = spark.createDataFrame(sizes, "source_key string, source_size long, target double")
    sources = mixing.source_slots(targets, 40)
    slots = mixing.schedule(spark, sources).toPandas().sort_values("slot")
    words = (slots["to"] - slots["from"]).groupby(slots["source_key"]).sum()
    assert words.to_dict() == {"+a": 12000, "+b": 9000, "+c": 150, "-": 3}
    assert (slots["to"] > slots["from"]).all()
    for part in (slots.iloc[:100], slots.iloc[200:300]):
        assert abs((part["source_key"] == "+a").mean() - 12000 / 21153) < 0.06
