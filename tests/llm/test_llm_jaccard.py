"""The join against brute force over word shingles, with rare and with very common shingles."""

import random

import pytest

from veritab.llm import jaccard

from llm_fixtures import awkward_rows, prose


def brute(rows):
    sets = []
    for _, text in rows:
        words = (text or "").translate({c: c + 32 for c in range(65, 91)})
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
        sets.append({tuple(words[i:i + 4]) for i in range(len(words) - 3)} if len(words) > 3 else ({tuple(words)} if words else set()))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            inter = len(a & sets[j])
            if a and sets[j] and 100 * inter >= 85 * len(a | sets[j]):
                parent[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(i)] = min(ids.get(find(i), doc), doc)
    return sorted(((doc, len(s), ids.get(find(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=str)


def family(seed, copies, edits, first):
    rnd, words, out = random.Random(seed), prose(seed, rnd_words(seed)).split(" "), []
    for c in range(copies):
        own = list(words)
        for _ in range(rnd.randint(0, edits)):
            own[rnd.randrange(len(own))] = f"new{rnd.randrange(10 ** 6)}"
        out.append((first + c, " ".join(own)))
    return out


def rnd_words(seed):
    return random.Random(seed * 7).randint(30, 160)


def table(seed):
    rows = []
    for f in range(8):
        rows += family(seed * 100 + f, 7, 5, len(rows))
    passage = prose(999, 60)
    rows += [(500 + i, prose(3000 + seed * 50 + i, 20 + 4 * i) + " " + passage) for i in range(25)]
    rows += [(600 + i, t) for i, (_, t, _, _) in enumerate(awkward_rows())] + [(None, passage), (0, passage)]
    return rows


@pytest.mark.parametrize("common", [2, 64])
def test_components_equal_brute_force(spark, monkeypatch, common):
    monkeypatch.setattr(jaccard, "COMMON", common)
    rows = table(common)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.similarity_components(frame).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_large_near_copy_group_by_shuffled_keys(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "COMMON", 8)
    monkeypatch.setattr(jaccard, "CELL_PAIRS", 16)
    monkeypatch.setattr(jaccard, "FEW_KEYS", 1)
    rows = family(5, 90, 6, 0) + [(1000 + i, prose(70 + i, 90)) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.similarity_components(frame).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_keep_one(spark):
    rows = [(i, t, "x") for i, t in table(3)[:60]] + [(700, None, "x"), (701, "", "x"), (3, table(3)[3][1], "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = [r["doc_id"] for r in jaccard.keep_one(frame).collect()]
    expected = {c for _, n, c in brute([(i, t) for i, t, _ in rows]) if n}
    assert sorted(kept) == sorted(expected | {700, 701})


def test_three_hundred_near_copies(spark, monkeypatch):
    """Copies with several changes each: many pairs stand at the edge of the similarity, and few links join them."""
    monkeypatch.setattr(jaccard, "COMMON", 2)
    asked = []
    pruned = jaccard._pruned
    monkeypatch.setattr(jaccard, "_pruned", lambda pairs, classes: asked.append(pairs.count()) or pruned(pairs, classes))
    rows = family(12, 300, 4, 0)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.similarity_components(frame).collect()]
    assert sorted(got, key=str) == brute(rows)
    assert sum(asked) < 300 * 299 / 2


def test_keep_one_leaves_columns_of_any_name(spark):
    rows = [(i, t, "left") for i, t in table(3)[:30]]
    names = ("_th", "_key", "_row", "_copy", "_one", "_worded", "_set")
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, "doc_id long, text string, cls string").select("*", *[F.lit("clash").alias(n) for n in names])
    kept = jaccard.keep_one(frame)
    assert kept.columns == frame.columns
    assert all(r["cls"] == "left" and all(r[n] == "clash" for n in names) for r in kept.collect())
