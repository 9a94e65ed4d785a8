"""The pipeline against a brute-force version, and the registered queries against their SQL twins."""

import hashlib
import math
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from scripts.check_oracle import digest
from veritab.llm import queries, surrogates

from conftest import SMALL
from llm_fixtures import awkward_docs
from test_llm_jaccard import brute

SPLIT = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPLIT.split(text or "") if w]


def failed(text):
    w = words(text)
    windows = {}
    for i in range(len(w) - 4):
        windows.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {j for places in windows.values() if len(places) > 1 for i in places for j in range(i, i + 5)}
    return len(w) < 10 or 100 * len(covered) > 20 * len(w)


def kept_by_rules(rows):
    host = {}
    for r in rows:
        n = host.setdefault(r["source"], [0, 0])
        n[0] += 1
        n[1] += failed(r["text"])
    n, f = sum(a for a, _ in host.values()), sum(b for _, b in host.values())
    m = f / n
    spread = (sum(b * b / a for a, b in host.values()) - n * m * m - (len(host) - 1) * m * (1 - m)) / max(n - len(host), 1)
    s = min(max(m * (1 - m) / spread - 1, 1.0), 1e4) if spread > 0 else 1e4
    good = {h for h, (a, b) in host.items() if (b + m * s) / (a + s) <= 0.5}
    return [r for r in rows if not failed(r["text"]) and r["source"] in good]


def mixed(rows):
    """(doc_id, text) rows of the mix: each source's first words in shuffled order, as often as its target has them."""
    def at(r):
        key = "|".join(["mix-1", "~" if r["doc_id"] is None else str(r["doc_id"]), str(len(words(r["text"])))])
        return int(hashlib.md5(key.encode()).hexdigest()[:13], 16)

    names = sorted({r["source"] for r in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(len(words(r["text"])) for r in rows if r["source"] == s) for s in names}
    weight, total = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, sum(size.values())
    full = set()
    while True:
        level = (total - sum(3 * size[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and level * weight[s] > 3 * size[s]}
        if not more:
            break
        full |= more
    target = {s: 3 * size[s] if s in full else level * weight[s] for s in names}
    out = []
    for s in names:
        own = sorted((r for r in rows if r["source"] == s), key=lambda r: (at(r), r["doc_id"] is not None, r["doc_id"] or 0))
        before, given = 0, math.floor(target[s] + 0.5)
        for r in own:
            n = len(words(r["text"]))
            for epoch in range(3):
                c = min(n, max(0, min(given - epoch * size[s], size[s]) - before))
                if c:
                    out.append((r["doc_id"], r["text"] if c == n else
                                "".join(re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", r["text"])[:c])))
            before += n
    return out


def test_pipeline_equals_brute_force(spark):
    rows = [r.asDict() for r in queries.documents(spark, SMALL).collect()]
    rows = kept_by_rules(rows)
    least = {c for _, n, c in brute([(r["doc_id"], r["text"]) for r in rows]) if n}
    rows = [r for r in rows if r["doc_id"] in least]
    frame = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in surrogates.replace_entities(frame).collect()}
    for r in rows:
        r["text"] = clean[r["doc_id"]]
    library = Tokenizer.from_file(queries.vocabulary_path())
    expected = []
    for doc, text in mixed(rows):
        ids = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        expected.append((doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = [(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SMALL).collect()]
    assert sorted(got) == sorted(expected)


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (awkward_docs(spark, clashing=True), awkward_docs(spark).limit(0)):
        rows = docs.count()
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == list(corpus_pipeline.COLUMNS)
            assert out.count() <= 3 * rows
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == rows


def test_mix_of_repeated_rows_gives_all_their_takes(spark):
    from veritab.llm import mixing

    docs = awkward_docs(spark).unionByName(awkward_docs(spark))
    taken = mixing.mixed(docs).agg(F.sum("taken")).first()[0]
    assert sum(len(words(r["text"])) for r in mixing.apply_mix(docs).collect()) == taken


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    frame = queries.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in frame.collect()]
    cur = con.execute(queries.SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(frame.columns)
    assert digest(frame.columns, rows)[0] == digest(columns, cur.fetchall())[0]


def test_no_python_on_native_paths(spark):
    for name in ("op2_pii_surrogates", "op3_licence_lookup", "op5_interleaved_shards", "op6_quality_rules"):
        plan = queries.queries()[name](spark, SMALL)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
