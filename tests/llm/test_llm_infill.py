"""Fill-in-middle against slicing of the text: every cut, both forms, exact restoring; awkward and empty tables."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from veritab.llm import infill

from llm_fixtures import CLASHING, awkward_docs, awkward_rows, counted

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plainly(doc_id, text):
    text, h = text or "", hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    tokens, h = TOKEN.findall(text), [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def rows_of(frame):
    return [tuple(r) for r in infill.restore(infill.transform(frame)).collect()]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é中\n\t\x0b\x1c\xa0<PSM>", max_size=40), st.integers(0, 50), st.integers(0, 50))
def test_every_cut_is_undone(text, x, y):
    raw = text.encode()
    ends = [0, *infill.token_ends(raw).tolist()]
    assert [raw[a:b].decode() for a, b in zip(ends, ends[1:])] == TOKEN.findall(text)
    if any(s in text for s in ("<P>", "<S>", "<M>")):
        return
    a, b = sorted((ends[x % len(ends)], ends[y % len(ends)]))
    p, m, s = raw[:a], raw[a:b], raw[b:]
    assert infill.rearranged(raw, a, b, "psm") == b"<P>" + p + b"<S>" + s + b"<M>" + m
    assert infill.rearranged(raw, a, b, "spm") == b"<S>" + s + b"<P>" + p + b"<M>" + m
    for form in ("psm", "spm"):
        assert infill.restored(infill.rearranged(raw, a, b, form), form) == raw


def test_rotation_moves_bytes_in_place():
    buffer = bytearray(b"0123456789")
    infill.rotate(buffer, 2, 5, 9)
    assert buffer == b"0156782349"
    infill.rotate(buffer, 2, 6, 9)
    assert buffer == b"0123456789"


def test_awkward_rows_and_clashing_columns(spark):
    extra = [(100 + i, f"word {i} <{'PSM'[i % 3]}> end" if i % 4 == 0 else f"  é{i} two\n中 three {i} \n" * (i % 5), "en", "a") for i in range(200)]
    frame = awkward_docs(spark).drop("n_chars").unionByName(
        spark.createDataFrame(extra, "doc_id long, text string, lang string, source string"))
    expected = counted([plainly(i, t) for i, t, *_ in awkward_rows() + extra])
    assert counted(rows_of(frame)) == expected
    names = CLASHING + ("_h0", "_raw", "form", "output", "restored", "prefix_chars")
    from pyspark.sql import functions as F

    assert counted(rows_of(frame.select("*", *[F.lit("clash").alias(c) for c in dict.fromkeys(names)]))) == expected
    assert rows_of(frame.limit(0)) == []


def test_other_shares(spark):
    frame = spark.createDataFrame([(i, f"a b c d {i}") for i in range(300)], "doc_id long, text string")
    forms = {p: {r["form"] for r in infill.transform(frame, infill_percent=100, suffix_first_percent=p).collect()} for p in (0, 100)}
    assert forms == {0: {"psm"}, 100: {"spm"}}
