"""Fill-in-middle transformation by block rotation inside one buffer, and its exact inverse.

A text is cut after two of its tokens. Sentinels are inserted before its three parts in a bytearray, and neighbouring
segments are exchanged in place by a rotation of three reversals; the form that puts the suffix first rotates the whole
buffer, the other one its tail. To restore a text the rotation is inverted and the sentinels are taken out.

Bytes below 128 never occur inside a longer UTF-8 character, so tokens, whose ends lie beside white space, are found
and cut on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from veritab.llm.bpe import _in_batches as in_batches
from veritab.llm.textvec import SPACED

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: of 100 texts without a sentinel so many are rearranged, of 100 rearranged ones so many with the suffix first
INFILL_PERCENT, SUFFIX_FIRST_PERCENT = 50, 80


def rotate(buffer: bytearray, start: int, middle: int, stop: int) -> None:
    """Exchange ``buffer[start:middle]`` and ``buffer[middle:stop]`` in place: both reversed, then the whole."""
    for a, b in ((start, middle), (middle, stop), (start, stop)):
        buffer[a:b] = buffer[a:b][::-1]


def token_ends(raw: bytes) -> np.ndarray:
    """Where the tokens of a text end: a word with the white space before it, or the white space at the end."""
    worded = SPACED[np.frombuffer(raw, np.uint8)] > 0
    inner = np.flatnonzero(worded[:-1] & ~worded[1:]) + 1
    return np.append(inner, len(raw)) if raw else inner


def _characters(raw: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80))


def rearranged(raw: bytes, first: int, second: int, form: str) -> bytes:
    """The text cut at two byte offsets, its parts in the order of ``form`` (``psm`` or ``spm``) behind sentinels."""
    buffer = bytearray(raw)
    buffer[second:second] = SUFFIX
    buffer[first:first] = MIDDLE
    buffer[0:0] = PREFIX
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(buffer, 0 if form == "spm" else middle, suffix, len(buffer))
    return bytes(buffer)


def restored(output: bytes, form: str) -> bytes:
    """The text that ``rearranged`` was given; a sentinel never overlaps another or the text beside it."""
    if form == "plain":
        return output
    buffer, size = bytearray(output), len(output)
    if form == "spm":
        prefix = buffer.index(PREFIX)
        rotate(buffer, 0, prefix, size)
        middle, suffix = buffer.index(MIDDLE), size - prefix
    else:
        middle, tail = buffer.index(SUFFIX), buffer.index(MIDDLE)
        rotate(buffer, middle, tail, size)
        suffix = middle + size - tail
    for at, mark in ((suffix, SUFFIX), (middle, MIDDLE), (0, PREFIX)):
        del buffer[at:at + len(mark)]
    return bytes(buffer)


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42,
              infill_percent: int = INFILL_PERCENT, suffix_first_percent: int = SUFFIX_FIRST_PERCENT) -> DataFrame:
    """Per row: ``doc_id``, ``n`` (tokens), ``form`` (plain, psm or spm), ``prefix_chars``, ``middle_chars``, ``output``.

    Cuts and form follow from the SHA-256 of seed and id, so reruns and repeated rows agree. A null text counts as
    empty; an empty text, or one that holds a sentinel, stays plain, and its characters are null; a null id counts as
    an empty one; texts of any length are cut whole; an empty table gives no rows; other columns are ignored.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    part = lambda i: F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"_h{i}")
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), *[part(i) for i in range(4)],
                       F.col(f"`{text_col}`").cast("string").cast("binary").alias("_raw"))
    id_field = slim.schema["doc_id"]

    def step(raw: bytes, h: list[int]) -> tuple:
        ends = token_ends(raw)
        n = len(ends)
        if not raw or any(mark in raw for mark in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= infill_percent:
            return n, "plain", None, None, raw
        first, second = (int(ends[k - 1]) if k else 0 for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
        form = "spm" if h[3] % 100 < suffix_first_percent else "psm"
        return n, form, _characters(raw[:first]), _characters(raw[first:second]), rearranged(raw, first, second, form)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                ids, *numbers, raws = batch.columns
                numbers = list(zip(*[c.to_pylist() for c in numbers]))
                for i, (h, raw) in enumerate(zip(numbers, raws)):
                    yield (ids[i].as_py(), *step(raw.as_py() or b"", h))

        return in_batches(rows(), arrow)

    out = StructType([id_field, StructField("n", LongType()), StructField("form", StringType()),
                      StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()),
                      StructField("output", BinaryType())])
    arrow = to_arrow_schema(out)
    return slim.mapInArrow(run, out).withColumn("output", F.col("output").cast("string"))


def restore(rows: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """``rows`` with the column ``restored``: the exact text before ``transform``, from output and form alone.

    A null output or form gives an empty text; a column ``restored`` of the input is replaced.
    """
    @F.pandas_udf("binary")
    def undo(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([restored(raw or b"", form or "plain") for raw, form in zip(outputs, forms)], dtype=object)

    rebuilt = undo(F.col(f"`{output_col}`").cast("binary"), F.col(f"`{form_col}`"))
    return rows.withColumn("restored", rebuilt.cast("string"))
