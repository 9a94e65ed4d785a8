"""Language identification by compression.

Each language has a raw-content zstandard dictionary, made of a bounded sample of its training documents. A text is
encoded with each dictionary and takes the language whose encoding is smallest; when the runner-up is about as small,
the decision is marked as rejected. Dictionaries differ in length, and a longer one makes texts of any language smaller:
each size is divided by the share of its plain size that the dictionary leaves of texts of the other languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log
from statistics import median

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
#: documented bounds of the training sample: documents, letters of each and dictionary bytes for each language
SAMPLE_DOCS, SAMPLE_LETTERS, DICTIONARY_BYTES = 200, 1_024, 65_536
#: texts are encoded in slices of so many bytes, each on its own, so that the dictionary matters in long texts too
SLICE_BYTES = 4_096
LEVEL = 6
#: what a dictionary leaves of foreign texts is measured on so many slices of each language, at each of these lengths
MEASURED_SLICES, MEASURED_BYTES = 8, (64, 256, 1_024, 4_096)
#: a decision is rejected when the best encoding is not smaller than the runner-up's by this share
MIN_MARGIN = 0.01


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def letters(text: Column) -> Column:
    """What is encoded: the whole text in lower case, one space for whatever is no letter."""
    return F.regexp_replace(F.lower(text), r"\P{L}+", " ")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, bytes]]:
    """(language, dictionary) pairs in order of language, each dictionary as long as its language's rows and the bound allow.

    Learns from rows with a language and a letter in their text that are not held out: of each language the
    ``SAMPLE_DOCS`` rows of smallest keyed hash, each adding at most ``SAMPLE_LETTERS``, until the dictionary is full.
    """
    rows = docs.where(F.col(text_col).rlike(r"\p{L}") & F.col(lang_col).isNotNull() & ~held_out(F.col(id_col)))
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"),
                       F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.crc32(F.col(text_col).cast("binary")))).alias("_key"),
                       F.substring(letters(F.col(text_col)), 1, SAMPLE_LETTERS).alias("_sample"))
    first = Window.partitionBy("lang").orderBy("_key", "_sample")
    rows = rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= SAMPLE_DOCS)
    found: dict[str, list[bytes]] = {}
    for row in rows.orderBy("lang", "_n").toLocalIterator():
        found.setdefault(row["lang"], []).append(row["_sample"].encode())
    return [(lang, b"\n".join(found[lang])[:DICTIONARY_BYTES]) for lang in sorted(found)]


def sizes(text: str, compressors: list, shares: list[dict[int, float]]) -> list[float]:
    """The encoded size of ``text`` with each dictionary, each slice's divided by the share left of foreign texts."""
    raw = text.encode("utf-8", "replace")
    slices = [raw[i:i + SLICE_BYTES] for i in range(0, len(raw), SLICE_BYTES)]
    return [sum(len(c.compress(s)) / _share(share, len(s)) for s in slices) for c, share in zip(compressors, shares)]


def _share(share: dict[int, float], length: int) -> float:
    """Between the measured lengths by the logarithm of the length."""
    return float(np.interp(log(length), [log(n) for n in share], list(share.values()))) if share else 1.0


def foreign_shares(dictionaries: list[tuple[str, bytes]], compressors: list) -> list[dict[int, float]]:
    """For each language and measured length the share of its plain size that the dictionary leaves of foreign slices.

    The median over evenly spaced slices of the other languages' dictionaries; a language that is shorter than the
    length has no slice of it. The shortest length takes what there is, so that every other language counts there.
    """
    plain, out = compressor(b""), []
    for i, tool in enumerate(compressors):
        share = {}
        for n in MEASURED_BYTES:
            slices = [d[at:at + n] for j, (_, d) in enumerate(dictionaries) if j != i
                      and (len(d) >= n or n == MEASURED_BYTES[0])
                      for at in sorted({k * max(0, len(d) - n) // MEASURED_SLICES for k in range(MEASURED_SLICES)})]
            if slices:
                share[n] = median(len(tool.compress(s)) / len(plain.compress(s)) for s in slices)
        out.append(share)
    return out


def compressor(dictionary: bytes):
    options = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
    if not dictionary:
        return zstandard.ZstdCompressor(**options)
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, **options)


def predict(docs: DataFrame, dictionaries: list[tuple[str, bytes]], keep: list[str] = ["doc_id"],  # noqa: B006
            text_col: str = "text") -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score`` (the runner-up's excess as a share of its size) and ``rejected``.

    Whole texts are encoded. A null text or one without a letter, and any text when nothing was learned, is ``und``
    with score 0 and rejected; ties go to the language first in order; with one language the score is 1; equal rows
    get equal answers; an empty table gives no rows; columns not in ``keep`` are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

    text = F.col(text_col).cast("string")
    slim = docs.select(*[F.col(f"`{c}`") for c in keep], F.when(text.rlike(r"\p{L}"), letters(text)).alias("_text"))
    out_schema = StructType([*slim.schema.fields[:-1], StructField("lang_pred", StringType()),
                             StructField("score", DoubleType()), StructField("rejected", BooleanType())])
    arrow, n_kept = to_arrow_schema(out_schema), len(keep)
    learned = [(lang, d) for lang, d in dictionaries]
    shares = foreign_shares(learned, [compressor(d) for _, d in learned])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, tools = [lang for lang, _ in learned], [compressor(d) for _, d in learned]
        for batch in batches:
            langs, scores = [], []
            for value in batch.column(n_kept):
                text = value.as_py()
                if text is None or not names:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                own = sizes(text, tools, shares)
                order = sorted(range(len(own)), key=lambda i: (own[i], i))
                langs.append(names[order[0]])
                scores.append(1.0 if len(own) == 1 else (own[order[1]] - own[order[0]]) / own[order[1]])
            columns = [batch.column(i) for i in range(n_kept)]
            columns += [pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                        pa.array([s < MIN_MARGIN for s in scores], pa.bool_())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return slim.mapInArrow(run, out_schema)
