"""Byte-level BPE encoding and decoding by forced boundaries.

Merges only ever build vocabulary tokens, so two neighbouring bytes that stand side by side in no token of the
vocabulary can never be merged into one: between them a cut is certain. Each pre-token is cut there, the fragments are
encoded independently (and remembered, for they recur), and their ids are concatenated.
"""

from __future__ import annotations

import heapq
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: the published split of byte-level vocabularies: contractions, letters, numbers, other signs, white space
PRE_TOKEN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: entries of one generation of what a worker remembers
REMEMBERED = 250_000
#: fragments up to so many bytes are merged without a heap
SHORT = 48
NO_MERGE = (1 << 40, -1)
#: bytes of text and ids handed back at a time
BATCH_BYTES = 4_000_000


def byte_letters() -> dict[str, int]:
    """The public letter for each byte: printable ones stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class _Memo(dict):
    """A dict that computes what it lacks; when full, it becomes the old generation from which it is refilled."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        value = self[key] = self.old[key] if key in self.old else self.make(key)
        return value


class ByteBpe:
    """Encoder and decoder for a vocabulary file of the ``tokenizers`` library (byte-level BPE)."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if (model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]
                or spec["normalizer"] or model.get("ignore_merges") or model.get("byte_fallback")
                or any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))):
            raise ValueError("only plain byte-level BPE vocabularies are understood")
        letters = byte_letters()
        spelled = {t: bytes(letters[c] for c in t) for t in model["vocab"] if all(c in letters for c in t)}
        self.tokens: list[bytes] = [b""] * (1 + max([*model["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]))
        for t, b in spelled.items():
            self.tokens[model["vocab"][t]] = b
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t, i in self.added.items():
            self.tokens[i] = t.encode()
        self.added_pattern = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")")
        pairs = (m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"])
        ids = model["vocab"]
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.merged = [m[1] for m in self.merges.values()]
        byte_of = {b: t for t, b in letters.items()}
        self.byte_ids = [ids[byte_of[b]] for b in range(256)]
        self.joined = {p for b in spelled.values() for p in zip(b, b[1:])}  # byte pairs inside some token
        self.fragments = _Memo(self._encode_fragment)
        self.pieces = _Memo(self._encode_piece)
        # a word is None, and the text encoded in one piece, where white space stands beside white space
        self.words = _Memo(lambda w: None if not w or w[0].isspace() or w[-1].isspace() else self._encode_plain(" " + w))
        self.firsts = _Memo(lambda w: None if not w or w[0].isspace() or w[-1].isspace() else self._encode_plain(w))
        self.newline = self._encode_plain("\n")
        self.lengths = np.array([len(t) for t in self.tokens])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)

    def _encode_fragment(self, fragment: bytes) -> bytes:
        """Merge the best-ranked pair, leftmost first, until none is left."""
        ids, merges = [self.byte_ids[b] for b in fragment], self.merges
        if len(ids) > SHORT:
            return self._encode_long(ids)
        ranks = [merges.get(p, NO_MERGE)[0] for p in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < NO_MERGE[0]:
            i = ranks.index(best)
            ids[i:i + 2] = [self.merged[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = merges.get((ids[i - 1], ids[i]), NO_MERGE)[0]
            if i < len(ranks):
                ranks[i] = merges.get((ids[i], ids[i + 1]), NO_MERGE)[0]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode_long(self, ids: list[int]) -> bytes:
        """The same by a heap of pairs, so that a word of any length costs n log n."""
        n, merges = len(ids), self.merges
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, m[1], ids[i], ids[i + 1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, merged, left, right = heapq.heappop(heap)
            j = following[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one side has been merged meanwhile
            ids[i], ids[j] = merged, -1
            k = following[i] = following[j]
            if k < n:
                before[k] = i
                if m := merges.get((merged, ids[k])):
                    heapq.heappush(heap, (m[0], i, m[1], merged, ids[k]))
            if (h := before[i]) >= 0 and (m := merges.get((ids[h], merged))):
                heapq.heappush(heap, (m[0], h, m[1], ids[h], merged))
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def _encode_piece(self, piece: str) -> bytes:
        raw, start, out = piece.encode(), 0, []
        if self.joined.issuperset(zip(raw, raw[1:])):
            return self._encode_fragment(raw)
        for i, pair in enumerate(zip(raw, raw[1:]), 1):
            if pair not in self.joined:
                out.append(self.fragments[raw[start:i]])
                start = i
        out.append(self.fragments[raw[start:]])
        return b"".join(out)

    def _encode_plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, PRE_TOKEN.findall(text)))

    def _encode_words(self, text: str) -> bytes:
        """A single space or line break between two other characters always begins a pre-token."""
        lines = []
        try:
            for line in text.split("\n"):
                first, *words = line.split(" ")
                lines.append(b"".join([self.firsts[first], *map(self.words.__getitem__, words)]))
        except TypeError:
            return self._encode_plain(text)
        return self.newline.join(lines)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; strings of added tokens become their ids."""
        if not any(t in text for t in self.added):
            return self._encode_words(text)
        parts = self.added_pattern.split(text)
        return b"".join(np.array([self.added[p]], "<u4").tobytes() if i % 2 else self._encode_words(p)
                        for i, p in enumerate(parts))

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 bytes; what is not valid UTF-8 becomes replacement characters."""
        numbers = np.frombuffer(ids, "<u4")
        lengths = self.lengths[numbers]
        places = np.arange(lengths.sum()) + np.repeat(self.starts[numbers] - np.cumsum(lengths) + lengths, lengths)
        return self.blob[places].tobytes().decode("utf-8", "replace").encode()


_LOADED: dict[int, ByteBpe] = {}


def loaded(vocabulary: str) -> ByteBpe:
    """One encoder for each worker process, so that what it remembers serves all its tasks."""
    key = hash(vocabulary)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBpe(vocabulary)
    return _LOADED[key]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    columns, held = [[] for _ in schema], 0
    for row in rows:
        for column, value in zip(columns, row):
            column.append(value)
            held += len(value) if isinstance(value, bytes) else 8
        if held >= BATCH_BYTES:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            columns, held = [[] for _ in schema], 0
    if columns[0]:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _mapped(df: DataFrame, vocabulary: str, keep: list[str], source: str, step, added: list[tuple[str, pa.DataType]]) -> DataFrame:
    """Run ``step(bpe, value) -> tuple`` on the binary column ``source``; ``keep`` columns pass through."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BinaryType, StructField, StructType

    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    slim = df.select(*[F.col(f"`{c}`") for c in keep], source.alias("_source"))
    out_schema = StructType([*slim.schema.fields[:-1], *[StructField(name, BinaryType()) for name, _ in added]])
    arrow = to_arrow_schema(out_schema)
    n_kept = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(shared.value)

        def rows():
            for batch in batches:
                kept = [batch.column(i) for i in range(n_kept)]
                for i, value in enumerate(batch.column(n_kept)):
                    yield (*(c[i].as_py() for c in kept), *step(bpe, value.as_py()))

        return _in_batches(rows(), arrow)

    return slim.mapInArrow(run, out_schema)


def round_trip(docs: DataFrame, vocabulary: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, ``ids`` (packed little-endian unsigned 32-bit) and ``decoded`` (UTF-8 bytes), in one pass.

    Whole texts of any length. A null text counts as empty; an empty text has no ids; equal rows are encoded each
    for itself; an empty table gives no rows; columns not in ``keep`` are ignored.
    """
    def step(bpe, raw):
        ids = bpe.encode((raw or b"").decode("utf-8", "replace"))
        return ids, bpe.decode(ids)

    return _mapped(docs, vocabulary, keep, F.col(text_col).cast("string").cast("binary"), step,
                   [("ids", pa.binary()), ("decoded", pa.binary())])


def encode(docs: DataFrame, vocabulary: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``ids``; see ``round_trip``."""
    return _mapped(docs, vocabulary, keep, F.col(text_col).cast("string").cast("binary"),
                   lambda bpe, raw: (bpe.encode((raw or b"").decode("utf-8", "replace")),), [("ids", pa.binary())])


def decode(encoded: DataFrame, vocabulary: str, keep: list[str], ids_col: str = "ids") -> DataFrame:
    """``keep`` columns and ``decoded``, the text of packed ids; null ids count as none."""
    return _mapped(encoded, vocabulary, keep, F.col(ids_col), lambda bpe, ids: (bpe.decode(ids or b""),),
                   [("decoded", pa.binary())])
