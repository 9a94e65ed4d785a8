"""Phrase collocations by a sort of suffix pointers that is spread over the cluster.

Every word of a text begins a suffix, which is looked at to a depth of four words inside its piece. A first pass counts
the words and the load of every leading pair of words. Then the suffixes are routed by their leading words: those of a
pair go to one task, and only the suffixes of overfull pairs are dealt by all their words. In each task a multikey
three-way quicksort partitions the pointers word by word; the size of an equal partition is the count of the phrase it
stands for, and a partition that is smaller than the least count is abandoned unsorted. Counts of overfull pairs, which
several tasks hold in part, are abandoned only once they are summed.

Words travel as 64-bit hashes; the table of all words tells whether two share one, and then another hash is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.staging import staged
from veritab.llm.textvec import mix

DEPTH = 4
LEAST_COUNT = 30
#: a phrase goes if a longer candidate around it has this share of its count
ABSORBED_PERCENT = 80
TOP = 2000
SCALE = 2_000_000
#: suffixes that a task sorts, about; a pair of leading words with half as many is dealt by all words
TASK_SUFFIXES = 1 << 19
#: leading pairs are told apart by so many loads
LOADS = 1 << 16
#: frequent words are told from others by so many bits, of which some may be set by two words
WORD_BITS = 1 << 20
#: bytes of text taken at a time; a longer text is cut between pieces
CHUNK_BYTES = 2_000_000
#: partitions of fewer pointers are counted without further pivots
SMALL = 48

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0: between words, 1: between pieces, 2: in a word
_KIND = np.full(256, 2, np.uint8)
_KIND[[9, 32]] = 0
_KIND[[*b".,;:!?", *range(10, 14)]] = 1
COLUMNS = [f"w{i}" for i in range(DEPTH)]


class _Words:
    """Words of a run of texts: hashes, first and last byte, the text each stands in, and whether a piece ends after it."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, seed: int):
        kind = _KIND[data]
        inside = kind == 2
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begun = offsets[:-1][offsets[:-1] < len(data)]
        first[begun] = inside[begun]
        self.starts = np.flatnonzero(first)
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        before = offsets[1:-1]
        before = before[(before > 0) & (before < len(data) + 1)] - 1
        last[before] = inside[before]
        self.stops = np.flatnonzero(last) + 1
        lengths = self.stops - self.starts
        random = np.random.default_rng(seed)
        values = random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        step = random.integers(0, 1 << 61, dtype=np.uint64) * np.uint64(8) + np.uint64(5)
        powers = np.full(int(lengths.max(initial=0)) + 1, step, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        letters = np.flatnonzero(inside)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        sums = values[_LOWER[data[letters]]] * powers[place]
        sums = np.add.reduceat(sums, np.cumsum(lengths) - lengths) if len(lengths) else sums
        self.hashes = np.maximum(mix(sums ^ (lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))), np.uint64(1))
        self.texts = np.searchsorted(offsets, self.starts, "right") - 1
        breaks = np.cumsum(kind == 1)
        self.ends_piece = np.ones(len(self.starts), bool)
        self.ends_piece[:-1] = (self.texts[1:] != self.texts[:-1]) | (breaks[self.starts[1:]] != breaks[self.starts[:-1]])


def _cut_between_pieces(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and languages with texts longer than a chunk taken as several, cut behind ends of pieces."""
    cuts, owners = [], []
    for i in np.flatnonzero(np.diff(offsets) > CHUNK_BYTES):
        at = int(offsets[i])
        while int(offsets[i + 1]) - at > CHUNK_BYTES:
            window = at + CHUNK_BYTES
            ends = np.flatnonzero(_KIND[data[window:min(window + CHUNK_BYTES, int(offsets[i + 1]))]] == 1)
            if len(ends):
                cuts.append(window + int(ends[0]) + 1)
                owners.append(codes[i])
            at = cuts[-1] if len(ends) else window
    if not cuts:
        return offsets, codes
    whole = np.append(offsets[:-1], cuts)
    order = np.argsort(whole, kind="stable")
    return np.append(whole[order], offsets[-1]), np.append(codes, owners)[order]


def _chunks(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[tuple[np.ndarray, list, np.ndarray, _Words]]:
    """Bytes, languages, language of each word (a number) and words, of about ``CHUNK_BYTES`` of texts."""
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        coded = batch.column(0).dictionary_encode()
        offsets, codes = _cut_between_pieces(data, offsets, coded.indices.to_numpy(zero_copy_only=False))
        first = 0
        while first < len(codes):
            last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
            last = min(max(first + 1, last), len(codes))
            part = data[offsets[first]:offsets[last]]
            if len(part):
                words = _Words(part, offsets[first:last + 1] - offsets[first], seed)
                yield part, coded.dictionary.to_pylist(), codes[first:last][words.texts], words
            first = last


def _followers(words: _Words) -> np.ndarray:
    """Four rows of hashes: the word that begins a suffix and the three after it; 0 beyond the end of the piece."""
    out = np.zeros((DEPTH, len(words.hashes)), np.uint64)
    out[0] = words.hashes
    open_ = np.ones(len(words.hashes), bool)
    for d in range(1, DEPTH):
        # a suffix goes on while the word before is not the last of its piece
        open_ = open_ & ~np.append(words.ends_piece, np.ones(d, bool))[d - 1:d - 1 + len(open_)]
        follows = np.append(words.hashes, np.zeros(d, np.uint64))[d:]
        out[d] = np.where(open_, follows, np.uint64(0))
    return out


def _lang_key(lang: str) -> np.uint64:
    import xxhash

    return np.uint64(xxhash.xxh64_intdigest(lang.encode()))


def _pair_key(keys: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    return mix(keys ^ mix(suffixes[0]) + np.uint64(3) * suffixes[1])


def _words_and_loads(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, id, word, n) of the words of each chunk of texts; rows without a language give loads of leading pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads = np.zeros(LOADS, np.int64)
        names = ["lang", "id", "word", "n"]
        for data, langs, codes, words in _chunks(batches, seed):
            raw, suffixes = data.tobytes(), _followers(words)
            for code in np.unique(codes):
                own = np.flatnonzero(codes == code)
                key = _pair_key(_lang_key(langs[code]), suffixes[:, own][:, suffixes[1][own] > 0])
                loads += np.bincount((key % np.uint64(LOADS)).astype(np.int64), minlength=LOADS)
                ids, at, n = np.unique(words.hashes[own], return_index=True, return_counts=True)
                at = own[at]
                spelt = [raw[a:b].lower() for a, b in zip(words.starts[at].tolist(), words.stops[at].tolist())]
                yield pa.record_batch([pa.array([langs[code]] * len(ids), pa.string()), pa.array(ids.view(np.int64)),
                                       pa.array(spelt, pa.binary()), pa.array(n.astype(np.int64))], names)
        full = np.flatnonzero(loads)
        yield pa.record_batch([pa.nulls(len(full), pa.string()), pa.array(full.astype(np.int64)),
                               pa.nulls(len(full), pa.binary()), pa.array(loads[full])], names)

    return docs.mapInArrow(run, "lang string, id long, word binary, n long")


def _suffix_blocks(docs: DataFrame, seed: int, word_bits: np.ndarray, overfull: np.ndarray, routes: int) -> DataFrame:
    """(route, lang, suffixes, counts): the suffixes of each chunk that go to one task, sorted and each once.

    A suffix ends before a word that is not frequent, and one without a second word is of no use.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(word_bits).astype(bool)
        dealt = np.zeros(LOADS, bool)
        dealt[overfull] = True
        for _, langs, codes, words in _chunks(batches, seed):
            frequent = bits[(words.hashes % np.uint64(WORD_BITS)).astype(np.int64)]
            suffixes = _followers(words)
            held = frequent.copy()
            for d in range(1, DEPTH):
                held = held & np.append(frequent, np.zeros(d, bool))[d:]
                suffixes[d][~held] = 0
            useful = np.flatnonzero(frequent & (suffixes[1] > 0))
            columns = {name: [] for name in ("route", "lang", "suffixes", "counts")}
            for code in np.unique(codes[useful]):
                own = suffixes[:, useful[codes[useful] == code]]
                pair = _pair_key(_lang_key(langs[code]), own)
                whole = mix(pair + mix(own[2]) + np.uint64(5) * own[3])
                spread = dealt[(pair % np.uint64(LOADS)).astype(np.int64)]
                route = (mix(np.where(spread, whole, pair)) % np.uint64(routes)).astype(np.int64)
                order = np.lexsort((*own[::-1], route))
                own, route = own[:, order], route[order]
                new = np.ones(len(route), bool)
                new[1:] = (own[:, 1:] != own[:, :-1]).any(axis=0) | (route[1:] != route[:-1])
                at = np.flatnonzero(new)
                counts = np.diff(at, append=len(route))
                own, route = own[:, at], route[at]
                cuts = np.flatnonzero(np.append(True, route[1:] != route[:-1]))
                for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(route)]):
                    for name, value in zip(columns, (int(route[a]), langs[code], own[:, a:b].tobytes(),
                                                     counts[a:b].astype(np.uint32).tobytes())):
                        columns[name].append(value)
            types = (pa.int64(), pa.string(), pa.binary(), pa.binary())
            yield pa.record_batch([pa.array(v, t) for v, t in zip(columns.values(), types)], list(columns))

    return docs.mapInArrow(run, "route long, lang string, suffixes binary, counts binary")


def partition_sizes(suffixes: np.ndarray, counts: np.ndarray, least: int, partial: np.ndarray) -> dict[tuple, int]:
    """Counts of the phrases of two to four words that begin the suffixes, by multikey three-way quicksort of pointers.

    ``suffixes`` has a row for each depth, 0 after the last word; ``counts`` says how often each stands. Partitions of
    less than ``least`` are abandoned, except where ``partial`` marks suffixes whose shorter phrases are counted by
    other tasks too.
    """
    found: dict[tuple, int] = {}
    stack = [(np.arange(suffixes.shape[1]), 0, bool(partial.any()))]
    while stack:
        pointers, depth, shared = stack.pop()
        keys = suffixes[depth][pointers]
        if len(pointers) > SMALL:
            low, pivot, high = sorted((keys[0], keys[len(keys) // 2], keys[-1]))
            sides = ((keys < pivot, 0), (keys == pivot, 1), (keys > pivot, 0))
            parts = [(pointers[side], deeper) for side, deeper in sides]
        else:
            order = np.argsort(keys, kind="stable")
            cuts = np.flatnonzero(keys[order][1:] != keys[order][:-1]) + 1
            parts = [(p, 1) for p in np.split(pointers[order], cuts)]
        for part, deeper in parts:
            if not len(part):
                continue
            size = int(counts[part].sum())
            kept = shared and bool(partial[part].any())
            # phrases of all words are in one task, whatever their route
            if size < least and not (kept and depth + deeper < DEPTH):
                continue
            if not deeper:
                stack.append((part, depth, kept))
            elif suffixes[depth][part[0]]:
                if depth:
                    phrase = tuple(suffixes[:depth + 1, part[0]].tolist())
                    found[phrase] = size
                if depth + 1 < DEPTH:
                    stack.append((part, depth + 1, kept))
    return found


def _sorted_route(rows: pd.DataFrame, overfull: np.ndarray, least: int) -> pd.DataFrame:
    """Phrase counts of one route; ``rows`` are blocks of suffixes from many chunks."""
    out = {name: [] for name in ("lang", *COLUMNS, "n")}
    dealt = np.zeros(LOADS, bool)
    dealt[overfull] = True
    for lang, blocks in rows.groupby("lang"):
        suffixes = np.concatenate([np.frombuffer(b, np.uint64).reshape(DEPTH, -1) for b in blocks["suffixes"]], axis=1)
        counts = np.concatenate([np.frombuffer(b, np.uint32) for b in blocks["counts"]]).astype(np.int64)
        partial = dealt[(_pair_key(_lang_key(lang), suffixes) % np.uint64(LOADS)).astype(np.int64)]
        for phrase, n in partition_sizes(suffixes, counts, least, partial).items():
            out["lang"].append(lang)
            for name, word in zip(COLUMNS, (*phrase, *[0] * (DEPTH - len(phrase)))):
                out[name].append(word - (1 << 64) if word >> 63 else word)
            out["n"].append(n)
    return pd.DataFrame({k: pd.Series(v, dtype="object" if k == "lang" else "int64") for k, v in out.items()})


def phrase_counts(docs: DataFrame, least: int = LEAST_COUNT, lang_col: str = "lang",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Words (lang, id, word, n) and phrases (lang, w0 to w3: ids, 0 after the last; n >= ``least``), as written tables."""
    slim = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    for seed in range(1, 9):
        counted = _words_and_loads(slim, seed).groupBy("lang", "id").agg(
            F.sum("n").alias("n"), F.min("word").alias("word"), (F.min("word") != F.max("word")).alias("shared"))
        words = staged(counted, "collocation-words")
        if not words.where("shared").take(1):
            break
    else:
        raise ValueError("words share hashes under every seed")
    loads = words.where("lang IS NULL")
    words = words.where("lang IS NOT NULL").select("lang", "id", F.col("word").cast("string").alias("word"), "n")
    total = words.agg(F.sum("n")).first()[0] or 0
    overfull = np.array([r["id"] for r in loads.where(F.col("n") > TASK_SUFFIXES // 2).select("id").collect()], np.int64)
    # the hashes are unsigned where they are cut to a bit's number, hence the two's complement of the low bits
    frequent = words.where(F.col("n") >= least).select(F.col("id").bitwiseAND(F.lit(WORD_BITS - 1)).alias("bit")).distinct()
    bits = np.zeros(WORD_BITS, bool)
    bits[[r["bit"] for r in frequent.collect()]] = True
    routes = max(1, -(-total // TASK_SUFFIXES))
    blocks = _suffix_blocks(slim, seed, np.packbits(bits), overfull, routes)
    schema = f"lang string, {', '.join(f'{c} long' for c in COLUMNS)}, n long"
    sizes = blocks.groupBy("route").applyInPandas(lambda rows: _sorted_route(rows, overfull, least), schema)
    phrases = sizes.groupBy("lang", *COLUMNS).agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return words, staged(phrases, "collocation-phrases")


def _part(start: int, stop: int) -> list:
    """The words ``start`` to ``stop`` of a phrase as a phrase of its own."""
    return [F.col(COLUMNS[start + i]) if start + i < stop else F.lit(0).cast("long") for i in range(DEPTH)]


def _named(columns: list) -> list:
    return [c.alias(name) for c, name in zip(columns, COLUMNS)]


def scored_phrases(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """Phrases with ``a``, and ``l``, ``r`` and ``score`` of the cut of the lowest score (ties: the earliest cut)."""
    counts = phrases.unionByName(words.select("lang", F.col("id").alias("w0"), *[F.lit(0).cast("long").alias(c) for c in COLUMNS[1:]], "n"))
    size = sum((F.when(F.col(c) != 0, 1).otherwise(0) for c in COLUMNS), F.lit(0))
    cuts = []
    for m in range(2, DEPTH + 1):
        for k in range(1, m):
            for side, part in (("l", _part(0, k)), ("r", _part(k, m))):
                cuts.append(F.when(size == m, F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), F.struct(*_named(part)).alias("part"))))
    asked = phrases.select("lang", F.struct(*COLUMNS).alias("phrase"), F.col("n").alias("a"),
                           F.explode(F.filter(F.array(*cuts), lambda x: x.isNotNull())).alias("cut"))
    asked = asked.select("lang", "phrase", "a", "cut.k", "cut.side", "cut.part.*")
    answered = asked.join(counts, ["lang", *COLUMNS])
    both = answered.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("side") == "l", F.col("n"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("n"))).alias("r"))
    score = F.expr(f"CAST(a AS DECIMAL(19,0)) * {SCALE} div (l + r)")
    lowest = both.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
    return lowest.select("lang", "phrase.*", "a", "low.l", "low.r", "low.score")


def without_absorbed(scored: DataFrame, phrases: DataFrame, percent: int = ABSORBED_PERCENT) -> DataFrame:
    """``scored`` without the phrases that a longer one holds in ``percent`` or more of their occurrences."""
    size = sum((F.when(F.col(c) != 0, 1).otherwise(0) for c in COLUMNS), F.lit(0))
    inner = [F.when(size == m, F.struct(*_named(_part(i, i + length)))) for m in range(3, DEPTH + 1)
             for length in range(2, m) for i in range(m - length + 1)]
    held = phrases.select("lang", "n", F.explode(F.filter(F.array(*inner), lambda x: x.isNotNull())).alias("part"))
    most = held.groupBy("lang", "part").agg(F.max("n").alias("most")).select("lang", "part.*", "most")
    absorbed = F.col("most").cast("decimal(19,0)") * 100 >= F.col("a").cast("decimal(19,0)") * percent
    return scored.join(most, ["lang", *COLUMNS], "left").where(~F.coalesce(absorbed, F.lit(False))).drop("most")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, top: int = TOP, lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """Per language the ``top`` phrases of two to four words: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``,
    ``score``; by score, then count, then the phrase in byte order.

    A null language is ``und``, together with rows that say so; null and empty texts have no words; whole texts of any
    length; repeated rows count each time; an empty table, or one without frequent phrases, gives no rows; other
    columns are ignored.
    """
    words, phrases = phrase_counts(docs, least, lang_col, text_col)
    scored = without_absorbed(scored_phrases(words, phrases), phrases)
    by_score = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    first = staged(scored.withColumn("_at", F.rank().over(by_score)).where(F.col("_at") <= top).drop("_at"), "collocation-first")
    spelt = first.select("lang", *COLUMNS, F.posexplode(F.array(*COLUMNS)).alias("place", "id")).where("id <> 0")
    spelt = spelt.join(words.drop("n"), ["lang", "id"]).groupBy("lang", *COLUMNS).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    ordered = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    out = first.join(spelt, ["lang", *COLUMNS]).withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= top)
    return out.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
