"""N-gram Jaccard join by vertical partitioning, down to connected components.

All shingles have one global order, that of their 64-bit hashes. Texts with equal sets form one class.

Candidates come from the first fragment of the order: two sets that reach the similarity share a shingle among the
first n - ceil(0.85 n) + 1 of each. A shingle that very many sets begin with (a passage, a group of copies) is moved to
the end of the order; sets that begin a little further still have enough other shingles, and the few that do not are
matched in the unchanged order. Parities of the fragments bound the difference of a pair from below and drop most false
candidates. For those left, the order is cut into fragments, the overlap is counted in each fragment on its own and the
counts are summed per pair.

Only components are wanted, so every class is first compared with a few of those it shares shingles with, and then
only pairs that these links leave in different components are examined: a group of n near copies costs about n pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.components import components
from veritab.llm.staging import staged, unstage
from veritab.llm.textvec import mix, text_chunks, word_hashes

WORDS = 4
#: links have 100 * intersection >= PERCENT * union
PERCENT = 85
#: a shingle that more classes than this begin with goes to the end of the order
COMMON = 64
#: shingles of each set that are looked at, at least: a short text keeps enough rare ones beside a common passage
LOOKED_AT = 80
#: fragments whose parities bound a difference, and fragments in which overlaps are counted
ODD_FRAGMENTS, COUNT_FRAGMENTS = 2048, 8
ODD = [f"f{i}" for i in range(ODD_FRAGMENTS // 64)]
#: parities of the sums of four fragments each, which travel with every row
COARSE = [f"s{i}" for i in range(len(ODD) // 4)]
#: pairs that are compared in one task, about
CELL_PAIRS = 1_000
#: so many texts to fetch at most are broadcast by key
FEW_KEYS = 200_000

_MULTIPLIERS = np.array([0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than a shingle has make one shorter shingle."""
    words, counts = word_hashes(data, offsets)
    ends = np.cumsum(counts)
    rolled = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for j, m in enumerate(_MULTIPLIERS):
        rolled += words[j:j + len(rolled)] * m
    rolled = mix(rolled)
    out = []
    for n, end in zip(counts.tolist(), ends.tolist()):
        if n >= WORDS:
            out.append(np.unique(rolled[end - n:end - WORDS + 1]))
        else:
            short = words[end - n:end]
            out.append(mix((short * _MULTIPLIERS[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n)) if n else words[:0])
    return out


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """A row for each set, a bit for each fragment of the order: whether it holds an odd number of its shingles."""
    out = np.empty((len(sets), ODD_FRAGMENTS // 8), np.uint8)
    for bits, s in zip(out, sets):
        held = np.bincount((s >> np.uint64(53)).astype(np.int64), minlength=ODD_FRAGMENTS)
        bits[:] = np.packbits((held & 1).astype(np.uint8))
    return out.view(np.int64)


def needed(n):
    """The overlap that a set of n shingles needs with any partner, at least."""
    return -(-n * PERCENT // 100)


def _first_fragment(n: int) -> tuple[int, int]:
    """Shingles of a set of n that candidates are sought by, and how many of the order's first are looked at."""
    least = n - needed(n) + 1
    return least, min(n, max(least + least // 6 + 4, LOOKED_AT))


def _sets(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, th, n, least, cls, parities of fragments (a bit each), first shingles in order."""
    slim = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    id_type = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, data, offsets in text_chunks(batch.column(2)):
                sets = shingle_sets(data, offsets)
                n = np.array([len(s) for s in sets], np.int32)
                bounds = [_first_fragment(int(k)) if k else (0, 0) for k in n]
                first = [s[:b[1]].view(np.int64) for s, b in zip(sets, bounds)]
                packed = parities(sets)
                cls = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(start, stop - start), batch.column(1).slice(start, stop - start), pa.array(n),
                    pa.array([b[0] for b in bounds], pa.int32()), pa.array(cls),
                    *[pa.array(np.ascontiguousarray(packed[:, i])) for i in range(len(ODD))],
                    pa.ListArray.from_arrays(np.cumsum([0, *map(len, first)]).astype(np.int32),
                                             pa.array(np.concatenate(first)))],
                    ["doc_id", "th", "n", "least", "cls", *ODD, "first"])

    return slim.mapInArrow(
        run, f"doc_id {id_type}, th long, n int, least int, cls long, {', '.join(f'{c} long' for c in ODD)}, first array<long>")


def _least_overlap(a: str, b: str) -> Column:
    return F.ceil((F.col(f"{a}.n") + F.col(f"{b}.n")) * PERCENT / F.lit(100.0 + PERCENT) - 1e-9)


def _may_link(a: str, b: str, parities: list[str]) -> Column:
    """Whether sizes, and parities of the fragments, of two classes allow a link.

    What two sets share adds equally to a fragment of both, so a fragment that is odd in one and even in the other
    holds at least one shingle of their difference.
    """
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    lengths = (100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb))
    apart = sum((F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in parities), F.lit(0))
    return lengths & (apart <= na + nb - 2 * _least_overlap(a, b))


def _pruned(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes whose sizes and parities allow a link, with the sizes na and nb and the first shingle of a."""
    left = classes.select(F.col("cls").alias("a"), F.struct("n", "low", *ODD).alias("ca"))
    right = classes.select(F.col("cls").alias("b"), F.struct("n", *ODD).alias("cb"))
    both = pairs.join(left, "a").join(right, "b").where(_may_link("ca", "cb", ODD))
    return both.select("a", "b", F.col("ca.n").alias("na"), F.col("cb.n").alias("nb"), F.col("ca.low").alias("low"))


def _fragments(docs: DataFrame, members: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, fragment, shingles) of the classes ``wanted``, computed from one text of each."""
    chosen = members.where("n > 0").join(wanted, "cls", "left_semi").groupBy("cls").agg(
        F.min(F.struct("th", F.col("doc_id").isNull().alias("_no_id"), "doc_id")).alias("_one"))
    chosen = staged(chosen.select("cls", "_one.th", F.col("_one.doc_id").alias("_chosen")), "jaccard-chosen")
    few = chosen.count() <= FEW_KEYS
    rows = docs.withColumn("th", F.xxhash64("text")).join(F.broadcast(chosen) if few else chosen, "th")
    rows = rows.where(F.col("doc_id").eqNullSafe(F.col("_chosen"))).select("cls", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, _, data, offsets in text_chunks(batch.column(1)):
                ids, numbers, parts = [], [], []
                for i, s in enumerate(shingle_sets(data, offsets)):
                    cuts = np.searchsorted(s >> np.uint64(61), np.arange(COUNT_FRAGMENTS + 1))
                    for f in range(COUNT_FRAGMENTS):
                        ids.append(batch.column(0)[start + i].as_py())
                        numbers.append(f)
                        parts.append(s[cuts[f]:cuts[f + 1]].tobytes())
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(parts, pa.binary())],
                                      ["cls", "fragment", "shingles"])

    parts = staged(rows.mapInArrow(run, "cls long, fragment int, shingles binary"), "jaccard-fragments")
    unstage(chosen)
    return parts


def _count(rows: pd.DataFrame) -> pd.DataFrame:
    """Partial overlaps in one fragment of a cell, from its pairs and the shingles of its classes."""
    held = rows["shingles"].notna()
    sets = {c: np.frombuffer(x, np.uint64) for c, x in zip(rows["a"][held], rows["shingles"][held])}
    pairs, shared = rows[~held], []
    for a, b in zip(pairs["a"], pairs["b"]):
        mine, theirs = sets[a], sets[b]
        at = np.searchsorted(mine, theirs)
        shared.append(int((mine[np.minimum(at, len(mine) - 1)] == theirs).sum()) if len(mine) and len(theirs) else 0)
    return pd.DataFrame({"a": pairs["a"], "b": pairs["b"], "shared": np.array(shared, np.int64)})


def _linked(docs: DataFrame, members: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b, na, nb, low) that reach the similarity: overlaps counted by fragment and summed per pair.

    Pairs are dealt by the first shingle of a, which similar sets mostly share, so that a class travels to few cells;
    the pairs of a shingle that very many have are dealt over a square of blocks.
    """
    pairs = staged(pairs, "jaccard-pairs")
    wanted = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    parts = _fragments(docs, members, wanted)
    blocks = pairs.groupBy("low").agg(F.ceil(F.sqrt(F.count(F.lit(1)) / CELL_PAIRS)).cast("long").alias("_side"))
    side = lambda c: F.pmod(F.xxhash64(c), F.col("_side"))
    cells = max(1, pairs.count() // CELL_PAIRS)
    placed = pairs.join(blocks, "low").withColumn("cell", F.pmod(F.xxhash64("low", side("a"), side("b")), F.lit(cells)))
    sets = placed.select("cell", F.explode(F.array("a", "b")).alias("cls")).distinct().join(parts, "cls")
    asked = placed.select("cell", "a", "b", F.explode(F.sequence(F.lit(0), F.lit(COUNT_FRAGMENTS - 1))).alias("fragment"))
    rows = asked.withColumn("shingles", F.lit(None).cast("binary")).unionByName(sets.select(
        "cell", F.col("cls").alias("a"), F.col("cls").alias("b"), "fragment", "shingles"))
    counted = rows.groupBy("cell", "fragment").applyInPandas(_count, "a long, b long, shared long")
    summed = counted.groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    reach = (100 + PERCENT) * F.col("shared") >= PERCENT * (F.col("na") + F.col("nb"))
    links = staged(pairs.join(summed, ["a", "b"]).where(reach).select("a", "b"), "jaccard-links")
    unstage(pairs, parts)
    return links


def _runs(members: DataFrame) -> DataFrame:
    """(t, cls, pos, m): shingles that m > 1 classes begin with, at place pos of theirs; equal sets are one class
    before anything is dealt by shingle."""
    one = members.where("n > 0").groupBy("cls").agg(F.first("first").alias("first"))
    tokens = one.select("cls", F.posexplode("first").alias("pos", "t"))
    often = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    return staged(tokens.join(often, "t").select("t", "cls", "pos", "m"), "jaccard-runs")


def _stars(runs: DataFrame, drawn: Column) -> DataFrame:
    """Every class of a run paired with the class of the run that ``drawn`` puts first."""
    least = runs.groupBy("t").agg(F.min_by("cls", drawn).alias("a"))
    pairs = runs.join(least, "t").where("cls <> a")
    return pairs.select(F.least("cls", "a").alias("a"), F.greatest("cls", "a").alias("b")).distinct()


def similarity_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``th`` (digest of the text), ``n_shingles``, ``cls`` (its set) and ``component_id``.

    The component id is the smallest id that links reach. Texts without words (null or empty ones too) have no
    shingles and are a component of their own, with their own id. Rows with equal sets are linked; a null id takes
    part and never is the smallest, unless all are null. Whole texts, ties, repeated rows and empty tables need no
    care; other columns are ignored. Sets and shingles are told apart by 64-bit hashes.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    members = staged(_sets(docs), "jaccard-members")
    classes = members.where("n > 0").groupBy("cls").agg(
        *[F.first(c).alias(c) for c in ("n", "least", *ODD)], F.first(F.size("first")).alias("looked"),
        F.first(F.get("first", F.lit(0))).alias("low"))
    fours = {s: F.col(ODD[4 * i]).bitwiseXOR(F.col(ODD[4 * i + 1])).bitwiseXOR(F.col(ODD[4 * i + 2])).bitwiseXOR(F.col(ODD[4 * i + 3]))
             for i, s in enumerate(COARSE)}
    classes = staged(classes.withColumns(fours), "jaccard-classes")
    runs = _runs(members)
    common = runs.where(F.col("m") > COMMON)
    moved = staged(common.groupBy("cls").agg(F.count(F.lit(1)).alias("moved")), "jaccard-moved")
    # classes left with too few shingles when the common ones go to the end of the order
    bare = staged(moved.join(classes.select("cls", "least", "looked"), "cls").where("looked - moved < least").select("cls"),
                  "jaccard-bare")
    bare_runs = staged(common.join(bare, "cls", "left_semi").select("t", "cls", "m"), "jaccard-bare-runs")
    # in groups that share their shingles, another class is drawn by each shingle, so that each is compared with many
    near = _stars(runs.where(F.col("m") <= COMMON), F.col("cls")).unionByName(
        _stars(bare_runs, F.xxhash64("cls", "t"))).distinct()
    links = _linked(docs, members, _pruned(near, classes))
    grouped = staged(components(links), "jaccard-groups")

    # what the first links left apart: pairs of one run in different components
    told = runs.join(grouped.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "component", F.coalesce("component", "cls"))
    mixed = told.groupBy("t").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).where(
        "_low <> _high").select("t")
    told = told.join(mixed, "t", "left_semi").join(classes.select("cls", "n", "least", *COARSE), "cls")
    # without the common shingles a place is by at most their number nearer to the beginning
    told = told.join(moved, "cls", "left").withColumn("pos", F.when(F.col("m") > COMMON, F.col("pos")).otherwise(
        F.greatest(F.lit(0), F.col("pos") - F.coalesce("moved", F.lit(0))))).where("pos < least")
    asked = bare_runs.select("t").distinct().withColumn("_asked", F.lit(True))
    told = told.join(asked, "t", "left").where((F.col("m") <= COMMON) | F.col("_asked"))
    told = told.join(bare.withColumn("bare", F.lit(True)), "cls", "left")
    # sets that may be similar have sizes in the same step of 1 / 0.85, or in neighbouring ones
    told = staged(told.drop("moved", "least", "_asked").withColumn(
        "step", F.floor(F.log("n") / np.log(100 / PERCENT)).cast("int")), "jaccard-told")
    rest = told.where(F.col("m") <= COMMON)
    steps = F.explode(F.array(F.col("step") - 1, F.col("step"), F.col("step") + 1))
    many = told.where(F.col("m") > COMMON)
    many = many.join(many.where("bare").withColumn("step", steps).select("t", "step").distinct(), ["t", "step"], "left_semi")
    # near copies share most of what they begin with: a pair is made once, at the first shingle that both have
    firsts = members.where("n > 0").join(many.select("cls").distinct(), "cls", "left_semi").groupBy("cls").agg(F.first("first").alias("first"))
    many = staged(many.join(firsts, "cls").withColumn("before", F.slice("first", F.lit(1), F.col("pos"))).drop("first"), "jaccard-many")
    near_steps = many.where("bare").withColumn("step", steps)
    # at the first shingle that two sets share, what follows it in both must hold the rest of the overlap
    follows = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) >= _least_overlap("x", "y")
    apart = (F.col("x.component") != F.col("y.component")) & follows & _may_link("x", "y", COARSE) & (F.col("x.t") == F.col("y.t"))
    pair = lambda x, y, rule: x.alias("x").join(y.alias("y"), apart & rule).select(
        F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b"))
    far = pair(rest, rest, F.col("x.cls") < F.col("y.cls")).unionByName(
        pair(near_steps, many, (F.col("x.cls") != F.col("y.cls")) & (F.col("x.step") == F.col("y.step"))
             & ~F.arrays_overlap("x.before", "y.before"))).distinct()
    links = links.unionByName(_linked(docs, members, _pruned(far, classes)))
    grouped = components(links).withColumnRenamed("node", "cls")
    placed = members.select("doc_id", "th", "n", "cls").join(grouped, "cls", "left").withColumn(
        "component", F.coalesce("component", "cls"))
    placed = staged(placed, "jaccard-placed")
    unstage(members, classes, runs, moved, bare, bare_runs, told, many)
    least = placed.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("_least"))
    return placed.join(least, "component", "left").select(
        "doc_id", "th", F.col("n").cast("long").alias("n_shingles"), "cls",
        F.when(F.col("n") > 0, F.col("_least")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, the one of the smallest id (of equal ids, the smallest text digest).

    Rows without words all stay. Of repeated rows one stays.
    """
    found = similarity_components(docs, id_col, text_col).where("n_shingles > 0")
    chosen = found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("cls")).alias("_set")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "th")).alias("_one"))
    chosen = chosen.select(F.coalesce(F.col("_one.doc_id").cast("string"), F.lit("~")).alias("_key"), F.col("_one.th").alias("_th")).distinct()
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.xxhash64(text).alias("_th"),
                       F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("~")).alias("_key"),
                       text.rlike(r"[^\x20\x09-\x0D]").alias("_worded"))
    kept = rows.where("_worded").join(chosen, ["_key", "_th"], "left_semi").withColumn(
        "_copy", F.row_number().over(Window.partitionBy("_key", "_th").orderBy(F.lit(0)))).where("_copy = 1")
    return kept.select("_row").unionByName(rows.where("NOT _worded").select("_row")).select("_row.*")
