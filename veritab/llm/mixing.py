"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's shuffled documents are laid end to end and cut into blocks of equally many words, blocks of about the
same length in all sources. The target of a source is so many slots of one block each, the last one partial. Point i
of the schedule is the golden-ratio point frac((i + 1/2) / phi); it falls into one interval of the cumulative slots,
so every stretch of the schedule holds the sources in proportion. The points of a source are ranked, and the one of
rank r is the slot that takes block r (cyclically), until the target is met to the word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritab.operators.prefix import global_running_sums
from veritab.llm.running import running
from veritab.llm.sharding import source_key
from veritab.llm.staging import row_key, staged, unit_interval

#: one word: anything but space and the control characters tab to carriage return
WORD = r"[^\x20\x09-\x0D]+"
#: 1 / golden ratio
GOLDEN = 0.6180339887498949
#: a source gives at most so many times its own words
MOST_EPOCHS = 3


def _by_name() -> list:
    """Sources by code point, those without a name last."""
    return [(F.col("source_key") == "-").asc(), F.col("source_key").asc()]


def source_targets(rows: DataFrame, weights: tuple = (5, 2, 1)) -> DataFrame:
    """``source_key``, ``source_size``, ``weight``, ``target``: shares of all words, none above 3 times its source.

    The excess of full sources is dealt to the others by weight; the level L with sum(min(cap, L * weight)) = total
    is the largest of the levels that arise when sources fill up in the order of cap / weight. One row per source.
    """
    table = staged(rows.groupBy("source_key").agg(F.sum("size").alias("source_size")), "mix-sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    table = global_running_sums(table, _by_name(), {"_index": F.lit(1)})
    index = ((F.col("_index") - 1) % len(weights)).cast("int")
    table = table.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), index + 1)).drop("_index")
    table = staged(table.withColumn("cap", (F.col("source_size") * MOST_EPOCHS).cast("double")), "mix-weights")
    whole = table.agg(F.sum("weight")).first()[0] or 0.0
    order = [(F.col("cap") / F.col("weight")).asc(), F.col("source_key").asc()]
    filled = global_running_sums(table, order, {"_cap": F.col("cap"), "_weight": F.col("weight")})
    open_ = F.lit(whole) - (F.col("_weight") - F.col("weight"))
    level = filled.agg(F.max((F.lit(float(total)) - (F.col("_cap") - F.col("cap"))) / open_)).first()[0] or 0.0
    return table.select("source_key", "source_size", "weight", F.lit(total).cast("long").alias("total"),
                        F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def source_slots(targets: DataFrame, block: int) -> DataFrame:
    """``targets`` with ``blocks`` of each source, the ``words`` it gives (its target, rounded) and the ``slots`` they fill."""
    size, blocks = F.col("source_size"), F.col("blocks")
    out = targets.where("source_size > 0").withColumn("blocks", F.ceil(size / block).cast("long"))
    out = out.withColumn("words", F.floor(F.col("target") + 0.5).cast("long"))
    over = F.col("words") % size
    # the first block boundary at or behind the words of the last pass
    return out.withColumn("slots", F.expr("words div source_size") * blocks + F.when(over > 0, F.expr(
        "(words % source_size * blocks + source_size - 1) div source_size")).otherwise(0))


def schedule(spark, sources: DataFrame) -> DataFrame:
    """``slot``, ``source_key``, ``rank``, ``block``, ``from``, ``to``: the words ``from`` to ``to`` of which source
    stand at each slot (a point of the schedule), and in which pass over it (``epoch``).

    2.62 points for each slot leave no gap in which a source misses one; points beyond a source's slots stay empty.
    """
    spans = staged(global_running_sums(sources, _by_name(), {"_to": F.col("slots")}), "mix-spans")
    slots, cells = spans.agg(F.sum("slots"), F.count(F.lit(1))).first()
    if not slots:
        slots, cells = 0, 1
    points = spark.range(-(-27 * slots // 10) + 8 if slots else 0)
    # frac((i + 1/2) * golden), the high part of i apart, so that large i lose no digits
    low, high = "(id % 65536 + 0.5D)", "(id div 65536)"
    points = points.withColumn("_u", F.expr(f"({high} * {65536 * GOLDEN % 1.0!r}D % 1.0D + {low} * {GOLDEN!r}D % 1.0D) % 1.0D * {slots}"))
    # a point and the interval it falls in share a cell; a cell holds about one interval
    width = max(1.0, slots / cells)
    points = points.withColumn("_cell", F.floor(F.col("_u") / width))
    spans = spans.withColumn("_from", F.col("_to") - F.col("slots"))
    spans = spans.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_from") / width), F.floor(F.col("_to") / width))))
    hit = points.join(spans, "_cell").where("_u >= _from AND _u < _to")
    hit = hit.select(F.col("id").alias("slot"), "source_key", "source_size", "blocks", "words", "slots",
                     (F.col("id") / F.lit(float(max(1, 3 * slots + 8)))).alias("_at"))
    ranked = running(staged(hit, "mix-slots"), "source_key", "_at", ["slot"]).where(F.col("rank") < F.col("slots"))
    ranked = ranked.withColumns({"epoch": F.expr("rank div blocks"), "block": F.col("rank") % F.col("blocks")})
    edge = lambda i: F.expr(f"({i}) * source_size div blocks")
    last = F.col("words") - F.col("epoch") * F.col("source_size")
    return ranked.select("slot", "source_key", "rank", "epoch", "block", edge("block").alias("from"), F.least(edge("block + 1"), last).alias("to"))


def mixed(docs: DataFrame, weights: tuple = (5, 2, 1), seed: str = "mix-1", id_col: str = "doc_id",
          text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``row_key``, ``size``, ``source_key``, ``source_size``, ``target``,
    ``taken`` and ``epochs``, the words taken in each of the up to three passes over its source (always the
    document's first words).

    A null or wordless text has size 0 and takes nothing; a null source is a source of its own, last in order;
    equal rows stand beside each other in the shuffle; a table without words takes nothing and has targets 0; empty
    input gives no rows; other columns are ignored. Reruns agree.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), source_key(F.col(source_col)).alias("source_key"),
                       F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       row_key(F.col(id_col), text).alias("row_key"))
    rows = staged(rows.withColumn("_at", unit_interval(F.lit(seed), F.col("doc_id"), F.col("size"))), "mix-rows")
    targets = staged(source_targets(rows, weights), "mix-targets")
    total = targets.agg(F.max("total")).first()[0] or 0
    sources = staged(source_slots(targets, max(1, round(total ** (1 / 3) / 2))), "mix-blocks")
    laid = staged(running(rows, "source_key", "_at", [F.asc_nulls_first("doc_id"), "size", "row_key"], value="size"),
                  "mix-laid")
    slots = schedule(spark, sources).select("source_key", "epoch", "block", "from", "to")
    block_of = lambda word: F.expr(f"(({word}) * blocks + blocks - 1) div source_size")
    parts = laid.where("size > 0").join(sources.select("source_key", "source_size", "blocks"), "source_key").withColumn(
        "block", F.explode(F.sequence(block_of("before"), block_of("before + size - 1"))))
    overlap = F.greatest(F.lit(0), F.least(F.col("before") + F.col("size"), "to") - F.greatest("before", "from"))
    parts = parts.join(slots, ["source_key", "block"]).groupBy("source_key", "before").agg(
        *[F.sum(F.when(F.col("epoch") == e, overlap).otherwise(0)).alias(f"_e{e}") for e in range(MOST_EPOCHS)])
    out = laid.where("size > 0").join(parts, ["source_key", "before"], "left").unionByName(
        laid.where("size = 0"), allowMissingColumns=True)
    epochs = F.array(*[F.coalesce(F.col(f"_e{e}"), F.lit(0)).cast("long") for e in range(MOST_EPOCHS)])
    out = out.withColumn("epochs", epochs).join(targets.select("source_key", "source_size", "target"), "source_key")
    return out.select("doc_id", "row_key", "size", "source_key", "source_size", "target",
                      F.aggregate("epochs", F.lit(0).cast("long"), lambda a, x: a + x).alias("taken"), "epochs")


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` as the mix takes them, same columns: a row for each pass over a document, the text cut to the words taken."""
    takes = mixed(docs, id_col=id_col, text_col=text_col, **options)
    takes = takes.groupBy("row_key").agg(F.flatten(F.collect_list("epochs")).alias("_takes"), F.max("size").alias("_size"))
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(own, text.alias("_text"), row_key(F.col(f"`{id_col}`"), text).alias("row_key")).join(takes, "row_key")
    # the takes of equal rows are gathered, so they are dealt out from one of them
    rows = rows.withColumn("_copy", F.row_number().over(Window.partitionBy("row_key").orderBy(F.lit(0)))).where("_copy = 1")
    rows = rows.withColumn("_words", F.explode("_takes")).where("_words > 0")
    head = F.array_join(F.slice(F.regexp_extract_all("_text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0)), 1,
                                F.col("_words").cast("int")), "")
    taken = F.when(F.col("_words") < F.col("_size"), head).otherwise(F.col("_text"))
    return rows.select(*[taken.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns])
