"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions.

Targets: every source gets its share of all words by weight; a source stops at ``max_epochs`` times its own
size, and the excess is shared again by weight among the rest until none is above its limit.

Sampling: a source with target t and size s repeats each document t div s times. The remaining t mod s words
come from one more pass over its documents in a seeded order, up to the word: the last document of that pass
may take part. So taken words equal the rounded target, and no document exceeds ``max_epochs`` repetitions.

The seeded order is never sorted as a whole. Documents fall into slots by the leading bits of a hash; slot sums
per source (at most 4096 rows) show the slot where the pass ends, and that slot alone is cut again, down to a few
documents. A hot source costs as many rows per task and slot as any other.

Defined results: a null text has size 0; a null source is a source of its own and sorts last; a source without
words has target 0; repeated rows are documents of their own (rows of one id, source, size and text are interchangeable); other columns do
not take part. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import WORD, query, table
from skyloom.session import durable

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 20_240_229
SLOT_BITS = 12
#: 72 bits: 48 of the seeded hash, 12 of the text's for rows that share id, source and size, 12 that part equal documents.
LEVELS = 6
FEW = 2_000


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``key, source, source_size, target``: capped water-filling over one row per source."""
    per_source = sizes.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    ranked = per_source.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    filling = durable(
        ranked.select(
            "key", "source", "source_size",
            F.element_at(pattern, (F.col("place") % len(weights) + 1).cast("int")).alias("weight"),
            (F.col("source_size") * F.lit(max_epochs)).alias("most"),
        ), "sources",
    )
    # The level is where clamped sources and the rest add up to all words. Each round clamps the sources that the
    # level of the round before would take beyond their limit; only three sums per round reach the driver.
    level, clamped = 0.0, -1
    while True:
        over = F.col("most") <= F.lit(level) * F.col("weight")
        row = filling.agg(
            F.sum("source_size").alias("words"), F.sum(F.when(over, F.col("most"))).alias("fixed"),
            F.sum(F.when(~over, F.col("weight"))).alias("free"), F.count(F.when(over, True)).alias("n"),
        ).first()
        if row["n"] == clamped or not row["free"]:
            break
        level, clamped = ((row["words"] or 0) - (row["fixed"] or 0)) / row["free"], row["n"]
    share = F.lit(level) * F.col("weight")
    return filling.select(
        "key", "source", "source_size", F.least(F.col("most").cast("double"), share).alias("target")
    )


def slot(level: int):
    """Slot of a document at a level of the seeded order."""
    word, shift = {LEVELS - 2: ("h2", 64 - SLOT_BITS), LEVELS - 1: ("h3", 64 - SLOT_BITS)}.get(
        level, ("h1", 64 - SLOT_BITS * (level + 1)))
    return F.shiftrightunsigned(F.col(word), shift).bitwiseAND(F.lit((1 << SLOT_BITS) - 1).cast("long"))


def path(level: int):
    """Slots of all levels before ``level``, as one string key."""
    return F.concat_ws(".", *[slot(k).cast("string") for k in range(level)]) if level else F.lit("")


def mix(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Columns ``keep`` as struct ``row``, with ``size, source_size, target, taken`` per row of ``docs``."""
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        F.col(f"`{source_col}`").alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit("")).alias("key"),
        F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.col(f"`{id_col}`").alias("id"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("h2"),
    )
    sized = durable(
        sized.select(
            "row", "source", "key", "size", F.xxhash64(F.lit(seed), "id", "source", "size").alias("h1"),
            "h2", F.monotonically_increasing_id().alias("uid"),
        ), "mix",
    ).withColumn("h3", F.xxhash64("uid"))
    targets = source_targets(sized.select("key", "source", "size"), weights, max_epochs)
    goal = F.round("target").cast("long")
    state = durable(
        targets.select(
            "key", "source_size", "target",
            F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long").alias("whole"),
            F.when(F.col("source_size") > 0, goal % F.col("source_size")).otherwise(0).cast("long").alias("need"),
        ), "targets",
    )
    # Walk down to the slot where the extra pass of each source ends. ``cuts`` has one row per source that still
    # needs words: the slots above, and the words that remain when its documents' turn comes.
    cuts = state.where("need > 0").select("key", F.lit("").alias("above"), "need")
    narrow = sized.select("key", "size", "h1", "h2", "h3")
    passed = []
    for level in range(LEVELS):
        inside = narrow.withColumn("above", path(level)).join(cuts, ["key", "above"])
        sums = inside.groupBy("key", "above", "need", slot(level).alias("slot")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")
        )
        upto = Window.partitionBy("key").orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = sums.withColumn("run", F.sum("words").over(upto))
        end = run.where((F.col("run") >= F.col("need")) & (F.col("run") - F.col("words") < F.col("need")))
        cuts = durable(
            end.select(
                "key", "above", "slot", "n",
                F.concat_ws(".", F.when(F.col("above") != "", F.col("above")), F.col("slot").cast("string")).alias("next"),
                (F.col("need") - F.col("run") + F.col("words")).alias("rest"),
            ), "cuts",
        )
        passed.append(cuts.select("key", F.col("above").alias(f"above{level}"), F.col("slot").alias(f"slot{level}")))
        largest = cuts.agg(F.max("n")).first()[0] or 0
        cuts = cuts.select("key", F.col("next").alias("above"), F.col("rest").alias("need"))
        if largest <= FEW:
            break
    depth = len(passed)
    plan = state
    for cut in passed:
        plan = plan.join(cut, "key", "left")
    plan = durable(plan.join(cuts.select("key", F.col("above").alias("last"), F.col("need").alias("rest")), "key", "left"), "plan")
    full = F.lit(False)
    for level in range(depth):
        full = full | ((path(level) == F.col(f"above{level}")) & (slot(level) < F.col(f"slot{level}")))
    placed = sized.join(plan, "key").select(
        "row", "key", "size", "h1", "h2", "h3", "source_size", "target", "rest", F.col("whole").alias("times"),
        F.coalesce(full, F.lit(False)).alias("extra"),
        F.coalesce(path(depth) == F.col("last"), F.lit(False)).alias("edge"),
    )
    before = Window.partitionBy("key").orderBy("h1", "h2", "h3").rowsBetween(Window.unboundedPreceding, -1)
    edge = placed.where("edge").withColumn("gone", F.coalesce(F.sum("size").over(before), F.lit(0)))
    edge_part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("gone")))
    out = ["row", "size", "source_size", "target"]
    return placed.where("not edge").select(
        *out, (F.col("times") * F.col("size") + F.when(F.col("extra"), F.col("size")).otherwise(0)).alias("taken")
    ).unionAll(edge.select(*out, (F.col("times") * F.col("size") + edge_part).alias("taken")))


@query("op9_mix_sources")
def op9_mix_sources(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("row.*", "size", "source_size", "target", "taken")
