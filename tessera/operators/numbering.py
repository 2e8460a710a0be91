"""Multi-level list counters, replayed with windows.

A counter's state is that of one abstract list within one unit of a document. Going down to a deeper level resets the
levels below; the first use of a level may start at its list's override. Both become running sums and counts over
(file, unit, abstract list) in document order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import kind_of_level, label, presence

LEVELS = 9


def with_levels(blocks: DataFrame, nums: DataFrame, levels: DataFrame) -> DataFrame:
    """blocks (source_file, num_id, ilvl, ..) with abstract_id, override, lvl_text, num_fmt, lvl_start.

    nums: (source_file, num_id, abstract_id, overrides map<int,int>); levels: (source_file, abstract_id, ilvl, lvl_text,
    num_fmt, start). What a lookup misses is null. The dimensions are a few rows per document and join by broadcast as
    long as Spark's size estimate says so."""
    nums = nums.select(F.col("source_file").alias("n_file"), F.col("num_id").alias("n_id"), "abstract_id", "overrides")
    levels = levels.select(F.col("source_file").alias("l_file"), F.col("abstract_id").alias("l_abstract"), F.col("ilvl").alias("l_ilvl"), "lvl_text", "num_fmt", F.col("start").alias("lvl_start"))
    out = blocks.join(nums, (F.col("source_file") == F.col("n_file")) & (F.col("num_id") == F.col("n_id")), "left")
    out = out.join(levels, (F.col("source_file") == F.col("l_file")) & (F.col("abstract_id") == F.col("l_abstract")) & (F.col("ilvl") == F.col("l_ilvl")), "left")
    return out.withColumn("override", F.element_at("overrides", F.col("ilvl"))).drop("n_file", "n_id", "l_file", "l_abstract", "l_ilvl", "overrides")


def counters(rows: DataFrame, keys: list[str], order: str, starts: str = "starts", levels: int = LEVELS) -> DataFrame:
    """rows with counter, an array of the counters of levels 0 .. ilvl after each row.

    rows have ilvl (0 .. levels - 1), override (null without one) and starts, an array with each level's first number;
    keys name a list within a unit. All windows share one partitioning and order, so one exchange and sort serve them."""
    w = Window.partitionBy(*keys).orderBy(order)
    up_to = w.rowsBetween(Window.unboundedPreceding, 0)
    each = range(levels)
    here = lambda k: F.when(F.col("ilvl") == k, 1).otherwise(0)
    out = rows.withColumn("prev__", F.lag("ilvl").over(w))
    out = out.withColumns({f"down{k}__": F.when(F.col("prev__").isNotNull() & (F.col("prev__") < k) & (F.col("ilvl") >= k), 1).otherwise(0) for k in each})
    out = out.withColumns({f"s{k}__": F.sum(here(k)).over(up_to) for k in each} | {f"g{k}__": F.sum(f"down{k}__").over(up_to) for k in each})
    # the level's rows before its last reset, and the level's first row ever: its override, its reset group, whether it was itself a reset
    out = out.withColumns(
        {f"b{k}__": F.last(F.when(F.col(f"down{k}__") == 1, F.col(f"s{k}__") - here(k)), ignorenulls=True).over(up_to) for k in each}
        | {f"f{k}__": F.first(F.when(F.col("ilvl") == k, F.struct(F.col("override").alias("o"), F.col(f"g{k}__").alias("g"), F.col(f"down{k}__").alias("d"))), ignorenulls=True).over(up_to) for k in each}
    )
    values = []
    for level in range(levels):
        n = F.col(f"s{level}__") - F.coalesce(F.col(f"b{level}__"), F.lit(0))
        plain = F.coalesce(F.get(F.col(starts), F.lit(level)), F.lit(1)) - 1 + n
        f = F.col(f"f{level}__")
        started = f["o"].isNotNull() & (f["d"] == 0) & (f["g"] == F.col(f"g{level}__"))
        values.append(F.when(started, f["o"] - 1 + n).otherwise(plain).cast("int"))
    out = out.withColumn("counter", F.slice(F.array(*values), 1, F.col("ilvl") + 1))
    return out.drop("prev__", *(f"{x}{k}__" for k in each for x in ("down", "s", "g", "b", "f")))


def numbered(blocks: DataFrame, nums: DataFrame, levels: DataFrame, unit: str = "unit") -> DataFrame:
    """blocks with kind_n, paragraph_n (the label; null without one), counter and suppressed.

    No num_id is a plain paragraph, `0` one whose number is suppressed; a list, level or depth that isn't defined is
    unknown_numbering and moves no counter. The label of bullets and of unknown patterns is null, but they count."""
    looked = with_levels(blocks, nums, levels)
    lists = levels.groupBy("source_file", "abstract_id").agg(F.map_from_entries(F.collect_list(F.struct("ilvl", F.struct("start", "num_fmt")))).alias("defs"))
    lists = lists.select(F.col("source_file").alias("d_file"), F.col("abstract_id").alias("d_abstract"), "defs")
    looked = looked.join(lists, (F.col("source_file") == F.col("d_file")) & (F.col("abstract_id") == F.col("d_abstract")), "left").drop("d_file", "d_abstract")
    plain = F.col("num_id").isNull() | (F.col("num_id") == "0")
    counts = ~plain & F.col("lvl_text").isNotNull()
    state = F.when(plain, "plain").when(counts, "counts").otherwise("unknown")
    looked = looked.withColumn("state__", state)
    base = looked.withColumn("starts", F.array(*(F.element_at("defs", F.lit(k))["start"] for k in range(LEVELS)))).withColumn("formats", F.array(*(F.element_at("defs", F.lit(k))["num_fmt"] for k in range(LEVELS))))
    # rows that don't count stand in a group of their own kind, so that the windows see the others alone; one exchange serves all
    out = counters(base.withColumn("ilvl", F.coalesce("ilvl", F.lit(0))), ["source_file", unit, "abstract_id", "state__"], "idx").withColumn("ilvl__", F.col("ilvl"))
    counting = F.col("state__") == "counts"
    kind = F.when(F.col("state__") == "plain", "paragraph_body").when(counting, kind_of_level(F.col("lvl_text"), F.col("num_fmt"), F.col("ilvl__"))).otherwise("unknown_numbering")
    out = out.withColumn("kind_n", kind).withColumn("counter", F.when(counting, F.col("counter")))
    labelled = counting & ~F.col("kind_n").isin("bullet", "unknown_numbering")
    out = out.withColumn("paragraph_n", F.when(labelled, presence(label(F.col("lvl_text"), F.col("counter"), F.col("formats")))))
    return out.withColumn("suppressed", F.coalesce(F.col("num_id") == "0", F.lit(False))).drop("state__", "starts", "formats", "defs", "ilvl__", "abstract_id", "override", "lvl_text", "num_fmt", "lvl_start")


def kind_counts(blocks: DataFrame) -> DataFrame:
    """(kind, n) of blocks, most frequent first."""
    return blocks.groupBy("kind").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "kind")


def unknown_ratio(blocks: DataFrame, most: float = 0.05) -> DataFrame:
    """One row: n, unknown, ratio, passed; a ratio above `most` fails, no block at all passes."""
    sums = blocks.agg(F.count("*").alias("n"), F.count(F.when(F.col("kind") == "unknown_numbering", 1)).alias("unknown"))
    return sums.withColumn("ratio", F.when(F.col("n") > 0, F.col("unknown") / F.col("n")).otherwise(F.lit(0.0))).withColumn("passed", F.col("ratio") <= most)
