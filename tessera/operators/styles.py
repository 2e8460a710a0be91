"""Paragraph styles: names and inherited list settings (a transitive closure over a small dimension)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Styles that a chain of inheritance may have.
MAX_CHAIN = 10


def resolved_styles(styles: DataFrame) -> DataFrame:
    """(source_file, style_id, style_num_id, style_ilvl): what each style of (source_file, style_id, based_on, num_id, ilvl) inherits.

    The nearest ancestor with a num_id gives it; the nearest style on the way that has an ilvl gives that, else 0. A chain
    that ends without a num_id, runs in a circle or is longer than MAX_CHAIN gives nulls. styles is one row per style of
    a document, so each of the at most MAX_CHAIN joins is with that small table."""
    base = styles.select("source_file", "style_id", "based_on", "num_id", "ilvl")
    up = base.select(F.col("source_file").alias("u_file"), F.col("style_id").alias("u_id"), F.col("based_on").alias("u_based"), F.col("num_id").alias("u_num"), F.col("ilvl").alias("u_ilvl"))
    now = base.select("source_file", "style_id", F.col("num_id").alias("style_num_id"), F.col("ilvl").alias("near"), F.when(F.col("num_id").isNull(), F.col("based_on")).alias("next"), F.array("style_id").alias("seen"))
    for _ in range(MAX_CHAIN - 1):
        here = (F.col("source_file") == F.col("u_file")) & (F.col("next") == F.col("u_id"))
        on = now.join(up, here, "left")
        circle = F.array_contains("seen", F.col("next"))
        going = F.col("next").isNotNull() & F.col("u_id").isNotNull() & ~F.coalesce(circle, F.lit(False))
        now = on.select(
            "source_file",
            "style_id",
            F.when(going, F.col("u_num")).otherwise(F.col("style_num_id")).alias("style_num_id"),
            F.when(going, F.coalesce("near", "u_ilvl")).otherwise(F.col("near")).alias("near"),
            F.when(going & F.col("u_num").isNull(), F.col("u_based")).alias("next"),
            F.when(going, F.concat("seen", F.array("next"))).otherwise(F.col("seen")).alias("seen"),
        )
    return now.select("source_file", "style_id", "style_num_id", F.when(F.col("style_num_id").isNotNull(), F.coalesce("near", F.lit(0))).alias("style_ilvl"))


def with_styles(paragraphs: DataFrame, styles: DataFrame) -> DataFrame:
    """paragraphs (source_file, style_id, p_num_id, p_ilvl, ..) with style (the display name, else the id), num_id and ilvl.

    A paragraph's own num_id, `0` included, wins, with its own ilvl; else the style's, whose ilvl yields to the paragraph's."""
    names = styles.select(F.col("source_file").alias("n_file"), F.col("style_id").alias("n_id"), F.col("name").alias("display"))
    inherited = resolved_styles(styles).select(F.col("source_file").alias("r_file"), F.col("style_id").alias("r_id"), "style_num_id", "style_ilvl")
    out = paragraphs.join(names, (F.col("source_file") == F.col("n_file")) & (F.col("style_id") == F.col("n_id")), "left")
    out = out.join(inherited, (F.col("source_file") == F.col("r_file")) & (F.col("style_id") == F.col("r_id")), "left")
    own = F.col("p_num_id").isNotNull()
    return (
        out.withColumn("style", F.coalesce("display", "style_id", F.lit("")))
        .withColumn("num_id", F.coalesce("p_num_id", "style_num_id"))
        .withColumn("ilvl", F.when(own, F.col("p_ilvl")).otherwise(F.coalesce("p_ilvl", "style_ilvl")))
        .drop("display", "n_file", "n_id", "r_file", "r_id", "style_num_id", "style_ilvl")
    )
