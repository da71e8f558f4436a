"""What changed between consecutive full snapshots of a table.

EXCEPT ALL both ways removes the rows that are alike; a full join of what is left, by key, labels additions, removals and
changes. The compared columns are folded into a 256-bit digest before the first shuffle, so no text is ever moved: what is
shuffled is a key, two dates and 32 bytes a row. Keys are unique within a snapshot after the first aggregation, which has
map-side combine, so no key or entity can be hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BLANKS = "[\\s\\u00a0\\u1680\\u2000-\\u200b\\u202f\\u205f\\u3000\\ufeff]+"


def plain(c: Column) -> Column:
    """White space runs become one blank, outer ones go, null is blank."""
    return F.coalesce(F.trim(F.regexp_replace(c.cast("string"), _BLANKS, " ")), F.lit(""))


def digest(*values: Column) -> Column:
    """256 bits of the values with their lengths, so that no two lists of values run into one another."""
    return F.unhex(F.sha2(F.concat(*[F.concat(F.length(v).cast("string"), F.lit(":"), v) for v in values]), 256))


def snapshot_changes(df: DataFrame, snapshot: str, key: str, version: str, compared: list[Column]) -> DataFrame:
    """``snapshot``, ``key`` and ``change_kind`` (added, removed, changed) of each snapshot against the one before.

    Of several rows for a key in a snapshot that with the latest ``version`` counts; of several such, that with the largest
    digest, so the result does not depend on the order of rows. Rows with a null key or snapshot are no records. An empty
    table and a single snapshot give no row; columns that are not named are never read.
    """
    latest = (
        df.where(F.col(key).isNotNull() & F.col(snapshot).isNotNull())
        .select(F.col(snapshot).alias("at"), F.col(key).alias("k"), F.struct(F.col(version).alias("v"), digest(*compared).alias("d")).alias("row"))
        .groupBy("at", "k")
        .agg(F.max("row")["d"].alias("d"))
    )
    # One row a snapshot; its window runs over that many rows only.
    dates = df.select(F.col(snapshot).alias("at")).where(F.col("at").isNotNull()).distinct()
    after = dates.select("at", F.lead("at").over(Window.orderBy("at")).alias("after")).where(F.col("after").isNotNull())
    first = dates.agg(F.min("at").alias("first"))
    now = latest.join(F.broadcast(first), latest["at"] != F.col("first")).select("at", "k", "d")
    before = latest.join(F.broadcast(after), "at").select(F.col("after").alias("at"), "k", "d")
    new = now.exceptAll(before).select("at", "k", F.lit(True).alias("n"))
    old = before.exceptAll(now).select("at", "k", F.lit(True).alias("o"))
    return new.join(old, ["at", "k"], "full").select(
        F.col("at").alias(snapshot),
        F.col("k").alias(key),
        F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").otherwise("changed").alias("change_kind"),
    )
