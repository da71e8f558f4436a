"""Joins, merges and mutations on keyed tables.

Parquet tables have no MERGE, so a mutation is the table as it is afterwards; ``write_swap`` puts it in place. Joins are plain
equi-joins, so the optimiser broadcasts a side only where its statistics are below its threshold and adaptive execution
splits skewed keys.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the last by ``order``, by an aggregation with map-side combine and no sort; null keys are kept as a key."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *rest)).alias("__r"))
    return picked.select(*keys, *[F.col("__r")[c].alias(c) for c in rest])


def filled(c: Column, kind: str) -> Column:
    """``c``, null where it is blank text or an empty list."""
    if kind == "string":
        return F.when(F.trim(c) != "", c)
    if kind.startswith("array"):
        return F.when(F.size(c) > 0, c)
    return c


def overlay(base: DataFrame, top: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join in which a filled value of ``top`` wins; columns of either side alone are kept, rows of either too."""
    kinds = dict(top.dtypes)
    b, t = base.alias("b"), top.alias("t")
    joined = b.join(t, keys, "full")
    columns = [*base.columns, *[c for c in top.columns if c not in base.columns]]
    out = []
    for c in columns:
        if c in keys:
            out.append(F.col(c))
        elif c not in top.columns:
            out.append(F.col(f"b.{c}"))
        elif c not in base.columns:
            out.append(F.col(f"t.{c}"))
        else:
            out.append(F.coalesce(filled(F.col(f"t.{c}"), kinds[c]), F.col(f"b.{c}")).alias(c))
    return joined.select(*out)


def overwrite_present(base: DataFrame, patch: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which a row of ``patch`` overwrites its columns, with nulls too; ``base`` rows with a null key are dropped."""
    kept = reduce(and_, [F.col(k).isNotNull() for k in keys])
    marked = patch.withColumn("__hit", F.lit(True)).alias("p")
    joined = base.where(kept).alias("b").join(marked, keys, "left")
    out = []
    for c in [*base.columns, *[c for c in patch.columns if c not in base.columns]]:
        if c in keys:
            out.append(F.col(c))
        elif c not in patch.columns:
            out.append(F.col(f"b.{c}"))
        elif c not in base.columns:
            out.append(F.col(f"p.{c}"))
        else:
            out.append(F.when(F.col("p.__hit"), F.col(f"p.{c}")).otherwise(F.col(f"b.{c}")).alias(c))
    return joined.select(*out)


def _one_a_key(rows: DataFrame, keys: list[str], order: list[Column] | None) -> DataFrame:
    """Of rows that share a key the last by ``order``, then by all other columns, so the result does not depend on their order."""
    return latest(rows, keys, order or [])


def upsert(target: DataFrame, rows: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """``target`` after inserting ``rows`` or replacing rows of the same key; columns of ``target`` only, missing ones null.

    Of several ``rows`` for a key the last by ``order`` counts, ties by their other columns.
    """
    given = [c for c in target.columns if c in rows.columns]
    new = _one_a_key(rows, keys, order).select(*given)
    aligned = new.select(*[F.col(c) if c in given else F.lit(None).cast(dict(target.dtypes)[c]).alias(c) for c in target.columns])
    return target.join(new.select(*keys), keys, "left_anti").select(*target.columns).unionByName(aligned)


def insert_new(target: DataFrame, rows: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """``target`` with those ``rows`` whose key it lacks; of rows that share a key the last by ``order`` is inserted."""
    fresh = _one_a_key(rows, keys, order).join(target.select(*keys).distinct(), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def patch_filled(target: DataFrame, patch: DataFrame, keys: list[str], fields: list[str], order: list[Column] | None = None) -> DataFrame:
    """``target`` with those ``fields`` set which ``patch`` has a value for; nulls of the patch and keys without one change nothing."""
    one = _one_a_key(patch.select(*keys, *fields), keys, order).select(*keys, *[F.col(f).alias(f"__{f}") for f in fields])
    joined = target.join(one, keys, "left")
    return joined.select(*[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in target.columns])


def orphans(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``child`` whose key ``parent`` lacks: none must be left before both are written."""
    return child.join(parent.select(*keys).distinct(), keys, "left_anti")


def updated_manifest(manifest: DataFrame, extracted: DataFrame, keys: list[str]) -> DataFrame:
    """The manifest after files were extracted: their entries replaced, the entries of all others as they were."""
    return upsert(manifest, extracted, keys)


def extraction_plan(manifest: DataFrame, landed: DataFrame, keys: list[str], compared: list[str], extensions: dict[str, str], extension: str) -> DataFrame:
    """``keys``, ``state`` and ``reader``: landed files that are new or changed against the manifest, with the reader of their
    extension (null where none is known, so that nothing is dropped silently)."""
    changed = manifest_changes(manifest.select(*keys, *compared), landed.select(*keys, *compared), keys, compared).where("state <> 'deleted'")
    reader = F.create_map(*[x for k, v in extensions.items() for x in (F.lit(k), F.lit(v))])
    return changed.join(landed.select(*keys, extension), keys).select(*keys, "state", reader[F.lower(extension)].alias("reader"))


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """``df`` with columns set where the condition holds; unknown counts as not."""
    hit = F.coalesce(condition, F.lit(False))
    return df.select(*[F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns])


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """``df`` without the rows for which the condition holds; unknown counts as not."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def keep_known(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is in ``known``; an empty ``known`` deletes nothing, so a failed scan can't empty a table."""
    ids = known.select(*keys).where(reduce(and_, [F.col(k).isNotNull() for k in keys])).distinct()
    none = ids.agg((F.count("*") == 0).alias("__none"))
    hit = df.join(ids.withColumn("__hit", F.lit(True)), keys, "left").join(F.broadcast(none))  # one row
    return hit.where(F.col("__hit") | F.col("__none")).select(*df.columns)


def tiered_lookup(asked: DataFrame, tiers: list[tuple[DataFrame, str, str]], fields: list[str]) -> DataFrame:
    """``asked`` with ``fields`` of the first tier that knows it, and ``tier`` (from 1).

    A tier is (table, its key, the column of ``asked`` that holds the key); of rows that share a key the least counts.
    """
    out = asked
    for i, (df, key, by) in enumerate(tiers):
        one = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"__k{i}")).agg(F.min(F.struct(*fields)).alias(f"__t{i}"))
        out = out.join(one, F.col(by) == F.col(f"__k{i}"), "left")
    hits = [F.col(f"__t{i}") for i in range(len(tiers))]
    found = F.coalesce(*hits)
    tier = F.coalesce(*[F.when(h.isNotNull(), F.lit(i + 1)) for i, h in enumerate(hits)])
    return out.select(*asked.columns, *[found[f].alias(f) for f in fields], tier.alias("tier"))


def manifest_changes(old: DataFrame, new: DataFrame, keys: list[str], compared: list[str]) -> DataFrame:
    """``keys`` and ``state`` (new, changed, deleted) of what differs between two manifests of unique keys."""
    o = old.select(*keys, F.struct(*compared).alias("__o"))
    n = new.select(*keys, F.struct(*compared).alias("__n"))
    state = F.when(F.col("__o").isNull(), "new").when(F.col("__n").isNull(), "deleted").when(~F.col("__o").eqNullSafe(F.col("__n")), "changed")
    return o.join(n, keys, "full").select(*keys, state.alias("state")).where("state is not null")


def changed_fields(old: str, new: str, fields: list[str]) -> Column:
    """The names of the fields that differ between two sides of a join, null-safe, in their order."""
    return F.array_compact(F.array(*[F.when(~F.col(f"{new}.{f}").eqNullSafe(F.col(f"{old}.{f}")), F.lit(f)) for f in fields]))


def missing_fields(fields: list[str]) -> Column:
    """The names of required fields that are null or blank, in their order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(F.trim(F.col(f).cast("string")), F.lit("")) == "", F.lit(f)) for f in fields]))


def mirror_differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of one side only, with ``side``."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def text_search(df: DataFrame, needle: str, fields: list[str]) -> DataFrame:
    """Rows in which the fields, joined by blanks without their nulls and blanks, hold ``needle``, case ignored."""
    text = F.lower(F.concat_ws(" ", *[F.when(F.trim(F.col(f)) != "", F.col(f)) for f in fields]))
    return df.where(text.contains(needle.lower()))


def page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """Rows of one page with ``total_rows`` and ``has_next``.

    The page is a top-k of ``number * size`` rows, which no sort of the table is needed for; the total is a count of its own.
    """
    top = df.orderBy(*order).offset((number - 1) * size).limit(size)
    total = df.agg(F.count("*").alias("total_rows"))
    return top.join(F.broadcast(total)).withColumn("has_next", F.col("total_rows") > number * size)  # one row


def first_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group by ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def any_of(*conditions: Column) -> Column:
    """Whether one of the conditions holds."""
    return reduce(or_, conditions)
