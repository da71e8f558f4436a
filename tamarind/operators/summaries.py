"""Aggregations and order-dependent operators."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def facets(df: DataFrame, dimensions: dict[str, Column], unknown: str = "Unknown") -> DataFrame:
    """(dimension, value, n) of several dimensions in one pass: null and blank values count as ``unknown``."""
    pairs = F.array(*[F.struct(F.lit(n).alias("dimension"), F.coalesce(F.when(F.trim(c) != "", c), F.lit(unknown)).alias("value")) for n, c in dimensions.items()])
    return df.select(F.explode(pairs).alias("d")).groupBy("d.dimension", "d.value").agg(F.count("*").alias("n"))


def completeness(df: DataFrame, detail: Column, recent: Column) -> DataFrame:
    """Rows, rows with and without the detail, recent rows and the rate of completeness in per cent (0 for no rows)."""
    has = F.count_if(detail)
    return df.agg(
        F.count("*").alias("total"), has.alias("with_details"), (F.count("*") - has).alias("without_details"), F.count_if(recent).alias("recent"),
        F.coalesce(F.round(F.try_divide(has * 100.0, F.count("*")), 2), F.lit(0.0)).alias("rate"),
    )


def first_valid(value: Column, order: Column) -> Column:
    """The first value by ``order`` that is neither null nor blank."""
    return F.min_by(value, F.when(F.trim(value) != "", order))


def ordered_union(value: Column, order: Column) -> Column:
    """All values of a group's lists in order, each once. For groups that are known to be small."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda x: x["v"])
    return F.array_distinct(F.flatten(rows))


def next_fit(df: DataFrame, group: list[str], order: str, size: str, limit: int) -> DataFrame:
    """``df`` with ``bin_no`` from 1: items in order go into the current bin while it holds, else open the next.

    An oversized item has a bin of its own. The pass is sequential within a group by its nature; groups are laid in sorted order
    and streamed, so a group of any size needs the state of one bin. Only group, order and size pass through Python, and the
    order must be unique within a group, since the bins are joined back by it.
    """
    types = dict(df.dtypes)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, bin_no, used = None, 0, 0
        for pdf in it:
            bins = []
            for key, n in zip(pdf[group].itertuples(index=False, name=None), pdf["__size"]):
                key = tuple(None if pd.isna(k) else k for k in key)
                if key != at:
                    at, bin_no, used = key, 1, n
                elif used + n > limit:
                    bin_no, used = bin_no + 1, n
                else:
                    used += n
                bins.append(bin_no)
            yield pdf[[*group, order]].assign(bin_no=bins)

    slim = df.select(*group, order, F.coalesce(F.col(size).cast("bigint"), F.lit(0)).alias("__size"))
    laid = slim.repartition(*group).sortWithinPartitions(*group, order)
    bins = laid.mapInPandas(run, ", ".join(f"`{c}` {types[c]}" for c in (*group, order)) + ", bin_no int")
    same = reduce(and_, [F.col(f"d.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*group, order)])
    return df.alias("d").join(bins.alias("b"), same).select("d.*", "b.bin_no")


def split_at_limit(text: Column, limit: int) -> Column:
    """Parts of at most ``limit`` characters: cut at the last blank line that lies wholly below the limit, else at the last line
    break, else hard. Parts are stripped of white space, text that fits stays as it is; null gives null."""
    # white space in front of a part goes, but for the first one's, which counts towards the limit as it stands
    part = rf"(?!\A).{{1,{limit}}}\s*\z|.{{0,{limit - 2}}}(?=\n\n)|.{{0,{limit - 1}}}(?=\n)|.{{1,{limit}}}"
    parts = F.regexp_extract_all(text, F.lit(rf"(?s)(?:\A|\s*+)({part})"), 1)
    stripped = F.filter(F.transform(parts, lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")
    return F.when(F.length(text) <= limit, F.array(text)).otherwise(stripped)


def carry_forward(value: Column, keys: list[str], order: str) -> Column:
    """The last non-null value up to the row."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))


def part_labels(keys: list[str], order: str) -> Column:
    """'[part i/n]' of each row of a group of several, '' for a row alone."""
    n = F.count("*").over(Window.partitionBy(*keys))
    i = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return F.when(n > 1, F.format_string("[part %d/%d]", i, n)).otherwise(F.lit(""))
