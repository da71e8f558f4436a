"""Mixed timestamp formats and zones: all valid readings of a value, then the likeliest path through each source's records.

The readings come from :func:`tamarind.functions.instants.readings` in the JVM. A Viterbi pass over each source's record
order picks one reading a value; it pays for a change of form between neighbours and for time going backwards. A value
with one reading splits the path there, so only runs of ambiguous values need any memory.

At scale the records are range-partitioned by source and order, so a hot source is spread over as many partitions as it
needs. A run that crosses partitions is solved exactly: each partition reports the least costs from its first to its
last value for its outermost sources only (two small matrices a partition), these are chained on the driver, and each
partition then walks its own records between the readings so fixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarind.functions.instants import readings
from tamarind.session import cut

SWITCH_COST = 1.0
BACKWARD_COST = 0.5


def _step(before: list, after: list) -> np.ndarray:
    """Cost of each pair of readings of two neighbouring records."""
    return np.array(
        [[(SWITCH_COST if f != g else 0.0) + (BACKWARD_COST if n < m else 0.0) for g, n in after] for f, m in before]
    ).reshape(len(before), len(after))


def viterbi(path: list[list[tuple[str, int]]], first: int | None = None, last: int | None = None) -> list[int]:
    """Positions of the cheapest reading of each record; ties go to the first reading. ``first`` and ``last`` fix the ends."""
    cost = np.zeros(len(path[0]))
    if first is not None:
        cost += np.where(np.arange(len(cost)) == first, 0.0, np.inf)
    back = []
    for before, after in zip(path, path[1:]):
        total = cost[:, None] + _step(before, after)
        back.append(total.argmin(axis=0))
        cost = total.min(axis=0)
    at = int(cost.argmin()) if last is None else last
    chosen = [at]
    for b in reversed(back):
        at = int(b[at])
        chosen.append(at)
    return chosen[::-1]


def _rows(it: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for pdf in it:
        for row in pdf.itertuples(index=False, name=None):
            yield row


def _ends(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For the first and the last source of the partition: its first and last readings and the least costs between them."""
    found: list[list] = []
    for seg, source, _, options in _rows(it):
        now = [(o["form"], o["micros"]) for o in options]
        if found and found[-1][0] == source:
            found[-1][4] = (found[-1][4][:, :, None] + _step(found[-1][3], now)[None]).min(axis=1)
            found[-1][3] = now
        else:
            if len(found) > 1:
                found.pop()
            start = np.where(np.eye(len(now)) > 0, 0.0, np.inf)
            found.append([source, seg, now, now, start])
    out = [
        (seg, n, source, [f for f, _ in a], [m for _, m in a], [f for f, _ in b], [m for _, m in b], c.ravel().tolist())
        for n, (source, seg, a, b, c) in enumerate(found)
    ]
    yield pd.DataFrame(out, columns=["seg", "nth", "source", "af", "am", "bf", "bm", "cost"])


_ENDS = (
    "seg int, nth int, source string, af array<string>, am array<bigint>, bf array<string>, bm array<bigint>, cost array<double>"
)


def _fix(ends: list) -> dict[tuple[int, str], tuple[int, int]]:
    """The readings at both ends of each part of a source that several partitions share."""
    parts: dict[str, list] = {}
    for r in sorted(ends, key=lambda r: (r["seg"], r["nth"])):
        parts.setdefault(r["source"], []).append(r)
    fixed = {}
    for source, rows in parts.items():
        if len(rows) < 2:
            continue
        nodes: list[list] = []
        costs: list[np.ndarray] = []
        for r in rows:
            a, b = list(zip(r["af"], r["am"])), list(zip(r["bf"], r["bm"]))
            if nodes:
                costs.append(_step(nodes[-1], a))
            costs.append(np.array(r["cost"]).reshape(len(a), len(b)))
            nodes += [a, b]
        total = np.zeros(len(nodes[0]))
        back = []
        for c in costs:
            t = total[:, None] + c
            back.append(t.argmin(axis=0))
            total = t.min(axis=0)
        at = int(total.argmin())
        chosen = [at]
        for b in reversed(back):
            at = int(b[at])
            chosen.append(at)
        chosen.reverse()
        for i, r in enumerate(rows):
            fixed[(r["seg"], source)] = (chosen[2 * i], chosen[2 * i + 1])
    return fixed


def _choose(it: Iterator[pd.DataFrame], fixed: dict) -> Iterator[pd.DataFrame]:
    out: list[tuple] = []
    run: list[tuple] = []

    def flush(ended: bool) -> None:
        """Decide the run. Unless its source ended, its last record has one reading and begins the next run."""
        if not run:
            return
        seg, source = run[0][0], run[0][1]
        ends = fixed.get((seg, source), (None, None))
        path = [[(o["form"], o["micros"]) for o in r[3]] for r in run]
        chosen = viterbi(path, ends[0] if run[0][4] else None, ends[1] if ended else None)
        keep = list(zip(run, chosen))
        for (_, _, payload, options, _), k in keep if ended else keep[:-1]:
            out.append((payload, options[k]["form"], options[k]["micros"]))

    for row in _rows(it):
        if run and run[-1][1] != row[1]:
            flush(True)
            run = []
        run.append((*row, not run))
        if len(row[3]) == 1:
            flush(False)
            run = [(*row, len(run) == 1 and run[0][4])]
        if len(out) >= 20_000:
            yield pd.DataFrame(out, columns=["payload", "form", "micros"])
            out.clear()
    flush(True)
    yield pd.DataFrame(out, columns=["payload", "form", "micros"])


def normalise_instants(
    df: DataFrame, value: str, source: list[str], order: list[str], keep: list[str], partitions: int | None = None, **kinds: object
) -> DataFrame:
    """One row a value that has a valid reading: ``keep``, ``form`` and ``utc_micros``.

    ``source`` names the columns that make up a source, ``order`` its record order (ties are broken by the value itself),
    ``kinds`` are the parameters of :func:`readings`. Null, blank and other text, impossible dates and skipped local times
    give no row; repeated rows each give one; an empty table gives none; other columns are not touched, whatever their names.
    """
    payload = F.struct(*[F.col(c) for c in keep])
    base = df.select(
        F.coalesce(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in source]), F.lit("")).alias("source"),
        F.struct(*[F.col(c) for c in order], F.col(value).alias("__v")).alias("ord"),
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("payload"),
        F.col(value).alias("raw"),
    ).where(F.length(F.trim("raw")) > 0)
    count = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the values are read once they lie in order: laying them out samples its input, which would read every value twice
    laid = cut(
        base.repartitionByRange(count, "source", "ord")
        .sortWithinPartitions("source", "ord")
        .select(F.spark_partition_id().alias("seg"), "source", "payload", readings(F.col("raw"), **kinds).alias("options"))  # type: ignore[arg-type]
        .where(F.size("options") > 0)
    )
    several = not laid.where(F.size("options") > 1).isEmpty()
    fixed = _fix(laid.mapInPandas(_ends, _ENDS).collect()) if several else {}
    chosen = laid.mapInPandas(lambda it: _choose(it, fixed), "payload string, form string, micros bigint")
    shape = T.StructType([df.schema[c] for c in keep])
    back = F.from_json("payload", shape)
    return chosen.select(*[back[c].alias(c) for c in keep], "form", F.col("micros").alias("utc_micros"))
