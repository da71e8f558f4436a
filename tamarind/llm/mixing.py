"""Mixing sources to target weights by hash thresholds, without sorting anything.

Every document has a size in tokens and a hash of its key. A source whose share needs r and a bit times its tokens gives
every document r times and, once more, those whose hash is below a threshold. The threshold comes from a histogram of tokens
by source and by the hash's first bits; only the bucket in which the budget runs out is looked into, by the next bits, until
the hash is used up. A larger budget has larger thresholds, so the selections are nested. What reaches the driver is one
histogram of ``2 ** BITS`` buckets for each source of the target table, whatever the corpus is in size.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.session import cut, spread

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
BITS = 12
_LEVELS = 5
#: The size of the target table is checked against this before it is read to the driver.
MOST_SOURCES = 10_000


def count_tokens(docs: DataFrame, key: str, text: str, source: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """``key``, ``source`` and ``n_tokens`` of every document; null text has none. Whole texts are encoded."""
    kinds = dict(docs.dtypes)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer)
        t.encode_special_tokens = True
        for pdf in it:
            sizes: list[int] = []
            texts = [x or "" for x in pdf["t"]]
            for a in range(0, len(texts), 256):
                sizes += [len(e) for e in t.encode_batch(texts[a : a + 256], add_special_tokens=False)]
            yield pd.DataFrame({key: pdf["k"], source: pdf["s"], "n_tokens": sizes})

    rows = docs.select(F.col(key).alias("k"), F.col(source).alias("s"), F.col(text).alias("t"))
    return spread(rows).mapInPandas(run, f"{key} {kinds[key]}, {source} {kinds[source]}, n_tokens bigint")


def plan_uses(totals: dict[str, int], targets: list[tuple[str, float, int]], budget: int | None) -> dict[str, tuple[int, int]]:
    """Whole uses of every document and the tokens still missing, by source.

    Without a ``budget`` the total is the largest at which every source that has tokens meets its share. With one, a source
    that cannot meet its share within ``max_repeats`` gives all it may.
    """
    real = [(s, w, m) for s, w, m in targets if totals.get(s, 0) > 0 and w > 0 and m > 0]
    if not real:
        return {}
    total = min(totals[s] * m / w for s, w, m in real) if budget is None else budget
    out = {}
    for s, w, m in real:
        want = min(int(total * w + 1e-6), totals[s] * m)
        out[s] = (want // totals[s], want % totals[s])
    return out


def _thresholds(sized: DataFrame, source: str, missing: dict[str, int]) -> dict[str, int]:
    """For each source the 60-bit hash below which its documents are used once more: the most that the missing tokens allow."""
    spark = sized.sparkSession
    prefix = dict.fromkeys(missing, 0)
    left = dict(missing)
    done = {s: 0 for s, m in missing.items() if m <= 0}
    for level in range(_LEVELS):
        open_ = sorted(set(missing) - set(done))
        if not open_:
            break
        shift = 60 - BITS * (level + 1)
        at = spark.createDataFrame([(s, prefix[s]) for s in open_], "__s string, __p long")
        inside = sized.join(F.broadcast(at), (F.col(source) == F.col("__s")) & (F.shiftright("h", shift + BITS) == F.col("__p")))
        by: dict[str, list[tuple[int, int]]] = {}
        for r in inside.groupBy(source, F.shiftright("h", shift).alias("b")).agg(F.sum("n_tokens").alias("n")).collect():
            by.setdefault(r[0], []).append((r["b"], r["n"]))
        for s in open_:
            # where nothing overruns, the whole bucket of the level above is taken
            end = (prefix[s] + 1) << BITS
            for b, n in sorted(by.get(s, [])):
                if n > left[s]:
                    end = b
                    break
                left[s] -= n
            if end == (prefix[s] + 1) << BITS or level == _LEVELS - 1:
                done[s] = end << shift
            prefix[s] = end
    return done


def mix(sized: DataFrame, targets: DataFrame, key: str, source: str, budget: int | None = None) -> DataFrame:
    """``key``, ``source``, ``n_tokens`` and ``uses`` of every document drawn.

    ``sized`` is what :func:`count_tokens` gives, ``targets`` has source, target_share and max_repeats. Documents without
    tokens, without a source or of a source that has no target are not drawn; documents that share a key are drawn alike.
    """
    n_targets = targets.count()
    if n_targets > MOST_SOURCES:
        raise ValueError(f"{n_targets} target sources; at most {MOST_SOURCES} are supported")
    wanted = [(r["source"], float(r["target_share"]), int(r["max_repeats"])) for r in targets.where("source is not null").collect()]
    hashed = sized.where(F.col("n_tokens") > 0).withColumn("h", F.shiftrightunsigned(F.xxhash64(key), 4))
    totals = {r[0]: r["n"] for r in hashed.where(F.col(source).isin([s for s, _, _ in wanted])).groupBy(source).agg(F.sum("n_tokens").alias("n")).collect()}
    planned = plan_uses(totals, wanted, budget)
    limits = _thresholds(hashed, source, {s: m for s, (_, m) in planned.items()})
    rows = [(s, whole, limits[s]) for s, (whole, _) in sorted(planned.items())]
    rule = sized.sparkSession.createDataFrame(rows, "__s string, __whole long, __below long")
    drawn = hashed.join(F.broadcast(rule), F.col(source) == F.col("__s"))
    uses = (F.col("__whole") + F.when(F.col("h") < F.col("__below"), 1).otherwise(0)).cast("int")
    return drawn.select(key, source, "n_tokens", uses.alias("uses")).where("uses > 0")


def mix_report(drawn: DataFrame, targets: DataFrame, source: str) -> DataFrame:
    """Shares reached by source: tokens drawn, documents, most uses, actual and target share; sources without tokens have 0."""
    by = drawn.groupBy(F.col(source).alias("s")).agg(
        F.sum(F.col("n_tokens") * F.col("uses")).alias("tokens"), F.count("*").alias("n_docs"), F.max("uses").alias("most_uses")
    )
    total = by.agg(F.sum("tokens").alias("total"))
    return (
        targets.join(by, targets["source"] == by["s"], "left").join(F.broadcast(total))
        .select(
            "source", "target_share", F.coalesce(F.col("tokens") / F.col("total"), F.lit(0.0)).alias("actual_share"),
            F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"),
        )
    )


def mix_documents(docs: DataFrame, targets: DataFrame, key: str, text: str, source: str, budget: int | None = None, tokenizer: str = TOKENIZER) -> DataFrame:
    """Count, then mix; the counts are written once, since the histograms and the result all read them."""
    return mix(cut(count_tokens(docs, key, text, source, tokenizer)), targets, key, source, budget)
