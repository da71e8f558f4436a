"""Evaluation passages in training text, by latent semantic retrieval and an exact alignment.

Every text is cut into words once; what goes on from there is a table of word hashes. Words are hashed into ``BUCKETS`` columns
and weighted by inverse document frequency over all documents. A randomised SVD of the TF-IDF passages of the whole corpus and
of the items (which get the same total weight as the corpus, so that what only the items speak of keeps its directions) takes
two passes: the first sums A'(A R) for random R, of which an orthonormal basis Q is made; the second sums (A Q)'(A Q), whose
eigenvectors turn Q into right singular vectors. The ``RANK`` leading ones are kept. A task sums blocks of fixed size, these
are added up in a shuffle, and only the sums reach the driver, whatever the corpus is in size.

Every passage of every document is then compared by cosine with every passage of the items, which are a stated query set and
are taken in blocks of bounded size; what comes near is aligned word by word with the whole item. The cosine misses a few
passages that lie across both cuts, so there is an exact way for the rest: what shares a run of ``SEED`` equal words with an
item is aligned as well, and every finding holds such a run. :func:`find_paraphrases` keeps what is near by cosine but is no
repetition, if the longest common subsequence with the item's passage and the words of its answer say it is the same.

No document's text leaves its task but as its own words' hashes; copies cost what they weigh.
"""

from __future__ import annotations

import html
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.session import cut_table, spread

BUCKETS = 1 << 14
RANK = 32
OVERSAMPLE = 16
PASSAGE = 20
STRIDE = 10
ITEM_STRIDE = 10
MIN_COSINE = 0.6
MIN_WORDS = 20
#: L words of an item with at most L/10 differences hold a run of (L - L/10)/(L/10 + 1) equal words or more: 6 where L is 20.
SEED = 6
#: Passages of the items compared at once, and words of documents.
PASSAGE_BLOCK, WORDS_AT_ONCE = 8_192, 16_384
#: Words of the items that are compared in one scan of the documents: bounds what a task holds of the query set.
BLOCK_WORDS = 200_000
#: Share of a passage's words in their order, and of the answer's rare words, that a paraphrase has at least.
MIN_LCS, MIN_ANSWER = 0.5, 0.5

_MARK_BITS = 22

_TAG = re.compile(r"<[/!a-zA-Z][^<>]{0,200}>")
_BROKEN = re.compile(r"(?<=\w)[-\u00ad\u2010]\s*\n\s*(?=\w)")
_DASH = re.compile(r"[–—/|\\]")
_NOT_WORD = re.compile(r"[^\w\s]|_")
_ANSWER = re.compile(r"\b(?:answer|solution)\s*:", re.IGNORECASE)


def words(text: str) -> list[str]:
    """The words that count: without markup, case, punctuation and hyphens at the ends of lines."""
    text = html.unescape(_TAG.sub(" ", text)) if ("<" in text or "&" in text) else text
    text = _BROKEN.sub("", text.replace("\r", ""))
    text = _DASH.sub(" ", unicodedata.normalize("NFKC", text).replace("\u00ad", "")).casefold()
    return _NOT_WORD.sub("", text).split()


@lru_cache(500_000)
def _code(word: str) -> int:
    """32 bits of a word; the low ones are its column."""
    return zlib.crc32(word.encode()) - (1 << 31)


def codes(text: str) -> np.ndarray:
    tokens = words(text)
    return np.fromiter(map(_code, tokens), np.int32, len(tokens))


def _columns(w: np.ndarray) -> np.ndarray:
    return (w & (BUCKETS - 1)).astype(np.int64)


def _starts(n: int, size: int, stride: int) -> np.ndarray:
    """Starts of the passages of a text of n words; the last one ends with the text."""
    if n <= size:
        return np.zeros(1 if n else 0, np.int64)
    return np.append(np.arange(0, n - size, stride), n - size)


def _project(cols: np.ndarray, starts: np.ndarray, ends: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Unit vectors of the passages: sums of the basis rows of their words."""
    total = np.zeros((len(cols) + 1, basis.shape[1]), np.float32)
    np.cumsum(basis[cols], axis=0, out=total[1:], dtype=np.float32)
    v = total[ends] - total[starts]
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def _runs(w: np.ndarray) -> np.ndarray:
    """A number for each run of ``SEED`` words; equal runs have equal numbers."""
    out = np.zeros(max(0, len(w) - SEED + 1), np.uint64)
    u = w.astype(np.uint64)
    for j in range(SEED if len(out) else 0):
        out = out * np.uint64(0x9E3779B97F4A7C15) + u[j : j + len(out)] + np.uint64(1)
    return out


def _laid(it: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Columns of many texts in a row and where their passages start, end to end; a long text is spread over several."""
    held: list[np.ndarray] = []
    n = 0
    step = WORDS_AT_ONCE // PASSAGE * PASSAGE

    def lay() -> tuple[np.ndarray, np.ndarray]:
        offsets = np.cumsum([0, *map(len, held)])
        return np.concatenate(held), np.concatenate([np.arange(o, o + len(c), PASSAGE) for o, c in zip(offsets, held)])

    for pdf in it:
        for w in pdf["w"]:
            cols = _columns(np.asarray(w))
            for at in range(0, len(cols), step):
                held.append(cols[at : at + step])
                n += len(held[-1])
                if n >= step:
                    yield lay()
                    held, n = [], 0
    if held:
        yield lay()


def _outer(it: Iterator[pd.DataFrame], idf: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, float]:
    """A'(A basis) over the passages of the texts, and the passages' energy."""
    weighted = basis * idf[:, None]
    out = np.zeros_like(basis)
    energy = 0.0
    for cols, starts in _laid(it):
        y = np.add.reduceat(weighted[cols], starts, axis=0)
        rows = np.repeat(y, np.diff(np.r_[starts, len(cols)]), axis=0) * idf[cols][:, None]
        order = np.argsort(cols, kind="stable")
        at = cols[order]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        out[at[first]] += np.add.reduceat(rows[order], first, axis=0)
        energy += float((idf[cols] ** 2).sum())
    return out, energy


def _gram(it: Iterator[pd.DataFrame], idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """(A basis)'(A basis) over the passages of the texts."""
    weighted = basis * idf[:, None]
    out = np.zeros((basis.shape[1],) * 2)
    for cols, starts in _laid(it):
        y = np.add.reduceat(weighted[cols], starts, axis=0)
        out += y.T @ y
    return out


def document_frequencies(tokens: DataFrame) -> tuple[np.ndarray, int]:
    """How many documents each column occurs in, over all documents; summed per task, then by a shuffle of columns."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(BUCKETS, np.int64)
        n = 0
        for pdf in it:
            for w in pdf["w"]:
                df[np.unique(np.asarray(w) & (BUCKETS - 1))] += 1
            n += len(pdf)
        hit = np.flatnonzero(df)
        yield pd.DataFrame({"c": np.r_[hit, -1], "n": np.r_[df[hit], n]})

    rows = tokens.select("w").mapInPandas(run, "c bigint, n bigint").groupBy("c").agg(F.sum("n").alias("n")).toPandas()  # at most BUCKETS + 1 rows
    df = np.zeros(BUCKETS, np.float64)
    known = rows[rows["c"] >= 0]
    df[known["c"].to_numpy()] = known["n"].to_numpy()
    return df, int(rows.loc[rows["c"] < 0, "n"].sum())


def _summed(tokens: DataFrame, block, rows: int, columns: int, pieces: int) -> np.ndarray:  # noqa: ANN001
    """The sum over all tasks of the rows x columns block that ``block`` makes of a task's texts.

    Each task cuts its block into pieces by row; a piece is added up in a shuffle, tree-wise where there are many tasks, so that
    no task adds up more than a bounded number of blocks.
    """
    step = -(-rows // pieces)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = block(it).astype(np.float32)
        part = zlib.crc32(total[:64].tobytes())
        for p in range(pieces):
            yield pd.DataFrame({"piece": [p], "part": [part], "data": [total[p * step : (p + 1) * step].tobytes()]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(pdf["data"].iloc[0], np.float32).astype(np.float64)
        for b in pdf["data"].iloc[1:]:
            total += np.frombuffer(b, np.float32)
        return pd.DataFrame({"piece": [pdf["piece"].iloc[0]], "part": [pdf["part"].iloc[0]], "data": [total.astype(np.float32).tobytes()]})

    shape = "piece int, part bigint, data binary"
    parts = tokens.select("w").mapInPandas(run, shape)
    groups = max(1, len(tokens.inputFiles()) // 32)
    while groups > 1:
        parts = parts.groupBy("piece", F.pmod("part", F.lit(groups)).alias("g")).applyInPandas(lambda pdf: add(pdf), shape)
        groups //= 32
    found = parts.groupBy("piece").applyInPandas(add, shape).collect()  # one block
    out = np.zeros((rows, columns), np.float32)
    for r in found:
        got = np.frombuffer(r["data"], np.float32).reshape(-1, columns)
        out[r["piece"] * step : r["piece"] * step + len(got)] = got
    return out


def latent_basis(tokens: DataFrame, items: list[np.ndarray], idf: np.ndarray, corpus_energy: float, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The ``RANK`` leading right singular vectors of the weighted TF-IDF passages, as columns, and their singular values."""
    spark = tokens.sparkSession
    width = RANK + OVERSAMPLE
    mine = pd.DataFrame({"w": items})
    own_energy = sum(float((idf[_columns(w)] ** 2).sum()) for w in items)
    weight = max(corpus_energy, 1.0) / max(own_energy, 1e-9)
    start = np.random.default_rng(seed).standard_normal((BUCKETS, width)).astype(np.float32)
    shared = spark.sparkContext.broadcast((idf, start))
    corpus = _summed(tokens, lambda it: _outer(it, *shared.value)[0], BUCKETS, width, 8)
    q, _ = np.linalg.qr(corpus + np.float32(weight) * _outer(iter([mine]), idf, start)[0])
    q = q.astype(np.float32)
    again = spark.sparkContext.broadcast((idf, q))
    gram = _summed(tokens, lambda it: _gram(it, *again.value), width, width, 1) + weight * _gram(iter([mine]), idf, q)
    for b in (shared, again):
        b.unpersist()
    values, turn = np.linalg.eigh(gram)
    lead = np.argsort(values)[::-1][:RANK]
    return (q @ turn[:, lead]).astype(np.float32), np.sqrt(np.maximum(values[lead], 0))


def repeats(item: list, doc: list, least: int = MIN_WORDS) -> bool:
    """Whether ``doc`` holds ``least`` or more consecutive words of ``item``, a tenth of them altered, missing or added.

    From every place where a run of equal words begins, the furthest reach of each number of differences is followed on the
    diagonals around it; a reach of L words with at most L/10 differences is a finding. It begins and ends with equal words.
    """
    if len(item) < least:
        return False
    places: dict = {}
    for j, w in enumerate(doc):
        places.setdefault(w, []).append(j)
    m, n = len(item), len(doc)
    for i0 in range(m - least + 1):
        for j0 in places.get(item[i0], ()):
            if i0 and j0 and item[i0 - 1] == doc[j0 - 1]:
                continue
            reach = {0: i0}
            e = 0
            while e <= (m - i0) // 10:
                best = 0
                for d, i in list(reach.items()):
                    first = i
                    while i < m and 0 <= i + j0 - i0 + d < n and item[i] == doc[i + j0 - i0 + d]:
                        i += 1
                    reach[d] = i
                    if i > first:
                        best = max(best, i - i0)
                if best >= max(least, 10 * e):
                    return True
                if max(reach.values()) - i0 < 10 * e - least:
                    break  # what follows would have to be a finding of its own
                e += 1
                grown: dict[int, int] = {}
                for d, i in reach.items():
                    for nd, ni in ((d, i + 1), (d - 1, i + 1), (d + 1, i)):
                        if ni <= m and ni > grown.get(nd, -1):
                            grown[nd] = ni
                reach = grown
    return False


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence."""
    last = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(last[j] + 1 if x == y else max(last[j + 1], now[j]))
        last = now
    return last[-1]


class _Queries:
    """A block of items as every task needs it: words, passages' vectors, runs, rare words of the answers."""

    def __init__(self, items: list[tuple], basis: np.ndarray, idf: np.ndarray):
        self.keys = [k for k, _, _ in items]
        self.words = [w.tolist() for _, w, _ in items]
        starts = [_starts(len(w), PASSAGE, ITEM_STRIDE) for _, w, _ in items]
        self.owner = np.repeat(np.arange(len(items)), [len(x) for x in starts])
        self.at = np.concatenate(starts)
        self.vectors = np.concatenate([_project(_columns(w), x, np.minimum(x + PASSAGE, len(w)), basis) for (_, w, _), x in zip(items, starts)])
        runs = [np.unique(_runs(w)) for _, w, _ in items]
        owner = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
        order = np.argsort(np.concatenate(runs), kind="stable")
        self.seeds, self.seed_owner = np.concatenate(runs)[order], owner[order]
        # most runs of the documents are none of these, which one look into a table of their first bits tells
        self.marked = np.zeros(1 << _MARK_BITS, bool)
        self.marked[(self.seeds >> np.uint64(64 - _MARK_BITS)).astype(np.int64)] = True
        median = float(np.median(idf))
        self.answers = [{c for c in a.tolist() if idf[c & (BUCKETS - 1)] >= median} for _, _, a in items]


def _near(pdf: pd.DataFrame, q: _Queries, basis: np.ndarray, min_cosine: float) -> tuple[set, set, list]:
    """(row, item) that a cosine brings together, and those that a run of equal words does, over the rows of a part; and for the
    former the best passages: (row, item, start in the document, start in the item, cosine)."""
    texts = [np.asarray(w) for w in pdf["w"]]
    offsets = np.cumsum([0, *map(len, texts)])
    flat = np.concatenate(texts) if texts else np.zeros(0, np.int32)
    by_cosine, by_run, best = set(), set(), {}
    runs = _runs(flat)
    if len(runs) and len(q.seeds):
        likely = np.flatnonzero(q.marked[(runs >> np.uint64(64 - _MARK_BITS)).astype(np.int64)])
        first, last = np.searchsorted(q.seeds, runs[likely]), np.searchsorted(q.seeds, runs[likely], "right")
        for i, lo, hi in zip(likely, first, last):
            row = int(np.searchsorted(offsets, i, "right")) - 1
            if i + SEED <= offsets[row + 1]:
                by_run.update((row, int(o)) for o in q.seed_owner[lo:hi])
    starts = [o + _starts(len(t), PASSAGE, STRIDE) for o, t in zip(offsets, texts)]
    row_of = np.repeat(np.arange(len(texts)), [len(x) for x in starts])
    starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    ends = np.minimum(starts + PASSAGE, offsets[row_of + 1]) if len(starts) else starts
    for at in range(0, len(starts), WORDS_AT_ONCE // STRIDE):
        part = slice(at, at + WORDS_AT_ONCE // STRIDE)
        low, high = starts[part][0], ends[part].max()
        v = _project(_columns(flat[low:high]), starts[part] - low, ends[part] - low, basis)
        for b in range(0, len(q.vectors), PASSAGE_BLOCK):
            cosine = v @ q.vectors[b : b + PASSAGE_BLOCK].T
            hit = np.flatnonzero(cosine.max(axis=1) >= min_cosine)
            for i, j in zip(*np.nonzero(cosine[hit] >= min_cosine)):
                i = hit[i]
                key = (int(row_of[at + i]), int(q.owner[b + j]))
                by_cosine.add(key)
                if float(cosine[i, j]) > best.get(key, (0.0,))[0]:
                    best[key] = (float(cosine[i, j]), int(starts[at + i] - offsets[key[0]]), int(q.at[b + j]))
    return by_cosine, by_run, [(*k, *v) for k, v in best.items()]


def _prepared(docs: DataFrame, items: DataFrame, doc_key: str, doc_text: str, item_key: str, item_text: str):  # noqa: ANN202
    """Token table, idf, basis and the blocks of items."""
    shape = f"k {dict(docs.dtypes)[doc_key]}, w array<int>"

    def tokenise(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pd.DataFrame({"k": pdf["k"], "w": [codes(t) for t in pdf["t"]]})

    # spread() looks at the files, so the narrowing select comes after it
    corpus = spread(docs).where(F.length(F.trim(doc_text)) > 0).select(F.col(doc_key).alias("k"), F.col(doc_text).alias("t"))
    tokens = cut_table(corpus.mapInPandas(tokenise, shape))
    blocks: list[list[tuple]] = [[]]
    size = 0
    for r in items.where(F.col(item_text).isNotNull()).select(F.col(item_key).alias("k"), F.col(item_text).alias("t")).toLocalIterator():
        w = codes(r["t"])
        if len(w) < MIN_WORDS:
            continue
        if size and size + len(w) > BLOCK_WORDS:
            blocks.append([])
            size = 0
        mark = _ANSWER.search(r["t"])
        blocks[-1].append((r["k"], w, codes(r["t"][mark.end() :]) if mark else w[:0]))
        size += len(w)
    blocks = [b for b in blocks if b]
    if not blocks:
        return tokens, None, None, []
    df, n = document_frequencies(tokens)
    idf = np.log((n + 2.0) / (df + 1.0)).astype(np.float32) + np.float32(0.01)
    energy = float(tokens.select(F.sum(F.size("w"))).first()[0] or 0) * float((idf**2 * df).sum() / max(1.0, df.sum()))
    basis, _ = latent_basis(tokens, [w for b in blocks for _, w, _ in b], idf, energy)
    return tokens, idf, basis * idf[:, None], blocks


def find_leaks(
    docs: DataFrame, items: DataFrame, doc_key: str, doc_text: str, item_key: str, item_text: str, min_cosine: float = MIN_COSINE, by_runs: bool = True
) -> DataFrame:
    """(item_key, doc_key) of every document that repeats a passage of an item.

    Null and blank texts hold nothing; items of fewer than ``MIN_WORDS`` words cannot be repeated. Copies of a document and
    of an item each count. The documents' words are read once for the frequencies, twice for the basis and once for each block
    of ``BLOCK_WORDS`` words of items. Without ``by_runs`` the cosine is the only way to a candidate. An empty table on either
    side gives no row; other columns are never read.
    """
    spark = docs.sparkSession
    kinds = f"{item_key} {dict(items.dtypes)[item_key]}, {doc_key} {dict(docs.dtypes)[doc_key]}"
    tokens, idf, basis, blocks = _prepared(docs, items, doc_key, doc_text, item_key, item_text)
    found = None
    for block in blocks:
        shared = spark.sparkContext.broadcast((_Queries(block, basis, idf), basis))

        def search(it: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            q, basis = shared.value
            for whole in it:
                out = []
                for at in range(0, len(whole), 256):
                    pdf = whole.iloc[at : at + 256]
                    by_cosine, by_run, _ = _near(pdf, q, basis, min_cosine)
                    rows: dict[int, list] = {}
                    for row, item in by_cosine | by_run if by_runs else by_cosine:
                        rows.setdefault(row, []).append(item)
                    for row, near in rows.items():
                        doc = np.asarray(pdf["w"].iloc[row]).tolist()
                        # a repetition holds a run of equal words, so what has none is not aligned
                        out += [(q.keys[i], pdf["k"].iloc[row]) for i in near if (row, i) in by_run and repeats(q.words[i], doc)]
                yield pd.DataFrame(out, columns=[item_key, doc_key])

        part = tokens.mapInPandas(search, kinds)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], kinds) if found is None else found.distinct()


def find_paraphrases(docs: DataFrame, items: DataFrame, doc_key: str, doc_text: str, item_key: str, item_text: str, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(item_key, doc_key, cosine, lcs, answer): documents with a passage near an item's that is no repetition of it.

    ``lcs`` is the share of the item's passage that the document's has in the same order, ``answer`` that of the rare words of the
    item's answer which the document holds (0 where the item states none). Kept are those with ``MIN_LCS`` or ``MIN_ANSWER``.
    """
    spark = docs.sparkSession
    kinds = f"{item_key} {dict(items.dtypes)[item_key]}, {doc_key} {dict(docs.dtypes)[doc_key]}, cosine double, lcs double, answer double"
    tokens, idf, basis, blocks = _prepared(docs, items, doc_key, doc_text, item_key, item_text)
    found = None
    for block in blocks:
        shared = spark.sparkContext.broadcast((_Queries(block, basis, idf), basis))

        def search(it: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            q, basis = shared.value
            for whole in it:
                out = []
                for at in range(0, len(whole), 256):
                    pdf = whole.iloc[at : at + 256]
                    _, by_run, best = _near(pdf, q, basis, min_cosine)
                    for row, item, cosine, there, here in best:
                        doc = np.asarray(pdf["w"].iloc[row]).tolist()
                        passage = q.words[item][here : here + PASSAGE]
                        lcs = common_subsequence(passage, doc[max(0, there - STRIDE) : there + PASSAGE + STRIDE]) / len(passage)
                        rare = q.answers[item]
                        answer = len(rare.intersection(doc)) / len(rare) if rare else 0.0
                        if (lcs >= MIN_LCS or answer >= MIN_ANSWER) and not ((row, item) in by_run and repeats(q.words[item], doc)):
                            out.append((q.keys[item], pdf["k"].iloc[row], cosine, lcs, answer))
                yield pd.DataFrame(out, columns=[item_key, doc_key, "cosine", "lcs", "answer"])

        part = tokens.mapInPandas(search, kinds)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], kinds) if found is None else found
