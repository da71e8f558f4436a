"""Records of two sources that share no key, matched by graph embeddings, hyperplane blocks and an exact comparison.

1. Records, their attributes (title, reference, entity) and the attributes' tokens (words and letter groups) form a graph.
   Random walks go from each record of the right side over one of its attributes or tokens to another record that has it, and on from there; at
   every record some of its nodes are said. A token's records are laid in slots of about ``SLOT_ROWS`` by their frequency, so
   the neighbours of a hot token are drawn from many small groups and never gathered.
2. The walks train skip-gram vectors of all nodes. Nodes are hashed into ``2 * BUCKETS`` words (tokens and attributes apart), so
   the vocabulary, and with it what the driver holds, has a fixed size.
3. A record's vector is the sum of its title's letter groups, weighted by inverse frequency over all records, centred and
   partly whitened by the covariance over all records. Signs on random hyperplanes make the keys of ``TABLES`` hash tables;
   their number grows with the logarithm of the records, so a key keeps its length. Records of the right side probe each
   table with their ``2 ** UNSURE`` likeliest keys. One more table hashes the attribute vectors (reference with entity), and
   records of one reference meet by it, whatever their other parts but lot and year say.
4. Pairs that meet, agree on their exact parts (lot, year), share part of their names' letters and lie in the window of dates
   that pairs of one title and reference show are compared exactly: cosine, words, entity, phase, days between them, trait. How much each says comes from counts over
   all pairs whose references agree or differ, and the sum is calibrated into a confidence; last the references add theirs.
5. A pair is a match if its confidence is ``MIN_CONFIDENCE`` or more and each side is the other's best.

Nothing is sampled. A title that ``COMMON_TITLE`` of all records or more have names nothing, and is hashed once: what meets it
meets each of its records, in slices of ``SLICE``. What the features say is counted apart for pairs with such a title.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce
from itertools import chain
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Word2Vec
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarind.llm.names import edits, take_apart
from tamarind.session import cut_table, drop_table, release

#: Words of the embedding for tokens, and as many for attributes.
BUCKETS = 1 << 14
DIMENSIONS = 32
#: Hash tables of titles; a key has log2(records of the left side) + ``SPARE_BITS`` signs.
TABLES = 5
SPARE_BITS = 0
#: Signs nearest to their hyperplane that a probe leaves open.
UNSURE = 2
#: Weight of a letter group at most, so that a misspelling's rare groups do not outweigh the rest.
MOST_WEIGHT = 3.0
#: Power of the covariance that is taken out of the vectors.
WHITEN = 0.25
SLOT_ROWS = 6
#: A title of this share of all records, or of this many where that is more, is a common one, and so with references.
COMMON_TITLE, COMMON_LEAST = 0.002, 1_000
#: Records of a common title that are joined in one piece.
SLICE = 2_000
#: A word in this share of all titles or more is a common one, others are names; titles with names must share this part of the
#: letter groups of theirs (0.05 % of true pairs share less).
COMMON_WORD, SHARED_NAMES = 0.002, 0.4
MIN_CONFIDENCE = 0.5
#: Words of the longest titles that are compared in arrays.
MOST_WORDS = 24
#: Days of a bin of days between two dates, and the bins' reach.
BIN, REACH = 15, 1_500
#: Share of pairs of one title and reference that may lie outside the window of dates, and the least number of such pairs.
OUTSIDE, LEAST_DATED = 0.0005, 50
#: Pairs whose references agree, and pairs whose differ, that are needed to count what a feature says.
LEAST_TOLD = 20
#: How references of matches are typed (codes of :func:`_reference_state`), as far as too few pairs tell.
TYPED = {10: 0.85, 7: 0.04, 5: 0.08, 0: 0.03}
#: Buckets of the trait's values.
TRAITS = 4_096

# Abbreviations and other words for the same in titles.
SAME = {
    "sup": "supply", "del": "delivery", "svcs": "services", "proc": "procurement", "purchase": "procurement",
    "prov": "provision", "consult": "consultancy", "consultant": "consultancy", "constr": "construction", "stn": "station",
    "refurb": "refurbishment", "rehab": "rehabilitation", "maint": "maintenance", "hlth": "health", "ctr": "centre",
    "bldg": "building", "hiring": "engagement", "upgrade": "upgrading", "rd": "road", "repairs": "repair",
    "hosp": "hospital", "sch": "school", "inst": "installation", "equip": "equipment", "ext": "extension",
}
# Words that say nothing about what a title is of.
FILLERS = frozenset("the of for to at and a an in re award tender contract notice firm new no lot services".split())
_ROMAN = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9, "x": 10}
_LOT = re.compile(r"\blots?\s*(?:no\.?\s*)?[-#:]?\s*(\d{1,3}|[ivx]{1,4})\b")
_PHASE = re.compile(r"\bphase\s*[-#:]?\s*(\d{1,3}|[ivx]{1,4})\b")
_YEAR = re.compile(r"\b(?:fy\s*)?(20\d\d)\s*[/-]\s*(\d{2})\b")
_WORDS = re.compile(r"[a-z0-9]+")
_REFERENCE = re.compile(r"(?:([A-Z]{2,5})[^A-Z0-9]*)?(20\d\d)[^A-Z0-9]*(\d{1,5})(?:[^A-Z0-9]*L(\d+))?$")


def _number(text: str) -> str:
    return text if text.isdigit() else str(_ROMAN.get(text, text))


def title_parts(title: str) -> tuple[list[str], str, str, str]:
    """Words of a title that count, and its lot, phase and year ('' for none)."""
    t = (title if title.isascii() else unicodedata.normalize("NFKC", title)).lower()
    if "&" in t:
        t = t.replace("d&b", "design build").replace("&", " and ")
    found = []
    for pattern, sign in ((_LOT, "lot"), (_PHASE, "phase"), (_YEAR, "20")):
        m = pattern.search(t) if sign in t else None
        found.append((_number(m.group(1)).lstrip("0") if pattern is not _YEAR else m.group(1)) if m else "")
        if m:
            t = t[: m.start()] + " " + t[m.end() :]
    words = [SAME.get(w, w) for w in _WORDS.findall(t)]
    return [w for w in words if w not in FILLERS], *found


def reference_parts(reference: str | None) -> tuple[str, str, str, str]:
    """Series, year, number and lot of a reference number; '' for what it lacks or what is no reference."""
    if not reference:
        return "", "", "", ""
    m = _REFERENCE.search((reference if reference.isascii() else unicodedata.normalize("NFKC", reference)).upper().strip())
    return ("", "", "", "") if not m else (m.group(1) or "", m.group(2), m.group(3).lstrip("0") or "0", m.group(4) or "")


def _hash(text: str) -> int:
    return zlib.crc32(text.encode())


@lru_cache(200_000)
def _letters(word: str) -> tuple[int, ...]:
    """Buckets of a word's letter groups."""
    padded = f"_{word}_"
    return tuple(_hash(f"#{padded[i : i + 3]}") & (BUCKETS - 1) for i in range(len(padded) - 2))


@lru_cache(200_000)
def _word(word: str) -> int:
    return BUCKETS + (_hash(f"w:{word}") & (BUCKETS - 1))


@lru_cache(200_000)
def _token(word: str) -> int:
    return _hash(f"t:{word}") & (BUCKETS - 1)


@lru_cache(200_000)
def _mask(word: str) -> int:
    bits = 0
    for g in _letters(word):
        bits |= 1 << (g * 2_654_435_761 >> 7 & 127)
    return bits


def _node(attribute: str) -> int:
    return BUCKETS + (_hash(attribute) & (BUCKETS - 1))


@lru_cache(50_000)
def _entity(text: str) -> tuple[str, str, bool, int]:
    """Head and rest of a body's name, whether it is short, and its node."""
    form, head, rest, _ = take_apart(text, False) or ("", "", "", "")
    return head, rest, form == "short", _node(f"entity:{head}/{rest}") if head or rest else 0


_SHAPE = (
    "rid string, side int, words string, lot string, phase string, fy string, series string, ref_year string, ref_no string, "
    "head string, rest string, short boolean, day int, basis int, trait int, links array<int>, own array<int>"
)


def _parts(rows: Iterable[tuple]) -> list[tuple]:
    """The parts of records; ``links`` are nodes by which a walk may leave one, ``own`` nodes that are said when it is passed."""
    out = []
    for rid, side, title, entity, reference, day, basis, trait in rows:
        words, lot, phase, fy = title_parts(title)
        series, year, number, ref_lot = reference_parts(reference)
        head, rest, short, body = _entity(entity) if entity and entity.strip() else ("", "", False, 0)
        lot, said = lot or ref_lot, " ".join(words)
        nodes = [_node(f"title:{said}/{lot}/{phase}/{fy}")]
        if number:
            nodes.append(_node(f"reference:{year}/{number}"))
        if body:
            nodes.append(body)
        tokens = list(map(_token, words))
        chance, links, own = _hash(f"{side}{rid}"), nodes[:2], []
        if tokens:
            links += tokens[(chance * 2_654_435_761 >> 7 & 0xFFFFFFFF) % len(tokens)], tokens[(chance * 2_246_822_519 >> 7 & 0xFFFFFFFF) % len(tokens)]
            letters = len(said) - len(words) + 1
            for d in ((chance * 3_266_489_917 >> 7 & 0xFFFFFFFF) % letters, (chance * 668_265_263 >> 7 & 0xFFFFFFFF) % letters):
                for w in words:  # a word has as many letter groups as letters
                    if d < len(w):
                        own.append(_letters(w)[d])
                        break
                    d -= len(w)
        last = (chance * 374_761_393 >> 7 & 0xFFFFFFFF) % (len(tokens) + len(nodes))
        own.append(tokens[last] if last < len(tokens) else nodes[last - len(tokens)])
        out.append((
            rid, side, said, lot, phase, fy, series, year, number, "" if short else head, rest, short,
            day, basis, trait, list(dict.fromkeys(links)), own,
        ))
    return out


def _describe(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """:func:`_parts` of frames."""
    names = [c.split()[0] for c in _SHAPE.split(", ")]
    for pdf in it:
        out = _parts(pdf.itertuples(index=False, name=None))
        yield pd.DataFrame(dict(zip(names, zip(*out))) if out else {}, columns=names).astype({"day": "Int32"})


def _describe_batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """:func:`_parts` of Arrow batches, without a frame on the way in or out."""
    kinds = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32())}
    fields = [c.split() for c in _SHAPE.split(", ")]
    for batch in it:
        out = _parts(zip(*(c.to_pylist() for c in batch.columns)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(zip(*out), fields)], [name for name, _ in fields])


def random_walks(records: DataFrame) -> DataFrame:
    """``sentence`` array<string>: what a walk from every record of the right side says, over two further records of either side.

    The second and third record are drawn among those that share a node with the one before: each record has its place in the
    slots of its links, and the next one there (the first one after the last) is its neighbour by that link.
    """
    seen = records.select("node", "side", "own", F.explode("links").alias("link"), (F.pmod("node", F.size("links"))).alias("first"), F.col("links"))
    # which of its links a record leaves by, on a walk's first and on its second way
    seen = seen.select(
        "node", "side", "own", "link", (F.col("link") == F.get("links", F.col("first"))).alias("l1"),
        (F.col("link") == F.get("links", F.pmod(F.col("first") + 1, F.size("links")))).alias("l2"),
    )
    slots = cut_table(records.select(F.explode("links").alias("link")).groupBy("link").agg(F.ceil(F.count("*") / SLOT_ROWS).cast("int").alias("slots")))
    placed = seen.join(F.broadcast(slots), "link").withColumn("slot", F.pmod(F.xxhash64("node", "link"), "slots"))  # slots: 2 * BUCKETS rows at most
    w = Window.partitionBy("link", "slot").orderBy("node")
    here = F.struct("node", "own")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    steps = placed.withColumn("next", F.coalesce(F.lead(here).over(w), F.first(here).over(whole)))
    # what is said on a walk's first way and on its second way, each at the record where the two meet
    ways = steps.select(F.explode(F.array(
        F.when(F.col("l1") & (F.col("side") == 1), F.struct(F.col("next.node").alias("at"), F.lit(1).alias("way"), F.concat("own", F.array("link"), "next.own").alias("said"))),
        F.when(F.col("l2"), F.struct(F.col("node").alias("at"), F.lit(0).alias("way"), F.concat(F.array("link"), "next.own").alias("said"))),
    )).alias("x")).where("x is not null").select("x.*")
    more = F.first(F.when(F.col("way") == 0, F.col("said"))).over(Window.partitionBy("at").orderBy("way").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return ways.withColumn("more", more).where("way = 1").select(F.concat("said", F.coalesce("more", F.array().cast("array<int>"))).cast("array<string>").alias("sentence"))


def train_vectors(sentences: DataFrame, partitions: int) -> np.ndarray:
    """Skip-gram vectors of the nodes, tokens and attributes each centred, at unit length.

    A bucket that no walk passed keeps a random start, as it would in the training itself.
    """
    model = Word2Vec(
        vectorSize=DIMENSIONS, minCount=1, numPartitions=partitions, maxIter=1, windowSize=2, stepSize=0.05, seed=3, inputCol="sentence", outputCol="v", maxSentenceLength=64
    ).fit(sentences)
    out = np.zeros((2 * BUCKETS, DIMENSIONS), np.float32)
    for r in model.getVectors().collect():  # at most 2 * BUCKETS rows
        out[int(r["word"])] = r["vector"].toArray()
    for half in (out[:BUCKETS], out[BUCKETS:]):
        hit = np.abs(half).sum(axis=1) > 0
        if hit.any():
            half[hit] -= half[hit].mean(axis=0)
        half[~hit] = np.random.default_rng(29).standard_normal((int((~hit).sum()), DIMENSIONS))
        half /= np.maximum(np.linalg.norm(half, axis=1, keepdims=True), 1e-9)
    return out


def _numbered(texts: Iterable[str]) -> tuple[list[list[str]], list[str], np.ndarray]:
    """The words of each title, the distinct ones of all, and for one title after the other the place of each of its words among those."""
    titles = [x.split() for x in texts]
    every = list(chain.from_iterable(titles))
    known = {w: i for i, w in enumerate(dict.fromkeys(every))}
    return titles, list(known), np.fromiter(map(known.__getitem__, every), np.int64, len(every))


def frequencies(records: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """In how many titles each bucket of letter groups and each bucket of words occurs, over all records."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(2 * BUCKETS, np.int64)
        for pdf in it:
            for at in range(0, len(pdf), 2_000):
                titles, words, place = _numbered(pdf["words"][at : at + 2_000])
                groups = [(_word(w), *_letters(w)) for w in words]
                size = np.fromiter(map(len, groups), np.int64, len(groups))
                flat = np.fromiter(chain.from_iterable(groups), np.int64, int(size.sum()))
                # one row a title and group of a word of it
                many = size[place]
                within = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                group = flat[np.repeat((np.cumsum(size) - size)[place], many) + within]
                title = np.repeat(np.repeat(np.arange(len(titles)), [len(x) for x in titles]), many)
                said = np.sort(title * (2 * BUCKETS) + group)  # np.unique hashes, which takes longer
                once = said[np.flatnonzero(np.diff(said, prepend=-1))]
                total += np.bincount(once % (2 * BUCKETS), minlength=2 * BUCKETS)
        hit = np.flatnonzero(total)
        yield pd.DataFrame({"c": hit, "n": total[hit]})

    rows = records.select("words").mapInPandas(run, "c bigint, n bigint").groupBy("c").agg(F.sum("n").alias("n")).toPandas()  # at most 2 * BUCKETS rows
    out = np.zeros(2 * BUCKETS, np.int64)
    out[rows["c"].to_numpy(np.int64)] = rows["n"].to_numpy()
    return out[:BUCKETS], out[BUCKETS:]


class Names(dict):
    """128 bits a title, set by the letter groups of its uncommon words: titles that name the same share most of theirs."""

    def __init__(self, common: np.ndarray):
        super().__init__()
        self.common = common

    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        self[word] = out = 0 if self.common[_word(word) - BUCKETS] else _mask(word)
        return out

    def of(self, titles: list[list[str]]) -> np.ndarray:
        bits = [reduce(or_, map(self.__getitem__, x), 0) for x in titles]
        return np.array([[x & 0xFFFFFFFFFFFFFFFF for x in bits], [x >> 64 for x in bits]], np.uint64).T.view(np.int64)


class Sums:
    """Sums of the weighted vectors of titles' letter groups, kept by word for ``most`` words at a time."""

    def __init__(self, table: np.ndarray, most: int = 40_000):
        self.table, self.most = table, most
        self.place: dict[str, int] = {}
        self.rows = np.zeros((1_024, table.shape[1]), np.float32)

    def _learn(self, words: list[str]) -> None:
        groups = [_letters(w) for w in words]
        size = np.fromiter(map(len, groups), np.int64, len(groups))
        flat = np.fromiter(chain.from_iterable(groups), np.int64, int(size.sum()))
        end = len(self.place) + len(words)
        if end > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((max(end - len(self.rows), len(self.rows)), self.rows.shape[1]), np.float32)])
        self.rows[len(self.place) : end] = np.add.reduceat(self.table[flat], np.cumsum(np.r_[0, size[:-1]]), axis=0)  # a word has one group at least
        self.place.update(zip(words, range(len(self.place), end)))

    def __call__(self, titles: list[list[str]]) -> np.ndarray:
        every = list(chain.from_iterable(titles))
        new = [w for w in dict.fromkeys(every) if w not in self.place]
        if new and len(self.place) + len(new) > self.most:
            self.place = {}
            new = list(dict.fromkeys(every))
        if new:
            self._learn(new)
        size = np.fromiter(map(len, titles), np.int64, len(titles))
        out = np.zeros((len(titles), self.table.shape[1]), np.float32)
        if every:
            flat = np.fromiter(map(self.place.__getitem__, every), np.int64, len(every))
            out[size > 0] = np.add.reduceat(self.rows[flat], np.cumsum(np.r_[0, size[:-1]])[size > 0], axis=0)
        return out


def _totals(titles: list[str], table: np.ndarray) -> np.ndarray:
    """Sums of the weighted vectors of each title's letter groups."""
    return Sums(table)([x.split() for x in titles])


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def whitening(records: DataFrame, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean of the records' unit vectors and the matrix that takes part of their covariance out; sums over all records."""
    d = table.shape[1]
    shared = records.sparkSession.sparkContext.broadcast(table)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, sums = np.zeros((d + 1, d)), Sums(shared.value)
        for pdf in it:
            for at in range(0, len(pdf), 2_000):
                v = _unit(sums([x.split() for x in pdf["words"][at : at + 2_000]])).astype(np.float64)
                total[:d] += v.T @ v
                total[d] += v.sum(axis=0)
        yield pd.DataFrame({"i": range(d + 1), "v": list(total)})

    summed = records.select("words").mapInPandas(run, "i int, v array<double>").groupBy("i").agg(*[F.sum(F.col("v")[j]).alias(f"v{j}") for j in range(d)])
    rows = summed.orderBy("i").toPandas().drop(columns="i").to_numpy(float)  # d + 1 rows
    shared.unpersist()
    n = max(1, records.count())
    mean = rows[d] / n
    values, vectors = np.linalg.eigh(rows[:d] / n - np.outer(mean, mean))
    return mean.astype(np.float32), (vectors * np.maximum(values, 1e-6) ** -WHITEN).astype(np.float32)


@lru_cache(200_000)
def _signs(word: str) -> int:
    """The letters and digits of a word as bits."""
    bits = 0
    for ch in word:
        bits |= 1 << (ord(ch) & 63)
    return bits


@lru_cache(500_000)
def _near(a: str, b: str) -> int:
    """Edits between two words, up to 2; 3 for more."""
    return edits(a, b, 2)


def _alike(a: str, b: str) -> int:
    """1 for words one edit apart and for a word and its beginning, 2 for words two edits apart, 0 for others."""
    least = min(len(a), len(b))
    if least < 3:
        return 0
    if a.startswith(b) or b.startswith(a):
        return 1
    if least < 4 or abs(len(a) - len(b)) > 2:
        return 0
    # an edit takes at most one sign from either word
    x, y = _signs(a), _signs(b)
    if (x & ~y).bit_count() > 2 or (y & ~x).bit_count() > 2:
        return 0
    found = _near(a, b)
    return 1 if found <= 1 else 2 if found == 2 and least >= 6 else 0


class Weights(dict):
    """What a word counts: uncommon ones, which are names, three times as much as common ones."""

    def __init__(self, common: np.ndarray):
        super().__init__()
        self.common = common

    def __missing__(self, word: str) -> float:
        if len(self) > 500_000:
            self.clear()
        self[word] = out = 1.0 if self.common[_word(word) - BUCKETS] else 3.0
        return out


def compare_titles(a: list[str], b: list[str], weight: Weights) -> tuple[float, int]:
    """Share of both titles' words that have a counterpart, uncommon words counting three times, and the uncommon words of either
    title that have none within two edits on the other side: other names, most likely."""
    only, left, got = [], b.copy(), 0.0
    for w in a:
        if w in left:
            left.remove(w)
            got += weight[w]
        else:
            only.append(w)
    total, other = got, 0
    for w in only:
        total += weight[w]
        hit, best = None, 3
        for x in left:
            found = _alike(w, x)
            if found and found < best:
                hit, best = x, found
        if hit is not None:
            left.remove(hit)
            got += weight[w] if best == 1 else weight[w] / 2
        else:
            other += weight[w] > 1 and len(w) >= 4
    for x in left:
        total += weight[x] / 2
        other += weight[x] > 1 and len(x) >= 4
    return (got / total if total else 0.0), min(3, other)


def compare_all(texts: Iterable[str], x: np.ndarray, y: np.ndarray, weight: Weights) -> tuple[np.ndarray, np.ndarray]:
    """:func:`compare_titles` for each pair of places ``x`` and ``y`` in ``texts``.

    Words that both titles have are told in arrays, and so is which of the others may be alike, by length and letters. Pairs with
    words that are, with a title that repeats a word or with one of more than ``MOST_WORDS`` words are compared one by one.
    """
    titles, words, place = _numbered(texts)
    size = np.array([len(t) for t in titles])
    row = np.repeat(np.arange(len(titles)), size)
    column = np.arange(len(place)) - np.repeat(np.cumsum(size) - size, size)
    short = column < MOST_WORDS
    grid = np.full((len(titles), min(MOST_WORDS, max(1, int(size.max(initial=0))))), -1)
    grid[row[short], column[short]] = place[short]
    ordered = np.sort(grid, axis=1)
    alone = (size > MOST_WORDS) | ((ordered[:, 1:] == ordered[:, :-1]) & (ordered[:, 1:] >= 0)).any(axis=1)

    # what is known of a word; the last place stands for none
    length = np.array([*map(len, words), 0])
    signs = np.array([*map(_signs, words), 0], np.uint64)
    first = np.array([*(ord(w[0]) for w in words), 0])
    counts = np.array([*(weight[w] for w in words), 0.0])
    name = (counts > 1) & (length >= 4)

    a, b = grid[x], grid[y]
    equal = (a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None]
    both = equal.any(axis=2)
    only, left = (a >= 0) & ~both, (b >= 0) & ~equal.any(axis=1)
    got = (counts[a] * both).sum(axis=1)
    total = got + (counts[a] * only).sum(axis=1) + (counts[b] * left).sum(axis=1) / 2
    share = np.divide(got, total, out=np.zeros(len(x)), where=total > 0)
    other = np.minimum(3, (name[a] & only).sum(axis=1) + (name[b] & left).sum(axis=1))

    pair, i, j = np.nonzero(only[:, :, None] & left[:, None, :])
    p, q = a[pair, i], b[pair, j]
    least = np.minimum(length[p], length[q])
    more, less = np.bitwise_count(signs[p] & ~signs[q]), np.bitwise_count(signs[q] & ~signs[p])
    maybe = (least >= 4) & (np.abs(length[p] - length[q]) <= 2) & (more <= 2) & (less <= 2)
    maybe |= (least >= 3) & (first[p] == first[q]) & ((more == 0) | (less == 0))
    single = alone[x] | alone[y]
    single[[k for k, u, v in zip(pair[maybe].tolist(), p[maybe].tolist(), q[maybe].tolist()) if _alike(words[u], words[v])]] = True
    for k in np.flatnonzero(single).tolist():
        share[k], other[k] = compare_titles(titles[x[k]], titles[y[k]], weight)
    return share, other


_FEATURES = ("words", "entity", "dated", "trait")
#: The code of two equal titles: see :func:`_title_codes`.
_EQUAL = (10 * 10 + 9) * 4


def _title_codes(shared):  # noqa: ANN001, ANN202
    """A pandas UDF of two titles: (tenths of words shared, tenths of cosine, names of one side only) as one number."""

    @F.pandas_udf("int")
    def codes(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        table, mean, turn, common = shared.value
        sums, weight = Sums(table), Weights(common)
        for left, right in batches:
            a, b = left.to_numpy(), right.to_numpy()
            out = np.full(len(a), _EQUAL)
            different = np.flatnonzero(a != b)
            for at in range(0, len(different), 2_000):
                part = different[at : at + 2_000]
                # a title is in several pairs, and is summed and cut once
                place, titles = pd.factorize(np.concatenate([a[part], b[part]]))
                words = [t.split() for t in titles]
                v = _unit((_unit(sums(words)) - mean) @ turn)
                x, y = place[: len(part)], place[len(part) :]
                near = np.clip((np.einsum("nd,nd->n", v[x], v[y]) * 10).astype(int), 0, 9)
                share, other = compare_all(titles, x, y, weight)
                out[part] = ((10 * share).astype(int) * 10 + near) * 4 + other
            yield pd.Series(out)

    return codes


def _entity_state(h1, r1, s1, h2, r2, s2):  # noqa: ANN001, ANN202
    """2 the same, 1 unknown (initials stand for several), 0 another. Up to two edits in the words that only this body has."""
    unknown = ((h1 == "") & (r1 == "")) | ((h2 == "") & (r2 == "")) | s1 | s2
    least = F.least(F.length(h1), F.length(h2))
    near = (r1 == r2) & ((h1 == h2) | ((least >= 6) & (F.levenshtein(h1, h2, 2) >= 0)) | (F.levenshtein(h1, h2, 1) >= 0))
    return F.when(unknown, 1).when(near, 2).otherwise(0)


def _reference_state(s1, y1, n1, s2, y2, n2):  # noqa: ANN001, ANN202
    """10 the same, 7 one digit apart, 5 unknown, 0 another."""
    whole = lambda y, n: F.concat(y, F.lpad(n, 5, "0"))
    other_series = (s1 != "") & (s2 != "") & (s1 != s2)
    one_off = F.levenshtein(whole(y1, n1), whole(y2, n2), 1) >= 0
    return F.when((n1 == "") | (n2 == ""), 5).when(other_series, 0).when((y1 == y2) & (n1 == n2), 10).when(one_off, 7).otherwise(0)


def evidence(counted: DataFrame) -> dict[str, dict[int, float]]:
    """``counted``: ``n`` pairs of the same features. What each value of a feature says for a match, in nats: the logarithm of its share among pairs whose references agree over
    over that among pairs whose references differ. Where several tenders have the award's reference, none of them counts. Counts
    over all other pairs, with half a pair added; the driver gets a row a value."""
    known = counted.where("reference <> 5 and (reference <> 10 or alone)")
    values = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in _FEATURES])
    rows = known.select(F.explode(values).alias("x"), (F.col("reference") == 10).alias("yes"), "n").groupBy("x.f", "x.v", "yes").agg(F.sum("n").alias("count")).collect()
    out: dict[str, dict[int, float]] = {}
    told = [sum(r["count"] for r in rows if r["f"] == "entity" and r["yes"] == yes) for yes in (True, False)]
    if min(told) < LEAST_TOLD:
        return prior_evidence()
    for f in _FEATURES:
        mine = [r for r in rows if r["f"] == f]
        yes = {r["v"]: r["count"] for r in mine if r["yes"]}
        no = {r["v"]: r["count"] for r in mine if not r["yes"]}
        k = 0.5 * max(1, len(yes.keys() | no.keys()))
        ny, nn = sum(yes.values()) + k, sum(no.values()) + k
        out[f] = {v: float(np.log((yes.get(v, 0) + 0.5) / ny) - np.log((no.get(v, 0) + 0.5) / nn)) for v in yes.keys() | no.keys()}
    return out


def prior_evidence() -> dict[str, dict[int, float]]:
    """What titles and entities say where too few references are known to count it: shared words for, open names and another body
    against a match; dates and traits say nothing then."""
    words = {}
    for code in range(2 * _EQUAL + 2):
        share, other = code // 80, code // 2 % 4
        words[code] = 1.2 * (share - 8) - 3.0 * other
    return {"words": words, "entity": {0: -3.0, 1: 0.0, 2: 2.0}, "dated": {}, "trait": {}}


def calibrate(scored: DataFrame) -> tuple[float, float]:
    """Slope and bias of the logistic fit of the score to whether the references agree, on counts over all pairs."""
    binned = scored.where("reference <> 5").groupBy(F.round(F.greatest(F.lit(-30.0), F.least(F.lit(30.0), "z")), 1).alias("z"), (F.col("reference") == 10).alias("yes")).agg(F.sum("n").alias("count"))
    rows = binned.collect()  # at most 2 * 601 rows
    if min((sum(r["count"] for r in rows if r["yes"] == yes) for yes in (True, False))) < LEAST_TOLD:
        return 1.0, 0.0
    z = np.array([r["z"] for r in rows])
    y = np.array([r["yes"] for r in rows], float)
    weight = np.array([r["count"] for r in rows], float)
    weight /= weight.sum()
    s, b = 1.0, 0.0
    for _ in range(50):  # Newton's method on two numbers
        p = 1 / (1 + np.exp(-np.clip(s * z + b, -40, 40)))
        g = np.array([(weight * (p - y) * z).sum(), (weight * (p - y)).sum()]) + 1e-4 * np.array([s - 1.0, b])
        q = weight * p * (1 - p)
        h = np.array([[(q * z * z).sum(), (q * z).sum()], [(q * z).sum(), q.sum()]]) + 1e-4 * np.eye(2)
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        s, b = max(0.05, s - step[0]), b - step[1]
    return float(s), float(b)


def _date_windows(records: DataFrame) -> dict[int, tuple[int, int]]:
    """For each basis the days between left and right within which pairs of one title and one reference lie, a little widened."""
    known = records.where("ref_no <> '' and day is not null").withColumn("k", F.xxhash64("words", "lot", "fy", "series", "ref_year", "ref_no"))
    t = known.where("side = 0").select("k", "basis", F.col("day").alias("td"))
    a = known.where("side = 1").select("k", F.col("day").alias("ad"))
    rows = t.join(a, "k").select("basis", F.greatest(F.lit(-REACH), F.least(F.lit(REACH), F.col("ad") - F.col("td"))).alias("gap")).groupBy("basis", "gap").count().collect()
    out = {}
    for basis in {r["basis"] for r in rows}:
        mine = sorted((r["gap"], r["count"]) for r in rows if r["basis"] == basis)
        gaps, n = np.array(mine).T
        if n.sum() >= LEAST_DATED:
            share = np.cumsum(n) / n.sum()
            lo, hi = int(gaps[np.searchsorted(share, OUTSIDE)]), int(gaps[np.searchsorted(share, 1 - OUTSIDE)])
            out[int(basis)] = (lo - max(2, (hi - lo) // 20), hi + max(2, (hi - lo) // 20))
    return out


def match_records(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left_id``, ``right_id``, ``confidence`` of the matches, at most one for a record on either side.

    Both inputs have id, title, entity, reference and day (int, days since 1970); the left one also basis (int, what kind of
    date day is) and trait (any text that may tell for or against a match). Records with a null or blank title or id are left
    out; of repeated ids the caller keeps one row. All other columns may be null: what is unknown tells nothing. Ties go to the
    closer date, then the smaller ids. Empty tables give no row.
    """
    trait = F.pmod(F.xxhash64(F.lower(F.trim(F.coalesce(F.col("trait").cast("string"), F.lit(""))))), F.lit(TRAITS)).cast("int")
    common = ["id", "title", "entity", "reference", F.col("day").cast("int").alias("day")]
    sides = [
        left.select(F.col("id").cast("string").alias("rid"), F.lit(0).alias("side"), *common[1:], F.coalesce(F.col("basis").cast("int"), F.lit(0)).alias("basis"), trait.alias("trait")),
        right.select(F.col("id").cast("string").alias("rid"), F.lit(1).alias("side"), *common[1:], F.lit(0).alias("basis"), F.lit(0).alias("trait")),
    ]
    both = sides[0].unionByName(sides[1]).where(F.col("rid").isNotNull() & (F.length(F.trim("title")) > 0))
    spark = both.sparkSession
    records = cut_table(both.mapInArrow(_describe_batches, _SHAPE).withColumn("node", F.xxhash64("rid", "side")))
    release(spark)
    kind = "left_id string, right_id string, confidence double"
    counts = {r["side"]: r["count"] for r in records.groupBy("side").count().collect()}
    if len(counts) < 2:
        return spark.createDataFrame([], kind)
    n = sum(counts.values())

    walks = cut_table(random_walks(records))  # the training reads them twice
    vectors = train_vectors(walks, max(1, spark.sparkContext.defaultParallelism))
    drop_table(walks)
    release(spark)
    groups, known_words = frequencies(records)
    table = vectors[:BUCKETS] * np.minimum(np.log((n + 1.0) / np.maximum(groups, 1)), MOST_WEIGHT).astype(np.float32)[:, None]
    common = known_words >= max(3.0, COMMON_WORD * n)
    mean, turn = whitening(records, table)
    title = F.xxhash64("words", "lot", "fy")
    number = F.when(F.col("ref_no") != "", F.xxhash64(F.lit("reference"), "ref_year", "ref_no", "lot", "fy"))
    often = records.select(F.explode(F.array(title, number)).alias("k")).where("k is not null").groupBy("k").count().where(F.col("count") >= max(float(COMMON_LEAST), COMMON_TITLE * n))
    frequent = {r["k"]: r["count"] for r in often.collect()}  # at most 2 / COMMON_TITLE
    common_keys = sorted(frequent)
    windows = _date_windows(records)

    bits = int(np.clip(np.ceil(np.log2(counts[0])) + SPARE_BITS, 8, 40))
    planes = np.random.default_rng(17).standard_normal((DIMENSIONS, TABLES * bits)).astype(np.float32)
    flat_planes = np.random.default_rng(18).standard_normal((DIMENSIONS, 40)).astype(np.float32)
    shared = spark.sparkContext.broadcast((table, mean, turn, planes, vectors[BUCKETS:], flat_planes, common))

    def hashed(side: int):  # noqa: ANN202
        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, mean, turn, planes, attributes, flat, common = shared.value
            power, sums = (1 << np.arange(bits)).astype(np.int64), Sums(table)
            named_by = Names(common)
            for whole in it:
                for at in range(0, len(whole), 2_000):
                    words, *parts = (whole.column(c).slice(at, 2_000).to_pylist() for c in ("words", "ref_year", "ref_no", "head", "rest"))
                    titles = [x.split() for x in words]
                    v = _unit((_unit(sums(titles)) - mean) @ turn)
                    margin = (v @ planes).reshape(len(v), TABLES, bits)
                    base = (margin > 0) @ power
                    keys = [base]
                    if side:
                        unsure = np.abs(margin).argpartition(UNSURE, axis=2)[:, :, :UNSURE]
                        flips = power[unsure] * np.where(np.take_along_axis(margin, unsure, 2) > 0, -1, 1)
                        keys = [base + sum((flips[:, :, j] for j in range(UNSURE) if s >> j & 1), np.zeros_like(base)) for s in range(1 << UNSURE)]
                    names = np.ascontiguousarray(named_by.of(titles))
                    views = np.concatenate([k.astype(np.int64) * TABLES + np.arange(TABLES) for k in keys] + [np.zeros((len(titles), 1), np.int64)], axis=1)
                    # the attributes' own vectors: reference and entity
                    refs = np.array([r != "" for r in parts[1]])
                    named = [[_hash(f"reference:{y}/{r}"), _hash(f"entity:{h}/{e}")] for y, r, h, e in zip(*parts) if r != ""]
                    if named:
                        b = np.array(named) & (BUCKETS - 1)
                        views[refs, -1] = -1 - ((attributes[b[:, 0]] + 0.5 * attributes[b[:, 1]]) @ flat > 0) @ (1 << np.arange(40)).astype(np.int64)
                    kept = np.ones(views.shape, bool)
                    kept[:, -1] = refs
                    ends = np.cumsum(kept.sum(axis=1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(views[kept])), *(whole.column(c).slice(at, len(titles)) for c in ("node", "exact", "day", "basis")), *map(pa.array, names.T.copy())],
                        ["keys", "node", "exact", "day", "basis", "x", "y"],
                    )

        columns = ["node", "words", "ref_year", "ref_no", "head", "rest", "day", "basis", F.xxhash64("lot", "fy").alias("exact")]
        mine = records.where(F.col("side") == side)
        marked = mine.where(~title.isin(common_keys)).select(*columns)
        if frequent:  # a common title stands once for all its records; its key is its node
            none = lambda c, kind: F.lit(None).cast(kind).alias(c)
            once = mine.where(title.isin(common_keys)).groupBy(title.alias("node")).agg(F.first("words").alias("words"), F.first(F.xxhash64("lot", "fy")).alias("exact"))
            empty = [F.lit("").alias(c) for c in ("ref_year", "ref_no", "head", "rest")]
            marked = marked.unionByName(once.select("node", "words", *empty, none("day", "int"), F.lit(0).alias("basis"), "exact"))
        rows = marked.mapInArrow(run, "keys array<bigint>, node bigint, exact bigint, day int, basis int, x bigint, y bigint")
        rows = rows.select(F.explode("keys").alias("k"), "node", "exact", "day", "basis", "x", "y")
        blocks = rows.select(F.xxhash64("k", "exact").alias("key"), "node", "day", "basis", "x", "y", F.lit(False).alias("sure"))
        # one reference, where at most one of the two lacks its series or both do; a reference that many have is no sure sign
        open_left, open_right, both_open = F.lit("left?"), F.lit("right?"), F.lit("?")
        given = F.array(F.col("series"), open_right if side == 0 else open_left)
        series = F.explode(F.when(F.col("series") != "", given).otherwise(F.array(open_left if side == 0 else open_right, both_open)))
        told = mine.where("ref_no <> ''").select(number.alias("number"), series.alias("series"), "node", "words", "day", "basis")
        told = told.withColumn("sure", ~F.col("number").isin(common_keys))
        return blocks.unionByName(told.select(F.xxhash64("number", "series").alias("key"), "node", "day", "basis", F.lit(0).cast("bigint").alias("x"), F.lit(0).cast("bigint").alias("y"), "sure").where("sure"))

    t = hashed(0).select("key", F.col("node").alias("tn"), F.col("day").alias("td"), "basis", F.col("x").alias("tx"), F.col("y").alias("ty"), "sure")
    a = hashed(1).select("key", F.col("node").alias("an"), F.col("day").alias("ad"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    gap = F.col("ad") - F.col("td")
    dated = reduce(Column.__and__, [(F.col("basis") != basis) | gap.isNull() | gap.between(lo, hi) for basis, (lo, hi) in windows.items()], F.lit(True))
    bits = lambda p: F.bit_count(f"{p}x") + F.bit_count(f"{p}y")
    shared_bits = F.bit_count(F.col("tx").bitwiseAND(F.col("ax"))) + F.bit_count(F.col("ty").bitwiseAND(F.col("ay")))
    named = shared_bits >= F.least(bits("t"), bits("a")) * SHARED_NAMES
    pairs = t.join(a, "key").where(F.col("sure") | (dated & named)).groupBy("tn", "an").agg(F.max(~F.col("sure")).alias("told"))
    if not frequent:
        met = cut_table(pairs)
    else:
        titles = cut_table(pairs)
        met = cut_table(_each_record(titles, records.withColumn("title", title), frequent, dated).groupBy("tn", "an").agg(F.max("told").alias("told")))
        drop_table(titles)
    release(spark)
    side = lambda k, p: records.where(F.col("side") == k).select(
        F.col("node").alias(f"{p}n"), F.col("rid").alias(f"{p}id"), F.col("words").alias(f"{p}words"), F.col("phase").alias(f"{p}phase"), F.col("head").alias(f"{p}head"),
        F.col("rest").alias(f"{p}rest"), F.col("short").alias(f"{p}short"), F.col("series").alias(f"{p}1"), F.col("ref_year").alias(f"{p}2"), F.col("ref_no").alias(f"{p}3"),
        F.col("day").alias(f"{p}d"), title.isin(common_keys).alias(f"{p}common"), *([F.col("basis"), F.col("trait")] if k == 0 else []),
    )
    wide = met.join(side(0, "t").hint("shuffle_hash"), "tn").join(side(1, "a"), "an").where("tphase = aphase or tphase = '' or aphase = ''")
    # a common title beside another one is weighed as any two titles are, but tells nothing: there are too many of such pairs
    same = F.col("tcommon") & (F.col("twords") == F.col("awords"))
    wide = wide.withColumn("common", same).withColumn("told", F.col("told") & (same | ~(F.col("tcommon") | F.col("acommon"))))
    agree = (F.col("t3") != "") & (F.col("t2") == F.col("a2")) & (F.col("t3") == F.col("a3"))
    ranking = spark.sparkContext.broadcast((table, mean, turn, common))
    c = lambda *names: [F.col(n) for n in names]
    gap = F.col("ad") - F.col("td")
    dated = F.coalesce(F.col("basis") * 10_000 + F.floor((F.greatest(F.lit(-REACH), F.least(F.lit(REACH), gap)) + REACH) / BIN), F.lit(-1)).cast("int")
    ranked = cut_table(
        wide.withColumn("alone", F.count_if(agree & F.col("told")).over(Window.partitionBy("an")) == 1)
        .select(
            "tid", "aid", gap.alias("gap"), (_title_codes(ranking)("twords", "awords") * 2 + (F.col("tphase") == F.col("aphase")).cast("int")).alias("words"),
            _entity_state(*c("thead", "trest", "tshort", "ahead", "arest", "ashort")).alias("entity"), dated.alias("dated"), "trait",
            _reference_state(*c("t1", "t2", "t3", "a1", "a2", "a3")).alias("reference"), "alone",
            "common", "told",
        )
    )
    for b in (shared, ranking):
        b.unpersist()
    for x in (records, met):
        drop_table(x)
    release(spark)
    if not frequent:
        return _decide(_likely(ranked)[0])
    plain, typed = _likely(ranked.where("not common"))
    return _decide(plain.unionByName(_likely(ranked.where("common"), typed)[0]))


def _each_record(met: DataFrame, records: DataFrame, frequent: dict[int, int], dated: Column) -> DataFrame:
    """``met`` with every record of a common title in the place of the title; the join is split into slices of its records.

    Pairs of two records are kept as they are, so the window of dates holds for those of a common title only.
    """
    counts = met.sparkSession.createDataFrame([(k, -(-n // SLICE)) for k, n in frequent.items()], "title long, slices int")
    members = records.join(F.broadcast(counts), "title").withColumn("slice", F.pmod(F.xxhash64("node"), "slices").cast("int"))
    days = records.select("node", "side", "day", "basis")
    keys = sorted(frequent)

    def filled(pairs: DataFrame, side: int) -> DataFrame:
        p = "ta"[side]
        known = [F.col("day").alias(f"{p}d"), *([] if side else ["basis"])]
        one = pairs.where(~F.col(f"{p}n").isin(keys)).join(days.where(F.col("side") == side).select(F.col("node").alias(f"{p}n"), *known), f"{p}n")
        sliced = pairs.join(F.broadcast(counts.withColumnRenamed("title", f"{p}n")), f"{p}n").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        mine = members.where(F.col("side") == side).select(F.col("title").alias(f"{p}n"), "slice", "node", *known)
        many = sliced.join(mine, [f"{p}n", "slice"]).drop(f"{p}n", "slice", "slices").withColumnRenamed("node", f"{p}n")
        return one.unionByName(many)

    either = F.col("tn").isin(keys) | F.col("an").isin(keys)
    return met.where(~either).unionByName(filled(filled(met.where(either), 0), 1).where(dated).select("tn", "an", "told"))


def _likely(ranked: DataFrame, typed: dict[int, float] | None = None) -> tuple[DataFrame, dict[int, float]]:
    """The pairs of ``MIN_CONFIDENCE`` or more, by what all of ``ranked`` say, and how the references of matches are typed.

    Where titles say nothing, hardly a feature but the reference tells a match, so what references say cannot be counted there.
    How those of matches are typed is given then (``typed``), and those of others are what is left of all pairs.
    """
    # pairs that met by their reference alone are weighed, but tell nothing
    counted = cut_table(ranked.where("told").groupBy(*_FEATURES, "reference", "alone").agg(F.count("*").alias("n")))
    said = evidence(counted)

    def weigh(feature: str, values: dict[int, float]):  # noqa: ANN202
        if not values:
            return F.lit(0.0)
        if min(values) >= 0 and max(values) < 4 * len(values):
            known = F.array(*[F.lit(values.get(v, 0.0)) for v in range(max(values) + 1)])
            return F.coalesce(F.get(known, F.col(feature)), F.lit(0.0))
        known = F.create_map(*[x for v, e in sorted(values.items()) for x in (F.lit(v), F.lit(e))])
        return F.coalesce(known[F.col(feature)], F.lit(0.0))

    score = sum((weigh(f, said[f]) for f in _FEATURES), F.lit(0.0))
    scored, told = ranked.withColumn("z", score), counted.withColumn("z", score)
    slope, bias = calibrate(told)
    # what the references say, among pairs that are likely or unlikely without them
    p = 1 / (1 + F.exp(-(F.lit(slope) * F.col("z") + F.lit(bias))))
    rows = told.select("reference", "n", p.alias("p")).groupBy("reference").agg(F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no")).collect()
    drop_table(counted)
    yes, no = sum(r["yes"] for r in rows) + 2, sum(r["no"] for r in rows) + 2
    refs = {r["reference"]: float(np.log((r["yes"] + 0.5) / yes) - np.log((r["no"] + 0.5) / no)) for r in rows}
    if typed:
        expected, every = yes - 2, yes + no - 4
        refs = {r["reference"]: float(np.log(typed[r["reference"]]) - np.log(max(0.5, r["yes"] + r["no"] - expected * typed[r["reference"]]) / (every - expected + 2))) for r in rows}
    shares = {k: (sum(r["yes"] for r in rows if r["reference"] == k) + LEAST_TOLD * v) / (yes - 2 + LEAST_TOLD) for k, v in TYPED.items()}
    total = F.lit(slope) * F.col("z") + F.lit(bias) + weigh("reference", refs)
    likely = scored.withColumn("s", total).withColumn("confidence", 1 / (1 + F.exp(-F.col("s")))).where(F.col("confidence") >= MIN_CONFIDENCE)
    apart = F.abs(F.coalesce("gap", F.lit(1_000_000)))
    return likely.select("tid", "aid", "confidence", F.round("s", 6).alias("s"), apart.alias("apart")), shares


def _decide(likely: DataFrame) -> DataFrame:
    """Pairs of which each side is the other's best."""
    of_award = Window.partitionBy("aid").orderBy(F.desc("s"), "apart", "tid")
    of_tender = Window.partitionBy("tid").orderBy(F.desc("s"), "apart", "aid")
    best = likely.withColumn("ra", F.row_number().over(of_award)).withColumn("rt", F.row_number().over(of_tender))
    return best.where("ra = 1 and rt = 1").select(F.col("tid").alias("left_id"), F.col("aid").alias("right_id"), "confidence")
