"""Variant spellings of names typed by people, linked by a pigeonhole segment join.

A name is first taken apart: titles, legal forms and articles go, abbreviations and misspelt common words are read as the
common word they stand for, and what is left is a *head* (the words only this entity has, in any order), a *rest* (the common
words, as a set) and, for people, a given name and a middle initial. Common words and abbreviations are learnt from the names
themselves, beside short lists of general ones. Two names with the same rest are the same
entity if their heads differ by few edits. To find these pairs a head is cut into k+1 segments: with at most k edits one
segment stays whole and only moves by up to k places. Every name puts its segments in an inverted index and looks up its
own substrings, shifted; what meets is verified by banded edit distance. Index keys hold the rest as well, which keeps
lists short where a common word is shared by a third of all names.

Names are made distinct first, with map-side combine, so a name that holds a third of the rows costs one row. Links
become entities by hash-to-min over checkpointed tables; no name or link is collected, only the words learnt.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import permutations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarind.session import cut

# Legal forms, titles and articles, which tell nothing about who is meant.
DROPPED = "ltd limited inc incorporated llc llp plc the ms mr mrs miss dr of and for jamaica in a an"
# Common words of the names of public bodies and of firms.
COMMON = (
    "ministry department institute development board national agency authority commission corporation municipal regional "
    "health general hospital primary high school saint "
    "civil registration community clinics consumer redress craft trades coastal works digital services drainage early learning "
    "energy savings fisheries flood relief forest reserves harbour safety heritage sites housing repair irrigation land survey "
    "market port logistics public records rural transport meals sports grounds street lighting waste recovery youth training "
    "associates bayview brothers caribbean company eastern enterprises equipment global group hillside international northern "
    "partners sons tropical "
    "air conditioning auto parts catering construction consulting dredging electrical engineering fencing furniture haulage "
    "janitorial laboratory landscaping medical office paving pharmaceuticals plumbing printing roofing security software steel "
    "supplies surveying roads bridges"
)
#: Words that say what a firm does or what kind of body it is; a name without any has had that part dropped.
TRADES = (
    "air conditioning auto parts catering construction consulting dredging electrical engineering fencing furniture haulage "
    "janitorial laboratory landscaping medical office paving pharmaceuticals plumbing printing roofing security software steel "
    "supplies surveying services works waste"
)
# Abbreviations that are no beginning and no squeezed form of their word, or would fit several.
SHORT = {
    "st": "saint", "co": "company", "bros": "brothers", "svcs": "services", "serv": "services", "svc": "services",
    "sec": "security", "med": "medical", "const": "construction", "constr": "construction", "eng": "engineering",
    "engineers": "engineering", "engrg": "engineering", "gen": "general", "reg": "regional", "sch": "school",
    "schl": "school", "comm": "commission", "commn": "commission", "corp": "corporation", "corpn": "corporation",
    "mun": "municipal", "munic": "municipal", "dev": "development", "devt": "development", "min": "ministry",
    "mnstry": "ministry", "dept": "department", "inst": "institute", "natl": "national", "prim": "primary",
    "hosp": "hospital", "auth": "authority", "authy": "authority", "agcy": "agency", "lab": "laboratory",
    "supp": "supplies", "suppl": "supplies", "assoc": "associates", "assocs": "associates", "intl": "international",
    "ent": "enterprises", "entprs": "enterprises", "equip": "equipment", "carib": "caribbean", "ptnrs": "partners",
    "pharm": "pharmaceuticals", "pharma": "pharmaceuticals", "elec": "electrical", "consult": "consulting",
    "regnl": "regional", "constn": "construction", "electl": "electrical", "surveyg": "surveying",
    "lscaping": "landscaping", "consting": "consulting",
}
# Given names and the short forms people use for them.
GIVEN = {
    "alexander": "alex sandy", "anthony": "tony", "benjamin": "ben benny", "christopher": "chris kit", "deborah": "debbie deb",
    "edward": "ed eddie ted ned", "elizabeth": "liz beth betty lizzie eliza", "jennifer": "jenny jen", "joseph": "joe joey",
    "katherine": "kate kathy katie kay", "margaret": "maggie peggy meg", "michael": "mike mick mickey", "nicholas": "nick nicky",
    "patricia": "pat tricia patty trish", "rebecca": "becky becca", "richard": "rick dick rich richie", "robert": "rob bob bobby robbie",
    "samuel": "sam sammy", "theodore": "theo ted teddy", "thomas": "tom tommy", "victoria": "vicky vic tori", "william": "will bill billy liam",
}

_DROPPED = frozenset(DROPPED.split())
_TRADES = frozenset(TRADES.split())
_NICK: dict[str, list[str]] = {}
for _full, _shorts in GIVEN.items():
    for _s in (_full, *_shorts.split()):
        _NICK.setdefault(_s, []).append(_full)

#: A word with so many different partners in names is a common one, if so large a share of all distinct names has it; so there are
#: at most as many common words as words a name times 1 / COMMON_SHARE, whatever the data.
COMMON_PARTNERS, COMMON_SHARE = 24, 0.0005
#: Partners that occur in fewer distinct names are misspellings, most likely, and do not count.
PARTNER_NAMES = 3
#: Share of an abbreviation's names that must also be there with the word it stands for, and the share of all distinct names that
#: an abbreviation must have: so there are at most as many as words a name times 1 / SHORT_LEAST.
SHORT_SHARE, SHORT_LEAST = 0.1, 0.00005


def edits(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours, in a band of ``most`` around the diagonal; ``most + 1`` if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    far = most + 1
    before, last = None, [j if j <= most else far for j in range(len(b) + 1)]
    for i in range(1, len(a) + 1):
        now = [far] * (len(b) + 1)
        if i <= most:
            now[0] = i
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            v = min(last[j] + 1, now[j - 1] + 1, last[j - 1] + (a[i - 1] != b[j - 1]))
            if before is not None and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                v = min(v, before[j - 2] + 1)
            now[j] = min(v, far)
        if min(now) > most:
            return far
        before, last = last, now
    return min(last[-1], far)


def allowed(length: int) -> int:
    """Edits granted to a head of that length."""
    return 0 if length < 4 else 1 if length < 14 else 2


def less_one(word: str) -> set[str]:
    """``word`` and all that is left of it without one letter: words one edit apart have one of these in common."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


def _neighbours(words: list[str]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for w in words:
        for d in less_one(w):
            out.setdefault(d, []).append(w)
    return out


def _one_edit(token: str, index: dict[str, list[str]]) -> set[str]:
    return {w for d in less_one(token) for w in index.get(d, ()) if edits(token, w, 1) <= 1}


class Lexicon:
    """Common words and their abbreviations: the general ones above, and what :func:`learn` finds in the data."""

    def __init__(self, common: Iterable[str] = (), short: dict[str, str] | None = None):
        self.short = {**(short or {}), **SHORT}
        self.common = (frozenset(COMMON.split()) | frozenset(common)) - self.short.keys()
        self._near_common = _neighbours([w for w in self.common if len(w) >= 4])
        self._near_short = _neighbours([w for w in self.short if len(w) >= 5])
        self._by_first: dict[str, list[str]] = {}
        for w in sorted(self.common):
            self._by_first.setdefault(w[0], []).append(w)
        self._cache: dict[str, str] = {}

    def word(self, token: str) -> str:
        """The common word that ``token`` is, abbreviates or misspells, '' for a misspelt legal form; else ``token``."""
        known = self._cache.get(token)
        if known is None:
            known = self._look(token)
            if len(self._cache) < 200_000:
                self._cache[token] = known
        return known

    def _look(self, token: str) -> str:
        if token in self.common:
            return token
        if token in self.short:
            return self.short[token]
        if len(token) >= 6 and any(edits(token, w, 1) <= 1 for w in ("limited", "incorporated")):
            return ""
        near = sorted(_one_edit(token, self._near_common)) if len(token) >= 4 else []
        if not near and 4 <= len(token) <= 6:
            near = [w for w in self._by_first.get(token[0], ()) if len(w) >= len(token) + 2 and (w.startswith(token) or w[-1] == token[-1] and _squeezed(token, w))]
        if not near and len(token) >= 5:
            near = sorted({self.short[w] for w in _one_edit(token, self._near_short)})
        return near[0] if len(near) == 1 else token


def _squeezed(token: str, word: str) -> bool:
    """Whether ``token`` is ``word`` with letters left out, the first one kept."""
    rest = iter(word)
    return token[0] == word[0] and all(c in rest for c in token)


def _given(token: str) -> list[str]:
    if token in _NICK:
        return _NICK[token]
    if len(token) >= 5:
        return [g for g in GIVEN if edits(token, g, 1) <= 1]
    return []


_GENERAL: list[Lexicon] = []


def general() -> Lexicon:
    """The lexicon without anything learnt."""
    if not _GENERAL:
        _GENERAL.append(Lexicon())
    return _GENERAL[0]


def take_apart(raw: str, people: bool, lexicon: Lexicon | None = None) -> tuple[str, str, str, str] | None:
    """(form, head, rest, middle) of a name; None if nothing is left of it.

    form is ``body``, ``short`` (initials of a body), ``person`` (rest is the given name) or ``initial`` (rest is its first
    letter); a nickname of several given names is ``nick``, with the names joined by ``|``. The words of a head are separated by
    blanks, in the order typed.
    """
    lexicon = lexicon or general()
    text = unicodedata.normalize("NFKD", raw)
    text = "".join(c for c in text if not unicodedata.combining(c))
    text = re.sub(r"\s+", " ", text).strip()
    if not people:
        bare = text.replace(".", "")
        if re.fullmatch(r"[A-Z]{2,8}", bare):
            return ("short", bare.lower(), "", "")
        text = re.sub(r"^[A-Z.]{2,10} - |\s*\([A-Z.]{2,10}\)\s*$", "", text)
    text = re.sub(r"\bm/s\b", " ", text.lower())
    text = re.sub(r"[’'`.]", lambda m: "" if m.group() != "." else " ", text).replace("+", " and ").replace("&", " and ")
    tokens = re.findall(r"[a-z0-9]+", text)
    words = [w for w in tokens if w not in _DROPPED]
    if people:
        person = _person([w for w in tokens if len(w) == 1 or w not in _DROPPED], lexicon)
        if person:
            return person
    joined: list[str] = []
    for w in words:
        c = lexicon.word(w)
        if not c:
            continue
        if joined and joined[-1][0] == "part" and w not in lexicon.common and w not in lexicon.short:
            joined[-1] = ("word", joined[-1][1] + w)
        elif not joined and len(w) <= 4 and c not in lexicon.common:
            joined.append(("part", w))
        else:
            joined.append(("word", c))
    flat = [w for _, w in joined]
    rest = sorted({w for w in flat if w in lexicon.common})
    if people and len(rest) > 1 and "company" in rest and not re.search(r"\band\s+co(mpany)?\b", text):
        rest.remove("company")
    head = [w for w in flat if w not in lexicon.common]
    if not head and not rest:
        return None
    return ("body", " ".join(head), " ".join(rest), "")


def _person(words: list[str], lexicon: Lexicon) -> tuple[str, str, str, str] | None:
    letters = [w for w in words if len(w) == 1]
    names = [w for w in words if len(w) > 1]
    if len(names) == 2 and len(letters) <= 1:
        options = [(i, _given(n)) for i, n in enumerate(names)]
        exact = [(i, g) for i, g in options if names[i] in _NICK]
        found = exact or [(i, g) for i, g in options if g]
        if len(found) >= 1:
            i, g = found[0]
            if lexicon.word(names[1 - i]) in lexicon.common:
                return None
            middle = letters[0] if letters else ""
            return ("person" if len(g) == 1 else "nick", names[1 - i], "|".join(g), middle)
        return None
    if len(names) == 1 and 1 <= len(letters) <= 2 and lexicon.word(names[0]) not in lexicon.common:
        first = letters[0]
        return ("initial", names[0], first, letters[1] if len(letters) > 1 else "")
    return None


def acronyms(raw: str) -> list[str]:
    """The initials of a body's words, and the initials typed beside its name."""
    text = re.sub(r"\s+", " ", unicodedata.normalize("NFKD", raw)).strip()
    typed = re.findall(r"^([A-Z.]{2,10}) - |\(([A-Z.]{2,10})\)$", text)
    return [x.replace(".", "").lower() for pair in typed for x in pair if x]


def _segments(head: str, k: int) -> list[tuple[int, int]]:
    """Start and length of k+1 segments of about the same length."""
    n, parts = len(head), k + 1
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


#: Edits for which the index is cut: a swap of neighbours counts as two single edits here.
INDEX_EDITS = 2


def orders(head: str) -> list[str]:
    """A head's words run together in the orders they may have been typed in: all of them for up to three words; for more the
    order typed, each of its turns, and the alphabetical one."""
    words = head.split(" ")
    if len(words) == 1:
        return words
    if len(words) <= 3:
        return sorted({"".join(p) for p in permutations(words)})
    return sorted({"".join(words[i:] + words[:i]) for i in range(len(words))} | {"".join(sorted(words))})


def _index_keys(head: str) -> list[str]:
    return [f"{len(head)}:{i}:{head[a : a + n]}" for i, (a, n) in enumerate(_segments(head, INDEX_EDITS))]


def _probe_keys(head: str) -> list[str]:
    keys = set()
    for length in range(max(1, len(head) - INDEX_EDITS), len(head) + INDEX_EDITS + 1):
        parts = INDEX_EDITS + 1
        for i in range(parts):
            a, b = length * i // parts, length * (i + 1) // parts
            for at in range(max(0, a - INDEX_EDITS), min(len(head) - (b - a), a + INDEX_EDITS) + 1):
                keys.add(f"{length}:{i}:{head[at : at + b - a]}")
    return sorted(keys)


_PARTS = "kind string, raw string, form string, head string, rest string, middle string, typed array<string>"


def _apart(lexicon: tuple[frozenset[str], dict[str, str]]):  # noqa: ANN202
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Lexicon(*lexicon)
        for pdf in it:
            out = []
            for kind, raw in zip(pdf["kind"], pdf["raw"]):
                found = take_apart(raw, kind != "authority", known)
                if found:
                    out.append((kind, raw, *found, acronyms(raw) if kind == "authority" else []))
            yield pd.DataFrame(out, columns=["kind", "raw", "form", "head", "rest", "middle", "typed"])

    return run


def learn(distinct: DataFrame) -> tuple[frozenset[str], dict[str, str]]:
    """Common words of the names (kind, raw) given, and the abbreviations people use for them.

    A common word stands beside many different words. A shorter word that is one with letters left out is its abbreviation if
    both complete the same name: without them what is left of two names is the same. An abbreviation that so stands for several
    words stands for the one with more such names. What comes to the driver is bounded by ``COMMON_SHARE`` and ``SHORT_LEAST``.
    """
    bare = F.regexp_replace(F.regexp_replace(F.lower("raw"), r"['\u2019`.]", ""), "[^a-z0-9]+", " ")
    words = F.array_sort(F.array_distinct(F.filter(F.split(F.trim(bare), " "), lambda w: (F.length(w) > 1) & ~w.isin(sorted(_DROPPED)))))
    names = cut(distinct.select(words.alias("ws")).where(F.size("ws").between(2, 12)).distinct())
    n = names.count()
    counts = names.select(F.explode("ws").alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    often = counts.where(F.col("n") >= PARTNER_NAMES)
    pairs = names.select(F.explode("ws").alias("w"), "ws").select("w", F.explode("ws").alias("p")).where("w <> p").distinct()
    partners = pairs.join(often.select(F.col("w").alias("p")), "p").groupBy("w").agg(F.count("*").alias("partners"))
    wide = partners.join(counts, "w").where((F.col("partners") >= COMMON_PARTNERS) & (F.col("n") >= COMMON_SHARE * n) & (F.length("w") >= 4))
    rows = wide.select("w", "n").collect()
    seen = {r["w"]: r["n"] for r in rows}
    # a frequent misspelling of a frequent word is no word of its own
    near = _neighbours(sorted(seen))
    common = frozenset(w for w in seen if w not in _NICK and not any(x != w and seen[x] > 3 * seen[w] for x in _one_edit(w, near)))
    full = sorted(common | frozenset(COMMON.split()))
    by_first = {c: [w for w in full if w[0] == c] for c in {w[0] for w in full}}
    framed = names.select(F.explode("ws").alias("w"), "ws").select("w", F.xxhash64(F.array_join(F.array_remove("ws", F.col("w")), " ")).alias("frame"))

    @F.pandas_udf("array<string>")
    def stands_for(tokens: pd.Series) -> pd.Series:
        return pd.Series([[w for w in by_first.get(t[0], ()) if len(w) >= len(t) + 2 and _squeezed(t, w)] if len(t) <= 8 else [] for t in tokens])

    short = framed.select("w").distinct().select("w", F.explode(stands_for("w")).alias("long"))
    hits = framed.join(short, "w").join(framed.select(F.col("w").alias("long"), "frame"), ["long", "frame"]).groupBy("w", "long").agg(F.countDistinct("frame").alias("n"))
    own = framed.groupBy("w").agg(F.countDistinct("frame").alias("own"))
    best = hits.groupBy("w").agg(F.max(F.struct("n", "long")).alias("b"), F.sum("n").alias("all")).join(own, "w")
    best = best.where((F.col("b.n") * 2 > F.col("all")) & (F.col("b.n") >= SHORT_SHARE * F.col("own")) & (F.col("own") >= SHORT_LEAST * n))
    short_for = {r["w"]: r["long"] for r in best.where(~F.col("w").isin(sorted(_NICK))).select("w", F.col("b.long").alias("long")).collect()}
    # an abbreviation is no word of its own, and stands for what its word stands for
    for w in list(short_for):
        while short_for[w] in short_for:
            short_for[w] = short_for[short_for[w]]
    return common - short_for.keys(), short_for


def _keyed(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        out = []
        for node, kind, form, head, rest in zip(pdf["node"], pdf["kind"], pdf["form"], pdf["head"], pdf["rest"]):
            # the order typed is indexed, and the alphabetical one of many words; all orders are looked up
            words = head.split(" ")
            own = {k for x in {"".join(words), *(["".join(sorted(words))] if len(words) > 3 else [])} for k in _index_keys(x)}
            for k in own:
                out.append((f"{kind}|{form}|{rest}|{k}", node, head, True))
            for k in {k for x in orders(head) for k in _probe_keys(x)}:
                out.append((f"{kind}|{form}|{rest}|{k}", node, head, False))
        yield pd.DataFrame(out, columns=["key", "node", "head", "indexed"])


def near_heads(a: str, b: str) -> bool:
    """Whether two heads differ by the edits granted to the shorter one, in any order of the words of ``b``."""
    plain = a.replace(" ", "")
    k = allowed(min(len(plain), len(b.replace(" ", ""))))
    tried = orders(b)
    if edits(plain, b.replace(" ", ""), k) <= k or any(edits(plain, x, k) <= k for x in tried):
        return True
    words = a.split(" ")
    return len(words) > 3 and any(edits("".join(sorted(words)), x, k) <= k for x in tried)


@F.pandas_udf(T.BooleanType())
def _near(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([near_heads(x, y) for x, y in zip(a, b)])


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, entity) by hash-to-min: each round every node takes the least label among its neighbours' labels, and the labels'
    own labels; ends when none changes. ``edges`` holds (a, b) in both directions."""
    labels = cut(nodes.select("node", F.col("node").alias("entity")))
    if edges.isEmpty():
        return labels
    while True:
        offered = edges.join(labels, edges["b"] == labels["node"]).select(F.col("a").alias("node"), "entity")
        least = offered.unionByName(labels).groupBy("node").agg(F.min("entity").alias("entity"))
        jump = least.select(F.col("node").alias("entity"), F.col("entity").alias("via"))
        new = cut(least.join(jump, "entity", "left").select("node", F.coalesce(F.least("entity", "via"), F.col("entity")).alias("entity")))
        changed = not new.join(labels.select("node", F.col("entity").alias("was")), "node").where("entity <> was").isEmpty()
        labels = new
        if not changed:
            return labels


def link_names(names: DataFrame) -> DataFrame:
    """(kind, raw, entity) for the distinct names of ``names`` (kind, raw); ``kind`` is ``authority`` or any other for traders.

    Null and blank names have no entity; names of which nothing is left but legal forms have none either. A short form that
    fits several entities (initials, a firm without its trade, a person without the middle initial) stays on its own rather
    than joining them. Names of the same kind only are linked.
    """
    distinct = names.where(F.col("raw").isNotNull() & (F.trim("raw") != "")).distinct()
    lexicon = learn(distinct)
    parts = cut(distinct.mapInPandas(_apart(lexicon), _PARTS).withColumn("node", F.xxhash64("kind", "form", F.array_join(F.array_sort(F.split("head", " ")), " "), "rest")))
    nodes = parts.groupBy("node", "kind", "form", "rest").agg(F.min("head").alias("head"))

    # 1. the pigeonhole join among full names with the same rest
    full = nodes.where(F.col("form").isin("body", "person") & (F.length(F.replace("head", F.lit(" "), F.lit(""))) >= 4))
    keys = cut(full.mapInPandas(_keyed, "key string, node bigint, head string, indexed boolean"))
    index = keys.where("indexed").select("key", F.col("node").alias("a"), F.col("head").alias("ha"))
    probe = keys.where("not indexed").select("key", F.col("node").alias("b"), F.col("head").alias("hb"))
    pairs = index.join(probe, "key").where("a <> b").select("a", "b", "ha", "hb").distinct().where(_near("ha", "hb"))
    edges = cut(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    grouped = components(edges, nodes)

    # 2. people of one name are told apart by their middle initials, where there are several
    base = parts.join(grouped, "node")
    middles = base.where("form = 'person' and middle <> ''").groupBy("entity").agg(F.countDistinct("middle").alias("n_middle"))
    base = base.join(middles, "entity", "left").withColumn(
        "owner", F.when((F.col("form") == "person") & (F.col("n_middle") > 1), F.concat_ws("/", F.col("entity"), "middle")).otherwise(F.col("entity").cast("string"))
    )
    base = cut(base.select("kind", "raw", "form", "head", "rest", "middle", "typed", "owner", (F.col("n_middle") > 1).alias("split")))
    # persons without a middle initial among several namesakes are nobody's
    whole = base.where(F.col("form").isin("body", "person"))

    # 3. short forms, each by a key that only one entity may answer
    last = lambda c: F.element_at(F.split(c, " "), -1)  # noqa: E731,F841
    has_trade = F.exists(F.split("rest", " "), lambda w: w.isin(sorted(_TRADES)))
    people = whole.where("form = 'person' and (not coalesce(split, false) or middle <> '')")
    who = people.select("kind", "head", "rest", "middle", "owner").distinct()
    firms = whole.where("form = 'body' and kind <> 'authority'").withColumn("trade", has_trade)
    bodies = whole.where("form = 'body' and kind = 'authority'")

    offers = [
        # initials and a nickname of several names: the given name is left open
        who.select("kind", F.concat(F.lit("i|"), "head", F.lit("|"), F.substring("rest", 1, 1)).alias("key"), "middle", "owner"),
        who.select("kind", F.concat(F.lit("g|"), "head", F.lit("|"), "rest").alias("key"), "middle", "owner"),
        firms.where("trade").select(
            "kind",
            F.concat(F.lit("t|"), "head", F.lit("|"), F.array_join(F.filter(F.split("rest", " "), lambda w: ~w.isin(sorted(_TRADES))), " ")).alias("key"),
            F.lit("").alias("middle"), "owner",
        ),
        bodies.select("kind", F.concat(F.lit("a|"), _initials(F.col("raw"))).alias("key"), F.lit("").alias("middle"), "owner"),
        bodies.select("kind", F.explode("typed").alias("key"), "owner").select("kind", F.concat(F.lit("a|"), "key").alias("key"), F.lit("").alias("middle"), "owner"),
    ]
    offered = offers[0]
    for o in offers[1:]:
        offered = offered.unionByName(o)
    offered = offered.distinct()
    asks = (
        base.where("form = 'initial'").select("kind", "raw", "middle", F.concat(F.lit("i|"), "head", F.lit("|"), "rest").alias("key"))
        .unionByName(
            base.where("form = 'nick'").select("kind", "raw", "middle", "head", F.explode(F.split("rest", "\\|")).alias("g"))
            .select("kind", "raw", "middle", F.concat(F.lit("g|"), "head", F.lit("|"), "g").alias("key"))
        )
        .unionByName(firms.where("not trade").select("kind", "raw", "middle", F.concat(F.lit("t|"), "head", F.lit("|"), "rest").alias("key")))
        .unionByName(base.where("form = 'short'").select("kind", "raw", "middle", F.concat(F.lit("a|"), "head").alias("key")))
    )
    # a key answered by several entities is decided by a count, not by listing them
    few = offered.groupBy("kind", "key", "middle").agg(F.min("owner").alias("lo"), F.max("owner").alias("hi"))
    answers = (
        asks.join(few.withColumnRenamed("middle", "m"), ["kind", "key"])
        .where("middle = '' or m = '' or middle = m")
        .groupBy("kind", "raw").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .where("lo = hi").select("kind", "raw", F.col("lo").alias("found"))
    )
    out = base.join(answers, ["kind", "raw"], "left")
    alone = F.concat_ws("/", F.lit("own"), F.xxhash64("kind", "form", "head", "rest", "middle").cast("string"))
    unclear = F.col("form").isin("initial", "nick", "short")
    nobody = (F.col("form") == "person") & F.coalesce("split", F.lit(False)) & (F.col("middle") == "")
    return out.select(
        "kind", "raw",
        F.coalesce("found", F.when(unclear, alone).when(nobody, F.concat_ws("/", "owner", F.lit("open"))).otherwise(F.col("owner"))).alias("entity"),
    )


def _initials(raw):
    """Initials of a body's words, without small words, in the JVM."""
    bare = F.regexp_replace(F.regexp_replace(raw, r"^[A-Z.]{2,10} - |\s*\([A-Z.]{2,10}\)\s*$|, Jamaica\s*$", ""), r"[\s ]+", " ")
    words = F.filter(F.split(F.lower(F.trim(bare)), "[^a-z']+"), lambda w: (F.length(w) > 0) & ~w.isin("of", "and", "for", "the", "jamaica"))
    return F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")


def name_pairs(linked: DataFrame) -> DataFrame:
    """(name_kind, name_a, name_b), name_a < name_b by code point: every two spellings of one entity."""
    a = linked.select("kind", "entity", F.col("raw").alias("name_a"))
    b = linked.select("kind", "entity", F.col("raw").alias("name_b"))
    return a.join(b, ["kind", "entity"]).where("name_a < name_b").select(F.col("kind").alias("name_kind"), "name_a", "name_b")
