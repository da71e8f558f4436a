"""Text garbled by a wrong character encoding: find it and restore it by minimum description length.

A text is cut into sentences. For each sentence that holds signs beyond ASCII, every chain of wrong decodings that could
have made it is undone, run by run; a run that cannot have come about that way stays as it is. Each candidate, and the
sentence as it stands, is compressed with zstandard under a dictionary of each language, and the one with the shortest
description counts, the cost of its chain included. Where nothing is shorter the sentence is left unchanged. A replacement
sign (U+FFFD) is a garbled place that cannot be restored.

The dictionaries are fitted on a bounded sample of labelled documents (``DICT_DOCS`` a language, at most ``DICT_BYTES``);
everything else runs over all documents in one pass without a shuffle.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarind.session import spread

#: The bound of the sample that the dictionaries are fitted on.
DICT_DOCS = 200
DICT_BYTES = 48_000
#: Documents, and the share of all labelled ones, that a label needs to count as a language.
DICT_LEAST, DICT_SHARE = 5, 0.001

#: Chains of wrong decodings, undone from left to right: text in the one encoding, bytes in the other. The cost is in bytes
#: of description; chains that fit honest text by chance cost more.
CHAINS = {
    "cp1252>utf-8": ([("cp1252", "utf-8")], 0.5),
    "cp437>utf-8": ([("cp437", "utf-8")], 1.0),
    "cp850>utf-8": ([("cp850", "utf-8")], 1.0),
    "mac_roman>utf-8": ([("mac_roman", "utf-8")], 1.5),
    "cp1251>utf-8": ([("cp1251", "utf-8")], 1.0),
    "koi8_r>utf-8": ([("koi8_r", "utf-8")], 1.5),
    "cp1252>utf-8 twice": ([("cp1252", "utf-8")] * 2, 1.0),
    "cp1252>utf-8 thrice": ([("cp1252", "utf-8")] * 3, 1.5),
    "cp1251>cp1252": ([("cp1251", "cp1252")], 2.0),
    "mac_roman>cp1252": ([("mac_roman", "cp1252")], 3.0),
    "cp1252>gb18030": ([("cp1252", "gbk")], 4.0),
    "cp1252>shift_jis": ([("cp1252", "shift_jis")], 8.0),
}
_RUN = re.compile(r"[^\x00-\x7f]+")
_WIDE = re.compile(r"[^\x00-\x7f]+(?:[\x40-\x7e][^\x00-\x7f]+)*")
_SENTENCE = re.compile(r"(?<=[.!?。\n])\s+")
_CP1252_GAPS = {0x81, 0x8D, 0x8F, 0x90, 0x9D}


def _to_bytes(text: str, encoding: str) -> bytes:
    """``text`` in ``encoding``; the five bytes that cp1252 leaves open, and other C1 controls, stand for themselves."""
    if encoding != "cp1252":
        return text.encode(encoding)
    out = bytearray()
    for c in text:
        if 0x80 <= ord(c) <= 0x9F:
            out.append(ord(c))
        else:
            out += c.encode("cp1252")
    return bytes(out)


@lru_cache(100_000)
def _written(sign: str) -> bool:
    """Whether texts are written with that sign: any letter, mark, figure or symbol of any script, but no control or unassigned one."""
    return sign == "\n" or unicodedata.category(sign) not in ("Cc", "Cn", "Co", "Cs")


#: Bytes that a script costs which neither the languages here nor the sentence have: without it a pair of honest signs that by
#: chance are one sign of a rare script would look shorter than they are.
NEW_SCRIPT = 4.0


@lru_cache(100_000)
def _rare_script(sign: str) -> str:
    """The script of a sign that is none of the common letters and symbols here, else ''."""
    o = ord(sign)
    if (
        o < 0x250 or 0x370 <= o <= 0x4FF or 0x1E00 <= o <= 0x1EFF or 0x2010 <= o <= 0x206F or 0x20A0 <= o <= 0x20BF
        or 0x2100 <= o <= 0x22FF or 0x3000 <= o <= 0x30FF or 0x4E00 <= o <= 0x9FFF or 0xFF00 <= o <= 0xFFEF
    ):
        return ""
    return "symbol" if unicodedata.category(sign).startswith("S") else unicodedata.name(sign, "?").split(" ")[0]


def _new_scripts(now: str, before: str) -> int:
    return len({s for c in set(now) if (s := _rare_script(c))} - {_rare_script(c) for c in set(before)})


def _undo_run(run: str, source: str, target: str) -> str | None:
    try:
        back = _to_bytes(run, source).decode(target)
    except (UnicodeEncodeError, UnicodeDecodeError):
        return None
    return back if back != run else None


@lru_cache(200_000)
def _undo_steps(run: str, steps: tuple[tuple[str, str], ...]) -> str | None:
    """A run with all steps undone; None if they cannot have made it. Texts repeat few runs, so the answers are kept."""
    now = run
    for source, target in steps:
        back = "".join(_undo_run(x, source, target) or x if not x.isascii() else x for x in re.split(r"([^\x00-\x7f]+)", now))
        if back == now:
            return None
        now = back
    return now if all(map(_written, now)) else None


@lru_cache(200_000)
def _admits(run: str, chain: str) -> bool:
    """Whether a chain can have made a run, alone or with what stands around it."""
    (source, target), *more = CHAINS[chain][0]
    if target == "utf-8":
        return _undo_steps(run, tuple(CHAINS[chain][0])) is not None
    if source == "cp1251":
        return any("\u0400" <= c <= "\u04ff" for c in run)
    try:
        run.encode("latin-1" if source == "cp1252" else source, "strict" if source != "cp1252" else "ignore")
    except UnicodeEncodeError:
        return False
    return True


def undo(text: str, steps: list[tuple[str, str]]) -> str | None:
    """``text`` with each run that the chain can have made undone; None if there is none such."""
    first = steps[0]
    if first[1] in ("gbk", "shift_jis"):
        return _undo_wide(text, *first)
    if first == ("cp1251", "cp1252"):
        return _undo_cyrillic(text)
    if first == ("mac_roman", "cp1252"):
        return _undo_letters(text, *first)
    back = _RUN.sub(lambda m: _undo_steps(m.group(), tuple(steps)) or m.group(), text)
    return back if back != text else None


def _undo_wide(text: str, source: str, target: str) -> str | None:
    """Two-byte encodings: their second byte can be ASCII, and honest text can fit by chance, so common signs are asked for."""
    common = total = 0

    def one(m: re.Match) -> str:
        nonlocal common, total
        back = _undo_run(m.group(), source, target)
        if back is None:
            return m.group()
        for c in back:
            if ord(c) > 0x7F:
                total += 1
                b = c.encode(target)
                common += 0xB0 <= b[0] <= 0xD7 or b[0] in (0xA1, 0xA3) if target == "gbk" else 0x3040 <= ord(c) <= 0x30FF
        return back

    out = _WIDE.sub(one, text)
    return out if total >= 4 and common >= 0.7 * total else None


def _undo_cyrillic(text: str) -> str | None:
    """Cyrillic letters inside words in Latin letters; whole Cyrillic words are honest text."""
    if not re.search(r"[A-Za-z][Ѐ-ӿ]|[Ѐ-ӿ][A-Za-z]", text):
        return None
    out = re.sub(r"[Ѐ-ӿ]+", lambda m: _undo_run(m.group(), "cp1251", "cp1252") or m.group(), text)
    return out if out != text else None


#: Signs that honest text holds beside letters.
_TYPED = frozenset("’‘“”–—•…°²±½¿¡§©£€µ¶‰№\u00a0")


def _undo_letters(text: str, source: str, target: str) -> str | None:
    """One-byte encodings taken for one another: runs that become letters only.

    One run at least must stand behind a letter and be what no word holds there: a sign, or a capital after a small letter.
    """
    inside = False

    def one(m: re.Match) -> str:
        nonlocal inside
        run = m.group()
        if _TYPED & set(run):
            return run
        back = _undo_run(run, source, target)
        if back is None or not re.fullmatch(r"[À-ÖØ-öø-ÿ]+", back):
            return run
        before = text[m.start() - 1 : m.start()] if m.start() else ""
        inside |= before.isalpha() and (not run.isalpha() or (before.islower() and run[0].isupper()))
        return back

    out = _RUN.sub(one, text)
    return out if inside else None


class Describer:
    """Bytes that a text takes under the best of the languages' dictionaries."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.by_language = [
            zstandard.ZstdCompressor(level=9, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False)
            for d in dictionaries.values()
        ] or [zstandard.ZstdCompressor(level=9)]

    def cost(self, text: str) -> int:
        data = text.encode("utf-8", "surrogatepass")
        return min(len(c.compress(data)) for c in self.by_language)


def restore(text: str, describer: Describer) -> tuple[str, list[str]]:
    """The text with garbled sentences restored, and the chains undone; ``lost`` for signs that cannot be restored."""
    if text.isascii():
        return text, []
    chains: set[str] = set()
    parts = re.split(r"((?<=[.!?。\n])\s+)", text)
    for i, part in enumerate(parts):
        if part.isascii():
            continue
        best, best_chain = part, ""
        least = None
        runs = set(_RUN.findall(part))
        for name, (steps, price) in CHAINS.items():
            if not any(_admits(r, name) for r in runs):
                continue
            now = undo(part, steps)
            if now is None:
                continue
            if least is None:
                least = float(describer.cost(part))
            cost = describer.cost(now) + price + NEW_SCRIPT * _new_scripts(now, part)
            if cost < least:
                best, best_chain, least = now, name, cost
        if best_chain:
            parts[i] = best
            chains.add(best_chain)
    out = "".join(parts)
    if "�" in text or re.search(r"(?:â€|Ã¢â‚¬)(?![\w])", out):
        chains.add("lost")
    return out, sorted(chains)


def _honest(sentence: str) -> bool:
    """Whether a sentence may go into a dictionary: no chain can have made it, but for a few signs that fit two-byte encodings."""
    if "�" in sentence:
        return False
    for steps, _ in CHAINS.values():
        now = undo(sentence, steps)
        if now is not None and (steps[0][1] == "utf-8" or steps[0] == ("cp1251", "cp1252") or sum(c > "\u2e80" for c in now) >= 8):
            return False
    return True


def fit_dictionaries(docs: DataFrame, text: str, lang: str, languages: tuple[str, ...] | None = None) -> dict[str, bytes]:
    """A dictionary for each language of the data from at most ``DICT_DOCS`` labelled documents each, of honest sentences only.

    The documents are those with the least hash of their text, so the sample does not depend on the order of rows, and whole
    sentences are taken in the order of their hashes up to ``DICT_BYTES``. A label that fewer than ``DICT_LEAST`` documents, or a
    smaller share than ``DICT_SHARE`` of all, have is no language here, so the driver holds at most 1 / DICT_SHARE dictionaries.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("l"), F.col(text).alias("t"), F.xxhash64(text).alias("h"))
    if languages is None:
        counts = known.groupBy("l").agg(F.count("*").alias("n"), F.countDistinct("h").alias("d"))
        rows = counts.collect() if counts.limit(100_001).count() <= 100_000 else counts.where(F.col("n") >= DICT_LEAST).limit(100_000).collect()
        total = sum(r["n"] for r in rows)
        languages = tuple(sorted(r["l"] for r in rows if r["d"] >= DICT_LEAST and r["n"] >= DICT_SHARE * total)) or tuple(sorted(r["l"] for r in rows))[:10]
    place = F.row_number().over(Window.partitionBy("l").orderBy("h", "t"))
    sample = known.where(F.col("l").isin(*languages)) if languages else known.limit(0)
    kept: dict[str, dict[str, None]] = {}
    for r in sample.withColumn("n", place).where(F.col("n") <= DICT_DOCS).select("l", "t").collect():
        for s in _SENTENCE.split(r["t"]):
            if _honest(s):
                kept.setdefault(r["l"], {})[s] = None
    out = {}
    for language in sorted(kept):
        data = b""
        for s in sorted(kept[language], key=lambda s: (zlib.crc32(s.encode("utf-8", "ignore")), s)):
            more = s.encode("utf-8", "ignore") + b"\n"
            if len(data) + len(more) <= DICT_BYTES:
                data += more
        if data:
            out[language] = data
    return out


def restore_texts(docs: DataFrame, key: str, text: str, lang: str, dictionaries: dict[str, bytes] | None = None) -> DataFrame:
    """``key``, ``restored`` and ``chains`` of the documents with garbled sequences, restorable or not.

    Null, blank and plain ASCII texts have none and are filtered in the JVM. Repeated rows each give their own; an empty
    table gives none; ``lang`` is only used to fit the dictionaries and may be null or wrong.
    """
    fitted = fit_dictionaries(docs, text, lang) if dictionaries is None else dictionaries

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        describer = Describer(fitted)
        for pdf in it:
            out = []
            for k, t in zip(pdf["k"], pdf["t"]):
                now, chains = restore(t, describer)
                if chains:
                    out.append((k, now, chains))
            yield pd.DataFrame(out, columns=["k", "restored", "chains"])

    suspects = docs.where(F.col(text).rlike("[^\\x00-\\x7f]")).select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = dict(docs.dtypes)[key]
    return spread(suspects).mapInPandas(run, f"k {kind}, restored string, chains array<string>").withColumnRenamed("k", key)
