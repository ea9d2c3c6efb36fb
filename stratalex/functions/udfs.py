"""The few functions that no built-in expresses, as Arrow-batched pandas UDFs. Apply them to distinct values."""

from __future__ import annotations

import difflib
import unicodedata
from urllib.parse import urljoin, urlparse, urlunparse

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def _fold(text: pd.Series) -> pd.Series:
    return text.map(lambda x: x if x is None else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)))


def fold_diacritics_full(text: Column) -> Column:
    """Compatibility decomposition without combining marks, for any script. ASCII values stay out of Python."""
    return F.coalesce(_fold(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)


def jaro(a: str, b: str) -> float:
    """Share of matching characters within a sliding window, less half the transpositions."""
    if a == b:
        return 1.0 if a else 0.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used, first = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                first.append(c)
                break
    if not first:
        return 0.0
    second = [b[j] for j, u in enumerate(used) if u]
    m, t = len(first), sum(x != y for x, y in zip(first, second)) // 2
    return (m / len(a) + m / len(b) + (m - t) / m) / 3


def winkler(a: str, b: str, weight: float = 0.1) -> float:
    """Jaro with a boost for up to four leading characters, given only above 0.7."""
    score = jaro(a, b)
    if score <= 0.7:
        return score
    same = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        same += 1
    return min(1.0, score + same * min(0.25, max(0.0, weight)) * (1 - score))


def jaro_winkler(a: Column, b: Column, weight: float = 0.1) -> Column:
    @F.pandas_udf(T.DoubleType())
    def score(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else winkler(p, q, weight) for p, q in zip(x, y)], dtype="float64")

    return score(a, b)


_VOWELS = frozenset("AEIOUY")


class _Codes:
    """Primary and secondary code under way."""

    __slots__ = ("one", "two")

    def __init__(self) -> None:
        self.one, self.two = [], []

    def add(self, one: str, two: str | None = None) -> None:
        self.one.append(one)
        self.two.append(one if two is None else two)


def metaphone_codes(text: str | None) -> list[str]:
    """Sound codes of a label in the Double Metaphone manner: primary, then secondary where it differs.

    A rule table by letter: each rule is tried in order at a position and gives (primary, secondary, letters taken)."""
    letters = "".join(c if "a" <= c <= "z" else " " for c in (text or "").lower())
    word = " ".join(letters.split()).upper()
    if not word:
        return []
    codes, n = _Codes(), len(word)
    slavic = any(s in word for s in ("W", "K", "CZ", "WITZ"))

    def at(i: int, *options: str) -> bool:
        return i >= 0 and any(word.startswith(o, i) for o in options)

    def vowel(i: int) -> bool:
        return 0 <= i < n and word[i] in _VOWELS

    i = 0
    if at(0, "GN", "KN", "PN", "WR", "PS"):
        i = 1
    elif word[0] == "X":
        codes.add("S")
        i = 1
    while i < n:
        c, nxt = word[i], word[i + 1 : i + 2]
        step = 2 if nxt == c and c not in "AEIOUYHCGW " else 1
        if c in _VOWELS:
            if i == 0:
                codes.add("A")
        elif c == "B":
            codes.add("P")
        elif c == "C":
            if at(i, "CHIA"):
                codes.add("K")
                step = 2
            elif i == 0 and at(i, "CAESAR"):
                codes.add("S")
                step = 2
            elif at(i, "CH"):
                if i == 0 and at(1, "HARAC", "HARIS", "HOR", "HYM", "HIA", "HEM") and not at(0, "CHORE"):
                    codes.add("K")
                elif at(i - 2, "ORCHES", "ARCHIT", "ORCHID") or at(i + 2, "T", "S") or ((i == 0 or at(i - 1, "A", "O", "U", "E")) and at(i + 2, "L", "R", "N", "M", "B", "H", "F", "V", "W", " ")):
                    codes.add("K")
                elif i > 0:
                    codes.add("X", "K")
                else:
                    codes.add("X")
                step = 2
            elif at(i, "CZ") and not at(i - 2, "WICZ"):
                codes.add("S", "X")
                step = 2
            elif at(i + 1, "CIA"):
                codes.add("X")
                step = 3
            elif at(i, "CC") and not (i == 1 and word[0] == "M"):
                if at(i + 2, "I", "E", "H") and not at(i + 2, "HU"):
                    codes.add("KS" if (i == 1 and word[0] == "A") or at(i - 1, "UCCEE", "UCCES") else "X")
                    step = 3
                else:
                    codes.add("K")
                    step = 2
            elif at(i, "CK", "CG", "CQ"):
                codes.add("K")
                step = 2
            elif at(i, "CI", "CE", "CY"):
                codes.add("S", "X" if at(i, "CIO", "CIE", "CIA") else "S")
                step = 2
            else:
                codes.add("K")
                step = 3 if at(i + 1, " C", " Q", " G") else 2 if at(i + 1, "C", "K", "Q") and not at(i + 1, "CE", "CI") else 1
        elif c == "D":
            if at(i, "DG"):
                if at(i + 2, "I", "E", "Y"):
                    codes.add("J")
                    step = 3
                else:
                    codes.add("TK")
                    step = 2
            else:
                codes.add("T")
                step = 2 if at(i, "DT", "DD") else 1
        elif c == "F":
            codes.add("F")
        elif c == "G":
            if nxt == "H":
                if i > 0 and not vowel(i - 1):
                    codes.add("K")
                elif i == 0:
                    codes.add("J" if at(2, "I") else "K")
                elif (i > 1 and at(i - 2, "B", "H", "D")) or (i > 2 and at(i - 3, "B", "H", "D")) or (i > 3 and at(i - 4, "B", "H")):
                    pass
                elif i > 2 and word[i - 1] == "U" and at(i - 3, "C", "G", "L", "R", "T"):
                    codes.add("F")
                elif i > 0 and word[i - 1] != "I":
                    codes.add("K")
                step = 2
            elif nxt == "N":
                if i == 1 and vowel(0) and not slavic:
                    codes.add("KN", "N")
                elif not at(i + 2, "EY") and nxt != "Y" and not slavic:
                    codes.add("N", "KN")
                else:
                    codes.add("KN")
                step = 2
            elif at(i + 1, "LI") and not slavic:
                codes.add("KL", "L")
                step = 2
            elif i == 0 and (nxt == "Y" or at(1, "ES", "EP", "EB", "EL", "EY", "IB", "IL", "IN", "IE", "EI", "ER")):
                codes.add("K", "J")
                step = 2
            elif at(i + 1, "E", "I", "Y") or at(i - 1, "AGGI", "OGGI"):
                if at(0, "VAN ", "VON ", "SCH") or at(i + 1, "ET"):
                    codes.add("K")
                elif at(i + 1, "IER"):
                    codes.add("J")
                else:
                    codes.add("J", "K")
                step = 2
            else:
                codes.add("K")
                step = 2 if nxt == "G" else 1
        elif c == "H":
            if (i == 0 or vowel(i - 1)) and vowel(i + 1):
                codes.add("H")
                step = 2
        elif c == "J":
            if at(i, "JOSE") or at(0, "SAN "):
                codes.add("H")
            elif i == 0:
                codes.add("J", "A")
            elif vowel(i - 1) and not slavic and nxt in ("A", "O"):
                codes.add("J", "H")
            elif i == n - 1:
                codes.add("J", "")
            elif not at(i + 1, "L", "T", "K", "S", "N", "M", "B", "Z") and not at(i - 1, "S", "K", "L"):
                codes.add("J")
        elif c in "KQ":
            codes.add("K")
        elif c == "L":
            codes.add("L")
        elif c == "M":
            codes.add("M")
            if at(i - 1, "UMB") and (i + 1 == n - 1 or at(i + 2, "ER")):
                step = 2
        elif c == "N":
            codes.add("N")
        elif c == "P":
            if nxt == "H":
                codes.add("F")
                step = 2
            else:
                codes.add("P")
                step = 2 if nxt in ("P", "B") else 1
        elif c == "R":
            if i == n - 1 and not slavic and at(i - 2, "IE") and not at(i - 4, "ME", "MA"):
                codes.add("", "R")
            else:
                codes.add("R")
        elif c == "S":
            if at(i - 1, "ISL", "YSL"):
                step = 1
            elif i == 0 and at(i, "SUGAR"):
                codes.add("X", "S")
            elif at(i, "SH"):
                codes.add("S" if at(i + 1, "HEIM", "HOEK", "HOLM", "HOLZ") else "X")
                step = 2
            elif at(i, "SIO", "SIA"):
                codes.add("S", "S" if slavic else "X")
                step = 3
            elif (i == 0 and at(1, "M", "N", "L", "W")) or nxt == "Z":
                codes.add("S", "X")
                step = 2 if nxt == "Z" else 1
            elif at(i, "SC"):
                if at(i + 2, "H"):
                    if at(i + 3, "OO", "ER", "EN", "UY", "ED", "EM"):
                        codes.add("X" if at(i + 3, "ER", "EN") else "SK", "SK")
                    else:
                        codes.add("X", "S" if i == 0 and not vowel(3) and word[3:4] != "W" else "X")
                elif at(i + 2, "I", "E", "Y"):
                    codes.add("S")
                else:
                    codes.add("SK")
                step = 3
            else:
                codes.add(*(("", "S") if i == n - 1 and at(i - 2, "AI", "OI") else ("S", "S")))
                step = 2 if nxt in ("S", "Z") else 1
        elif c == "T":
            if at(i, "TION", "TIA", "TCH"):
                codes.add("X")
                step = 3
            elif at(i, "TH", "TTH"):
                codes.add(*(("T", "T") if at(i + 2, "OM", "AM") or at(0, "VAN ", "VON ", "SCH") else ("0", "T")))
                step = 2
            else:
                codes.add("T")
                step = 2 if nxt in ("T", "D") else 1
        elif c == "V":
            codes.add("F")
        elif c == "W":
            if at(i, "WR"):
                codes.add("R")
                step = 2
            elif i == 0 and (vowel(1) or at(0, "WH")):
                codes.add("A", "F" if vowel(1) else "A")
            elif (i == n - 1 and vowel(i - 1)) or at(i - 1, "EWSKI", "EWSKY", "OWSKI", "OWSKY") or at(0, "SCH"):
                codes.add("", "F")
            elif at(i, "WICZ", "WITZ"):
                codes.add("TS", "FX")
                step = 4
        elif c == "X":
            if not (i == n - 1 and (at(i - 3, "IAU", "EAU") or at(i - 2, "AU", "OU"))):
                codes.add("KS")
            step = 2 if nxt in ("C", "X") else 1
        elif c == "Z":
            if nxt == "H":
                codes.add("J")
                step = 2
            else:
                codes.add(*(("S", "TS") if at(i + 1, "ZO", "ZI", "ZA") or (slavic and i > 0 and word[i - 1] != "T") else ("S", "S")))
        i += step
    one, two = "".join(codes.one), "".join(codes.two)
    return [x for x in dict.fromkeys((one, two)) if x]


@F.pandas_udf(T.ArrayType(T.StringType()))
def _metaphone(text: pd.Series) -> pd.Series:
    return text.map(metaphone_codes)


def double_metaphone(text: Column) -> Column:
    """Array of the distinct non-empty sound codes."""
    return _metaphone(text)


def close_matches(anchor: Column, keys: list[str], most: int = 3, cutoff: float = 0.86) -> Column:
    """The closest of a small list of keys with their scores, best first: those of several lists can be merged."""

    def scored(x: str) -> list[dict]:
        matcher = difflib.SequenceMatcher()
        matcher.set_seq2(x)
        out = []
        for key in difflib.get_close_matches(x, keys, n=most, cutoff=cutoff):
            matcher.set_seq1(key)
            out.append({"score": matcher.ratio(), "key": key})
        return out

    @F.pandas_udf(T.ArrayType(T.StructType([T.StructField("score", T.DoubleType()), T.StructField("key", T.StringType())])))
    def match(text: pd.Series) -> pd.Series:
        return text.map(lambda x: None if x is None else scored(x))

    return match(anchor)


def canonical(url: str | None, base: str | None = None) -> str | None:
    """An http(s) URL with lower-case host, no fragment and a path; null for others."""
    try:
        found = urlparse(urljoin(base, url) if base else url or "")
        if found.scheme not in ("http", "https"):
            return None
        return urlunparse(found._replace(netloc=found.netloc.lower(), fragment="", path=found.path or "/"))
    except ValueError:
        return None


@F.pandas_udf(T.StringType())
def canonical_url(url: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([canonical(u, b) for u, b in zip(url, base)], dtype=object)
