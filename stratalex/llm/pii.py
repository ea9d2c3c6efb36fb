"""Personal data by anchor expansion.

One Aho-Corasick automaton finds anchors in a single pass over a text: at-signs, plus signs, digits, URL
schemes and identifier cues. A deterministic parser for each anchor expands it to the left and right and
validates what it found. Base kinds follow fixed patterns, leftmost and non-overlapping within a kind:

  email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
  ip     four dotted numbers, each at most 255
  card   digits with single spaces or hyphens between, 14 to 19 of them, with a right Luhn sum
  phone  + and a digit, then digits, spaces, brackets, dots and hyphens to a last digit, 10 to 15 digits

The anchors add: url (a URL with user data before its host), secret (a key, token or password after its cue, a key with a
known prefix, a JSON web token, a private key block) and account (an account number after its cue, or an IBAN whose check
digits are right). Base spans are never changed by these.

Each text is scanned in linear time: how far a run of characters goes is remembered for its later starts, and what has a
greatest length is read no further.

Defined cases: a null or empty text has no spans; a very long text is scanned whole; equal rows give equal rows; an empty
table gives an empty result; other columns pass through, except those named like an output. Positions are code points,
end exclusive; spans are ordered by start, then kind as listed, then end.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import numbered, position, with_columns

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "secret", "account")

_DIGITS = frozenset("0123456789")
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_ALNUM = _DIGITS | _LETTERS
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_URL_END = frozenset(" \t\n\r\x0b\x0c<>\"'`{}|\\^")
_VALUE = _ALNUM | frozenset("_+/=.-")
_KEY = _ALNUM | frozenset("_-")
_UPPER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
# Words before a secret or an account number, and what begins a key, with the characters that follow, how many at least and at most.
_SECRET_CUES = ("password", "passwd", "passphrase", "token", "api_key", "api-key", "apikey", "secret", "access_key", "private_key")
_ACCOUNT_CUES = ("account", "acct", "iban", "ssn", "passport")
_PREFIXES = {
    "AKIA": (_UPPER | _DIGITS, 16, 16),
    "ASIA": (_UPPER | _DIGITS, 16, 16),
    "AIza": (_KEY, 35, 35),
    "ghp_": (_ALNUM, 36, 36),
    "gho_": (_ALNUM, 36, 36),
    "ghs_": (_ALNUM, 36, 36),
    "glpat-": (_KEY, 20, 20),
    "sk_live_": (_ALNUM, 24, 99),
    "xoxb-": (_KEY, 24, 99),
    "xoxp-": (_KEY, 24, 99),
}
_JWT, _PEM, _PEM_END = "eyJ", "-----BEGIN ", "-----END "
#: Characters of an account number, of the name in a key block's first or last line, and of an IBAN, at most.
_ACCOUNT_CHARS, _PEM_CHARS, _IBAN_CHARS = 40, 64, 42


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for mark in ("@", "+", "://", _JWT, _PEM, *_PREFIXES):
        found.add_word(mark, (mark, len(mark)))
    for digit in _DIGITS:
        found.add_word(digit, ("0", 1))
    for kind, cues in (("secret", _SECRET_CUES), ("account", _ACCOUNT_CUES)):
        for cue in cues:
            for form in (cue, cue.upper(), cue.capitalize()):
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


class _Runs:
    """Ends of runs of characters of a text. The latest run of each set is remembered, with its last digit: any start inside has the same end."""

    def __init__(self, text: str):
        self.text, self.n, self.latest = text, len(text), {}

    def end(self, at: int, name: str, inside) -> tuple[int, int]:
        """(end, place of the last digit or -1) of the run that goes on at `at`."""
        begin, end, digit = self.latest.get(name, (0, -1, -1))
        if not begin <= at <= end:
            text, n, end, digit = self.text, self.n, at, -1
            while end < n and inside(c := text[end]):
                if c in _DIGITS:
                    digit = end
                end += 1
            self.latest[name] = at, end, digit
        return end, digit


def _run(text: str, at: int, end: int, allowed: frozenset) -> int:
    while at < end and text[at] in allowed:
        at += 1
    return at


def _luhn(digits: list[int]) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        if i & 1:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _number_chain(text: str, at: int, n: int, spans: list) -> int:
    """Dotted numbers from a digit that begins a run: groups of four, in turn. Returns the end of the chain."""
    parts, i = [], at
    while True:
        j = _run(text, i, n, _DIGITS)
        parts.append((i, j))
        if j + 1 < n and text[j] == "." and text[j + 1] in _DIGITS:
            i = j + 1
        else:
            break
    for k in range(0, len(parts) - 3, 4):
        four = parts[k : k + 4]
        if all(len(p := text[a:b].lstrip("0")) <= 3 and int(p or 0) <= 255 for a, b in four):
            spans.append((four[0][0], 1, four[3][1]))
    return j


def _digit_run(text: str, at: int, n: int, spans: list) -> int:
    """Digits with single separators, as far as they go. Returns the end."""
    digits, i = [int(text[at])], at + 1
    while i < n:
        c = text[i]
        if c in _DIGITS:
            digits.append(int(c))
            i += 1
        elif (c == " " or c == "-") and i + 1 < n and text[i + 1] in _DIGITS:
            digits.append(int(text[i + 1]))
            i += 2
        else:
            break
    if 14 <= len(digits) <= 19 and _luhn(digits):
        spans.append((at, 2, i))
    return i


def find(text: str | None) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of every span."""
    if not text:
        return []
    n, spans, runs = len(text), [], _Runs(text)
    email_end = ip_end = card_end = phone_end = value_end = iban_end = 0
    url_stop = url_end = pem_end = -1
    for last, (mark, size) in anchors().iter(text):
        first = last - size + 1
        if mark == "0":
            if first >= ip_end:
                ip_end = _number_chain(text, first, n, spans)
            if first >= card_end:
                card_end = _digit_run(text, first, n, spans)
            if first >= iban_end + 2 and text[first - 1] in _UPPER and text[first - 2] in _UPPER and (first == 2 or text[first - 3] not in _ALNUM):
                if end := _iban(text, first - 2, n):
                    if first - 2 >= value_end:
                        spans.append((first - 2, 6, end))
                        value_end = max(value_end, end)
                    iban_end = end
        elif mark == "@":
            start = first
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            label = _run(text, last + 1, n, _LABEL)
            end = label
            while label > last + 1 and end < n and text[end] == ".":
                more = _run(text, end + 1, n, _LABEL)
                if more == end + 1:
                    break
                end = more
            if start < first and label > last + 1 and end > label:
                spans.append((start, 0, end))
                email_end = end
        elif mark == "+":
            if first >= phone_end and last + 1 < n and text[last + 1] in _DIGITS:
                stop = _run(text, last + 2, n, _PHONE)
                end = stop
                while end > last + 3 and text[end - 1] not in _DIGITS:
                    end -= 1
                if end > last + 3:
                    phone_end = end
                    if 10 <= sum(c in _DIGITS for c in text[first:end]) <= 15:
                        spans.append((first, 3, end))
        elif mark == "://":
            start = first
            while start > 0 and (text[start - 1] in _ALNUM or text[start - 1] in "+.-"):
                start -= 1
            if start < first and text[start] in _LETTERS:
                stop, _ = runs.end(last + 1, "url", _in_url)
                host = last + 1
                while host < stop and text[host] not in "/?#":
                    host += 1
                if text.find("@", last + 2, host) >= 0:
                    if stop != url_stop:
                        url_stop = url_end = stop
                        while text[url_end - 1] in ".,;:!?)":
                            url_end -= 1
                    spans.append((start, 4, url_end))
        elif mark in _PREFIXES:
            allowed, least, most = _PREFIXES[mark]
            end = _run(text, last + 1, min(n, last + 2 + most), allowed)
            if least <= end - last - 1 <= most and (end == n or text[end] not in _ALNUM) and (first == 0 or text[first - 1] not in _ALNUM) and first >= value_end:
                spans.append((first, 5, end))
                value_end = end
        elif mark == _JWT:
            if first >= value_end and (first == 0 or text[first - 1] not in _KEY) and (end := _web_token(text, last + 1, runs)):
                spans.append((first, 5, end))
                value_end = end
        elif mark == _PEM:
            name = text.find("-----", last + 1, last + 1 + _PEM_CHARS)
            if first >= value_end and name >= 0 and text.endswith("PRIVATE KEY", last + 1, name):
                if pem_end < name:
                    pem_end = text.find(_PEM_END, name)
                    pem_end = n if pem_end < 0 else pem_end
                close = text.find("-----", pem_end + len(_PEM_END), pem_end + len(_PEM_END) + _PEM_CHARS)
                if close >= 0:
                    spans.append((first, 5, close + 5))
                    value_end = close + 5
        elif first >= value_end and (first == 0 or text[first - 1] not in _LETTERS):
            span = _secret(text, last + 1, n, runs) if mark == "secret" else _account(text, last + 1, n)
            if span:
                spans.append((span[0], 5 if mark == "secret" else 6, span[1]))
                value_end = span[1]
    spans.sort()
    return spans


def _in_url(c: str) -> bool:
    return c not in _URL_END and not c.isspace()


def _secret(text: str, at: int, n: int, runs: _Runs) -> tuple[int, int] | None:
    """The value after = or :, eight characters at least with a digit among them."""
    at = _run(text, at, n, frozenset(" "))
    if at >= n or text[at] not in "=:":
        return None
    at = _run(text, at + 1, n, frozenset(" \"'"))
    end, digit = runs.end(at, "value", _VALUE.__contains__)
    if digit < at:
        return None
    end = max(digit + 1, _trimmed(text, end))
    return (at, end) if end - at >= 8 else None


def _trimmed(text: str, end: int) -> int:
    """Where a value that ends here ends without dots and hyphens; looked at only where it has a digit, so at once for each run."""
    while text[end - 1] in ".-":
        end -= 1
    return end


def _web_token(text: str, at: int, runs: _Runs) -> int | None:
    """End of header.payload.signature, each of eight characters at least."""
    for part in range(3):
        end, _ = runs.end(at, "key", _KEY.__contains__)
        if end - at < 8 or (part < 2 and text[end : end + 1] != "."):
            return None
        at = end + 1
    return end


def _iban(text: str, at: int, n: int) -> int | None:
    """End of the longest IBAN that begins here: 15 to 34 characters, single spaces between groups, remainder 1 modulo 97."""
    stop, found, value, size, i = min(n, at + _IBAN_CHARS), None, 0, 0, at
    head = text[at : at + 4]
    if len(head) < 4 or head[3] not in _DIGITS:
        return None
    while i < stop and size < 34:
        c = text[i]
        if c in _DIGITS or c in _UPPER:
            size += 1
            if size > 4:
                value = (value * 10 + int(c) if c in _DIGITS else value * 100 + ord(c) - 55) % 97
            i += 1
            if size >= 15 and (i == n or text[i] not in _ALNUM):
                whole = value
                for h in head:
                    whole = (whole * 10 + int(h) if h in _DIGITS else whole * 100 + ord(h) - 55) % 97
                if whole == 1:
                    found = i
        elif c == " " and i + 1 < stop and text[i - 1] != " ":
            i += 1
        else:
            break
    return found


def _account(text: str, at: int, n: int) -> tuple[int, int] | None:
    """A number of six digits at least, up to two letters before it, after at most a short word and : or #."""
    for word in (" number", " no.", " no", " nr.", " nr"):
        if text.startswith(word, at):
            at += len(word)
            break
    at = _run(text, at, min(n, at + 3), frozenset(" :#"))
    start, at = at, _run(text, at, min(n, at + 2), _LETTERS)
    end, stop = at, min(n, at + _ACCOUNT_CHARS + 1)
    while end < stop and (text[end] in _ALNUM or text[end] in " -" and end + 1 < n and text[end + 1] in _DIGITS):
        end += 1
    digits = sum(c in _DIGITS for c in text[at:end])
    return (start, end) if digits >= 6 and text[at] in _DIGITS and 2 * digits > end - at and end - at <= _ACCOUNT_CHARS else None


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def find_spans(df: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds spans: array<struct<kind, start, end>>."""

    def run(texts: list) -> list[list]:
        return [[[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in find(t)] for t in texts]]

    return with_columns(df, [text], run, pa.schema([("spans", pa.list_(_SPAN))]), carry)


def _redacted(text: str | None) -> str | None:
    spans = find(text)
    if not spans:
        return text
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """Each span, overlapping ones together, becomes <KIND>; `length`, where the table has it, follows. Columns stay as they are."""
    at = position(df, text)
    made = with_columns(numbered(df), [f"c{at}"], lambda texts: [[_redacted(t) for t in texts]], pa.schema([("redacted", pa.string())]))
    out = {f"c{i}": F.col(f"c{i}") for i in range(len(df.columns))}
    out[f"c{at}"] = F.col("redacted")
    if length and length.lower() in [c.lower() for c in df.columns]:
        i = position(df, length)
        out[f"c{i}"] = F.char_length("redacted").cast(df.schema.fields[i].dataType)
    return made.select(*[c.alias(name) for name, c in out.items()]).toDF(*df.columns)
