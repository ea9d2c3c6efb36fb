"""Label and text functions as Column expressions; all built-in, so they stay inside code generation."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..policies import InstitutionPolicy, LabelPolicy

# Prefixes that a label of a level may carry.
LEVEL_PREFIXES = {
    0: (),
    1: ("school of ", "college of ", "department of ", "dept of ", "dept. of ", "division of "),
    2: ("center for ", "centre for ", "laboratory for ", "lab for ", "institute for ", "research area: "),
    3: ("workshop on ", "symposium on ", "track: "),
}
# Acronyms that labels expand to, those that need an opt-in, and words that are no acronyms.
ACRONYM_EXPANSIONS = {
    "cs": "computer science",
    "cee": "civil and environmental engineering",
    "ce": "civil engineering",
    "ece": "electrical and computer engineering",
    "ee": "electrical engineering",
    "eecs": "electrical engineering and computer science",
    "ise": "industrial and systems engineering",
    "me": "mechanical engineering",
    "mba": "master of business administration",
    "mse": "materials science and engineering",
    "ai": "artificial intelligence",
}
AMBIGUOUS_ACRONYMS = ("ai",)
ACRONYM_STOP_WORDS = ("OF", "THE", "AND", "FOR", "WITH", "FROM", "IN", "ON", "BY", "AT", "TO", "UNIVERSITY", "COLLEGE", "SCHOOL", "DEPARTMENT", "DEPT", "CENTER", "CENTRE", "INSTITUTE", "LAB", "LABORATORY", "PROGRAM", "PROGRAMME", "RESEARCH", "SCIENCE", "ENGINEERING", "STUDIES", "PENNSYLVANIA")
# Acronyms known to match their expansion.
KNOWN_ACRONYMS = {
    "AI": "artificial intelligence",
    "ML": "machine learning",
    "NLP": "natural language processing",
    "CV": "computer vision",
    "HCI": "human computer interaction",
    "EE": "electrical engineering",
    "EECS": "electrical engineering and computer science",
    "CS": "computer science",
    "DS": "data science",
    "IS": "information systems",
    "SE": "software engineering",
    "STAT": "statistics",
}


def squeeze(text: Column) -> Column:
    """Single spaces for any run of white space, none at the ends."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), "^ | $", "")


@lru_cache(maxsize=1)
def _folding() -> tuple[str, str]:
    """Letters of the Latin, Greek and Cyrillic blocks whose decomposition is one base letter and marks."""
    source, target = [], []
    for code in [*range(0xA0, 0x530), *range(0x1E00, 0x2000)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(code):
            source.append(chr(code))
            target.append(base)
    return "".join(source), "".join(target)


def fold_diacritics(text: Column) -> Column:
    """Base letters without marks, for Latin, Greek and Cyrillic; functions.udfs has the form for any script."""
    source, target = _folding()
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.regexp_replace(F.translate(text, source, target), r"[\u0300-\u036F]+", "")).otherwise(text)


def normalize_label(label: Column) -> Column:
    """Folded, lower case, quotes, dashes and separators as spaces."""
    return squeeze(F.regexp_replace(F.lower(fold_diacritics(label)), r"[\u2018\u2019\u201C\u201D\-\u2010-\u2015.,;:/\\]+", " "))


def minimal_form(text: Column, policy: LabelPolicy) -> Column:
    out = F.lower(text) if policy.case == "lower" else text
    if policy.remove_punctuation:
        out = F.regexp_replace(out, r"(?U)[^0-9A-Za-z\s]+", " ")
    if policy.fold_diacritics:
        out = fold_diacritics(out)
    return squeeze(out) if policy.collapse_whitespace else F.trim(out)


def _step(state: Column, changed: Column, cleaned: Column) -> Column:
    """state: struct(text, aliases). Where changed, the text before becomes an alias."""
    return F.struct(F.when(changed, cleaned).otherwise(state["text"]).alias("text"), F.when(changed, F.array_append(state["aliases"], state["text"])).otherwise(state["aliases"]).alias("aliases"))


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_boilerplate(label: Column, level: int, policy: LabelPolicy, institution: Column | None = None) -> Column:
    """struct(text, aliases): the label without its owner's name (level 0), level prefix, policy patterns and a short
    closing bracket; aliases are the forms before each cut, each once."""
    state = F.struct(squeeze_ends(label).alias("text"), F.array().cast("array<string>").alias("aliases"))
    if institution is not None and level == 0:
        owner = squeeze_ends(institution)
        lowered = F.lower(squeeze_ends(label))
        rest = F.substring(squeeze_ends(label), F.length(owner) + 1, F.lit(1 << 30))
        is_prefix = (F.length(owner) > 0) & lowered.startswith(F.lower(owner)) & rest.rlike(r"(?U)^\s*[-–—:|]?\s+")
        cut = F.regexp_replace(rest, r"(?U)^\s*[-–—:|]?\s+", "")
        state = _step(state, F.coalesce(is_prefix, F.lit(False)), cut)
    prefixes = LEVEL_PREFIXES.get(level, ())
    if prefixes:
        pattern = "(?i)^(?:" + "|".join(re.escape(p) for p in prefixes) + ")"
        state = _let(state, lambda s: _step(s, s["text"].rlike(pattern), F.regexp_replace(F.regexp_replace(s["text"], pattern, ""), r"^[ \-:,\t]+", "")))
    for boilerplate in policy.boilerplate_patterns:
        found = f"(?i){boilerplate}"
        state = _let(state, lambda s: _step(s, s["text"].rlike(found), squeeze(F.regexp_replace(s["text"], found, " "))))  # noqa: B023
    closing = r"(?U)\(([^)]+)\)\s*$"
    state = _let(state, lambda s: _step(s, F.length(squeeze_ends(F.regexp_extract(s["text"], closing, 1))).between(1, 8), F.regexp_replace(F.regexp_replace(s["text"], closing, ""), r"(?U)\s+$", "")))
    return _let(state, lambda s: F.struct(s["text"].alias("text"), F.array_distinct(s["aliases"]).alias("aliases")))


def squeeze_ends(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def acronyms(text: Column) -> Column:
    """Distinct runs of two to six capitals (parts may be joined by &) that are no stop words, in order."""
    found = F.regexp_extract_all(text, F.lit(r"\b[A-Z]{2,}(?:&[A-Z]{2,})*\b"), F.lit(0))
    return F.array_distinct(F.filter(found, lambda a: F.length(a).between(2, 6) & ~a.isin(*ACRONYM_STOP_WORDS)))


def expand_acronym(acronym: Column, level: int, context: Column, policy: LabelPolicy) -> Column:
    """The known expansion: always if the context holds it, else at levels 0 and 1, ambiguous ones only by policy."""
    known = F.create_map(*[F.lit(x) for pair in ACRONYM_EXPANSIONS.items() for x in pair])
    key = F.lower(acronym)
    expansion = F.element_at(known, key)
    allowed = F.lit(level <= 1) if policy.include_ambiguous_acronyms else F.lit(level <= 1) & ~key.isin(*AMBIGUOUS_ACRONYMS)
    return F.when(F.contains(F.lower(context), expansion) | allowed, expansion)


def canonical_form(label: Column, level: int, policy: LabelPolicy, institution: Column | None = None) -> Column:
    """struct(canonical, aliases) of a label at a level. Aliases keep their order of discovery, each once."""

    def finish(s: Column) -> Column:
        canonical = minimal_form(normalize_label(s["text"]), policy)
        short = F.flatten(F.transform(acronyms(label), lambda a: F.array(a, expand_acronym(a, level, label, policy))))
        names = F.transform(F.filter(F.concat(F.array(label, canonical), s["aliases"], short), lambda x: x.isNotNull()), squeeze)
        if policy.fold_diacritics:
            names = _let(names, lambda n: F.concat(n, F.transform(n, lambda x: squeeze(fold_diacritics(x)))))
        return F.struct(canonical.alias("canonical"), F.array_distinct(names).alias("aliases"))

    return _let(strip_boilerplate(label, level, policy, institution), finish)


def canonical_at_any_level(label: Column, level: Column, policy: LabelPolicy, institution: Column | None = None) -> Column:
    return F.when(level == 0, canonical_form(label, 0, policy, institution)).when(level == 1, canonical_form(label, 1, policy, institution)).when(level == 2, canonical_form(label, 2, policy, institution)).when(level == 3, canonical_form(label, 3, policy, institution))


def comparable(text: Column) -> Column:
    """Lower case words with single spaces; anything else is a space."""
    return squeeze(F.regexp_replace(F.lower(squeeze(text)), r"(?U)[^\w\s]+", " "))


def tokens(text: Column) -> Column:
    return F.filter(F.split(comparable(text), " "), lambda t: t != "")


def shingles(text: Column, n: int = 3) -> Column:
    """Runs of n words; a text of n words or fewer is one shingle, one without words none."""

    def runs(t: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.size(t) - n + 1), lambda i: F.array_join(F.slice(t, i, F.lit(n)), " "))
        return F.when(F.size(t) == 0, F.array().cast("array<string>")).when(F.size(t) <= n, F.array(F.array_join(t, " "))).otherwise(many)

    return _let(tokens(text), runs)


def context_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9']+"), F.lit(0))


def acronym_of(text: Column) -> Column:
    """The letters of a label that is itself an acronym, in capitals; else null."""
    letters = F.regexp_replace(text, "[^A-Za-z]", "")
    capitals = F.length(F.regexp_replace(letters, "[^A-Z]", ""))
    shape = (capitals / F.greatest(F.length(letters), F.lit(1)) >= 0.8) | (F.upper(squeeze_ends(text)) == squeeze_ends(text))
    return F.when((F.length(letters) >= 2) & (capitals >= 2) & shape, F.upper(letters))


def initials(text: Column) -> Column:
    return F.upper(F.array_join(F.transform(tokens(text), lambda t: F.left(t, F.lit(1))), ""))


def initials_key(text: Column) -> Column:
    """Initials of the words that begin with a letter, for labels of two words or more; null under two letters."""
    key = F.upper(F.array_join(F.transform(F.filter(tokens(text), lambda t: t.rlike(r"^\p{L}")), lambda t: F.left(t, F.lit(1))), ""))
    return F.when((F.size(tokens(text)) >= 2) & (F.length(key) >= 2), key)


def expands(acronym: Column, expansion: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in KNOWN_ACRONYMS.items() for x in pair])
    letters = acronym_of(acronym)
    full = comparable(expansion)
    return F.coalesce(letters.isNotNull() & (full != "") & ((initials(expansion) == letters) | (F.element_at(known, letters) == full)), F.lit(False))


def abbreviates(a: Column, b: Column) -> Column:
    """1.0 if either label is an acronym of the other."""
    filled = (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")
    return F.when(filled & (expands(a, b) | expands(b, a)), F.lit(1.0)).otherwise(F.lit(0.0))


# institutions and fingerprints


def title_case(name: Column) -> Column:
    """Words capitalised; short all-capital words stay, small words after the first are lower case."""

    def word(t: Column, i: Column) -> Column:
        low = F.lower(t)
        return F.when((F.upper(t) == t) & (low != t) & (F.length(t) <= 4), t).when((i > 0) & low.isin("of", "and", "for", "the", "at", "in"), low).otherwise(F.concat(F.upper(F.left(t, F.lit(1))), F.substring(low, 2, 1 << 30)))

    return F.array_join(F.transform(F.filter(F.split(name, " "), lambda t: t != ""), word), " ")


def placeholder(material: str) -> Column:
    return F.concat(F.lit("placeholder::"), F.left(F.sha1(F.lit(material).cast("binary")), F.lit(8)))


def institution_key(name: Column) -> Column:
    return F.lower(squeeze(fold_diacritics(squeeze_ends(name))))


def resolve_institution(name: Column, policy: InstitutionPolicy) -> Column:
    """One identity for the spellings of an institution."""
    cleaned = squeeze(name)
    if policy.campus_vs_system == "prefer-system":
        first, before_at = squeeze(F.substring_index(cleaned, ",", 1)), squeeze(F.regexp_extract(cleaned, r"(?i)^(.*?) at ", 1))
        base = F.when(F.contains(cleaned, F.lit(",")) & (first != ""), first).when(before_at != "", before_at).otherwise(cleaned)
    elif policy.campus_vs_system == "merge":
        base = squeeze(F.regexp_replace(cleaned, ",", " "))
    else:
        base = cleaned
    out = title_case(base)
    if policy.canonical_mappings:
        known = F.create_map(*[x for alias, name_ in policy.canonical_mappings.items() for x in (institution_key(F.lit(alias)), squeeze(F.lit(name_)))])
        out = F.coalesce(F.element_at(known, institution_key(name)), out)
    blank = F.coalesce(cleaned, F.lit("")) == ""
    return F.when(blank, placeholder("unknown|empty")).when(F.lower(cleaned) == "unknown", placeholder("unknown|explicit")).otherwise(out)


def record_fingerprint(text: Column, institution: Column, url: Column) -> Column:
    material = F.concat_ws("|", squeeze(text), institution, F.coalesce(url, F.lit("")))
    return F.concat(F.lit("record:"), F.sha1(material.cast("binary")))


def near_duplicate_key(fingerprint: Column, policy) -> Column:
    """What fingerprints of versions of one record share: the part before a delimiter, without a trailing number."""
    key = None
    for mark in policy.prefix_delimiters:
        head = F.substring_index(fingerprint, mark, 1)
        condition = F.contains(fingerprint, F.lit(mark)) & (F.length(head) >= policy.min_prefix_length)
        key = F.when(condition, head) if key is None else key.when(condition, head)
    key = fingerprint if key is None else key.otherwise(fingerprint)
    if policy.strip_numeric_suffix:
        key = F.regexp_replace(F.regexp_replace(key, r"[-_]?v?\d+$", ""), r"[-_][0-9a-f]{6,}$", "")
    return key


def split_id(base: Column, index: Column) -> Column:
    return F.concat(base, F.lit("::split::"), F.left(F.sha2(F.concat(base, F.lit(":"), index.cast("string")).cast("binary"), 256), F.lit(12)))


def lineage_key(level: Column, parents: Column) -> Column:
    return F.concat(F.lit("L"), level.cast("string"), F.lit(":"), F.coalesce(F.nullif(F.array_join(parents, " > "), F.lit("")), F.lit("<root>")))


def sense_label(base: Column, sense: Column) -> Column:
    said = squeeze_ends(sense)
    return F.when((said == "") | F.contains(F.lower(base), F.lower(said)), base).otherwise(F.concat(base, F.lit(" - "), said))


def capped_gloss(gloss: Column, most: int = 20) -> Column:
    words = F.filter(F.split(squeeze(gloss), " "), lambda t: t != "")
    return F.when(F.size(words) <= most, gloss).otherwise(F.concat(F.regexp_replace(F.array_join(F.slice(words, 1, most), " "), r"[.,;:!?]+$", ""), F.lit("...")))


def affix_hint(a: Column, b: Column, terms: tuple[str, ...]) -> Column:
    """1.0 if the labels differ by one of the terms alone, at either end."""

    def words(x: Column) -> Column:
        return F.filter(F.split(F.lower(x), "[^0-9a-z]+"), lambda t: t != "")

    def differs(x: Column, y: Column, term: tuple[str, ...]) -> Column:
        own, k = F.array(*[F.lit(t) for t in term]), len(term)
        longer = F.size(x) > k
        head, tail = F.slice(x, F.lit(1), F.greatest(F.size(x) - k, F.lit(0))), F.slice(x, F.greatest(F.size(x) - k + 1, F.lit(1)), F.lit(k))
        return longer & (((head == y) & (tail == own)) | ((F.slice(x, F.lit(k + 1), F.size(x)) == y) & (F.slice(x, F.lit(1), F.lit(k)) == own)))

    found = F.lit(False)
    for term in terms:
        parts = tuple(t for t in re.split("[^0-9a-z]+", term.lower()) if t)
        if parts:
            found = found | differs(words(a), words(b), parts) | differs(words(b), words(a), parts)
    return F.when(found & (F.size(words(a)) > 0) & (F.size(words(b)) > 0), F.lit(1.0)).otherwise(F.lit(0.0))


# URLs


def url_part(url: Column, part: str) -> Column:
    return F.try_parse_url(url, F.lit(part))


def normalize_url(url: Column) -> Column:
    """http(s) URLs with lower-case host, a path and no fragment; null for others."""
    bare = F.regexp_replace(url, "#.*$", "")
    scheme, rest = F.lower(F.regexp_extract(bare, r"(?i)^(https?)://([^/?]*)(.*)$", 1)), F.regexp_extract(bare, r"(?i)^(https?)://([^/?]*)(.*)$", 3)
    host = F.lower(F.regexp_extract(bare, r"(?i)^(https?)://([^/?]*)(.*)$", 2))
    return F.when(scheme != "", F.concat(scheme, F.lit("://"), host, F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))))


def host_of(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1)), r":\d*$", "")


def in_domain(host: Column, domains: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for d in domains:
        name = d.lower().lstrip(".")
        if name:
            found = found | (host == name) | host.endswith("." + name)
    return found


def follows(url: Column, allowed: tuple[str, ...], disallowed: tuple[str, ...]) -> Column:
    path = F.regexp_extract(url, r"^[^:]+://[^/?#]*([^?#]*)", 1)
    blocked = F.lit(False)
    for p in disallowed:
        blocked = blocked | path.startswith(p)
    return in_domain(host_of(url), allowed) & ~blocked


def checksum(text: Column) -> Column:
    return F.sha2(squeeze(text).cast("binary"), 256)


def clean_text(text: Column) -> Column:
    """Single spaces within lines and at most one blank line between lines."""
    lines = F.transform(F.split(text, r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"), squeeze)
    return F.regexp_replace(F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n"), r"^\n+|\n+$", "")
