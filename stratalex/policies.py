"""Policies: frozen settings that the operators turn into literals of their expressions."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields, is_dataclass, replace
from typing import Any


@dataclass(frozen=True)
class LevelThreshold:
    min_institutions: int = 1
    min_src_count: int = 1
    weight_formula: str = "1.0*inst_count + 0.3*log(1+src_count)"


@dataclass(frozen=True)
class NearDuplicatePolicy:
    enabled: bool = True
    prefix_delimiters: tuple[str, ...] = ("::", "#", "@")
    strip_numeric_suffix: bool = True
    min_prefix_length: int = 6


@dataclass(frozen=True)
class FrequencyPolicy:
    thresholds: tuple[LevelThreshold, ...] = (LevelThreshold(), LevelThreshold(), LevelThreshold(2, 1), LevelThreshold(2, 3))
    unknown_institution: str = "placeholder::unknown"
    near_duplicate: NearDuplicatePolicy = NearDuplicatePolicy()


@dataclass(frozen=True)
class InstitutionPolicy:
    campus_vs_system: str = "prefer-campus"
    canonical_mappings: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class LabelPolicy:
    case: str = "lower"
    remove_punctuation: bool = True
    fold_diacritics: bool = True
    collapse_whitespace: bool = True
    min_length: int = 2
    max_length: int = 64
    boilerplate_patterns: tuple[str, ...] = ("department of", "school of", "college of", "program in")
    include_ambiguous_acronyms: bool = False
    parent_similarity_cutoff: float = 0.86


@dataclass(frozen=True)
class TokenPolicy:
    max_tokens: tuple[int, ...] = (5, 5, 5, 5)
    forbidden_punctuation: tuple[str, ...] = ("-", "_", ".", "/", ":")
    # Labels that always pass, and names of venues.
    allowlist: tuple[str, ...] = ("computer vision", "machine learning", "natural language processing", "artificial intelligence", "data science")
    venue_names: tuple[str, ...] = ("neurips", "neural information processing systems", "icml", "international conference on machine learning", "cvpr", "computer vision and pattern recognition", "acl", "association for computational linguistics", "emnlp", "kdd", "siggraph", "isca")
    venue_keywords: tuple[str, ...] = ("conference", "symposium", "symposia", "journal", "transactions", "workshop", "proceedings")
    venue_names_forbidden: bool = True
    hyphenated_compounds_allowed: bool = False
    prefer_rule_over_model: bool = True
    min_alnum_ratio: float = 0.7


@dataclass(frozen=True)
class ExtractionPolicy:
    segment_on_headers: bool = True
    segment_on_lists: bool = True
    segment_on_tables: bool = True
    preserve_list_structure: bool = True
    min_chars: int = 12
    max_chars: int = 2000
    target_language: str = "en"
    language_confidence_threshold: float = 0.8
    require_language_confidence: bool = True
    dedup_enabled: bool = True
    similarity_threshold: float = 0.95
    similarity_method: str = "jaccard_shingles"
    remove_boilerplate: bool = True
    # Patterns, matched without regard to case.
    boilerplate_patterns: tuple[str, ...] = (r"© \d{4}", "all rights reserved", "privacy policy", "terms of use", "contact us", r"home \| about \| contact")
    detect_sections: bool = True
    section_header_patterns: tuple[str, ...] = (r"^[A-Z][A-Z\s]{2,50}:?$", r"^#{1,6}\s+.+$", r"^\d+\.\s+[A-Z].+$")


@dataclass(frozen=True)
class WebPolicy:
    allowed_domains: tuple[str, ...] = (".edu", ".org")
    disallowed_paths: tuple[str, ...] = ("/events", "/news", "/calendar")
    max_pages: int = 300
    max_depth: int = 3
    max_minutes: int = 30
    max_content_mb: int = 5
    pdf_size_limit_mb: int = 5
    min_text_length: int = 120
    language_allowlist: tuple[str, ...] = ("en",)
    language_confidence_threshold: float = 0.6
    ttl_days: int = 14
    max_cache_bytes: int | None = None


@dataclass(frozen=True)
class ValidationPolicy:
    forbidden_patterns: tuple[str, ...] = ("neurips$", "icml$", "cvpr$", "acl$", "emnlp$", "kdd$", "siggraph$")
    required_vocabularies: dict[int, tuple[str, ...]] = field(default_factory=dict)
    venue_patterns: tuple[str, ...] = ("neurips", "icml", "cvpr", "acl", "emnlp", "kdd", "siggraph")
    venue_detection_hard: bool = False
    structural_checks: bool = True
    authoritative_domains: tuple[str, ...] = ("wikipedia.org", "acm.org", "ieee.org")
    snippet_max_length: int = 200
    min_snippet_matches: int = 1
    max_snippets: int = 3
    max_evidence_tokens: int = 1000
    confidence_threshold: float = 0.7
    rule_weight: float = 1.0
    web_weight: float = 0.7
    model_weight: float = 0.4
    hard_rule_failure_blocks: bool = True
    tie_break_conservative: bool = True
    tie_break_min_strength: float | None = None

    def __post_init__(self) -> None:
        for name in ("rule_weight", "web_weight", "model_weight"):
            if not 0 <= getattr(self, name) < float("inf"):
                raise ValueError(f"{name} must be finite and not negative")
        if self.tie_break_min_strength is not None and not 0 <= self.tie_break_min_strength < float("inf"):
            raise ValueError("tie_break_min_strength must be finite and not negative")


@dataclass(frozen=True)
class DisambiguationPolicy:
    min_parent_divergence: float = 0.3
    max_context_overlap: float = 0.2
    require_multiple_parents: bool = True
    max_contexts_per_parent: int = 5
    window_size: int = 100
    max_contexts_for_prompt: int = 10
    gloss_max_words: int = 20
    min_evidence_strength: float = 0.6
    defer_threshold: float = 0.4
    allow_multi_parent_exceptions: bool = False

    def __post_init__(self) -> None:
        if self.defer_threshold > self.min_evidence_strength:
            raise ValueError("defer_threshold must not exceed min_evidence_strength")


@dataclass(frozen=True)
class DedupPolicy:
    threshold_shallow: float = 0.93
    threshold_deep: float = 0.90
    merge_policy: str = "conservative"
    prefix_length: int = 6
    phonetic_enabled: bool = True
    phonetic_probe_threshold: float = 0.75
    acronym_enabled: bool = True
    max_block_size: int = 1000
    max_comparisons: int = 10_000
    jaro_winkler_weight: float = 1.0
    jaccard_weight: float = 1.0
    abbrev_weight: float = 1.2
    heuristic_suffixes: tuple[str, ...] = ("systems", "theory", "engineering")
    min_similarity: float = 0.85
    parent_context_strict: bool = True
    cross_parent_merge_allowed: bool = False
    early_stopping: bool = True
    sample_merges: int = 10


@dataclass(frozen=True)
class HierarchyPolicy:
    enforce_unique_paths: bool = True
    multi_parent_exceptions: tuple[str, ...] = ()
    orphan_strategy: str = "quarantine"
    placeholder_prefix: str = "placeholder::"
    strict_levels: bool = True
    allow_shortcuts: bool = False
    max_nodes: int | None = 100_000  # None: as many as there are

    def __post_init__(self) -> None:
        if self.orphan_strategy not in ("quarantine", "drop", "attach_placeholder"):
            raise ValueError(f"unknown orphan strategy {self.orphan_strategy}")


@dataclass(frozen=True)
class ObservabilityPolicy:
    sampling_rate: float = 0.1
    max_samples: int = 100
    seed: int = 42
    max_operations: int = 5000
    redacted_keys: tuple[str, ...] = ("api_key", "authorization", "password", "secret", "token", "credential")


@dataclass(frozen=True)
class SpreadsheetPolicy:
    top_institutions: int = 25
    seed: int = 20230927


@dataclass(frozen=True)
class Policies:
    version: str = "1"
    frequency: FrequencyPolicy = FrequencyPolicy()
    institution: InstitutionPolicy = field(default_factory=InstitutionPolicy)
    label: LabelPolicy = LabelPolicy()
    token: TokenPolicy = TokenPolicy()
    extraction: ExtractionPolicy = ExtractionPolicy()
    web: WebPolicy = WebPolicy()
    validation: ValidationPolicy = field(default_factory=ValidationPolicy)
    disambiguation: DisambiguationPolicy = DisambiguationPolicy()
    dedup: DedupPolicy = DedupPolicy()
    hierarchy: HierarchyPolicy = HierarchyPolicy()
    observability: ObservabilityPolicy = ObservabilityPolicy()
    spreadsheet: SpreadsheetPolicy = SpreadsheetPolicy()


def override(value: Any, path: str, new: Any) -> Any:
    """A copy with one dotted setting changed: override(policies, "dedup.prefix_length", 4)."""
    head, _, rest = path.partition(".")
    if not is_dataclass(value) or head not in {f.name for f in fields(value)}:
        raise KeyError(f"no setting {path}")
    old = getattr(value, head)
    if rest:
        return replace(value, **{head: override(old, rest, new)})
    return replace(value, **{head: tuple(new) if isinstance(old, tuple) and isinstance(new, list) else new})


def load(settings: dict[str, Any] | None = None, environment: dict[str, str] | None = None, prefix: str = "STRATALEX__") -> Policies:
    """Defaults, then environment variables like STRATALEX__dedup__prefix_length=4 (JSON values), then dotted settings."""
    found = Policies()
    for name, raw in sorted((environment if environment is not None else os.environ).items()):
        if name.startswith(prefix):
            try:
                new = json.loads(raw)
            except ValueError:
                new = raw
            found = override(found, name[len(prefix) :].replace("__", "."), new)
    for path, new in (settings or {}).items():
        found = override(found, path, new)
    return found


def flat(value: Any, at: str = "") -> dict[str, Any]:
    """Dotted settings of a policy, for manifests."""
    if not is_dataclass(value):
        return {at: value}
    out: dict[str, Any] = {}
    for f in fields(value):
        out |= flat(getattr(value, f.name), f"{at}.{f.name}" if at else f.name)
    return out
