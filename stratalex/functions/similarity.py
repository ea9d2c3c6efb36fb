"""Similarity of texts as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as tx
from .udfs import jaro_winkler


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; two empty ones are alike."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def shingle_jaccard(a: Column, b: Column, n: int = 3) -> Column:
    return jaccard(tx.shingles(a, n), tx.shingles(b, n))


def token_jaccard(a: Column, b: Column) -> Column:
    return jaccard(tx.tokens(a), tx.tokens(b))


def winkler_similarity(a: Column, b: Column) -> Column:
    return jaro_winkler(tx.comparable(a), tx.comparable(b))


def minhash(text: Column, n: int = 3, hashes: int = 128) -> Column:
    """Least hash of the shingles under each of a family of hash functions; empty for a text without words."""
    return tx._let(tx.shingles(text, n), lambda s: F.when(F.size(s) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.lit(hashes - 1)), lambda i: F.array_min(F.transform(s, lambda x: F.xxhash64(i, x))))))


def minhash_similarity(a: Column, b: Column, n: int = 3, hashes: int = 128) -> Column:
    """Share of equal minima of two signatures."""

    def share(x: Column, y: Column) -> Column:
        equal = F.size(F.filter(F.zip_with(x, y, lambda p, q: p == q), lambda e: e))
        return F.when((F.size(x) == 0) & (F.size(y) == 0), F.lit(1.0)).when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(equal / F.lit(float(hashes)))

    return tx._let(F.struct(minhash(a, n, hashes).alias("a"), minhash(b, n, hashes).alias("b")), lambda s: share(s["a"], s["b"]))


def combined(a: Column, b: Column, weights: tuple[float, float, float] = (1.0, 1.0, 1.2), how: str = "max") -> Column:
    """Weighted Jaro-Winkler, token Jaccard and abbreviation: the greatest or the sum."""
    parts = [F.lit(w) * x for w, x in zip(weights, (winkler_similarity(a, b), token_jaccard(a, b), tx.abbreviates(a, b))) if w]
    if how == "max":
        return F.greatest(*parts) if len(parts) > 1 else parts[0]
    return sum(parts[1:], parts[0])


METHODS = {"jaccard_shingles": shingle_jaccard, "token_jaccard": token_jaccard, "minhash": minhash_similarity, "jaro_winkler": winkler_similarity, "combined": combined}


def similarity(method: str, a: Column, b: Column) -> Column:
    if method not in METHODS:
        raise ValueError(f"unknown similarity method {method}; known: {sorted(METHODS)}")
    return METHODS[method](a, b)


def context_divergence(a_tokens: Column, b_tokens: Column, a_parents: Column, b_parents: Column, a_places: Column, b_places: Column) -> Column:
    score = 0.5 * (1 - jaccard(a_tokens, b_tokens)) + 0.3 * (1 - jaccard(a_parents, b_parents)) + 0.2 * (1 - jaccard(a_places, b_places))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))
