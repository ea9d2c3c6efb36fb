import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_texts():
    """Texts that operators must bear: null, empty, blank, repeated, very long, other planes, control characters."""
    long = " ".join(f"word{i % 997} Éa{i % 31}" for i in range(40_000))
    return [None, "", " \n\t ", "one", "two words", "a b c", "tie tie tie tie tie tie", "ZEBRA É é \U0001f600 end\x00\x1f.", "x" * 5000, long, long, "same text here now", "same text here now", "a\x85b c d", "don't I'll we've  gap\n\n\nline"]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(odd_texts())] + [(None, "no id", None, None, None), (None, "no id", None, None, None), (3, "one", "en", "s", 3), (3, "other text of id three", "en", "s", 22)]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def clashing(odd):
    """The odd rows with further columns whose names clash with outputs and with each other."""
    from pyspark.sql import functions as F

    names = ("token_ids", "n_tokens", "decoded", "spans", "score", "fingerprint", "component_id", "kept", "n_words", "k", "c0", "TEXT", "label")
    return odd.select("*", *[F.lit("x").alias(n) for n in names])
