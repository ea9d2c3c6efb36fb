import random
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stratalex.llm import queries, rangecoder, tokenstore
from stratalex.llm.base import pick, table


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))


def expected(rows, library):
    start = 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        yield i, start, len(ids), zlib.crc32(array("I", ids).tobytes())
        start += len(ids)


def test_op3_matches_library(spark, data, library):
    rows = [tuple(r) for r in table(spark, data, "documents").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op3_tokenstore(spark, data).collect())) == sorted(expected(rows, library))


SPECIAL = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|>start", "end<|endoftext|>", "x<|endoftext|><|endoftext|>y", " <|endoftext|>  z", "<|endoftext", "|endoftext|> <|"]
SPACED = ["a  b", " lead", "trail ", "  ", "a \nb", "a\n b", "a\x1c b", "a \u00a0b", "a\u3000 b c", "a \u200bb", "it's we'll  I'd 've", "1 2  3\t4 \t5", "\u180e x \u180e y", "\n\n a\r\n b", "\x85 a \x85", "\u2028 a\u2029 b"]


def test_encoder_equals_the_library(library):
    import random

    rng = random.Random(4)
    parts = [" ", " ", " ", "\n", "\t", "\u00a0", "a", "word", "É", "1", "23", "'s", "'", "!", "\U0001f600", "\x1c", "\u180e", "\u200b", "\u3000", "<|endoftext|>"]
    texts = [None, "", *SPECIAL, *SPACED, *["".join(rng.choice(parts) for _ in range(rng.randint(1, 20))) for _ in range(5000)]]
    made = tokenstore.encoder(public_tokenizers.path(queries.TOKENIZER))
    for _ in range(2):  # again with everything remembered
        assert [array("I", x).tolist() for x in made(texts)] == [library.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


def test_texts_are_cut_at_marks_as_the_library_cuts(library):
    """Whole columns: words are learned without the marks after them, and simple, spaced, added-token, blank and null texts keep their order."""
    import pyarrow as pa

    rng = random.Random(9)
    parts = [" ", " ", "\n", "a", "Word", "Éa", "ñ", "ß", "×", "÷", "7", "'s", "'", "!", ",", ".;", "$$$", "_", "[x]", "~", "\u0301", "日本", "\U0001f600", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts[: rng.choice([-1, len(parts)])]) for _ in range(rng.randint(0, 12))) for _ in range(8000)]
    made = tokenstore.Encoder(public_tokenizers.path(queries.TOKENIZER))
    want = [library.encode(t, add_special_tokens=False).ids + [0] for t in texts]
    for k, step in ((0, 8000), (1000, 1), (2000, 300)):
        ids, counts = made.coded(pa.array([None, *texts[k : k + step]], pa.string()))
        assert counts.tolist() == [1, *map(len, want[k : k + step])] and ids.tolist() == [0, *(i for w in want[k : k + step] for i in w)]
    simple = ["End.", "a,b c!", "x\ny"]
    made = tokenstore.Encoder(public_tokenizers.path(queries.TOKENIZER))
    made.coded(pa.array(simple))
    assert {"\rEnd", "\r.", "\ra", "\r,b", "c", "\r!", "\rx", "\n", "\ry"} == set(made.young)


def test_generations_of_remembered_parts(library, monkeypatch):
    monkeypatch.setattr(tokenstore, "GENERATION", 5)
    made = tokenstore.Encoder(public_tokenizers.path(queries.TOKENIZER))
    for k in range(40):
        texts = [f"word{k} word{k - 1} and word{k % 7}", "and the " + "long" * 40]
        assert [array("I", x).tolist() for x in made(texts)] == [library.encode(t, add_special_tokens=False).ids + [0] for t in texts]
        assert len(made.young) <= 5 + 20


def test_op3_odd_rows(spark, clashing, library, tmp_path):
    folder = f"file://{tmp_path}/ids"
    vocabulary = public_tokenizers.path(queries.TOKENIZER)
    special = spark.createDataFrame([(100 + i, t) for i, t in enumerate(SPECIAL)], "doc_id long, text string")
    both = pick(clashing, doc_id="doc_id", text="text").unionByName(special)
    tokenstore.write(both, folder, vocabulary)
    found = tokenstore.read(spark, folder).collect()
    want = sorted((str(r["doc_id"]), len(x := library.encode(r["text"] or "", add_special_tokens=False).ids) + 1, zlib.crc32(array("I", [*x, 0]).tobytes())) for r in both.collect())
    assert sorted((str(r["doc_id"]), r["n_tokens"], zlib.crc32(bytes(r["token_ids"]))) for r in found) == want
    ends = sorted((r["start"], r["n_tokens"]) for r in found)
    assert ends[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:]))
    tokenstore.write(clashing, folder + "-wide", vocabulary)
    assert tokenstore.read(spark, folder + "-wide").count() == clashing.count()
    tokenstore.write(clashing.limit(0), folder + "-none", vocabulary)
    assert tokenstore.read(spark, folder + "-none").count() == 0


@pytest.mark.parametrize("kind", ["random", "one", "zipf", "loop", "large"])
def test_coder_round_trip(kind):
    rng = np.random.default_rng(7)
    for n in (0, 1, 255, 256, 257, 9000):
        made = {"random": rng.integers(0, 50257, n), "one": np.full(n, 50256), "zipf": np.minimum(rng.zipf(1.3, n), 50256), "loop": np.arange(n) % 37, "large": rng.integers(0, 1 << 22, n)}
        ranks = made[kind].astype(np.int64)
        counts, length = rangecoder.octave_counts(ranks), rangecoder.block_length(n)
        blocks = rangecoder.encode(ranks, length, counts)
        assert (rangecoder.decode(blocks, length, counts)[:n] == ranks).all()
        if len(blocks) > 1:  # any block alone
            assert (rangecoder.decode(blocks[1:2], length, counts)[: n - length] == ranks[length : 2 * length]).all()
        if kind == "loop" and n == 9000:
            assert sum(map(len, blocks)) < n / 2


def test_long_blocks_keep_every_share_positive():
    """Ranks that never change, then others: shares reach their bounds."""
    ranks = np.concatenate([np.zeros(3000, np.int64), np.arange(3000) * 17 % 60000, np.full(3000, 59999), np.arange(3000)[::-1]])
    counts = rangecoder.octave_counts(ranks)
    blocks = rangecoder.encode(ranks, len(ranks), counts)
    assert len(blocks) == 1 and (rangecoder.decode(blocks, len(ranks), counts) == ranks).all()


def test_damage_is_found():
    packed = [array("I", [random.randrange(50257) for _ in range(40)]).tobytes() for _ in range(8)] + [array("I", [300000]).tobytes()]
    payload = tokenstore.pack([*range(8), None], packed)
    doc_ids, counts, ids = tokenstore.unpack(payload)
    assert doc_ids == [*range(8), None] and counts.tolist() == [40] * 8 + [1] and ids.astype("<u4").tobytes() == b"".join(packed)
    for at in (0, 40, len(payload) - 60):
        with pytest.raises(ValueError):
            tokenstore.unpack(payload[:at] + bytes([payload[at] ^ 255]) + payload[at + 1 :])
