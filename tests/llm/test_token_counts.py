"""Token counts against the library."""

import random

import pytest
import sentencepiece
from frames import ODD, frame
from pyspark.sql import functions as F

from evenkeel.llm import token_counts
from evenkeel.llm.queries import PIECES, op12_token_counts


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def hard(n, seed=4):
    draw = random.Random(seed)
    parts = [*"abcTHE  \n\t\r\x0b\x85\xa0'’sret.,!1½٣éß你　▁Ａ", "<s>", "</s>", "<unk>", "<0x0A>", "hello", " world", "▁the", "   ", "ing", "́", "🙂", " ", "\x00"]
    return ["".join(draw.choice(parts) for _ in range(draw.randrange(40))) for _ in range(n)]


def test_merges_equal_the_library(library):
    pieces = token_counts.read_model(PIECES)
    draw = random.Random(5)
    for _ in range(300):
        word = "▁" + "".join(draw.choice("aeiounrstl▁é.<") for _ in range(draw.randrange(1, 120)))
        assert token_counts.merged(word, pieces) == token_counts._merged_long(word, pieces)
        spaced = word[1:].replace("▁", " ")
        assert len(token_counts.merged(word, pieces)) == len(library.encode(spaced, out_type=str))


def test_whole_tokens_are_single(library):
    """A proven piece is one token by itself; what stands in none of them is not."""
    pieces = token_counts.read_model(PIECES)
    whole = token_counts.whole_tokens(pieces)
    near = token_counts.neighbours(pieces)
    assert 20_000 < len(whole) <= len(pieces)
    for piece in whole:
        if piece.startswith("▁") and len(piece) > 1 and piece[1] != "▁":
            assert library.encode(piece[1:], out_type=str) == [piece]
    assert not any(pair[1] == "▁" and pair[0] != "▁" for pair in near)


def test_other_models_are_refused(monkeypatch):
    class Folding:
        def __init__(self, model_file):
            pass

        def normalize(self, text):
            return text.lower()

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Folding)
    with pytest.raises(ValueError):
        token_counts.read_model(PIECES)


def test_count_tokens(spark, library):
    texts = ODD + list(enumerate(hard(500), 100)) + [(900, "a" * 50_000 + "ß" * 300), (901, "  two  spaces  "), (902, " "), (903, "▁")]
    out = token_counts.count_tokens(frame(spark, texts).withColumn("n_tokens", F.lit("taken")), PIECES)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "n_bytes", "n_tokens"]
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_bytes, r.n_tokens, r.score) == (len((r.text or "").encode()), len(library.encode(r.text or "")), -1.0), r.doc_id
    assert token_counts.count_tokens(frame(spark, []), PIECES).count() == 0


def test_query(spark, tmp_path, library):
    texts = ODD + list(enumerate(hard(200, 6), 100))
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    want = [(key, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for key, t in texts]
    got = [tuple(r) for r in op12_token_counts(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and any(r[3] for r in got)
