"""Words encoded side by side, the automaton walked side by side, and tasks without this package."""

import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from frames import ODD
from tokenizers import Tokenizer

from evenkeel.llm import bpe
from evenkeel.llm.queries import VOCABULARY


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(VOCABULARY)


def letters(n, seed, most=60):
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdeinorstTHE é你.,'-12 ") for _ in range(draw.randrange(most))) for _ in range(n)]


def test_words_side_by_side(vocabulary):
    words = [w.encode() for w in letters(3000, 1)] + [b"", b"a", b"aaaaaaaa" * 30]
    for word, ids in zip(words, bpe.merged_many(words, vocabulary)):
        assert np.frombuffer(ids, np.int32).tolist() == bpe.merged(word, vocabulary.byte_ids, vocabulary.merges)
    assert bpe.merged_many([], vocabulary) == [] and bpe.merged_many([b""], vocabulary) == [b""]


def test_the_automaton_holds_what_it_gives(vocabulary):
    words = sorted({w.encode() for w in letters(500, 2, 9) if w})
    lexicon = bpe.Lexicon(bpe.compile_lexicon((w, tuple(bpe.merged(w, vocabulary.byte_ids, vocabulary.merges))) for w in words))
    asked = words + [w + b"x" for w in words] + [w[:-1] for w in words] + [b"", b"\xff"]
    assert lexicon.holds(asked).tolist() == [lexicon.get(w) is not None for w in asked]
    empty = bpe.Lexicon(bpe.compile_lexicon([]))
    assert empty.holds([b"a", b""]).tolist() == [False, False] and lexicon.holds([]).tolist() == []


def test_batches_equal_the_library(vocabulary):
    """Texts parted at spaces, texts with other white space, added tokens, nulls, in one batch and with little memory."""
    library = Tokenizer.from_file(VOCABULARY)
    texts = [t for _, t in ODD] + letters(400, 3) + ["a<|endoftext|> b", " x", "x ", "a  b", "a \n b", "tab\t x", "\x85 y", "end. ", "\x00 a"]
    block = bpe.lexicon_of([w for t in letters(50, 3) for w in t.split(" ")], vocabulary)
    codec = bpe.Codec(vocabulary, block)
    for _ in range(2):  # the second time from the memo
        ids, back = codec.batch(pa.array(texts, pa.string()))
        for text, got, said in zip(texts, ids.to_pylist(), back.to_pylist()):
            assert got == library.encode(text or "", add_special_tokens=False).ids and said == (text or "")
    ids, back = codec.batch(pa.array([], pa.string()))
    assert len(ids) == len(back) == 0


WITHOUT = """
import sys
sys.path.insert(0, {repo!r})
from evenkeel.session import build_session
spark = build_session("without", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": {shared!r}, "spark.ui.showConsoleProgress": "false"}})
spark.sparkContext.setLogLevel("OFF")
import public_tokenizers
from pyspark.sql import functions as F
from evenkeel.llm import queries

def there(batches):
    import importlib.util
    for batch in batches:
        batch["x"] = importlib.util.find_spec("evenkeel") is not None
        yield batch

assert not spark.range(1).select(F.lit(True).alias("x")).mapInPandas(there, "x boolean").first()[0], "the package is on the workers' path"
for name, query in queries.QUERIES.items():
    rows = query(spark, {sf!r}).count()
    print(name, rows)
"""


def test_workers_without_the_package(tmp_path):
    """Every query runs where Python workers can't import this package."""
    repo = bpe.__file__.rsplit("/evenkeel/", 1)[0]
    script = WITHOUT.format(repo=repo, shared=str(tmp_path / "shared"), sf="/root/testdata/sf0.001")
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=900, env={**__import__("os").environ, "PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr[-3000:]
    assert {line.split()[0] for line in done.stdout.splitlines() if line.startswith("op")} >= {"op1_quality", "op4_bpe", "op13_spelling"}
