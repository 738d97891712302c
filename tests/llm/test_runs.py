"""Periodic runs against a search over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from frames import ODD, frame
from pyspark.sql import functions as F

from evenkeel.llm import runs
from evenkeel.llm.queries import op11_runs


def brute(words, least=24, repeats=3):
    """(start, length, period) of all runs, by start, then period."""
    out, n = [], len(words)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            held = words[start:start + length]
            if length >= max(least, repeats * q) and all(any(held[k] != held[k + d] for k in range(length - d)) for d in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(5))
def test_runs_of_slices(seed):
    draw = random.Random(seed)
    for _ in range(40):
        least, repeats = draw.choice([(24, 3), (6, 2), (2, 2), (9, 3), (4, 4)])
        documents = []
        for _ in range(draw.randrange(6)):
            words, n = [draw.randrange(draw.choice([1, 2, 3, 8])) for _ in range(draw.randrange(90))], 0
            if draw.random() < 0.5 and (n := len(words)):
                p, a = draw.randrange(1, 12), draw.randrange(n)
                words = [words[i] if i < a else words[min(n - 1, a + (i - a) % p)] for i in range(n)]
            documents.append(np.array(words, np.int64))
        got = runs.runs_of(documents, least, repeats)
        assert {d: r for d, w in enumerate(documents) if (r := brute(w.tolist(), least, repeats))} == got


def test_nested_runs():
    """A run of period 1 inside each repeat of a longer one; a tie of starts; a Fibonacci word."""
    words = np.array(([0] * 30 + [1]) * 4)
    assert runs.runs_of([words])[0] == brute(words.tolist())
    a, b = "0", "01"
    while len(b) < 600:
        a, b = b, b + a
    fibonacci = np.array([int(c) for c in b])
    assert runs.runs_of([fibonacci])[0] == brute(fibonacci.tolist())


def test_options():
    with pytest.raises(ValueError):
        runs.find_runs(None, repeats=1)


def test_find_runs(spark):
    spaced = [(20, "x y\x85z " * 30), (21, "Ab ab " * 20), (22, "one two\nthree\t" * 9 + "end")]
    out = runs.find_runs(frame(spark, ODD + spaced).withColumn("runs", F.lit("taken")))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "runs", "collapsed"]
    rows = out.collect()
    assert len(rows) == len(ODD) + 3
    for r in rows:
        words = (r.text or "").encode().split()
        want = [(0, 30000, 1)] if r.doc_id == 7 else brute(words)
        assert [tuple(x) for x in r.runs] == want
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert r.collapsed.encode() == b" ".join(w for i, w in enumerate(words) if i not in gone) and r.score == -1.0
    assert runs.find_runs(frame(spark, [])).count() == 0


def test_query(spark, tmp_path):
    draw = random.Random(3)
    texts = ODD + [(i, " ".join(draw.choice("abcdefgh") * draw.randrange(1, 4) for _ in range(draw.randrange(0, 200))) or None) for i in range(100, 400)]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    want, planted = [], 0
    for key, text in texts:
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(b"" if key is None else str(key).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        found = [(0, 30000, 1)] if key == 7 else brute(words)
        gone, best = {i for s, size, q in found for i in range(s + q, s + size)}, None
        for r in found:
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        listed = "".join(f"{s},{size},{q}\n" for s, size, q in found).encode()
        collapsed = b" ".join(w for i, w in enumerate(words) if i not in gone)
        want.append((key, len(found), *(best or (None,) * 3), best and best[1] * 1000 // best[2], hashlib.sha256(listed).hexdigest(), hashlib.sha256(collapsed).hexdigest()))
    assert planted > 10
    got = [tuple(r) for r in op11_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
