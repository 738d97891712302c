"""Spelling variants against a comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from frames import ODD, frame
from pyspark.sql import functions as F

from evenkeel.llm import spelling
from evenkeel.llm.queries import op13_spelling


def one_edit(a, b):
    """True if one inserted, deleted or replaced letter leads from ``a`` to ``b``."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(counts, ratio=5):
    """word to (form, root, n, n_near, form_n)."""
    near = {w: [v for v in counts if abs(len(v) - len(w)) <= 1 and one_edit(w, v)] for w in counts}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def vocabulary(n, seed, letters="abcdeé", sizes=(6, 12)):
    """Words with many near and many anagrams among them, of very different frequency."""
    draw = random.Random(seed)
    words = set()
    while len(words) < n:
        w = [draw.choice(letters) for _ in range(draw.randint(*sizes))]
        words.add("".join(w))
        for _ in range(3):
            v = list(w)
            at = draw.randrange(len(v))
            v[at:at + 1] = draw.choice([[], [draw.choice(letters)], [v[at], draw.choice(letters)]])
            if len(v) >= sizes[0]:
                words.add("".join(v))
                w = v if draw.random() < 0.5 else w
    return {w: int(5 * draw.paretovariate(0.4)) % 10**9 for w in sorted(words)}


def results(found):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect()}


@pytest.mark.parametrize("cell", [40, 10**6])
def test_variants(spark, cell):
    counts = vocabulary(900, cell)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = brute(counts)
    assert sum(w[3] for w in want.values()) > 200 and any(w[0] and w[0] != w[1] for w in want.values())
    found = spelling.variants(df, cell=cell)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"] and results(found) == want and found.count() == len(counts)


def test_blocks_of_words_and_queries(spark):
    """A cell dealt to blocks both ways gives each link once."""
    counts = vocabulary(400, 3, "abc", (6, 8))
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = [(r.word, r.near, r.near_n) for r in spelling.near_words(df, block_words=500, block_queries=700).collect()]
    want = [(a, b, counts[b]) for a in counts for b in counts if abs(len(a) - len(b)) <= 1 and one_edit(a, b)]
    assert sorted(got) == sorted(want)


def test_block_of_anagrams_and_long_words():
    """Words of the same letters in every order; words of hundreds of letters."""
    draw = random.Random(9)
    base = "aabbccde"
    same = {"".join(draw.sample(base, 8)) for _ in range(400)} | {"".join(draw.sample("aabbccdf", 8)) for _ in range(400)}
    long = {"".join(draw.choice("aÿ") for _ in range(300)) for _ in range(5)}
    long |= {w[:100] + "b" + w[101:] for w in long}
    for words in (sorted(same), sorted(long)):
        rows = pd.DataFrame({"word": words, "n": 5})
        got = sorted((words[q], words[m]) for i, j in spelling.near_in_block(rows, rows) for q, m in zip(i, j))
        assert got == sorted((a, b) for a in words for b in words if one_edit(a, b)) and got
    longer = sorted({w[:i] + "b" + w[i:] for w in long for i in (0, 150, 300)})
    rows, asked = pd.DataFrame({"word": sorted(long), "n": 5}), pd.DataFrame({"word": longer, "n": 5})
    got = sorted((longer[q], sorted(long)[m]) for i, j in spelling.near_in_block(rows, asked) for q, m in zip(i, j))
    assert got == sorted((a, b) for a in longer for b in long if one_edit(a, b))


def test_equal_hashes(monkeypatch):
    """Words that share a hash are all compared."""
    monkeypatch.setattr(spelling, "scattered", lambda x: np.ones(len(x), np.uint64))
    words = [w for w in sorted(vocabulary(300, 5, "abc", (6, 6))) if len(w) == 6]
    rows = pd.DataFrame({"word": words, "n": 5})
    got = sorted((words[q], words[m]) for i, j in spelling.near_in_block(rows, rows) for q, m in zip(i, j))
    assert got == sorted((a, b) for a in words for b in words if one_edit(a, b))


def test_roots(spark):
    chain = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("x", "e")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == dict.fromkeys("abcdx", "e")


def test_count_words(spark):
    texts = ODD + [(i, "Éclairs ÉCLAIRS, straße×÷ naïveté-naïveté x1word2") for i in range(20, 24)]
    got = {r.word: r.n for r in spelling.count_words(frame(spark, texts).withColumn("word", F.lit(1)), least_length=4, least_count=2).collect()}
    assert got == {"word": 30004, "Éclairs": 8, "straße×÷": 4, "naïveté": 8}
    empty = spelling.variants(spelling.count_words(frame(spark, [])))
    assert empty.count() == 0


def test_query(spark, tmp_path):
    draw = random.Random(8)
    counts = vocabulary(150, 8, "abcé", (6, 9))
    words = [w for w in counts for _ in range(min(400, counts[w]))] + ["short", "ABCabc"] * 30
    draw.shuffle(words)
    texts = ODD + [(i, " ".join(words[i * 100:(i + 1) * 100]) or None) for i in range(100, 100 + len(words) // 100 + 2)]
    texts += [(50, " ".join(words[:10_000]))]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    total, slips = Counter(), 0
    for key, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run, slips = run[:h % len(run)] + run[h % len(run) + 1:], slips + 1
            total[run] += 1
    want = brute({w: n for w, n in total.items() if len(w) >= 6 and n >= 5})
    assert slips > 20 and any(w[0] for w in want.values())
    assert results(op13_spelling(spark, str(tmp_path))) == want
