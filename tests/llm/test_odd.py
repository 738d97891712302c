"""Null and repeated ids, null, empty and very long texts: values, not only row counts. Mixing and quality by hand."""

import collections
import math

import numpy as np
import pytest
from frames import ODD, frame
from pyspark.sql import functions as F
from test_llm import katz_scores, prose, words_of

from evenkeel.llm import katz, licenses, line_dedup, mixing, quality, toxicity
from evenkeel.llm.common import remainder


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_lines(spark):
    """No line is in ten documents: all texts stay, null as an empty one; a repeated row keeps its text twice."""
    want = sorted(((i, (t or "").count("\n") + 1, 0, t or "") for i, t in ODD), key=repr)
    assert rows_of(line_dedup.dedup_lines(frame(spark, ODD)), "doc_id", "n_lines", "n_dropped", "text") == want
    many = ODD + [(20 + i, "A b\nother") for i in range(9)]  # with row 4, "a b" is in ten documents
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.dedup_lines(frame(spark, many)).collect() if r.doc_id not in (6, None)}
    assert got[4] == ("C", 1) and got[5] == (" c", 1) and got[20] == ("other", 1) and got[7] == ("word " * 30000, 0)


def test_katz(spark):
    """The null id counts as empty text; rows of one id are scored each."""
    texts = ODD + [(30 + i, t) for i, t in enumerate(prose(20, seed=6))]
    held = {i for i, in spark.createDataFrame([(i,) for i, _ in texts], "doc_id long").filter(remainder(7) == 2).collect()}
    numbered = [((k, i), t) for k, (i, t) in enumerate(texts)]
    want = katz_scores(numbered, lambda key: key[1] not in held)
    got = rows_of(katz.score_documents(frame(spark, texts), remainder(7) != 2), "doc_id", "learns", "n_tokens", "score")
    expected = sorted(((i, i not in held, want[k, i][0], want[k, i][2]) for k, (i, _) in enumerate(texts)), key=repr)
    assert [g[:3] for g in got] == [e[:3] for e in expected] and [g[3] for g in got] == pytest.approx([e[3] for e in expected])


def test_scores_depend_on_the_text_alone(spark):
    """Quality and toxicity of a hard row are those of its text under another id."""
    texts = [(100 + i, t + (" you vile scoundrel" if i % 4 == 0 else "")) for i, t in enumerate(prose(200, seed=3))]
    labels = spark.createDataFrame([(i, int(i % 4 == 0), int(i % 4 != 0)) for i, _ in texts], "doc_id long, toxic int, quality int")
    docs = frame(spark, texts)
    model, index = quality.fit(docs, labels, F.lit(True)), toxicity.fit(docs, labels, F.lit(True))
    other = [(500 + k, t or "") for k, (_, t) in enumerate(ODD)]
    for score in (lambda d: quality.score_documents(d, model), lambda d: toxicity.score_documents(d, index)):
        got, want = rows_of(score(frame(spark, ODD)), "doc_id", "score"), {r.doc_id: r.score for r in score(frame(spark, other)).collect()}
        assert got == sorted(((i, want[500 + k]) for k, (i, _) in enumerate(ODD)), key=repr) and all(0 <= s <= 1 for _, s in got)


def test_quality_by_hand(spark):
    """Scores of whole texts against attention summed passage by passage."""
    texts = [(i, t if i % 3 else "BUY!! NOW!! " * 200) for i, t in enumerate(prose(60, seed=4))] + ODD[:5] + [(7, "word " * 30000)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, quality int")
    docs = frame(spark, texts)
    model = quality.fit(docs, labels, F.lit(True))
    got = rows_of(quality.score_documents(docs, model), "doc_id", "score")
    want = []
    for i, text in texts:
        attention, vectors = [], []
        for x in (quality.encode(text or "").astype(np.float64) - model.mean) / model.scale:
            h = np.tanh(x @ model.p["W"] + model.p["b"])
            gate = 1 / (1 + np.exp(-(h @ model.p["U"])))
            attention.append(float((np.tanh(h @ model.p["V"]) * gate) @ model.p["w"]))
            vectors.append(h)
        e = np.exp(np.array(attention) - max(attention))
        z = sum(a * v for a, v in zip(e / e.sum(), vectors))
        want.append((i, float(1 / (1 + math.exp(-float(z @ model.p["c"] + model.p["c0"][0]))))))
    want.sort(key=lambda r: (repr(r[0]), r[1]))
    got.sort(key=lambda r: (repr(r[0]), r[1]))
    assert [g[0] for g in got] == [w[0] for w in want] and [g[1] for g in got] == pytest.approx([w[1] for w in want], abs=1e-9)


def test_long_documents_are_spread_for_the_fit():
    x = np.arange(1000)[:, None]
    assert len(quality.spread(x, 10)) == 10 and quality.spread(x, 10)[[0, -1], 0].tolist() == [0, 999] and quality.spread(x[:10], 10) is not None
    assert len(quality.spread(x[:7], 10)) == 7


def test_licences(spark):
    model = licenses.fit(frame(spark, ODD))
    got = rows_of(licenses.scan_documents(frame(spark, ODD + [(9, "x\nReleased under the MIT License.")]), model), "doc_id", "n_paragraphs", F.size("licences"))
    assert got == sorted([(i, (t or "").count("\n") + 1, 0) for i, t in ODD] + [(9, 2, 1)], key=repr)


def test_mixing_by_hand(spark):
    """What each document gives, counted slot by slot; pieces cover each document once and fill blocks without overlap."""
    texts = ODD + [(100 + i, t) for i, t in enumerate(prose(80, seed=9))]
    result, slots, pieces = mixing.mix(frame(spark, texts), block_words=16)
    uses = collections.Counter((r.no, r.block) for r in slots.collect())
    taken, covered, filled = collections.Counter(), collections.Counter(), collections.defaultdict(list)
    for r in pieces.collect():
        start = (r.no, r.start)
        taken[start] += r.words * uses[r.no, r.block]
        covered[start] += r.words
        filled[r.no, r.block].append((r["at"], r["at"] + r.words))
    for spans in filled.values():
        spans.sort()
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[0][0] == 0 and spans[-1][1] <= 16
    rows = result.collect()
    assert sorted((r.size, r.taken) for r in rows if r.size) == sorted((covered[s], taken[s]) for s in covered)
    assert sorted((repr(r.doc_id), r.size) for r in rows) == sorted((repr(i), len(words_of(t))) for i, t in texts)
    assert all(r.taken <= 2 * r.size for r in rows) and sum(r.taken for r in rows) == pytest.approx(rows[0].target, abs=16)
