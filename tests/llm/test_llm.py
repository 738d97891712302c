"""The training-data operators against brute force on small tables, hard cases included."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.llm import bpe, exact_dedup, katz, licenses, line_dedup, mixing, near_dedup, neighbours, quality, toxicity
from evenkeel.llm.common import remainder
from evenkeel.llm.queries import VOCABULARY

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double"


def frame(spark, texts, sources=None):
    """Documents with further columns, one of which is named like an output."""
    rows = [(i, t, None, (sources or {}).get(i, "a"), None, -1.0) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, white space, ties, repeated rows, null ids, a very long text."""
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, "A b\nC"), (5, "a B \n c"), (6, "Ab c"), (6, "Ab c"), (None, "x y z"), (7, "word " * 30000), (8, "only\n\nlines\n")]
    return frame(spark, texts)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def prose(n, seed=1, vocabulary=400):
    draw = random.Random(seed)
    return [" ".join(f"w{int(draw.paretovariate(0.6)) % vocabulary}" for _ in range(draw.randrange(0, 120))) for _ in range(n)]


def test_exact_dedup(spark, odd, none):
    """Of the three empty texts the longest stays, then the smallest id; a repeated id is two rows of one group."""
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.deduplicate(odd).collect()), key=repr)
    want = [(1, 3, 3, False), (2, 3, 3, False), (3, 3, 3, True), (4, 4, 1, True), (5, 5, 1, True), (6, 6, 2, True), (6, 6, 2, True),
            (7, 7, 1, True), (8, 8, 1, True), (None, None, 1, True)]
    assert got == sorted(want, key=repr)
    assert exact_dedup.deduplicate(none).count() == 0


def test_exact_index_persists(spark, tmp_path):
    """Three batches: the row indexed first stays, groups count all rows so far, a text known before may be hot in a batch."""
    path = str(tmp_path / "index")
    batches = [[(5, "a b"), (6, "c")], [(1, "ab"), (2, "a b"), (3, "d"), (4, "d")], [(i, "c") for i in range(10, 40)] + [(7, "a b "), (8, "e")]]
    seen, first = collections.Counter(), {}
    for texts in batches:
        rows = exact_dedup.deduplicate(frame(spark, texts), index_path=path).collect()
        seen.update(t.replace(" ", "") for _, t in texts)
        best = {}
        for i, t in texts:
            best.setdefault(t.replace(" ", ""), []).append((-len(t), i))
        for t, found in best.items():
            first.setdefault(t, min(found)[1])
        want = {i: (first[t.replace(" ", "")], seen[t.replace(" ", "")], first[t.replace(" ", "")] == i) for i, t in texts}
        assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in rows} == want and len(rows) == len(texts)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("digest_index")]


def test_line_dedup(spark, odd, none):
    texts = [(i, f"  Shared Line\nown {i}\n\n" + ("rare\n" if i < 5 else "")) for i in range(12)] + [(20, None), (21, "shared line")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(frame(spark, texts)).collect()}
    assert got[0] == ("own 0\n\nrare\n", 5, 1) and got[7] == ("own 7\n\n", 4, 1)
    assert got[20] == ("", 1, 0) and got[21] == ("", 1, 1)
    out = line_dedup.dedup_lines(odd)
    assert out.count() == 10 and "score" in out.columns and line_dedup.dedup_lines(none).count() == 0


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 100, 1000):
        got = [r.x for r in spark.range(n).select(mixing.shuffled(F.col("id"), F.lit(n), F.lit(3)).alias("x")).collect()]
        assert sorted(got) == list(range(n))


def test_mixing(spark, odd, none):
    sources = {i: ["big", "mid", "wee", None][min(3, i % 10 // 3)] for i in range(300)}
    texts = [(i, t) for i, t in enumerate(prose(300))]
    docs = frame(spark, texts, sources)
    result, slots, _ = mixing.mix(docs, block_words=8)
    rows = result.collect()
    sizes = collections.Counter()
    for i, t in texts:
        sizes[sources[i]] += len(words_of(t))
    names = sorted(k for k in sizes if k is not None) + [None]
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(names)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(names)
    while True:
        rate = left / sum(weight[k] for k in free)
        full = {k for k in free if rate * weight[k] > 2 * sizes[k]}
        if not full:
            target |= {k: rate * weight[k] for k in free}
            break
        target |= {k: 2.0 * sizes[k] for k in full}
        left, free = left - sum(2 * sizes[k] for k in full), free - full
    taken = collections.Counter()
    for r in rows:
        assert r.size == len(words_of(dict(texts)[r.doc_id])) and r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
    for k in names:
        assert taken[k] == pytest.approx(target[k], abs=16)
    assert sorted(map(tuple, mixing.mix(docs, block_words=8)[0].collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert mixing.shard_counts(slots).agg(F.sum("n_slots")).first()[0] == slots.count()
    assert mixing.mix(odd)[0].count() == 10 and mixing.mix(none)[0].count() == 0 and mixing.mixed_documents(odd).columns == odd.columns


def test_bpe(spark, odd, none):
    from tokenizers import Tokenizer

    path = VOCABULARY
    own = Tokenizer.from_file(path)
    draw = random.Random(2)
    letters = [*"abcTHE  \n\t\r\x0b\x1c\x85\xa0'’sret.,!1½٣éß你　", "<|endoftext|>", "hello", " world"]
    texts = [(100 + i, "".join(draw.choice(letters) for _ in range(draw.randrange(30)))) for i in range(300)]
    docs = odd.unionByName(frame(spark, texts))
    for r in bpe.encode_documents(docs, path, lexicon_words=50).collect():
        want = own.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.decoded == own.decode(want, skip_special_tokens=False)
    assert bpe.encode_documents(none, path).count() == 0


def test_lexicon_shares_suffixes():
    words = sorted({f"{a}{b}ing".encode() for a in "abcdefgh" for b in "rst"} | {b"a", b"ab"})
    block = bpe.compile_lexicon((w, (len(w), w[0], i)) for i, w in enumerate(words))
    lexicon = bpe.Lexicon(block)
    assert [lexicon.get(w) for w in words] == [[len(w), w[0], i] for i, w in enumerate(words)]
    assert lexicon.get(b"arin") is None and lexicon.get(b"") is None and lexicon.get(b"aringx") is None
    assert len(lexicon.starts) < 40


def components(texts, width, percent=80):
    sets = {}
    for i, t in texts:
        w = words_of(t)
        sets[i] = {tuple(w[j:j + width]) for j in range(max(1, len(w) - width + 1))} if w else set()
    top = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                old, new = max(top[a], top[b]), min(top[a], top[b])
                top = {i: new if t == old else t for i, t in top.items()}
    return {i: (len(sets[i]), top[i]) for i in sets}


@pytest.mark.parametrize("width, crowd", [(2, 2000), (2, 2), (5, 2000)])
def test_near_dedup(spark, monkeypatch, width, crowd):
    monkeypatch.setattr(near_dedup, "CROWD", crowd)
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 7)
    draw = random.Random(3)
    texts = [t for t in prose(60, seed=4, vocabulary=60)] + ["", "one", "one two", "One  two", "one two three", "a b c d e", "a b c d e f"]
    base = prose(1, seed=9)[0] + " " + " ".join(f"v{i}" for i in range(60))
    for _ in range(60):
        words = base.split()
        for _ in range(draw.randrange(7)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(500)}"
        texts.append(" ".join(words))
    texts = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame(spark, texts), width=width).collect()}
    assert got == components(texts, width)


def test_near_dedup_odd(spark, odd, none):
    got = near_dedup.near_duplicates(odd, width=2).collect()
    assert len(got) == 10 and {(r.doc_id, r.component_id) for r in got} >= {(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (None, None)}
    assert near_dedup.near_duplicates(none).count() == 0


def test_neighbours(spark):
    draw = np.random.default_rng(1)
    vectors = [(int(i), v.tolist()) for i, v in enumerate(draw.normal(size=(1500, 16)) + 4 * draw.integers(0, 4, (1500, 1)))]
    vectors += [(2000 + i, vectors[0][1]) for i in range(40)] + [(3000, None), (3100, [0.0] * 16), (3200, [float("nan")] * 16), (3300, [None] * 16), (3400, [1.0, 2.0]), (5, vectors[5][1])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("ids", F.lit(1))
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0, cell_rows=200).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    usable = [(i, np.array(v)) for i, v in dict(vectors).items() if v and len(v) == 16 and v[0] is not None and np.isfinite(v).all() and any(v)]
    hits = 0
    queries = [(i, v) for i, v in usable if i % 100 == 0]
    for i, v in queries:
        want = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in usable if j != i)[:10]
        hits += len({j for _, j in want} & {j for j, _ in got[i]})
        assert [round(s, 9) for _, s in got[i]] == sorted(round(s, 9) for _, s in got[i]) and len(got[i]) == 10
    assert hits >= 0.9 * 10 * len(queries) and set(got) == {i for i, _ in queries}
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("cell_rows, part_rows", [(10**6, 10**6), (20, 10**6), (10**6, 30), (40, 15)])
def test_neighbours_at_equal_distances(spark, cell_rows, part_rows):
    """Whole-number grids, cells of every size: ties go to the smaller id. The stopping rule is made certain."""
    points = [(x, y, z) for x in range(9) for y in range(9) for z in range(2)]
    ids = list(range(len(points)))
    random.Random(4).shuffle(ids)
    vectors = {i: (float(x) + 1, float(y) + 1, float(z) + 1) for i, (x, y, z) in zip(ids, points)}
    vectors |= {500 + i: (1.0, 1.0, 1.0) for i in range(4)}
    df = spark.createDataFrame([(i, list(v)) for i, v in vectors.items()], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, F.lit(True), k=7, cell_rows=cell_rows, part_rows=part_rows, confidence=1 - 1e-9).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    for i, v in vectors.items():
        want = sorted((math.dist(v, w), j) for j, w in vectors.items() if j != i)[:7]
        assert [(j, d) for j, d in got[i]] == [(j, pytest.approx(d)) for d, j in want], i


def katz_scores(texts, learns):
    tokens = {i: [*words_of(t), None] for i, t in texts}
    one, two, ctx = collections.Counter(), collections.Counter(), collections.Counter()
    for i, t in tokens.items():
        if learns(i):
            one.update(t)
            for a, b in zip([""] + t, t):
                two[a, b] += 1
                ctx[a] += 1

    def discount(counts):
        n, k = collections.Counter(counts.values()), katz.K
        tail = (k + 1) * n[k + 1] / n[1] if n[1] else 1
        f = {}
        for r in range(1, k + 1):
            good = ((r + 1) * n[r + 1] / n[r] / r - tail) / (1 - tail) if n[r] and tail < 1 else 0
            f[r] = good if 0 < good < 1 else (r - 0.5) / r
        return lambda r: r * f.get(r, 1.0)

    d1, d2, n, v = discount(one), discount(two), sum(one.values()), len(one)
    saved = n - sum(d1(c) for c in one.values())
    total = n + (all(c > katz.K for c in one.values()))
    low = lambda w: d1(one[w]) / total if w in one else (saved if saved > 1e-9 else 1) / total
    after = collections.defaultdict(dict)
    for (a, b), c in two.items():
        after[a][b] = c

    def p(a, b):
        s = after.get(a)
        if not s:
            return low(b)
        total = ctx[a] + (not any(c <= katz.K for c in s.values()))
        if b in s:
            return d2(s[b]) / total
        return (1 - sum(map(d2, s.values())) / total) / (1 - sum(map(low, s))) * low(b)

    for a in list(after)[:20]:  # every context is normalised over the words and the unknown one
        assert sum(p(a, b) for b in [*one, "\0new"]) == pytest.approx(1, abs=1e-9)
    return {i: (len(t), sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t), sum(math.log10(p(a, b)) for a, b in zip([""] + t, t))) for i, t in tokens.items()}


@pytest.mark.parametrize("batch", [300, 10**9])
def test_katz(spark, monkeypatch, batch):
    monkeypatch.setattr(katz, "BATCH_TOKENS", batch)
    texts = list(enumerate(prose(150, seed=6, vocabulary=80) + [None, "", "unheard words"]))
    learns = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    want = katz_scores(texts, learns)
    got = katz.score_documents(frame(spark, texts), remainder(7) != 2).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.learns == learns(r.doc_id) and r.n_tokens == want[r.doc_id][0]
        assert r.base_score == pytest.approx(want[r.doc_id][1]) and r.score == pytest.approx(want[r.doc_id][2])


def test_katz_splits_hot_contexts(spark, monkeypatch):
    """A word that is half of all tokens, with new successors in each batch, is spread over the parts."""
    monkeypatch.setattr(katz, "BATCH_TOKENS", 300)
    monkeypatch.setattr(katz, "PART_TOKENS", 300)
    monkeypatch.setattr(katz, "SPLIT_TOKENS", 30, raising=False)
    draw, kept = random.Random(4), {}
    monkeypatch.setattr(katz, "written", lambda df, name, keep=katz.written: kept.setdefault(name, keep(df, name)))
    texts = [(i, " ".join(f"hot {'held' if i % 5 else 'w'}{draw.randrange(900)}" for _ in range(40))) for i in range(120)]
    learns = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    want = katz_scores(texts, learns)
    for r in katz.score_documents(frame(spark, texts), remainder(7) != 2).collect():
        assert r.score == pytest.approx(want[r.doc_id][2])
    entries = collections.Counter()
    for r in kept["pair-counts"].filter("batch IS NOT NULL").collect():
        entries[r.part] += len(katz.unpack(r.n))
    assert len(entries) > 5 and max(entries.values()) < 0.3 * sum(entries.values())


@pytest.mark.parametrize("split", [30, 100_000])
def test_katz_tables_score_other_texts(spark, monkeypatch, tmp_path, split):
    """A stored model scores the corpus as the run that counted it did, and texts outside it as brute force does."""
    monkeypatch.setattr(katz, "BATCH_TOKENS", 700)
    monkeypatch.setattr(katz, "PART_TOKENS", 400)
    monkeypatch.setattr(katz, "SPLIT_TOKENS", split)
    texts = [(i, t) for i, t in enumerate(prose(90, seed=21, vocabulary=60))]
    learns = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    model, scores = katz.fit_and_score(frame(spark, texts), remainder(7) != 2)
    model.save(str(tmp_path / "model"))
    again = katz.Model.load(spark, str(tmp_path / "model"))
    monkeypatch.setattr(katz, "SPLIT_TOKENS", 17)  # of another build
    assert again.words.count() > 1 and again.pairs.filter("batch >= 0").count() == 0
    columns = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    first = {r.doc_id: tuple(r)[1:] for r in scores.select(*columns).collect()}
    for r in katz.score_texts(frame(spark, texts), again).select(*columns).collect():
        assert tuple(r)[1:4] == first[r.doc_id][:3] and tuple(r)[4:] == pytest.approx(first[r.doc_id][3:])
    other = [(1000 + i, t + " never seen words") for i, t in enumerate(prose(25, seed=77, vocabulary=90))] + [(2000, None), (2001, "w1 " * 3000)]
    want = katz_scores(texts + other, lambda i: i < 1000 and learns(i))
    got = katz.score_texts(frame(spark, other), again).collect()
    assert len(got) == len(other)
    for r in got:
        assert r.n_tokens == want[r.doc_id][0] and r.base_score == pytest.approx(want[r.doc_id][1]) and r.score == pytest.approx(want[r.doc_id][2])
    assert katz.score_texts(frame(spark, []), again).count() == 0


def test_katz_odd(odd, none):
    assert katz.score_documents(odd, remainder(7) != 2).count() == 10 and katz.score_documents(none, F.lit(True)).count() == 0
    assert {r.score for r in katz.score_documents(odd, F.lit(False)).collect()} == {0.0}


def labelled(spark, texts, marks, name):
    return spark.createDataFrame([(i, int(i in marks)) for i, _ in texts] + [(999999, 1)], f"doc_id long, {name} int").unionByName(
        spark.createDataFrame([(None, 1), (3, None)], f"doc_id long, {name} int"))


def test_quality(spark, odd, none):
    good = prose(300, seed=8)
    texts = [(i, t if i % 3 else " ".join(["BUY!! NOW!!"] * (len(t) // 20 + 3))) for i, t in enumerate(good)]
    docs = frame(spark, texts)
    labels = labelled(spark, texts, {i for i, _ in texts if i % 3}, "quality")
    model = quality.fit(docs, labels, remainder(5) != 0)
    out = quality.score_documents(docs, model).collect()
    assert len(out) == 300 and all(0 <= r.score <= 1 for r in out)
    assert np.mean([(r.score >= 0.3) == (r.doc_id % 3 > 0) for r in out if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]) > 0.95
    assert quality.score_documents(odd, model).count() == 10 and quality.keep_good(odd, model).columns == odd.columns
    assert quality.fit(none, labels, F.lit(True)).score(np.zeros((1, quality.WIDTH)), np.zeros(1, int), 1)[0] == 0.5
    assert quality.score_documents(none, model).count() == 0


def test_attention_gradients():
    draw = np.random.default_rng(0)
    model, x, bag, y = quality.Attention(5, 3), draw.normal(size=(7, 5)), np.array([0, 0, 0, 1, 2, 2, 2]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = model._forward(x, bag, 3)[-1]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    slopes = model._gradients(x, bag, y)
    for name, value in model.p.items():
        at = (0,) * value.ndim
        value[at] += 1e-6
        up = loss()
        value[at] -= 2e-6
        down = loss()
        value[at] += 1e-6
        assert slopes[name][at] - (1e-4 * value[at] if name == "W" else 0) == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_toxicity(spark, odd, none):
    texts = [(i, t + (" you vile scoundrel" if i % 5 == 0 else "")) for i, t in enumerate(prose(400, seed=12))]
    docs, labels = frame(spark, texts), labelled(spark, texts, {i for i, _ in texts if i % 5 == 0}, "toxic")
    index = toxicity.fit(docs, labels, remainder(3) != 1)
    out = {r.doc_id: r for r in toxicity.score_documents(docs, index).collect()}
    held = [i for i, _ in texts if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(out[i].score >= 0.7) == (i % 5 == 0) for i in held]) > 0.97
    # pruning by blocks finds the exact neighbours
    counts = toxicity.Terms(index.terms).counts("vile scoundrel you w1 w2")
    near = index.nearest(counts)
    terms, w = index.vector(counts)
    dense = np.zeros(len(index.ids))
    for t, x in zip(terms, w):
        dense[index.at[t]] += x * index.weight[t]
    want = sorted(((s, i) for i, s in enumerate(dense) if s > 0), key=lambda x: (-round(x[0], 9), x[1]))[:toxicity.NEIGHBOURS]
    assert [round(s, 9) for s, _ in near] == [round(s, 9) for s, _ in want]
    assert toxicity.score_documents(odd, index).count() == 10 and toxicity.score_documents(none, index).count() == 0
    assert toxicity.fit(none, labels, F.lit(True)) == 0.5


def test_toxicity_neighbours_from_the_texts(spark):
    """Neighbours and evidence of whole texts against cosines computed from the words of the texts, ties included."""
    draw = random.Random(5)
    insults = ["scoundrel", "scoundrels", "vile", "viler", "dolt", "doltish"]
    texts = [(i, t + "".join(f" {draw.choice(insults)}" for _ in range(draw.randrange(1, 5))) if i % 4 == 0 else t) for i, t in enumerate(prose(500, seed=2))]
    texts += [(1000 + i, texts[4 * i][1]) for i in range(20)]  # equal examples
    docs, labels = frame(spark, texts), labelled(spark, texts, {i for i, _ in texts if i % 4 == 0}, "toxic")
    index = toxicity.fit(docs, labels, F.lit(True))

    def counts(text):
        found = collections.Counter()
        for word in text.encode().lower().split():
            word = word.strip(toxicity.EDGE)
            for term in [word, *(b"^" + word.decode()[:n].encode() for n in (4, 5) if len(word) > n)]:
                found[term] += term in index.terms
        return {t: n for t, n in found.items() if n}

    held = {i: counts(t) for i, t in texts}
    df = collections.Counter(t for i in index.ids for t in held[i])
    idf = {t: math.log((1 + len(index.ids)) / (1 + df[t])) + 1 for t in index.terms}

    def vector(c):
        w = {t: (1 + math.log(n)) * idf[t] for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()}

    examples = [vector(held[i]) for i in index.ids]
    evidence = {r.doc_id: r.evidence for r in toxicity.score_documents(docs, index).collect()}
    assert len(index.ids) == len(texts) and sum(map(bool, evidence.values())) > 100
    for i, _ in texts[::7]:
        mine = vector(held[i])
        cosines = [sum(x * e.get(t, 0.0) for t, x in mine.items()) for e in examples]
        want = sorted(((round(c, 9), -at) for at, c in enumerate(cosines) if c > 1e-12), reverse=True)[:toxicity.NEIGHBOURS]
        near = index.nearest(toxicity.Terms(index.terms).counts(dict(texts)[i])) if mine else []
        assert [round(c, 9) for c, _ in near] == [c for c, _ in want]
        assert sorted(round(cosines[at], 9) for _, at in near) == sorted(c for c, _ in want)
        assert evidence[i] == [index.ids[at] for _, at in near if index.labels[at] > 0.5]


def test_licenses(spark, odd, none):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    texts = list(enumerate(prose(40, seed=5) + [f"words\nLicensed under the Apache License, Version 2.0.\n{notice}", "Licensed under CC BY-NC 4.0.", "he licensed the software free of any plan", None]))
    docs = frame(spark, texts)
    out = {r.doc_id: [(x.paragraph, x.family) for x in r.licences if x.confirmed] for r in licenses.scan_documents(docs, licenses.fit(docs)).collect()}
    assert out[40] == [(1, "Apache"), (2, "MIT")] and out[41] == [(0, "CC-BY-NC")]
    assert not any(v for i, v in out.items() if i not in (40, 41))
    model = licenses.fit(none)
    assert licenses.scan_documents(odd, model).count() == 10 and licenses.scan_documents(none, model).count() == 0


def test_licenses_inside_lines(spark):
    before, after = prose(2, seed=8)
    notices = [("Copyright (c) 2020 Foo Inc. All rights reserved.", ["Proprietary"]), ("(C) Jane Roe and others 2019, all rights reserved worldwide", ["Proprietary"]),
               ("This project is licensed under the MIT License - see the LICENSE file for details.", ["MIT"]),
               ("The source can be had by letter. Released under the MIT License. Contact us for details.", ["MIT"]),
               ("It is dual licensed. Licensed under the MIT license. Licensed under the Apache License, Version 2.0. Pick one.", ["MIT", "Apache"]),
               ("photos are licensed under CC BY-SA 4.0 unless noted", ["CC-BY-SA"]), ("# SPDX-License-Identifier: GPL-3.0-or-later see COPYING", ["GPL"]),
               ("Licensed under the Zebra License.", []), ("GNU Lesser General Public License v2.1", ["LGPL"]), ("Apache-2.0", ["Apache"]),
               ("Code is available under the terms of the Apache 2.0 license.", ["Apache"]), ("they worked under the terms of the plan and all copies were sold", [])]
    lines = [x for notice, _ in notices for x in (notice, f"{before} {notice} {after}".replace("\n", " "))]
    docs = frame(spark, [(0, "\n".join(lines)), *enumerate(prose(40, seed=5), 1)])
    out = {r.doc_id: [(x.paragraph, x.family) for x in r.licences if x.confirmed] for r in licenses.scan_documents(docs, licenses.fit(docs)).collect()}
    assert out[0] == [(2 * i + j, f) for i, (_, families) in enumerate(notices) for j in (0, 1) for f in families]
    assert not any(v for i, v in out.items() if i)


def test_licenses_unknown_class_decides():
    class Doubting(licenses.Classifier):
        def __init__(self, unknown):
            self.p = np.zeros(len(licenses.FAMILIES))
            self.p[0], self.p[1] = unknown, 1 - unknown
            self.marks = {"mit license", "quagga licence"}

        def probabilities(self, words):
            return self.p

    notice = "Released under the MIT License."
    assert not Doubting(0.69).scan(notice) and [x[:3] for x in Doubting(0.25).scan(notice)] == [(0, "MIT", 0.75)]
    # the classifier alone is heard where it is sure, as not confirmed
    assert not Doubting(0.3).scan("the quagga licence of zebras") and [x[1:] for x in Doubting(0.1).scan("the quagga licence of zebras")] == [("MIT", 0.9, 0.0, False)]
    # no part of a long template is unknown to the classifier
    model = licenses.Classifier([licenses.words_of(x) for x in prose(300, seed=5)])
    for family, texts in licenses.TEMPLATES.items():
        for words in map(licenses.words_of, texts):
            for i in range(max(1, len(words) - 11)):
                p = model.probabilities(words[i:i + 12])
                # wording that families share may be read as another of them, what is a family's own may not
                own = len(set(licenses.grams(words[i:i + 12])) & licenses.OWN[family]) > 2
                assert p.argmax() and (not own or licenses.FAMILIES[p.argmax()] == family and p.max() >= licenses.THRESHOLD), words[i:i + 12]


def test_licenses_find_every_template():
    """Each template, whole or inside prose, is found as its family and confirmed; prose alone names nothing."""
    clean = prose(300, seed=5)
    model = licenses.Classifier([licenses.words_of(x) for x in clean])
    draw = random.Random(1)
    for family, texts in licenses.TEMPLATES.items():
        for text in texts:
            before, after = (" ".join(draw.choice(clean).split()[:30]) for _ in range(2))
            for line in (text, f"{before} {text} {after}"):
                assert (0, family, True) in {(i, f, sure) for i, f, _, _, sure in model.scan(line)}, line
    assert not any(model.scan(t) for t in clean)


def test_licenses_learn_from_whole_documents(spark, monkeypatch):
    given = []
    monkeypatch.setattr(licenses, "Classifier", lambda others: given.extend(others))
    late, wide = [f"early{i} late{i}" for i in range(60)], [f"wide{i}" for i in range(1000)]
    licenses.fit(frame(spark, [(0, "\n".join(late)), (1, " ".join(wide)), (2, "Released under the MIT License.")]))
    assert sorted(w for words in given for w in words) == sorted([*" ".join(late).split(), *wide])
    assert max(map(len, given)) <= licenses.LONGEST


def test_pipeline(spark, tmp_path):
    """Every stage keeps and drops what brute force does on its own input."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "mixing", "bpe"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, sf)
        path = str(tmp_path / name)
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if name == "bpe":
            for r in out.collect():
                assert r.decoded_sha256 == hashlib.sha256((before[r.doc_id] or "").encode()).hexdigest()
            break
        assert out.columns == docs.columns
        after = {r.doc_id: r.text for r in out.collect()}
        if name == "line_dedup":
            many = collections.Counter(k for t in before.values() for k in {x.strip(" \t\n\x0b\x0c\r").lower() for x in (t or "").split("\n")} if k)
            assert all(len(after[i].split("\n")) <= len((t or "").split("\n")) for i, t in before.items())
            assert not any(many[x.strip(" \t\n\x0b\x0c\r").lower()] >= 10 for t in after.values() for x in t.split("\n") if x.strip())
        elif name == "near_dedup":
            assert set(after) == {i for i, (n, c) in components(list(before.items()), 5).items() if c == i}
        docs = out


def test_pipeline_odd(spark, odd, none, tmp_path):
    """Odd rows through every stage; a table without n_chars and with a column of its own; an empty table."""
    import corpus_pipeline

    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 9)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    docs = odd.drop("n_chars").withColumn("mine", F.lit(7))
    good = stages["quality"](spark, docs, str(tmp_path))
    assert rows(good) == rows(docs) and good.columns == docs.columns  # every label says good
    lines = stages["line_dedup"](spark, good, str(tmp_path))
    assert rows(lines) == sorted(((i, t or "") for i, t in rows(docs)), key=repr) and lines.columns == docs.columns
    near = stages["near_dedup"](spark, lines, str(tmp_path))
    # rows 4 and 5 have the same words, so the first stays; equal rows of one id stay together
    assert rows(near) == [r for r in rows(lines) if r[0] != 5]
    mixed = stages["mixing"](spark, near, str(tmp_path))
    size = {i: len(words_of(t)) for i, t in rows(near)}
    assert mixed.columns == docs.columns and {i for i, _ in rows(mixed)} <= {i for i in size if size[i]} and mixed.filter("mine = 7").count() == mixed.count()
    coded = stages["bpe"](spark, mixed, str(tmp_path))
    assert coded.count() == mixed.count() and coded.filter("n_tokens = 0").count() == 0
    empty = none
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, str(tmp_path))
        assert empty.count() == 0, name
