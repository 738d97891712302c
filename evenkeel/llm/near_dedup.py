"""Near-duplicates by bottom-k sketches of one hash function.

A document's set holds the hashes of its word shingles. Its sketch is the ``SKETCH`` least. Equal sets
are one class first, so exact copies never meet pairwise. Inverted lists hold, for every two
neighbouring retained values, the classes that retain both next to each other: sets of Jaccard
similarity 0.8 share at least ``SHARED`` such neighbourhoods but for a probability of about 1e-12
(short sets, whose sketch is the whole set, share at least n - 1 - 0.4 n without exception), while unlike
texts hardly ever share one. Candidates from the lists pass if the sketch of the union estimates
a similarity within six deviations of the threshold; the exact similarity of the full sets, read
again from the texts, decides.

Lists never emit all their pairs. In each turn a list names leaders among its members, and the
members outside a leader's component are compared with the leaders alone; links join components,
and lists within one component are done. After the last turn the pairs between different
components of a list are compared, each once. Lists with more than ``CROWD`` such pairs are
boilerplate in unlike texts, or large groups with strays. A class may miss some of them: as long as it is in so few
that the lists it must share with a like set include two others, it is found there. The classes in more
are compared by exact prefix filtering of their full sets, rarest shingles first, in blocks of bounded size that emit links alone. So every link between different texts either is compared or joins
what is one component already, at any size of a list or a group.

Defined cases: null text counts as empty; a set without words links with nothing, and fewer words
than a shingle are one shingle; a null id takes no part in links and is kept; rows that repeat an
id are one node; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import counted_small, joined_by_share, received, shipped, written

SKETCH = 64
#: Lists that two like sets of any size share at least, apart from short sets.
SHARED = 7
#: Pairs between components of a list up to which the list is compared pair by pair.
CROWD = 500
#: Classes and shingles a block of a crowded list may hold, and columns of a product.
BLOCK_ROWS = 1000
BLOCK_VALUES = 1_500_000
WIDE = 2048
#: Binary digits of the number of counters that order values by frequency, and counts added up at a time.
COUNTERS = 22
FAN_IN = 32
#: In each turn the leaders of a list up to this rank meet the members.
TURNS = (1, 3)
MEMO_LIMIT = 300_000


class WordHashes(dict):
    """64-bit hashes of the words seen, forgotten when they grow many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_LIMIT:
            self.clear()
        found = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = found
        return found

    def of(self, text: str) -> np.ndarray:
        """Hashes of the words of ``text``: split at ASCII white space, A-Z in lower case."""
        words = text.encode("utf-8", "replace").lower().split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def scattered(x: np.ndarray) -> np.ndarray:
    """splitmix64: spreads 64-bit integers evenly."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct hashes of all runs of ``width`` words, sorted; fewer words are one run."""
    if not len(words):
        return words
    width = min(width, len(words))
    run = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        run = scattered(run * np.uint64(31) + words[i:len(words) - width + 1 + i])
    return np.unique(run)


def features(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(id, set size, two digests of the set, sketch)."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            sizes, first, second, sketches = [], [], [], []
            for value in batch.column(1):
                s = shingles(memo.of(value.as_py() or ""), width)
                sizes.append(len(s))
                first.append(int(scattered(s).sum(dtype=np.uint64).astype(np.int64)))
                second.append(int(scattered(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
                sketches.append(s[:SKETCH].astype(np.int64))
            ends = np.cumsum([0] + [len(x) for x in sketches]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sketches) if sketches else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), lists], ["doc_id", "n", "d1", "d2", "sketch"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.col(text)).mapInArrow(found, f"doc_id {kind}, n long, d1 long, d2 long, sketch array<long>")


def within_sizes(a: str, b: str, percent: int):
    """Set sizes that allow the similarity."""
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent)


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose union sketch does not rule out the similarity."""
    side = lambda x: classes.select(F.col("doc_id").alias(x), F.col("sketch").alias(f"s{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    # values are compared as unsigned numbers: flipping the sign bit orders them so
    order = lambda x: F.transform(x, lambda v: v.bitwiseXOR(F.lit(-(1 << 63))))
    union = F.slice(F.array_sort(order(F.array_union("sa", "sb"))), 1, SKETCH)
    shared = F.size(F.array_intersect(union, order(F.array_intersect("sa", "sb")))) / F.size(union)
    p = percent / 100
    return both.filter(shared >= p - 6 * F.sqrt(F.lit(p * (1 - p)) / F.size(union)) - 1e-9).select("a", "b")


def verified(pairs: DataFrame, docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar."""
    needed = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    needed = written(needed, "needed")
    texts = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = written(texts.join(counted_small(needed, needed.count()), "doc_id", "left_semi"), "texts")
    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "ta", "tb")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            last, mine, keep = None, None, []
            for ta, tb in zip(batch.column(2), batch.column(3)):
                ta = ta.as_py()
                if ta != last:  # rows of one leader follow each other
                    last, mine = ta, shingles(memo.of(ta), width)
                other = shingles(memo.of(tb.as_py()), width)
                shared = len(np.intersect1d(mine, other, assume_unique=True))
                keep.append(shared > 0 and 100 * shared >= percent * (len(mine) + len(other) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(compared, f"a {kind}, b {kind}")


def components(edges: DataFrame) -> DataFrame:
    """(doc_id, component): the least id reachable, for every id with an edge.

    Labels spread to neighbours and then jump to the label of their label, until nothing changes. A leader
    with a large share of all edges, or a label of a large share of all ids, is joined by broadcast.
    """
    both = written(edges.union(edges.select("b", "a")).distinct(), "edges")
    degree = written(both.groupBy(F.col("b").alias("doc_id")).agg(F.count("*").alias("rows")), "degrees")
    total = max(1, both.count())
    labels = written(both.groupBy(F.col("a").alias("doc_id")).agg(F.least(F.min("a"), F.min("b")).alias("component")), "labels")
    ids = degree.count()
    while True:
        known = labels.join(degree, "doc_id").select(F.col("doc_id").alias("b"), "component", "rows")
        near = joined_by_share(both, known, ["b"], "rows", total).groupBy("a").agg(F.min("component").alias("near"))
        spread = labels.join(near, labels.doc_id == near.a).select("doc_id", "component", F.least("component", "near").alias("next"))
        spread = written(spread, "spread")
        often = spread.groupBy("next").agg(F.count("*").alias("rows"))
        jump = spread.select(F.col("doc_id").alias("next"), F.col("next").alias("further")).join(often, "next")
        moved = joined_by_share(spread, jump, ["next"], "rows", max(1, ids))
        moved = written(moved.select("doc_id", F.col("further").alias("component"), (F.col("further") < F.col("component")).alias("moved")), "labels")
        labels = moved.select("doc_id", "component")
        if not moved.filter("moved").head(1):
            return labels


def _with_components(entries: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return entries.withColumn("component", F.col("doc_id"))
    return entries.join(labels, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def _open(entries: DataFrame) -> DataFrame:
    """Lists whose members are in different components."""
    return entries.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("key")


def _leaders(entries: DataFrame) -> DataFrame:
    """(key, rank, leader, m, lead): the first members of each list, those in the most crowded lists first.

    Copies of one text meet in the same crowded lists, and the copy nearest to all others meets
    most of them; as a leader it links most at once.
    """
    crowded = entries.groupBy("doc_id").agg(F.sum("c").alias("weight"))
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.col("weight").desc(), "doc_id"))
    ranked = entries.join(crowded, "doc_id").withColumn("rank", rank).filter(F.col("rank") <= TURNS[-1])
    return ranked.select("key", "rank", F.col("doc_id").alias("leader"), F.col("n").alias("m"))


def _leader_pairs(entries: DataFrame, leaders: DataFrame, labels: DataFrame | None, percent: int) -> DataFrame:
    """(a, b): members against leaders of their list that are in other components."""
    lead = _with_components(leaders.select("key", F.col("leader").alias("doc_id"), "m"), labels).select(
        "key", F.col("doc_id").alias("a"), "m", F.col("component").alias("theirs"))
    met = entries.join(lead, "key").filter((F.col("component") != F.col("theirs")) & within_sizes("n", "m", percent))
    # like sets share many neighbourhoods, chance meetings mostly one; what this leaves is compared at the end
    return met.groupBy("a", F.col("doc_id").alias("b")).agg(F.count("*").alias("shared")).filter("shared >= 2").select("a", "b")


def _cross_pairs(entries: DataFrame, percent: int, least: int) -> DataFrame:
    """(a, b): members of ``least`` lists or more that are in different components, each pair once."""
    x = entries.select("key", F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"))
    y = entries.select("key", F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"))
    pairs = x.join(y, "key").filter((F.col("ca") < F.col("cb")) & within_sizes("na", "nb", percent))
    met = pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count("*").alias("shared"))
    return met.filter(F.col("shared") >= least).select("a", "b")


def _must_share(n: str, percent: int):
    """Lists that a set of ``n`` shares with every like set: each value it has alone breaks two neighbourhoods at most."""
    return F.least(F.lit(SHARED), F.col(n) - 1 - F.floor(F.col(n) * 2 * (100 - percent) / 100))


def _by_size(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keys of open lists: those of at most ``CROWD`` pairs between components, and those of more."""
    each = entries.groupBy("key", "component").agg(F.count("*").alias("c")).groupBy("key").agg(F.sum("c").alias("all"), F.sum(F.col("c") * F.col("c")).alias("within"))
    cross = (F.col("all") * F.col("all") - F.col("within")) / 2
    return each.filter((cross > 0) & (cross <= CROWD)).select("key"), each.filter(cross > CROWD).select("key")


def bucket_of(values: np.ndarray) -> np.ndarray:
    """The counter of each value."""
    return (scattered(values.astype(np.uint64)) >> np.uint64(64 - COUNTERS)).astype(np.int64)


def value_counts(full: DataFrame) -> np.ndarray:
    """How many sets hold a value of each of 2^``COUNTERS`` counters, as one byte each; values share counters by hash.

    The size is fixed, whatever the number of values: none, one, two, and from there on steps of an eighth of a doubling,
    which any order of values may use. Tasks count for themselves, and their counts are added up
    ``FAN_IN`` at a time, a part of the counters in each group.
    """
    width = 1 << (COUNTERS - 4)

    def packed(part: int, at: np.ndarray, n: np.ndarray) -> dict:
        return {"part": part, "at": at.astype(np.int64).tobytes(), "n": n.astype(np.int64).tobytes()}

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTERS, np.int32)
        for batch in frames:
            at, n = np.unique(bucket_of(batch.column(0).flatten().to_numpy()), return_counts=True)
            total[at] += n
        held = np.flatnonzero(total)
        cut = np.searchsorted(held, np.arange(17) * width)
        for part in range(16):
            at = held[cut[part]:cut[part + 1]]
            if len(at):
                yield pa.RecordBatch.from_pylist([packed(part, at, total[at])], pa.schema([("part", pa.int32()), ("at", pa.binary()), ("n", pa.binary())]))

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        at = np.concatenate([np.frombuffer(b, np.int64) for b in rows["at"]])
        n = np.concatenate([np.frombuffer(b, np.int64) for b in rows["n"]])
        held, which = np.unique(at, return_inverse=True)
        return pd.DataFrame([packed(int(rows["part"].iloc[0]), held, np.bincount(which, n).astype(np.int64))]).assign(turn=int(rows["turn"].iloc[0]) // FAN_IN)

    blocks = written(full.select("values").mapInArrow(count, "part int, at binary, n binary").withColumn("turn", F.spark_partition_id()), "counts")
    while (blocks.agg(F.max("turn")).first()[0] or 0) > 0:
        blocks = written(blocks.groupBy("part", F.floor(F.col("turn") / FAN_IN)).applyInPandas(added, "part int, at binary, n binary, turn int"), "counts")
    level = np.zeros(1 << COUNTERS, np.uint8)
    for row in blocks.select("at", "n").collect():  # 16 parts, each of other counters
        n = np.frombuffer(row["n"], np.int64)
        level[np.frombuffer(row["at"], np.int64)] = np.where(n < 2, n, np.minimum(2 + 8 * np.log2(np.maximum(n, 2) / 2), 255))
    return level


def linked_in_block(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links (a, b) that join components, among the full sets of one block.

    Members outside the largest component are counted against all members: shared values by a
    product of 0/1 matrices, a run of columns at a time.
    """
    component, n = rows["component"].to_numpy(), rows["n"].to_numpy()
    names, code = np.unique(component, return_inverse=True)
    stray = np.flatnonzero(code != np.bincount(code).argmax())
    links = []
    if len(stray):
        of_row = np.repeat(np.arange(len(rows)), rows["values"].map(len))
        _, column, often = np.unique(np.concatenate(rows["values"].to_numpy()), return_inverse=True, return_counts=True)
        again = often > 1  # a value of one member is shared by none
        renamed = np.cumsum(again) - 1
        of_row, column = of_row[again[column]], renamed[column[again[column]]]
        order = np.argsort(column, kind="stable")
        of_row, column = of_row[order], column[order]
        shared = np.zeros((len(stray), len(rows)), np.float32)
        for start in range(0, int(again.sum()), WIDE):
            lo, hi = np.searchsorted(column, [start, start + WIDE])
            held = np.zeros((len(rows), WIDE), np.float32)
            held[of_row[lo:hi], column[lo:hi] - start] = 1
            shared += held[stray] @ held.T
        near = 100 * shared >= percent * (n[stray][:, None] + n[None, :] - shared)
        near &= code[stray][:, None] != code[None, :]
        parent = np.arange(len(names))

        def top(c: int) -> int:
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        ids = rows["doc_id"].to_numpy()
        for i, j in zip(*np.nonzero(near)):
            a, b = top(code[stray[i]]), top(code[j])
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((min(ids[stray[i]], ids[j]), max(ids[stray[i]], ids[j])))
    return pd.DataFrame(links, columns=["a", "b"])


def _crowd_links(docs: DataFrame, classes: DataFrame, crowd: DataFrame, labels: DataFrame | None, key: str, text: str, width: int, percent: int) -> DataFrame:
    """Links between components of the classes of ``crowd``: prefix filtering, then full sets in blocks.

    A similar pair shares one of the n - ceil(p n) + 1 first values of each, in any one order of all values; that
    of ``value_counts`` has the rare ones first. The classes that share such a value are dealt to blocks of bounded size, and every two blocks of a value meet
    in one task, which emits links alone.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            found = [shingles(memo.of(v.as_py() or ""), width).astype(np.int64) for v in batch.column(1)]
            ends = np.cumsum([0] + [len(x) for x in found]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found) if found else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "values"])

    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text)).join(counted_small(crowd, crowd.count()), "doc_id", "left_semi")
    full = written(texts.mapInArrow(sets, f"doc_id {kind}, values array<long>"), "crowd-sets")
    shared = shipped(docs.sparkSession, value_counts(full))

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = received(shared)
        for batch in batches:
            sizes, keys = [], []
            for value in batch.column(1):
                v = value.values.to_numpy()
                often = counts[bucket_of(v)]
                first = np.lexsort((v, often))[:len(v) - -(-len(v) * percent // 100) + 1]
                sizes.append(len(v))
                keys.append(v[first[often[first] > 1]])  # a value of one class takes its place and meets nobody
            ends = np.cumsum([0] + [len(x) for x in keys]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), lists], ["doc_id", "n", "keys"])

    prefix = full.mapInArrow(rarest, f"doc_id {kind}, n long, keys array<long>").select("doc_id", F.explode("keys").alias("key"), "n")
    entries = written(_with_components(prefix, labels), "prefixes")
    few, crowded = _by_size(entries)
    # where few share a value, its pairs are cheaper than the sets of all who share it
    pairs = written(likely(_cross_pairs(entries.join(few, "key", "left_semi"), percent, 1), classes, percent), "likely")
    links = verified(pairs, docs, key, text, width, percent)
    entries = entries.join(crowded, "key", "left_semi")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_VALUES)).cast("int")
    dealt = entries.join(entries.groupBy("key").agg(blocks.alias("blocks")), "key").withColumn("mine", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("doc_id", "key", "n", "component", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))
    dealt = dealt.join(full, "doc_id")
    blocks = dealt.groupBy("key", "lo", "hi").applyInPandas(lambda rows: linked_in_block(rows, percent), f"a {kind}, b {kind}")
    return links.union(blocks).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Documents are linked where 100 * shared shingles >= ``percent`` * shingles of both; ``percent`` is 80 or more.
    """
    if not 80 <= percent <= 100:
        raise ValueError(f"percent must lie between 80 and 100, not {percent}")
    found = written(features(docs, key, text, width), "sketches")
    usable = found.filter("n > 0 AND doc_id IS NOT NULL")
    per_set = usable.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("class"), F.count("*").alias("rows"), F.first("sketch").alias("sketch"))
    per_set = written(per_set, "classes")
    equal = per_set.drop("sketch")
    classes = per_set.select(F.col("class").alias("doc_id"), "n", "sketch")

    near = F.transform(F.sequence(F.lit(0), F.size("sketch") - 2), lambda i: F.xxhash64(F.get("sketch", i), F.get("sketch", i + 1)))
    keys = classes.filter("n > 1").select("doc_id", "n", F.explode(near).alias("key"))
    lists = keys.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    entries = written(keys.join(lists.hint("merge"), "key"), "lists")
    leaders = written(_leaders(entries), "leaders")

    edges, labels, done = None, None, 0
    for upto in TURNS:
        now = _with_components(entries, labels)
        if labels is not None:
            entries = written(now.join(_open(now), "key", "left_semi").drop("component"), "lists")
            now = _with_components(entries, labels)
        chosen = leaders.filter((F.col("rank") > done) & (F.col("rank") <= upto))
        pairs = written(likely(_leader_pairs(now, chosen, labels, percent), classes, percent), "likely")
        links = written(verified(pairs, docs, key, text, width, percent), "links")
        if links.head(1):
            edges = links if edges is None else edges.union(links)
            labels = components(edges)
        done = upto

    now = written(_with_components(entries, labels), "open")
    few, crowded = _by_size(now)
    # like sets share two of these lists, unless both are in too many crowded ones; the crowd's own way compares those
    pairs = _cross_pairs(now.join(few, "key", "left_semi"), percent, 2)
    pairs = written(likely(pairs, classes, percent), "likely")
    links = verified(pairs, docs, key, text, width, percent)
    held = now.join(crowded, "key", "left_semi").groupBy("doc_id", "n").agg(F.count("*").alias("held"))
    crowd = written(held.filter(F.col("held") > _must_share("n", percent) - 2).select("doc_id").distinct(), "crowd")
    if crowd.head(1):
        links = links.union(_crowd_links(docs, classes, crowd, labels, key, text, width, percent))
    links = written(links, "links")
    if links.head(1):
        edges = links if edges is None else edges.union(links)
        labels = components(edges)

    equal = _with_components(equal.withColumnRenamed("class", "doc_id"), labels).withColumnRenamed("doc_id", "class")
    rows = usable.select("doc_id", "n", "d1", "d2")
    linked = joined_by_share(rows, written(equal, "class-components"), ["n", "d1", "d2"], "rows", max(1, rows.count()))
    # rows that repeat an id under different texts are one node
    alone = found.filter("n = 0 OR doc_id IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id")).unionByName(alone).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
