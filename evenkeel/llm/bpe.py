"""Byte-level BPE: frequent words from a shared-suffix transducer, unseen words by exact merging.

One pass over all documents counts words by lossy counting (Manku and Motwani 2002: bounded
memory, every word read), distinct words of a batch at a time. The most frequent ones are encoded once and compiled into a minimal
acyclic transducer: bytes lead along arcs, arcs carry ids, outputs are pushed toward the root so
that equal suffixes are one. The automaton travels as one broadcast of bounded size; each task maps
it into memory from an unlinked file of its own. Words outside it are merged by rank, exactly as
the vocabulary prescribes, so the lexicon changes speed alone.

Defined cases: null text counts as empty and has no ids; the string of an added token is that
token's id, as in the tokenizers library; very long words merge in n log n; repeated rows are
encoded each; an empty table gives an empty result; other columns pass through, but for columns
named as an output, which are replaced.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import struct
import tempfile
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.llm.common import received, shipped, written

LEXICON_WORDS = 30_000
#: Words a counting task holds before it forgets the rarest.
COUNT_LIMIT = 200_000
#: Encoded words a task keeps at hand before it starts anew.
MEMO_LIMIT = 150_000
#: Texts that are parted, encoded and put together at a time.
ROWS = 1024

# Unicode white space, and the pattern by which the vocabulary splits text.
SPACES = "\t-\r \x85\xa0  -     　"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+".replace(r"\S", f"[^{SPACES}]").replace(
    r"[^\s", f"[^{SPACES}").replace(r"\s", f"[{SPACES}]")
BLANK = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{SPACES}]", c))
#: Stands for the merge of a pair that is never merged: above every rank.
NEVER = (1 << 60, -1)
#: No piece of the pattern reaches over a space that a visible character follows.
CHUNK = re.compile(f" (?=[^{SPACES}])")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, letter to byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    return letters | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}


class Vocabulary:
    """Merges, token bytes and added tokens of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        vocab, letters = said["model"]["vocab"], byte_letters()
        self.added = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.tokens = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if t not in self.added}
        self.tokens |= {i: t.encode() for t, i in self.added.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in said["model"]["merges"]]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.byte_ids = [0] * 256
        for letter, b in letters.items():
            self.byte_ids[b] = vocab[letter]
        # the same merges as sorted columns: pair, rank, joined id
        pairs = sorted((a << 32 | b, rank, joined) for (a, b), (rank, joined) in self.merges.items())
        self.pairs, self.ranks, self.joined = (np.array([x[i] for x in pairs], np.int64) for i in range(3))
        # pairs of bytes by place, and the bytes of every token in a row
        single = np.array(self.byte_ids, np.int64)
        self.byte_ranks, self.byte_joined = (x.reshape(256, 256) for x in self.look_up(np.repeat(single, 256), np.tile(single, 256)))
        said = [self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)]
        self.token_sizes = np.fromiter(map(len, said), np.int64, len(said))
        self.token_bytes = np.frombuffer(b"".join(said), np.uint8)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and joined id of each pair; the rank of a pair that is never merged is above all."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        hit = self.pairs[at] == wanted
        return np.where(hit, self.ranks[at], NEVER[0]), np.where(hit, self.joined[at], -1)

    def spelled(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts that runs of ``ids`` stand for, where each run spells whole characters; run i ends at ``ends[i + 1]``."""
        sizes = self.token_sizes[ids]
        source = np.repeat((np.cumsum(self.token_sizes) - self.token_sizes)[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        offsets = np.concatenate([[0], np.cumsum(sizes)])[ends].astype(np.int32)
        return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(offsets), pa.py_buffer(self.token_bytes[source]))


def merged(word: bytes, byte_ids: list[int], merges: dict) -> list[int]:
    """Ids of ``word``: the pair of lowest rank, leftmost first, is joined until none is left."""
    ids = [byte_ids[b] for b in word]
    if len(ids) > 48:
        return _merged_long(ids, merges)
    pairs = [merges.get(p, NEVER) for p in zip(ids, ids[1:])]
    while pairs:
        best = min(pairs)
        if best is NEVER:
            break
        at = pairs.index(best)
        ids[at:at + 2] = [best[1]]
        del pairs[at]
        if at:
            pairs[at - 1] = merges.get((ids[at - 1], best[1]), NEVER)
        if at < len(pairs):
            pairs[at] = merges.get((best[1], ids[at + 1]), NEVER)
    return ids


def _merged_long(ids: list[int], merges: dict) -> list[int]:
    """The same with a heap and links, for long words."""
    n = len(ids)
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
    heapq.heapify(heap)
    while heap:
        _, i, a, b, joined = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j < 0 or ids[j] != b:
            continue
        ids[i], ids[j], after[i] = joined, -1, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right >= 0 and (m := merges.get((ids[left], ids[right]))):
                heapq.heappush(heap, (m[0], left, ids[left], ids[right], m[1]))
    out, i = [], 0
    while i >= 0:
        out.append(ids[i])
        i = after[i]
    return out


def merged_many(words: list[bytes], v: Vocabulary) -> list[bytes]:
    """Ids of many words as 32-bit integers, merged side by side: each round joins one pair in every unfinished word.

    The pair is the one ``merged`` would join; words above 48 bytes go through ``merged``.
    """
    out: list = [b"" if len(w) <= 48 else array("i", merged(w, v.byte_ids, v.merges)).tobytes() for w in words]
    which = np.array([i for i, w in enumerate(words) if 0 < len(w) <= 48], np.int64)
    if not len(which):
        return out
    sizes = np.array([len(words[i]) for i in which], np.int64)
    text = np.frombuffer(b"".join(words[i] for i in which), np.uint8)
    ids, behind = np.array(v.byte_ids, np.int64)[text], np.append(text[1:], 0)
    rank, joined = v.byte_ranks[text, behind], v.byte_joined[text, behind]
    rank[np.cumsum(sizes) - 1] = NEVER[0]  # no pair reaches into the next word
    while len(which):
        starts = np.cumsum(sizes) - sizes
        best = np.minimum.reduceat(rank, starts)
        done = best == NEVER[0]
        if done.any():
            for i, a, n in zip(which[done].tolist(), starts[done].tolist(), sizes[done].tolist()):
                out[i] = ids[a:a + n].astype(np.int32).tobytes()
            open_ = np.repeat(~done, sizes)
            ids, rank, joined = ids[open_], rank[open_], joined[open_]
            which, sizes, best = which[~done], sizes[~done], best[~done]
            if not len(which):
                break
        word = np.repeat(np.arange(len(which)), sizes)
        at = np.flatnonzero(rank == best[word])
        at = at[np.r_[True, word[at[1:]] != word[at[:-1]]]]  # the leftmost of each word
        ids[at], rank[at] = joined[at], rank[at + 1]
        kept = np.ones(len(ids), bool)
        kept[at + 1] = False
        at -= np.arange(len(at))  # one place fewer for each word before
        ids, rank, joined = ids[kept], rank[kept], joined[kept]
        sizes -= 1
        ends = np.cumsum(sizes)
        right = at[at + 1 < ends]
        rank[right], joined[right] = v.look_up(ids[right], ids[right + 1])
        rank[ends - 1] = NEVER[0]
        left = at[at > ends - sizes] - 1
        rank[left], joined[left] = v.look_up(ids[left], ids[left + 1])
    return out


# --------------------------------------------------------------------- the transducer


def compile_lexicon(entries: Iterable[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """Minimal acyclic transducer of sorted, distinct (word, ids), as one block of bytes.

    Nodes behind the common prefix with the next word are complete; equal complete nodes become one.
    """
    nodes: list[tuple] = []
    known: dict[tuple, int] = {}

    def complete(node: list) -> int:
        shape = (node[0], tuple(map(tuple, node[1])))
        if shape not in known:
            known[shape] = len(nodes)
            nodes.append(shape)
        return known[shape]

    path: list[list] = [[None, []]]  # final output or None; arcs of label, ids, target
    last = b""
    for word, ids in entries:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        for depth in range(len(path) - 1, common, -1):
            path[depth - 1][1][-1][2] = complete(path.pop())
        for depth in range(1, common + 1):
            arc, node = path[depth - 1][1][-1], path[depth]
            same = 0
            while same < min(len(arc[1]), len(ids)) and arc[1][same] == ids[same]:
                same += 1
            rest, arc[1], ids = arc[1][same:], arc[1][:same], ids[same:]
            if rest:
                node[0] = None if node[0] is None else rest + node[0]
                for below in node[1]:
                    below[1] = rest + below[1]
        for at in range(common, len(word)):
            path[-1][1].append([word[at], ids if at == common else (), None])
            path.append([None, []])
        path[-1][0] = () if len(word) > common else ids
        last = word
    while len(path) > 1:
        done = complete(path.pop())
        path[-1][1][-1][2] = done
    root = complete(path[0])

    starts, labels, targets, outs, pool, finals = [0], bytearray(), [], [0], [], []
    for final, arcs in nodes:
        for label, ids, target in arcs:
            labels.append(label)
            targets.append(target)
            pool.extend(ids)
            outs.append(len(pool))
        starts.append(len(labels))
        finals.append(final)
    ends = [len(pool)]
    for final in finals:  # 1 in front marks a node where a word ends
        pool.extend(() if final is None else (1, *final))
        ends.append(len(pool))
    parts = [np.asarray(x, np.uint32).tobytes() for x in (starts, targets, outs, ends, pool)] + [bytes(labels)]
    return struct.pack("<7I", root, *map(len, parts)) + b"".join(parts)


ONE = [bytes([b]) for b in range(256)]


class Lexicon:
    """The compiled words, mapped into memory."""

    def __init__(self, block: bytes) -> None:
        with tempfile.TemporaryFile() as f:  # without a name: gone when the task ends
            f.write(block)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, *sizes = struct.unpack_from("<7I", self.map)
        at, views = 28, []
        for size in sizes[:-1]:
            views.append(memoryview(self.map)[at:at + size].cast("I"))
            at += size
        self.starts, self.targets, self.outs, self.ends, self.pool = views
        self.labels = at
        # arcs by node and label, for many words at a time; arcs of a node are sorted by label
        self.nodes = np.frombuffer(self.ends, np.uint32)
        owner = np.repeat(np.arange(len(self.starts) - 1), np.diff(np.frombuffer(self.starts, np.uint32).astype(np.int64)))
        self.arcs = owner << 8 | np.frombuffer(self.map, np.uint8, len(owner), at)
        self.to = np.frombuffer(self.targets, np.uint32).astype(np.int64)

    def holds(self, words: list[bytes]) -> np.ndarray:
        """Which of ``words`` are in the lexicon: all walk the automaton together, a byte at a time."""
        found = np.zeros(len(words), bool)
        if not len(self.arcs) or not words:
            return found
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(size) - size
        text = np.frombuffer(b"".join(words), np.uint8)
        here, node, depth = np.arange(len(words)), np.full(len(words), self.root, np.int64), 0
        while len(here):
            end = size[here] == depth
            last = node[end]
            found[here[end]] = self.nodes[last + 1] > self.nodes[last]
            here, node = here[~end], node[~end]
            wanted = node << 8 | text[start[here] + depth]
            arc = np.minimum(np.searchsorted(self.arcs, wanted), len(self.arcs) - 1)
            hit = self.arcs[arc] == wanted
            here, node, depth = here[hit], self.to[arc[hit]], depth + 1
        return found

    def get(self, word: bytes) -> list[int] | None:
        """The ids of ``word``, or None if it is not in the lexicon."""
        node, find, starts, targets, base = self.root, self.map.find, self.starts, self.targets, self.labels
        arcs = []
        for b in word:
            arc = find(ONE[b], base + starts[node], base + starts[node + 1]) - base
            if arc < 0:
                return None
            arcs.append(arc)
            node = targets[arc]
        end = self.pool[self.ends[node]:self.ends[node + 1]]
        if not len(end):
            return None
        ids: list[int] = []
        for arc in arcs:
            ids += self.pool[self.outs[arc]:self.outs[arc + 1]]
        return ids + list(end[1:])


class Memo:
    """Results at hand in two generations: when the young one is full, the old one is forgotten."""

    def __init__(self) -> None:
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key: str) -> bytes | None:
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        if len(self.young) >= MEMO_LIMIT // 2:
            self.old, self.young = self.young, {}
        if len(key) <= 64:
            self.young[key] = value


class Codec:
    """Encodes and decodes inside a task."""

    def __init__(self, vocabulary: Vocabulary, block: bytes) -> None:
        import regex

        self.v, self.lexicon = vocabulary, Lexicon(block)
        self.split = regex.compile(PATTERN).findall
        self.chunks, self.pieces = Memo(), Memo()
        self.added = re.compile("(" + "|".join(map(re.escape, vocabulary.added)) + ")") if vocabulary.added else None

    def learn(self, words: list[str], local: dict[str, bytes]) -> None:
        """Put the ids of ``words`` into ``local``: those of the lexicon, and the others by merging, all at once."""
        spelt = [w.encode("utf-8", "replace") for w in words]
        known = self.lexicon.holds(spelt)
        unseen = iter(merged_many([w for w, k in zip(spelt, known) if not k], self.v))
        for word, spelling, k in zip(words, spelt, known):
            local[word] = array("i", self.lexicon.get(spelling)).tobytes() if k else next(unseen)

    def coded(self, parted: list[list[str]]) -> list[bytes]:
        """Ids of lists of the pattern's pieces."""
        local: dict[str, bytes] = {}
        new: dict[str, None] = {}
        for pieces in parted:
            for piece in pieces:
                if piece not in local and (found := self.pieces.get(piece)) is not None:
                    local[piece] = found
                elif piece not in local:
                    new[piece] = None
        self.learn(list(new), local)
        for piece in new:
            self.pieces.put(piece, local[piece])
        return [local[p[0]] if len(p) == 1 else b"".join([local[x] for x in p]) for p in parted]

    def after_space(self, chunks: list[str]) -> list[bytes]:
        """Ids of a space and each of ``chunks``. A word, or a word and its stops, needs no pattern to split."""
        found = list(map(self.chunks.get, chunks))
        lacking = [i for i, f in enumerate(found) if f is None]
        cores: dict[str, bytes | None] = {}
        other = []
        for i in lacking:
            chunk = chunks[i]
            core = chunk.rstrip(".,")
            if core.isalpha():
                cores[core] = self.chunks.get(core)
            else:
                other.append(i)
        new = [c for c, f in cores.items() if f is None]
        local: dict[str, bytes] = {}
        self.learn([" " + c for c in new], local)
        for core in new:
            cores[core] = local[" " + core]
            self.chunks.put(core, cores[core])
        for i, ids in zip(other, self.coded([self.split(" " + chunks[i]) for i in other])):
            found[i] = ids
            self.chunks.put(chunks[i], ids)
        stops: dict[str, bytes] = {}
        for i in lacking:
            if found[i] is None:
                chunk = chunks[i]
                core = chunk.rstrip(".,")
                found[i] = cores[core]
                if len(core) < len(chunk):
                    end = chunk[len(core):]
                    if end not in stops:
                        stops[end] = self.coded([[end]])[0]
                    found[i] += stops[end]
        return found

    def plain(self, text: str) -> bytes:
        first, *rest = CHUNK.split(text)
        return b"".join([*self.coded([self.split(first)] if first else []), *self.after_space(rest)])

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as 32-bit integers."""
        if not self.added or not self.added.search(text):
            return self.plain(text)
        return b"".join(np.int32(self.v.added[part]).tobytes() if part in self.v.added else self.plain(part) for part in self.added.split(text))

    def batch(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Ids of each text, and the text decoded from them.

        Texts are parted at spaces by Arrow; each distinct chunk of the batch is encoded and decoded once, and the
        chunks of a text are put together by position. A chunk starts and ends with whole characters, so the
        decoded chunks in a row are the decoded text. Texts with an added token, or with a space
        that does not end a chunk, are encoded one by one.
        """
        texts = pc.fill_null(texts, "")
        slow = np.zeros(len(texts), bool)
        for token in self.v.added:
            slow |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts.filter(pa.array(~slow)), " ")
        sizes = pc.list_value_length(lists).to_numpy()
        coded = lists.flatten().dictionary_encode()
        chunks, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        of_text = np.repeat(np.flatnonzero(~slow).astype(np.int32), sizes)
        first = np.zeros(len(codes), bool)
        first[np.cumsum(sizes) - sizes] = True
        odd = np.array([not c or c[0] in BLANK for c in chunks], bool)
        slow[of_text[odd[codes] & ~first]] = True

        at = ~slow[of_text]
        codes, first, of_text = codes[at], first[at], of_text[at]
        used = np.zeros(len(chunks), bool)
        used[codes[~first]] = True
        blocks = [b""] * len(chunks)
        for i, found in zip(np.flatnonzero(used).tolist(), self.after_space([chunks[i] for i in np.flatnonzero(used)])):
            blocks[i] = found
        blocks += self.coded([self.split(chunks[c]) for c in codes[first]])  # no space before them
        heads = len(blocks)
        blocks += [self.encode(t) for t in texts.filter(pa.array(slow)).to_pylist()]
        entry = codes.copy()
        entry[first] = np.arange(len(chunks), heads)
        if slow.any():
            entry = np.concatenate([entry, np.arange(heads, len(blocks), dtype=np.int32)])
            of_text = np.concatenate([of_text, np.flatnonzero(slow).astype(np.int32)])
            order = np.argsort(of_text, kind="stable")
            entry, of_text = entry[order], of_text[order]

        # an Arrow array of lists holds less than 2^31 ids, so these numbers are small ones
        length = np.fromiter(map(len, blocks), np.int32, len(blocks)) // 4
        ids, start = np.frombuffer(b"".join(blocks), np.int32), np.cumsum(length, dtype=np.int32) - length
        size = length[entry]
        until = np.cumsum(size, dtype=np.int32)
        source = np.repeat(start[entry] - (until - size), size)
        source += np.arange(len(source), dtype=np.int32)
        per_text = np.searchsorted(of_text, np.arange(len(texts) + 1))
        ends = np.concatenate([np.zeros(1, np.int32), until])[per_text]
        said = self.v.spelled(ids, np.concatenate([[0], np.cumsum(length)]))
        parts = pa.ListArray.from_arrays(pa.array(per_text.astype(np.int32)), said.take(pa.array(entry)))
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids[source])), pc.binary_join(parts, "")


def frequent_words(docs: DataFrame, text: str, limit: int) -> list[str]:
    """At most ``limit`` of the most frequent chunks between spaces, by lossy counting over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        floor = 1
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                found = pc.value_counts(pc.split_pattern(pc.fill_null(whole.column(0).slice(start, ROWS), ""), " ").flatten())
                seen.update(dict(zip(found.field(0).to_pylist(), found.field(1).to_pylist())))
                while len(seen) > COUNT_LIMIT:
                    seen = Counter({w: n for w, n in seen.items() if n > floor})
                    floor += 1
        kept = [(w, n) for w, n in seen.items() if n > 1 and w and len(w) <= 64]
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept]), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

    counts = written(docs.select(F.col(text)).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    # the least count that ``limit`` words at most reach, from the words of each power of two
    steps = counts.groupBy(F.floor(F.log2("n") * 8).alias("step")).agg(F.count("*").alias("words")).orderBy(F.col("step").desc()).collect()
    total, least = 0, None
    for r in steps:
        total += r["words"]
        if total > limit:
            break
        least = r["step"]
    if least is None:
        return []
    return [r.word for r in counts.filter(F.floor(F.log2("n") * 8) >= least).select("word").collect()]


def lexicon_of(words: list[str], vocabulary: Vocabulary) -> bytes:
    """Transducer of the pieces that ``words`` hold when they follow a space."""
    import regex

    pieces = {p.encode("utf-8", "replace") for w in words for p in regex.findall(PATTERN, " " + w)}
    return compile_lexicon((p, tuple(merged(p, vocabulary.byte_ids, vocabulary.merges))) for p in sorted(pieces))


def encode_documents(
    docs: DataFrame, vocabulary_path: str, text: str = "text", lexicon_words: int = LEXICON_WORDS, ids: str = "ids", decoded: str = "decoded",
) -> DataFrame:
    """``docs`` with the ids of each text and the text decoded from those ids."""
    vocabulary = Vocabulary(vocabulary_path)
    shared = shipped(docs.sparkSession, (vocabulary, lexicon_of(frequent_words(docs, text, lexicon_words), vocabulary)))
    kept = [c for c in docs.columns if c not in (ids, decoded)]
    schema = T.StructType([docs.schema[c] for c in kept]).add(ids, T.ArrayType(T.IntegerType())).add(decoded, T.StringType())

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*received(shared))
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                yield pa.RecordBatch.from_arrays([*batch.columns, *codec.batch(batch.column(text_at))], [*kept, ids, decoded])
        pa.default_memory_pool().release_unused()  # workers are kept, and other tasks need the memory

    text_at = kept.index(text)
    return docs.select(*kept).mapInArrow(code, schema)
