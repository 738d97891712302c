"""Token counts of a sentencepiece BPE model: whole tokens are looked up, only the rest is merged.

Two facts are proved from the vocabulary before any text is read. First, where no piece holds two
characters next to each other, no merge ever joins them: such places part a text into pre-tokens that
merge apart from each other. Every space before a visible character is one, or the model is refused.
Second, each piece is merged from its characters; those that come out as one token are whole tokens,
so a pre-token among them counts one. In the tasks Arrow splits texts at spaces and finds the distinct
pre-tokens of a batch; whole tokens are looked up, the others are parted further and merged by score,
leftmost first, exactly as the model prescribes. Characters without a piece count their UTF-8 bytes.

Defined cases: null text counts as empty, an empty text has no tokens; strings of control and byte
pieces inside a text are ordinary text, as in the library; U+2581 in a text is a space, as there;
very long pre-tokens merge in n log n; repeated rows and null ids are counted each; an empty table gives an empty
result; other columns pass through, but for columns named as an output, which are replaced.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pre-tokens a task keeps at hand before it starts anew; longer ones are merged each time.
MEMO_LIMIT = 400_000
MEMO_LENGTH = 64
#: The character by which models write a space.
SPACE = "▁"
#: A space, more spaces, and what follows them.
CHUNK = re.compile(" +[^ ]*")
#: Stands for the merge of two parts that is none: above every rank.
NEVER = 1 << 60


def read_model(path: str) -> dict[str, int]:
    """Rank of every piece of a sentencepiece BPE model, the first to be merged least.

    Raises ValueError for models that work otherwise: other normalisers, own symbols, pieces over spaces.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    probe = " Ａ  é\tx "
    if model.normalize(probe) != (SPACE + probe).replace(" ", SPACE):
        raise ValueError("only models that keep texts as they are, with a space in front, are supported")
    if sum(map(model.is_byte, range(model.get_piece_size()))) != 256:
        raise ValueError("only models that write unknown characters as bytes are supported")
    plain = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    scores = {model.id_to_piece(i): model.get_score(i) for i in plain}
    if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in scores):
        raise ValueError("the vocabulary holds pieces that reach over a space")
    rank = {score: at for at, score in enumerate(sorted(set(scores.values()), reverse=True))}
    return {piece: rank[score] for piece, score in scores.items()}


def neighbours(pieces: dict[str, int]) -> set[str]:
    """Two characters that stand next to each other in some piece; all others never merge."""
    return {piece[i:i + 2] for piece in pieces for i in range(len(piece) - 1)}


def merged(word: str, pieces: dict[str, int]) -> list[str]:
    """The parts of ``word``: the neighbours whose joint piece has the least rank are joined, leftmost first, until none is left."""
    if len(word) > 48:
        return _merged_long(word, pieces)
    parts = list(word)
    ranks = [pieces.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
    while ranks:
        best = min(ranks)
        if best == NEVER:
            break
        at = ranks.index(best)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del ranks[at]
        if at:
            ranks[at - 1] = pieces.get(parts[at - 1] + parts[at], NEVER)
        if at < len(ranks):
            ranks[at] = pieces.get(parts[at] + parts[at + 1], NEVER)
    return parts


def _merged_long(word: str, pieces: dict[str, int]) -> list[str]:
    """The same with a heap and links, for long words."""
    parts, n = list(word), len(word)
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    heap = [(rank, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (rank := pieces.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, joined = heapq.heappop(heap)
        j = after[i]
        if not parts[i] or j < 0 or parts[i] + parts[j] != joined:
            continue  # one of the two has been joined since
        parts[i], parts[j], after[i] = joined, "", after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right >= 0 and (rank := pieces.get(parts[left] + parts[right])) is not None:
                heapq.heappush(heap, (rank, left, parts[left] + parts[right]))
    return [p for p in parts if p]


def whole_tokens(pieces: dict[str, int]) -> frozenset[str]:
    """The pieces that merging their own characters gives back as one token."""
    return frozenset(piece for piece in pieces if len(merged(piece, pieces)) == 1)


class Counter:
    """Counts the tokens of pre-tokens inside a task."""

    def __init__(self, pieces: dict[str, int], whole: frozenset[str], near: set[str]) -> None:
        self.pieces, self.whole, self.near = pieces, whole, near
        self.memo: dict[str, int] = {}

    def chunk(self, chunk: str) -> int:
        """Tokens of a space and ``chunk``."""
        word = SPACE + chunk.replace(" ", SPACE)
        if word in self.whole:
            return 1
        found = self.memo.get(word)
        if found is None:
            found, start, near = 0, 0, self.near
            for i in range(1, len(word)):
                if word[i - 1:i + 1] not in near:
                    found += self.part(word[start:i])
                    start = i
            found += self.part(word[start:])
            if len(word) <= MEMO_LENGTH:
                if len(self.memo) >= MEMO_LIMIT:
                    self.memo.clear()
                self.memo[word] = found
        return found

    def part(self, part: str) -> int:
        """Tokens of a stretch that no proven place parts."""
        if part in self.whole:
            return 1
        return sum(1 if p in self.pieces else len(p.encode("utf-8", "replace")) for p in merged(part, self.pieces))

    def lists(self, lists: pa.Array) -> np.ndarray:
        """Tokens of each list of chunks; equal chunks of the batch are counted once."""
        coded = lists.flatten().dictionary_encode()
        each = np.fromiter(map(self.chunk, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        sums = np.concatenate([[0], np.cumsum(each[coded.indices.to_numpy()])])
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        return sums[ends[1:]] - sums[ends[:-1]]

    def texts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), SPACE, " ")
        # a lone space is where two chunks part; more of them belong to the chunk behind them
        odd = pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " "))
        counts = np.zeros(len(texts), np.int64)
        for which, chunked in (
            (pc.invert(odd), lambda t: pc.split_pattern(t, " ")),
            (odd, lambda t: pa.array([[c[1:] for c in CHUNK.findall(" " + x)] for x in t.to_pylist()], pa.list_(pa.string()))),
        ):
            counts[which.to_numpy(zero_copy_only=False)] = self.lists(chunked(texts.filter(which)))
        counts[pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)] = 0
        return counts


def count_tokens(docs: DataFrame, model_path: str, text: str = "text", n_bytes: str = "n_bytes", n_tokens: str = "n_tokens") -> DataFrame:
    """``docs`` with the UTF-8 bytes and the tokens of each text."""
    pieces = read_model(model_path)
    shared = docs.sparkSession.sparkContext.broadcast((pieces, whole_tokens(pieces), neighbours(pieces)))
    kept = [c for c in docs.columns if c not in (n_bytes, n_tokens)]
    schema = T.StructType([docs.schema[c] for c in kept]).add(n_bytes, T.LongType()).add(n_tokens, T.LongType())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counter.texts(batch.column(text_at)))], [*kept, n_bytes, n_tokens])

    text_at = kept.index(text)
    size = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long")
    return docs.select(*kept).withColumn(n_bytes, size).mapInArrow(count, schema)
