"""Cost-balanced packing of tokenized documents into sequences.

A piece costs its length plus a share of its length squared, as attention does.
Documents longer than a sequence give whole sequences; the rest, in descending
order of length, go each to the sequence of least cost that still has room, and
one that fits nowhere whole is cut to fill what room there is. Every sequence
is full but for the last tokens of a partition, which fill sequences of powers
of two, so there is no padding.

Every task packs the documents of its own partition, a few thousand sequences
at a time, so nothing is shuffled, memory is bounded and a lost task is run
again alone. The rows must come the same way whenever they are read (a scan or
a checkpoint).
"""

from __future__ import annotations

import heapq
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import giving_back

CAPACITY = 2048
END = 1
#: Cost of a squared token against that of a token.
QUADRATIC = 1 / CAPACITY
#: Tokens that a task gathers before it packs.
BATCH = 1 << 22
#: Words whose ids a worker remembers, words that are held of a text, words that are encoded at once.
REMEMBERED, CHUNK, JOINED = 350_000, 1 << 18, 256
#: Bytes of short texts whose words are learnt together.
TOGETHER = 1 << 18


#: Lower-case Latin letters, then ASCII punctuation: the tokenizer cuts such a word between the two.
PLAIN = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-/:-@\[-`{-~]*)")


class WordIds:
    """Token ids of texts, equal to those of the tokenizer itself.

    The tokenizer drops white space and never merges across it, so a text's ids
    are those of its words. Words are encoded many at a time with a special
    token between them, and remembered; when the memory is half full, only words
    that occur again stay. Lower-casing A-Z beforehand changes
    nothing, as the tokenizer does so itself, unless that makes a special token
    or a character that composes otherwise; such texts are left as they are.

    Most words are lower-case letters with some punctuation. Their letters need
    only the merges of the tokenizer, where each word ends in a token that marks
    its end, and so are learnt without the steps before these.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder()
        self.between, token = min(special.items())
        self.separator = token.content
        self.marks = {t.content[:1].encode() for t in special.values()}
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.ids: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def of_all(self, texts: Iterable[bytes]) -> Iterator[list[bytes]]:
        """The pieces of ``of`` for every text in turn; words of short texts are learnt together."""
        group, size = [], 0
        for text in texts:
            if len(text) > TOGETHER:
                yield from self.of_group(group)
                group, size = [], 0
                yield list(self.of(text))
                continue
            group.append(self.lowered(text).split())
            size += len(text)
            if size >= TOGETHER:
                yield from self.of_group(group)
                group, size = [], 0
        yield from self.of_group(group)

    def of_group(self, group: list[list[bytes]]) -> Iterator[list[bytes]]:
        self.prepare(set().union(*group))
        for words in group:
            yield [b"".join(map(self.ids.__getitem__, words))]

    def of(self, text: bytes) -> Iterator[bytes]:
        """The ids as little-endian unsigned 32-bit numbers, piece by piece."""
        rest = self.lowered(text)
        while rest:
            words = rest.split(None, CHUNK)
            rest = words.pop() if len(words) > CHUNK else b""
            self.prepare(set(words))
            yield b"".join(map(self.ids.__getitem__, words))

    def prepare(self, words: set[bytes]) -> None:
        if len(self.ids) > REMEMBERED // 2:
            self.ids, self.before = {}, self.ids
        self.learn(self.recalled(words.difference(self.ids)))

    def recalled(self, words: set[bytes]) -> set[bytes]:
        """Take up again what was remembered before, and return the words that were not."""
        new = words.difference(self.before)
        if len(new) < len(words):
            again = words - new
            self.ids.update(zip(again, map(self.before.__getitem__, again)))
        return new

    def lowered(self, text: bytes) -> bytes:
        low = text.lower()
        if text.isascii():
            return text if b"<|" in text else low
        same = unicodedata.is_normalized("NFC", text.decode()) and unicodedata.is_normalized(
            "NFC", low.decode()
        )
        return low if same and b"<|" not in text else text

    def learn(self, words: set[bytes]) -> None:
        letters, cut, rest = [], {}, []
        for word in words:
            if word.isalpha() and word.islower():
                letters.append(word)
            elif made := PLAIN.fullmatch(word):
                cut[word] = made.groups()
            else:
                rest.append(word)
        starts = {a for a, _ in cut.values()}.difference(letters).difference(self.ids)
        ends = {b for _, b in cut.values() if b}.difference(rest).difference(self.ids)
        self.learn_letters([*letters, *self.recalled(starts)])
        self.learn_any([*rest, *self.recalled(ends)])
        for word, (a, b) in cut.items():
            if b:
                self.ids[word] = self.ids[a] + self.ids[b]

    def learn_letters(self, words: list[bytes]) -> None:
        joined = [b" ".join(words[i : i + JOINED]).decode() for i in range(0, len(words), JOINED)]
        at = 0
        for made in self.merges.encode_batch_fast(joined, add_special_tokens=False):
            ids = np.array(made.ids, "<u4")
            whole, start = ids.tobytes(), 0
            for end in (np.flatnonzero(self.ends[ids]) + 1).tolist():
                self.ids[words[at]] = whole[4 * start : 4 * end]
                at, start = at + 1, end

    def learn_any(self, words: list[bytes]) -> None:
        plain = [w for w in words if not any(m in w for m in self.marks)]
        texts = [w.decode() for w in plain]
        joined = [
            self.separator.join(texts[i : i + JOINED]) for i in range(0, len(texts), JOINED)
        ]
        at = 0
        for made in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            ids = np.array([*made.ids, self.between], "<u4")
            whole, start = ids.tobytes(), 0
            for end in np.flatnonzero(ids == self.between).tolist():
                self.ids[plain[at]] = whole[4 * start : 4 * end]
                at, start = at + 1, end + 1
        for word in words:
            if word not in self.ids:
                made = self.tokenizer.encode(word.decode(), add_special_tokens=False)
                self.ids[word] = np.array(made.ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def cost(length: int) -> float:
    return length + QUADRATIC * length * length


def assign(
    lengths: Sequence[int], capacities: Sequence[int]
) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]]]:
    """Assign descending lengths to the sequence of least cost with room.

    Returns pieces ``(item, start, length, sequence)`` in order of assignment
    and, where the capacities do not take all, the rests ``(item, start)``.
    Sequences without room for the length at hand wait in order of their room
    until lengths have come down to it.
    """
    room = list(capacities)
    ready = [(0.0, s) for s in range(len(room))]
    waiting: list[tuple[int, float, int]] = []
    pieces, rests = [], []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        start = 0
        while start < lengths[item]:
            need = lengths[item] - start
            if not start:  # the rest of a cut item goes where most room is
                while waiting and -waiting[0][0] >= need:
                    _, spent, s = heapq.heappop(waiting)
                    heapq.heappush(ready, (spent, s))
                while ready and room[ready[0][1]] < need:
                    spent, s = heapq.heappop(ready)
                    heapq.heappush(waiting, (-room[s], spent, s))
            if ready:
                spent, s = heapq.heappop(ready)
            elif waiting:
                _, spent, s = heapq.heappop(waiting)
            else:
                rests.append((item, start))
                break
            take = min(need, room[s])
            pieces.append((item, start, take, s))
            start += take
            room[s] -= take
            if room[s]:
                heapq.heappush(ready, (spent + cost(take), s))
    return pieces, rests


def powers(total: int) -> list[int]:
    """Powers of two that make up ``total``, the largest first."""
    return [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]


class Packer:
    """Packs the documents of one task; ``add`` and ``finish`` give pieces as they are settled.

    A piece is ``(document, ids, start, doc_tokens, sequence, offset)``.
    """

    def __init__(self, capacity: int, first: int, batch: int):
        self.capacity, self.sequence, self.batch = capacity, first, batch
        self.held: list[tuple[object, np.ndarray, int, int]] = []
        self.tokens = 0

    def add(self, document: object, ids: np.ndarray) -> Iterator[tuple]:
        whole = len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            yield document, ids[start : start + self.capacity], start, len(ids), self.sequence, 0
            self.sequence += 1
        if whole < len(ids):
            self.held.append((document, ids[whole:].copy(), whole, len(ids)))
            self.tokens += len(ids) - whole
        if self.tokens >= self.batch:
            yield from self.settle([self.capacity] * (self.tokens // self.capacity))

    def finish(self) -> Iterator[tuple]:
        full, rest = divmod(self.tokens, self.capacity)
        yield from self.settle([self.capacity] * full + powers(rest))

    def settle(self, capacities: list[int]) -> Iterator[tuple]:
        pieces, rests = assign([len(h[1]) for h in self.held], capacities)
        offsets = [0] * len(capacities)
        for item, start, length, s in pieces:
            document, ids, before, total = self.held[item]
            yield document, ids[start : start + length], before + start, total, self.sequence + s, offsets[s]
            offsets[s] += length
        self.sequence += len(capacities)
        self.held = [
            (self.held[i][0], self.held[i][1][start:], self.held[i][2] + start, self.held[i][3])
            for i, start in rests
        ]
        self.tokens = sum(len(h[1]) for h in self.held)


PIECE = (
    "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


def pack(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END, batch: int = BATCH
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``vocabulary`` is the tokenizer's file, ``ids`` are little-endian unsigned
    32-bit numbers, every document ends in ``end``. A null text is empty and has
    only that. Repeated rows are documents of their own. ``sequence_id`` is
    unique, not dense. An empty table gives no rows. Only ``doc_id`` and
    ``text`` are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(vocabulary)
        packer = Packer(capacity, TaskContext.get().partitionId() << 33, batch)
        last = np.array([end], "<u4")

        def pieces() -> Iterator[tuple]:
            for some in batches:
                texts = (text.as_py() or b"" for text in some.column("text"))
                for doc_id, made in zip(some.column("doc_id"), encode.of_all(texts)):
                    ids = [np.frombuffer(b, "<u4") for b in made]
                    yield from packer.add(doc_id.as_py(), np.concatenate([*ids, last]))
            yield from packer.finish()

        made: list[tuple] = []
        for piece in pieces():
            made.append(piece)
            if len(made) >= 500:
                yield _batch(made)
                made = []
        if made:
            yield _batch(made)

    read = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return read.mapInArrow(giving_back(run), f"doc_id long, {PIECE}")


def _batch(pieces: list[tuple]) -> pa.RecordBatch:
    document, ids, start, total, sequence, offset = zip(*pieces)
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(document, pa.int64()),
            "start": pa.array(start, pa.int64()),
            "length": pa.array([len(i) for i in ids], pa.int64()),
            "ids": pa.array([i.tobytes() for i in ids], pa.binary()),
            "doc_tokens": pa.array(total, pa.int64()),
            "sequence_id": pa.array(sequence, pa.int64()),
            "offset": pa.array(offset, pa.int64()),
        }
    )
