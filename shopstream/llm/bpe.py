"""Byte-pair encoding and decoding by a contiguous rank array.

A word is held as its parts and, side by side, the rank of joining each part
with the next. The smallest rank is searched, its boundary deleted and the two
ranks beside it refreshed, until nothing joins. Many words go through this at
once, a row of a matrix each: every join shortens the matrix by one column.
Words beyond ``SHORT`` bytes, where the repeated search would be quadratic,
take the same joins in the same order from a heap.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from itertools import chain, islice
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

# Fixed value, the branch for words put first: how byte-level vocabularies of this kind cut text into words
WORDS = r" ?\p{L}+| ?\p{N}+|'(?:[stmd]|re|ve|ll)| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHORT = 64
NEVER = 1 << 30
ROWS = 4096  # words in a matrix
CHARS = 1 << 21  # of texts whose words are looked up together
LONG = 1 << 20  # texts beyond are cut into words bit by bit


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """A vocabulary file's merges. ``keep`` bounds the words whose ids are remembered."""

    def __init__(self, data: bytes, keep: int = 400_000):
        spec = json.loads(data)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.first = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.first[byte] = vocab[letter]
        pairs = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], order.astype(np.int32)
        self.rank = dict(zip(pairs.tolist(), range(len(merges)), strict=True))
        self.joined = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(map(letters.__getitem__, token))
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        listed = map(regex.escape, sorted(self.special, key=len, reverse=True))
        self.cut = regex.compile("(" + ("|".join(listed) or r"(?!)") + ")")
        self.words = regex.compile(WORDS)
        self.keep, self.known = keep, {}

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right  # an empty place is -1, and so is in no pair
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NEVER)

    def _short(self, words: list[bytes]) -> list[bytes]:
        """Ids of up to ROWS words, each as little-endian 32-bit numbers."""
        lengths = np.array([len(w) for w in words])
        places = np.arange(lengths.max())
        parts = np.full((len(words), len(places)), -1, np.int64)
        parts[places < lengths[:, None]] = self.first[np.frombuffer(b"".join(words), np.uint8)]
        ranks = self._look_up(parts[:, :-1], parts[:, 1:])
        row, out = np.arange(len(words)), [b""] * len(words)
        while True:
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(row), np.int64)
            r = np.arange(len(row))
            low = ranks[r, at] if ranks.shape[1] else np.full(len(row), NEVER)
            ended = low == NEVER
            if ended.any():
                held = parts[ended]
                ids = held[held >= 0].astype("<u4").tobytes()
                ends = (4 * np.cumsum((held >= 0).sum(axis=1))).tolist()
                for i, a, b in zip(row[ended].tolist(), [0, *ends[:-1]], ends, strict=True):
                    out[i] = ids[a:b]
                more = ~ended
                row, parts, ranks, at, low = row[more], parts[more], ranks[more], at[more], low[more]
                if not len(row):
                    return out
                r = np.arange(len(row))
            n = parts.shape[1]
            parts[r, at] = self.joined[low]
            parts = parts[np.arange(n) != at[:, None] + 1].reshape(len(row), n - 1)
            ranks = ranks[np.arange(n - 1) != at[:, None]].reshape(len(row), n - 2)
            here = at < n - 2
            ranks[r[here], at[here]] = self._look_up(parts[r[here], at[here]], parts[r[here], at[here] + 1])
            here = at > 0
            ranks[r[here], at[here] - 1] = self._look_up(parts[r[here], at[here] - 1], parts[r[here], at[here]])

    def _rank(self, a: int, b: int) -> int:
        return self.rank.get(a << 32 | b, NEVER)

    def _long(self, word: bytes) -> bytes:
        parts = self.first[np.frombuffer(word, np.uint8)].tolist()
        n = len(parts)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(self._rank(parts[i], parts[i + 1]), i, parts[i], parts[i + 1]) for i in range(n - 1)]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if rank == NEVER:
                break
            if not alive[i] or j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], alive[j], after[i] = int(self.joined[rank]), False, after[j]
            if after[i] < n:
                before[after[i]] = i
                heapq.heappush(heap, (self._rank(parts[i], parts[after[i]]), i, parts[i], parts[after[i]]))
            if (h := before[i]) >= 0:
                heapq.heappush(heap, (self._rank(parts[h], parts[i]), h, parts[h], parts[i]))
        return np.array([p for p, a in zip(parts, alive, strict=True) if a], "<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        """Put the ids of these words beside the known ones."""
        fresh = sorted(((w.encode(), w) for w in words), key=lambda x: len(x[0]))
        short = [x for x in fresh if len(x[0]) <= SHORT]
        for at in range(0, len(short), ROWS):
            some = short[at:at + ROWS]
            self.known.update(zip([w for _, w in some], self._short([x for x, _ in some]), strict=True))
        self.known.update((w, self._long(x)) for x, w in fresh[len(short):])

    def _ids(self, groups: list[list[str]]) -> list[bytes]:
        every = set(chain.from_iterable(groups))
        fresh = every.difference(self.known)
        if len(self.known) + len(fresh) > self.keep:
            self.known.clear()
            fresh = every
        self._learn(fresh)
        known = self.known.__getitem__
        return [b"".join(map(known, words)) for words in groups]

    def _piece(self, text: str) -> Iterator[list[str]]:
        """Words of a text without special tokens, in lists of bounded length."""
        if len(text) <= LONG:
            yield self.words.findall(text)
            return
        every = self.words.finditer(text)
        while some := [m[0] for m in islice(every, LONG // 8)]:
            yield some

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, each as little-endian 32-bit numbers."""
        out: list[list[bytes]] = [[] for _ in texts]
        groups, owners, size = [], [], 0

        def flush() -> None:
            for i, ids in zip(owners, self._ids(groups), strict=True):
                out[i].append(ids)
            groups.clear()
            owners.clear()

        for i, text in enumerate(texts):
            for k, piece in enumerate(self.cut.split(text)):
                if k % 2:
                    flush()
                    out[i].append(pack("<I", self.special[piece]))
                    continue
                for words in self._piece(piece):
                    groups.append(words)
                    owners.append(i)
                    size += sum(map(len, words))
                    if size >= CHARS:
                        flush()
                        size = 0
        flush()
        return [b"".join(x) for x in out]

    def decode(self, ids: bytes) -> str:
        """Text of the ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def _encoder(held: Broadcast) -> Encoder:
    """One encoder per worker process: it stays with the process's copy of the vocabulary."""
    if not hasattr(held, "encoder"):
        held.encoder = Encoder(held.value)
    return held.encoder


def encode(docs: DataFrame, path: str, *, ids: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens, ids (array, if asked for), ids_sha256 and decoded_sha256, one row per row of ``docs``.

    ``path`` names a tokenizer file as the tokenizers library writes it; the
    driver reads it and sends its few MB to the executors. Null text counts as
    empty and has no ids. Text of a special token gives that token. The decoded
    digest is that of the ids turned back into text. Columns to ``keep`` follow; others are left out.
    """
    with open(path, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary, bounded by its file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(held)
        for b in batches:
            found = encoder.encode([t or "" for t in b["text"].to_pylist()])
            back = [encoder.decode(x) for x in found]
            columns = [b["doc_id"], pa.array([len(x) // 4 for x in found], pa.int64()),
                       pa.array([hashlib.sha256(x).hexdigest() for x in found]),
                       pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back])]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                offsets = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(found), "<i4"))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays([*columns, *(b[c] for c in keep)], [*names, *keep])

    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    kind += "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.selectExpr("cast(doc_id as long) doc_id", "text", *keep).mapInArrow(run, kind)


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from rows of (doc_id, ids); null ids give an empty text."""
    with open(path, "rb") as f:
        held = tokens.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(held)
        for b in batches:
            texts = [encoder.decode(np.array(x or [], "<u4").tobytes()) for x in b["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.selectExpr("cast(doc_id as long) doc_id", "ids").mapInArrow(run, "doc_id long, text string")
