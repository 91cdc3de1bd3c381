"""Byte-level BPE by a pair occurrence index.

The distinct pieces of a chunk of a partition are laid out as one linked list
of symbols.  An index maps each pair that has a merge to all its positions.
The active ranks are applied in ascending order: a rank merges all its
positions at once and only the lists of the pairs beside them are updated.
Pieces already known to the worker are not encoded again.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wattframe.llm.common import rows_of, with_text

# The word pattern of the vocabulary's published pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CHUNK = 24 << 20  # bytes of text whose new pieces are encoded together
MOST_KNOWN = 1_000_000  # pieces kept by a worker; beyond it the memory starts anew

#: A word starts at each of these cuts, whatever stands around them.
CUT = re.compile(r"[ \n]?[^ \n]+|[ \n]+(?![^ \n])|[ \n]+")
OTHER_SPACE = re.compile(r"[^\S \n]")


def byte_symbols() -> dict[str, int]:
    """The vocabulary's printable stand-in for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Merges and tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        stand_in = byte_symbols()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self.tokens[i] = bytes(stand_in[c] for c in token)
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        self.of_byte = np.zeros(256, np.int64)
        for symbol, byte in stand_in.items():
            self.of_byte[byte] = vocab[symbol]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.pair = [(vocab[a], vocab[b]) for a, b in pairs]
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair, -1 without one."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.rank[at], -1)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def _alternate(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of a run of overlapping pairs of one symbol, every other from the left."""
    kept, taken = [], -1
    for here, there in zip(at.tolist(), after[at].tolist()):
        if here != taken:
            kept.append(here)
            taken = there
    return np.array(kept, np.int64)


def merge(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after another, and how many each has."""
    lengths = np.array([len(w) for w in words], np.int64)
    symbol = vocabulary.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    size = len(symbol)
    after, before = np.arange(1, size + 1), np.arange(-1, size - 1)
    ends = np.cumsum(lengths)
    after[ends[lengths > 0] - 1] = -1
    before[(ends - lengths)[lengths > 0]] = -1
    alive = np.ones(size, bool)
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def note(at: np.ndarray) -> None:
        ranks = vocabulary.ranks(symbol[at], symbol[after[at]])
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ranks)]):
            if start < end:
                rank = int(ranks[start])
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(active, rank)
                index[rank].append(at[start:end])

    note(np.flatnonzero(after >= 0))
    while active:
        rank = heapq.heappop(active)
        left, right = vocabulary.pair[rank]
        at = np.unique(np.concatenate(index.pop(rank)))
        at = at[alive[at] & (symbol[at] == left) & (after[at] >= 0)]
        at = at[symbol[after[at]] == right]
        if left == right:
            at = _alternate(at, after)
        if not len(at):
            continue
        gone = after[at]
        symbol[at], alive[gone] = vocabulary.made[rank], False
        beyond = after[gone]
        after[at] = beyond
        before[beyond[beyond >= 0]] = at[beyond >= 0]
        ahead = before[at]
        note(np.concatenate([ahead[ahead >= 0], at[beyond >= 0]]))
    totals = np.concatenate(([0], np.cumsum(alive)))
    return symbol[alive], totals[ends] - totals[ends - lengths]


class Encoder:
    """Encodes chunks of texts, remembering the pieces it has met."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.words = regex.compile(PATTERN)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.int64)
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def pieces(self, text: str) -> list[str]:
        """Cuts at which words start; each special token a piece of its own."""
        v = self.vocabulary
        if v.split and any(s in text for s in v.special):
            return [w for i, part in enumerate(v.split.split(text))
                    for w in ([part] if i % 2 else self.words.findall(part))]
        return self.words.findall(text) if OTHER_SPACE.search(text) else CUT.findall(text)

    def _learn(self, new: list[str]) -> None:
        words, owner, special = [], [], []
        for i, piece in enumerate(new):
            if piece in self.vocabulary.special:
                special.append((i, self.vocabulary.special[piece]))
                continue
            for word in self.words.findall(piece):
                words.append(word.encode())
                owner.append(i)
        ids, counts = merge(words, self.vocabulary)
        per = np.bincount(np.array(owner, np.int64), counts, len(new)).astype(np.int64)
        starts = len(self.flat) + np.cumsum(per) - per
        tail = len(self.flat) + len(ids)
        for k, (i, _) in enumerate(special):
            per[i], starts[i] = 1, tail + k
        self.flat = np.concatenate([self.flat, ids, np.array([i for _, i in special], np.int64)])
        self.start, self.count = np.concatenate([self.start, starts]), np.concatenate([self.count, per])

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.known) > MOST_KNOWN:
            self._forget()
        known, new, rows = self.known, [], []
        for text in texts:
            row = []
            for piece in self.pieces(text):
                i = known.get(piece)
                if i is None:
                    i = known[piece] = len(known)
                    new.append(piece)
                row.append(i)
            rows.append(np.array(row, np.int64 if len(known) >= 1 << 31 else np.int32))
        if new:
            self._learn(new)
        for row in rows:
            counts = self.count[row]
            total = int(counts.sum())
            skip = np.repeat(self.start[row] - (np.cumsum(counts) - counts), counts)
            yield self.flat[skip + np.arange(total)].astype("<u4")


_ENCODERS: dict[str, Encoder] = {}  # of this worker


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): the token ids of each whole text.

    Null and empty texts have no ids.  Special tokens written in a text are
    taken as such, as the library does.  Repeated rows give repeated results.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches, CHUNK):
            rows = [x.tolist() for x in encoder(path).encode([t.decode() for t in texts])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return with_text(docs, encoded=True).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); bytes that are no UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder(path).vocabulary
        for batch in batches:
            texts = [vocabulary.decode(np.array(x or [], np.int64)).decode("utf-8", "replace")
                     for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row the number of ids and the digests of the ids and of their decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder(path).vocabulary
        for doc_ids, texts in rows_of(batches, CHUNK):
            counts, ids_hash, text_hash = [], [], []
            for ids in encoder(path).encode([t.decode() for t in texts]):
                decoded = vocabulary.decode(ids).decode("utf-8", "replace").encode()
                counts.append(len(ids))
                ids_hash.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text_hash.append(hashlib.sha256(decoded).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return with_text(docs, encoded=True).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
