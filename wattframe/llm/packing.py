"""Packing token sequences by cutting-stock column generation.

Documents longer than a sequence fill whole sequences by themselves; what is
left of each is rounded up to a class of ``UNIT`` tokens.  A linear program
over patterns (how many of each class share a sequence) covers the histogram
of classes.  Its columns are priced by a knapsack dynamic program.  Whole
multiples of the patterns are taken as they are and the small rest is packed
first-fit decreasing.  Only the histogram reaches the driver; documents are
ranked within their class by Spark and take the pattern slot of their rank.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.common import ranked, rows_of, staged, with_text

SEQUENCE = 4096
UNIT = 16
END = 2  # the id put after each document
CHUNK = 8 << 20
MOST_KNOWN = 1_000_000  # pieces a worker remembers before it lets go of the rarest
AT_ONCE = 20_000  # pieces given to the library at a time
GAP = 1e-4  # the program stops this close to its bound
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class _Known(dict):
    """Slots of pieces; one met for the first time is given its slot by ``miss``."""

    def __init__(self, miss: Callable[[bytes], int], known: dict[bytes, int] | None = None):
        super().__init__(known or {})
        self.miss = miss

    def __missing__(self, piece: bytes) -> int:
        return self.miss(piece)


class Encoder:
    """Token ids of whole texts; pieces between ASCII white space are encoded once by the library.

    The vocabulary drops white space and splits at it, so pieces don't influence
    one another.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known = _Known(self._slot)
        self.new: list[tuple[int, str]] = []
        self.joined: list[tuple[int, int, int]] = []
        self.slots = 0
        self.flat = np.zeros(0, np.int32)
        self.start, self.count, self.met = (np.zeros(0, np.int64) for _ in range(3))

    def _forget(self) -> None:
        """Keeps the pieces met most often, at most half of what may be known, and counts old meetings for less."""
        least, kept = 2, self.known
        while len(kept) > MOST_KNOWN // 2:
            often = self.met >= least
            kept = {piece: slot for piece, slot in kept.items() if often[slot]}
            least *= 2
        slots = np.unique(np.fromiter(kept.values(), np.int64, len(kept)))
        place = np.zeros(self.slots, np.int64)
        place[slots] = np.arange(len(slots))
        self.known = _Known(self._slot, {piece: int(place[slot]) for piece, slot in kept.items()})
        self.flat, self.count, self.met = self._gather(slots), self.count[slots], self.met[slots] // 2
        self.start, self.slots = np.cumsum(self.count) - self.count, len(slots)

    def _slot(self, piece: bytes) -> int:
        """The slot of a piece met for the first time.

        ASCII letters are looked up in lower case, and one comma or full stop
        behind them apart: the vocabulary lowers case and splits there itself.
        """
        plain = piece.lower() if piece.isalpha() or piece[:-1].isalpha() and piece[-1:] in (b".", b",") else piece
        slot = self.known.get(plain)
        if slot is None:
            slot = self.known[plain] = self.slots
            self.slots += 1
            if len(plain) > 1 and plain[-1:] in (b".", b",") and plain[:-1].isalpha():
                self.joined.append((slot, self.known[plain[:-1]], self.known[plain[-1:]]))
            else:
                self.new.append((slot, plain.decode()))
        self.known[piece] = slot
        return slot

    def _ids(self, texts: list[str], letters: bool) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after another, and how many each has."""
        if letters:  # each is one word of the library, so they can be encoded as one text
            found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            sizes = np.bincount(np.array(found.word_ids, np.int64), minlength=len(texts))
            if len(sizes) == len(texts) and sizes.all():
                return np.array(found.ids, np.int32), sizes
        each = [x.ids for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.array([y for x in each for y in x], np.int32), np.array([len(x) for x in each], np.int64)

    def _learn(self) -> None:
        new, joined, self.new, self.joined = self.new, self.joined, [], []
        self.start, self.count, self.met = (np.concatenate([x, np.zeros(self.slots - len(x), np.int64)])
                                            for x in (self.start, self.count, self.met))
        at, parts = len(self.flat), [self.flat]
        new.sort(key=lambda x: not x[1].isalpha())  # words of letters alone come first
        letters = sum(t.isalpha() for _, t in new)
        for start, end in [(i, min(i + AT_ONCE, stop)) for begin, stop in ((0, letters), (letters, len(new)))
                           for i in range(begin, stop, AT_ONCE)]:
            some = new[start:end]
            ids, sizes = self._ids([t for _, t in some], end <= letters)
            slots = np.array([k for k, _ in some], np.int64)
            self.start[slots], self.count[slots] = at + np.cumsum(sizes) - sizes, sizes
            parts.append(ids)
            at += len(ids)
        self.flat = np.concatenate(parts)
        if joined:  # the ids of the letters, then of the stop
            slots, letters, stops = np.array(joined, np.int64).T
            sizes = self.count[letters] + self.count[stops]
            starts = at + np.cumsum(sizes) - sizes
            both = self._gather(np.stack([letters, stops], axis=1).ravel())
            self.start[slots], self.count[slots] = starts, sizes
            self.flat = np.concatenate([self.flat, both])

    def _gather(self, row: np.ndarray) -> np.ndarray:
        counts = self.count[row]
        skip = np.repeat(self.start[row] - (np.cumsum(counts) - counts), counts)
        return self.flat[skip + np.arange(len(skip))]

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        if len(self.known) > MOST_KNOWN:
            self._forget()
        rows = [np.array(list(map(self.known.__getitem__, text.split())), np.int64) for text in texts]
        if self.new or self.joined:
            self._learn()
        for row in rows:
            np.add.at(self.met, row, 1)
            yield np.append(self._gather(row), END).astype("<u4")


_ENCODERS: dict[str, Encoder] = {}  # of this worker


def pieces(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Each document's ids cut at multiples of the sequence length.

    Null and empty texts are the end id alone.  ``with_ids`` adds the ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        for doc_ids, texts in rows_of(batches, CHUNK):
            rows, own = [], []
            for doc_id, ids in zip(doc_ids, _ENCODERS[path].encode(texts)):
                for start in range(0, len(ids), SEQUENCE):
                    part = ids[start:start + SEQUENCE]
                    rows.append((doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids)))
                    if with_ids:
                        own.append(part.astype(np.int32))
            columns = [pa.array(x, pa.int64()) for x in zip(*rows)]
            if with_ids:
                columns.append(pa.array(own, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = PIECE + (", ids array<int>" if with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]
    return with_text(docs, encoded=True).mapInArrow(run, schema)


def price(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: how many of each class (size 1, 2, ...) fill ``capacity``."""
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        sizes = min(room, len(values))
        found = values[:sizes] + best[room - sizes:room][::-1]
        k = int(np.argmax(found))
        best[room], choice[room] = (found[k], k + 1) if found[k] > best[room - 1] else (best[room - 1], 0)
    pattern, room = np.zeros(len(values), np.int64), capacity
    while room > 0:
        k = int(choice[room])
        if k:
            pattern[k - 1] += 1
        room -= max(k, 1)
    return float(best[capacity]), pattern


def first_fit(demand: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Patterns, one for each sequence, that hold ``demand``: largest classes first."""
    left, made = demand.copy(), []
    while left.any():
        pattern, room = np.zeros_like(left), capacity
        for k in np.flatnonzero(left)[::-1]:
            n = min(int(left[k]), room // (int(k) + 1))
            pattern[k] += n
            room -= n * (int(k) + 1)
        left -= pattern
        made.append(pattern)
    return made


def cut(demand: np.ndarray, capacity: int, rounds: int = 5000) -> list[tuple[np.ndarray, int]]:
    """(pattern, how many sequences) that hold ``demand`` (of class sizes 1, 2, ...)."""
    used = np.flatnonzero(demand)
    if not len(used):
        return []
    need = demand[used].astype(float)
    size = len(used)
    patterns = np.zeros((size, len(demand)), np.int64)
    patterns[np.arange(size), used] = capacity // (used + 1)
    inverse = np.diag(1.0 / patterns[np.arange(size), used])
    times = inverse @ need
    for _ in range(rounds):
        duals = np.maximum(inverse.sum(axis=0), 0)
        values = np.zeros(len(demand))
        values[used] = duals
        worth, pattern = price(values, capacity)
        pattern[demand == 0] = 0
        total = times.sum()
        if worth <= 1 + 1e-9 or total - (need @ duals) / worth <= GAP * total:
            break
        entering = inverse @ pattern[used].astype(float)
        ratios = np.where(entering > 1e-9, times / np.where(entering > 1e-9, entering, 1), np.inf)
        out = int(np.argmin(ratios))
        if not np.isfinite(ratios[out]):
            break
        step = ratios[out]
        times = np.maximum(times - step * entering, 0)
        times[out] = step
        pivot = inverse[out] / entering[out]
        inverse -= np.outer(entering, pivot)
        inverse[out] = pivot
        patterns[out] = pattern
    whole = np.floor(times + 1e-9).astype(np.int64)
    rest = np.maximum(demand - whole @ patterns, 0)
    return [(p, int(n)) for p, n in zip(patterns, whole) if n and p.any()] + [(p, 1) for p in first_fit(rest, capacity)]


def _slots(plan: list[tuple[np.ndarray, int]], classes: int) -> tuple[list[tuple[np.ndarray, ...]], int]:
    """For each class the first rank of each pattern, its first sequence and its items a sequence."""
    table: list[list[tuple[int, int, int]]] = [[] for _ in range(classes)]
    ranks, sequence = [0] * classes, 0
    for pattern, times in plan:
        for k in np.flatnonzero(pattern).tolist():
            each = int(pattern[k])
            table[k].append((ranks[k], sequence, each))
            ranks[k] += each * times
        sequence += times
    return [tuple(np.array(x, np.int64) for x in zip(*rows)) if rows else () for rows in table], sequence


def pack(cuts: DataFrame) -> DataFrame:
    """Adds sequence_id and offset to pieces (at least doc_id, start, length of at most SEQUENCE).

    Pieces of a full sequence stand alone.  Ties are broken by doc_id and start;
    repeated rows are packed each.  No pieces give no sequences.
    """
    kind = F.when(F.col("length") == SEQUENCE, 0).otherwise(F.ceil(F.col("length") / UNIT)).cast("int")
    cuts = staged(cuts.withColumn("class", kind), "cuts")
    histogram = {r["class"]: r["n"] for r in cuts.groupBy("class").agg(F.count("*").alias("n")).collect()}
    classes = SEQUENCE // UNIT
    demand = np.array([histogram.get(k + 1, 0) for k in range(classes)], np.int64)
    table, patterned = _slots(cut(demand, classes), classes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.column(names.index("class")).to_numpy(zero_copy_only=False)
            rank = batch.column(names.index("rank")).to_numpy(zero_copy_only=False)
            sequence = patterned + rank
            for k in np.unique(kinds[kinds > 0]).tolist():
                first, start, each = table[k - 1]
                mine = kinds == k
                at = np.searchsorted(first, rank[mine], side="right") - 1
                sequence[mine] = start[at] + (rank[mine] - first[at]) // each[at]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence, pa.int64())],
                                             [*names, "sequence_id"])

    dealt = ranked(cuts, ["class"], ["doc_id", "start"], sum(histogram.values()))
    names = dealt.columns
    placed = dealt.mapInArrow(place, ", ".join(f"{n} {t}" for n, t in dealt.dtypes) + ", sequence_id long")
    before = (Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank")
              .rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop(
        "class", "rank")
