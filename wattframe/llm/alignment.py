"""Alignment of two tokenizers by byte spans.

A byte-level BPE (A, of the tokenizers library) and a sentencepiece BPE with
byte fallback (B) encode one text each in its own way.  The spans that the
libraries report are coarse cuts: character offsets of A, spans of B's proto.
Within a cut, characters that A splits and bytes that B falls back to are cut
finer by the bytes of the tokens themselves.

Neither tokenizer joins anything across a single blank between two printed
characters, so a text is cut there and each distinct unit of a chunk is encoded
and aligned once.  Corpus counts travel as one row for each chunk and id pair;
texts and units don't travel.
"""

from __future__ import annotations

import ctypes
import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.bpe import byte_symbols
from wattframe.llm.common import rows_of, staged, with_text

UNIT = re.compile(r"(?<=\S)(?= \S)")
CHUNK = 7 << 20  # characters of text whose distinct units share a dictionary
AT_ONCE = 1 << 18  # characters of units encoded and aligned at a time; a longer unit stands alone
RUN = 4096  # characters of units encoded as one text
B_BITS = 20


class Tokenizers:
    """Both tokenizers with the bytes of their tokens and ready-made pieces of the report."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        stand_in = byte_symbols()
        with open(a_path, encoding="utf-8") as file:
            special = {t["content"] for t in json.load(file)["added_tokens"]}
        size = self.a.get_vocab_size()
        names = [self.a.id_to_token(i) or "" for i in range(size)]
        self.a_bytes = [n.encode() if n in special else bytes(stand_in[c] for c in n) for n in names]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = range(self.b.get_piece_size())
        self.b_byte = np.array([self.b.is_byte(i) for i in pieces])
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b_byte[i]
                        else self.b.id_to_piece(i).replace("▁", " ").encode() for i in pieces]
        assert len(self.b_bytes) < 1 << B_BITS
        self.a_length, self.b_length = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))
        self.a_comma, self.a_bar = (np.array([f"{i}{end}" for i in range(size)], object) for end in ",|")
        self.b_comma, self.b_semicolon = (np.array([f"{i}{end}" for i in pieces], object) for end in ",;")


def _refined(coarse: np.ndarray, at: np.ndarray, lengths: np.ndarray, first: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Byte ends: ``at`` where the cut is coarse, else the last cut plus the bytes of the tokens since.

    ``first`` marks the first token of a unit, ``start`` the byte where that unit starts.
    """
    total = np.cumsum(lengths)
    known = np.maximum.accumulate(np.where(coarse, np.arange(len(at)), -1))
    opened = np.maximum.accumulate(np.where(first, np.arange(len(at)), -1))
    from_cut = known >= opened
    base = np.where(from_cut, at[known], start)
    past = np.where(from_cut, total[known], (total - lengths)[opened])
    return base + total - past


def _sound(ids: np.ndarray, ends: np.ndarray, sizes: np.ndarray, names: list[bytes],
           lengths: np.ndarray, data: bytes, bounds: np.ndarray) -> np.ndarray:
    """Which units the bytes of their tokens spell out, span by span."""
    joined = b"".join(map(names.__getitem__, ids.tolist()))
    total = np.cumsum(lengths[ids])
    if joined == data and np.array_equal(total, ends) and sizes.all() \
            and np.array_equal(total[np.cumsum(sizes) - 1], bounds):
        return np.ones(len(sizes), bool)
    sound, token, byte = np.zeros(len(sizes), bool), 0, 0
    starts = np.append(0, bounds).tolist()
    for i, n in enumerate(sizes.tolist()):
        own = lengths[ids[token:token + n]]
        size = int(own.sum())
        sound[i] = n > 0 and joined[byte:byte + size] == data[starts[i]:starts[i + 1]] and np.array_equal(
            starts[i] + np.cumsum(own), ends[token:token + n])
        token, byte = token + n, byte + size
    return sound


def _runs(units: list[str]) -> Iterator[tuple[int, int]]:
    """Bounds of units that may be encoded as one text: none has B's mark of a blank or white space at its end."""
    low, size = 0, 0
    for i, unit in enumerate(units):
        alone = "▁" in unit or unit[-1].isspace()
        if (alone or size >= RUN) and low < i:
            yield low, i
            low, size = i, 0
        size += len(unit)
        if alone:
            yield i, i + 1
            low, size = i + 1, 0
    if low < len(units):
        yield low, len(units)


class Units:
    """Distinct units, one after another: tokens, groups and links of each."""

    def __init__(self, units: list[str], t: Tokenizers):
        data = "".join(units).encode()
        chars = np.append(np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80), len(data))
        last_char = np.cumsum([len(u) for u in units], dtype=np.int64)
        bounds = chars[last_char]
        runs = [(low, high, "".join(units[low:high])) for low, high in _runs(units)]
        a_ids, a_of, a_ends, a_sound = self._spans_a(units, runs, t, data, chars, last_char, bounds)
        b_ids, b_of, b_ends, b_sound = self._spans_b(units, runs, t, data, bounds)
        count = len(units)
        self.sound = a_sound & b_sound
        keep_a, keep_b = self.sound[a_of], self.sound[b_of]
        a_ids, a_of, a_ends = a_ids[keep_a], a_of[keep_a], a_ends[keep_a]
        b_ids, b_of, b_ends = b_ids[keep_b], b_of[keep_b], b_ends[keep_b]
        self.n_a, self.n_b = np.bincount(a_of, minlength=count), np.bincount(b_of, minlength=count)
        both = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")  # two sorted runs: a merge
        again = both[1:] == both[:-1]
        ends, cuts = both[np.append(True, ~again)[:len(both)]], both[1:][again]
        in_a, in_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        self.links = a_ids[in_a] << B_BITS | b_ids[in_b]
        self.n_links = np.bincount(a_of[in_a], minlength=count)
        self.n_groups = np.bincount(np.searchsorted(bounds, cuts), minlength=count)
        self.reports = self._reports(t, a_ids, a_ends, b_ids, b_ends, cuts)

    def _spans_a(self, units: list[str], runs: list, t: Tokenizers, data: bytes, chars: np.ndarray, last_char: np.ndarray,
                 bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        ids, offsets, first_char, starts = [], [], np.append(0, last_char[:-1]).tolist(), np.append(0, bounds[:-1])
        for (low, _, _), encoding in zip(runs, t.a.encode_batch([text for _, _, text in runs], add_special_tokens=False)):
            ids += encoding.ids
            own = np.fromiter(chain.from_iterable(encoding.offsets), np.int64)
            offsets.append(own.reshape(-1, 2) + first_char[low])
        ids, spans = np.array(ids, np.int64), np.concatenate([np.empty((0, 2), np.int64), *offsets])
        of = np.searchsorted(last_char, spans[:, 0], side="right")
        first = np.append(True, of[1:] != of[:-1])[:len(of)]
        last = np.append(of[1:] != of[:-1], True)[:len(of)]
        coarse = last | (np.append(spans[1:, 0], 0)[:len(of)] >= spans[:, 1])
        ends = _refined(coarse, chars[spans[:, 1]], t.a_length[ids], first, starts[of])
        sizes = np.bincount(of, minlength=len(units))
        return ids, of, ends, _sound(ids, ends, sizes, t.a_bytes, t.a_length, data, bounds)

    def _spans_b(self, units: list[str], runs: list, t: Tokenizers, data: bytes, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        ids, ends, starts = [], [], np.append(0, bounds[:-1])
        for low, _, text in runs:
            pieces = t.b.encode(text[1:], return_type="proto").pieces  # the library adds a blank
            ids += [p.id for p in pieces]
            ends.append(np.array([p.end for p in pieces], np.int64) + 1 + starts[low])
        ids, at = np.array(ids, np.int64), np.concatenate([np.empty(0, np.int64), *ends])
        # Of the fallback bytes of a character only the last has a span; the others end where it begins.
        empty = t.b_byte[ids] & (np.append(-1, at[:-1])[:len(at)] == at)
        of = np.searchsorted(bounds, at - 1 + empty, side="right")
        first = np.append(True, of[1:] != of[:-1])[:len(of)]
        ends = _refined(~t.b_byte[ids], at, t.b_length[ids], first, starts[of])
        sizes = np.bincount(of, minlength=len(units))
        return ids, of, ends, _sound(ids, ends, sizes, t.b_bytes, t.b_length, data, bounds)

    def _reports(self, t: Tokenizers, a_ids: np.ndarray, a_ends: np.ndarray, b_ids: np.ndarray, b_ends: np.ndarray,
                 cuts: np.ndarray) -> list[str]:
        """`a1,a2|b1;` for each group of a unit."""
        if not len(cuts):
            return [""] * len(self.n_a)
        group_a, group_b = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        many_a, many_b = np.bincount(group_a), np.bincount(group_b)
        before_a, before_b = np.cumsum(many_a), np.cumsum(many_b) - many_b
        parts = np.empty(len(a_ids) + len(b_ids), object)
        at_a = np.arange(len(a_ids)) + before_b[group_a]
        at_b = np.arange(len(b_ids)) + before_a[group_b]
        parts[at_a] = np.where(a_ends == cuts[group_a], t.a_bar[a_ids], t.a_comma[a_ids])
        parts[at_b] = np.where(b_ends == cuts[group_b], t.b_semicolon[b_ids], t.b_comma[b_ids])
        parts, bounds = parts.tolist(), np.append(0, np.cumsum(self.n_a + self.n_b)).tolist()
        return ["".join(parts[i:j]) for i, j in zip(bounds, bounds[1:])]


class Aligned:
    """The figures of all units of a chunk, made for AT_ONCE characters at a time; id pairs get numbers of the chunk."""

    def __init__(self, units: Iterable[str], t: Tokenizers):
        names, parts, held, size = ("sound", "n_a", "n_b", "n_groups", "n_links"), [], [], 0
        self.reports: list[str] = []

        def close() -> None:
            u = Units(held, t)
            self.reports += u.reports
            pairs, coded = np.unique(u.links, return_inverse=True)
            parts.append([getattr(u, n) for n in names] + [pairs, coded.astype(np.int32)])

        for unit in units:
            held.append(unit)
            size += len(unit)
            if size >= AT_ONCE:
                close()
                held, size = [], 0
        if held:
            close()
        for at, name in enumerate(names):
            setattr(self, name, np.concatenate([np.empty(0, bool if name == "sound" else np.int64), *[p[at] for p in parts]]))
        self.pairs = np.unique(np.concatenate([np.empty(0, np.int64), *[p[-2] for p in parts]]))
        self.links = np.concatenate([np.empty(0, np.int32), *[
            np.searchsorted(self.pairs, p[-2]).astype(np.int32)[p[-1]] for p in parts]])


STATED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
ROWS = f"chunk long, {STATED}, units array<int>, sizes array<int>, links array<int>, code int, pair long, count long"


def _chunk_rows(chunk: int, ids: list, codes: list[np.ndarray], units: Iterable[str], t: Tokenizers) -> Iterator[pa.RecordBatch]:
    """A row for each document, one with the links of each unit, one for each id pair."""
    fields = [f.split() for f in ROWS.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}

    def batch(**columns) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk] * size, pa.int64()) if n == "chunk" else pa.array(columns[n], kinds[k]) if n in columns
             else pa.nulls(size, kinds[k]) for n, k in fields], [n for n, _ in fields])

    u = Aligned(units, t)
    met = np.zeros(len(u.sound), np.int64)
    rows = {n: [] for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "units")}
    for doc_id, own in zip(ids, codes):
        if not u.sound[own].all():
            own = own[:0]
        np.add.at(met, own, 1)
        report = "".join(map(u.reports.__getitem__, own.tolist()))[:-1]
        values = (doc_id, *[int(x[own].sum()) for x in (u.n_a, u.n_b, u.n_groups, u.n_links)],
                  hashlib.sha256(report.encode()).hexdigest() if len(own) else "", np.sort(own))
        for name, value in zip(rows, values):
            rows[name].append(value)
        if len(rows["doc_id"]) == 4096:
            yield batch(**rows)
            rows = {n: [] for n in rows}
    if rows["doc_id"]:
        yield batch(**rows)
    yield batch(sizes=[u.n_links.astype(np.int32)], links=[u.links])
    counts = np.zeros(len(u.pairs), np.int64)
    np.add.at(counts, u.links, np.repeat(met, u.n_links))
    used = np.flatnonzero(counts)
    for part in np.array_split(used, len(used) // 65536 + 1):
        yield batch(code=part.astype(np.int32), pair=u.pairs[part], count=counts[part])


class UnitCodes(dict):
    """Numbers of units, given as they are met; ``odd`` holds those with white space at an end.

    Units are named without the blank that starts each of them.
    """

    def __init__(self) -> None:
        super().__init__()
        self.odd: list[bool] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = code = len(self)
        self.odd.append(not unit or unit[0].isspace() or unit[-1].isspace())
        return code

    def of(self, text: str) -> np.ndarray:
        """The units of a text: what stands between blanks, unless blanks meet or other white space is beside one."""
        if not text:
            return np.empty(0, np.int32)
        known = list(map(self.__getitem__, text.split(" ")))
        if any(map(self.odd.__getitem__, known)):
            known = [self[unit[1:]] for unit in UNIT.split(" " + text)]
        return np.array(known, np.int32)

    def units(self) -> Iterator[str]:
        return (" " + unit for unit in self)


_LOADED: dict[tuple[str, str], Tokenizers] = {}


def _give_back() -> None:
    """Workers live on after a task; what it no longer holds goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library alone
    if trim is not None:
        trim(0)


def _aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _LOADED.get((a_path, b_path)) or _LOADED.setdefault((a_path, b_path), Tokenizers(a_path, b_path))
        chunk = TaskContext.get().partitionId() << 32
        ids, codes, size, index = [], [], 0, UnitCodes()
        for doc_ids, texts in rows_of(batches, AT_ONCE):
            codes += map(index.of, texts)
            ids += doc_ids
            size += sum(map(len, texts))
            if size >= CHUNK:
                yield from _chunk_rows(chunk, ids, codes, index.units(), t)
                chunk, ids, codes, size, index = chunk + 1, [], [], 0, UnitCodes()
        if ids:
            yield from _chunk_rows(chunk, ids, codes, index.units(), t)
        _give_back()

    return with_text(docs).mapInArrow(run, ROWS)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, total, best): how many links hold each id pair, and whether that is its B id's highest."""
    totals = staged(rows.where("pair is not null").groupBy("pair").agg(F.sum("count").alias("total")), "pairs")
    b = F.col("pair").bitwiseAND((1 << B_BITS) - 1).alias("b")
    highest = totals.groupBy(b).agg(F.max("total").alias("highest"))  # at most one row for each entry of B
    return totals.withColumn("b", b).join(F.broadcast(highest), "b").select(
        "pair", "total", (F.col("total") == F.col("highest")).alias("best"))


RESULT = f"{STATED}, n_best long, count_sum long"


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Spans, groups and links of both tokenizations of each row's text.

    A encodes a blank and the text, B the text, to which it adds a blank; the
    strings of special tokens are plain text.  Null and empty texts, and those
    which the tokens of A or B don't spell out, have no tokens: zeros and an
    empty digest.  Repeated rows count each time they occur; rows without
    doc_id are like any other.  An empty table gives an empty result.
    """
    rows = staged(_aligned(docs, a_path, b_path), "aligned")
    values = (rows.where("pair is not null").select("chunk", "code", "pair").join(pair_counts(rows), "pair")
              .select("chunk", "code", "total", "best"))
    names = [f.split()[0] for f in STATED.split(", ")]

    def scored(own: pa.Table, met: pa.Table) -> pa.Table:
        is_unit = own["sizes"].is_valid()
        unit, texts = own.filter(is_unit), own.filter(own["sizes"].is_null()).combine_chunks()
        sizes = unit["sizes"].combine_chunks().flatten().to_numpy()
        links = unit["links"].combine_chunks().flatten().to_numpy()
        code = met["code"].to_numpy()
        lists = texts["units"].combine_chunks()
        units, many = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()

        def added(values: np.ndarray) -> pa.Array:
            of_pair = np.zeros(links.max() + 1 if len(links) else 0, np.int64)
            of_pair[code] = values
            of_unit = _sums(of_pair[links], sizes)
            return pa.array(_sums(of_unit[units], many))

        columns = [texts[n].combine_chunks() for n in names]
        columns += [added(met["best"].to_numpy().astype(np.int64)), added(met["total"].to_numpy())]
        _give_back()
        return pa.Table.from_arrays(columns, [*names, "n_best", "count_sum"])

    left = rows.where("pair is null").select(F.col("chunk").alias("of"), *names, "units", "sizes", "links")
    return left.groupBy("of").cogroup(values.groupBy("chunk")).applyInArrow(scored, RESULT)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``sizes`` values."""
    total = np.append(0, np.cumsum(values))
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]
