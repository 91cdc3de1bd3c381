"""Near-duplicate lines by a segment-partition edit join, in native expressions.

Two lines within T edits share one of T + 1 segments: cut the shorter line into
T + 1 segments, and one of them stands in the longer line, shifted by no more
than the edits left on either side allow.  Each line is indexed by its segments
and probed by those substrings, all keyed with the length of the shorter line.
Where many lines have a segment, those are told apart by longer keys: the line
without one or two blocks, halved until few lines have a key.
Of the pairs that meet, those whose letter counts differ too much can't be
within T edits; the others are verified by a bit-parallel edit automaton over the band of
2T + 1 diagonals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.common import staged

EDITS = 2
SHORTEST = 12  # code points; shorter lines match exactly only


def _segments(length: Column, edits: int) -> list[tuple[Column, Column]]:
    """(first position, length) of each segment of a line of ``length``; the last ones take the rest."""
    n = edits + 1
    base, rest = F.floor(length / n).cast("int"), (length % n).cast("int")
    found = []
    for i in range(n):
        longer = F.greatest(F.lit(0), rest - (n - i))  # segments before i that are one longer
        start = 1 + i * base + longer
        found.append((start, base + F.when(rest >= n - i, 1).otherwise(0)))
    return found


def _probes(edits: int) -> list[tuple[int, int, int]]:
    """(how much shorter the other line is, segment, shift) of each key of a line."""
    return [(shorter, i, shift) for shorter in range(edits + 1) for i in range(edits + 1)
            for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + edits - i) + 1)]


def with_keys(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """``lines`` plus ``keys``: those of each line in the order of ``_probes``; null where a substring doesn't fit.

    Substrings of text are found by counting its characters from the start, each
    time anew, so they are taken from a form of four bytes to a character.  Length
    and cuts are columns of their own, worked out once for all keys.
    """
    cuts = {(k, i): cut for k in range(edits + 1) for i, cut in enumerate(_segments(F.col("_size") - k, edits))}
    wide = (lines.withColumn("_wide", F.encode("line", "UTF-32"))
            .withColumn("_size", F.shiftright(F.octet_length("_wide"), 2))
            .withColumns({f"_{n}{k}{i}": c for (k, i), cut in cuts.items() for n, c in zip(("start", "width"), cut)}))
    keys = []
    for k, i, shift in _probes(edits):
        begin, width = F.col(f"_start{k}{i}") + shift, F.col(f"_width{k}{i}")
        fits = (begin >= 1) & (begin + width - 1 <= F.col("_size")) & (F.col("_size") >= SHORTEST + k)
        part = F.substring(F.col("_wide"), begin * 4 - 3, width * 4)
        keys.append(F.when(fits, F.xxhash64(F.col("_size") - k, F.lit(i), part)))
    return wide.select(*lines.columns, F.array(*keys).alias("keys"))


# Frequent letters.  An edit changes the counts of two of them by one at most.
LETTERS = "etaonrsihldcump"
LONG, FEW = 128, 6  # a line of so many bytes has its first few letters counted only: they tell long lines apart


def letter_counts(line: Column) -> Column:
    """How often each of LETTERS stands in a line, modulo 16, four bits each; the bit above them marks a long line."""
    size = F.octet_length(line)

    def counted(letters: range) -> Column:
        found = F.lit(0).cast("long")
        for k in letters:
            n = size - F.octet_length(F.replace(line, F.lit(LETTERS[k]), F.lit("")))
            found = found.bitwiseOR(F.shiftleft(n.cast("long").bitwiseAND(F.lit(15)), 4 * k))
        return found

    rest = F.when(size < LONG, counted(range(FEW, len(LETTERS)))).otherwise(F.lit(1 << 4 * len(LETTERS)))
    return counted(range(FEW)).bitwiseOR(rest)


def letters_apart(a: Column, b: Column) -> Column:
    """The sum of differences of the letter counts that both have; at most twice the edits between two lines."""
    def apart(letters: range) -> Column:
        total = F.lit(0).cast("long")
        for k in letters:
            x, y = (F.shiftrightunsigned(c, 4 * k).bitwiseAND(F.lit(15)) for c in (a, b))
            total = total + F.least(F.abs(x - y), 16 - F.abs(x - y))
        return total

    both = a.bitwiseOR(b) < (1 << 4 * len(LETTERS))
    return apart(range(FEW)) + F.when(both, apart(range(FEW, len(LETTERS)))).otherwise(0)


def all_letters_apart(a: Column, b: Column) -> Column:
    """The sum of differences of the counts of all LETTERS, from the lines themselves."""
    def counted(line: Column, letter: str) -> Column:
        return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))

    return reduce(Column.__add__, [F.abs(counted(a, c) - counted(b, c)) for c in LETTERS])


SLOTS, BITMAP = 1 << 27, 1 << 15  # at most so many bits mark documents; bits of one bitmap


def marked(docs: DataFrame, ids: DataFrame, most: int) -> DataFrame:
    """The rows of ``docs`` whose doc_id is among ``ids`` (``most`` at most), with some others.

    The ids are marked by one bit each, eight to an id or more, so that few other
    texts are shuffled with theirs; the bits are 16 MB at most.
    """
    slots = min(max(8 * most, BITMAP), SLOTS)
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(slots))
    bits = ids.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    at = F.col("at").cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftright(byte, at % 8) & 1") == 1
    return (docs.withColumns({"bucket": F.bitmap_bucket_number(slot), "at": F.bitmap_bit_position(slot)})
            .join(F.broadcast(bits), "bucket").withColumns({"byte": byte, "at": at}).where(hit)
            .select(*docs.columns))


def within_edits(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Whether two lines are within ``edits`` insertions, deletions and substitutions.

    The state holds, for each number of edits spent, one bit for each diagonal
    of the band; a step moves all of them by one character of ``a``.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1

    def run(p: Column) -> Column:
        x, y = p["x"], p["y"]
        masks = F.transform(F.sequence(F.lit(0), F.size(x) - 1), lambda i: sum(
            (F.when(F.get(x, i) == F.get(y, i + (k - edits)), 1 << k).otherwise(0) for k in range(1, width)),
            F.when(F.get(x, i) == F.get(y, i - edits), 1).otherwise(0)))

        def spread(level: Column) -> Column:
            return F.shiftleft(level, 1).bitwiseAND(F.lit(full))

        def step(state: Column, mask: Column) -> Column:
            after = F.get(state, F.lit(0)).bitwiseAND(mask)
            levels = [after]
            for e in range(1, edits + 1):
                spent = F.get(state, F.lit(e - 1))
                after = (F.get(state, F.lit(e)).bitwiseAND(mask).bitwiseOR(spent)
                         .bitwiseOR(F.shiftright(spent, 1)).bitwiseOR(spread(after)))
                levels.append(after)
            return F.array(*levels)

        start, levels = 1 << edits, []
        for e in range(edits + 1):
            levels.append(F.lit(sum(1 << (edits + k) for k in range(e + 1)) if e else start))
        end = F.aggregate(masks, F.array(*levels), step)
        goal = F.size(y) - F.size(x) + edits
        reached = F.aggregate(end, F.lit(0), lambda s, level: s.bitwiseOR(level))
        return F.coalesce(*[F.when(goal == k, reached.bitwiseAND(F.lit(1 << k)) != 0) for k in range(width)],
                          F.lit(False))

    return F.transform(F.array(F.struct(F.split(a, "").alias("x"), F.split(b, "").alias("y"))), run)[0]


WORD = "[^\\x20\\x09-\\x0D]"  # of a line that is not blank
LAST = (1 << 63) - 1  # stands for a missing doc_id: such lines come after all others


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) of all lines of all texts."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"),
                       F.posexplode(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n"))
                       .alias("line_no", "line"))


MOST, BLOCKS = 16, 4  # lines that own a key and are compared with all that have it; blocks of the first longer keys


def sharing(keys: DataFrame, name: str) -> DataFrame:
    """The rows of ``keys`` (key, id, same, owned ...) whose key can link two lines, plus ``owners``.

    Where a key leaves out two blocks, two lines of it differ in both, ``left`` and ``right``.
    """
    mine = Window.partitionBy("key")
    several = reduce(Column.__and__, [F.coalesce(F.min(c).over(mine) < F.max(c).over(mine), F.lit(True))
                                      for c in ("id", "left", "right") if c in keys.columns])
    counted = keys.withColumns({"owners": F.count(F.when(F.col("owned"), 1)).over(mine), "several": several})
    return staged(counted.where("several and owners > 0").drop("several"), name)


def meeting(shared: DataFrame, edits: int) -> DataFrame:
    """(p, q): pairs of lines that share a key and may be within ``edits``; p is not the longer one."""
    out = [c for c in ("left", "right") if c in shared.columns]
    owned = shared.where("owned").select("key", F.col("id").alias("p"), F.col("letters").alias("x"),
                                         *[F.col(c).alias(f"own_{c}") for c in out])
    other = shared.select("key", F.col("id").alias("q"), F.col("letters").alias("y"), "same", *out)
    both = owned.join(other, "key").where("p <> q and (not same or p < q)")
    for c in out:
        both = both.where(F.coalesce(F.col(f"own_{c}") != F.col(c), F.lit(True)))
    return both.where(letters_apart(F.col("x"), F.col("y")) <= 2 * edits).select("p", "q").distinct()


def _shifts(shorter: int) -> list[int]:
    """Shifts between two blocks with one edit each, where the other line is so much shorter."""
    return [s for s in (-1, 0, 1) if abs(shorter - s) <= 1]


def _state(i, j, k, s) -> Column:
    """One key of a line: the blocks left out, how much shorter the other line is, the shift between the blocks."""
    return F.struct(*[(c if isinstance(c, Column) else F.lit(c)).cast("int").alias(n)
                      for n, c in zip("ijks", (i, j, k, s))])


def _halved(state: Column) -> Column:
    """The keys that take the place of one when each block is cut in two."""
    i, j, k, s = (state[n] for n in "ijks")
    one = [_state(2 * i + h, 2 * i + h, k, 0) for h in (0, 1)]
    two = [F.array(*one, *[_state(2 * i, 2 * i + 1, k, x) for x in _shifts(n)]) for n in range(EDITS + 1)]
    both = F.array(*[_state(2 * i + g, 2 * j + h, k, s) for g in (0, 1) for h in (0, 1)])
    return F.when(i < j, both).otherwise(F.get(F.array(*two), k))


def longer_keys(states: DataFrame, blocks: int) -> DataFrame:
    """The key of each state (id, letters, wide, i, j, k, s): the line without one or two of ``blocks`` blocks.

    ``size`` is the length of the shorter line, which is cut into the blocks;
    ``left`` and ``right`` are digests of two blocks left out.
    """
    def cut(block: Column) -> Column:
        return F.floor(block.cast("long") * F.col("size") / blocks).cast("int")

    def part(first: Column, last: Column) -> Column:
        return F.substring(F.col("wide"), first * 4 + 1, (last - first) * 4)

    i, j, k, s = (F.col(n) for n in "ijks")
    at = (states.withColumn("all", F.shiftright(F.octet_length("wide"), 2)).withColumn("size", F.col("all") - k)
          .where(F.col("size") >= SHORTEST)
          .withColumns({"i0": cut(i), "i1": cut(i + 1), "j0": cut(j), "j1": cut(j + 1)})
          .where("i = j or (i1 + s >= i0 and j1 + k >= j0 + s)"))
    i0, i1, j0, j1 = (F.col(n) for n in ("i0", "i1", "j0", "j1"))
    two = i < j
    middle = F.when(two, part(i1 + s, j0 + s)).otherwise(F.lit(b""))
    return at.select(
        F.xxhash64("size", i, j, part(F.lit(0), i0), middle, part(j1 + k, F.col("all"))).alias("key"), "id", "letters",
        (k == 0).alias("same"), ((k == 0) & (s == 0)).alias("owned"), F.when(two, F.xxhash64(part(i0, i1 + s))).alias("left"),
        F.when(two, F.xxhash64(part(j0 + s, j1 + k))).alias("right"), "size", "i", "j", "k", "s")


def crowded_pairs(lines: DataFrame, edits: int) -> DataFrame:
    """(p, q) as of ``meeting`` for ``lines`` (id, letters, line) that have a segment in common with too many others.

    Two edits lie in one block of a line or in two with one edit each, and the
    rest is equal.  A key that still has too many lines is given up for those
    with halves of its blocks, down to single characters, where all lines of a
    key are links but for few.  So pairs are listed in proportion to lines and links.
    """
    lines = lines.select("id", "letters", F.encode("line", "UTF-32").alias("wide"))
    first = [_state(i, j, k, s) for k in range(EDITS + 1) for i in range(BLOCKS) for j in range(i, BLOCKS)
             for s in (_shifts(k) if i < j else [0])]
    states, blocks, found = lines.withColumn("state", F.explode(F.array(*first))), BLOCKS, []
    while True:
        keys = longer_keys(states.select("id", "letters", "wide", "state.*"), blocks)
        shared = sharing(keys, "shared")
        crowd = (F.col("owners") > MOST) & (F.col("size") > blocks)
        found.append(meeting(shared.where(~crowd), edits))
        crowded = shared.where(crowd).select("id", F.struct("i", "j", "k", "s").alias("state"))
        if crowded.isEmpty():
            return reduce(DataFrame.union, found)
        halves = crowded.distinct().groupBy("id").agg(F.collect_list("state").alias("states"))
        halves = halves.withColumn("states", F.flatten(F.transform("states", _halved)))
        states, blocks = lines.join(halves, "id").withColumn("state", F.explode("states")), 2 * blocks


def looked_up(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (id, first ...) plus ``line``, taken from the texts by the places ``first``."""
    by_doc = wanted.groupBy("first.doc_id").agg(F.collect_list(F.struct("*")).alias("places"))
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"),
                        F.col("text").cast("string").alias("text"))

    def taken(lines: Column) -> Column:
        return F.transform("places", lambda p: F.struct(p.alias("p"), F.get(lines, p["first"]["line_no"]).alias("line")))

    return (marked(texts, wanted.select("first.doc_id"), wanted.count()).join(by_doc, "doc_id")
            .select(F.explode(F.transform(F.array(F.split("text", "\n")), taken)[0]).alias("found"))
            .select("found.p.*", "found.line").where("line is not null and hash(line) = first.tag")
            .dropDuplicates(["id"]))


def line_links(docs: DataFrame, edits: int = EDITS) -> tuple[DataFrame, DataFrame]:
    """All links: (first, copies) of equal lines and (a, b) of different lines within ``edits``.

    A line is named by its first place (doc_id, line_no, tag), tag being a short
    hash that tells apart rows which share a doc_id.  In a link a < b.
    """
    lines = lines_of(docs).where(F.col("line").rlike(WORD))
    place = F.struct("doc_id", "line_no", F.hash("line").alias("tag"))
    keyed = with_keys(lines, edits).select(F.unhex(F.md5("line")).alias("same_line"), place.alias("place"), "keys")
    # numbered once they are grouped; the number is stored with the line
    distinct = staged(keyed.groupBy("same_line").agg(
        F.min("place").alias("first"), F.count("*").alias("copies"), F.first("keys").alias("keys"))
        .withColumn("id", F.monotonically_increasing_id()), "lines")
    probes = _probes(edits)
    at = F.col("at")
    shared = sharing(distinct.select("id", F.posexplode("keys").alias("at", "key")).where("key is not null")
                     .select("key", "id", (at < sum(not k for k, _, _ in probes)).alias("same"),
                             at.isin([n for n, (k, _, s) in enumerate(probes) if not k and not s]).alias("owned")),
                     "shared")
    crowd = F.col("owners") > (MOST if edits <= EDITS else LAST)
    wanted = staged(shared.groupBy("id").agg(F.max(crowd).alias("crowded"))
                    .join(distinct.select("id", "first"), "id"), "wanted")
    texts = staged(looked_up(docs, wanted).withColumn("letters", letter_counts(F.col("line"))), "texts")
    met = meeting(shared.where(~crowd).join(texts.select("id", "letters"), "id"), edits)
    met = staged(met.union(crowded_pairs(texts.where("crowded"), edits)).distinct(), "met")
    pairs = (met.join(texts.select(F.col("id").alias("p"), F.col("first").alias("a"), F.col("line").alias("x")), "p")
             .join(texts.select(F.col("id").alias("q"), F.col("first").alias("b"), F.col("line").alias("y")), "q"))
    links = (pairs.where(all_letters_apart(F.col("x"), F.col("y")) <= 2 * edits)
             .where(within_edits(F.col("x"), F.col("y"), edits)))
    return distinct.select("same_line", "first", "copies"), staged(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "links")


def repeated_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """(doc_id, line_no, tag, copy, near, links) of the lines that repeat an earlier one.

    ``copy``: equal to an earlier line; ``near``: within ``edits`` of one that is
    different, by the first places of both.  ``links`` counts the different
    lines within ``edits``, also for lines that repeat none.
    """
    distinct, links = line_links(docs, edits)
    later = links.groupBy(F.col("b").alias("first")).agg(F.count("*").alias("before"))
    sooner = links.groupBy(F.col("a").alias("first")).agg(F.count("*").alias("after"))
    known = distinct.join(later, "first", "left").join(sooner, "first", "left").where(
        "copies > 1 or before > 0 or after > 0")
    known = staged(known.select("same_line", "first", (F.coalesce("before", F.lit(0)) > 0).alias("near"),
                                (F.coalesce("before", F.lit(0)) + F.coalesce("after", F.lit(0))).alias("links")),
                   "known")
    lines = lines_of(docs).where(F.col("line").rlike(WORD)).select(
        F.unhex(F.md5("line")).alias("same_line"),
        F.struct("doc_id", "line_no", F.hash("line").alias("tag")).alias("place"))
    return lines.join(known, "same_line").select("place.*", (F.col("place") > F.col("first")).alias("copy"),
                                                 "near", "links")


def line_code(number: Column, tag: Column) -> Column:
    """Line number and tag as one number."""
    return F.shiftleft(number.cast("long"), 32).bitwiseOR(tag.cast("long").bitwiseAND(F.lit((1 << 32) - 1)))


def line_report(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """Each row with the numbers of its repeats: all columns under ``row``, ``drop`` the codes of lines to take out.

    A line goes if an equal line, or one within ``edits`` of it, comes earlier
    by (doc_id, line number).  Blank lines stay.  Null texts have no lines;
    rows without doc_id come last.  Rows that share a doc_id share decisions by
    line number and line, so repeated rows lose the same lines.
    """
    found = repeated_lines(docs, edits).groupBy("doc_id").agg(
        F.collect_set(F.when(F.col("copy") | F.col("near"), line_code(F.col("line_no"), F.col("tag")))).alias("drop"),
        F.sum(F.col("copy").cast("long")).alias("n_copies"),
        F.sum((F.col("near") & ~F.col("copy")).cast("long")).alias("n_near"),
        F.sum("links").alias("n_links"))
    rows = docs.select(F.struct("*").alias("row")).withColumn(
        "_id", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(LAST)))
    return rows.join(found.withColumnRenamed("doc_id", "_id"), "_id", "left").drop("_id")


def kept_lines(text: Column, drop: Column) -> Column:
    """``text`` without the lines whose codes are in ``drop``; null stays null."""

    def left(lines: Column) -> Column:
        codes = F.array_except(F.transform(lines, lambda x, i: line_code(i, F.hash(x))), drop)
        return F.array_join(F.transform(codes, lambda c: F.get(lines, F.shiftright(c, 32).cast("int"))), "\n")

    return F.when(F.size(drop) > 0, F.transform(F.array(F.split(text, "\n")), left)[0]).otherwise(text)
