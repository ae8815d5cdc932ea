"""Best-fit packing of token pieces into sequences, by bin completion.

A document is its token ids and an end id; only a document longer than a sequence is cut. Pieces are
dealt evenly into groups of a bounded number of tokens and rows, and each group is packed by one task:

* the incumbent is best-fit decreasing, or a dive that is better: sequences filled one by one around the
  largest piece, with the longest or the shortest pieces that waste least, or the shortest pieces by counts first;
* the search fills one sequence at a time: the largest piece left, with fillings of the rest around it.
  The first has the least waste of all, found in a bit set of the sums that the pieces left can reach,
  of the longest pieces that make that sum; up to ``CHOICES`` are tried, each without the longest piece of
  the one before, if that does not cover it piece by piece. A branch ends when the waste it has made
  cannot beat the incumbent, and the search ends when the incumbent meets the bound (tokens over capacity,
  rounded up) or after ``NODES`` fillings.

Sequences that stay emptier than an eighth are taken from all groups and packed again together, in far
fewer groups, so a group's remainder is not left over.

Scale: texts are read once and never shuffled; what is dealt and grouped is a few numbers per piece. A
task holds one group, whose size is a parameter.

Defined cases: a null or empty text is the end id alone, so every document has a piece; repeated rows
are packed each; an empty table gives no rows; a null ``doc_id`` stays null; other columns are left
aside. Texts are encoded whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailtide.llm.components import written
from retailtide.llm.texts import slices
from retailtide.llm.tokens import SLICE_BYTES, encoder

CAPACITY = 4096
END_ID = 1
GROUP_TOKENS = 8_000_000
GROUP_PIECES = 100_000
NODES = 10_000
#: Fillings tried per sequence.
CHOICES = 3

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, deal long"


def pieces(
    docs: DataFrame, path: str, spaced: bool = False, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """The pieces of every document with their length and checksum, and ``deal``, which deals them out."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, deal = encoder(path, spaced), TaskContext.get().partitionId()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES, keep=True):
                ids, counts = own.encode(part.column("text"))
                at = 0
                rows = []
                for doc_id, count in zip(part.column("doc_id").to_pylist(), counts.tolist()):
                    mine = np.append(ids[at : at + count], np.uint32(end_id)).astype("<u4")
                    at += count
                    for k, start in enumerate(range(0, len(mine), capacity)):
                        piece = mine[start : start + capacity]
                        rows.append((doc_id, k, start, len(piece), zlib.crc32(piece.tobytes()), deal))
                        deal += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*rows), _PIECE_TYPES)], _PIECE_NAMES
                )

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return texts.mapInArrow(cut, PIECE)


_PIECE_NAMES = [c.split()[0] for c in PIECE.split(", ")]
_PIECE_TYPES = [pa.int32() if c.endswith(" int") else pa.int64() for c in PIECE.split(", ")]


class _Lengths:
    """How many pieces of each length are left; the longest up to a limit is found in a bit set."""

    def __init__(self, lengths: list[int], capacity: int):
        self.left = [0] * (capacity + 1)
        self.bits = 0
        for length in lengths:
            self.add(length)

    def add(self, length: int) -> None:
        self.left[length] += 1
        self.bits |= 1 << length

    def take(self, length: int) -> None:
        self.left[length] -= 1
        if not self.left[length]:
            self.bits ^= 1 << length

    def longest(self, limit: int) -> int:
        """The longest piece left of at most ``limit`` tokens, or 0."""
        return max((self.bits & ((2 << limit) - 1)).bit_length() - 1, 0) if limit > 0 else 0

    def shortest(self, least: int) -> int:
        """The shortest piece left of at least ``least`` tokens, or 0."""
        fitting = self.bits >> least
        return least + (fitting & -fitting).bit_length() - 1 if fitting else 0


def _fullest(lengths: _Lengths, room: int, skip: int = 0, short: bool = False) -> list[int]:
    """The filling of a room with the least waste, of the longest (or shortest) pieces that reach it, without ``skip``.

    A bit set holds the sums that the pieces so far can reach; it is ended early by a sum without waste.
    """
    reached, steps = 1, []
    within, full = (2 << room) - 1, 1 << room
    length = lengths.shortest(1) if short else lengths.longest(room)
    while 0 < length <= room and not reached & full:
        copies = min(lengths.left[length], room // length) if length != skip else 0
        taken = 1
        while copies > 0:  # 1, 2, 4... copies and the rest make every number of them
            taken = min(taken, copies)
            more = (reached | reached << taken * length) & within
            if more != reached:
                steps.append((length, taken, reached))
                reached = more
            copies -= taken
            taken *= 2
        length = lengths.shortest(length + 1) if short else lengths.longest(length - 1)
    total = reached.bit_length() - 1
    filling: list[int] = []
    for length, taken, before in reversed(steps):
        if not before >> total & 1:
            filling += [length] * taken
            total -= taken * length
    return sorted(filling, reverse=True)


def _covers(wide: list[int], narrow: list[int]) -> bool:
    """Whether each piece of ``narrow`` has one of ``wide`` that is as long, so it is dominated."""
    pairs = zip(sorted(wide, reverse=True), sorted(narrow, reverse=True))
    return len(wide) >= len(narrow) and all(a >= b for a, b in pairs)


def _undominated(lengths: _Lengths, largest: int, capacity: int) -> list[list[int]]:
    """All sequences with the largest piece left that no other is as good as piece by piece, least waste first.

    They are as many as there are ways to fill the room, so this is for groups of a few pieces.
    """
    lengths.take(largest)
    kinds = [n for n in range(capacity, 0, -1) if lengths.left[n]]
    made: list[list[int]] = []

    def fill(at: int, room: int, filling: list[int]) -> None:
        if at == len(kinds):
            made.append(filling)
            return
        length = kinds[at]
        for copies in range(min(lengths.left[length], room // length), -1, -1):
            fill(at + 1, room - copies * length, filling + [length] * copies)

    fill(0, capacity - largest, [])
    lengths.add(largest)
    kept: list[list[int]] = []
    for filling in sorted(made, key=sum, reverse=True):
        if not any(_covers(better, filling) for better in kept):
            kept.append(filling)
    return [[largest, *filling] for filling in kept]


def _fillings(lengths: _Lengths, largest: int, capacity: int, choices: int | None) -> Iterator[list[int]]:
    """Sequences with the largest piece left, least waste first, made as they are asked for.

    Up to so many ``choices`` are made, or all undominated ones without a number. Each filling after the first does without the longest piece that the one before put beside ``largest``,
    and is left out if that one covers it. All pieces are left as they were whenever a filling is handed out.
    """
    if choices is None:
        yield from _undominated(lengths, largest, capacity)
        return
    before: list[int] | None = None
    skip = 0
    for _ in range(choices):
        lengths.take(largest)
        filling = _fullest(lengths, capacity - largest, skip)
        lengths.add(largest)
        if before is None or not _covers(before, filling):
            yield [largest, *filling]
            before = filling
        if not filling or filling[0] == skip:
            return
        skip = filling[0]


def best_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Each piece, the longest first, goes to the fullest sequence that has room for it."""
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    bits = 0
    made: list[list[int]] = []
    for length in sorted(lengths, reverse=True):
        fitting = bits >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            at = rooms[room].pop()
            if not rooms[room]:
                bits ^= 1 << room
        else:
            room, at = capacity, len(made)
            made.append([])
        made[at].append(length)
        if room > length:
            rooms[room - length].append(at)
            bits |= 1 << (room - length)
    return made


def _dive(lengths: list[int], capacity: int, short: bool) -> list[list[int]]:
    """Sequences filled one after another around the largest piece left, with the least waste each."""
    left = _Lengths(lengths, capacity)
    made = []
    while left.bits:
        largest = left.longest(capacity)
        left.take(largest)
        filling = _fullest(left, capacity - largest, short=short)
        for length in filling:
            left.take(length)
        made.append([largest, *filling])
    return made


def _by_count(lengths: list[int], capacity: int) -> list[list[int]]:
    """Sequences of as many pieces each as can be: the shortest that fill sequences of k pieces, then of k - 1..."""
    rest = np.sort(np.array(lengths, np.int64))
    made: list[list[int]] = []
    k = capacity // int(rest[0])
    while len(rest):
        k = max(min(k, capacity // int(rest[0])), 1)
        sums = np.cumsum(rest)[k - 1 :: k]
        fit = np.flatnonzero(sums <= capacity * np.arange(1, len(sums) + 1))
        most = k * (int(fit[-1]) + 1) if len(fit) else 0
        if k == 1 or len(rest) < k:
            most = len(rest)
        made += _dive(rest[:most].tolist(), capacity, False)
        rest, k = rest[most:], k - 1
    loose = [s for s in made if (capacity - sum(s)) * 8 > capacity]
    again = min(
        (_dive([x for s in loose for x in s], capacity, short) for short in (False, True)), key=len, default=[]
    )
    if len(again) < len(loose):
        made = [s for s in made if (capacity - sum(s)) * 8 <= capacity] + again
    return made


def complete_bins(
    lengths: list[int], capacity: int = CAPACITY, nodes: int | None = NODES, choices: int | None = CHOICES
) -> list[list[int]]:
    """Sequences of lengths, as few as the search finds; as few as can be with neither ``nodes`` nor ``choices``."""
    incumbent = best_fit_decreasing(lengths, capacity)
    total = sum(lengths)
    bound = -(-total // capacity)
    if len(incumbent) == bound or not lengths:
        return incumbent
    dives = (
        lambda: _dive(lengths, capacity, False),
        lambda: _dive(lengths, capacity, True),
        lambda: _by_count(lengths, capacity),
    )
    for dive in dives:
        incumbent = min(incumbent, dive(), key=len)
        if len(incumbent) == bound:
            return incumbent
    left = _Lengths(lengths, capacity)
    path: list[list[int]] = []  # sequences of the branch
    options: list[Iterator[list[int]]] = []  # fillings still to try at each of them
    waste = 0
    while nodes is None or nodes > 0:
        if left.bits:
            options.append(_fillings(left, left.longest(capacity), capacity, choices))
        else:
            if len(path) < len(incumbent):
                incumbent = [list(s) for s in path]
            if len(incumbent) == bound:
                return incumbent
            options.append(iter(()))
        may_waste = (len(incumbent) - 1) * capacity - total
        while (filling := next(options[-1], None)) is None or waste + capacity - sum(filling) > may_waste:
            options.pop()  # go back to where another filling is left
            if not options:
                return incumbent
            last = path.pop()
            for length in last:
                left.add(length)
            waste -= capacity - sum(last)
        for length in filling:
            left.take(length)
        path.append(filling)
        waste += capacity - sum(filling)
        nodes = None if nodes is None else nodes - 1
    return incumbent


def _packed(capacity: int, nodes: int | None, choices: int | None):
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "deal"], kind="stable").reset_index(drop=True)
        lengths = group["length"].to_numpy()
        places: dict[int, int] = dict(zip(*np.unique(lengths, return_index=True)))
        sequence, offset = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
        base = int(group["sequence_id"].iloc[0])
        for number, filled in enumerate(complete_bins(lengths.tolist(), capacity, nodes, choices)):
            at = 0
            for length in filled:
                row = places[length]
                places[length] += 1
                sequence[row], offset[row] = base + number, at
                at += length
        used = pd.Series(lengths).groupby(sequence).transform("sum").to_numpy()
        return group.assign(sequence_id=sequence, offset=offset, room=capacity - used)

    return pack


def _level(
    rows: DataFrame, groups: int, first: int, capacity: int, nodes: int | None, choices: int | None
) -> DataFrame:
    """Pack rows in so many groups; the sequences of a group are numbered from its own base."""
    group = F.pmod(F.col("deal"), F.lit(groups))
    dealt = rows.withColumn("pack_group", group).withColumn(
        "sequence_id", (F.col("pack_group") + F.lit(first)) * F.lit(1 << 24)
    )
    schema = f"{PIECE}, pack_group long, sequence_id long, offset long, room long"
    return dealt.groupBy("pack_group").applyInPandas(_packed(capacity, nodes, choices), schema)


def pack(
    made: DataFrame, capacity: int = CAPACITY, nodes: int | None = NODES, choices: int | None = CHOICES
) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``made`` is written first, as dealing must not change.

    ``nodes`` and ``choices`` bound the search in a group. Without them (None) a group's sequences are as few
    as can be; the time for that grows without bound with the group, so it is for a few dozen pieces.
    """
    made = written(made, "pieces")
    size = made.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("tokens"), F.count("*").alias("rows")).first()
    groups = max(1, -(-size["tokens"] // GROUP_TOKENS), -(-size["rows"] // GROUP_PIECES))
    packed = written(_level(made, groups, 0, capacity, nodes, choices), "packed")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    if groups == 1:
        return packed.select(columns)
    open_rows = packed.filter(F.col("room") * 8 > capacity)
    loose = open_rows.select(*PIECE_COLUMNS)
    again = open_rows.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("tokens"), F.count("*").alias("rows")).first()
    fewer = max(1, -(-again["tokens"] // GROUP_TOKENS), -(-again["rows"] // GROUP_PIECES))
    full = packed.filter(F.col("room") * 8 <= capacity)
    return full.select(columns).union(_level(loose, fewer, groups, capacity, nodes, choices).select(columns))


PIECE_COLUMNS = _PIECE_NAMES
