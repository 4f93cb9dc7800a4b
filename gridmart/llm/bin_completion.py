"""Best-fit packing by bin completion branch and bound.

A text that fits a sequence is one piece; a longer one is cut into pieces of the
full capacity, behind a first piece with the rest.  As in any packing, only the
number of pieces of each length matters, at most ``capacity`` numbers, so this
histogram alone comes to the driver and the work there does not depend on the
number of documents.

The search (``Search``) places the longest piece that is left and enumerates the
undominated fillings around it, nearest to capacity first: a filling is dominated
if a piece left out could take the place of pieces in it that are together no longer, and
still fit.  A filling is repeated as often as the counts allow, fewer times being
further branches.  Beforehand and at every node best-fit decreasing packs what is left;
the best such packing so far is the incumbent.  A branch ends once the bins
used and the bound for the rest (the wasted room that pieces above
each length make unavoidable) reach the incumbent's number, and the search when the
incumbent meets the root's bound, or after ``NODES`` nodes, so that its
result is the least number of sequences wherever the search was completed
and never worse than best fit.

Best fit works on groups of equal bins, so a million equal pieces are one step.
Pieces are numbered within their length over the cluster, and a piece's number
gives its sequence and its place there.

Cases: null or empty text is the end id alone; repeated rows are documents of
their own; equal lengths are told apart by their number; a null id is kept; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import documents, numbered, slices, staged, table
from gridmart.llm.tokens import byte_bpe

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"
#: Nodes of the search after which the incumbent is taken.
NODES = 3000
#: Steps of the enumeration of fillings that one node may take.
STEPS = 20000
_RANKS = 1 << 44

#: (repetitions, length -> how many) of equal sequences.
Filling = tuple[int, dict[int, int]]


def best_fit(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Best-fit decreasing: each piece, longest first, goes to the fullest sequence that has room.

    Equal sequences are one group: pieces of a length fill the sequences of a
    group one after the other, each until it has no room for another, which is what
    best fit does piece by piece.
    """
    rooms: list[int] = []
    bins: dict[int, list[list]] = defaultdict(list)  # room -> [how many, pieces in it]

    def add(room: int, often: int, inside: tuple) -> None:
        if not bins[room]:
            bisect.insort(rooms, room)
        bins[room].append([often, inside])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            room = rooms[at] if at < len(rooms) else capacity
            fits = room // length
            if at < len(rooms):
                often, inside = bins[room].pop()
                if not bins[room]:
                    rooms.pop(at)
            else:
                often, inside = max(1, -(-left // fits)), ()
            full = min(often, left // fits)
            if full:
                add(room - fits * length, full, (*inside, (length, fits)))
                left -= full * fits
                often -= full
            if often and left:  # fewer pieces than one more sequence takes
                add(room - left * length, 1, (*inside, (length, left)))
                left, often = 0, often - 1
            if often and inside:
                add(room, often, inside)
    return [(often, dict(inside)) for groups in bins.values() for often, inside in groups]


def bins_of(packing: list[Filling]) -> int:
    return sum(times for times, _ in packing)


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """A bound from below on the number of sequences.

    For each k up to half the capacity: pieces longer than ``capacity - k`` stand alone;
    those above half need a sequence each, which only pieces from k on may share;
    what of the latter finds no room there needs further ones.
    """
    often = np.zeros(capacity + 2, dtype=np.int64)
    for length, n in counts.items():
        often[length] = n
    sums = np.concatenate([[0], np.cumsum(often * np.arange(capacity + 2))])
    many = np.concatenate([[0], np.cumsum(often)])
    half = capacity // 2
    best = -(-int(sums[-1]) // capacity)
    for k in range(0, half + 1):
        alone = int(many[-1] - many[capacity - k + 1])  # longer than capacity - k
        large = int(many[capacity - k + 1] - many[half + 1])  # above half, up to capacity - k
        room = large * capacity - int(sums[capacity - k + 1] - sums[half + 1])
        small = int(sums[half + 1] - sums[k])
        best = max(best, alone + large + max(0, -(-(small - room) // capacity)))
    return best


def _dominated(filling: dict[int, int], left: dict[int, int], others: list[int], slack: int) -> bool:
    """Whether a piece left out could replace pieces of ``filling`` that are together no longer.

    ``others`` are the lengths of ``left`` in rising order; ``slack`` is the room not used.
    A piece that simply fits into that room replaces nothing, which counts too.
    """
    for length in others:
        if length > slack:
            break
        if left[length] > filling.get(length, 0):
            return True
    sums = 1
    for length, n in filling.items():
        chunk = 1
        while n:
            take = min(chunk, n)
            sums |= sums << (length * take)
            n, chunk = n - take, chunk * 2
    own = set(filling)
    bits = sums >> 1
    total = 1
    while bits:
        step = (bits & -bits).bit_length()
        total, bits = total + step - 1, bits >> step
        # A piece from ``total`` to ``total + slack``: it takes the place of pieces that long.
        at = bisect.bisect_left(others, total)
        while at < len(others) and others[at] <= total + slack:
            length = others[at]
            if left[length] > filling.get(length, 0) and not (length == total and length in own):
                return True
            at += 1
        total += 1
    return False


class OutOfSteps(Exception):
    """An enumeration was ended before it was complete."""


def completions(left: dict[int, int], room: int, least: int, steps: int = STEPS):
    """Undominated fillings of ``room`` by the pieces ``left``, fullest first, with ``least`` at least.

    Sums that cannot be reached are never tried: for each length it is known,
    as a bitset, which sums the shorter ones can make.  After ``steps`` steps it
    raises ``OutOfSteps``.
    """
    lengths = sorted((n for n in left if n <= room), reverse=True)
    rising = lengths[::-1]
    mask, reach = (1 << (room + 1)) - 1, [1]
    for length in rising:
        sums, n, chunk = reach[-1], min(left[length], room // length), 1
        while n:
            take = min(chunk, n)
            sums |= (sums << (length * take)) & mask
            n, chunk = n - take, chunk * 2
        reach.append(sums)
    reach.reverse()  # reach[i]: sums of lengths[i:]
    budget = steps
    for total in range(room, max(least, 0) - 1, -1):
        if not reach[0] >> total & 1:
            continue
        stack: list[tuple[int, int, tuple]] = [(0, total, ())]
        while stack:
            budget -= 1
            if budget < 0:
                raise OutOfSteps
            at, rest, inside = stack.pop()
            if not rest:
                filling = dict(inside)
                if not _dominated(filling, left, rising, room - total):
                    yield filling
                continue
            # Of the next length as many as possible come last on the stack, so they are tried first.
            while at < len(lengths) and lengths[at] > rest:
                at += 1
            if at == len(lengths) or not reach[at] >> rest & 1:
                continue
            length = lengths[at]
            for n in range(0, min(left[length], rest // length) + 1):
                after = rest - n * length
                if reach[at + 1] >> after & 1:
                    stack.append((at + 1, after, (*inside, (length, n)) if n else inside))


class Search:
    """Bin completion over a histogram of lengths; ``packing`` is the incumbent."""

    def __init__(self, counts: dict[int, int], capacity: int, nodes: int = NODES):
        self.capacity, self.nodes = capacity, nodes
        self.counts = {n: c for n, c in counts.items() if c}
        self.bound = least_bins(self.counts, capacity)
        self.packing = best_fit(self.counts, capacity)
        self.bins = bins_of(self.packing)
        self.visited = 0
        #: Whether the incumbent is known to be the least: every branch was ended by a bound.
        self.proven = self.bins == self.bound
        if not self.proven:
            self._run()

    def _children(self, left: dict[int, int], used: int):
        """(filling, repetitions) around the longest piece, best first."""
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        if not rest[longest]:
            del rest[longest]
        total = sum(n * c for n, c in left.items())
        # One bin fewer than the incumbent: so much room may stay empty in all.
        spare = (self.bins - 1 - used) * self.capacity - total
        if spare < 0:
            return
        room = self.capacity - longest
        for filling in completions(rest, room, room - spare):
            whole = dict(filling)
            whole[longest] = whole.get(longest, 0) + 1
            waste = self.capacity - sum(n * c for n, c in whole.items())
            most = min(left[n] // c for n, c in whole.items())
            times = most if not waste else min(most, max(1, spare // waste))
            while times:
                yield whole, times
                times //= 2

    def _run(self) -> None:
        left, used, chosen = dict(self.counts), 0, []
        stack = [self._children(left, used)]
        complete = True
        while stack and self.bins > self.bound:
            if self.visited >= self.nodes:
                complete = False
                break
            try:
                step = next(stack[-1], None)
            except OutOfSteps:
                complete, step = False, None
            if step is None:
                stack.pop()
                if chosen:
                    filling, times = chosen.pop()
                    used -= times
                    for n, c in filling.items():
                        left[n] = left.get(n, 0) + c * times
                continue
            self.visited += 1
            filling, times = step
            if used + times >= self.bins:
                continue
            after = dict(left)
            for n, c in filling.items():
                after[n] -= c * times
                if not after[n]:
                    del after[n]
            if used + times + least_bins(after, self.capacity) >= self.bins:
                continue
            rest = best_fit(after, self.capacity)
            made = used + times + bins_of(rest)
            if made < self.bins:
                self.bins = made
                self.packing = [(t, f) for f, t in (*chosen, (filling, times))] + rest
            if after:
                left, used = after, used + times
                chosen.append((filling, times))
                stack.append(self._children(left, used))
        self.proven = complete


def layout(packing: list[Filling]) -> np.ndarray:
    """Rows (length, first number, first sequence, how many in a sequence, place), by length and number."""
    given: dict[int, int] = defaultdict(int)
    first, rows = 0, []
    for times, inside in packing:
        place = 0
        for length in sorted(inside, reverse=True):
            rows.append((length, given[length], first, inside[length], place))
            given[length] += inside[length] * times
            place += length * inside[length]
        first += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def cut(docs: DataFrame, capacity: int, json_path: str, ranks_path: str, pattern: str, end_id: int) -> DataFrame:
    """The pieces of all documents; of a document longer than ``capacity`` the first takes the rest."""
    def pieces(batches):
        for part in slices(batches, 256):
            ids = byte_bpe(part["text"].to_pylist(), json_path, ranks_path, pattern)
            rows: list[tuple] = []
            for doc, own in zip(part["doc_id"].to_pylist(), ids, strict=True):
                raw = np.array([*own, end_id], dtype="<u4")
                first = len(raw) % capacity or capacity
                starts = [0, *range(first, len(raw), capacity)]
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(raw)], strict=True)):
                    rows.append((doc, k, a, b - a, zlib.crc32(raw[a:b].tobytes())))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if k == 1 else pa.int64()) for k, c in enumerate(zip(*rows, strict=True))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return documents(docs).mapInArrow(pieces, PIECES)


def pack(docs: DataFrame, capacity: int, json_path: str, ranks_path: str, pattern: str, end_id: int = 0,
         nodes: int = NODES) -> DataFrame:
    """One row for each piece, with its sequence and its place there."""
    made = cut(docs, capacity, json_path, ranks_path, pattern, end_id)
    rows = staged(made.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # capacity rows at most
    plan = layout(Search(counts, capacity, nodes).packing)
    keys = plan[:, 0] * _RANKS + plan[:, 1]
    names = [c.split()[0] for c in PIECES.split(", ")]

    def place(batches):
        for batch in batches:
            length, number = (batch[c].to_numpy(zero_copy_only=False) for c in ("length", "_number"))
            mine = plan[np.searchsorted(keys, length * _RANKS + number, side="right") - 1]
            nth, slot = np.divmod(number - mine[:, 1], np.maximum(mine[:, 3], 1))
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(mine[:, 2] + nth), pa.array(mine[:, 4] + slot * length)],
                names=[*names, "sequence_id", "offset"])

    return numbered(rows, "length", "_row", "_number").mapInArrow(place, PLACED)


def op13_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    path = public_tokenizers.path
    return pack(table(spark, sf_dir, "documents"), 2048, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"),
                public_tokenizers.PATTERN)


QUERIES = {"op13_bin_completion": op13_bin_completion}
