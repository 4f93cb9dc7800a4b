"""Packing by minimum bin slack over the multiset of remaining lengths.

Each document is cut into windows of the full capacity and one remainder.  All
that the packing needs to know of the remainders is how many there are of each
length, at most ``capacity`` numbers, so this histogram alone comes to the
driver.  There a window is opened with the longest remaining length, a bitset
subset-sum over the other lengths (with their counts) finds the filling closest
to capacity, backtracking gives how many of each length it takes, and the same
filling is repeated as often as the counts allow.  A filling repeated uses up
one of its lengths nearly, so there are at most some thousand fillings whatever
the input.  Pieces are numbered within their length, and the number says the
window and the place in it.

Cases: null or empty text is the end id alone; repeated rows are documents of
their own; equal lengths are told apart by their number; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import documents, numbered, staged, table
from gridmart.llm.tokens import byte_bpe

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = PIECES + ", sequence_id long, offset long"
_RANKS = 1 << 44


def _filling(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of ``lengths`` (descending) whose sum is closest to ``room`` from below."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in lengths:
        if length > room:
            continue
        left, chunk = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            take = min(chunk, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, chunk = left - take, chunk * 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return used


def fillings(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(repetitions, length -> how many) of the windows that take all pieces."""
    left, out = {n: c for n, c in counts.items() if c}, []
    while left:
        order = sorted(left, reverse=True)
        longest = order[0]
        left[longest] -= 1
        used = _filling(order, left, capacity - longest)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(left[n] // u for n, u in used.items())
        for n, u in used.items():
            left[n] -= u * times
            if not left[n]:
                del left[n]
        out.append((times, used))
    return out


def layout(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first number, first window, how many in a window, place), by length and number."""
    given, window, rows = dict.fromkeys(counts, 0), 0, []
    for times, used in fillings(counts, capacity):
        place = 0
        for length in sorted(used, reverse=True):
            rows.append((length, given[length], window, used[length], place))
            given[length] += used[length] * times
            place += length * used[length]
        window += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def cut(docs: DataFrame, capacity: int, json_path: str, ranks_path: str, pattern: str, end_id: int) -> DataFrame:
    """The pieces of all documents: full windows and a remainder each."""
    def pieces(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = byte_bpe(part["text"].to_pylist(), json_path, ranks_path, pattern)
                rows: list[tuple] = []
                for doc, own in zip(part["doc_id"].to_pylist(), ids, strict=True):
                    raw = np.array([*own, end_id], dtype="<u4")
                    rows.extend((doc, s, len(x), zlib.crc32(x.tobytes()), len(raw))
                                for s in range(0, len(raw), capacity) for x in (raw[s:s + capacity],))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return documents(docs).mapInArrow(pieces, PIECES)


def pack(docs: DataFrame, capacity: int, json_path: str, ranks_path: str, pattern: str, end_id: int = 0) -> DataFrame:
    """One row for each piece, with its window and its place there."""
    made = cut(docs, capacity, json_path, ranks_path, pattern, end_id)
    rows = staged(made.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # capacity rows at most
    plan = layout(counts, capacity)
    keys = plan[:, 0] * _RANKS + plan[:, 1]

    def place(batches):
        for batch in batches:
            length, number = (batch[c].to_numpy(zero_copy_only=False) for c in ("length", "_number"))
            mine = plan[np.searchsorted(keys, length * _RANKS + number, side="right") - 1]
            nth, slot = np.divmod(number - mine[:, 1], np.maximum(mine[:, 3], 1))
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")),
                 pa.array(mine[:, 2] + nth), pa.array(mine[:, 4] + slot * length)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return numbered(rows, "length", "_row", "_number").mapInArrow(place, PLACED)


def pack_1024(docs: DataFrame) -> DataFrame:
    """Packing with the production parameters."""
    path = public_tokenizers.path
    return pack(docs, 1024, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 1024 tokens."""
    return pack_1024(table(spark, sf_dir, "documents"))


QUERIES = {"op6_bin_slack": op6_bin_slack}
