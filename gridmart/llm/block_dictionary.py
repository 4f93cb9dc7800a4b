"""Corpus-wide values of tokens, joined to documents block by block.

A per-document join on tokens would shuffle a row for each distinct token of
each document.  Here a task encodes its documents in blocks: the distinct
tokens of a block once, and each document as (place in the block's dictionary,
how often).  The dictionaries go, split by token bucket, to the tasks that hold
one bucket of all tokens; these give each token its value, computed once, and
send the values back to the blocks, where documents are summed.  What is
shuffled is a dictionary for each block and compressed place lists, whatever
the most frequent token is.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from gridmart.llm.common import packed, unpacked

#: UTF-8 bytes of text in a block at which it is closed.
BLOCK_BYTES = 24 << 20
ENCODED = "block long, bucket int, places binary, tokens binary, extra binary, docs array<binary>"


class Block:
    """Documents and dictionary of one block, as rows of the schema ENCODED."""

    def __init__(self, number: int):
        self.number = number

    def documents(self, ids: list, places: np.ndarray, bounds: np.ndarray, columns: list[np.ndarray]) -> tuple:
        """One row for all documents; ``places`` are dictionary places of their tokens in a row."""
        owner = np.repeat(np.arange(len(ids), dtype=np.uint64), np.diff(bounds))
        pairs, often = np.unique((owner << np.uint64(32)) | places.astype(np.uint64), return_counts=True)
        per_doc = np.bincount((pairs >> np.uint64(32)).astype(np.int64), minlength=len(ids))
        place = (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        known = np.array([i is not None for i in ids], dtype=np.int8)
        arrays = [np.array([i or 0 for i in ids], dtype=np.int64), known, per_doc.astype(np.int64),
                  np.diff(place, prepend=0).astype(np.int32), often.astype(np.int32), *columns]
        return self.number, -1, None, None, None, [packed(a) for a in arrays]

    def dictionary(self, bucket_of: np.ndarray, dump: Callable[[np.ndarray], bytes], extra: np.ndarray | None):
        """A row for each bucket that holds tokens of this block."""
        order = np.argsort(bucket_of, kind="stable")
        names, starts = np.unique(bucket_of[order], return_index=True)
        for name, place in zip(names.tolist(), np.split(order, starts[1:]), strict=True):
            yield (self.number, name, packed(np.diff(place, prepend=0).astype(np.int32)), dump(place),
                   None if extra is None else packed(extra[place]), None)


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of the schema ENCODED as an Arrow batch."""
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary())]
    names = ["block", "bucket", "places", "tokens", "extra", "docs"]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


def grouped(batches, limit: int = BLOCK_BYTES):
    """(block number, tables) of about ``limit`` bytes of text; numbers are unique over all tasks."""
    number, kept, size = TaskContext.get().partitionId() << 24, [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            kept.append(part)
            size += pa.compute.sum(pa.compute.binary_length(part["text"])).as_py() or 0
            if size >= limit:
                yield number, pa.Table.from_batches(kept)
                number, kept, size = number + 1, [], 0
    if kept:
        yield number, pa.Table.from_batches(kept)


def joined(encoded: DataFrame, values: DataFrame, per_document, schema: str) -> DataFrame:
    """``per_document(ids, owner, often, value, columns)`` of each block, as rows of ``schema``.

    ``values`` has (block, places, found): packed 64-bit values of the places.
    """
    def block(docs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        parts = []
        value = np.zeros(0, dtype=np.int64)
        if len(found):
            places = [np.cumsum(unpacked(x, np.int32)) for x in found["places"]]
            value = np.zeros(1 + max(int(p[-1]) for p in places), dtype=np.int64)
            for place, mine in zip(places, found["found"], strict=True):
                value[place] = unpacked(mine, np.int64)
        for arrays in docs["docs"]:
            ids, known, per_doc, steps, often = (unpacked(x, t) for x, t in zip(
                arrays[:5], [np.int64, np.int8, np.int64, np.int32, np.int32], strict=True))
            owner = np.repeat(np.arange(len(ids)), per_doc)
            place = np.cumsum(steps)
            parts.append(per_document(pd.Series(pd.arrays.IntegerArray(ids, known == 0)), owner, often,
                                      value[place] if len(place) else value, [unpacked(x, np.int64) for x in arrays[5:]]))
        return pd.concat(parts) if parts else pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])

    left = encoded.where("bucket < 0").select("block", "docs").groupBy("block")
    return left.cogroup(values.groupBy("block")).applyInPandas(block, schema)
