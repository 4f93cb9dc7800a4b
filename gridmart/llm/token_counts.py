"""Token counts from piece counts of distinct pre-tokens.

A byte-level BPE never merges across pre-tokens, so a text has as many tokens
as its pre-tokens have pieces.  Pre-tokens are counted by document, each
distinct pre-token of the corpus goes through the tokenizer once, and the piece
counts come back to the documents by a join (see ``block_dictionary``); no
document's ids are ever made.

A special string inside a text is one token of its own, as the library handles
it by default, so texts are split there first.

Cases: null or empty text has no tokens; a null id is kept; repeated rows are
counted each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession

from gridmart.llm.block_dictionary import ENCODED, Block, as_batch, grouped, joined
from gridmart.llm.common import documents, packed, staged, table, tasks, unpacked
from gridmart.llm.tokens import SPECIAL, library

COUNTED = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


@lru_cache(maxsize=1)
def _splitter(pattern: str):
    import regex
    return regex.compile(pattern)


def pre_tokens(text: str, pattern: str) -> list[str]:
    """The pre-tokens of a text, a special string being one of its own."""
    find = _splitter(pattern).findall
    if SPECIAL not in text:
        return find(text)
    first, *rest = text.split(SPECIAL)
    return find(first) + [x for part in rest for x in (SPECIAL, *find(part))]


def _dump(words: list[bytes]) -> bytes:
    lengths = packed(np.array([len(w) for w in words], dtype=np.int32))
    return len(lengths).to_bytes(4, "little") + lengths + zstandard.compress(b"".join(words), 3)


def _load(data: bytes) -> list[bytes]:
    n = int.from_bytes(data[:4], "little")
    ends = np.cumsum(unpacked(data[4:4 + n], np.int32)).tolist()
    joint = zstandard.decompress(data[4 + n:])
    return [joint[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _encode(pattern: str, buckets: int):
    def run(batches):
        for number, part in grouped(batches):
            seen: dict[str, int] = {}
            places, bounds, sizes = [], [0], []
            for at in range(0, part.num_rows, 500):
                for text in part["text"].slice(at, 500).to_pylist():
                    own = pre_tokens(text, pattern)
                    places.append(np.fromiter((seen.setdefault(x, len(seen)) for x in own), np.uint32, len(own)))
                    bounds.append(bounds[-1] + len(own))
                    sizes.append(len(text.encode()))
            words = [x.encode() for x in seen]
            bucket = np.array([xxhash.xxh3_64_intdigest(w) % buckets for w in words], dtype=np.int64)
            block = Block(number)
            rows = [block.documents(part["doc_id"].to_pylist(), np.concatenate(places), np.array(bounds),
                                    [np.array(sizes, dtype=np.int64)])]
            rows.extend(block.dictionary(bucket, lambda at: _dump([words[i] for i in at]), None))
            yield as_batch(rows)
    return run


def _pieces(path: str):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known: dict[bytes, int] = {}
        found = []
        for data in rows["tokens"]:
            words = _load(data)
            new = [w for w in words if w not in known]
            for at in range(0, len(new), 5000):
                part = new[at:at + 5000]
                encoded = library(path).encode_batch([w.decode() for w in part], add_special_tokens=False)
                known.update((w, len(e)) for w, e in zip(part, encoded, strict=True))
            found.append(packed(np.array([known[w] for w in words], dtype=np.int64)))
        return pd.DataFrame({"block": rows["block"], "places": rows["places"], "found": found})
    return run


def count_tokens(docs: DataFrame, tokenizer: str, pattern: str, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether that is over ``limit``, for each document."""
    def per_document(ids, owner, often, pieces, columns):
        tokens = np.bincount(owner, weights=often * pieces, minlength=len(ids)).astype(np.int64)
        return pd.DataFrame({"doc_id": ids, "n_bytes": columns[0], "n_tokens": tokens, "over_limit": tokens > limit})

    encoded = staged(documents(docs).mapInArrow(_encode(pattern, 2 * tasks(docs)), ENCODED), "encoded")
    values = (encoded.where("bucket >= 0").select("block", "bucket", "places", "tokens").groupBy("bucket")
              .applyInPandas(_pieces(tokenizer), "block long, places binary, found binary"))
    return joined(encoded, values, per_document, COUNTED)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents by the byte-level BPE of 50,257 ids."""
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.PATTERN, 512)


QUERIES = {"op5_token_counts": op5_token_counts}
