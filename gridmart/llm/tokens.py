"""Loading of the public tokenizers inside tasks; paths are parameters.

``byte_bpe`` gives the ids of the ``tokenizers`` library for a byte-level BPE
file.  The rank file of the same vocabulary is read by the faster ``tiktoken``;
a text that holds a special string goes to ``tokenizers`` itself, which is the
library whose result counts.
"""

from __future__ import annotations

import base64
from functools import lru_cache

#: Fixed value: the special string of the byte-level BPE file.
SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=2)
def library(path: str):
    """The ``tokenizers`` object of a .json file, once for a Python worker."""
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def ranked(path: str, pattern: str):
    """The ``tiktoken`` object of a rank file, once for a Python worker."""
    import tiktoken
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def byte_bpe(texts: list[str], json_path: str, ranks_path: str, pattern: str) -> list[list[int]]:
    """Token ids of each text, without added special tokens."""
    fast = ranked(ranks_path, pattern)
    return [library(json_path).encode(text, add_special_tokens=False).ids if SPECIAL in text
            else fast.encode_ordinary(text) for text in texts]
