"""Byte-level BPE in tasks.

``public_tokenizers`` gives one vocabulary in two files.  The rank file with ``tiktoken`` yields the
same ids as the ``tokenizers`` file (tests compare them) at about five times the speed.  That file's
added token ``<|endoftext|>`` follows the ranks; with ``special`` its string in a text is this token, as
``tokenizers`` has it by default, and without it is ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache, partial

import numpy as np
import public_tokenizers
import tiktoken

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: The added token; its id is the one after the ranks.
END_OF_TEXT = "<|endoftext|>"


@lru_cache(maxsize=2)
def encoding(path: str = RANKS) -> tiktoken.Encoding:
    """The encoding of a rank file; built once per Python worker."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: max(ranks.values()) + 1})


def encoder(path: str = RANKS, special: bool = False) -> Callable[[str], list[int]]:
    """Ids of a text."""
    return partial(encoding(path).encode, allowed_special="all") if special else encoding(path).encode_ordinary


@lru_cache(maxsize=2)
def token_bytes(path: str = RANKS) -> np.ndarray:
    """Bytes of each id, the added token's too."""
    with open(path, "rb") as f:
        ranks = {int(b): len(base64.b64decode(a)) for a, b in map(bytes.split, f)}
    ranks[max(ranks) + 1] = len(END_OF_TEXT)
    out = np.zeros(max(ranks) + 1, np.int64)
    out[list(ranks)] = list(ranks.values())
    return out
