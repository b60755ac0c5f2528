"""Reading vocabulary files; they are never trained and never copied."""

from __future__ import annotations

import base64
import sys
import types

# Fixed value: the pattern that splits text before the merges of the byte-level rank files.
BYTE_LEVEL = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
#: Where vocabulary files lie unless a caller says otherwise.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def read(path: str) -> bytes:
    """The bytes of a vocabulary file (at most a few MB), read on the driver."""
    with open(path, "rb") as file:
        return file.read()


def once_per_worker(name: str, make):
    """Build something costly once per Python worker process, not once per task."""
    store = sys.modules.setdefault("_wharf_llm_worker", types.ModuleType("_wharf_llm_worker"))
    if name not in store.__dict__:
        store.__dict__[name] = make()
    return store.__dict__[name]


def byte_level(ranks: bytes):
    """A tiktoken encoding of a rank file."""
    import tiktoken

    pairs = (line.split() for line in ranks.splitlines() if line)
    table = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL, mergeable_ranks=table, special_tokens={})
