"""Token ids of texts by a byte-level BPE vocabulary file."""

from __future__ import annotations

import base64
import json
import re
import sys
from array import array
from collections.abc import Callable
from types import SimpleNamespace

# The rank file's library fails near 1,000,000 white-space characters in a row; Python's white space includes its own.
LONG_SPACE = 100_000
_LONG_SPACE = re.compile(rf"(?<!\s)\s{{{LONG_SPACE}}}")


def vocabulary(json_path: str | None = None, ranks_path: str | None = None) -> SimpleNamespace:
    """Where the vocabulary lies: the ``tokenizers`` file, the same vocabulary as ranks, its split
    pattern and the strings of its special tokens."""
    import public_tokenizers

    where = json_path or public_tokenizers.path("byte_bpe_50k.json")
    with open(where, encoding="utf-8") as file:
        special = [t["content"] for t in json.load(file).get("added_tokens", [])]
    return SimpleNamespace(json=where, ranks=ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"),
                           pattern=public_tokenizers.PATTERN, special=special)


def encoder(where: SimpleNamespace) -> Callable[[str], list[int]]:
    """A function from a text to its ids, as ``tokenizers`` gives them without added special tokens.

    The rank file holds the same vocabulary and merges, and its library encodes several
    times faster; a text that holds a special token's string, or ``LONG_SPACE`` white-space
    characters in a row, is left to ``tokenizers``.
    A worker process builds the encoding once and finds it again in the library's registry.
    """
    import tiktoken
    from tiktoken.registry import ENCODINGS

    name = f"{where.ranks}|{where.pattern}"
    if name not in ENCODINGS:
        with open(where.ranks, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        ENCODINGS[name] = tiktoken.Encoding(name, pat_str=where.pattern, mergeable_ranks=ranks, special_tokens={})
    fast = tiktoken.get_encoding(name)
    whole = []

    def encode(text: str) -> list[int]:
        if any(s in text for s in where.special) or len(text) >= LONG_SPACE and _LONG_SPACE.search(text):
            if not whole:
                from tokenizers import Tokenizer

                whole.append(Tokenizer.from_file(where.json))
            return whole[0].encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def pack_ids(ids: list[int], kind: str) -> bytes:
    """The ids as little-endian unsigned numbers of ``kind`` (``<u2`` or ``<u4``)."""
    out = array(next(c for c in "HIL" if array(c).itemsize == int(kind[2])), ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()
