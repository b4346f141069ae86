"""Token ids of a public byte-level vocabulary."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import public_tokenizers

#: White space that is too long for the faster engine.
LONG_SPACE = re.compile(r"\s{1000}")


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Callable[[str], list[int]]:
    """Text to ids by the vocabulary of that file name; no special token is added, but one that a text spells out is one id."""
    path = public_tokenizers.path(vocabulary)
    if vocabulary.endswith(".json"):
        return _byte_level(path)
    raise ValueError(f"no byte-level vocabulary: {vocabulary}")


def _byte_level(path: str) -> Callable[[str], list[int]]:
    """The ids that ``tokenizers`` gives for this file, from a faster engine for the same merges.

    In a byte-level vocabulary an id is also the rank of its merge, so the
    tokens of the file, written in its alphabet of printable stand-ins for
    bytes, are all that the other engine needs.

    The other engine's pattern matching gives up on very long white space, so
    texts that hold some go to ``tokenizers`` itself.
    """
    import json

    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        description = json.load(file)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}
    special = {token["content"]: token["id"] for token in description["added_tokens"]}
    ranks = {
        bytes(byte_of[c] for c in token): i
        for token, i in description["model"]["vocab"].items()
        if token not in special and all(c in byte_of for c in token)
    }
    engine = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    plain = Tokenizer.from_file(path)

    def encode(text: str) -> list[int]:
        if LONG_SPACE.search(text):
            return plain.encode(text, add_special_tokens=False).ids
        return engine.encode(text, allowed_special="all")

    return encode
