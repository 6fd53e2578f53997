"""Token ids of whole texts by the files of public tokenizers, for operators that only need the ids.

A byte-level file whose ids follow its merges says the same as a table of ranks, which tiktoken encodes several times as
fast as the tokenizers library; any other file goes through the library itself.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import tiktoken

from tenderline.llm.bpe import BYTE_LEVEL_PATTERN, byte_letters


def token_bytes(vocab: dict[str, int]) -> dict[bytes, int]:
    """The bytes that the letters of byte-level tokens stand for."""
    number = {c: b for b, c in enumerate(byte_letters())}
    return {bytes(number[c] for c in token): i for token, i in vocab.items() if all(c in number for c in token)}


class ByteLevel:
    """Ids of a byte-level file (its text, as JSON). ``specials``: whether their strings in a text are their ids."""

    def __init__(self, spec: str, specials: bool):
        told = json.loads(spec)
        model = told["model"]
        special = {t["content"]: t["id"] for t in told.get("added_tokens") or []}
        self.ranks = {b: i for b, i in token_bytes(model["vocab"]).items() if i not in special.values()}
        made = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in model["merges"]]
        ids = [model["vocab"][t] for t in made]
        steps = [told["pre_tokenizer"], told.get("normalizer")]
        plain = steps[0]["type"] == "ByteLevel" and not steps[0].get("add_prefix_space") and steps[1] is None
        if not plain or ids != sorted(ids) or len(self.ranks) != len(ids) + 256:
            raise ValueError("not a byte-level file whose ids follow its merges")
        self.coder = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=self.ranks, special_tokens=special)
        self.allowed = "all" if specials else set()

    def encode(self, text: str) -> np.ndarray:
        return self.coder.encode_to_numpy(text, allowed_special=self.allowed, disallowed_special=())


@lru_cache(maxsize=4)
def byte_level(spec: str, specials: bool) -> ByteLevel:
    return ByteLevel(spec, specials)
