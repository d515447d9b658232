"""Token ids of a public byte-level BPE vocabulary.

The ids are those of the ``tokenizers`` library for the given file, without added special
tokens. Texts are encoded by ``tiktoken`` over the same vocabulary and the same
splitting pattern, several times as fast and with the same ids (compared in the tests
over whole tables, every code point and random texts); a text that spells a special
token, or has a run of white space so long that ``tiktoken``'s search would give up (from
1,000,000 on), goes through ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

# Fixed value: the splitting pattern of the byte-level pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_RUN = 100_000
# \s takes more here than in PATTERN, so no run is missed
LONG_SPACE = re.compile(r"\s{%d}" % LONG_RUN)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable bytes for themselves, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = tuple(t["content"] for t in spec["added_tokens"])
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in self.special}
        self.exact = Tokenizer.from_file(path)
        self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special) or (len(text) >= LONG_RUN and LONG_SPACE.search(text)):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for a file and process."""
    return Encoder(path)
