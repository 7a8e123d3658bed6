"""Byte-level BPE ids of texts from a public vocabulary."""

from __future__ import annotations

import base64
import re

import numpy as np
import tiktoken

# Fixed value: the pattern that goes with the rank files, in the form that never goes back over a run.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
# The same for a text in which two white spaces only stand at the end, without a look ahead: several times cheaper to match.
_PLAIN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"""
WHITE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"  # what \s stands for in patterns
_RUN = re.compile(WHITE + "{2,}")
_ENCODERS: dict[int, Encoder] = {}

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


def ranks_of(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


class Encoder:
    """Ids of whole texts as packed bytes."""

    def __init__(self, data: bytes):
        ranks = ranks_of(data)
        self.size = max(ranks.values()) + 1
        self.end = self.size
        self.kind = np.uint16 if self.end < 2**16 else np.uint32
        self.coder = tiktoken.Encoding("own", pat_str=_PLAIN, mergeable_ranks=ranks, special_tokens={"<|end|>": self.end})

    def packed(self, text: str | None) -> bytes:
        """The ids that PATTERN gives: a run of white space before something else is one piece but for its last character."""
        text, parts, at = text or "", [], 0
        for run in _RUN.finditer(text):
            if run.end() < len(text):
                parts += [text[at : run.start()], text[run.start() : run.end() - 1]]
                at = run.end() - 1
        parts.append(text[at:])
        # No special token is allowed: its name is text like any other.
        return b"".join([self.coder.encode_to_numpy(part, disallowed_special=()).astype(self.kind).tobytes() for part in parts if part])


def encoder(data: bytes) -> Encoder:
    """One for each Python worker."""
    key = hash(data)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(data)
    return _ENCODERS[key]
