"""Text encoders for :func:`loomset.operators.embed.embed`."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

Encoder = Callable[[list[str]], np.ndarray]
_TOKEN = re.compile(r"\w+")


def hashed_terms(dim: int = 64) -> Encoder:
    """Term counts folded into ``dim`` buckets by the digest of the term, at unit length."""

    @lru_cache(maxsize=100_000)
    def bucket(term: str) -> int:
        return int(hashlib.md5(term.encode()).hexdigest()[:8], 16) % dim

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim))
        for row, text in enumerate(texts):
            np.add.at(out[row], [bucket(t) for t in _TOKEN.findall((text or "").lower())], 1.0)
        lengths = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, lengths, out=out, where=lengths > 0)

    return encode
