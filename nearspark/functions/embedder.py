"""A deterministic embedding model for offline use, and the interface models share.

A model has ``embed_documents(texts) -> rows x dims`` and ``embed_query(text) -> row``,
both with the same meaning of a vector.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class HashingEmbedder:
    """Token counts by hash slot, scaled to unit length.

    Tokens are separated by ASCII white space and ASCII-lowercased; the slot is the
    first 32 bits of the token's MD5 modulo ``dims``.
    """

    def __init__(self, dims: int = 64):
        self.dims = dims

    def embed_documents(self, texts: Sequence[str]) -> np.ndarray:
        split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
        tokens = pc.list_flatten(split)
        row = np.asarray(pc.list_parent_indices(split))
        keep = np.asarray(pc.not_equal(tokens, ""), dtype=bool)
        coded = tokens.dictionary_encode()
        slots = np.array([self._slot(t) for t in coded.dictionary.to_pylist()], np.int64)
        place = row[keep] * self.dims + slots[np.asarray(coded.indices)[keep]]
        counts = np.bincount(place, minlength=len(texts) * self.dims)
        counts = counts.reshape(len(texts), self.dims).astype(np.float64)
        norm = np.sqrt(np.square(counts).sum(axis=1, keepdims=True))
        return (counts / np.where(norm == 0, 1.0, norm)).astype(np.float32)

    def embed_query(self, text: str) -> list[float]:
        return self.embed_documents([text])[0].tolist()

    def _slot(self, token: str) -> int:
        return int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % self.dims
