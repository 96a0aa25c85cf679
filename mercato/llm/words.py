"""Whitespace tokens of a batch of texts, by Arrow."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def tokens(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct tokens, the code of every token, and the token offsets of the texts."""
    parts = pc.utf8_split_whitespace(texts.cast(pa.large_string()))
    offsets = np.asarray(parts.offsets).astype(np.int64)
    flat = parts.flatten()
    # splitting leaves empty strings at the ends of a text; they are not tokens
    real = np.asarray(pc.greater(pc.binary_length(flat), 0)) if len(flat) else np.empty(0, bool)
    upto = np.concatenate([[0], np.cumsum(real)]).astype(np.int64)
    coded = flat.filter(pa.array(real, pa.bool_())).dictionary_encode()
    return coded.dictionary.to_pylist(), np.asarray(coded.indices).astype(np.int64), upto[offsets - offsets[0]]
