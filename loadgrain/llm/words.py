"""Words of whole texts, as bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from loadgrain.llm.common import text_bytes

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def joined_words(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words in a row with a blank after each, where each begins and ends, and each text's first word."""
    data, offsets = text_bytes(texts)
    if lower:
        data = LOWER[data]
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], solid[:-1]]) if len(data) else solid
    begins = np.flatnonzero(solid & (~before | edge[: len(data)]))
    rank = np.cumsum(solid)
    first_rank = rank[begins] - 1
    places = first_rank + np.arange(len(begins))
    n = int(rank[-1]) if len(rank) else 0
    ends = np.append(places[1:] - 1, n + len(begins) - 1)[: len(begins)]
    out = np.full(n + len(begins), 32, np.uint8)
    out[np.arange(n) + np.repeat(np.arange(len(begins)), ends - places)] = data[solid]
    return out, places, ends, np.searchsorted(begins, offsets)
