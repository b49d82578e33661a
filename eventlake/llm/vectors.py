"""What the vector operators share."""

from __future__ import annotations

import numpy as np


def farthest_first(x: np.ndarray, n: int) -> list[int]:
    """Row numbers of at most ``n`` centres, each the row farthest from those before it.

    Any prefix is a net of the rows, with a covering radius that falls as it grows.
    """
    if not len(x):
        return []
    chosen, near = [0], np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < n and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(x - x[chosen[-1]], axis=1))
    return chosen
