"""Documents as token pieces of at most one sequence."""

from __future__ import annotations

import numpy as np

ID_BYTES = 4


def with_end(ids: bytes, end_id: int) -> bytes:
    return ids + np.uint32(end_id).tobytes()


def cut(ids: bytes, longest: int) -> list[bytes]:
    """A document's ids in pieces of ``longest``; the last may be shorter. Nothing is lost."""
    step = longest * ID_BYTES
    return [ids[i : i + step] for i in range(0, len(ids), step)]
