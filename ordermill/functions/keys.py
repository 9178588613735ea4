"""Stable hash keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def surrogate_key(*columns: Column | str, bits: int = 256, null_marker: str | None = None) -> Column:
    """Hex hash of the ``|``-joined text of ``columns``; ``bits=128`` gives MD5, otherwise SHA-2.

    Null columns vanish from the joined text, so ``(a, null)`` and ``(null, a)`` share a key.
    With ``null_marker`` nulls keep their place.
    """
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    if null_marker is not None:
        texts = [F.coalesce(text, F.lit(null_marker)) for text in texts]
    joined = F.concat_ws("|", *texts)
    return F.md5(joined) if bits == 128 else F.sha2(joined, bits)
