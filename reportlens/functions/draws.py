"""Random draws that are functions of a key and a seed.

They come from MD5 digits, so that any engine can repeat them.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def digest(key, seed: int) -> Column:
    """32 hex digits of ``<seed>:<key>``; their order is a random order of the keys."""
    c = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(c.cast("string"), F.lit(""))))


def unit(key, seed: int) -> Column:
    """A draw from the open interval (0, 1): the middle of one of 2^52 parts."""
    part = F.conv(F.substring(digest(key, seed), 1, 13), 16, 10).cast("double")
    return (part + 0.5) / float(1 << 52)
