"""Repeatable randomness: MD5 of key and seed, the same on any cluster and for any partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(keys: Sequence[str], seed: int) -> Column:
    """32 hex digits that put the rows in a random but fixed order."""
    return F.md5(F.concat_ws(":", *[_part(F.col(k)) for k in keys], F.lit(str(seed))))


def _part(key: Column) -> Column:
    """A part of a key as text in which neither separator nor null can be mistaken for a value."""
    text = F.replace(F.replace(key.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\:"))
    return F.coalesce(text, F.lit("\\N"))


def hash_number(*parts: Column | str | int) -> Column:
    """A non-negative 60-bit integer drawn from the given parts; plain values are literals."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    digest = F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
