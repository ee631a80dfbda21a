"""Keys computed from content."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def content_md5(*cols: Column, sep: str = "||") -> Column:
    """MD5 of the columns' text joined by ``sep``; NULL columns are left out."""
    return F.md5(F.concat_ws(sep, *[c.cast("string") for c in cols]))


def leading_bits(digest: Column) -> Column:
    """The first 12 bits of a binary digest, 0 to 4095; the number never falls along the digest's order."""
    return F.shiftright(F.conv(F.hex(F.substring(digest, 1, 2)), 16, 10).cast("int"), 4)


def hash_key(*cols: Column) -> Column:
    """32-bit key without a lookup; stable between runs, collisions possible."""
    return F.hash(*cols)
