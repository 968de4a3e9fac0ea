"""Content ids and order-free digests of sets of rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def blob_id(content: Column) -> Column:
    """Id of a file's bytes: sha1 over ``blob <length>``, a zero byte and the bytes."""
    header = F.encode(F.concat(F.lit("blob "), F.octet_length(content).cast("string")), "UTF-8")
    return F.sha1(F.concat(header, F.unhex(F.lit("00")), content))


def _slice(digest: Column, start: int) -> Column:
    # 15 hex digits are 60 bits: a sum over 10^18 rows still fits decimal(38).
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(38,0)")


def entry_sums(entry: Column) -> tuple[Column, Column]:
    """What one entry adds to the two sums of a set's digest."""
    hashed = F.sha1(entry.cast("binary"))
    return _slice(hashed, 1), _slice(hashed, 16)


def sums_digest(count: Column, first: Column, second: Column) -> Column:
    """The digest of a set from its count and sums."""
    return F.sha1(F.concat_ws(":", count.cast("string"), first.cast("string"), second.cast("string")).cast("binary"))


def set_digest(entry: Column) -> Column:
    """Aggregate: digest of a set of strings, whatever their order.

    The sums of two slices of the entries' hashes take partial aggregation, so
    a group of any size is combined map-side and never gathered in one task.
    """
    first, second = entry_sums(entry)
    return sums_digest(F.count(entry), F.sum(first), F.sum(second))
