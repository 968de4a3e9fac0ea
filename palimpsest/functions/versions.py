"""Dotted version numbers as ``array<int>`` columns.

Arrays of int compare element by element, so ``[1, 2] < [1, 10]``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_version(text: Column) -> Column:
    """``'1.1.2.1'`` to ``[1, 1, 2, 1]``; null where the text is no version."""
    parts = F.transform(F.split(text, "[.]"), lambda part: part.try_cast("int"))
    return F.when(text.rlike(r"^[0-9]+([.][0-9]+)*$"), parts)


def render_version(version: Column) -> Column:
    return F.array_join(version.cast("array<string>"), ".")


def is_branch(version: Column) -> Column:
    """Magic branch numbers carry a zero in the last place but one."""
    return F.when(F.size(version) >= 2, F.element_at(version, -2) == 0)


def is_vendor_branch(version: Column) -> Column:
    """Numbers of odd length (``1.1.1``) name vendor branches."""
    return F.size(version) % 2 == 1


def branch_parent(version: Column) -> Column:
    """The version a branch (or a revision on it) sprouts from, null on trunk."""
    return F.when(F.size(version) >= 4, F.slice(version, F.lit(1), F.size(version) - 2))


def depth(version: Column) -> Column:
    """1 on trunk, one more for every branch level."""
    return F.floor(F.size(version) / 2).cast("int")


def branch_stem(magic: Column) -> Column:
    """Common prefix of the revisions on a branch: ``1.1.0.2`` gives ``1.1.2``."""
    return F.concat(
        F.slice(magic, F.lit(1), F.size(magic) - 2), F.slice(magic, F.size(magic), F.lit(1))
    )


def revision_stem(version: Column) -> Column:
    """All but the last component."""
    return F.slice(version, F.lit(1), F.size(version) - 1)
