"""A tag as a map column ``path -> version``.

The map form suits tags of moderate size; the operators work on the long form
``tags(tag, path, revision)``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from palimpsest.functions import versions as V


def with_file(files: Column, path: Column, revision: Column) -> Column:
    """Set the version of one file."""
    others = F.map_filter(files, lambda key, _: key != path)
    return F.map_concat(others, F.create_map(path, revision))


def includes_file(files: Column, path: Column) -> Column:
    return F.map_contains_key(files, path)


def includes_commit(files: Column, path: Column, revision: Column) -> Column:
    return F.coalesce(F.try_element_at(files, path) == revision, F.lit(False))


def ignore_files(files: Column, paths: Column) -> Column:
    """Drop the files named in the array ``paths``."""
    return F.map_filter(files, lambda key, _: ~F.array_contains(paths, key))


def tag_depth(files: Column) -> Column:
    """Greatest branch depth of the versions; null for an empty tag."""
    return F.array_max(F.transform(F.map_values(files), V.depth))


def tag_is_branch(files: Column) -> Column:
    return F.exists(F.map_values(files), V.is_branch)


def tag_branch_parent(files: Column) -> Column:
    """Each file's branch point, files without one dropped."""
    parents = F.transform_values(files, lambda _, version: V.branch_parent(version))
    return F.map_filter(parents, lambda _, version: version.isNotNull())
