"""Text records: the note of a commit and the message of a tag."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from palimpsest.functions.versions import parse_version, render_version

# The four lines of a note.
PATH_KEY = "CVS_PATH: "
REVISION_KEY = "CVS_REV: "
COMMIT_ID_KEY = "CVS_COMMIT_ID: "
DEAD = "dead"
ALIVE = "alive"


def render_note(path: Column, revision: Column, is_dead: Column, commit_id: Column) -> Column:
    return F.concat(
        F.lit(PATH_KEY), path, F.lit("\n"),
        F.lit(REVISION_KEY), render_version(revision), F.lit("\n"),
        F.when(is_dead, DEAD).otherwise(ALIVE), F.lit("\n"),
        F.coalesce(F.concat(F.lit(COMMIT_ID_KEY), commit_id), F.lit("")), F.lit("\n"),
    )


def parse_note(note: Column) -> Column:
    """Note text to ``struct(path, revision, is_dead, commit_id)``."""
    lines = F.split(note, "\n")

    def value(position: int, key: str) -> Column:
        return F.substring(F.get(lines, F.lit(position)), F.lit(len(key) + 1), F.lit(2147483647))

    commit_id = F.when(F.get(lines, F.lit(3)).startswith(COMMIT_ID_KEY), value(3, COMMIT_ID_KEY))
    return F.struct(
        value(0, PATH_KEY).alias("path"),
        parse_version(value(1, REVISION_KEY)).alias("revision"),
        (F.get(lines, F.lit(2)) == DEAD).alias("is_dead"),
        commit_id.alias("commit_id"),
    )


def tag_line(path: Column, revision: Column) -> Column:
    return F.concat(path, F.lit(" : "), render_version(revision))
