"""Repository paths and derived names."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Ref prefixes, the suffix of archive files, the folder that
# holds archives of removed files.
REMOTE_PREFIX = "refs/remotes/cvs/"
HEAD_PREFIX = "refs/heads/"
ARCHIVE_SUFFIX = ",v"
REMOVED_FOLDER = "Attic"
MAIL_HOST = "nowhere.com"


def server_root(root: str | None) -> str:
    """``:pserver:host:/root`` keeps what follows the last colon."""
    root = root or ""
    return root.rpartition(":")[2] if root.startswith(":pserver:") else root


def clean_path(absolute: Column, root: str | None = None, module: str | None = None) -> Column:
    """Archive path to the path of the file inside its module."""
    prefix = server_root(root).rstrip("/") + "/" + (f"{module}/" if module else "")
    relative = F.regexp_replace(F.trim(absolute), "^" + re.escape(prefix), "")
    without_suffix = F.regexp_replace(relative, re.escape(ARCHIVE_SUFFIX) + "$", "")
    return F.regexp_replace(without_suffix, f"(^|/)(?:{REMOVED_FOLDER}/)+", "$1")


def parent_dir(path: Column) -> Column:
    """Directory of a path, ``''`` for the top level."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def leaf_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def ancestor_dirs(path: Column) -> Column:
    """All directories above a path, from ``''`` downwards."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"),
    )


def module_path(module: str | None, path: Column) -> Column:
    return F.concat(F.lit(f"{module}/" if module else ""), path)


def remote_ref(branch: Column) -> Column:
    return F.concat(F.lit(REMOTE_PREFIX), branch)


def head_ref(branch: Column) -> Column:
    return F.concat(F.lit(HEAD_PREFIX), branch)


def author_mail(author: Column) -> Column:
    return F.concat(author, F.lit("@" + MAIL_HOST))


def patch_name(parent: Column, branch: Column, head: Column) -> Column:
    return F.concat(F.lit("patches/"), parent, F.lit("/"), branch, F.lit("__"), head, F.lit(".diff"))
