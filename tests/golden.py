"""Small histories with known results."""

from __future__ import annotations

import datetime as dt

from palimpsest.sources.rlog import FILE_SEPARATOR, REVISION_SEPARATOR

# Module -> (date, path, revision, dead, commit id, comment).
REVISIONS = {
    "subdirs": [
        ("2013-02-16 17:18:38", "1.txt", "1.1", False, "IhZzWJhSWp6aqrEw", "initial"),
        ("2013-02-16 17:18:39", "2.txt", "1.1", False, "IhZzWJhSWp6aqrEw", "initial"),
        ("2013-02-16 17:18:39", "3.txt", "1.1", False, "IhZzWJhSWp6aqrEw", "initial"),
        ("2013-02-16 17:18:39", "dir/1.txt", "1.1", False, "IhZzWJhSWp6aqrEw", "initial"),
        ("2013-02-16 17:18:39", "dir/2.txt", "1.1", False, "IhZzWJhSWp6aqrEw", "initial"),
        ("2013-02-16 17:18:39", "dir/3.txt", "1.1", False, "IhZzWJhSWp6aqrEw", "initial"),
    ],
    "spaces": [
        ("2013-08-12 16:34:29", "space man.bin", "1.1", False, "JmIDJDLFOoMgub1x", "added file with spaces in name"),
        ("2013-08-12 16:38:35", "My Documents/simple file.txt", "1.1", False, "mPqUXPXuv58Gvb1x", "directory with spaces"),
    ],
    "delete": [
        ("2013-02-16 16:49:53", "file.txt", "1.1", False, "CEexdhSh7QwigrEw", "a simple file"),
        ("2013-02-16 16:50:50", "evil.txt", "1.1", False, "OFwvvFFVRfsCgrEw", "an evil file added"),
        ("2013-02-16 16:51:17", "evil.txt", "1.2", False, "QFvtH5p0NpbMgrEw", "HAHA"),
        ("2013-02-16 16:51:57", "evil.txt", "1.3", True, "GPBwRbCULgj0hrEw", "removed evil"),
    ],
    "readd": [
        ("2013-02-15 20:24:24", "good.txt", "1.1", False, "e3TbwYEMhLxStkEw", "the good"),
        ("2013-02-15 20:26:16", "evil.txt", "1.1", False, "nxmml6MFdbYvukEw", "the evil"),
        ("2013-02-15 20:26:56", "evil.txt", "1.2", True, "0DRUHQHq4fLKukEw", "banish the evil"),
        ("2013-02-15 20:29:28", "evil.txt", "1.3", False, "QdX1IEdzXHzCvkEw", "evil returns"),
    ],
    "subdir_delete": [
        ("2013-02-16 17:46:01", "evil.txt", "1.1", False, "NdVbsH3vtvkyzrEw", "initial"),
        ("2013-02-16 17:46:01", "good.txt", "1.1", False, "NdVbsH3vtvkyzrEw", "initial"),
        ("2013-02-16 17:47:38", "really/evil.txt", "1.1", False, "Biagzo4CPyI6ArEw", "subdirs"),
        ("2013-02-16 17:47:38", "really/good.txt", "1.1", False, "Biagzo4CPyI6ArEw", "subdirs"),
        ("2013-02-16 17:48:51", "evil.txt", "1.2", True, "Qvre7b4zOtDwArEw", "removed bad files"),
        ("2013-02-16 17:48:52", "really/evil.txt", "1.2", True, "Qvre7b4zOtDwArEw", "removed bad files"),
    ],
    "branch": [
        ("2013-02-16 18:20:49", "main.cpp", "1.1", False, "W8QsQ1N4i6HuLrEw", "hello world"),
        ("2013-02-16 18:25:53", "README.txt", "1.1", True, "ucwnjU0Eu0seNrEw", "file README.txt was initially added on branch branch."),
        ("2013-02-16 18:25:53", "README.txt", "1.1.2.1", False, "ucwnjU0Eu0seNrEw", "added useless README"),
        ("2013-02-16 18:28:28", "main.cpp", "1.1.2.1", False, "60Oi7a3eCem7OrEw", "added a lot whitespace"),
    ],
    "multi_branch": [
        ("2013-02-25 18:22:12", "main.cpp", "1.1", False, "vyrQuiQYuHV1uBFw", "the main file"),
        ("2013-02-25 18:27:22", "opengl.c", "1.1", True, "l3iA9xyJwNPNvBFw", "file opengl.c was initially added on branch opengl."),
        ("2013-02-25 18:27:22", "opengl.c", "1.1.2.1", False, "l3iA9xyJwNPNvBFw", "one oGL source file"),
        ("2013-02-25 18:28:21", "directx.cpp", "1.1", True, "sAaw1uQ0TSD8wBFw", "file directx.cpp was initially added on branch directx."),
        ("2013-02-25 18:28:21", "directx.cpp", "1.1.2.1", False, "sAaw1uQ0TSD8wBFw", "one dX source file"),
        ("2013-02-25 18:34:43", "console.cpp", "1.1", False, "MZx58g2hedckyBFw", "console will suffice"),
        ("2013-02-25 18:36:16", "opengl.cpp", "1.1", True, "pwm9bgPc8k8RyBFw", "file opengl.cpp was initially added on branch opengl."),
        ("2013-02-25 18:36:16", "opengl.cpp", "1.1.2.1", False, "pwm9bgPc8k8RyBFw", "another oGL source file"),
        ("2013-02-25 18:41:26", "awesome.txt", "1.1", True, "rMsLd555nUZCABFw", "file awesome.txt was initially added on branch experiment."),
        ("2013-02-25 18:41:26", "awesome.txt", "1.1.2.1", False, "rMsLd555nUZCABFw", "added cool stuff"),
        ("2013-02-25 18:41:26", "cool.cpp", "1.1", True, "rMsLd555nUZCABFw", "file cool.cpp was initially added on branch experiment."),
        ("2013-02-25 18:41:26", "cool.cpp", "1.1.2.1", False, "rMsLd555nUZCABFw", "added cool stuff"),
        ("2013-02-25 18:41:26", "main.cpp", "1.1.6.1", True, "rMsLd555nUZCABFw", "added cool stuff"),
    ],
    "out_of_sync": [
        ("2013-05-31 16:51:12", "A", "1.1", False, "Ej0uNtPEjYVtVNRw", "innital"),
        ("2013-05-31 16:51:12", "B", "1.1", False, "Ej0uNtPEjYVtVNRw", "innital"),
        ("2013-05-31 16:52:07", "A", "1.2", False, "8YJ9ZemVzQCNVNRw", "A CHANGE"),
        ("2013-05-31 16:52:58", "B", "1.2", False, "Y10sDuZO74V5WNRw", "later B CHANGE"),
        ("2013-05-31 17:03:10", "A", "1.1.2.1", False, "4IdaS9vaM4JAZNRw", "commits in bad branch"),
        ("2013-05-31 17:03:10", "B", "1.2.2.1", False, "4IdaS9vaM4JAZNRw", "commits in bad branch"),
    ],
    "vendor": [
        ("2013-01-29 17:36:29", "txt1.txt", "1.1", False, "DZoooTXELSA968Cw", "Initial revision"),
        ("2013-01-29 17:36:29", "txt1.txt", "1.1.1.1", False, "DZoooTXELSA968Cw", "vendor files"),
        ("2013-01-29 17:36:29", "txt2.txt", "1.1", False, "DZoooTXELSA968Cw", "Initial revision"),
        ("2013-01-29 17:36:29", "txt2.txt", "1.1.1.1", False, "DZoooTXELSA968Cw", "vendor files"),
        ("2013-01-29 17:41:22", "txt1.txt", "1.2", False, "W32wcPiPVIsP78Cw", "big @ 1"),
    ],
}

# Module -> tag -> path -> version.
TAGS = {
    "branch": {
        "branch": {"README.txt": "1.1.0.2", "main.cpp": "1.1.0.2"},
        "branch_start": {"main.cpp": "1.1"},
    },
    "multi_branch": {
        "directx": {"directx.cpp": "1.1.0.2", "main.cpp": "1.1.0.4"},
        "experiment": {
            "awesome.txt": "1.1.0.2",
            "cool.cpp": "1.1.0.2",
            "main.cpp": "1.1.0.6",
            "opengl.c": "1.1.2.1.0.2",
            "opengl.cpp": "1.1.2.1.0.2",
        },
        "experiment_start": {"main.cpp": "1.1", "opengl.c": "1.1.2.1", "opengl.cpp": "1.1.2.1"},
        "libs_start": {"main.cpp": "1.1"},
        "opengl": {"main.cpp": "1.1.0.2", "opengl.c": "1.1.0.2", "opengl.cpp": "1.1.0.2"},
    },
    "out_of_sync": {
        "BPT": {"A": "1.1", "B": "1.2"},
        "bad_branch": {"A": "1.1.0.2", "B": "1.2.0.2"},
    },
    "vendor": {
        "start": {"txt1.txt": "1.1.1.1", "txt2.txt": "1.1.1.1"},
        "vendor": {"txt1.txt": "1.1.1", "txt2.txt": "1.1.1"},
    },
}

DEFAULT_BRANCHES = {"vendor": {"txt2.txt": "1.1.1"}}
AUTHOR = "dev"
ROOT = "/srv/root"


def numbers(version: str) -> list[int]:
    return [int(part) for part in version.split(".")]


def revisions(spark, module, branch=None):
    rows = [
        (path, numbers(revision), dead, dt.datetime.fromisoformat(date), AUTHOR, comment, commit_id)
        for date, path, revision, dead, commit_id, comment in REVISIONS[module]
    ]
    schema = (
        "path string, revision array<int>, is_dead boolean, date timestamp, "
        "author string, comment string, commit_id string"
    )
    df = spark.createDataFrame(rows, schema)
    if branch is not None:
        from pyspark.sql import functions as F

        df = df.select(F.lit(branch).alias("branch"), "*")
    return df


def tags(spark, module):
    rows = [
        (tag, path, numbers(version))
        for tag, files in TAGS.get(module, {}).items()
        for path, version in files.items()
    ]
    return spark.createDataFrame(rows, "tag string, path string, revision array<int>")


def log_text(module: str, date_format: str = "%Y-%m-%d %H:%M:%S +0000") -> str:
    """The module as a log, one section per file, newest revision first."""
    sections = []
    for path in sorted({row[1] for row in REVISIONS[module]}):
        head, _, leaf = path.rpartition("/")
        archive = "/".join(part for part in (ROOT, module, head, leaf) if part)
        own = [row for row in REVISIONS[module] if row[1] == path]
        if any(row[3] for row in own):
            archive = "/".join(part for part in (ROOT, module, head, "Attic", leaf) if part)
        symbols = [
            f"\t{tag}: {files[path]}" for tag, files in TAGS.get(module, {}).items() if path in files
        ]
        lines = [
            "",
            f"RCS file: {archive},v",
            f"head: {own[-1][2]}",
            "branch: " + DEFAULT_BRANCHES.get(module, {}).get(path, ""),
            "locks: strict",
            "access list:",
            "symbolic names:",
            *symbols,
            "keyword substitution: kv",
            f"total revisions: {len(own)};\tselected revisions: {len(own)}",
            "description:",
        ]
        for date, _, revision, dead, commit_id, comment in reversed(own):
            when = dt.datetime.fromisoformat(date).strftime(date_format)
            state = "dead" if dead else "Exp"
            lines += [
                REVISION_SEPARATOR,
                f"revision {revision}",
                f"date: {when};  author: {AUTHOR};  state: {state};  commitid: {commit_id};",
                *(["branches:  1.1.2;"] if revision == "1.1" else []),
                comment,
            ]
        sections.append("\n".join([*lines, FILE_SEPARATOR, ""]))
    return "".join(sections)
