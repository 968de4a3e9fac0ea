"""Version-history analytics as Spark jobs.

Every operator is a function from DataFrames to a DataFrame.  The tables they
work on (revisions, tags, branches, contents) are described in
:mod:`palimpsest.schema`.
"""
