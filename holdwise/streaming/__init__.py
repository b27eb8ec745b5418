"""Incremental loading of statement files.

The warehouse reloads every statement file on each run ("drop the files in the
folder"). ``land_statements_incrementally`` is the same scan (S1) and save (K1)
as a Structured Streaming query with an ``availableNow`` trigger: each run
appends only the files that arrived since the last one, exactly once, with its
progress kept in a checkpoint below the session's shared folder.
"""

from holdwise.streaming.statements import land_statements_incrementally

__all__ = ["land_statements_incrementally"]
