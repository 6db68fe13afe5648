"""Surrogate keys and change hashes."""

from pyspark.sql import functions as F

# Control characters that cannot occur in source text.
NULL_MARK = chr(30)
FIELD_MARK = chr(31)


def hash_key(*cols):
    """SHA-1 hex of the parts joined by ``_``; a NULL part is skipped."""
    return F.sha1(F.concat_ws("_", *cols))


def data_hash(*cols):
    """SHA-1 over attribute values in which a NULL and a shifted value stay distinct.

    Joining with ``_`` and skipping NULLs would give (a, NULL, b) and (a, b, NULL) one hash, and
    a value that moves between columns would pass as unchanged.
    """
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_MARK))
        for c in cols
    ]
    return F.sha1(F.concat_ws(FIELD_MARK, *parts))
