"""Row hashes and deterministic keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The unit separator keeps ('a','bc') and ('ab','c') apart, the
# marker keeps null apart from the empty text.
SEPARATOR = "\u001f"
NULL_MARK = "\u0000"


def row_hash(cols: Sequence[str | Column], sep: str = SEPARATOR, null: str = NULL_MARK) -> Column:
    """SHA-256 over the text of several columns. A null never voids the hash.

    ``sep=""`` with ``null=""`` gives the plain-concatenation variant some
    existing dimensions were loaded with.
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(null)) for c in cols]
    return F.sha2(F.concat_ws(sep, *parts), 256)


def hash_sk(col: str | Column) -> Column:
    """Deterministic surrogate key: MD5 of the natural key's text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.md5(c.cast("string"))
