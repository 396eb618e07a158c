"""Post identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_HEX_CHARS = 24


def post_id_col(*parts: Column | str) -> Column:
    """First 24 hex characters of SHA-256 over the parts joined with ``-``.

    Deterministic on purpose: the same payload always gets the same id, so a
    replayed record dedups instead of counting twice.  (A clock-salted id
    would differ on every replay.)
    """
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.substring(F.sha2(F.concat_ws("-", *cols), 256), 1, ID_HEX_CHARS)
