"""Change-detection hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "NULL"


def row_hash(columns: list[str], mode: str = "pipe") -> Column:
    """md5 over ``columns``.

    ``pipe`` (default, the reference's form): values as strings joined with
    ``|``, null as ``NULL``.  It collides for ('a|b','c') vs ('a','b|c') and
    for null vs the text ``NULL``.  ``json``: md5 of the JSON object with
    nulls kept, which has neither collision.
    """
    if not columns:
        raise ValueError("row_hash needs at least one column")
    if mode == "pipe":
        return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN))
                                        for c in columns]))
    if mode == "json":
        return F.md5(F.to_json(F.struct(*[F.col(c) for c in columns]),
                               {"ignoreNullFields": "false"}))
    raise ValueError(f"unknown hash mode {mode!r}")
