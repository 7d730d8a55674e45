"""Keys, file names and the reproducible shuffle order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the words removed from a description, in removal order.
POSITION_WORDS = ("lh", "rh", "right", "left", "upper")


def hash_order(id_col: str | Column, seed: int) -> Column:
    """Hex digest that orders ids pseudo-randomly, the same on every run and engine."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(column.cast("string"), F.lit("-"), F.lit(str(seed))).cast("binary"))


def file_key(case_id: Column, doc_id: Column, suffix: str = ".JPG") -> Column:
    """Photo file name `<case>_<doc>.JPG`; ids that arrive as floats lose their fraction."""
    return F.concat(
        case_id.cast("long").cast("string"), F.lit("_"), doc_id.cast("long").cast("string"), F.lit(suffix)
    )


def case_from_path(path: Column) -> Column:
    """Case id in front of the first underscore of the file name at the end of a path."""
    return F.regexp_extract(path, r"([^/_]+)[^/]*$", 1).try_cast("long")


def strip_position(text: Column) -> Column:
    """Delete the position words one after another, also inside longer words, then trim."""
    result = F.lower(text)
    for word in POSITION_WORDS:
        result = F.replace(result, F.lit(word), F.lit(""))
    return F.trim(result)


def label_key(parts: Sequence[str]) -> Column:
    """The 0/1 labels of a wide row as one string of digits, `?` for a label that is missing."""
    return F.concat(*[F.coalesce(F.col(p).cast("int").cast("string"), F.lit("?")) for p in parts])
