"""The filter vocabulary as Column builders. All are built-ins that Spark can push to the scan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPARISONS = {
    "eq": Column.__eq__, "ne": Column.__ne__, "gt": Column.__gt__, "ge": Column.__ge__, "lt": Column.__lt__,
    "le": Column.__le__,
}
WORD_BREAK = r"[^a-z0-9\p{L}\p{N}]+"  # runs of anything but letters and digits, plain ones tried first
WORD_CHARACTER = r"[\p{L}\p{N}]"


def compare(column: str, operator: str, value) -> Column:
    """eq, ne, gt, ge, lt, le; rows with a null value never match."""
    return COMPARISONS[operator](F.col(column), value)


def is_true(column: str) -> Column:
    return F.col(column)


def one_of(column: str, values: str, delimiter: str = ",") -> Column:
    """Membership in a delimited list of values."""
    return F.col(column).isin(*[v.strip() for v in values.split(delimiter)])


def any_equals(array: str, value) -> Column:
    return F.array_contains(array, value)


def any_match(array: str, condition) -> Column:
    """Some element of a nested collection meets the condition (a function of the element)."""
    return F.exists(array, condition)


def json_path(column: str, path: str, kind: str = "string") -> Column:
    """Value at a path of a JSON field, null where it is absent or of another kind."""
    return F.get_json_object(column, path).try_cast(kind)


def date_text_between(column: str, first: str, last: str) -> Column:
    """Range over fixed-width ISO-8601 text, where text order is time order."""
    return F.col(column).between(first, last)


def date_between(column: str, low: str, high: str) -> Column:
    """Time column between two ISO instants, both included; a typed comparison, which prunes Parquet row groups."""
    return F.col(column).between(F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz"))


def prefix(column: str, start: str) -> Column:
    return F.col(column).startswith(start)


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != "")


def has_word(text: str, word: str) -> Column:
    """Texts with that word; only those that contain it at all are searched for its edges."""
    if not word.isalnum():
        raise ValueError(f"{word!r} is not one word of letters and digits")
    wanted = word.lower()
    lowered = F.lower(F.col(text))
    whole = f"{wanted}(?<!{WORD_CHARACTER}{wanted})(?!{WORD_CHARACTER})"
    return lowered.contains(wanted) & lowered.rlike(whole)
