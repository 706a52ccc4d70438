"""Columns that take a delimited message apart.

A message is split once into segments and each wanted segment once into fields; both stay
array columns, so later expressions only index into them. Blank parts read as NULL, and of
a repeated segment or field the first one counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The delimiters of the message format.
FIELD, COMPONENT, REPETITION, SUBCOMPONENT = "|", "^", "~", "&"
_HEADER = "MSH"
_WELL_FORMED = "MSH|^~\\&"
# A framed message stands between these control characters.
_BLANKS = " \t\n\x0b\x0c\r"
_FRAME, _FRAME_END = "\x1c", r"\x1c\s*$"


def is_message(msg: Column) -> Column:
    return F.coalesce(F.ltrim(msg, F.lit(_BLANKS)).startswith(_WELL_FORMED), F.lit(False))


def normalise(msg: Column) -> Column:
    """Line feeds become the segment separator ``\\r``; text that is no message becomes NULL."""
    breaks = F.replace(F.replace(_unframed(msg), F.lit("\r\n"), F.lit("\r")), F.lit("\n"), F.lit("\r"))
    return F.when(is_message(msg), breaks)


def _unframed(msg: Column) -> Column:
    """Without white space and control characters before the message and a frame's end after it. The pattern is
    only run over texts that hold the frame's character."""
    begun = F.ltrim(msg, F.lit(_BLANKS))
    return F.when(F.contains(begun, F.lit(_FRAME)), F.regexp_replace(begun, _FRAME_END, "")).otherwise(begun)


def segments(msg: Column) -> Column:
    """The lines of a message; splitting at one plain character takes no pattern matching, and only a text that holds a
    line feed is written anew."""
    text = _unframed(msg)
    fed = F.split(F.replace(text, F.lit("\n"), F.lit("\r")), "\r")
    return F.when(F.contains(text, F.lit("\n")), fed).otherwise(F.split(text, "\r"))


def fields(segment: Column) -> Column:
    return F.split(segment, r"\|")


def named(segs: Column, name: str) -> Column:
    """All segments called ``name``, unsplit."""
    return F.filter(segs, lambda s: s.startswith(name + FIELD))


def first_line(segs: Column, name: str) -> Column:
    """The first segment called ``name``, unsplit."""
    return F.get(named(segs, name), F.lit(0))


def first_segment(segs: Column, name: str) -> Column:
    """Fields of the first segment called ``name``, as an array."""
    return fields(first_line(segs, name))


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c in ": -" else "\\" + c for c in text)


def observations(segs: Column, code: str, whole: bool = False) -> Column:
    """OBX segments whose third field starts with the components in ``code``, unsplit.

    With ``whole`` the field, up to its first repetition, has to be ``code`` and nothing else.
    One pattern per segment, so that nothing is split that is not wanted, and only for segments that hold the code at all.
    """
    end = r"(?:[~|]|$)" if whole else r"(?:[\^~|]|$)"
    pattern = r"^OBX\|[^|]*\|[^|]*\|" + _quoted(code) + end
    return F.filter(segs, lambda s: s.startswith("OBX" + FIELD) & s.contains(code) & s.rlike(pattern))


def observed_values(observed: Column) -> Column:
    """The components of the fifth field of each observation, as an array of arrays."""
    return F.transform(
        observed,
        lambda s: F.split(first_repetition(F.split_part(s, F.lit(FIELD), F.lit(6))), r"\^"),
    )


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def first_repetition(field: Column) -> Column:
    return F.substring_index(field, REPETITION, 1)


def raw(segment: Column, number: int, component: int | None = None, name: str = "") -> Column:
    """A field, or a component of it, in which blank and absent are not yet the same.

    The header's first field is the delimiter itself.
    """
    index = number - 1 if name == _HEADER else number
    value = first_repetition(F.get(segment, F.lit(index)))
    if component is None:
        return value
    if component == 1:
        return F.substring_index(value, COMPONENT, 1)
    # Splitting at one escaped character takes no pattern matching; split_part would compile a pattern for every value.
    found = F.get(F.split(value, r"\^"), F.lit(component - 1))
    return F.coalesce(found, F.when(value.isNotNull(), F.lit("")))


def part(segment: Column, number: int, component: int | None = None, name: str = "") -> Column:
    """A field, or a component of it; NULL when blank."""
    return blank_to_null(raw(segment, number, component, name))


def with_segments(df: DataFrame, msg: str, names: list[str], unsplit: bool = False) -> DataFrame:
    """Add ``_segs`` and, per name, the fields of the first such segment: ``_pid``, ``_pv1``, …

    With ``unsplit`` the segment itself. Who takes all its fields in one projection splits it there, by an expression
    that Catalyst evaluates once, and no array has to be written between projections.

    Each level is a projection of its own. What is used more than once is then computed
    once, because Catalyst does not merge projections over such columns.
    """
    split = df.withColumn("_segs", segments(F.col(msg)))
    first = first_line if unsplit else first_segment
    return split.withColumns({f"_{n.lower()}": first(F.col("_segs"), n) for n in names})
