"""Comma-separated lines to typed records.

A line is well formed when it has enough fields (trailing empty ones do not
count), its times are whole numbers between the years 1677 and 2262 (what a
nanosecond timestamp can hold) and its speed is below ``SPEED_LIMIT`` either
way, so that no single line can stop a job or a stream later on.  ``PERMISSIVE``
keeps the well-formed lines and ``malformed`` returns the others, so nothing is
lost between the two; ``TAGGED`` keeps all in one pass, the text of the malformed
ones in ``rejected``; ``FAILFAST`` stops the job at the first bad line.
"""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from roadstream.functions.numeric import SPEED_LIMIT
from roadstream.schemas import PASSAGE, POLICE_ACTION, VIOLATION

_LONG = r"^[+-]?[0-9]+$"
_LAST_MS = 9_223_372_036_854


def _record(value: Column, schema: StructType) -> Column:
    """Array of one struct, null for a malformed line.

    The lambda binds the split line, so it is split once however many fields
    and checks refer to it.
    """
    def record(parts: Column) -> Column:
        columns, good = [], F.size(parts) >= len(schema)
        for at, field in enumerate(schema):
            column = F.get(parts, F.lit(at))
            if isinstance(field.dataType, LongType):
                column = F.when(column.rlike(_LONG), column.try_cast("bigint"))
                good = good & column.between(-_LAST_MS, _LAST_MS)
            elif isinstance(field.dataType, DoubleType):
                column = column.try_cast("double")
                good = good & (F.abs(column) < F.lit(SPEED_LIMIT))
            columns.append(column.alias(field.name))
        return F.when(good, F.struct(*columns))

    # One part more than needed, so the rest of a long line stays in one piece.
    parts = F.split(F.rtrim(value, F.lit(",")), ",", len(schema) + 1)
    return F.transform(F.array(parts), record)


def parse(lines: DataFrame, schema: StructType, mode: str = "PERMISSIVE", value: str = "value") -> DataFrame:
    """Typed columns in wire order; the other columns of ``lines`` stay."""
    record = _record(F.col(value), schema)
    if mode == "PERMISSIVE":
        records = F.filter(record, lambda r: r.isNotNull())
    elif mode == "FAILFAST":
        stop = F.raise_error(F.concat(F.lit("malformed line: "), F.coalesce(F.col(value), F.lit("null"))))
        records = F.transform(record, lambda r: F.when(r.isNull(), stop).otherwise(r))
    elif mode == "TAGGED":
        keep = [c for c in lines.columns if c != value]
        tagged = lines.select(F.get(record, F.lit(0)).alias("_record"), value, *keep)
        return tagged.select("_record.*", *keep, F.when(F.col("_record").isNull(), F.coalesce(value, F.lit(""))).alias("rejected"))
    else:
        raise ValueError("mode must be PERMISSIVE, TAGGED or FAILFAST")
    keep = [c for c in lines.columns if c != value]
    return lines.select(F.inline(records), *keep)


def malformed(lines: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """The lines that ``parse`` leaves out."""
    return lines.filter(F.get(_record(F.col(value), schema), F.lit(0)).isNull())


def parse_passages(lines: DataFrame, mode: str = "PERMISSIVE", value: str = "value") -> DataFrame:
    return parse(lines, PASSAGE, mode, value)


def parse_violations(lines: DataFrame, mode: str = "PERMISSIVE", value: str = "value") -> DataFrame:
    return parse(lines, VIOLATION, mode, value)


def parse_police_actions(lines: DataFrame, mode: str = "PERMISSIVE", value: str = "value") -> DataFrame:
    return parse(lines, POLICE_ACTION, mode, value)
