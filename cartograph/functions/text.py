"""String helpers with the parsing rules of the original (Java) log reader."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's String.trim removes every char <= U+0020 at both ends, not just the blank.
JAVA_WHITESPACE = "".join(chr(c) for c in range(0x21))

# Long.parseLong accepts an optional sign and decimal digits only.
_LONG_PATTERN = r"^[+-]?[0-9]+\z"


def java_trim(col: Column) -> Column:
    return F.btrim(col, F.lit(JAVA_WHITESPACE))


def parse_long(col: Column) -> Column:
    """Integer text -> bigint, NULL when the text is not a plain (signed) integer or overflows.

    The pattern is needed beside ``try_cast``, which ignores white space and control
    characters (U+007F among them) around the digits.
    """
    return F.when(col.rlike(_LONG_PATTERN), col.try_cast("bigint"))


def split_fields(line: Column) -> Column:
    """Comma-separated when the line has a comma, else split on runs of whitespace.

    Limit -1 keeps trailing empty fields, so '1,2,3,4,5,' has six fields.
    """
    return F.when(line.contains(","), F.split(line, ",", -1)).otherwise(F.split(line, r"\s+", -1))
