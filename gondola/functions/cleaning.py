"""Row-level cleaning of raw file rows, as column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.schemas import DATE, TableSpec

# The characters that count as surrounding whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Texts that stand for a missing value, and the start of a publication's last line.
MISSING = ("", "nan", "None")
FOOTER = "ultima actualizacion"
#: Stored rows have their fields in columns of this name and the field's place.
FIELD = "campo_"

_DIGITS = r"(?U)\A\d+\z"
_NUMBER = r"\A[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"


def stripped(column: Column) -> Column:
    """Remove surrounding whitespace of every kind (``trim`` alone knows only spaces)."""
    return F.btrim(column, F.lit(WHITESPACE))


def has_content(fields: Column) -> Column:
    """At least one field is not blank."""
    return F.exists(fields, lambda value: stripped(value) != "")


def has_size(fields: Column, size: int) -> Column:
    return F.size(fields) == size


def is_footer(fields: Column) -> Column:
    """The publication's closing line, recognised regardless of accents and case."""
    first = stripped(F.get(fields, F.lit(0)))
    # Data rows start with a digit; testing that first keeps the collation off the hot path.
    return ~first.rlike(r"\A\d") & F.startswith(F.collate(first, "UNICODE_CI_AI"), F.lit(FOOTER))


def is_identifier(column: Column) -> Column:
    """Only digits. ``\\z`` and not ``$``, which would let a trailing newline pass."""
    return stripped(column).rlike(_DIGITS)


def text_or_null(column: Column) -> Column:
    return _present(stripped(column))


def number_or_null(column: Column) -> Column:
    """Decimal text to double; a comma makes it the decimal mark and drops all dots before it."""
    return _number(stripped(column))


def _present(value: Column) -> Column:
    return F.when(~value.isin(*MISSING), value)


def _number(value: Column) -> Column:
    plain = F.when(F.contains(value, F.lit(",")), F.translate(value, ",.", ".")).otherwise(value)
    # The guard refuses what a cast would take for a number, such as '1d' or '1f'.
    return F.when(plain.rlike(_NUMBER), plain.try_cast("double"))


def timestamp_or_null(column: Column) -> Column:
    return F.try_to_timestamp(column)


def publication_date(name: Column, forced: date | str | Column | None = None) -> Column:
    """The forced date, or the first date in the member name, or NULL."""
    found = F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1).try_cast("date")
    if forced is None:
        return found
    return F.coalesce((forced if isinstance(forced, Column) else F.lit(str(forced))).cast("date"), found)


def clean(rows: DataFrame, spec: TableSpec, forced: date | str | Column | None = None) -> DataFrame:
    """Raw rows of one file (column ``campos``) to rows of its base table.

    A first column of digits only excludes blank rows and the closing line as well, so this one test
    stands for all three.
    """
    fields = F.col("campos")
    whole = rows.where((F.col("csv") == spec.csv) & (F.col("tipo") == "fila")).where(
        has_size(fields, len(spec.header)) & is_identifier(F.get(fields, F.lit(0)))
    )
    return _typed(whole, spec, forced, [stripped(F.get(fields, F.lit(i))) for i in range(len(spec.header))])


def in_columns(rows: DataFrame, specs: Iterable[TableSpec]) -> DataFrame:
    """Notes, and rows with as many fields as their file has columns, with the fields in columns of their own (``FIELD`` and their place).

    Places that no table takes are left out.
    """
    specs = list(specs)
    is_row = F.col("tipo") == "fila"
    sized = reduce(or_, [(F.col("csv") == spec.csv) & has_size(F.col("campos"), len(spec.header)) for spec in specs])
    places = sorted({i for spec in specs for i, c in enumerate(spec.header) if c in spec.output})
    fields = [F.when(is_row, F.get("campos", F.lit(i))).alias(f"{FIELD}{i}") for i in places]
    return rows.where(~is_row | sized).select(*[c for c in rows.columns if c != "campos"], *fields)


def clean_columns(rows: DataFrame, spec: TableSpec, forced: date | str | Column | None = None) -> DataFrame:
    """As ``clean``, for rows of ``in_columns`` whose fields came stripped."""
    fields = [F.col(f"{FIELD}{i}") if c in spec.output else None for i, c in enumerate(spec.header)]
    whole = rows.where((F.col("csv") == spec.csv) & (F.col("tipo") == "fila")).where(fields[0].rlike(_DIGITS))
    return _typed(whole, spec, forced, fields)


def _typed(rows: DataFrame, spec: TableSpec, forced: date | str | Column | None, fields: list[Column | None]) -> DataFrame:
    """Rows of the table of valid rows, whose stripped fields are given in the order of the header."""
    first = spec.header[0]
    # Stripped once in a projection of their own, the values are plain references below.
    values = rows.select(
        *[field.alias(c) for field, c in zip(fields, spec.header, strict=True) if c in spec.output],
        publication_date(F.col("archivo_origen"), forced).alias(DATE),
        "archivo_origen",
        # The archive path stays with the rows while they are counted; writers drop it.
        *[c for c in rows.columns if c in ("zip", "archivo")],
    )

    def output(name: str) -> Column:
        value = F.col(name)
        if name in spec.numeric:
            return _number(value)
        if name in spec.timestamps:
            return timestamp_or_null(value)
        return _present(value) if name in spec.header and name != first else value

    return values.withColumns({name: output(name) for name in spec.output}).select(
        *spec.output, *[c for c in rows.columns if c in ("zip", "archivo")]
    )
