"""Document-information dates such as ``D:20250609143818+09'00'``, without a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import strip

# Fixed value: the published date layout. Every field after the year may be missing and
# whatever follows the layout is ignored.
PDF_DATE_PATTERN = (
    r"^D:([0-9]{4})([0-9]{2})?([0-9]{2})?([0-9]{2})?([0-9]{2})?([0-9]{2})?"
    r"([Zz+-])?([0-9]{2})?'?([0-9]{2})?"
)


_FIELDS = 9
_MARK = "\x01"


def parse_pdf_date(value: Column) -> Column:
    """UTC instant of a date string; NULL for anything that is not a real calendar moment.

    An offset counts only with a sign and hours. One of 24 hours or more gives NULL.
    """
    raw = strip(value)
    # One match gives all fields, as a list behind an empty first entry; missing ones are ''.
    listed = "".join(f"{_MARK}${group}" for group in range(1, _FIELDS + 1))
    fields = F.split(F.regexp_replace(raw, f"(?s){PDF_DATE_PATTERN}.*", listed), _MARK)
    matched = raw.startswith("D:") & (F.get(fields, F.lit(0)) == "")
    # The list is bound to a variable, so that it is worked out once per row.
    return F.get(F.transform(F.array(F.when(matched, fields)), _moment), F.lit(0))


def _moment(fields: Column) -> Column:
    def number(group: int, default: int) -> Column:
        return F.coalesce(F.nullif(F.get(fields, F.lit(group)), F.lit("")).cast("int"), F.lit(default))

    year, second = number(1, 0), number(6, 0)
    moment = F.try_make_timestamp(
        year, number(2, 1), number(3, 1), number(4, 0), number(5, 0),
        second.cast("decimal(8,6)"), F.lit("UTC"),
    )
    sign, hours, minutes = F.get(fields, F.lit(7)), number(8, -1), number(9, 0)
    shift = F.when(
        sign.isin("+", "-") & (hours >= 0),
        (hours * 60 + minutes) * F.when(sign == "-", -1).otherwise(1),
    ).otherwise(0)
    valid = (year >= 1) & (second <= 59) & (F.abs(shift) < 24 * 60)
    return F.when(valid, moment - F.make_dt_interval(F.lit(0), F.lit(0), shift))
