"""Date parsing with explicit formats; each parse is guarded by its shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talweg.functions.text import strip, stringify

_D, _Y = r"\d{1,2}", r"\d{4}"
_CLOCK = rf"{_D}:{_D}:{_D}"

# (shape, format) in order of preference: ISO timestamp, day-first date, then
# the lenient day-first tail.
DAY_FIRST_FORMATS = (
    (rf"^{_Y}-{_D}-{_D} {_CLOCK}$", "yyyy-M-d H:m:s"),
    (rf"^{_D}/{_D}/{_Y}$", "d/M/yyyy"),
    (rf"^{_Y}-{_D}-{_D}$", "yyyy-M-d"),
    (rf"^{_Y}-{_D}-{_D}T{_CLOCK}$", "yyyy-M-d'T'H:m:s"),
    (rf"^{_Y}-{_D}-{_D} {_D}:{_D}$", "yyyy-M-d H:m"),
    (rf"^{_Y}/{_D}/{_D}$", "yyyy/M/d"),
    (rf"^{_D}/{_D}/{_Y} {_CLOCK}$", "d/M/yyyy H:m:s"),
    (rf"^{_D}/{_D}/{_Y} {_D}:{_D}$", "d/M/yyyy H:m"),
    (rf"^{_D}-{_D}-{_Y}$", "d-M-yyyy"),
    (rf"^{_D}\.{_D}\.{_Y}$", "d.M.yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
    (rf"^{_D}/{_D}/{_Y}$", "M/d/yyyy"),
    (rf"^{_D}-{_D}-{_Y}$", "M-d-yyyy"),
)
MONTH_FIRST = {"d/M/yyyy": "M/d/yyyy", "M/d/yyyy": "d/M/yyyy",
               "d-M-yyyy": "M-d-yyyy", "M-d-yyyy": "d-M-yyyy"}


#: A clock's fraction of a second and zone, which don't change the written day.
_TAIL = rf"^({_Y}-{_D}-{_D}[ T]{_CLOCK})(?:\.\d+)?(?: ?(?:Z|[+-]\d{{2}}:?\d{{2}}))?$"
_SHORT_YEAR = rf"^({_D}[/.-]{_D}[/.-])(\d{{2}})$"


def _full_year(text: Column) -> Column:
    """A two-digit year becomes the nearest one: less than 50 years ahead of today."""
    year = F.regexp_extract(text, _SHORT_YEAR, 2).try_cast("int") + 2000
    year = F.when(year >= F.year(F.current_date()) + 50, year - 100).otherwise(year)
    return F.when(
        text.rlike(_SHORT_YEAR), F.concat(F.regexp_extract(text, _SHORT_YEAR, 1), year.cast("string"))
    ).otherwise(text)


def _parse(text: Column, formats) -> Column:
    def parsed(t: Column) -> Column:
        return F.coalesce(
            *[F.try_to_timestamp(F.when(t.rlike(shape), t), F.lit(layout)).cast("date") for shape, layout in formats]
        )

    # As lambda arguments, the rewritten texts are worked out once for all formats.
    plain = F.transform(F.array(text), lambda t: F.regexp_replace(t, _TAIL, "$1"))
    return F.transform(F.transform(plain, _full_year), parsed)[0]


def date_text(value: Column) -> Column:
    """Text that can be a date; blank, 'nan' and 'None' are null."""
    text = strip(value)
    return F.when(~text.isin("", "nan", "None"), text)


def parse_date(value: Column, text: Column | None = None) -> Column:
    """Day-first date of a text; blank, 'nan' and 'None' are null.

    With ``text``, a column that holds the ``date_text``, dates in the first two formats are read from there: they have neither tail nor
    short year to rewrite, so only other texts go through the lambdas, which aren't compiled.
    """
    if text is None:
        return _parse(date_text(value), DAY_FIRST_FORMATS)
    direct = [F.try_to_timestamp(F.when(text.rlike(shape), text), F.lit(layout)).cast("date") for shape, layout in DAY_FIRST_FORMATS[:2]]
    return F.coalesce(*direct, _parse(text, DAY_FIRST_FORMATS))


def date_folder(value: Column) -> Column:
    """``YYYYMMDD`` folder of a date: eight digits stay, else month first, then day first."""
    text = stringify(value)
    month_first = [(shape, MONTH_FIRST.get(layout, layout)) for shape, layout in DAY_FIRST_FORMATS]
    return F.when(text.rlike(r"^\d{8}$"), text).otherwise(
        F.date_format(_parse(text, month_first), "yyyyMMdd")
    )
