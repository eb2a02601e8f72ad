"""Control-table keys: status flags, schedules, versions, location paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talweg.functions.dates import date_folder
from talweg.functions.text import lookup_key, stringify, theme_key

# Status flags, and the schedule directive with its timestamp.
STATUS_FLAGS = ("download", "publish", "schedule", "treatment")
SCHEDULE_PATTERN = (
    r"(?i)(^|[-,;\s])schedule(?:\s+|[:=]+)(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(?::\d{2})?)"
)


def scheduled_for(status: Column) -> Column:
    """Timestamp of the schedule directive, null when absent or not a real time."""
    stamp = F.replace(F.regexp_extract(stringify(status), SCHEDULE_PATTERN, 2), F.lit("T"), F.lit(" "))
    return F.coalesce(
        F.try_to_timestamp(F.when(F.length(stamp) == 19, stamp), F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(F.when(F.length(stamp) == 16, stamp), F.lit("yyyy-MM-dd HH:mm")),
    )


def status_flags(status: Column) -> Column:
    """Sorted distinct flags; the directive is removed first because it contains dashes."""
    text = lookup_key(status)
    planned = scheduled_for(status).isNotNull()
    bare = F.regexp_replace(F.regexp_replace(text, SCHEDULE_PATTERN, "$1"), r"^[ \-,;]+|[ \-,;]+$", "")
    parts = F.transform(F.split(F.when(planned, bare).otherwise(text), "[-,;]"), lambda part: F.trim(part))
    flags = F.filter(parts, lambda part: part != "")
    return F.array_sort(
        F.array_distinct(F.when(planned, F.array_append(flags, F.lit("schedule"))).otherwise(flags))
    )


def invalid_flags(flags: Column) -> Column:
    return F.array_except(flags, F.array(*[F.lit(flag) for flag in STATUS_FLAGS]))


def parse_status(status: Column) -> Column:
    """struct(flags, invalid, scheduled_for) of a status text."""
    flags = status_flags(status)
    return F.struct(
        flags.alias("flags"),
        invalid_flags(flags).alias("invalid"),
        scheduled_for(status).alias("scheduled_for"),
    )


def version_folder(value: Column) -> Column:
    """Two-digit version; '' starts at 00, a trailing '.0' goes, other text is null."""
    text = F.regexp_replace(stringify(value), r"^(\d+)\.0$", "$1")
    digits = F.when(text == "", F.lit("0")).otherwise(text)
    number = F.regexp_replace(F.when(digits.rlike(r"^\d+$"), digits), r"^0+(?=\d)", "")
    return F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number)


def path_part_error(value: Column, field: str) -> Column:
    """Why a value cannot be a path part, null when it can."""
    text = stringify(value)
    return (
        F.when(text == "", F.lit(f"Campo {field} vazio para montagem do caminho."))
        .when(
            text.rlike(r"[/\\]"),
            F.concat(F.lit(f"Campo {field} contem separador de caminho: "), text),
        )
        .when(
            text.rlike(r'[<>:"|?*]'),
            F.concat(F.lit(f"Campo {field} contem caractere invalido: "), text),
        )
    )


def location_key(
    base: str,
    stage: str,
    access: Column,
    category: Column,
    theme: Column,
    citation: Column,
    date: Column,
    version: Column | None = None,
) -> Column:
    """struct(path, error) of ``base/stage/access/category/theme/citation/date[/version]``."""
    folder = date_folder(date)
    date_error = (
        F.when(stringify(date) == "", F.lit("Campo date vazio para versionamento."))
        .when(folder.isNull(), F.concat(F.lit("Campo date invalido para versionamento: "), date))
    )
    theme_part = theme_key(theme)
    errors = [
        date_error,
        path_part_error(access, "access_constraints"),
        path_part_error(category, "category_acronym"),
        path_part_error(theme_part, "theme_folder"),
        path_part_error(citation, "citation"),
    ]
    parts = [F.lit(base), F.lit(stage), stringify(access), stringify(category), theme_part,
             stringify(citation), folder]
    if version is not None:
        number = version_folder(version)
        errors.append(
            F.when(number.isNull(), F.concat(F.lit("Versao invalida: "), version.cast("string")))
        )
        parts.append(number)
    error = F.coalesce(*errors)
    return F.struct(
        F.when(error.isNull(), F.concat_ws("/", *parts)).alias("path"), error.alias("error")
    )
