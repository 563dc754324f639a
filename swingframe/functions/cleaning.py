"""Column expressions that clean and conform raw string cells."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from swingframe.constants import BAG_LABELS, CAMERA_CLUBS, DOPPLER_CLUBS


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def safe_double(c: Column) -> Column:
    """Text to double; anything unparseable is null. Java number suffixes (`1.5f`,
    `2d`) are not numbers in an export, so they are refused as well."""
    text = F.rtrim(c)
    suffixed = F.right(text, F.lit(1)).isin("d", "D", "f", "F") & ~F.lower(text).endswith("inf")
    return F.when(~suffixed, c.try_cast("double"))


def clean_double(c: Column) -> Column:
    """Safe cast with NaN as null."""
    return nan_to_null(safe_double(c))


def known_spin(spin: Column) -> Column:
    """Spin is never negative: monitors use a large negative value for "not measured"."""
    return F.when(spin >= 0, spin)


def clean_spin(c: Column) -> Column:
    return known_spin(clean_double(c))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def safe_int(c: Column) -> Column:
    return blank_to_null(F.trim(c)).try_cast("bigint")


def parse_flag(c: Column) -> Column:
    return F.lower(c) == "true"


def null_of(kind: str) -> Column:
    return F.lit(None).cast(kind)


def surrogate_key(*parts: Column) -> Column:
    """Hex md5 of the parts joined with `|`; null if any part is null."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        pieces += [F.lit("|"), part] if i else [part]
    return F.md5(F.concat(*pieces))


def shot_key(source: Column, row_index: Column) -> Column:
    return F.md5(F.concat(source, F.lit("-"), row_index.cast("string")))


def _lookup(c: Column, names: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.element_at(table, c)


def camera_club(code: Column) -> Column:
    return F.coalesce(_lookup(code, CAMERA_CLUBS), code)


def doppler_club(code: Column) -> Column:
    number = F.regexp_extract(code, "^([0-9]+)[IW]$", 1)
    return (
        F.when(_lookup(code, DOPPLER_CLUBS).isNotNull(), _lookup(code, DOPPLER_CLUBS))
        .when(code.rlike("^[0-9]+I$"), F.concat(number, F.lit(" Iron")))
        .when(code.rlike("^[0-9]+W$"), F.concat(number, F.lit(" Wood")))
        .otherwise(code)
    )


def bag_label(c: Column) -> Column:
    """One label per club whatever the export called it: `7i`, `7 Iron`, `#7iron` are `7-iron`."""
    trimmed = F.trim(c)
    lowered = F.lower(trimmed)
    squeezed = F.translate(lowered, " #", "")
    known = _lookup(lowered, BAG_LABELS)
    digits = F.regexp_extract(squeezed, "^([0-9]+)", 1)
    return (
        F.when(known.isNotNull(), known)
        .when(squeezed.rlike("^[0-9]+(i|iron)$"), F.concat(digits, F.lit("-iron")))
        .when(squeezed.rlike("^[0-9]+wood$"), F.concat(digits, F.lit("-wood")))
        .otherwise(trimmed)
    )


def date_in_path(path: Column) -> Column:
    found = blank_to_null(F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})", 1))
    return F.try_to_date(found, "yyyy-MM-dd")


def iso_date(c: Column) -> Column:
    return F.try_to_date(blank_to_null(c), "yyyy-MM-dd")


def date_of_stamp(c: Column) -> Column:
    """Date of a stamp in 24-hour or AM/PM style."""
    return F.to_date(F.coalesce(
        F.try_to_timestamp(c, F.lit("M/d/yy H:mm:ss")),
        F.try_to_timestamp(c, F.lit("M/d/yy h:mm:ss a")),
    ))


def header_name(c: Column) -> Column:
    """Header text to snake case, as an expression over a column of headers."""
    name = F.btrim(F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.when(name == "", "unnamed").otherwise(name)


def header_text(name: str) -> str:
    """The same rule for one header string."""
    return re.sub("[^a-z0-9]+", "_", name.strip().lower()).strip("_") or "unnamed"


def alias_form(name: str) -> str:
    """Header with case and punctuation dropped, the form export aliases are keyed by."""
    return "".join(ch for ch in name.lower() if ch.isalnum())
