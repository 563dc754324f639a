"""The registered launch-monitor sources."""

from __future__ import annotations

from dataclasses import dataclass

from swingframe.constants import SESSION_COLUMNS


@dataclass(frozen=True)
class Source:
    """How one monitor's CSV files look and where they land."""

    name: str
    path_pattern: str  # regex over paths below the landing root
    bronze_table: str
    has_units_row: bool = False  # physical line 2 holds [mph], [deg], ...
    encoding: str = "UTF-8"  # a leading byte-order mark is always dropped
    # True reads quoted line breaks, one task per file. False splits big files.
    multi_line: bool = True
    # Header of every file, where known; saves the pass that reads the headers.
    header: tuple[str, ...] = ()


SOURCES: dict[str, Source] = {
    "trackman": Source("trackman", r"^trackman/.*\.csv$", "trackman_raw", has_units_row=True),
    "foresight": Source("foresight", r"^foresight/.*\.csv$", "foresight_raw", has_units_row=True),
    "caddieset": Source("caddieset", r"^caddieset/.*\.csv$", "caddieset_raw"),
    "flightscope": Source("flightscope", r"^range/.*\.csv$", "flightscope_raw"),
}
MANUAL = Source("manual", r"^manual/.*\.csv$", "manual_raw", header=tuple(SESSION_COLUMNS))


def get_source(name: str) -> Source:
    try:
        return SOURCES[name]
    except KeyError:
        raise LookupError(f"unknown source {name!r}; valid sources: {', '.join(sorted(SOURCES))}") from None
