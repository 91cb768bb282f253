"""Clean-up of line codes, stop codes, station names and mixed JSON members, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Line types, speed caps and legal limits of the city network.
METRO = (1, 2, 5, 6)
TRAM = (3, 4, 7, 8, 9, 19, 25, 39, 44, 51, 55, 62, 81, 82, 92, 93, 97)
MAX_SPEED = {"metro": 250, "tram": 60, "bus": 80}
LEGAL_LIMIT = {"metro": 50, "tram": 30}
LEGAL_LIMIT_OF_LINE = {12: 100}
LEGAL_LIMIT_ELSE = 50
UNKNOWN_COLOR = "#000000"


def unpadded(code: Column) -> Column:
    return F.regexp_replace(code, "^0+", "")


def gtfs_line_number(line: Column) -> Column:
    """A timetable's line as a number: a night line's first character becomes 2, padding and B, M, T go."""
    return F.translate(unpadded(F.when(F.contains(line, F.lit("N")), F.concat(F.lit("2"), F.substr(line, F.lit(2)))).otherwise(line)), "BMT", "").cast("int")


def generic_line(line: Column) -> Column:
    return F.translate(unpadded(line), "BMTbmt", "")


def shape_line_number(line: Column) -> Column:
    return F.translate(unpadded(line), "bmt", "").cast("int")


def shape_line_name(line: Column) -> Column:
    """A shape's line as stops name it: a leading 2 is a night line's N."""
    return F.translate(unpadded(F.when(F.startswith(line, F.lit("2")), F.concat(F.lit("N"), F.substr(line, F.lit(2)))).otherwise(line)), "bmt", "")


def live_line_name(line: Column, compat: bool = False) -> Column:
    """A live feed's line without a trailing .0 and without T; compat takes any character before each 0 along, as a pattern `.0` does."""
    return F.regexp_replace(F.trim(line), ".0|T" if compat else r"\.0$|T", "")


def live_stop_number(stop: Column) -> Column:
    return F.regexp_replace(stop, "[FGHCBPA]", "").cast("int")


def stop_number(stop: Column) -> Column:
    """Letters go; nothing left is 0."""
    digits = F.regexp_replace(F.coalesce(stop, F.lit("")), "[A-Za-z]", "")
    return F.when(digits == "", F.lit(0).cast("long")).otherwise(digits.cast("long"))


def station_key(name: Column) -> Column:
    """A station's name to compare by: upper case, without spaces, apostrophes and a platform mark in brackets."""
    return F.translate(F.regexp_replace(F.upper(name), r"\((A|B)\)", ""), " '", "")


def operator_station_key(name: Column) -> Column:
    return F.translate(F.upper(name), " '", "")


def member(value: Column, *paths: str) -> Column:
    """The first of the paths that a JSON text has; an empty string if it has none."""
    return F.coalesce(*(F.get_json_object(value, p) for p in paths), F.lit(""))


def direction_letter(direction: Column) -> Column:
    return F.when(direction == "City", F.lit("V")).otherwise(F.lit("F"))


def direction_number(letter: Column) -> Column:
    return F.when(letter == "V", F.lit(1)).when(letter == "F", F.lit(2))


def line_type(line: Column) -> Column:
    number = line.try_cast("int")
    return F.when(number.isin(*METRO), F.lit("metro")).when(number.isin(*TRAM), F.lit("tram")).otherwise(F.lit("bus"))


def _of_type(line: Column, values: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for kind, value in values.items():
        out = F.when(line_type(line) == kind, F.lit(value)).otherwise(out)
    return out


def max_speed(line: Column) -> Column:
    return _of_type(line, MAX_SPEED, MAX_SPEED["bus"])


def legal_limit(line: Column) -> Column:
    out = _of_type(line, LEGAL_LIMIT, LEGAL_LIMIT_ELSE)
    for number, value in LEGAL_LIMIT_OF_LINE.items():
        out = F.when(line.try_cast("int") == number, F.lit(value)).otherwise(out)
    return out


def mapped(code: Column, labels: dict) -> Column:
    """The label of a code; null for a code without one."""
    return F.create_map(*(F.lit(x) for pair in labels.items() for x in pair))[code]
