"""Text functions: convention strings, feature lists, locations."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import FragmentError

# Lowest convention minor version an aggregation may claim, the
# feature keywords of each known layout in rising priority, and the
# substitutions that always apply to a location.
MIN_MINOR = 12
FEATURES = {
    "primary": ("map", "uris", "identifiers"),
    "secondary": ("map", "unique_values"),
    "interim": ("shape", "location", "address"),
    "beta": ("location", "file", "format"),
}
DEFAULT_SUBSTITUTIONS = {"file:///": "/"}


def raise_conventions(value: Column, minor: int = MIN_MINOR) -> Column:
    """Raise each ``CF-1.x`` entry to at least ``CF-1.<minor>``; keep all else.

    Entries are separated by commas, or by blanks where there is no comma.
    """
    def lift(entry: Column) -> Column:
        found = F.regexp_extract(entry, r"^\s*CF-1\.(\d+)\s*$", 1).try_cast("int")
        return F.when(
            entry.rlike(r"^\s*CF(-1(\.\d+)?)?\s*$"),
            F.concat(
                F.regexp_extract(entry, r"^(\s*)", 1),
                F.lit("CF-1."),
                F.greatest(F.coalesce(found, F.lit(0)), F.lit(minor)).cast("string"),
            ),
        ).otherwise(entry)

    def joined(by: str) -> Column:
        return F.array_join(F.transform(F.split(value, by), lift), by)

    return F.when(value.contains(","), joined(",")).otherwise(joined(" "))


def parse_features(text: Column) -> Column:
    """``"map: a uris: b"`` as a map; order and extra blanks do not matter."""
    tidy = F.regexp_replace(F.trim(F.regexp_replace(text, r"\s+", " ")), ": ", "\u0001")
    return F.str_to_map(tidy, F.lit(" "), F.lit("\u0001"))


def detect_convention(features: Column) -> Column:
    """Name of the layout whose keywords are all present; the last match wins."""
    keys = F.map_keys(features)
    found = F.lit(None).cast("string")
    for name, needed in FEATURES.items():
        absent = F.size(F.array_except(F.array(*[F.lit(n) for n in needed]), keys))
        found = F.when(absent == 0, F.lit(name)).otherwise(found)
    return found


def substitute(location: Column, substitutions: dict[str, str]) -> Column:
    """Replace each key by its value, in order."""
    for base, sub in substitutions.items():
        location = F.replace(location, F.lit(base), F.lit(sub))
    return location


def substitute_all(locations: Column, substitutions: dict[str, str]) -> Column:
    """Apply :func:`substitute` to every version of a location."""
    return F.transform(locations, lambda u: substitute(u, substitutions))


def parse_substitutions(text: str) -> dict[str, str]:
    """``"${a}: x ${b}: y"`` as an ordered dictionary; text that is not made of such pairs is an error."""
    pair = r"\s*(\S+):\s+(\S+)(?=\s|$)"
    if not re.fullmatch(f"(?:{pair})*\\s*", text):
        raise FragmentError(f"substitutions are pairs of 'key: value', not {text!r}")
    return dict(re.findall(pair, text))


def is_absolute(location: Column) -> Column:
    """A location that begins with a scheme, or with a slash."""
    return location.rlike(r"^([A-Za-z][A-Za-z0-9+.\-]*:|/)")


def resolve_relative(location: Column, base: str) -> Column:
    """Relative locations count from the folder of the manifest; ``..`` is folded."""
    joined = F.concat(F.lit(base.rstrip("/") + "/"), location)

    def fold(path: Column, part: Column) -> Column:
        up = F.slice(path, 1, F.greatest(F.size(path) - 1, F.lit(0)))
        return F.when(part == "..", up).when(part == ".", path).otherwise(F.array_append(path, part))

    empty = F.array().cast("array<string>")
    folded = F.array_join(F.aggregate(F.split(joined, "/"), empty, fold), "/")
    return F.when(is_absolute(location), location).otherwise(folded)
