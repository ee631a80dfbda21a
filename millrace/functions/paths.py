"""Reading a ``;``-separated region path whose layout depends on the region type."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def part(path: Column, index: int) -> Column:
    """Field ``index`` of the path, NULL past its end."""
    return F.get(F.split(path, ";"), F.lit(index))


def before_last_comma(text: Column) -> Column:
    """The text up to its last comma, or all of it when it has none."""
    return F.when(text.contains(","), F.regexp_extract(text, r"(?s)^(.*),[^,]*$", 1)).otherwise(text)


def after_last_comma(text: Column) -> Column:
    return F.trim(F.substring_index(text, ",", -1))


def state_code(path: Column, kind: Column, code_of_state: Column) -> Column:
    """``code_of_state`` is the code found for a path that is just a state's name."""
    return (
        F.when(kind == "state", code_of_state)
        .when((kind == "metro") & path.contains(","), after_last_comma(path))
        .when(kind.isin("metro", "county", "city", "zip", "neigh"), part(path, 1))
    )


def metro_name(path: Column, kind: Column) -> Column:
    inner = before_last_comma(part(path, 2))
    return (
        F.when((kind == "metro") & path.contains(","), F.trim(before_last_comma(path)))
        .when(kind == "metro", path)
        .when(kind.isin("county", "city", "zip", "neigh"), F.nullif(inner, F.lit("nan")))
    )


def county_name(path: Column, kind: Column) -> Column:
    return (
        F.when(kind == "county", part(path, 0))
        .when(kind.isin("city", "zip"), part(path, 3))
        .when(kind == "neigh", part(path, 4))
    )


def city_name(path: Column, kind: Column) -> Column:
    return F.when(kind == "city", part(path, 0)).when(kind.isin("zip", "neigh"), part(path, 3))


def zip_key(path: Column, kind: Column) -> Column:
    first = part(path, 0)
    return F.when(kind == "zip", F.when(first == "nan", "00000").otherwise(first))


def neighborhood_name(path: Column, kind: Column) -> Column:
    return F.when(kind == "neigh", part(path, 0))
