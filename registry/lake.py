"""Clean and star tables of a data folder, written once per application.

Later layers read what earlier layers wrote, as in any lakehouse; the queries that
test a layer's own job compute it from the layer before.
"""

from __future__ import annotations

from millrace import lookups
from millrace.plans import clean, star
from millrace.session import path_exists, scratch_path, side_by_side, stable
from millrace.sinks.files import write_table
from registry.fixtures import EXTRA_UNITS, HOUSING_CODES, HOUSING_SINCE, SYMBOLS, Data

_written: dict[tuple[str, str, str], dict] = {}


def units(d: Data):
    return lookups.series_units(d.spark, EXTRA_UNITS)


def clean_tables(d: Data, **given) -> dict:
    """``given``: fixtures already written, which others read several times."""
    meta = d.view("fx_meta", **given)
    return {
        "indicators": clean.clean_indicators(d.view("fx_raw_indicators", **given), meta, newest="load_id"),
        "meta": clean.clean_metadata(meta),
        "housing": clean.clean_housing(
            d.fx_housing, d.fx_housing_indicators, d.fx_regions, HOUSING_CODES, HOUSING_SINCE
        ),
        "bars": clean.clean_bars(d.fx_raw_bars, SYMBOLS, newest="load_id"),
    }


def _layer(d: Data, layer: str, build, by_year: dict[str, list[str]]) -> dict:
    """What ``build`` makes for a folder, written there side by side but for what it has written itself.

    ``by_year``: the tables partitioned by year, with their order within a file.
    """
    key = (d.spark.sparkContext.applicationId, d.sf_dir, layer)
    if key not in _written:
        root = scratch_path(d.spark, layer)

        def written(name, df):
            if not path_exists(d.spark, f"{root}/{name}"):
                write_table(
                    df, f"{root}/{name}", partition_by=["year"] if name in by_year else None,
                    sort_by=by_year.get(name, []),
                )
            return d.spark.read.parquet(f"{root}/{name}")

        built = build(root)
        _written[key] = side_by_side(
            d.spark, {name: lambda name=name, df=df: written(name, df) for name, df in built.items()}
        )
    return dict(_written[key])


def silver(d: Data) -> dict:
    return _layer(
        d, "clean", lambda _: clean_tables(d, fx_indicators=stable(d.fx_indicators)), {"indicators": [], "bars": []}
    )


def gold(d: Data) -> dict:
    s = silver(d)
    return _layer(
        d, "star",
        lambda root: star.build_star(s["indicators"], s["meta"], s["housing"], s["bars"], units(d), path=root),
        {"fact_value": ["asset_key", "realestate_indicator_key", "socioeconomical_indicator_key", "date_key"]},
    )
