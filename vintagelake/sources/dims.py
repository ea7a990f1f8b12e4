"""Dimension tables.

Dimensions are data: every provider takes them as DataFrame arguments.  The
defaults below are the published values, built as small DataFrames whose size
is fixed by construction (so broadcasting them is safe).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vintagelake import schemas
from vintagelake.session import local_frame

# ---------------------------------------------------------------------------
# Fixed values (must equal the published configuration for equal results).
# Release provider: dataset id -> location, in the order they are processed.
# ---------------------------------------------------------------------------
RELEASE_DATASETS = [
    ("1064", "Alaska"),
    ("1235", "Hawaii"),
    ("6460", "Midland Texas"),
    ("6461", "Delaware NM"),
    ("6462", "Permian"),
    ("6463", "Eagle Ford"),
    ("6464", "Williston"),
    ("6465", "DJ Basin"),
    ("6466", "Gulf of Mexico"),
    ("6468", "Delaware TX"),
    ("6495", "U.S."),
    ("6496", "PADD 1"),
    ("6497", "PADD 2"),
    ("6498", "PADD 3"),
    ("6499", "PADD 4"),
    ("6500", "PADD 5"),
    ("15149", "Anadarko"),
    ("15150", "Outside Major Basins"),
    ("141778", "Total US Offshore"),
    ("141840", "Total US Onshore"),
    ("142073", "Appalachia"),
    ("142077", "Arkoma Woodford"),
    ("142078", "Bakken MT"),
    ("142079", "Bakken ND"),
    ("142086", "Barnett"),
    ("142093", "Fayetteville"),
    ("142097", "Greater Green River"),
    ("142101", "Haynesville"),
    ("142102", "Powder River"),
    ("142106", "Niobrara"),
    ("142110", "Permian Basin Other"),
    ("142117", "San Juan"),
    ("142121", "Uinta"),
    ("142122", "California"),
]

# Edition provider: series id -> location; the id list is also the scan filter.
EDITION_SERIES = [
    ("COPRAP", "Appalachia"),
    ("COPRBK", "Bakken"),
    ("COPREF", "Eagle Ford"),
    ("COPRHA", "Haynesville"),
    ("COPRPM", "Permian"),
    ("COPRPUS", "U.S."),
    ("COPRR48", "Rest of Lower 48"),
    ("PAPR48NGOM", "Lower 48 (excl GOM)"),
    ("PAPRPAK", "Alaska"),
    ("PAPRPGLF", "Gulf of Mexico"),
]
EDITION_FORECAST_FLAG = "Forecast"
EDITION_SCALE = 1000.0

# Report provider, regional rollups, in the order they are applied.
# (target, null policy, components); "propagate" = plain a + b, "skip" = row sum
# that skips missing values and gives 0 when all are missing.
REPORT_ROLLUPS = [
    ("DJ Basin", "propagate", ["Wyoming Denver Julesberg", "Colorado Denver Julesberg"]),
    ("Permian", "skip", ["Permian New Mexico", "Texas Dist 7C", "Texas Dist 8", "Texas Dist 8A"]),
    ("Gulf of Mexico", "skip", ["Gulf of Mexico - Deepwater", "Gulf of Mexico - Shelf"]),
    ("Colorado", "skip", ["Colorado Denver Julesberg", "Colorado Other", "Colorado Piceance",
                          "Colorado San Juan"]),
    ("Utah", "skip", ["Utah Other", "Utah Uinta"]),
    ("Wyoming", "skip", ["Wyoming Big Horn", "Wyoming Green/Wind/OT", "Wyoming Powder"]),
    ("Texas", "skip", ["Texas Dist 1", "Texas Dist 10", "Texas Dist 2", "Texas Dist 3",
                       "Texas Dist 4", "Texas Dist 5", "Texas Dist 6", "Texas Dist 7B",
                       "Texas Dist 7C", "Texas Dist 8", "Texas Dist 8A", "Texas Dist 9"]),
    ("New Mexico", "skip", ["Permian New Mexico", "New Mexico San Juan"]),
]
# The original job, as published, writes the Wyoming sum into the "Utah" column.  This
# variant reproduces that output; the default above keeps both regions.
REPORT_ROLLUPS_AS_DEPLOYED = [
    (("Utah" if target == "Wyoming" else target), policy, components)
    for target, policy, components in REPORT_ROLLUPS
]
REPORT_RENAMES = [("United States", "U.S.")]
REPORT_ITEM = "crudeOilProduction"
REPORT_FALLBACK_DAYS = 7

# Source names of the output.
SOURCE_NAMES = {"release": "Energy Aspects", "report": "Genscape", "edition": "EIA STEO"}


def dataset_dim(spark: SparkSession, rows=None) -> DataFrame:
    rows = RELEASE_DATASETS if rows is None else rows
    return local_frame(spark, [(d, loc, i) for i, (d, loc) in enumerate(rows)], schemas.DATASET_DIM)


def series_dim(spark: SparkSession, rows=None) -> DataFrame:
    return local_frame(spark, EDITION_SERIES if rows is None else rows, schemas.SERIES_DIM)


def hierarchy(spark: SparkSession, rollups=None) -> DataFrame:
    """Rollup list -> (target, component, null_policy, rule) rows.

    ``rule`` is the position of the rollup: when two rollups write the same
    target, the later one that can be computed wins.
    """
    rollups = REPORT_ROLLUPS if rollups is None else rollups
    rows = [(target, comp, policy, rule)
            for rule, (target, policy, comps) in enumerate(rollups)
            for comp in comps]
    return local_frame(spark, rows, schemas.HIERARCHY)


def rename_dim(spark: SparkSession, rows=None) -> DataFrame:
    return local_frame(spark, REPORT_RENAMES if rows is None else rows, schemas.RENAME_DIM)
