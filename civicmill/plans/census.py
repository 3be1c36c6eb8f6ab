"""Census files to Census.RedistEquiv, Census.Raw and Census.VTDFormatted."""

from pyspark.sql import functions as F

from civicmill import schemas
from civicmill.functions.casts import conform
from civicmill.operators.lookup import left_lookup
from civicmill.operators.merge import merge_records, nest_many
from civicmill.plans.warehouse import overwrite_table
from civicmill.sources.csv_sets import read_csv_set
from civicmill.sources.lines import packed_cell, parse_fixed_width, parse_ranges, read_lines

COUNTY_LEVEL, SUBDIVISION_LEVEL, VTD_LEVEL = 50, 60, 710

# Cells of the packed ranges that the formatted table shows (fixed values).
ADULT_CELLS = {"TotalOver18": 0, "HispanicOver18": 1, "WhiteNonHispanicOver18": 4, "BlackNonHispanicOver18": 5}
HOUSING_CELLS = {"TotalHousingUnits": 0, "OccupiedHousingUnits": 1, "VacantHousingUnits": 2}


def merge_census(geo_lines, part1_lines, part2_lines):
    """The three files as one row per record number."""
    cell = schemas.CENSUS_RECORD_CELL
    sides = [
        parse_fixed_width(geo_lines, schemas.CENSUS_GEO_LAYOUT),
        parse_ranges(part1_lines, cell, schemas.CENSUS_PART1_RANGES),
        parse_ranges(part2_lines, cell, schemas.CENSUS_PART2_RANGES),
    ]
    return merge_records(sides, "LOGRECNO")


def with_names(rows, levels, name="NAME"):
    """Add county and subdivision names found in the higher-level rows of the same table."""
    counties = levels.where(F.col("SUMLEV") == COUNTY_LEVEL).select("COUNTY", name)
    subdivisions = levels.where(F.col("SUMLEV") == SUBDIVISION_LEVEL).select("COUNTY", "COUSUB", name)
    named = left_lookup(rows, counties, {"COUNTY": "COUNTY"}, {"CountyName": name})
    return left_lookup(
        named, subdivisions, {"COUNTY": "COUNTY", "COUSUB": "COUSUB"}, {"CousubName": name}
    )


def format_vtds(raw, equivalents):
    """One row per voting district with names, adult and housing counts, and its election
    districts as an array."""
    vtds = raw.where(F.col("SUMLEV") == VTD_LEVEL).select(
        "COUNTY", "COUSUB", "LOGRECNO", "VTD",
        *[packed_cell(F.col("P4_HISPANIC18OLDER"), i).alias(n) for n, i in ADULT_CELLS.items()],
        *[packed_cell(F.col("H1_OCCUPANCY"), i).alias(n) for n, i in HOUSING_CELLS.items()],
    )
    nested = nest_many(
        with_names(vtds, raw),
        equivalents,
        {"COUNTY": "COUNTY", "COUSUB": "COUSUB", "VTD": "VTD08"},
        {"WARD": "WARD", "AD": "AD", "ED": "ED"},
        "ElectionDistricts",
    )
    return conform(nested, schemas.VTD_FORMATTED)


def load_census(spark, geo, part1, part2, mapping):
    """The whole job; ``mapping`` is the folder of district mapping CSVs."""
    equivalents = overwrite_table(
        read_csv_set(spark, mapping, schemas.REDIST_EQUIV), "Census.RedistEquiv"
    )
    merged = merge_census(*[read_lines(spark, p) for p in (geo, part1, part2)])
    raw = overwrite_table(merged, "Census.Raw", schemas.CENSUS_RAW)
    overwrite_table(format_vtds(raw, equivalents), "Census.VTDFormatted")
