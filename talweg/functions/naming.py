"""Column naming contract: immutable source columns and derived columns."""

from __future__ import annotations

SOURCE_PREFIX = "sdb_"
DERIVED_PREFIX = "acm_"
GEOMETRY = "geometry"
SRID = "srid"
ID_COLUMN = "acm_id"
FID_COLUMN = "fid"
REPAIR_FLAG = "__internal_geom_null_safe_repair"
AREA, PERIMETER, LONGITUDE, LATITUDE = "acm_a_ha", "acm_prm_km", "acm_long", "acm_lat"


def source_name(column: str) -> str:
    name = column.lower().replace(" ", "_")
    return name if name.startswith(SOURCE_PREFIX) else SOURCE_PREFIX + name


def derived_name(column: str) -> str:
    if column.startswith(DERIVED_PREFIX):
        return column
    return DERIVED_PREFIX + column.removeprefix(SOURCE_PREFIX)


def source_of_derived(column: str) -> str:
    return SOURCE_PREFIX + column.removeprefix(DERIVED_PREFIX)
