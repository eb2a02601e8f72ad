"""Spatial treatment of feature tables: metrics, bounds, clipping, relocation, repair."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talweg.functions import geometry as g
from talweg.functions.naming import AREA, GEOMETRY, LATITUDE, LONGITUDE, PERIMETER, REPAIR_FLAG, SRID
from talweg.functions.projection import GEOGRAPHIC, SIRGAS2000, WGS84

# Default region box and the columns that record a relocation.
REGION_BOX = (-73.99044999999995, -37.245154277004936, -25.290947335149315, 8.757636788451368)
RELOCATED_LONGITUDE, RELOCATED_LATITUDE = "acm_long_centroide_brasil", "acm_lat_centroide_brasil"
# State envelopes (minx, miny, maxx, maxy).
STATE_BOUNDS = {
    "ac": (-74.1, -11.2, -66.5, -7.0),
    "al": (-38.4, -10.7, -35.1, -8.7),
    "am": (-74.0, -10.1, -56.0, 2.4),
    "ap": (-54.9, -1.4, -49.6, 4.6),
    "ba": (-46.8, -18.5, -37.2, -8.4),
    "ce": (-41.5, -7.9, -37.1, -2.7),
    "df": (-48.4, -16.1, -47.3, -15.4),
    "es": (-41.9, -21.4, -39.6, -17.8),
    "go": (-53.4, -19.6, -45.8, -12.3),
    "ma": (-49.0, -11.0, -41.0, 0.0),
    "mg": (-52.5, -23.0, -39.8, -14.0),
    "ms": (-58.3, -24.2, -50.8, -17.0),
    "mt": (-61.8, -18.2, -50.0, -7.2),
    "pa": (-59.0, -10.0, -46.0, 2.7),
    "pb": (-38.9, -8.4, -34.7, -6.0),
    "pe": (-41.5, -9.7, -34.8, -7.2),
    "pi": (-46.9, -11.1, -40.2, -2.7),
    "pr": (-54.8, -26.8, -48.0, -22.2),
    "rj": (-44.9, -23.4, -40.9, -20.7),
    "rn": (-38.8, -7.0, -34.8, -4.8),
    "ro": (-66.9, -13.8, -59.7, -7.8),
    "rr": (-64.9, -1.7, -58.8, 5.4),
    "rs": (-57.8, -33.9, -49.6, -27.0),
    "sc": (-54.0, -29.4, -48.3, -25.8),
    "se": (-38.3, -11.6, -36.3, -9.5),
    "sp": (-53.2, -25.4, -43.9, -19.7),
    "to": (-50.9, -13.7, -45.5, -5.0),
}
_FACTS = "_facts"


def with_facts(df: DataFrame, out: str = _FACTS, once: bool = False) -> DataFrame:
    """Facts struct of every geometry; ``once`` where rows are filtered by it right after."""
    facts = g.geometry_facts_once if once else g.geometry_facts
    return df.withColumn(out, facts(F.col(GEOMETRY)))


def _srid(df: DataFrame, assumed_srid: int) -> Column:
    return F.coalesce(F.col(SRID), F.lit(assumed_srid)) if SRID in df.columns else F.lit(assumed_srid)


def reproject(df: DataFrame, assumed_srid: int = SIRGAS2000) -> DataFrame:
    """Geometry in EPSG:4326; a missing reference system is assumed."""
    return df.withColumn(GEOMETRY, g.to_geographic(F.col(GEOMETRY), _srid(df, assumed_srid))).withColumn(SRID, F.lit(WGS84))


def geographic_2d(df: DataFrame, out: str = _FACTS, assumed_srid: int = SIRGAS2000) -> DataFrame:
    """Reprojected geometry without Z and M, with the facts from before these were dropped, in one look."""
    looked = df.withColumn("_look", g.geographic_2d(F.col(GEOMETRY), _srid(df, assumed_srid)))
    return looked.withColumns({GEOMETRY: F.col("_look.geometry"), out: F.col("_look.facts"), SRID: F.lit(WGS84)}).drop("_look")


def needs_reprojection(df: DataFrame, assumed_srid: int = SIRGAS2000) -> Column:
    """Rows with a geometry in another system than EPSG:4326; a missing system is the assumed one."""
    return F.col(GEOMETRY).isNotNull() & (_srid(df, assumed_srid) != WGS84)


def force_2d(df: DataFrame) -> DataFrame:
    return df.withColumn(GEOMETRY, g.force_2d(F.col(GEOMETRY)))


def count_3d(df: DataFrame) -> DataFrame:
    """How many non-empty geometries carry Z or M."""
    facts = g.geometry_facts(F.col(GEOMETRY))
    return df.select(facts.alias("f")).agg(
        F.count_if((F.col("f.dims") > 2) & ~F.col("f.is_empty")).alias("forced_to_2d")
    )


def geographic_range_ok(facts: Column, srid: Column) -> Column:
    """Bounds fit ±180/±90; null, empty and non-geographic geometries pass."""
    inside = (
        facts["finite"] & (facts["minx"] >= -180) & (facts["maxx"] <= 180)
        & (facts["miny"] >= -90) & (facts["maxy"] <= 90)
    )
    skipped = facts["kind"].isNull() | facts["is_empty"] | ~F.coalesce(srid.isin(*GEOGRAPHIC), F.lit(False))
    return F.coalesce(skipped | inside, F.lit(False))


def measurable(facts: Column) -> Column:
    return facts["finite"] & ~facts["kind"].isin("Point", "MultiPoint")


def has_measurable(df: DataFrame) -> DataFrame:
    return with_facts(df).agg(F.coalesce(F.bool_or(measurable(F.col(_FACTS))), F.lit(False)).alias("measurable"))


def geometry_kind(df: DataFrame) -> DataFrame:
    """Layer kind: polygon if any, else line, else point; 'point' when there is nothing."""
    kind = F.col(f"{_FACTS}.kind")
    rank = F.when(F.contains(kind, F.lit("Polygon")), 3).when(F.contains(kind, F.lit("LineString")), 2).otherwise(1)
    top = F.max(F.when(kind.isNotNull() & ~F.col(f"{_FACTS}.is_empty"), rank))
    label = F.when(F.col("top") == 3, "polygon").when(F.col("top") == 2, "line").otherwise("point")
    return with_facts(df).agg(top.alias("top")).select(label.alias("geometry_kind"))


def _scaled(value: Column, unit: float) -> Column:
    """Half-even rounding to six places: scale, round to the nearest even integer, unscale."""
    return F.rint(value / F.lit(unit) * F.lit(1e6)) / F.lit(1e6)


def metric_values(facts: Column) -> dict[str, Column]:
    """Area (ha), perimeter (km) and centroid columns of a facts struct."""
    return {
        AREA: F.when(facts["finite"], _scaled(facts["area_m2"], 10000.0)),
        PERIMETER: F.when(facts["finite"], _scaled(facts["length_m"], 1000.0)),
        LONGITUDE: F.when(facts["finite"], _scaled(facts["centroid_x"], 1.0)),
        LATITUDE: F.when(facts["finite"], _scaled(facts["centroid_y"], 1.0)),
    }


def spatial_metrics(df: DataFrame, measure: bool = True) -> DataFrame:
    """Area (ha), perimeter (km) and centroid, six places, from one pass over the geometry.

    ``measure`` is off for point layers, which have no area or perimeter columns.
    """
    values = metric_values(F.col(_FACTS))
    wanted = values if measure else {k: values[k] for k in (LONGITUDE, LATITUDE)}
    return with_facts(df).withColumns(wanted).drop(_FACTS)


def lacks_metrics(df: DataFrame) -> Column:
    """Rows with a geometry and without one of the metrics that the table has."""
    lacking = F.lit(False)
    for name in (AREA, PERIMETER, LONGITUDE, LATITUDE):
        if name in df.columns:
            lacking = lacking | F.col(name).isNull()
    return lacking & F.col(GEOMETRY).isNotNull()


def fill_missing_metrics(df: DataFrame) -> DataFrame:
    """Metrics of rows that lack one are all computed again.

    Area and perimeter of a set of rows without any measurable shape stay as they are.
    """
    present = [c for c in (AREA, PERIMETER, LONGITUDE, LATITUDE) if c in df.columns]
    if not present or GEOMETRY not in df.columns:
        return df
    lacking = lacks_metrics(df)
    facts = g.geometry_facts(F.when(lacking, F.col(GEOMETRY)))
    values = metric_values(F.col(_FACTS))
    return (
        df.withColumn("_lacking", lacking)
        .withColumn(_FACTS, facts)
        .withColumns({c: F.when(F.col("_lacking"), values[c]).otherwise(F.col(c)) for c in present})
        .drop(_FACTS, "_lacking")
    )


def finite_geometry(facts: Column) -> Column:
    """Non-null, non-empty, finite bounds."""
    return F.coalesce(facts["finite"], F.lit(False))


def box_overlaps(facts: Column, box: tuple[float, float, float, float]) -> Column:
    return (
        (facts["maxx"] >= box[0]) & (facts["minx"] <= box[2])
        & (facts["maxy"] >= box[1]) & (facts["miny"] <= box[3])
    )


def box_covers(facts: Column, box) -> Column:
    return (
        (facts["minx"] >= box[0]) & (facts["maxx"] <= box[2])
        & (facts["miny"] >= box[1]) & (facts["maxy"] <= box[3])
    )


@dataclass(frozen=True)
class Region:
    """Region of interest: a box by default, or a polygon given as WKB."""

    box: tuple[float, float, float, float] = REGION_BOX
    polygon: bytes | None = None

    @classmethod
    def of_polygon(cls, wkb: bytes) -> "Region":
        from talweg.functions.shapes import bounds, read_shapes
        import pyarrow as pa

        return cls(tuple(float(v) for v in bounds(read_shapes(pa.array([wkb])))[0]), wkb)

    def anchor(self) -> tuple[float, float]:
        """Centroid when the region covers it, else a point inside, fixed when the plan is built."""
        if self.polygon is None:
            return (self.box[0] + self.box[2]) / 2, (self.box[1] + self.box[3]) / 2
        from talweg.functions.shapes import centroids, read_shapes
        import pyarrow as pa

        x, y = centroids(read_shapes(pa.array([self.polygon])))[0]
        return (x, y) if _covers(self.polygon, x, y) else _interior_point(self.polygon)


def _covers(wkb, x, y) -> bool:
    import numpy as np

    from talweg.functions.prepared import Prepared

    return bool(Prepared(wkb).locate(np.array([[x, y]]))[0] >= 0)


def _interior_point(wkb):
    """Middle of the widest inside interval on the horizontal line through the middle."""
    import numpy as np

    from talweg.functions.shapes import read_tree

    areas, _ = g._areas_and_paths(read_tree(wkb)[0])
    rings = [r for rings in areas for r in rings]
    heights = np.unique(np.concatenate([r[:, 1] for r in rings]))
    middle = (heights[0] + heights[-1]) / 2
    above, below = heights[heights > middle].min(), heights[heights <= middle].max()
    y = (above + below) / 2
    cuts = sorted(
        float(a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]))
        for r in rings for a, b in zip(r[:-1], r[1:]) if (a[1] > y) != (b[1] > y)
    )
    left, right = max(zip(cuts[::2], cuts[1::2]), key=lambda pair: pair[1] - pair[0])
    return (left + right) / 2, float(y)


def intersects_region(df: DataFrame, region: Region, out: str) -> DataFrame:
    """Exact intersection flag: bounds decide most rows, only undecided geometries are tested."""
    facts = F.col(_FACTS)
    present = finite_geometry(facts)
    overlap = present & box_overlaps(facts, region.box)
    sure = present & (box_covers(facts, region.box) | (facts["kind"] == "Point"))
    if region.polygon is not None:
        sure = F.lit(False)
    undecided = F.when(overlap & ~sure, F.col(GEOMETRY))
    tested = F.coalesce(g.meets_polygon(undecided, region.polygon or g.box_wkb(*region.box)), F.lit(False))
    return with_facts(df, once=True).withColumn(out, F.coalesce(overlap & (sure | tested), F.lit(False))).drop(_FACTS)


def filter_to_region(df: DataFrame, region: Region = Region()) -> DataFrame:
    """Keep features that meet the region; null and empty geometries go."""
    return intersects_region(df, region, "_in").filter("_in").drop("_in")


def relocate_outside(df: DataFrame, region: Region = Region()) -> DataFrame:
    """Features off the region move to its anchor; two columns record where, null inside."""
    x, y = region.anchor()
    lon, lat = round(x, 6), round(y, 6)
    flagged = intersects_region(df, region, "_in")
    flagged = flagged.withColumn("_out", ~F.col("_in") & F.col(GEOMETRY).isNotNull() & (F.length(GEOMETRY) > 0))
    flagged = flagged.withColumn(
        "_out", F.col("_out") & ~F.coalesce(g.geometry_facts(F.when(F.col("_out"), F.col(GEOMETRY)))["is_empty"], F.lit(True))
    )
    moved = F.col("_out")

    def put(column, value):
        kept = F.col(column) if column in df.columns else F.lit(None).cast("double")
        return F.when(moved, F.lit(value)).otherwise(kept)

    changes = {GEOMETRY: F.when(moved, F.lit(g.point_wkb(x, y))).otherwise(F.col(GEOMETRY))}
    for column, value in ((RELOCATED_LONGITUDE, lon), (RELOCATED_LATITUDE, lat)):
        changes[column] = put(column, value)
    for column, value in ((LONGITUDE, lon), (LATITUDE, lat)):
        if column in df.columns:
            changes[column] = put(column, value)
    return flagged.withColumns(changes).drop("_in", "_out")


def changed_geometry_count(pairs: DataFrame, before: str, after: str) -> DataFrame:
    return pairs.agg(F.count_if(~F.col(before).eqNullSafe(F.col(after))).alias("moved"))


def clip_to_states(df: DataFrame, state: str | Column, out: str = "clip_status") -> DataFrame:
    """Clip to the state envelope; ``out`` is clipped, outside (no overlap, unchanged) or kept.

    The 27 envelopes are a literal map. One function looks at the bounds, clips what lies beyond its envelope
    and measures only what it clipped.
    """
    code = F.lit(state) if isinstance(state, str) else state
    envelopes = F.create_map(
        *[x for k, box in STATE_BOUNDS.items() for x in (F.lit(k), F.array(*map(F.lit, box)))]
    )
    work = df.withColumn("_box", envelopes[code])
    work = work.withColumn("_clip", g.clip_beyond(F.col(GEOMETRY), *[F.col("_box")[i] for i in range(4)]))
    clipped = F.col("_clip.geometry")
    values = metric_values(F.col("_clip.facts"))
    changes = {c: F.when(F.col("_clip.facts.finite"), values[c]).otherwise(F.col(c)) for c in values if c in df.columns}
    return work.withColumns({
        **changes, out: F.when(clipped.isNotNull(), "clipped").when(F.col("_clip.beyond"), "outside").otherwise("kept"),
        GEOMETRY: F.coalesce(clipped, F.col(GEOMETRY)),
    }).drop("_box", "_clip")


def repair_geometries(df: DataFrame) -> DataFrame:
    """Invalid geometries become valid ones, or null with the internal flag set."""
    fixed = df.withColumn("_fix", g.repair_geometry(F.col(GEOMETRY)))
    nulled = F.col("_fix.changed") & F.col("_fix.geometry").isNull()
    if REPAIR_FLAG in df.columns:
        nulled = nulled | F.col(REPAIR_FLAG)
    return (
        fixed.withColumn(REPAIR_FLAG, F.coalesce(nulled, F.lit(False)))
        .withColumn(GEOMETRY, F.col("_fix.geometry"))
        .drop("_fix")
    )
