"""Intersects join of features with reference regions over a grid of cells."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from talweg.functions import geometry as g
from talweg.functions.naming import GEOMETRY
from talweg.functions.text import strip
from talweg.operators.scale import HOT_ROWS, salts_of, stage

# Candidate names of reference columns, the no-match marker, UF codes.
REFERENCE_COLUMNS = {
    "code": ("sdb_cd_mun", "cd_mun"),
    "name": ("sdb_nm_mun", "nm_mun"),
    "uf": ("sdb_sigla_uf", "sigla_uf", "sdb_cd_uf", "cd_uf"),
    GEOMETRY: (GEOMETRY,),
}
NO_MATCH = "Fora do limite territorial brasileiro / zona costeira"
UF_CODES = {
    "11": "RO", "12": "AC", "13": "AM", "14": "RR", "15": "PA", "16": "AP", "17": "TO",
    "21": "MA", "22": "PI", "23": "CE", "24": "RN", "25": "PB", "26": "PE", "27": "AL",
    "28": "SE", "29": "BA", "31": "MG", "32": "ES", "33": "RJ", "35": "SP", "41": "PR",
    "42": "SC", "43": "RS", "50": "MS", "51": "MT", "52": "GO", "53": "DF",
}
BROADCAST_CELLS = 500_000
BROADCAST_BYTES = 256 << 20
LEVEL_SPAN = 4  # cells a geometry may span on its level
TILE_VERTICES = 1024  # regions of more vertices get smaller tiles


def first_existing(df: DataFrame, candidates: tuple[str, ...]) -> str | None:
    return next((c for c in candidates if c in df.columns), None)


def reference_layer(df: DataFrame) -> DataFrame:
    """Regions as (code, name, uf, geometry), each from the first of its known columns; raises when one has none."""
    sources = {out: first_existing(df, names) for out, names in REFERENCE_COLUMNS.items()}
    if None in sources.values():
        lacking = {out: REFERENCE_COLUMNS[out] for out, column in sources.items() if column is None}
        raise ValueError(f"the reference regions need one column of each of {lacking}")
    return df.select(*[F.col(column).alias(out) for out, column in sources.items()])


def normalize_uf(value: Column) -> Column:
    """Numeric UF codes as acronyms, anything else in upper case."""
    text = strip(value.cast("string"))
    code = F.regexp_replace(text, r"\.0$", "")
    padded = F.when(F.length(code) < 2, F.lpad(code, 2, "0")).otherwise(code)
    acronyms = F.create_map(*[F.lit(x) for pair in UF_CODES.items() for x in pair])
    return F.coalesce(F.when(padded.isin(*UF_CODES), acronyms[padded]), F.upper(text))


def _level(x0: Column, y0: Column, x1: Column, y1: Column, size: float) -> Column:
    """Grid level on which bounds span a few cells; cells double in size per level."""
    extent = F.greatest(x1 - x0, y1 - y0)
    return F.ceil(F.log2(F.greatest(extent / (size * LEVEL_SPAN), F.lit(1.0)))).cast("int")


def _cells(x0: Column, y0: Column, x1: Column, y1: Column, level: Column, size: float) -> Column:
    """Cells (l, i, j) under bounds on one level."""
    side = F.lit(size) * F.pow(F.lit(2.0), level)
    columns = F.sequence(F.floor(x0 / side), F.floor(x1 / side))
    rows = F.sequence(F.floor(y0 / side), F.floor(y1 / side))
    return F.flatten(
        F.transform(
            columns,
            lambda i: F.transform(
                rows, lambda j: F.struct(level.alias("l"), i.alias("i"), j.alias("j"))
            ),
        )
    )


@dataclass(frozen=True)
class Grid:
    """Finest cell side, coarsest level and common bounds of a set of regions."""

    size: float
    top: int
    bounds: tuple[float, float, float, float]

    @classmethod
    def of(cls, regions: DataFrame, size: float | None = None) -> "Grid":
        """Cells of a quarter of the typical region extent, as a power of two, which keeps cell arithmetic exact.

        One cell of the top level spans about a quarter of all regions, so no level ever has
        to be cut off, however far out a region lies.
        """
        f = F.col("f")
        row = regions.select(g.geometry_facts_once(F.col(GEOMETRY)).alias("f")).filter("f.finite").agg(
            F.percentile_approx(F.greatest(f["maxx"] - f["minx"], f["maxy"] - f["miny"]), 0.5).alias("w"),
            F.min(f["minx"]).alias("x0"), F.min(f["miny"]).alias("y0"),
            F.max(f["maxx"]).alias("x1"), F.max(f["maxy"]).alias("y1"),
        ).first()
        bounds = tuple(row[c] or 0.0 for c in ("x0", "y0", "x1", "y1"))
        size = size or 2.0 ** math.floor(math.log2(max(row["w"] or 0.0, 1e-6) / LEVEL_SPAN))
        extent = max(bounds[2] - bounds[0], bounds[3] - bounds[1])
        return cls(size, math.ceil(math.log2(max(extent / (size * LEVEL_SPAN), 1.0))), bounds)


def region_tiles(regions: DataFrame, grid: Grid) -> DataFrame:
    """Written table of regions: attributes, bounds, grid level, and the region cut into its tiles once.

    Tiles are grid cells, about sixteen to a region and smaller for regions of many vertices, so that each holds a short
    piece of outline. Tiles wholly inside the region hold their own box.
    """
    f = F.col("f")
    bounds = [F.col(c) for c in ("rx0", "ry0", "rx1", "ry1")]
    boxed = (
        regions.select("code", "name", "uf", F.col(GEOMETRY).alias("r_geometry"), g.geometry_facts_once(F.col(GEOMETRY)).alias("f"))
        .filter("f.finite")
        .select("code", "name", "uf", "r_geometry", f["minx"].alias("rx0"), f["miny"].alias("ry0"), f["maxx"].alias("rx1"),
                f["maxy"].alias("ry1"), f["vertices"].alias("vertices"))
        .withColumn("r_level", _level(*bounds, grid.size))
    )
    finer = F.ceil(F.log2(F.greatest(F.col("vertices") / TILE_VERTICES, F.lit(1.0))) / 2).cast("int")
    sides = boxed.withColumn("side", F.lit(grid.size) * F.pow(F.lit(2.0), F.col("r_level") - finer))
    numbered = sides.withColumn("rid", F.monotonically_increasing_id())
    return stage(numbered.withColumn("tiles", g.cut_to_cells("r_geometry", "side")).drop("r_geometry", "vertices"))


def _close_cells(cells_from: Column, cells_to: Column, side: Column) -> Column:
    """Numbers of the closed cells that an interval meets; a point on a cell's border lies in both."""
    return F.sequence(F.ceil(cells_from / side) - 1, F.floor(cells_to / side))


@dataclass(frozen=True)
class Tiling:
    """Regions cut into tiles, and what is known of their number and size."""

    grid: Grid
    tiled: DataFrame
    stats: Row

    @classmethod
    def of(cls, regions: DataFrame, size: float | None = None) -> "Tiling":
        grid = Grid.of(regions, size)
        tiled = region_tiles(regions, grid)
        length = F.aggregate("tiles", F.lit(0).cast("long"), lambda n, t: n + F.length(t["piece"]))
        square = F.pow("side", F.lit(2.0))
        return cls(grid, tiled, tiled.agg(
            F.sum(F.size("tiles")).alias("tiles"), F.sum(length).alias("bytes"),
            F.sum((F.pow(F.lit((LEVEL_SPAN + 1.0)), 2) + 4 * (grid.top - F.col("r_level")))).alias("cells"),
            F.array_sort(F.collect_set("r_level")).alias("levels"),  # a handful of integers
            F.min("side").alias("side"), F.sum(F.size("tiles") * square).alias("area"), F.sum(length * square).alias("volume"),
        ).first())

    def small(self, broadcast_cells: int) -> bool:
        """Whether all tiles, repeated on the grid of the smallest ones, can be broadcast."""
        s = self.stats
        square = (s["side"] or 1.0) ** 2
        return (s["area"] or 0) <= broadcast_cells * square and (s["volume"] or 0) <= BROADCAST_BYTES * square


def _touching_tiles(features: DataFrame, tiling: Tiling, row_key: str, broadcast_cells: int, hot_rows: int) -> DataFrame:
    """(row_key, code, name, uf) for every feature and tile that share a point."""
    grid, tiled, stats = tiling.grid, tiling.tiled, tiling.stats
    size = grid.size
    right = _region_cells(tiled, size, grid.top)

    f = F.col("f")
    left_x, left_y, right_x, right_y = map(F.lit, grid.bounds)
    left = (
        features.select(F.col(row_key), F.col(GEOMETRY), g.geometry_bounds_once(F.col(GEOMETRY)).alias("f"))
        .filter("f.finite")
        .select(row_key, GEOMETRY, f["kind"].alias("kind"),
                F.greatest(f["minx"], left_x).alias("x0"), F.greatest(f["miny"], left_y).alias("y0"),
                F.least(f["maxx"], right_x).alias("x1"), F.least(f["maxy"], right_y).alias("y1"))
        .filter("x0 <= x1 AND y0 <= y1")
        .withColumn("level", _level(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), size))
    )
    meeting = F.array_distinct(
        F.transform(F.array(*map(F.lit, stats["levels"])), lambda r: F.greatest(F.col("level"), r))
    )
    left = left.withColumn(
        "cell",
        F.explode(
            F.flatten(
                F.transform(
                    meeting,
                    lambda m: _cells(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), m, size),
                )
            )
        ),
    )
    small = (stats["cells"] or 0) <= broadcast_cells
    pairs = left.join(F.broadcast(right), "cell") if small else _salted_join(left, right, row_key, hot_rows)
    side = F.lit(size) * F.pow(F.lit(2.0), F.col("cell.l"))
    pairs = pairs.filter(
        (F.col("cell.l") == F.greatest("level", "r_level"))
        & (F.col("x0") <= F.col("rx1")) & (F.col("rx0") <= F.col("x1"))
        & (F.col("y0") <= F.col("ry1")) & (F.col("ry0") <= F.col("y1"))
        & (F.floor(F.greatest("x0", "rx0") / side) == F.col("cell.i"))
        & (F.floor(F.greatest("y0", "ry0") / side) == F.col("cell.j"))
    )
    tile_side = F.col("side")
    columns = _close_cells(F.greatest("x0", "rx0"), F.least("x1", "rx1"), tile_side)
    lines = _close_cells(F.greatest("y0", "ry0"), F.least("y1", "ry1"), tile_side)
    pairs = (
        pairs.select(row_key, GEOMETRY, "kind", "rid", F.explode(columns).alias("i"), lines.alias("js"))
        .withColumn("j", F.explode("js")).drop("js")
    )
    tiles = tiled.select("rid", "code", "name", "uf", F.explode("tiles").alias("t")).select(
        "rid", "code", "name", "uf", F.col("t.i").alias("i"), F.col("t.j").alias("j"), F.col("t.inside").alias("inside"), F.col("t.piece").alias("piece")
    )
    if small and (stats["tiles"] or 0) <= broadcast_cells and (stats["bytes"] or 0) <= BROADCAST_BYTES:
        tiles = F.broadcast(tiles)  # else adaptive execution splits crowded tiles
    met = pairs.join(tiles, ["rid", "i", "j"])
    sure = F.col("inside") & (F.col("kind") == "Point")
    exact = g.intersects(F.when(~sure, F.col(GEOMETRY)), F.when(~sure, F.col("piece")))
    return met.filter(sure | F.coalesce(exact, F.lit(False))).select(row_key, "rid", "code", "name", "uf")


def intersecting_pairs(
    features: DataFrame, regions: DataFrame, row_key: str, *,
    size: float | None = None, broadcast_cells: int = BROADCAST_CELLS, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows (row_key, code, name, uf) of intersecting features and regions, each pair once; ``row_key`` tells features apart.

    First the bounds of both meet on a grid. Each lies in the few cells under its bounds on a level that fits its
    size, so one huge geometry cannot flood the grid; a pair meets on the coarser of
    its two levels, in the cell with the lower-left corner of the common bounds. Cells of a feature are listed only within the
    bounds of all regions, so a stray coordinate costs nothing. Then the feature meets the region's tiles under the
    common bounds, by region and tile number: no row holds more of a region than the outline in one tile, and points in
    tiles wholly inside need no exact test. Cells and tiles are broadcast after a check of their number and bytes;
    otherwise both sides shuffle, with crowded cells salted.
    """
    met = _touching_tiles(features, Tiling.of(regions, size), row_key, broadcast_cells, hot_rows)
    return met.dropDuplicates([row_key, "rid"]).drop("rid")


def _region_cells(tiled: DataFrame, size: float, top: int) -> DataFrame:
    """Cells under a region's bounds on its own level and every coarser one, where larger features meet it."""
    bounds = [F.col(c) for c in ("rx0", "ry0", "rx1", "ry1")]
    levels = F.sequence(F.col("r_level"), F.lit(top))
    return tiled.select("rid", "rx0", "ry0", "rx1", "ry1", "r_level", "side").withColumn(
        "cell", F.explode(F.flatten(F.transform(levels, lambda m: _cells(*bounds, m, size))))
    )


def _salted_join(left: DataFrame, right: DataFrame, row_key: str, hot_rows: int) -> DataFrame:
    """Shuffle join on the cell; crowded cells spread over as many partitions as their rows ask for."""
    hot = (
        left.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows)
        .select("cell", salts_of(F.col("n"), hot_rows).alias("salts"))
    )
    spread = F.pmod(F.xxhash64(row_key), F.coalesce("salts", F.lit(1))).cast("int")
    salted_left = left.join(F.broadcast(hot), "cell", "left").withColumn("salt", spread).drop("salts")
    salted_right = (
        right.join(F.broadcast(hot), "cell", "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
        .drop("salts")
    )
    return salted_left.join(salted_right, ["cell", "salt"])


def first_match(pairs: DataFrame, row_key: str) -> DataFrame:
    """One region per feature, the lowest code; partial aggregation, no window."""
    return pairs.groupBy(row_key).agg(
        F.min_by(F.struct("code", "name", "uf"), F.struct("code", "name", "uf")).alias("m")
    ).select(row_key, "m.*")


def _cell_regions(tiling: Tiling) -> DataFrame:
    """Regions by cell of the smallest tiles: the first that covers it, and the pieces of those before that one."""
    n = F.round(F.col("side") / tiling.stats["side"]).cast("long")
    within = lambda c: F.sequence(F.col(c) * n, F.col(c) * n + n - 1)
    tiles = tiling.tiled.select("code", "name", "uf", "side", F.explode("tiles").alias("t")).select(
        "code", "name", "uf", "side", "t.*"
    ).withColumn("_i", F.explode(within("i"))).withColumn("_j", F.explode(within("j")))
    listed = tiles.groupBy("_i", "_j").agg(F.array_sort(F.collect_list(F.struct("code", "name", "uf", "inside", "piece"))).alias("all"))
    names = lambda x: F.struct(x["code"].alias("code"), x["name"].alias("name"), x["uf"].alias("uf"))
    first = listed.withColumn("_sure", F.get(F.transform(F.filter("all", lambda x: x["inside"]), names), F.lit(0)))
    before = first.withColumn("all", F.filter("all", lambda x: ~x["inside"] & (F.col("_sure").isNull() | (names(x) < F.col("_sure")))))
    return before.select("_i", "_j", "_sure", F.transform("all", names).alias("_names"), F.transform("all", lambda x: x["piece"]).alias("_pieces"))


def _matched_in_cells(df: DataFrame, tiling: Tiling) -> tuple[DataFrame, DataFrame]:
    """Features strictly inside one cell of the smallest tiles, with their first region as ``_m``, and all others as they are.

    The cell tells the regions that can meet the feature, so a feature stays in its row and its partition.
    """
    f, side = F.col("_f"), F.lit(tiling.stats["side"] or 1.0)
    i, j = F.floor(f["minx"] / side), F.floor(f["miny"] / side)
    alone = (f["minx"] > i * side) & (f["maxx"] < (i + 1) * side) & (f["miny"] > j * side) & (f["maxy"] < (j + 1) * side)
    looked = df.withColumn("_f", g.geometry_bounds_once(F.col(GEOMETRY))).withColumn("_alone", ~f["finite"] | alone)
    placed = looked.filter("_alone").withColumns({"_i": F.when(f["finite"], i), "_j": F.when(f["finite"], j)}).drop("_f", "_alone")
    met = placed.join(F.broadcast(_cell_regions(tiling)), ["_i", "_j"], "left")
    asked = F.size("_pieces") > 0
    met = met.withColumn("_first", g.first_met(F.when(asked, F.col(GEOMETRY)), F.when(asked, F.col("_pieces"))))
    met = met.withColumn("_m", F.coalesce(F.get("_names", F.col("_first")), F.col("_sure")))
    return met.drop("_i", "_j", "_sure", "_names", "_pieces", "_first"), stage(looked.filter("NOT _alone").drop("_f", "_alone"))


def assign_regions(df: DataFrame, regions: DataFrame, row_key: str, **options) -> DataFrame:
    """Region code, name and UF of every feature; the marker text where none matches.

    The UF of a matched region without one comes from the feature's own UF. Features in one cell of the smallest tiles find their
    region there, if all tiles can be broadcast; only those on several cells meet the tiles in pairs and are joined back.
    """
    tiling = Tiling.of(reference_layer(regions), options.get("size"))
    broadcast_cells = options.get("broadcast_cells", BROADCAST_CELLS)
    alone, rest = _matched_in_cells(df, tiling) if tiling.small(broadcast_cells) else (None, df)
    pairs = _touching_tiles(rest, tiling, row_key, broadcast_cells, options.get("hot_rows", HOT_ROWS))
    match = first_match(pairs, row_key)  # pairs that repeat by tile are one group here
    joined = rest.join(match.select(row_key, F.struct("code", "name", "uf").alias("_m")), row_key, "left")
    if alone is not None:
        joined = alone.unionByName(joined)
    joined = joined.select("*", "_m.*").drop("_m")
    hit = F.col("code").isNotNull()
    uf = normalize_uf(F.col("uf"))
    if "sdb_uf" in df.columns:
        uf = F.coalesce(uf, normalize_uf(F.col("sdb_uf")))
    marker = F.lit(NO_MATCH)
    return joined.withColumns(
        {
            "acm_cod_munici": F.when(hit, F.col("code").cast("string")).otherwise(marker),
            "acm_municipio": F.when(hit, F.col("name")).otherwise(marker),
            "acm_uf": F.when(hit, uf).otherwise(marker),
        }
    ).drop("code", "name", "uf")
