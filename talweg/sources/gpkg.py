"""GeoPackage layers as a Spark data source, split by row ranges.

``spark.dataSource.register(GeoPackageSource)`` and then
``spark.read.format("gpkg").option("path", file_or_comma_list).load()``. The first
feature layer is read; geometry blobs lose their header and come back as WKB with
the layer's srid. Files must be reachable as paths on the workers.

The driver only looks at the files' sizes: each task finds its own row range. Option ``bbox`` ("x0,y0,x1,y1") keeps features
whose bounds meet the box, by the layer's R-tree where it has one. ``filtered_layer`` makes comparisons of columns part of the layer's SQL,
so that other rows never leave the file. Spark's own hook for that is not used: of a frame that is read twice, the second read keeps
the filters of the first, also where it has none (seen with 4.1.2).
"""

from __future__ import annotations

import json
import os
import sqlite3
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from talweg.functions.shapes import bounds, read_shapes

BYTES_PER_PARTITION = 64 << 20
BATCH_ROWS = 5_000
#: Comparisons that SQLite makes like Spark: all for numbers, the first two for texts, whatever the column's collation.
COMPARISONS = ("=", "IN", ">", ">=", "<", "<=", "IS NULL", "IS NOT NULL")
_ENVELOPE_BYTES = (0, 32, 48, 48, 64)  # fixed values: envelope sizes by header code


def _connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _layer(path: str):
    """First feature layer: (table, geometry column, srid, [(column, declared type)])."""
    with _connect(path) as db:
        table = db.execute(
            "SELECT table_name FROM gpkg_contents WHERE data_type = 'features' ORDER BY rowid LIMIT 1"
        ).fetchone()
        if table is None:
            raise ValueError(f"no feature layer in {path}")
        geometry, srid = db.execute(
            "SELECT column_name, srs_id FROM gpkg_geometry_columns WHERE table_name = ?", table
        ).fetchone()
        columns = [(r[1], (r[2] or "TEXT").upper()) for r in db.execute(f'PRAGMA table_info("{table[0]}")')]
    return table[0], geometry, srid, columns


def _spark_type(declared: str) -> T.DataType:
    if declared == "BOOLEAN":
        return T.BooleanType()
    if declared == "DATE":
        return T.DateType()
    if "INT" in declared:
        return T.LongType()
    if declared.startswith(("REAL", "DOUBLE", "FLOAT")):
        return T.DoubleType()
    if declared.startswith("BLOB"):
        return T.BinaryType()
    return T.StringType()


def _values(column, kind: T.DataType):
    """Stored values of a column as Python values of its Spark type."""
    if isinstance(kind, T.BooleanType):
        return [None if v is None else bool(v) for v in column]
    if isinstance(kind, T.DateType):
        return [None if v is None else date.fromisoformat(v) for v in column]
    return column


def strip_header(blob: bytes | None) -> bytes | None:
    """WKB inside a GeoPackage geometry blob."""
    if blob is None:
        return None
    if blob[:2] != b"GP":
        raise ValueError("not a GeoPackage geometry")
    return blob[8 + _ENVELOPE_BYTES[(blob[3] >> 1) & 7] :]


class RowRange(InputPartition):
    """Part ``number`` of ``count`` equal ranges of row ids of a file."""

    def __init__(self, path: str, number: int, count: int):
        self.path, self.number, self.count = path, number, count


class GeoPackageReader(DataSourceReader):
    def __init__(self, schema: T.StructType, paths: list[str], partition_bytes: int, box: tuple[float, ...] | None, filters: list[list]):
        self.schema, self.paths, self.partition_bytes, self.box = schema, paths, partition_bytes, box
        self.conditions: list[str] = []
        self.values: list = []
        for name, comparison, *values in filters:
            self._push(name, comparison, values)

    def _push(self, name: str, comparison: str, values: list) -> None:
        """Take a comparison into the SQL if SQLite makes it like Spark; it may only leave out what Spark would leave out too."""
        kind = self.schema[name].dataType
        number, text = isinstance(kind, (T.LongType, T.DoubleType)), isinstance(kind, T.StringType)
        if name in ("srid", "geometry") or comparison not in COMPARISONS:
            return
        if comparison.startswith("IS"):
            self.conditions.append(f'"{name}" {comparison}')
        elif number or text and comparison in ("=", "IN"):
            places = ", ".join("?" * len(values))
            self.conditions.append(f'"{name}" {comparison} ' + (f"({places})" if comparison == "IN" else places))
            self.values += values

    def partitions(self):
        counts = {p: max(1, -(-os.path.getsize(p) // self.partition_bytes)) for p in self.paths}
        return [RowRange(p, i, n) for p, n in counts.items() for i in range(n)]

    def _query(self, db, table: str, geometry: str, picked: str, part: RowRange) -> tuple[str, list]:
        low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{table}"').fetchone()
        low, size = low or 0, (high or 0) - (low or 0) + 1
        where, values = ["rowid >= ? AND rowid < ?", *self.conditions], [low + size * part.number // part.count, low + size * (part.number + 1) // part.count, *self.values]
        tree = f"rtree_{table}_{geometry}"
        if self.box and db.execute("SELECT 1 FROM sqlite_master WHERE name = ?", (tree,)).fetchone():
            # The tree's bounds are rounded outwards, so it leaves nothing out.
            where.append(f'rowid IN (SELECT id FROM "{tree}" WHERE minx <= ? AND maxx >= ? AND miny <= ? AND maxy >= ?)')
            values += [self.box[2], self.box[0], self.box[3], self.box[1]]
        return f'SELECT {picked} FROM "{table}" WHERE {" AND ".join(where)} ORDER BY rowid', values

    def read(self, partition: RowRange):
        from pyspark.sql.pandas.types import to_arrow_schema

        table, geometry, srid, _ = _layer(partition.path)
        names = [f.name for f in self.schema.fields if f.name != "srid"]
        picked = ", ".join(f'"{geometry if n == "geometry" else n}"' for n in names)
        arrow = to_arrow_schema(self.schema)
        with _connect(partition.path) as db:
            cursor = db.execute(*self._query(db, table, geometry, picked, partition))
            while rows := cursor.fetchmany(BATCH_ROWS):
                columns = dict(zip(names, zip(*rows)))
                columns = {n: _values(c, self.schema[n].dataType) for n, c in columns.items()}
                columns["geometry"] = [strip_header(b) for b in columns["geometry"]]
                columns["srid"] = [srid] * len(rows)
                batch = pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)
                yield batch if self.box is None else batch.filter(self._inside(pa.array(columns["geometry"], pa.binary())))

    def _inside(self, geometry: pa.Array) -> pa.Array:
        own, (x0, y0, x1, y1) = bounds(read_shapes(geometry)), self.box
        with np.errstate(invalid="ignore"):
            return pa.array((own[:, 0] <= x1) & (own[:, 2] >= x0) & (own[:, 1] <= y1) & (own[:, 3] >= y0))


class GeoPackageSource(DataSource):
    @classmethod
    def name(cls):
        return "gpkg"

    def _paths(self):
        return [p.strip() for p in self.options["path"].split(",")]

    def schema(self):
        _, geometry, _, columns = _layer(self._paths()[0])
        fields = [
            T.StructField("geometry", T.BinaryType()) if name == geometry else T.StructField(name, _spark_type(kind))
            for name, kind in columns
        ]
        return T.StructType([*fields, T.StructField("srid", T.IntegerType())])

    def reader(self, schema):
        box = self.options.get("bbox")
        return GeoPackageReader(
            schema, self._paths(), int(self.options.get("bytesPerPartition", BYTES_PER_PARTITION)),
            tuple(map(float, box.split(","))) if box else None, json.loads(self.options.get("filters", "[]")),
        )


def filtered_layer(
    spark: SparkSession, path: str, filters: list[tuple] = (), bbox: tuple[float, float, float, float] | None = None, **options: str
) -> DataFrame:
    """A layer's rows that meet all ``filters``, as (column, comparison, values...) with one of COMPARISONS, and whose bounds meet ``bbox``.

    The layer's SQL leaves out what it can; Spark then applies all comparisons.
    """
    spark.dataSource.register(GeoPackageSource)
    read = spark.read.format("gpkg").option("path", path).option("filters", json.dumps(list(filters))).options(**options)
    found = (read.option("bbox", ",".join(map(str, bbox))) if bbox else read).load()
    for name, comparison, *values in filters:
        column = F.col(f"`{name}`")
        if comparison.startswith("IS"):
            found = found.filter(column.isNull() if comparison == "IS NULL" else column.isNotNull())
        elif comparison == "IN":
            found = found.filter(column.isin(values))
        else:
            value = F.lit(values[0])
            found = found.filter({"=": column == value, ">": column > value, ">=": column >= value, "<": column < value, "<=": column <= value}[comparison])
    return found
