import datetime
import json
import sqlite3
import struct

import pytest
from pyspark.sql import functions as F

from talweg.functions.geometry import box_wkb, point_wkb
from talweg.operators.quality import QualityConfig, quality_reports, quality_summary
from talweg.plans import registry
from talweg.plans.treatment import Profile, SchemaMismatch, treat
from talweg.sources import sinks
from talweg.sources.gpkg import GeoPackageSource, filtered_layer
from talweg.sources.rules import load_rules, read_bundles
from talweg.sources.tables import resolve_paths, scan_many
from talweg.streaming.rowlocal import treat_stream

VALIDATE = ["validate_shapefile_attribute"]
CAR_COLUMNS = {"sdb_cod_tema": {"dtype": "string", "nullable": False}, "sdb_nom_tema": "string", "sdb_des_condic": "string"}
BUNDLES = {
    "auth/auth_supn": {
        "input_schema": {"columns": {"sdb_descriptio": {"dtype": "string", "nullable": False}, "sdb_author_dat": "string",
                                     "sdb_expira_dat": "string"}},
        "treatment": {"auto_functions": {"sdb_author_dat": ["validate_date_fields"], "sdb_expira_dat": ["validate_date_fields"]}},
    },
    "car_reserva_legal/rl_car_ma": {
        "input_schema": {"columns": CAR_COLUMNS},
        "domains": {"fields": {"sdb_cod_tema": {"accepted_values": ["ARL_AVERBADA", "ARL_PROPOSTA"], "aliases": {}},
                               "sdb_nom_tema": {"accepted_values": ["Reserva Legal Averbada", "Reserva Legal Proposta"],
                                                "aliases": {"RL Averbada": "Reserva Legal Averbada"}}}},
        "relations": {"relations": {"cod_tema_to_nom_tema": {"ARL_AVERBADA": "Reserva Legal Averbada",
                                                             "ARL_PROPOSTA": "Reserva Legal Proposta"}}},
        "treatment": {"postprocess_functions": ["enforce_car_state_bounds"],
                      "auto_functions": {"sdb_cod_tema": VALIDATE, "sdb_nom_tema": VALIDATE,
                                         "sdb_des_condic": ["car_reserva_legal_transform_des_condic"]},
                      "quality_outputs": {"geometric_duplicates": False}},
    },
    "_template/x": {"domains": {"fields": {}}},
}


@pytest.fixture(scope="module")
def rules(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("rules")
    for name, parts in BUNDLES.items():
        folder = base / name
        folder.mkdir(parents=True)
        parts = {"profile": {"profile_name": name, "project_name": name.split("/")[0], "theme_folder": name.split("/")[1]}, **parts}
        for part, body in parts.items():
            (folder / f"{part}.json").write_text(json.dumps(body, ensure_ascii=False), encoding="utf-8-sig")
    return load_rules(spark, str(base))


def test_rule_tables(spark, rules):
    assert {r.profile for r in rules.profiles.collect()} == {"auth/auth_supn", "car_reserva_legal/rl_car_ma"}
    assert rules.domain_aliases.first().alias == "RL Averbada"
    required = {r.column: r.nullable for r in rules.schema_columns.filter("profile like 'car%'").collect()}
    assert required == {"sdb_cod_tema": False, "sdb_nom_tema": True, "sdb_des_condic": True}
    profile = Profile.of(rules, "car_reserva_legal/rl_car_ma")
    assert profile.postprocess == ["enforce_car_state_bounds"] and not profile.quality.geometric_duplicates
    assert profile.quality.attribute_duplicates and profile.theme == "rl_car_ma"


def test_dates_end_to_end(spark, rules):
    layer = spark.createDataFrame(
        [("PMFS/POA", "31/01/2025", "2026-02-01 00:00:00", point_wkb(0, 0), 4674)],
        "Descriptio string, author_dat string, expira_dat string, geometry binary, srid int")
    result = treat(layer, rules, "auth/auth_supn", ["Descriptio"])
    row = result.data.first()
    assert (row.acm_author_dat, row.acm_expira_dat) == (datetime.date(2025, 1, 31), datetime.date(2026, 2, 1))
    assert row.sdb_author_dat == "31/01/2025" and row.acm_id == row.fid == 1 and row.srid == 4326
    assert "acm_a_ha" not in result.data.columns and result.stats["skipped_point_measurements"] == 1


def car_layer(spark):
    return spark.createDataFrame(
        [("ARL_AVERBADA", "Reserva Legal  Averbada", "Analisado sem pendencias", box_wkb(-45, -5, -44, -4)),
         ("arl_proposta", "RL Averbada", "Em analise", box_wkb(-41.5, -5, -40.5, -4)),
         ("???", "Reserva Legal Proposta", None, box_wkb(10, 10, 11, 11))],
        "cod_tema string, nom_tema string, desc_condic string, geometry binary").withColumn("srid", F.lit(4674))


def test_rules_end_to_end(spark, rules):
    result = treat(car_layer(spark), rules, "car_reserva_legal/rl_car_ma", ["cod_tema"], id_start=10)
    rows = {r.sdb_cod_tema: r for r in result.silver.collect()}
    assert [r.acm_id for r in result.data.orderBy("acm_id").collect()] == [10, 11, 12]
    assert rows["ARL_AVERBADA"].acm_nom_tema == "Reserva Legal Averbada" and rows["ARL_AVERBADA"].acm_des_condic == "Analisado"
    assert rows["arl_proposta"].acm_cod_tema == "ARL_PROPOSTA" and rows["arl_proposta"].acm_nom_tema == "Reserva Legal Proposta"
    assert rows["arl_proposta"].acm_long == -41.25 and rows["ARL_AVERBADA"].acm_a_ha > 0
    assert rows["arl_proposta"].sdb_nom_tema == "RL Averbada"
    summary = {(r.column, r.status): r.n for r in result.domain_summary().collect()}
    assert summary == {("sdb_cod_tema", "valid"): 2, ("sdb_cod_tema", "invalid"): 1, ("sdb_nom_tema", "valid"): 2, ("sdb_nom_tema", "normalized"): 1}
    related = {(r.status, r.source_value): r.n for r in result.relation_summaries().collect()}
    assert related == {("consistent", None): 1, ("autocorrected", "ARL_PROPOSTA"): 1, ("unchecked", "???"): 1}
    domains, _ = result.rule_deltas()
    assert {(r.column, r.kind, r.value) for r in domains.collect()} == {("sdb_cod_tema", "accepted", "???")}


def test_treating_twice_adds_nothing(spark, rules):
    name = "car_reserva_legal/rl_car_ma"
    first = treat(car_layer(spark), rules, name, ["cod_tema"]).data
    clean = first.select(F.coalesce("acm_cod_tema", "sdb_cod_tema").alias("sdb_cod_tema"), F.col("acm_nom_tema").alias("sdb_nom_tema"),
                         F.col("acm_des_condic").alias("sdb_des_condic"), "geometry", "srid")
    again = treat(clean, rules, name, ["sdb_cod_tema"]).data
    assert "acm_nom_tema" not in again.columns and "acm_cod_tema" not in again.columns


def test_schema_errors_stop_the_treatment(spark, rules):
    layer = car_layer(spark).drop("nom_tema").withColumn("cod_tema", F.lit(None).cast("string"))
    with pytest.raises(SchemaMismatch) as caught:
        treat(layer, rules, "car_reserva_legal/rl_car_ma", ["cod_tema"])
    assert len(caught.value.errors) == 2


def test_function_registry_logs_and_goes_on(spark, rules):
    profile = Profile.of(rules, "car_reserva_legal/rl_car_ma")
    ctx = registry.RuleContext(rules.of(profile.name), profile.config)
    registry.register_column_function("extra.upper", lambda df, c, _: df.withColumn("acm_up", F.upper(c)))
    registry.register_column_function("extra.broken", lambda df, c, _: df.select("no_such_column"))
    frame = spark.createDataFrame([("a",)], "c string")
    out = registry.apply_column_functions(frame, {"c": ["extra.broken", "none", "extra.upper"], "z": ["extra.upper"]}, ctx)
    assert out.first().acm_up == "A"
    assert [outcome.split(":")[0] for _, _, outcome in ctx.log] == ["failed", "not_registered", "applied", "missing_column"]


def test_quality_fixtures(spark, tmp_path):
    rows = [(1, "A", point_wkb(0, 0), 4326), (2, "A", point_wkb(0, 0), 4326), (3, "B", point_wkb(0, 0), 4326)]
    layer = spark.createDataFrame(rows, "acm_id int, code string, geometry binary, srid int")
    counts = {r.check: r.n for r in quality_summary(layer).collect()}
    assert counts == {"attribute_duplicates": 2, "geometric_duplicates": 3, "ogc_invalid": 0, "safe_null": 0}
    reports = quality_reports(layer)
    assert [r.dup_registro for r in reports.geometric_duplicates.orderBy("acm_id").collect()] == [True, True, False]
    written = sinks.write_reports(quality_reports(layer, QualityConfig(ogc_invalid_geometries=False)), str(tmp_path / "r"))
    assert sorted(written) == ["attribute_duplicates", "geometric_duplicates"]
    sinks.append_manifest(spark, str(tmp_path / "m"), "silver", "primary", {})
    assert spark.read.parquet(str(tmp_path / "m")).first().report is None


def test_paths(spark, tmp_path):
    for name in ("a/x_1", "a/x_2", "a/y", "b/c/z"):
        spark.range(1).coalesce(1).write.parquet(str(tmp_path / "w" / name))
        part = next((tmp_path / "w" / name).glob("*.parquet"))
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        part.rename(tmp_path / f"{name}.parquet")
    names = lambda p: [x.rsplit("/", 1)[1] for x in resolve_paths(spark, str(p))]
    assert names(tmp_path / "a/x_1.parquet") == ["x_1.parquet", "x_2.parquet"]
    assert names(tmp_path / "a/y.parquet") == ["y.parquet"]
    assert names(tmp_path / "a") == ["x_1.parquet", "x_2.parquet", "y.parquet"] and names(tmp_path / "b") == ["z.parquet"]
    assert scan_many(spark, resolve_paths(spark, str(tmp_path / "a"))).count() == 3
    for bad, kind in (("", FileNotFoundError), ("/x.zip", ValueError), (str(tmp_path / "none"), FileNotFoundError)):
        with pytest.raises(kind):
            resolve_paths(spark, bad)


def test_geopackage_layer(spark, tmp_path):
    path = str(tmp_path / "layer.gpkg")
    header = b"GP\x00\x01" + struct.pack("<i", 4674)
    boxed = b"GP\x00\x03" + struct.pack("<i4d", 4674, 1, 1, 2, 2)
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE gpkg_contents (table_name TEXT, data_type TEXT)")
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, srs_id INTEGER)")
        db.execute("CREATE TABLE roads (fid INTEGER PRIMARY KEY, name TEXT, size REAL, geom BLOB, open BOOLEAN, day DATE)")
        db.execute("INSERT INTO gpkg_contents VALUES ('notes', 'attributes'), ('roads', 'features')")
        db.execute("INSERT INTO gpkg_geometry_columns VALUES ('roads', 'geom', 4674)")
        db.executemany("INSERT INTO roads (fid, name, size, geom) VALUES (?, ?, ?, ?)",
                       [(i, f"r{i}", i / 2, (boxed if i % 2 else header) + point_wkb(i, i)) for i in range(1, 101)] + [(101, None, None, None)])
        db.execute("INSERT INTO roads (fid, open, day) VALUES (1000000000, 1, '2026-02-01')")
    spark.dataSource.register(GeoPackageSource)
    layer = spark.read.format("gpkg").option("path", path).option("bytesPerPartition", "4000").load()
    assert layer.dtypes == [("fid", "bigint"), ("name", "string"), ("size", "double"), ("geometry", "binary"),
                            ("open", "boolean"), ("day", "date"), ("srid", "int")]
    assert layer.rdd.getNumPartitions() > 3
    rows = {r.fid: r for r in layer.collect()}
    assert rows[1000000000].open is True and rows[1000000000].day == datetime.date(2026, 2, 1)
    assert len(rows) == 102 and bytes(rows[7].geometry) == point_wkb(7, 7) and rows[101].geometry is None and rows[8].srid == 4674


def road_package(path, rows, tree):
    header = b"GP\x00\x01" + struct.pack("<i", 4326)
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE gpkg_contents (table_name TEXT, data_type TEXT)")
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, srs_id INTEGER)")
        db.execute("CREATE TABLE roads (fid INTEGER PRIMARY KEY, name TEXT, size REAL, geom BLOB)")
        db.execute("INSERT INTO gpkg_contents VALUES ('roads', 'features')")
        db.execute("INSERT INTO gpkg_geometry_columns VALUES ('roads', 'geom', 4326)")
        db.executemany("INSERT INTO roads VALUES (?, ?, ?, ?)", [(i, f"r{i % 7}", i / 2, header + point_wkb(i, -i)) for i in range(rows)] + [(rows, None, None, None)])
        if tree:
            db.execute("CREATE VIRTUAL TABLE rtree_roads_geom USING rtree(id, minx, maxx, miny, maxy)")
            db.executemany("INSERT INTO rtree_roads_geom VALUES (?, ?, ?, ?, ?)", [(i, i, i, -i, -i) for i in range(rows)])


@pytest.mark.parametrize("tree", [True, False])
def test_geopackage_filters(spark, tmp_path, tree):
    path = str(tmp_path / "roads.gpkg")
    road_package(path, 1000, tree)
    whole = filtered_layer(spark, path, bytesPerPartition="8192")
    assert whole.rdd.getNumPartitions() > 3
    cases = {
        (("fid", "=", 17),): "fid = 17", (("fid", ">=", 10), ("fid", "<=", 19), ("size", ">", 6)): "fid BETWEEN 10 AND 19 AND size > 6",
        (("name", "=", "r3"),): "name = 'r3'", (("name", "IN", "r1", "r2"), ("fid", "<", 50)): "name IN ('r1', 'r2') AND fid < 50",
        (("size", "IS NULL"),): "size IS NULL", (("name", "IS NOT NULL"),): "name IS NOT NULL", (("name", ">", "r4"),): "name > 'r4'",
        (("srid", "=", 4326), ("fid", ">=", 995)): "srid = 4326 AND fid >= 995", (): "true",
    }
    for filters, condition in cases.items():
        got = sorted(r.fid for r in filtered_layer(spark, path, filters, bytesPerPartition="8192").collect())
        assert got == sorted(r.fid for r in whole.filter(condition).collect()), condition
    boxed = filtered_layer(spark, path, bbox=(10.5, -30, 20, -12))
    assert sorted(r.fid for r in boxed.filter("size < 8.5").collect()) == [12, 13, 14, 15, 16]
    assert sorted(r.fid for r in boxed.collect()) == list(range(12, 21))


def test_filtered_rows_never_leave_the_file(tmp_path):
    path = str(tmp_path / "roads.gpkg")
    road_package(path, 1000, True)
    filters = [["fid", ">", 150], ["name", "=", "r3"], ["name", ">", "q"]]
    source = GeoPackageSource({"path": path, "filters": json.dumps(filters), "bbox": "100,-300,300,-100"})
    reader = source.reader(source.schema())
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == sum(1 for i in range(151, 301) if i % 7 == 3)
    assert reader.conditions == ['"fid" > ?', '"name" = ?']


def test_stream_equals_batch(spark, rules, tmp_path):
    source, name = str(tmp_path / "in"), "car_reserva_legal/rl_car_ma"
    layer = car_layer(spark).withColumnRenamed("desc_condic", "des_condic")
    layer.write.parquet(source)
    stream = spark.readStream.schema(layer.schema).parquet(source)
    query = (
        treat_stream(stream, rules, name).writeStream.format("memory").queryName("treated")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    got = {r.sdb_cod_tema: (r.acm_nom_tema, r.acm_des_condic, r.acm_a_ha) for r in spark.table("treated").collect()}
    batch = treat(car_layer(spark), rules, name, ["cod_tema"]).audited
    assert got == {r.sdb_cod_tema: (r.acm_nom_tema, r.acm_des_condic, r.acm_a_ha) for r in batch.collect()}


def test_rule_folders_have_one_name_however_the_path_is_given(spark, tmp_path):
    folder = tmp_path / "the rules" / "a" / "b"
    folder.mkdir(parents=True)
    (folder / "profile.json").write_text("{}")
    for path in (str(tmp_path / "the rules"), f"file://{tmp_path}/the rules/"):
        assert [tuple(r)[:2] for r in read_bundles(spark, path).collect()] == [("a/b", "profile.json")]


def test_half_written_bronze_is_replaced(spark, tmp_path):
    path = tmp_path / "bronze"
    (path / "_temporary").mkdir(parents=True)
    assert sinks.write_bronze(spark.range(3), str(path)).count() == 3
    assert sinks.write_bronze(spark.range(5), str(path)).count() == 3
    sinks.append_manifest(spark, str(tmp_path / "m"), "silver", "primary", {})
    assert spark.read.parquet(str(tmp_path / "m")).filter("written_at IS NOT NULL").count() == 1


def test_sibling_folders_are_found_and_hidden_names_skipped(spark, tmp_path):
    for name in ("x_1.parquet", "x_2.parquet", "_x_3.parquet"):
        spark.range(1).write.parquet(str(tmp_path / name))
    found = resolve_paths(spark, str(tmp_path / "x_1.parquet"))
    assert [p.rsplit("/", 1)[1] for p in found] == ["x_1.parquet", "x_2.parquet"] and found[0].startswith("file:")
    assert resolve_paths(spark, str(tmp_path)) == found


def test_empty_layers_are_treated(spark, rules):
    result = treat(car_layer(spark).limit(0), rules, "car_reserva_legal/rl_car_ma", ["cod_tema"])
    assert result.stats["rows"] == result.stats["reprojected_to_wgs84"] == 0 and result.data.count() == 0
    assert registry.named_state(("other", None, "/in/RL_CAR_MA.gpkg", "/src/app_car_ac.gpkg")) == "ma"
    assert registry.named_state(("rl_car_zz", None)) is None


def test_summaries_take_no_post_processing(spark, rules, monkeypatch):
    name, ran = "enforce_car_state_bounds", []
    step = registry.POSTPROCESS_STEPS[name]
    monkeypatch.setitem(registry.POSTPROCESS_STEPS, name, lambda df, ctx: ran.append(name) or step(df, ctx))
    result = treat(car_layer(spark), rules, "car_reserva_legal/rl_car_ma", ["cod_tema"])
    assert result.relation_summaries().count() == 3 and result.domain_summary().count() == 4 and not ran
    assert result.data.count() == result.silver.count() == 3 and ran == [name]
