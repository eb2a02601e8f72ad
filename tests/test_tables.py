import datetime

import pytest
from pyspark.sql import functions as F

from talweg.operators import domains as d
from talweg.operators import duplicates as dup
from talweg.operators import identifiers as ids
from talweg.operators import relations as r
from talweg.operators import schema as sc


def rule(dtype, **options):
    return sc.TableSchema({"c": sc.ColumnRule(dtype, **options)}, require_geometry=False)


def test_coercion(spark):
    frame = spark.createDataFrame([(1.5,), (None,)], "c double")
    assert [x.c for x in sc.conform(frame, rule("string")).data.collect()] == ["1.5", None]
    whole = spark.createDataFrame([(1.0,), (None,)], "c double")
    out = sc.conform(whole, rule("integer"))
    assert out.data.dtypes == [("c", "bigint")] and not out.errors
    parts = sc.conform(frame, rule("integer"))
    assert parts.data.dtypes == [("c", "double")] and "tipo invalido" in parts.errors[0][1]
    text = spark.createDataFrame([("10.5",), ("dez",)], "c string")
    assert [x.c for x in sc.conform(text, rule("number")).data.collect()] == [10.5, None]
    guarded = sc.conform(text, rule("number", nullable=False))
    assert len(guarded.errors) == 1 and "sem gerar 1" in guarded.errors[0][1]
    assert guarded.data.dtypes == [("c", "string")]
    flags = spark.createDataFrame([("Sim",), ("nao",)], "c string")
    assert [x.c for x in sc.conform(flags, rule("bool")).data.collect()] == [True, False]
    unsure = sc.conform(spark.createDataFrame([("Sim",), ("?",)], "c string"), rule("bool"))
    assert unsure.errors and unsure.data.dtypes == [("c", "string")]


def test_text_dates_stay_text_for_the_date_function(spark):
    frame = spark.createDataFrame([("31/01/2025",)], "c string")
    assert sc.conform(frame, rule("date")).data.dtypes == [("c", "string")]
    assert sc.conform(frame, rule("date"), keep_text_dates=False).data.first().c == datetime.datetime(2025, 1, 31)


def test_names_and_presence(spark):
    frame = spark.createDataFrame([(1, 2, b"")], "`Nome UF` int, sdb_x int, geometry binary")
    named = sc.normalize_columns(frame)
    assert named.columns == ["sdb_nome_uf", "sdb_x", "geometry"] and sc.columns_are_normalized(named)
    assert sc.normalize_columns(named).columns == named.columns
    closed = sc.TableSchema({"sdb_x": sc.ColumnRule(), "sdb_y": sc.ColumnRule()}, allow_extra_columns=False)
    assert sc.missing_columns(named, closed) == ["sdb_y"]
    assert sc.unexpected_columns(named, closed) == ["sdb_nome_uf"]
    assert sc.derived_name("sdb_x") == "acm_x" == sc.derived_name("x") == sc.derived_name("acm_x")
    assert sc.TableSchema.from_config(None, []) is None
    assert sc.TableSchema.from_config({}, ["sdb_a"]).columns["sdb_a"].dtype == "string"


def test_derived_columns_kept_only_when_changed(spark):
    frame = spark.createDataFrame([("A", "A", "A"), (None, None, "B")], "sdb_x string, acm_x string, acm_y string")
    pairs = {"acm_x": "sdb_x", "acm_y": "sdb_x"}
    assert sc.changed_columns(frame, pairs) == {"acm_y"}
    assert sc.keep_changed(frame, pairs).columns == ["sdb_x", "acm_y"]
    assert sc.keep_changed(frame, pairs, always_emit=True).columns == frame.columns
    fill = spark.createDataFrame([("Cacoal", None), ("x", "x")], "sdb_m string, acm_m string")
    assert [v.acm_m for v in sc.backfill_derived(fill).collect()] == ["Cacoal", "x"]
    typed = spark.createDataFrame([("t", None)], "sdb_d string, acm_d date")
    assert sc.backfill_derived(typed).first().acm_d is None


@pytest.mark.parametrize("partitions", [1, 7])
def test_sequential_ids_do_not_depend_on_partitions(spark, partitions):
    frame = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(partitions)
    rows = ids.add_sequential_id(frame, ["k"], start=5).collect()
    assert sorted((x.k, x.acm_id) for x in rows) == [(i, i + 5) for i in range(1000)]


def test_scan_order_ids_over_several_files(spark, tmp_path):
    spark.range(300).repartition(3).sortWithinPartitions("id").write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t")).select("id", "_metadata")
    got = [x.acm_id for x in ids.add_scan_order_id(frame).collect()]
    assert sorted(got) == list(range(1, 301))


def lookup(spark):
    values = spark.createDataFrame([("Ilheus - Itabuna", 0), ("Cacoal", 1)], "canonical string, position int")
    aliases = spark.createDataFrame([("Ilheus", "Ilheus - Itabuna", 0), ("CACOAL", "wrong", 1)],
                                    "alias string, canonical string, position int")
    return d.domain_lookup(values, aliases, [])


@pytest.mark.parametrize("small", [True, False])
def test_classification(spark, small):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(["Ilhéus", " cacoal", "x ", "", None])], "i int, v string")
    got = [tuple(x.domain) for x in d.classify(frame, "v", lookup(spark), small=small).orderBy("i").collect()]
    assert got == [
        ("Ilheus - Itabuna", "normalized", "Valor normalizado por alias: Ilhéus -> Ilheus - Itabuna"),
        ("Cacoal", "valid", ""), ("x", "invalid", d.INVALID_VALUE), ("", "empty", d.BLANK_VALUE), (None, "empty", d.NULL_VALUE),
    ]


def test_relations_chain_on_one_target(spark):
    frame = spark.createDataFrame([("a", "b", "old")], "sdb_x string, sdb_y string, sdb_t string")
    assert r.resolve_relation("x_to_t", frame.columns) == r.Relation("x_to_t", "sdb_x", "sdb_t")
    assert r.resolve_relation("nothing", frame.columns) is None
    pairs = lambda s, t: spark.createDataFrame([(s, t)], "src_value string, dst_value string")
    for source, key, value, status in (("sdb_x", "a", "one", "autocorrected"), ("sdb_y", "b", "two", "autocorrected"),
                                       ("sdb_y", "z", "three", "unchecked")):
        relation = r.Relation("n", source, "sdb_t")
        frame = r.enforce_relation(frame, relation, pairs(key, value), source, "sdb_t", "s")
        assert frame.first().s == status
        frame = frame.drop("s")
    assert frame.first().sdb_t == "two"


def test_duplicates_treat_nulls_as_equal_and_salting_changes_nothing(spark):
    rows = [(i, "A" if i % 3 else None, i % 2) for i in range(60)] + [(99, "only", 7)]
    frame = spark.createDataFrame(rows, "acm_id int, a string, b int")
    for hot in (2, 10**6):
        flagged = dup.flag_attribute_duplicates(frame, hot_rows=hot).collect()
        assert {x.acm_id for x in flagged if not x.dup_attributes} == {99}
        assert len(flagged) == len(rows)
        repeats = dup.flag_repeats(frame, ["a", "b"], "acm_id", hot_rows=hot).collect()
        assert sum(x["repeat"] for x in repeats) == 60 - 4
    assert dup.duplicate_count(frame, F.col("a")).first().n == 60


def test_row_digest_is_injective_for_shifted_values(spark):
    frame = spark.createDataFrame([(1, "ab", "c"), (2, "a", "bc"), (3, None, "-"), (4, "-", None)], "acm_id int, x string, y string")
    assert not any(x.dup_attributes for x in dup.flag_attribute_duplicates(frame).collect())


def test_versions_compare_as_numbers(spark):
    rows = [("a", "99", True), ("a", "100", True), ("a", "101", False), ("b", "x", True), ("b", "07", True)]
    frame = spark.createDataFrame(rows, "k string, version string, has_data boolean")
    assert {tuple(r) for r in ids.latest_version(frame, ["k"]).collect()} == {("a", "100"), ("b", "07")}


def test_ordering_runs_costly_work_once_for_each_row(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def costly(v):
        calls.add(1)
        return v

    frame = spark.range(1000).repartition(4)
    numbered = ids.add_sequential_id(frame, ["id"], work=lambda rows: rows.withColumn("w", costly("id")))
    assert numbered.filter("w = id AND acm_id = id + 1").count() == 1000 and calls.value == 1000


def test_staged_tables_of_a_scope_go_together(spark):
    from talweg.operators import scale

    kept = scale.stage(spark.range(3))
    spark.conf.set(scale.SCOPE, "one-run")
    try:
        folder = scale.staging_folder(spark)
        assert "/talweg/one-run/" in folder
        spark.range(4).write.parquet(folder)
        assert spark.read.parquet(folder).count() == 4
        assert scale.remove_staged(spark) and not scale.remove_staged(spark)
    finally:
        spark.conf.unset(scale.SCOPE)
    assert kept.count() == 3
