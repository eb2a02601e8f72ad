"""Column and schema operators, dates, identifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from talweg.functions.dates import date_folder, parse_date
from talweg.functions.text import collapse
from talweg.operators import identifiers as ids
from talweg.operators import schema as sc
from talweg.operators.profiling import column_profile, value_counts
from talweg.sources.tables import scan
from workload.inputs import Registry, rows, table

QUERIES = Registry()
ORACLES = QUERIES.sql
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@QUERIES.query("SELECT o_orderkey, o_orderstatus FROM orders")
def pruned_scan(spark, sf):
    return scan(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_orderstatus"])


@QUERIES.query(
    "SELECT p_partkey AS sdb_p_partkey, p_name AS sdb_p_name, p_brand AS sdb_part_brand, p_type AS sdb_p_type,"
    " p_size AS sdb_p_size, p_retailprice AS sdb_p_retailprice FROM part"
)
def normalized_column_names(spark, sf):
    return sc.normalize_columns(table(spark, sf, "part").withColumnRenamed("p_brand", "Part Brand"))


@QUERIES.query("SELECT o_orderkey AS sdb_o_orderkey, o_orderpriority AS sdb_des_condic FROM orders")
def legacy_column_aliases(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("desc_condic"))
    return sc.apply_legacy_aliases(sc.normalize_columns(orders), {"sdb_des_condic"})


@QUERIES.query(f"SELECT doc_id, md5(trim(regexp_replace(text, '{WS}', ' ', 'g'))) AS clean FROM documents")
def whitespace_cleaned(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(collapse(F.col("text"))).alias("clean"))


PROPS = "CASE WHEN event_id % 97 = 0 THEN 'dez' ELSE concat(regexp_extract(props, '(\\d+)', 1), '.5') END"


@QUERIES.query(
    f"SELECT event_id AS sdb_event_id, try_cast({PROPS} AS DOUBLE) AS sdb_k, value::VARCHAR = '' AS sdb_unused,"
    " user_id AS sdb_user_id FROM events".replace("value::VARCHAR = '' AS sdb_unused,", "")
)
def coerced_types(spark, sf):
    events = table(spark, sf, "events").selectExpr(
        "event_id AS sdb_event_id",
        r"CASE WHEN event_id % 97 = 0 THEN 'dez' ELSE concat(regexp_extract(props, '(\\d+)', 1), '.5') END AS sdb_k",
        "cast(user_id AS double) AS sdb_user_id",
    )
    schema = sc.TableSchema(
        {"sdb_k": sc.ColumnRule("number"), "sdb_user_id": sc.ColumnRule("integer")}, require_geometry=False
    )
    return sc.conform(events, schema).data


@QUERIES.query(
    f"""
    WITH e AS (SELECT event_id, {PROPS} AS k, CASE WHEN event_id % 50 = 7 THEN NULL ELSE event_type END AS kind
               FROM events)
    SELECT 'k' AS "column", 'Coluna k nao pode ser convertida para number sem gerar '
           || count(*) FILTER (k IS NOT NULL AND try_cast(k AS DOUBLE) IS NULL)::VARCHAR || ' valor(es) nulo(s).' AS message
    FROM e
    UNION ALL SELECT 'kind', 'Coluna kind nao permite valores nulos.' FROM e HAVING bool_or(kind IS NULL)
    UNION ALL SELECT 'value', 'Coluna value tem tipo invalido: esperado integer, encontrado double.'
    FROM events HAVING NOT bool_and(value % 1 = 0)
    UNION ALL SELECT 'absent', 'Colunas obrigatorias ausentes: absent.'
    UNION ALL SELECT 'event_id', 'Colunas nao previstas no schema: event_id.'
    """
)
def schema_errors(spark, sf):
    events = table(spark, sf, "events").selectExpr(
        "event_id", "value",
        r"CASE WHEN event_id % 97 = 0 THEN 'dez' ELSE concat(regexp_extract(props, '(\\d+)', 1), '.5') END AS k",
        "CASE WHEN event_id % 50 = 7 THEN NULL ELSE event_type END AS kind",
    )
    schema = sc.TableSchema(
        {"k": sc.ColumnRule("number", nullable=False), "kind": sc.ColumnRule("string", nullable=False),
         "value": sc.ColumnRule("integer"), "absent": sc.ColumnRule()},
        require_geometry=False, allow_extra_columns=False,
    )
    return sc.error_rows(spark, sc.conform(events, schema).errors)


@QUERIES.query(
    """
    WITH have AS (SELECT DISTINCT user_id AS layer, lower(event_type) AS "column" FROM events),
         want("column", required) AS (VALUES ('click', true), ('error', true), ('absent', true), ('view', false), ('signup', false))
    SELECT layer, w."column", 'missing' AS difference FROM (SELECT DISTINCT layer FROM have), want w
    WHERE required AND NOT EXISTS (SELECT 1 FROM have h WHERE h.layer = have.layer AND h."column" = w."column")
    UNION ALL
    SELECT layer, "column", 'extra' FROM have WHERE "column" NOT IN (SELECT "column" FROM want)
    """.replace("(SELECT DISTINCT layer FROM have), want w", "(SELECT DISTINCT layer FROM have) have, want w")
)
def structure_differences(spark, sf):
    present = table(spark, sf, "events").select(
        F.col("user_id").alias("layer"), F.lit("events").alias("profile"), F.upper("event_type").alias("column")
    ).distinct()
    expected = rows(
        spark, "profile string, column string, required boolean, allow_extra boolean",
        ("events", "Click", True, False), ("events", "error", True, False), ("events", "absent", True, False),
        ("events", "view", False, False), ("events", "signup", False, False), ("events", "acm_x", True, False),
    )
    return sc.structure_diff(present, expected)


BOOLS = """CASE o_orderkey % 7 WHEN 0 THEN ' Sim' WHEN 1 THEN 'nao' WHEN 2 THEN 'TRUE' WHEN 3 THEN '0'
           WHEN 4 THEN 'yes' WHEN 5 THEN NULL ELSE 'talvez' END"""


@QUERIES.query(
    f"""SELECT o_orderkey, CASE WHEN t IN ('true', '1', 'sim', 'yes') THEN true
                               WHEN t IN ('false', '0', 'nao', 'no') THEN false END AS flag
        FROM (SELECT o_orderkey, lower(trim({BOOLS})) AS t FROM orders)"""
)
def boolean_texts(spark, sf):
    return table(spark, sf, "orders").selectExpr("o_orderkey", f"{BOOLS} AS t").select(
        "o_orderkey", sc.boolean_text(F.col("t")).alias("flag")
    )


@QUERIES.query(
    "SELECT DISTINCT p_brand AS profile, p_type AS \"column\", 'string' AS dtype, true AS required, true AS nullable FROM part"
)
def inferred_schema(spark, sf):
    domain = table(spark, sf, "part").select(F.col("p_brand").alias("profile"), F.col("p_type").alias("column"))
    return sc.infer_schema(domain)


@QUERIES.query(
    """SELECT o_orderkey AS sdb_key, o_orderstatus AS sdb_status, o_orderpriority AS sdb_priority,
              CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS acm_status FROM orders"""
)
def derived_kept_if_changed(spark, sf):
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS sdb_key", "o_orderstatus AS sdb_status", "o_orderpriority AS sdb_priority",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'X' END AS acm_status", "o_orderpriority AS acm_priority",
    )
    pairs = {"acm_status": "sdb_status", "acm_priority": "sdb_priority"}
    return sc.backfill_derived(sc.keep_changed(orders, pairs))


@QUERIES.query(
    """SELECT 'l_shipdate' AS "column", bool_and(l_shipdate = date_trunc('day', l_shipdate)) AS date_only FROM lineitem
       UNION ALL
       SELECT 'ts', bool_and(ts = date_trunc('day', ts)) FROM events"""
)
def date_only_columns(spark, sf):
    return sc.date_only_columns(table(spark, sf, "lineitem")).unionByName(
        sc.date_only_columns(table(spark, sf, "events"))
    )


@QUERIES.query("SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS l_shipdate FROM lineitem")
def timestamps_stored_as_dates(spark, sf):
    return sc.store_dates(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"))


DATE_TEXT = """CASE o_orderkey % 12
    WHEN 5 THEN concat({f}(o_orderdate, '{iso}'), 'T10:20:30Z') WHEN 6 THEN concat({f}(o_orderdate, '{iso}'), ' 23:59:59.123')
    WHEN 7 THEN concat({f}(o_orderdate, '{iso}'), 'T23:59:59.5-03:00') WHEN 8 THEN {f}(o_orderdate, '{short}')
    WHEN 0 THEN {f}(o_orderdate, '{iso} 00:00:00') WHEN 1 THEN {f}(o_orderdate, '{day}')
    WHEN 2 THEN concat(' ', {f}(o_orderdate, '{iso}'), ' ') WHEN 3 THEN 'None'
    WHEN 4 THEN {f}(o_orderdate, '{dash}') ELSE 'sem data' END"""
SPARK_DATE = DATE_TEXT.format(f="date_format", iso="yyyy-MM-dd", day="dd/MM/yyyy", dash="dd-MM-yyyy", short="dd/MM/yy").replace(
    "yyyy-MM-dd 00:00:00", "yyyy-MM-dd HH:mm:ss"
)


@QUERIES.query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 12 IN (0, 1, 2, 4, 5, 6, 7, 8) THEN o_orderdate::DATE END AS acm_date FROM orders"""
)
def dates_parsed(spark, sf):
    return table(spark, sf, "orders").selectExpr("o_orderkey", f"{SPARK_DATE} AS t").select(
        "o_orderkey", parse_date(F.col("t")).alias("acm_date")
    )


@QUERIES.query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 AND day(o_orderdate) <= 12
                               THEN strftime(o_orderdate, '%Y%d%m') ELSE strftime(o_orderdate, '%Y%m%d') END AS folder
       FROM orders"""
)
def date_folders(spark, sf):
    text = """CASE o_orderkey % 3 WHEN 0 THEN date_format(o_orderdate, 'yyyyMMdd')
              WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM-dd') ELSE date_format(o_orderdate, 'dd/MM/yyyy') END"""
    return table(spark, sf, "orders").selectExpr("o_orderkey", f"{text} AS t").select(
        "o_orderkey", date_folder(F.col("t")).alias("folder")
    )


@QUERIES.query(
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS acm_id FROM orders"
)
def sequential_ids(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return ids.add_sequential_id(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "acm_id")


@QUERIES.query(
    """SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_orderkey % 10 = 0 THEN o_orderpriority ELSE '3-SAME' END, o_orderkey) AS acm_id FROM orders"""
)
def ids_of_tied_rows(spark, sf):
    """Nine rows in ten share one key; they keep the order of the file and spread over partitions."""
    key = F.when(F.col("o_orderkey") % 10 == 0, F.col("o_orderpriority")).otherwise("3-SAME")
    orders = table(spark, sf, "orders").select("o_orderkey", key.alias("key"))
    return ids.add_sequential_id(orders, ["key"]).select("o_orderkey", "acm_id")


@QUERIES.query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) + 99 AS acm_id FROM orders")
def scan_order_ids(spark, sf):
    """Ids in file order (the orders file is sorted by its key), without a shuffle."""
    return ids.add_scan_order_id(table(spark, sf, "orders").select("o_orderkey", "_metadata"), start=100).select(
        "o_orderkey", "acm_id"
    )


@QUERIES.query(
    """SELECT c_custkey, row_number() OVER (ORDER BY c_name) AS acm_id, row_number() OVER (ORDER BY c_name) AS fid
       FROM customer"""
)
def output_identifiers(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return ids.assign_output_identifiers(customers, ["c_name"]).drop("c_name")


@QUERIES.query(
    """SELECT g, f, coalesce(sum(n) OVER (PARTITION BY g ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + 1 AS id_start
       FROM (SELECT l_returnflag AS g, l_linestatus || l_linenumber::VARCHAR AS f, count(*) AS n FROM lineitem GROUP BY ALL)"""
)
def group_id_offsets(spark, sf):
    files = table(spark, sf, "lineitem").groupBy(
        F.col("l_returnflag").alias("g"), F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("f")
    ).agg(F.count(F.lit(1)).alias("n"))
    return ids.group_offsets(files, ["g"], "f")


@QUERIES.query(
    """WITH v AS (SELECT o_custkey AS k, o_orderkey % 4 AS n FROM orders GROUP BY ALL)
       SELECT k, printf('%02d', min(c)) AS version
       FROM (SELECT DISTINCT o_custkey AS k FROM orders) o, range(0, 5) r(c)
       WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.k = o.k AND v.n = c) GROUP BY k"""
)
def next_free_versions(spark, sf):
    used = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), (F.col("o_orderkey") % 4).alias("version"))
    return ids.next_free_version(used, ["k"], used.select("k"))


@QUERIES.query(
    """SELECT o_custkey AS k, max(printf('%02d', o_orderkey % 40)) AS version FROM orders
       WHERE o_orderstatus <> 'P' GROUP BY o_custkey"""
)
def latest_versions_with_data(spark, sf):
    versions = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("k"), F.format_string("%02d", F.col("o_orderkey") % 40).alias("version"),
        (F.col("o_orderstatus") != "P").alias("has_data"),
    )
    return ids.latest_version(versions, ["k"])


@QUERIES.query(
    """SELECT url AS path FROM pages ORDER BY page_id % 7 DESC, (page_id % 3)::VARCHAR DESC, url DESC LIMIT 1"""
)
def latest_reference_path(spark, sf):
    pages = table(spark, sf, "pages").select(
        (F.col("page_id") % 7).alias("stamp"), (F.col("page_id") % 3).alias("date"), F.col("url").alias("path")
    )
    return ids.latest_reference(pages, ["stamp", "date"], "path")


PART_TEXT = "SELECT trim(p_name) AS p_name, p_brand, CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_type END AS p_type, p_size FROM part"


@QUERIES.query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", coalesce({c}::VARCHAR, '<NULL>') AS value, count(*) AS n
            FROM ({PART_TEXT}) GROUP BY ALL"""
        for c in ("p_name", "p_brand", "p_type", "p_size")
    )
)
def unique_value_counts(spark, sf):
    part = table(spark, sf, "part").selectExpr(
        "concat(' ', p_name) AS p_name", "p_brand", "CASE WHEN p_size % 10 = 0 THEN '  ' ELSE p_type END AS p_type", "p_size"
    )
    return value_counts(part, ["p_name", "P_BRAND", "sdb_p_type", "p_size"])


@QUERIES.query(
    f"""SELECT 'p_name' AS "column", 'string' AS type, count(DISTINCT p_name) AS unique_values FROM ({PART_TEXT})
        UNION ALL SELECT 'p_type', 'string', count(DISTINCT p_type) + max((p_type IS NULL)::INT) FROM ({PART_TEXT})
        UNION ALL SELECT 'p_size', 'int', count(DISTINCT p_size) FROM part"""
)
def column_profiles(spark, sf):
    part = table(spark, sf, "part").selectExpr(
        "p_name", "CASE WHEN p_size % 10 = 0 THEN '  ' ELSE p_type END AS p_type", "p_size"
    )
    return column_profile(part)
