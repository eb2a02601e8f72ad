"""Domain validation, relations and rule mining."""

from __future__ import annotations

from pyspark.sql import functions as F

from talweg.operators import domains as d
from talweg.operators import mining as m
from talweg.operators import relations as r
from workload.inputs import Registry, rows, table

QUERIES = Registry()
ORACLES = QUERIES.sql

# Priorities: one value missing from the domain, one reached by an alias.
PRIORITY = """CASE WHEN {k} % 13 = 0 THEN NULL WHEN {k} % 17 = 0 THEN '  ' WHEN {k} % 5 = 1 THEN concat(' ', lower(o_orderpriority), ' ')
              ELSE o_orderpriority END""".format(k="o_orderkey")
PRIORITY_SQL = f"""
    SELECT o_orderkey, o_orderstatus, p, upper(trim(p)) AS k, trim(p) AS t FROM (SELECT *, {PRIORITY} AS p FROM orders)
"""
CLASSIFIED_SQL = f"""
    SELECT o_orderkey, o_orderstatus, p,
           CASE WHEN p IS NULL THEN NULL WHEN t = '' THEN p WHEN k = '1-URGENT' THEN '1-Urgent' WHEN k = '2-HIGH' THEN '2-High'
                WHEN k = '3-MEDIUM' THEN '3-Medium' WHEN k = '4-NOT SPECIFIED' THEN '3-Medium' ELSE t END AS value,
           CASE WHEN p IS NULL OR t = '' THEN 'empty' WHEN k IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'valid'
                WHEN k = '4-NOT SPECIFIED' THEN 'normalized' ELSE 'invalid' END AS status,
           CASE WHEN p IS NULL THEN 'Valor nulo.' WHEN t = '' THEN 'Valor vazio.'
                WHEN k = '4-NOT SPECIFIED' THEN concat('Valor normalizado por alias: ', t, ' -> 3-Medium')
                WHEN k IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN '' ELSE 'Valor fora do dominio configurado.' END AS reason
    FROM ({PRIORITY_SQL})
"""


def priority_lookup(spark):
    values = rows(spark, "canonical string, position int", ("1-Urgent", 0), ("2-High", 1), ("3-Médium", 2), ("3-Medium", 3))
    aliases = rows(spark, "alias string, canonical string, position int",
                   ("4-not  specified", "3-Medium", 0), ("1-urgent", "2-High", 1))
    return d.domain_lookup(values, aliases, [])


def priorities(spark, sf):
    return table(spark, sf, "orders").selectExpr("o_orderkey", "o_orderstatus", f"{PRIORITY} AS p")


def classified(spark, sf):
    return d.classify(priorities(spark, sf), "p", priority_lookup(spark))


@QUERIES.query(f"SELECT o_orderkey, value, status, reason FROM ({CLASSIFIED_SQL})")
def domain_classified(spark, sf):
    return classified(spark, sf).select("o_orderkey", "domain.*")


@QUERIES.query(
    f"SELECT DISTINCT trim(p) AS value, value AS replacement, status, status = 'normalized' AS corrected FROM ({CLASSIFIED_SQL}) WHERE trim(p) <> ''"
)
def domain_value_mapping(spark, sf):
    return d.value_mapping(priorities(spark, sf), "p", priority_lookup(spark))


@QUERIES.query(
    f"""SELECT 'p' AS "column", status, CASE WHEN status IN ('empty', 'invalid') THEN reason ELSE '' END AS reason, count(*) AS n
        FROM ({CLASSIFIED_SQL}) GROUP BY ALL
        UNION ALL SELECT 'o_orderstatus', 'unconfigured', '', count(*) FROM orders"""
)
def domain_status_counts(spark, sf):
    both = classified(spark, sf).withColumn("s", d.unconfigured(F.col("o_orderstatus")))
    return d.status_counts(both, {"p": "domain", "o_orderstatus": "s"})


@QUERIES.query(
    f"""SELECT 'p' AS "column", value, count(*) AS n FROM ({CLASSIFIED_SQL}) WHERE status = 'invalid' GROUP BY value"""
)
def invalid_domain_values(spark, sf):
    return d.invalid_value_counts(priorities(spark, sf), priority_lookup(spark).withColumn("column", F.lit("p")), ["p"])


@QUERIES.query(
    f"""SELECT reason, n, rank FROM (
          SELECT reason, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, reason) AS rank
          FROM ({CLASSIFIED_SQL}) WHERE reason <> '' GROUP BY reason) WHERE rank <= 5"""
)
def top_reasons(spark, sf):
    counts = (
        classified(spark, sf).filter("domain.reason != ''").groupBy(F.col("domain.reason").alias("reason"))
        .agg(F.count(F.lit(1)).alias("n")).withColumn("column", F.lit("p"))
    )
    return r.top_counts(counts, ["column"], "reason", 5).select("reason", "n", "rank")


# Customers carry a segment code; every 9th row has a wrong one, unknown segments stay.
SEGMENT_SQL = """
    SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_mktsegment END AS segment,
           CASE WHEN c_custkey % 9 = 0 THEN 'wrong' ELSE lower(c_mktsegment) END AS code,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'automobile' WHEN 'BUILDING' THEN 'building' WHEN 'FURNITURE' THEN 'furniture'
                WHEN 'HOUSEHOLD' THEN 'home' END AS mapped FROM customer
"""
ENFORCED_SQL = f"""
    SELECT c_custkey, segment, CASE WHEN segment IS NULL OR mapped IS NULL THEN code ELSE mapped END AS code,
           CASE WHEN segment IS NULL OR mapped IS NULL THEN 'unchecked' WHEN code = mapped THEN 'consistent'
                ELSE 'autocorrected' END AS status FROM ({SEGMENT_SQL})
"""


def enforced(spark, sf):
    customers = table(spark, sf, "customer").selectExpr(
        "c_custkey", "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_mktsegment END AS segment",
        "CASE WHEN c_custkey % 9 = 0 THEN 'wrong' ELSE lower(c_mktsegment) END AS code",
    )
    pairs = rows(spark, "src_value string, dst_value string", ("AUTOMOBILE", "automobile"), ("BUILDING", "building"),
                 ("FURNITURE", "furniture"), ("HOUSEHOLD", "home"))
    relation = r.resolve_relation("segment_to_code", customers.columns)
    return r.enforce_relation(customers, relation, pairs, "segment", "code", "status")


@QUERIES.query(f"SELECT * FROM ({ENFORCED_SQL})")
def relation_enforced(spark, sf):
    return enforced(spark, sf)


RELATION_COUNTS = f"""
    SELECT 'segment_to_code' AS relation, status, CASE WHEN status <> 'consistent' THEN coalesce(segment, '<NULL>') END AS source_value,
           count(*) AS n FROM ({ENFORCED_SQL}) GROUP BY ALL
"""


@QUERIES.query(RELATION_COUNTS)
def relation_status_counts(spark, sf):
    return r.relation_summary(enforced(spark, sf), "segment_to_code", "segment", "status")


@QUERIES.query(
    f"""SELECT status, source_value, n, rank FROM (
          SELECT *, row_number() OVER (PARTITION BY status ORDER BY n DESC, source_value) AS rank FROM ({RELATION_COUNTS})
          WHERE source_value IS NOT NULL) WHERE rank <= 5"""
)
def top_relation_sources(spark, sf):
    counts = r.relation_summary(enforced(spark, sf), "segment_to_code", "segment", "status")
    return r.top_counts(counts.filter("source_value IS NOT NULL"), ["status"], "source_value", 5).drop("relation")


@QUERIES.query(
    """SELECT 'nation_to_region' AS relation, s AS src_value, t AS dst_value,
              min(t) OVER (PARTITION BY s) <> max(t) OVER (PARTITION BY s) AS ambiguous
       FROM (SELECT DISTINCT n_name AS s, CASE WHEN c_custkey % 97 = 0 AND n_nationkey < 10 THEN 'ODD' ELSE r_name END AS t
             FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
)
def functional_dependencies(spark, sf):
    flat = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    target = F.when((F.col("c_custkey") % 97 == 0) & (F.col("n_nationkey") < 10), "ODD").otherwise(F.col("r_name"))
    return m.functional_dependency(flat, m.clean_value(F.col("n_name")), m.clean_value(target), "nation_to_region")


@QUERIES.query(
    """SELECT 'cust_to_segment' AS relation, s AS src_value, min(t) AS dst_value
       FROM (SELECT c_name AS s, c_mktsegment AS t FROM customer WHERE c_mktsegment <> 'MACHINERY'
             UNION ALL SELECT c_name, 'BUILDING' FROM customer WHERE c_custkey % 3 = 0)
       WHERE s NOT LIKE '%7' GROUP BY s
       HAVING min(t) = max(t)
          AND s NOT IN (SELECT c_name FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_custkey % 3 = 0)"""
)
def relations_mined(spark, sf):
    """New customer-to-segment pairs: one target each, target in its domain, source not yet mapped."""
    customer = table(spark, sf, "customer")
    seen = customer.select(F.col("c_name").alias("s"), F.col("c_mktsegment").alias("t")).unionByName(
        customer.filter("c_custkey % 3 = 0").select(F.col("c_name").alias("s"), F.lit("BUILDING").alias("t"))
    )
    values = rows(spark, "canonical string, position int", ("AUTOMOBILE", 0), ("BUILDING", 1), ("FURNITURE", 2), ("HOUSEHOLD", 3))
    aliases = rows(spark, "alias string, canonical string, position int")
    existing = customer.filter(F.col("c_name").endswith("7")).select(F.lit("cust_to_segment").alias("relation"), F.col("c_name").alias("src_value"))
    lookups = d.domain_lookup(values, aliases, []).withColumn("column", F.lit("t"))
    return m.mine_relations(seen, [("cust_to_segment", "s", "t")], lookups, ["t"], existing)


@QUERIES.query(
    """WITH p AS (SELECT DISTINCT p_name AS v FROM part)
       SELECT 'name' AS "column", 'accepted' AS kind, v AS value, v AS canonical FROM p WHERE v NOT LIKE '%anvil'
       UNION ALL SELECT 'name', 'alias', concat(v, 's'), v FROM p
       UNION ALL SELECT 'name', 'alias', concat(v, 's Ã§'), concat(v, 's ç') FROM p
       UNION ALL SELECT 'name', 'accepted', concat(v, 's ç'), concat(v, 's ç') FROM p"""
)
def domain_autofix(spark, sf):
    """Frequent names are accepted, their plurals follow as aliases, broken texts follow their repair."""
    part = table(spark, sf, "part").select(F.col("p_name").alias("v"))
    broken = F.decode(F.encode(F.concat("v", F.lit("s ç")), "UTF-8"), "ISO-8859-1")
    seen = (
        part.filter("NOT endswith(v, 'anvil')").withColumn("w", F.lit(5))
        .unionByName(part.select(F.concat("v", F.lit("s")).alias("v"), F.lit(1).alias("w")))
        .unionByName(part.select(broken.alias("v"), F.lit(1).alias("w")))
    )
    invalid = seen.groupBy(F.col("v").alias("value")).agg(F.sum("w").alias("n")).withColumn("column", F.lit("name"))
    accepted = part.filter("endswith(v, 'anvil')").select(F.lit("name").alias("column"), F.col("v").alias("canonical"))
    return m.autofix_domain(invalid, accepted)
