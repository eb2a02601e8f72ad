import os

import duckdb
import pytest

import check
import workload

SF = os.environ.get("TALWEG_TEST_SF", "/root/testdata/sf0.001")
QUERIES, ORACLES = workload.queries(), workload.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return check.connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, name):
    note, good = check.compare(spark, connection, SF, QUERIES[name], ORACLES.get(name))
    assert good, note


def test_every_sql_text_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_canonical_domain_texts_equal_sql_on_odd_texts(spark, tmp_path):
    """Missing and empty texts, question marks at the end, white space beyond ASCII."""
    white = ["", *map(chr, (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1F, 0x20, 0x85, 0xA0, 0x1680, 0x180E, 0x2003, 0x200B, 0x2028, 0x202F, 0x205F, 0x3000, 0xFEFF))]
    texts = [None, "?", " ? ? ", "a ?", "¿", " ¿ ? ¿ ? ", *white, *[f"a{w}b{w}{w}c {w}" for w in white], *[f"a ? {w}" for w in white]]
    rows = [("s", "en", x) for x in texts] + [(s, g, "x") for s in (None, " ? ", "?", *white) for g in (None, " ", "\xa0", "en")]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, source string, lang string, text string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    name = "domain_texts_canonical"
    note, good = check.compare(spark, connection, str(tmp_path), QUERIES[name], ORACLES[name])
    assert good, note
