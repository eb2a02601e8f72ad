import pytest

from talweg import local_session, ship_package


# Started here so that test modules can build columns at import.
SESSION = local_session("8", "talweg-tests")
ship_package(SESSION)


@pytest.fixture(scope="session")
def spark():
    return SESSION


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def results(df, *columns):
    """Column values in order of the row number ``i``."""
    rows = df.select("i", *[c.alias(f"c{k}") for k, c in enumerate(columns)]).orderBy("i").collect()
    return [tuple(r)[1:] if len(columns) > 1 else r["c0"] for r in rows]
