import __spark_entry__ as entry


def test_queries_have_their_sql():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q) and len([n for n in sql if not n.startswith("op")]) >= 70


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
