import __spark_entry__ as entry


def test_entry_and_names(spark):
    assert {r.route for r in entry.entry(spark).collect()} <= {"skip", "llm_small", "llm_large", "unknown"}
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) >= 60 and all(map(callable, queries.values()))
