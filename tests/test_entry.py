import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 20
    assert df.columns == ["zone_id", "pagerank", "label"]
    assert rows[0].zone_id == 143  # FIXTURES: highest rank at sf0.001


def test_oracle_keys_are_registered():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 50
