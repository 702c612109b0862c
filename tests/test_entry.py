import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "version" in df.columns and "lastversion" in df.columns


def test_registry_names():
    qs = entry.queries()
    assert len(qs) >= 50
    assert all(callable(f) for f in qs.values())
