import re

import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 105
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    try:
        import pricelab.llm.queries  # noqa: F401
    except ImportError:
        assert not any(re.match(r"op\d+_", k) or "pipeline" in k for k in q)
