"""The driver contract: every registered query returns flat, engine-neutral columns."""

import pytest
from pyspark.sql import types as T

import __spark_entry__ as entry
from sparklytics.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
ALLOWED = (T.StringType, T.LongType, T.TimestampNTZType, T.BooleanType, T.DoubleType, T.DateType)


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if not k.endswith("_replay")))
def test_flat_schema(spark, name):
    schema = QUERIES[name](spark, SF).schema
    names = [f.name for f in schema.fields]
    assert len(names) == len(set(names)), names
    for f in schema.fields:
        assert isinstance(f.dataType, ALLOWED), (name, f.name, f.dataType)


def test_oracle_keys_are_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(sql.strip() for sql in entry.oracle_sql().values())
