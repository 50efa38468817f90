"""Every registered query against its DuckDB oracle at sf0.01, plus the
driver contract (entry, key sets, declared double columns)."""

import os

import pytest
from pyspark.sql.types import DoubleType

import __spark_entry__ as entry
from bench.oracle_check import duck, rows_of
from eventlake.plans.registry import oracle_text
from tests.conftest import SF01

KEYS = sorted(entry.load_all())
DUCK_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    out = df.collect()
    assert len(out) > 0
    assert df.columns[:3] == ["device_type", "event_date", "percentile_95th"]


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.skipif(os.environ.get("EVENTLAKE_SKIP_ORACLE") == "1", reason="oracle run disabled")
@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, registry, con, key):
    sdf = entry.queries()[key](spark, SF01)
    doubles = {f.name for f in sdf.schema.fields if isinstance(f.dataType, DoubleType)}
    assert doubles == set(registry[key].doubles), "declared double columns must be rounded on both sides"
    rel = con.sql(oracle_text(registry[key]))
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    spark_types = {f.name: DUCK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in sdf.schema.fields}
    assert spark_types == duck_types
    spark_pdf = sdf.toPandas()
    oracle_pdf = rel.df()
    assert sorted(spark_pdf.columns) == sorted(oracle_pdf.columns)
    assert len(spark_pdf) == len(oracle_pdf)
    assert rows_of(spark_pdf) == rows_of(oracle_pdf)
