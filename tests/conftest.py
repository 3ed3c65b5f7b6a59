from __future__ import annotations

import datetime as dt
import decimal
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from statera.session import build_session  # noqa: E402
from statera.sources.schema import SCHEMAS  # noqa: E402
from statera.sources.tables import FinanceTables  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    import tempfile
    s = build_session("local[4]", shuffle_partitions=4, app_name="statera-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="statera-wh-")})
    yield s
    s.stop()


def _convert(value, dtype):
    if value is None:
        return None
    if isinstance(dtype, T.DecimalType):
        return decimal.Decimal(str(value))
    if isinstance(dtype, T.DateType) and isinstance(value, str):
        return dt.date.fromisoformat(value)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)) and isinstance(value, str):
        return dt.datetime.fromisoformat(value)
    if isinstance(dtype, (T.LongType, T.IntegerType)) and isinstance(value, float):
        return int(value)
    return value


def frame(spark: SparkSession, name: str, rows: list[dict], types: dict | None = None):
    """DataFrame of relation ``name`` from dict rows; missing columns are NULL;
    ``types`` overrides column types (e.g. timestamps with a time of day)."""
    fields = []
    for f in SCHEMAS[name].fields:
        dtype = (types or {}).get(f.name, f.dataType)
        fields.append(T.StructField(f.name, dtype, True))
    schema = T.StructType(fields)
    data = [tuple(_convert(r.get(f.name), f.dataType) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)


def tables(spark: SparkSession, types: dict | None = None, **relations: list[dict]) -> FinanceTables:
    """FinanceTables over hand-written rows; relations not given are empty."""
    types = types or {}
    frames = {name: frame(spark, name, relations.get(name, []), types.get(name)) for name in SCHEMAS}
    return FinanceTables(frames)


def dec(x) -> decimal.Decimal:
    return decimal.Decimal(str(x))
