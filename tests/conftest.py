import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lamina.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Joins as they are planned when nothing fits a broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.fixture
def rows(spark):
    """Build a frame from a DDL schema and tuples."""
    from datetime import date, datetime

    from pyspark.sql import functions as F
    from pyspark.sql.types import _parse_datatype_string

    def build(ddl, *tuples):
        schema = _parse_datatype_string(ddl)
        # Everything goes in as text and is cast, so NTZ and decimals stay exact.
        text = ", ".join(f"`{f.name}` string" for f in schema.fields)
        as_text = [
            tuple(v.isoformat(sep=" ") if isinstance(v, datetime)
                  else v.isoformat() if isinstance(v, date)
                  else None if v is None else str(v) for v in t)
            for t in tuples
        ]
        df = spark.createDataFrame(as_text, text)
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])

    return build
