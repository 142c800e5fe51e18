"""Hand-written frames for tests."""

import datetime as dt

from clickloom.schemas import RAW_TABLES


def ts(text):
    return dt.datetime.fromisoformat(text)


def raw(spark, table, rows):
    """Raw rows from dicts; columns left out get a harmless default."""
    schema = RAW_TABLES[table].schema
    defaults = {
        "string": "x", "bigint": 1_000_000, "double": 10.0,
        "timestamp": ts("2024-01-03 10:00:00"), "date": dt.date(2024, 1, 1),
    }
    full = [tuple(r.get(f.name, defaults[f.dataType.simpleString()]) for f in schema.fields) for r in rows]
    return spark.createDataFrame(full, schema)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
