import datetime as dt
from decimal import Decimal

from levyline.schemas import TableSpec


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def make(spark, spec: TableSpec, rows: list[dict]):
    """A DataFrame in the spec's layout from partial rows (absent fields are NULL)."""
    data = []
    for r in rows:
        out = []
        for name, typ in spec.columns:
            v = r.get(name)
            if v is not None and typ.startswith("decimal"):
                v = Decimal(str(v))
            if v is not None and typ == "timestamp_ntz" and isinstance(v, str):
                v = ts(v)
            out.append(v)
        data.append(tuple(out))
    return spark.createDataFrame(data, spec.schema)


def rows_by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}
