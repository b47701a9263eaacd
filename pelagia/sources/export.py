"""CSV export of products that carry a taxon -> value map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_table(df: DataFrame, column: str, key: str = "taxon") -> DataFrame:
    """The distinct keys of a map column, one per row; each task hands on its distinct ones only."""
    return df.select(F.explode(F.map_keys(column)).alias(key)).distinct()


def map_keys(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct keys of a map column.

    Column names are a part of the plan, so the driver needs them: one name per column of the
    file, however many there are. ``long_rows`` is the form that needs none.
    """
    return sorted(r[0] for r in key_table(df, column).collect())


def widen(df: DataFrame, column: str, keys: list[str] | None = None) -> DataFrame:
    """Give each map key its own column, in key order, after the other columns."""
    keys = map_keys(df, column) if keys is None else keys
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    if not keys:
        return df.select(*rest)
    value_type = df.schema[column].dataType.valueType.simpleString()
    # Laying the map over a template holding every key lines its values up once per row,
    # instead of searching the map again for each of the columns.
    names = F.array(*[F.lit(k) for k in keys])
    template = F.map_from_arrays(
        names, F.array_repeat(F.lit(None).cast(value_type), len(keys))
    )
    own = F.coalesce(F.col(column), F.create_map().cast(f"map<string,{value_type}>"))
    lined = F.map_values(F.map_zip_with(template, own, lambda _k, _none, v: v))
    staged = df.select(*rest, lined.alias("__values"))
    kept = [F.col(f"`{c}`") for c in staged.columns if c != "__values"]
    return staged.select(*kept, *[F.col("__values")[i].alias(k) for i, k in enumerate(keys)])


def long_rows(df: DataFrame, column: str, key: str = "taxon", value: str = "value") -> DataFrame:
    """One row per map entry; rows without a map are kept with NULL key and value."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.select(*rest, F.explode_outer(column).alias(key, value))


def with_json(df: DataFrame, column: str) -> DataFrame:
    """The map column as JSON text, NULL values included."""
    return df.withColumn(column, F.to_json(column, {"ignoreNullFields": "false"}))


def write_wide_csv(df: DataFrame, column: str, path: str, keys: list[str] | None = None) -> list[str]:
    """Write the wide form as CSV and return its column names; ``keys`` if they are known already."""
    wide = widen(df, column, keys)
    for name, kind in wide.dtypes:
        if kind.startswith("timestamp"):
            wide = wide.withColumn(name, F.date_format(F.col(f"`{name}`"), "yyyy-MM-dd HH:mm:ss"))
    wide.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return wide.columns
