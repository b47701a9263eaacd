"""The derived tables as Spark DataFrames, and results in a form two engines can compare."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.plans import Catalog
from pelagia.session import tune

from .tables import BASE, TABLES, reads, trip

# Laboratory tables and profiles turn each narrow line into dozens of values. They are grouped, and read, by this key.
PLACED = {
    **dict.fromkeys(("bgc_chemistry", "bgc_pigments", "bgc_tss", "bgc_tss_meta", "bgc_picoplankton", "bgc_picoplankton_meta"), trip("l_orderkey")),
    "measurements": "l_orderkey",
}
# Counts by trip read lines with the names of their parts; these are all columns that they read of both.
COUNTS = ("bgc_phyto_raw", "bgc_zoop_raw")
COUNTED = "{lineitem} JOIN {taxon} ON p_partkey = l_partkey"
COUNTED_COLUMNS = ("l_orderkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_quantity", "l_extendedprice", "taxon_name", "code", "genus", "species")


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(
    spark: SparkSession, sf_dir: str, name: str, seen: dict[str, DataFrame] | None = None
) -> DataFrame:
    """A base or derived table; ``seen`` keeps frames already built for the same query."""
    seen = {} if seen is None else seen
    if name not in seen:
        if name in BASE:
            seen[name] = base(spark, sf_dir, name)
        else:
            sql = TABLES[name]
            tables = {n: derived(spark, sf_dir, n, seen) for n in reads(sql)}
            if name in PLACED:
                tables["lineitem"] = placed(tables["lineitem"], PLACED[name])
            elif name in COUNTS:
                sql, tables = sql.replace(COUNTED, "{counted}"), {"counted": counted(**tables)}
            seen[name] = spark.sql(sql, **tables)
    return seen[name]


def placed(lines: DataFrame, key: str) -> DataFrame:
    """Lines placed by key while they are narrow.

    What is grouped by the key and more, and joined by it, then stays where it is. Parts are many,
    as rows grow tenfold in them.
    """
    parts = 4 * int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lines.repartition(parts, F.expr(key))


def counted(lineitem: DataFrame, taxon: DataFrame) -> DataFrame:
    """Lines with the names of their parts, placed by trip, in one exchange for all counts.

    Spark makes an exchange once if its readers ask for the same rows and columns. ``stack`` reads
    all columns and is not filtered below, so they do, whatever they use.
    """
    lines = placed(lineitem.join(taxon, F.expr("p_partkey = l_partkey")).select(*COUNTED_COLUMNS), trip("l_orderkey"))
    key, *others = COUNTED_COLUMNS
    return lines.select(key, F.expr(f"stack(1, {', '.join(others)}) AS ({', '.join(others)})"))


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """A catalog whose raw tables are the derived ones, each built when first used."""
    tune(spark)
    seen: dict[str, DataFrame] = {}
    return Catalog(spark, {n: (lambda n=n: derived(spark, sf_dir, n, seen)) for n in TABLES})


def map_text(column: str):
    """A map as 'k=v;k=v' in key order, values whole with six decimals."""
    def entry(e):
        v = e["value"]
        # Most entries are defaults, whose text is known without a decimal.
        text = F.when(v.isNull(), F.lit("=null")).when(v == 0, F.lit("=0.000000"))
        return F.concat(e["key"], text.otherwise(F.concat(F.lit("="), F.coalesce(v.cast("decimal(38,6)").cast("string"), F.lit("null")))))

    return F.array_join(F.transform(F.sort_array(F.map_entries(column)), entry), ";")


def comparable(df: DataFrame, rounded: dict[str, int] | None = None) -> DataFrame:
    """Times, dates and maps as text; named computed columns rounded."""
    rounded = rounded or {}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.MapType):
            c = map_text(f"`{f.name}`")
        elif f.name in rounded:
            c = F.round(c, rounded[f.name])
        out.append(c.alias(f.name))
    return df.select(*out)
