"""Taxon maps: pivot observed values and fill the gaps a name changelog explains.

A product row holds one map from taxon to value. A taxon that came into use on a known
date is present in every map of its programme: NULL if the sample is older ("not looked
for"), 0 if it is not ("not found"), unless a value was observed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import first_word


def typed_entries(entries: Column) -> Column:
    """Map from an array of (taxon, value) structs, taxa in text order."""
    return F.map_from_entries(F.array_sort(entries))


def to_maps(observed: DataFrame, keys: list[str], taxon: str, value: str, out: str) -> DataFrame:
    """One row per key with a taxon -> value map.

    Rows are reduced to one per (key, taxon) before they are shuffled, and again after it, so a
    key with very many rows is never in one task before it is one row per taxon. A NULL taxon
    cannot name an entry and raises, as does the map constructor itself.
    """
    single = observed.groupBy(*keys, taxon).agg(F.max(value).alias(value))
    return single.groupBy(*keys).agg(
        typed_entries(F.collect_list(F.struct(F.col(taxon), F.col(value)))).alias(out)
    )


@dataclass(frozen=True)
class Sightings:
    """Raw rows reduced to what gap filling needs.

    ``rows``: key columns, ``taxon``, ``value`` - one row per changelog part of a taxon.
    ``affected``: ``taxon`` (and ``method``), ``start`` - earliest start of each taxon
    touched by a change; ``start`` NULL means the default is always 0.
    ``marked``: rows are one per key and taxon, and the one of the NULL taxon says that the key has
    rows that do not count. Metadata whose key has no row at all is then dropped.
    """

    rows: DataFrame
    affected: DataFrame
    marked: bool = False


def _earliest(rows: DataFrame, by: list[str]) -> DataFrame:
    """Earliest start date per affected taxon; an unknown date means 'always in use'."""
    start = F.when(F.max(F.col("start").isNull().cast("int")) == 0, F.min("start"))
    return rows.groupBy(*by).agg(start.alias("start"))


def sightings_with_changelog(
    raw: DataFrame,
    changelog: DataFrame,
    keys: list[str],
    taxon: Column,
    value: str,
    changed: str,
    combine: str = "max",
) -> Sightings:
    """Sum values per key and taxon, and list the taxa a changelog affects.

    ``changed`` is ``'genus'`` (the first words of the old and new name differ) or
    ``'name'`` (the names differ). The changelog is matched on ``raw.taxon_name``.

    A taxon built from several raw names has one part per changelog entry. The published
    rule keeps the *largest* part rather than their total (``combine='max'``); pass
    ``'sum'`` for the total.
    """
    word = first_word if changed == "genus" else F.col
    # Whether a name changed depends on its changelog row alone, so it is settled there and
    # not once per raw row. Names without an entry get NULL from the left join.
    names = changelog.select(
        "taxon_name",
        F.col("startdate").alias("start"),
        (word("taxon_name") != word("parent_name")).alias("changed"),
    )
    methods = keys[1:]
    tagged = raw.select(
        *[F.col(k) for k in keys], F.col("taxon_name"), taxon.alias("taxon"), F.col(value).alias("value")
    )

    if combine == "sum":
        rows = tagged.groupBy(*keys, "taxon").agg(F.sum("value").alias("value"))
    else:
        # The changelog has one row per name and comes from storage, so Spark broadcasts it while it
        # is small, and splits the rows of a hot name when it is not.
        parts = tagged.join(names, "taxon_name", "left")
        rows = (
            parts.groupBy(*keys, "taxon", "start", "changed")
            .agg(F.sum("value").alias("value"))
            .select(*keys, "taxon", "value")
        )

    # Names are reduced to their distinct set before the changelog is looked up again.
    seen = tagged.select("taxon_name", "taxon", *methods).distinct()
    touched = seen.join(names.filter("changed"), "taxon_name")
    return Sightings(rows, _earliest(touched, ["taxon", *methods]))


@dataclass(frozen=True)
class Level:
    """One way to name taxa: what a row is called, whether it counts, and its changelog name.

    ``changed`` says which words of a name a changelog entry must have changed; see
    :func:`sightings_with_changelog`. Without ``lookup`` the changelog is not asked.
    """

    taxon: Column
    counted: Column | None = None
    lookup: Column | None = None
    changed: str = "name"


def _lookup(level: Level) -> Column:
    return (F.lit(None) if level.lookup is None else level.lookup).cast("string").alias("lookup")


def level_cells(raw: DataFrame, changelog: DataFrame | None, keys: list[str], levels: dict[str, Level], values: list[str]) -> DataFrame:
    """Raw rows under several levels of naming and several measures, in one read and one shuffle.

    keys, ``level``, ``taxon``, ``start`` and ``changed`` of the changelog entry, and per measure its
    ``sum_<v>`` and ``max_<v>``. A row counts under each level that it belongs to, as with grouping
    sets, and partial sums are made before the shuffle.
    """

    def named(name: str, level: Level) -> list[Column]:
        return [F.lit(name).alias("level"), level.taxon.alias("taxon"), _lookup(level)]

    if len(levels) == 1:  # the condition can reach the scan
        ((name, level),) = levels.items()
        rows = (raw if level.counted is None else raw.filter(level.counted)).select(*keys, *values, *named(name, level))
    else:
        entries = [F.when(F.lit(True) if v.counted is None else v.counted, F.struct(*named(n, v))) for n, v in levels.items()]
        rows = raw.select(*keys, *values, F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"))
        rows = rows.select(*keys, *values, "e.level", "e.taxon", "e.lookup")
    if any(v.lookup is not None for v in levels.values()):
        by = {kind: word("taxon_name") != word("parent_name") for kind, word in (("genus", first_word), ("name", F.col))}
        log = changelog.select(F.col("taxon_name").alias("lookup"), F.col("startdate").alias("start"), by["genus"].alias("__genus"), by["name"].alias("__name"))
        genus = [n for n, v in levels.items() if v.changed == "genus"]
        changed = F.when(F.col("level").isin(*genus), F.col("__genus")).otherwise(F.col("__name")) if genus else F.col("__name")
        rows = rows.join(log, "lookup", "left").withColumn("changed", changed)
    else:
        rows = rows.withColumns({"start": F.lit(None).cast("date"), "changed": F.lit(None).cast("boolean")})
    sums = [g(v).alias(f"{n}_{v}") for v in values for n, g in (("sum", F.sum), ("max", F.max))]
    return rows.groupBy(*keys, "level", "taxon", "start", "changed").agg(*sums)


def sightings_of(cells: DataFrame, keys: list[str], value: str) -> Sightings:
    """What gap filling needs, from the cells of one level; the affected taxa are read off them."""
    rows = cells.select(*keys, "taxon", F.col(f"sum_{value}").alias("value"))
    return Sightings(rows, _earliest(cells.filter("changed"), ["taxon", *keys[1:]]))


def marked_rows(raw: DataFrame, keys: list[str], level: Level, value: str) -> DataFrame:
    """Sums per key and taxon; what does not count under ``level`` leaves a row with a NULL taxon and value."""
    counted = F.lit(True) if level.counted is None else level.counted
    return raw.groupBy(*keys, F.when(counted, level.taxon).alias("taxon")).agg(F.sum(F.when(counted, F.col(value))).alias("value"))


def sightings_of_level(raw: DataFrame, changelog: DataFrame, keys: list[str], level: Level, value: str) -> Sightings:
    """:func:`sightings_of` for one level that is read off the raw rows.

    The affected taxa depend on the names alone, so these are reduced to their distinct set where the
    rows are, and only they are looked up: no row is placed by its key a second time.
    """
    cells = level_cells(raw, changelog, keys, {level.changed: level}, [value])
    word = first_word if level.changed == "genus" else F.col
    log = changelog.filter(word("taxon_name") != word("parent_name")).select(F.col("taxon_name").alias("lookup"), F.col("startdate").alias("start"))
    counted = raw if level.counted is None else raw.filter(level.counted)
    names = counted.select(level.taxon.alias("taxon"), _lookup(level), *keys[1:]).distinct()
    rows = cells.select(*keys, "taxon", F.col(f"sum_{value}").alias("value"))
    return Sightings(rows, _earliest(names.join(log, "lookup"), ["taxon", *keys[1:]]))


def sightings_with_list(
    raw: DataFrame, keys: list[str], taxon: str, value: str, affected: DataFrame
) -> Sightings:
    """Sum values per key and taxon; the affected taxa come as a ready list."""
    rows = raw.groupBy(*keys, F.col(taxon).alias("taxon")).agg(F.sum(value).alias("value"))
    return Sightings(rows, affected)


def _default(time: Column, start: Column) -> Column:
    """NULL before the start, 0 from then on."""
    return F.when(time < start, F.lit(None).cast("double")).otherwise(F.lit(0.0))


def _seen(found: Sightings, key: str, methods: list[str]) -> DataFrame:
    """``__key``[, method], ``__seen``: the observed (taxon, value) entries of each key, in text order.

    Raw rows are summed by now, so a key has a row per taxon and changelog part: they are placed by
    key once, for the merge of each taxon, the entries, and the join to the metadata.
    """
    rows = found.rows.select(F.col(key).alias("__key"), *methods, "taxon", F.col("value").cast("double").alias("value")).repartition("__key")
    if found.marked:
        entries = F.sort_array(F.collect_list(F.when(F.col("taxon").isNotNull(), F.struct("taxon", "value"))))
        seen = rows.groupBy("__key", *methods).agg(entries.alias("__seen"))
        return seen.withColumn("__seen", F.when(F.size("__seen") > 0, F.col("__seen")))
    largest = rows.groupBy("__key", *methods, "taxon").agg(F.max("value").alias("value"))
    return largest.groupBy("__key", *methods).agg(F.sort_array(F.collect_list(F.struct("taxon", "value"))).alias("__seen"))


def _starts(affected: DataFrame, by: list[str], time_type: T.DataType) -> DataFrame:
    """``by``, ``__starts``: the affected taxa as one map taxon -> (start), in text order."""
    entry = F.struct("taxon", F.struct(F.col("start").cast(time_type).alias("start")).alias("at"))
    return affected.groupBy(*by).agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("__starts"))


def _filled_map(seen: Column, starts: Column, time: Column) -> Column:
    """Observed entries over the defaults of the affected taxa, taxa in text order.

    Equal to the larger of an observed value and the default where a taxon has both.
    """

    def value(_taxon: Column, at: Column, v: Column) -> Column:
        return F.when(at.isNull(), v).otherwise(F.greatest(v, _default(time, at["start"])))

    both = F.map_from_entries(F.sort_array(F.map_entries(F.map_zip_with(starts, F.map_from_entries(seen), value))))
    only = F.map_from_entries(F.sort_array(F.map_entries(F.transform_values(starts, lambda _t, at: _default(time, at["start"])))))
    return F.when(starts.isNull(), F.map_from_entries(seen)).when(seen.isNull(), only).otherwise(both)


def _with_lists(rows: DataFrame, key: str, lists: DataFrame, copies: int) -> DataFrame:
    """Each row with the one row of ``lists`` of its salt.

    A list travels whole, as it does in every published map, so no default is a row of its own and
    none is shuffled. It is copied per salt: where it is too large to be broadcast, rows meet it in
    as many join keys.
    """
    return rows.withColumn("__salt", F.pmod(F.hash(key), F.lit(copies))).join(lists, "__salt", "left").drop("__salt")


def _copied(affected: DataFrame, copies: int) -> DataFrame:
    return affected.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def _attached(meta: DataFrame, key: str, facts: DataFrame, how: str = "left") -> DataFrame:
    return meta.join(facts, meta[key] == facts["__key"], how).drop("__key")


def fill_gaps(meta: DataFrame, key: str, time: str, found: Sightings, out: str, slices: int = 8, salts: int = 8) -> DataFrame:
    """Attach the gap-filled map of each metadata row as column ``out``.

    Only observed values are shuffled. The map of a row, which holds every affected taxon by
    definition, is made where the row already is. The list has slices x salts copies.
    """
    lists = _starts(_copied(found.affected, slices * salts), ["__salt"], meta.schema[time].dataType)
    attached = _attached(meta, key, _seen(found, key, []), "inner" if found.marked else "left")
    rows = _with_lists(attached, key, lists, slices * salts)
    filled = _filled_map(F.col("__seen"), F.col("__starts"), F.col(time))
    return rows.select(*[f"`{c}`" for c in meta.columns], filled.alias(out))


def fill_gaps_by_method(
    meta: DataFrame,
    key: str,
    method: str,
    time: str,
    found: Sightings,
    out: str,
    observed_only: bool = False,
    slices: int = 8,
    salts: int = 8,
) -> DataFrame:
    """Like :func:`fill_gaps` with one row per counting method, in a column ``Method``.

    A row appears for every method observed or affected; ``observed_only`` keeps just the
    observed, non-NULL methods of the key. Keys with neither keep one row without a map.
    """
    columns, time_type = [f"`{c}`" for c in meta.columns], meta.schema[time].dataType
    seen = _seen(found, key, [method]).withColumnRenamed(method, "__method")
    affected = found.affected.withColumnRenamed(method, "__method")
    if observed_only:
        # Each observed (key, method) meets the list of its method: what is made is what is kept.
        kept = seen.filter(F.col("__method").isNotNull()).join(_starts(affected, ["__method"], time_type), "__method", "left")
        rows = _attached(meta, key, kept)
        return rows.select(*columns, F.col("__method").alias("Method"), _filled_map(F.col("__seen"), F.col("__starts"), F.col(time)).alias(out))
    by_key = seen.groupBy("__key").agg(F.collect_list(F.struct("__method", "__seen")).alias("__by"))
    of_method = _starts(_copied(affected, slices * salts), ["__salt", "__method"], time_type)
    lists = of_method.groupBy("__salt").agg(F.collect_list(F.struct("__method", "__starts")).alias("__lists"))
    rows = _with_lists(_attached(meta, key, by_key), key, lists, slices * salts)
    each = F.array_distinct(F.concat(*[F.coalesce(F.col(c)["__method"], F.array().cast(T.ArrayType(affected.schema["__method"].dataType))) for c in ("__by", "__lists")]))
    rows = rows.withColumn("__method", F.explode_outer(each))

    def of(column: str, field: str) -> Column:
        return F.get(F.filter(column, lambda x: x["__method"].eqNullSafe(F.col("__method"))), F.lit(0))[field]

    # Looked up once, as columns of their own, before the map reads them several times.
    rows = rows.withColumns({"__seen": of("__by", "__seen"), "__starts": of("__lists", "__starts")})
    return rows.select(*columns, F.col("__method").alias("Method"), _filled_map(F.col("__seen"), F.col("__starts"), F.col(time)).alias(out))


def filled_rows(
    meta: DataFrame, key: str, time: str, found: Sightings, slices: int = 16, salts: int = 16
) -> DataFrame:
    """The gap-filled values of :func:`fill_gaps` as rows (key, taxon, value)."""
    visits = meta.select(key, time).distinct()
    rows = fill_gaps(visits, key, time, found, "__map", slices, salts).select(key, F.explode("__map").alias("taxon", "value"))
    return rows.groupBy(key, "taxon").agg(F.max("value").alias("value"))
