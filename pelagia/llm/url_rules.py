"""URL rules by a sort-merge range join.

The labels of a host are reversed and each is closed by a dot (``www.example.net`` becomes
``net.example.www.``), and the path follows after a slash. A rule for a host and its subdomains
is then the interval of keys that start with its own reversed host. Pages and rules are dealt
out by ranges of keys, sorted, and swept once: rules open and close in nested order on a stack,
and a page sees exactly the rules open at its key.

Ranges are cut at quantiles of a bounded sample of (key, hash of the id), so a host, or a single
URL, that owns a third of all pages is spread over many ranges. A rule goes to every range its
interval touches; as open intervals nest, a range gets its own rules and one per label level.

Cases. A NULL url, or one without ``://``, has an empty host and path. A rule fits if the host is
its host or a subdomain and the path starts with its path; of several the longest text wins, then
the longest host, then the smallest text. A rule with an empty host fits every host. NULL parts of
a rule count as empty. Repeated pages and rules give repeated and unchanged results. No rule:
``rule`` is NULL and the verdict is ``default``.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Sampled keys for each range; the sample is this times the number of ranges.
SAMPLE_PER_RANGE = 30
# The rules of the registered query.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    start = F.instr(url, "://")
    rest = F.when(start > 0, url.substr(start + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def reversed_host(host: Column) -> Column:
    """Labels from the last to the first, a dot after each; the empty host has the empty key."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order (range, key, rules first): open rules, close them, answer pages."""
    at, stack = None, []
    for batch in batches:
        rows, found, verdicts = [], [], []
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for i, (part, key, is_page, end, host, path, verdict) in enumerate(zip(*columns[:7])):
            if part != at:
                at, stack = part, []
            while stack and stack[-1][0] is not None and key >= stack[-1][0]:
                stack.pop()
            if not is_page:
                stack.append((end, (-len(host) - len(path), -len(host), host + path, verdict), path))
                continue
            fits = [rank for _, rank, start in stack if path.startswith(start)]
            best = min(fits) if fits else None
            rows.append(i)
            found.append(best and best[2])
            verdicts.append(best and best[3])
        page = batch.take(pa.array(rows, pa.int64())) if rows else batch.slice(0, 0)
        yield pa.RecordBatch.from_arrays(
            [page.column("page_id"), page.column("host"), page.column("path"), pa.array(found, pa.string()), pa.array(verdicts, pa.string())],
            ["page_id", "host", "path", "rule", "verdict"],
        )


def judge(pages: DataFrame, rules: DataFrame, id: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict. ``rules``: host, path, verdict."""
    spark = pages.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = host_and_path(F.col(url))
    p = pages.select(F.col(id).alias("page_id"), host.alias("host"), path.alias("path"))
    p = p.withColumns({"key": F.concat(reversed_host(F.col("host")), F.lit("/"), F.col("path")), "tie": F.xxhash64("page_id")})
    share = min(1.0, SAMPLE_PER_RANGE * ranges / max(1, pages.count()))
    sample = sorted((r.key, r.tie) for r in p.select("key", "tie").sample(share, seed=7).collect())
    cuts = [sample[len(sample) * i // ranges] for i in range(1, ranges)] if sample else []
    low = -(2**63)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [bisect_right(cuts, kt) for kt in zip(b["key"].to_pylist(), b["tie"].to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *b.columns], ["part", *b.schema.names])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, parts = [], []
            for i, (key, end) in enumerate(zip(b["key"].to_pylist(), b["end"].to_pylist())):
                last = len(cuts) if end is None else bisect_left(cuts, (end, low))
                touched = range(bisect_left(cuts, (key, low)), last + 1)
                rows += [i] * len(touched)
                parts += touched
            b = b.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *b.columns], ["part", *b.schema.names])

    r = rules.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("host", "path")), "verdict").distinct()
    own = reversed_host(F.col("host"))
    # The interval of keys that start with "net.example." ends before "net.example/", the next string.
    end = F.when(own != "", F.concat(own.substr(F.lit(1), F.length(own) - 1), F.lit("/")))
    r = r.select(own.alias("key"), end.alias("end"), "host", "path", "verdict").mapInArrow(
        spread, "part int, key string, end string, host string, path string, verdict string"
    )
    p = p.mapInArrow(place, f"part int, page_id {pages.schema[id].dataType.simpleString()}, host string, path string, key string, tie long")
    null = F.lit(None)
    mixed = p.select("part", "key", F.lit(True).alias("is_page"), null.cast("string").alias("end"), "host", "path", null.cast("string").alias("verdict"), "page_id").unionByName(
        r.select("part", "key", F.lit(False).alias("is_page"), "end", "host", "path", "verdict", null.cast(pages.schema[id].dataType).alias("page_id"))
    )
    # Rules open at a key come before pages; of two at one key the wider one (its host is equal) is as good first as last.
    swept = mixed.repartitionById(ranges, "part").sortWithinPartitions("part", "key", "is_page").mapInArrow(
        _sweep, f"page_id {pages.schema[id].dataType.simpleString()}, host string, path string, rule string, verdict string"
    )
    return swept.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)


OP8_SQL = r"""
WITH r AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM r),
rules(rhost, rpath, rverdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (
  SELECT p.*, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST, length(rhost) DESC, rhost) AS n
  FROM p LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM m WHERE n = 1
"""
