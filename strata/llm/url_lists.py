"""URL filters over dated lists: every capture against the entries active when it was fetched.

A list arrives as changes (list, kind, value, action, date). Changes of one
entry become validity intervals [add, next change). A capture is looked up by
its host, by every parent domain and by host plus first path segment; each
different (host, segment, date) is looked up once, so a host with a third of
all captures is a few hundred look-ups, and the answers go back to the captures
in a join that adaptive execution can split.

A host is what the authority names: user and password, port and final dots go,
an address in brackets stays, and a backslash counts as a slash.

Cases: a null or malformed url has no host and matches nothing; captures
without a date match nothing; repeated changes count once; of an add and a
removal on one day the removal wins; repeated captures each keep their row;
other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import common


# The authority's host: behind user and password, before the port, without final dots; brackets stay. A backslash ends it like a slash.
HOST = r"^[a-z][a-z0-9+.-]*:[/\\][/\\](?:[^/?#\\]*@)?(\[[^\]/?#]*\]|[^/?#:@\\]*?)\.*(?::[^/?#\\]*)?(?:[/?#\\]|$)"
SEGMENT = r"^[a-z][a-z0-9+.-]*:[/\\][/\\][^/?#\\]+[/\\]([^/?#\\]+)"


def host_of(url: str | Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(F.trim(url)), HOST, 1), F.lit(""))


def segment_of(url: str | Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(F.trim(url)), SEGMENT, 1), F.lit(""))


def intervals(changes: DataFrame) -> DataFrame:
    """Entries with the days they hold: ``from_day`` on, up to but not on ``to_day`` (null: still held)."""
    order = Window.partitionBy("list", "kind", "value").orderBy("day", "action")  # 'add' before 'remove'
    known = changes.select("list", "kind", "value", "action", "day").where(F.col("day").isNotNull()).distinct()
    dated = known.withColumn("to_day", F.lead("day").over(order))
    return dated.where("action = 'add' AND (to_day IS NULL OR to_day > day)").select("list", "kind", "value", F.col("day").alias("from_day"), "to_day")


def filter_urls(captures: DataFrame, changes: DataFrame, url: str = "url", day: str = "fetched_on") -> DataFrame:
    """Every capture with ``host``, ``n_active`` (entries that hold), ``lists`` (their lists) and ``blocked``."""
    name = {n: common.own_name(captures, n) for n in ("host", "segment", "n_active", "lists", "blocked", "h", "s", "d", "own")}
    named = captures.withColumns({name["host"]: host_of(url), name["segment"]: segment_of(url), name["own"]: F.monotonically_increasing_id()})
    asked = named.select(F.col(name["host"]).alias("h"), F.col(name["segment"]).alias("s"), F.col(day).alias("d")).where("h IS NOT NULL AND d IS NOT NULL").distinct()
    labels = F.split("h", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("value")))
    others = F.array(
        F.struct(F.lit("host").alias("kind"), F.col("h").alias("value")),
        F.struct(F.lit("path").alias("kind"), F.concat("h", F.lit("/"), "s").alias("value")))
    keys = asked.withColumn("key", F.explode(F.concat(others, suffixes))).select("h", "s", "d", "key.*")
    active = keys.join(intervals(changes), ["kind", "value"]).where("d >= from_day AND (to_day IS NULL OR d < to_day)")
    h, s, d = name["h"], name["s"], name["d"]
    verdict = active.groupBy(F.col("h").alias(h), F.col("s").alias(s), F.col("d").alias(d)).agg(
        F.count(F.lit(1)).alias(name["n_active"]), F.array_join(F.array_sort(F.collect_set("list")), ",").alias(name["lists"]))
    # Urls without a host spread over keys that no host has.
    own = F.coalesce(name["host"], F.concat(F.lit(" "), F.col(name["own"]).cast("string")))
    out = named.join(verdict, (own == F.col(h)) & (F.col(name["segment"]) == F.col(s)) & (F.col(day) == F.col(d)), "left").drop(h, s, d, name["segment"], name["own"])
    return out.withColumns({
        name["n_active"]: F.coalesce(name["n_active"], F.lit(0)), name["lists"]: F.coalesce(name["lists"], F.lit("")),
        name["blocked"]: F.coalesce(F.col(name["n_active"]) > 0, F.lit(False))})


def _number(column: Column, salt: str, most: int) -> Column:
    """A whole number below ``most`` that only depends on a text."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(salt), column)), 1, 7), 16, 10).cast("long"), F.lit(most))


def dated_changes(pages: DataFrame) -> DataFrame:
    """A change log over the hosts of a page table: the tables hold no dated
    list, so hosts, domains and sections are listed, lifted and listed again on
    days that follow from their names."""
    names = pages.select(host_of("url").alias("h"), segment_of("url").alias("s")).where("h IS NOT NULL").distinct()
    kinds = F.explode(F.array(
        F.struct(F.lit("host").alias("kind"), F.col("h").alias("value")),
        F.struct(F.lit("domain").alias("kind"), F.regexp_extract("h", r"([^.]+\.[^.]+)$", 1).alias("value")),
        F.struct(F.lit("path").alias("kind"), F.concat("h", F.lit("/"), "s").alias("value"))))
    values = names.select(kinds.alias("e")).select("e.*").where("value <> ''").distinct()
    key = F.concat("kind", F.lit(":"), "value")
    start = F.date_add(F.lit("2024-01-01").cast("date"), _number(key, "a", 700).cast("int"))
    lifted = F.date_add(start, (_number(key, "b", 200) + 1).cast("int"))
    again = F.date_add(lifted, (_number(key, "c", 200) + 1).cast("int"))
    steps = F.explode(F.array(
        F.struct(F.lit("add").alias("action"), start.alias("day"), F.lit(True).alias("on")),
        F.struct(F.lit("remove").alias("action"), lifted.alias("day"), (_number(key, "d", 4) > 0).alias("on")),
        F.struct(F.lit("add").alias("action"), again.alias("day"), (_number(key, "e", 2) > 0).alias("on"))))
    listed = values.where(_number(key, "f", 3) == 0)
    name = F.element_at(F.array(F.lit("spam"), F.lit("adult"), F.lit("phishing")), (_number(key, "g", 3) + 1).cast("int"))
    return listed.select(name.alias("list"), "kind", "value", steps.alias("c")).where("c.on").select("list", "kind", "value", "c.action", "c.day")


def op7_url_lists(spark, sf_dir: str) -> DataFrame:
    """Every page with its verdict on the day it was fetched (a day that follows from its id)."""
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(730)).cast("int"))
    return filter_urls(pages.withColumn("fetched_on", fetched), dated_changes(pages))


_N = "CAST(('0x' || substr(md5('{0}' || kind || ':' || value), 1, 7)) AS BIGINT) % {1}"
OP7_SQL = f"""
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 37) % 730 AS INTEGER) AS fetched_on,
    nullif(regexp_extract(lower(trim(url)), '{HOST}', 1), '') AS host,
    coalesce(regexp_extract(lower(trim(url)), '{SEGMENT}', 1), '') AS seg
  FROM pages
), v AS (
  SELECT 'host' AS kind, host AS value FROM p WHERE host IS NOT NULL
  UNION SELECT 'domain', regexp_extract(host, '([^.]+[.][^.]+)$', 1) FROM p WHERE host IS NOT NULL
  UNION SELECT 'path', host || '/' || seg FROM p WHERE host IS NOT NULL
), n AS (
  SELECT kind, value, DATE '2024-01-01' + CAST({_N.format('a', 700)} AS INTEGER) AS d1,
    {_N.format('b', 200)} + 1 AS b, {_N.format('c', 200)} + 1 AS c, {_N.format('d', 4)} AS d, {_N.format('e', 2)} AS e, {_N.format('g', 3)} AS g
  FROM v WHERE value <> '' AND {_N.format('f', 3)} = 0
), c AS (
  SELECT *, ['spam', 'adult', 'phishing'][g + 1] AS list, d1 + CAST(b AS INTEGER) AS d2, d1 + CAST(b + c AS INTEGER) AS d3 FROM n
), ch AS (
  SELECT list, kind, value, 'add' AS action, d1 AS day FROM c
  UNION SELECT list, kind, value, 'remove', d2 FROM c WHERE d > 0
  UNION SELECT list, kind, value, 'add', d3 FROM c WHERE e > 0
), i AS (
  SELECT *, lead(day) OVER (PARTITION BY list, kind, value ORDER BY day, action) AS to_day FROM ch
), m AS (
  SELECT a.host, a.seg, a.fetched_on, count(*) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists
  FROM (SELECT DISTINCT host, seg, fetched_on FROM p) a JOIN i
    ON action = 'add' AND fetched_on >= day AND (to_day IS NULL OR fetched_on < to_day)
    AND ((kind = 'host' AND host = value) OR (kind = 'path' AND host || '/' || seg = value)
      OR (kind = 'domain' AND (host = value OR ends_with(host, '.' || value))))
  GROUP BY ALL
)
SELECT page_id, url, p.fetched_on, p.host, coalesce(n, 0) AS n_active, coalesce(lists, '') AS lists, coalesce(n, 0) > 0 AS blocked
FROM p LEFT JOIN m ON p.host = m.host AND p.seg = m.seg AND p.fetched_on = m.fetched_on
"""
