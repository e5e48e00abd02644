"""Dated block lists joined to captures as of their fetch time (operator 10).

List entries are dated events: a key (a host, a parent domain, or a host with
its first path segment) is added to or removed from a category. Events become
validity intervals [valid_from, valid_to); every capture is held against the
entries of its keys that are active at its fetch time. Each capture has one
key per label of its host and one for its path, so the join is by equality of
keys and a range check, and a capture's verdict is gathered again by a
grouping. The intervals are written first: the planner then knows their size
(small ones are broadcast) and can split the captures of a hot host.

Defined results: events of one day apply adds before removes; adding an
active key again changes nothing; a null key, action or date is no event; a
null url or fetch time is not blocked; captures that agree in all of
(capture_id, url, fetched) are one; empty tables give empty results; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staffmart.llm.common import materialise

# The parts of a URL.
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
SEGMENT = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]+)"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def keys_of(url: Column) -> Column:
    """The host, its parent domains of two labels or more, and host plus first segment."""
    host = host_of(url)
    labels = F.split(host, r"\.", -1)
    domains = F.transform(
        F.filter(F.sequence(F.lit(1), F.size(labels)), lambda i: (i == 1) | (i < F.size(labels))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    segment = F.regexp_extract(F.coalesce(url, F.lit("")), SEGMENT, 1)
    paths = F.when(segment != "", F.array(F.concat(host, segment))).otherwise(F.array().cast("array<string>"))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(domains, paths)))


def validity(events: DataFrame) -> DataFrame:
    """(key, category, valid_from, valid_to) of events (key, category, action, at).

    One window per key and category, over the history of that entry alone;
    ``valid_to`` is null while the entry is active.
    """
    clean = (events.filter(F.col("key").isNotNull() & F.col("action").isin("add", "remove")
                           & F.col("at").isNotNull())
             .groupBy("key", "category", "at").agg(F.max("action").alias("action")))
    history = W.partitionBy("key", "category").orderBy("at")
    changes = clean.withColumn("before", F.lag("action").over(history)).filter(
        ~F.col("action").eqNullSafe(F.col("before")))
    spans = changes.withColumn("valid_to", F.lead("at").over(history))
    return spans.filter("action = 'add'").select("key", "category", F.col("at").alias("valid_from"), "valid_to")


def listed_captures(captures: DataFrame, events: DataFrame) -> DataFrame:
    """One row per capture (capture_id, url, fetched): blocked, categories, n_entries, since."""
    intervals = materialise(validity(events), "url-intervals")
    rows = captures.select("capture_id", "url", "fetched").distinct()
    asked = rows.withColumn("key", F.explode(keys_of(F.col("url"))))
    active = (F.col("fetched") >= F.col("valid_from")) & (
        F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    hits = asked.join(intervals, "key").filter(active).select(
        "capture_id", "url", "fetched", "category", "valid_from")
    hits = hits.unionByName(rows.select("*", F.lit(None).cast("string").alias("category"),
                                        F.lit(None).cast("date").alias("valid_from")))
    return hits.groupBy("capture_id", "url", "fetched").agg(
        F.count("valid_from").alias("n_entries"),
        F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"),
        F.min("valid_from").alias("since")).select(
            "capture_id", "url", "fetched", (F.col("n_entries") > 0).alias("blocked"), "categories",
            "n_entries", "since")


# --------------------------------------------------------------- the query
#
# The pages carry no fetch time and no list, so both are derived from them:
# a page is fetched on a day given by its id, and a quarter of all keys has a
# history that follows from the key's md5.

CATEGORIES = ["adult", "gambling", "phishing"]
DAYS = 366


def _digit(digest: Column, i: int) -> Column:
    return F.ascii(F.substring(digest, i, 1))


def derived_events(pages: DataFrame) -> DataFrame:
    keys = (pages.select(F.explode(keys_of(F.col("url"))).alias("key")).distinct()
            .filter(F.col("key").contains("."))
            .withColumn("d", F.md5("key")).filter(_digit(F.col("d"), 1) % 4 == 0))
    d = F.col("d")
    start = (_digit(d, 2) * 131 + _digit(d, 3) * 17 + _digit(d, 4)) % 300
    length = 20 + (_digit(d, 5) * 7 + _digit(d, 6)) % 90
    again = start + length + 10 + (_digit(d, 7) % 30)

    def event(action: str, day: Column, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(action).alias("action"),
                                     F.date_add(F.lit("2024-01-01").cast("date"), day).alias("at")))

    every = F.lit(True)
    events = F.array(event("add", start, every), event("remove", start + length, _digit(d, 8) % 3 != 0),
                     event("add", again, _digit(d, 9) % 2 == 0))
    category = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), _digit(d, 10) % 3 + 1)
    return (keys.select("key", category.alias("category"), F.explode(events).alias("e"))
            .filter(F.col("e").isNotNull()).select("key", "category", "e.action", "e.at"))


def op10_url_lists(pages: DataFrame) -> DataFrame:
    captures = pages.select(
        F.col("page_id").alias("capture_id"), "url",
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(DAYS)).cast("int")).alias("fetched"))
    return listed_captures(captures, derived_events(pages)).withColumnRenamed("capture_id", "page_id")


_D = "ascii(substr(d, {}, 1))"
OP10_SQL = f"""
WITH parts AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % {DAYS} AS INT) AS fetched,
         lower(regexp_extract(coalesce(url, ''), '{HOST}', 1)) AS host,
         regexp_extract(coalesce(url, ''), '{SEGMENT}', 1) AS segment
  FROM (SELECT DISTINCT page_id, url FROM pages)),
labels AS (SELECT *, string_split(host, '.') AS ls FROM parts),
asked AS (
  SELECT page_id, url, fetched, unnest(list_distinct(list_concat(
           list_transform(list_filter(range(1, len(ls) + 1), lambda i: i = 1 OR i < len(ls)),
                          lambda i: array_to_string(ls[i:], '.')),
           CASE WHEN segment <> '' THEN [host || segment] ELSE [] END))) AS key
  FROM labels WHERE host <> ''),
keys AS (
  SELECT key, md5(key) AS d FROM (SELECT DISTINCT key FROM asked)
  WHERE contains(key, '.') AND ascii(substr(md5(key), 1, 1)) % 4 = 0),
days AS (
  SELECT key, d, ({_D.format(2)} * 131 + {_D.format(3)} * 17 + {_D.format(4)}) % 300 AS s,
         20 + ({_D.format(5)} * 7 + {_D.format(6)}) % 90 AS n,
         ['adult', 'gambling', 'phishing'][{_D.format(10)} % 3 + 1] AS category
  FROM keys),
events AS (
  SELECT key, category, 'add' AS action, DATE '2024-01-01' + CAST(s AS INT) AS "day" FROM days
  UNION ALL
  SELECT key, category, 'remove', DATE '2024-01-01' + CAST(s + n AS INT) FROM days WHERE {_D.format(8)} % 3 <> 0
  UNION ALL
  SELECT key, category, 'add', DATE '2024-01-01' + CAST(s + n + 10 + {_D.format(7)} % 30 AS INT)
  FROM days WHERE {_D.format(9)} % 2 = 0),
state AS (
  SELECT *, lag(action) OVER (PARTITION BY key, category ORDER BY "day") AS earlier FROM events),
spans AS (
  SELECT key, category, action, "day", lead("day") OVER (PARTITION BY key, category ORDER BY "day") AS ended
  FROM state WHERE earlier IS DISTINCT FROM action),
hits AS (
  SELECT a.page_id, a.url, a.fetched, s.category, s."day"
  FROM asked a JOIN spans s ON a.key = s.key AND s.action = 'add' AND a.fetched >= s."day"
       AND (s.ended IS NULL OR a.fetched < s.ended))
SELECT p.page_id, p.url, p.fetched, count(h."day") > 0 AS blocked,
       coalesce(string_agg(DISTINCT h.category, ',' ORDER BY h.category), '') AS categories,
       count(h."day") AS n_entries, min(h."day") AS since
FROM parts p LEFT JOIN hits h ON p.page_id = h.page_id AND p.url = h.url
GROUP BY p.page_id, p.url, p.fetched
"""
