"""URL filters: dated list entries as validity intervals, and an as-of join of captures against them.

An entry names a domain (which covers its subdomains) or a host with a path prefix, a category, a date, and whether it
is added or dropped.  Entries of a pattern and category, in order of their dates, become intervals: each ``add`` holds
from its date until the next entry's date; the latest entry on or before the day of the fetch thus decides, as in an
as-of join.  A capture is looked up under every suffix of its host and every path prefix of its full host, which is an
equi-join with a condition on the date; at most one interval of a pattern and category can hold it.

Scale: captures of the same host and path on the same day are looked up once, so that a hot host shrinks before the
join.  Intervals and verdicts are written before they are joined: up to ``SMALL`` rows of them are broadcast; beyond that
both sides of the join are plain shuffles, so that Spark may split the captures of a hot host or path.
No page text is read.  A pattern's history has a row a day at most before it is sorted.

Edge cases: a capture without a URL, host or date matches nothing and isn't blocked; entries without a pattern or
date are left out; of several entries of one pattern, category and day, a drop wins; patterns are compared in lower
case, without a scheme, a leading dot or a trailing slash; repeated captures each get their verdict; other columns of
captures stay, those with names of the result's as ``capture_`` and that name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, shielded, sized

SMALL = 10_000
VERDICT = ["host", "n_entries", "categories", "pattern", "blocked"]


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, category, valid_from, valid_to) of entries (pattern, category, action, dated)."""
    pattern = F.regexp_replace(F.regexp_replace(F.lower("pattern"), r"^[a-z][a-z0-9+.-]*://|^\.+", ""), "/+$", "")
    days = entries.select(pattern.alias("pattern"), F.coalesce("category", F.lit("")).alias("category"), F.col("dated").cast("date").alias("valid_from"), (F.lower("action") == "add").alias("listed"))
    days = days.where("pattern <> '' and valid_from is not null").groupBy("pattern", "category", "valid_from").agg(F.min(F.coalesce("listed", F.lit(False))).alias("listed"))
    after = F.lead("valid_from").over(Window.partitionBy("pattern", "category").orderBy("valid_from"))
    return days.withColumn("valid_to", F.coalesce(after, F.lit("9999-12-31").cast("date"))).where("listed").drop("listed")


def parsed(captures: DataFrame, url: str, fetched: str) -> DataFrame:
    """Adds host, _path and _day."""
    host = F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)?", 1)
    segments = F.filter(F.split(F.lower(path), "/"), lambda s: s != "")
    return captures.withColumn("host", F.coalesce(F.regexp_replace(host, r"\.+$", ""), F.lit(""))).withColumn("_path", F.coalesce(F.array_join(segments, "/"), F.lit(""))).withColumn("_day", F.col(fetched).cast("date"))


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """All rows of ``captures`` with host, n_entries, categories (sorted, comma-joined), pattern (the longest) and blocked."""
    scratch = Scratch(captures.sparkSession)
    captures = captures.withColumnsRenamed({c: f"capture_{c}" for c in VERDICT if c in captures.columns and c not in (url, fetched)})
    own, restore = shielded(captures, url, fetched)
    columns = own.columns
    rows = parsed(own, url, fetched)
    places = rows.where("host <> '' and _day is not null").select("host", "_path", "_day").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    parts = F.split("_path", "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.concat("host", F.lit("/"), F.array_join(F.slice(parts, F.lit(1), k), "/")))
    keys = places.withColumn("key", F.explode(F.array_distinct(F.when(F.col("_path") == "", suffixes).otherwise(F.concat(suffixes, prefixes)))))
    known = sized(scratch.write(intervals(entries)), SMALL)
    hits = keys.join(known, (keys.key == known.pattern) & (keys._day >= known.valid_from) & (keys._day < known.valid_to))
    verdicts = scratch.write(hits.groupBy(F.col("host").alias("_host"), F.col("_path").alias("_p"), F.col("_day").alias("_d")).agg(
        F.count("*").alias("n_entries"),
        F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"),
        F.max(F.struct(F.length("pattern").alias("n"), F.col("pattern"))).alias("best"),
    ))
    out = rows.join(sized(verdicts, SMALL), (rows.host == verdicts._host) & (rows._path == verdicts._p) & (rows._day == verdicts._d), "left")
    out = out.select(
        *columns, "host", F.coalesce("n_entries", F.lit(0)).alias("n_entries"), F.coalesce("categories", F.lit("")).alias("categories"),
        F.col("best.pattern").alias("pattern"), F.col("n_entries").isNotNull().alias("blocked"),
    )
    return restore(out, *VERDICT)


# The tables have neither fetch dates nor lists.  The query takes a day of 2024 from page_id, and a list that grows
# with the pages: some of their hosts and host sections, picked by digest, and these domains.
DOMAINS = [
    ("casino-win.example.com", "gambling", "add", "2024-01-10"), ("casino-win.example.com", "gambling", "drop", "2024-06-01"), ("casino-win.example.com", "gambling", "add", "2024-09-15"),
    ("free-bets.example.com", "gambling", "add", "2024-03-01"), ("cheap-pills.example.com", "pharma", "add", "2024-02-01"), ("cheap-pills.example.com", "pharma", "drop", "2024-11-01"),
    ("cheap-pills.example.com", "spam", "add", "2024-05-05"),
]
PICKED = [
    ("0", "", "spam", "add", "2024-01-15"), ("0", "", "spam", "drop", "2024-05-01"), ("0", "", "spam", "add", "2024-10-01"), ("1", "", "adult", "add", "2024-03-01"),
    ("2", "/en", "section", "add", "2024-06-01"), ("2", "/en", "section", "drop", "2024-08-01"),
]


def page_captures(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.expr("date_add(date'2024-01-01', cast(page_id % 366 as int))").alias("fetched"))


def page_list(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    hosts = parsed(page_captures(pages), "url", "fetched").where("host <> ''").select("host").distinct()
    picked = spark.createDataFrame(PICKED, "digit string, section string, category string, action string, dated string")
    picked = hosts.join(F.broadcast(picked), F.substring(F.md5(F.col("host").cast("binary")), 1, 1) == F.col("digit"))
    fixed = spark.createDataFrame(DOMAINS, "pattern string, category string, action string, dated string")
    return fixed.unionByName(picked.select(F.concat("host", "section").alias("pattern"), "category", "action", "dated"))


def oracle() -> str:
    values = lambda rows: ", ".join(str(tuple(r)) for r in rows)
    return rf"""
WITH c AS (SELECT page_id, url, (DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER))::DATE AS fetched,
  rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.') AS host,
  list_filter(string_split(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)?', 1)), '/'), lambda x: x <> '') AS segs FROM pages),
p(digit, section, category, action, dated) AS (VALUES {values(PICKED)}),
f(pattern, category, action, dated) AS (VALUES {values(DOMAINS)}),
e AS (SELECT pattern, category, action, dated::DATE AS dated FROM f UNION ALL
  SELECT host || section, category, action, dated::DATE FROM (SELECT DISTINCT host FROM c WHERE host <> '') h JOIN p ON substr(md5(h.host), 1, 1) = p.digit),
k AS (SELECT DISTINCT page_id, fetched, unnest(list_concat(
  list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
  list_transform(range(1, len(segs) + 1), lambda i: host || '/' || array_to_string(segs[1:i], '/')))) AS key FROM c),
latest AS (SELECT k.page_id, e.pattern, e.category, max_by(e.action, e.dated) AS action FROM k JOIN e ON e.pattern = k.key AND e.dated <= k.fetched GROUP BY ALL),
hit AS (SELECT page_id, count(*) AS n, string_agg(DISTINCT category, ',' ORDER BY category) AS cats, max_by(pattern, (length(pattern), pattern)) AS best FROM latest WHERE action = 'add' GROUP BY page_id)
SELECT c.page_id, c.url, CAST(c.fetched AS VARCHAR) AS fetched, c.host, coalesce(n, 0)::BIGINT AS n_entries, coalesce(cats, '') AS categories, best AS pattern, n IS NOT NULL AS blocked FROM c LEFT JOIN hit USING (page_id)"""
