"""URL filter lists that change over time, joined as of the time of each capture.

Entries are dated: a list adds or removes a domain (it and all below it), a host (just it) or a
URL (without scheme, query, fragment and closing slash); a domain may be one label (``xyz``).  Hosts in
keys count in lower case and without a closing dot, as in captures.  The dated entries of a key become
validity intervals, and every capture is evaluated against the intervals that hold on its day.

Nothing but DataFrame functions is used.  What captures ask is first reduced to distinct keys and
days, so that a host, or a domain above very many hosts, has a row for each day at most.  The as-of
join puts those days and the begins of the key's intervals into one order for each list, and takes
the last begin before each day; what it makes follows the days asked, however long an interval is
open or however far off a day lies.  Captures are then joined to the verdicts of their (host, day)
and (URL, day).

On one day a list's removal of a key wins over its addition.  Entries without list, scope, key,
day or a known action are ignored, as are repeats.  Captures without URL or day, or with a URL
without host, match nothing; repeated captures are each evaluated.  No entries: nothing matches; no
captures: no rows.  Columns of the captures other than those named are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and closing dot, an address in brackets whole; null if
    there is none."""
    host = F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("."))
    return F.when(host != "", host)


def page_of(url: Column) -> Column:
    """Host and path, without a closing slash; null without host."""
    return F.concat(host_of(url), F.rtrim(F.regexp_extract(url, PATH, 1), F.lit("/")))


def domains_of(host: Column, least: int = 1) -> Column:
    """The host and the domains above it, down to ``least`` labels (an address in brackets is one)."""
    parts = F.when(host.startswith("["), F.array(host)).otherwise(F.split(host, r"\."))
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - (least - 1), F.lit(1))), lambda i: F.array_join(
        F.slice(parts, i, F.size(parts)), "."))


def key_of(scope: Column, key: Column) -> Column:
    """An entry's key as captures are: lower-case host without closing dot, no closing slash."""
    host = F.rtrim(F.lower(F.regexp_extract(key, r"^[^/]*", 0)), F.lit("."))
    return F.when(scope == "url", F.concat(host, F.rtrim(F.regexp_extract(key, r"^[^/]*(.*)", 1), F.lit("/")))).otherwise(host)


def day_number(day: Column) -> Column:
    """Days since 1970-01-01."""
    return F.unix_date(day.cast("date"))


def intervals(entries: DataFrame) -> DataFrame:
    """``list, scope, key, begin, end``: days from ``begin`` on and before ``end`` (null: for good)."""
    clean = entries.filter(F.col("list").isNotNull() & F.col("scope").isin("domain", "host", "url")
                           & F.col("key").isNotNull() & F.col("day").isNotNull()
                           & F.col("action").isin("add", "remove"))
    clean = clean.withColumn("key", key_of(F.col("scope"), F.col("key"))).filter("key <> ''")
    # one row per key and day, so a key's history has a row per day at most
    days = clean.groupBy("list", "scope", "key", day_number(F.col("day")).alias("begin")).agg(
        F.max("action").alias("action"))
    history = Window.partitionBy("list", "scope", "key").orderBy("begin")
    changes = (days.withColumn("was", F.lag("action").over(history))
               .filter(~F.col("action").eqNullSafe(F.col("was"))))
    return (changes.withColumn("end", F.lead("begin").over(history))
            .filter(F.col("action") == "add").select("list", "scope", "key", "begin", "end"))


def as_of(asked: DataFrame, valid: DataFrame) -> DataFrame:
    """``scope, key, day, list, begin``: the intervals that hold on the ``asked(scope, key, day)`` days,
    which are distinct."""
    listed = valid.select("scope", "key", "list").distinct()
    none = F.lit(None).cast("int")
    order = (asked.join(listed, ["scope", "key"]).select(
        "scope", "key", "list", "day", F.lit(1).alias("asks"), none.alias("begin"), none.alias("end"))
        .unionByName(valid.select("scope", "key", "list", F.col("begin").alias("day"), F.lit(0).alias("asks"), "begin", "end")))
    # an interval that begins on a day holds on it
    before = Window.partitionBy("scope", "key", "list").orderBy("day", "asks")
    last = F.last(F.when(F.col("asks") == 0, F.struct("begin", "end")), ignorenulls=True).over(before)
    return (order.withColumn("last", last).filter("asks = 1 and last is not null")
            .filter(F.coalesce(F.col("last.end") > F.col("day"), F.lit(True)))
            .select("scope", "key", "day", "list", F.col("last.begin").alias("begin")))


def active(keys: DataFrame, valid: DataFrame, by: list[str]) -> DataFrame:
    """For each ``by`` and day: the entries that hold.  ``keys``: by, scope, key, day number."""
    held = as_of(keys.select("scope", "key", "day").distinct(), valid)
    return (keys.join(held, ["scope", "key", "day"])
            .groupBy(*by, "day").agg(F.count("*").alias("n"), F.collect_set("list").alias("lists"),
                                     F.max("begin").alias("since")))


def evaluate(captures: DataFrame, entries: DataFrame, identity: str, url: str = "url", day: str = "day") -> DataFrame:
    """Per capture: ``identity``, host, day, and what holds: entries, lists (sorted), the latest
    entry's day, and ``blocked``."""
    valid = intervals(entries)
    rows = captures.select(F.col(identity), F.col(url).alias("__url"), day_number(F.col(day)).alias("day")).select(
        identity, host_of(F.col("__url")).alias("host"), page_of(F.col("__url")).alias("page"), "day")
    hosts = rows.filter("host is not null and day is not null").select("host", "day").distinct()
    keyed = hosts.select("host", "day", F.inline(F.concat(
        F.transform(domains_of(F.col("host")), lambda d: F.struct(F.lit("domain").alias("scope"), d.alias("key"))),
        F.array(F.struct(F.lit("host").alias("scope"), F.col("host").alias("key"))))))
    by_host = active(keyed, valid.filter("scope <> 'url'"), ["host"])
    pages = rows.filter("page is not null and day is not null").select(
        "page", "day", F.lit("url").alias("scope"), F.col("page").alias("key")).distinct()
    by_page = active(pages, valid.filter("scope = 'url'"), ["page"]).select(
        "page", "day", F.col("n").alias("n2"), F.col("lists").alias("lists2"), F.col("since").alias("since2"))
    none = F.array().cast("array<string>")
    n = F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))
    return rows.join(by_host, ["host", "day"], "left").join(by_page, ["page", "day"], "left").select(
        identity, "host", F.date_from_unix_date("day").alias("captured_on"), n.alias("n_active"),
        F.array_join(F.array_sort(F.array_union(F.coalesce("lists", none), F.coalesce("lists2", none))), ",").alias("lists"),
        F.date_from_unix_date(F.greatest("since", "since2")).alias("listed_since"), (n > 0).alias("blocked"))


def hashed(*parts: Column) -> Column:
    """A whole number below 2**24 from the md5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *(p.cast("string") for p in parts)).cast("binary")), 1, 6), 16, 10).cast("int")


def derived_captures(pages: DataFrame) -> DataFrame:
    """The pages with a fetch day of 2024 from their id's hash (the table has none)."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"),
                                                     hashed(F.lit("day"), F.col("page_id")) % 366).alias("day"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """Dated entries for the domains, hosts and URLs that occur: about half of the domains and
    hosts and a tenth of the URLs have four changes each, by hash.  Domains have two labels or more,
    as in the SQL."""
    rows = pages.select(host_of(F.col("url")).alias("host"), page_of(F.col("url")).alias("page"))
    hosts = rows.filter("host is not null").select("host").distinct()
    keys = (hosts.select(F.lit("domain").alias("scope"), F.explode(domains_of(F.col("host"), 2)).alias("key")).distinct()
            .unionByName(hosts.select(F.lit("host").alias("scope"), F.col("host").alias("key")))
            .unionByName(rows.filter("page is not null").select(F.lit("url").alias("scope"), F.col("page").alias("key")).distinct()))
    scope, key, k = F.col("scope"), F.col("key"), F.col("k")
    every = F.when(scope == "url", 10).otherwise(2)
    return (keys.filter(hashed(F.lit("in"), scope, key) % every == 0)
            .withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(4))))
            .select(F.concat(F.lit("list"), hashed(F.lit("list"), scope, key, k) % 3).alias("list"), "scope", "key",
                    F.date_add(F.lit("2023-12-01").cast("date"), hashed(F.lit("when"), scope, key, k) % 396).alias("day"),
                    F.when(hashed(F.lit("what"), scope, key, k) % 3 == 0, "remove").otherwise("add").alias("action")))


def _h(*parts: str) -> str:
    return f"CAST(('0x' || substr(md5({' || chr(124) || '.join(parts)}), 1, 6)) AS INTEGER)"


EVALUATE_SQL = rf"""
WITH captures AS (
  SELECT page_id, {_h("'day'", "CAST(page_id AS VARCHAR)")} % 366 + DATE '2024-01-01' AS day,
         nullif(rtrim(lower(regexp_extract(url, '{HOST}', 1)), '.'), '') AS host,
         rtrim(regexp_extract(url, '{PATH}', 1), '/') AS path
  FROM pages
), labels_of AS (
  SELECT *, CASE WHEN host LIKE '[%' THEN [host] ELSE string_split(host, '.') END AS parts FROM (SELECT DISTINCT host FROM captures WHERE host IS NOT NULL)
), above AS (
  SELECT host, array_to_string(parts[i:], '.') AS domain
  FROM (SELECT host, parts, unnest(range(1, greatest(len(parts) - 1, 1) + 1)) AS i FROM labels_of)
), keys AS (
  SELECT DISTINCT 'domain' AS scope, domain AS key FROM above
  UNION ALL SELECT 'host', host FROM labels_of
  UNION ALL SELECT DISTINCT 'url', host || path FROM captures WHERE host IS NOT NULL
), entries AS (
  SELECT 'list' || CAST({_h("'list'", "scope", "key", "CAST(k AS VARCHAR)")} % 3 AS VARCHAR) AS list, scope, key,
         {_h("'when'", "scope", "key", "CAST(k AS VARCHAR)")} % 396 + DATE '2023-12-01' AS day,
         CASE WHEN {_h("'what'", "scope", "key", "CAST(k AS VARCHAR)")} % 3 = 0 THEN 'remove' ELSE 'add' END AS action
  FROM keys, range(1, 5) AS ks(k)
  WHERE {_h("'in'", "scope", "key")} % (CASE WHEN scope = 'url' THEN 10 ELSE 2 END) = 0
), states AS (
  SELECT list, scope, key, day, max(action) AS action FROM entries GROUP BY ALL
), asked AS (
  SELECT DISTINCT host, day, 'domain' AS scope, domain AS key FROM captures JOIN above USING (host)
  UNION ALL SELECT DISTINCT host, day, 'host', host FROM captures WHERE host IS NOT NULL
), as_of AS (
  SELECT a.host, a.scope, a.key, a.day, s.list, arg_max(s.action, s.day) AS action
  FROM (SELECT * FROM asked
        UNION ALL SELECT DISTINCT host || path, day, 'url', host || path FROM captures WHERE host IS NOT NULL) a
  JOIN states s ON s.scope = a.scope AND s.key = a.key AND s.day <= a.day
  GROUP BY ALL
), begun AS (
  SELECT a.*, (SELECT min(s.day) FROM states s WHERE s.list = a.list AND s.scope = a.scope AND s.key = a.key
               AND s.day <= a.day AND s.action = 'add' AND s.day > coalesce(
                 (SELECT max(r.day) FROM states r WHERE r.list = a.list AND r.scope = a.scope AND r.key = a.key
                  AND r.day <= a.day AND r.action = 'remove'), DATE '1900-01-01')) AS since
  FROM as_of a WHERE action = 'add'
), verdicts AS (
  SELECT c.page_id, c.host, c.day, b.list, b.since
  FROM captures c JOIN begun b ON b.day = c.day
   AND ((b.scope <> 'url' AND b.host = c.host) OR (b.scope = 'url' AND b.key = c.host || c.path))
)
SELECT c.page_id, c.host, c.day AS captured_on, count(v.list) AS n_active,
       coalesce(string_agg(DISTINCT v.list, ',' ORDER BY v.list), '') AS lists, max(v.since) AS listed_since,
       count(v.list) > 0 AS blocked
FROM captures c LEFT JOIN verdicts v ON v.page_id = c.page_id GROUP BY c.page_id, c.host, c.day
"""


def filtered_pages(pages: DataFrame) -> DataFrame:
    """Every page against the entries derived from the pages, as of its day."""
    return evaluate(derived_captures(pages), derived_entries(pages), "page_id")
