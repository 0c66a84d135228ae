"""URL filters by a temporal join with dated lists.

A list entry adds or removes a pattern from a date on.  The entries of one list and pattern, in order of date, become
validity intervals.  A capture has a few keys: every domain its host belongs to, its host with the first part of
its path, and its whole address.  For every key and fetch date that occurs, an as-of join finds the intervals
that hold on that date, and captures meet the active ones by key and date.

The as-of step works on distinct keys and dates, so a host with a large share of all captures counts once for each
day; its window holds one row for each date and event of one pattern, which the calendar bounds.  Captures are
joined only to active entries, one for each list, and such a join can be split however hot the key.

Patterns: ``d:`` and a domain (it and all below), ``s:`` and host/first part of the path, ``u:`` and host with path.  Hosts
are compared in lower case without user, port and closing dot; queries and fragments do not matter.  Defined
results: null urls and urls without a host match nothing; a host of over 253 characters has only itself as
a domain; of entries of one list, pattern and date a removal wins; entries without list, pattern or date are
void; a null fetch date meets nothing; repeated captures give one row; an empty list blocks nothing, and an
empty table of captures gives an empty result.  Other columns are left out.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

LONGEST_HOST = 253


def host_of(url: Column) -> Column:
    place = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    bare = F.regexp_replace(F.regexp_replace(place, r"^.*@", ""), r":[0-9]*$", "")
    return F.lower(F.regexp_replace(bare, r"[.]$", ""))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def keys_of(url: Column) -> Column:
    """All keys under which a list could name the address."""
    host, path = host_of(url), path_of(url)
    labels = F.when(F.length(host) <= LONGEST_HOST, F.split(host, "[.]")).otherwise(F.array(host))
    below = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    domains = F.transform(below, lambda d: F.concat(F.lit("d:"), d))
    section = F.concat(F.lit("s:"), host, F.regexp_extract(path, r"^/[^/]*", 0))
    keys = F.concat(domains, F.array(section, F.concat(F.lit("u:"), host, path)))
    return F.when(host != "", F.array_distinct(keys)).otherwise(F.array().cast("array<string>"))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``list``, ``pattern``, ``action``, ``valid_from``, ``valid_to`` (open if null) from dated entries."""
    usable = entries.where("list is not null and pattern is not null and entry_date is not null and action in ('add', 'remove')")
    dated = usable.groupBy("list", "pattern", "entry_date").agg(F.max("action").alias("action"))
    following = F.lead("entry_date").over(Window.partitionBy("list", "pattern").orderBy("entry_date"))
    return dated.select("list", "pattern", "action", F.col("entry_date").alias("valid_from"), following.alias("valid_to"))


def active_entries(asked: DataFrame, intervals: DataFrame) -> DataFrame:
    """``key``, ``day``, ``list``, ``valid_from`` of the entries that hold for distinct ``key``, ``day``."""
    named = intervals.select("list", F.col("pattern").alias("key")).distinct()
    moments = asked.join(named, "key").select("list", "key", "day", F.lit(None).cast("string").alias("action"))
    events = intervals.select("list", F.col("pattern").alias("key"), F.col("valid_from").alias("day"), "action")
    timeline = events.unionByName(moments)
    until = Window.partitionBy("list", "key").orderBy("day", F.col("action").isNull())
    last = F.last(F.when(F.col("action").isNotNull(), F.struct("action", F.col("day").alias("valid_from"))), True).over(until)
    found = timeline.withColumn("last", last).where(F.col("action").isNull() & (F.col("last.action") == "add"))
    return found.select("key", "day", "list", "last.valid_from")


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``fetched``, ``blocked``, ``n_matches`` (entries), ``lists`` and ``since`` of each capture.

    ``captures`` has ``page_id``, ``url``, ``fetched`` (a date); ``entries`` has ``list``, ``pattern``, ``action``
    ('add' or 'remove'), ``entry_date``.
    """
    own = ["page_id", "url", "fetched"]
    distinct = captures.select(*own).distinct()
    keyed = distinct.select(*own, F.explode(keys_of(F.col("url"))).alias("key"))
    asked = keyed.where("fetched is not null").select("key", F.col("fetched").alias("day")).distinct()
    active = active_entries(asked, validity_intervals(entries))
    met = keyed.join(active, (keyed["key"] == active["key"]) & (keyed["fetched"] == active["day"]))
    found = met.groupBy(*own).agg(
        F.count("*").alias("n_matches"),
        F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"),
        F.min("valid_from").alias("since"),
    )
    found = found.withColumnsRenamed({c: f"m_{c}" for c in own})
    same = F.col("page_id").eqNullSafe(F.col("m_page_id")) & (F.col("url") == F.col("m_url")) & (F.col("fetched") == F.col("m_fetched"))
    return distinct.join(found, same, "left").select(
        *own,
        F.col("n_matches").isNotNull().alias("blocked"),
        F.coalesce("n_matches", F.lit(0)).alias("n_matches"),
        F.coalesce("lists", F.lit("")).alias("lists"),
        "since",
    )


# The tables have no fetch dates and no lists.  Both are derived from pages by rules that Spark and DuckDB share.
CAPTURES = "select page_id, url, date_add(date '2024-01-01', cast((page_id * 37) % 366 as int)) as fetched from pages"
_DAY = "cast((page_id * {k} + {k}) % 366 as int)"
_HOST = r"lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#@:]*)', 1))"
_PATH = r"regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_NAMED = f"""select page_id, {_HOST} as host, {_PATH} as path from pages where url is not null"""
ENTRIES = f"""
select case when page_id % 2 = 0 then 'ads' else 'spam' end as list,
       case page_id % 3 when 0 then concat('d:', host)
            when 1 then concat('s:', host, regexp_extract(path, '^/[^/]*', 0)) else concat('u:', host, path) end as pattern,
       'add' as action, date_add(date '2024-01-01', {_DAY.format(k=11)}) as entry_date
from ({_NAMED}) p where page_id % 5 < 2
union all
select case when page_id % 2 = 0 then 'ads' else 'spam' end as list,
       case page_id % 3 when 0 then concat('d:', host)
            when 1 then concat('s:', host, regexp_extract(path, '^/[^/]*', 0)) else concat('u:', host, path) end as pattern,
       'remove' as action, date_add(date '2024-01-01', {_DAY.format(k=29)}) as entry_date
from ({_NAMED}) p where page_id % 5 < 1"""


def filtered_pages(pages: DataFrame) -> DataFrame:
    captures, entries = (pages.sparkSession.sql(text.replace("from pages", "from {pages}"), pages=pages) for text in (CAPTURES, ENTRIES))
    found = filter_captures(captures, entries)
    return found.withColumns({c: F.col(c).cast("string") for c in ("fetched", "since")})


def _duckdb(text: str) -> str:
    return text.replace("date_add(date '2024-01-01', ", "(date '2024-01-01' + ")


ORACLE = f"""
with captures as (select distinct * from ({_duckdb(CAPTURES)}) c),
entries as (select list, pattern, entry_date, max(action) as action from ({_duckdb(ENTRIES)}) e group by all),
intervals as (
  select *, lead(entry_date) over (partition by list, pattern order by entry_date) as valid_to from entries),
named as (
  select *, lower(regexp_replace(regexp_replace(regexp_replace(
             regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', ''), '[.]$', '')) as host,
         {_PATH} as path from captures),
keyed as (
  select page_id, url, fetched, unnest(list_distinct(list_concat(
    list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: 'd:' || array_to_string(string_split(host, '.')[i:], '.')),
    ['s:' || host || regexp_extract(path, '^/[^/]*', 0), 'u:' || host || path]))) as key
  from named where host <> ''),
met as (
  select page_id, url, fetched, count(*) as n_matches, array_to_string(list_sort(list_distinct(list(list))), ',') as lists,
         min(entry_date) as since
  from keyed join intervals on key = pattern and action = 'add' and fetched >= entry_date and (valid_to is null or fetched < valid_to)
  group by all)
select c.page_id, c.url, cast(c.fetched as varchar) as fetched, n_matches is not null as blocked, coalesce(n_matches, 0) as n_matches,
       coalesce(lists, '') as lists, cast(since as varchar) as since
from captures c left join met m using (page_id, url, fetched)
"""
