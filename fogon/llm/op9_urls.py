"""URL filters by a temporal join with dated list entries, in Spark expressions only.

A list is a history: entries (pattern, kind, action, at) say that a pattern was added to or removed from the list. The entries of a
pattern, in order, become validity intervals [from, until). A capture (url, fetched_at) is listed if an interval of one of its
patterns was open when it was fetched.

Captures meet the list in two equi-joins, by host and by host with first path segment. For the first, every distinct host is
matched with the domains above it once, and the intervals that apply to a host are gathered in one array (as long as the list's
history of a few domains); the as-of step is a filter of that array. So a capture is joined once per kind and never multiplied, and a host
of a third of all captures only makes the left side of an inner-size join large, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fogon.llm.store import prepare

HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
SEGMENT = r"^[a-z][a-z0-9+.-]*://[^/?#]+/([^/?#]+)"


def host_of(url: Column) -> Column:
    return F.rtrim(F.regexp_extract(F.lower(url), HOST, 1), F.lit("."))


def path_of(url: Column) -> Column:
    """host/segment, or null without a path segment."""
    segment = F.regexp_extract(F.lower(url), SEGMENT, 1)
    return F.when(segment != "", F.concat(host_of(url), F.lit("/"), segment))


def intervals(entries: DataFrame) -> DataFrame:
    """(kind, pattern, valid_from, valid_until) from entries (kind, pattern, action 'add' or 'remove', at).

    Repeated entries count once; of two at one time, the removal comes last. An open end is null. An addition to a listed
    pattern continues it. Entries with a null are ignored.
    """
    known = entries.select("kind", "pattern", "action", "at").dropna().filter(F.col("action").isin("add", "remove")).distinct()
    w = Window.partitionBy("kind", "pattern").orderBy("at", "action")
    stepped = known.withColumn("before", F.coalesce(F.lag("action").over(w), F.lit("remove"))).filter("action <> before")
    opened = stepped.withColumn("until", F.lead("at").over(w)).filter("action = 'add'")
    return opened.select("kind", "pattern", F.col("at").alias("valid_from"), F.col("until").alias("valid_until")).filter("valid_until is null or valid_until > valid_from")


def match(captures: DataFrame, spans: DataFrame) -> DataFrame:
    """``captures`` (url, fetched_at, ...) with host, listed, n_active, matched (the longest active pattern) and active_since.

    Kinds: 'domain' holds a host and all below it, 'path' a host with a first path segment. Null or unreadable URLs have an empty
    host and are not listed; a null fetched_at is within no interval. Every row of captures has one row; columns named like the
    added ones are replaced.
    """
    prepare(captures.sparkSession)
    rows = captures.drop("host", "listed", "n_active", "matched", "active_since").withColumn("host", F.coalesce(host_of(F.col("url")), F.lit("")))
    rows = rows.withColumn("_path", path_of(F.col("url")))
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = rows.filter("host <> ''").select("host").distinct().select("host", F.explode(above).alias("pattern"))
    span = F.struct(F.length("pattern").alias("size"), "pattern", "valid_from", "valid_until")
    by_host = hosts.join(spans.filter("kind = 'domain'"), "pattern").groupBy("host").agg(F.collect_list(span).alias("_spans"))
    by_path = spans.filter("kind = 'path'").groupBy(F.col("pattern").alias("_path")).agg(F.collect_list(span).alias("_path_spans"))
    joined = rows.join(by_host, "host", "left").join(by_path, "_path", "left")
    none = F.array().cast("array<struct<size:int,pattern:string,valid_from:bigint,valid_until:bigint>>")
    active = F.filter(F.concat(F.coalesce("_spans", none), F.coalesce("_path_spans", none)),
                      lambda x: (x["valid_from"] <= F.col("fetched_at")) & (x["valid_until"].isNull() | (x["valid_until"] > F.col("fetched_at"))))
    out = joined.withColumn("_active", active).withColumn("_top", F.array_max("_active"))
    return out.select(*[F.col(c) for c in rows.columns if c != "_path"], (F.size("_active") > 0).alias("listed"), F.size("_active").cast("long").alias("n_active"),
                      F.col("_top.pattern").alias("matched"), F.col("_top.valid_from").alias("active_since"))


DAY = 86_400
START = 1_704_067_200  # 2024-01-01


def dated_list(pages: DataFrame) -> DataFrame:
    """The list of the registered query, derived from the hosts and paths of the table itself.

    Digits of a pattern's MD5 decide whether it is listed, when, whether it is taken off and whether it comes back.
    """
    domains = pages.select(host_of(F.col("url")).alias("host")).filter("host <> ''").distinct()
    parents = domains.select(F.regexp_replace("host", r"^[^.]+\.", "").alias("host"))
    patterns = domains.union(parents).distinct().select(F.lit("domain").alias("kind"), F.col("host").alias("pattern"))
    patterns = patterns.union(pages.select(F.lit("path").alias("kind"), path_of(F.col("url")).alias("pattern")).dropna().distinct())
    named = patterns.withColumn("m", F.md5(F.col("pattern").cast("binary")))
    digit = [F.ascii(F.substring("m", i, 1)) for i in range(1, 7)]
    since = (digit[1] * digit[2]) % 365 * DAY + START
    add = named.filter(digit[0] < 53).select("kind", "pattern", F.lit("add").alias("action"), since.cast("long").alias("at"))
    remove = named.filter((digit[0] < 53) & (digit[3] < 57)).select("kind", "pattern", F.lit("remove").alias("action"), (since + (30 + digit[4]) * DAY).cast("long").alias("at"))
    back = named.filter((digit[0] < 53) & (digit[5] < 53)).select("kind", "pattern", F.lit("add").alias("action"), (since + 300 * DAY).cast("long").alias("at"))
    return add.union(remove).union(back)


def op9_temporal_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages have no fetch time: one within two years is derived from page_id."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    fetched = (F.lit(START) + (F.col("page_id") * 7919 % 730) * DAY + F.col("page_id") % DAY).cast("long")
    found = match(pages.withColumn("fetched_at", fetched), intervals(dated_list(pages)))
    return found.select("page_id", "host", "fetched_at", "listed", "n_active", "matched", "active_since")


SQL = {
    "op9_temporal_list": rf"""
with p as (
  select page_id, rtrim(regexp_extract(lower(url), '{HOST}', 1), '.') as host, regexp_extract(lower(url), '{SEGMENT}', 1) as seg,
    (1704067200 + (page_id * 7919 % 730) * 86400 + page_id % 86400)::bigint as fetched_at from pages),
dom as (select distinct host from p where host <> ''),
pat as (
  select distinct 'domain' as kind, host as pattern from (select host from dom union select regexp_replace(host, '^[^.]+\.', '') from dom)
  union select distinct 'path', host || '/' || seg from p where seg <> ''),
dig as (
  select kind, pattern, ascii(m[1]) as a, ascii(m[4]) as c, ascii(m[5]) as d, ascii(m[6]) as e, ascii(m[2]) * ascii(m[3]) % 365 * 86400 + 1704067200 as since
  from (select *, md5(pattern) as m from pat)),
ent as (
  select kind, pattern, 'add' as action, since::bigint as ts from dig where a < 53
  union select kind, pattern, 'remove', (since + (30 + d) * 86400)::bigint from dig where a < 53 and c < 57
  union select kind, pattern, 'add', (since + 300 * 86400)::bigint from dig where a < 53 and e < 53),
step as (
  select * from (select *, coalesce(lag(action) over (partition by kind, pattern order by ts, action), 'remove') as before from ent) where action <> before),
span as (
  select kind, pattern, ts as valid_from, until from (select *, lead(ts) over (partition by kind, pattern order by ts, action) as until from step)
  where action = 'add' and (until is null or until > ts)),
key as (
  select page_id, fetched_at, 'domain' as kind, array_to_string(ls[i:], '.') as pattern
  from (select page_id, fetched_at, string_split(host, '.') as ls, unnest(range(1, len(string_split(host, '.')) + 1)) as i from p where host <> '')
  union all select page_id, fetched_at, 'path', host || '/' || seg from p where seg <> ''),
hit as (
  select page_id, pattern, valid_from from key join span using (kind, pattern) where valid_from <= fetched_at and (until is null or until > fetched_at)),
best as (
  select page_id, count(*) as n, (list({{'l': length(pattern), 'p': pattern, 'f': valid_from}} order by length(pattern) desc, pattern desc, valid_from desc))[1] as b
  from hit group by page_id)
select p.page_id, host, fetched_at, n is not null as listed, coalesce(n, 0)::bigint as n_active, b.p as matched, b.f as active_since
from p left join best using (page_id)"""
}
