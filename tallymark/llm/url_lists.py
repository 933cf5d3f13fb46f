"""URL filters by a temporal list join, in DataFrame functions.

Lists come as dated events: an entry is added or removed. Per entry they become validity
intervals, and an as-of join looks up which entries were active when a page was fetched. Of the
active entries that cover a capture, the most specific one decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.operators.joins import null_safe_join
from tallymark.operators.moving import carried

LAST = 2**62

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-cased host without a leading www.; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"^www\.", "")


def entries_covering(url: Column) -> Column:
    """Every entry that would cover the URL: its host, the domains above it, and its path prefixes.

    An entry is written `example.com` (this host and all below it) or `host/first/second`.
    """
    labels = F.split(host_of(url), r"\.")
    steps = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda s: s != "")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.transform(
        F.when(F.size(steps) > 0, F.sequence(F.lit(1), F.size(steps))).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(steps, 1, i), "/")))
    return F.when(host_of(url) != "", F.concat(domains, paths)).otherwise(F.array().cast("array<string>"))


def intervals(events: DataFrame) -> DataFrame:
    """(entry, list, since, until): when entries are active, from events (entry, list, action, at).

    action: add or remove. Repeated events count once, a removal at the time of an addition comes
    after it, an entry that is never removed stays; events with a null are left out. The distinct
    events of an entry are few, whatever the number of captures: at most two a second.
    """
    order = Window.partitionBy("entry", "list").orderBy("at", "action")
    return (
        events.select("entry", "list", "action", F.col("at").cast("bigint").alias("at")).na.drop().distinct()
        .withColumn("until", F.coalesce(F.lead("at").over(order), F.lit(LAST)))
        .where("action = 'add' and until > at")
        .select("entry", "list", F.col("at").alias("since"), "until")
    )


def url_filter(captures: DataFrame, events: DataFrame) -> DataFrame:
    """(page_id, fetched_at, copies, n_active, entry, blocked) of every capture.

    captures: page_id, url, fetched_at (seconds). events: see `intervals`; list is block or allow.
    blocked: the longest active entry that covers the URL is on a block list (if it is on both, it
    blocks). A capture without host, url or time is covered by nothing and passes. Repeated rows
    are one capture with their number in `copies`; other columns are not read; without events
    everything passes. Times may be any whole numbers; URLs of any length are taken whole.
    """
    active = intervals(events)
    asked = captures.groupBy("page_id", "url", F.col("fetched_at").cast("bigint").alias("fetched_at")).agg(
        F.count("*").alias("copies"))
    # only entries that some list has ever had are looked up
    probes = (
        asked.where("fetched_at is not null")
        .select("page_id", "url", "fetched_at", F.explode(entries_covering(F.col("url"))).alias("entry"))
        .join(active.select("entry", "list").distinct(), "entry")
    )
    # as-of join: intervals and captures of an entry in the order of time, an interval first among equals;
    # the end of the last interval that has begun is carried to the captures
    both = active.withColumnRenamed("since", "at").withColumn("asks", F.lit(False)).unionByName(
        probes.withColumnRenamed("fetched_at", "at").withColumn("asks", F.lit(True)), allowMissingColumns=True)
    order = [F.col(c) for c in ("at", "asks", "page_id", "url")]
    met = carried(both, ["entry", "list"], order, F.col("until"), "last", "ends").where("asks and at < ends")
    best = F.max(F.struct(F.length("entry").alias("size"), (F.col("list") == "block").alias("block"), "entry"))
    hits = met.groupBy("page_id", "url", F.col("at").alias("fetched_at")).agg(
        F.count("*").alias("n_active"), best.alias("best"))
    return null_safe_join(asked, hits, ["page_id", "url", "fetched_at"], "left").select(
        "page_id", "fetched_at", "copies", F.coalesce("n_active", F.lit(0)).cast("bigint").alias("n_active"),
        F.col("best.entry").alias("entry"), F.coalesce("best.block", F.lit(False)).alias("blocked"))


# The pages have no fetch times and no lists come with them: both derive from the URLs.
START, YEAR = 1_704_067_200, 31_536_000  # 2024-01-01, seconds of a year


def number_of(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def captures_of(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", (START + number_of(F.concat(
        F.lit("fetch:"), F.col("page_id").cast("string"))) % YEAR).alias("fetched_at"))


def events_of(pages: DataFrame) -> DataFrame:
    """Hosts, their parent domains and first path steps as entries, listed at dates of their own.

    A third of the hosts are blocked for a while, half of them again later; a tenth of the parent
    domains are blocked from some day on; a quarter of the path prefixes are allowed for a while.
    """
    host = host_of(F.col("url"))
    found = pages.select(host.alias("host"), F.regexp_extract("url", PATH, 1).alias("path")).where("host != ''")
    path = F.split("path", "/")[0]
    kinds = {
        "host": (F.col("host"), 3, "block"),
        "domain": (F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1), 10, "block"),
        "path": (F.when(path != "", F.concat("host", F.lit("/"), path)), 4, "allow"),
    }
    events = None
    for kind, (entry, one_in, name) in kinds.items():
        listed = (
            found.select(entry.alias("entry")).where("entry != ''").distinct()
            .withColumn("n", number_of(F.concat(F.lit(f"{kind}:"), F.col("entry"))))
            .where(F.col("n") % one_in == 0)
            .withColumn("at", START + F.col("n") % YEAR)
        )
        pause = F.col("at") + 1 + F.col("n") % 8_000_000
        steps = [F.struct(F.lit("add").alias("action"), F.col("at").alias("at"))]
        if kind != "domain":
            steps.append(F.struct(F.lit("remove").alias("action"), pause.alias("at")))
        again = F.struct(F.lit("add").alias("action"), (pause + F.col("n") % 4_000_000).alias("at"))
        every = F.array(*steps)
        if kind == "host":
            every = F.when(F.col("n") % 2 == 0, F.concat(every, F.array(again))).otherwise(every)
        rows = listed.select("entry", F.lit(name).alias("list"), F.explode(every).alias("e")).select(
            "entry", "list", "e.action", "e.at")
        events = rows if events is None else events.union(rows)
    return events


def filtered_pages(spark: SparkSession, root: str) -> DataFrame:
    pages = spark.read.parquet(f"{root}/pages.parquet")
    return url_filter(captures_of(pages), events_of(pages))


_NUMBER = "('0x' || md5({})[1:8])::BIGINT"
URL_LISTS_SQL = rf"""
WITH urls AS (
    SELECT page_id, url, regexp_replace(lower(regexp_extract(url, '{HOST}', 1)), '^www\.', '') AS host,
           regexp_extract(url, '{PATH}', 1) AS path,
           {START} + {_NUMBER.format("'fetch:' || page_id::VARCHAR")} % {YEAR} AS fetched_at
    FROM pages),
named AS (
    SELECT DISTINCT 'host' AS kind, host AS entry FROM urls WHERE host <> ''
    UNION ALL SELECT DISTINCT 'domain', regexp_extract(host, '^[^.]+\.(.+\..+)$', 1) FROM urls WHERE host <> ''
    UNION ALL SELECT DISTINCT 'path', host || '/' || split_part(path, '/', 1) FROM urls
    WHERE host <> '' AND split_part(path, '/', 1) <> ''),
listed AS (
    SELECT *, {_NUMBER.format("kind || ':' || entry")} AS n FROM named WHERE entry <> ''),
dated AS (
    SELECT *, {START} + n % {YEAR} AS moment, {START} + n % {YEAR} + 1 + n % 8000000 AS pause,
           CASE WHEN kind = 'path' THEN 'allow' ELSE 'block' END AS list
    FROM listed
    WHERE n % CASE kind WHEN 'host' THEN 3 WHEN 'domain' THEN 10 ELSE 4 END = 0),
events AS (
    SELECT entry, list, 'add' AS action, moment FROM dated
    UNION SELECT entry, list, 'remove', pause FROM dated WHERE kind <> 'domain'
    UNION SELECT entry, list, 'add', pause + n % 4000000 FROM dated WHERE kind = 'host' AND n % 2 = 0),
spells AS (
    SELECT *, coalesce(lead(moment) OVER (PARTITION BY entry, list ORDER BY moment, action), {LAST}) AS until FROM events),
active AS (SELECT entry, list, moment AS since, until FROM spells WHERE action = 'add' AND until > moment),
captures AS (SELECT page_id, url, host, path, fetched_at, count(*) AS copies FROM urls GROUP BY ALL),
parts AS (
    SELECT *, string_split(host, '.') AS labels,
           list_filter(string_split(path, '/'), lambda s: s <> '') AS steps FROM captures),
asked AS (
    SELECT page_id, url, fetched_at, unnest(list_concat(
        list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.')),
        list_transform(range(1, len(steps) + 1), lambda i: host || '/' || array_to_string(steps[1:i], '/')))) AS entry
    FROM parts WHERE host <> ''),
met AS (
    SELECT q.page_id, q.url, q.fetched_at, a.entry, a.list FROM asked q
    JOIN active a ON q.entry = a.entry AND q.fetched_at >= a.since AND q.fetched_at < a.until),
decided AS (
    SELECT page_id, url, fetched_at, count(*) AS n_active,
           max(struct_pack(size := length(entry), block := list = 'block', entry := entry)) AS best
    FROM met GROUP BY ALL)
SELECT page_id, fetched_at, copies, coalesce(n_active, 0) AS n_active, best.entry AS entry,
       coalesce(best.block, false) AS blocked
FROM captures LEFT JOIN decided USING (page_id, url, fetched_at)
"""
