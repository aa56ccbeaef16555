"""URL filters by dated lists: entries become validity intervals, captures meet them by an as-of join.

A list is a log of dated changes, each adding or removing a key: a host (``h:``), a domain with all its hosts (``d:``), or a
host with the start of a path (``p:``).  A capture is judged by the entries that were active when it was fetched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stepstone.llm.registry import query
from stepstone.operators.ordering import with_previous
from stepstone.session import cut

HOST, PATH, SEGMENT = r"^[a-z]+://([^/?#:]+)", r"^[a-z]+://[^/?#]+(/[^?#]*)", r"[^/]+"
LISTS = ("allow", "block")


def host_of(url: Column) -> Column:
    """Host in lower case; empty for what is no URL."""
    return F.regexp_extract(F.coalesce(F.lower(F.substring_index(url, "?", 1)), F.lit("")), HOST, 1)


def path_segments(url: Column) -> Column:
    return F.regexp_extract_all(F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1), F.lit(SEGMENT), F.lit(0))


def keys_of(url: Column) -> Column:
    """All keys that a list may hold against a URL: its host, its domains of two labels or more, its path starts."""
    host, segments = host_of(url), path_segments(url)
    labels = F.split(host, r"\.")
    domains = F.when(
        F.size(labels) >= 2,
        F.transform(
            F.sequence(F.lit(1), F.size(labels) - 1),
            lambda i: F.concat(F.lit("d:"), F.concat_ws(".", F.slice(labels, i, F.size(labels) - i + 1))),
        ),
    ).otherwise(F.array().cast("array<string>"))
    starts = F.when(
        F.size(segments) >= 1,
        F.transform(
            F.sequence(F.lit(1), F.size(segments)),
            lambda i: F.concat(F.lit("p:"), host, F.lit("/"), F.concat_ws("/", F.slice(segments, F.lit(1), i))),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.when(host != "", F.concat(F.array(F.concat(F.lit("h:"), host)), domains, starts)).otherwise(
        F.array().cast("array<string>")
    )


def validity(changes: DataFrame) -> DataFrame:
    """(list, key, from, to) from (list, key, at, seq, added): an entry is active from ``from`` on and before ``to``.

    Changes apply in the order of ``at`` and ``seq``; adding what is active and removing what is not do nothing, an entry
    that is never removed has no ``to``, and one removed at the moment it was added was never active.  Changes without a
    list, key or time are left out.
    """
    group, order = ["list", "key"], ["at", "seq"]
    whole = changes.where("list IS NOT NULL AND key IS NOT NULL AND at IS NOT NULL").select(*group, *order, F.coalesce("added", F.lit(False)).alias("added"))
    turns = with_previous(whole, group, order, ["added"]).where("added <> coalesce(prev.added, false)").drop("prev")
    paired = cut(with_previous(cut(turns, "turns"), group, order, ["at"], "before"), "paired")
    closed = paired.where("NOT added").select(*group, F.col("before.at").alias("from"), F.col("at").alias("to"))
    last = paired.groupBy(*group).agg(F.max_by(F.struct("at", "added"), F.struct(*order)).alias("last"))
    still = last.where("last.added").select(*group, F.col("last.at").alias("from"), F.lit(None).cast(dict(changes.dtypes)["at"]).alias("to"))
    return closed.where("`from` < `to`").unionByName(still)


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, since: str, value: str) -> DataFrame:
    """Add ``value`` of the latest row of ``right`` whose ``since`` is not after ``at``, for rows of one key.

    Both tables are range-partitioned by key and time together, so a hot key is spread over tasks; what a piece leaves for
    those behind it is one row for each key in it.  ``right`` has one row for each key and time; without a match the value is null.
    """
    stamps = left.select(F.col(key), F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.struct(*left.columns).alias("_row"))
    marks = right.select(F.col(key), F.col(since).alias("_at"), F.lit(0).alias("_kind"), F.col(value).alias("_value"))
    both = stamps.unionByName(marks, allowMissingColumns=True)
    ranged = both.repartitionByRange(F.col(key), "_at", "_kind").withColumn("_piece", F.spark_partition_id())
    ranged = cut(ranged, "as-of")
    so_far = Window.partitionBy(key, "_piece").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_near", F.last("_value", ignorenulls=True).over(so_far)).where("_kind = 1")
    carried = (
        ranged.groupBy(key, "_piece")
        .agg(F.max_by("_value", F.when(F.col("_kind") == 0, F.col("_at"))).alias("_left"))
        .withColumn("_far", F.last("_left", ignorenulls=True).over(before))
        .select(F.col(key).alias("_of_key"), F.col("_piece").alias("_of_piece"), "_far")
    )
    joined = local.join(carried, (F.col(key) == F.col("_of_key")) & (F.col("_piece") == F.col("_of_piece")))
    return joined.select("_row.*", F.coalesce("_near", "_far").alias(value))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(page_id, url, fetched_at, n_captures, host, n_active, verdict, matched_key, active_from, active_to).

    One row for each distinct capture, with the number of its rows.  The most specific active entry decides: a path start
    before a host before a domain, longer keys before shorter ones, ``allow`` before ``block`` on the same key.  Without an
    active entry the verdict is ``none``; so it is for what is no URL and for captures without a time.
    """
    same = ["page_id", "url", "fetched_at"]
    whole = cut(captures.groupBy(*same).agg(F.count(F.lit(1)).alias("n_captures")), "captures")
    asked = (
        whole.where("fetched_at IS NOT NULL")
        .select(*same, F.explode(keys_of(F.col("url"))).alias("key"))
        .select(*same, "key", F.explode(F.array(*map(F.lit, LISTS))).alias("list"))
        .select(*same, "key", "list", F.concat_ws("|", "list", "key").alias("listed"))
    )
    marks = entries.select(F.concat_ws("|", "list", "key").alias("listed"), F.col("from").alias("since"), F.struct("from", "to").alias("span"))
    met = as_of(asked, marks, "listed", "fetched_at", "since", "span")
    active = met.where("span IS NOT NULL AND (span.to IS NULL OR fetched_at < span.to)")
    kind = F.when(F.col("key").startswith("p:"), 3).when(F.col("key").startswith("h:"), 2).otherwise(1)
    rank = F.struct(kind.alias("kind"), F.length("key").alias("size"), "key", (F.col("list") == "allow").alias("allow"))
    found = active.groupBy(*same).agg(
        F.count(F.lit(1)).alias("n_active"), F.max_by(F.struct("list", "key", "span"), rank).alias("best")
    )
    named = found.withColumnsRenamed({c: f"_{c}" for c in same})
    match = F.col("page_id").eqNullSafe(F.col("_page_id")) & F.col("url").eqNullSafe(F.col("_url")) & F.col("fetched_at").eqNullSafe(F.col("_fetched_at"))
    return whole.join(named, match, "left").select(
        *same, "n_captures", host_of(F.col("url")).alias("host"), F.coalesce("n_active", F.lit(0)).alias("n_active"),
        F.coalesce("best.list", F.lit("none")).alias("verdict"), F.col("best.key").alias("matched_key"),
        F.col("best.span.from").alias("active_from"), F.col("best.span.to").alias("active_to"),
    )


def captures_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a fetch time; the table has none, so one within 30 days is derived from the id."""
    fetched = F.expr("timestampadd(SECOND, int(pmod(page_id * 7919, 2592000)), TIMESTAMP_NTZ'2024-01-01 00:00:00')")
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", fetched.alias("fetched_at"))


def changes_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated changes: each event adds or removes the host, domain or path start of a page.

    Events are dealt over the page ids, which run from 0 without gaps, so every event is a change.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    url = F.col("url")
    host = host_of(url)
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    first = F.get(path_segments(url), F.lit(0))
    key = (
        F.when((F.col("event_type") == "click") & (domain != ""), F.concat(F.lit("d:"), domain))
        .when((F.col("event_type") == "error") & first.isNotNull(), F.concat(F.lit("p:"), host, F.lit("/"), first))
        .otherwise(F.concat(F.lit("h:"), host))
    )
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    of_page = F.pmod(F.col("event_id"), pages.agg(F.max("page_id") + 1).scalar())
    return events.withColumn("of_page", of_page).join(pages, F.col("of_page") == F.col("page_id")).select(
        F.when(F.col("user_id") % 4 == 0, "allow").otherwise("block").alias("list"), key.alias("key"),
        F.col("ts").cast("timestamp_ntz").alias("at"), F.col("event_id").alias("seq"), (F.col("value") < 25).alias("added"),
    )


_SQL = r"""
WITH p AS (SELECT page_id, url, regexp_extract(lower(split_part(url, '?', 1)), '^[a-z]+://([^/?#:]+)', 1) AS host,
    regexp_extract_all(regexp_extract(url, '^[a-z]+://[^/?#]+(/[^?#]*)', 1), '[^/]+') AS segs,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds((page_id * 7919) % 2592000) AS fetched_at FROM pages),
changes AS (SELECT CASE WHEN user_id % 4 = 0 THEN 'allow' ELSE 'block' END AS lst, ts AS moment, event_id AS seq, value < 25 AS added,
    CASE WHEN event_type = 'click' AND regexp_extract(host, '([^.]+\.[^.]+)$', 1) <> '' THEN 'd:' || regexp_extract(host, '([^.]+\.[^.]+)$', 1)
      WHEN event_type = 'error' AND len(segs) > 0 THEN 'p:' || host || '/' || segs[1] ELSE 'h:' || host END AS key
  FROM (SELECT *, event_id % (SELECT max(page_id) + 1 FROM pages) AS of_page FROM events) JOIN p ON of_page = page_id),
turns AS (SELECT * FROM (SELECT *, lag(added, 1, false) OVER (PARTITION BY lst, key ORDER BY moment, seq) AS before_it FROM changes) WHERE added <> before_it),
spans AS (SELECT lst, key, moment AS f, lead(moment) OVER (PARTITION BY lst, key ORDER BY moment, seq) AS t, added FROM turns),
entries AS (SELECT lst, key, f, t FROM spans WHERE added AND (t IS NULL OR f < t)),
c AS (SELECT page_id, url, fetched_at, host, segs, count(*) AS n_captures FROM p GROUP BY ALL),
k AS (SELECT page_id, url, fetched_at, 'h:' || host AS key FROM c WHERE host <> ''
  UNION ALL SELECT page_id, url, fetched_at, 'd:' || array_to_string(list_slice(l, i, len(l)), '.')
    FROM (SELECT *, string_split(host, '.') AS l FROM c WHERE host <> ''), LATERAL (SELECT unnest(range(1, len(l))) AS i)
  UNION ALL SELECT page_id, url, fetched_at, 'p:' || host || '/' || array_to_string(list_slice(segs, 1, i), '/')
    FROM (SELECT * FROM c WHERE host <> ''), LATERAL (SELECT unnest(range(1, len(segs) + 1)) AS i)),
met AS (SELECT k.*, e.lst, e.f, e.t, row_number() OVER (PARTITION BY page_id, url, fetched_at ORDER BY
      CASE left(k.key, 2) WHEN 'p:' THEN 3 WHEN 'h:' THEN 2 ELSE 1 END DESC, length(k.key) DESC, k.key DESC, e.lst) AS n,
    count(*) OVER (PARTITION BY page_id, url, fetched_at) AS n_active
  FROM k JOIN entries e ON e.key = k.key AND e.f <= fetched_at AND (e.t IS NULL OR fetched_at < e.t))
SELECT c.page_id, c.url, c.fetched_at, c.n_captures, c.host, coalesce(m.n_active, 0) AS n_active, coalesce(m.lst, 'none') AS verdict,
  m.key AS matched_key, m.f AS active_from, m.t AS active_to
FROM c LEFT JOIN met m ON m.n = 1 AND m.page_id = c.page_id AND m.url = c.url AND m.fetched_at = c.fetched_at"""


@query("op2_dated_url_lists", _SQL)
def dated_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists from all events."""
    return judge(captures_of(spark, sf_dir), validity(changes_of(spark, sf_dir)))
