"""URL filters: dated list entries become validity intervals, which an as-of join holds against captures.

An entry puts a host on a list, or takes it off, from its date on. A capture is judged by the entries for its host
and the host's parents that were active when it was fetched. The join is on (host, period): intervals are cut at period
bounds, so a capture meets only the intervals of its own period, however long a host's history is, and a host with
very many captures is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docpulse.llm.common import query, table, without

OWN = ["host", "blocked", "listed_host", "listed_since", "n_listed"]


def intervals(entries: DataFrame) -> DataFrame:
    """``entries`` (listed_host, action, dated) as listed_host, since, until (NULL: still valid).

    Of entries of one host on one day, "add" wins. Actions other than "add" take off; rows without host or date say nothing.
    Adding again what is listed begins a new interval, which changes no verdict, only ``since``.
    """
    days = (entries.filter("listed_host IS NOT NULL AND dated IS NOT NULL")
            .groupBy(F.lower("listed_host").alias("listed_host"), "dated")
            .agg(F.max(F.coalesce(F.col("action") == "add", F.lit(False))).alias("__on")))
    later = Window.partitionBy("listed_host").orderBy("dated")
    return (days.withColumn("until", F.lead("dated").over(later)).filter("__on")
            .select("listed_host", F.col("dated").alias("since"), "until"))


def host_of(url):
    """Host in lower case, without credentials, port and trailing dot; NULL if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(host), r"^.*@", ""), r"(:[0-9]*)?$", "")
    return F.nullif(F.rtrim(host, F.lit(".")), F.lit(""))


def filter_urls(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
                fetched_col: str = "fetched", period_days: int = 32) -> DataFrame:
    """Every capture with ``host``, ``blocked``, ``listed_host`` and ``listed_since`` of the most specific active
    entry, and ``n_listed``, the number of active entries.

    Captures without a host or date are not blocked. Rows that repeat an id are judged each. Input columns named like
    the new ones give way to them. Without entries nothing is blocked.
    """
    rows = without(captures, OWN).withColumn("host", host_of(F.col(url_col)))
    columns = rows.columns
    # A verdict depends on host and time alone, so that other columns are neither copied for parents nor grouped.
    asked = rows.filter(F.col("host").isNotNull() & F.col(f"`{fetched_col}`").isNotNull()).select(
        F.col("host").alias("__host"), F.col(f"`{fetched_col}`").alias("__fetched")).distinct()
    asked = asked.withColumn("__labels", F.split("__host", r"\."))
    parents = F.transform(F.sequence(F.lit(1), F.size("__labels")), lambda i: F.concat_ws(
        ".", F.slice("__labels", i, F.size("__labels"))))
    period = lambda day: F.floor(F.unix_date(F.to_date(day)) / period_days)
    asked = asked.select("__host", "__fetched", period(F.col("__fetched")).alias("__period"), F.explode(parents).alias("__key"))
    first, last = captures.agg(F.min(F.to_date(fetched_col)), F.max(F.to_date(fetched_col))).first()
    first, last = F.lit(first).cast("date"), F.lit(last).cast("date")
    valid = (intervals(entries)
             .filter((F.to_date("since") <= last) & (F.coalesce("until", last) >= first))
             .withColumn("__period", F.explode(F.sequence(
                 period(F.greatest("since", first)), period(F.least(F.coalesce("until", last), last)))))
             .select(F.col("listed_host").alias("__key"), "__period", "since", "until"))
    met = asked.join(valid, ["__key", "__period"]).filter(
        (F.col("__fetched") >= F.col("since")) & (F.col("until").isNull() | (F.col("__fetched") < F.col("until"))))
    verdicts = met.groupBy("__host", "__fetched").agg(
        F.max(F.struct(F.length("__key").alias("n"), F.col("__key").alias("k"), "since")).alias("__best"), F.count("*").alias("__n"))
    judged = rows.join(verdicts, (F.col("host") == F.col("__host")) & (F.col(f"`{fetched_col}`") == F.col("__fetched")), "left")
    return judged.select(*[F.col(f"`{c}`") for c in columns], F.col("__best").isNotNull().alias("blocked"), F.col("__best.k").alias("listed_host"),
                         F.col("__best.since").alias("listed_since"), F.coalesce("__n", F.lit(0)).alias("n_listed"))


# The pages carry no fetch date and there is no list: both are derived, in either engine, from ids and host names.
DATED = "date_add(DATE'2024-01-01', CAST(page_id * 7919 % 366 AS INT))"


def entries_of(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts of ``pages`` and their parent domains: added, taken off, some added again."""
    host = pages.select(host_of(F.col("url")).alias("h")).filter("h IS NOT NULL").distinct()
    names = host.select(F.explode(F.array("h", F.regexp_replace("h", r"^[^.]*\.", ""))).alias("listed_host")).distinct()
    n = F.conv(F.substring(F.md5("listed_host"), 1, 4), 16, 10).cast("int")
    names = names.withColumn("n", n).filter("n % 3 = 0")
    event = lambda action, days: F.struct(
        F.lit(action).alias("action"), F.expr(f"date_add(DATE'2023-12-01', {days})").alias("dated"))
    events = F.array(event("add", "n % 200"), event("remove", "n % 200 + 10 + n % 70"), event("add", "n % 200 + 90 + n % 50"))
    return names.withColumn("e", F.explode(F.when(F.col("n") % 2 == 0, events).otherwise(F.slice(events, 1, 2)))).select(
        "listed_host", "e.action", "e.dated")


@query(r"""
    WITH p AS (
        SELECT page_id, DATE '2024-01-01' + CAST(page_id * 7919 % 366 AS INT) AS fetched,
               nullif(rtrim(regexp_replace(regexp_replace(lower(regexp_extract(
                   coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^.*@', ''), '(:[0-9]*)?$', ''), '.'), '') AS host
        FROM pages),
    h AS (SELECT DISTINCT host FROM p WHERE host IS NOT NULL),
    names AS (
        SELECT DISTINCT name FROM (SELECT host AS name FROM h UNION ALL SELECT regexp_replace(host, '^[^.]*\.', '') FROM h)),
    n AS (SELECT name, ('0x' || md5(name)[1:4])::INT AS n FROM names),
    l AS (SELECT * FROM n WHERE n % 3 = 0),
    e AS (
        SELECT name, true AS act, DATE '2023-12-01' + n % 200 AS dated FROM l
        UNION ALL SELECT name, false, DATE '2023-12-01' + (n % 200 + 10 + n % 70) FROM l
        UNION ALL SELECT name, true, DATE '2023-12-01' + (n % 200 + 90 + n % 50) FROM l WHERE n % 2 = 0),
    d AS (SELECT name, dated, bool_or(act) AS act FROM e GROUP BY ALL),
    v AS (SELECT *, lead(dated) OVER (PARTITION BY name ORDER BY dated) AS until FROM d),
    m AS (
        SELECT page_id, max({'n': length(name), 'k': name, 's': dated}) AS b, count(name) AS n_listed
        FROM p JOIN v ON act AND fetched >= dated AND (until IS NULL OR fetched < until)
            AND (host = name OR ends_with(host, '.' || name)) GROUP BY page_id)
    SELECT page_id, fetched, host, b IS NOT NULL AS blocked, b.k AS listed_host, b.s AS listed_since,
           coalesce(n_listed, 0) AS n_listed
    FROM p LEFT JOIN m USING (page_id)
""")
def op8_url_filter(spark, sf_dir):
    """All pages against the list entries active when they were fetched."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url").withColumn("fetched", F.expr(DATED))
    return filter_urls(pages, entries_of(pages)).drop("url")
