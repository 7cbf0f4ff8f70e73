"""URL filters by dated lists, in DataFrame operations only.

A list is a history: entries are added and removed at dates. Each add opens a validity interval that the next
event of the same entry closes, and a capture is judged by the entries that are active at its fetch time: an
as-of join on the entry's value, with the interval as its second condition.

An entry's value is a host, which covers the host and everything below it, or a host with a path, which covers
that path and everything below it. So a URL has a few possible values, and looking them up is an equi join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOREVER = "9999-12-31 00:00:00"


def url_host(url: Column) -> Column:
    """Lower-case host of an absolute URL, without user, port and closing dot; null where there is none."""
    host = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#\\]*@)?(\[[^\]]*\]|[^/?#:\\]*)", 1)
    return F.nullif(F.rtrim(F.lower(host), F.lit(".")), F.lit(""))


def url_path(url: Column) -> Column:
    """Path of an absolute URL without query, fragment and closing slashes; empty for the host's root."""
    path = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://[^/?#\\]*(/[^?#]*)", 1)
    return F.regexp_replace(F.coalesce(path, F.lit("")), r"[/\s]+$", "")


def lookup_values(host: Column, path: Column) -> Column:
    """Every value that would cover a URL: its host and the hosts above it, and its host with each path above
    and at its own. Distinct; null for a null host."""
    labels = F.split(host, r"\.")
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    steps = F.filter(F.split(path, "/"), lambda s: s != "")
    paths = F.when(F.size(steps) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.size(steps)),
            lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, 1, i), "/")),
        )
    )
    return F.array_distinct(F.concat(hosts, paths))


def validity(events: DataFrame) -> DataFrame:
    """Intervals [valid_from, valid_to) per list_name, verdict and value from dated events.

    ``events`` has list_name, verdict ('block' or 'allow'), value, action ('add' or 'remove') and dated
    (timestamp); other columns are ignored, as are events with a null among these or another action or verdict.
    Values are matched in lower case up to their first slash, without closing slashes. Events at the same time
    collapse into one, and an add then wins over a remove. Adding an active entry or removing an absent one
    changes nothing; an entry that is never removed is valid for ever. Repeated events are one.
    """
    host = F.lower(F.regexp_extract("value", r"^\s*([^/\s]*)", 1))
    rest = F.regexp_extract("value", r"^\s*[^/\s]*(/.*)", 1)
    path = F.regexp_replace(F.regexp_replace(rest, r"/+", "/"), r"[/\s]+$", "")
    clean = events.select(
        "list_name", "verdict", F.concat(host, path).alias("value"), F.col("dated").cast("timestamp").alias("dated"),
        (F.col("action") == "add").alias("added"), "action",
    ).filter("list_name is not null and value != '' and dated is not null and verdict in ('block', 'allow') and action in ('add', 'remove')")
    entry = ["list_name", "verdict", "value"]
    states = clean.groupBy(*entry, "dated").agg(F.max("added").alias("added"))
    # a history is that of one entry of one list: the events of its dates, not of its captures
    order = Window.partitionBy(*entry).orderBy("dated")
    states = states.withColumn("was", F.lag("added").over(order)).filter("added != coalesce(was, false)")
    closed = states.withColumn("valid_to", F.coalesce(F.lead("dated").over(order), F.lit(FOREVER).cast("timestamp")))
    return closed.filter("added").select(*entry, F.col("dated").alias("valid_from"), "valid_to")


def judge(captures: DataFrame, events: DataFrame) -> DataFrame:
    """capture_id, blocked, n_entries, lists and verdict_value for every capture: a row for every row given.

    ``captures`` has capture_id, url and fetched_at (timestamp); other columns are ignored. The longest active
    value decides; if a block and an allow entry are equally long, the allow entry does. n_entries counts the
    active entries that cover the capture, lists has the sorted names of their lists, verdict_value the value
    that decided. A capture without a host or a fetch time, or which no active entry covers, isn't blocked and
    has 0 entries, an empty array and null. Captures of one capture_id, null included, are judged each by its own
    URL and time; equal rows are judged once and come back as often as they were given.

    A frequent host makes a frequent join key. Spark broadcasts the intervals where their measured size allows
    it, and a capture's values then never leave its task until they are one row again. Beyond that size it is a
    sort-merge join, whose frequent keys adaptive execution splits; nothing in the plan needs a key's rows in
    one place.
    """
    capture = ["capture_id", "url", "fetched_at"]
    captures = captures.select("capture_id", "url", F.col("fetched_at").cast("timestamp").alias("fetched_at"))
    captures = captures.groupBy(*capture).agg(F.count(F.lit(1)).alias("n_rows"))
    values = lookup_values(url_host(F.col("url")), url_path(F.col("url")))
    keyed = captures.select(*capture, "n_rows", F.explode_outer(values).alias("looked_up"))
    active = validity(events)
    at_fetch = (
        (F.col("looked_up") == F.col("value"))
        & (F.col("fetched_at") >= F.col("valid_from"))
        & (F.col("fetched_at") < F.col("valid_to"))
    )
    rank = F.struct(F.length("value").alias("size"), (F.col("verdict") == "allow").alias("allow"), F.col("value").alias("value"))
    found = (
        keyed.join(active, at_fetch, "left")
        .groupBy(*capture)
        .agg(
            F.max("n_rows").alias("n_rows"),
            F.count("value").alias("n_entries"),
            F.array_sort(F.collect_set("list_name")).alias("lists"),
            F.max(F.when(F.col("value").isNotNull(), rank)).alias("top"),
        )
    )
    each = found.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))))
    return each.select(
        "capture_id",
        F.coalesce(~F.col("top.allow"), F.lit(False)).alias("blocked"),
        "n_entries",
        "lists",
        F.col("top.value").alias("verdict_value"),
    )
