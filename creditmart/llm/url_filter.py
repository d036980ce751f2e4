"""Dated URL lists applied to captures as they stood when each page was fetched.

A list entry is dated: a pattern is added to or removed from a list on a day. The entries of a
pattern become validity intervals [from, until). A capture is judged by the last interval of each
pattern that covers its URL and began no later than its fetch day (an as-of join): the list counts
if that interval had not ended.

Patterns are domains (``b.example`` covers that host and all below it) or a host with leading path
segments (``a.b.example/x/y``). A URL is expanded to the patterns that could cover it, no deeper
than the lists are. The as-of search runs on distinct (pattern, day) marks, so a host with a third
of all captures is as many marks as there are days; its captures meet the outcome in equi-joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart.llm.common import cut, free_name

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host(url: str) -> Column:
    """Host in lower case without user, port and a final dot; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.+$", "")


def covering(url: str, labels: int, segments: int) -> Column:
    """Patterns of up to ``labels`` host labels or ``segments`` path segments that cover a URL."""
    parts = F.split(host(url), r"\.")
    n = F.size(parts)
    domains = F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(labels))), lambda k: F.array_join(F.slice(parts, n - k + 1, k), "."))
    steps = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda s: s != "")
    m = F.least(F.size(steps), F.lit(segments))
    paths = F.when(m > 0, F.transform(
        F.sequence(F.lit(1), m), lambda k: F.concat(host(url), F.lit("/"), F.array_join(F.slice(steps, 1, k), "/"))))
    whole = F.array(host(url))  # also for hosts of more labels than any listed domain
    return F.when(host(url) != "", F.array_distinct(F.concat(domains, whole, F.coalesce(paths, F.array().cast("array<string>")))))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_until) from entries (list, pattern, action, day).

    ``action`` is add or remove. Entries with a null or another action are left aside; repeats and
    actions that change nothing are folded; of an add and a remove on one day the add counts. An
    interval that never ends has a null ``valid_until``.
    """
    clean = entries.where(
        F.col("action").isin("add", "remove") & F.col("list").isNotNull() & F.col("pattern").isNotNull() & F.col("day").isNotNull())
    states = clean.groupBy("list", "pattern", "day").agg(F.max((F.col("action") == "add").cast("int")).alias("on"))
    order = Window.partitionBy("list", "pattern").orderBy("day")  # no more rows than days
    turns = states.withColumn("before", F.lag("on", 1, 0).over(order)).where("on != before")
    ends = turns.withColumn("valid_until", F.lead("day").over(order))
    return ends.where("on = 1").select("list", "pattern", F.col("day").alias("valid_from"), "valid_until")


def judge(
    captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "fetched_on",
    names: tuple[str, str, str] = ("blocked", "lists", "rule"),
) -> DataFrame:
    """Add blocked, lists and rule to every capture.

    ``lists`` are the lists (sorted) with a pattern that covers the URL and was valid on the fetch
    day, ``rule`` the longest such pattern (of equal ones the last by name). A null or hostless URL and
    a null day match nothing: not blocked, no lists, null rule. Repeated rows come out alike; all
    other columns stay, save that columns named like results are replaced. Empty tables are fine.
    """
    valid = cut(intervals(entries))
    pattern = F.col("pattern")
    deep = valid.agg(
        F.max(F.size(F.split(F.substring_index(pattern, "/", 1), r"\."))).alias("labels"),
        F.max(F.size(F.split(pattern, "/")) - 1).alias("segments")).first()  # one row
    asked = captures.select(F.col(url).alias("url"), F.col(day).alias("day")).where("url is not null and day is not null").distinct()
    asked = asked.select("url", "day", F.explode(covering("url", deep["labels"] or 1, deep["segments"] or 0)).alias("pattern"))
    listed = valid.select("pattern", "list").distinct()
    marks = asked.select("pattern", "day").distinct().join(listed, "pattern").select(
        "list", "pattern", "day", F.lit(None).cast("struct<f:date,u:date>").alias("valid"), F.lit(1).alias("asked"))
    starts = valid.select(
        "list", "pattern", F.col("valid_from").alias("day"),
        F.struct(F.col("valid_from").alias("f"), F.col("valid_until").alias("u")).alias("valid"), F.lit(0).alias("asked"))
    as_of = Window.partitionBy("list", "pattern").orderBy("day", "asked").rowsBetween(Window.unboundedPreceding, 0)
    last = marks.unionByName(starts).withColumn("valid", F.last("valid", ignorenulls=True).over(as_of))
    active = last.where("asked = 1 and valid is not null and (valid.u is null or day < valid.u)").groupBy("pattern", "day").agg(
        F.collect_set("list").alias("some"))
    verdict = (
        asked.join(active, ["pattern", "day"]).groupBy("url", "day").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("some")))).alias("some"),
            F.max(F.struct(F.length("pattern").alias("n"), F.col("pattern").alias("p"))).alias("best")))
    work = free_name(captures, "_judged")
    verdict = verdict.select(*(F.col(c).alias(f"{work}_{c}") for c in ("url", "day", "some", "best")))
    out = captures.join(verdict, (F.col(url) == F.col(f"{work}_url")) & (F.col(day) == F.col(f"{work}_day")), "left")
    blocked, lists, rule = names
    return (
        out.withColumn(blocked, F.col(f"{work}_some").isNotNull())
        .withColumn(lists, F.coalesce(f"{work}_some", F.array().cast("array<string>")))
        .withColumn(rule, F.col(f"{work}_best.p")).drop(*(f"{work}_{c}" for c in ("url", "day", "some", "best"))))
