"""URL filtering against dated lists, in DataFrame and SQL functions only.

A list is a history of entries that were added and removed. Each entry's events become validity intervals
[from, until). A capture is looked up under all names that an entry can have for it (its host, each parent
domain, each path prefix), and the as-of join keeps the entries whose interval holds the day of the fetch. So a
verdict depends on the list as it was when the page was fetched, whatever it says today.

Verdicts are computed once per distinct URL and day. Events are first reduced to one per entry and day, so the
history of one entry is bounded by the calendar. A host with very many captures is a hot key on one side of the
join, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host(url: str | Column) -> Column:
    """Lower-case host of a URL; null if there is none."""
    found = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(found != "", found)


def intervals(entries: DataFrame) -> DataFrame:
    """(kind, pattern, category, from, until) of entries (kind, pattern, category, action, at).

    ``action`` is 'add' or 'remove', ``at`` a date. Of several events of an entry on one day an 'add' wins. Adding
    what is listed and removing what is not change nothing. An entry that is never removed has a null ``until``.
    Events with a null kind, pattern, action or date are passed over; a null category counts as ''.
    """
    daily = (
        entries.where("kind is not null and pattern is not null and at is not null and action in ('add', 'remove')")
        .groupBy("kind", F.lower("pattern").alias("pattern"), F.coalesce("category", F.lit("")).alias("category"), F.col("at").cast("date").alias("at"))
        .agg(F.max((F.col("action") == "add").cast("int")).alias("on"))
    )
    history = Window.partitionBy("kind", "pattern", "category").orderBy("at")
    changes = daily.withColumn("was", F.coalesce(F.lag("on").over(history), F.lit(0))).where("on <> was")
    return (
        changes.withColumn("until", F.lead("at").over(history)).where("on = 1")
        .select("kind", "pattern", "category", F.col("at").alias("from"), "until")
    )


def names(url: str = "url") -> Column:
    """All (kind, pattern) under which an entry may hold a URL: host, domains of two and more labels, path prefixes."""
    h = host(url)
    labels = F.split(h, r"\.")
    parts = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda p: p != "")
    one = F.array(F.struct(F.lit("host").alias("kind"), h.alias("pattern")))
    domains = F.when(F.size(labels) >= 2, F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")),
    ))
    prefixes = F.when(F.size(parts) >= 1, F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.struct(F.lit("prefix").alias("kind"), F.lower(F.concat(h, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/"))).alias("pattern")),
    ))
    empty = F.array().cast("array<struct<kind:string,pattern:string>>")
    return F.when(h.isNotNull(), F.concat(one, F.coalesce(domains, empty), F.coalesce(prefixes, empty)))


def evaluate(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``captures`` with host, blocked, n_entries, categories and listed_since as of each fetch.

    ``categories`` are the distinct categories of active entries in order, comma-joined; ``listed_since`` is the
    earliest start among them. A null or unusable URL and a null fetch date match no entry and are not blocked. All
    rows and columns of ``captures`` stay; columns with the names of the new ones are replaced.
    """
    new = ["host", "blocked", "n_entries", "categories", "listed_since"]
    base = captures.drop(*[c for c in new if c in captures.columns])
    day = F.col(fetched).cast("date")
    wanted = base.select(F.col(url).alias("_url"), day.alias("_day")).where("_url is not null and _day is not null").distinct()
    keys = wanted.withColumn("n", F.explode(names("_url"))).select("_url", "_day", "n.kind", "n.pattern")
    held = keys.join(intervals(entries), ["kind", "pattern"]).where("`from` <= _day and (until is null or _day < until)")
    verdicts = held.groupBy("_url", "_day").agg(
        F.count(F.lit(1)).alias("n_entries"), F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"),
        F.min("from").alias("listed_since"),
    )
    joined = base.join(verdicts, (F.col(url) == F.col("_url")) & (day == F.col("_day")), "left")
    return joined.select(
        *base.columns, host(url).alias("host"), F.col("n_entries").isNotNull().alias("blocked"),
        F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"), F.coalesce("categories", F.lit("")).alias("categories"), "listed_since",
    )
