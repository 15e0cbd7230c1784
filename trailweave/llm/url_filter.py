"""URL filters by a temporal list join.

List entries are dated: a target (a domain or the beginning of a path below a host) is added to
or removed from a list on a day. Each target's history becomes validity intervals, and a capture
is judged by the entries that were valid when it was fetched.

A capture is looked up by equality under each target that could cover it: its host, the host's
parent domains and the beginnings of its path. Their number is bounded by the URL's length, so
no list is scanned for a capture. Intervals of a target do not overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, sent_if_small, write_table

_URL = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"


def targets_of(url: Column) -> Column:
    """Targets that can cover a URL, the most specific first: path beginnings, host, parent domains.

    A path beginning ends before a slash; hosts are lower-cased and lose a final dot.
    """
    url = F.coalesce(url, F.lit(""))
    host = F.rtrim(F.lower(F.regexp_extract(url, _URL, 1)), F.lit("."))
    path = F.filter(F.split(F.regexp_extract(url, _URL, 2), "/"), lambda s: s != "")
    labels = F.split(host, r"\.")
    n, m = F.size(labels), F.size(path)
    parents = F.transform(
        F.sequence(F.lit(1), n), lambda i: F.concat_ws(".", F.slice(labels, i, n - i + 1))
    )
    beginnings = F.transform(
        F.when(m > 0, F.sequence(m, F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat(host, F.lit("/"), F.concat_ws("/", F.slice(path, F.lit(1), i))),
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.concat(beginnings, parents))


def validity(entries: DataFrame) -> DataFrame:
    """Intervals (list, target, valid_from, valid_to) from dated entries (list, target, day, added).

    valid_to is exclusive, null while the entry stands. A later entry of the target ends an
    earlier one; of entries of one day the removal counts. Entries without list, target, day or
    `added` are left out.
    """
    dated = entries.dropna(subset=["list", "target", "day", "added"])
    daily = dated.groupBy("list", "target", "day").agg(F.min("added").alias("added"))
    history = Window.partitionBy("list", "target").orderBy("day")
    spans = daily.withColumn("valid_to", F.lead("day").over(history))
    return spans.where("added").select("list", "target", F.col("day").alias("valid_from"), "valid_to")


def filtered(captures: DataFrame, entries: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per capture: `key`, url, fetched, blocked, n_entries, target, lists.

    captures: `key`, url, fetched (date). n_entries counts the valid entries that cover the
    capture, `target` is the most specific covered target and `lists` the sorted lists that have
    a valid entry; null and empty if nothing covers it. A null fetch day or a URL without host is
    covered by nothing. Repeated rows count each for themselves. Other columns are not read.
    """
    spans = sent_if_small(write_table(validity(entries), "spans"))
    targets = fresh("targets")
    own = captures.select(key, "url", "fetched").withColumn(targets, targets_of(F.col("url")))
    # equal captures have equal answers: each is looked up once
    asked = own.select("url", "fetched", targets).where(F.col("fetched").isNotNull()).distinct()
    asked = asked.select("url", "fetched", F.posexplode(targets).alias("rank", "target"))
    valid = (F.col("valid_from") <= F.col("fetched")) & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    hits = asked.join(spans, "target").where(valid)
    found = hits.groupBy("url", "fetched").agg(
        F.count("*").alias("n_entries"), F.min_by("target", "rank").alias("target"),
        F.array_sort(F.collect_set("list")).alias("lists"),
    )
    out = own.drop(targets).join(found, ["url", "fetched"], "left")
    return out.select(
        key, "url", "fetched", F.col("n_entries").isNotNull().alias("blocked"),
        F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"), "target",
        F.coalesce("lists", F.array().cast("array<string>")).alias("lists"),
    )
