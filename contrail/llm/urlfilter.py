"""URL filters by a temporal list join: every capture meets the list as it stood when it was fetched.

List entries are dated additions and removals of domains under a category. Each addition becomes a
validity interval that ends at the next entry for the same domain and category; an entry for a domain
covers its subdomains. The as-of join evaluates the distinct (host, day) pairs of the captures, not the
captures: pairs are reduced map-side, joined with the intervals on host suffix and date range, and the
verdicts joined back. A host with a third of all captures is one pair a day. The list and the verdicts are written before
their joins, which then stand alone, so that Spark can split a suffix of very many hosts and a (host, day) of very many captures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import stash

FOREVER = "9999-12-31"


def intervals(entries: DataFrame) -> DataFrame:
    """(domain, category, action, day) -> (domain, category, valid_from, valid_to), end exclusive.

    ``action`` is ``add`` or ``remove``. Domains are compared in lower case. Repeated entries count once;
    an addition and a removal on one day leave the domain listed; an addition to what is listed already
    starts a new interval. Entries with a null domain or day, or another action, are left out; a null
    category is a category of its own. There is at most one entry a day for each domain and category.
    """
    daily = (entries.select(F.lower("domain").alias("domain"), F.col("category").alias("category"), F.to_date("day").alias("day"),
                            F.col("action").alias("action"))
             .filter("domain is not null and day is not null and action in ('add', 'remove')")
             .groupBy("domain", "category", "day").agg(F.min("action").alias("action")))  # 'add' sorts first
    following = F.lead("day").over(Window.partitionBy("domain", "category").orderBy("day"))
    return (daily.withColumn("valid_to", F.coalesce(following, F.lit(FOREVER).cast("date"))).filter("action = 'add'")
            .select("domain", "category", F.col("day").alias("valid_from"), "valid_to"))


def host_of(url: Column) -> Column:
    """Host of an absolute URL in lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def evaluate(captures: DataFrame, listed: DataFrame, keep: list[str]) -> DataFrame:
    """Adds the verdict to captures with ``url`` and ``fetched`` (a date): columns ``keep`` and

    host, n_active (list entries in force that cover the host), blocked, and domain, category and
    valid_from of the entry that decides: the most specific domain, then the latest, then the first
    category. Every capture has one row; a null or relative URL, or a null date, is never blocked.
    ``keep`` must not name a verdict column. ``listed`` is as intervals() returns it.
    """
    rows = captures.select(*keep, host_of(F.col("url")).alias("host"), F.to_date("fetched").alias("__day"))
    labels = F.split("host", r"\.")
    pairs = rows.select("host", F.col("__day").alias("day")).filter("host <> '' and day is not null").distinct()
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    keys = pairs.select("host", "day", F.explode(suffixes).alias("domain"))
    in_force = (F.col("valid_from") <= F.col("day")) & (F.col("day") < F.col("valid_to"))
    met = keys.join(stash(listed, "intervals"), "domain").filter(in_force)
    order = F.struct((-F.length("domain")).alias("l"), F.datediff(F.lit(FOREVER).cast("date"), "valid_from").alias("age"),
                     F.coalesce("category", F.lit("")).alias("c"))
    entry = F.struct("domain", "category", "valid_from")
    verdict = met.groupBy("host", "day").agg(F.count("*").alias("n_active"), F.min_by(entry, order).alias("e"))
    verdict = stash(verdict, "verdicts")
    same = (F.col("host") == F.col("__host")) & (F.col("__day") == F.col("day"))
    joined = rows.join(verdict.withColumnRenamed("host", "__host"), same, "left")
    return joined.select(*keep, "host", F.coalesce("n_active", F.lit(0)).cast("bigint").alias("n_active"),
                         F.col("n_active").isNotNull().alias("blocked"), F.col("e.domain").alias("domain"),
                         F.col("e.category").alias("category"), F.col("e.valid_from").alias("valid_from"))
