"""URL filter rules as a sort-merge range join (DataFrame functions only).

A rule names a host and the beginning of a path. It fits the host, its subdomains, and
every path that starts with the rule's. The longest fitting rule decides.

Canonical keys: the host's labels in reverse, a slash, and the path, as bytes. All keys that a
rule fits on one host then form one interval, from the rule's key up to that key
followed by byte 0xFF, which no UTF-8 text contains. A url is looked up under each of
its parent domains, so subdomains need no intervals of their own. Intervals are nested
or apart. Each rule gives two boundaries, and each boundary carries the stack of rules
that are active after it: at its start its ancestors and itself, at its end its
ancestors. Boundaries and urls are sorted together, and the last boundary before a url
carries the stack that is active there.

Scale: distinct (host, path) pairs are swept, not rows. The sweep is cut by rule host and,
within a host, into salted pieces of about ``ROWS_PER_SWEEP`` keys (or as many as the host has
boundaries, if these are more), each with its own copy of that host's boundaries, so a host or domain with a third of all urls is spread
over many tasks. Nothing is broadcast by hint.

Edge cases: a null url or one without ``://`` has an empty host and path; it is judged by a
rule on the empty host if there is one, else by the default. Repeated rules count once;
if their verdicts differ, ``block`` holds. Rules with a null host or path are ignored. Rules of
equal length: the one with the longer host wins. Repeated rows are each returned. With
no rules every url gets the default verdict. With no pages the result is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_SWEEP = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def canonical_key(host: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("/"), path).cast("binary")


def _boundaries(rules: DataFrame) -> DataFrame:
    """Two rows per rule: (rule_host, key, kind, stack)."""
    rules = (
        rules.select("host", "path", "verdict").dropna(subset=["host", "path"])
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # 'block' sorts after 'allow'
    )
    entry = F.struct(
        F.length("path").alias("depth"), F.concat("host", "path").alias("rule"), "verdict",
        F.length("host").alias("host_length"),
    )
    outer = rules.select(F.col("host").alias("o_host"), F.col("path").alias("o_path"), entry.alias("outer"))
    prefixes = rules.select(
        "host", "path",
        F.explode(F.transform(F.sequence(F.lit(0), F.length("path")), lambda n: F.substring("path", F.lit(1), n)))
        .alias("prefix"),
    )
    stacks = (
        prefixes.join(outer, (F.col("host") == F.col("o_host")) & (F.col("prefix") == F.col("o_path")))
        .groupBy("host", "path").agg(F.sort_array(F.collect_list("outer")).alias("stack"))
    )
    key = canonical_key(F.col("host"), F.col("path"))
    start = F.struct(key.alias("key"), F.lit(0).alias("kind"), F.col("stack").alias("stack"))
    end = F.struct(
        F.concat(key, F.unhex(F.lit("FF"))).alias("key"), F.lit(0).alias("kind"),
        F.slice("stack", F.lit(1), F.size("stack") - 1).alias("stack"),
    )
    return stacks.select(F.col("host").alias("rule_host"), F.explode(F.array(start, end)).alias("b")).select(
        "rule_host", "b.*"
    )


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` added.

    ``rules``: columns ``host``, ``path``, ``verdict`` (allow or block). Columns of ``pages`` with
    the name of an added one are replaced.
    """
    host, path = host_and_path(F.col(url))
    pages = pages.withColumns({"host": host, "path": path}).drop("rule", "verdict")
    bounds = _boundaries(rules)

    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    urls = pages.select("host", "path").distinct()
    points = urls.select("host", "path", F.explode(suffixes).alias("rule_host"))
    ruled = bounds.groupBy("rule_host").agg(F.count("*").alias("bounds"))
    # hosts without a rule drop out here; a piece is no smaller than the boundaries copied to it
    pieces = points.groupBy("rule_host").agg(F.count("*").alias("n")).join(ruled, "rule_host").select(
        "rule_host", F.ceil(F.col("n") / F.greatest(F.lit(ROWS_PER_SWEEP), "bounds")).cast("int").alias("pieces")
    )

    events = bounds.join(pieces, "rule_host").select(
        "rule_host", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), "key", "kind", "stack",
        F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"),
    )
    swept = points.join(pieces, "rule_host").select(
        "rule_host", F.pmod(F.xxhash64("host", "path"), F.col("pieces")).cast("int").alias("piece"),
        canonical_key(F.col("rule_host"), F.col("path")).alias("key"), F.lit(1).alias("kind"),
        F.lit(None).cast(bounds.schema["stack"].dataType).alias("stack"), "host", "path",
    )
    w = (
        Window.partitionBy("rule_host", "piece").orderBy("key", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    top = F.element_at("active", -1)
    verdicts = (
        events.unionByName(swept)
        # by piece as well, else the sweep would stay where the join put a host as a whole
        .repartition("rule_host", "piece")
        .withColumn("active", F.last("stack", ignorenulls=True).over(w))
        .where((F.col("kind") == 1) & (F.size("active") > 0))
        .select("host", "path", top.alias("top"))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("top.rule").alias("n"), "top.host_length", "top.rule", "top.verdict")).alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    return pages.join(verdicts, ["host", "path"], "left").withColumn(
        "verdict", F.coalesce("verdict", F.lit(default))
    )
