"""URL filters by a sort-merge range join of reversed-host keys, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.llm.common import Scratch
from docweave.session import read_table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OPEN, POINT, CLOSE = 0, 1, 2


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each closed by a dot (``org.example.``): a host's key begins
    with the key of every domain that it belongs to, and with no other host's."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")).cast("binary")


def _sweep(scratch: Scratch, name: str, points: DataFrame, intervals: DataFrame, every: bool) -> DataFrame:
    """``points`` (distinct rows with a binary ``key``) and ``found``: the payload of an interval that holds the point.

    An interval is a prefix (``key``, ``payload`` whose first field is the key; distinct keys): it opens at its key and closes
    at the key with a byte 0xFF, which no UTF-8 text holds. Intervals are nested, so the number of open ones is the height of a
    stack, and the slot at height ``l`` holds the last interval opened at that height. With ``every`` a
    point returns one row for each slot of its stack, otherwise one for the top; points in no interval return none.

    Events are range-partitioned by (key, kind, the point's columns), which splits a hot key's points, and written.
    The heights and slots with which a partition begins come from one row per partition and height.
    """
    cols = [c for c in points.columns if c != "key"]
    blank = [F.lit(None).cast(points.schema[c].dataType).alias(c) for c in cols]
    kind = intervals.schema["payload"].dataType
    events = (
        intervals.select("key", F.lit(OPEN).alias("kind"), F.lit(1).alias("step"), "payload", *blank)
        .unionByName(intervals.select(F.concat("key", F.unhex(F.lit("FF"))).alias("key"), F.lit(CLOSE).alias("kind"),
                                      F.lit(-1).alias("step"), F.lit(None).cast(kind).alias("payload"), *blank))
        .unionByName(points.select("key", F.lit(POINT).alias("kind"), F.lit(0).alias("step"), F.lit(None).cast(kind).alias("payload"), *cols)))
    order = ["key", "kind", *cols]
    placed = scratch.save(events.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), name)

    # height after each event: the steps of earlier partitions, and those before it in its own
    steps = placed.groupBy("part").agg(F.sum("step").alias("s"))
    before = steps.select("part", (F.sum("s").over(Window.orderBy("part")) - F.col("s")).alias("before"))
    upto = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    high = placed.join(F.broadcast(before), "part").withColumn("top", F.col("before") + F.sum("step").over(upto))
    high = high.filter((F.col("kind") != CLOSE) & (F.col("top") > 0))
    bottom = F.when((F.col("kind") == POINT) & F.lit(every), F.lit(1).cast("long")).otherwise(F.col("top"))
    slots = high.select("part", *order, "payload", F.explode(F.sequence(bottom, "top")).alias("slot"))

    # keys only grow, so the last interval opened in a slot is the largest
    opened = slots.groupBy("part", "slot").agg(F.max("payload").alias("p"))
    earlier = Window.partitionBy("slot").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = opened.select("part", "slot", F.max("p").over(earlier).alias("carried"))
    mine = Window.partitionBy("part", "slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = slots.withColumn("own", F.max("payload").over(mine)).filter(F.col("kind") == POINT)
    return held.join(carried, ["part", "slot"]).select(
        "key", *cols, F.coalesce("own", "carried").alias("found"))


def _clean(rules: DataFrame) -> DataFrame:
    """Rules that can fit: host in lower case, null path empty, ``block`` before ``allow`` where both stand."""
    host, path = F.translate("host", _UPPER, _LOWER), F.coalesce("path", F.lit(""))
    return rules.select(host.alias("host"), path.alias("path"), "verdict").filter(
        "host is not null and verdict is not null and (path = '' or startswith(path, '/'))").groupBy("host", "path").agg(
        F.max("verdict").alias("verdict"))


def rule_of(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, verdict`` of the distinct ``places`` (``host, path``) that some rule (``host, path, verdict``) fits."""
    scratch = Scratch(places.sparkSession, "url-filter")
    rules = scratch.save(_clean(rules).withColumn("domain", host_key(F.col("host"))), "rules")
    domains = rules.select(F.col("domain").alias("key")).distinct().withColumn("payload", F.struct("key"))
    hosts = places.select("host", "path").distinct().withColumn("key", host_key(F.col("host")))
    inside = _sweep(scratch, "hosts", hosts, domains, every=True)
    # a place stands once under each domain that has rules and that its host belongs to
    points = inside.select("host", "path", F.concat("found.key", F.col("path").cast("binary")).alias("key"))
    prefixes = rules.select(F.concat("domain", F.col("path").cast("binary")).alias("key"), F.concat("host", "path").alias("rule"),
                            F.char_length("host").alias("host_chars"), "verdict")
    prefixes = prefixes.select("key", F.struct("key", "rule", "host_chars", "verdict").alias("payload"))
    fits = _sweep(scratch, "paths", points, prefixes, every=False).select("host", "path", "found.*")
    best = F.max(F.struct(F.char_length("rule").alias("chars"), "host_chars", "rule", "verdict")).alias("b")
    return fits.groupBy("host", "path").agg(best).select("host", "path", "b.rule", "b.verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``id_col, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` has ``host, path, verdict`` (``allow`` or ``block``): a rule fits its host and all subdomains where the url's path begins
    with the rule's. The longest rule (characters of host and path, then of the host) wins; ``rule`` is its host and path, null
    where none fits, and the verdict is ``default`` then. Equal rules with two verdicts block. Rules without a host or verdict, and
    those whose path is neither empty nor begins with ``/``, fit nothing. A null path is empty.

    Null urls and urls without ``://`` have an empty host and path. Null ids and repeated rows return rows; other columns of ``pages``
    are ignored; an empty table gives none, and without rules every row gets ``default``. A url of any length is one key.

    Work is done once per distinct (host, path): both sides are sorted by reversed-host keys in which a rule is an interval, and
    swept with a stack of the open ones, first over hosts, then over paths under each domain found. No rule list goes to all tasks.
    """
    url = F.col(url_col)
    placed = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    found = rule_of(placed, rules)
    return placed.join(found, ["host", "path"], "left").select(
        id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def keep_allowed(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The rows of ``pages``, in all their columns, whose url is allowed (see ``judge_urls``)."""
    url = F.col(url_col)
    found = rule_of(pages.select(host_of(url).alias("host"), path_of(url).alias("path")), rules)
    named = found.filter(F.col("verdict") != default).select(F.col("host").alias("_rule_host"), F.col("path").alias("_rule_path"))
    fits = (host_of(url) == F.col("_rule_host")) & (path_of(url) == F.col("_rule_path"))
    return pages.join(named, fits, "left_anti" if default == "allow" else "left_semi")


#: (host, path, verdict)
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
         ("com", "/de/", "block")]


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("host", "path", "verdict")
    listed = F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in zip(fields, r))) for r in RULES))
    return judge_urls(read_table(spark, sf_dir, "pages"), spark.range(1).select(F.inline(listed)))


ORACLE_OP12 = f"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(h, p, v) AS (VALUES {", ".join(str(r) for r in RULES)}),
best AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM (SELECT DISTINCT host, path FROM u), r
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN best USING (host, path)
"""
