"""URL filters over time: dated list entries against captures, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratamart.llm.common import join_salted
from stratamart.staging import materialize

#: Equal slices of the whole time range that an as-of join is dealt out by; layout only.
SLICES = 256
#: Verdicts of list entries in order of strictness; where entries of one pattern share an instant, the strictest holds.
VERDICTS = ("clear", "allow", "block")
#: Kinds of patterns, the most specific last.
KINDS = ("domain", "host", "prefix")

_URL = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"


def host_of(url: str) -> Column:
    """Lower-case host of a URL, empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, _URL, 1)), F.lit(""))


def path_of(url: str) -> Column:
    """Path of a URL with exactly one slash in front and one at its end."""
    inner = F.regexp_replace(F.coalesce(F.regexp_extract(url, _URL, 2), F.lit("")), "^/+|/+$", "")
    return F.when(inner == "", F.lit("/")).otherwise(F.concat(F.lit("/"), inner, F.lit("/")))


def intervals(entries: DataFrame) -> DataFrame:
    """Dated entries (`kind`, `pattern`, `verdict`, `since`) -> validity intervals `key`, `verdict`, `since`, `until`.

    An entry holds until the next one of its pattern; `until` is null for the last. Entries with a null, an unknown kind
    or an unknown verdict are ignored, repeated ones count once. Patterns are lower-cased hosts; a prefix is a
    host and path and matches whole path segments. A pattern with many entries is cut into slices of time.
    """
    strictness = F.array_position(F.array(*map(F.lit, VERDICTS)), F.lower("verdict"))
    pattern = F.when(F.col("kind") == "prefix", F.concat(F.lower(F.substring_index("pattern", "/", 1)), path_of_pattern("pattern"))
                     ).otherwise(F.lower("pattern"))
    clean = (entries.where(F.col("kind").isin(*KINDS) & F.lower("verdict").isin(*VERDICTS) & F.col("pattern").isNotNull() & F.col("since").isNotNull())
             .select(F.concat_ws(":", "kind", pattern).alias("key"), "since", strictness.alias("_strict"))
             .groupBy("key", "since").agg(F.max("_strict").alias("_strict")))
    sliced = clean.withColumn("_slice", F.floor(_micros("since") / F.lit(_slice_width(clean))).cast("long"))
    within = Window.partitionBy("key", "_slice").orderBy("since")
    firsts = sliced.groupBy("key", "_slice").agg(F.min("since").alias("_first"))
    firsts = firsts.withColumn("_next", F.lead("_first").over(Window.partitionBy("key").orderBy("_slice"))).drop("_first")
    verdict = F.element_at(F.array(*map(F.lit, VERDICTS)), F.col("_strict").cast("int"))
    return (sliced.withColumn("_lead", F.lead("since").over(within)).join(firsts, ["key", "_slice"])
            .select("key", verdict.alias("verdict"), "since", F.coalesce("_lead", "_next").alias("until")))


def path_of_pattern(column: str) -> Column:
    inner = F.regexp_replace(F.regexp_replace(column, "^[^/]*", ""), "^/+|/+$", "")
    return F.when(inner == "", F.lit("/")).otherwise(F.concat(F.lit("/"), inner, F.lit("/")))


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def _slice_width(rows: DataFrame, column: str = "since") -> int:
    """Microseconds of a slice, from the first and last instant."""
    low, high = rows.agg(F.min(_micros(column)), F.max(_micros(column))).first()
    return max(1, ((high or 0) - (low or 0)) // SLICES + 1)


def keys_of(url: str, depth: int) -> Column:
    """Every list key that matches a URL: its host, the host and the domains above it, and its path prefixes of up to
    `depth` segments (the deepest that any listed prefix has)."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    deep = F.least(F.size(segments), F.lit(depth))
    prefixes = F.transform(F.sequence(F.lit(0), deep), lambda n: F.when(n == 0, F.concat(F.lit("prefix:"), host, F.lit("/"))).otherwise(
        F.concat(F.lit("prefix:"), host, F.lit("/"), F.array_join(F.slice(segments, 1, n), "/"), F.lit("/"))))
    return F.when(host != "", F.concat(domains, F.array(F.concat(F.lit("host:"), host)), prefixes)).otherwise(F.array().cast("array<string>"))


def as_of(asked: DataFrame, listed: DataFrame) -> DataFrame:
    """Distinct `key`, `at` -> those with the listed interval that is the latest begun by then and still holds.

    Each slice of time of a key is one unit: its instants and its intervals are sorted together and the last interval
    begun is carried on; what holds at the slice's begin is carried from the last earlier slice with an
    entry. So neither a key with many instants nor one with many entries is one task, and no pairs are made.
    """
    width = _slice_width(asked.select(F.col("at").alias("since")).union(listed.select("since")))
    interval = F.struct("since", "until", "verdict")
    begun = listed.select("key", F.col("since").alias("at"), F.lit(0).alias("_asks"), interval.alias("_interval"))
    none = F.lit(None).cast(begun.schema["_interval"].dataType)
    rows = begun.union(asked.select("key", "at", F.lit(1).alias("_asks"), none.alias("_interval"))).withColumn(
        "_slice", F.floor(_micros("at") / F.lit(width)).cast("long"))
    earlier = Window.partitionBy("key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("key", "_slice").agg(F.max("_interval").alias("_latest")).select(
        "key", "_slice", F.last("_latest", ignorenulls=True).over(earlier).alias("_carried"))
    upto = Window.partitionBy("key", "_slice").orderBy("at", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(carried, ["key", "_slice"]).withColumn("_now", F.coalesce(F.last("_interval", ignorenulls=True).over(upto), "_carried"))
    return joined.where((F.col("_asks") == 1) & F.col("_now").isNotNull()).select("key", "at", "_now.*")


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """The columns of `captures`, then `matched` (the most specific entry in force when the page was fetched), `verdict`,
    `valid_from`, `valid_until` and `kept` (false if that entry blocks).

    A listed path prefix is more specific than a host, and that than a domain; among equals the longest is. A cleared
    pattern is not in force. A null time, a null, empty or broken URL matches nothing and is kept; repeated rows
    are judged one by one; empty tables are allowed; columns of `captures` named like a result are replaced.
    """
    own = ("matched", "verdict", "valid_from", "valid_until", "kept", "_row")
    kept = [c for c in captures.columns if c not in own]
    stored = materialize(captures.select(*kept).withColumn("_row", F.monotonically_increasing_id()), "captures")
    listed = materialize(intervals(entries), "intervals")
    depth = listed.where("key like 'prefix:%'").agg(
        F.max(F.length("key") - F.length(F.replace(F.col("key"), F.lit("/"), F.lit(""))))).first()[0] or 1
    asked = stored.where(F.col(at).isNotNull()).select("_row", F.col(at).alias("at"), F.explode(keys_of(url, depth - 1)).alias("key"))
    # Keys that no list has are left out before anything is sorted; equal questions are asked once.
    asked = materialize(join_salted(asked, "key", "_row", listed.select("key", F.lit(True).alias("_listed")).distinct()).where("_listed").drop("_listed"), "asked")
    found = materialize(as_of(asked.select("key", "at").distinct(), listed).where("verdict != 'clear'"), "in_force")
    kind = F.array_position(F.array(*map(F.lit, KINDS)), F.substring_index("key", ":", 1))
    best = (join_salted(asked, ["key", "at"], "_row", found).where("verdict is not null")
            .groupBy("_row").agg(F.max_by(F.struct("key", "verdict", "since", "until"), F.struct(kind.alias("kind"), F.length("key").alias("length"), "key")).alias("_best")))
    return stored.join(best, "_row", "left").select(
        *kept, F.col("_best.key").alias("matched"), F.col("_best.verdict").alias("verdict"), F.col("_best.since").alias("valid_from"),
        F.col("_best.until").alias("valid_until"), F.coalesce(F.col("_best.verdict") != "block", F.lit(True)).alias("kept"))
