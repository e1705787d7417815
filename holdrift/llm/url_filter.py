"""URL filters whose lists change over time.

List entries are dated: an entry is added at one time and perhaps removed at another. Their
events become validity intervals, and an as-of join evaluates each capture (url, fetched)
against the entries that were active when it was fetched. An entry names a host, with all
hosts below it, or a host with the start of a path.

Of all matching entries the longest decides; of equally long ones, an allowing one.

Defined results: a capture without a url or host matches nothing, one without a time too. Events
without list, pattern or time are ignored. Repeated events count once; of an addition and a
removal at the same time the removal wins. Additions while an entry is active prolong it.
Repeated captures are judged one by one; ids are only passed on. Empty lists block nothing.
Extra columns of captures are kept, whatever their names; ``n_active``, ``decided_by`` and ``blocked`` of the
captures themselves are replaced.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdrift.llm.tables import small_side, stored

ADD, REMOVE = "add", "remove"
BLOCK, ALLOW = "block", "allow"
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; empty without one."""
    return F.coalesce(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit(""))


def keys_of(url: Column) -> Column:
    """Every pattern that could match a URL: its host, the hosts above, and host with path starts.

    example.org/a/b gives example.org, org, example.org/a and example.org/a/b.
    """
    def above(host):
        labels = F.split(host, r"\.")
        return F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))

    def starts(host, path):
        parts = F.filter(F.split(path, "/"), lambda p: p != "")
        numbers = F.when(F.size(parts) > 0, F.sequence(F.lit(1), F.size(parts))).otherwise(
            F.array().cast("array<int>"))
        return F.transform(numbers, lambda k: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, k), "/")))

    host, path = host_of(url), F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(above(host), starts(host, path))))


def validity_intervals(events: DataFrame) -> DataFrame:
    """(list, action, pattern, since, until) from events (list, action, pattern, event, happened).

    Events are reduced to one per time first, so a much repeated entry is no large group.
    ``until`` is null while the entry is still active.
    """
    known = events.where("list IS NOT NULL AND pattern IS NOT NULL AND happened IS NOT NULL").select(
        "list", "action", F.lower("pattern").alias("pattern"), "happened", (F.col("event") == REMOVE).alias("removes"))
    entry = ["list", "action", "pattern"]
    once = known.groupBy(*entry, "happened").agg(F.max("removes").alias("removes"))
    in_time = Window.partitionBy(*entry).orderBy("happened")
    return once.withColumn("until", F.lead("happened").over(in_time)).where("NOT removes").select(
        *entry, F.col("happened").alias("since"), "until")


def judged(captures: DataFrame, intervals: DataFrame) -> DataFrame:
    """Captures (url, fetched, ...) with n_active, decided_by and blocked.

    The captures meet the list by their distinct (key, time) pairs, so a hot host costs as many
    rows as it has times; the entries found come back to them as one small array per pair.
    """
    keyed = stored(captures.select(F.struct("*").alias("given"), F.monotonically_increasing_id().alias("capture")))
    pairs = keyed.select("capture", "given.fetched", F.explode(keys_of(F.col("given.url"))).alias("key"))
    asked = pairs.select("key", "fetched").distinct()
    side = small_side(stored(intervals))
    active = asked.join(side, (F.col("key") == F.col("pattern")) & (F.col("since") <= F.col("fetched")) & (
        F.col("until").isNull() | (F.col("fetched") < F.col("until")))).select(
        "key", "fetched", "list", "action").distinct()
    found = stored(active.groupBy("key", "fetched").agg(
        F.count("*").alias("n"), F.max(F.col("action") == ALLOW).alias("allows")))
    hits = pairs.join(small_side(found), ["key", "fetched"])
    strongest = F.struct(F.char_length("key").alias("size"), F.col("allows"), F.col("key"))
    verdict = hits.groupBy("capture").agg(
        F.sum("n").alias("n_active"), F.max(strongest).alias("strongest"))
    kept = [F.col("given").getField(name).alias(name) for name in captures.columns
            if name not in ("n_active", "decided_by", "blocked")]
    return keyed.join(verdict, "capture", "left").select(
        *kept, F.coalesce("n_active", F.lit(0)).alias("n_active"),
        F.col("strongest.key").alias("decided_by"),
        F.coalesce(~F.col("strongest.allows"), F.lit(False)).alias("blocked"))
