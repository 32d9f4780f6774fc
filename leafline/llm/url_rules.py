"""Allow and block rules on urls, by a range join over sorted keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafline.llm.text import ascii_lower
from leafline.session import materialize

#: prefixes in one range, at least; the ranges are never more than MAX_RANGES
RANGE_PREFIXES, MAX_RANGES = 5_000, 1_000
#: keys that one sweep sorts
SWEEP_KEYS = 100_000
#: between a reversed host and a path; a reversed host ends with a dot
JOINT = "\u0001"
#: a host or address that more than one in so many rows have is crowded
CROWDED = 1_000


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host in lower case, path). Both are empty for null or without `://`."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    return ascii_lower(part(1)), part(2)


def host_key(host: Column) -> Column:
    """Reversed labels, each with a dot: `a.net` gives `net.a.`, which begins the
    keys of its subdomains and of no other host. No host gives the empty key."""
    return F.when(host == "", "").otherwise(F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit(".")))


def _range_of(key: Column, cuts: list[str]) -> Column:
    """How many of the sorted `cuts` are at most `key`, by binary search."""
    if not cuts:
        return F.lit(0)
    at = F.array(*[F.lit(c) for c in cuts])
    span = lambda lo, hi: F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))

    def step(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        return F.when(s["lo"] >= s["hi"], s).otherwise(
            F.when(F.get(at, mid) <= key, span(mid + 1, s["hi"])).otherwise(span(s["lo"], mid))
        )

    rounds = F.array(*[F.lit(i) for i in range(len(cuts).bit_length() + 1)])
    return F.aggregate(rounds, span(F.lit(0), F.lit(len(cuts))), step, lambda s: s["lo"])


def cover(points: DataFrame, prefixes: DataFrame, range_prefixes: int = RANGE_PREFIXES, sweep_keys: int = SWEEP_KEYS) -> DataFrame:
    """For each row of `points` (key) the prefixes that begin its key: column
    `stack`, array of (prefix, info), the longest last. `prefixes` (prefix, info)
    has each prefix once.

    A prefix is the interval of all keys that begin with it, and such intervals
    nest or are apart. Points and prefixes are sorted together; a prefix enters
    with the stack of those around it, and each point takes the stack of the
    last prefix before it, less those that have closed. Ranges of the key space
    are swept apart; a range with many points is dealt to several sweeps, each
    with a copy of the range's few prefixes. So neither a crowded host nor a
    large set of rules meets in one task.
    """
    around = prefixes.select(F.col("prefix").alias("__outer"), F.struct("prefix", "info").alias("__item"))
    inner = (
        prefixes.select("prefix", F.explode(F.sequence(F.lit(0), F.length("prefix"))).alias("__n"))
        .select("prefix", F.expr("substring(prefix, 1, __n)").alias("__outer"))
        .join(around, "__outer")
        .groupBy("prefix")
        .agg(F.array_sort(F.collect_list("__item")).alias("stack"))
    )
    stacks = materialize(inner, "rule-stacks")
    n = stacks.count()
    step = max(range_prefixes, -(-n // MAX_RANGES))
    # every step-th prefix by its hash: about n / step of them, MAX_RANGES at most on average
    chosen = stacks.where(F.pmod(F.xxhash64("prefix"), F.lit(step)) == 0) if n > step else stacks.limit(0)
    cuts = sorted(r["prefix"] for r in chosen.select("prefix").collect())
    points = points.withColumn("__range", _range_of(F.col("key"), cuts))
    counted = {r["__range"]: r["n"] for r in points.groupBy("__range").agg(F.count("*").alias("n")).collect()}
    # how many sweeps each range has: MAX_RANGES + 1 numbers
    number = F.array(*[F.lit(-(-counted.get(i, 0) // sweep_keys)) for i in range(len(cuts) + 1)])
    left = points.withColumn("__sweeps", F.get(number, F.col("__range"))).select(
        "__range", F.pmod(F.xxhash64("key"), F.col("__sweeps")).cast("int").alias("__sweep"), "key", F.lit(1).alias("__kind"),
        F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"),
    )
    right = stacks.withColumn("__range", _range_of(F.col("prefix"), cuts)).withColumn("__sweeps", F.get(number, F.col("__range")))
    right = right.where("__sweeps > 0").select(
        "__range", F.explode(F.sequence(F.lit(0), F.col("__sweeps") - 1)).alias("__sweep"), F.col("prefix").alias("key"),
        F.lit(0).alias("__kind"), "stack",
    )
    sweep = Window.partitionBy("__range", "__sweep").orderBy("key", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = left.unionByName(right).withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("__kind = 1")
    still_open = F.filter("stack", lambda s: F.startswith(F.col("key"), s["prefix"]))
    return swept.select("key", F.coalesce(still_open, F.expr("filter(array(stack[0]), s -> false)")).alias("stack"))


def _crowded(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of `counts` (keys, __n) that more than one in CROWDED rows have: fewer than CROWDED."""
    total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    return counts.where(F.col("__n") * CROWDED > total).select(*keys)


def _found(rows: DataFrame, side: DataFrame, keys: list[str], value: str, crowded: DataFrame) -> DataFrame:
    """`rows` with the `value` that `side`, one row for each of its keys, has for theirs, or
    null. Values of crowded keys go to the rows, which are then dealt out by their plain columns
    instead, so that no task gets all rows of such a key."""
    few = crowded.join(side, keys, "left").select(*keys, F.col(value).alias("__few"), F.lit(True).alias("__known"))
    plain = [c for c, kind in rows.dtypes if not kind.startswith(("array", "map", "struct", "variant"))]
    by_key = F.xxhash64(*keys)  # no constant: Spark would make it a filter, and deal rows out by `keys` alone
    salt = F.when(F.col("__known"), F.xxhash64(*[F.col(f"`{c}`") for c in plain])).otherwise(by_key)
    out = rows.join(F.broadcast(few), keys, "left").withColumn("__salt", salt)
    out = out.join(side.select(*keys, value, by_key.alias("__salt")), [*keys, "__salt"], "left")
    return out.withColumn(value, F.when(F.col("__known"), F.col("__few")).otherwise(F.col(value))).drop("__few", "__known", "__salt")


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", **sizes: int) -> DataFrame:
    """`pages` with host, path, rule and verdict, which replace columns of those
    names. A rule (host, path, verdict) fits its host and all subdomains where
    the url's path begins with the rule's; the longest host and path wins, then
    the longest host. Without a fitting rule, `rule` is null and `verdict` the
    default.

    A null url, or one without `://`, has an empty host and path. A rule without
    host fits every url; a null path is empty; of rules with equal host and path
    a blocking one holds. Repeated pages each come out; no rules or no pages
    give the defaults or nothing.

    Two sweeps: reversed hosts against the hosts of rules, then each page's path
    grafted on every rule host found, against the hosts and paths of rules.
    """
    host, path = url_parts(F.col(url))
    pages = pages.withColumns({"__host": host, "__path": path}).drop("host", "path", "rule", "verdict")
    pages = pages.withColumnsRenamed({"__host": "host", "__path": "path"})
    r_host = ascii_lower(F.coalesce(F.col("host"), F.lit("")))
    rules = (
        rules.select(r_host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # block is after allow
        .withColumn("__key", host_key(F.col("host")))
    )
    rules = materialize(rules, "rules")
    addresses = materialize(pages.groupBy("host", "path").agg(F.count("*").alias("__n")), "addresses")
    by_key = addresses.select("host", "path", host_key(F.col("host")).alias("__of"))
    keys = by_key.select(F.col("__of").alias("key")).distinct()
    hosts = rules.select(F.col("__key").alias("prefix")).distinct().withColumn("info", F.lit(0))
    by_host = materialize(cover(keys, hosts, **sizes).select(F.col("key").alias("__of"), F.col("stack.prefix").alias("__ats")), "by-host")
    large = _crowded(by_key.groupBy("__of").agg(F.count("*").alias("__n")), ["__of"])
    grafted = _found(by_key, by_host, ["__of"], "__ats", large).withColumn("__at", F.explode("__ats")).drop("__ats")
    grafted = grafted.withColumn("key", F.concat("__at", F.lit(JOINT), "path"))
    full = rules.select(
        F.concat("__key", F.lit(JOINT), "path").alias("prefix"),
        F.struct(
            F.length(F.concat("host", "path")).alias("length"), F.length("host").alias("host_length"),
            F.concat("host", "path").alias("rule"), "verdict",
        ).alias("info"),
    )
    grafted = materialize(grafted, "grafted")
    fits = cover(grafted.select("key").distinct(), full, **sizes)
    fits = fits.where(F.size("stack") > 0).select("key", F.element_at("stack", -1)["info"].alias("__best"))
    best = grafted.join(fits, "key").groupBy("host", "path").agg(F.max("__best").alias("__best"))
    best = materialize(best, "best-rules")
    frequent = _crowded(addresses, ["host", "path"])
    return (
        _found(pages, best, ["host", "path"], "__best", frequent)
        .withColumns({"rule": F.col("__best.rule"), "verdict": F.coalesce("__best.verdict", F.lit(default))})
        .drop("__best")
    )
