"""Hosts: policies by suffix, refusals and cool-offs, rate slots, bot walls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from scholarlake.functions import urls

#: Cool-off in seconds after the first, second and any later refusal (fixed values).
LADDER = (900, 6 * 3600, 48 * 3600)
WINDOW_SECONDS = 7 * 24 * 3600
SMALL_BODY = 4096
#: Statuses that a refusal may have (fixed values).
REFUSAL_STATUSES = (202, 403, 503)
#: Texts of refusal pages (fixed values).
REFUSAL_MARKERS = ("access denied", "attention required", "cf-browser-verification", "just a moment", "unusual traffic", "pardon our interruption", "request unsuccessful. incapsula", "you have been blocked", "enable javascript and cookies to continue")
#: Texts of bot walls, never of prose (fixed values).
CHALLENGE_MARKERS = ("attention required", "cf-browser-verification", "just a moment", "pardon our interruption", "request unsuccessful. incapsula", "you have been blocked", "enable javascript and cookies to continue", "checking your browser before accessing", "/cdn-cgi/challenge-platform", "_incapsula_resource", "validate.perfdrive.com", "radware bot manager", "px-captcha", "/_px/")


def with_policy(df: DataFrame, host: str, policies: DataFrame, key: list[str]) -> DataFrame:
    """Each row with the policy of its most specific dotted suffix; ``key``
    names the row.  An equi-join on exploded suffixes, no pattern join."""
    each = df.select(*key, F.posexplode(urls.suffixes(F.col(host))).alias("depth", "suffix"))
    hit = each.join(policies.withColumnRenamed("host", "suffix"), "suffix")
    values = [c for c in policies.columns if c != "host"]
    best = hit.groupBy(*key).agg(F.min_by(F.struct(F.col("suffix"), *values), "depth").alias("p"))
    return df.join(best.select(*key, F.col("p.suffix").alias("policy_host"), *[F.col(f"p.{v}").alias(v) for v in values]), key, "left")


def refusal_ladder(refusals: DataFrame, window: int = WINDOW_SECONDS, ladder: tuple[int, ...] = LADDER) -> DataFrame:
    """For each refusal (``host``, ``at`` in seconds): refusals of the trailing
    window, the cool-off, the time until which the host is blocked, and whether
    it was free before."""
    w = Window.partitionBy("host").orderBy("at")
    n = F.count("*").over(w.rangeBetween(-window, 0))
    step = F.element_at(F.array(*[F.lit(float(x)) for x in ladder]), F.least(n, F.lit(len(ladder))).cast("int"))
    out = refusals.select("host", F.col("at").cast("double").alias("at")).withColumn("recent", n).withColumn("cooloff", step)
    until = F.max(F.col("at") + F.col("cooloff"))
    out = out.withColumn("blocked_until", until.over(w.rowsBetween(Window.unboundedPreceding, 0)))
    before = F.max(F.col("at") + F.col("cooloff")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return out.withColumn("newly", F.coalesce(before <= F.col("at"), F.lit(True)))


def rate_slots(arrivals: DataFrame, interval: Column) -> DataFrame:
    """Start of each request (``host``, ``at``, ``seq``) when starts of a host
    are ``interval`` apart: the closed form of the running recurrence."""
    w = Window.partitionBy("host").orderBy("at", "seq")
    nth = F.row_number().over(w) * interval
    numbered = arrivals.withColumn("nth", nth)
    lag = F.max(F.col("at") - F.col("nth")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return numbered.withColumn("start", F.round(F.col("nth") + lag, 6)).withColumn("wait", F.round(F.col("start") - F.col("at"), 6)).drop("nth")


#: Seconds for which a bot wall keeps a host off; it does not climb the ladder (fixed value).
CHALLENGE_SECONDS = 3600


def block_states(ladder: DataFrame, challenges: DataFrame, denied: list[str], as_of: Column, since: Column | None = None) -> DataFrame:
    """Hosts that are off at a time and why: denied, else challenge, else refusal,
    until when, and from when on the block has stood; with ``since`` only those blocked
    from then on.  ``challenges`` holds ``host at``."""
    refused = ladder.where(F.col("at") <= as_of).groupBy("host").agg(F.max("blocked_until").alias("until"), F.max_by("at", F.when(F.col("newly"), F.col("at"))).alias("blocked_at"))
    walled = challenges.where(F.col("at") <= as_of).groupBy("host").agg((F.max("at") + CHALLENGE_SECONDS).alias("until"), F.max("at").alias("blocked_at"))
    both = refused.select("host", "until", "blocked_at", F.lit(2).alias("o")).unionByName(walled.select("host", "until", "blocked_at", F.lit(1).alias("o"))).where(F.col("until") > as_of)
    off = urls.under(F.col("host"), denied) if denied else F.lit(False)
    both = both.withColumn("o", F.when(off, 0).otherwise(F.col("o")))
    first = both.groupBy("host").agg(F.min_by(F.struct("o", "until", "blocked_at"), "o").alias("b"))
    state = F.element_at(F.array(F.lit("denied"), F.lit("challenge"), F.lit("refusal")), F.col("b.o") + 1)
    out = first.select("host", state.alias("state"), F.col("b.until").alias("until"), F.col("b.blocked_at").alias("blocked_at"))
    return out if since is None else out.where(F.col("blocked_at") >= since)


def blocked(ladder: DataFrame, as_of: Column) -> DataFrame:
    """The hosts that are blocked at a time."""
    return ladder.where(F.col("at") <= as_of).groupBy("host").agg(F.max("blocked_until").alias("blocked_until")).where(F.col("blocked_until") > as_of)


def _holds(body: Column, markers: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for m in markers:
        found = found | body.contains(m)
    return found


def response_kind(status: Column, final_url: Column, headers: Column, body: Column, api_hosts: tuple[str, ...] = (), walled_hosts: tuple[str, ...] = ()) -> Column:
    """challenge, refusal or null: a bot wall by header, text or host; a refusal
    by status and a small or telling body, but never of an API."""
    low = F.lower(F.substring(F.coalesce(body, F.lit("")), 1, 65536))
    named = F.transform_keys(headers, lambda k, v: F.lower(k))
    by_header = (F.lower(F.try_element_at(named, F.lit("cf-mitigated"))) == "challenge") | (F.lower(F.try_element_at(named, F.lit("x-datadome"))) == "protected")
    where = urls.host(final_url)
    wall = F.coalesce(by_header, F.lit(False)) | _holds(low, CHALLENGE_MARKERS)
    if walled_hosts:
        wall = wall | urls.under(where, walled_hosts)
    small = F.length(F.trim(low)) == 0
    refused = status.isin(*REFUSAL_STATUSES) & (small | (F.octet_length(F.coalesce(body, F.lit(""))) < SMALL_BODY) | _holds(low, REFUSAL_MARKERS))
    if api_hosts:
        refused = refused & ~urls.under(where, api_hosts)
    return F.when(wall, "challenge").when(F.coalesce(refused, F.lit(False)), "refusal")
