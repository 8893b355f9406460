"""The analytic suites over an event table, each as DataFrame -> DataFrame.

Expected columns: pattern, root_cause, build, env, file_index, event_id, status, message, tool_name. `from_events`
makes them from parsed events whose log_file tells build and environment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.patterns import build_id, environment, root_cause


def from_events(events: DataFrame) -> DataFrame:
    """file_index counts the files by name; the numbering runs over the distinct files only."""
    files = events.select("log_file").distinct()
    files = files.withColumn("file_index", F.row_number().over(Window.orderBy("log_file")).cast("bigint"))
    return events.join(files, "log_file", "left").select(
        F.col("fingerprint").alias("pattern"), root_cause(F.col("message"), F.col("event_type")).alias("root_cause"), F.coalesce(build_id(F.col("log_file")), F.col("log_file")).alias("build"),
        environment(F.col("log_file")).alias("env"), "file_index", "event_id", "status", "severity", "message", "tool_name", "category",
    )


def co_occurrence(e: DataFrame, least: int = 2) -> DataFrame:
    """Pairs of patterns that meet in one build and environment.

    Distinct (pattern, build, env) first: a pattern's repeats in a build never multiply the join.
    """
    d = e.where("pattern is not null").select("pattern", "build", "env").distinct()
    pairs = d.alias("a").join(d.alias("b"), (F.col("a.build") == F.col("b.build")) & F.col("a.env").eqNullSafe(F.col("b.env")) & (F.col("a.pattern") < F.col("b.pattern")))
    out = pairs.groupBy(F.col("a.pattern").alias("pattern_a"), F.col("b.pattern").alias("pattern_b")).agg(F.count(F.lit(1)).alias("meetings"), F.countDistinct("a.build").alias("builds"), F.countDistinct("a.env").alias("envs"))
    out = out.where(F.col("meetings") >= least)
    strength = F.round(F.col("meetings") / (F.col("builds") + F.col("envs")), 4)
    return out.withColumn("strength", strength).withColumn("class", F.when(strength >= 0.8, "STRONG").when(strength >= 0.5, "MODERATE").otherwise("WEAK"))


def cascade(e: DataFrame, reach: int = 5, least: int = 2) -> DataFrame:
    """Ordered pairs of patterns at most `reach` events apart in one build: leads, not a band join."""
    w = Window.partitionBy("build").orderBy("file_index", "event_id")
    ahead = F.array(*[F.struct(F.lit(k).alias("gap"), F.lead("pattern", k).over(w).alias("next")) for k in range(1, reach + 1)])
    rows = e.where("pattern is not null").select(F.col("pattern").alias("first_pattern"), ahead.alias("x")).select("first_pattern", F.explode("x").alias("x")).where("x.next is not null and x.next <> first_pattern")
    out = rows.groupBy("first_pattern", F.col("x.next").alias("next_pattern")).agg(F.count(F.lit(1)).alias("times"), F.round(F.avg("x.gap"), 4).alias("mean_gap"))
    return out.where(F.col("times") >= least)


def propagation(e: DataFrame, envs: tuple = ("dev", "staging", "prod")) -> DataFrame:
    """For each pattern, its occurrences by environment and the class of its spread: one pivoted aggregate, no outer joins."""
    counted = e.where("pattern is not null").groupBy("pattern").agg(*[F.count(F.when(F.col("env") == x, 1)).alias(f"n_{x}") for x in envs], *[F.min(F.when(F.col("env") == x, F.col("file_index"))).alias(f"first_{x}") for x in envs])
    seen = F.concat_ws("+", *[F.when(F.col(f"n_{x}") > 0, x) for x in envs])
    return counted.withColumn("spread", F.when(seen == "", "other").otherwise(seen)).withColumn("delay", F.col(f"first_{envs[-1]}") - F.col(f"first_{envs[0]}"))


def root_cause_matrix(e: DataFrame) -> DataFrame:
    """Pairs of causes that meet in a build: 2 n / (builds of a + builds of b)."""
    d = e.select("root_cause", "build").distinct()
    totals = d.groupBy("root_cause").agg(F.count(F.lit(1)).alias("total"))
    both = d.alias("a").join(d.alias("b"), (F.col("a.build") == F.col("b.build")) & (F.col("a.root_cause") < F.col("b.root_cause"))).groupBy(F.col("a.root_cause").alias("cause_a"), F.col("b.root_cause").alias("cause_b")).agg(F.count(F.lit(1)).alias("n"))
    return (
        both.join(F.broadcast(totals).select(F.col("root_cause").alias("cause_a"), F.col("total").alias("ta")), "cause_a")
        .join(F.broadcast(totals).select(F.col("root_cause").alias("cause_b"), F.col("total").alias("tb")), "cause_b")
        .select("cause_a", "cause_b", "n", F.round(2 * F.col("n") / (F.col("ta") + F.col("tb")), 4).alias("coefficient"))
    )


def recurrence(e: DataFrame, least: int = 3) -> DataFrame:
    """Gaps between the files a pattern occurs in, and where it is due next."""
    d = e.where("pattern is not null").select("pattern", "file_index").distinct()
    gaps = d.withColumn("gap", F.col("file_index") - F.lag("file_index").over(Window.partitionBy("pattern").orderBy("file_index")))
    out = gaps.groupBy("pattern").agg(F.count(F.lit(1)).alias("files"), F.round(F.avg("gap"), 4).alias("mean_gap"), F.median("gap").alias("median_gap"), F.max("file_index").alias("last_file"))
    return out.where(F.col("files") >= least).withColumn("next_file", F.round(F.col("last_file") + F.col("mean_gap"), 4))


def environment_risk(e: DataFrame) -> DataFrame:
    """Weighted score and rank of environments."""
    out = e.groupBy("env").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("status") == "ERROR").alias("errors"), F.countDistinct("pattern").alias("patterns"), F.countDistinct("root_cause").alias("causes"),
    )
    score = F.round(100.0 * F.col("errors") / F.col("events") + 0.1 * F.col("patterns") + F.col("causes"), 4)
    return out.withColumn("score", score).withColumn("place", F.rank().over(Window.orderBy(F.col("score").desc())))


def frequency_trend(daily: DataFrame, day: str = "day", n: str = "n") -> DataFrame:
    """Changes against the day and the week before, rolling mean of seven rows. `daily` is one row a day."""
    w = Window.orderBy(day)
    return daily.select(day, n, (F.col(n) - F.lag(n, 1).over(w)).alias("change_1"), (F.col(n) - F.lag(n, 7).over(w)).alias("change_7"), F.round(F.avg(n).over(w.rowsBetween(-6, 0)), 4).alias("mean_7"))


def evolution(e: DataFrame) -> DataFrame:
    """Stability of a pattern over files: 1 - standard deviation over mean of its counts."""
    per = e.where("pattern is not null").groupBy("pattern", "file_index").agg(F.count(F.lit(1)).alias("n"))
    out = per.groupBy("pattern").agg(F.sum("n").alias("events"), F.min("file_index").alias("first_file"), F.max("file_index").alias("last_file"), F.avg("n").alias("m"), F.stddev_samp("n").alias("s"))
    return out.select("pattern", "events", "first_file", "last_file", F.round(F.greatest(F.lit(0.0), 1 - F.coalesce("s", F.lit(0.0)) / F.col("m")), 4).alias("stability"))


def overview(e: DataFrame) -> DataFrame:
    return e.agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("status").isin("ERROR", "FAIL")).alias("failures"), F.round(100.0 * F.count_if(F.col("status").isin("ERROR", "FAIL")) / F.count(F.lit(1)), 4).alias("failure_rate"),
        F.countDistinct("pattern").alias("patterns"), F.countDistinct("build").alias("builds"), F.countDistinct("env").alias("envs"),
    )


def top_patterns(e: DataFrame, n: int = 10) -> DataFrame:
    """The most frequent patterns with their first message."""
    return e.where("pattern is not null").groupBy("pattern").agg(F.count(F.lit(1)).alias("events"), F.min_by("message", F.struct("file_index", "event_id")).alias("first_message")).orderBy(F.col("events").desc(), "pattern").limit(n)


def root_cause_breakdown(e: DataFrame) -> DataFrame:
    counted = e.groupBy("root_cause").agg(F.count(F.lit(1)).alias("events"))
    return counted.withColumn("share", F.round(100.0 * F.col("events") / F.sum("events").over(Window.partitionBy(F.lit(1))), 4))


def quality_gate(e: DataFrame, *by: str) -> DataFrame:
    out = e.groupBy(*by).agg(F.count_if(F.col("status") == "ERROR").alias("errors"), F.count_if(F.col("status") == "WARNING").alias("warnings"))
    return out.withColumn("gate", F.when(F.col("errors") > 0, "FAIL").when(F.col("warnings") > 0, "WARN").otherwise("PASS"))


def _cut_point(e: DataFrame, share: float) -> DataFrame:
    """One row: the file index at `share` of the highest."""
    return e.agg((F.max("file_index") * share).alias("_cut"))


def deployment_readiness(e: DataFrame, recent: float = 0.3) -> DataFrame:
    """Failure rates of the last `recent` of files against all before, by environment."""
    late = F.col("file_index") > F.col("_cut")
    bad = F.col("status").isin("ERROR", "FAIL")
    rate = lambda test: F.round(100.0 * F.count_if(test & bad) / F.nullif(F.count_if(test), F.lit(0)), 4)
    out = e.join(F.broadcast(_cut_point(e, 1 - recent))).groupBy("env").agg(rate(late).alias("recent_rate"), rate(~late).alias("past_rate"), F.countDistinct(F.when(late & bad, F.col("pattern"))).alias("recent_patterns"))
    return out.withColumn("ready", F.when(F.col("recent_rate") <= F.coalesce("past_rate", F.lit(0.0)), "READY").when(F.col("recent_rate") <= 1.5 * F.col("past_rate"), "CAUTION").otherwise("NOT_READY"))


def anomalies(e: DataFrame, baseline: float = 0.7) -> DataFrame:
    """Events a file of each pattern in the first `baseline` of files, and behind."""
    late = F.col("file_index") > F.col("_cut")
    out = e.where("pattern is not null").join(F.broadcast(_cut_point(e, baseline))).groupBy("pattern").agg(
        F.count_if(~late).alias("base_events"), F.countDistinct(F.when(~late, F.col("file_index"))).alias("base_files"), F.count_if(late).alias("late_events"), F.countDistinct(F.when(late, F.col("file_index"))).alias("late_files"),
    )
    base = F.col("base_events") / F.nullif(F.col("base_files"), F.lit(0))
    now = F.col("late_events") / F.nullif(F.col("late_files"), F.lit(0))
    ratio = F.round(now / base, 4)
    kind = F.when(F.col("base_events") == 0, "NEW").when(F.col("late_events") == 0, "GONE").when(ratio >= 2, "SPIKE").when(ratio <= 0.5, "DROP").otherwise("NORMAL")
    return out.select("pattern", "base_events", "late_events", ratio.alias("ratio"), kind.alias("class"))


def cycles(e: DataFrame, at: str = "event_id", least: int = 3) -> DataFrame:
    """Gaps between a pattern's events by `at` (hours), and the cycle they are near to."""
    gaps = e.where("pattern is not null").withColumn("gap", F.col(at) - F.lag(at).over(Window.partitionBy("pattern").orderBy(at)))
    out = gaps.groupBy("pattern").agg(F.count("gap").alias("gaps"), F.round(F.avg("gap"), 4).alias("mean_gap")).where(F.col("gaps") >= least)
    m = F.col("mean_gap")
    return out.withColumn("cycle", F.when(m.between(20, 28), "DAILY").when(m.between(144, 192), "WEEKLY").when(m.between(600, 840), "MONTHLY").otherwise("REGULAR"))


def root_cause_trend(e: DataFrame, period: int = 10) -> DataFrame:
    """Counts by cause and period of files, rolling mean of three periods, direction against the period before."""
    counted = e.groupBy("root_cause", F.floor(F.col("file_index") / period).cast("bigint").alias("period")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("root_cause").orderBy("period")
    before = F.lag("n").over(w)
    return counted.select("root_cause", "period", "n", F.round(F.avg("n").over(w.rowsBetween(-2, 0)), 4).alias("mean_3"), F.when(before.isNull(), "NEW").when(F.col("n") > before, "UP").when(F.col("n") < before, "DOWN").otherwise("FLAT").alias("direction"))


def environment_health(e: DataFrame) -> DataFrame:
    bad = F.count_if(F.col("status").isin("ERROR", "FAIL"))
    rate = F.round(100.0 * bad / F.count(F.lit(1)), 4)
    out = e.groupBy("env").agg(F.count(F.lit(1)).alias("events"), bad.alias("failures"), rate.alias("failure_rate"))
    return out.withColumn("health", F.when(F.col("failure_rate") < 5, "HEALTHY").when(F.col("failure_rate") < 20, "WARNING").otherwise("CRITICAL"))


def action_items(e: DataFrame, n: int = 15) -> DataFrame:
    """The failing patterns that occur twice or more, most frequent first."""
    bad = e.where(F.col("status").isin("ERROR", "FAIL") & F.col("pattern").isNotNull())
    return bad.groupBy("pattern").agg(F.count(F.lit(1)).alias("events"), F.countDistinct("env").alias("envs"), F.min_by("message", F.struct("file_index", "event_id")).alias("first_message")).where("events >= 2").orderBy(F.col("events").desc(), "pattern").limit(n)


def quality_by_tool(e: DataFrame, by: str = "tool_name", least: int = 3) -> DataFrame:
    out = e.groupBy(by).agg(F.count(F.lit(1)).alias("events"), F.round(100.0 * F.count_if(~F.col("status").isin("ERROR", "FAIL")) / F.count(F.lit(1)), 4).alias("quality"))
    return out.where(F.col("events") >= least)
