"""status_badge in its three forms, as column functions and for SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OK, FAIL, WARN, RUNNING, UNKNOWN = "[ OK ]", "[FAIL]", "[WARN]", "[ .. ]", "[ ?? ]"
#: What each badge stands for.
WORDS = ((OK, ("ok", "pass", "passed", "success")), (FAIL, ("fail", "failed", "error")), (WARN, ("warn", "warning")), (RUNNING, ("running", "pending", "in_progress")))


def status_badge(status: Column) -> Column:
    low = F.lower(status)
    out = F.lit(UNKNOWN)
    for badge, words in reversed(WORDS):
        out = F.when(low.isin(*words), badge).otherwise(out)
    return F.when(status.isNull(), F.lit(None).cast("string")).otherwise(out)


def count_badge(errors: Column, warnings: Column, running: Column | None = None) -> Column:
    """Null if any argument is."""
    out = F.when(errors > 0, FAIL).when(warnings > 0, WARN).otherwise(OK)
    given = errors.isNotNull() & warnings.isNotNull()
    if running is not None:
        out = F.when(running, RUNNING).otherwise(out)
        given = given & running.isNotNull()
    return F.when(given, out)
