"""State over streams of logs: section heads and half lines carried from batch to batch, and running numbers.

A file that grows comes as chunks (log_file, part, content). For each file the state keeps its last head line, the
line that hasn't ended, and the lines so far: three values, whatever the file's length. A chunk is then parsed
behind its head line by the same expressions as a whole text, and the head's own event is dropped. Event and pattern
numbers are a second state, the events so far and the fingerprints seen, in order. Spark takes one such state a query, so
numbering is a query of its own over the table that the first one writes. Both states are checkpointed with the batch, so that a
replayed batch gives the same rows. With `idle_ms`, for streams that keep running, the state of a file without chunks for so long goes,
and its half line is then emitted; a file that comes back later starts anew. Without it state stays, and runs with
`availableNow` end (a time limit keeps Spark making batches).

A batch's chunks of one file are handled in one task; `maxFilesPerTrigger` or the source's own limit bounds them.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import StructType

from .. import registry
from ..operators.parse import parse_log
from ..parsers.spec import Lines
from ..schema import EVENT_FIELDS

def _spec(format: str) -> Lines:
    """The format's rules, where each event needs its line and the head above it only."""
    found = registry.resolve(format)
    spec = found[0].specs[0] if len(found) == 1 and len(found[0].specs) == 1 else None
    whole = spec is None or type(spec) is not Lines or spec.after or spec.otherwise or spec.closing or any(r.span > 1 or "carry_no" in str(r) for r in spec.rules)
    if whole:
        raise ValueError(f"events of {format} depend on the whole text")
    return spec


def _timeout(idle_ms: int | None) -> str:
    return GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout


def stitched(chunks: DataFrame, carry: str | None, idle_ms: int | None = None) -> DataFrame:
    """log_file, head, content, first_line: for each file with new whole lines in a batch these lines, the number of the
    first, and the last line before them that meets `carry`. Chunks go by part; null contents are empty."""
    head_of = re.compile(re.sub(r"\(\?<([a-zA-Z]\w*)>", r"(?P<\1>", carry)) if carry else None

    def run(key, frames, state):
        lines, head, rest = state.get if state.exists else (0, "", "")
        if state.hasTimedOut:
            state.remove()
            text = rest
        else:
            parts = pd.concat(list(frames)).sort_values("part", kind="stable")
            text = rest + "".join(x or "" for x in parts["content"])
            end = text.rfind("\n") + 1
            text, rest = text[:end], text[end:]
        if text:
            own = text.split("\n")[: -1 if text.endswith("\n") else None]
            yield pd.DataFrame({"log_file": [key[0]], "head": [head], "content": ["\n".join(own)], "first_line": [lines + 1]})
            lines += len(own)
            head = next((x for x in reversed(own) if head_of and head_of.search(x)), head)
        if not state.hasTimedOut:
            state.update((lines, head, rest))
            if idle_ms:
                state.setTimeoutDuration(idle_ms)

    own = chunks.select("log_file", F.col("part").cast("long").alias("part"), F.col("content").cast("string").alias("content"))
    return own.groupBy("log_file").applyInPandasWithState(
        run, "log_file string, head string, content string, first_line long", "lines long, head string, rest string", "append", _timeout(idle_ms)
    )


def with_running_ids(events: DataFrame, idle_ms: int | None = None) -> DataFrame:
    """event_id and pattern_id by first sight in the file, over all its batches; a batch's events go by line. The stream
    is one without a state before it, such as the table that `follow` writes."""
    fields = StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in EVENT_FIELDS.items()))
    own = events.select("log_file", F.coalesce("log_line_start", F.lit(0)).cast("long").alias("line"), F.coalesce("event_id", F.lit(0)).alias("at"), F.coalesce("fingerprint", F.lit("")).alias("fingerprint"), F.to_json(F.struct(*EVENT_FIELDS)).alias("event"))

    def run(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        count, seen = state.get if state.exists else (0, "")
        order = seen.split("\n") if seen else []
        number = {x: i for i, x in enumerate(order, 1)}
        found = pd.concat(list(frames)).sort_values(["line", "at"], kind="stable")
        patterns = []
        for x in found["fingerprint"]:
            if x and x not in number:
                order.append(x)
                number[x] = len(order)
            patterns.append(number.get(x, 0))
        ids = range(count + 1, count + 1 + len(found))
        state.update((count + len(found), "\n".join(order)))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame({"event": found["event"].to_list(), "event_id": list(ids), "pattern_id": patterns})

    numbered = own.groupBy("log_file").applyInPandasWithState(run, "event string, event_id long, pattern_id long", "events long, patterns string", "append", _timeout(idle_ms))
    own_of = {"event_id": F.col("event_id"), "pattern_id": F.nullif(F.col("pattern_id"), F.lit(0).cast("long"))}
    return numbered.withColumn("event", F.from_json("event", fields)).select(*[own_of.get(n, F.col(f"event.{n}")).alias(n) for n in EVENT_FIELDS])


def follow(chunks: DataFrame, format: str, idle_ms: int | None = None) -> DataFrame:
    """The events of growing files, the same as of the whole files but for event_id and pattern_id, which are null until
    `with_running_ids` gives them. Raises ValueError for formats whose events depend on more than their line and head."""
    spec = _spec(format)
    pieces = stitched(chunks, spec.carry, idle_ms)
    before = F.when(F.col("head") != "", 1).otherwise(0)
    pieces = pieces.withColumn("_before", before).withColumn("content", F.when(F.col("head") != "", F.concat("head", F.lit("\n"), "content")).otherwise(F.col("content")))
    events = parse_log(pieces, "content", format, log_file="log_file", keep=("_before", "first_line")).where("log_line_start > _before")
    shift = F.col("first_line") - F.col("_before") - 1
    for name in ("log_line_start", "log_line_end"):
        events = events.withColumn(name, (F.col(name) + shift).cast(EVENT_FIELDS[name]))
    return events.withColumn("event_id", F.lit(None).cast(EVENT_FIELDS["event_id"])).select(*EVENT_FIELDS)
