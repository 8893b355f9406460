"""Repair of conversation structure: a min-plus matrix scan with its audit.

Output roles must read `(s?(ua)+)?`, so there are four states (nothing yet, after system, after user, after
assistant). A turn is a 4 x 4 matrix whose elements are (cost, audit) pairs: keep, re-role or delete it, closed
under insertions on both sides. Matrices multiply by minimum of costs (then of audits in ASCII order) and sum of
costs, which is associative, so that a conversation is a product over its turns, in any bracketing:

* turns are range-partitioned by (conversation, turn, tie), narrow (no texts), so that a very long conversation
  lies in several partitions; each partition yields blocks of at most BLOCK turns, one letter a turn;
* "seen earlier" is decided inside a partition by a set, and over partitions by the first partition of a text
  among conversations that touch a partition's edge;
* blocks become matrices, and conversations of several blocks are multiplied in groups of FAN, level by level;
* the audit then meets its turns, sorted by conversation, and a task streams over them: only the current
  conversation's audit is held, whatever its length. The digest of a whole conversation is sequential by nature.

Audits of one span and one cost are never prefixes of each other (a longer one would hold more insertions), so
the ASCII order survives concatenation and the product is exact.

Defined results: null role and text count as one space (so such turns are blank, or have an unknown role); null
turns come first; rows of one turn are ordered by role, the text's first 32 characters and its hash; null conv_id
is a conversation of its own; a conversation without turns has zeros, no audit and the empty text; very long texts
are only streamed; repeated rows are duplicates; gaps beyond a long are the largest long; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Turns of a block, blocks of a product, turns of a partition.
BLOCK, FAN, PER_PARTITION = 1024, 16, 20_000
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
START, SYSTEM, USER, ASSISTANT = range(4)
#: State and initial of the next role -> state.
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LARGEST = (1 << 63) - 1

ELEMENT = "struct<cost:bigint,audit:string>"
SUMMARY = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, low bigint, high bigint, turns bigint"


# --- The semiring: an element is None or (cost, audit), a matrix a tuple of 16 of them.
def times(a: tuple, b: tuple) -> tuple:
    out = []
    for i in (0, 4, 8, 12):
        for j in range(4):
            best = None
            for k in range(4):
                x, y = a[i + k], b[4 * k + j]
                if x is not None and y is not None:
                    z = (x[0] + y[0], x[1] + y[1])
                    if best is None or z < best:
                        best = z
            out.append(best)
    return tuple(out)


def _closure() -> tuple:
    """All insertions between two turns: more than four in a row repeat a state."""
    out = {(i, i): (0, "") for i in range(4)}
    for _ in range(4):
        for (i, j), (cost, audit) in list(out.items()):
            for c in "ua":
                k = NEXT.get((j, c))
                if k is not None:
                    new = (cost + INSERT, audit + "I")
                    out[i, k] = min(out.get((i, k), new), new)
    return tuple(out.get((i, j)) for i in range(4) for j in range(4))


INSERTED = _closure()
OK, CUT, BLANK, SEEN = range(4)
INITIALS = "suao"


def letter(fault: int, initial: int) -> str:
    return chr(65 + 4 * fault + initial)


@lru_cache(16)
def turn_matrix(symbol: str) -> tuple:
    fault, initial = divmod(ord(symbol) - 65, 4)
    own = {(i, i): (DELETE, "D") for i in range(4)}
    if fault < BLANK:
        more = TRUNCATED * (fault == CUT)
        for role, cost, edit in ((INITIALS[initial], 0, "K"), ("u", REROLE, "R"), ("a", REROLE, "R")):
            for i in range(4):
                j = NEXT.get((i, role))
                if j is not None:
                    own[i, j] = min(own.get((i, j), (1 << 62, "")), (cost + more, edit))
    return times(times(INSERTED, tuple(own.get((i, j)) for i in range(4) for j in range(4))), INSERTED)


@lru_cache(1 << 15)
def piece_matrix(symbols: str) -> tuple:
    """The product over a few turns; the same few turns come again and again."""
    return reduce(times, map(turn_matrix, symbols), INSERTED)


def span_matrix(symbols: str) -> tuple:
    parts = [piece_matrix(symbols[i : i + 8]) for i in range(0, len(symbols), 8)] or [INSERTED]
    while len(parts) > 1:
        parts = [times(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def best(matrix: tuple) -> tuple:
    """The cheapest way to an accepted end; of equals, the audit that is least in ASCII order."""
    return min(x for x in (matrix[START], matrix[ASSISTANT]) if x is not None)


def legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def summary(symbols: str, low, high, turns: int) -> dict:
    kinds = [(ord(c) - 65) // 4 for c in symbols]
    roles = [INITIALS[(ord(c) - 65) % 4] for c in symbols]
    return {
        "blank": kinds.count(BLANK), "duplicate": kinds.count(SEEN), "truncated": kinds.count(CUT), "illegal": sum(not legal(a, b) for a, b in zip(roles, roles[1:], strict=False)),
        "first": roles[0] if roles else "", "last": roles[-1] if roles else "", "low": low, "high": high, "turns": turns,
    }


def joined(a: dict, b: dict) -> dict:
    """The summary of two neighbouring spans; it is associative as the product is."""
    out = {n: a[n] + b[n] for n in ("blank", "duplicate", "truncated", "illegal", "turns")}
    out["illegal"] += bool(a["last"] and b["first"]) and not legal(a["last"], b["first"])
    out["turns"] -= a["high"] is not None and a["high"] == b["low"]
    lows, highs = ([s[n] for s in (a, b) if s[n] is not None] for n in ("low", "high"))
    return out | {"first": a["first"] or b["first"], "last": b["last"] or a["last"], "low": lows[0] if lows else None, "high": highs[-1] if highs else None}


# --- Turns to blocks
def tie() -> F.Column:
    """Orders rows of one turn: role, the text's beginning, its hash."""
    return F.concat_ws("\u0001", "role", F.substring("text", 1, 32), F.hex(F.xxhash64("role", "text")))


def prepared(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with nulls as one space, and `tie`."""
    spaced = lambda n: F.coalesce(F.col(n).cast("string"), F.lit(" ")).alias(n)
    return turns.select("conv_id", F.col("turn").cast("long"), spaced("role"), spaced("text")).withColumn("tie", tie()).withColumn("gone", F.lit(False))


def damaged(turns: DataFrame) -> DataFrame:
    """Faults by crc32(conv_id:turn) % 20; a dropped row stays as a mark (`gone`), so that no conversation is lost."""
    name = lambda n: F.coalesce(F.col(n).cast("string"), F.lit(" "))
    fate = F.crc32(F.encode(F.concat(name("conv_id"), F.lit(":"), name("turn")), "utf-8")) % 20
    rows = prepared(turns).withColumn("fate", fate)
    text = F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    out = rows.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), "tie", (F.col("fate") == 0).alias("gone"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return out.drop("copy")


def _blocks(rows: DataFrame) -> DataFrame:
    """conv_id, part, block, symbols, low, high, turns, heads: heads has texts first seen there, at a partition's edge."""
    space = r"[\x20\x09-\x0D]"
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(~F.col("text").rlike(rf"[.!?]{space}*+\z"), CUT).otherwise(OK)
    initial = F.substring("role", 1, 1)
    known = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    narrow = rows.select("conv_id", "turn", "tie", F.when(F.col("gone"), -1).otherwise(4 * fault + known).cast("int").alias("code"), F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("k"), "role", "text").alias("h2"))
    parts = max(1, -(-rows.count() // PER_PARTITION))
    ordered = narrow.repartitionByRange(parts, "conv_id", "turn", "tie").sortWithinPartitions("conv_id", "turn", "tie")
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, part int, block int, symbols string, low bigint, high bigint, turns bigint, heads array<struct<i:int,h1:bigint,h2:bigint>>"

    def run(batches):
        part = TaskContext.get().partitionId()
        missing = object()
        now, held, seen, first, out_of = missing, [], set(), True, None

        def fresh():
            return {"symbols": [], "low": None, "high": None, "turns": 0, "heads": []}

        def closed(edge):
            columns = [[], [], [], [], [], [], [], []]
            for i, b in enumerate(held):
                for c, v in zip(columns, (now, part, i, "".join(b["symbols"]), b["low"], b["high"], b["turns"], b["heads"] if edge else []), strict=True):
                    c.append(v)
            return columns

        def batch(columns):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, out_of, strict=True)], names=["conv_id", "part", "block", "symbols", "low", "high", "turns", "heads"])

        ready = [[] for _ in range(8)]
        for b in batches:
            out_of = out_of or [b.schema.field(0).type, pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("i", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())]))]
            for conv, turn, _, code, h1, h2 in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now is missing or conv != now:
                    if now is not missing:
                        for c, v in zip(ready, closed(first), strict=True):
                            c.extend(v)
                        first = False
                        if len(ready[0]) >= 1000:
                            yield batch(ready)
                            ready = [[] for _ in range(8)]
                    now, held, seen, last = conv, [fresh()], set(), None
                if code < 0:
                    continue
                if len(held[-1]["symbols"]) == BLOCK:
                    held.append(fresh())
                    last = None
                block = held[-1]
                if code < 4 * BLANK:
                    if (h1, h2) in seen:
                        code = 4 * SEEN + code % 4
                    else:
                        seen.add((h1, h2))
                        block["heads"].append({"i": len(block["symbols"]), "h1": h1, "h2": h2})
                block["symbols"].append(chr(65 + code))
                if turn is not None and turn != last:
                    block["low"] = turn if block["low"] is None else block["low"]
                    block["high"] = last = turn
                    block["turns"] += 1
        if now is not missing:
            for c, v in zip(ready, closed(True), strict=True):
                c.extend(v)
            yield batch(ready)

    return ordered.mapInArrow(run, schema)


def _joined(a: DataFrame, b: DataFrame, names: list[str], how: str) -> DataFrame:
    """An equi-join in which null meets null."""
    own = b.select(*[F.col(n).alias(f"_{n}") for n in names], *[n for n in b.columns if n not in names])
    return a.join(own, reduce(lambda x, y: x & y, (F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names)), how).drop(*[f"_{n}" for n in names])


def _with_seen(blocks: DataFrame) -> DataFrame:
    """`late`: places in a block whose role and text stand in an earlier partition of their conversation."""
    heads = blocks.select("conv_id", "part", "block", F.explode("heads").alias("x")).select("conv_id", "part", "block", F.col("x.i").alias("i"), F.col("x.h1").alias("h1"), F.col("x.h2").alias("h2"))
    firsts = heads.groupBy("conv_id", "h1", "h2").agg(F.min("part").alias("one"), F.max("part").alias("more")).where("one < more").drop("more")
    late = _joined(heads, firsts, ["conv_id", "h1", "h2"], "inner").where("part > one").groupBy("conv_id", "part", "block").agg(F.collect_list("i").alias("late"))
    return _joined(blocks.drop("heads"), late, ["conv_id", "part", "block"], "left")


_SPAN = f"matrix array<{ELEMENT}>, {SUMMARY}"
_NAMES = [x.split()[0] for x in SUMMARY.split(", ")]


def _element(x):
    return None if x is None else {"cost": x[0], "audit": x[1]}


def _leaves(blocks: DataFrame, schema: str) -> DataFrame:
    """A matrix and a summary for each block."""
    at = [blocks.columns.index(c) for c in ("symbols", "low", "high", "turns", "late")]

    def run(batches):
        for whole in batches:
            for b in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                matrices, sums = [], []
                for symbols, low, high, turns, late in zip(*(b.column(i).to_pylist() for i in at), strict=True):
                    if late:
                        chars = list(symbols)
                        for i in late:
                            chars[i] = letter(SEEN, (ord(chars[i]) - 65) % 4)
                        symbols = "".join(chars)
                    matrices.append([_element(x) for x in span_matrix(symbols)])
                    sums.append(summary(symbols, low, high, turns))
                yield _spans(b.columns[:3], b.schema.names[:3], matrices, sums)

    return blocks.mapInArrow(run, schema)


def _spans(keys, names, matrices, sums) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))
    texts = {"first", "last"}
    values = [pa.array([s[n] for s in sums], pa.string() if n in texts else pa.int64()) for n in _NAMES]
    return pa.RecordBatch.from_arrays([*keys, pa.array(matrices, kind), *values], names=[*names, "matrix", *_NAMES])


def _level(spans: DataFrame, schema: str) -> DataFrame:
    """Products of FAN neighbouring spans."""
    kept = ["matrix", *_NAMES]
    grouped = spans.groupBy("conv_id", F.floor(F.col("at") / FAN).cast("int").alias("at"), F.ceil(F.col("of") / FAN).cast("int").alias("of")).agg(F.sort_array(F.collect_list(F.struct(F.col("at").alias("place"), *kept))).alias("spans"))

    def run(batches):
        for whole in batches:
            for b in (whole.slice(i, 16) for i in range(0, whole.num_rows, 16)):
                matrices, sums = [], []
                for spans in b.column(3).to_pylist():
                    total = reduce(times, (tuple(None if x is None else (x["cost"], x["audit"]) for x in s["matrix"]) for s in spans))
                    matrices.append([_element(x) for x in total])
                    sums.append(reduce(joined, ({n: s[n] for n in _NAMES} for s in spans)))
                yield _spans(b.columns[:3], b.schema.names[:3], matrices, sums)

    return grouped.mapInArrow(run, schema)


def audits(rows: DataFrame) -> DataFrame:
    """For each conversation of `prepared` rows: gaps, blank, duplicate, truncated, illegal, cost and audit."""
    blocks = written(_blocks(rows), "conversation-blocks")
    order = Window.partitionBy("conv_id").orderBy("part", "block")
    placed = _with_seen(blocks).withColumn("at", F.row_number().over(order) - 1).withColumn("of", F.count(F.lit(1)).over(Window.partitionBy("conv_id")).cast("int"))
    placed = placed.select("conv_id", "at", "of", "symbols", "low", "high", "turns", "late")
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, at int, of int, {_SPAN}"
    spans = written(_leaves(placed, schema), "conversation-spans")
    most = spans.agg(F.max("of")).first()[0] or 1
    done, rest = spans.where("of = 1"), spans.where("of > 1")
    while most > 1:
        rest, most = _level(rest, schema), -(-most // FAN)
        if most > 1:
            rest = written(rest, "conversation-level")
        done = done.unionByName(rest.where("of = 1"))
        rest = rest.where("of > 1")
    ends = F.array_min(F.filter(F.array(F.get("matrix", F.lit(START)), F.get("matrix", F.lit(ASSISTANT))), lambda x: x.isNotNull()))
    width = F.col("high").cast("decimal(20,0)") - F.col("low").cast("decimal(20,0)") + 1 - F.col("turns")
    gaps = F.when(F.col("low").isNull(), F.lit(0)).otherwise(F.least(width, F.lit(LARGEST).cast("decimal(20,0)")).cast("long"))
    return done.withColumn("end", ends).select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", F.col("end.cost").alias("cost"), F.col("end.audit").alias("audit"))


# --- Audits applied to their turns
class Writer:
    """Turns of one conversation in order, edited as its audit says: yields (role, text) of what is put out."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _put(self, role: str):
        self.state = NEXT[self.state, role[:1]]
        return role

    def _due(self) -> str:
        return "assistant" if self.state == USER else "user"

    def inserted(self):
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._put(self._due()), ""

    def turn(self, role: str, text: str):
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            yield self._put(role), text
        elif edit == "R":
            yield self._put(self._due()), text


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _meeting(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit in front of its turns, sorted."""
    null = lambda t: F.lit(None).cast(t)
    heads = found.select("conv_id", F.lit(0).alias("kind"), null("long").alias("turn"), null("string").alias("tie"), null("string").alias("role"), null("string").alias("text"), "audit", *_COUNTS)
    turns = rows.where(~F.col("gone")).select("conv_id", F.lit(1).alias("kind"), "turn", "tie", "role", "text", null("string").alias("audit"), *[null("long").alias(c) for c in _COUNTS])
    return heads.unionByName(turns).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "tie").drop("tie", "turn")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, place (from 0), role, text."""
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, place bigint, role string, text string"

    def run(batches):
        conv, writer, place = None, None, 0
        for b in batches:
            for part in (b.slice(i, 256) for i in range(0, b.num_rows, 256)):
                out = []
                for key, kind, role, text, audit in zip(*(part.column(i).to_pylist() for i in range(5)), strict=True):
                    if kind == 0:
                        out += [(conv, *x) for x in writer.inserted()] if writer else []
                        conv, writer = key, Writer(audit)
                        out.append(None)
                    else:
                        out += [(conv, *x) for x in writer.turn(role, text)]
                yield from _placed(out, part, place)
                place = _place_after(out, place)
        if writer:
            yield from _placed([(conv, *x) for x in writer.inserted()], b, place)

    return _meeting(rows, found).mapInArrow(run, schema)


def _places(out, place):
    for x in out:
        place = 0 if x is None else place + 1
        if x is not None:
            yield place - 1


def _place_after(out, place):
    for x in out:
        place = 0 if x is None else place + 1
    return place


def _placed(out, like, place):
    turns = [x for x in out if x is not None]
    columns = [pa.array([x[0] for x in turns], like.schema.field(0).type), pa.array(list(_places(out, place)), pa.int64()), pa.array([x[1] for x in turns], pa.string()), pa.array([x[2] for x in turns], pa.string())]
    yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "place", "role", "text"])


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """A row for each conversation: its counts, cost and audit, and the SHA-256 of its repaired turns."""
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", audit string, repaired_sha256 string"

    def run(batches):
        state, out, kind_of = None, [], None

        def put(turns):
            for role, text in turns:
                if state["any"]:
                    state["sha"].update(b"\n")
                state["any"] = True
                state["sha"].update(f"{role}:{text}".encode())

        def closed():
            put(state["writer"].inserted())
            out.append((*state["row"], state["sha"].hexdigest()))

        def batch():
            types = [kind_of, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(types)], names=["conv_id", *_COUNTS, "audit", "repaired_sha256"])

        for b in batches:
            kind_of = b.schema.field(0).type
            for key, kind, role, text, audit, *counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if kind == 0:
                    if state:
                        closed()
                    if len(out) >= 1000:
                        yield batch()
                        out = []
                    state = {"writer": Writer(audit), "sha": hashlib.sha256(), "any": False, "row": (key, *counts, audit)}
                else:
                    put(state["writer"].turn(role, text))
        if state:
            closed()
            yield batch()

    return _meeting(rows, found).mapInArrow(run, schema)


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    rows = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    return digests(rows, audits(rows))
