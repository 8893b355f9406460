"""How a format is described, and how a description becomes column expressions.

A format yields, for one text, an array of hits; a hit is a struct `x`, and the event's columns are SQL
expressions over it. Arrays are built by higher-order functions inside one row, so parsing is a narrow
operation: no shuffle, event numbers by position, and Spark splits the work by documents.

* `Lines`: the first rule whose pattern occurs in a line (or in `span` lines joined) gives the hit. Groups are
  taken in one pass: the line is rewritten to its groups and split.
* `Machine`: as Lines, but which rules meet depends on a state that earlier lines leave.
* `Json`: a whole document, or one document a line; `rows` is an SQL expression over the parsed value `j`.
* `Xml`: as Json, over from_xml.
"""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass, field
from functools import cache
from re import _parser

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import EVENT_FIELDS, KEPT_EMPTY, LATER

SEP, MET = "\u0001", "\u0002"
#: Formats with `capped` cut lines beyond this length and mark them, before any rule sees them; the others don't.
LINE_LIMIT, CUT_MARK = 2000, "..."
ERRORS = ("error", "err", "fatal", "critical", "crit", "severe", "panic", "alert", "emerg", "emergency", "failure", "e", "f", "ftl", "fail", "failed", "fatal error", "exception")
WARNINGS = ("warning", "warn", "w", "wrn", "caution")


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def level_status(level: str) -> str:
    """ERROR, WARNING or INFO for a level's text."""
    inside = lambda names: ", ".join(f"'{n}'" for n in names)
    return f"CASE WHEN lower({level}) IN ({inside(ERRORS)}) THEN 'ERROR' WHEN lower({level}) IN ({inside(WARNINGS)}) THEN 'WARNING' ELSE 'INFO' END"


def int_of(text: str) -> str:
    """Leading digits as a number; null where there are none."""
    return f"try_cast(nullif(regexp_extract({text}, '^\\\\s*([0-9]{{1,9}})', 1), '') AS int)"


def double_of(text: str) -> str:
    return f"coalesce(try_cast(nullif(regexp_extract({text}, '^\\\\s*([0-9]+(?:[.][0-9]+)?)', 1), '') AS double), 0.0D)"


def bound(name: str, value: str, body: str) -> str:
    """SQL for `body`, in which `name` stands for `value`, computed once; a fold over nothing, as `transform` copies all that `body` gives."""
    return f"aggregate(array(), {value}, (_held, _none) -> _held, {name} -> {body})"


def switch(number: str, cases: dict, otherwise: str) -> str:
    """SQL for the case of a number, by halving: Spark walks through the branches of a CASE inside a lambda."""
    keys = sorted(cases)
    if not keys:
        return otherwise
    if len(keys) == 1:
        return f"if({number} = {keys[0]}, {cases[keys[0]]}, {otherwise})"
    low, high = keys[: len(keys) // 2], keys[len(keys) // 2 :]
    return f"if({number} < {high[0]}, {switch(number, {k: cases[k] for k in low}, otherwise)}, {switch(number, {k: cases[k] for k in high}, otherwise)})"


def powers(size: str) -> str:
    """SQL for the powers of two up to a size, the highest first."""
    return f"CASE WHEN {size} > 0 THEN slice(array({', '.join(str(1 << b) for b in range(30, -1, -1))}), -length(bin({size})), length(bin({size}))) ELSE cast(array() AS array<int>) END"


def _needed(parsed) -> list[tuple]:
    """Of a parsed pattern: tuples of texts, of each of which one stands in whatever matches."""
    out, run = [], ""
    for op, value in [*parsed, (None, None)]:
        if op is _parser.LITERAL:
            run += chr(value)
            continue
        if run:
            out.append((run,))
        run = ""
        if op is _parser.SUBPATTERN and not value[1] and not value[2]:
            out += _needed(value[3])
        elif op in (_parser.MAX_REPEAT, _parser.MIN_REPEAT, _parser.POSSESSIVE_REPEAT) and value[0] > 0:
            out += _needed(value[2])
        elif op is _parser.ATOMIC_GROUP:
            out += _needed(value)
        elif op is _parser.BRANCH:
            each = [[n for n in _needed(b) if len(n) == 1] for b in value[1]]
            if all(each):
                out.append(tuple(max((n[0] for n in b), key=len) for b in each))
    return out


@cache
def needed(pattern: str) -> tuple:
    """Texts of which one at least stands in whatever a Java pattern matches; none if that isn't plain to see.

    Patterns are read by Python's parser. What it reads as something else than Java does gives none: flags, \\v, sets within sets.
    """
    sets = re.findall(r"(?s)\\.|(\[\^?\]?(?:\\.|[^\]\\])*\])", pattern)
    if re.search(r"\\[vQE]", pattern) or any("&&" in x or "[" in re.sub(r"(?s)\\.", "", x[1:]) or re.match(r"\[\^?\]", x) for x in sets):
        return ()
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("error")
            parsed = _parser.parse(re.sub(r"\(\?<([a-zA-Z]\w*)>", r"(?P<\1>", pattern))
    except (re.error, Warning, OverflowError, RecursionError):
        return ()
    if parsed.state.flags & (re.IGNORECASE | re.VERBOSE):
        return ()
    able = [n for n in _needed(parsed) if len(n) <= 4 and all(t.strip() and "\ufffd" not in t for t in n)]
    return max(able, key=lambda n: (min(map(len, n)) - len(n), -len(n)), default=())


def meets(text: str, pattern: str) -> str:
    """SQL: the pattern occurs in a name's text. What it can't lack is looked for first, which is much cheaper."""
    test, texts = f"{text} RLIKE {quoted('(?s)' + pattern)}", needed(pattern)
    return f"(({' OR '.join(f'contains({text}, {quoted(t)})' for t in texts)}) AND {test})" if texts else test


@dataclass
class Rule:
    """pattern: a Java regex, searched. columns: name -> group number, "=text", or SQL with {1}, {line}, {carry}."""

    pattern: str
    columns: dict
    level: str | int | None = None
    span: int = 1
    unless: str | None = None

    def sql(self, name: str) -> str | None:
        if name in ("status", "severity") and name not in self.columns and self.level is not None:
            level = self.expand(f"{{{self.level}}}" if isinstance(self.level, int) else self.level)
            return level_status(level) if name == "status" else f"lower({level_status(level)})"
        value = self.columns.get(name)
        if value is None:
            return None
        if isinstance(value, int):
            text = self.expand(f"{{{value}}}")
        elif value.startswith("="):
            return quoted(value[1:])
        else:
            text = self.expand(value)
        kind = EVENT_FIELDS[name]
        if isinstance(value, int) and kind == "int":
            return int_of(text)
        if isinstance(value, int) and kind == "double":
            return double_of(text)
        return text

    def expand(self, text: str) -> str:
        text = re.sub(r"\{(\d+)\}", lambda m: f"get(x.g, {int(m[1]) - 1})", text)
        text = re.sub(r"\{v(\d+)\}", lambda m: f"get(x.v, {m[1]})", text)
        return text.replace("{line}", "x.line").replace("{carry}", "x.carry")


def hit_with(*values: str) -> str:
    """SQL for the hit `x` with further values behind its groups."""
    return f"named_struct('rule', x.rule, 'line_no', x.line_no, 'line_end', x.line_end, 'line', x.line, 'g', concat(x.g, array({', '.join(values)})), 'carry', x.carry, 'carry_no', x.carry_no)"


_KEPT_OF_HIT = "'rule', x.rule, 'line_no', x.line_no, 'line_end', x.line_end, 'line', x.line, 'g', x.g"


@dataclass
class Format:
    """What all kinds share. tool, type and category hold where a rule says nothing."""

    tool: str
    type: str
    category: str
    columns: dict = field(default_factory=dict)
    detect: object = None

    def hits(self) -> Column:
        return F.expr(self.hits_sql())

    def events_sql(self, hits: str | None = None) -> str:
        """SQL over the column _text (or over hits) for an array of events, without what later steps fill."""
        columns = ", ".join(f"{self.event(n)} AS `{n}`" for n in EVENT_FIELDS if n not in LATER)
        return f"transform(coalesce({self.after_sql(hits or self.hits_sql())}, array()), x -> struct({columns}))"

    def after_sql(self, hits: str) -> str:
        """`hits`, SQL for an array of hits, with what depends on other hits."""
        return hits

    def default(self, name: str) -> str | None:
        fixed = {"tool_name": quoted(self.tool), "event_type": quoted(self.type), "category": quoted(self.category)}
        return fixed.get(name)

    def finished(self, name: str, sql: str | None) -> str:
        kind = EVENT_FIELDS[name]
        if sql is None:
            sql = {"execution_time": "0.0D"}.get(name, "''" if name in KEPT_EMPTY else "NULL")
        if kind == "string":
            return f"coalesce({sql}, '')" if name in KEPT_EMPTY else f"nullif({sql}, '')"
        return f"cast({sql} AS {kind})"


@dataclass
class Lines(Format):
    rules: tuple = ()
    #: A line with this pattern sets `carry`, group 1, and its number `carry_no` for the lines behind it.
    carry: str | None = None
    #: SQL over all hits of a document (`_hits`), where one hit depends on others; see `hit_with`.
    after: str | None = None
    #: What a text without any hit gives.
    otherwise: Rule | None = None
    #: What every text gives in the end, whose groups are the numbers of hits, of those for which `bad` holds and `poor` does.
    closing: Rule | None = None
    bad: str = "false"
    poor: str = "false"
    capped: bool = False

    def __post_init__(self):
        more = self.otherwise or self.closing
        self.tried = self.rules
        if self.closing:
            number = lambda test: f"cast(size(filter(_hits, x -> {test})) AS string)"
            self.after = f"CASE WHEN _text = '' THEN _hits ELSE concat(_hits, array(named_struct('rule', {len(self.rules)}, 'line_no', cast(NULL AS int), 'line_end', cast(NULL AS int), 'line', '', 'g', array(cast(size(_hits) AS string), {number(self.bad)}, {number(self.poor)}), 'carry', '', 'carry_no', cast(NULL AS int)))) END"
        if more:
            self.rules = (*self.rules, more)

    def hits_sql(self) -> str:
        """SQL over the column _text. Each array is computed once: it is bound as a lambda's variable."""
        lines = f"split(CASE WHEN contains(_text, {quoted(MET)}) THEN translate(_text, {quoted(MET)}, ' ') ELSE _text END, '\\r?\\n')"
        if self.capped:
            lines = f"transform({lines}, y -> CASE WHEN length(y) > {LINE_LIMIT} THEN concat(left(y, {LINE_LIMIT - len(CUT_MARK)}), {quoted(CUT_MARK)}) ELSE y END)"
        tests = " ".join(f"WHEN {self._meets(rule)} THEN {self._hit(number, rule)}" for number, rule in enumerate(self.tried))
        found = f"filter(transform(_lines, (line, i) -> CASE {tests} END), x -> x IS NOT NULL)"
        if self.carry:
            head = f"CASE WHEN {meets('line', self.carry)} THEN named_struct('n', i + 1, 'v', regexp_extract(line, {quoted(self.carry)}, 1)) END"
            below = bound("_places", powers("size(_heads)"), f"transform(_met, x -> {self._carried()})")
            found = bound("_met", found, bound("_heads", f"CASE WHEN size(_met) > 0 THEN filter(transform(_lines, (line, i) -> {head}), y -> y IS NOT NULL) END", f"CASE WHEN size(_heads) > 0 THEN {below} ELSE _met END"))
        found = bound("_lines", lines, found)
        if self.otherwise:
            none = f"named_struct('rule', {len(self.tried)}, 'line_no', 1, 'line_end', 1, 'line', '', 'g', array(''), 'carry', '', 'carry_no', cast(NULL AS int))"
            found = bound("_found", found, f"CASE WHEN size(_found) > 0 OR _text = '' THEN _found ELSE array({none}) END")
        return found

    @staticmethod
    def _source(rule: Rule) -> str:
        return "line" if rule.span == 1 else f"array_join(slice(_lines, i + 1, {rule.span}), '\n')"

    def _meets(self, rule: Rule) -> str:
        """True where the rule's pattern occurs in the line; groups are only taken then."""
        source = self._source(rule)
        test = meets(source, rule.pattern) if rule.span == 1 else f"{source} RLIKE {quoted('(?s)' + rule.pattern)}"
        return test + (f" AND NOT {source} RLIKE {quoted(rule.unless)}" if rule.unless else "")

    def _hit(self, number: int, rule: Rule) -> str:
        """The hit with all groups, taken in one pass: the line is rewritten to its groups and split."""
        groups = re.compile(re.sub(r"\(\?<([a-zA-Z]\w*)>", r"(?P<\1>", rule.pattern.replace("++", "+").replace("*+", "*"))).groups
        whole, put = quoted(f"(?s)^.*?(?:{rule.pattern}).*$"), quoted(SEP.join(f"${k + 1}" for k in range(groups)))
        return f"named_struct('rule', {number}, 'line_no', i + 1, 'line_end', i + {rule.span}, 'line', line, 'g', split(regexp_replace({self._source(rule)}, {whole}, {put}), {quoted(SEP)}, -1), 'carry', '', 'carry_no', cast(NULL AS int))"

    @staticmethod
    def _carried() -> str:
        """The hit with the last head at or above its line, found by halving: heads are in order of lines."""
        place = "aggregate(_places, 0, (at, b) -> CASE WHEN at + b <= size(_heads) AND get(_heads, at + b - 1).n <= x.line_no THEN at + b ELSE at END)"
        return f"get(transform(array(get(_heads, {place} - 1)), h -> named_struct({_KEPT_OF_HIT}, 'carry', coalesce(h.v, ''), 'carry_no', h.n)), 0)"

    def after_sql(self, hits: str) -> str:
        return bound("_hits", hits, self.after) if self.after else hits

    def event(self, name: str) -> str:
        own = {"log_content": "nullif(x.line, '')", "log_line_start": "x.line_no", "log_line_end": "x.line_end"}.get(name)
        if own and not any(name in r.columns for r in self.rules):
            return own
        kind, whens, fixed, groups = EVENT_FIELDS[name], {}, {}, {}
        for i, rule in enumerate(self.rules):
            given = rule if rule.sql(name) is not None else Rule("", self.columns, rule.level)
            sql = given.sql(name) or own or self.default(name)
            if sql is None:
                continue
            value = given.columns.get(name)
            if isinstance(value, int) and kind in ("string", "int"):
                groups[i] = value - 1
            elif re.fullmatch(r"'[^'\\]+'", sql):
                fixed[i] = sql
            else:
                whens.setdefault(sql, []).append(i)
        if not (whens or fixed or groups):
            return self.finished(name, None)
        if len(whens) == 1 and not fixed and not groups and len(next(iter(whens.values()))) == len(self.rules):
            return self.finished(name, next(iter(whens)))
        # Fixed texts and groups are looked up by the rule's number: a branch for each would make methods that the JVM doesn't compile.
        looked = lambda values: f"get(array({', '.join(str(values.get(i, 'NULL')) for i in range(len(self.rules)))}), x.rule)"
        one = f"get(x.g, {looked(groups)})"
        rest = [looked(fixed)] * bool(fixed) + [int_of(one) if kind == "int" else one] * bool(groups)
        last = f"coalesce({', '.join(rest)})" if len(rest) > 1 else rest[0] if rest else "NULL"
        if not whens:
            return last if not groups and len(fixed) == len(self.rules) and kind == "string" else self.finished(name, last)
        return self.finished(name, "CASE " + " ".join(f"WHEN x.rule IN ({', '.join(map(str, at))}) THEN {sql}" for sql, at in whens.items()) + f" ELSE {last} END")


#: Lines that one running fold takes; the array it fills is copied as it grows, so long texts are folded in two levels.
FOLDED = 1024


@dataclass
class Machine(Lines):
    """An automaton over a text's lines: a table says in which states a rule meets and where it leads.

    Each line's patterns are tested once; the fold then only walks over lines that any rule may meet and holds the state. An
    event finds the last line of any rule before it (`last`) by halving, so that it can tell what stood before it. Rules in `opens` put
    their event on a stack and rules in `closes` take the topmost one off: what closes an event can be looked up from it.
    """

    #: rule -> {state: next state}: it meets in these states only. Other rules meet in all and change none.
    moves: dict = field(default_factory=dict)
    #: rule -> states in which it gives an event. Other rules give one in all.
    emits: dict = field(default_factory=dict)
    states: int = 1
    opens: tuple = ()
    closes: tuple = ()
    #: Further values of an event, {v0}, {v1} .. in columns: SQL over `o`, its place in the fold; see `told` and `between`.
    values: tuple = ()
    #: What meets once behind the last line.
    end: Rule | None = None

    def __post_init__(self):
        self.tried = self.rules
        if self.end:
            self.rules = (*self.rules, self.end)

    def _table(self, of) -> str:
        return "array(" + ", ".join(of(r, s) for r in range(len(self.rules)) for s in range(self.states)) + ")"

    def _used(self, rule: int) -> tuple:
        """Numbers of the values that a rule's columns name."""
        texts = [str(v) for v in ({**self.columns, **self.rules[rule].columns}).values()]
        return tuple(sorted({int(v) for t in (*texts, str(self.rules[rule].level)) for v in re.findall(r"\{v(\d+)\}", t)}))

    def _values(self) -> tuple[str, list]:
        """SQL for the values of the hit `x`, and the rules that it asks for: only values that the hit's rule names, and only the lines before it that these ask for."""

        def asked_of(name: str, values: str) -> list:
            return sorted({int(r) for r in re.findall(rf"get\({name}\.last, (\d+)\)", values)})

        def placed(o: str, name: str, values: str) -> str:
            before = "".join(f", 'last{r}', coalesce(get(_at{r}, {halved(f'_at{r}', f'{o}.n - 1', f'_powers{r}')} - 1), -1)" for r in asked_of(name, values))
            return f"named_struct('n', {o}.n, 'rule', {o}.rule, 'i', {o}.i, 'line', {o}.line{before})"

        none, cases, asked = "cast(array() AS array<string>)", {}, set()
        for r in range(len(self.rules)) if self.values else ():
            used = self._used(r)
            if not used:
                continue
            values = ", ".join(f"coalesce({v}, '')" if i in used else "''" for i, v in enumerate(self.values))
            block = f"array({values})"
            if _CLOSED in values:
                # The line that closed `o`, w, is looked up once for all values.
                block = bound("w", f"{bound('z', _PAIR, 'CASE WHEN z.n = o.n THEN get(_spots, z.by) END')}", bound("q", f"CASE WHEN {_CLOSED} THEN {placed('w', 'q', values)} END", block))
            asked |= {*asked_of("o", values), *asked_of("q", values)}
            cases[r] = re.sub(r"get\((\w+)\.last, (\d+)\)", r"\1.last\2", bound("o", placed("x", "o", values), block))
        return switch("x.rule", cases, none), sorted(asked)

    def hits_sql(self) -> str:
        n, k = self.states, len(self.rules)
        assert k < 63, "a line's rules are bits of a number"
        lines = f"split(CASE WHEN contains(_text, {quoted(MET)}) THEN translate(_text, {quoted(MET)}, ' ') ELSE _text END, '\\r?\\n')"
        may = " | ".join(f"if({meets('line', r.pattern)}, {1 << i}L, 0L)" for i, r in enumerate(self.tried))
        marked = f"filter(transform(_lines, (line, i) -> named_struct('i', i + 1, 'line', line, 'may', {may})), m -> m.may <> 0L)"
        if self.end:
            marked = f"CASE WHEN _text = '' THEN array() ELSE concat({marked}, array(named_struct('i', size(_lines) - CASE WHEN element_at(_lines, -1) = '' THEN 1 ELSE 0 END, 'line', '', 'may', {1 << (k - 1)}L))) END"
        able = ", ".join(f"{sum(1 << r for r in range(k) if s in self.moves.get(r, range(n)))}L" for s in range(n))
        leads = self._table(lambda r, s: str(self.moves.get(r, {}).get(s, s)))
        gives = self._table(lambda r, s: str(s in self.emits.get(r, range(n))).lower())
        # The fold holds small numbers only: Spark may copy what it holds at each line. A line's number is rule * states + state, or -1.
        # The rule is the lowest of those that the line may meet, c, and that meet in the state.
        code = bound("c", f"m.may & get(array({able}), a.s)", f"if(c = 0L, -1, (bit_count(c ^ (c - 1L)) - 1) * {n} + a.s)")
        step = bound("r", code, f"named_struct('s', if(r < 0, a.s, element_at({leads}, r + 1)), 'out', array_append(a.out, r))")
        codes = _in_parts("_marked", "'s', 0", "'s', b.s", "'s', p.s", "int", step)
        spots = f"transform(_marked, (m, j) -> named_struct('n', j, 'rule', if(get(_codes, j) < 0, -1, cast(get(_codes, j) DIV {n} AS int)), 's', pmod(get(_codes, j), {n}), 'i', m.i, 'line', m.line))"
        groups = switch("x.rule", {i: self._groups(r) for i, r in enumerate(self.tried)}, "cast(array() AS array<string>)")
        values, asked = self._values()
        hit = f"named_struct('rule', x.rule, 'line_no', x.i, 'line_end', x.i, 'line', x.line, 'g', {groups}, 'carry', '', 'carry_no', cast(NULL AS int), 'v', {values})"
        hits = f"transform(filter(_spots, x -> x.rule >= 0 AND element_at({gives}, x.rule * {n} + x.s + 1)), x -> {hit})"
        if self.closes:
            inside = lambda rules: f"({', '.join(map(str, rules))})"
            some = f"filter(_spots, x -> x.rule IN {inside((*self.opens, *self.closes))})"
            opened = f"named_struct('open', CASE WHEN m.rule IN {inside(self.opens)} THEN array_append(a.open, m.n) WHEN size(a.open) > 0 THEN slice(a.open, 1, size(a.open) - 1) ELSE a.open END, "
            pair = f"'out', CASE WHEN m.rule IN {inside(self.closes)} AND size(a.open) > 0 THEN array_append(a.out, named_struct('n', get(a.open, size(a.open) - 1), 'by', m.n)) ELSE a.out END)"
            pairs = _in_parts("_some", "'open', cast(array() AS array<int>)", "'open', b.open", "'open', p.open", "struct<n:int,by:int>", opened + pair)
            hits = bound("_pairs", bound("_some", some, f"array_sort({pairs})"), bound("_paired", "transform(_pairs, y -> y.n)", bound("_powers", powers("size(_paired)"), hits)))
        for r in asked:
            hits = bound(f"_at{r}", f"transform(filter(_spots, y -> y.rule = {r}), y -> y.n)", bound(f"_powers{r}", powers(f"size(_at{r})"), hits))
        return bound("_lines", lines, bound("_marked", marked, f"CASE WHEN size(_marked) = 0 THEN NULL ELSE {bound('_codes', codes, bound('_spots', spots, hits))} END"))

    @staticmethod
    def _groups(rule: Rule) -> str:
        groups = re.compile(rule.pattern).groups
        if not groups:
            return "array('')"
        return f"split(regexp_replace(x.line, {quoted(f'(?s)^.*?(?:{rule.pattern}).*$')}, {quoted(SEP.join(f'${k + 1}' for k in range(groups)))}), {quoted(SEP)}, -1)"


def halved(numbers: str, most: str, powers: str = "_powers") -> str:
    """SQL for how many of an array of rising numbers are at most `most`, by halving."""
    return f"aggregate({powers}, 0, (at, b) -> CASE WHEN at + b <= size({numbers}) AND get({numbers}, at + b - 1) <= {most} THEN at + b ELSE at END)"


#: That `o` was closed, and the pair that tells by which line, if its n is that of `o`.
_CLOSED, _PAIR = "w IS NOT NULL", f"get(_pairs, {halved('_paired', 'o.n')} - 1)"


def _in_parts(array: str, first: str, going: str, gone: str, kind: str, step: str) -> str:
    """SQL for what a fold over `array` puts out, in two levels; `step` is over what is held, `a`, and an element, `m`."""
    empty = f"cast(array() AS array<{kind}>)"
    part = f"aggregate(slice({array}, c * {FOLDED} + 1, {FOLDED}), named_struct({going}, 'out', {empty}), (a, m) -> {step})"
    outer = bound("p", part, f"named_struct({gone}, 'out', array_append(b.out, p.out))")
    return f"CASE WHEN size({array}) > 0 THEN aggregate(sequence(0, (size({array}) - 1) DIV {FOLDED}), named_struct({first}, 'out', cast(array() AS array<array<{kind}>>)), (b, c) -> {outer}, b -> flatten(b.out)) ELSE {empty} END"


def told(pattern: str, rule: int, group: int = 1, since: int | None = None, o: str = "o") -> str:
    """SQL for a group of the last line that `rule` met before `o`; with `since`, only behind the last line of that rule."""
    value = f"regexp_extract(get(_spots, get({o}.last, {rule})).line, {quoted(pattern)}, {group})"
    return value if since is None else f"CASE WHEN get({o}.last, {rule}) > get({o}.last, {since}) THEN {value} END"


def between(patterns: dict, since: int, o: str = "o") -> str:
    """SQL for an array of texts, in order: of each line between the last one of rule `since` and `o` that met a rule of `patterns`, which gives SQL over `y.line`."""
    lines = f"slice(_spots, get({o}.last, {since}) + 2, {o}.n - get({o}.last, {since}) - 1)"
    return f"transform(filter({lines}, y -> y.rule IN ({', '.join(map(str, patterns))})), y -> CASE y.rule " + " ".join(f"WHEN {r} THEN {sql}" for r, sql in patterns.items()) + " END)"


def closed_by(body: str) -> str:
    """SQL for `body` over `q`, the line that closed `o`; null where none did."""
    return f"CASE WHEN {_CLOSED} THEN {body} END"


@dataclass
class Json(Format):
    """schema: DDL of the document (or of one line's). rows: SQL over `j` giving the hits; per line: `keep` over x.j."""

    schema: str = ""
    rows: str = "array(j)"
    per_line: bool = False
    keep: str = "true"
    #: SQL over all hits of a document, where one hit depends on others.
    after: str | None = None
    #: With per_line: keys whose array holds the records where the text is one document.
    wrappers: tuple = ()

    #: The document inside the text: what is in front of the first line that begins like JSON is left out.
    body = r"""CASE WHEN _text RLIKE r'^\s*[\[{]' THEN _text ELSE regexp_extract(_text, r'(?s)(?:^|[\r\n])([\[{](?=["{\[\]} \t\n\r0-9]|$).*)', 1) END"""
    reader = "from_json"

    def hits_sql(self) -> str:
        if self.per_line:
            lines = "split(_text, r'\\r?\\n')"
            if self.wrappers:
                lines = "coalesce(" + ", ".join(f"from_json(_text, 'struct<`{w}`: array<string>>').`{w}`" for w in self.wrappers) + f", {lines})"
            parsed = f"transform({lines}, (line, i) -> named_struct('line_no', i + 1, 'line', line, 'j', from_json(line, {quoted(self.schema)})))"
            found = f"filter({parsed}, x -> ltrim(x.line) LIKE '{{%' AND x.j IS NOT NULL AND ({self.keep}))"
            return bound("_hits", found, self.after) if self.after else found
        return bound("j", f"{self.reader}({self.body}, {quoted(self.schema)})", self.rows)

    def event(self, name: str) -> str:
        if self.per_line and name in ("log_line_start", "log_line_end") and name not in self.columns:
            return "x.line_no"
        if self.per_line and name == "log_content" and name not in self.columns:
            return "nullif(x.line, '')"
        value = self.columns.get(name)
        if name in ("status", "severity") and value is None and "level" in self.columns:
            level = self.columns["level"]
            value = level_status(level) if name == "status" else f"lower({level_status(level)})"
        sql = self.default(name) if value is None else quoted(value[1:]) if value.startswith("=") else value
        return self.finished(name, sql)


@dataclass
class Xml(Json):
    """from_xml over the document, or over what follows <?xml or the first line that begins with a tag."""

    body = r"""CASE WHEN _text RLIKE r'^\s*<[A-Za-z?]' THEN _text ELSE coalesce(nullif(regexp_extract(_text, r'(?s)(<\?xml.*)', 1), ''), regexp_extract(_text, r'(?s)(?:^|[\r\n])(<[A-Za-z].*)', 1)) END"""
    reader = "from_xml"
