"""The formats: names, aliases, groups and parsers; what a name resolves to; custom formats of a session."""

from __future__ import annotations

from dataclasses import dataclass, field

from .parsers import json_tools, line_tools, log_tools, machines
from .parsers.formats import COMMANDS, FORMATS
from .parsers.spec import Format

#: Formats whose name has more than one parser.
MORE = {"winston": ("winston_text",), "serilog": ("serilog_text",)}
#: Of these, all parsers' events count, by line.
MERGED = ("winston", "serilog")
_SPECS: dict[str, Format] = {**json_tools.LINTERS, **json_tools.TESTS, **json_tools.LOGS, **line_tools.LINES, **machines.MACHINES, **log_tools.LOGS}
#: Names that win over registered aliases where the two disagree.
FIRST_ALIASES = {"gotest": "gotest_json", "bandit": "bandit_text", "eslint": "eslint_json", "pytest": "pytest_text", "make": "make_error", "rust": "cargo_build", "coverage": "coverage_text"}
#: Further names of formats.
MORE_ALIASES = {
    "ndjson": "jsonl", "cloudtrail": "aws_cloudtrail", "gcp_logging": "gcp_cloud_logging", "azure_activity_log": "azure_activity", "python_log": "python_logging", "log4j_text": "log4j", "logback": "log4j",
    "logrus_text": "logrus", "winston_json": "winston", "pino_json": "pino", "bunyan_json": "bunyan", "serilog_json": "serilog", "serilog_text": "serilog", "nlog_text": "nlog", "ruby_log": "ruby_logger", "rails": "rails_log",
    "netfilter": "iptables", "ufw": "iptables", "pf_firewall": "pf", "openbsd_pf": "pf", "asa": "cisco_asa", "vpc_flow_logs": "vpc_flow", "aws_vpc_flow": "vpc_flow", "k8s": "kubernetes", "kube": "kubernetes",
    "windows_event_log": "windows_event", "eventlog": "windows_event", "audit": "auditd", "ssh_auth": "auditd", "s3_access_log": "s3_access", "clang-tidy": "clang_tidy_text", "g++": "gcc_text", "clang++": "gcc_text", "cc": "gcc_text",
    "c++": "gcc_text", "gfortran": "gcc_text", "gnat": "gcc_text", "compiler_diagnostic": "gcc_text", "mvn": "maven_build", "npm": "node_build", "yarn": "node_build", "pip": "python_build", "setuptools": "python_build",
    "visualstudio": "msbuild", "vs": "msbuild", "pytest-cov": "pytest_cov_text", "go_test_json": "gotest_json",
}
NO_PARSER = ("nunit_xml", "checkstyle_xml")


class UnknownFormat(ValueError):
    pass


@dataclass(frozen=True)
class Entry:
    name: str
    priority: int
    category: str
    description: str
    aliases: tuple
    groups: tuple
    order: int
    specs: tuple = field(repr=False)
    commands: tuple = ()
    built_in: bool = True

    @property
    def supports_workflow(self) -> bool:
        return self.category in ("ci_system", "workflow") or "ci" in self.category


def _specs(name: str) -> tuple:
    found = [_SPECS[name]] if name in _SPECS else []
    return tuple(found + [_SPECS[x] for x in MORE.get(name, ())])


BUILT_IN = {n: Entry(n, p, c, d, a, g, i, _specs(n), COMMANDS.get(n, ())) for i, (n, p, c, d, a, g) in enumerate(FORMATS)}
_custom: dict[str, Entry] = {}


def entries() -> list[Entry]:
    """By priority, then by registration."""
    return sorted([*BUILT_IN.values(), *_custom.values()], key=lambda e: (-e.priority, e.order))


def register(entry: Entry) -> str:
    """A custom format of this session; it replaces a custom one of its name, never a built-in one."""
    if entry.name in BUILT_IN:
        raise ValueError(f"{entry.name} is a built-in format")
    _custom[entry.name] = entry
    return entry.name


def unregister(name: str) -> bool:
    if name in BUILT_IN:
        raise ValueError(f"{name} is a built-in format")
    return _custom.pop(name, None) is not None


def groups() -> dict[str, list[Entry]]:
    out: dict[str, list[Entry]] = {}
    for e in entries():
        for g in e.groups:
            out.setdefault(g, []).append(e)
    return out


def find(name: str) -> Entry | None:
    """A format by name or alias."""
    name = name.strip().lower()
    name = FIRST_ALIASES.get(name, name)
    name = name if name in BUILT_IN or name in _custom else MORE_ALIASES.get(name, name)
    if name in BUILT_IN or name in _custom:
        return _custom.get(name) or BUILT_IN[name]
    for e in reversed(list(BUILT_IN.values())):
        if name in e.aliases:
            return e
    return next((e for e in _custom.values() if name in e.aliases), None)


def resolve(name: str) -> list[Entry]:
    """The candidates of a format argument, first choice first: a list of names, a group, a name or an alias."""
    names = [x.strip() for x in name.split(",") if x.strip()]
    if len(names) > 1:
        if {"auto", "unknown"} & {n.lower() for n in names}:
            raise UnknownFormat("auto can't be part of a list of formats")
        out = [e for n in names for e in resolve(n)]
        return list({e.name: e for e in out}.values())
    low = name.strip().lower()
    if low in NO_PARSER:
        return []
    exact = BUILT_IN.get(FIRST_ALIASES.get(low, low)) or _custom.get(low)
    if exact:
        return [exact]
    if low in groups():
        return groups()[low]
    if found := find(low):
        return [found]
    hint = suggestion(low)
    raise UnknownFormat(f"Unknown format: '{name}'" + (f". Did you mean '{hint}'?" if hint else ""))


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def suggestion(name: str) -> str | None:
    """The nearest known name, if at most half its letters differ; a shared start counts for it."""
    known = sorted({n for e in entries() for n in (e.name, *e.aliases)} | set(groups()) | set(MORE_ALIASES))

    def score(n: str) -> int:
        same = next((i for i, (x, y) in enumerate(zip(name, n, strict=False)) if x != y), min(len(name), len(n)))
        return distance(name, n) - same

    fine = [n for n in known if distance(name, n) <= (len(name) + 1) // 2]
    return min(fine, key=lambda n: (score(n), n)) if fine else None
