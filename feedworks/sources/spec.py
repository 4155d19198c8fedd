"""Feed specs: what a client's files look like and how to read them.

One YAML file per client, one section per entity. Loading and checking happen on
the driver, before any Spark job.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

import yaml

from feedworks.functions.transforms import TRANSFORM_OUTPUTS, TRANSFORMS
from feedworks.sources.entities import CANONICAL

CORRUPT_COLUMN = "_corrupt_record"
LINEAGE_COLUMNS = ("_client_id", "_entity", "_source_file", "_ingestion_ts")
#: Only there if a scan is asked for it: the file that a row really came from.
PATH_COLUMN = "_source_path"
SYSTEM_COLUMNS = (CORRUPT_COLUMN, *LINEAGE_COLUMNS)
#: Names that the library gives to columns of its own.
RESERVED = (*SYSTEM_COLUMNS, PATH_COLUMN, "_raw", "_rejected", "_quarantine_reason", "_silver_refined_ts")
DATE_TYPES = ("date", "timestamp")
#: The letters that Spark can parse times with, and how often each may stand in a row.
PATTERN_LETTERS = {
    "G": 4, "y": 6, "M": 4, "L": 4, "d": 2, "D": 3, "a": 1, "h": 2, "H": 2, "k": 2, "K": 2,
    "m": 2, "s": 2, "S": 9, "V": 2, "z": 4, "O": 4, "X": 5, "x": 5, "Z": 5,
}


@dataclass(frozen=True)
class DateField:
    target: str
    format: str
    type: str = "timestamp"


@dataclass(frozen=True)
class FlagField:
    target: str
    true_values: tuple[str, ...] = ()
    false_values: tuple[str, ...] = ()


@dataclass(frozen=True)
class FeedSpec:
    """One client's feed of one entity. All maps go from raw column to target."""

    file: str | None = None
    delimiter: str | None = None
    header: bool = True
    quote: str = '"'
    validate_header: bool = False
    columns: tuple[str, ...] = ()
    column_map: Mapping[str, str] = field(default_factory=dict)
    special_transform: str | None = None
    date_fields: Mapping[str, DateField] = field(default_factory=dict)
    int_fields: Mapping[str, str] = field(default_factory=dict)
    decimal_fields: Mapping[str, str] = field(default_factory=dict)
    boolean_fields: Mapping[str, FlagField] = field(default_factory=dict)
    default_currency: str | None = None
    required_fields: tuple[str, ...] = ()

    def targets(self) -> list[str]:
        """Every column the spec itself produces, besides what a transform adds."""
        return [
            *self.column_map.values(),
            *[date.target for date in self.date_fields.values()],
            *self.int_fields.values(),
            *self.decimal_fields.values(),
            *[flag.target for flag in self.boolean_fields.values()],
            *(["currency"] if self.default_currency is not None else []),
        ]

    @classmethod
    def of(cls, cfg: FeedSpec | Mapping[str, Any]) -> FeedSpec:
        """The spec for one entity section of a client's YAML."""
        if isinstance(cfg, FeedSpec):
            return cfg
        given = {k: v for k, v in cfg.items() if v is not None}
        plain = {
            name: given[name]
            for name in ("file", "delimiter", "quote", "special_transform", "default_currency")
            if name in given
        }
        maps = {name: dict(given[name]) for name in ("column_map", "int_fields", "decimal_fields") if name in given}
        dates = {
            raw: DateField(s["target"], s["format"], s.get("type") or "timestamp")
            for raw, s in given.get("date_fields", {}).items()
        }
        flags = {
            raw: FlagField(s["target"], tuple(s["true_values"]), tuple(s["false_values"]))
            for raw, s in given.get("boolean_fields", {}).items()
        }
        return cls(
            **plain,
            **maps,
            header=_as_bool(given.get("header", True)),
            validate_header=_as_bool(given.get("validate_header", False)),
            columns=tuple(given.get("columns", ())),
            date_fields=dates,
            boolean_fields=flags,
            required_fields=tuple(given.get("required_fields", ())),
        )


def _as_bool(value: Any) -> bool:
    return str(value).strip().lower() == "true"


def load_client_config(configs_dir: str, client_id: str) -> dict[str, Any]:
    """The client's YAML as a dict; an empty file is an error that names the path."""
    path = Path(configs_dir) / f"{client_id}.yaml"
    with path.open(encoding="utf-8") as handle:
        config = yaml.safe_load(handle)
    if config is None:
        raise ValueError(f"{path} is empty: a client config must describe at least one feed")
    return config


def list_client_ids(configs_dir: str) -> list[str]:
    """Client ids, which are the sorted names of the YAML files."""
    return sorted(p.name.removesuffix(".yaml") for p in Path(configs_dir).iterdir() if p.name.endswith(".yaml"))


def load_configs(configs_dir: str) -> dict[str, dict[str, Any]]:
    return {client_id: load_client_config(configs_dir, client_id) for client_id in list_client_ids(configs_dir)}


def feeds_of(configs: Mapping[str, Mapping[str, Any]]) -> list[tuple[str, str, Mapping[str, Any]]]:
    """(client id, entity, section) for every feed, clients in given order."""
    return [
        (client_id, entity, cfg[entity]) for client_id, cfg in configs.items() for entity in CANONICAL if entity in cfg
    ]


def check_configs(configs: Mapping[str, Mapping[str, Any]]) -> dict[str, list[str]]:
    """Check every config and return the entities of each client.

    Raises one ``ValueError`` that lists everything found, so a bad config stops
    a run before it has written anything.
    """
    found: list[str] = []
    for client_id, cfg in configs.items():
        stated = cfg.get("client_id", client_id)
        if str(stated) != client_id:
            found.append(f"{client_id}: client_id says {stated!r}, but the file name decides the id")
    for client_id in configs:
        parts = client_id.split("_")
        for n in range(1, len(parts)):
            if (shorter := "_".join(parts[:n])) in configs:
                found.append(f"{shorter}, {client_id}: keys of these two clients could read the same")
    for client_id, entity, section in feeds_of(configs):
        found += [f"{client_id}.{entity}: {problem}" for problem in feed_problems(section, entity)]
    if found:
        raise ValueError("invalid feed configs:\n  " + "\n  ".join(found))
    return {client_id: [e for e in CANONICAL if e in cfg] for client_id, cfg in configs.items()}


def feed_problems(section: Any, entity: str | None = None) -> list[str]:
    """What is wrong with one feed section, of ``entity`` if that is given; empty when nothing is."""
    if not isinstance(section, (FeedSpec, Mapping)):
        return ["is not a mapping"]
    try:
        spec = FeedSpec.of(section)
    except (KeyError, TypeError, ValueError, AttributeError) as err:
        return [f"is malformed ({type(err).__name__}: {err})"]
    problems = [f"{name} is missing" for name in ("file", "delimiter", "columns") if not getattr(spec, name)]
    if isinstance(section, Mapping):
        known = {f.name for f in fields(FeedSpec)}
        problems += [f"unknown key {key!r}" for key in section if key not in known]
    problems += [f"column {name!r} is listed twice" for name in _repeated(spec.columns)]
    problems += [f"column {name!r} has a reserved name" for name in spec.columns if name.lower() in RESERVED]
    problems += [f"target {name!r} is a reserved name" for name in spec.targets() if name.lower() in RESERVED]
    for raw, date in spec.date_fields.items():
        if date.type not in DATE_TYPES:
            problems.append(f"date_fields.{raw}: type {date.type!r} is none of {', '.join(DATE_TYPES)}")
        if (fault := pattern_fault(date.format)) is not None:
            problems.append(f"date_fields.{raw}: format {date.format!r} {fault}")
    for raw, flag in spec.boolean_fields.items():
        if not all(isinstance(v, str) for v in (*flag.true_values, *flag.false_values)):
            problems.append(f"boolean_fields.{raw}: values must be quoted text")
    if entity in CANONICAL and (row_id := CANONICAL[entity].row_id) not in spec.required_fields:
        problems.append(f"required_fields lacks {row_id!r}: rows without it would be taken for one")
    return problems + _lost_values(spec) + _unresolved_names(spec)


def pattern_fault(pattern: Any) -> str | None:
    """Why Spark could not read times with this pattern, as far as its letters tell."""
    if not isinstance(pattern, str) or not pattern:
        return "is no pattern"
    plain = re.sub(r"'[^']*'", "", pattern)
    if "'" in plain:
        return "has a quote that does not end"
    if any(c in plain for c in "{}#"):
        return "has a reserved character"
    depth = 0
    for c in plain:
        depth += (c == "[") - (c == "]")
        if depth < 0:
            break
    if depth:
        return "has a bracket without the other"
    for run in re.finditer(r"([A-Za-z])\1*", plain):
        letter, n = run.group(1), len(run.group())
        if letter not in PATTERN_LETTERS:
            return f"has the letter {letter!r}, which cannot be parsed"
        if n > PATTERN_LETTERS[letter] or (letter == "V" and n != 2) or (letter == "O" and n not in (1, 4)):
            return f"repeats the letter {letter!r} {n} times"
    return None


def _lost_values(spec: FeedSpec) -> list[str]:
    """Targets that a later step gives a second value, so that the first is gone.

    A step may go on with what it reads itself, and a constant currency replaces one.
    """
    steps = [
        *spec.column_map.items(),
        *((raw, date.target) for raw, date in spec.date_fields.items()),
        *spec.int_fields.items(),
        *spec.decimal_fields.items(),
        *((raw, flag.target) for raw, flag in spec.boolean_fields.items()),
    ]
    made: set[str] = set()
    problems = []
    for raw, target in steps:
        if target.lower() in made and raw.lower() != target.lower():
            problems.append(f"target {target!r} is made twice: {raw!r} replaces what was there")
        made.add(target.lower())
    return problems


def _repeated(names: Iterable[str]) -> list[str]:
    seen: set[str] = set()
    return [n for n in names if n.lower() in seen or seen.add(n.lower())]


def _unresolved_names(spec: FeedSpec) -> list[str]:
    """Names a step reads although neither the file nor an earlier step has them."""
    known = {n.lower() for n in (*spec.columns, *SYSTEM_COLUMNS, "client_id")}
    problems: list[str] = []

    def step(section: str, targets: Mapping[str, str]) -> None:
        for raw, target in targets.items():
            if raw.lower() not in known:
                problems.append(f"{section} reads unknown column {raw!r}")
            known.add(target.lower())

    step("column_map", spec.column_map)
    if spec.special_transform is not None:
        if spec.special_transform not in TRANSFORMS:
            return [*problems, f"special_transform {spec.special_transform!r} is not registered"]
        if spec.special_transform not in TRANSFORM_OUTPUTS:
            return problems  # its columns are known only once it runs
        known.update(TRANSFORM_OUTPUTS[spec.special_transform])
    step("date_fields", {raw: d.target for raw, d in spec.date_fields.items()})
    step("int_fields", spec.int_fields)
    step("decimal_fields", spec.decimal_fields)
    step("boolean_fields", {raw: f.target for raw, f in spec.boolean_fields.items()})
    if spec.default_currency is not None:
        known.add("currency")
    problems += [f"required field {n!r} is never produced" for n in spec.required_fields if n.lower() not in known]
    return problems
