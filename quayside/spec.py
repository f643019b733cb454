"""Load specification: the parameters of one load, parsed and checked."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, fields
from datetime import date, datetime
from typing import Any, NamedTuple

from pyspark.sql import SparkSession

from .functions.shift import Shift, parse_shifts

Hook = str | Callable[[SparkSession], None] | None

_RUN_DATE = "?date"
COMMITS = ("partition", "batch")


class Constant(NamedTuple):
    """A constant column: fixed text, or text around the (shifted) run date."""

    name: str
    text: str
    shifts: tuple[Shift, ...] = ()

    @property
    def dated(self) -> bool:
        return _RUN_DATE in self.text


def parse_pairs(text: str) -> dict[str, str]:
    """``A=x,B=y`` as a dict; what follows a second ``=`` is dropped, the last name wins."""
    pairs = {}
    for item in filter(None, text.split(",")):
        name, *rest = item.split("=")
        if not name or not rest:
            raise ValueError(f"expected NAME=VALUE, got {item!r}")
        pairs[name] = rest[0]
    return pairs


def parse_map(text: str) -> dict[str, str]:
    """Conversion map ``COL=rule,COL=rule``."""
    return parse_pairs(text)


def parse_constants(text: str) -> list[Constant]:
    """Constant columns ``A=x,B=?date,C=?date[-1month][+1day]``."""
    return [_constant(name, value) for name, value in parse_pairs(text).items()]


def _constant(name: str, value: str) -> Constant:
    if "?" in value and "[" in value:
        head, bracket, chain = value.partition("[")
        if head != _RUN_DATE:
            raise ValueError(f"constant {name!r}: a date shift needs exactly ?date before it")
        return Constant(name, head, tuple(parse_shifts(bracket + chain)))
    return Constant(name, value)


def match_columns(
    wanted: Iterable[str], columns: Iterable[str], what: str
) -> dict[str, str]:
    """``wanted`` name -> actual column name, ignoring case; warns about unknown names."""
    actual = {c.lower(): c for c in columns}
    found = {w: actual[w.lower()] for w in wanted if w.lower() in actual}
    unknown = [w for w in wanted if w not in found]
    if unknown:
        warnings.warn(f"{what}: no such column {', '.join(unknown)}", stacklevel=3)
    return found


def resolve_path(
    spark: SparkSession, root: str, expression: str, run_at: datetime | None = None
) -> str:
    """Source path of a run.

    ``/in/@format/x_@format.parquet,[yyyyMMdd,HHmm]``: everything up to the
    first comma, each ``@format`` in turn replaced by the run time in the next
    pattern.  Without a pattern list, or without a run time, the template is
    the path.
    """
    template = root + expression
    opening = template.find("[")
    if run_at is None or opening <= 0:
        return template
    path, comma, _ = template.partition(",")
    if not comma or "]" not in template:
        raise ValueError(f"path template {expression!r}: expected path,[pattern,...]")
    patterns = template[opening + 1 : template.rindex("]")].split(",")
    # a local time: the session's zone and its gaps have no say in it
    time = spark._jvm.java.time
    at = time.LocalDateTime.of(
        run_at.year, run_at.month, run_at.day, run_at.hour, run_at.minute, run_at.second
    )
    for pattern in patterns:
        part = at.format(time.format.DateTimeFormatter.ofPattern(pattern))
        path = path.replace("@format", part, 1)
    return path


@dataclass(frozen=True)
class LoadSpec:
    """One load.  Names in ``from_params`` are the field names with hyphens."""

    root: str = ""
    source_file_expression: str = ""
    data_type: str = "PARQUET"
    file_filter: str = ""
    date: datetime | None = None
    with_log: int = 0
    ledger_path: str | None = None
    insert_batch_size: int = 10_000
    submit_thread_count: int | None = None
    map_data_fields: str = ""
    custom_column: str = ""
    mode_type: int = 0
    script_before: Hook = None
    script_after: Hook = None
    on_error: Hook = None
    source_columns: str = "*"
    partition_on: str | None = None
    read_partitions: int | None = None
    equal_rows: int = 0
    predicates: tuple[str, ...] = ()
    commit: str = "partition"
    # settings of this library
    merge_schema: bool = False
    rejects_path: str | None = None
    key_columns: str = ""
    column_width: int | None = None
    verify_files: bool = False
    arrivals_path: str | None = None
    int96_noon: bool = False
    wave_files: int = 10_000

    # accepted, without effect: Spark splits input and prunes columns itself
    all_schema: int = 0
    fields_case: str = "exact"

    def __post_init__(self) -> None:
        if self.with_log > 0 and not self.ledger_path:
            raise ValueError("with_log needs ledger_path")
        if self.keys and not self.rejects_path:
            raise ValueError("key_columns needs rejects_path")
        if (self.verify_files or self.arrivals_path) and self.with_log <= 0:
            raise ValueError("verify_files and arrivals_path need with_log")
        if self.wave_files < 1:
            raise ValueError("wave_files must be at least 1")
        if self.commit not in COMMITS:
            raise ValueError(f"commit must be one of {COMMITS}, got {self.commit!r}")
        # bad specs fail here, before anything is read or written
        if any(c.dated for c in self.constants) and self.date is None:
            raise ValueError("a constant uses ?date but the load has no date")
        _ = self.rules

    @property
    def rules(self) -> dict[str, str]:
        return parse_map(self.map_data_fields)

    @property
    def constants(self) -> list[Constant]:
        return parse_constants(self.custom_column)

    @property
    def name_parts(self) -> list[str]:
        return [p for p in self.file_filter.split(",") if p]

    @property
    def keys(self) -> list[str]:
        return [k for k in self.key_columns.split(",") if k]

    @property
    def staged(self) -> bool:
        """Whether converted rows are written to a stage first, since more than one thing is made of them."""
        return self.rejects_path is not None or self.verify_files

    @property
    def run_date(self) -> date | None:
        return self.date.date() if self.date else None

    @property
    def order(self) -> str:
        """Bulk modes follow the destination's column order."""
        return "target" if self.mode_type in (1, 4) else "source"

    @property
    def bulk(self) -> bool:
        return self.mode_type in (1, 4, 5)

    @classmethod
    def from_params(cls, params: Mapping[str, Any], **extra: Any) -> LoadSpec:
        """Spec from hyphenated parameters; connection parameters are left alone."""
        known = {f.name for f in fields(cls)}
        taken = {k.replace("-", "_"): v for k, v in params.items()}
        taken = {k: v for k, v in taken.items() if k in known}
        if isinstance(taken.get("date"), str):
            taken["date"] = datetime.fromisoformat(taken["date"])
        for f in fields(cls):
            if f.name in taken and taken[f.name] is not None and f.type in ("int", "int | None"):
                taken[f.name] = int(taken[f.name])
        if isinstance(taken.get("predicates"), str):
            taken["predicates"] = tuple(filter(None, taken["predicates"].split(";")))
        return cls(**{**taken, **extra})
