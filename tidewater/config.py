"""Run parameters and source-to-target mappings (plain config objects, no I/O)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

DEFAULT_JOB_ID = "interactive"


@dataclass(frozen=True)
class RunConfig:
    """Parameters of one pipeline run.

    ``as_of`` / ``run_ts`` are injected (never read from the clock inside transforms) so
    a run can be replayed and checked against an oracle.
    """

    base_path: str
    bronze_path: str | None = None
    silver_path: str | None = None
    gold_path: str | None = None
    job_id: str = DEFAULT_JOB_ID
    as_of: dt.date = field(default_factory=dt.date.today)
    run_ts: dt.datetime = field(default_factory=lambda: dt.datetime.now().replace(microsecond=0))
    snapshot: bool = False

    def __post_init__(self):
        if not self.base_path or not str(self.base_path).strip():
            raise ValueError("base_path must not be blank")
        for name in ("bronze_path", "silver_path", "gold_path"):
            v = getattr(self, name)
            if v is not None and not str(v).strip():
                raise ValueError(f"{name} must not be blank")

    def layer(self, name: str) -> str:
        explicit = getattr(self, f"{name}_path", None)
        return explicit or f"{self.base_path.rstrip('/')}/{name}"

    @property
    def run_id(self) -> str:
        return self.run_ts.strftime("%Y%m%d_%H%M%S")


@dataclass(frozen=True)
class SourceMapping:
    """How one source's columns land in the conformed (target) schema.

    ``columns`` maps target column -> source column name or ``None`` (typed NULL);
    ``constants`` maps target column -> literal value.
    """

    source: str
    columns: dict[str, str | None]
    constants: dict[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class AttributeMap:
    """Concept-level map between two sources (documentation + conform driver)."""

    concept: str
    left: str | None
    right: str | None


def attribute_map(left: SourceMapping, right: SourceMapping) -> list[AttributeMap]:
    """Concept-by-concept source-to-target map of two sources (the mapping workbook)."""
    concepts = list(dict.fromkeys([*left.columns, *right.columns]))
    return [AttributeMap(c, left.columns.get(c), right.columns.get(c)) for c in concepts]
