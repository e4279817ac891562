"""A dataset as declared: columns with kinds, aliases, maps, fills and thresholds."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

from loomtab.functions.casts import KINDS, kind_type

#: Columns that the engine itself adds.
GENERATED = ("_source_file", "_ingested_at", "row_id")


def to_snake_case(name: str) -> str:
    """CamelCase is one word; a snake name has lower-case letters, digits and single underscores."""
    return re.sub("[^A-Za-z0-9]+", "_", str(name)).strip("_").lower()


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: str = "string"
    nullable: bool = True
    primary_key: bool = False
    null_strings: tuple[str, ...] = ()
    fill_strategy: str | None = None
    max_null_rate: float | None = None
    allowed_values: tuple[Any, ...] = ()

    @classmethod
    def of(cls, name: str, said: Any) -> ColumnSpec:
        said = said if isinstance(said, Mapping) else {"dtype": said}
        dtype = said.get("dtype")
        return cls(name, dtype if dtype in KINDS else "string", bool(said.get("nullable", True)), bool(said.get("primary_key", False)), tuple(said.get("null_strings") or ()), said.get("fill_strategy"), said.get("max_null_rate"), tuple(said.get("allowed_values") or ()))


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    aliases: Mapping[str, str] = field(default_factory=dict)
    value_maps: Mapping[str, Mapping[str, str | None]] = field(default_factory=dict)
    max_null_rate: float = 1.0
    max_duplicate_rate: float = 1.0
    min_row_count: int = 0
    combine_key: str | None = None

    def __post_init__(self) -> None:
        names = [c.name for c in self.columns]
        if len(set(names)) != len(names):
            raise ValueError(f"{self.name}: a column is declared twice")
        for c in self.columns:
            if c.fill_strategy == "fill_zero" and c.dtype not in ("int64", "float64"):
                raise ValueError(f"{self.name}.{c.name}: fill_zero needs a number")

    @classmethod
    def from_dict(cls, name: str, said: Mapping[str, Any]) -> DatasetSpec:
        """columns may be a mapping of name to attributes (or to a dtype), or a list of mappings with a name."""
        raw = (said.get("schema") or said).get("columns") or {}
        items = raw.items() if isinstance(raw, Mapping) else [(c["name"], c) for c in raw]
        limits = said.get("validation") or {}
        return cls(name, tuple(ColumnSpec.of(n, c) for n, c in items), dict(said.get("aliases") or {}), {c: m for c, m in (said.get("value_maps") or {}).items() if isinstance(m, Mapping)}, float(limits.get("max_null_rate", 1.0)), float(limits.get("max_duplicate_rate", 1.0)), int(limits.get("min_row_count", 0)), (said.get("combine") or {}).get("primary_key"))

    @classmethod
    def from_yaml(cls, name: str, text: str) -> DatasetSpec:
        import yaml

        return cls.from_dict(name, yaml.safe_load(text) or {})

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def declared(self) -> list[str]:
        """Columns that a source must bring."""
        return [c.name for c in self.columns if c.name not in GENERATED]

    def column(self, name: str) -> ColumnSpec:
        return next(c for c in self.columns if c.name == name)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, kind_type(c.dtype)) for c in self.columns])

    def key(self) -> list[str]:
        return [self.combine_key] if self.combine_key else [c.name for c in self.columns if c.primary_key]

    def required(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable or c.primary_key]
