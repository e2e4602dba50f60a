"""Contracts of the published marts: columns, types, keys and control sums."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql.types import StructType

DEFAULT_FILE = Path(__file__).with_name("marts.json")
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def identifier(value: str) -> str:
    """The value, if it is safe to use as a name in SQL."""
    if not IDENTIFIER.fullmatch(value):
        raise ValueError(f"not an identifier: {value!r}")
    return value


@dataclass(frozen=True)
class MartSpec:
    model: str
    layer: str
    table: str
    schema: StructType
    unique_key: tuple[str, ...]
    sum_columns: tuple[str, ...]
    sort_key: tuple[str, ...]
    unsigned: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def required(self) -> list[str]:
        return [field.name for field in self.schema.fields if not field.nullable]


def read_schema(folder: Path, file_name: str) -> StructType:
    """Columns of a mart; their names are safe and all different."""
    if Path(file_name).name != file_name or not file_name.endswith(".ddl"):
        raise ValueError(f"not a schema file name: {file_name!r}")
    path = folder / file_name
    if not path.is_file():
        raise ValueError(f"schema file is missing: {file_name}")
    schema = StructType.fromDDL(path.read_text())
    names = [identifier(name) for name in schema.names]
    if len(set(names)) < len(names):
        raise ValueError(f"{file_name} lists a column twice")
    return schema


def parse_spec(entry: dict, folder: Path) -> MartSpec:
    for key in ("model", "layer", "table"):
        identifier(entry[key])
    schema = read_schema(folder, entry["schema_file"])
    lists = {key: tuple(entry[key]) for key in ("unique_key", "sum_columns", "sort_key", "unsigned")}
    if not lists["unique_key"]:
        raise ValueError(f"{entry['model']} has no unique key")
    for key, names in lists.items():
        unknown = set(names) - set(schema.names)
        if unknown:
            raise ValueError(f"{key} of {entry['model']} names unknown columns: {sorted(unknown)}")
    return MartSpec(entry["model"], entry["layer"], entry["table"], schema, **lists)


def load_marts(path: Path | str = DEFAULT_FILE) -> dict[str, MartSpec]:
    """Mart specs by model name; any breach of the rules is an error."""
    path = Path(path)
    specs = [parse_spec(entry, path.parent) for entry in json.loads(path.read_text())["marts"]]
    if not specs:
        raise ValueError("no marts are configured")
    targets = [(spec.layer, spec.table) for spec in specs]
    if len(set(targets)) < len(targets):
        raise ValueError("two marts have the same target table")
    return {spec.model: spec for spec in specs}
