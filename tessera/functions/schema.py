"""The schema language: YAML fields to JSON Schema, instructions, Spark types and checks."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Type spellings with their JSON type, Spark type, and whether a value may be missing.
SCALARS = {
    "str": ("string", T.StringType(), False),
    "str?": ("string", T.StringType(), True),
    "int": ("integer", T.LongType(), False),
    "int?": ("integer", T.LongType(), True),
    "float": ("number", T.DoubleType(), False),
    "float?": ("number", T.DoubleType(), True),
}
#: Constraint names in JSON Schema.
BOUNDS = {"ge": "minimum", "le": "maximum", "gt": "exclusiveMinimum", "lt": "exclusiveMaximum"}
#: Fields of one chunk that never enter a document's table.
CHUNK_ONLY = ("thinking", "llm_commentary", "confidence_score")


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "str?"
    description: str = ""
    constraints: dict[str, Any] = field(default_factory=dict)
    merge: str = ""
    identity: str | None = None
    fields: tuple["Field", ...] = ()

    @property
    def is_entity(self) -> bool:
        return self.type == "list[object]"

    @property
    def is_list(self) -> bool:
        return self.type == "list[str]"

    @property
    def required(self) -> bool:
        return self.type in SCALARS and not SCALARS[self.type][2]


def parse_field(spec: dict[str, Any], nested: bool = False) -> Field:
    kind = spec.get("type", "str?")
    if kind == "list[object]":
        if nested:
            raise ValueError(f"field {spec['name']!r}: objects nest one level only")
    elif kind != "list[str]" and kind not in SCALARS:
        raise ValueError(f"Unknown type {kind!r} of field {spec.get('name')!r}")
    inner = tuple(parse_field(x, True) for x in spec.get("fields", ())) if kind == "list[object]" else ()
    return Field(spec["name"], kind, spec.get("description", ""), dict(spec.get("constraints") or {}), spec.get("merge", ""), spec.get("identity"), inner)


class Schemas:
    """Sections of fields, "core" and one per genre."""

    def __init__(self, config: dict[str, Any]):
        schemas = config.get("schemas") or {}
        self.sections = {**{k: v or {} for k, v in (schemas.get("genres") or {}).items()}, "core": schemas.get("core") or {}}

    def fields(self, section: str) -> list[Field]:
        return [parse_field(x) for x in self.sections.get(section, {}).get("fields", [])]

    def prompt_suffix(self, genre: str) -> str:
        return self.sections.get(genre, {}).get("system_prompt_suffix", "") or ""

    def combined(self, core: bool = True, genre: str | None = None) -> list[Field]:
        out = (self.fields("core") if core else []) + (self.fields(genre) if genre else [])
        names = [f.name for f in out]
        if len(set(names)) < len(names):
            raise ValueError(f"a field is declared twice: {sorted(n for n in set(names) if names.count(n) > 1)}")
        return out

    def json_schema(self, core: bool = True, genre: str | None = None) -> dict[str, Any]:
        return object_schema(self.combined(core, genre))

    def instructions(self, core: bool = True, genre: str | None = None) -> str:
        """What the prompt says about the fields. Its wording is a fixed value."""
        parts = []
        if core and self.fields("core"):
            parts += ["### Core（必填）", *map(instruction, self.fields("core"))]
        if genre and self.fields(genre):
            parts += [f"### {genre.capitalize()} Genre（{genre}領域）", *map(instruction, self.fields(genre))]
        return "\n".join(parts)


def instruction(f: Field) -> str:
    line = f"- {f.name}: {f.description}"
    return line + f"（每筆包含：{'、'.join(n.name for n in f.fields)}）" if f.is_entity else line


def property_of(f: Field) -> dict[str, Any]:
    if f.is_entity:
        return {"type": "array", "items": object_schema(list(f.fields)), "description": f.description}
    if f.is_list:
        out: dict[str, Any] = {"type": "array", "items": {"type": "string"}, "description": f.description}
    else:
        kind, _, optional = SCALARS[f.type]
        out = {"type": [kind, "null"] if optional else kind, "description": f.description}
    out |= {BOUNDS[k]: v for k, v in f.constraints.items() if k in BOUNDS}
    if "default" in f.constraints:
        out["default"] = f.constraints["default"]
    return out


def object_schema(fields: list[Field]) -> dict[str, Any]:
    out: dict[str, Any] = {"type": "object", "properties": {f.name: property_of(f) for f in fields}}
    needed = [f.name for f in fields if f.required]
    return out | ({"required": needed} if needed else {})


def spark_type(f: Field) -> T.DataType:
    if f.is_entity:
        return T.ArrayType(struct_type(list(f.fields)))
    return T.ArrayType(T.StringType()) if f.is_list else SCALARS[f.type][1]


def struct_type(fields: list[Field]) -> T.StructType:
    return T.StructType([T.StructField(f.name, spark_type(f), not f.required) for f in fields])


def violations(value: Column, fields: list[Field]) -> Column:
    """Names of the fields of a parsed struct that are missing or outside their bounds (strict mode)."""
    checks = []
    for f in fields:
        x = value[f.name]
        bad = x.isNull() if f.required and "default" not in f.constraints else F.lit(False)
        for k, test in (("ge", x < F.lit(f.constraints.get("ge"))), ("le", x > F.lit(f.constraints.get("le"))), ("gt", x <= F.lit(f.constraints.get("gt"))), ("lt", x >= F.lit(f.constraints.get("lt")))):
            if k in f.constraints:
                bad = bad | F.coalesce(test, F.lit(False))
        checks.append(F.when(bad, F.lit(f.name)))
    return F.array_compact(F.array(*checks))


def ddl(section: str, fields: list[Field]) -> str:
    """A section as a CREATE TABLE column list, one line a field; what the drift check compares."""
    name = re.sub(r"\W", "_", section)
    lines = [f"  {f.name} {spark_type(f).simpleString()}{' NOT NULL' if f.required else ''} COMMENT '{f.description.replace(chr(39), chr(39) * 2)}'" for f in fields]
    return f"-- {name}\n(\n" + ",\n".join(lines) + "\n)\n"


def chunk_table(spec: dict[str, str]) -> T.StructType:
    """A source's ``schema:`` map of name to str, int or float."""
    return T.StructType([T.StructField(n, SCALARS[k][1]) for n, k in spec.items()])
