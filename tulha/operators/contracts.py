"""Data contracts as Avro schema text: how rows written under one schema are read under another."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The format's types as Spark's, and what each may be promoted to.
SPARK_TYPES = {"boolean": "boolean", "int": "int", "long": "bigint", "float": "float", "double": "double", "bytes": "binary", "string": "string"}
LOGICAL_TYPES = {("int", "date"): "date", ("long", "timestamp-millis"): "timestamp", ("long", "timestamp-micros"): "timestamp"}
PROMOTIONS = {"int": {"long", "float", "double"}, "long": {"float", "double"}, "float": {"double"}, "string": {"bytes"}, "bytes": {"string"}}
COMPATIBLE, PROMOTED, DEFAULTED, REFUSED, IGNORED = "compativel", "promovida", "preenchida", "recusada", "ignorada"


@dataclass(frozen=True)
class Verdict:
    """What becomes of one column: where it comes from, its Spark type, and why it is refused."""

    column: str
    verdict: str
    source: str | None = None
    type_name: str | None = None
    default: object = None
    required: bool = False
    reason: str | None = None


@dataclass(frozen=True)
class _Kind:
    name: str
    logical: str | None
    nullable: bool

    @property
    def spark(self) -> str:
        return LOGICAL_TYPES.get((self.name, self.logical), SPARK_TYPES[self.name])


def _kind(declared: object, column: str) -> _Kind:
    """A primitive type, or a union of one with null."""
    options = declared if isinstance(declared, list) else [declared]
    named = [(t, None) if isinstance(t, str) else (t.get("type"), t.get("logicalType")) for t in options]
    own = [n for n in named if n[0] != "null"]
    if len(own) != 1 or own[0][0] not in SPARK_TYPES:
        raise ValueError(f"{column}: a column is one primitive type, or a union of one with null, not {json.dumps(declared)}")
    return _Kind(*own[0], nullable=len(own) < len(named))


def _fields(text: str) -> dict[str, dict]:
    schema = json.loads(text)
    if not isinstance(schema, dict) or schema.get("type") != "record":
        raise ValueError("a contract is a record")
    return {f["name"]: f for f in schema["fields"]}


def resolve(writer: str, reader: str) -> list[Verdict]:
    """A verdict per column of the reader, in its order, then per writer's column that the reader does not ask for.

    A reader's column is found under its name, else under one of its aliases. It
    is compatible if the types are equal, promoted if the reader's is wider, and
    filled with its default if the writer lacks it. A column without default, of
    a type that can't be promoted, or that may be null where the reader has no
    null, is refused; the last kind alone is checked row by row in `read_as`.
    """
    written, wanted = _fields(writer), _fields(reader)
    verdicts, used = [], set()
    for name, field in wanted.items():
        kind = _kind(field["type"], name)
        source = next((n for n in (name, *field.get("aliases", [])) if n in written), None)
        if source is None:
            if "default" in field:
                verdicts.append(Verdict(name, DEFAULTED, None, kind.spark, field["default"]))
            else:
                verdicts.append(Verdict(name, REFUSED, reason="ausente, sem valor padrao"))
            continue
        used.add(source)
        held = _kind(written[source]["type"], source)
        required = held.nullable and not kind.nullable
        if (held.name, held.logical) == (kind.name, kind.logical):
            verdicts.append(Verdict(name, COMPATIBLE, source, kind.spark, required=required))
        elif kind.name in PROMOTIONS.get(held.name, ()) and kind.logical is None and held.logical is None:
            verdicts.append(Verdict(name, PROMOTED, source, kind.spark, required=required))
        else:
            verdicts.append(Verdict(name, REFUSED, source, reason=f"tipo {held.spark}, esperado {kind.spark}"))
    return verdicts + [Verdict(name, IGNORED, name) for name in written if name not in used]


def _column(v: Verdict) -> Column:
    value = F.lit(v.default) if v.source is None else F.col(f"`{v.source}`")
    return value.cast(v.type_name).alias(v.column)


def read_as(df: DataFrame, verdicts: Sequence[Verdict]) -> DataFrame:
    """Rows as the reader declares them, but for refused columns; a projection, so unused columns are not read.

    Rows that hold NULL where the reader has none are left out; `refused_rows` has them.
    """
    kept = [v for v in verdicts if v.verdict in (COMPATIBLE, PROMOTED, DEFAULTED)]
    return df.where(~_lacking(verdicts)).select(*map(_column, kept))


def refused_rows(df: DataFrame, verdicts: Sequence[Verdict]) -> DataFrame:
    """The original rows that `read_as` leaves out."""
    return df.where(_lacking(verdicts))


def _lacking(verdicts: Sequence[Verdict]) -> Column:
    lacking = F.lit(False)
    for v in verdicts:
        if v.required:
            lacking = lacking | F.isnull(F.col(f"`{v.source}`"))
    return lacking


def require(verdicts: Sequence[Verdict]) -> None:
    """Raise if any column is refused, naming each with its reason."""
    refused = [f"{v.column}: {v.reason}" for v in verdicts if v.verdict == REFUSED]
    if refused:
        raise ValueError("the contract is not met: " + "; ".join(refused))
