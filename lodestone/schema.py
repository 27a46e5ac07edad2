"""Typed index schemas over DataFrames: fields, YAML, inference, validation."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from typing import Any

import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Field types, vector element types, metrics and compressions that schemas may name (fixed values).
FIELD_TYPES = ("text", "tag", "numeric", "geo", "vector")
VECTOR_TYPES = ("bfloat16", "float16", "float32", "float64", "int8", "uint8")
METRICS = ("cosine", "l2", "ip")
ALGORITHMS = ("flat", "hnsw", "svs-vamana")
COMPRESSIONS = ("LVQ4", "LVQ4x4", "LVQ4x8", "LVQ8", "LeanVec4x8", "LeanVec8x8")

#: Attributes of each field type with their defaults (fixed values).
BASE_DEFAULTS = {"sortable": False, "index_missing": False, "no_index": False}
TYPE_DEFAULTS: dict[str, dict[str, Any]] = {
    "text": {"weight": 1.0, "no_stem": False, "withsuffixtrie": False, "phonetic_matcher": None, "index_empty": False, "unf": False},
    "tag": {"separator": ",", "case_sensitive": False, "withsuffixtrie": False, "index_empty": False},
    "numeric": {"unf": False},
    "geo": {},
    "vector": {"algorithm": "flat", "datatype": "float32", "distance_metric": "cosine", "dims": None, "index_missing": False},
}
ALGORITHM_DEFAULTS: dict[str, dict[str, Any]] = {
    "flat": {"initial_cap": None, "block_size": None},
    "hnsw": {"initial_cap": None, "m": 16, "ef_construction": 200, "ef_runtime": 10, "epsilon": 0.01},
    "svs-vamana": {"graph_max_degree": 40, "construction_window_size": 250, "search_window_size": 20, "epsilon": 0.01, "compression": None, "reduce": None, "training_threshold": None},
}


class SchemaError(ValueError):
    """A schema that contradicts itself, or data that contradicts its schema."""


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    path: str | None = None
    attrs: dict[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.type not in FIELD_TYPES:
            raise SchemaError(f"unknown field type {self.type!r}")
        merged = {**BASE_DEFAULTS, **TYPE_DEFAULTS[self.type]}
        if self.type == "vector":
            algorithm = str(self.attrs.get("algorithm", "flat")).lower()
            if algorithm not in ALGORITHMS:
                raise SchemaError(f"unknown vector algorithm {algorithm!r}")
            merged.update(ALGORITHM_DEFAULTS[algorithm])
        merged.update(self.attrs)
        if self.type == "vector":
            for key in ("algorithm", "datatype", "distance_metric"):
                merged[key] = str(merged[key]).lower()
            _check_vector(self.name, merged)
        object.__setattr__(self, "attrs", merged)

    def __getattr__(self, key: str) -> Any:
        try:
            return self.__dict__["attrs"][key]
        except KeyError:
            raise AttributeError(key) from None

    def to_dict(self) -> dict[str, Any]:
        own = {k: v for k, v in self.attrs.items() if v is not None}
        return {"name": self.name, "type": self.type, **({"path": self.path} if self.path else {}), "attrs": own}


def _check_vector(name: str, a: dict[str, Any]) -> None:
    if not isinstance(a["dims"], int) or a["dims"] < 1:
        raise SchemaError(f"{name}: dims must be a positive integer")
    if a["datatype"] not in VECTOR_TYPES:
        raise SchemaError(f"{name}: unknown datatype {a['datatype']!r}")
    if a["distance_metric"] not in METRICS:
        raise SchemaError(f"{name}: unknown metric {a['distance_metric']!r}")
    if a["algorithm"] == "svs-vamana":
        if a["datatype"] not in ("float16", "float32"):
            raise SchemaError(f"{name}: svs-vamana takes float16 or float32")
        if a["compression"] is not None and a["compression"] not in COMPRESSIONS:
            raise SchemaError(f"{name}: unknown compression {a['compression']!r}")
        if a["reduce"] is not None:
            if not str(a["compression"]).startswith("LeanVec"):
                raise SchemaError(f"{name}: reduce needs a LeanVec compression")
            if a["reduce"] >= a["dims"]:
                raise SchemaError(f"{name}: reduce must be less than dims")


@dataclass(frozen=True)
class IndexInfo:
    name: str
    prefix: str | list[str] = "doc"
    key_separator: str = ":"
    storage_type: str = "hash"
    stopwords: list[str] | None = None

    @property
    def prefixes(self) -> list[str]:
        return [self.prefix] if isinstance(self.prefix, str) else list(self.prefix)

    def key(self, ident: str) -> str:
        """Prefix and id with one separator; an empty prefix gives the id alone."""
        head = self.prefixes[0].rstrip(self.key_separator) if self.key_separator else self.prefixes[0]
        return f"{head}{self.key_separator}{ident}" if head else ident

    def key_column(self, ident: Column) -> Column:
        head = self.prefixes[0].rstrip(self.key_separator) if self.key_separator else self.prefixes[0]
        return F.concat(F.lit(head + self.key_separator), ident.cast("string")) if head else ident.cast("string")


@dataclass(frozen=True)
class IndexSchema:
    index: IndexInfo
    fields: dict[str, Field] = field(default_factory=dict)
    version: str = "0.1.0"

    @classmethod
    def from_dict(cls, d: dict[str, Any]) -> IndexSchema:
        info = dict(d.get("index") or {})
        if not info.get("name"):
            raise SchemaError("the index needs a name")
        listed = d.get("fields") or []
        if isinstance(listed, dict):
            listed = [{"name": k, **v} for k, v in listed.items()]
        out = cls(IndexInfo(**{k: v for k, v in info.items() if k in IndexInfo.__dataclass_fields__}), {}, d.get("version", "0.1.0"))
        return out.add_fields(listed)

    @classmethod
    def from_yaml(cls, path: str) -> IndexSchema:
        with open(path, encoding="utf-8") as f:
            return cls.from_dict(yaml.safe_load(f))

    @classmethod
    def from_struct_type(cls, name: str, struct: T.StructType, dims: dict[str, int] | None = None, **index: Any) -> IndexSchema:
        """The schema of column types: numbers, arrays of numbers as vectors of the given ``dims`` (left out without), structs lon/lat as geo,
        arrays of strings as tags."""
        fields = []
        for f in struct.fields:
            kind = _kind(f.dataType)
            if kind == "vector":
                if (dims or {}).get(f.name):
                    wide = "float64" if isinstance(f.dataType.elementType, T.DoubleType) else "float32"
                    fields.append({"name": f.name, "type": kind, "attrs": {"dims": dims[f.name], "datatype": wide}})
            elif kind:
                fields.append({"name": f.name, "type": kind})
        return cls.from_dict({"index": {"name": name, **index}, "fields": fields})

    @classmethod
    def from_table(cls, name: str, df: DataFrame, **index: Any) -> IndexSchema:
        """As ``from_struct_type``; a vector has as many dimensions as most of its values."""
        vectors = [f.name for f in df.schema.fields if _kind(f.dataType) == "vector"]
        dims = df.agg(*[F.mode(F.when(F.size(v) > 0, F.size(v))).alias(v) for v in vectors]).first().asDict() if vectors else {}
        return cls.from_struct_type(name, df.schema, dims, **index)

    def to_dict(self) -> dict[str, Any]:
        i = self.index
        info = {"name": i.name, "prefix": i.prefix, "key_separator": i.key_separator, "storage_type": i.storage_type}
        if i.stopwords is not None:
            info["stopwords"] = i.stopwords
        return {"index": info, "fields": [f.to_dict() for f in self.fields.values()], "version": self.version}

    def to_yaml(self, path: str, overwrite: bool = True) -> None:
        with open(path, "w" if overwrite else "x", encoding="utf-8") as f:
            yaml.safe_dump(self.to_dict(), f, sort_keys=False)

    def add_field(self, spec: dict[str, Any] | Field) -> IndexSchema:
        f = spec if isinstance(spec, Field) else Field(spec["name"], str(spec["type"]).lower(), spec.get("path"), dict(spec.get("attrs") or {}))
        if f.name in self.fields:
            raise SchemaError(f"duplicate field {f.name!r}")
        if self.index.storage_type == "json" and f.path is None:
            f = Field(f.name, f.type, f"$.{f.name}", f.attrs)
        return replace(self, fields={**self.fields, f.name: f})

    def add_fields(self, specs: list[dict[str, Any] | Field]) -> IndexSchema:
        out = self
        for s in specs:
            out = out.add_field(s)
        return out

    def remove_field(self, name: str) -> IndexSchema:
        return replace(self, fields={k: v for k, v in self.fields.items() if k != name})

    def generate_fields(self, df: DataFrame) -> list[dict[str, Any]]:
        """Field definitions inferred from column types and, for strings, from all values that are not null: numeric, then geo ("lon,lat"),
        then tag (lists of strings), then text. One aggregate over the strings."""
        kinds = {f.name: _kind(f.dataType) for f in df.schema.fields}
        strings = [n for n, k in kinds.items() if k == "text"]
        if strings:
            numbers = [F.every(F.col(n).try_cast("double").isNotNull() | F.col(n).isNull()).alias(f"n{i}") for i, n in enumerate(strings)]
            points = [F.every(F.col(n).rlike(POINT.pattern)).alias(f"p{i}") for i, n in enumerate(strings)]
            r = df.agg(*numbers, *points, *[F.count(n).alias(f"c{i}") for i, n in enumerate(strings)]).first()
            for i, n in enumerate(strings):
                if r[f"c{i}"]:
                    kinds[n] = "numeric" if r[f"n{i}"] else "geo" if r[f"p{i}"] else "text"
        return [{"name": n, "type": k} for n, k in kinds.items() if k]

    def to_struct_type(self) -> T.StructType:
        kinds = {"text": T.StringType(), "tag": T.ArrayType(T.StringType()), "numeric": T.DoubleType(), "vector": T.ArrayType(T.FloatType())}
        geo = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])
        return T.StructType([T.StructField(f.name, kinds.get(f.type, geo)) for f in self.fields.values()])

    def errors(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_errors``: what is wrong with each row, in one projection; an empty array where nothing is."""
        checks = []
        for f in self.fields.values():
            if f.name not in df.columns:
                continue
            kind, c = df.schema[f.name].dataType, F.col(f.name)
            if f.type == "numeric" and not isinstance(kind, T.NumericType):
                bad = F.lit(True) if isinstance(kind, T.BooleanType) else c.cast("string").try_cast("double").isNull()
                checks.append(F.when(c.isNotNull() & bad, F.lit(f"{f.name}: not a number")))
            elif f.type == "vector":
                if isinstance(kind, T.BinaryType):
                    width = {"float64": 8, "float32": 4, "float16": 2, "bfloat16": 2, "int8": 1, "uint8": 1}[f.datatype] * f.dims
                    checks.append(F.when(F.octet_length(c) != width, F.lit(f"{f.name}: expected {width} bytes")))
                elif isinstance(kind, T.ArrayType):
                    checks.append(F.when(F.size(c) != f.dims, F.lit(f"{f.name}: expected {f.dims} dimensions")))
                    bounds = {"int8": (-128, 127), "uint8": (0, 255)}.get(f.datatype)
                    if bounds:
                        checks.append(F.when((F.array_min(c) < bounds[0]) | (F.array_max(c) > bounds[1]), F.lit(f"{f.name}: outside {bounds[0]}..{bounds[1]}")))
                else:
                    checks.append(F.when(c.isNotNull(), F.lit(f"{f.name}: not a vector")))
            elif f.type == "geo" and isinstance(kind, T.StringType):
                checks.append(F.when(~c.rlike(POINT.pattern), F.lit(f"{f.name}: not lon,lat")))
            elif f.type in ("text", "tag") and isinstance(kind, (T.NumericType, T.BooleanType)):
                checks.append(F.when(c.isNotNull(), F.lit(f"{f.name}: not a string")))
        found = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.array().cast("array<string>")
        return df.withColumn("_errors", found)

    def validated(self, df: DataFrame) -> DataFrame:
        """``df``; the job fails on the first row that contradicts the schema, and names what is wrong."""
        checked = self.errors(df)
        fine = F.when(F.size("_errors") == 0, F.lit(True)).otherwise(F.raise_error(F.concat_ws("; ", "_errors")).cast("boolean"))
        return checked.where(fine).drop("_errors")


POINT = re.compile(r"^\s*-?\d{1,3}(\.\d+)?\s*,\s*-?\d{1,2}(\.\d+)?\s*$")


def _kind(t: T.DataType) -> str | None:
    if isinstance(t, T.NumericType) or isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "numeric"
    if isinstance(t, T.StringType):
        return "text"
    if isinstance(t, T.ArrayType):
        return "tag" if isinstance(t.elementType, T.StringType) else "vector" if isinstance(t.elementType, T.NumericType) else None
    if isinstance(t, T.StructType) and {"lon", "lat"} <= set(t.names):
        return "geo"
    return None
