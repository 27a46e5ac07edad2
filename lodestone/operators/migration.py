"""Schema migration: a plan from a difference of schemas, its application as one lineage, validation, rollback."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import vectors as V
from lodestone.operators.index import layered, migrations
from lodestone.schema import IndexSchema
from lodestone.sources import store


@dataclass
class Plan:
    source: IndexSchema
    target: IndexSchema
    added: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)
    renamed: dict[str, str] = field(default_factory=dict)
    quantised: dict[str, tuple[str, str]] = field(default_factory=dict)
    prefix: tuple[str, str] | None = None
    blocked: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)

    @property
    def supported(self) -> bool:
        return not self.blocked

    def to_dict(self) -> dict[str, Any]:
        return {"added": self.added, "removed": self.removed, "renamed": self.renamed, "quantised": {k: list(v) for k, v in self.quantised.items()}, "prefix": list(self.prefix) if self.prefix else None, "blocked": self.blocked, "warnings": self.warnings}


def merge(source: IndexSchema, patch: dict[str, Any]) -> tuple[IndexSchema, dict[str, str]]:
    """The target of a patch with add_fields, remove_fields, rename_fields, update_fields and index; and the renames."""
    d = source.to_dict()
    d["index"].update(patch.get("index") or {})
    renames = {r["old_name"]: r["new_name"] for r in patch.get("rename_fields") or []}
    fields = []
    updates = {u["name"]: u for u in patch.get("update_fields") or []}
    gone = set(patch.get("remove_fields") or [])
    for unknown in (set(renames) | set(updates) | gone) - set(source.fields):
        raise ValueError(f"no field {unknown!r}")
    for f in d["fields"]:
        if f["name"] in gone:
            continue
        f = {**f, "attrs": {**f["attrs"], **(updates.get(f["name"], {}).get("attrs") or {})}}
        if f["attrs"].get("algorithm") and (updates.get(f["name"], {}).get("attrs") or {}).get("algorithm"):
            keep = {"dims", "datatype", "distance_metric", "algorithm", "index_missing"}
            f["attrs"] = {k: v for k, v in f["attrs"].items() if k in keep or k in updates[f["name"]]["attrs"]}
        fields.append({**f, "name": renames.get(f["name"], f["name"])})
    d["fields"] = fields + list(patch.get("add_fields") or [])
    return IndexSchema.from_dict(d), renames


def plan(source: IndexSchema, target: IndexSchema, renames: dict[str, str] | None = None) -> Plan:
    """What changes, and what blocks: other dimensions, other types or paths, new vectors, other separator or storage."""
    renames = dict(renames or {})
    p = Plan(source, target, renamed=renames)
    a, b = source.index, target.index
    if a.key_separator != b.key_separator:
        p.blocked.append("the key separator changes")
    if a.storage_type != b.storage_type:
        p.blocked.append("the storage type changes")
    if a.prefixes != b.prefixes:
        if len(a.prefixes) > 1 or len(b.prefixes) > 1:
            p.blocked.append("several prefixes cannot be renamed")
        else:
            p.prefix = (a.prefixes[0], b.prefixes[0])
    for name, f in source.fields.items():
        new = target.fields.get(renames.get(name, name))
        if new is None:
            p.removed.append(name)
            continue
        if new.type != f.type:
            p.blocked.append(f"{name}: the type changes from {f.type} to {new.type}")
        elif (new.path or None) != (f.path or None) and name == new.name:
            p.blocked.append(f"{name}: the path changes")
        elif f.type == "vector":
            if new.dims != f.dims:
                p.blocked.append(f"{name}: the dimensions change from {f.dims} to {new.dims}")
            elif new.datatype != f.datatype:
                if f.datatype in ("int8", "uint8"):
                    p.blocked.append(f"{name}: {f.datatype} cannot be widened again")
                else:
                    p.quantised[new.name] = (f.datatype, new.datatype)
    known = {renames.get(n, n) for n in source.fields}
    for name, f in target.fields.items():
        if name not in known:
            p.added.append(name)
            if f.type == "vector":
                p.blocked.append(f"{name}: a vector field cannot be added")
            same = [r for r in p.removed if source.fields[r].type == f.type]
            if same and f.type != "vector":
                p.warnings.append(f"{same[0]} goes and {name} comes: if that is a renaming, say so")
    return p


def transform(df: DataFrame, p: Plan, key: str = "key") -> DataFrame:
    """The migrated rows: columns renamed, keys re-prefixed, vectors quantised; one projection."""
    if not p.supported:
        raise ValueError("; ".join(p.blocked))
    out = df.withColumnsRenamed(p.renamed)
    if p.prefix and key in df.columns:
        old, new = p.prefix
        sep = p.source.index.key_separator
        head = f"{old}{sep}" if old else ""
        fresh = F.concat(F.lit(f"{new}{sep}" if new else ""), F.substring(key, len(head) + 1, 2_000_000))
        out = out.withColumn(key, F.when(F.startswith(F.col(key), F.lit(head)), fresh).otherwise(F.col(key)))
    for name, (old, new) in p.quantised.items():
        if out.schema[name].dataType.typeName() == "binary":
            out = V.convert(out, name, old, new)
        elif new in ("int8", "uint8"):
            out = out.withColumn(name, V.quantise(F.col(name), new))
        elif new in ("float16", "bfloat16"):
            out = _halved(out, name, new)
    return out


def _halved(df: DataFrame, name: str, to: str) -> DataFrame:
    @F.pandas_udf("array<float>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else V.from_bytes(V.to_bytes(v, to), to))

    return df.withColumn(name, run(name))


@dataclass
class Validation:
    schema_match: bool
    doc_count_match: bool
    missing_keys: int
    unreadable_vectors: int
    unreadable_before: int = 0

    @property
    def failures(self) -> list[str]:
        """What went wrong. Vectors that could not be read before are no fault of the migration; more of them are."""
        worse = self.unreadable_vectors - self.unreadable_before
        said = [(not self.schema_match, "columns are missing"), (not self.doc_count_match, "the number of rows differs"), (self.missing_keys > 0, f"{self.missing_keys} keys are missing"), (worse > 0, f"{worse} more vectors cannot be read")]
        return [text for wrong, text in said if wrong]

    @property
    def passed(self) -> bool:
        return not self.failures


def validate(before: DataFrame, after: DataFrame, p: Plan, key: str = "key") -> Validation:
    want = {c for c in before.withColumnsRenamed(p.renamed).columns}
    expected = transform(before.select(key), Plan(p.source, p.target, prefix=p.prefix), key)

    def unreadable(df: DataFrame, schema: IndexSchema) -> int:
        bad = F.lit(False)
        for f in schema.fields.values():
            if f.type == "vector" and f.name in df.columns and df.schema[f.name].dataType.typeName() == "array":
                bad = bad | F.coalesce(F.size(f.name) != f.dims, F.lit(False))
        return df.where(bad).count()

    return Validation(want <= set(after.columns), before.count() == after.count(), expected.join(after.select(key), key, "left_anti").count(), unreadable(after, p.target), unreadable(before, p.source))


class Migrator:
    """Applies plans to a versioned table: each state is a folder, a journal names what was live before."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _current(self) -> str:
        return store.read_text(self.spark, f"{self.path}/CURRENT")

    def status(self) -> list[dict[str, Any]]:
        return migrations(self.spark, self.path)

    def apply(self, p: Plan, key: str = "key") -> Validation:
        """Writes the new version beside the old one, validates it, and only then makes it the live one."""
        before = self._current()
        source = layered(self.spark, self.path, store.read_json(self.spark, f"{self.path}/{before}"), key)
        name, version = f"v-{uuid.uuid4().hex}", f"layers-{uuid.uuid4().hex}.json"
        transform(source, p, key).write.parquet(f"{self.path}/{name}")
        store.write_json(self.spark, f"{self.path}/{version}", [["base", name]])
        result = validate(source, self.spark.read.parquet(f"{self.path}/{name}"), p, key)
        nth = len(self.status())
        store.write_json(self.spark, f"{self.path}/migration-{nth:08d}.json", {"from": before, "to": version, "passed": result.passed, "failures": result.failures, "plan": p.to_dict()})
        if result.passed:
            store.write_text(self.spark, f"{self.path}/CURRENT", version)
        return result

    def rollback(self) -> str:
        done = [x for x in self.status() if x["passed"]]
        if not done:
            raise ValueError("nothing to roll back")
        store.write_text(self.spark, f"{self.path}/CURRENT", done[-1]["from"])
        return done[-1]["from"]


def apply_all(migrators: list[tuple[Migrator, Plan]], resume: bool = True) -> list[Validation | None]:
    """Plans of several tables in turn; those that passed before are left alone when resuming."""
    out: list[Validation | None] = []
    for m, p in migrators:
        done = resume and any(x["passed"] and x["plan"] == json.loads(json.dumps(p.to_dict())) for x in m.status())
        out.append(None if done else m.apply(p))
    return out


def disk_estimate(n_docs: int, dims: int, source: str, target: str, backup: bool = True) -> dict[str, int]:
    """Bytes of vectors before and after, and of a backup."""
    width = {"float64": 8, "float32": 4, "float16": 2, "bfloat16": 2, "int8": 1, "uint8": 1}
    before, after = n_docs * dims * width[source], n_docs * dims * width[target]
    return {"before": before, "after": after, "saved": before - after, "backup": before if backup else 0}


# ---- compression ---------------------------------------------------------------------------------------------------

#: From so many dimensions on, vectors are reduced as well as quantised.
HIGH_DIMS = 1024
#: Bits for each dimension (fixed values).
BITS = {"LVQ4": 4, "LVQ4x4": 8, "LVQ4x8": 12, "LVQ8": 8, "LeanVec4x8": 12, "LeanVec8x8": 16}


def recommend(dims: int, priority: str = "balanced") -> dict[str, Any]:
    """Settings (fixed values) of a compressed graph index for ``dims``; priority is speed, memory or balanced."""
    if dims <= 0:
        raise ValueError("dims must be positive")
    if priority not in ("speed", "memory", "balanced"):
        raise ValueError("priority is speed, memory or balanced")
    if dims >= HIGH_DIMS:
        reduce, window = {"memory": (dims // 2, 20), "speed": (dims // 4, 40), "balanced": (dims // 2, 30)}[priority]
        return {"algorithm": "svs-vamana", "datatype": "float16", "compression": "LeanVec4x8", "reduce": reduce, "graph_max_degree": 64, "construction_window_size": 300, "search_window_size": window}
    compression, window = {"memory": ("LVQ4", 20), "speed": ("LVQ4x8", 20), "balanced": ("LVQ4x4", 20)}[priority]
    return {"algorithm": "svs-vamana", "datatype": "float32", "compression": compression, "reduce": None, "graph_max_degree": 40, "construction_window_size": 250, "search_window_size": window}


def memory_savings(compression: str, dims: int, reduce: int | None = None) -> float:
    """Percent saved against 32 bits for each dimension."""
    if compression not in BITS:
        return 0.0
    used = (reduce or dims) * BITS[compression] if compression.startswith("LeanVec") and reduce else dims * BITS[compression]
    return round((1 - used / (dims * 32)) * 100, 1)
