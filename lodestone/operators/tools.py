"""Tools for agents over registered indexes: search, upsert, list."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from lodestone.operators import search as S
from lodestone.operators.filters import from_json
from lodestone.operators.index import SearchIndex


@dataclass
class ToolConfig:
    """How an index is searched: ``mode`` is vector, fulltext or hybrid."""

    mode: str = "fulltext"
    text_field: str | None = None
    vector_field: str | None = None
    default_limit: int = 10
    max_limit: int = 100
    max_result_window: int = 1000
    max_upsert_records: int = 64
    linear_text_weight: float | None = None
    params: dict[str, Any] = field(default_factory=dict)


class ToolServer:
    def __init__(self, embed=None) -> None:
        self.indexes: dict[str, tuple[SearchIndex, ToolConfig]] = {}
        self.embed = embed

    def register(self, name: str, index: SearchIndex, config: ToolConfig) -> None:
        self.indexes[name] = (index, config)

    def list_indexes(self) -> list[dict[str, Any]]:
        return [{"id": n, "mode": c.mode, "fields": {f.name: f.type for f in i.schema.fields.values()}} for n, (i, c) in sorted(self.indexes.items())]

    def search_records(self, name: str, query: str, limit: int | None = None, offset: int = 0, filter: Any = None, return_fields: list[str] | None = None) -> dict[str, Any]:
        index, c = self.indexes[name]
        limit = c.default_limit if limit is None else limit
        if not query or not query.strip():
            raise ValueError("the query is empty")
        if not 0 < limit <= c.max_limit or offset < 0 or limit + offset > c.max_result_window:
            raise ValueError("limit or offset out of bounds")
        f, n = from_json(filter, index.schema), limit + offset
        if c.mode == "fulltext":
            q: Any = S.TextQuery(filter=f, text=query, fields=c.text_field, num_results=n, return_fields=return_fields, **c.params)
        elif c.mode == "vector":
            q = S.VectorQuery(filter=f, vector=self.embed(query), field_name=c.vector_field, num_results=n, return_fields=return_fields, normalize=True, **c.params)
        elif c.mode == "hybrid":
            extra = {"combination": "LINEAR", "alpha": c.linear_text_weight} if c.linear_text_weight is not None else {}
            q = S.HybridQuery(filter=f, text=query, fields=c.text_field, vector=self.embed(query), vector_field=c.vector_field, num_results=n, return_fields=return_fields, **extra, **c.params)
        else:
            raise ValueError(f"unknown mode {c.mode!r}")
        rows = index.query(q).offset(offset).limit(limit).collect()
        return {"mode": c.mode, "limit": limit, "offset": offset, "results": [r.asDict(recursive=True) for r in rows]}

    def upsert_records(self, name: str, records: list[dict[str, Any]], id_field: str | None = None) -> dict[str, Any]:
        index, c = self.indexes[name]
        if not records or len(records) > c.max_upsert_records:
            raise ValueError(f"between 1 and {c.max_upsert_records} records are taken")
        if self.embed and c.vector_field and c.text_field:
            records = [r if r.get(c.vector_field) else {**r, c.vector_field: self.embed(r[c.text_field])} for r in records]
        return {"status": "success", "count": index.load(records, id_field=id_field)}
