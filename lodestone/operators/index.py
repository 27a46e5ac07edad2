"""A search index: a typed, versioned view over a DataFrame or a Parquet table."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.operators.filters import Context, Filter, as_filter
from lodestone.operators.search import CountQuery, FilterQuery, Query, Source, TextQuery, sort_keys
from lodestone.plans.physical import stage_table
from lodestone.schema import IndexSchema, SchemaError
from lodestone.sources import store

EXPIRES = "_expires_at"


@dataclass(frozen=True)
class BulkResult:
    matched: int
    processed: int
    completed: bool = True
    dry_run: bool = False


def _frame(spark: SparkSession, records: list[dict[str, Any]], known: dict[str, T.StructField]) -> DataFrame:
    """Records as a DataFrame, in the types of the table that they are to join where it has their columns."""
    names = list(dict.fromkeys(k for r in records for k in r))
    if not known or not set(names) <= set(known):
        return spark.createDataFrame(records)

    def fit(v: Any, kind: T.DataType) -> Any:
        if isinstance(kind, (T.DoubleType, T.FloatType)) and isinstance(v, int) and not isinstance(v, bool):
            return float(v)
        if isinstance(kind, T.ArrayType) and isinstance(v, (list, tuple)):
            return [fit(x, kind.elementType) for x in v]
        return v

    rows = [tuple(fit(r.get(n), known[n].dataType) for n in names) for r in records]
    return spark.createDataFrame(rows, T.StructType([T.StructField(n, known[n].dataType) for n in names]))


def layered(spark: SparkSession, path: str, layers: list[list[str]], key: str) -> DataFrame:
    """The frame that a base and the changes after it make."""
    df: DataFrame | None = None
    for kind, name in layers:
        part = spark.read.parquet(f"{path}/{name}")
        if kind == "base":
            df = part
        elif kind == "rows":
            df = df.join(part.select(key), key, "left_anti").select(*df.columns).unionByName(part, allowMissingColumns=True)
        else:
            df = df.join(part.select(key), key, "left_anti").select(*df.columns)
    return df


def migrations(spark: SparkSession, path: str) -> list[dict[str, Any]]:
    """The journal of migrations of a table, oldest first."""
    return [store.read_json(spark, f"{path}/{n}") for n in store.names(spark, path) if n.startswith("migration-")]


def _after(names: list[tuple[str, bool]], last: Row) -> Column:
    """Whether a row comes after ``last``: nulls come first upwards and last downwards."""
    out, equal = F.lit(False), F.lit(True)
    for name, up in names:
        c, v = F.col(name), last[name]
        if v is None:
            beyond = c.isNotNull() if up else F.lit(False)
        else:
            beyond = (c > F.lit(v)) if up else (c < F.lit(v)) | c.isNull()
        out = out | (equal & F.coalesce(beyond, F.lit(False)))
        equal = equal & c.eqNullSafe(F.lit(v))
    return out


class SearchIndex:
    """Every change makes a new version of the frame; readers of an old one are not disturbed.

    With ``path`` a version is a list of layers, each a Parquet folder below it: a base, rows that replace those of their keys, and
    keys that are gone. A change writes its own rows only; reading joins the layers, and after ``MAX_LAYERS`` changes they
    are written as one base. ``CURRENT`` names the live version, so a reader never sees half a write and a rollback is a change
    of one name. All goes through the Hadoop file system.
    """

    #: Layers from which a table is written anew.
    MAX_LAYERS = 12

    def __init__(self, schema: IndexSchema, df: DataFrame | None = None, key: str = "key", path: str | None = None) -> None:
        self.schema, self.key, self.path, self._df = schema, key, path, df
        self.dropped = False
        self.ann: dict[str, Any] = {}

    # ---- catalog ---------------------------------------------------------------------------------------------------

    _catalog: dict[str, SearchIndex] = {}

    def create(self, overwrite: bool = False, drop: bool = False) -> bool:
        """Registers the index; False, and nothing done, if the name exists and ``overwrite`` is not set. With ``path`` the schema is
        kept beside the table, where ``from_existing`` and ``listall`` of other processes find it."""
        if not self.schema.fields:
            raise SchemaError("an index needs fields")
        name = self.schema.index.name
        if self.exists() and not overwrite:
            return False
        if drop and self.exists():
            (self._catalog.get(name) or self).delete(drop=True)
        self._catalog[name] = self
        if self.path:
            store.write_json(SparkSession.active(), f"{self.path}/SCHEMA", {"schema": self.schema.to_dict(), "key": self.key})
        return True

    def delete(self, drop: bool = True) -> None:
        """Forgets the index; ``drop`` removes its rows as well."""
        self._catalog.pop(self.schema.index.name, None)
        if self.path:
            spark = SparkSession.active()
            store.remove(spark, self.path if drop else f"{self.path}/SCHEMA")
            self._df = None if drop else self._df
        elif drop and self._df is not None:
            self.clear()
        self.dropped = True

    def exists(self) -> bool:
        return self.schema.index.name in self._catalog or bool(self.path) and store.exists(SparkSession.active(), f"{self.path}/SCHEMA")

    @classmethod
    def listall(cls, root: str | None = None) -> list[str]:
        """Names of this process, or of all indices in the folders below ``root``."""
        if root is None:
            return sorted(cls._catalog)
        spark = SparkSession.active()
        found = [f"{root}/{n}/SCHEMA" for n in store.names(spark, root)]
        return sorted(store.read_json(spark, f)["schema"]["index"]["name"] for f in found if store.exists(spark, f))

    @classmethod
    def from_existing(cls, name: str, df: DataFrame | None = None, key: str = "key", path: str | None = None) -> SearchIndex:
        """An index by its name in this process, by the folder it lies in, or over any table, whose schema is read off its columns."""
        if path is not None:
            kept = store.read_json(SparkSession.active(), f"{path}/SCHEMA")
            return cls(IndexSchema.from_dict(kept["schema"]), None, kept["key"], path)
        if df is None:
            return cls._catalog[name]
        return cls(IndexSchema.from_table(name, df), df, key)

    def info(self) -> dict[str, Any]:
        i = self.schema.index
        return {"name": i.name, "prefixes": i.prefixes, "storage_type": i.storage_type, "fields": {f.name: f.type for f in self.schema.fields.values()}, "num_docs": self.df.count()}

    #: Names of the statistics report (fixed values).
    STATS = ("num_docs", "num_terms", "max_doc_id", "num_records", "percent_indexed", "hash_indexing_failures", "number_of_uses", "bytes_per_record_avg", "doc_table_size_mb", "inverted_sz_mb", "key_table_size_mb", "offset_bits_per_record_avg", "offset_vectors_sz_mb", "offsets_per_term_avg", "records_per_doc_avg", "sortable_values_size_mb", "total_indexing_time", "total_inverted_index_blocks", "vector_index_sz_mb")

    def stats(self) -> dict[str, Any]:
        """The statistics that a table has; the rest are None. A row that contradicts the schema is a failure."""
        ctx = Context(self.schema, self.source.dtypes)
        words = [ctx.tokens(f.name) for f in self.schema.fields.values() if f.type == "text" and f.name in self.df.columns]
        out: dict[str, Any] = dict.fromkeys(self.STATS)
        r = self.schema.errors(self.df).agg(F.count("*"), F.count_if(F.size("_errors") > 0)).first()
        out["num_docs"], out["hash_indexing_failures"] = r[0], r[1]
        out["percent_indexed"] = 1.0 - r[1] / r[0] if r[0] else 1.0
        if words:
            out["num_terms"] = self.df.select(F.explode(F.concat(*[F.coalesce(w, F.array().cast("array<string>")) for w in words])).alias("t")).agg(F.count_distinct("t")).first()[0]
        return out

    # ---- reading ---------------------------------------------------------------------------------------------------

    @property
    def df(self) -> DataFrame:
        """The live rows: expired ones are not seen."""
        if self._df is None:
            if self.path is None:
                raise ValueError("the index has no data")
            self._df = self._read()
        return self._df.where(F.col(EXPIRES).isNull() | (F.col(EXPIRES) > F.current_timestamp())).drop(EXPIRES) if EXPIRES in self._df.columns else self._df

    @property
    def source(self) -> Source:
        return Source(self.df, self.schema, self.key, self.ann)

    def build_ann(self, name: str, cells: int | None = None, path: str | None = None) -> Any:
        """An approximate index of a vector field, used by vector queries until the next write."""
        from lodestone.operators.ann import CellIndex

        self.ann[name] = CellIndex.build(self.df, self.key, name, self.schema.fields[name].dims, cells, path)
        return self.ann[name]

    def _read(self) -> DataFrame:
        spark = SparkSession.active()
        return layered(spark, self.path, store.read_json(spark, f"{self.path}/{store.read_text(spark, f'{self.path}/CURRENT')}"), self.key)

    def query(self, q: Query | CountQuery | Any) -> DataFrame | int:
        """A lazy DataFrame; a number for a CountQuery."""
        if isinstance(q, TextQuery) and q.stopwords and self.schema.index.stopwords == []:
            warnings.warn("the index keeps stop words, the query drops them", UserWarning, stacklevel=2)
        if isinstance(q, CountQuery):
            return q.run(self.source).first()[0]
        return q.run(self.source)

    search = query

    def batch_query(self, queries: list[Any], batch_size: int = 10) -> list[DataFrame | int]:
        """Results in the order of the queries; plans are lazy, so batches need no pipelining."""
        if batch_size < 1:
            raise ValueError("batch_size must be positive")
        return [self.query(q) for q in queries]

    def paginate(self, q: Query, page_size: int = 30) -> Iterator[list[Row]]:
        """Pages until the first empty one, in the order of the query and then the key. A page is sought by the last row before
        it, so each is a top-k of its own; scores are computed once."""
        if not isinstance(page_size, int) or page_size < 1:
            raise ValueError("page_size must be a positive integer")
        if isinstance(q, FilterQuery):
            rows, order = self.source.where(q.filter), []
        elif hasattr(q, "scored"):
            rows = stage_table(q.scored(self.source))
        else:
            rows = stage_table(replace(q, num_results=2_000_000_000).run(self.source))
        if keys := sort_keys(q.sort_by):
            order = keys[:1]
        elif not isinstance(q, FilterQuery):
            order = [(n, n == "vector_distance") for n in ("hybrid_score", "combined_score", getattr(q, "name", "score"), "vector_distance") if n in rows.columns][:1]
        names = [*order, (self.key, True)]
        shown = list(dict.fromkeys([self.key, *q.return_fields, *(n for n in rows.columns if n not in self.df.columns)])) if q.return_fields is not None else rows.columns
        last: Row | None = None
        while True:
            page = rows if last is None else rows.where(_after(names, last))
            got = page.orderBy(*[F.col(n).asc_nulls_first() if up else F.col(n).desc_nulls_last() for n, up in names]).limit(page_size).collect()
            if not got:
                return
            yield [Row(*shown)(*[r[n] for n in shown]) for r in got]
            last = got[-1]

    def fetch(self, ident: str) -> Row | None:
        """The row of a key, with or without the prefix; the key column is compared as it is, so the scan can skip files."""
        kind = self.df.schema[self.key].dataType
        wanted = [F.lit(x).try_cast(kind) for x in dict.fromkeys([str(ident), self.schema.index.key(str(ident))])]
        hit = F.col(self.key) == wanted[0]
        for w in wanted[1:] if isinstance(kind, T.StringType) else []:
            hit = hit | (F.col(self.key) == w)
        return self.df.where(hit).head()

    def keys(self, f: Filter | str | None = None) -> Iterator[Any]:
        for r in self.source.where(f).select(self.key).toLocalIterator():
            yield r[0]

    def sql(self, text: str, params: dict[str, Any] | None = None) -> DataFrame:
        from lodestone.operators.dialect import SQLQuery

        return SQLQuery(text, params or {}).run(self.source)

    # ---- writing ---------------------------------------------------------------------------------------------------

    def _set(self, df: DataFrame, rows: DataFrame | None = None, gone: DataFrame | None = None) -> None:
        """Makes ``df`` the live frame. On disk only what changed is written: ``rows``, which replace those of their keys, or keys that are
        ``gone``; all of ``df`` where neither is given, the columns differ, or the layers have become many."""
        self.ann = {}
        if self.path is None:
            self._df = df
            return
        spark, current = SparkSession.active(), f"{self.path}/CURRENT"
        layers = store.read_json(spark, f"{self.path}/{store.read_text(spark, current)}") if store.exists(spark, current) else []
        part = rows if rows is not None else gone
        same = rows is None or self._df is not None and set(rows.columns) <= set(self._df.columns)
        if part is None or not layers or len(layers) >= self.MAX_LAYERS or not same:
            layers, part, kind = [], df, "base"
        else:
            kind = "rows" if rows is not None else "gone"
        name = f"v-{uuid.uuid4().hex}"
        part.write.parquet(f"{self.path}/{name}")
        version = f"layers-{uuid.uuid4().hex}.json"
        store.write_json(spark, f"{self.path}/{version}", [*layers, [kind, name]])
        store.write_text(spark, current, version)
        self._df = None
        self._df = self._read()

    def vacuum(self) -> int:
        """Removes the folders that neither the live version nor one that a migration can go back to reads; returns their number."""
        spark = SparkSession.active()
        versions = {store.read_text(spark, f"{self.path}/CURRENT")} | {x["from"] for x in migrations(spark, self.path)[-1:]}
        kept = versions | {n for v in versions for _, n in store.read_json(spark, f"{self.path}/{v}")}
        old = [n for n in store.names(spark, self.path) if n.startswith(("v-", "layers-")) and n not in kept]
        for n in old:
            store.remove(spark, f"{self.path}/{n}")
        return len(old)

    def load(self, data: DataFrame | list[dict], id_field: str | None = None, ttl: int | None = None, preprocess: Callable[[DataFrame], DataFrame] | None = None, keys: list[str] | None = None) -> int:
        """Validates and upserts: a row replaces the one of its key; of rows with one key the last counts. Returns the number of rows."""
        if not isinstance(data, DataFrame):
            spark = SparkSession.active()
            if keys is not None:
                if len(keys) != len(data):
                    raise ValueError("as many keys as records are needed")
                data = [{**r, self.key: k} for r, k in zip(data, keys)]
            data = _frame(spark, data, {f.name: f for f in self._raw().schema.fields} if self._df is not None else {})
        new = data.transform(preprocess) if preprocess else data
        if self.key not in new.columns:
            ident = F.col(id_field) if id_field else F.expr("uuid()")
            if id_field and id_field not in new.columns:
                raise ValueError(f"no column {id_field!r}")
            new = new.withColumn(self.key, self.schema.index.key_column(ident))
        new = self.schema.validated(new)
        if ttl is not None:
            new = new.withColumn(EXPIRES, F.current_timestamp() + F.make_dt_interval(secs=F.lit(ttl)))
        if self._df is None and self.path and store.exists(new.sparkSession, f"{self.path}/CURRENT"):
            self._df = self._read()
        columns = [c for c in new.columns if c != self.key]
        latest = F.max_by(F.struct(*columns), "_at").alias("_row") if columns else F.max("_at").alias("_row")
        once = new.withColumn("_at", F.monotonically_increasing_id()).groupBy(self.key).agg(latest, F.count("*").alias("_times"))
        if self.path:
            once = stage_table(once)
        n = int(once.agg(F.sum("_times")).first()[0] or 0)
        new = once.select(*[self.key if c == self.key else f"_row.{c}" for c in new.columns])
        old = self._df
        self._set(new if old is None else old.join(new.select(self.key), self.key, "left_anti").unionByName(new, allowMissingColumns=True), rows=new)
        return n

    def clear(self) -> int:
        n = self.df.count()
        self._set(self._raw().limit(0))
        return n

    def _raw(self) -> DataFrame:
        _ = self.df
        return self._df

    def _named(self, keys: str | list[str]) -> DataFrame:
        keys = [keys] if isinstance(keys, str) else list(keys)
        field = T.StructField(self.key, T.StringType())
        named = SparkSession.active().createDataFrame([(str(k),) for k in keys], T.StructType([field]))
        return named.select(F.col(self.key).try_cast(self._raw().schema[self.key].dataType).alias(self.key)).distinct()

    def drop_keys(self, keys: str | list[str]) -> int:
        """Any number of keys, by a join."""
        named = self._named(keys)
        n = self.df.join(named, self.key, "left_semi").count()
        self._set(self._raw().join(named, self.key, "left_anti"), gone=named)
        return n

    def drop_documents(self, ids: str | list[str]) -> int:
        ids = [ids] if isinstance(ids, str) else list(ids)
        return self.drop_keys([self.schema.index.key(i) for i in ids])

    def drop_where(self, hit: Column) -> int:
        hit = F.coalesce(hit, F.lit(False))
        n = self.df.where(hit).count()
        raw = self._raw()
        self._set(raw.where(~hit), gone=raw.where(hit).select(self.key))
        return n

    def expire_keys(self, keys: str | list[str], ttl: int) -> int:
        return self.expire_rows(self._named(keys), ttl)

    def expire_rows(self, named: DataFrame, ttl: int) -> int:
        """The rows whose keys are in ``named`` are not seen from ``ttl`` seconds on; their number."""
        raw = self._raw()
        n = self.df.join(named, self.key, "left_semi").count()
        until = F.current_timestamp() + F.make_dt_interval(secs=F.lit(ttl))
        old = raw if EXPIRES in raw.columns else raw.withColumn(EXPIRES, F.lit(None).cast("timestamp"))
        marked = old.join(named.withColumn("_hit", F.lit(True)), self.key, "left")
        whole = marked.withColumn(EXPIRES, F.when(F.col("_hit"), until).otherwise(F.col(EXPIRES))).select(*old.columns)
        self._set(whole, rows=old.join(named, self.key, "left_semi").withColumn(EXPIRES, until).select(*old.columns))
        return n

    def _guarded(self, f: Filter | str | None, allow_all: bool) -> Column:
        f = as_filter(f)
        if f.all and not allow_all:
            raise ValueError("the filter matches everything; say allow_all=True if that is meant")
        return f.compile(Context(self.schema, self.source.dtypes))

    def drop_by_filter(self, f: Filter | str | None, dry_run: bool = False, allow_all: bool = False, on_progress: Callable[[BulkResult], None] | None = None) -> BulkResult:
        hit = self._guarded(f, allow_all)
        n = self.df.where(hit).count()
        if not dry_run:
            self.drop_where(hit)
        out = BulkResult(n, 0 if dry_run else n, True, dry_run)
        if on_progress:
            on_progress(out)
        return out

    def update_by_filter(self, f: Filter | str | None, values: dict[str, Any], dry_run: bool = False, allow_all: bool = False, on_progress: Callable[[BulkResult], None] | None = None) -> BulkResult:
        """Sets ``values`` in every row that matches; None removes a field. A dict merges into a struct column."""
        hit = F.coalesce(self._guarded(f, allow_all), F.lit(False))
        n = self.df.where(hit).count()
        if not dry_run:
            raw = self._raw().withColumn("_hit", hit)
            kinds = {x.name: x.dataType for x in raw.schema.fields}
            for name, v in values.items():
                if isinstance(v, dict) and isinstance(kinds.get(name), T.StructType):
                    new = F.col(name)
                    for sub, x in v.items():
                        new = new.withField(sub, F.lit(x).cast(kinds[name][sub].dataType) if sub in kinds[name].names else F.lit(x))
                    raw = raw.withColumn(name, F.when(F.col("_hit"), new).otherwise(F.col(name)))
                    continue
                lit = F.array(*[F.lit(x) for x in v]) if isinstance(v, (list, tuple)) else F.lit(v)
                kind = kinds.get(name)
                old = F.col(name) if kind is not None else F.lit(None)
                raw = raw.withColumn(name, F.when(F.col("_hit"), lit.cast(kind) if kind is not None else lit).otherwise(old))
            self._set(raw.drop("_hit"), rows=raw.where("_hit").drop("_hit"))
        out = BulkResult(n, 0 if dry_run else n, True, dry_run)
        if on_progress:
            on_progress(out)
        return out
