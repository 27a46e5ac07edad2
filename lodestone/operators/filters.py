"""Filters: a typed predicate tree with two back ends, a query string and a Spark column.

``Tag("brand") == "nike"`` and the like build nodes; ``str()`` renders a node, ``column(schema, dtypes)``
compiles it. An empty operand is match-all, and match-all is the identity of both ``&`` and ``|``.
Negation is the complement: rows whose field is missing match.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions import geo as G
from lodestone.functions import text as X
from lodestone.schema import IndexSchema

#: Characters that a query string escapes (fixed values).
ESCAPED = re.compile(r"[,.<>{}\[\]\\\"':;!@#$%^&*()\-+=~/ ?]")
ESCAPED_NOT_WILD = re.compile(r"[,.<>{}\[\]\\\"':;!@#$%^&()\-+=~/ ]")


def escape(value: str, wildcards: bool = False) -> str:
    if not isinstance(value, str):
        raise TypeError("only strings are escaped")
    return (ESCAPED_NOT_WILD if wildcards else ESCAPED).sub(lambda m: "\\" + m.group(), value)


class Context:
    """What compilation needs to know of the table: the schema and the column types."""

    def __init__(self, schema: IndexSchema | None, dtypes: dict[str, T.DataType]) -> None:
        self.schema, self.dtypes = schema, dtypes

    def attr(self, name: str, key: str, default: Any) -> Any:
        f = self.schema.fields.get(name) if self.schema else None
        return f.attrs.get(key, default) if f else default

    def tags(self, name: str) -> Column:
        """The tags of a field as an array: split, trimmed and, unless case-sensitive, in lower case."""
        c = F.col(name)
        if not isinstance(self.dtypes.get(name), T.ArrayType):
            c = F.split(c.cast("string"), re.escape(self.attr(name, "separator", ",")))
        keep = self.attr(name, "case_sensitive", False)
        return F.transform(c, lambda x: F.trim(x) if keep else F.lower(F.trim(x)))

    def tokens(self, name: str) -> Column:
        stops = self.schema.index.stopwords if self.schema else None
        return X.tokens(F.col(name), not self.attr(name, "no_stem", False), stops)

    def stems(self, name: str, words: list[str]) -> list[str]:
        return words if self.attr(name, "no_stem", False) else [X.stem(w) for w in words]

    def number(self, name: str) -> Column:
        kind = self.dtypes.get(name)
        if isinstance(kind, (T.NumericType, T.TimestampType, T.TimestampNTZType)):
            return F.col(name)
        return F.col(name).cast("timestamp_ntz") if isinstance(kind, T.DateType) else F.col(name).try_cast("double")

    def bound(self, name: str, value: float) -> Column:
        """A constant to compare ``number`` with: epoch seconds become a time where the column holds times, so that the
        bare column stands in the comparison and the scan can use it."""
        kind = self.dtypes.get(name)
        if not isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return F.lit(value)
        at = (dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=round(value * 1e6))).isoformat(sep=" ", timespec="microseconds")
        return F.expr(f"TIMESTAMP '{at} UTC'" if isinstance(kind, T.TimestampType) else f"TIMESTAMP_NTZ '{at}'")


class Filter:
    """A node of the predicate tree."""

    def render(self) -> str:
        raise NotImplementedError

    def compile(self, ctx: Context) -> Column:
        raise NotImplementedError

    @property
    def all(self) -> bool:
        return False

    def column(self, schema: IndexSchema | None, dtypes: dict[str, T.DataType]) -> Column:
        return self.compile(Context(schema, dtypes))

    def __str__(self) -> str:
        return self.render()

    def __and__(self, other: Filter) -> Filter:
        return _join(self, other, "AND")

    def __or__(self, other: Filter) -> Filter:
        return _join(self, other, "OR")

    def __invert__(self) -> Filter:
        return self if self.all else Not(self)


def _join(a: Filter, b: Filter, op: str) -> Filter:
    if not isinstance(b, Filter):
        raise TypeError("filters combine with filters only")
    if a.all:
        return b
    return a if b.all else Junction(op, a, b)


@dataclass(frozen=True)
class All(Filter):
    def render(self) -> str:
        return "*"

    def compile(self, ctx: Context) -> Column:
        return F.lit(True)

    @property
    def all(self) -> bool:
        return True


@dataclass(frozen=True)
class Junction(Filter):
    op: str
    left: Filter
    right: Filter

    def render(self) -> str:
        return f"({self.left.render()}{' ' if self.op == 'AND' else ' | '}{self.right.render()})"

    def compile(self, ctx: Context) -> Column:
        a, b = self.left.compile(ctx), self.right.compile(ctx)
        return a & b if self.op == "AND" else a | b


@dataclass(frozen=True)
class Not(Filter):
    inner: Filter
    flat: bool = False

    def render(self) -> str:
        return f"(-{self.inner.render()})" if self.flat else f"(-({self.inner.render()}))"

    def compile(self, ctx: Context) -> Column:
        return ~F.coalesce(self.inner.compile(ctx), F.lit(False))


@dataclass(frozen=True)
class TagAny(Filter):
    name: str
    values: tuple[str, ...]
    wild: bool = False

    def render(self) -> str:
        return f"@{self.name}:{{{'|'.join(escape(v, self.wild) for v in self.values)}}}"

    def compile(self, ctx: Context) -> Column:
        tags = ctx.tags(self.name)
        keep = ctx.attr(self.name, "case_sensitive", False)
        values = [v.strip() if keep else v.strip().lower() for v in self.values]
        if not self.wild:
            return F.arrays_overlap(tags, F.array(*[F.lit(v) for v in values]))
        pattern = "|".join("^" + re.escape(v).replace(r"\*", ".*") + "$" for v in values)
        return F.exists(tags, lambda t: t.rlike(pattern))


@dataclass(frozen=True)
class Between(Filter):
    name: str
    low: float | None
    high: float | None
    low_open: bool = False
    high_open: bool = False

    def render(self) -> str:
        lo = "-inf" if self.low is None else f"{'(' if self.low_open else ''}{self.low}"
        hi = "+inf" if self.high is None else f"{'(' if self.high_open else ''}{self.high}"
        return f"@{self.name}:[{lo} {hi}]"

    def compile(self, ctx: Context) -> Column:
        c, out = ctx.number(self.name), F.lit(True)
        if self.low is not None and self.low == self.high and not self.low_open and not self.high_open:
            return c == ctx.bound(self.name, self.low)
        if self.low is not None:
            low = ctx.bound(self.name, self.low)
            out = c > low if self.low_open else c >= low
        if self.high is not None:
            high = ctx.bound(self.name, self.high)
            upper = c < high if self.high_open else c <= high
            out = upper if self.low is None else out & upper
        return out


@dataclass(frozen=True)
class Phrase(Filter):
    name: str
    text: str
    bare: bool = False

    def render(self) -> str:
        return f'@{self.name}:"{self.text}"' if self.bare else f'@{self.name}:("{self.text}")'

    def compile(self, ctx: Context) -> Column:
        words = ctx.stems(self.name, X.tokenize(self.text))
        joined = F.concat(F.lit(" "), F.array_join(ctx.tokens(self.name), " "), F.lit(" "))
        return F.contains(joined, F.lit(f" {' '.join(words)} "))


def _near(words: Column, word: str, edits: int) -> Column:
    return F.exists(words, lambda t: F.levenshtein(t, F.lit(word), edits) >= 0)


def _like(words: Column, pattern: str) -> Column:
    return F.exists(words, lambda t: t.rlike(pattern))


@dataclass(frozen=True)
class Pattern(Filter):
    """``a b`` all, ``a|b`` any, ``a*`` prefix, ``*a`` suffix, ``%a%`` fuzzy (as many edits as leading percent signs)."""

    name: str
    text: str

    def render(self) -> str:
        return f"@{self.name}:({self.text})"

    def compile(self, ctx: Context) -> Column:
        raw, stemmed = X.raw_tokens(F.col(self.name)), None
        groups = []
        for group in self.text.split():
            options = []
            for word in filter(None, group.split("|")):
                low = word.lower()
                fuzzy = len(low) - len(low.lstrip("%"))
                if fuzzy and low.endswith("%"):
                    core = low.strip("%")
                    options.append(_near(raw, core, fuzzy))
                elif "*" in low:
                    pattern = "^" + re.escape(low).replace(r"\*", ".*") + "$"
                    options.append(_like(raw, pattern))
                else:
                    stemmed = ctx.tokens(self.name) if stemmed is None else stemmed
                    options.append(F.array_contains(stemmed, ctx.stems(self.name, X.tokenize(low) or [low])[0]))
            if options:
                out = options[0]
                for o in options[1:]:
                    out = out | o
                groups.append(out)
        out = groups[0] if groups else F.lit(True)
        for g in groups[1:]:
            out = out & g
        return out


@dataclass(frozen=True)
class InRadius(Filter):
    name: str
    lon: float
    lat: float
    radius: int
    unit: str

    def render(self) -> str:
        return f"@{self.name}:[{self.lon} {self.lat} {self.radius} {self.unit}]"

    def compile(self, ctx: Context) -> Column:
        lon, lat = G.lon_lat(F.col(self.name), ctx.dtypes.get(self.name))
        return G.within(lon, lat, self.lon, self.lat, self.radius * G.UNITS[self.unit])


@dataclass(frozen=True)
class Missing(Filter):
    name: str

    def render(self) -> str:
        return f"ismissing(@{self.name})"

    def compile(self, ctx: Context) -> Column:
        return F.col(self.name).isNull()


class FieldFilter:
    """Base of the builders. Comparing with an operand of the wrong type is a TypeError."""

    __hash__ = None  # type: ignore[assignment]

    def __init__(self, name: str) -> None:
        self.name = name

    def is_missing(self) -> Filter:
        return Missing(self.name)

    def exists(self) -> Filter:
        return Not(Missing(self.name), flat=True)

    def _check(self, value: Any, kinds: tuple[type, ...]) -> None:
        if isinstance(value, bool) and bool not in kinds or not isinstance(value, kinds):
            raise TypeError(f"{type(self).__name__} does not take {type(value).__name__}")

    def _unsupported(self, *_: Any) -> Filter:
        raise ValueError(f"{type(self).__name__} does not support this operator")

    __lt__ = __le__ = __gt__ = __ge__ = __mod__ = _unsupported


class Tag(FieldFilter):
    def _values(self, value: Any) -> tuple[str, ...]:
        if value is None:
            return ()
        self._check(value, (str, list, tuple, set))
        if isinstance(value, str):
            return (value,) if value else ()
        out = tuple(str(v) for v in (sorted(value) if isinstance(value, set) else value) if v)
        return out

    def __eq__(self, value: Any) -> Filter:  # type: ignore[override]
        v = self._values(value)
        return TagAny(self.name, v) if v else All()

    def __ne__(self, value: Any) -> Filter:  # type: ignore[override]
        v = self._values(value)
        return Not(TagAny(self.name, v), flat=True) if v else All()

    def __mod__(self, value: Any) -> Filter:
        parts = tuple(p for v in self._values(value) for p in v.split("|") if p)
        return TagAny(self.name, parts, wild=True) if parts else All()


class Num(FieldFilter):
    def _coerce(self, v: Any, end: bool = False) -> Any:
        if v is not None:
            self._check(v, (int, float))
        return v

    def _range(self, low: Any, high: Any, low_open: bool = False, high_open: bool = False) -> Filter:
        return All() if low is None and high is None else Between(self.name, low, high, low_open, high_open)

    def __eq__(self, v: Any) -> Filter:  # type: ignore[override]
        return self._range(self._coerce(v), self._coerce(v, True))

    def __ne__(self, v: Any) -> Filter:  # type: ignore[override]
        same = self.__eq__(v)
        return same if same.all else Not(same, flat=True)

    def __gt__(self, v: Any) -> Filter:
        return self._range(self._coerce(v, True), None, low_open=True)

    def __ge__(self, v: Any) -> Filter:
        return self._range(self._coerce(v), None)

    def __lt__(self, v: Any) -> Filter:
        return self._range(None, self._coerce(v), high_open=True)

    def __le__(self, v: Any) -> Filter:
        return self._range(None, self._coerce(v, True))

    def between(self, start: Any, end: Any, inclusive: str = "both") -> Filter:
        if inclusive not in ("both", "neither", "left", "right"):
            raise ValueError("inclusive is both, neither, left or right")
        return self._range(self._coerce(start), self._coerce(end, True), inclusive in ("neither", "right"), inclusive in ("neither", "left"))


class Timestamp(Num):
    """Epoch seconds, UTC. A bare date is its whole day: equality spans it, ``>`` and ``<=`` stand at its end, ``<`` and ``>=`` at its start."""

    def _coerce(self, v: Any, end: bool = False) -> Any:
        if v is None:
            return None
        if isinstance(v, str):
            if re.fullmatch(r"\d{4}-\d{2}-\d{2}", v):
                v = dt.date.fromisoformat(v)
            else:
                try:
                    v = dt.datetime.fromisoformat(v)
                except ValueError:
                    raise ValueError(f"not an ISO time: {v!r}") from None
        if isinstance(v, dt.datetime):
            v = v if v.tzinfo else v.replace(tzinfo=dt.UTC)
            return v.timestamp()
        if isinstance(v, dt.date):
            day = dt.datetime.combine(v, dt.time.max if end else dt.time.min, tzinfo=dt.UTC)
            return day.timestamp()
        if isinstance(v, bool) or not isinstance(v, (int, float)):
            raise TypeError(f"Timestamp does not take {type(v).__name__}")
        return v


class Text(FieldFilter):
    def __eq__(self, v: Any) -> Filter:  # type: ignore[override]
        if v is not None:
            self._check(v, (str,))
        return Phrase(self.name, v) if v else All()

    def __ne__(self, v: Any) -> Filter:  # type: ignore[override]
        if v is not None:
            self._check(v, (str,))
        return Not(Phrase(self.name, v, bare=True), flat=True) if v else All()

    def __mod__(self, v: Any) -> Filter:
        if v is not None:
            self._check(v, (str,))
        return Pattern(self.name, v) if v else All()


@dataclass(frozen=True)
class GeoRadius:
    lon: float
    lat: float
    radius: float = 1
    unit: str = "km"

    def __post_init__(self) -> None:
        if self.unit.lower() not in G.UNITS:
            raise ValueError(f"unit is one of {', '.join(G.UNITS)}")
        object.__setattr__(self, "unit", self.unit.lower())


class Geo(FieldFilter):
    def _inside(self, g: Any) -> Filter:
        self._check(g, (GeoRadius,))
        return InRadius(self.name, float(g.lon), float(g.lat), int(g.radius), g.unit)

    def __eq__(self, g: Any) -> Filter:  # type: ignore[override]
        return All() if g is None else self._inside(g)

    def __ne__(self, g: Any) -> Filter:  # type: ignore[override]
        return All() if g is None else Not(self._inside(g), flat=True)


# ---- the query-string grammar -------------------------------------------------------------------------------------

_LEX = re.compile(r'\s+|(?P<missing>ismissing\(@(\w+)\))|(?P<field>@(\w+):)|(?P<op>[()|~-])|(?P<star>\*)')


def parse(text: str) -> Filter:
    """A filter from a query string of the grammar that the builders render: tags, ranges, radii, phrases,
    patterns, ``-`` and grouping; juxtaposition is AND, ``|`` is OR."""
    pos, n = 0, len(text)

    def space() -> None:
        nonlocal pos
        while pos < n and text[pos].isspace():
            pos += 1

    def union() -> Filter:
        nonlocal pos
        out = chain()
        space()
        while pos < n and text[pos] == "|":
            pos += 1
            out = out | chain()
            space()
        return out

    def chain() -> Filter:
        out: Filter = All()
        space()
        while pos < n and text[pos] not in ")|":
            out = out & unit()
            space()
        return out

    def until(close: str) -> str:
        nonlocal pos
        start = pos
        while pos < n and text[pos] != close:
            pos += 2 if text[pos] == "\\" else 1
        if pos >= n:
            raise ValueError(f"missing {close!r} in {text!r}")
        pos += 1
        return text[start : pos - 1]

    def unit() -> Filter:
        nonlocal pos
        space()
        ch = text[pos]
        if ch == "*":
            pos += 1
            return All()
        if ch == "(":
            pos += 1
            out = union()
            space()
            if pos >= n or text[pos] != ")":
                raise ValueError(f"missing ')' in {text!r}")
            pos += 1
            return out
        if ch == "-":
            pos += 1
            return ~unit()
        if m := re.compile(r"ismissing\(@(\w+)\)").match(text, pos):
            pos = m.end()
            return Missing(m[1])
        m = re.compile(r"@(\w+):").match(text, pos)
        if not m:
            raise ValueError(f"cannot read {text[pos : pos + 20]!r}")
        name, pos = m[1], m.end()
        ch = text[pos]
        pos += 1
        if ch == "{":
            values = [re.sub(r"\\(.)", r"\1", v).strip() for v in re.split(r"(?<!\\)\|", until("}"))]
            wild = any(re.search(r"(?<!\\)\*", v) for v in values)
            return TagAny(name, tuple(values), wild)
        if ch == "[":
            parts = until("]").split()
            if len(parts) == 4:
                return InRadius(name, float(parts[0]), float(parts[1]), int(float(parts[2])), parts[3].lower())
            lo, hi = parts
            return Between(name, None if lo.lstrip("(") in ("-inf", "inf") else _num(lo.lstrip("(")), None if hi.lstrip("(") in ("+inf", "inf") else _num(hi.lstrip("(")), lo.startswith("("), hi.startswith("("))
        if ch == '"':
            return Phrase(name, until('"'))
        if ch == "(":
            body = until(")").strip()
            if body.startswith('"') and body.endswith('"'):
                return Phrase(name, body[1:-1])
            return Pattern(name, re.sub(r"\s*\|\s*", "|", body))
        raise ValueError(f"cannot read the value of @{name}")

    out = union()
    if pos < n:
        raise ValueError(f"cannot read {text[pos:]!r}")
    return out


def _num(s: str) -> float:
    v = float(s)
    return int(v) if v.is_integer() and "." not in s else v


def as_filter(f: Filter | str | None) -> Filter:
    return All() if f is None else parse(f) if isinstance(f, str) else f


# ---- the JSON filter language -------------------------------------------------------------------------------------


class FilterError(ValueError):
    pass


def from_json(spec: Any, schema: IndexSchema) -> Filter | str:
    """``{"and"|"or"|"not": ...}`` and ``{"field", "op", "value"}`` with eq ne in like gt gte lt lte exists; strings pass through."""
    if spec is None or isinstance(spec, str):
        return All() if spec is None else spec
    if not isinstance(spec, dict) or not spec:
        raise FilterError("a filter is an object")
    for key in ("and", "or"):
        if key in spec:
            items = spec[key]
            if len(spec) != 1 or not isinstance(items, list) or not items:
                raise FilterError(f"{key} takes a list")
            out: Filter | None = None
            for item in items:
                one = from_json(item, schema)
                out = one if out is None else (out & one if key == "and" else out | one)
            return out
    if "not" in spec:
        return Not(from_json(spec["not"], schema))
    name, op, value = spec.get("field"), spec.get("op"), spec.get("value")
    field = schema.fields.get(name)
    if field is None:
        raise FilterError(f"unknown field {name!r}")
    if field.type in ("geo", "vector"):
        raise FilterError(f"{field.type} fields cannot be filtered here")
    if op == "exists":
        if value not in (True, False, None):
            raise FilterError("exists takes true or false")
        return Missing(name) if value is False else Not(Missing(name), flat=True)
    if value is None:
        raise FilterError(f"{op} needs a value")
    build = {"tag": Tag, "text": Text, "numeric": Num}[field.type](name)
    try:
        if op == "in":
            if not isinstance(value, list) or not value:
                raise FilterError("in takes a list")
            if field.type == "tag":
                return build == value
            out = None
            for v in value:
                out = (build == v) if out is None else out | (build == v)
            return out
        if op in ("eq", "ne"):
            return build == value if op == "eq" else build != value
        if op == "like" and field.type in ("tag", "text"):
            return build % value
        if op in ("gt", "gte", "lt", "lte") and field.type == "numeric":
            return {"gt": build.__gt__, "gte": build.__ge__, "lt": build.__lt__, "lte": build.__le__}[op](value)
    except TypeError as e:
        raise FilterError(str(e)) from None
    raise FilterError(f"{op!r} does not apply to {field.type} fields")
