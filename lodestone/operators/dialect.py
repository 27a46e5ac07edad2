"""The single-table SQL dialect: typed predicates, vector, geo, date and full-text functions.

A hand-written lexer and recursive-descent parser turn one SELECT into DataFrame operations; every
expression becomes a Spark column, so Catalyst plans the rest. Parameters are bound as values, never spliced
into text.
"""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import geo as G
from lodestone.functions import text as X
from lodestone.functions import vectors as V
from lodestone.operators import search as S
from lodestone.operators.filters import Context, Num, Phrase, Tag, Timestamp

LEX = re.compile(r"\s*(?:(?P<num>\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)|(?P<str>'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\")|(?P<par>:\w+)|(?P<op><=|>=|<>|!=|=>|[=<>+\-*/%(),.;])|(?P<word>[A-Za-z_]\w*|`[^`]+`))")
CLAUSES = {"FROM", "WHERE", "GROUP", "ORDER", "LIMIT", "OFFSET", "BY", "ASC", "DESC", "AS", "AND", "OR", "NOT", "IN", "BETWEEN", "LIKE", "IS", "NULL", "SELECT", "DISTINCT"}
VECTOR_FUNCTIONS = {"VECTOR_DISTANCE": None, "COSINE_DISTANCE": "cosine", "L2_DISTANCE": "l2", "IP_DISTANCE": "ip"}
#: strftime codes and their Java patterns (fixed values).
STRFTIME = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%y": "yy", "%j": "DDD", "%b": "MMM", "%B": "MMMM", "%a": "EEE", "%A": "EEEE", "%F": "yyyy-MM-dd", "%T": "HH:mm:ss"}
DATE = re.compile(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}:\d{2})?$")


@dataclass
class Expr:
    """A parsed expression: its column, and what the parser needs to know of it."""

    col: Column
    name: str = ""
    field: str | None = None
    value: Any = None
    literal: bool = False
    aggregate: bool = False
    vector: bool = False


def lex(sql: str) -> list[tuple[str, str]]:
    out, pos = [], 0
    sql = sql.strip().rstrip(";")
    while pos < len(sql):
        m = LEX.match(sql, pos)
        if not m or m.end() == pos:
            if sql[pos:].strip() == "":
                break
            raise ValueError(f"cannot read SQL at {sql[pos : pos + 20]!r}")
        kind = m.lastgroup
        out.append((kind, m.group(kind)))
        pos = m.end()
    return out


@dataclass
class SQLQuery:
    sql: str
    params: dict[str, Any] = field(default_factory=dict)

    def run(self, s: S.Source) -> DataFrame:
        return Parser(self.sql, self.params, s).select()

    def explain(self, s: S.Source) -> str:
        return self.run(s)._jdf.queryExecution().toString()


class Parser:
    def __init__(self, sql: str, params: dict[str, Any], s: S.Source) -> None:
        self.toks, self.i, self.params, self.s = lex(sql), 0, params, s
        self.ctx = Context(s.schema, s.dtypes)
        self.hybrid: dict[str, Any] | None = None
        self.named: dict[str, Column] = {}

    # ---- tokens ------------------------------------------------------------------------------------------------

    def peek(self, k: int = 0) -> tuple[str, str]:
        return self.toks[self.i + k] if self.i + k < len(self.toks) else ("end", "")

    def word(self, *names: str) -> bool:
        if self.peek()[0] == "word" and self.peek()[1].upper() in names:
            self.i += 1
            return True
        return False

    def op(self, *ops: str) -> str | None:
        if self.peek()[0] == "op" and self.peek()[1] in ops:
            self.i += 1
            return self.toks[self.i - 1][1]
        return None

    def need(self, *what: str) -> None:
        if not (self.op(*what) or self.word(*what)):
            raise ValueError(f"expected {' or '.join(what)}, found {self.peek()[1]!r}")

    def kind(self, name: str | None) -> str | None:
        f = self.s.schema.fields.get(name) if name else None
        return f.type if f else None

    # ---- statement ---------------------------------------------------------------------------------------------

    def select(self) -> DataFrame:
        self.need("SELECT")
        distinct = self.word("DISTINCT")
        items: list[tuple[Expr, str]] = []
        star = False
        while True:
            if self.op("*"):
                star = True
            else:
                start = self.i
                e = self.expression()
                alias = ""
                if self.word("AS"):
                    alias = self.toks[self.i][1].strip("`")
                    self.i += 1
                elif self.peek()[0] == "word" and self.peek()[1].upper() not in CLAUSES:
                    alias = self.toks[self.i][1].strip("`")
                    self.i += 1
                text = e.name or "".join(t for _, t in self.toks[start : self.i]).lower()
                items.append((e, alias or text))
                self.named[(alias or text).lower()] = e.col
            if not self.op(","):
                break
        if distinct and star:
            raise ValueError("DISTINCT * is not supported; name the columns")
        self.need("FROM")
        self.i += 1
        where = self.predicate() if self.word("WHERE") else None
        groups: list[Expr] = []
        if self.word("GROUP"):
            self.need("BY")
            groups.append(self.expression())
            while self.op(","):
                groups.append(self.expression())
        orders: list[tuple[str | Column, bool]] = []
        if self.word("ORDER"):
            self.need("BY")
            while True:
                first = self.peek()[1].strip("`").lower()
                alone = self.peek()[0] == "word" and (self.peek(1)[0] != "op" or self.peek(1)[1] in (",",)) and first in {n.lower() for _, n in items}
                e = self.expression()
                key: str | Column = next(n for _, n in items if n.lower() == first) if alone else e.col
                desc = self.word("DESC")
                if not desc:
                    self.word("ASC")
                orders.append((key, not desc))
                if not self.op(","):
                    break
        limit = offset = None
        while True:
            if self.word("LIMIT"):
                limit = int(self.primary().value)
                if self.op(","):
                    offset, limit = limit, int(self.primary().value)
            elif self.word("OFFSET"):
                offset = int(self.primary().value)
            else:
                break
        if self.i < len(self.toks):
            raise ValueError(f"cannot read SQL at {self.peek()[1]!r}")
        return self.plan(items, star, distinct, where, groups, orders, limit, offset)

    def plan(self, items, star, distinct, where, groups, orders, limit, offset) -> DataFrame:
        df, key = self.s.df, self.s.key
        if where is not None:
            df = df.where(where)
        if self.hybrid is not None:
            h = self.hybrid
            q = S.HybridQuery(text=h["text"], fields=h["text_field"], vector=h["vector"], vector_field=h["vector_field"], num_results=limit or 10, **h["options"])
            out = q.run(S.Source(df, self.s.schema, key))
            names = [n for e, n in items if e.name != "hybrid_score"]
            alias = next((n for e, n in items if e.name == "hybrid_score"), "hybrid_score")
            out = out.withColumnRenamed("hybrid_score", alias)
            return out if star else out.select(*dict.fromkeys([*names, alias]))
        aggregated = bool(groups) or any(e.aggregate for e, _ in items)
        near = next((n for e, n in items if e.vector), None)
        if aggregated:
            named = [(g.col.alias(f"_g{k}")) for k, g in enumerate(groups)]
            grouped = df.groupBy(*named).agg(*[e.col.alias(n) for e, n in items if e.aggregate] or [F.count("*").alias("_n")])
            cols = []
            for e, n in items:
                if e.aggregate:
                    cols.append(F.col(f"`{n}`"))
                else:
                    k = next((k for k, g in enumerate(groups) if g.name == e.name and g.name or str(g.col) == str(e.col)), None)
                    if k is None:
                        k = next((k for k, g in enumerate(groups) if g.name == n), None)
                    if k is None:
                        raise ValueError(f"{n} is neither grouped nor aggregated")
                    cols.append(F.col(f"_g{k}").alias(n))
            out = grouped.select(*cols)
            orders = [(o if isinstance(o, str) else next((n for e, n in items if str(e.col) == str(o)), o), a) for o, a in orders]
        else:
            pre = df.select("*", *[e.col.alias(f"_s{k}") for k, (e, _) in enumerate(items)])
            if near and not orders:
                k = next(k for k, (_, n) in enumerate(items) if n == near)
                pre = pre.where(F.col(f"_s{k}").isNotNull()).orderBy(f"_s{k}", key)
                limit = 10 if limit is None else limit
            elif orders:
                pos = {n: k for k, (_, n) in enumerate(items)}
                # the key makes the order total, so that pages do not overlap
                by = [(F.col(f"_s{pos[o]}") if isinstance(o, str) else o) for o, _ in orders]
                tie = [] if distinct else [F.col(key)]
                pre = pre if distinct else pre.orderBy(*[c.asc() if a else c.desc() for c, (_, a) in zip(by, orders)], *tie)
            own = [F.col(f"`{c}`") for c in self.s.df.columns] if star else []
            out = pre.select(*own, *[F.col(f"_s{k}").alias(n) for k, (_, n) in enumerate(items)])
        if distinct:
            out = out.dropDuplicates()
        if orders and (aggregated or distinct):
            out = out.orderBy(*[(F.col(f"`{o}`") if isinstance(o, str) else o).asc() if a else (F.col(f"`{o}`") if isinstance(o, str) else o).desc() for o, a in orders])
        if offset:
            out = out.offset(offset)
        return out if limit is None else out.limit(limit)

    # ---- predicates --------------------------------------------------------------------------------------------

    def predicate(self) -> Column:
        out = self.conjunction()
        while self.word("OR"):
            out = out | self.conjunction()
        return out

    def conjunction(self) -> Column:
        out = self.negation()
        while self.word("AND"):
            out = out & self.negation()
        return out

    def negation(self) -> Column:
        if self.word("NOT"):
            return ~F.coalesce(self.negation(), F.lit(False))
        if self.peek() == ("op", "("):
            mark = self.i
            try:
                self.i += 1
                out = self.predicate()
                self.need(")")
                if not (self.peek()[0] == "op" and self.peek()[1] in "=<>!=+-*/"):
                    return out
            except ValueError:
                pass
            self.i = mark
        return self.comparison()

    def comparison(self) -> Column:
        left = self.expression()
        negate = self.word("NOT")
        kind = self.kind(left.field)
        if self.word("IS"):
            no = self.word("NOT")
            self.need("NULL")
            return left.col.isNotNull() if no else left.col.isNull()
        if self.word("BETWEEN"):
            if kind in ("tag", "text"):
                raise ValueError(f"BETWEEN does not apply to {kind} fields")
            lo = self.expression()
            self.need("AND")
            hi = self.expression()
            return self.flip(self.ranged(left, lo, hi), negate)
        if self.word("IN"):
            self.need("(")
            values = [self.expression()]
            while self.op(","):
                values.append(self.expression())
            self.need(")")
            hit = F.lit(False)
            for v in values:
                hit = hit | self.equal(left, v)
            return self.flip(hit, negate)
        if self.word("LIKE"):
            return self.flip(self.like(left, self.expression()), negate)
        op = self.op("=", "!=", "<>", "<", "<=", ">", ">=")
        if op is None:
            if left.value is True or left.name in ("fulltext", "fuzzy"):
                return self.flip(left.col, negate)
            raise ValueError(f"expected a comparison, found {self.peek()[1]!r}")
        right = self.expression()
        if op in ("=", "!=", "<>"):
            return self.flip(self.equal(left, right), negate ^ (op != "="))
        stamp = self.stamp(left, right)
        if stamp is not None:
            t = Timestamp(left.field)
            return self.flip({"<": t < stamp, "<=": t <= stamp, ">": t > stamp, ">=": t >= stamp}[op].compile(self.ctx), negate)
        a, b = left.col, right.col
        return self.flip({"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[op], negate)

    @staticmethod
    def flip(c: Column, negate: bool) -> Column:
        return ~F.coalesce(c, F.lit(False)) if negate else c

    def stamp(self, left: Expr, right: Expr) -> str | None:
        """The date literal that a numeric field is compared with."""
        return right.value if self.kind(left.field) == "numeric" and isinstance(right.value, str) and DATE.match(right.value) else None

    def ranged(self, left: Expr, lo: Expr, hi: Expr) -> Column:
        if self.stamp(left, lo) and self.stamp(left, hi):
            return Timestamp(left.field).between(lo.value, hi.value).compile(self.ctx)
        return left.col.between(lo.col, hi.col)

    def equal(self, left: Expr, right: Expr) -> Column:
        kind = self.kind(left.field)
        if kind == "tag" and right.literal:
            return (Tag(left.field) == str(right.value)).compile(self.ctx)
        if kind == "text" and right.literal:
            return self.phrase(left.field, str(right.value)).compile(self.ctx)
        if self.stamp(left, right):
            return (Timestamp(left.field) == right.value).compile(self.ctx)
        if kind == "numeric" and right.literal and isinstance(right.value, (int, float)):
            return (Num(left.field) == right.value).compile(self.ctx)
        return left.col == right.col

    def phrase(self, name: str, text: str) -> Phrase:
        stops = X.stopword_set("english", self.s.df.sparkSession) if self.s.schema.index.stopwords is None else frozenset(self.s.schema.index.stopwords)
        words = X.tokenize(text)
        kept = [w for w in words if w not in stops]
        if kept and len(kept) < len(words):
            warnings.warn(f"stop words are left out of the phrase {text!r}", UserWarning, stacklevel=2)
            loose = type("Loose", (_Loose,), {"stops": frozenset(stops)})
            return loose(name, " ".join(kept))
        return Phrase(name, text)

    def like(self, left: Expr, right: Expr) -> Column:
        pattern = str(right.value).lower()
        if pattern == "":
            raise ValueError("LIKE needs a pattern")
        rx = "^" + "".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in pattern) + "$"
        if self.kind(left.field) == "tag":
            return F.exists(self.ctx.tags(left.field), lambda t: t.rlike(rx))
        if self.kind(left.field) == "text":
            return F.exists(X.raw_tokens(F.col(left.field)), lambda t: t.rlike(rx))
        return F.lower(left.col.cast("string")).rlike(rx)

    # ---- expressions -------------------------------------------------------------------------------------------

    def expression(self) -> Expr:
        out = self.product()
        while o := self.op("+", "-"):
            b = self.product()
            out = Expr(out.col + b.col if o == "+" else out.col - b.col, aggregate=out.aggregate or b.aggregate)
        return out

    def product(self) -> Expr:
        out = self.primary()
        while o := self.op("*", "/", "%"):
            b = self.primary()
            out = Expr({"*": lambda x, y: x * y, "/": lambda x, y: x / y, "%": lambda x, y: x % y}[o](out.col, b.col), aggregate=out.aggregate or b.aggregate)
        return out

    def constant(self, v: Any) -> Expr:
        if isinstance(v, (list, tuple)):
            return Expr(F.array(*[F.lit(float(x)) for x in v]), value=list(v), literal=True)
        if isinstance(v, (bytes, bytearray)):
            return Expr(F.lit(bytearray(v)), value=bytes(v), literal=True)
        return Expr(F.lit(v), value=v, literal=True)

    def primary(self) -> Expr:
        kind, text = self.peek()
        if self.op("-"):
            e = self.primary()
            return self.constant(-e.value) if e.literal and isinstance(e.value, (int, float)) else Expr(-e.col, aggregate=e.aggregate)
        if self.op("("):
            e = self.expression()
            self.need(")")
            return e
        self.i += 1
        if kind == "num":
            return self.constant(float(text) if re.search(r"[.eE]", text) else int(text))
        if kind == "str":
            return self.constant(text[1:-1].replace(text[0] * 2, text[0]))
        if kind == "par":
            if text[1:] not in self.params:
                raise ValueError(f"no value for {text}")
            return self.constant(self.params[text[1:]])
        if kind != "word":
            raise ValueError(f"cannot read SQL at {text!r}")
        if self.peek() == ("op", "("):
            return self.call(text.upper())
        name = text.strip("`")
        if name.upper() == "NULL":
            return Expr(F.lit(None), literal=True)
        if name in self.s.df.columns:
            return Expr(F.col(f"`{name}`"), name=name, field=name)
        if name.lower() in self.named:
            return Expr(self.named[name.lower()], name=name)
        raise ValueError(f"no column {name!r}")

    def arguments(self) -> list[Expr]:
        self.need("(")
        out: list[Expr] = []
        if self.op(")"):
            return out
        while True:
            out.append(self.expression())
            if not self.op(","):
                break
        self.need(")")
        return out

    def time(self, e: Expr) -> Column:
        """The UTC time of an epoch number or a time column."""
        kind = self.s.dtypes.get(e.field or "")
        if kind is not None and kind.typeName().startswith(("timestamp", "date")):
            return e.col.cast("timestamp")
        return F.timestamp_micros((e.col.cast("double") * 1e6).cast("long"))

    def call(self, name: str) -> Expr:
        if name == "COUNT" and self.peek(1) == ("op", "*"):
            self.i += 2
            self.need(")")
            return Expr(F.count("*"), aggregate=True)
        if name in ("COUNT", "SUM", "AVG", "MIN", "MAX") and self.peek(1)[1].upper() == "DISTINCT":
            self.i += 2
            args = [self.expression()]
            while self.op(","):
                args.append(self.expression())
            self.need(")")
            if name != "COUNT" or len(args) != 1:
                raise ValueError(f"{name}(DISTINCT ...) takes COUNT of one column only")
            return Expr(F.count_distinct(args[0].col), aggregate=True)
        if name == "HYBRID_VECTOR_SEARCH":
            return self.hybrid_call()
        if name == "POINT":
            a = self.arguments()
            return Expr(F.lit(None), value=("point", float(a[0].value), float(a[1].value)), literal=True)
        a = self.arguments()
        if name in VECTOR_FUNCTIONS:
            metric = VECTOR_FUNCTIONS[name] or self.s.metric(a[0].field)
            vec = a[1].value
            if isinstance(vec, bytes):
                vec = V.from_bytes(vec, self.s.schema.fields[a[0].field].datatype)
            self.s.check_vector(a[0].field, vec)
            return Expr(V.distance(metric, a[0].col, [float(x) for x in vec]), name="vector_distance", vector=True)
        if name == "GEO_DISTANCE":
            point = next(x.value for x in a if isinstance(x.value, tuple))
            unit = next((str(x.value).lower() for x in a if isinstance(x.value, str)), "m")
            if unit not in G.UNITS:
                raise ValueError(f"unknown unit {unit!r}")
            lon, lat = G.lon_lat(a[0].col, self.s.dtypes.get(a[0].field))
            return Expr(G.haversine(lon, lat, point[1], point[2]) / G.UNITS[unit], name="geo_distance")
        if name == "FULLTEXT":
            return Expr(self.fulltext(a[0].field, str(a[1].value)), name="fulltext", value=True)
        if name == "FUZZY":
            word = str(a[1].value).lower()
            n = int(a[2].value) if len(a) > 2 else 1
            return Expr(F.exists(X.raw_tokens(F.col(a[0].field)), lambda t: F.levenshtein(t, F.lit(word), n) >= 0), name="fuzzy", value=True)
        c = a[0].col if a else F.lit(None)
        if name in ("SUM", "AVG", "MIN", "MAX", "COUNT"):
            return Expr({"SUM": F.sum, "AVG": F.avg, "MIN": F.min, "MAX": F.max, "COUNT": F.count}[name](c), aggregate=True)
        if name == "COUNT_DISTINCT":
            if len(a) != 1:
                raise ValueError("COUNT_DISTINCT takes one column")
            return Expr(F.count_distinct(c), aggregate=True)
        if name in ("STDDEV", "STDEV"):
            return Expr(F.stddev_samp(c), aggregate=True)
        if name == "QUANTILE":
            return Expr(F.percentile(c, F.lit(float(a[1].value))), aggregate=True)
        if name in ("ARRAY_AGG", "TOLIST"):
            return Expr(F.sort_array(F.collect_set(c)), aggregate=True)
        if name == "FIRST_VALUE":
            return Expr(F.min_by(c, F.col(self.s.key)), aggregate=True)
        if name in ("YEAR", "MONTH", "DAY", "HOUR", "MINUTE"):
            t = self.time(a[0])
            fn = {"YEAR": F.year(t), "MONTH": F.month(t) - 1, "DAY": F.day(t), "HOUR": F.hour(t), "MINUTE": F.minute(t)}[name]
            return Expr(fn, name=f"{name.lower()}({a[0].name})")
        if name == "DATE_FORMAT":
            pattern = re.sub(r"%.", lambda m: STRFTIME.get(m.group(), m.group()), str(a[1].value))
            return Expr(F.date_format(self.time(a[0]), pattern))
        if name in ("UPPER", "LOWER", "ABS", "FLOOR", "CEIL", "SQRT", "LENGTH", "ROUND"):
            extra = [int(x.value) for x in a[1:]]
            return Expr(getattr(F, name.lower())(c, *extra))
        raise ValueError(f"unknown function {name}")

    def fulltext(self, name: str, query: str) -> Column:
        """All words; ``OR`` or ``|`` between words means any; ``~word`` is optional."""
        toks = self.ctx.tokens(name)
        out = F.lit(True)
        for group in re.split(r"\s+AND\s+|\s+(?!OR\b|\|)(?<!OR )(?<!\| )", re.sub(r"\s*\|\s*", " OR ", query.strip())):
            words = [w for w in re.split(r"\s+OR\s+", group) if w and not w.startswith("~")]
            stems = self.ctx.stems(name, [t for w in words for t in X.tokenize(w)])
            if stems:
                out = out & F.arrays_overlap(toks, F.array(*[F.lit(s) for s in stems]))
        return out

    def hybrid_call(self) -> Expr:
        """hybrid_vector_search(cosine_distance(f, :v), fulltext(t, 'q'), rrf(constant => 60, window => 20) | linear(alpha => 0.3))"""
        self.need("(")
        got: dict[str, Any] = {"options": {}}
        while True:
            name = self.toks[self.i][1].upper()
            self.i += 1
            self.need("(")
            if name in VECTOR_FUNCTIONS:
                f = self.expression()
                self.need(",")
                got["vector_field"], got["vector"] = f.field, self.expression().value
                self.need(")")
            elif name == "FULLTEXT":
                f = self.expression()
                self.need(",")
                got["text_field"], got["text"] = f.field, str(self.expression().value)
                self.need(")")
            elif name in ("RRF", "LINEAR"):
                got["options"]["combination"] = name
                keys = {"CONSTANT": "rrf_constant", "WINDOW": "rrf_window", "ALPHA": "alpha"}
                while not self.op(")"):
                    k = self.toks[self.i][1].upper()
                    self.i += 1
                    self.need("=>")
                    if k in keys:
                        got["options"][keys[k]] = self.primary().value
                    else:
                        self.primary()
                    self.op(",")
            else:
                raise ValueError(f"hybrid_vector_search does not take {name.lower()}")
            if not self.op(","):
                break
        self.need(")")
        self.hybrid = got
        return Expr(F.lit(None), name="hybrid_score")


class _Loose(Phrase):
    """A phrase whose stop words were taken out: the rest in order, with nothing but stop words between them, however many."""

    #: Set by ``phrase``: the stop words that count.
    stops: frozenset[str] = frozenset()

    def compile(self, ctx: Context) -> Column:
        words = ctx.stems(self.name, X.tokenize(self.text))
        kept = X.tokens(F.col(self.name), not ctx.attr(self.name, "no_stem", False), sorted(self.stops))
        return F.contains(F.concat(F.lit(" "), F.array_join(kept, " "), F.lit(" ")), F.lit(f" {' '.join(words)} "))
