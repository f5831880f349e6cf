"""Translation rules: small expressions over the columns of a survey, compiled to Catalyst expressions and never evaluated as Python.

A rule block holds, for one survey, a ``direct`` map of values and ``conditions`` (``expr`` and ``value``), and a ``default``:
the default is overwritten by the direct map, and that by the last condition that holds.
"""

from __future__ import annotations

import ast
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType, StructType

from skyloom.functions.text import strip

_COMPARE = {
    ast.Eq: lambda a, b: a == b, ast.NotEq: lambda a, b: a != b, ast.Lt: lambda a, b: a < b,
    ast.LtE: lambda a, b: a <= b, ast.Gt: lambda a, b: a > b, ast.GtE: lambda a, b: a >= b,
}
_ARITHMETIC = {ast.Add: lambda a, b: a + b, ast.Sub: lambda a, b: a - b, ast.Mult: lambda a, b: a * b, ast.Div: lambda a, b: F.try_divide(a, b)}


@dataclass
class _Value:
    column: Column
    text: bool = False
    #: A floating-point column as it came from the file: missing counts as NaN, so that it differs from everything.
    raw: bool = False


class RuleError(ValueError):
    """An expression that the rule language doesn't have, or a column that isn't there."""


class _Compiler:
    def __init__(self, schema: StructType, normalized: Iterable[str]):
        self.types: dict[str, DataType] = {f.name: f.dataType for f in schema}
        self.normalized = set(normalized)

    def value(self, node: ast.expr) -> _Value:
        match node:
            case ast.Constant(value=bool() as v):
                return _Value(F.lit(v))
            case ast.Constant(value=str() as v):
                return _Value(F.lit(v), text=True)
            case ast.Constant(value=int() | float() as v):
                return _Value(F.lit(v))
            case ast.Name(id=name):
                if name not in self.types:
                    raise RuleError(f"column {name!r} isn't there")
                kind, c = self.types[name], F.col(f"`{name}`")
                floating = isinstance(kind, (DoubleType, FloatType))
                return _Value(F.when(~F.isnan(c), c) if floating else c, isinstance(kind, StringType), floating and name not in self.normalized)
            case ast.UnaryOp(op=ast.USub(), operand=x):
                v = self.value(x)
                return _Value(-v.column, raw=v.raw)
            case ast.BinOp(left=a, op=op, right=b) if type(op) in _ARITHMETIC:
                a, b = self.value(a), self.value(b)
                return _Value(_ARITHMETIC[type(op)](a.column, b.column), raw=a.raw or b.raw)
            case ast.Call(args=[x], keywords=[]):
                return self.call(ast.unparse(node.func), self.value(x))
            case ast.Subscript(value=x, slice=index):
                v = self.value(x)
                if not v.text:
                    raise RuleError("only text has places")
                return _Value(self.place(v.column, index), text=True)
            case ast.Compare() | ast.BoolOp() | ast.UnaryOp():
                return _Value(self.truth(node))
        raise RuleError(f"not in the rule language: {ast.unparse(node)}")

    def call(self, name: str, v: _Value) -> _Value:
        c = v.column
        match name:
            case "np.abs" | "abs":
                return _Value(F.abs(c), raw=v.raw)
            case "np.trunc":
                return _Value(F.when(c < 0, F.ceil(c)).otherwise(F.floor(c)).cast("double"), raw=v.raw)
            case "np.isfinite":
                return _Value(F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
            case "len":
                return _Value(F.length(c.cast("string")))
            case "str":
                return _Value(c.cast("string"), text=True)
            case "float":
                return _Value(c.cast("string").try_cast("double"), raw=v.raw)
            case "int":
                d = c.cast("string").try_cast("double")
                return _Value(F.when(d == F.floor(d), d.cast("long")), raw=v.raw)
        raise RuleError(f"not in the rule language: {name}()")

    @staticmethod
    def place(c: Column, index: ast.expr) -> Column:
        """Character or slice of text by Python's places; outside the text a character is null."""
        number = lambda n: None if n is None else int(ast.literal_eval(n))
        n = F.length(c)
        if isinstance(index, ast.Slice):
            if index.step is not None:
                raise RuleError("slices with a step aren't in the rule language")
            lo, hi = number(index.lower), number(index.upper)
            at = lambda k, d: F.lit(d) if k is None else F.lit(k) if k >= 0 else F.greatest(n + k, F.lit(0))
            start, end = at(lo, 0), n if hi is None else at(hi, 0)
            return F.substring(c, start + 1, F.greatest(end - start, F.lit(0)))
        k = number(index)
        return F.when(n > k, F.substring(c, F.lit(k + 1), F.lit(1))) if k >= 0 else F.when(n >= -k, F.substring(c, n + k + 1, F.lit(1)))

    def truth(self, node: ast.expr) -> Column:
        match node:
            case ast.BoolOp(op=op, values=parts):
                join = (lambda a, b: a & b) if isinstance(op, ast.And) else (lambda a, b: a | b)
                return reduce(join, [self.truth(p) for p in parts])
            case ast.UnaryOp(op=ast.Not(), operand=x):
                return ~self.truth(x)
            case ast.Compare(left=first, ops=ops, comparators=rest):
                sides = [self.value(n) for n in [first, *rest]]
                return reduce(lambda a, b: a & b, [self.compare(a, op, b) for a, op, b in zip(sides, ops, sides[1:])])
        return self.value(node).column.cast("boolean")

    @staticmethod
    def compare(a: _Value, op: ast.cmpop, b: _Value) -> Column:
        if type(op) not in _COMPARE:
            raise RuleError(f"not in the rule language: {type(op).__name__}")
        left, right = a.column, b.column
        if a.text != b.text:  # text never equals a number
            return F.lit(isinstance(op, ast.NotEq)) if isinstance(op, (ast.Eq, ast.NotEq)) else F.lit(False)
        c = _COMPARE[type(op)](left, right)
        return F.coalesce(c, F.lit(isinstance(op, ast.NotEq))) if a.raw or b.raw else c


def compile_condition(text: str, schema: StructType, normalized: Iterable[str] = ()) -> Column:
    """A condition as a boolean column that is never null.

    The language: names, numbers, text, + - * /, chained comparisons, and/or/not, ``len str int float abs``, ``np.trunc``,
    ``np.isfinite``, ``np.abs``, places and slices of text. Comparisons with null are false; of columns not in ``normalized`` that
    are floating-point, ``!=`` with a missing value is true. Anything else raises RuleError.
    """
    try:
        tree = ast.parse(text, mode="eval").body
    except SyntaxError as e:
        raise RuleError(f"can't be parsed: {text}") from e
    return F.coalesce(_Compiler(schema, normalized).truth(tree), F.lit(False))


def variables(text: str) -> set[str]:
    """The columns that an expression names."""
    tree = ast.parse(text, mode="eval")
    calls = {id(n.func) for n in ast.walk(tree) if isinstance(n, ast.Call)} | {id(n.value) for n in ast.walk(tree) if isinstance(n, ast.Attribute)}
    return {n.id for n in ast.walk(tree) if isinstance(n, ast.Name) and id(n) not in calls}


@dataclass
class Rule:
    """What one survey's values of a field mean on the common scale."""

    direct: Mapping = field(default_factory=dict)
    conditions: list[tuple[str, object]] = field(default_factory=list)
    default: object = None

    @classmethod
    def parse(cls, block: Mapping) -> Rule:
        conditions = [(c["expr"], c.get("value", block.get("default"))) for c in block.get("conditions") or []]
        return cls(block.get("direct") or {}, conditions, block.get("default"))

    def column(self, source: str, schema: StructType, normalized: Iterable[str], result: str) -> Column:
        """The translated value of column ``source`` as type ``result``; null where nothing applies, and for empty text."""
        typed = lambda v: F.lit(None if v == "" else v).cast(result)
        out = typed(self.default)
        if self.direct:
            c = F.col(f"`{source}`")
            key = F.lower(strip(c.cast("string")))
            numeric = key.try_cast("double")
            for k, v in self.direct.items():
                try:
                    hit = numeric == F.lit(float(k))
                except (TypeError, ValueError):
                    hit = key == F.lit(str(k).strip().lower())
                out = F.when(hit, typed(v)).otherwise(out)
        for text, v in self.conditions:  # the last that holds wins
            out = F.when(compile_condition(text, schema, normalized), typed(v)).otherwise(out)
        return out
