"""Rule texts of a mapping as Spark columns: a small part of Python's expressions, checked before anything runs.

A text may use names, numbers, texts, comparisons, ``and``/``or``/``not``, ``in``, ``is None``, arithmetic and the functions
listed here. Anything else, and any name that is neither a column nor a function, is refused with its place in the text.
Null follows SQL: a comparison with null is null, which counts as failed in a rule.
"""

from __future__ import annotations

import ast
from collections.abc import Callable
from functools import reduce
from operator import add, and_, eq, ge, gt, le, lt, mod, mul, ne, or_, sub

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Looks up a name of the text; ``None`` refuses it.
Names = Callable[[str], Column | None]

_COMPARISONS = {ast.Eq: eq, ast.NotEq: ne, ast.Lt: lt, ast.LtE: le, ast.Gt: gt, ast.GtE: ge}
_ARITHMETIC = {ast.Add: add, ast.Sub: sub, ast.Mult: mul, ast.Mod: mod}


def _pattern(text: Column, pattern: str) -> Column:
    return text.cast("string").rlike(pattern)


#: Functions by name, with the least and most arguments, and the places of those that must be constants.
FUNCTIONS: dict[str, tuple[Callable, int, int, tuple[int, ...]]] = {
    "abs": (F.abs, 1, 1, ()),
    "coalesce": (F.coalesce, 1, 99, ()),
    "concat": (F.concat, 1, 99, ()),
    "float": (lambda x: x.try_cast("double"), 1, 1, ()),
    "int": (lambda x: x.try_cast("bigint"), 1, 1, ()),
    "len": (lambda x: F.length(x.cast("string")), 1, 1, ()),
    "lower": (F.lower, 1, 1, ()),
    "matches": (_pattern, 2, 2, (1,)),
    "replace": (F.replace, 3, 3, ()),
    "round": (lambda x, n=0: F.round(x, n), 1, 2, (1,)),
    "str": (lambda x: x.cast("string"), 1, 1, ()),
    "strip": (F.trim, 1, 1, ()),
    "substr": (F.substr, 2, 3, ()),
    "upper": (F.upper, 1, 1, ()),
}


class RuleError(ValueError):
    """A rule text that is no expression of the allowed kind."""


def compile_rule(text: str, names: Names) -> Column:
    """The column that a rule text stands for."""
    try:
        tree = ast.parse(text.strip(), mode="eval")
    except (SyntaxError, ValueError) as problem:
        raise RuleError(f"Not an expression: {text!r}") from problem
    return _Compiler(text, names).column(tree.body)


class _Compiler:
    def __init__(self, text: str, names: Names) -> None:
        self.text, self.names = text, names

    def refuse(self, node: ast.AST, why: str) -> RuleError:
        return RuleError(f"{why} at {getattr(node, 'col_offset', 0)} in {self.text!r}")

    def constant(self, node: ast.expr):
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
            value = self.constant(node.operand)
            if isinstance(value, (int, float)) and not isinstance(value, bool):
                return -value
        elif isinstance(node, ast.Constant) and (node.value is None or isinstance(node.value, (bool, int, float, str))):
            return node.value
        raise self.refuse(node, "Not a constant")

    def column(self, node: ast.expr) -> Column:
        match node:
            case ast.Constant():
                return F.lit(self.constant(node))
            case ast.Name():
                found = self.names(node.id)
                if found is None:
                    raise self.refuse(node, f"Unknown name {node.id}")
                return found
            case ast.BoolOp():
                join = and_ if isinstance(node.op, ast.And) else or_
                return reduce(join, map(self.column, node.values))
            case ast.UnaryOp(op=ast.Not()):
                return ~self.column(node.operand)
            case ast.UnaryOp(op=ast.USub()):
                return -self.column(node.operand)
            case ast.BinOp(op=ast.Div()):
                return F.try_divide(self.column(node.left), self.column(node.right))
            case ast.BinOp() if type(node.op) in _ARITHMETIC:
                return _ARITHMETIC[type(node.op)](self.column(node.left), self.column(node.right))
            case ast.Compare():
                sides = [node.left, *node.comparators]
                return reduce(and_, [self.compared(*part) for part in zip(sides, node.ops, sides[1:])])
            case ast.Call():
                return self.call(node)
        raise self.refuse(node, f"Not allowed: {type(node).__name__}")

    def compared(self, left: ast.expr, how: ast.cmpop, right: ast.expr) -> Column:
        if isinstance(how, (ast.Is, ast.IsNot)):
            if not (isinstance(right, ast.Constant) and right.value is None):
                raise self.refuse(right, "Only None may follow is")
            empty = self.column(left).isNull()
            return empty if isinstance(how, ast.Is) else ~empty
        if isinstance(how, (ast.In, ast.NotIn)):
            if not isinstance(right, (ast.List, ast.Tuple, ast.Set)):
                raise self.refuse(right, "Only a list may follow in")
            found = self.column(left).isin([self.constant(item) for item in right.elts])
            return found if isinstance(how, ast.In) else ~found
        return _COMPARISONS[type(how)](self.column(left), self.column(right))

    def call(self, node: ast.Call) -> Column:
        if not isinstance(node.func, ast.Name) or node.func.id not in FUNCTIONS:
            raise self.refuse(node, "Unknown function")
        function, least, most, constants = FUNCTIONS[node.func.id]
        if node.keywords or not least <= len(node.args) <= most:
            raise self.refuse(node, f"{node.func.id} takes {least} to {most} arguments")
        return function(*[self.constant(a) if i in constants else self.column(a) for i, a in enumerate(node.args)])
