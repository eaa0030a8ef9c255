"""Conversion of nested source types (C18-C20): ``list<map<text,frozen<set<int>>>>``.

A type name is read into a small tree once, on the driver; the tree becomes one
column expression, so the conversion runs inside Spark's own functions whatever
the depth. Elements that do not convert become null, as scalars do; a collection
stays null where it was null; a value that is no collection of the named kind
becomes null (an error with ``strict``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Collections and how many types each one names; frozen only wraps.
COLLECTIONS = {"list": 1, "set": 1, "map": 2, "frozen": 1}


@dataclass(frozen=True)
class TypeTree:
    name: str
    args: tuple[TypeTree, ...] = ()


def type_tree(text: str) -> TypeTree:
    """The tree of a source type name; ``frozen<x>`` is x."""
    parts = re.findall(r"[<>,]|[^<>,\s]+", text)

    def read(i: int) -> tuple[TypeTree, int]:
        if i >= len(parts) or parts[i] in "<>,":
            raise ValueError(f"unsupported source type {text!r}")
        name, i = parts[i].lower(), i + 1
        if i >= len(parts) or parts[i] != "<":
            return TypeTree(name), i
        args = []
        while parts[i] in "<,":
            arg, i = read(i + 1)
            args.append(arg)
            if i >= len(parts):
                raise ValueError(f"unsupported source type {text!r}")
        if parts[i] != ">" or COLLECTIONS.get(name) != len(args):
            raise ValueError(f"unsupported source type {text!r}")
        return (args[0] if name == "frozen" else TypeTree(name, tuple(args))), i + 1

    tree, end = read(0)
    if end != len(parts):
        raise ValueError(f"unsupported source type {text!r}")
    return tree


def target_type(tree: TypeTree, scalar) -> T.DataType:
    """The Spark type of a tree; ``scalar(name)`` gives those of its leaves."""
    if not tree.args:
        return scalar(tree.name)
    args = [target_type(a, scalar) for a in tree.args]
    return T.MapType(*args) if tree.name == "map" else T.ArrayType(args[0])


def _orderable(tree: TypeTree) -> bool:
    return tree.name != "map" and all(_orderable(a) for a in tree.args)


def convert_nested(col: Column, tree: TypeTree, data_type: T.DataType | None, scalar, scalar_type, strict: bool = False) -> Column:
    """``col`` (of ``data_type``) converted by ``tree``; ``scalar(col, name, type)``
    converts the leaves, ``scalar_type(name)`` gives their Spark types."""
    if not tree.args:
        return scalar(col, tree.name, data_type)
    wanted = T.MapType if tree.name == "map" else T.ArrayType
    if not isinstance(data_type, wanted):
        if strict:
            raise ValueError(f"a {tree.name} cannot be made of {data_type.simpleString() if data_type else 'a value of unknown type'}")
        return F.lit(None).cast(target_type(tree, scalar_type))

    def inner(c: Column, i: int, kind: T.DataType) -> Column:
        return convert_nested(c, tree.args[i], kind, scalar, scalar_type, strict)

    if tree.name != "map":
        out = F.transform(col, lambda x: inner(x, 0, data_type.elementType))
        # distinct elements in a stable order; Spark cannot compare maps, those stay as they are
        return F.array_sort(F.array_distinct(out)) if tree.name == "set" and _orderable(tree.args[0]) else out
    entries = F.transform(F.map_entries(col), lambda e: F.struct(
        inner(e["key"], 0, data_type.keyType).alias("key"), inner(e["value"], 1, data_type.valueType).alias("value")))
    # a key that does not convert has no place in a map; of keys that convert alike the last stays
    entries = F.filter(entries, lambda e: e["key"].isNotNull())
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1))),
                                                    lambda other: other["key"] == e["key"]))
    return F.map_from_entries(entries if strict else last)
