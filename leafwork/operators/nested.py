"""Nested JSON records as flat tables with parent-child links.

Each object of a record is hashed bottom-up (a Merkle tree): its identity is the digest of its sorted
fields, in which every nested object is replaced by its own digest.  Equal subtrees anywhere in the
corpus therefore have one identity and are stored once; every occurrence is kept as a bridge row with
the path, the parent and the ordinal.

Defined results: a record that is null, empty, not valid JSON or not an object has no rows.  ``NaN`` and
``Infinity`` aren't JSON.  Null array entries have no row but keep their position.  A key that is
repeated in one object yields a row for each value that is an object.  Repeated input rows yield
repeated occurrences.  Nesting is limited by memory only.  Columns of the input other than the id and the
JSON text aren't read, so their names can't clash.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OCCURRENCE = (
    "elem_path string, parent_path string, field string, ordinal int, depth int, seq int, "
    "object_hash string, parent_hash string, attrs array<struct<name:string,pos:int,kind:string,value:string>>"
)


class _Object:
    __slots__ = ("pairs",)

    def __init__(self, pairs):
        self.pairs = pairs


class _Number(str):
    __slots__ = ()


def _reject(name):
    raise ValueError(name)


_DECODER = dict(object_pairs_hook=_Object, parse_int=_Number, parse_float=_Number, parse_constant=_reject)
_TOKEN = re.compile(r'[ \t\n\r]*(?:([\[\]{},:])|("(?:[^"\\\x00-\x1f]|\\.)*")|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?)|(true|false|null))', re.ASCII)


def _parse_deep(text: str):
    """The same result as the library's parser, with a stack of its own: for nesting beyond its recursion."""
    root: list = []
    stack: list = [(root, None)]  # container, pending key
    pos, state = 0, "value"
    end = len(text.rstrip(" \t\n\r"))
    while pos < end:
        m = _TOKEN.match(text, pos)
        if not m:
            raise ValueError(pos)
        pos = m.end()
        mark, string, number, word = m.groups()
        box, key = stack[-1]
        if state in ("key", "key or end") and string:
            stack[-1] = (box, json.loads(string))
            state = "colon"
        elif state == "colon" and mark == ":":
            state = "value"
        elif state in ("value", "value or end") and mark != "]" and mark not in (",", ":", "}"):
            if mark:
                item = _Object([]) if mark == "{" else []
            else:
                item = json.loads(string) if string else _Number(number) if number else {"true": True, "false": False, "null": None}[word]
            if isinstance(box, _Object):
                box.pairs.append((key, item))
            else:
                box.append(item)
            if mark:
                stack.append((item, None))
                state = "key or end" if mark == "{" else "value or end"
            else:
                state = "next"
        elif (mark == "]" and state in ("next", "value or end") and isinstance(box, list) and len(stack) > 1) or (mark == "}" and state in ("next", "key or end") and isinstance(box, _Object)):
            stack.pop()
            state = "next"
        elif mark == "," and state == "next" and len(stack) > 1:
            state = "key" if isinstance(box, _Object) else "value"
        else:
            raise ValueError(pos)
    if len(stack) > 1 or len(root) != 1:
        raise ValueError("end")
    return root[0]


def parse_object(text: str | None) -> _Object | None:
    if not text:
        return None
    try:
        try:
            top = json.loads(text, **_DECODER)
        except RecursionError:
            top = _parse_deep(text)
    except ValueError:
        return None
    return top if isinstance(top, _Object) else None


def _clean(s: str) -> str:
    return s.encode("utf-8", "replace").decode("utf-8") if not s.isascii() else s


def _scalar(v) -> tuple[str, str | None]:
    if v is None:
        return "null", None
    if v is True or v is False:
        return "boolean", "true" if v else "false"
    if isinstance(v, _Number):
        return "number", str(v)
    return "string", _clean(v)


def shred_object(top: _Object) -> list[tuple]:
    """(path, parent path, field, ordinal, depth, seq, hash, parent hash, attrs) of each object, the top level first.

    The walk keeps its own stack; children are hashed before their parents by going through the
    pre-order list backwards.
    """
    nodes: list[list] = [[top, "", None, None, None, 0]]  # object, path, parent index, field, ordinal, depth
    inside: list[dict[int, int]] = []
    stack = [0]
    while stack:
        at = stack.pop()
        obj, path, _, _, _, depth = nodes[at]
        found = []
        for key, value in obj.pairs:
            walk = [(value, f"{path}/{_clean(key)}" if at else _clean(key), None)]
            while walk:
                v, p, ordinal = walk.pop()
                if isinstance(v, _Object):
                    found.append([v, p, at, _clean(key), ordinal, depth + 1])
                elif isinstance(v, list):
                    walk.extend((x, f"{p}/{k}", k) for k, x in reversed(list(enumerate(v))))
        first = len(nodes)
        nodes.extend(found)
        stack.extend(range(first + len(found) - 1, first - 1, -1))
    digest: dict[int, str] = {}
    rows: list[tuple] = [()] * len(nodes)
    for at in range(len(nodes) - 1, -1, -1):
        obj, path, parent, field, ordinal, depth = nodes[at]
        attrs, parts = [], []
        for key, value in sorted(obj.pairs, key=lambda kv: kv[0]):
            parts.append(json.dumps(key) + ":")
            walk, pos = [value], 0
            while walk:
                v = walk.pop()
                if isinstance(v, _Object):
                    parts.append("#" + digest[id(v)])
                elif isinstance(v, list):
                    parts.append("[")
                    walk.append(_CLOSE)
                    walk.extend(reversed(v))
                elif v is _CLOSE:
                    parts.append("]")
                else:
                    kind, text = _scalar(v)
                    attrs.append((_clean(key), pos, kind, text))
                    pos += 1
                    parts.append(text if kind == "number" else json.dumps(v) if kind != "null" else "null")
                parts.append(",")
        digest[id(obj)] = hashlib.sha256("".join(parts).encode("ascii", "backslashreplace")).hexdigest()[:32]
        rows[at] = (path, None if parent is None else nodes[parent][1], field, ordinal, depth, at, digest[id(obj)], parent, attrs)
    return [(*r[:7], None if r[7] is None else digest[id(nodes[r[7]][0])], r[8]) for r in rows]


_CLOSE = object()


def shred(df: DataFrame, id_col: str, json_col: str, *, with_top: bool = True, attributes: bool = True) -> DataFrame:
    """One row for each occurrence of an object in ``json_col``: ``id_col`` and the columns of OCCURRENCE.

    The top level has the path '' and no parent; ``with_top=False`` leaves it out.  ``attributes=False``
    leaves ``attrs`` null, for queries that need the links only.  No shuffle: each record is one row of input.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    names = [id_col, *(c.split()[0] for c in OCCURRENCE.split(", "))]
    assert id_col not in names[1:], "the id column has the name of an output column"

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            out: list[tuple] = []
            for key, text in zip(batch.iloc[:, 0], batch.iloc[:, 1], strict=True):
                top = parse_object(text)
                if top is not None:
                    rows = shred_object(top)
                    out.extend((key, *r[:8], [dict(zip(("name", "pos", "kind", "value"), a, strict=True)) for a in r[8]] if attributes else None) for r in (rows if with_top else rows[1:]))
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)

    return df.select(id_col, json_col).where(F.length(json_col) > 0).mapInPandas(run, f"{id_col} {id_type}, {OCCURRENCE}")


def objects(occurrences: DataFrame) -> DataFrame:
    """Each distinct object once: its identity, its scalar attributes and how often it occurs."""
    return occurrences.groupBy("object_hash").agg(F.first("attrs").alias("attrs"), F.count(F.lit(1)).alias("occurrences"))


def attribute(attrs: Column | str, name: str) -> Column:
    """The first scalar value of the attribute ``name`` as text; null where it is missing, null or no scalar."""
    attrs = F.col(attrs) if isinstance(attrs, str) else attrs
    return F.get(F.filter(attrs, lambda a: a["name"] == name), F.lit(0))["value"]


def bridge(occurrences: DataFrame) -> DataFrame:
    """The distinct parent-child links between identities, with field and ordinal."""
    return occurrences.where("parent_hash IS NOT NULL").groupBy("parent_hash", "field", "ordinal", "object_hash").agg(F.count(F.lit(1)).alias("occurrences"))
