"""Deeply nested records as flat node tables linked by interval labels.

A depth-first traversal gives every node of a record two numbers: ``pre`` when it is entered and
``post`` when it is left, drawn from one counter. Node ``a`` is an ancestor of node ``b`` of the
same record just when ``a.pre < b.pre`` and ``b.post < a.post``; node tables need no other key.

The traversal needs the JSON tree and runs once over each body in Arrow batches. Linking is
relational: nodes of one record are read in order of ``pre``, where the last ancestor-kind node
of a depth that was entered before a node is its ancestor just when its interval encloses the
node. That is a sort of the nodes of a record, not a pairing of all its nodes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

NODE_SCHEMA = "kind string, no int, pre int, post int, lang string, text string, depths array<int>"


@dataclass(frozen=True)
class NodeKind:
    """Nodes of one table: those reached from a node of kind ``below`` (or the root) by ``path``.

    Key names are compared without a namespace prefix. ``anywhere``: found at any depth, inside
    nodes of the same kind too.
    """

    name: str
    path: tuple[str, ...]
    below: str | None = None
    anywhere: bool = False


#: Node tables of bibliographic records.
BIBLIO = (
    NodeKind("document", ("exchange-document",), None, True),
    NodeKind("title", ("bibliographic-data", "invention-title"), "document"),
    NodeKind("applicant", ("bibliographic-data", "parties", "applicants", "applicant"), "document"),
    NodeKind("name", ("applicant-name", "name"), "applicant"),
)


def _text(value) -> str | None:
    if isinstance(value, dict):
        value = value.get("$")
    if isinstance(value, bool):
        return str(value).lower()
    return str(value) if isinstance(value, (str, int, float)) else None


def label(tree, kinds: tuple[NodeKind, ...]) -> list[tuple]:
    """``(kind, no, pre, post, lang, text, depths)`` of every node of ``kinds`` in document order.

    ``no`` counts the nodes of a kind below the same ancestor of the kind it is ``below``, from 1.
    ``depths`` says for each of ``kinds`` how many of its nodes are open at this one, itself
    included. Null nodes aren't nodes; nodes without text are. Lists (also lists in lists) stand
    for their elements. The traversal has its own stack, so depth is bounded by memory only.
    """
    place = {kind.name: i for i, kind in enumerate(kinds)}
    depths = [0] * len(kinds)
    out: list[list] = []
    counter = 0
    by_below: dict[str | None, list[NodeKind]] = {}
    for kind in kinds:
        by_below.setdefault(kind.below, []).append(kind)
    # A frame: (value, open searches [(kind, position in path, counts)], row to close).
    start = [(kind, 0, {}) for kind in by_below.get(None, [])]
    stack: list[tuple] = [("enter", tree, start, None)]
    while stack:
        step, value, searches, row = stack.pop()
        if step == "leave":
            counter += 1
            if row is not None:
                row[3] = counter
                depths[place[row[0]]] -= 1
            continue
        if value is None:
            continue
        if isinstance(value, list):
            stack.extend(("enter", x, searches, None) for x in reversed(value))
            continue
        counter += 1
        pre, opened, ongoing = counter, None, []
        for kind, at, counts in searches:
            if at == len(kind.path):
                counts[kind.name] = counts.get(kind.name, 0) + 1
                lang = value.get("@lang") if isinstance(value, dict) else None
                depths[place[kind.name]] += 1
                opened = [kind.name, counts[kind.name], pre, 0, lang if isinstance(lang, str) else None, _text(value), tuple(depths)]
                out.append(opened)
                own: dict = {}
                ongoing.extend((k, 0, own) for k in by_below.get(kind.name, []))
                if kind.anywhere and len(kind.path) == 1:
                    ongoing.append((kind, 0, counts))
            else:
                ongoing.append((kind, at, counts))
        stack.append(("leave", None, None, opened))
        if isinstance(value, dict):
            children = []
            for key, child in value.items():
                local = key.rpartition(":")[2]
                inner = []
                for kind, at, counts in ongoing:
                    if local == kind.path[at]:
                        inner.append((kind, at + 1, counts))
                    elif kind.anywhere and at == 0:
                        inner.append((kind, 0, counts))
                    if kind.anywhere and at == 0 and len(kind.path) > 1 and local == kind.path[0]:
                        inner.append((kind, 0, counts))
                children.append(("enter", child, inner, None))
            stack.extend(reversed(children))
    return [tuple(r) for r in out]


_SPACE = re.compile(r"[ \t\n\r]*")
_NUMBER = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?")
_WORDS = {"true": True, "false": False, "null": None, "NaN": float("nan"), "Infinity": float("inf"), "-Infinity": float("-inf")}


def parse(text: str):
    """The JSON tree of ``text``, of any depth; ValueError if it isn't JSON. The last of equal keys counts."""
    try:
        return json.loads(text)
    except RecursionError:
        pass
    # The state is what may come next: a value, the first value of a list, a first or further key, or what follows a value.
    root: list = []
    stack: list = [root]
    keys: list = []
    state, at = "value", _SPACE.match(text).end()
    while at < len(text) or state != "after" or len(stack) > 1:
        c = text[at : at + 1]
        if state in ("value", "first"):
            if c == "]" and state == "first":
                stack.pop()
                at, state = at + 1, "after"
            else:
                if c == '"':
                    value, at = scanstring(text, at + 1, True)
                elif c in ("{", "["):
                    value, at = ({} if c == "{" else []), at + 1
                elif m := _NUMBER.match(text, at):
                    value, at = (int(m.group()) if m.group().lstrip("-").isdigit() else float(m.group())), m.end()
                elif word := next((w for w in _WORDS if text.startswith(w, at)), None):
                    value, at = _WORDS[word], at + len(word)
                else:
                    raise ValueError(f"no value at {at}")
                if isinstance(stack[-1], dict):
                    stack[-1][keys.pop()] = value
                else:
                    stack[-1].append(value)
                state = "after"
                if c in ("{", "["):
                    stack.append(value)
                    state = "opened" if c == "{" else "first"
        elif state in ("opened", "key"):
            if c == "}" and state == "opened":
                stack.pop()
                at, state = at + 1, "after"
            elif c == '"':
                key, at = scanstring(text, at + 1, True)
                at = _SPACE.match(text, at).end()
                if text[at : at + 1] != ":":
                    raise ValueError(f"no colon at {at}")
                keys.append(key)
                at, state = at + 1, "value"
            else:
                raise ValueError(f"no key at {at}")
        elif len(stack) > 1 and c == ",":
            at, state = at + 1, "key" if isinstance(stack[-1], dict) else "value"
        elif len(stack) > 1 and c == ("}" if isinstance(stack[-1], dict) else "]"):
            stack.pop()
            at += 1
        else:
            raise ValueError(f"unexpected text at {at}")
        at = _SPACE.match(text, at).end()
    return root[0]


def node_tables(df: DataFrame, key: str, body: str, kinds: tuple[NodeKind, ...] = BIBLIO) -> DataFrame:
    """All nodes of ``kinds``: ``key``, ``kind``, ``no``, ``pre``, ``post``, ``lang``, ``text``, ``depths``.

    A null, blank or malformed body has no nodes; refetched bodies under other keys have theirs.
    Other columns of ``df`` are ignored. ``node_tables(...).where("kind = 'title'")`` is the
    table of one type.
    """
    source = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{body}`").alias("b")).where(F.col("b").isNotNull())
    key_type = source.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            bodies = batch.column(1)
            for i in range(batch.num_rows):
                try:
                    tree = parse(bodies[i].as_py())
                except ValueError:
                    continue
                nodes = label(tree, kinds)
                rows.extend(nodes)
                keys.extend([i] * len(nodes))
            columns = list(zip(*rows)) if rows else [[]] * 7
            types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keys, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, types))], names=["k", "kind", "no", "pre", "post", "lang", "text", "depths"]
            )

    return source.mapInArrow(run, f"k {key_type}, {NODE_SCHEMA}").withColumnRenamed("k", key)


def link(nodes: DataFrame, key: str, parents: dict[str, str], kinds: tuple[NodeKind, ...] = BIBLIO) -> DataFrame:
    """``nodes`` with ``<kind>_no`` and ``<kind>_pre`` of the nearest ancestor of each kind in ``parents``, itself included.

    ``parents`` names the ancestor kinds and, for documentation of the model, the kind each of
    them lies below; ``kinds`` are those of ``nodes``. The link is by interval containment and
    null where no node of that kind encloses the row: of the nodes of that kind that were opened
    at the depth of the row, the last one is the only one that can be open still.
    """
    place = {kind.name: i for i, kind in enumerate(kinds)}
    # One exchange by record serves the windows of all kinds.
    nodes = nodes.repartition(F.col(f"`{key}`"))

    def order(kind: str):
        return W.partitionBy(F.col(f"`{key}`"), F.get("depths", F.lit(place[kind]))).orderBy("pre").rowsBetween(W.unboundedPreceding, W.currentRow)

    spans = {kind: F.last(F.when(F.col("kind") == kind, F.struct("no", "pre", "post")), ignorenulls=True).over(order(kind)) for kind in parents}
    out = nodes.select("*", *[span.alias(f"__{kind}") for kind, span in spans.items()])
    for kind in parents:
        encloses = (F.col(f"__{kind}.pre") <= F.col("pre")) & (F.col("post") <= F.col(f"__{kind}.post"))
        out = out.withColumn(f"{kind}_no", F.when(encloses, F.col(f"__{kind}.no"))).withColumn(f"{kind}_pre", F.when(encloses, F.col(f"__{kind}.pre")))
    return out.drop(*[f"__{kind}" for kind in parents])
