"""Nested JSON as flat rows.

A few levels of a document are expanded by array expressions inside one projection.
Nodes at the last of these levels that have something below them are the roots of the
next pass, until there are none, so a document may be nested to any depth.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from auditflow.operators.checks import is_id_disguise, is_id_kind, is_identifier_only, violations
from auditflow.session import checkpointed

#: Levels that one projection expands; how often it is applied follows from the data.
LEVELS = 8


def _unfold(df: DataFrame, keep: list[str], top: Column, below: Callable[[Column], Column], levels: int) -> DataFrame:
    """Rows ``keep, _n`` of all nodes, starting from the array ``top``; ``below`` gives the nodes under one."""
    parts = []
    while True:
        out = df.withColumn("_l0", top)
        for level in range(1, levels):
            out = out.withColumn(f"_l{level}", F.flatten(F.transform(F.col(f"_l{level - 1}"), below)))
        upper = [F.transform(f"_l{d}", lambda n: F.struct(n.alias("n"), F.lit(False).alias("more"))) for d in range(levels - 1)]
        lowest = F.transform(f"_l{levels - 1}", lambda n: F.struct(n.alias("n"), (F.size(below(n)) > 0).alias("more")))
        rows = out.select(*keep, F.explode(F.concat(*upper, lowest)).alias("_r"))
        # written once, since both the result and the next pass read it
        rows = checkpointed(rows.select(*keep, F.col("_r.n").alias("_n"), F.col("_r.more").alias("_more")))
        parts.append(rows.select(*keep, "_n"))
        last = rows.where("_more").select(*keep, "_n")
        if last.isEmpty():
            return reduce(DataFrame.union, parts)
        df, top = last, below(F.col("_n"))


def flatten_tree(df: DataFrame, root: str, child: str = "child_list", name: str = "name", levels: int = LEVELS) -> DataFrame:
    """Nodes of an element tree, each with its path and the names above it.

    Sorting by ``path`` gives the depth-first preorder.
    """
    def kids(node: Column) -> Column:
        return F.coalesce(F.try_variant_get(node, f"$.{child}", "array<variant>"), F.array().cast("array<variant>"))

    def below(p: Column) -> Column:
        own = F.coalesce(F.try_variant_get(p["node"], f"$.{name}", "string"), F.lit(""))
        return F.transform(kids(p["node"]), lambda c, i: F.struct(
            F.concat(p["path"], F.array(i)).alias("path"),
            F.concat(p["parent_names"], F.array(own)).alias("parent_names"),
            c.alias("node")))

    top = F.coalesce(F.try_variant_get(F.col(root), "$", "array<variant>"), F.array().cast("array<variant>"))
    first = F.transform(top, lambda n, i: F.struct(
        F.array(i).alias("path"), F.array().cast("array<string>").alias("parent_names"), n.alias("node")))
    keep = [c for c in df.columns if c != root]
    return _unfold(df, keep, first, below, levels).select(
        *keep, F.col("_n.path").alias("path"), F.size("_n.path").alias("depth"),
        F.col("_n.parent_names").alias("parent_names"), F.col("_n.node").alias("node"))


def index_tree(nodes: DataFrame, keys: list[str], id_field: str = "id") -> DataFrame:
    """One node per id; of repeated ids the last in preorder stays."""
    tagged = nodes.withColumn("id", F.try_variant_get("node", f"$.{id_field}", "string"))
    return tagged.groupBy(*keys, "id").agg(
        F.max_by("node", "path").alias("node"), F.max("path").alias("path"), F.count("*").alias("n_seen")
    )


# A text, a bracket, a mark between values, or any other plain value.
TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\],:]|[^\s{}\[\],:"]+')
#: Rows and characters of one batch that a walk gives.
WALK_ROWS, WALK_CHARS = 20_000, 8_000_000
#: Tasks of a walk for each core.
PER_CORE = 4


def _said(token: str) -> str:
    """The text that a quoted token stands for."""
    return json.loads(token) if "\\" in token else token[1:-1]


def _places(text: str) -> list[list]:
    """``[parent, key, position, start, end]`` of every value of a JSON text, each before what is below it; ``text[start:end]`` is the value."""
    out, above, key, last = [], [], None, None
    for m in TOKEN.finditer(text):
        token, start = m[0], m.start()
        if token == ":":
            key = _said(last)
            out.pop()
            above[-1][1] -= 1
        elif token in ("}", "]"):
            out[above.pop()[0]][4] = m.end()
        elif token != ",":
            parent, position = above[-1] if above else (-1, 0)
            if above:
                above[-1][1] += 1
            # until its colon a key looks like a value
            out.append([parent, key, position, start, m.end()])
            key, last = None, token
            if token in ("{", "["):
                above.append([len(out) - 1, 0])
    return out


def _walk(df: DataFrame, doc: str, made: Callable[[str], Iterator[tuple]], ddl: str) -> DataFrame:
    """The other columns of ``df`` with each row that ``made`` gives for the JSON text of its document."""
    keep = [c for c in df.columns if c != doc]
    fields = StructType.fromDDL(ddl)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at, chars = [], [], 0

            def built():
                columns = [pa.array(c) for c in zip(*rows, strict=True)]
                return pa.RecordBatch.from_arrays([*batch.select(range(len(keep))).take(pa.array(at)).columns, *columns], [*keep, *fields.names])

            for i, text in enumerate(batch.column(len(keep)).to_pylist()):
                for row in made(text) if text is not None else ():
                    rows.append(row)
                    at.append(i)
                    chars += row[-1] and len(row[-1]) or 0
                    if len(rows) >= WALK_ROWS or chars >= WALK_CHARS:
                        yield _typed(built(), len(keep), types)
                        rows, at, chars = [], [], 0
            if rows:
                yield _typed(built(), len(keep), types)

    from pyspark.sql.pandas.types import to_arrow_schema

    types = to_arrow_schema(fields)
    schema = StructType([*df.select(*keep).schema.fields, *fields.fields])
    # a small file is one partition, and its documents are far dearer to walk than to move
    dealt = df.select(*keep, F.to_json(doc).alias("_text")).repartition(PER_CORE * df.sparkSession.sparkContext.defaultParallelism)
    return dealt.mapInArrow(walk, schema)


def _typed(batch: pa.RecordBatch, n: int, types: pa.Schema) -> pa.RecordBatch:
    """The batch with the columns from the n-th on in their types."""
    columns = [c if i < n else c.cast(types.field(i - n).type) for i, c in enumerate(batch.columns)]
    return pa.RecordBatch.from_arrays(columns, batch.schema.names)


def _nodes(text: str, keys: set[str] | None = None) -> Iterator[tuple]:
    """``path, key, depth, is_leaf, value`` of every value below the root of a JSON text, or of those under ``keys`` only."""
    places = _places(text)
    paths = ["$"]
    depths = [0]
    for parent, key, position, start, end in places[1:]:
        path = f"{paths[parent]}.{key}" if key is not None else f"{paths[parent]}[{position}]"
        paths.append(path)
        depths.append(depths[parent] + 1)
        if keys is None or key in keys:
            yield path, key, depths[-1], text[start] not in "{[" or end - start == 2, text[start:end]


def json_nodes(df: DataFrame, doc: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Every value below the root of a VARIANT document with its JSON path and key, or those under ``keys`` only.

    Each document is read once, as JSON text, whatever its depth; values that JSON has no
    form for, such as dates, are texts.
    """
    wanted = set(keys) if keys is not None else None
    rows = _walk(df, doc, lambda text: _nodes(text, wanted), "path string, key string, depth int, is_leaf boolean, value string")
    return rows.withColumn("value", F.parse_json("value")).select(*[c for c in df.columns if c != doc], "path", "key", "depth", "value", "is_leaf")


def identifier_only(df: DataFrame, doc: str, levels: int = LEVELS) -> DataFrame:
    """The rows of ``df`` without ``doc``, with ``identifier_only``: does the value hold nothing but identifiers?

    A list or an object does if all its members do, and a member under a key that names
    an identifier does by its key alone; so a value fails by one open scalar anywhere
    below it, and the walk leaves out what such keys cover.  Numbers and null are
    identifiers, truth values are not, a text is judged by its form.  ``doc`` is VARIANT;
    a null ``doc`` is the value null.  Rows must differ in their other columns.
    """
    open_members = lambda node: F.filter(
        F.map_entries(F.try_variant_get(node, "$", "map<string,variant>")), lambda e: ~is_id_kind(e["key"]))

    def below(node: Column) -> Column:
        return F.coalesce(
            F.transform(open_members(node), lambda e: e["value"]), F.try_variant_get(node, "$", "array<variant>"), F.array().cast("array<variant>"))

    keep = [c for c in df.columns if c != doc]
    top = F.when(F.col(doc).isNotNull(), F.array(doc)).otherwise(F.array().cast("array<variant>"))
    nodes = _unfold(df, keep, top, below, levels)
    kind = F.schema_of_variant(F.col("_n"))
    shown = (kind == "BOOLEAN") | ((kind == "STRING") & ~is_identifier_only(F.try_variant_get("_n", "$", "string")))
    bad = nodes.where(shown).select(*keep).distinct().withColumn("_shown", F.lit(True))
    same = reduce(Column.__and__, [df[c].eqNullSafe(bad[c]) for c in keep])
    return df.join(bad, same, "left").select(*[df[c] for c in keep], F.col("_shown").isNull().alias("identifier_only"))


def evidence_disguise(df: DataFrame, entity: str, column: str) -> DataFrame:
    """Evidence values, as JSON text of any depth, that are or hold nothing but identifiers; what is no JSON is a text."""
    text = F.coalesce(column, F.lit("null"))
    rows = df.select(F.col(entity).alias("entity_id"), F.coalesce(F.try_parse_json(text), F.try_parse_json(F.to_json(F.array(text)))).alias("doc"), F.try_parse_json(text).isNull().alias("bare"))
    doc = F.when(F.col("bare"), F.try_variant_get("doc", "$[0]", "variant")).otherwise(F.col("doc"))
    rows = rows.select("entity_id", doc.alias("doc"))
    said = F.when(F.schema_of_variant("doc") == "STRING", F.try_variant_get("doc", "$", "string"))
    spoofed = rows.where(is_id_disguise(said))
    only = identifier_only(rows, "doc").where("identifier_only")
    return violations(spoofed, "entity_id", f"{column}_id_disguise").union(violations(only, "entity_id", f"{column}_identifier_only"))


def collect_named_values(df: DataFrame, doc: str, keys: list[str]) -> DataFrame:
    """All values under any of the keys at any depth, inside matched values too."""
    return json_nodes(df, doc, keys)


def key_paths(df: DataFrame, doc: str, key: str) -> DataFrame:
    return json_nodes(df, doc, [key])


def _number(text: str) -> tuple[str]:
    """A number as it is written, unlike any text."""
    return (text,)


def _read(text: str):
    """A JSON document with its numbers as written; None if its nesting is too deep for the parser, or a text in it has another form there."""
    if "\\u" in text:
        return None
    try:
        return json.loads(text, parse_int=_number, parse_float=_number, parse_constant=_number)
    except RecursionError:
        return None


PLAIN = {None: "null", True: "true", False: "false"}


def _written(value) -> str:
    """A plain value or an empty list or object as JSON text."""
    kind = type(value)
    return json.encoder.encode_basestring(value) if kind is str else value[0] if kind is tuple else "{}" if kind is dict else "[]" if kind is list else PLAIN[value]


def _leaves(value, path: str, out: dict[str, str]) -> None:
    """The leaves of a document by their paths; of those that are written alike the greatest."""
    open_ = [(path, value)]
    while open_:
        path, value = open_.pop()
        if value and type(value) is dict:
            open_ += [(f"{path}.{k}", v) for k, v in value.items()]
        elif value and type(value) is list:
            open_ += [(f"{path}[{i}]", v) for i, v in enumerate(value)]
        elif path != "$":
            said = _written(value)
            out[path] = max(out[path], said) if path in out else said


def _text_leaves(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    value = _read(text)
    if value is not None:
        _leaves(value, "$", out)
        return out
    for path, _, _, leaf, said in _nodes(text):
        if leaf:
            out[path] = max(out.get(path, said), said)
    return out


# A key that holds a mark of paths, so that two paths may be written alike.
MARKED_KEY = re.compile(r'[.\[][^"]*":')


def _different(before: str, after: str) -> tuple[dict[str, str], dict[str, str]]:
    """Leaves of two documents, without those of parts that are the same in both."""
    b, a = _read(before), _read(after)
    if b is None or a is None or "\\" in before or "\\" in after or MARKED_KEY.search(before) or MARKED_KEY.search(after):
        return _text_leaves(before), _text_leaves(after)
    out: tuple[dict, dict] = ({}, {})
    open_ = [("$", b, a)]
    while open_:
        path, b, a = open_.pop()
        if b == a:
            continue
        if b and a and type(b) is type(a) is dict:
            for k, v in b.items():
                if k in a:
                    open_.append((f"{path}.{k}", v, a[k]))
                else:
                    _leaves(v, f"{path}.{k}", out[0])
            for k in a.keys() - b.keys():
                _leaves(a[k], f"{path}.{k}", out[1])
        elif b and a and type(b) is type(a) is list:
            open_ += [(f"{path}[{i}]", *pair) for i, pair in enumerate(zip(b, a, strict=False))]
            for i in range(len(a), len(b)):
                _leaves(b[i], f"{path}[{i}]", out[0])
            for i in range(len(b), len(a)):
                _leaves(a[i], f"{path}[{i}]", out[1])
        else:
            _leaves(b, path, out[0])
            _leaves(a, path, out[1])
    return out


class Versions:
    """The documents of one key, before and after: one text a side as it came, more of them as what was read and ``joined``."""

    def __init__(self, read: Callable[[str], dict], joined: Callable):
        self.read, self.joined, self.texts, self.found = read, joined, [None, None], [None, None]

    def add(self, side: int, text: str | None) -> None:
        if text is None:
            return
        if self.texts[side] is None and self.found[side] is None:
            self.texts[side] = text
            return
        found = self.of(side)
        for k, v in self.read(text).items():
            found[k] = self.joined(found[k], v) if k in found else v
        self.texts[side], self.found[side] = None, found

    def of(self, side: int) -> dict:
        if self.found[side] is not None:
            return self.found[side]
        return self.read(self.texts[side]) if self.texts[side] is not None else {}


def _met(before: DataFrame, after: DataFrame, keys: Sequence[str], doc: str, begin: Callable[[], Versions], made: Callable[[Versions], Iterator[tuple]], ddl: str) -> DataFrame:
    """The keys with each row that ``made`` gives for the documents of a key: they meet as texts, sorted by key, and are walked there."""
    keys, fields = list(keys), StructType.fromDDL(ddl)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, met, rows, chars = None, None, [], 0
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *now, side, text in zip(*columns, strict=True):
                if met is None or now != key and not all(a == b or a != a and b != b for a, b in zip(key, now, strict=True)):
                    if met is not None:
                        rows += [(*key, *row) for row in made(met)]
                    key, met = now, begin()
                met.add(side, text)
                chars += len(text or "")
                if len(rows) >= WALK_ROWS or rows and chars >= WALK_CHARS:
                    yield built(rows)
                    rows, chars = [], 0
        if met is not None:
            rows += [(*key, *row) for row in made(met)]
        if rows:
            yield built(rows)

    def built(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), types, strict=True)], schema=types)

    from pyspark.sql.pandas.types import to_arrow_schema

    sides = [df.select(*keys, F.lit(i).alias("_side"), F.to_json(doc).alias("_text")) for i, df in enumerate((before, after))]
    met = sides[0].union(sides[1])
    schema = StructType([*met.select(*keys).schema.fields, *fields.fields])
    types = to_arrow_schema(schema)
    dealt = met.repartition(PER_CORE * before.sparkSession.sparkContext.defaultParallelism, *keys)
    return dealt.sortWithinPartitions(*keys).mapInArrow(walk, schema)


def structural_diff(before: DataFrame, after: DataFrame, keys: list[str], doc: str = "doc") -> DataFrame:
    """Changed leaf paths between two versions of each document.

    The two texts of a key meet and only leaves that differ leave the task.  Of several
    documents of one key on a side the greatest value of a path counts.
    """
    def made(met: Versions) -> Iterator[tuple]:
        b, a = met.texts
        if b is not None and b == a:
            return
        was, now = _different(b, a) if b is not None and a is not None else (met.of(0), met.of(1))
        for path in was.keys() | now.keys():
            if was.get(path) != now.get(path):
                yield path, was.get(path), now.get(path)

    rows = _met(before, after, keys, doc, lambda: Versions(_text_leaves, max), made, "path string, before string, after string")
    change = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").otherwise("changed")
    return rows.withColumn("change", change)


def identified_nodes(df: DataFrame, doc: str, ids: Sequence[str]) -> DataFrame:
    """Objects of a VARIANT document that carry an identity, with the identity of the nearest one above.

    ``kind`` is the first of the fields ``ids`` that holds a text or a number, ``id`` its
    text; ``at`` is the place in document order.
    """
    ids = list(ids)

    def made(text: str) -> Iterator[tuple]:
        places = _places(text)
        named: dict[int, dict] = {}
        for parent, key, _, start, end in places:
            if key in ids and text[start] not in "{[" and text[start:end] not in ("null", "true", "false"):
                named.setdefault(parent, {})[key] = _said(text[start:end]) if text[start] == '"' else text[start:end]
        own = {p: next({"kind": k, "id": found[k]} for k in ids if k in found) for p, found in named.items()}
        at, owner = [], []
        for n, (parent, _, position, start, end) in enumerate(places):
            at.append([*at[parent], position] if parent >= 0 else [])
            owner.append((own.get(parent) or owner[parent]) if parent >= 0 else None)
            if n in own:
                yield own[n]["kind"], own[n]["id"], owner[n], at[n], text[start:end]

    rows = _walk(df, doc, made, "kind string, id string, owner struct<kind:string,id:string>, at array<int>, node string")
    return rows.withColumn("node", F.parse_json("node"))


def _identities(text: str, ids: Sequence[str]) -> dict[tuple, tuple]:
    """``(kind, id)`` of the objects with an identity: how many there are, and place, identity above and own plain fields of the last one."""
    value, out = _read(text), {}
    if value is None:
        value = _deep(text)
    if type(value) is not dict and type(value) is not list:
        return out
    open_ = [(value, [], None)]
    for value, at, owner in open_:
        members = value
        if type(value) is dict:
            members = value.values()
            for kind in ids:
                said = value.get(kind)
                if type(said) is str or type(said) is tuple:
                    own = kind, said if type(said) is str else said[0]
                    seen = (1, at, owner, {k: v for k, v in value.items() if type(v) is not dict and type(v) is not list})
                    out[own] = _last(out[own], seen) if own in out else seen
                    owner = own
                    break
        i = 0
        for v in members:
            if type(v) is dict or type(v) is list:
                open_.append((v, [*at, i], owner))
            i += 1
    return out


def _last(one: tuple, other: tuple) -> tuple:
    return one[0] + other[0], *max(one, other, key=lambda x: x[1])[1:]


def _deep(text: str):
    """As ``_read``, for a document of any depth."""
    built: list = []
    for parent, key, _, start, end in _places(text):
        c = text[start]
        value = {} if c == "{" else [] if c == "[" else _said(text[start:end]) if c == '"' else {"null": None, "true": True, "false": False}.get(text[start:end], (text[start:end],))
        built.append(value)
        if parent >= 0:
            if key is None:
                built[parent].append(value)
            else:
                built[parent][key] = value
    return built[0]


def identity_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], ids: Sequence[str], doc: str = "doc") -> DataFrame:
    """What became of each identified node between two versions of a document.

    ``change`` is ``lost`` or ``new``, ``repeated`` if a version has the identity more
    than once, ``moved`` if it stands under another identity or in another order among
    those that stayed under the same one, else ``kept``.  ``fields`` are the own fields
    with a plain value that differ.  A path plays no part, so a node that only has other
    nodes before it now is kept.  The two texts of a key meet and are compared in one task.
    """
    ids = list(ids)

    def made(met: Versions) -> Iterator[tuple]:
        b, a = met.of(0), met.of(1)
        stays: dict = {}
        for own in b.keys() & a.keys():
            if b[own][0] == a[own][0] == 1 and b[own][2] == a[own][2]:
                stays.setdefault(b[own][2], []).append(own)
        kept = set()
        for group in stays.values():
            group.sort(key=lambda own: b[own][1])
            kept.update(own for own, other in zip(group, sorted(group, key=lambda own: a[own][1]), strict=True) if own == other)
        for own in b.keys() | a.keys():
            was, now = b.get(own), a.get(own)
            if was is None or now is None:
                yield *own, "new" if was is None else "lost", None
            else:
                change = "repeated" if was[0] > 1 or now[0] > 1 else "kept" if own in kept else "moved"
                fields = sorted(k for k in was[3].keys() | now[3].keys() if was[3].get(k, ()) != now[3].get(k, ())) if was[3] != now[3] else []
                yield *own, change, fields

    begin = lambda: Versions(lambda text: _identities(text, ids), _last)
    return _met(before, after, keys, doc, begin, made, "kind string, id string, change string, fields array<string>")


def identity_losses(diff: DataFrame, entity: str) -> DataFrame:
    """Violations of identities that did not survive: lost, or no longer unique."""
    what = F.concat_ws(":", "kind", "id")
    return violations(diff.where("change = 'lost'"), entity, "identity_lost", what).union(
        violations(diff.where("change = 'repeated'"), entity, "identity_repeated", what))
