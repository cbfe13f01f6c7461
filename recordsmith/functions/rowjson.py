"""Documents given as text: read and rated row by row in Arrow batches, by Python's own ``json``.

The functions of ``jsonparse`` and ``scoring`` on VARIANT columns walk a document with nested
SQL lambdas, which costs close to a millisecond a row. Where a document is a text column, these
functions do the same in one pass over it. Each is a column of its own, so a query pays only
for what it selects; rows, joins and aggregates stay Spark's.
"""

from __future__ import annotations

import functools
import json
import math
import re
import sys
from collections.abc import Iterator
from json.encoder import encode_basestring

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from recordsmith.ship import ship_package, shipped

sys.set_int_max_str_digits(0)       # integers of any length, as in the VARIANT functions

#: No value: a text that is no JSON, or the JSON ``null`` of a raw output.
ABSENT = object()

_KINDS = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}

_CONTROL = re.compile(r"\\(?:u00[01][0-9a-f]|.)", re.S)


def _no_number(name: str):
    raise ValueError(f"{name} is no JSON")


_DECODER = json.JSONDecoder(parse_constant=_no_number)
_SCAN = _DECODER.scan_once
_BLANKS = " \t\r\n"
_ENVELOPE = {"can_extract", "refusal_reason", "record"}
_ENCODER = json.JSONEncoder(ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def _utf8(s: str) -> str:
    """Half surrogate pairs, which no UTF-8 text can hold, as question marks."""
    try:
        s.isascii() or s.encode()
    except UnicodeEncodeError:
        return s.encode("utf-8", "replace").decode()
    return s


def _written(s: str) -> str:
    """A JSON text as Spark writes it: hexadecimal digits of control characters in capitals."""
    if "\\u" in s:
        s = _CONTROL.sub(lambda m: m[0][:2] + m[0][2:].upper() if m[0][1] == "u" else m[0], s)
    return _utf8(s)


def _scan(text: str):
    """The JSON value at the start of a text and where it ends; ABSENT and -1 if there is none."""
    try:
        return _SCAN(text, 0)
    except (StopIteration, ValueError, RecursionError):
        return ABSENT, -1


def parse(text: str | None):
    """The value of a text that is one JSON value and not ``null``, else ABSENT."""
    if text is None:
        return ABSENT
    text = text.strip(_BLANKS)
    value, end = _scan(text)
    return ABSENT if value is None or end != len(text) else value


def parse_block(raw: str | None):
    """Strip; the whole text; else the first ``{`` to the last ``}``."""
    if raw is None:
        return ABSENT
    raw = raw.strip()
    value, end = _scan(raw)
    if end == len(raw):
        return ABSENT if value is None else value
    first, last = raw.find("{"), raw.rfind("}")
    if not 0 <= first < last:
        return ABSENT
    # What stands before trailing text has been read already.
    return value if first == 0 and end == last + 1 else parse(raw[first:last + 1])


def parse_target(text: str | None):
    """A target's value, ``null`` included; ABSENT for a null text, an error for no JSON."""
    if text is None:
        return ABSENT
    value = parse(text)
    return _DECODER.raw_decode(text.lstrip(" \t\r\n"))[0] if value is ABSENT else value


READERS = {"block": parse_block, "strict": parse, "target": parse_target}


def canonical(value) -> str | None:
    return None if value is ABSENT else _written(_ENCODER.encode(value))


def literal(x) -> str:
    """``json.dumps`` of a scalar."""
    if type(x) is str:
        return _written(encode_basestring(x))
    if x is None or type(x) is bool:
        return "null" if x is None else "true" if x else "false"
    return _ENCODER.encode(x) if type(x) is float else str(x)


def leaves(value) -> list[tuple[str, str]]:
    """(path, literal) of every leaf; repeated paths stay."""
    if type(value) not in (dict, list):
        return [("", literal(value))]
    found, todo = [], [("", value)]
    for path, x in todo:                            # grows by the containers inside
        if type(x) is dict:
            members = [(f"{path}.{k}", y) for k, y in x.items()] if path else x.items()
        else:
            members = [(f"{path}[{i}]", y) for i, y in enumerate(x)]
        for p, y in members:
            kind_of = type(y)
            if kind_of is str:
                found.append((p, encode_basestring(y)))
            elif kind_of is int:
                found.append((p, int.__repr__(y)))
            elif kind_of is dict or kind_of is list:
                todo.append((p, y))
            else:
                found.append((p, literal(y)))
    whole = "".join([p + x for p, x in found])
    if whole.isascii() and "\\u" not in whole:
        return found
    return [(_utf8(p), _written(x)) for p, x in found]


def items(value) -> dict[str, str]:
    """The leaves by path, the smallest literal of a path that comes twice."""
    return _items(value)[0]


def _items(value) -> tuple[dict[str, str], bool]:
    """``items``, and whether no path comes twice."""
    found = leaves(value) if value is not ABSENT else []
    by_path = dict(found)
    single = len(by_path) == len(found)
    if not single:
        by_path = {}
        for path, x in found:
            by_path[path] = min(x, by_path.get(path, x))
    return by_path, single


_HALF = re.compile(r"\\u[dD][89a-fA-F]")


def leaf_count(text: str, value) -> int:
    """How many leaves the value of a text has, or -1 where paths or literals may fall together:
    for a key that is empty or holds ``.`` or ``[``, and for escaped half surrogate pairs."""
    if value is ABSENT:
        return 0
    if "\\u" in text and _HALF.search(text):
        return -1
    if type(value) not in (dict, list):
        return 1
    count, todo = 0, [value]
    for x in todo:                                  # grows by the containers inside
        if type(x) is dict:
            names = "".join(x)
            if "." in names or "[" in names or "" in x:
                return -1
            x = x.values()
        count += len(x)
        for y in x:
            if type(y) is dict or type(y) is list:
                count -= 1
                todo.append(y)
    return count


def common_leaves(a, b) -> int:
    """How many leaves two values share, path and literal, where ``leaf_count`` knows both."""
    if type(a) is not type(b) or a is ABSENT:
        return 0
    if type(a) not in (dict, list):
        return int(literal(a) == literal(b))
    count, todo = 0, [(a, b)]
    for x, y in todo:                               # grows by the containers of one kind at one path
        pairs = [(p, y[k]) for k, p in x.items() if k in y] if type(x) is dict else zip(x, y)
        for p, q in pairs:
            of = type(p)
            if of is type(q):
                if of is dict or of is list:
                    todo.append((p, q))
                elif p == q and (of is not float or p or repr(p) == repr(q)):
                    count += 1
    return count


def kind(x) -> str | None:
    if x is ABSENT:
        return None
    return _KINDS.get(type(x), "number")


def _double(x) -> float:
    try:
        return float(x)
    except OverflowError:
        return math.inf if x > 0 else -math.inf


def py_equal(a, b) -> bool:
    """``sqltext.py_equal``: Python's ``==``, a missing value as None."""
    if type(a) is bool and type(b) is bool:
        return a is b
    a, b = (None if x is ABSENT else x for x in (a, b))
    if a is None or b is None:
        return a is None and b is None
    ka, kb = kind(a), kind(b)
    if ka in ("number", "boolean") and kb in ("number", "boolean"):
        return _double(a) == _double(b)
    if ka != kb:
        return False
    return a == b if ka == "string" else canonical(a) == canonical(b)


def member(x, key: str):
    return x.get(key, ABSENT) if type(x) is dict else ABSENT


def populated(value) -> int:
    """Members of the record that are not null and not empty."""
    record = member(value, "record")
    return sum(1 for x in record.values() if x is not None and x not in ("", [], {})) if type(record) is dict else 0


def conforms(value, fields: dict[str, str]) -> bool:
    """C21, as ``scoring.schema_conformance``."""
    if type(value) is not dict or value.keys() != _ENVELOPE:
        return False
    record = value["record"]
    if type(value["can_extract"]) is not bool or kind(value["refusal_reason"]) not in ("string", "null"):
        return False
    if record is None:
        return True
    return type(record) is dict and record.keys() == fields.keys() and all(
        type(record[k]) is int if want == "integer" else kind(record[k]) == want for k, want in fields.items())


def nodes(value) -> list[tuple]:
    """(path, pattern, parent, kind) of all nodes, as ``sqltext.flatten_nodes``."""
    found, todo = [], [("", "", None, value)]
    while todo:
        path, pattern, parent, x = todo.pop()
        found.append((_utf8(path), _utf8(pattern), None if parent is None else _utf8(parent), "integer" if type(x) is int else kind(x)))
        if type(x) is dict:
            todo += [(f"{path}.{k}" if path else k, f"{pattern}.{k}" if pattern else k, path, y) for k, y in x.items()]
        elif type(x) is list:
            todo += [(f"{path}[{i}]", pattern + "[]", path, y) for i, y in enumerate(x)]
    return found


def places(value, rules: dict[str, list[tuple[list[str], int | None]]]) -> list[tuple]:
    """(path, n_unknown, n_kind, want, has, parsed) of the places of a document that matter to a
    schema, one row a path: nodes with a fault, objects that must have members, and the root.
    ``rules`` holds (kinds, members) by pattern; ``parsed`` is set on the root alone."""
    if value is ABSENT:
        return [(None, 0, 0, 0, 0, False)]
    found: dict[str, list] = {}
    for path, pattern, parent, of in nodes(value):
        root = parent is None
        for kinds, members in rules.get(pattern, ((None, None),)):
            known = kinds is not None
            wrong = known and of not in kinds
            want = members if known and of == "object" and members is not None else 0
            if not known or wrong or want or root:
                at = found.setdefault(path, [0, 0, 0, 0, None])
                at[0] += not known
                at[1] += wrong
                at[2] += want
                at[4] = True if root else at[4]
            if known and not root and not pattern.endswith("[]"):
                found.setdefault(parent, [0, 0, 0, 0, None])[3] += 1
    return [(path, *at) for path, at in found.items()]


def verdict(value) -> tuple[int | None, int | None, str | None]:
    """The indexes, null unless they are whole numbers of 32 bits, and the reason, a string
    as it is and other values as canonical text."""
    def index(key: str):
        x = member(value, key)
        return x if type(x) is int and -2 ** 31 <= x < 2 ** 31 else None
    reason = member(value, "reason")
    return index("chosen_index"), index("rejected_index"), _utf8(reason) if type(reason) is str else canonical(reason)


_TOKEN = re.compile(r'"(?:[^"\\]++|\\.)*+"|[\[{]\s*[\]}]|[\[\]{},:]|[^\[\]{},:"\s]++', re.A)


def indented(text: str, indent: int) -> str:
    """A JSON text with its tokens on lines of their own; empty containers stay on one."""
    out, line = [], "\n"
    for token in _TOKEN.findall(text):
        if token in ("{", "["):
            line += " " * indent
            out.append(token + line)
        elif token in ("}", "]"):
            line = line[:len(line) - indent]
            out.append(line + token)
        elif token == ",":
            out.append("," + line)
        elif token == ":":
            out.append(": ")
        else:
            out.append(token[0] + token[-1] if token[0] in "[{" else token)
    return "".join(out)


# ------------------------------------------------------------- columns


def _lists(rows: list, fields: list[tuple[str, pa.DataType]]) -> pa.Array:
    """Lists of tuples, a null for None, as one array of lists of structs."""
    offsets, flat = [], []
    for row in rows:
        offsets.append(None if row is None else len(flat))
        flat.extend(row or ())
    return pa.ListArray.from_arrays(pa.array([*offsets, len(flat)], pa.int32()), _struct(flat, fields))


def _struct(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.Array:
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


_DOCUMENT = [("canonical", pa.string()), ("kind", pa.string()), ("refused", pa.bool_()), ("populated", pa.int32())]
_SCORES = [("json_valid", pa.bool_()), ("exact_match", pa.bool_()), ("n_pred", pa.int32()), ("n_target", pa.int32()),
           ("n_common", pa.int32()), ("refusal_correct", pa.bool_()), ("schema_ok", pa.bool_())]
_LEAF = [("path", pa.string()), ("literal", pa.string())]
_PATH = [("path", pa.string()), ("p", pa.string()), ("t", pa.string()), ("valid", pa.bool_())]
_PLACE = [("path", pa.string()), *((n, pa.int32()) for n in ("n_unknown", "n_kind", "want", "has")), ("parsed", pa.bool_())]
_VERDICT = [("chosen_index", pa.int32()), ("rejected_index", pa.int32()), ("reason", pa.string())]


def _documents(reader: str, texts: pa.Array) -> pa.Array:
    values = map(READERS[reader], texts.to_pylist())
    return _struct([(canonical(v), kind(v), member(v, "can_extract") is False, populated(v)) for v in values], _DOCUMENT)


def _leaf_lists(reader: str, unique: bool, texts: pa.Array) -> pa.Array:
    def of(v):
        return None if v is ABSENT else list(items(v).items()) if unique else leaves(v)
    return _lists([of(READERS[reader](t)) for t in texts.to_pylist()], _LEAF)


def _path_lists(raws: pa.Array, targets: pa.Array) -> pa.Array:
    offsets, paths, ps, ts, valid = [0], [], [], [], []
    for raw, text in zip(raws.to_pylist(), targets.to_pylist()):
        value = parse_block(raw)
        given, wanted = items(value), items(parse_target(text))
        missed = [p for p in wanted if p not in given] if not wanted.keys() <= given.keys() else []
        paths += (None, *given, *missed)
        ps += (None, *given.values(), *[None] * len(missed))
        ts += (None, *map(wanted.get, given), *map(wanted.get, missed))
        valid.append(value is not ABSENT)
        valid += [None] * (len(paths) - len(valid))
        offsets.append(len(paths))
    columns = [pa.array(c, t) for c, (_, t) in zip((paths, ps, ts, valid), _PATH)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, [n for n, _ in _PATH]))


def _place_lists(rules: dict, reader: str, texts: pa.Array) -> pa.Array:
    return _lists([places(READERS[reader](t), rules) for t in texts.to_pylist()], _PLACE)


def _verdicts(texts: pa.Array) -> pa.Array:
    return _struct([verdict(parse(t)) for t in texts.to_pylist()], _VERDICT)


def _indented(indent: int, texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else indented(t, indent) for t in texts.to_pylist()], pa.string())


def _conforming(reader: str, fields: dict[str, str], texts: pa.Array) -> pa.Array:
    return pa.array([conforms(READERS[reader](t), fields) for t in texts.to_pylist()], pa.bool_())


def _compared(value, target) -> tuple[int, int, int, bool, bool]:
    """Leaves of either value and of both, whether all are equal, and whether no path comes twice."""
    given, once = _items(value)
    wanted, single = _items(target)
    exact = given == wanted
    common = len(given) if exact else sum([wanted.get(p) == x for p, x in given.items()])
    return len(given), len(wanted), common, exact, once and single


def _scored(fields: dict[str, str] | None, raws: pa.Array, targets: pa.Array) -> pa.Array:
    rows, last, target, wanted = [], None, ABSENT, 0
    for raw, text in zip(raws.to_pylist(), targets.to_pylist()):
        if text != last:            # the candidates of an example share its target
            target, last = parse_target(text), text
            wanted = leaf_count(text, target)
        value = parse_block(raw)
        given = leaf_count(raw, value)
        if given < 0 or wanted < 0:
            n_pred, n_target, common, exact, once = _compared(value, target)
        else:
            common = common_leaves(value, target)
            n_pred, n_target, exact, once = given, wanted, common == given == wanted, True
        if exact and not (once and value == target):     # equal leaves of equal values: equal texts
            exact = canonical(value) == canonical(target)
        refusal = type(value) is dict and py_equal(member(value, "can_extract"), member(target, "can_extract"))
        rows.append((value is not ABSENT, exact, n_pred, n_target, common, refusal, fields is not None and conforms(value, fields)))
    return _struct(rows, _SCORES)


def _ddl(fields: list[tuple[str, pa.DataType]]) -> str:
    named = {pa.string(): "string", pa.bool_(): "boolean", pa.int32(): "int"}
    return "struct<" + ", ".join(f"{n}: {named[t]}" for n, t in fields) + ">"


def _list_ddl(fields: list[tuple[str, pa.DataType]]) -> str:
    return f"array<{_ddl(fields)}>"


def _call(work, returns: str, *texts: str | Column) -> Column:
    """``work`` over Arrow batches of the text columns."""
    ship_package(SparkSession.active())
    if len(texts) == 1:
        def run(a: pa.Array) -> pa.Array:
            return work(a)
    else:
        def run(a: pa.Array, b: pa.Array) -> pa.Array:
            return work(a, b)
    return F.arrow_udf(run, returns)(*texts)


def document(text: str | Column, reader: str = "block") -> Column:
    """(canonical, kind, refused, populated): canonical text and kind (null where there is no
    value), whether ``can_extract`` is false, and how many members of the record are filled."""
    return _call(functools.partial(_documents, reader), _ddl(_DOCUMENT), text)


def leaf_list(text: str | Column, reader: str = "block", unique: bool = False) -> Column:
    """``jsonparse.flatten_leaves`` of a text; ``unique`` as in ``scoring.item_set``."""
    return _call(functools.partial(_leaf_lists, reader, unique), _list_ddl(_LEAF), text)


def path_list(raw: str | Column, target: str | Column) -> Column:
    """(path, p, t, valid) of every path of a raw output (literal p) or its target (t), and one
    row without a path that says whether the output is valid."""
    return _call(_path_lists, _list_ddl(_PATH), raw, target)


def place_list(text: str | Column, rules: dict[str, list[tuple[list[str], int | None]]], reader: str = "block") -> Column:
    """``places`` of a text."""
    return _call(functools.partial(_place_lists, rules, reader), _list_ddl(_PLACE), text)


def with_verdicts(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with (chosen_index, rejected_index, reason) of a verdict's JSON text in its place.
    As a table function: what filters on them cannot have them made a second time."""
    rest = df.select(*[c for c in df.columns if c != text_col], text_col)
    schema = StructType.fromDDL(", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields[:-1]), _ddl(_VERDICT)[7:-1]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = [*b.columns[:-1], *_verdicts(b.columns[-1]).flatten()]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
    return shipped(rest).mapInArrow(run, schema)


def indent_text(text: str | Column, indent: int = 2) -> Column:
    """The JSON text, indented."""
    return _call(functools.partial(_indented, indent), "string", text)


def conformance(text: str | Column, fields: dict[str, str], reader: str = "block") -> Column:
    """``scoring.schema_conformance`` of a text."""
    return _call(functools.partial(_conforming, reader, fields), "boolean", text)


def scores(raw: str | Column, target: str | Column, fields: dict[str, str] | None = None) -> Column:
    """(json_valid, exact_match, n_pred, n_target, n_common, refusal_correct, schema_ok) of a raw
    output against its target's text."""
    return _call(functools.partial(_scored, fields), _ddl(_SCORES), raw, target)
