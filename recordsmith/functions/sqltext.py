"""SQL-text forms of the JSON expressions, for ``F.expr``.

The same expressions as ``jsonparse`` but written as Spark SQL text: one
py4j call builds the whole tree on the JVM side instead of one call per
node, which matters for the long flatten and canonical expressions.
Inputs are SQL expressions (usually a quoted column name).
"""

from __future__ import annotations

import itertools

MAP_T = "map<string,variant>"
ARR_T = "array<variant>"


def lit(text: str) -> str:
    """A Spark SQL string literal (backslash escapes are processed by the parser)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def py_strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(r'(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z')}, '')"


def brace_span(x: str) -> str:
    return f"regexp_extract({x}, {lit(r'(?s)\{.*\}')}, 0)"


_names = itertools.count()


def let(expr: str, body) -> str:
    """Evaluate ``expr`` once and use it several times in ``body``.

    SQL text has no variables; binding through a one-element ``transform``
    keeps an expensive value (a parse, a regex) from being recomputed at every
    place it is referenced.
    """
    name = f"_v{next(_names)}"
    return f"element_at(transform(array({expr}), {name} -> {body(name)}), 1)"


# Texts with a number that VARIANT holds in another kind than Python does: exponents, long
# integers and fractions, negative zeros, small fractions; and the mark of kept literals.
_UNUSUAL = r"[0-9][eE]|[0-9.]{17,}|-0|0\.0000|\\u0001"
_JSON_TOKEN = r'"(?:[^"\\]++|\\.)*+"|[0-9-][0-9.eE+-]*+|[^"0-9-]++|"'
_INTEGER = r"^-?(0|[1-9][0-9]*)$"
_FRACTION = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
_HELD = r"^-?(0|[1-9][0-9]{0,15})\.[0-9]{1,20}$"
#: Begins a string that stands for a number's literal. Strings of the text that hold this
#: character get it twice, so the two cannot be mixed up.
NUMBER_MARK = "\x01n"
_MARK_JSON = r'"\u0001n'


def py_float(x: str, literal: str | None = None) -> str:
    """``repr`` of a double: shortest digits, an exponent below 1e-4 and from 1e16 on. Digits
    of the ``literal`` that the double was read from are taken where they are as short."""
    def digits(t: str) -> str:
        # Digits and place of the point of Java's text, such as 1.25E-7.
        point = f"(length(substring_index({t}.m, '.', 1)) + {t}.e)"
        raw = f"concat(substring_index({t}.m, '.', 1), substring_index({t}.m, '.', -1))"
        return let(f"named_struct('r', {raw}, 'p', {point})", lambda r: (
            f"named_struct('d', rtrim('0', ltrim('0', {r}.r)), "
            f"'p', {r}.p - (length({r}.r) - length(ltrim('0', {r}.r))))"))

    def shorter(v: str) -> str:
        # Java may print one digit too many: drop the last one if the value stays the same.
        def text(d: str) -> str:
            return f"concat('0.', {d}, 'e', {v}.p)"
        cut = f"left({v}.d, length({v}.d) - 1)"
        up = f"cast(cast({cut} AS decimal(20,0)) + 1 AS string)"
        fits = {cut: f"cast({text(cut)} AS double) = {v}.x",
                up: f"length({up}) = length({cut}) AND cast({text(up)} AS double) = {v}.x"}
        rest = " ".join(f"WHEN {more}{fits[d]} THEN named_struct('d', {d}, 'p', {v}.p, 'x', {v}.x)" for more, d in (
            (f"right({v}.d, 1) >= '5' AND ", up), ("", cut), ("", up)))        # the nearer one first
        return f"CASE WHEN length({v}.d) < 2 THEN {v} {rest} ELSE {v} END"

    def shown(v: str) -> str:
        n = f"length({v}.d)"
        exponent = (f"concat(left({v}.d, 1), CASE WHEN {n} > 1 THEN concat('.', substring({v}.d, 2)) ELSE '' END, "
                    f"CASE WHEN {v}.p > 0 THEN 'e+' ELSE 'e-' END, "
                    f"CASE WHEN abs({v}.p - 1) < 10 THEN '0' ELSE '' END, cast(abs({v}.p - 1) AS string))")
        return (f"CASE WHEN {v}.d = '' THEN '0.0' WHEN {v}.p < -3 OR {v}.p > 16 THEN {exponent} "
                f"WHEN {v}.p <= 0 THEN concat('0.', repeat('0', -{v}.p), {v}.d) "
                f"WHEN {v}.p >= {n} THEN concat({v}.d, repeat('0', {v}.p - {n}), '.0') "
                f"ELSE concat(left({v}.d, {v}.p), '.', substring({v}.d, {v}.p + 1)) END")

    def whole(a: str) -> str:
        java = f"cast(abs({a}) AS string)"
        parts = let(java, lambda j: (f"named_struct('m', substring_index({j}, 'E', 1), 'e', "
                                     f"CASE WHEN contains({j}, 'E') THEN cast(substring_index({j}, 'E', -1) AS int) ELSE 0 END)"))
        found = let(parts, lambda t: let(digits(t), lambda d: f"named_struct('d', {d}.d, 'p', {d}.p, 'x', abs({a}))"))
        best = let(found, lambda v: let(shorter(v), shorter))
        if literal:
            body = f"substring_index(lower(ltrim('-', {literal})), 'e', 1)"
            given = (f"named_struct('m', CASE WHEN contains({body}, '.') THEN {body} ELSE concat({body}, '.0') END, 'e', "
                     f"CASE WHEN contains(lower({literal}), 'e') THEN cast(substring_index(lower({literal}), 'e', -1) AS int) ELSE 0 END)")
            best = let(best, lambda w: let(let(given, digits), lambda g: (
                f"CASE WHEN length({g}.d) <= length({w}.d) THEN named_struct('d', {g}.d, 'p', {g}.p, 'x', {w}.x) ELSE {w} END")))
        text = let(best, shown)
        sign = f"CASE WHEN startswith(cast({a} AS string), '-') THEN '-' ELSE '' END"
        return f"CASE WHEN abs({a}) = double('Infinity') THEN concat({sign}, 'Infinity') ELSE concat({sign}, {text}) END"

    return let(x, whole)


def keep_numbers(t: str) -> str:
    """A JSON text whose numbers keep the kind and the literal that Python gives them: those
    that VARIANT holds are written plainly, the others as marked strings. Numbers that are
    no JSON stay as they are, so an invalid text stays invalid."""
    def number(k: str) -> str:
        literal = (f"CASE WHEN {k} RLIKE {lit(_INTEGER)} THEN CASE WHEN {k} = '-0' THEN '0' ELSE {k} END "
                   f"ELSE {py_float(f'cast({k} AS double)', k)} END")
        return let(literal, lambda n: (
            f"CASE WHEN {n} RLIKE {lit(_INTEGER)} AND length({n}) < 19 OR {n} RLIKE {lit(_HELD)} AND {n} <> '-0.0' THEN {n} "
            f"ELSE concat({lit(_MARK_JSON)}, {n}, '\"') END"))

    doubled = f"regexp_replace(k, {lit(r'(?<!\\)((?:\\\\)*)\\u0001')}, {lit(r'$1\\u0001\\u0001')})"
    return (f"array_join(transform(regexp_extract_all({t}, {lit(_JSON_TOKEN)}, 0), k -> CASE "
            f"WHEN startswith(k, '\"') THEN {doubled} WHEN k RLIKE {lit(_FRACTION)} THEN {number('k')} ELSE k END), '')")


def is_marked(x: str) -> str:
    """Does a VARIANT stand for a kept number literal?"""
    return f"coalesce(startswith(try_variant_get({x}, '$', 'string'), {lit(NUMBER_MARK)}), false)"


def _unmarked(text: str) -> str:
    """A string of the text as it was before ``keep_numbers``."""
    return f"replace({text}, '\x01\x01', '\x01')"


def strict_parse(t: str) -> str:
    def check(tv: str) -> str:
        # The marker is the text's own digest, which the text cannot contain.
        arr = f"try_cast(try_parse_json(concat('[', {tv}, ',\"', md5({tv}), '\"]')) AS {ARR_T})"
        return let(arr, lambda a: (
            f"CASE WHEN size({a}) = 2 AND try_variant_get({a}[1], '$', 'string') = md5({tv}) "
            f"AND NOT is_variant_null({a}[0]) THEN {a}[0] END"))
    kept = let(t, lambda tv: f"CASE WHEN {tv} RLIKE {lit(_UNUSUAL)} THEN {keep_numbers(tv)} ELSE {tv} END")
    return let(kept, check)


def parse_target(t: str) -> str:
    """A target's JSON text as VARIANT, numbers kept; fails on a text that is not JSON."""
    return let(t, lambda tv: f"CASE WHEN {tv} IS NOT NULL THEN coalesce({strict_parse(tv)}, parse_json({tv})) END")


def extract_json_block(raw: str) -> str:
    return let(py_strip(raw), lambda t: (
        f"coalesce(CASE WHEN length({t}) > 0 THEN {strict_parse(t)} END, {strict_parse(brace_span(t))})"))


def leaf_literal(x: str) -> str:
    """``json.dumps`` of a scalar VARIANT. Integral decimals (floats of the text) get their
    ``.0`` back, kept literals stand for themselves."""
    s, mark = f"schema_of_variant({x})", lit(_MARK_JSON)
    return let(f"to_json({x})", lambda j: (
        f"CASE WHEN startswith({s}, 'DECIMAL(') AND endswith({s}, ',0)') THEN concat({j}, '.0') "
        f"WHEN startswith({j}, {mark}) THEN substring({j}, {len(_MARK_JSON) + 1}, length({j}) - {len(_MARK_JSON) + 1}) "
        f"ELSE replace({j}, {lit(r'\u0001' * 2)}, {lit(r'\u0001')}) END"))


def json_string(x: str) -> str:
    return f"substring(to_json(array({x})), 2, length(to_json(array({x}))) - 2)"


def levels(v: str) -> str:
    """As many rounds as ``v`` nests levels, and one: the deepest running count of brackets
    outside strings."""
    quoted = lit(r'"(?:[^"\\]++|\\.)*+"|[^"\[\]{}]++')
    brackets = f"split(translate(regexp_replace(to_json({v}), {quoted}, ''), '{{}}', '[]'), '')"
    deepest = (f"aggregate({brackets}, named_struct('d', 0, 'm', 0), (s, c) -> CASE "
               f"WHEN c = '[' THEN named_struct('d', s.d + 1, 'm', greatest(s.m, s.d + 1)) "
               f"WHEN c = ']' THEN named_struct('d', s.d - 1, 'm', s.m) ELSE s END, s -> s.m)")
    return f"sequence(0, {deepest})"


def _typed(x: str) -> str:
    return f"'m', try_cast({x} AS {MAP_T}), 'a', try_cast({x} AS {ARR_T})"


def flatten_leaves(v: str) -> str:
    """Leaves as ``array<struct<path, literal>>``, at any depth.

    The state of the fold carries finished leaves (``done``) apart from containers still
    to expand (``todo``); a round with nothing left to expand costs almost nothing.
    """
    start = (f"named_struct('done', filter(array(named_struct('path', '', 'literal', '')), z -> false), "
             f"'todo', array(named_struct('path', '', 'v', {v})))")
    typed = f"transform(s.todo, e -> named_struct('path', e.path, 'v', e.v, {_typed('e.v')}))"
    expand = ("e -> CASE WHEN e.m IS NOT NULL THEN transform(map_entries(e.m), en -> named_struct("
              f"'path', CASE WHEN e.path = '' THEN {_unmarked('en.key')} ELSE concat(e.path, '.', {_unmarked('en.key')}) END, "
              "'v', en.value)) "
              "ELSE transform(e.a, (x, i) -> named_struct("
              "'path', concat(e.path, '[', cast(i AS string), ']'), 'v', x)) END")

    def split(t: str) -> str:
        return (f"named_struct('done', concat(s.done, transform(filter({t}, e -> e.m IS NULL AND e.a IS NULL), "
                f"e -> named_struct('path', e.path, 'literal', {leaf_literal('e.v')}))), "
                f"'todo', flatten(transform(filter({t}, e -> e.m IS NOT NULL OR e.a IS NOT NULL), {expand})))")

    fold = (f"aggregate({levels(v)}, {start}, (s, r) -> CASE WHEN size(s.todo) = 0 THEN s "
            f"ELSE {let(typed, split)} END, s -> s.done)")
    return f"CASE WHEN {v} IS NOT NULL THEN {fold} END"


def flatten_nodes(v: str) -> str:
    """All nodes, containers too, as ``array<struct<path, pattern, parent, kind>>``: the pattern
    is the path with ``[]`` for every index, the parent the path of the container around it
    (null for the root), the kind ``kind``'s, with integers told apart from other numbers."""
    start = (f"named_struct('done', filter(array(named_struct('path', '', 'pattern', '', 'parent', CAST(NULL AS string), 'kind', CAST(NULL AS string))), z -> false), "
             f"'todo', array(named_struct('path', '', 'pattern', '', 'parent', CAST(NULL AS string), 'v', {v})))")
    typed = f"transform(s.todo, e -> named_struct('path', e.path, 'pattern', e.pattern, 'parent', e.parent, 'v', e.v, {_typed('e.v')}))"
    key = _unmarked("en.key")
    expand = (f"e -> CASE WHEN e.m IS NOT NULL THEN transform(map_entries(e.m), en -> named_struct("
              f"'path', CASE WHEN e.path = '' THEN {key} ELSE concat(e.path, '.', {key}) END, "
              f"'pattern', CASE WHEN e.pattern = '' THEN {key} ELSE concat(e.pattern, '.', {key}) END, "
              f"'parent', e.path, 'v', en.value)) "
              f"ELSE transform(e.a, (x, i) -> named_struct('path', concat(e.path, '[', cast(i AS string), ']'), "
              f"'pattern', concat(e.pattern, '[]'), 'parent', e.path, 'v', x)) END")

    def split(t: str) -> str:
        kind_of = f"CASE WHEN {is_integer('e.v')} THEN 'integer' ELSE {kind('e.v')} END"
        return (f"named_struct('done', concat(s.done, transform({t}, e -> named_struct('path', e.path, 'pattern', e.pattern, "
                f"'parent', e.parent, 'kind', {kind_of}))), "
                f"'todo', flatten(transform(filter({t}, e -> e.m IS NOT NULL OR e.a IS NOT NULL), {expand})))")

    fold = (f"aggregate({levels(v)}, {start}, (s, r) -> CASE WHEN size(s.todo) = 0 THEN s "
            f"ELSE {let(typed, split)} END, s -> s.done)")
    return f"CASE WHEN {v} IS NOT NULL THEN {fold} END"


def ascii_escape(j: str) -> str:
    """A JSON text with every character outside printable ASCII as ``\\uXXXX`` in lower-case
    hex (two of them, a surrogate pair, beyond the basic plane), as Python's ``ensure_ascii``
    writes it."""
    # An escape is taken whole, so that an escaped backslash before a u is not read as one.
    token = lit(r"\\u[0-9A-Fa-f]{4}|\\.|[\x00-\x5B\x5D-\x7E]++|[^\x00-\x7E]")

    def unit(code: str) -> str:
        return f"concat({lit(chr(92) + 'u')}, lower(lpad(hex({code}), 4, '0')))"

    def escaped(c: str) -> str:
        return (f"CASE WHEN {c} < 65536 THEN {unit(c)} ELSE concat({unit(f'55296 + shiftright({c} - 65536, 10)')}, "
                f"{unit(f'56320 + (({c} - 65536) & 1023)')}) END")
    whole = (f", {token}, 0), k -> CASE "
             f"WHEN k RLIKE {lit(r'^\\u')} THEN concat('{chr(92)}{chr(92)}u', lower(substring(k, 3))) "
             f"WHEN k RLIKE {lit(r'^[^\x00-\x7E]')} THEN {let('ascii(k)', escaped)} ELSE k END), '')")
    return let(j, lambda t: f"CASE WHEN {t} RLIKE {lit(r'[^\x00-\x7E]|\\u')} "
                          f"THEN array_join(transform(regexp_extract_all({t}{whole} ELSE {t} END")


def canonical_json(v: str) -> str:
    """Sorted keys, no spaces, at any depth.

    The fold rewrites a list of pieces, each a text and perhaps a value that follows it,
    until no piece holds a value.
    """
    start = f"array(named_struct('t', '', 'v', {v}))"

    def body(e: str) -> str:
        pair = (f"transform(map_entries({e}.m), (en, i) -> named_struct('t', concat(CASE WHEN i = 0 "
                f"THEN concat({e}.t, '{{') ELSE ',' END, {json_string(_unmarked('en.key'))}, ':'), 'v', en.value))")
        item = (f"transform({e}.a, (x, i) -> named_struct('t', CASE WHEN i = 0 THEN concat({e}.t, '[') "
                f"ELSE ',' END, 'v', x))")

        def closed(entries: str, size: str, opening: str, closing: str) -> str:
            return (f"concat({entries}, array(named_struct('t', CASE WHEN {size} = 0 THEN concat({e}.t, '{opening}{closing}') "
                    f"ELSE '{closing}' END, 'v', CAST(NULL AS variant))))")

        return (f"CASE WHEN {e}.m IS NOT NULL THEN {closed(pair, f'size({e}.m)', '{', '}')} "
                f"WHEN {e}.a IS NOT NULL THEN {closed(item, f'size({e}.a)', '[', ']')} "
                f"ELSE array(named_struct('t', concat({e}.t, {leaf_literal(e + '.v')}), 'v', CAST(NULL AS variant))) END")

    expand = (f"p -> CASE WHEN p.v IS NULL THEN array(p) ELSE "
              f"{let('named_struct(' + chr(39) + 't' + chr(39) + ', p.t, ' + chr(39) + 'v' + chr(39) + ', p.v, ' + _typed('p.v') + ')', body)} END")
    fold = (f"aggregate({levels(v)}, {start}, (s, r) -> flatten(transform(s, {expand})), "
            f"s -> array_join(transform(s, p -> p.t), ''))")
    return f"CASE WHEN {v} IS NOT NULL THEN {fold} END"


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def kind(x: str) -> str:
    """'object' | 'array' | 'string' | 'number' | 'boolean' | 'null'; NULL for SQL NULL."""
    return let(f"schema_of_variant({x})", lambda s: (
        f"CASE WHEN {s} IS NULL THEN NULL WHEN startswith({s}, 'OBJECT') THEN 'object' "
        f"WHEN startswith({s}, 'ARRAY') THEN 'array' WHEN {s} = 'STRING' THEN "
        f"CASE WHEN {is_marked(x)} THEN 'number' ELSE 'string' END "
        f"WHEN {s} = 'BOOLEAN' THEN 'boolean' WHEN {s} = 'VOID' THEN 'null' ELSE 'number' END"))


def is_integer(x: str) -> str:
    """A JSON number without fraction or exponent, of any size."""
    return (f"(schema_of_variant({x}) IN ('BIGINT', 'INT', 'SMALLINT', 'TINYINT') "
            f"OR coalesce(try_variant_get({x}, '$', 'string') RLIKE '^\x01n-?[0-9]+$', false))")


def get_field(x: str, key: str) -> str:
    return f"try_variant_get({x}, {lit('$.' + key)}, 'variant')"


def py_equal(a: str, b: str) -> str:
    """Python ``==`` of two JSON values (SQL NULL = missing = None)."""
    def body(t: str) -> str:
        def none(side: str) -> str:
            return f"({t}.{side} IS NULL OR {t}.k{side} = 'null')"

        def num(side: str) -> str:
            return (f"CASE WHEN {t}.k{side} = 'boolean' THEN CAST(try_cast({t}.{side} AS boolean) AS double) "
                    f"WHEN {is_marked(f'{t}.{side}')} THEN cast(substring(try_cast({t}.{side} AS string), 3) AS double) "
                    f"ELSE try_cast({t}.{side} AS double) END")
        numeric = "('number', 'boolean')"
        return (f"CASE WHEN {none('a')} OR {none('b')} THEN {none('a')} AND {none('b')} "
                f"WHEN {t}.ka IN {numeric} AND {t}.kb IN {numeric} THEN {num('a')} = {num('b')} "
                f"WHEN {t}.ka = 'string' AND {t}.kb = 'string' THEN try_cast({t}.a AS string) = try_cast({t}.b AS string) "
                f"WHEN {t}.ka = {t}.kb AND {t}.ka IN ('object', 'array') "
                f"THEN {canonical_json(t + '.a')} = {canonical_json(t + '.b')} "
                f"ELSE false END")
    return let(f"named_struct('a', {a}, 'b', {b}, 'ka', {kind(a)}, 'kb', {kind(b)})", body)


def refusal_correct(p: str, t: str) -> str:
    return (f"CASE WHEN {p} IS NULL OR {kind(p)} <> 'object' THEN false "
            f"ELSE {py_equal(get_field(p, 'can_extract'), get_field(t, 'can_extract'))} END")


def schema_conformance(v: str, fields: dict[str, str]) -> str:
    env_keys = "array('can_extract', 'record', 'refusal_reason')"
    rec_keys = "array(" + ", ".join(lit(k) for k in sorted(fields)) + ")"

    def body(t: str) -> str:
        checks = []
        for key, want in fields.items():
            val = get_field(f"{t}.rec", key)
            if want == "integer":
                checks.append(is_integer(val))
            else:
                checks.append(f"{kind(val)} = {lit(want)}")
        rec_ok = (f"({kind(t + '.rec')} = 'null' OR ({kind(t + '.rec')} = 'object' AND "
                  f"array_sort(map_keys(try_cast({t}.rec AS {MAP_T}))) = {rec_keys} AND " + " AND ".join(checks) + "))")
        return (f"coalesce({t}.keys = {env_keys} AND {kind(t + '.can')} = 'boolean' "
                f"AND {kind(t + '.reason')} IN ('string', 'null') AND {rec_ok}, false)")
    return let(f"named_struct('keys', array_sort(map_keys(try_cast({v} AS {MAP_T}))), "
               f"'can', {get_field(v, 'can_extract')}, 'reason', {get_field(v, 'refusal_reason')}, "
               f"'rec', {get_field(v, 'record')})", body)


def confidence(p: str) -> str:
    populated = (f"coalesce(size(filter(map_values(try_cast({get_field(p, 'record')} AS {MAP_T})), "
                 f"y -> NOT (y IS NULL OR is_variant_null(y) OR to_json(y) IN ('\"\"', '[]', '{{}}')))), 0)")
    can = get_field(p, "can_extract")
    is_false = f"coalesce(schema_of_variant({can}) = 'BOOLEAN' AND NOT try_cast({can} AS boolean), false)"
    return (f"CASE WHEN {p} IS NULL THEN 0.0D WHEN {is_false} THEN 0.92D "
            f"ELSE round(least(0.99D, 0.45D + ({populated} / 9.0D) * 0.5D), 2) END")
