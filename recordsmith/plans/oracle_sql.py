"""DuckDB SQL that recomputes each registered query independently (the oracle).

The SQL is written against the driver's views (orders, customer, ...). Shared
pieces (the order corpus texts, the strict parse, leaf tables, the bounded
canonical form) are composed here as CTE text.
"""

from __future__ import annotations

from recordsmith.sources import corpus as C

# ---------------------------------------------------------------- corpus ---


def _js(expr: str) -> str:
    """JSON string literal of a VARCHAR expression, 'null' for NULL."""
    return f"coalesce(CAST(to_json({expr}) AS VARCHAR), 'null')"


def _num(expr: str) -> str:
    return f"coalesce(CAST({expr} AS VARCHAR), 'null')"


def _members(cents_delta: int = 0, float_amount: bool = False,
             drop_priority: bool = False, extra: bool = False) -> str:
    total = _num(f"(cents + {cents_delta})") if cents_delta else _num("cents")
    amount = f"{_num('cents')} || '.0'" if float_amount else _num("cents")
    parts = [f"""'"order_id": ' || {_num('k')}""",
             f"""', "customer": ' || {_js('name')}""",
             f"""', "order_date": ' || {_js('dt')}"""]
    if not drop_priority:
        parts.append(f"""', "priority": ' || {_js('pri')}""")
    parts += [f"""', "total_cents": ' || {total}""",
              f"""', "tags": [' || {_js('status')} || ', ' || {_js('seg')}""",
              f"""'], "parties": [{{"name": ' || {_js('name')}""",
              f"""', "nation": ' || {_js('nat')}""",
              f"""'}}], "amounts": {{"total_cents": ' || {amount}""",
              f"""', "balance_cents": ' || {_num('bal')} || '}}'"""]
    if extra:
        parts.append(f"""', {C.EXTRA_MEMBER}'""")
    return " || ".join(parts)


def _pred_record(members: str) -> str:
    return f"""'{{"record": {{' || {members} || '}}, "can_extract": true, "refusal_reason": null}}'"""


def _refusal(reason: str | None = C.REFUSAL_REASON, extra: bool = False) -> str:
    body = ['"record": null', '"can_extract": false']
    if reason is not None:
        body.append(f'"refusal_reason": "{reason}"')
    if extra:
        body.append(C.EXTRA_MEMBER)
    return "'{" + ", ".join(body) + "}'"


def _sql_str(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def damaged(d: str) -> str:
    return f"""(CASE {d}
      WHEN 0 THEN base
      WHEN 1 THEN {_sql_str(C.PROSE_HEAD)} || base || {_sql_str(C.PROSE_TAIL)}
      WHEN 2 THEN base || {_sql_str(C.TRAILER)}
      WHEN 3 THEN substr(base, 1, length(base) - {C.CUT_CHARS})
      WHEN 4 THEN CASE WHEN refusal THEN {_refusal(C.WRONG_REASON)}
                       ELSE {_pred_record(_members(cents_delta=1, float_amount=True))} END
      WHEN 5 THEN CASE WHEN refusal THEN {_refusal(None)}
                       ELSE {_pred_record(_members(drop_priority=True))} END
      WHEN 6 THEN CASE WHEN refusal THEN {_refusal(extra=True)}
                       ELSE {_pred_record(_members(extra=True))} END
      WHEN 7 THEN CASE WHEN refusal THEN {_pred_record(_members())} ELSE {_refusal()} END
      WHEN 8 THEN {_sql_str(C.NON_OBJECT)}
      ELSE {_sql_str(C.BLANK)}
    END)"""


def _f(expr: str) -> str:
    return f"coalesce(CAST({expr} AS VARCHAR), 'None')"


ORDER_SOURCE = f"""
corpus_src AS (
  SELECT o.o_orderkey AS k, o.o_orderstatus AS status, c.c_name AS name,
         strftime(o.o_orderdate, '%Y-%m-%d') AS dt, o.o_orderpriority AS pri,
         CAST(round(o.o_totalprice * 100) AS BIGINT) AS cents, c.c_mktsegment AS seg,
         n.n_name AS nat, CAST(round(c.c_acctbal * 100) AS BIGINT) AS bal,
         coalesce(o.o_orderstatus = 'P', false) AS refusal,
         ((o.o_orderkey % 10) + 10) % 10 AS d
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
corpus_base AS (
  SELECT *, 'order-' || CAST(k AS VARCHAR) AS id,
    'Order ' || {_f('k')} || ' for ' || {_f('name')} || ' (' || {_f('nat')} || ') placed ' || {_f('dt')}
      || ', priority ' || {_f('pri')} || ', status ' || {_f('status')} || ', segment ' || {_f('seg')}
      || '. Total ' || {_f('cents')} || ' cents; customer balance ' || {_f('bal')} || ' cents.' AS input_text,
    '{C.ORDER_SCHEMA_HINT}' AS schema_hint,
    CASE WHEN refusal THEN '{{"can_extract": false, "refusal_reason": "{C.REFUSAL_REASON}", "record": null}}'
         ELSE '{{"can_extract": true, "refusal_reason": null, "record": {{' || {_members()} || '}}}}' END AS target_text,
    CASE WHEN refusal THEN {_refusal()} ELSE {_pred_record(_members())} END AS base
  FROM corpus_src
)"""

ORDER_CORPUS = ORDER_SOURCE + f""",
corpus AS (
  SELECT id, k AS o_orderkey, CAST(d AS INTEGER) AS damage, NOT refusal AS can_extract, target_text,
         {damaged('d')} AS raw_output
  FROM corpus_base
)"""

# The PROSE texts contain a newline; DuckDB string literals take it verbatim.

# ------------------------------------------------------------- json bits ---


def strict_block(text_expr: str) -> str:
    """C1 in DuckDB: strip, parse whole (JSON null -> NULL), else the brace span."""
    s = f"regexp_replace({text_expr}, '^\\s+|\\s+$', '', 'g')"
    span = f"regexp_extract({s}, '\\{{.*\\}}', 0, 's')"
    return (f"(CASE WHEN {s} <> '' AND json_valid({s}) THEN "
            f"CASE WHEN json_type({s}) <> 'NULL' THEN CAST({s} AS JSON) END "
            f"WHEN {span} <> '' AND json_valid({span}) THEN CAST({span} AS JSON) END)")


def canonical(expr: str, depth: int = 5) -> str:
    """Sorted-key compact JSON text, built recursively to a fixed depth."""
    if depth == 0:
        return f"CAST(json({expr}) AS VARCHAR)"
    k, x = f"k{depth}", f"x{depth}"
    child_obj = canonical(f"json_extract({expr}, '$.\"' || {k} || '\"')", depth - 1)
    child_arr = canonical(x, depth - 1)
    return (f"(CASE json_type({expr}) "
            f"WHEN 'OBJECT' THEN '{{' || array_to_string(list_transform(list_sort(json_keys({expr})), "
            f"lambda {k}: CAST(to_json({k}) AS VARCHAR) || ':' || {child_obj}), ',') || '}}' "
            f"WHEN 'ARRAY' THEN '[' || array_to_string(list_transform(json_extract({expr}, '$[*]'), "
            f"lambda {x}: {child_arr}), ',') || ']' "
            f"ELSE CAST(json({expr}) AS VARCHAR) END)")


def leaf_path(fullkey: str) -> str:
    return (f"(CASE WHEN {fullkey} = '$' THEN '' WHEN starts_with({fullkey}, '$.') "
            f"THEN substr({fullkey}, 3) ELSE substr({fullkey}, 2) END)")


def leaves_cte(name: str, source: str, id_col: str, json_col: str, side: str | None = None) -> str:
    """(id, [side,] path, lit): one row per leaf, smallest literal per path."""
    side_sel = f"'{side}' AS side, " if side else ""
    return (f"{name} AS (SELECT s.{id_col} AS id, {side_sel}{leaf_path('t.fullkey')} AS path, "
            f"min(CAST(t.value AS VARCHAR)) AS lit "
            f"FROM {source} s, json_tree(s.{json_col}) t "
            f"WHERE s.{json_col} IS NOT NULL AND t.type NOT IN ('OBJECT', 'ARRAY') "
            f"GROUP BY ALL)")


def py_eq(a: str, b: str) -> str:
    """Python == between two JSON values (NULL = missing)."""
    def none(e):
        return f"({e} IS NULL OR json_type({e}) = 'NULL')"

    def num(e):
        return (f"(CASE json_type({e}) WHEN 'BOOLEAN' THEN CASE WHEN CAST({e} AS VARCHAR) = 'true' "
                f"THEN 1.0 ELSE 0.0 END ELSE CAST(CAST({e} AS VARCHAR) AS DOUBLE) END)")
    numeric = "('BOOLEAN', 'BIGINT', 'UBIGINT', 'DOUBLE')"
    return (f"(CASE WHEN {none(a)} OR {none(b)} THEN {none(a)} AND {none(b)} "
            f"WHEN json_type({a}) IN {numeric} AND json_type({b}) IN {numeric} THEN {num(a)} = {num(b)} "
            f"WHEN json_type({a}) = 'VARCHAR' AND json_type({b}) = 'VARCHAR' THEN CAST({a} AS VARCHAR) = CAST({b} AS VARCHAR) "
            f"WHEN json_type({a}) = json_type({b}) AND json_type({a}) IN ('OBJECT', 'ARRAY') "
            f"THEN {canonical(a, 4)} = {canonical(b, 4)} "
            f"ELSE false END)")


def refusal_ok(pred: str, target: str) -> str:
    return (f"(CASE WHEN {pred} IS NULL OR json_type({pred}) <> 'OBJECT' THEN false "
            f"ELSE {py_eq(f"json_extract({pred}, '$.can_extract')", f"json_extract({target}, '$.can_extract')")} END)")


def f1_expr(tp: str, np_: str, nt: str, pred_null: str) -> str:
    p = f"(CAST({tp} AS DOUBLE) / {np_})"
    r = f"(CAST({tp} AS DOUBLE) / {nt})"
    return (f"(CASE WHEN {pred_null} THEN 0.0::DOUBLE WHEN {np_} = 0 AND {nt} = 0 THEN 1.0::DOUBLE "
            f"WHEN {np_} = 0 OR {nt} = 0 THEN 0.0::DOUBLE WHEN {tp} = 0 THEN 0.0::DOUBLE "
            f"ELSE 2.0::DOUBLE * {p} * {r} / ({p} + {r}) END)")


def scored_ctes(source: str = "corpus", extra: str = "damage, can_extract, ") -> str:
    """Per-row scores of ``source(id, raw_output, target_text, ...)`` as CTE ``scored``."""
    return f"""
parsed AS (
  SELECT id, {extra}raw_output, {strict_block('raw_output')} AS pred,
         CAST(target_text AS JSON) AS target
  FROM {source}
),
{leaves_cte('pl', 'parsed', 'id', 'pred', 'p')},
{leaves_cte('tl', 'parsed', 'id', 'target', 't')},
pcount AS (SELECT id, count(*) AS np FROM pl GROUP BY id),
tcount AS (SELECT id, count(*) AS nt FROM tl GROUP BY id),
tpcount AS (SELECT pl.id, count(*) AS tp FROM pl JOIN tl ON pl.id = tl.id AND pl.path = tl.path AND pl.lit = tl.lit GROUP BY pl.id),
scored AS (
  SELECT p.*,
         {canonical('p.pred')} AS parsed_output,
         {canonical('p.target')} AS target_json,
         p.pred IS NOT NULL AS json_valid,
         coalesce({canonical('p.pred')} = {canonical('p.target')}, false) AS exact_match,
         {f1_expr('coalesce(tp.tp, 0)', 'coalesce(pc.np, 0)', 'coalesce(tc.nt, 0)', 'p.pred IS NULL')} AS field_f1,
         {refusal_ok('p.pred', 'p.target')} AS refusal_correct
  FROM parsed p
  LEFT JOIN pcount pc ON p.id = pc.id
  LEFT JOIN tcount tc ON p.id = tc.id
  LEFT JOIN tpcount tp ON p.id = tp.id
)"""


SCORED = scored_ctes()


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def report_select(source: str = "scored", group: str = "") -> str:
    def pct(col):
        return f"round(avg(CAST({col} AS DOUBLE)) * 100.0, 2)"
    sel = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    return (f"SELECT {sel}count(*) AS samples, {pct('json_valid')} AS json_validity_rate, "
            f"{pct('exact_match')} AS exact_match_accuracy, {pct('field_f1')} AS field_level_f1, "
            f"{pct('refusal_correct')} AS refusal_correctness FROM {source}{tail}")
