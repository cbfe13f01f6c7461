"""DuckDB oracle SQL per registered query (same column names as the Spark side)."""

from __future__ import annotations

from recordsmith.plans import oracle_sql as Q

_CORPUS_PARSED = f"""
cparsed AS (SELECT id, raw_output, {Q.strict_block('raw_output')} AS pred FROM corpus)"""

_KIND = ("CASE WHEN pred IS NULL THEN NULL ELSE CASE json_type(pred) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' "
         "WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' "
         "ELSE 'number' END END")

_EVENTS_PARSED = """
evp AS (SELECT event_id, CASE WHEN json_valid(props) AND json_type(props) <> 'NULL'
        THEN CAST(props AS JSON) END AS v FROM events)"""


def _confidence(pred: str) -> str:
    rec = f"json_extract({pred}, '$.record')"
    can = f"json_extract({pred}, '$.can_extract')"
    populated = (f"(CASE WHEN json_type({pred}) = 'OBJECT' AND json_type({rec}) = 'OBJECT' THEN "
                 f"len(list_filter(json_keys({rec}), lambda kk: CAST(json_extract({rec}, '$.\"' || kk || '\"') AS VARCHAR) "
                 f"NOT IN ('null', '\"\"', '[]', '{{}}'))) ELSE 0 END)")
    return (f"(CASE WHEN {pred} IS NULL THEN 0.0::DOUBLE "
            f"WHEN json_type({pred}) = 'OBJECT' AND json_type({can}) = 'BOOLEAN' AND CAST({can} AS VARCHAR) = 'false' "
            f"THEN 0.92::DOUBLE "
            f"ELSE round(least(0.99::DOUBLE, 0.45::DOUBLE + ({populated} / 9.0::DOUBLE) * 0.5::DOUBLE), 2) END)")


def _schema_ok(pred: str, fields: dict[str, str]) -> str:
    rec = f"json_extract({pred}, '$.record')"
    types = {"integer": "('BIGINT', 'UBIGINT')", "string": "('VARCHAR')", "array": "('ARRAY')",
             "object": "('OBJECT')", "boolean": "('BOOLEAN')", "number": "('BIGINT', 'UBIGINT', 'DOUBLE')"}
    checks = " AND ".join(f"coalesce(json_type(json_extract({rec}, '$.{k}')) IN {types[v]}, false)"
                          for k, v in fields.items())
    keys = ", ".join(f"'{k}'" for k in sorted(fields))
    env = (f"json_type({pred}) = 'OBJECT' AND list_sort(json_keys({pred})) = ['can_extract', 'record', 'refusal_reason'] "
           f"AND coalesce(json_type(json_extract({pred}, '$.can_extract')) = 'BOOLEAN', false) "
           f"AND coalesce(json_type(json_extract({pred}, '$.refusal_reason')) IN ('VARCHAR', 'NULL'), false)")
    record = (f"(json_type({rec}) = 'NULL' OR (json_type({rec}) = 'OBJECT' "
              f"AND list_sort(json_keys({rec})) = [{keys}] AND {checks}))")
    return f"coalesce({pred} IS NOT NULL AND {env} AND {record}, false)"


def oracle_sql() -> dict[str, str]:
    from recordsmith.plans.catalog import ORDER_RECORD_FIELDS

    scored = Q.with_ctes(Q.ORDER_CORPUS, Q.SCORED)
    parsed = Q.with_ctes(Q.ORDER_CORPUS, _CORPUS_PARSED)
    out = {
        "eval_report": scored + Q.report_select(),
        "eval_report_joined": scored + Q.report_select(),
        "json_safe_rows": """
SELECT o_orderkey, strftime(o_orderdate::TIMESTAMP, '%Y-%m-%dT%H:%M:%S') AS o_orderdate, coalesce(lines, '') AS lines
FROM orders LEFT JOIN (
  SELECT l_orderkey, string_agg(l_linenumber || ' ' || strftime(l_shipdate::TIMESTAMP, '%Y-%m-%dT%H:%M:%S') || ' '
    || strftime(l_shipdate::TIMESTAMP, '%Y-%m-%d'), ',' ORDER BY l_linenumber, l_shipdate) AS lines
  FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
        "prediction_detail": scored + ("SELECT id, raw_output, parsed_output, target_json, json_valid, exact_match, "
                                       "field_f1, refusal_correct FROM scored"),
        "parse_json_block": parsed + (f"SELECT id, pred IS NOT NULL AS json_valid, {_KIND} AS parsed_kind, "
                                      f"{Q.canonical('pred')} AS parsed_output FROM cparsed"),
        "canonical_json": Q.with_ctes(_EVENTS_PARSED) + f"SELECT event_id, {Q.canonical('v')} AS canonical FROM evp",
        "flatten_json": Q.with_ctes(Q.ORDER_CORPUS, _CORPUS_PARSED, Q.leaves_cte("fl", "cparsed", "id", "pred"))
        + "SELECT id, path, lit AS literal FROM fl",
        "flatten_event_props": Q.with_ctes(_EVENTS_PARSED, Q.leaves_cte("fl", "evp", "event_id", "v"))
        + "SELECT id AS event_id, path, lit AS literal FROM fl",
        "field_f1": scored + "SELECT id, field_f1 FROM scored",
        "refusal_correct": scored + "SELECT id, refusal_correct FROM scored",
        "extract_response": parsed + (f"SELECT id, {Q.canonical('pred')} AS structured_json, "
                                      f"{_confidence('pred')} AS confidence, raw_output FROM cparsed"),
        "schema_check": parsed + f"SELECT id, {_schema_ok('pred', ORDER_RECORD_FIELDS)} AS schema_ok FROM cparsed",
    }
    out.update(long_form_oracles())
    out.update(corpus_oracles())
    out.update(pair_oracles())
    out.update(report_oracles())
    return out


# ------------------------------------------------------ corpus & rendering

def _lst(values) -> str:
    return "[" + ", ".join(Q._sql_str(str(v)) if isinstance(v, str) else str(v) for v in values) + "]"


def _synth_ctes(seed: int = 42) -> str:
    from recordsmith.operators import synth as SY

    def draw(field: str) -> str:
        return f"CAST(('0x' || substr(md5('{seed}|' || idx || '|{field}'), 1, 8)) AS BIGINT)"

    def choice(field, values):
        return f"{_lst(values)}[({draw(field)} % {len(values)}) + 1]"

    def randint(field, lo, hi):
        return f"({lo} + {draw(field)} % {hi - lo + 1})"

    def sample(field, values, k):
        return (f"list_transform(list_slice(list_sort(list_transform({_lst(values)}, "
                f"lambda x: md5('{seed}|' || idx || '|{field}|' || x) || x)), 1, {k}), lambda s: substr(s, 33))")

    dose = "CASE m " + " ".join(f"WHEN {Q._sql_str(a)} THEN {Q._sql_str(b)}" for a, b in SY.MEDICATIONS) + " END"
    med_names = [m for m, _ in SY.MEDICATIONS]
    refusal_json = ('{"can_extract":false,"refusal_reason":"' + SY.REFUSAL_REASON + '","record":null}')
    return f"""
params AS (SELECT count(*) AS n, CAST(floor(count(*) * 0.12::DOUBLE) AS BIGINT) AS r,
                  CAST(floor(count(*) * 0.8::DOUBLE) AS BIGINT) AS n_train,
                  CAST(floor(count(*) * 0.1::DOUBLE) AS BIGINT) AS n_val FROM orders),
order_keys AS (SELECT o_orderkey AS idx, row_number() OVER (ORDER BY o_orderkey) - 1 AS rk FROM orders),
note_idx AS (SELECT idx FROM order_keys, params WHERE rk < n - r),
refusal_idx AS (SELECT idx FROM order_keys, params WHERE rk >= n - r),
note_draws AS (
  SELECT idx, {choice('name', SY.NAMES)} AS name, {randint('age', *SY.AGE)} AS age,
         {choice('sex', SY.SEXES)} AS sex, {choice('complaint', SY.COMPLAINTS)} AS complaint,
         {sample('diagnoses', SY.DIAGNOSES, randint('n_diagnoses', 1, 2))} AS diagnoses,
         {sample('medications', med_names, randint('n_medications', 1, 2))} AS med_names,
         {sample('allergies', SY.ALLERGIES, 1)} AS allergies,
         {randint('systolic', *SY.SYSTOLIC)} AS systolic, {randint('diastolic', *SY.DIASTOLIC)} AS diastolic,
         {randint('heart_rate', *SY.HEART_RATE)} AS heart_rate, {randint('temperature', *SY.TEMP_TENTHS)} AS temp10,
         {choice('follow_up', SY.FOLLOW_UP_DAYS)} AS follow_up,
         printf('{SY.ENCOUNTER_YEAR}-%02d-%02d', {randint('month', 1, 12)}, {randint('day', 1, 28)}) AS encounter_date
  FROM note_idx),
notes AS (
  SELECT printf('medical-%05d', idx) AS id,
    'ED/Clinic note :: Pt ' || name || ', ' || age || ' y/o ' || sex || '. Seen on ' || encounter_date || ' for '
    || complaint || '. Assessment mentions ' || array_to_string(diagnoses, ', ') || '. Current meds: '
    || array_to_string(list_transform(med_names, lambda m: m || ' ' || {dose}), '; ') || '. Allergies: '
    || array_to_string(allergies, ', ') || '. Vitals -> BP ' || systolic || '/' || diastolic || ', HR ' || heart_rate
    || ', Temp ' || (temp10 // 10) || '.' || (temp10 % 10) || 'F. Follow-up requested in ' || follow_up
    || ' days. Transcribed from mixed shorthand and dictated fragments.' AS input_text,
    'medical_intake_v1' AS schema_hint,
    CAST(to_json({{'can_extract': true, 'refusal_reason': NULL::VARCHAR, 'record': {{
      'patient_name': name, 'age': CAST(age AS BIGINT), 'sex': sex, 'encounter_date': encounter_date,
      'chief_complaint': complaint, 'diagnoses': diagnoses,
      'medications': list_transform(med_names, lambda m: {{'name': m, 'dose': {dose}}}),
      'allergies': allergies,
      'vitals': {{'blood_pressure': systolic || '/' || diastolic, 'heart_rate': CAST(heart_rate AS BIGINT),
                  'temperature_f': CAST(temp10 AS DOUBLE) / 10.0::DOUBLE}},
      'follow_up_days': CAST(follow_up AS BIGINT)}}}}) AS VARCHAR) AS target_json,
    true AS can_extract, '{SY.DOMAIN}' AS domain
  FROM note_draws),
refusals AS (
  SELECT printf('refusal-%05d', idx) AS id, {choice('refusal_text', SY.REFUSAL_TEXTS)} AS input_text,
         'medical_intake_v1' AS schema_hint, '{refusal_json}' AS target_json,
         false AS can_extract, '{SY.DOMAIN}' AS domain
  FROM refusal_idx),
corpus_all AS (SELECT *, md5('{seed}|' || id) AS shuffle_key FROM notes UNION ALL
               SELECT *, md5('{seed}|' || id) AS shuffle_key FROM refusals),
ranked AS (
  SELECT c.*, row_number() OVER (ORDER BY shuffle_key, id) - 1 AS ordinal FROM corpus_all c),
split AS (
  SELECT r.*, CASE WHEN ordinal < p.n_train THEN 'train' WHEN ordinal < p.n_train + p.n_val THEN 'val'
                   ELSE 'test' END AS split
  FROM ranked r, params p)"""


def _chat_sql(source: str, gen: bool) -> str:
    from recordsmith.functions import prompts as P
    nl = "chr(10)"
    default_header = Q._sql_str(P.IM_START + "system\n" + P.DEFAULT_SYSTEM + P.IM_END + "\n")
    suffix = f" || {Q._sql_str(P.IM_START + 'assistant' + chr(10))}" if gen else ""
    return f"""
t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text,
             row_number() OVER w - 1 AS i, lag(role) OVER w AS prev_role, lead(role) OVER w AS next_role
      FROM {source} WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
pieces AS (
  SELECT conv_id, turn, i,
    CASE WHEN role IN ('user', 'assistant') OR (role = 'system' AND i > 0)
           THEN '{P.IM_START}' || role || {nl} || text || '{P.IM_END}' || {nl}
         WHEN role = 'tool'
           THEN (CASE WHEN i = 0 OR coalesce(prev_role <> 'tool', true) THEN '{P.IM_START}user' ELSE '' END)
                || {nl} || '<tool_response>' || {nl} || text || {nl} || '</tool_response>'
                || (CASE WHEN coalesce(next_role <> 'tool', true) THEN '{P.IM_END}' || {nl} ELSE '' END)
         ELSE '' END AS piece,
    CASE WHEN i = 0 THEN role END AS first_role, CASE WHEN i = 0 THEN text END AS first_text
  FROM t)
SELECT conv_id,
  CASE WHEN max(first_role) = 'system' THEN '{P.IM_START}system' || {nl} || max(first_text) || '{P.IM_END}' || {nl}
       ELSE {default_header} END || string_agg(piece, '' ORDER BY turn){suffix} AS text
FROM pieces GROUP BY conv_id"""


def _user_prompt_sql(text: str, hint: str) -> str:
    from recordsmith.functions import prompts as P
    return f"({Q._sql_str(P.USER_PROMPT_HEAD)} || {hint} || {Q._sql_str(P.USER_PROMPT_MID)} || {text})"


def _ascii_string(x: str) -> str:
    """A value as a JSON string of ASCII characters, null for NULL."""
    escapes = " ".join(f"WHEN '{c}' THEN '{e}'" for c, e in (('"', '\\"'), ("\\", "\\\\")))
    escapes += " " + " ".join(f"WHEN chr({c}) THEN '{e}'" for c, e in ((8, "\\b"), (9, "\\t"), (10, "\\n"), (12, "\\f"), (13, "\\r")))
    hexed = ("CASE WHEN unicode(c) > 65535 THEN printf('\\u%04x\\u%04x', 55296 + ((unicode(c) - 65536) >> 10), "
             "56320 + ((unicode(c) - 65536) & 1023)) WHEN unicode(c) < 32 OR unicode(c) > 126 THEN printf('\\u%04x', unicode(c)) "
             "ELSE c END")
    return (f"(CASE WHEN {x} IS NULL THEN 'null' WHEN {x} = '' THEN '\"\"' ELSE '\"' || array_to_string(list_transform("
            f"string_split({x}, ''), lambda c: CASE c {escapes} ELSE {hexed} END), '') || '\"' END)")


_DOCUMENT_SPLITS = """
placed AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) - 1 AS pos, count(*) OVER () AS n FROM documents),
docsplit AS (SELECT *, CASE WHEN pos < floor(n * 0.8::DOUBLE) THEN 'train'
                            WHEN pos < floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM placed)"""


def _nested_faults() -> str:
    """``faults`` (id, fault, path) of ``cparsed`` against the order schema."""
    from recordsmith.operators.conform import schema_rows
    from recordsmith.plans.catalog import ORDER_SCHEMA
    rules = ", ".join(f"('{p}', {_lst(kinds)}, {'NULL' if members is None else members})"
                      for p, _, kinds, members in schema_rows(ORDER_SCHEMA))
    kind = ("CASE t.type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' "
            "WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'DOUBLE' THEN 'number' ELSE 'integer' END")
    return f"""
rules(pattern, kinds, members) AS (VALUES {rules}),
nodes AS (SELECT s.id, {Q.leaf_path('t.fullkey')} AS path, {Q.leaf_path('t.path')} AS parent, t.fullkey = '$' AS root,
                 regexp_replace({Q.leaf_path('t.fullkey')}, '\\[[0-9]+\\]', '[]', 'g') AS pattern, {kind} AS kind
          FROM cparsed s, json_tree(s.pred) t WHERE s.pred IS NOT NULL),
held AS (SELECT n.*, r.kinds, r.members FROM nodes n LEFT JOIN rules r ON n.pattern = r.pattern),
faults AS (
  SELECT id, 'unknown' AS fault, path FROM held WHERE kinds IS NULL
  UNION ALL SELECT id, 'kind', path FROM held WHERE kinds IS NOT NULL AND NOT list_contains(kinds, kind)
  UNION ALL SELECT o.id, 'missing', o.path FROM held o LEFT JOIN held c
    ON c.id = o.id AND c.parent = o.path AND NOT c.root AND c.kinds IS NOT NULL AND NOT ends_with(c.pattern, '[]')
  WHERE o.kind = 'object' AND o.members IS NOT NULL GROUP BY o.id, o.path, o.members HAVING count(c.id) < o.members)"""


def long_form_oracles() -> dict[str, str]:
    scored = Q.with_ctes(Q.ORDER_CORPUS, Q.SCORED)
    parsed = Q.with_ctes(Q.ORDER_CORPUS, _CORPUS_PARSED)

    def dbl(x):
        return f"CAST(CAST({x} AS DOUBLE) AS VARCHAR)"

    text = _ascii_string("text")
    return {
        "score_long": scored + ("SELECT s.id, coalesce(np, 0) AS n_pred, coalesce(nt, 0) AS n_target, coalesce(tp, 0) AS n_common, "
                                "field_f1 FROM scored s LEFT JOIN pcount USING (id) LEFT JOIN tcount USING (id) LEFT JOIN tpcount USING (id)"),
        "score_long_events": Q.with_ctes(_EVENTS_PARSED, Q.leaves_cte("fl", "evp", "event_id", "v")) + f"""
SELECT id, n_pred, n_target, n_common, {Q.f1_expr('n_common', 'n_pred', 'n_target', 'false')} AS field_f1 FROM (
  SELECT event_type AS id, count(p.lit) AS n_pred, count(t.lit) AS n_target,
         count(*) FILTER (p.lit = t.lit) AS n_common
  FROM (SELECT id, path, lit FROM fl) p
  FULL JOIN (SELECT event_id AS id, 'k' AS path, CAST(((event_id % 100) + 100) % 100 AS VARCHAR) AS lit FROM events) t
    ON p.id = t.id AND p.path = t.path
  JOIN events e ON e.event_id = coalesce(p.id, t.id) GROUP BY event_type)""",
        "schema_nested": parsed.rstrip() + "," + _nested_faults() + """
SELECT c.id, c.pred IS NOT NULL AND count(f.id) = 0 AS schema_ok, count(*) FILTER (f.fault = 'unknown') AS n_unknown,
       count(*) FILTER (f.fault = 'kind') AS n_kind, count(*) FILTER (f.fault = 'missing') AS n_missing,
       min(f.path) AS first_fault
FROM cparsed c LEFT JOIN faults f ON c.id = f.id GROUP BY c.id, c.pred""",
        "number_kinds": f"""
SELECT o_orderkey, '{{"big":' || k || '00000000000000000000,"huge":' || {dbl("c || '.5E+17'")} || ',"list":[-0.0,0,'
       || {dbl("k || 'e3'")} || '],"price":' || {dbl("c || 'E-2'")} || ',"tiny":' || {dbl("u || 'e-12'")} || ',"whole":'
       || {dbl("u || '.0'")} || '}}' AS canonical
FROM (SELECT o_orderkey, coalesce(CAST(o_orderkey + 1 AS VARCHAR), '0') AS k, coalesce(CAST(o_custkey AS VARCHAR), '0') AS u,
             coalesce(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR), '0') AS c FROM orders)""",
        "ascii_texts": f"""
SELECT kind, id, turn, md5(j) AS digest, length(j) AS chars FROM (
  SELECT 'document' AS kind, doc_id AS id, 0::BIGINT AS turn, {text} AS j FROM documents
  UNION ALL SELECT 'turn', conv_id, turn::BIGINT, {text} FROM conversations)""",
    }


def corpus_oracles() -> dict[str, str]:
    from recordsmith.functions import prompts as P
    synth = Q.with_ctes(_synth_ctes())
    cols = "id, input_text, schema_hint, target_json, can_extract, domain"
    line = ("'{\"id\":' || CAST(to_json(id) AS VARCHAR) || ',\"input_text\":' || CAST(to_json(input_text) AS VARCHAR)"
            " || ',\"schema_hint\":' || CAST(to_json(schema_hint) AS VARCHAR) || ',\"target_json\":' || target_json"
            " || ',\"can_extract\":' || CAST(can_extract AS VARCHAR) || ',\"domain\":' || CAST(to_json(domain) AS VARCHAR) || '}'")
    events_turns = ("ev AS (SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS conv_id, "
                    "{'ts': ts, 'event_id': event_id} AS turn, "
                    "CASE WHEN event_type IN ('error', 'click') THEN 'tool' WHEN event_type = 'view' THEN 'user' "
                    "ELSE 'assistant' END AS role, event_type || ' ' || coalesce(props, 'null') AS text FROM events)")
    system = Q._sql_str(P.IM_START + "system" + chr(10) + P.SYSTEM_PROMPT + P.IM_END + chr(10))
    said = "coalesce(text, 'None')"
    opening = _ascii_string("split_part(coalesce(text, ''), chr(10), 1)")
    target = (f"'{{\"lang\":' || {_ascii_string('lang')} || ',\"source\":' || {_ascii_string('source')} "
              f"|| ',\"opening\":' || {opening} || '}}'")
    sft = (f"{system} || '{P.IM_START}user' || chr(10) || {_user_prompt_sql(said, 'coalesce(lang, ' + chr(39) + 'None' + chr(39) + ')')} "
           f"|| '{P.IM_END}' || chr(10) || '{P.IM_START}assistant' || chr(10) || {target} || '{P.IM_END}' || chr(10)")
    prompt = _user_prompt_sql(said, "coalesce(source, 'None')")
    infer = (f"{system} || '{P.IM_START}user' || chr(10) || {_user_prompt_sql(said, Q._sql_str(P.DEFAULT_SCHEMA_HINT))} "
             f"|| '{P.IM_END}' || chr(10) || '{P.IM_START}assistant' || chr(10)")
    return {
        "synth_notes": synth + f"SELECT {cols} FROM notes",
        "synth_refusals": synth + f"SELECT {cols} FROM refusals",
        "split_corpus": synth + f"SELECT {cols}, ordinal, split FROM split",
        "split_counts": Q.with_ctes(_DOCUMENT_SPLITS) + "SELECT split, count(*) AS rows FROM docsplit GROUP BY split",
        "split_documents": Q.with_ctes(_DOCUMENT_SPLITS) + "SELECT doc_id, split, length(text) AS chars FROM docsplit",
        "eval_subset": synth + ("SELECT id, ordinal, target_json FROM split WHERE split = 'test' "
                                "ORDER BY ordinal LIMIT 400"),
        "first_example": synth + f"SELECT id, {line} AS line FROM split WHERE split = 'train' ORDER BY ordinal LIMIT 1",
        "chat_render": "WITH " + _chat_sql("conversations", False).strip(),
        "chat_prompt": "WITH " + _chat_sql("conversations", True).strip(),
        "tool_chat_render": "WITH " + events_turns + ",\n" + _chat_sql("ev", False).strip(),
        "sft_text": Q.with_ctes(_DOCUMENT_SPLITS) + f"SELECT {sft} AS text FROM docsplit WHERE split = 'train'",
        "user_prompt": synth + (f"SELECT id, {_user_prompt_sql('input_text', 'schema_hint')} AS prompt FROM corpus_all "
                                f"UNION ALL SELECT 'document-' || doc_id, {prompt} FROM documents"),
        "inference_prompts": ("SELECT conv_id, " + infer + " AS prompt FROM (SELECT conv_id, first(text ORDER BY turn) AS text "
                              "FROM conversations WHERE role = 'user' GROUP BY conv_id)"),
    }


def pair_oracles() -> dict[str, str]:
    from recordsmith.functions import prompts as P
    from recordsmith.plans.catalog import ORDER_RECORD_FIELDS
    from recordsmith.sources import corpus as C

    cands = (f"cands AS (SELECT id, CAST(j AS INTEGER) AS candidate_index, "
             f"{Q.damaged('((k + 3 * j) % 10)')} AS text FROM (SELECT *, unnest(range(4)) AS j FROM corpus_base))")
    lists = ("lists AS (SELECT id, count(*) AS n_candidates, "
             "CAST(to_json(list(text ORDER BY candidate_index)) AS VARCHAR) AS candidates_json FROM cands GROUP BY id)")
    cand_src = ("cand_src AS (SELECT c.id || '#' || c.candidate_index AS id, c.id AS orig_id, c.candidate_index, "
                "c.text AS raw_output, b.target_text FROM cands c JOIN corpus_base b ON c.id = b.id)")
    ranked = (f"ranked AS (SELECT orig_id AS id, candidate_index, json_valid, "
              f"{_schema_ok('pred', ORDER_RECORD_FIELDS)} AS schema_ok, field_f1, refusal_correct, "
              f"row_number() OVER (PARTITION BY orig_id ORDER BY json_valid DESC, schema_ok DESC, field_f1 DESC, "
              f"refusal_correct DESC, candidate_index ASC) AS rb, "
              f"row_number() OVER (PARTITION BY orig_id ORDER BY json_valid ASC, schema_ok ASC, field_f1 ASC, "
              f"refusal_correct ASC, candidate_index DESC) AS rw FROM scored)")

    def describe(a):
        return (f"'valid=' || CAST({a}.json_valid AS VARCHAR) || ' schema=' || CAST({a}.schema_ok AS VARCHAR) "
                f"|| ' refusal=' || CAST({a}.refusal_correct AS VARCHAR)")
    verdicts = (f"verdicts AS (SELECT b.id, b.candidate_index AS chosen_index, w.candidate_index AS rejected_index, "
                f"'best [' || {describe('b')} || '] worst [' || {describe('w')} || ']' AS reason "
                f"FROM ranked b JOIN ranked w ON b.id = w.id AND b.rb = 1 AND w.rw = 1)")
    pairs = (f"pairs AS (SELECT v.id, {_user_prompt_sql('b.input_text', 'b.schema_hint')} AS prompt, "
             f"cc.text AS chosen, cr.text AS rejected, v.reason AS label_reason, "
             f"v.chosen_index = v.rejected_index AS same_choice, b.k "
             f"FROM verdicts v JOIN corpus_base b ON v.id = b.id "
             f"JOIN cands cc ON cc.id = v.id AND cc.candidate_index = v.chosen_index "
             f"JOIN cands cr ON cr.id = v.id AND cr.candidate_index = v.rejected_index)")
    rank_ctes = Q.with_ctes(Q.ORDER_SOURCE, cands, cand_src,
                            Q.scored_ctes("cand_src", "orig_id, candidate_index, "), ranked, verdicts)
    payload = (f"'{{\"instruction\":' || CAST(to_json({Q._sql_str(P.SYSTEM_PROMPT)}) AS VARCHAR) "
               f"|| ',\"user_prompt\":' || CAST(to_json({_user_prompt_sql('b.input_text', 'b.schema_hint')}) AS VARCHAR) "
               f"|| ',\"target_json\":' || b.target_text || ',\"candidates\":' || l.candidates_json || '}}'")
    # An indent of four comes from the JSON library; half of it is asked for.
    pretty = ("array_to_string(list_transform(string_split(json_pretty(CAST(payload AS JSON)), chr(10)), "
              "lambda x: repeat(' ', ((length(x) - length(ltrim(x, ' '))) // 2)::BIGINT) || ltrim(x, ' ')), chr(10))")
    sound = ("'{\"chosen_index\":' || (o_orderkey % 4) || ',\"rejected_index\":' || ((o_orderkey + 1) % 4) || ',\"reason\":\"' "
             "|| coalesce(o_orderpriority, '') || '\"}'")
    broken = (f"CASE o_orderkey % 4 WHEN 0 THEN replace(replace({sound}, '{{', ''), '}}', '') "
              "WHEN 1 THEN '{\"chosen_index\":' || (o_orderkey % 4) || '}' "
              "WHEN 2 THEN '{\"chosen_index\":\"' || (o_orderkey % 4) || '\",\"rejected_index\":\"' || ((o_orderkey + 1) % 4) "
              f"|| '\",\"reason\":\"' || coalesce(o_orderpriority, '') || '\"}}' ELSE substr({sound}, 1, 20) END")
    payloads = Q.with_ctes(Q.ORDER_SOURCE, cands, lists) + f"SELECT b.id, {payload} AS payload FROM corpus_base b JOIN lists l ON b.id = l.id"
    return {
        "sampled_candidates": Q.with_ctes(Q.ORDER_SOURCE) + f"""
SELECT id, candidate_index, CASE CAST('0x' || substr(md5('42|' || id || '|' || candidate_index), 1, 8) AS BIGINT) % 6
  WHEN 0 THEN target_text WHEN 1 THEN {Q._sql_str(C.PROSE_HEAD)} || target_text || {Q._sql_str(C.PROSE_TAIL)}
  WHEN 2 THEN target_text || {Q._sql_str(C.TRAILER)} WHEN 3 THEN substr(target_text, 1, length(target_text) - {C.CUT_CHARS})
  WHEN 4 THEN {Q._sql_str(C.NON_OBJECT)} ELSE {Q._sql_str(C.BLANK)} END AS text
FROM (SELECT *, CAST(unnest(range(4)) AS INTEGER) AS candidate_index FROM corpus_base)""",
        "judge_payload_pretty": f"SELECT id, {pretty} AS payload FROM ({payloads})",
        "verdicts_good": ("SELECT 'order-' || o_orderkey AS id, CAST(o_orderkey % 4 AS INTEGER) AS chosen_index, "
                          "CAST((o_orderkey + 1) % 4 AS INTEGER) AS rejected_index, coalesce(o_orderpriority, '') AS reason "
                          "FROM orders WHERE o_orderkey % 7 <> 3"),
        "verdicts_bad": f"SELECT 'order-' || o_orderkey AS id, {broken} AS output_text FROM orders WHERE o_orderkey % 7 = 3",
        "candidates_long": Q.with_ctes(Q.ORDER_SOURCE, cands) + "SELECT id, candidate_index, text FROM cands",
        "candidate_lists": Q.with_ctes(Q.ORDER_SOURCE, cands, lists) + "SELECT * FROM lists",
        "judge_payload": Q.with_ctes(Q.ORDER_SOURCE, cands, lists)
        + f"SELECT b.id, {payload} AS payload FROM corpus_base b JOIN lists l ON b.id = l.id",
        "rank_candidates": rank_ctes + "SELECT id, chosen_index, rejected_index, reason FROM verdicts",
        "judge_parse": rank_ctes + "SELECT id, chosen_index, rejected_index, reason FROM verdicts",
        "preference_pairs": rank_ctes.rstrip() + ",\n" + pairs
        + "\nSELECT id, prompt, chosen, rejected, label_reason, same_choice FROM pairs",
        "pair_split": rank_ctes.rstrip() + ",\n" + pairs
        + ("\nSELECT id, CASE WHEN row_number() OVER (ORDER BY k) - 1 < floor(count(*) OVER () * 0.8::DOUBLE) "
           "THEN 'train' ELSE 'val' END AS split FROM pairs"),
    }


def report_oracles() -> dict[str, str]:
    from recordsmith.schemas import METRIC_NAMES

    cands = (f"cands AS (SELECT id, CAST(j AS INTEGER) AS candidate_index, "
             f"{Q.damaged('((k + 3 * j) % 10)')} AS text FROM (SELECT *, unnest(range(4)) AS j FROM corpus_base))")
    cand_src = ("cand_src AS (SELECT c.id || '#' || c.candidate_index AS id, c.id AS orig_id, c.candidate_index, "
                "c.text AS raw_output, b.target_text FROM cands c JOIN corpus_base b ON c.id = b.id)")
    stages = Q.with_ctes(Q.ORDER_SOURCE, cands, cand_src, Q.scored_ctes("cand_src", "orig_id, candidate_index, "))
    rep = ("reports AS (" + Q.report_select("scored", "candidate_index")
           .replace("SELECT candidate_index, ", "SELECT 'stage_' || candidate_index AS stage, "
                    "candidate_index AS stage_no, ") + ")")
    long = ("long AS (" + " UNION ALL ".join(
        f"SELECT stage, stage_no, '{m}' AS metric, {m} AS value FROM reports" for m in METRIC_NAMES) + ")")
    delta = ("SELECT stage, stage_no, metric, value, delta FROM (SELECT *, "
             "round(value - lag(value) OVER (PARTITION BY metric ORDER BY stage_no), 2) AS delta FROM long) "
             "WHERE delta IS NOT NULL")
    synth = Q.with_ctes(_synth_ctes())
    conf_target = ("CASE WHEN can_extract THEN 0.99::DOUBLE ELSE 0.92::DOUBLE END")
    ev_conf = _confidence("v")
    return {
        "stage_report": stages.rstrip() + ",\n" + rep + "\nSELECT * FROM reports",
        "stage_compare": stages.rstrip() + ",\n" + rep + ",\n" + long + "\nSELECT * FROM long",
        "stage_delta": stages.rstrip() + ",\n" + rep + ",\n" + long + "\n" + delta,
        "stage_delta_files": stages.rstrip() + ",\n" + rep + ",\n" + long + "\n" + delta,
        "documents_files": Q.with_ctes(_DOCUMENT_SPLITS) + (
            "SELECT doc_id, split, lang, source, md5(CASE WHEN split = 'val' THEN 'rewritten' ELSE text END) AS digest "
            "FROM docsplit WHERE split <> 'test'"),
        "candidates_files": Q.with_ctes(Q.ORDER_SOURCE, cands) + "SELECT id, candidate_index, text FROM cands",
        "train_log": ("SELECT CASE WHEN event_id = last THEN 'final' WHEN ((event_id % 2) + 2) % 2 = 1 THEN 'train' ELSE 'eval' END AS part, "
                      "event_id AS step, value FROM (SELECT *, max(event_id) OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d')) AS last "
                      "FROM events) WHERE value IS NOT NULL"),
        "best_checkpoint": ("SELECT user_id, first(event_id ORDER BY value, event_id) AS best_step, "
                            "min(value) AS best_metric FROM events WHERE value IS NOT NULL GROUP BY user_id"),
        "running_best": ("SELECT user_id, event_id, value, min(value) OVER (PARTITION BY user_id ORDER BY event_id "
                         "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_best "
                         "FROM events WHERE value IS NOT NULL"),
        "template_extract": synth + "SELECT id, target_json AS extracted_json FROM corpus_all",
        "batch_extract": synth + (f"SELECT id, {Q.canonical('CAST(target_json AS JSON)')} AS structured_json, "
                                  f"{conf_target} AS confidence FROM corpus_all"),
        "stream_extract": Q.with_ctes(
            "evs AS (SELECT event_id, " + Q.strict_block("props") + " AS v FROM events)")
        + f"SELECT event_id, {Q.canonical('v')} AS structured_json, {ev_conf} AS confidence FROM evs",
    }
