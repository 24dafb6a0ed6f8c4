"""Expected results of the registered queries as DuckDB SQL over the same tables.

Rendered inputs are not parsed here: expected units, modules, pairs and metrics come from
the table columns they were rendered from. Markdown sections use DuckDB's own regex engine.
"""

from __future__ import annotations

from corpusflow import config as c
from corpusflow.plans import queries as q
from corpusflow.plans.rendered import CODE_HEAD, PART_KEYS_PER_FILE

CFG = q.CONFIG
W = CFG.wording
NL = "chr(10)"


def text(value: str) -> str:
    """SQL literal; line breaks and other controls through chr()."""
    out, plain = [], ""
    for ch in value:
        if ch.isprintable():
            plain += "''" if ch == "'" else ch
        else:
            if plain:
                out.append(f"'{plain}'")
            plain = ""
            out.append(f"chr({ord(ch)})")
    if plain or not out:
        out.append(f"'{plain}'")
    return "(" + " || ".join(out) + ")"


PROMPT = text(CFG.system_prompt)
SPACE = text("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0　")


def fill(template: str, **values: str) -> str:
    for name in values:
        template = template.replace("{" + name + "}", f"\0{name}\0")
    parts = template.split("\0")
    return "(" + " || ".join(values[p] if i % 2 else text(p) for i, p in enumerate(parts)) + ")"


def hashed(tag: str, key: str) -> str:
    return f"('0x' || substr(md5('{CFG.seed}|{tag}|' || {key}), 1, 15))::bigint"


def kept(tag: str, key: str, weight: float) -> str:
    return "true" if weight >= 1 else f"{hashed(tag, key)} < {int(weight * (1 << 60))}"


def fenced(code: str) -> str:
    return f"(chr(96)||chr(96)||chr(96)||'{W.fence}'||{NL}||{code}||{NL}||chr(96)||chr(96)||chr(96))"


GAP = f"{NL}||{NL}"

# ---- chats ----

TURNS = f"""
turns AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations WHERE role <> 'system' AND trim(text, {SPACE}) <> ''
),
chats AS (
  SELECT 'chats|' || conv_id AS example_id, pos AS turn, role AS msg_role,
         CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END AS chat_role, text AS value
  FROM turns WHERE n >= 2
  UNION ALL
  SELECT DISTINCT 'chats|' || conv_id, 0, 'system', 'system', {PROMPT} FROM turns WHERE n >= 2
)"""
RENDERED = """
shown AS (
  SELECT *, '<|im_start|>' || msg_role || chr(10) || value || '<|im_end|>' || chr(10) AS part FROM chats
),
rendered AS (
  SELECT example_id, string_agg(part, '' ORDER BY turn) AS text, count(*) AS turns FROM shown GROUP BY example_id
)"""


def split_of(key: str, table: str, columns: str = "*") -> str:
    return f"""
    SELECT {columns}, CASE WHEN r <= greatest(1, floor(n * 0.05::double)) THEN 'val' ELSE 'train' END AS split
    FROM (SELECT *, row_number() OVER (ORDER BY {hashed('order', key)}, {key}::varchar) AS r,
                 count(*) OVER () AS n FROM {table})"""


CHAT_SQL = {
    "chat_normalize": f"WITH {TURNS} SELECT example_id, turn, chat_role AS role, value FROM chats",
    "chat_messages": f"WITH {TURNS} SELECT example_id, turn, msg_role AS role, value FROM chats",
    "stream_normalize": f"WITH {TURNS} SELECT example_id, turn, chat_role AS role, value FROM chats",
    "chat_render": f"WITH {TURNS}, {RENDERED} SELECT example_id, text FROM rendered",
    "chat_prompt": f"""
        SELECT conv_id, turn, '<|im_start|>system' || {NL} || {PROMPT} || '<|im_end|>' || {NL} || '<|im_start|>user' || {NL}
          || text || '<|im_end|>' || {NL} || '<|im_start|>assistant' || {NL} AS prompt
        FROM conversations WHERE role = 'user'""",
    "response_spans": f"""
        WITH {TURNS}, {RENDERED}, placed AS (
          SELECT *, sum(length(part)) OVER (PARTITION BY example_id ORDER BY turn) AS ends FROM shown)
        SELECT example_id, turn, (ends - length(part) + 22)::bigint AS start, ends::bigint AS stop
        FROM placed WHERE msg_role = 'assistant'""",
    "length_profile": f"""
        WITH {TURNS}, {RENDERED}
        SELECT example_id, turns, length(text) AS chars,
               ceil(length(text) / {CFG.chars_per_token}::double)::bigint AS est_tokens,
               ceil(length(text) / {CFG.chars_per_token}::double) > {CFG.max_seq_length} AS over_budget
        FROM rendered""",
    "message_filter": f"""
        WITH gapped AS (
          SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 13 <> 6 THEN role END AS role,
                 CASE WHEN (conv_id + turn) % 7 = 3 THEN ' ' WHEN (conv_id + turn) % 11 = 5 THEN NULL ELSE text END AS text
          FROM conversations),
        counted AS (
          SELECT 'gapped|' || conv_id AS example_id,
                 count(*) FILTER (WHERE role <> 'system' AND trim(text, {SPACE}) <> '') AS n,
                 count(*) FILTER (WHERE role IS NULL OR text IS NULL) AS null_messages
          FROM gapped GROUP BY conv_id)
        SELECT example_id, n + 1 AS turns, null_messages FROM counted WHERE n >= 2""",
    "split_sink": f"""
        WITH {TURNS}, {RENDERED} SELECT split, text FROM ({split_of('example_id', 'rendered')})""",
    "messages_sink": f"""
        WITH {TURNS}, {RENDERED}, tail AS (
          SELECT example_id, count(*) AS turns, arg_max(msg_role, turn) AS last_role, arg_max(value, turn) AS last_content
          FROM chats GROUP BY example_id)
        SELECT CASE split WHEN 'val' THEN 'valid' ELSE split END AS split, turns, last_role, last_content
        FROM ({split_of('example_id', 'tail')})""",
}

for _name in ("messages", "response_spans", "length_profile", "message_filter"):
    CHAT_SQL[f"nested_{_name}"] = CHAT_SQL.get(_name) or CHAT_SQL[f"chat_{_name}"]

# ---- dataset rows ----


def pairs(origin: str) -> str:
    """Adjacent user and assistant turns whose filled keys are not hidden by a blank one."""
    return f"""
    SELECT '{origin}|' || u.conv_id || '-' || u.turn AS example_id, u.conv_id, u.turn,
           trim(u.text, {SPACE}) AS question, trim(a.text, {SPACE}) AS answer
    FROM conversations u JOIN conversations a
      ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
    WHERE u.role = 'user' AND NOT (u.conv_id % 3 > 0 AND u.conv_id % 7 = 3)
      AND trim(u.text, {SPACE}) <> '' AND trim(a.text, {SPACE}) <> ''"""


def landed_fields() -> str:
    """All fields of a landed turn pair as text, from which its key is made."""
    fields = []
    for side in ("u.text", "a.text"):
        for i in range(3):
            value = f"CASE WHEN u.conv_id % 3 = {i} THEN ' ' || {side} || {NL} WHEN u.conv_id % 3 > {i} THEN early END"
            fields.append(f"CASE WHEN ({value}) IS NULL THEN '-' ELSE length({value}) || ':' || ({value}) END")
    return " || ".join(fields)


def capped_pairs(name: str, last: str, language: str, cap: int) -> str:
    """Question and answer of the pairs with this value of the filter field, `cap` of them by the
    hash of their ids."""
    early = "CASE WHEN conv_id % 7 = 3 THEN ' ' || chr(9) WHEN conv_id % 2 = 0 THEN '' END"
    return f"""
    SELECT question, answer FROM (
      SELECT *, row_number() OVER (ORDER BY {hashed('cap', 'example_id')}, example_id) AS r FROM (
        SELECT '{name}|' || md5({landed_fields()} || '{len(language)}:{language}') AS example_id,
          trim(u.text, {SPACE}) AS question, trim(a.text, {SPACE}) AS answer
        FROM (SELECT *, {early} AS early FROM conversations) u JOIN conversations a
          ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
        WHERE u.role = 'user' AND NOT (u.conv_id % 3 > 0 AND u.conv_id % 7 = 3) AND u.turn % 10 IN ({last})
          AND trim(u.text, {SPACE}) <> '' AND trim(a.text, {SPACE}) <> ''))
    WHERE r <= {cap}"""


def landed_pairs() -> str:
    """Ids of the landed turn pairs, from all fields of their rows; some rows come twice."""
    early = "CASE WHEN conv_id % 7 = 3 THEN ' ' || chr(9) WHEN conv_id % 2 = 0 THEN '' END"
    return f"""
    SELECT 'landed|' || md5({landed_fields()}) AS example_id
    FROM (SELECT *, {early} AS early FROM conversations) u JOIN conversations a
      ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant',
      range(2) AS copies(copy)
    WHERE u.role = 'user' AND NOT (u.conv_id % 3 > 0 AND u.conv_id % 7 = 3) AND (copy = 0 OR u.turn % 10 = 1)
      AND trim(u.text, {SPACE}) <> '' AND trim(a.text, {SPACE}) <> ''"""


CODE_ROWS = rf"""
code_rows AS (
  SELECT p_partkey AS k,
    CASE WHEN p_partkey % 11 = 0 THEN 'func short() ' || '{{}}'
         WHEN p_partkey % 11 = 1 THEN '// only text without a block ' || repeat(p_name, p_size)
         ELSE 'func F' || p_partkey || '(a int) {{' || {NL}
           || repeat(chr(9) || 'call("' || p_name || '")' || {NL}, (1 + p_partkey % 7 * p_size)::int) || '}} // end' END AS code,
    p_partkey % 11 AS shape, p_name, p_size,
    substr(repeat(p_name || ' ', 300), 1, [0, 30, 31, 2100][p_partkey % 4 + 1]) AS doc
  FROM part)"""


def code_pairs(where: str = "true", doc: str = "doc") -> str:
    cut = f"substr(code, 1, {c.MAX_PAIR_CODE_CHARS})"
    call = "chr(9) || 'call(\"' || p_name || '\")' || chr(10)"
    # The closing brace survives only in code within the length limit.
    whole = f"length(code) - 7 < {c.MAX_PAIR_CODE_CHARS}"
    body = f"trim(repeat({call}, (1 + k % 7 * p_size)::int), {SPACE})"
    explain = f"length({doc}) > {c.MIN_PAIR_DOC_CHARS}"
    return f"""
    SELECT k,
      CASE WHEN {explain} THEN {text(W.pair_explain)} || {GAP} || {fenced(cut)}
           ELSE {text(W.pair_complete)} || {GAP} || {fenced("'func F' || k || '(a int)' || ' {'")} END AS question,
      CASE WHEN {explain} THEN trim(substr({doc}, 1, {c.MAX_PAIR_DOC_CHARS}), {SPACE}) ELSE {fenced(body)} END AS answer
    FROM code_rows
    WHERE {where} AND length(code) >= {c.MIN_PAIR_CODE_CHARS}
      AND ({explain} OR (shape > 1 AND {whole} AND length({body}) >= {c.MIN_PAIR_BODY_CHARS}))"""


ROW_SQL = {
    "qa_pairs": f"SELECT example_id, question, answer FROM ({pairs('qa')})",
    "instruction_pairs": f"SELECT example_id, question, answer FROM ({pairs('instruction')})",
    "code_pairs": f"WITH {CODE_ROWS} SELECT 'pairs|' || k AS example_id, question, answer FROM ({code_pairs()})",
    "jsonl_dataset": f"""
        WITH {TURNS}, {CODE_ROWS}
        SELECT 'landed' AS origin, count(*) AS turns, {PROMPT} AS first, arg_max(value, turn) AS last
        FROM chats GROUP BY example_id
        UNION ALL
        SELECT 'landed', 3, {PROMPT}, answer
        FROM ({code_pairs("k % 4 <> 3", "(CASE WHEN k % 3 < 2 THEN doc ELSE '' END)")})""",
    "table_dataset": f"SELECT question, answer FROM ({pairs('qa')}) WHERE turn % 10 = 2",
    "dataset_cap": f"""
        SELECT example_id, count(*) AS rows
        FROM (SELECT example_id, row_number() OVER (ORDER BY {hashed('cap', 'example_id')}, example_id) AS r
              FROM ({landed_pairs()}))
        WHERE r <= {q.CAP_DATASET} GROUP BY example_id""",
    "dataset_split": f"""
        SELECT example_id, split, count(*) AS rows
        FROM ({split_of('example_id', '(' + landed_pairs() + ')', 'example_id')}) GROUP BY example_id, split""",
    "field_filter": """
        SELECT doc_id, lang FROM documents LEFT JOIN labels USING (doc_id) WHERE lang = 'en' AND quality = 1""",
}

# ---- Markdown ----

SECTIONS = rf"""
md AS (
  SELECT source, doc_id, array_to_string(list_transform(string_split(text, chr(10)),
    lambda l, i: CASE WHEN (i-1)%5=0 THEN '## '||l WHEN (i-1)%7=3 THEN '### '||l ELSE l END), chr(10)) AS content
  FROM documents),
cut AS (
  SELECT source, doc_id, unnest(regexp_extract_all(content, '(?m)^(#{{2,3}})\s+(.+)$', 1)) AS marks,
         unnest(regexp_extract_all(content, '(?m)^(#{{2,3}})\s+(.+)$', 2)) AS heading,
         unnest(string_split_regex(content, '(?m)^#{{2,3}}\s+.+$')[2:]) AS body,
         unnest(range(0, len(regexp_extract_all(content, '(?m)^(#{{2,3}})\s+(.+)$', 1)))) AS position
  FROM md),
sections AS (
  SELECT trim(translate(trim(heading, {SPACE}), '`*[]()', ''), {SPACE}) AS title,
         substr(trim(body, {SPACE}), 1, {c.MAX_SECTION_CHARS}) AS content,
         'Handbook ' || source AS domain, source AS source_name, 'docs/' || doc_id || '.md' AS file_path,
         length(marks) AS level, position,
         source || '|docs/' || doc_id || '.md|' || position AS sid
  FROM cut WHERE length(trim(body, {SPACE})) >= {c.MIN_SECTION_CHARS})"""


def wording_of(key: str) -> str:
    listed = ", ".join(text(t) for t in W.sections)
    return f"[{listed}][{hashed('wording', key)} % {len(W.sections)} + 1]"


SECTION_EXAMPLES = f"""
section_examples AS (
  SELECT 'section|' || sid AS example_id,
         replace(replace({wording_of('sid')}, '{{domain}}', domain), '{{title}}', title) AS question, content AS answer
  FROM sections WHERE {kept('spec_explanation', 'sid', CFG.weight('spec_explanation'))})"""

ROW_SQL["stream_jsonl"] = ROW_SQL["jsonl_dataset"]

MARKDOWN_SQL = {
    "md_sections": f"""
        WITH {SECTIONS} SELECT title, content, domain, source_name, file_path, level, position FROM sections""",
    "md_section_stats": f"""
        WITH {SECTIONS} SELECT source_name AS source, count(*) AS sections, count(*) FILTER (WHERE level = 2) AS h2,
          count(*) FILTER (WHERE level = 3) AS h3 FROM sections GROUP BY source_name""",
    "section_examples": f"WITH {SECTIONS}, {SECTION_EXAMPLES} SELECT * FROM section_examples",
}

# ---- code ----

HEAD_LINES = CODE_HEAD.count("\n") + 1


def lines(item: str) -> str:
    """sz rendered lines, i counting from 1."""
    return f"array_to_string(list_transform(range(1, sz + 1), lambda i: {item}), chr(10))"


TAB = "chr(9)"
STEP = (
    f"{TAB} || 'visit(' || i || ', \"{{ ' || p_name || ' \\\" }}\", ''}}'') // ' || i || ' }}' || {NL} || {TAB} "
    "|| '/* { */ visit(-' || i || ', i)'"
).replace("{{", "{").replace("}}", "}")
RECEIVER = "CASE recv WHEN 0 THEN 'x *Holder' || k WHEN 1 THEN 'x Holder' || k || '[T]' ELSE 'Holder' || k END"
SIGNATURE = f"""CASE kind
    WHEN 0 THEN 'func ' || name || '(in string, opt struct{{}}, cb func(n int) error) (int, error)'
    WHEN 1 THEN 'func (' || {RECEIVER} || ') ' || name || '(' || {NL} || {TAB} || 'ctx interface' || '{{}},' || {NL}
                || {TAB} || 'in []byte,' || {NL} || ') error'
    WHEN 2 THEN 'type ' || name || ' struct'
    WHEN 3 THEN 'type ' || name || ' interface'
    ELSE 'type ' || name || CASE WHEN sz % 2 = 0 THEN ' map[string]struct{{}}' ELSE ' func(a interface{{}}) error' END END"""
# Text between the braces, as rendered.
INNER = f"""CASE kind
    WHEN 0 THEN {NL} || {TAB} || 's := "brace {{ in \\" text"' || {NL} || {TAB} || 'r := ''{{''' || {NL} || {lines(STEP)}
                || {NL} || {TAB} || 'return ' || sz || ', nil' || {NL}
    WHEN 1 THEN {NL} || {lines(STEP)} || {NL} || {TAB} || 'return nil' || {NL}
    WHEN 2 THEN CASE WHEN sz % 10 = 0 THEN '' ELSE {NL} || {TAB} || '// note }}' || {NL}
      || {lines(f"{TAB} || 'Field' || i || ' string ' || chr(96) || 'json:" + '"{f' + "' || i || '" + '"' + "' || chr(96)")} || {NL} END
    WHEN 3 THEN {NL} || {lines(f"{TAB} || 'Call' || i || '(in interface" + "{}" + ") error'")} || {NL} END"""

UNITS = f"""
base AS (
  SELECT p_partkey AS k, p_type AS source, split_part(p_brand, '#', 2) AS brand, p_partkey // {PART_KEYS_PER_FILE} AS file_no,
         p_name, p_size::bigint AS sz, p_partkey % 5 AS kind, (p_partkey // 5) % 5 AS doc_kind, (p_partkey // 5) % 3 AS recv,
         (CASE WHEN p_partkey % 3 = 0 THEN lower(['Load', 'Apply', 'Spec', 'Port', 'Code'][p_partkey % 5 + 1])
               ELSE ['Load', 'Apply', 'Spec', 'Port', 'Code'][p_partkey % 5 + 1] END) || p_partkey AS name
  FROM part),
shaped AS (
  SELECT *, {SIGNATURE} AS signature, {INNER} AS inside,
    CASE doc_kind WHEN 1 THEN name || ' ' || p_name || ' {{sample' WHEN 2 THEN name || {GAP} || p_name
                  WHEN 3 THEN name || {NL} || p_name ELSE '' END AS doc,
    CASE doc_kind WHEN 1 THEN '// ' || name || ' ' || p_name || ' {{sample' || {NL}
                  WHEN 2 THEN '// ' || name || {NL} || '//' || {NL} || '// ' || p_name || {NL}
                  WHEN 3 THEN '// ' || name || {NL} || '// ' || p_name || {NL} ELSE '' END AS doc_block,
    [0, 1, 3, 4, 3][doc_kind + 1] AS lead
  FROM base),
written AS (
  SELECT *, CASE WHEN kind = 4 THEN signature
                 WHEN kind = 2 AND sz % 10 = 0 THEN signature || '{{}}'
                 ELSE signature || ' {{' || inside || '}}' END AS declared
  FROM shaped),
placed AS (
  SELECT *, lead + 1 + length(declared) - length(replace(declared, {NL}, '')) AS block_lines FROM written),
units AS (
  SELECT CASE kind WHEN 0 THEN 'func' WHEN 1 THEN 'method' WHEN 2 THEN 'type_struct' WHEN 3 THEN 'type_interface'
              ELSE 'type_alias' END AS kind,
         name, 'brand' || brand AS package_name,
         CASE WHEN brand::int % 5 = 0 THEN 'example.org/brand' || brand
              WHEN source <> 'PROMO' THEN 'example.org/' || lower(source) || '/pkg/brand_' || brand
              ELSE 'pkg/brand_' || brand END AS module_path,
         'pkg/brand_' || brand || '/part_' || file_no || '.go' AS file_path, source AS project_name,
         doc AS doc_comment, doc_block || declared AS code, signature,
         coalesce(trim(inside, {SPACE}), '') AS body,
         CASE WHEN kind = 1 THEN 'Holder' || k ELSE '' END AS receiver_type,
         ({HEAD_LINES} + coalesce(sum(block_lines + 1) OVER (PARTITION BY source, brand, file_no ORDER BY k
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + lead + 1)::bigint AS line_number,
         k % 3 <> 0 AS exported, sz
  FROM placed WHERE brand NOT IN ('22', '23', '24', '25')),
sized AS (
  SELECT *, project_name || '|' || file_path || '|' || line_number AS uid FROM units
  WHERE length(code) BETWEEN {CFG.min_code_chars} AND {CFG.max_code_chars})"""
UNIT_COLUMNS = (
    "kind, name, package_name, module_path, file_path, project_name, doc_comment, code, signature, body, "
    "receiver_type, line_number, exported"
)
LOCATED = fill(W.located, file="file_path", package="package_name")
EXPLAIN = f"""
explain AS (
  SELECT 'code|' || uid || '|code_explanation' AS example_id,
    {fill(W.explain, entity=f"(CASE WHEN kind = 'method' THEN {fill(W.method, name='name', receiver='receiver_type')} ELSE {fill(W.function, name='name')} END)", module='module_path', project='project_name')}
      || {GAP} || {fenced('code')} AS question,
    doc_comment || {GAP} || {LOCATED} || {GAP} || {fill(W.signature, signature='signature')} AS answer
  FROM sized WHERE kind IN ('func', 'method') AND doc_comment <> '')"""
COMPLETE = f"""
complete AS (
  SELECT 'code|' || uid || '|code_completion' AS example_id,
    {text(W.complete)} || {GAP} || {fenced("(substr(code, 1, length(code) - length(declared)) || signature || ' {')")} AS question,
    {fenced('body')} AS answer
  FROM (SELECT *, CASE WHEN doc_comment = '' THEN code ELSE substr(code, strpos(code, {NL} || 'func ') + 1) END AS declared FROM sized)
  WHERE kind IN ('func', 'method') AND length(body) >= {c.MIN_BODY_CHARS}
    AND {kept('code_completion', 'uid', CFG.weight('code_completion'))})"""
TYPE_DOC = f"""
type_doc AS (
  SELECT 'code|' || uid || '|type_documentation' AS example_id,
    {fill(W.describe_type, name='name', module='module_path', project='project_name')} || {GAP} || {fenced('code')} AS question,
    doc_comment || {GAP} || {LOCATED} || CASE WHEN body = '' THEN '' ELSE {GAP} ||
      {fill(W.members, count='sz', label=f"(CASE WHEN kind = 'type_struct' THEN '{W.fields_label}' ELSE '{W.methods_label}' END)")} END AS answer
  FROM sized WHERE kind LIKE 'type_%' AND doc_comment <> ''
    AND {kept('type_documentation', 'uid', CFG.weight('type_documentation'))})"""
FIRST_LINE = "file_path || '|' || lpad(line_number::varchar, 12, '0')"
PACKAGES = f"""
packed AS (
  SELECT project_name, module_path, package_name, count(*) AS n,
    count(*) FILTER (WHERE exported AND kind LIKE 'type_%') AS n_types,
    count(*) FILTER (WHERE exported AND kind IN ('func', 'method')) AS n_functions,
    arg_min(doc_comment, (CASE WHEN kind = 'func' AND name = 'init' THEN '' ELSE '|' END) || {FIRST_LINE}) FILTER (WHERE doc_comment <> '') AS doc,
    list_sort(list(DISTINCT file_path)) AS paths,
    list(name ORDER BY file_path, line_number) FILTER (WHERE exported AND kind LIKE 'type_%') AS types,
    list(name ORDER BY file_path, line_number) FILTER (WHERE exported AND kind IN ('func', 'method')) AS functions
  FROM units GROUP BY project_name, module_path, package_name),
overview AS (
  SELECT 'package|' || project_name || '|' || module_path || '|' || package_name AS example_id,
    {fill(W.overview, module='module_path', project='project_name')} AS question,
    coalesce(substr(doc, 1, {c.MAX_PACKAGE_DOC_CHARS}),
             {fill(W.overview_fallback, package='package_name', project='project_name', module='module_path')}) || {GAP}
    || {fill(W.files, names=f"array_to_string(list_transform(paths[1:{c.MAX_PACKAGE_FILES}], lambda p: string_split(p, '/')[-1]), ', ')")}
    || CASE WHEN n_types > 0 THEN {NL} || {fill(W.types, count='n_types', names=f"array_to_string(types[1:{c.MAX_PACKAGE_NAMES}], ', ')")} ELSE '' END
    || CASE WHEN n_functions > 0 THEN {NL} || {fill(W.functions, count='n_functions', names=f"array_to_string(functions[1:{c.MAX_PACKAGE_NAMES}], ', ')")} ELSE '' END AS answer
  FROM packed WHERE n >= {c.MIN_PACKAGE_UNITS})"""

CODE_SQL = {
    "code_files": f"""
        SELECT DISTINCT p_type AS source, 'pkg/brand_' || split_part(p_brand, '#', 2) || '/part_' || (p_partkey // {PART_KEYS_PER_FILE}) || '.go' AS path
        FROM part WHERE split_part(p_brand, '#', 2) NOT IN ('22', '23', '24', '25')""",
    "code_units_all": f"WITH {UNITS} SELECT {UNIT_COLUMNS} FROM units",
    "unit_sink": f"""WITH {UNITS} SELECT {UNIT_COLUMNS.replace('body, ', '').replace('line_number, ', '')} FROM units""",
    "code_unit_stats": f"""
        WITH {UNITS} SELECT project_name AS source, count(*) AS units, count(*) FILTER (WHERE kind = 'func') AS funcs,
          count(*) FILTER (WHERE kind = 'method') AS methods, count(*) FILTER (WHERE kind = 'type_struct') AS structs,
          count(*) FILTER (WHERE kind = 'type_interface') AS interfaces, count(*) FILTER (WHERE exported) AS exported
        FROM units GROUP BY project_name""",
    "explain_code": f"WITH {UNITS}, {EXPLAIN} SELECT * FROM explain",
    "complete_code": f"WITH {UNITS}, {COMPLETE} SELECT * FROM complete",
    "document_type": f"WITH {UNITS}, {TYPE_DOC} SELECT * FROM type_doc",
    "package_overview": f"WITH {UNITS}, {PACKAGES} SELECT * FROM overview",
    "wide_packages": f"""
        WITH base AS (SELECT p_partkey AS k, p_type, p_name, p_partkey % 997 = 0 AND length(p_type) % 2 = 0 AS init FROM part),
        units AS (
          SELECT CASE WHEN init THEN 'func' ELSE ['func', 'method', 'type_struct', 'type_interface', 'type_alias'][k % 5 + 1] END AS kind,
            CASE WHEN init THEN 'init' ELSE 'N' || k END AS name, 'wide' AS package_name,
            'example.org/' || lower(p_type) AS module_path,
            'wide/' || CASE WHEN init THEN 'z' ELSE 'f' END || lpad((k % 40)::varchar, 2, '0') || '.go' AS file_path,
            p_type AS project_name, CASE WHEN init OR k % 3 = 0 THEN 'About ' || p_name || ' ' || k ELSE '' END AS doc_comment,
            k AS line_number, NOT init AND k % 7 <> 0 AS exported
          FROM base), {PACKAGES}
        SELECT * FROM overview""",
}

# ---- paths, sources ----


def chosen(values: list[str], number: str) -> str:
    return f"[{', '.join(text(v) for v in values)}][({number}) % {len(values)} + 1]"


FOLDERS = ["vendor/", "a/vendor/b/", "hack/", "docs/.github/", "docs/", "", "vendored/", "testdata/"]
NAMES = ["CHANGELOG.md", "x_test.go", "mock_a.go", "a.pb.go", "main.go", "README.MD", "Authors-list.md"]

PATH_SQL = {
    "module_lookup": r"""
        WITH pages_at AS (
          SELECT page_id, string_split(regexp_extract(url, '^[a-z]+://([^?#]*)', 1), '/') AS p FROM pages),
        place AS (SELECT page_id, p[1] AS host, p[2] AS lang, p[3] AS num FROM pages_at),
        hosts AS (SELECT DISTINCT host FROM place WHERE page_id % 3 = 0),
        deeper AS (SELECT DISTINCT host, lang FROM place WHERE page_id % 2 = 0)
        SELECT page_id, CASE WHEN d.host IS NOT NULL THEN 'mod.' || host || '/' || lang || '/' || num
                             WHEN h.host IS NOT NULL THEN 'mod.' || host || '/' || lang || '/' || num
                             ELSE host || '/' || lang || '/' || num END AS module_path
        FROM place LEFT JOIN hosts h USING (host) LEFT JOIN deeper d USING (host, lang)""",
    "source_attributes": """
        SELECT doc_id, source, 'spec' AS type,
               CASE WHEN substr(source, 4)::int % 2 = 1 THEN 'Handbook ' || source ELSE source END AS domain
        FROM documents WHERE substr(source, 4)::int < 20""",
    "path_filters": f"""
        WITH place AS (
          SELECT page_id, {chosen(FOLDERS, 'page_id')} AS folder, {chosen(NAMES, f'page_id // {len(FOLDERS)}')} AS name FROM pages),
        judged AS (
          SELECT page_id, folder || name AS path, folder, name,
                 folder IN ('vendor/', 'a/vendor/b/', 'hack/') AS pruned_code,
                 folder IN ('vendor/', 'a/vendor/b/', 'docs/.github/') AS pruned_md
          FROM place)
        SELECT page_id, path,
               NOT pruned_code AND (name = 'main.go' OR (folder = '' AND name IN ('mock_a.go', 'a.pb.go'))) AS is_code,
               NOT pruned_code AND folder <> 'testdata/' AND name IN ('main.go', 'x_test.go') AS is_code_at_root,
               NOT pruned_md AND name = 'README.MD' AS is_markdown
        FROM judged""",
}
# ---- sampling ----

ORDER = f"{hashed('order', 'doc_id')}, doc_id::varchar"
SAMPLING_SQL = {
    "weighted_keep": f"SELECT doc_id, source FROM documents WHERE {kept('keep', 'doc_id', q.KEEP_WEIGHT)}",
    "template_choice": f"SELECT doc_id, {wording_of('doc_id')} AS wording FROM documents",
    "cap_per_source": f"""
        SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source
          ORDER BY {hashed('cap', 'doc_id')}, doc_id::varchar) AS r FROM documents) WHERE r <= {q.CAP_PER_SOURCE}""",
    "cap_total": f"""
        SELECT doc_id, source FROM documents ORDER BY {hashed('cap', 'doc_id')}, doc_id::varchar LIMIT {q.CAP_TOTAL}""",
    "prefix_cap": f"SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT {q.PREFIX_ROWS}",
    "holdout_split": split_of("doc_id", "documents", "doc_id, source"),
    "seeded_order": f"SELECT doc_id, source, row_number() OVER (ORDER BY {ORDER}) - 1 AS position FROM documents",
}

# ---- whole corpus ----

CHAT_TEXT = (
    "'<|im_start|>system' || chr(10) || " + PROMPT + " || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || question "
    "|| '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || answer || '<|im_end|>' || chr(10)"
)


def _triples(name: str, origin: str, example_type: str) -> str:
    return f"SELECT example_id, '{origin}' AS origin, '{example_type}' AS example_type, {CHAT_TEXT} AS text FROM {name}"


ALL = f"""
{UNITS}, {EXPLAIN}, {COMPLETE}, {TYPE_DOC}, {PACKAGES}, {SECTIONS}, {SECTION_EXAMPLES}, {TURNS}, {RENDERED},
qa AS ({pairs('qa')}),
everything AS (
  {_triples('explain', 'code', 'code_explanation')}
  UNION ALL {_triples('complete', 'code', 'code_completion')}
  UNION ALL {_triples('type_doc', 'code', 'type_documentation')}
  UNION ALL {_triples('overview', 'code', 'package_overview')}
  UNION ALL {_triples('section_examples', 'section', 'spec_explanation')}
  UNION ALL {_triples('qa', 'qa', 'qa')}
  UNION ALL SELECT example_id, 'chats', 'messages', text FROM rendered)"""
DATASETS = f"""
dataset_rows AS (
  SELECT origin, {CHAT_TEXT} AS text FROM (
    SELECT 'capped' AS origin, question, answer FROM ({capped_pairs('capped', '0, 4', 'go', q.CAP_PAIRS)})
    UNION ALL SELECT 'other', question, answer FROM ({pairs('other')}) WHERE turn % 10 = 2
    UNION ALL SELECT 'plain', question, answer FROM ({pairs('plain')}) WHERE turn % 10 = 6))"""
CORPUS_SQL = {
    "origin_totals": f"""
        WITH {ALL} SELECT CASE WHEN grouping(origin) = 1 THEN 'total' ELSE origin END AS origin, count(*) AS examples
        FROM everything GROUP BY ROLLUP (origin)""",
    "corpus_build": f"""
        WITH {ALL} SELECT example_id, origin, example_type, split, text FROM ({split_of('example_id', 'everything')})""",
    "corpus_job": f"WITH {ALL} SELECT text FROM everything WHERE origin <> 'chats'",
    "corpus_datasets": f"""
        WITH {ALL}, {DATASETS} SELECT text FROM everything WHERE origin <> 'qa'
        UNION ALL SELECT text FROM dataset_rows""",
    "corpus_counts": f"""
        WITH {ALL}, {DATASETS}, made AS (
          SELECT origin FROM everything WHERE origin <> 'qa' UNION ALL SELECT origin FROM dataset_rows),
        total AS (SELECT count(*) AS n, greatest(1, floor({c.VALIDATION_SHARE} * count(*))::bigint) AS val FROM made)
        SELECT 'examples' AS part, CASE WHEN grouping(origin) = 1 THEN 'total' ELSE origin END AS name, count(*) AS rows
        FROM made GROUP BY ROLLUP (origin)
        UNION ALL SELECT 'written', 'train', n - val FROM total
        UNION ALL SELECT 'written', 'val', val FROM total
        UNION ALL SELECT 'written', 'units', count(*) FROM units
        UNION ALL SELECT 'files', 'code_files', count(DISTINCT (p_type, p_brand, p_partkey // {PART_KEYS_PER_FILE})) FROM part
        UNION ALL SELECT 'files', unnest(['unbalanced_files', 'unclosed_declarations', 'undecodable_files']), 0""",
    "corpus_stats": f"""
        WITH {UNITS}, {SECTIONS}
        SELECT 'units' AS what, count(DISTINCT project_name) AS sources, count(*) AS found FROM units
        UNION ALL SELECT 'sections', count(DISTINCT source_name), count(*) FROM sections""",
}

# ---- text helpers, files, logs ----

# Words of the rendered names, from the words they were made of.
TEXT_SQL = {
    "camel_words": """
        WITH named AS (
          SELECT p_partkey, p_name, array_to_string(list_transform(string_split(p_name, ' '),
            lambda w: upper(w[1]) || w[2:]), '') AS joined FROM part)
        SELECT p_partkey, joined || CASE WHEN p_partkey % 2 = 0 THEN 'HTTPServer2Go' ELSE 'ID' END AS name,
               p_name || CASE WHEN p_partkey % 2 = 0 THEN ' http server2 go' ELSE ' id' END AS words
        FROM named""",
    "strip_text": f"SELECT doc_id, trim(text, {SPACE}) AS stripped FROM documents",
    "line_prefix": """
        SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)),
          lambda l: CASE WHEN l = '' THEN '//' ELSE '// ' || l END), chr(10)) AS commented FROM documents""",
    "decode_text": "SELECT doc_id, text || chr(65533) || 'A' AS decoded FROM documents",
    "tree_scan": """
        SELECT 'source=' || source AS dir, line, count(*) AS n
        FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE line <> '' GROUP BY ALL""",
    "tree_corpus": f"""
        WITH {UNITS}, {SECTIONS},
        moved(package_name, here, there) AS (VALUES
          ('brand21', 'pkg/brand_21', 'pkg/_brand_21'), ('brand31', 'pkg/brand_31', '.ci/brand_31'),
          ('brand41', '/part', '/_part'), ('brand32', '/part', '/.part'))
        SELECT 'unit' AS what, project_name AS source, replace(file_path, coalesce(here, '?'), coalesce(there, '?')) AS path,
          replace(module_path, coalesce(here, '?'), coalesce(there, '?')) AS owner, kind, name, line_number AS place
        FROM units LEFT JOIN moved USING (package_name)
        UNION ALL SELECT DISTINCT 'unit', p_type, 'pkg/open.go',
          CASE WHEN p_type = 'PROMO' THEN 'pkg' ELSE 'example.org/' || lower(p_type) || '/pkg' END, 'func', 'Kept', 8 FROM part
        UNION ALL SELECT 'section', 'handbook', source_name || '/' || CASE WHEN file_path LIKE '%3.md'
            THEN '_more/' || file_path[6:-4] || '.MD' ELSE file_path END, 'handbook', 'h' || level, title, position FROM sections""",
    "tree_faults": f"""
        WITH files AS (SELECT DISTINCT p_type, p_brand, p_partkey // {PART_KEYS_PER_FILE} AS n FROM part),
        planted AS (SELECT count(DISTINCT p_type) AS n FROM part)
        SELECT 'code_files' AS what, (SELECT count(*) FROM files) + 2 * n AS files FROM planted
        UNION ALL SELECT 'undecodable_files', count(*) FROM files WHERE p_brand = 'Brand#12'
        UNION ALL SELECT 'unbalanced_files', n FROM planted
        UNION ALL SELECT 'unclosed_declarations', n FROM planted
        UNION ALL SELECT 'oversized_files', n FROM planted
        UNION ALL SELECT unnest(['unreadable_files', 'unreadable_folders']), 0""",
}

METRICS = """
lines AS (
  SELECT user_id % 10 AS run, event_id AS line_no, event_type, value, props FROM events WHERE event_type <> 'error'),
metrics AS (
  SELECT run, line_no, CASE WHEN event_type IN ('view', 'click') THEN line_no END AS iteration,
    CASE WHEN event_type = 'view' THEN printf('%.2f', value)::double END AS train_loss,
    CASE WHEN event_type = 'view' THEN printf('%.2f', value * 2)::double END AS it_per_sec,
    CASE WHEN event_type = 'click' THEN printf('%.2f', value)::double END AS val_loss,
    CASE WHEN event_type NOT IN ('view', 'click') THEN 'Saved ' || props END AS message
  FROM lines)"""
LOG_SQL = {
    "log_metrics": f"WITH {METRICS} SELECT * FROM metrics",
    "stream_log_metrics": f"WITH {METRICS} SELECT iteration, train_loss, it_per_sec, val_loss, message FROM metrics",
    "stream_log_progress": f"""
        WITH {METRICS}, numbered AS (
          SELECT user_id % 10 AS run, event_id AS line_no,
            row_number() OVER (PARTITION BY user_id % 10 ORDER BY event_id) AS line FROM events)
        SELECT run, line, iteration,
          iteration - coalesce(lag(iteration) OVER (PARTITION BY run ORDER BY line_no), 0) AS advance
        FROM metrics JOIN numbered USING (run, line_no) WHERE iteration IS NOT NULL""",
    "log_progress": f"""
        WITH {METRICS} SELECT run, line_no, iteration,
          iteration - coalesce(lag(iteration) OVER (PARTITION BY run ORDER BY line_no), 0) AS advance
        FROM metrics WHERE iteration IS NOT NULL""",
}

ORACLE: dict[str, str] = {
    **CHAT_SQL, **ROW_SQL, **MARKDOWN_SQL, **CODE_SQL, **PATH_SQL, **SAMPLING_SQL, **CORPUS_SQL, **TEXT_SQL, **LOG_SQL,
}
