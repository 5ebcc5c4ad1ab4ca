"""The registered queries as SQL over the same tables.

Derivations follow ``bindings`` column by column. Extraction queries state the
expected rows from the columns that the source text was made of.
"""

from __future__ import annotations

from driftspark.operators import prompts, style

NL = "chr(10)"
TOKENS = "'[A-Za-z0-9_]+'"

# Bindings

CODE_DOCS = """code_docs AS (
  SELECT doc_id, source AS repo, text, n_chars,
         concat('src/', source, '/', doc_id, CASE lang WHEN 'en' THEN '.ts' WHEN 'fr' THEN '.test.ts'
                WHEN 'de' THEN '.py' ELSE '.JSX' END) AS path,
         CASE lang WHEN 'de' THEN 'python' WHEN 'es' THEN 'javascript' ELSE 'typescript' END AS language
  FROM documents)"""
SNAPSHOTS = f"""{CODE_DOCS},
old_files AS (SELECT *, text AS content FROM code_docs WHERE doc_id NOT IN
  (SELECT doc_id FROM labels WHERE quality = 0 AND toxic = 0)),
new_files AS (SELECT *, CASE WHEN n_chars > 1500 THEN concat(text, {NL}, 'Reviewed for ', repo) ELSE text END AS content
  FROM code_docs WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
file_pairs AS (
  SELECT coalesce(o.repo, n.repo) AS repo, coalesce(o.path, n.path) AS path,
         CASE WHEN o.path IS NULL THEN 'added' WHEN n.path IS NULL THEN 'deleted' ELSE 'modified' END AS change_type,
         coalesce(o.language, n.language) AS language, coalesce(n.content, '') AS content,
         o.content AS previous_content, n.content IS DISTINCT FROM o.content AS differs
  FROM old_files o FULL OUTER JOIN new_files n ON o.repo = n.repo AND o.path = n.path),
changes AS (SELECT * EXCLUDE (differs) FROM file_pairs WHERE differs)"""

PARTS = """parts AS (
  SELECT p_brand AS repo, concat('src/', lower(p_type), '.ts') AS path, CAST(p_partkey AS INTEGER) AS ordinal,
         replace(p_name, ' ', '_') AS name, CASE WHEN p_size >= 30 THEN 'class' ELSE 'function' END AS kind,
         p_size < 35 AS is_public, p_type, p_name, p_size FROM part),
old_apis AS (SELECT *, concat('function ', name, '(size: number)') AS signature, 1 AS n_params, 'number' AS size_type,
         CAST(NULL AS VARCHAR) AS return_type, p_name AS documentation FROM parts WHERE p_size <= 40),
new_apis AS (SELECT *, concat('function ', name, '(size: ', CASE p_type WHEN 'ECONOMY' THEN 'string' ELSE 'number' END, ')') AS signature,
         CASE p_type WHEN 'SMALL' THEN 2 ELSE 1 END AS n_params,
         CASE p_type WHEN 'ECONOMY' THEN 'string' ELSE 'number' END AS size_type,
         CASE p_type WHEN 'STANDARD' THEN 'void' END AS return_type,
         CASE p_type WHEN 'PROMO' THEN concat(p_name, ' (revised)') ELSE p_name END AS documentation
  FROM parts WHERE p_size >= 6)"""
ADDED = """added AS (SELECT n.* FROM new_apis n WHERE NOT EXISTS (SELECT 1 FROM old_apis o
  WHERE o.repo = n.repo AND o.path = n.path AND o.name = n.name))"""
REMOVED = """removed AS (SELECT o.* FROM old_apis o WHERE NOT EXISTS (SELECT 1 FROM new_apis n
  WHERE o.repo = n.repo AND o.path = n.path AND o.name = n.name))"""
MATCHED = """last_new AS (SELECT * FROM new_apis
  QUALIFY row_number() OVER (PARTITION BY repo, path, name ORDER BY ordinal DESC) = 1),
matched AS (
  SELECT o.repo, o.path, o.name, o.kind, o.ordinal AS old_ordinal, n.ordinal AS new_ordinal,
         o.is_public AS old_public, n.is_public AS new_public, n.kind AS new_kind,
         o.signature AS old_signature, n.signature AS new_signature,
         [x FOR x IN [
           CASE WHEN o.signature <> n.signature THEN {'type': 'signature', 'description':
             concat('Signature changed from "', o.signature, '" to "', n.signature, '"')} END,
           CASE WHEN o.n_params <> n.n_params THEN {'type': 'parameters', 'description':
             concat('Parameter count changed from ', o.n_params, ' to ', n.n_params)}
                WHEN o.size_type <> n.size_type THEN {'type': 'parameters', 'description': 'Parameter "size" changed'} END,
           CASE WHEN o.return_type IS DISTINCT FROM n.return_type THEN {'type': 'return_type', 'description':
             concat('Return type changed from "', coalesce(o.return_type, 'void'), '" to "', coalesce(n.return_type, 'void'), '"')} END,
           CASE WHEN o.documentation <> n.documentation THEN {'type': 'documentation', 'description': 'Documentation was updated'} END
         ] IF x IS NOT NULL] AS details
  FROM old_apis o JOIN last_new n ON o.repo = n.repo AND o.path = n.path AND o.name = n.name)"""
API_DIFF = f"""{PARTS}, {ADDED}, {REMOVED}, {MATCHED},
api_diff AS (
  SELECT repo, path, 'added' AS kind, name, ordinal, 0 AS n_changes, is_public AS breaking_public, is_public AS any_public,
         FALSE AS hard, FALSE AS soft, signature AS new_signature, kind AS api_kind, ordinal AS list_ordinal, signature AS old_signature, '' AS reasons FROM added
  UNION ALL SELECT repo, path, 'removed', name, ordinal, 0, is_public, is_public, FALSE, FALSE, signature, kind, ordinal, signature, '' FROM removed
  UNION ALL SELECT repo, path, CASE WHEN len(details) > 0 THEN 'modified' ELSE 'unchanged' END, name, old_ordinal, len(details),
         old_public, old_public OR new_public,
         len([d FOR d IN details IF d.type IN ('parameters', 'return_type')]) > 0,
         len([d FOR d IN details IF d.type <> 'documentation']) > 0, new_signature, new_kind, old_ordinal, old_signature,
         list_aggregate([d.description FOR d IN details], 'string_agg', ', ') FROM matched),
flags AS (SELECT repo, path,
    bool_or(breaking_public AND (kind = 'removed' OR (kind = 'modified' AND hard))) AS breaking,
    bool_or(breaking_public AND kind = 'added') AS major,
    bool_or(breaking_public AND kind = 'modified' AND soft) AS minor,
    bool_or(any_public AND kind <> 'unchanged') AS public,
    count(*) FILTER (WHERE kind <> 'unchanged') AS n_changed
  FROM api_diff GROUP BY repo, path),
graded AS (SELECT f.repo, f.path,
    CASE WHEN breaking THEN 'breaking' WHEN major THEN 'major' WHEN minor THEN 'minor' ELSE 'patch' END AS severity,
    CASE WHEN breaking THEN 3 WHEN major THEN 2 WHEN minor THEN 1 ELSE 0 END AS severity_rank,
    coalesce(public, FALSE) AS is_public_change, coalesce(n_changed, 0) AS n_changed
  FROM (SELECT repo, path FROM old_apis UNION SELECT repo, path FROM new_apis) f LEFT JOIN flags g
    ON f.repo = g.repo AND f.path = g.path)"""

READABLE_PARTS = """p AS (SELECT p_brand AS repo, concat('src/part_', p_partkey, '.ts') AS path,
  CAST(p_partkey AS VARCHAR) AS k, p_name, p_type, p_size FROM part WHERE p_type <> 'PROMO' AND p_type <> 'LARGE'
  UNION ALL SELECT p_brand, concat('src/part_', p_partkey, '.py'), CAST(p_partkey AS VARCHAR), p_name, p_type, p_size
  FROM part WHERE p_type = 'LARGE')"""

# A part's file changes by its size, or by a bracket that only one version lacks.
CHANGED_PARTS = """changed_parts AS (
  SELECT p_brand AS repo, concat('src/part_', p_partkey, CASE p_type WHEN 'LARGE' THEN '.py' ELSE '.ts' END) AS path, p_size,
         CASE WHEN p_type = 'LARGE' THEN 'unsupported language python'
              WHEN p_type = 'PROMO' OR (p_type = 'SMALL' AND p_size % 5 = 0) THEN 'unbalanced brackets' END AS problem
  FROM part WHERE p_size > 25 OR p_size < 10 OR (p_type = 'PROMO' AND p_size % 2 = 1) OR (p_type = 'SMALL' AND p_size % 5 = 0))"""

SEARCH = f"""words AS (SELECT item_id, unnest(ws) AS name, generate_subscripts(ws, 1) - 1 AS pos
  FROM (SELECT item_id, regexp_extract_all(text, {TOKENS}) AS ws FROM benchmark)),
apis AS (SELECT concat('corpus', item_id % 5) AS repo, concat('src/bench/', item_id, '.ts') AS path, name, CAST(pos AS INTEGER) AS ordinal,
         length(name) <> 7 AS is_public FROM words QUALIFY row_number() OVER (PARTITION BY item_id % 5, name ORDER BY item_id, pos) = 1)"""
PROSE = "docs AS (SELECT concat('corpus', doc_id % 5) AS repo, concat('docs/', source, '/', doc_id, '.md') AS path, text AS content FROM documents)"
MARKDOWN = f"""docs AS (SELECT concat('corpus', doc_id % 5) AS repo, concat('docs/', source, '/', doc_id, '.md') AS path, source, lang, text, doc_id,
  concat('# Doc ', doc_id, {NL}, {NL}, text, {NL}, {NL}, '```', lang, {NL}, text, {NL}, '```', {NL},
    CASE lang WHEN 'fr' THEN concat({NL}, '```', {NL}, '```', {NL}) WHEN 'es' THEN concat({NL}, '```js', {NL}, 'open (x)')
      WHEN 'de' THEN concat({NL}, 'You can pass {{Type}} here.', {NL}, '* item', {NL}) ELSE '' END) AS content,
  len(string_split(text, {NL})) AS n FROM documents)"""
REFERENCES = f"""doc_lines AS (SELECT repo, path, ls, generate_subscripts(ls, 1) AS line_no, unnest(ls) AS line
  FROM (SELECT repo, path, string_split(content, {NL}) AS ls FROM docs)),
doc_tokens AS (SELECT repo, path, ls, line_no, unnest(list_distinct(regexp_extract_all(line, {TOKENS}))) AS token FROM doc_lines),
refs AS (SELECT t.repo, t.path, t.line_no,
    concat_ws({NL}, CASE WHEN line_no > 1 THEN ls[line_no - 1] END, ls[line_no], ls[line_no + 1]) AS context,
    'name' AS reference_type, a.name AS api_name, a.path AS api_path, a.ordinal AS api_ordinal
  FROM doc_tokens t JOIN apis a ON a.repo = t.repo AND a.name = t.token)"""
BLOCKS = """blocks AS (
  SELECT path, repo, lang AS language, n + 5 AS start_line, 2 * n + 4 AS end_line, text AS code FROM docs
  UNION ALL SELECT path, repo, '', 2 * n + 8, 2 * n + 7, '' FROM docs WHERE lang = 'fr')"""
EXAMPLES = f"""{BLOCKS},
block_tokens AS (SELECT *, unnest(list_distinct(regexp_extract_all(code, {TOKENS}))) AS token FROM blocks),
examples AS (SELECT b.repo, b.path, b.language, b.start_line, b.end_line, b.code, a.name AS api_name, a.path AS api_path, a.ordinal AS api_ordinal
  FROM block_tokens b JOIN apis a ON a.repo = b.repo AND a.name = b.token)"""
HITS = f"{SEARCH}, {MARKDOWN}, {REFERENCES}, {EXAMPLES}"
MISSING = f"""{HITS}, missing AS (SELECT * FROM apis WHERE is_public
  AND (repo, name) NOT IN (SELECT (repo, api_name) FROM refs) AND (repo, name) NOT IN (SELECT (repo, api_name) FROM examples))"""

PAIRS = f"""pairs AS (SELECT source AS repo, concat('docs/', doc_id, '.md') AS path, lang, text,
  string_split(text, {NL}) AS ls, len(string_split(text, {NL})) AS n FROM documents)"""
RISKY = f"""{MARKDOWN}, risky AS (SELECT path, content AS original, CASE lang WHEN 'en' THEN content
  WHEN 'fr' THEN concat('  ', {NL}, ' ') WHEN 'de' THEN text ELSE concat('# T', {NL}, '```x``` and', {NL}, text) END AS updated FROM docs)"""
TURNS = """turns AS (SELECT concat('docs/', conv_id, '.md') AS path, CAST(turn AS INTEGER) AS attempt, text,
  concat('# Answer', chr(10), text) AS titled, CASE WHEN length(text) < 400 THEN 'timeout' END AS error
  FROM conversations WHERE role = 'assistant')"""
PARSED = f"""{TURNS}, parsed AS (SELECT path, attempt, error, attempt IN (1, 2) AS is_structured,
  CASE WHEN attempt <= 3 THEN titled ELSE text END AS updated_content,
  CASE attempt WHEN 1 THEN 'why' WHEN 2 THEN 'No reasoning provided' ELSE 'Parsed from unstructured response' END AS reasoning
  FROM turns)"""
REVIEWS = f"""labelled AS (SELECT source AS repo, concat('docs/', source, '/', doc_id, '.md') AS path, CAST(doc_id AS INTEGER) AS seq,
  text, lang, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)),
decided AS (SELECT *, CASE WHEN n_chars < 300 THEN NULL WHEN toxic = 1 THEN 'reject' WHEN quality = 1 THEN 'approve' ELSE 'edit' END AS raw_action,
  toxic = 1 AND n_chars > 2500 AS stop FROM labelled),
stops AS (SELECT repo, min(seq) AS stop_seq FROM decided WHERE coalesce(raw_action, 'reject') = 'reject' AND stop GROUP BY repo),
resolved AS (SELECT d.*, CASE WHEN seq > stop_seq THEN 'reject' ELSE coalesce(raw_action, 'reject') END AS action,
  CASE WHEN seq > stop_seq THEN NULL WHEN raw_action = 'edit' THEN CASE WHEN n_chars > 1000 THEN concat('Edited: ', d.repo) ELSE '' END END AS edited_content,
  CASE WHEN seq > stop_seq THEN 'Skipped by user' WHEN raw_action IS NULL THEN 'Cancelled by user' WHEN raw_action = 'reject' THEN 'off topic' END AS feedback
  FROM decided d LEFT JOIN stops s ON d.repo = s.repo),
approved AS (SELECT repo, path, seq, action, CASE WHEN action = 'edit' AND length(edited_content) > 0 THEN edited_content
  ELSE concat(text, {NL}, {NL}, 'Reviewed.') END AS final_content FROM resolved WHERE action IN ('approve', 'edit'))"""


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches(pattern: str, text: str) -> str:
    """Any document of the group matches; RE2's classes and borders are ASCII."""
    from driftspark.functions.patterns import SPACE

    return f"bool_or(regexp_matches({text}, {quote(pattern.replace(SPACE, chr(92) + 's'))}))"


def _listed(features, text: str) -> str:
    flags = ", ".join(
        f"CASE WHEN {_matches(LAZY_FENCE if n == '```' else p, text)} THEN {quote(label)} END" for p, n, label in features
    )
    return f"concat_ws('; ', {flags})"


LAZY_FENCE = r"```\w*\n[\s\S]*?\n```"
YOU, WE = r"(?i)\b(you|your)\b", r"(?i)\b(we|our|us)\b"
TONE = (
    f"CASE WHEN {_matches(YOU, 'content')} OR {_matches(style.IMPERATIVE, 'content')} THEN {quote(style.DIRECT)} "
    f"WHEN {_matches(WE, 'content')} THEN {quote(style.COLLABORATIVE)} ELSE {quote(style.FORMAL)} END"
)
FORMATTING = f"coalesce(nullif({_listed(style.FORMATTING, 'content')}, ''), {quote(style.PLAIN_FORMATTING)})"
CONVENTIONS = f"coalesce(nullif({_listed(style.CONVENTIONS, 'content')}, ''), {quote(style.PLAIN_CONVENTION)})"
EXAMPLE_PATTERNS = (
    f"concat_ws('; ', nullif({_listed([style.EXAMPLE_COMMENTS, style.EXAMPLE_IMPORTS], 'code')}, ''), "
    f"CASE WHEN {_matches(style.EXAMPLE_FUNCTIONS, 'code')} THEN {quote(style.WHOLE_FUNCTIONS)} ELSE {quote(style.SNIPPETS)} END)"
)
STYLE = f"""{MARKDOWN}, {BLOCKS},
by_corpus AS (SELECT concat(source, '/', lang) AS repo, content FROM docs),
corpus_blocks AS (SELECT concat(source, '/', lang) AS repo, code FROM blocks JOIN docs USING (path)),
patterns AS (SELECT repo, {EXAMPLE_PATTERNS} AS example_patterns FROM corpus_blocks GROUP BY repo),
guide AS (SELECT repo, {TONE} AS tone, {FORMATTING} AS formatting, {CONVENTIONS} AS conventions FROM by_corpus GROUP BY repo)"""

RAW_FENCE = quote(r"```[\s\S]*?```")
HEADER = quote(r"(?m)^#{1,6}\s+.+$")
ITEM = quote(r"(?m)^\s*[-*+]\s+")
VALID_FENCE = (
    "len(string_split(f, chr(10))) >= 2 AND starts_with(trim(string_split(f, chr(10))[1]), '```') "
    "AND trim(string_split(f, chr(10))[-1]) = '```'"
)
PROMPT_TEXT = f"""{MISSING},
ref_rows AS (SELECT path, string_agg(concat(i, '. Line ', line_no, ' (name): "', context, '"'), {NL} ORDER BY i) AS body, count(*) AS c
  FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY api_path, api_ordinal, line_no) AS i FROM refs) GROUP BY path),
ex_rows AS (SELECT path, string_agg(concat('### Example ', i, ' (Lines ', start_line, '-', end_line, ')', {NL}, '```', language, {NL}, code, {NL}, '```', {NL}), {NL} ORDER BY i) AS body, count(*) AS c
  FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY api_path, api_ordinal, start_line) AS i FROM examples) GROUP BY path),
sections AS (SELECT coalesce(r.path, e.path) AS path,
  CASE WHEN r.c > 0 THEN concat('## References Found', {NL}, {NL}, 'This documentation file contains ', r.c, ' reference(s) to the changed APIs:', {NL}, {NL}, r.body) ELSE '' END AS reference_section,
  CASE WHEN e.c > 0 THEN concat('## Code Examples Found', {NL}, {NL}, 'This documentation contains ', e.c, ' code example(s):', {NL}, {NL}, e.body) ELSE '' END AS example_section
  FROM ref_rows r FULL OUTER JOIN ex_rows e ON r.path = e.path),
facts AS (SELECT repo, {TONE} AS tone, {FORMATTING} AS formatting, replace({CONVENTIONS}, '; ', ', ') AS conventions,
  {CONVENTIONS} AS convention_list FROM docs GROUP BY repo),
pattern_facts AS (SELECT repo, {EXAMPLE_PATTERNS} AS example_patterns FROM blocks GROUP BY repo),
system_text AS (SELECT repo, concat_ws({NL}, {quote(prompts.INTRODUCTION)}, {quote(prompts.DUTIES)}, concat({NL}, 'Style Guidelines:'),
  concat('- Tone: ', tone), concat('- Formatting: ', formatting), concat('- Conventions: ', conventions), concat({NL}, 'Project Context:'),
  '- Language: TypeScript', '- Documentation Format: markdown', '- Custom Guidelines: Be brief') AS system, convention_list FROM facts),
named AS (SELECT path, api_path, api_ordinal, api_name FROM refs UNION SELECT path, api_path, api_ordinal, api_name FROM examples),
change_text AS (SELECT path, concat('### Added APIs', {NL}, {NL}, string_agg(concat('- **', api_name, '** (function): function ', api_name, '()'), {NL} ORDER BY api_path, api_ordinal)) AS change_section
  FROM named GROUP BY path)"""

ORACLE: dict[str, str] = {
    "changed_files": f"WITH {SNAPSHOTS} SELECT * FROM changes",
    "changed_files_in_scope": f"""WITH {SNAPSHOTS} SELECT repo, path, change_type, language FROM changes
      WHERE regexp_matches(path, '^src/(?:.+/)?[^/]*\\.ts$', 'i') AND NOT regexp_matches(path, '\\.test\\.ts$', 'i')
         OR regexp_matches(path, '\\.py$', 'i')""",
    "listed_files": f"""WITH {SNAPSHOTS} SELECT repo, path, change_type, length(content) AS n_chars FROM file_pairs
      WHERE regexp_extract(path, '/([0-9]+)\\.', 1) IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE quality = 1)""",
    "glob_matches": f"""WITH {SNAPSHOTS} SELECT repo, count(*) FILTER (WHERE path LIKE '%.ts') AS n_ts,
      count(*) FILTER (WHERE path LIKE '%.py') AS n_py, count(*) FILTER (WHERE repo LIKE '%1') AS n_flat,
      count(*) FILTER (WHERE path LIKE '%.JSX') AS n_deep,
      count(*) FILTER (WHERE path LIKE '%.py' OR (path LIKE '%.ts' AND path NOT LIKE '%.test.ts')) AS n_included
      FROM new_files GROUP BY repo""",
    "file_languages": f"WITH {SNAPSHOTS} SELECT language, count(*) AS n_files FROM old_files GROUP BY language",
    "diff_eligible_files": f"""WITH {SNAPSHOTS} SELECT repo, change_type, count(*) AS n_files FROM changes
      WHERE change_type = 'added' OR length(previous_content) > 0 GROUP BY repo, change_type""",
    "scanned_files": "SELECT 'tree' AS repo, source, doc_id, concat(text, chr(10)) AS content FROM documents WHERE text IS NOT NULL",
    "streamed_references": f"""WITH {SEARCH}, d AS (SELECT concat('corpus', doc_id % 5) AS repo, n_chars,
        concat('docs/', source, '/', doc_id, '.md') AS path, text,
        CASE WHEN n_chars > 1500 THEN concat(text, {NL}, 'Reviewed') ELSE text END AS revised FROM documents),
      docs AS (SELECT 0 AS batch, repo, path, string_split(text, {NL}) AS ls FROM d
        UNION ALL SELECT 1, repo, path, string_split(revised, {NL}) FROM d
        UNION ALL SELECT 2, repo, path, string_split(revised, {NL}) FROM d WHERE NOT coalesce(n_chars < 300, FALSE)),
      doc_lines AS (SELECT batch, repo, path, ls, generate_subscripts(ls, 1) AS line_no, unnest(ls) AS line FROM docs),
      doc_tokens AS (SELECT * EXCLUDE (line), unnest(list_distinct(regexp_extract_all(line, {TOKENS}))) AS token FROM doc_lines),
      touched AS (SELECT 0 AS batch, repo, path, name, 1 AS kind_rank FROM apis WHERE length(name) <= 9
        UNION ALL SELECT 1, repo, path, name, CASE WHEN length(name) > 9 THEN 1 WHEN length(name) < 6 THEN 2 ELSE 3 END
          FROM apis WHERE length(name) > 9 OR length(name) < 6 OR contains(name, 'th')
        UNION ALL SELECT 2, repo, path, name, 2 FROM apis
          WHERE length(name) >= 6 AND CAST(regexp_extract(path, '([0-9]+)', 1) AS INTEGER) % 3 = 0)
      SELECT t.batch, t.repo, t.path, line_no,
        concat_ws({NL}, CASE WHEN line_no > 1 THEN ls[line_no - 1] END, ls[line_no], ls[line_no + 1]) AS context,
        name AS api_name, a.path AS api_path, kind_rank
      FROM doc_tokens t JOIN touched a ON a.batch = t.batch AND a.repo = t.repo AND a.name = t.token""",
    "streamed_changes": f"""WITH files AS (SELECT source AS repo, concat('src/', doc_id, '.ts') AS path, text, n_chars,
        concat(text, {NL}, 'Reviewed') AS revised FROM documents)
      SELECT repo, path, 'added' AS change_type, 'typescript' AS language, text AS content, CAST(NULL AS VARCHAR) AS previous_content FROM files
      UNION ALL SELECT repo, path, 'modified', 'typescript', revised, text FROM files WHERE n_chars > 1500
      UNION ALL SELECT repo, path, 'deleted', 'typescript', '', text FROM files WHERE n_chars < 300""",
    "added_apis": f"WITH {PARTS}, {ADDED} SELECT repo, path, name, ordinal, signature FROM added",
    "removed_apis": f"WITH {PARTS}, {REMOVED} SELECT repo, path, name, ordinal, signature FROM removed",
    "matched_apis": f"WITH {PARTS}, {MATCHED} SELECT repo, path, name, old_ordinal, new_ordinal, len(details) AS n_changes FROM matched",
    "api_change_details": f"""WITH {PARTS}, {MATCHED} SELECT repo, path, name, ordinal, position, d.type AS type, d.description AS description
      FROM (SELECT repo, path, name, old_ordinal AS ordinal, generate_subscripts(details, 1) - 1 AS position, unnest(details) AS d FROM matched)""",
    "api_diff": f"WITH {API_DIFF} SELECT repo, path, kind, name, ordinal, n_changes FROM api_diff",
    "file_severity": f"WITH {API_DIFF} SELECT * FROM graded",
    "files_above_threshold": f"WITH {API_DIFF} SELECT repo, path, severity FROM graded WHERE severity_rank >= 2",
    "changed_api_list": f"""WITH {API_DIFF} SELECT repo, path, CASE kind WHEN 'added' THEN 1 WHEN 'removed' THEN 2 ELSE 3 END AS kind_rank,
      list_ordinal, name, new_signature AS signature FROM api_diff JOIN graded USING (repo, path)
      WHERE kind <> 'unchanged' AND severity_rank >= 2""",
    "extracted_functions": f"""WITH {READABLE_PARTS} SELECT repo, path, concat('f_', k) AS name,
        concat('function f_', k, '(a: string, b?: number, c? = ', p_size, '): Promise') AS signature, TRUE AS is_public,
        concat('*', {NL}, ' * ', p_name) AS documentation, 'Promise' AS return_type,
        6 AS start_line, 8 AS end_line, 7 AS start_column, 1 AS end_column FROM p
      UNION ALL SELECT repo, path, concat('g_', k), concat('function g_', k, '(x: number, ...rest: unknown): void'), TRUE, NULL, 'void',
        10, 10, 13, 67 + length(k) FROM p""",
    "extracted_constants": f"""WITH {READABLE_PARTS} SELECT repo, path, concat('c_', k) AS name, concat('const c_', k) AS signature, TRUE AS is_public,
        CAST(NULL AS VARCHAR) AS documentation, CAST(NULL AS VARCHAR) AS return_type,
        9 AS start_line, 9 AS end_line, 13 AS start_column, 20 + length(k) + length(p_name) AS end_column FROM p
      UNION ALL SELECT repo, path, concat('d_', k), concat('const d_', k), TRUE, NULL, NULL,
        9, 9, 22 + length(k) + length(p_name), 27 + 2 * length(k) + length(p_name) + length(CAST(p_size AS VARCHAR)) FROM p""",
    "extracted_classes": f"""WITH {READABLE_PARTS} SELECT repo, path, concat('K_', k) AS name,
        concat('class K_', k, ' {{ constructor(param); size(unit: string): number }}') AS signature, TRUE AS is_public,
        concat('* ', lower(p_type), ' part') AS documentation, CAST(NULL AS VARCHAR) AS return_type,
        12 AS start_line, 16 AS end_line, 7 AS start_column, 1 AS end_column FROM p""",
    "extracted_interfaces": f"""WITH {READABLE_PARTS} SELECT repo, path, concat('I_', k) AS name,
        concat('interface I_', k, ' {{ id: string; tags?: unknown; find(q: string): Promise }}') AS signature, TRUE AS is_public,
        CAST(NULL AS VARCHAR) AS documentation, CAST(NULL AS VARCHAR) AS return_type,
        17 AS start_line, 21 AS end_line, 7 AS start_column, 1 AS end_column FROM p""",
    "extracted_aliases": f"""WITH {READABLE_PARTS} SELECT repo, path, concat('T_', k) AS name,
        concat('type T_', k, ' = union type') AS signature, TRUE AS is_public,
        CAST(NULL AS VARCHAR) AS documentation, CAST(NULL AS VARCHAR) AS return_type,
        22 AS start_line, 22 AS end_line, 7 AS start_column, 27 + length(k) AS end_column FROM p""",
    "extracted_parameters": f"""WITH {READABLE_PARTS} SELECT repo, path, concat(f, '_', k) AS api, position, name, type, optional,
        CASE WHEN name = 'c' THEN CAST(p_size AS VARCHAR) END AS default_value
      FROM p CROSS JOIN (VALUES ('f', 0, 'a', 'string', FALSE), ('f', 1, 'b', 'number', TRUE), ('f', 2, 'c', NULL, TRUE),
        ('g', 0, 'x', 'number', FALSE), ('g', 1, '...rest', 'unknown', FALSE)) v(f, position, name, type, optional)""",
    "extracted_exports": f"""WITH {READABLE_PARTS} SELECT repo, path, concat(prefix, k) AS name, is_default
      FROM p CROSS JOIN (VALUES ('f_', FALSE), ('c_', FALSE), ('d_', FALSE), ('g_', FALSE), ('K_', FALSE), ('I_', FALSE),
        ('T_', FALSE), ('util_', FALSE), ('f_', TRUE)) v(prefix, is_default)""",
    "extracted_imports": f"""WITH {READABLE_PARTS} SELECT repo, path, 'react' AS source, concat('React,us_', k) AS specifiers, TRUE AS is_default FROM p
      UNION ALL SELECT repo, path, concat('./', lower(p_type)), concat('u', k), FALSE FROM p""",
    "unreadable_files": """SELECT p_brand AS repo, path, 'parse' AS stage, concat('Failed to parse ', path, ': ', problem) AS message FROM (
      SELECT p_brand, concat('src/part_', p_partkey, '.py') AS path, 'unsupported language python' AS problem FROM part WHERE p_type = 'LARGE'
      UNION ALL SELECT p_brand, concat('src/part_', p_partkey, '.ts'), 'unbalanced brackets' FROM part WHERE p_type = 'PROMO')""",
    "built_signatures": f"""WITH {PARTS} SELECT repo, path, ordinal, concat('function ', name, '(size: ', size_type,
        CASE WHEN n_params = 2 THEN ', unit?: string = "mm"' ELSE '' END, ')',
        CASE WHEN return_type IS NULL THEN '' ELSE concat(': ', return_type) END) AS signature FROM new_apis""",
    "source_drift": f"""WITH {CHANGED_PARTS} SELECT repo, path, CASE WHEN p_size > 25 THEN 'breaking' ELSE 'major' END AS severity, 1 AS n_changed
      FROM changed_parts WHERE problem IS NULL""",
    "unreadable_changes": f"""WITH {CHANGED_PARTS} SELECT repo, path, 'parse' AS stage, concat('Failed to parse ', path, ': ', problem) AS message
      FROM changed_parts WHERE problem IS NOT NULL""",
    "line_references": f"WITH {SEARCH}, {PROSE}, {REFERENCES} SELECT * FROM refs",
    "line_references_two_phase": f"WITH {SEARCH}, {PROSE}, {REFERENCES} SELECT * FROM refs",
    "code_examples": f"WITH {SEARCH}, {MARKDOWN}, {EXAMPLES} SELECT * EXCLUDE (repo) FROM examples",
    "missing_docs": f"WITH {MISSING} SELECT path, name, concat('function ', name, '()') AS signature FROM missing",
    "document_hits": f"""WITH {HITS} SELECT repo, path, sum(r)::BIGINT AS n_references, sum(1 - r)::BIGINT AS n_examples
      FROM (SELECT repo, path, 1 AS r FROM refs UNION ALL SELECT repo, path, 0 FROM examples) GROUP BY repo, path""",
    "affected_documents": f"""WITH {HITS}, r AS (SELECT path, string_agg(concat(line_no, ':', api_name), '|' ORDER BY api_path, api_ordinal, line_no) AS reference_list FROM refs GROUP BY path),
      e AS (SELECT path, string_agg(concat(language, ':', start_line, ':', end_line, ':', api_name), '|' ORDER BY api_path, api_ordinal, start_line) AS example_list FROM examples GROUP BY path)
      SELECT d.path, coalesce(reference_list, '') AS reference_list, coalesce(example_list, '') AS example_list, length(content) AS n_chars
      FROM docs d LEFT JOIN r USING (path) LEFT JOIN e USING (path) WHERE reference_list IS NOT NULL OR example_list IS NOT NULL""",
    "total_references": f"WITH {SEARCH}, {PROSE}, {REFERENCES} SELECT count(*) AS total_references FROM refs",
    "drifted_documents": f"""WITH {SEARCH}, {PROSE}, {REFERENCES} SELECT path, line_no, count(*) AS n_references,
      count(*) FILTER (WHERE length(api_name) > 9) AS n_added, count(*) FILTER (WHERE length(api_name) < 6) AS n_removed,
      count(*) FILTER (WHERE length(api_name) BETWEEN 6 AND 9) AS n_modified
      FROM refs WHERE length(api_name) > 9 OR length(api_name) < 6 OR contains(api_name, 'th') GROUP BY path, line_no""",
    "code_blocks": f"WITH {MARKDOWN}, {BLOCKS} SELECT path, language, start_line, end_line, code FROM blocks",
    "raw_fences": f"""WITH {RISKY}, fences AS (SELECT path, unnest(fs) AS f, generate_subscripts(fs, 1) - 1 AS position
        FROM (SELECT path, regexp_extract_all(updated, {RAW_FENCE}) AS fs FROM risky))
      SELECT path, position, f AS fence, {VALID_FENCE} AS is_valid FROM fences""",
    "document_headers": f"""WITH {MARKDOWN} SELECT path, unnest(hs) AS header, generate_subscripts(hs, 1) - 1 AS position
      FROM (SELECT path, regexp_extract_all(content, {HEADER}) AS hs FROM docs)""",
    "markdown_paths": f"""WITH {SNAPSHOTS}, {PROSE} SELECT regexp_matches(path, '\\.mdx?$', 'i') AS is_markdown, count(*) AS n_files
      FROM (SELECT path FROM old_files UNION ALL SELECT path FROM docs) GROUP BY 1""",
    "corpus_tone": f"WITH {STYLE} SELECT repo, tone FROM guide",
    "corpus_formatting": f"WITH {STYLE} SELECT repo, formatting FROM guide",
    "corpus_conventions": f"WITH {STYLE} SELECT repo, conventions FROM guide",
    "corpus_example_patterns": f"WITH {STYLE} SELECT repo, example_patterns FROM patterns",
    "project_context": f"""WITH {STYLE} SELECT repo, tone, formatting, conventions, example_patterns, 'TypeScript' AS language, 'markdown' AS documentation_format
      FROM guide JOIN patterns USING (repo)
      UNION ALL SELECT DISTINCT p_brand, {quote(style.DIRECT)}, {quote(style.DEFAULT_FORMATTING)}, {quote(style.PLAIN_CONVENTION)},
        {quote(style.DEFAULT_EXAMPLES)}, 'TypeScript', 'markdown' FROM part""",
    "context_examples": f"""WITH {SEARCH}, {MARKDOWN}, {EXAMPLES} SELECT path, start_line, end_line, api_name, 'Python' AS project_language FROM examples""",
    "line_deltas": f"""WITH {PAIRS}, numbered AS (SELECT repo, path, lang, n, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM pairs)
      SELECT repo, path, CASE WHEN lang = 'fr' THEN i WHEN lang = 'es' THEN i + 2 WHEN lang = 'de' AND i > 1 THEN i + 11 ELSE i - 1 END AS seq,
        CASE WHEN lang = 'en' AND i = n THEN '-' ELSE '=' END AS op, line FROM numbered
      UNION ALL SELECT repo, path, v.i, '+', concat('Inserted ', v.i) FROM pairs CROSS JOIN generate_series(1, 12) v(i) WHERE lang = 'de' AND n > 1
      UNION ALL SELECT repo, path, n, '+', line FROM numbered WHERE lang = 'en' AND i = n
      UNION ALL SELECT repo, path, n + 1, '+', 'New closing line.' FROM pairs WHERE lang = 'en'
      UNION ALL SELECT repo, path, 0, '+', 'New opening line (see notes)' FROM pairs WHERE lang = 'fr'
      UNION ALL SELECT repo, path, v.i, '+', v.line FROM pairs CROSS JOIN (VALUES (0, '```'), (1, 'code'), (2, '```')) v(i, line) WHERE lang = 'es'""",
    "changed_hunks": f"""WITH {PAIRS} SELECT repo, path, 0 AS seq,
        CASE lang WHEN 'en' THEN 'addition' WHEN 'de' THEN 'addition' WHEN 'fr' THEN 'signature' ELSE 'example' END AS type,
        CASE lang WHEN 'en' THEN n + 1 WHEN 'de' THEN 2 ELSE 1 END AS start_line,
        CASE lang WHEN 'en' THEN n + 1 WHEN 'de' THEN 13 WHEN 'fr' THEN 1 ELSE 3 END AS end_line, '' AS old_content,
        CASE lang WHEN 'en' THEN 'New closing line.' WHEN 'fr' THEN 'New opening line (see notes)'
          WHEN 'de' THEN array_to_string([concat('Inserted ', i) FOR i IN generate_series(1, 12)], {NL})
          ELSE concat('```', {NL}, 'code', {NL}, '```') END AS new_content
      FROM pairs WHERE lang <> 'de' OR n > 1""",
    "validated_updates": f"""WITH {RISKY}, m AS (SELECT *, regexp_extract_all(updated, {RAW_FENCE}) AS nb, len(regexp_extract_all(original, {RAW_FENCE})) AS ob FROM risky),
      e AS (SELECT *, concat_ws('|', CASE WHEN regexp_matches(updated, '^\\s*$') THEN 'Updated content is empty' END,
          list_aggregate([concat('Code block has malformed markdown: ', left(f, 50), '...') FOR f IN nb IF NOT ({VALID_FENCE})], 'string_agg', '|')) AS errors,
        concat_ws('|', CASE WHEN updated = original THEN 'Updated content is identical to original' END,
          CASE WHEN regexp_matches(original, {HEADER}) AND NOT regexp_matches(updated, {HEADER}) THEN 'All markdown headers were removed' END,
          CASE WHEN regexp_matches(original, {ITEM}) AND NOT regexp_matches(updated, {ITEM}) THEN 'List formatting may have been removed' END,
          CASE WHEN ob > 0 AND len(nb) = 0 THEN 'All code examples were removed' END,
          CASE WHEN len(nb) > 0 AND ob > len(nb) + 1 THEN concat('Number of code blocks decreased from ', ob, ' to ', len(nb)) END) AS warnings FROM m)
      SELECT path, errors = '' AS is_valid, errors, warnings FROM e""",
    "parsed_answers": f"WITH {PARSED} SELECT path, attempt, is_structured, updated_content, reasoning FROM parsed",
    "update_changes": f"""WITH {TURNS}, n AS (SELECT *, len(string_split(text, {NL})) + 1 AS last FROM turns)
      SELECT path, attempt, concat(CASE WHEN attempt <= 3 THEN 'addition:1:1::# Answer|' ELSE '' END, 'description:', last, ':', last, ':Old end.:') AS changes FROM n""",
    "parsed_new_docs": f"""WITH {TURNS} SELECT path, attempt, CASE attempt WHEN 1 THEN titled WHEN 2 THEN concat('js', {NL}, titled) ELSE text END AS updated_content FROM turns""",
    "first_valid_answers": f"""WITH {PARSED}, tried AS (SELECT * FROM parsed WHERE attempt <= 3),
      good AS (SELECT * FROM tried WHERE error IS NULL QUALIFY row_number() OVER (PARTITION BY path ORDER BY attempt) = 1)
      SELECT p.path, g.attempt, g.updated_content, g.reasoning,
        CASE WHEN g.path IS NULL THEN 'Failed to generate update after 3 attempts: timeout' END AS failure
      FROM (SELECT DISTINCT path FROM tried) p LEFT JOIN good g ON p.path = g.path""",
    "failed_answers": f"""WITH {PARSED}, tried AS (SELECT * FROM parsed WHERE attempt <= 2)
      SELECT path, 'generate update' AS stage, concat('Failed to generate update for ', path, ': Failed to generate update after 2 attempts: timeout') AS message
      FROM tried GROUP BY path HAVING bool_and(error IS NOT NULL)""",
    "new_doc_updates": f"""WITH {MISSING} SELECT concat('docs/api/', lower(name), '.md') AS path, '' AS original_content,
      concat('# ', name) AS updated_content, concat('Generated new documentation for undocumented API: ', name) AS reasoning FROM missing""",
    "change_sections": f"""WITH {API_DIFF}, entries AS (SELECT repo, path, list_ordinal, kind,
        CASE WHEN kind = 'modified' THEN concat('- **', name, '** (', api_kind, ')', {NL}, '  - Old: ', old_signature, {NL}, '  - New: ', new_signature, {NL}, '  - Changes: ', reasons)
          ELSE concat('- **', name, '** (', api_kind, '): ', new_signature) END AS text FROM api_diff WHERE kind <> 'unchanged'),
      per_kind AS (SELECT repo, path, kind, string_agg(text, {NL} ORDER BY list_ordinal, text) AS body FROM entries GROUP BY repo, path, kind),
      joined AS (SELECT repo, path, max(CASE WHEN kind = 'added' THEN body END) AS a, max(CASE WHEN kind = 'removed' THEN body END) AS r,
        max(CASE WHEN kind = 'modified' THEN body END) AS m FROM per_kind GROUP BY repo, path)
      SELECT repo, path, concat_ws({NL}, '### Added APIs' || {NL} || {NL} || a, {NL} || '### Removed APIs' || {NL} || {NL} || r,
        {NL} || '### Modified APIs' || {NL} || {NL} || m) AS change_section FROM joined""",
    "reference_sections": f"WITH {PROMPT_TEXT} SELECT path, reference_section, example_section FROM sections",
    "update_prompts": f"""WITH {PROMPT_TEXT} SELECT d.path, system, concat_ws({NL} || {NL}, {quote(prompts.UPDATE_TASK)}, '## Code Changes', change_section,
        '## Current Documentation', concat('File: ', d.path), concat('```markdown', {NL}, content, {NL}, '```'), nullif(reference_section, ''),
        nullif(example_section, ''), {quote(prompts.ANSWER_FORMAT)}) AS user
      FROM docs d JOIN sections USING (path) JOIN change_text USING (path) JOIN system_text USING (repo)""",
    "new_doc_prompts": f"""WITH {PROMPT_TEXT} SELECT path AS api_path, name, system, concat_ws({NL} || {NL}, {quote(prompts.NEW_DOC_TASK)}, '## API Element',
        concat('Type: function', {NL}, 'Name: ', name, {NL}, 'Signature: function ', name, '()'), '## Style Guidelines',
        '- ' || replace(convention_list, '; ', {NL} || '- '), 'Example Patterns:' || {NL} || '- ' || replace(example_patterns, '; ', {NL} || '- '),
        '## Required Output', concat('Complete markdown', {quote(prompts.NEW_DOC_PARTS)})) AS user
      FROM missing JOIN system_text USING (repo) JOIN pattern_facts USING (repo)""",
    "resolved_decisions": f"WITH {REVIEWS} SELECT repo, path, seq, action, edited_content, feedback FROM resolved",
    "approved_updates": f"WITH {REVIEWS} SELECT * FROM approved",
    "auto_approved_updates": f"""WITH {REVIEWS} SELECT repo, count(*) AS n_updates, sum(length(text) + 11)::BIGINT AS n_chars FROM labelled GROUP BY repo""",
    "applied_documents": f"""WITH {REVIEWS} SELECT d.source AS repo, d.path, coalesce(a.final_content, d.text) AS content,
        CASE WHEN a.path IS NOT NULL THEN d.text END AS backup, a.path IS NOT NULL AS is_updated
      FROM (SELECT *, concat('docs/', source, '/', doc_id, '.md') AS path FROM documents) d LEFT JOIN approved a ON d.path = a.path""",
    "decision_log": f"""WITH {REVIEWS} SELECT repo, path, action, concat('review of ', lang) AS reasoning, feedback,
        coalesce(length(edited_content) > 0, FALSE) AS had_edited_content FROM resolved WHERE feedback IS DISTINCT FROM 'Skipped by user'""",
    "logged_decisions": f"""WITH {REVIEWS} SELECT repo, path, action, concat('review of ', lang) AS reasoning, feedback,
        coalesce(length(edited_content) > 0, FALSE) AS had_edited_content FROM resolved WHERE feedback IS DISTINCT FROM 'Skipped by user'""",
    "stored_files_in_scope": f"""WITH {SNAPSHOTS} SELECT repo, path, length(content) AS n_chars FROM new_files
      WHERE (path LIKE 'src/src1/%.ts' OR path LIKE 'src/src2/%') AND path NOT LIKE '%.test.ts'""",
    "observed_run": f"""WITH {REVIEWS}, {CHANGED_PARTS}, m AS (SELECT (SELECT count(*) FROM changed_parts) AS files_analyzed,
        (SELECT count(*) FROM changed_parts WHERE problem IS NULL) AS apis_changed, (SELECT count(*) FROM labelled) AS updates_generated,
        (SELECT count(*) FROM approved) AS docs_updated, (SELECT count(*) FROM changed_parts WHERE problem IS NOT NULL) AS errors)
      SELECT *, concat('Generated ', updates_generated, ' documentation update(s). Applied ', docs_updated, ' update(s). Encountered ', errors,
        ' error(s). Analyzed ', files_analyzed, ' file(s). Found ', apis_changed, ' API change(s).') AS summary FROM m""",
    "run_metrics": f"""WITH {SNAPSHOTS}, {API_DIFF}, {REVIEWS}, {CHANGED_PARTS}, m AS (SELECT (SELECT count(*) FROM changes) AS files_analyzed,
        (SELECT sum(n_changed) FROM graded WHERE severity_rank >= 1)::BIGINT AS apis_changed, (SELECT count(*) FROM labelled) AS updates_generated,
        (SELECT count(*) FROM approved) AS docs_updated, (SELECT count(*) FROM changed_parts WHERE problem IS NOT NULL) AS errors)
      SELECT *, concat('Generated ', updates_generated, ' documentation update(s). Applied ', docs_updated, ' update(s). Encountered ', errors,
        ' error(s). Analyzed ', files_analyzed, ' file(s). Found ', apis_changed, ' API change(s).') AS summary FROM m""",
}
