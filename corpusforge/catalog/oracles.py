"""SQL counterparts of the registered queries, for DuckDB over the same tables.

Written independently of the Spark expressions: relational where those use arrays, and
with the regex dialect of the other engine.
"""

from __future__ import annotations

from . import inputs as I

_TERMS = I.RULES.vocabulary
_BLANKS = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(133)||chr(160)"


def _strip(text: str) -> str:
    return f"trim({text}, {_BLANKS})"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _tag(text: str, term: str) -> str:
    pattern = "[ -]?".join(term.split(" "))
    word = r"[^\p{L}\p{N}_]"
    return f"regexp_matches({text}, '(^|{word}){pattern}({word}|$)')"


def _tags(text: str) -> str:
    """List of the terms in a lower-cased text."""
    items = ", ".join(f"CASE WHEN {_tag(text, term)} THEN {_quote(term)} END" for term in _TERMS)
    return f"list_filter([{items}], lambda t: t IS NOT NULL)"


# Documents with path, class and language, as in inputs.documents.
def _docs(content: str, content_type: str | None = None) -> str:
    kind = _quote(content_type) if content_type else (
        "CASE WHEN path LIKE '%test%' THEN 'test' WHEN path LIKE '%sample%' OR path LIKE '%example%' THEN 'example' "
        "WHEN path LIKE '%.md' THEN 'documentation' WHEN path LIKE '%worker%' THEN 'implementation' ELSE 'code' END"
    )
    return f"""
docs AS (
  SELECT doc_id, 'doc:'||doc_id AS id, 'https://docs.acme.example/'||path AS url, 'Document '||doc_id AS title,
         content, {kind} AS content_type, path,
         CASE regexp_extract(path, '\\.[a-z]+$') WHEN '.py' THEN 'python' WHEN '.go' THEN 'go'
              WHEN '.md' THEN 'markdown' WHEN '.js' THEN 'javascript' WHEN '.java' THEN 'java' END AS language
  FROM (SELECT doc_id, {content} AS content, {I.PATH} AS path FROM documents)
),
tagged AS (
  SELECT * FROM (SELECT *, {_tags('lower(content)')} AS tags FROM docs) WHERE len(tags) > 0
)"""


def _choice(doc: str, term: str) -> str:
    return f"(('0x'||substr(md5('{I.SEED}:'||{doc}||':'||{term}), 1, 8))::BIGINT % 4)"


_CONCEPT = f"""
terms AS (
  SELECT id, url, content, unnest(tags) AS term, unnest(range(1, 1 + len(tags))) AS slot FROM tagged
),
answered AS (
  SELECT *, {_strip("list_filter(string_split(content, chr(10)||chr(10)), lambda p: contains(lower(p), term) AND length(p) > 100)[1]")} AS answer
  FROM terms
),
concept_pairs AS (
  SELECT CASE {_choice('id', 'term')} WHEN 0 THEN 'What is a '||term||' in Acme?'
              WHEN 1 THEN 'Explain the concept of '||term||' in Acme.'
              WHEN 2 THEN 'How does '||term||' work in Acme?'
              ELSE 'What is the purpose of '||term||' in Acme?' END AS instruction,
         answer AS response, id AS source_id, url AS source_url, 'concept' AS category,
         [term] AS concepts, 1 AS strategy, slot
  FROM answered WHERE answer IS NOT NULL
)"""

_CODE = f"""
code_pairs AS (
  SELECT 'How do I implement a '||tags[1]||' in Acme using '||name||'?' AS instruction,
         'Here''s an example of implementing a '||tags[1]||' in '||name||':'||chr(10)||chr(10)||'```'||language||chr(10)
           ||content||chr(10)||'```' AS response,
         id AS source_id, url AS source_url, 'code' AS category, tags AS concepts, 2 AS strategy, 1 AS slot
  FROM (SELECT *, CASE language WHEN 'python' THEN 'Python' WHEN 'typescript' THEN 'TypeScript' WHEN 'go' THEN 'Go'
                  WHEN 'java' THEN 'Java' ELSE language END AS name FROM tagged)
  WHERE language <> '' AND content_type IN ('example', 'code', 'implementation')
)"""

_HEADERS = f"""
blocks AS (
  SELECT id, url, unnest(parts[2:]) AS block, unnest(range(2, len(parts) + 1)) AS slot
  FROM (SELECT id, url, string_split(regexp_replace(content, '(?m)^(#{{1,3}}\\s)', chr(1)||'\\1', 'g'), chr(1)) AS parts
        FROM tagged WHERE content_type = 'documentation')
),
sections AS (
  SELECT id, url, slot, regexp_extract(block, '(?s)^(#{{1,3}})\\s+([^\\n]+)\\n(.*)$', 2) AS heading,
         {_strip("regexp_extract(block, '(?s)^(#{1,3})\\s+([^\\n]+)\\n(.*)$', 3)")} AS body FROM blocks
),
useful AS (
  SELECT *, row_number() OVER (PARTITION BY id, url ORDER BY slot) AS number FROM sections
  WHERE length(body) >= 100 AND lower(heading) NOT IN ('overview', 'introduction', 'summary', 'table of contents')
),
header_pairs AS (
  SELECT CASE WHEN heading LIKE '%?%' THEN heading
              WHEN regexp_matches(lower(heading), '^(how|what|why|when)') THEN heading||'?'
              ELSE 'What is '||heading||' in Acme?' END AS instruction,
         answer AS response, id AS source_id, url AS source_url, 'concept' AS category,
         {_tags('lower(answer)')} AS concepts, 3 AS strategy, number AS slot
  FROM (SELECT id, url, number, {_strip('heading')} AS heading, body AS answer
        FROM useful)
)"""

_FIELDS = "instruction, response, source_id, source_url, category, to_json(concepts)::VARCHAR AS concepts"


def _placed(source: str) -> str:
    return (
        f"SELECT {_FIELDS}, row_number() OVER (PARTITION BY source_id, source_url ORDER BY strategy, slot) - 1 AS place "
        f"FROM ({source})"
    )


_ALL_CTES = f"WITH {_docs(I.RICH)}, {_CONCEPT}, {_CODE}, {_HEADERS}"
_ALL = (
    "SELECT * FROM concept_pairs UNION ALL SELECT * FROM code_pairs UNION ALL SELECT * FROM header_pairs"
)
_KEY = _strip("lower(instruction)")
_PAIRS = f"""{_ALL_CTES},
pairs AS (
  SELECT instruction, response, source_id, source_url, category, concepts FROM (
    SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY source_id, source_url, strategy, slot) AS seen
    FROM ({_ALL})) WHERE seen = 1
),
keyed AS (SELECT *, md5('{I.SEED}:'||source_id||':'||{_KEY}) AS shuffle_key FROM pairs),
split AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY shuffle_key) <= floor((SELECT count(*) FROM pairs) * 0.9::DOUBLE)
            THEN 'train' ELSE 'validation' END AS split FROM keyed
)"""

_PROMPT = _quote(I.RULES.system_prompt)
_MESSAGES = (
    f"to_json([{{'role': 'system', 'content': {_PROMPT}}}, {{'role': 'user', 'content': instruction}}, "
    "{'role': 'assistant', 'content': response}])::VARCHAR AS messages"
)
_TURNS = (
    f"to_json([{{'from': 'system', 'value': {_PROMPT}}}, {{'from': 'human', 'value': instruction}}, "
    "{'from': 'gpt', 'value': response}])::VARCHAR AS conversations"
)
_FORMATS = {
    "trl": f"{_MESSAGES}, source_id, category",
    "torchtune": "instruction, '' AS input, response AS output, source_id",
    "axolotl": _TURNS,
    "gpt": _MESSAGES,
    "qwen": f"{_MESSAGES}, source_id, category",
    "raw": _FIELDS,
    "alpaca": "instruction, '' AS input, response AS output",
}
_METADATA = (
    "to_json({'source_id': source_id, 'category': category, 'concepts': concepts})::VARCHAR AS metadata"
)
_NL = "chr(10)"
_CHATML = (
    f"'<|im_start|>system'||{_NL}||{_PROMPT}||'<|im_end|>'||{_NL}||'<|im_start|>user'||{_NL}||instruction||'<|im_end|>'"
    f"||{_NL}||'<|im_start|>assistant'||{_NL}||response||'<|im_end|>'||{_NL}"
)


def _llama_part(role: str, text: str) -> str:
    return f"'<|start_header_id|>{role}<|end_header_id|>'||{_NL}||{_NL}||{text}||'<|eot_id|>'"


_TEXTS = {
    "llama3": "'<|begin_of_text|>'||" + "||".join(
        _llama_part(role, text)
        for role, text in (("system", _PROMPT), ("user", "instruction"), ("assistant", "response"))
    ),
    "mistral": "'[INST] '||instruction||' [/INST]'||response||'</s>'",
    "chatml": _CHATML,
    "qwen": _CHATML,
    "gpt": "''",
    "alpaca": (
        "'Below is an instruction that describes a task. Write a response that appropriately completes the request.'||"
        f"{_NL}||{_NL}||'### Instruction:'||{_NL}||instruction||{_NL}||{_NL}||'### Response:'||{_NL}||response"
    ),
}

# --- pages ------------------------------------------------------------------

_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_TAG = "<[a-zA-Z/!?][^>]*>"


def _path(url: str) -> str:
    return f"regexp_replace(regexp_extract({url}, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), ';[^/]*$', '')"


def _unescape(text: str) -> str:
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{char}', 'g')"
    return text


def _page_ctes(html: str = "html") -> str:
    bare = (
        f"regexp_replace(regexp_replace({html}, '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>', '<!>', 'g'), "
        "'(?is)<nav\\b[^>]*>.*?</nav\\s*>|<footer\\b[^>]*>.*?</footer\\s*>|<header\\b[^>]*>.*?</header\\s*>', '<!>', 'g')"
    )
    text = f"trim(regexp_replace({_unescape(f'''regexp_replace(region, '{_TAG}', ' ', 'g')''')}, '{_SPACE}', ' ', 'g'))"

    def joined(part):
        return _strip(_unescape(f"regexp_replace({part}, '\\s*{_TAG}\\s*', '', 'g')"))

    h1 = joined("regexp_extract(bare, '(?is)<h1\\b[^>]*>(.*?)</h1\\s*>', 1)")
    title = f"replace({joined('''regexp_extract(bare, '(?is)<title\\b[^>]*>(.*?)</title\\s*>', 1)''')}, ' | Acme', '')"
    return f"""
bare AS (SELECT page_id, url, {bare} AS bare FROM pages),
regions AS (
  SELECT *, CASE WHEN regexp_matches(bare, '(?i)<article\\b')
            THEN regexp_extract(bare, '(?is)<article\\b[^>]*>(.*?)</article\\s*>', 1)
            ELSE regexp_extract(bare, '(?is)<body\\b[^>]*>(.*)', 1) END AS region FROM bare
),
extracted AS (
  SELECT * FROM (
    SELECT page_id, url, {text} AS content, region,
           coalesce(nullif(CASE WHEN regexp_matches(bare, '(?i)<h1\\b') THEN {h1} ELSE {title} END, ''), 'Untitled') AS title
    FROM regions) WHERE length(content) >= 100
),
page_docs AS (
  SELECT 'docs:'||{_path('url')} AS id, 'acme_docs' AS source, url, title, content,
         CASE WHEN regexp_matches(lower({_path('url')}), '/develop|/sdk') THEN 'tutorial'
              WHEN regexp_matches(lower({_path('url')}), '/references|/api') THEN 'reference'
              WHEN regexp_matches(lower({_path('url')}), '/encyclopedia|/glossary') THEN 'concept'
              WHEN regexp_matches(lower({_path('url')}), '/production|/deploy') THEN 'guide'
              ELSE 'documentation' END AS content_type,
         NULL::VARCHAR AS language, {_path('url')} AS path
  FROM extracted WHERE {_good_url('url')}
)"""


def _good_url(url: str) -> str:
    parts = " OR ".join(f"contains({_path(url)}, {_quote(part)})" for part in I.RULES.skipped_url_parts)
    return f"NOT ({parts})"


_PAGES = f"WITH {_page_ctes()}"
_CODE_PAGE = (
    "replace(html, '</article>', '<pre><code class=\"language-py\">x='||page_id||'</code></pre></article>')"
)
_PRIORITY = (
    f"CASE WHEN starts_with({_path('url')}, '/en') THEN 0 WHEN starts_with({_path('url')}, '/de') THEN 1 "
    f"WHEN starts_with({_path('url')}, '/fr') THEN 2 ELSE 3 END"
)
_SNAPSHOTS = f"""
fetched AS (SELECT url, html, TIMESTAMP '{I.NOW}' - page_id * INTERVAL '1' HOUR AS fetched_at FROM pages),
snapshots AS (SELECT * FROM fetched UNION ALL
              SELECT url, html||'<!-- old -->', fetched_at - INTERVAL '1' HOUR FROM fetched),
fresh AS (SELECT * FROM snapshots WHERE fetched_at > TIMESTAMP '{I.NOW}' - INTERVAL '24' HOUR)"""

# --- repository files -------------------------------------------------------

_KIND = (
    "CASE WHEN contains(path, 'test') THEN 'test' WHEN contains(path, 'sample') OR contains(path, 'example') THEN 'example' "
    "WHEN ends_with(path, '.md') OR ends_with(path, '.mdx') OR contains(path, 'readme') THEN 'documentation' "
    "WHEN contains(path, 'worker') THEN 'implementation' ELSE 'code' END"
)
_LANGUAGE = (
    "CASE WHEN ends_with(path, '.py') THEN 'python' WHEN ends_with(path, '.go') THEN 'go' WHEN ends_with(path, '.md') "
    "THEN 'markdown' WHEN ends_with(path, '.js') THEN 'javascript' WHEN ends_with(path, '.java') THEN 'java' END"
)


def _file_fields(sha: str, size: str, term: str) -> str:
    return (
        "'github:acme/tools/'||path AS id, 'github' AS source, 'https://code.example/acme/tools/'||path AS url, "
        f"'tools/'||path AS title, content, {_KIND} AS content_type, {_LANGUAGE} AS language, path, "
        f"'acme/tools' AS repo, {sha} AS sha, {size} AS size, {term} AS search_term"
    )


_TERM_ROWS = ", ".join(f"({number}, {_quote(term)})" for number, term in enumerate(_TERMS))
_FILES = f"""
files AS (SELECT doc_id, text, n_chars, {I.PATH} AS path FROM documents),
walked AS (
  SELECT {_file_fields('md5(text)', 'n_chars', 'NULL::VARCHAR')}
  FROM (SELECT *, text AS content FROM files WHERE length(text) >= 100)
  WHERE NOT regexp_matches(path, '(^|/)(node_modules|vendor|\\.git|__pycache__|dist|build)/')
    AND regexp_extract(path, '\\.[a-z]+$') IN ('.py', '.ts', '.js', '.go', '.java', '.md', '.mdx')
    AND (contains(path, 'worker') OR regexp_matches(lower(content), '@que|nicht\\.|of.*that'))
),
hits AS (
  SELECT path, number, term
  FROM files, (VALUES {_TERM_ROWS}) AS terms(number, term) WHERE contains(lower(text), term)
),
claimed AS (SELECT path, min(number) AS number FROM hits GROUP BY path),
searched AS (
  SELECT {_file_fields('NULL::VARCHAR', 'NULL::BIGINT', 'term')}
  FROM (SELECT path, text AS content, term FROM files JOIN claimed USING (path)
        JOIN (VALUES {_TERM_ROWS}) AS terms(number, term) USING (number))
  WHERE length(content) >= 100
)"""

_REPLIES = "usable AS (SELECT 'doc:'||doc_id AS id, doc_id % 3 <> 0 AS usable, 'Q'||doc_id AS question FROM documents)"
_REPLY_PAIRS = (
    "to_json([{'instruction': question, 'response': 'A', 'category': 'concept', 'concepts': []::VARCHAR[]}])::VARCHAR"
)


# Fixed value: the wording, stated here once more so that a change of the operator's shows.
_WORDING = """You are creating training data for a language model that will answer questions about {subject}.

Given the following document, generate 3-5 high-quality question-answer pairs.

Document Title: {title}
Document Type: {content_type}
Source: {source}

Content:
{content}

Generate questions that:
1. Cover key concepts explained in the document
2. Include "how-to" questions if code examples are present
3. Ask about best practices or common patterns
4. Are specific to {domain} concepts

Return your response as a JSON array with objects containing:
- "instruction": The question
- "response": A comprehensive answer based on the document
- "category": One of "concept", "howto", "code", "troubleshooting"
- "concepts": Array of {domain} concepts covered

JSON Output:"""


def _prompt() -> str:
    slots = {
        "subject": "'Acme'", "domain": "'Acme'", "title": "title", "content_type": "content_type",
        "source": "'acme_docs'", "content": "content",
    }
    text = _quote(_WORDING)
    for name, value in slots.items():
        text = text.replace("{" + name + "}", f"'||{value}||'")
    return text


def _block_ctes() -> str:
    """Pages by blocks, as documents and with their terms."""
    edge, level = "chr(2)", "chr(3)"
    names = "article|div|footer|h1|h2|li|ol|p|section|table|td|tr|ul"
    marked = (
        f"regexp_replace(regexp_replace(region, '(?i)<h([1-6])(\\s[^>]*)?>', {edge}||{level}||'\\1', 'g'), "
        f"'(?i)</?({names})(\\s[^>]*)?/?>', {edge}, 'g')"
    )
    plain = _unescape(f"regexp_replace(b, '{_TAG}', ' ', 'g')")
    clean = f"trim(regexp_replace({plain}, '{_SPACE}', ' ', 'g'))"
    written = f"CASE WHEN starts_with(c, {level}) THEN repeat('#', substr(c, 2, 1)::INT)||' '||trim(substr(c, 3)) ELSE c END"
    useful = f"c <> '' AND NOT regexp_matches(c, '^'||{level}||'[1-6]\\s*$')"
    blocks = f"list_filter(list_transform(string_split({marked}, {edge}), lambda b: {clean}), lambda c: {useful})"
    return _page_ctes(I.SECOND_HEADING) + f""",
blocks_text AS (
  SELECT page_id, array_to_string(list_transform({blocks}, lambda c: {written}), chr(10)||chr(10)) AS content FROM extracted
),
block_docs AS (
  SELECT 'docs:'||{_path('e.url')} AS id, e.url, e.title, b.content, p.content_type
  FROM extracted e JOIN blocks_text b USING (page_id)
  JOIN (SELECT DISTINCT url, content_type FROM page_docs) p ON p.url = e.url WHERE length(b.content) >= 100
),
tagged AS (SELECT * FROM (SELECT *, {_tags('lower(content)')} AS tags FROM block_docs) WHERE len(tags) > 0)"""


_CORPUS = f"""WITH {_page_ctes()}, {_FILES},
corpus AS (
  SELECT id, source, url, title, content_type, language FROM page_docs
  UNION ALL SELECT id, source, url, title, content_type, language FROM walked
  UNION ALL SELECT id, source, url, title, content_type, language FROM searched
)"""

ORACLES = {
    "concept_tags": (
        f"SELECT doc_id, to_json(tags)::VARCHAR AS concepts FROM "
        f"(SELECT doc_id, {_tags('lower(text)')} AS tags FROM documents) WHERE len(tags) > 0"
    ),
    "concept_tags_many": (
        "WITH drawn AS (SELECT doc_id, unnest([regexp_extract(text, '^([A-Za-z]+)[ ,.]', 1), "
        "regexp_extract(text, '^([A-Za-z]+ [A-Za-z]+)[ ,.]', 1)]) AS term FROM documents), "
        "terms AS (SELECT term, min(doc_id) AS position FROM drawn WHERE term <> '' GROUP BY term), "
        "keys AS (SELECT lower(term) AS key, * FROM terms UNION SELECT replace(lower(term), ' ', ''), * FROM terms), "
        "tokens AS (SELECT doc_id, unnest(t) AS w, unnest(range(len(t))) AS i FROM (SELECT doc_id, "
        "regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_]') AS t FROM documents)), "
        "seen AS (SELECT doc_id, w, lead(w) OVER here AS gap, lead(w, 2) OVER here AS next FROM tokens WINDOW here AS (PARTITION BY doc_id ORDER BY i)), "
        "sequences AS (SELECT DISTINCT doc_id, w AS key FROM seen UNION SELECT doc_id, w||' '||next FROM seen WHERE gap IN (' ', '-')) "
        "SELECT doc_id, to_json(list(term ORDER BY position, term))::VARCHAR AS concepts "
        "FROM (SELECT DISTINCT doc_id, position, term FROM sequences JOIN keys USING (key)) GROUP BY doc_id"
    ),
    "concept_qa": f"WITH {_docs(I.PARAGRAPHS)}, {_CONCEPT} {_placed('SELECT * FROM concept_pairs')}",
    "header_qa": f"WITH {_docs(I.HEADINGS, 'documentation')}, {_HEADERS} {_placed('SELECT * FROM header_pairs')}",
    "code_qa": f"WITH {_docs(I.RICH)}, {_CODE} {_placed('SELECT * FROM code_pairs')}",
    "rule_qa": f"{_ALL_CTES} {_placed(_ALL)}",
    "question_dedup": f"{_PAIRS} SELECT {_FIELDS} FROM pairs",
    "content_dedup": (
        "SELECT doc_id, text AS content, source FROM documents "
        "WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)"
    ),
    "train_split": f"{_PAIRS} SELECT instruction, source_id, shuffle_key, split FROM split",
    "split_counts": (
        f"{_PAIRS} SELECT count(*) AS total_examples, count(*) FILTER (WHERE split = 'train') AS train_examples, "
        "count(*) FILTER (WHERE split = 'validation') AS validation_examples FROM split"
    ),
    **{f"fmt_{name}": f"{_PAIRS} SELECT {fields} FROM pairs" for name, fields in _FORMATS.items()},
    **{f"render_{name}": f"{_PAIRS} SELECT {text} AS text, {_METADATA} FROM pairs" for name, text in _TEXTS.items()},
    "format_files": (
        f"{_PAIRS} SELECT format, split, instruction, '' AS input, response AS output "
        "FROM split, (VALUES ('alpaca'), ('torchtune')) AS formats(format)"
    ),
    "dataset_info": (
        f"{_PAIRS}, counts AS (SELECT count(*) AS n, count(*) FILTER (WHERE split = 'train') AS t FROM split) "
        "SELECT n AS total_examples, t AS train_examples, n - t AS validation_examples, t AS alpaca_train, "
        "n - t AS alpaca_validation, 'llama3' AS template FROM counts"
    ),
    "split_dataset": f"{_PAIRS} SELECT {_MESSAGES}, source_id, category, split FROM split",
    "training_rows": f"{_PAIRS} SELECT source_id, {_MESSAGES} FROM pairs",
    "normalize_chat": (
        "WITH rows AS (SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'user') AS instruction, "
        "arg_min(text, turn) FILTER (WHERE role = 'assistant') AS output FROM conversations GROUP BY conv_id) "
        f"SELECT conv_id, instruction, output, CASE WHEN instruction IS NOT NULL AND output IS NOT NULL THEN "
        f"to_json([{{'role': 'system', 'content': {_PROMPT}}}, {{'role': 'user', 'content': instruction}}, "
        "{'role': 'assistant', 'content': output}])::VARCHAR END AS messages FROM rows "
        "UNION ALL SELECT conv_id, NULL, NULL, to_json(list({'role': role, 'content': text} ORDER BY turn))::VARCHAR "
        "FROM conversations GROUP BY conv_id"
    ),
    "question_prompts": (
        f"SELECT conv_id, turn, question, to_json([{{'role': 'system', 'content': {_PROMPT}}}, "
        "{'role': 'user', 'content': question}])::VARCHAR AS messages FROM "
        f"(SELECT conv_id, turn, {_strip('text')} AS question FROM conversations WHERE role = 'user') WHERE question <> ''"
    ),
    "page_text": f"{_PAGES} SELECT page_id, content FROM extracted",
    "page_title": f"{_PAGES} SELECT page_id, title FROM extracted",
    "page_code_blocks": (
        f"WITH {_page_ctes(_CODE_PAGE)} SELECT page_id, "
        "to_json([{'code': 'x='||page_id, 'language': 'py'}])::VARCHAR AS code_blocks FROM extracted"
    ),
    "page_docs": f"{_PAGES} SELECT *, '{I.COLLECTED_AT}' AS collected_at FROM page_docs",
    "page_blocks": f"WITH {_block_ctes()} SELECT id, url, title, content FROM block_docs",
    "page_paragraph_qa": f"WITH {_block_ctes()}, {_CONCEPT} {_placed('SELECT * FROM concept_pairs')}",
    "page_heading_qa": f"WITH {_block_ctes()}, {_HEADERS} {_placed('SELECT * FROM header_pairs')}",
    "url_filter": f"SELECT page_id, url, {_path('url')} AS path FROM pages WHERE {_good_url('url')}",
    "url_priority": (
        f"SELECT url, ({_PRIORITY})::BIGINT AS priority, 'documentation' AS page_class FROM (SELECT DISTINCT url FROM pages)"
    ),
    "sitemap_urls": (
        "WITH locations AS (SELECT url, page_id % 2 = 1 AND regexp_matches(url, '&[^;]*$') AS broken FROM pages) "
        f"SELECT url FROM locations WHERE CASE WHEN broken THEN regexp_matches(url, '^https://[^/<]+[^<]+$') "
        f"ELSE {_good_url('url')} END"
    ),
    "sitemap_files": (
        "WITH files AS (SELECT *, page_id % 8 AS number FROM pages), "
        "broken AS (SELECT number FROM files WHERE number % 2 = 1 AND regexp_matches(url, '&([^;]*$|[^;]*[^a-z;])') GROUP BY number) "
        "SELECT url FROM files WHERE CASE WHEN number IN (SELECT number FROM broken) THEN regexp_matches(url, '^https://[^/<]+[^<]+$') "
        f"ELSE {_good_url('url')} END"
    ),
    "url_refresh": f"WITH {_SNAPSHOTS} SELECT DISTINCT url FROM pages WHERE url NOT IN (SELECT url FROM fresh)",
    "cached_pages": (
        f"WITH {_SNAPSHOTS} SELECT url, html, strftime(fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at FROM "
        "(SELECT *, row_number() OVER (PARTITION BY url ORDER BY fetched_at DESC) AS age FROM fresh) WHERE age = 1"
    ),
    "repo_docs": f"WITH {_FILES} SELECT * FROM walked",
    "concept_search": f"WITH {_FILES} SELECT * FROM searched",
    "first_code_docs": (
        f"WITH {_FILES}, code AS (SELECT id, url, search_term, 1 AS rank, 0 AS position FROM walked UNION ALL "
        "SELECT id, url, search_term, 2, number FROM searched JOIN "
        f"(VALUES {_TERM_ROWS}) AS terms(number, term) ON term = search_term) "
        "SELECT id, url, search_term FROM code ORDER BY rank, position, id LIMIT 50"
    ),
    "concept_search_many": (
        f"WITH files AS (SELECT text, lower(text) AS low, {I.PATH} AS path FROM documents), "
        f"syllables AS (SELECT unnest([{', '.join(map(_quote, I.SYLLABLES))}]) AS part, unnest(range({len(I.SYLLABLES)})) AS slot), "
        f"terms AS (SELECT a.part||b.part AS term, a.slot * {len(I.SYLLABLES)} + b.slot AS number FROM syllables a, syllables b), "
        "hits AS (SELECT path, arg_min(term, number) AS search_term FROM files, terms "
        "WHERE contains(low, term) AND length(text) >= 100 GROUP BY path) "
        "SELECT 'github:acme/tools/'||path AS id, 'https://code.example/acme/tools/'||path AS url, search_term FROM hits"
    ),
    "file_class": (
        f"SELECT doc_id, path, regexp_extract(path, '\\.[a-z]+$') AS extension, {_LANGUAGE} AS language, "
        f"{_KIND} AS content_type, starts_with(path, 'node_modules/') AS skipped "
        f"FROM (SELECT doc_id, {I.PATH} AS path FROM documents)"
    ),
    "b64_decode": "SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN text END AS content FROM documents",
    "repo_good_files": (
        f"SELECT 'acme/r'||doc_id % 3 AS repo, {I.PATH} AS path, md5(text) AS sha, n_chars AS size, length(text)::BIGINT AS characters "
        "FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0"
    ),
    "repo_rejects": (
        "SELECT 'acme/r'||doc_id % 3 AS repo, CASE WHEN doc_id % 5 = 0 THEN 'malformed' ELSE 'no repository or path' END AS reason, "
        "count(*) AS rejects FROM documents WHERE doc_id % 5 = 0 OR doc_id % 7 = 0 GROUP BY ALL"
    ),
    "reply_errors": (
        f"WITH {_docs('text')}, sizes AS (SELECT length({_prompt()}) AS n FROM docs) "
        "SELECT CASE WHEN n % 3 = 0 THEN 'ValueError: refused, remainder '||n % 2 ELSE 'none' END AS error, count(*) AS documents "
        "FROM sizes GROUP BY ALL"
    ),
    "reply_parse": f"WITH {_REPLIES} SELECT id, CASE WHEN usable THEN {_REPLY_PAIRS} END AS pairs FROM usable",
    "reply_fallback": (
        f"{_ALL_CTES}, {_REPLIES}, "
        "answers AS (SELECT question AS instruction, 'A' AS response, id AS source_id, url AS source_url, "
        "'concept' AS category, []::VARCHAR[] AS concepts, 1 AS strategy, 1 AS slot "
        "FROM usable JOIN docs USING (id) WHERE usable), "
        "rest AS (SELECT r.* FROM (" + _ALL + ") r JOIN usable u ON r.source_id = u.id WHERE NOT u.usable) "
        + _placed("SELECT * FROM answers UNION ALL SELECT * FROM rest")
    ),
    "model_prompts": f"WITH {_docs('text')} SELECT id, {_prompt()} AS prompt FROM docs",
    "model_answers": (
        f"WITH {_docs('text')} SELECT 'Prompt of '||length({_prompt()})||' characters' AS instruction, 'ok' AS response, "
        "id AS source_id, url AS source_url, 'concept' AS category, '[]' AS concepts, 0 AS place FROM docs"
    ),
    "doc_union": f"{_CORPUS} SELECT * FROM corpus",
    "source_counts": f"{_CORPUS} SELECT source, count(*) AS documents FROM corpus GROUP BY source",
    "run_stats": (
        f"{_PAIRS}, {_page_ctes()} SELECT (SELECT count(*) FROM page_docs) AS docs_collected, 0 AS code_collected, "
        "(SELECT count(*) FROM pairs) AS qa_pairs_generated"
    ),
    "page_class": (
        f"SELECT doc_id, CASE WHEN regexp_matches(p, '/develop|/sdk') THEN 'tutorial' WHEN regexp_matches(p, '/references|/api') "
        "THEN 'reference' WHEN regexp_matches(p, '/encyclopedia|/glossary') THEN 'concept' WHEN regexp_matches(p, "
        "'/production|/deploy') THEN 'guide' ELSE 'documentation' END AS page_class "
        f"FROM (SELECT doc_id, lower({_path('url')}) AS p FROM (SELECT doc_id, {I.SECTION_URL} AS url FROM documents))"
    ),
    "arrived_pages": (
        f"WITH {_SNAPSHOTS} SELECT url, strftime(fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at FROM snapshots "
        "WHERE html <> '' AND hour(fetched_at) % 3 = 0"
    ),
    "wanted_urls": (
        "WITH locations AS (SELECT url, page_id % 2 = 1 AND regexp_matches(url, '&[^;]*$') AS broken FROM pages), "
        "listed AS (SELECT DISTINCT 'sitemap' AS \"case\", url FROM locations WHERE CASE WHEN broken THEN "
        f"regexp_matches(url, '^https://[^/<]+[^<]+$') ELSE {_good_url('url')} END "
        "UNION ALL SELECT 'none', 'https://docs.acme.example'||path FROM (VALUES ('/en'), ('/de'), ('/fr')) AS seeds(path)), "
        f"ranked AS (SELECT *, ({_PRIORITY})::BIGINT AS priority FROM listed) SELECT \"case\", "
        "row_number() OVER (PARTITION BY \"case\" ORDER BY priority, url) AS place, url, priority FROM ranked"
    ),
    "qa_pairs_file": f"{_PAIRS} SELECT {_FIELDS} FROM pairs",
    "earlier_documents": f"WITH {_docs('text')} SELECT id, content FROM docs",
    "jsonl_documents": (
        f"WITH {_docs('text')} SELECT id, 'acme_docs' AS source, url, title, content, content_type, language, path, "
        f"'{I.COLLECTED_AT}' AS collected_at FROM docs"
    ),
}
