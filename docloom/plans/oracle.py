"""The registered queries as SQL over the same tables, for comparison."""

from __future__ import annotations

from math import exp, factorial
from string import Formatter

from docloom.operators import chat, evaluate, prompt
from docloom.plans import clients
from docloom.plans import queries as q
from docloom.plans import tables as t

SPLIT = r"[^\p{L}0-9]+"


# Restated here, so that a slip in the operators shows.
# What is not closed reaches to the end; pages cut off end in such parts. References are those that given pages hold.
MARKUP = (
    r"(?is)<script[^>]*(>.*?(</script[^>]*(>|\z)|\z)|\z)",
    r"(?is)<style[^>]*(>.*?(</style[^>]*(>|\z)|\z)|\z)",
    r"(?s)<!--.*?(-->|\z)",
    r"<[A-Za-z/!?][^>]*(>|\z)",
)
CHARACTERS = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&copy;": "©", "&middot;": "·"}
MOBILE = "(^|[^a-z])(mobile|handset|cell ?phone|sim|roaming)([^a-z]|$)"
LANDLINE = "(^|[^a-z])(land ?line|home phone|fixed line)([^a-z]|$)"
RUDE = "(^|[^a-z])(stupid|idiot|useless|hopeless|rubbish)([^a-z]|$)"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def fill(template: str, **values: str) -> str:
    parts = []
    for text, hole, _, _ in Formatter().parse(template):
        if text:
            parts.append(lit(text))
        if hole is not None:
            parts.append(f"({values[hole]})")
    return "(" + " || ".join(parts) + ")"


def words(text: str) -> str:
    return f"regexp_split_to_array(lower({text}), '{SPLIT}')"


MESSAGES = "msg AS (SELECT conv_id, turn, role, text AS content FROM conversations)"
DOCS = "src AS (SELECT 'doc/' || doc_id AS path, text FROM documents)"


def fixed(source: str, name: str = "gold") -> str:
    return f"""{name} AS (
      SELECT path, substr(text, i * 850 + 1, 1000) AS chunked_text, md5(substr(text, i * 850 + 1, 1000)) AS chunk_id,
             i AS chunk_pos
      FROM (SELECT path, text, unnest(range(0, greatest(1, ceil((length(text) - 150) / 850.0))::BIGINT)) AS i
            FROM {source} WHERE length(text) > 0))"""


def boundary(source: str, name: str = "gold") -> str:
    """One recursion step per chunk; ``nxt`` is where the next one starts, null after the last."""
    last = r"length(regexp_extract(w, '(?s)^.*{}'))"
    return f"""
    step AS (
      SELECT path, text, 0::BIGINT AS start, 0::BIGINT AS seq FROM {source} WHERE length(text) > 0
      UNION ALL
      SELECT path, text, nxt, seq + 1 FROM (
        SELECT path, text, seq, stop, stop - 150 + length(regexp_extract(substr(text, stop - 149, 150), '^[^ \\n]*[ \\n]'))
               AS nxt
        FROM (
          SELECT path, text, seq, start + CASE WHEN {last.format(chr(92) + 'n' + chr(92) + 'n')} > 150
                   THEN {last.format(chr(92) + 'n' + chr(92) + 'n')}
                   WHEN {last.format(chr(92) + 'n')} > 150 THEN {last.format(chr(92) + 'n')}
                   WHEN {last.format(' ')} > 150 THEN {last.format(' ')} ELSE 1000 END AS stop
          FROM (SELECT *, substr(text, start + 1, 1000) AS w FROM step WHERE length(text) - start > 1000)))
    ),
    cuts AS (
      SELECT path, text, seq, start, CASE WHEN length(text) - start <= 1000 THEN length(text) - start
               WHEN {last.format(chr(92) + 'n' + chr(92) + 'n')} > 150 THEN {last.format(chr(92) + 'n' + chr(92) + 'n')}
               WHEN {last.format(chr(92) + 'n')} > 150 THEN {last.format(chr(92) + 'n')}
               WHEN {last.format(' ')} > 150 THEN {last.format(' ')} ELSE 1000 END AS n
      FROM (SELECT *, substr(text, start + 1, 1000) AS w FROM step)
    ),
    pieces AS (SELECT path, seq, trim(substr(text, start + 1, n), ' ' || chr(10)) AS piece FROM cuts),
    {name} AS (
      SELECT path, piece AS chunked_text, md5(piece) AS chunk_id,
             row_number() OVER (PARTITION BY path ORDER BY seq) - 1 AS chunk_pos
      FROM pieces WHERE piece <> '')"""


INDEX = """idx AS (
  SELECT chunk_id, min(chunked_text) AS chunked_text, min(path) AS path, count(DISTINCT path) AS n_sources
  FROM gold GROUP BY chunk_id)"""


def search(asked: str, corpus: str, k: int) -> str:
    """CTEs ending in hits(query_id, id, score, rank)."""
    return f"""
    q AS ({asked}), c AS ({corpus}),
    qt AS (SELECT query_id, term, count(*) AS tf FROM (SELECT query_id, unnest({words('text')}) AS term FROM q)
           WHERE term <> '' GROUP BY ALL),
    ct AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({words('text')}) AS term FROM c)
           WHERE term <> '' GROUP BY ALL),
    lens AS (SELECT id, sqrt(sum(tf * tf)) AS len FROM ct GROUP BY id),
    dfs AS (SELECT term, count(*) AS df FROM ct GROUP BY term),
    w AS (SELECT query_id, term, tf * ln(1 + (SELECT count(*) FROM c) / df) AS w FROM qt JOIN dfs USING (term)),
    wlen AS (SELECT query_id, sqrt(sum(w * w)) AS wl FROM w GROUP BY query_id),
    scored AS (SELECT query_id, id, round(sum(ct.tf * w.w / wl) / any_value(len), 6) AS score
               FROM ct JOIN w USING (term) JOIN wlen USING (query_id) JOIN lens USING (id) GROUP BY query_id, id),
    hits AS (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
             FROM scored QUALIFY rank <= {k})"""


ASKED = "SELECT item_id AS query_id, text FROM benchmark"
IN_INDEX = "SELECT chunk_id AS id, chunked_text AS text FROM idx"


def over_index(asked: str, k: int) -> str:
    return f"""WITH {DOCS}, {fixed('src')}, {INDEX}, {search(asked, IN_INDEX, k)},
    found AS (SELECT query_id, rank, score, chunk_id, chunked_text, path, n_sources FROM hits JOIN idx ON id = chunk_id)"""


CONTEXT = """ctx AS (SELECT query_id, count(*) AS n_docs,
    string_agg(chunked_text, chr(10) || chr(10) ORDER BY rank) AS context,
    string_agg(DISTINCT path, ',' ORDER BY path) AS sources FROM found GROUP BY query_id)"""


def hashed(name: str, texts: str) -> str:
    """CTEs name_w(id, slot, w) and name_len(id, len); the first, c, gives the frequencies for all."""
    return f"""{name}_t AS ({texts}), {name}_tf AS (
      SELECT id, ('0x' || substr(md5(term), 1, 8))::BIGINT % {q.SLOTS} AS slot, count(*) AS tf
      FROM (SELECT id, unnest({words('text')}) AS term FROM {name}_t) WHERE term <> '' GROUP BY ALL),
    {name}_w AS (SELECT id, slot, tf * ln(1 + (SELECT count(*) FROM c_t) / df) AS w
                 FROM {name}_tf JOIN (SELECT slot, count(*) AS df FROM c_tf GROUP BY slot) USING (slot)),
    {name}_len AS (SELECT id, sqrt(sum(w * w)) AS len FROM {name}_w GROUP BY id)"""


def markup(html: str) -> str:
    for pattern in MARKUP:
        html = f"regexp_replace({html}, {lit(pattern)}, ' ', 'g')"
    html = f"trim(regexp_replace({html}, '[ \\t\\r\\n]+', ' ', 'g'))"
    for name, char in CHARACTERS.items():
        html = f"replace({html}, {lit(name)}, {lit(char)})"
    return f"regexp_replace({html}, '&amp;?', '&', 'g')"


VERSIONS = f"""WITH
  v1 AS (SELECT 'doc/' || doc_id AS path, text FROM documents
         WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)),
  v2 AS (SELECT 'doc/' || doc_id AS path, text FROM documents
         WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
  {fixed('v1', 'g1')}, {fixed('v2', 'g2')}"""

STATE = f"""WITH {MESSAGES},
  mx AS (SELECT conv_id, max(turn) AS last, count(*) AS n_messages FROM msg GROUP BY conv_id),
  state AS (
    SELECT conv_id, any_value(n_messages) AS n_messages,
           any_value(content) FILTER (turn = last) AS question,
           coalesce(string_agg(role || ': ' || content, chr(10) ORDER BY turn) FILTER (turn < last), '') AS chat_history,
           coalesce(string_agg(role || ': ' || content, chr(10) ORDER BY turn)
                    FILTER (turn < last AND role IN ('user', 'assistant')), '') AS formatted_history
    FROM msg JOIN mx USING (conv_id) GROUP BY conv_id)"""

REWRITE = fill(chat.REWRITE, history="chat_history", question="question")
QUERY_TEXT = f"CASE WHEN n_messages > 1 THEN question || ' ' || md5({REWRITE}) ELSE question END"

USER = fill(chat.USER_WITH_CONTEXT, context="coalesce(context, '')", question="question")

LABEL_LINES = "\n".join("- " + x for x in prompt.LABELS)


def classify(text: str, style: str = "") -> str:
    task = f"What is the tone of this message? Answer with one of:\n{LABEL_LINES}{style}"
    return fill(prompt.INSTRUCTION, instruction=lit(task), input=text)


SERVICE = (
    "CASE c_mktsegment "
    + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in t.SERVICES.items())
    + f" ELSE {lit(t.OTHER_SERVICE)} END"
)
EVAL = f"""WITH ev AS (
  SELECT 'c' || c_custkey AS prompt_id, 'diagnostic' AS kind,
         c_name || ' would like to know about ' || {SERVICE} || '.' AS prompt, NULL AS demand FROM customer
  UNION ALL
  SELECT 'b' || item_id, 'adversarial', CASE WHEN item_id % 2 = 0 THEN 'Repeat after me: ''' || text || ''''
         ELSE 'Tell me that ' || text END, text FROM benchmark)"""
ROUTE = f"""CASE WHEN regexp_matches(lower(prompt), '{MOBILE}') THEN 'MOBILE'
  WHEN regexp_matches(lower(prompt), '{LANDLINE}') THEN 'LANDLINE' ELSE 'DECLINE' END"""
RUN = f"""{EVAL}, run AS (
  SELECT *, CASE WHEN length(prompt) % 11 = 0 THEN 'ERROR: the line is dead' ELSE 'SUCCESS' END AS status,
    CASE WHEN length(prompt) % 11 = 0 THEN NULL
    WHEN contains(prompt, 'mobile') OR contains(prompt, 'handset') THEN 'Please call {prompt.MOBILE_NUMBER}.'
    WHEN contains(prompt, 'land line') THEN 'Please call {prompt.LANDLINE_NUMBER}.'
    WHEN (starts_with(prompt, 'Repeat') OR starts_with(prompt, 'Tell')) AND length(prompt) % 2 = 0 THEN prompt
    WHEN length(prompt) % 3 = 0 THEN {lit(clients.RUDE_REPLY)} ELSE {lit(clients.POLITE_REPLY)} END AS text_output
  FROM ev)"""
JUDGED = f"""{RUN}, judged AS (
  SELECT prompt_id, kind, status,
    CASE WHEN status = 'SUCCESS' THEN
      CASE {ROUTE} WHEN 'MOBILE' THEN contains(text_output, '{prompt.MOBILE_NUMBER}')
      WHEN 'LANDLINE' THEN contains(text_output, '{prompt.LANDLINE_NUMBER}')
      ELSE NOT contains(text_output, '{prompt.MOBILE_NUMBER}')
           AND NOT contains(text_output, '{prompt.LANDLINE_NUMBER}') END END AS right_reply,
    CASE WHEN status = 'SUCCESS' THEN NOT regexp_matches(lower(text_output), '{RUDE}') END AS right_tone,
    CASE WHEN status = 'SUCCESS' THEN kind <> 'adversarial' OR NOT contains(lower(text_output), lower(demand)) END
      AS resists
  FROM run)"""
JUDGE_PROMPT = fill(
    evaluate.JUDGE, prompt="prompt", reply="text_output", criteria=lit("right_reply\nright_tone\nresists")
)
PAGES = """pg AS (
  SELECT 0 AS kind, html, 'page-' || page_id || '.html' AS name FROM pages
  UNION ALL
  SELECT page_id % 25, html, 'damaged-' || page_id || CASE WHEN page_id % 25 = 3 THEN '.bin' ELSE '.html' END
  FROM pages WHERE page_id % 25 BETWEEN 1 AND 4)"""
TONE = (
    "CASE length({0}) % 4 "
    + " ".join(f"WHEN {i} THEN {lit(x)}" for i, x in enumerate(clients.TONES))
    + " END"
)


def prompts(expression: str) -> str:
    return f"SELECT conv_id, turn, {expression} AS prompt FROM conversations"


def oracle() -> dict[str, str]:
    doc_search = search(ASKED, "SELECT doc_id AS id, text FROM documents", 5)
    one_question = f"SELECT 1 AS query_id, {lit(q.QUESTION)} AS text"
    steps = lit(prompt.STEPS)
    # a Poisson variable with mean one, by its distribution function
    below = [sum(exp(-1) / factorial(j) for j in range(k + 1)) for k in range(9)]
    weight = " + ".join(f"(u >= {x!r}::DOUBLE)::INT" for x in below)
    return {
        "bronze_file_scan": """SELECT 'page-' || page_id || '.html' AS name, strlen(html) AS length, md5(html) AS content_md5
            FROM pages""",
        "bronze_overwrite_roundtrip": "SELECT url AS path, strlen(html) AS length, md5(html) AS content_md5 FROM pages",
        "manifest_last_wins": """SELECT page_id AS ord, regexp_extract(url, '([^/]*)$', 1) AS name, url FROM pages
            QUALIFY row_number() OVER (PARTITION BY name ORDER BY page_id DESC) = 1""",
        "landing_status": """
            SELECT source AS name, 'documents/' || source AS url, 'LANDED' AS status,
                   sum(strlen(doc_id::VARCHAR) + 1)::BIGINT AS landed_bytes FROM documents GROUP BY source
            UNION ALL
            SELECT DISTINCT h, '//' || h, 'MISSING', 0
            FROM (SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS h FROM pages)""",
        "stage_counts": f"""WITH RECURSIVE src AS (SELECT url AS path, {markup('html')} AS text FROM pages), {boundary('src')}
            SELECT 'bronze' AS stage, count(*) AS n FROM pages
            UNION ALL SELECT 'silver', count(*) FROM src UNION ALL SELECT 'gold', count(*) FROM gold""",
        "namespace_from_user": f"""
            SELECT user_name, count(*) AS n,
                   regexp_replace(split_part(user_name, '@', 1), '[^\\p{{L}}\\p{{N}}_]', '_', 'g') AS namespace
            FROM (SELECT unnest(regexp_extract_all(text, '{t.EMAIL}')) AS user_name FROM documents)
            GROUP BY user_name""",
        "silver_extract_pages": f"""SELECT url AS path, '1' AS num_pages, {markup('html')} AS parsed_content,
            'SUCCESS' AS parser_status FROM pages""",
        "silver_page_concat": """SELECT 'conv/' || conv_id AS path, count(*)::VARCHAR AS num_pages,
            string_agg(text, chr(10) ORDER BY turn) AS parsed_content FROM conversations GROUP BY conv_id""",
        "silver_status_counts": f"""WITH {PAGES}
            SELECT CASE kind WHEN 1 THEN 'ERROR: empty content' WHEN 2 THEN 'ERROR: content is not UTF-8'
                   WHEN 3 THEN 'ERROR: no extractor for .bin' WHEN 4 THEN 'ERROR: no content' ELSE 'SUCCESS' END AS status,
                   count(*) AS n FROM pg GROUP BY ALL""",
        "gold_boundary_chunks": f"WITH RECURSIVE {DOCS}, {boundary('src')} SELECT * FROM gold",
        "gold_fixed_chunks": f"WITH {DOCS}, {fixed('src')} SELECT * FROM gold",
        "gold_chunk_stats": f"""WITH RECURSIVE {DOCS}, {boundary('src')}
            SELECT path, count(*) AS n_chunks, min(length(chunked_text)) AS min_chars,
                   round(avg(length(chunked_text)), 4) AS avg_chars, max(length(chunked_text)) AS max_chars
            FROM gold GROUP BY path""",
        "gold_dropped_docs": f"""WITH {PAGES}
            SELECT name AS path, CASE kind WHEN 1 THEN 'ERROR: empty content' WHEN 2 THEN 'ERROR: content is not UTF-8'
                   WHEN 3 THEN 'ERROR: no extractor for .bin' WHEN 4 THEN 'ERROR: no content' ELSE 'SUCCESS' END
                   AS parser_status
            FROM pg WHERE kind BETWEEN 1 AND 4 OR {markup('html')} = ''""",
        "index_dedupe": f"WITH {DOCS}, {fixed('src')}, {INDEX} SELECT * FROM idx",
        "gold_change_feed": f"""{VERSIONS},
            k1 AS (SELECT DISTINCT path, chunk_id FROM g1), k2 AS (SELECT DISTINCT path, chunk_id FROM g2)
            SELECT coalesce(k1.path, k2.path) AS path, coalesce(k1.chunk_id, k2.chunk_id) AS chunk_id,
                   CASE WHEN k1.path IS NULL THEN 'insert' ELSE 'delete' END AS change_type
            FROM k1 FULL JOIN k2 ON k1.path = k2.path AND k1.chunk_id = k2.chunk_id
            WHERE k1.path IS NULL OR k2.path IS NULL""",
        "index_apply_changes": f"""{VERSIONS}
            SELECT chunk_id, min(chunked_text) AS chunked_text, min(path) AS path, count(DISTINCT path) AS n_sources
            FROM g2 GROUP BY chunk_id""",
        "stream_index_feed": f"""{VERSIONS}
            SELECT chunk_id, min(chunked_text) AS chunked_text, min(path) AS path, count(DISTINCT path) AS n_sources
            FROM g2 GROUP BY chunk_id""",
        "stream_gold_chunks": f"""WITH RECURSIVE src AS (
              SELECT 'doc/' || doc_id AS path, CASE WHEN doc_id % 10 = 0 THEN 'Revised. ' || text ELSE text END AS text
              FROM documents), {boundary('src')} SELECT * FROM gold""",
        "knn_lsh": f"""WITH dirs AS (
              SELECT b, list((('0x' || substr(md5(b || ':' || j), 1, 8))::BIGINT / 2147483648.0 - 1)::DOUBLE ORDER BY j) AS d
              FROM range(0, {q.LSH_TABLES * q.LSH_WIDTH}) t(b), range(0, 64) u(j) GROUP BY b),
            emb AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
            buckets AS (SELECT id, b // {q.LSH_WIDTH} AS tab, sum(CASE WHEN list_inner_product(v, d) > 0 THEN 1 << (b % {q.LSH_WIDTH}) ELSE 0 END)
                        AS bucket FROM emb, dirs GROUP BY ALL),
            near AS (SELECT DISTINCT x.id AS query_id, y.id FROM buckets x JOIN buckets y USING (tab, bucket)),
            s AS (SELECT query_id, near.id, list_cosine_similarity(x.v, y.v) AS sc
                  FROM near JOIN emb x ON x.id = query_id JOIN emb y ON y.id = near.id)
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round(sc, 6) DESC, id) AS rank, id,
                   round(sc, 6) AS score FROM s QUALIFY rank <= {q.K}""",
        "knn_exact": f"""WITH parts AS (
              SELECT label, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings),
            means AS (SELECT label, pos, avg(x::DOUBLE) AS x FROM parts GROUP BY ALL),
            qs AS (SELECT label AS query_id, list(x ORDER BY pos) AS v FROM means GROUP BY label),
            s AS (SELECT query_id, vec_id AS id, list_cosine_similarity(v, embedding::DOUBLE[]) AS sc
                  FROM qs, embeddings)
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round(sc, 6) DESC, id) AS rank, id,
                   round(sc, 6) AS score FROM s QUALIFY rank <= {q.K}""",
        "knn_exact_each": f"""WITH emb AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
            s AS (SELECT x.id AS query_id, y.id, list_cosine_similarity(x.v, y.v) AS sc
                  FROM emb x JOIN emb y ON x.id % 50 = 0)
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round(sc, 6) DESC, id) AS rank, id,
                   round(sc, 6) AS score FROM s QUALIFY rank <= {q.K}""",
        "search_text_tfidf": f"""WITH {search(ASKED, "SELECT doc_id AS id, text FROM documents", q.K)}
            SELECT query_id, rank, id, score FROM hits""",
        "search_top1": f"{over_index(ASKED, 1)} SELECT query_id, chunked_text FROM found",
        "search_result_arrays": f"""{over_index(ASKED, q.K)}
            SELECT query_id, string_agg(chunk_id || '|' || path, ';' ORDER BY rank) AS data_array
            FROM found GROUP BY query_id""",
        "retriever_docs": f"{over_index(ASKED, 5)} SELECT query_id, rank, chunk_id, chunked_text, path, n_sources FROM found",
        "retriever_by_document": f"""{over_index(ASKED, 5)}
            SELECT query_id, path, count(*) AS n_hits, min(rank) AS best_rank,
                   string_agg(chunk_id, ',' ORDER BY rank) AS chunk_ids FROM found GROUP BY query_id, path""",
        "search_collect_set": f"""{over_index(ASKED, 5)}
            SELECT query_id, '[' || string_agg(DISTINCT chunked_text, ', ' ORDER BY chunked_text) || ']' AS found
            FROM found GROUP BY query_id""",
        "search_function": f"""{over_index(one_question, 5)}
            SELECT '[' || string_agg(DISTINCT chunked_text, ', ' ORDER BY chunked_text) || ']' AS found FROM found""",
        "search_table_function": f"""{over_index(one_question, 5)}
            SELECT rank, score, chunk_id, path, chunked_text FROM found""",
        "rag_context": f"""{over_index(ASKED, q.K)}, {CONTEXT}
            SELECT query_id, coalesce(n_docs, 0) AS n_docs, coalesce(context, '') AS context
            FROM q LEFT JOIN ctx USING (query_id)""",
        "search_no_hits": f"""{over_index(f"{ASKED} UNION ALL SELECT item_id + 1000000, md5(text) FROM benchmark", q.K)}, {CONTEXT}
            SELECT query_id, coalesce(n_docs, 0) AS n_docs, coalesce(context, '') AS context
            FROM q LEFT JOIN ctx USING (query_id)""",
        "embed_chunks_hashed": f"""WITH {DOCS}, {fixed('src')}, {INDEX}, {hashed('c', IN_INDEX)}
            SELECT id AS chunk_id, slot, round(w / len, 6) AS weight FROM c_w JOIN c_len USING (id)""",
        "search_embedded": f"""WITH {DOCS}, {fixed('src')}, {INDEX}, {hashed('c', IN_INDEX)},
            {hashed('a', "SELECT item_id AS id, text FROM benchmark")},
            s AS (SELECT a_w.id AS query_id, c_w.id, round(sum(c_w.w / c_len.len * (a_w.w / a_len.len)), 6) AS score
                  FROM c_w JOIN c_len USING (id) JOIN a_w USING (slot) JOIN a_len ON a_len.id = a_w.id GROUP BY ALL)
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score
            FROM s QUALIFY rank <= {q.K}""",
        "embed_chunks": f"""WITH {DOCS}, {fixed('src')}, {INDEX}
            SELECT chunk_id, length(chunked_text) AS chars, length(chunked_text) - length(replace(chunked_text, ' ', ''))
                   AS spaces, length(chunked_text) - length(replace(chunked_text, 'e', '')) AS e FROM idx""",
        "prompt_instruction": prompts(
            fill(prompt.INSTRUCTION, instruction=lit("Describe the tone of this message."), input="text")
        ),
        "prompt_labels": prompts(classify("text", "\nExplain your choice in the manner of a ship's captain.")),
        "prompt_stepwise": prompts(f"'Answer this question.' || chr(10) || chr(10) || text || chr(10) || {steps}"),
        "prompt_few_shot": """WITH few AS (
              SELECT string_agg('Q: ' || n_name || chr(10) || 'A: ' || r_name, chr(10) || chr(10) ORDER BY n_nationkey)
                     AS block
              FROM (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey ORDER BY n_nationkey LIMIT 3))
            SELECT s_suppkey, (SELECT block FROM few) || chr(10) || chr(10) || 'Q: ' || n_name || chr(10) || 'A:' AS prompt
            FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
        "prompt_context": f"""{STATE}
            SELECT conv_id, 'Answer this question.' || chr(10) || chr(10) || question || chr(10) || chr(10)
                   || 'Use this context:' || chr(10) || formatted_history || chr(10) || chr(10) || {steps} AS prompt
            FROM state""",
        "route_requests": f"{EVAL} SELECT prompt_id, {ROUTE} AS route FROM ev",
        "label_parse": f"""WITH o AS (
              SELECT conv_id, turn, {TONE.format(classify('text'))} AS text_output FROM conversations),
            l AS (SELECT *, upper(regexp_extract(text_output, '(?i)\\b(Happy|Unhappy|Neutral)\\b', 1)) AS f FROM o)
            SELECT conv_id, turn, text_output, CASE WHEN f = '' THEN 'INVALID' ELSE f END AS label FROM l""",
        "batch_complete": """SELECT conv_id, turn, md5(text) || ' ' || length(text) || ' max_tokens=100,temperature='
            || turn % 3 AS text_output, 'SUCCESS' AS status FROM conversations""",
        "batch_complete_paced": """SELECT item_id AS query_id, md5(text) || ' ' || length(text) || ' ' AS text_output,
            'SUCCESS' AS status FROM benchmark""",
        "chat_question": f"{STATE} SELECT conv_id, question FROM state",
        "chat_history": f"""WITH {MESSAGES} SELECT conv_id, turn, role, content FROM msg
            QUALIFY turn < max(turn) OVER (PARTITION BY conv_id)""",
        "chat_formatted_history": f"{STATE} SELECT conv_id, n_messages, formatted_history FROM state",
        "chat_rewrite_prompt": f"{STATE} SELECT conv_id, {REWRITE} AS prompt FROM state WHERE n_messages > 1",
        "chat_search_query": f"{STATE} SELECT conv_id, question, {QUERY_TEXT} AS search_query FROM state",
        "chat_generation_messages": f"""{STATE},
            {over_index("SELECT conv_id AS query_id, question AS text FROM state", 1).replace("WITH ", "", 1)}, {CONTEXT}
            SELECT conv_id, -1 AS pos, 'system' AS role, {lit(chat.SYSTEM)} AS content FROM state
            UNION ALL
            SELECT conv_id, turn, role, content FROM msg JOIN mx USING (conv_id)
            WHERE turn < last AND role IN ('user', 'assistant')
            UNION ALL
            SELECT conv_id, turn, 'user', {USER}
            FROM (SELECT conv_id, turn, content AS question FROM msg JOIN mx USING (conv_id) WHERE turn = last)
            LEFT JOIN ctx ON query_id = conv_id""",
        "rag_batch": f"""{STATE}, asked AS (SELECT *, {QUERY_TEXT} AS search_query FROM state),
            {over_index("SELECT conv_id AS query_id, search_query AS text FROM asked", q.K).replace("WITH ", "", 1)}, {CONTEXT}
            SELECT conv_id, question, search_query, coalesce(n_docs, 0) AS n_docs, coalesce(sources, '') AS sources,
                   'Reply: system: ' || {lit(chat.SYSTEM)} || chr(10)
                   || CASE WHEN formatted_history = '' THEN '' ELSE formatted_history || chr(10) END
                   || 'user: ' || {USER} AS answer, 'SUCCESS' AS status
            FROM asked LEFT JOIN ctx ON conv_id = query_id""",
        "eval_set_union": f"{EVAL} SELECT prompt_id, kind, prompt, demand FROM ev",
        "eval_requests_as_chat": f"""{EVAL} SELECT prompt_id AS conv_id, 0::BIGINT AS turn, 'user' AS role,
            prompt AS content FROM ev""",
        "eval_bulk_run": f"{RUN} SELECT prompt_id, kind, prompt, text_output, status FROM run",
        "eval_judge": f"{JUDGED} SELECT prompt_id, right_reply, right_tone, resists FROM judged",
        "eval_judge_client": f"""{RUN}, asked AS (
              SELECT prompt_id, status, {JUDGE_PROMPT} AS p FROM run)
            SELECT prompt_id, CASE WHEN status = 'SUCCESS' THEN NOT contains(p, 'useless') AND length(p) % 4 > 0 END
                   AS right_reply,
                   CASE WHEN status = 'SUCCESS' THEN NOT contains(p, 'useless') END AS right_tone,
                   CASE WHEN status = 'SUCCESS' AND length(p) % 5 > 0 THEN true END AS resists FROM asked""",
        "eval_rag": f"""{over_index(ASKED, q.K)}, {CONTEXT},
            asked AS (SELECT q.query_id, q.text AS question, coalesce(n_docs, 0) AS n_docs, coalesce(sources, '') AS sources,
                             coalesce(context, '') AS context FROM q LEFT JOIN ctx USING (query_id)),
            replied AS (SELECT *, CASE WHEN length('system: ' || {lit(chat.SYSTEM)} || chr(10) || 'user: ' || {USER}) % 3 = 0
                        THEN {lit(clients.GUESS)} ELSE split_part({USER}, chr(10), 2) END AS answer FROM asked)
            SELECT query_id AS conv_id, n_docs, sources, answer,
                   contains(lower(context), lower(trim(answer))) AND trim(answer) <> '' AS grounded FROM replied""",
        "eval_summary": f"""{JUDGED} SELECT kind, count(*) AS n, count(*) FILTER (status <> 'SUCCESS') AS n_failed, round(avg(right_reply::DOUBLE), 4) AS right_reply,
            round(avg(right_tone::DOUBLE), 4) AS right_tone, round(avg(resists::DOUBLE), 4) AS resists
            FROM judged GROUP BY ROLLUP (kind)""",
        "eval_intervals": f"""{JUDGED}, long AS (
              SELECT kind, prompt_id, 'right_reply' AS value, right_reply::INT::DOUBLE AS x FROM judged
              UNION ALL SELECT kind, prompt_id, 'right_tone', right_tone::INT::DOUBLE FROM judged
              UNION ALL SELECT kind, prompt_id, 'resists', resists::INT::DOUBLE FROM judged),
            part AS (
              SELECT kind, value, x, b, ('0x' || substr(md5(prompt_id || ':' || b), 1, 8))::BIGINT / 4294967296.0 AS u
              FROM long, range(-1, 200) r(b) WHERE x IS NOT NULL),
            sums AS (
              SELECT kind, value, b, sum(x * w) AS s, sum(w) AS w FROM (
                SELECT kind, value, x, b, CASE WHEN b < 0 THEN 1 ELSE {weight} END AS w FROM part)
              GROUP BY GROUPING SETS ((kind, value, b), (value, b))),
            rates AS (
              SELECT kind AS "group", value, max(s / w) FILTER (b < 0) AS rate,
                     list(s / w ORDER BY s / w) FILTER (b >= 0 AND w > 0) AS all_rates
              FROM sums GROUP BY kind, value)
            SELECT "group", value, round(rate, 6) AS rate, round(all_rates[ceil(len(all_rates) * 0.025)::INT], 6) AS low,
                   round(all_rates[ceil(len(all_rates) * 0.975)::INT], 6) AS high FROM rates""",
        "eval_retrieval": f"""WITH {doc_search},
            truth AS (SELECT query_id, c.id FROM q JOIN c ON contains(c.text, q.text)),
            best AS (SELECT query_id, min(rank) AS best FROM hits JOIN truth USING (query_id, id) GROUP BY query_id),
            item AS (SELECT query_id, query_id IN (SELECT query_id FROM truth) AS known, best
                     FROM q LEFT JOIN best USING (query_id))
            SELECT count(*) AS n_items, count(*) FILTER (known) AS n_with_truth,
                   round(avg((best IS NOT NULL)::INT::DOUBLE) FILTER (known), 4) AS hit_rate,
                   round(avg(coalesce(1 / best, 0)) FILTER (known), 4) AS mrr FROM item""",
    }
