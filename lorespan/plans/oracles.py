"""SQL that a second engine (DuckDB) runs on the same tables, one statement per registered query."""

from __future__ import annotations

from lorespan import fixed_values as fixed
from lorespan.operators.evaluate import OUTSIDE, poisson_steps
from lorespan.plans import queries as q

TOKEN = r"[^ \t\n\x0B\f\r]+"
WORD = r"[\p{L}\p{N}]+"
RUN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"
SENTENCE = r"[^.!?。！？\n]+"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _chunks(size: int, overlap: int, pattern: str = TOKEN, joiner: str = " ") -> str:
    stride = size - overlap
    return f"""
    cut AS (SELECT doc_id, source, regexp_extract_all(text, '{pattern}') AS t FROM documents),
    starts AS (SELECT *, unnest(range(CAST(ceil(len(t) / {stride}.0) AS BIGINT))) AS i FROM cut),
    chunks AS (
      SELECT doc_id, source, CAST(i AS INTEGER) AS chunk_no, CAST(ceil(len(t) / {stride}.0) AS INTEGER) AS num_chunks,
             array_to_string(t[i * {stride} + 1 : i * {stride} + {size}], '{joiner}') AS response
      FROM starts)"""


def _counts(text: str) -> str:
    buckets = (
        f"list_transform(regexp_extract_all(lower({text}), '{WORD}'), "
        "lambda w: CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 64)"
    )
    return f"(SELECT list_transform(range(64), lambda b: len(list_filter(bs, lambda x: x = b))) FROM (SELECT {buckets} AS bs))"


def _vector(counts: str) -> str:
    norm = f"sqrt(greatest(list_sum(list_transform({counts}, lambda c: c * c)), 1))"
    return f"list_transform({counts}, lambda c: CAST(CAST(c / {norm} AS FLOAT) AS DOUBLE))"


def _expand(text: str, dictionary: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{a.lower()}' THEN '{a} ({full})'" for a, full in dictionary.items())
    return f"array_to_string(list_transform(regexp_extract_all({text}, '{RUN}'), lambda r: CASE lower(r) {cases} ELSE r END), '')"


TURN_ID = "conv_id || '-' || turn"
DEMO = _chunks(fixed.DEMO_CHUNK_SIZE, fixed.DEMO_CHUNK_OVERLAP)
MICROS = "CAST(floor(greatest(a.n2 + b.n2 - 2 * list_inner_product(a.v, b.v), 0) * 1e6 + 0.5) AS BIGINT)"

INDEX = f"""{DEMO},
    counted AS (SELECT *, {_counts('response')} AS cnt FROM chunks),
    ix AS (SELECT doc_id || ':' || chunk_no AS chunk_id, doc_id, chunk_no, response, source, v,
                  list_inner_product(v, v) AS n2
           FROM (SELECT *, {_vector('cnt')} AS v FROM counted))"""


def _hits(expanded: bool) -> str:
    asked = _expand("text", fixed.ABBREVIATIONS) if expanded else "text"
    return f"""{INDEX},
    asked AS (SELECT {TURN_ID} AS question_id, conv_id, text AS question, {asked} AS asked
              FROM conversations WHERE role = 'user'),
    qc AS (SELECT *, {_counts('asked')} AS cnt FROM asked),
    qv AS (SELECT *, list_inner_product(v, v) AS n2 FROM (SELECT * EXCLUDE cnt, {_vector('cnt')} AS v FROM qc)),
    near AS (SELECT a.question_id, b.chunk_id, {MICROS} AS micros FROM qv a CROSS JOIN ix b),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY question_id ORDER BY micros, chunk_id) AS INTEGER) AS rank
               FROM near),
    hits AS (SELECT r.question_id, r.rank, r.chunk_id, r.micros / 1000000.0::DOUBLE AS distance, ix.response, ix.source,
                    asked.question, asked.asked, asked.conv_id
             FROM ranked r JOIN ix USING (chunk_id) JOIN asked USING (question_id) WHERE r.rank <= {fixed.HITS_PER_QUESTION})"""


def _good(column: str) -> str:
    refused = " OR ".join(f"contains(lower({column}), {_text(p)})" for p in q.PHRASES)
    return f"({column} IS NOT NULL AND NOT ({refused}))"


ANSWERS = f"""{_hits(True)},
    sent AS (SELECT question_id, rank, asked, source, unnest(s) AS s, generate_subscripts(s, 1) AS pos
             FROM (SELECT *, regexp_extract_all(response, '{SENTENCE}') AS s FROM hits)),
    scored AS (SELECT question_id, rank, source, trim(s) AS text, pos,
                      len(list_intersect(regexp_extract_all(lower(s), '{WORD}'), regexp_extract_all(lower(asked), '{WORD}'))) AS shared
               FROM sent WHERE trim(s) <> ''),
    quoted AS (SELECT question_id, rank, source, text, shared FROM scored WHERE shared > 0
               QUALIFY row_number() OVER (PARTITION BY question_id, rank ORDER BY shared DESC, pos) = 1),
    best AS (SELECT * FROM quoted WHERE {_good('text')}
             QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY rank) = 1),
    answers AS (SELECT a.question_id, a.conv_id, a.question, b.text AS answer, b.source,
                       '{{"shared_words":' || b.shared || '}}' AS output_metadata
                FROM asked a LEFT JOIN best b USING (question_id))"""

PAIRS = f"""
    turns AS (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS response
              FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
    contexts AS (SELECT conv_id, arg_min(text, turn) AS context FROM conversations WHERE role = 'system' GROUP BY conv_id),
    pairs AS (SELECT {TURN_ID} AS example_id, conv_id, turn, text AS instruction, context, response
              FROM turns LEFT JOIN contexts USING (conv_id) WHERE role = 'user' AND next_role = 'assistant')"""


def _instruction_text() -> str:
    head = _text(f"{fixed.PROMPT_INTRO}\n\n{fixed.INSTRUCTION_MARK}\n")
    block = _text(f"\n\n{fixed.INPUT_MARK}\n")
    tail = _text(f"\n\n{fixed.RESPONSE_MARK}")
    context = f"CASE WHEN coalesce(context, '') <> '' THEN {block} || context ELSE '' END"
    return f"'{{ ''prompt'': ' || {head} || instruction || {context} || {tail} || ', ''response'': ' || response || ' }}'"


TEXTS = f"{PAIRS},\n    texts AS (SELECT *, {_instruction_text()} AS text FROM pairs)"
IDS = f"""{TEXTS},
    cut_tokens AS (SELECT example_id, regexp_extract_all(text, '{TOKEN}') AS t FROM texts),
    ids AS (SELECT example_id, len(t) > {fixed.TRAIN_MAX_TOKENS} AS truncated,
                   list_transform(t[1:{fixed.TRAIN_MAX_TOKENS}], lambda w:
                     CAST(1 + CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 49999 AS INTEGER)) AS input_ids
            FROM cut_tokens)"""
SPLIT = f"""
    split AS (SELECT example_id,
                     CASE WHEN row_number() OVER (ORDER BY md5('{fixed.TRAIN_SEED}:' || example_id), example_id)
                            <= ceil({q.TEST_FRACTION}::DOUBLE * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
              FROM pairs)"""
EVAL = f"""{PAIRS},
    evals AS (
      SELECT 'strict' AS run_id, example_id AS question_id, instruction AS question,
             CASE WHEN {_good('response')} THEN response END AS answer,
             CASE WHEN {_good('response')} THEN 'conversation ' || conv_id END AS source FROM pairs
      UNION ALL
      SELECT 'open', example_id, instruction, response, 'conversation ' || conv_id FROM pairs)"""
REQUEST_ID = f"conv_id || '-' || (turn // {q.QUESTIONS_PER_REQUEST})"
RESPONSES = f"""
    responses AS (
      SELECT {REQUEST_ID} AS request_id,
             CAST(to_json({{'predictions': list({{'answer': text, 'source': 'conversation ' || conv_id,
                                                 'output_metadata': NULL}} ORDER BY turn)}}) AS VARCHAR) AS body
      FROM conversations WHERE role = 'assistant' GROUP BY conv_id, {REQUEST_ID})"""

_template = fixed.QUESTION_TEMPLATE.replace("{organisation}", q.ORGANISATION)
_before, _rest = _template.split("{context}")
_between, _after = _rest.split("{question}")
_gap = "\n" + " " * fixed.SERVING_INDENT
_serve_head = fixed.PROMPT_INTRO + _gap + fixed.INSTRUCTION_MARK + _gap
_serve_tail = _gap + fixed.RESPONSE_MARK + _gap
_first_good = f"""
    WITH best AS (SELECT conv_id, text AS answer, 'turn ' || turn AS source FROM conversations
                  WHERE role = 'assistant' AND {_good('text')}
                  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1)
    SELECT c.conv_id, best.answer, best.source, CAST(NULL AS VARCHAR) AS output_metadata
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN best USING (conv_id)"""
_generated = f"""
    SELECT {TURN_ID} AS question_id,
           CASE WHEN length(text) <= {q.LONGEST_PROMPT} THEN array_to_string(regexp_extract_all(text, '{TOKEN}')[1:5], ' ') END AS text,
           CASE WHEN length(text) > {q.LONGEST_PROMPT} THEN 'ValueError: prompt too long' END AS error
    FROM conversations WHERE role = 'user'"""
_lang_cases = (
    "list_transform(regexp_extract_all(text, '" + RUN + "'), lambda r: "
    "CASE WHEN upper(r) = 'DE' AND list_contains(codes, 'DE') THEN 'DE (language de or ' || CASE WHEN list_contains(codes, 'FR') THEN 'FR (language fr)' ELSE 'fr' END"
    " || ', see ' || CASE WHEN list_contains(codes, 'ES') THEN 'ES (language es)' ELSE 'es' END || ')' "
    "WHEN list_contains(codes, upper(r)) THEN upper(r) || ' (language ' || lower(r) || ')' ELSE r END)"
)
_expanded_table = f"""
        SELECT doc_id, array_to_string({_lang_cases}, '') AS response
        FROM documents, (SELECT list(DISTINCT upper(lang)) AS codes FROM documents)"""
_phrases_expanded = rf"""
        WITH RECURSIVE opened AS (
          SELECT item_id, unnest([1, 2, 3, 4]) AS n, string_split(regexp_extract(text, '^[\p{{L}}\p{{N}}_]+(?: [\p{{L}}\p{{N}}_]+)*'), ' ') AS w FROM benchmark
        ), entries AS (
          SELECT array_to_string(w[1:n], ' ') AS abbreviation, item_id + n * 1000000 AS position, 'opening' || n AS full_text FROM opened WHERE w[1] <> ''
        ), e AS (
          SELECT word, best.abbreviation || ' (' || best.full_text || ')' AS replacement, 2 * len(string_split(word, ' ')) - 1 AS n
          FROM (SELECT lower(abbreviation) AS word, min({{'position': position, 'abbreviation': abbreviation, 'full_text': full_text}}) AS best FROM entries GROUP BY 1)
        ), d AS (
          SELECT doc_id, unnest(r) AS run, generate_subscripts(r, 1) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{RUN}') AS r FROM documents)
        ), ahead AS (
          SELECT doc_id, i, run AS r1, lead(run, 1) OVER w || lead(run, 2) OVER w AS r2, lead(run, 3) OVER w || lead(run, 4) OVER w AS r3,
                 lead(run, 5) OVER w || lead(run, 6) OVER w AS r4
          FROM d WINDOW w AS (PARTITION BY doc_id ORDER BY i)
        ), starts AS (
          SELECT doc_id, i, n, lower(word) AS word
          FROM (SELECT doc_id, i, unnest([1, 3, 5, 7]) AS n, unnest([r1, r1 || r2, r1 || r2 || r3, r1 || r2 || r3 || r4]) AS word FROM ahead)
          WHERE word IS NOT NULL
        ), m AS (
          SELECT doc_id, i, starts.n, replacement FROM starts JOIN e USING (word, n)
          QUALIFY row_number() OVER (PARTITION BY doc_id, i ORDER BY starts.n DESC) = 1
        ), linked AS (
          SELECT a.*, b.i AS next FROM m a ASOF LEFT JOIN (SELECT doc_id AS other, i FROM m) b ON a.doc_id = b.other AND a.i + a.n <= b.i
        ), chosen AS (
          SELECT * FROM (SELECT * FROM linked QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY i) = 1)
          UNION ALL SELECT linked.* FROM chosen JOIN linked ON linked.doc_id = chosen.doc_id AND linked.i = chosen.next
        ), covered AS (
          SELECT doc_id, i AS first, replacement, unnest(range(i, i + n)) AS i FROM chosen
        ), pieces AS (
          SELECT doc_id, i, CASE WHEN first IS NULL THEN run WHEN first = i THEN replacement ELSE '' END AS piece
          FROM d LEFT JOIN covered USING (doc_id, i)
        )
        SELECT doc_id, coalesce(response, '') AS response
        FROM (SELECT doc_id FROM documents) LEFT JOIN (SELECT doc_id, string_agg(piece, '' ORDER BY i) AS response FROM pieces GROUP BY 1) USING (doc_id)"""
_opening_filter = r"""
        WITH phrases AS (SELECT DISTINCT lower(regexp_extract(text, '^[^ \n]+ [^ \n]+')) AS phrase FROM benchmark)
        SELECT conv_id, turn, text AS answer FROM conversations WHERE role = 'assistant'
          AND NOT EXISTS (SELECT 1 FROM phrases WHERE phrase <> '' AND contains(lower(text), phrase))"""
_readings = f"""{_hits(True)},
    prompts AS (SELECT *, {_text(_before)} || response || {_text(_between)} || asked || {_text(_after)} AS prompt FROM hits),
    read AS (SELECT *, length(prompt) % 5 = 0 AS failed, array_to_string(regexp_extract_all(response, '{TOKEN}')[1:8], ' ') AS text FROM prompts),
    tried AS (SELECT *, min(CASE WHEN NOT failed AND {_good('text')} THEN rank END) OVER (PARTITION BY question_id) AS best FROM read)"""
_mixed = f"""
    mixed AS (SELECT {TURN_ID} AS request_id, text, (conv_id * 3 + turn) % 8 AS kind FROM conversations)"""

_index_rows = f"""
        WITH {INDEX} SELECT chunk_id, doc_id, chunk_no, source, CAST(length(response) AS INTEGER) AS n_chars,
          round(n2, 6) AS norm FROM ix"""
_knn_vectors = f"""
    WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    n AS (SELECT *, list_inner_product(v, v) AS n2 FROM e),
    near AS (SELECT a.vec_id AS query_id, b.vec_id, {MICROS} AS micros FROM n a CROSS JOIN n b)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY micros, vec_id) AS INTEGER) AS rank,
           vec_id, micros / 1000000.0::DOUBLE AS distance
    FROM near QUALIFY rank <= {fixed.HITS_PER_QUESTION}"""

SQL: dict[str, str] = {
    "source_count": "SELECT count(*) AS n_rows FROM documents",
    "project_sources": "SELECT doc_id, text AS response, source FROM documents",
    "longest_document": """
        SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, text AS response
        FROM documents ORDER BY length(text) DESC, doc_id LIMIT 1""",
    "chunk_documents": f"WITH {DEMO} SELECT doc_id, source, num_chunks, chunk_no, response FROM chunks",
    "chunk_documents_wide": f"""
        WITH {_chunks(fixed.CHUNK_SIZE, fixed.CHUNK_OVERLAP)}
        SELECT doc_id, source, num_chunks, chunk_no, response FROM chunks""",
    "chunk_characters": f"""
        WITH {_chunks(fixed.CHUNK_SIZE, fixed.CHUNK_OVERLAP, '(?s).', '')}
        SELECT doc_id, source, num_chunks, chunk_no, response FROM chunks""",
    "chunk_counts": f"""
        WITH {DEMO} SELECT doc_id, CAST(count(*) AS INTEGER) AS num_chunks FROM chunks GROUP BY doc_id""",
    "chunk_metadata": f"""
        WITH {DEMO} SELECT response,
          CAST(to_json({{'doc_id': doc_id, 'source': source, 'chunk_no': chunk_no}}) AS VARCHAR) AS metadata FROM chunks""",
    "hash_embed_documents": f"""
        SELECT doc_id, CAST(CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 64 AS INTEGER) AS bucket,
               CAST(count(*) AS INTEGER) AS n
        FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS w FROM documents) GROUP BY 1, 2""",
    "build_index": _index_rows,
    "refreshed_index": _index_rows,
    "chunk_with_tokenizer": f"WITH {DEMO} SELECT doc_id, source, num_chunks, chunk_no, response FROM chunks",
    "embed_with_model": """
        SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, CAST(length(text) - length(replace(text, chr(10), '')) AS INTEGER) AS n_lines
        FROM documents""",
    "bucketed_index": f"WITH {DEMO} SELECT doc_id, response, source FROM chunks WHERE chunk_no = 0",
    "knn_vectors": _knn_vectors,
    "knn_vectors_by_blocks": _knn_vectors,
    "knn_vectors_bounded": _knn_vectors,
    "knn_vectors_pivots": _knn_vectors,
    "vector_distances": """
        WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
        anchors AS (SELECT label, arg_min(v, vec_id) AS a FROM e GROUP BY label)
        SELECT vec_id,
               round(list_sum(list_transform(list_zip(v, a), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 6) AS squared_l2,
               round(list_cosine_similarity(v, a), 6) AS cosine
        FROM e JOIN anchors USING (label)""",
    "retrieve_documents": f"""
        WITH {_hits(False)} SELECT question_id, rank, chunk_id, distance, response, source FROM hits""",
    "render_prompts": f"""
        WITH {_hits(False)} SELECT question_id, rank,
          {_text(_before)} || response || {_text(_between)} || question || {_text(_after)} AS prompt FROM hits""",
    "expand_abbreviations": f"SELECT doc_id, {_expand('text', q.DICTIONARY)} AS response FROM documents",
    "expand_abbreviations_table": _expanded_table,
    "expand_abbreviations_join": _expanded_table,
    "expand_phrases": _phrases_expanded,
    "expand_phrases_blocks": _phrases_expanded,
    "filter_bad_answers": f"""
        SELECT conv_id, turn, text AS answer FROM conversations WHERE role = 'assistant' AND {_good('text')}""",
    "filter_bad_answers_table": _opening_filter,
    "filter_bad_answers_blocks": _opening_filter,
    "first_good_answer": _first_good,
    "cascade_answers": _first_good,
    "answer_questions": f"""
        WITH {ANSWERS} SELECT question_id, question, answer, source, output_metadata FROM answers""",
    "answer_with_model": f"""
        WITH {_readings}
        SELECT a.question_id, a.text AS question, t.text AS answer, t.source, CAST(NULL AS VARCHAR) AS output_metadata
        FROM (SELECT {TURN_ID} AS question_id, text FROM conversations WHERE role = 'user') a
        LEFT JOIN tried t ON t.question_id = a.question_id AND t.rank = t.best""",
    "answer_failures": f"""
        WITH {_readings} SELECT DISTINCT asked, rank, 'ValueError: no room' AS error FROM tried
        WHERE failed AND (best IS NULL OR rank < best)""",
    "generate_batches": _generated,
    "generate_resumed": _generated,
    "route_failures": f"""
        WITH made AS ({_generated})
        SELECT 'ok' AS route, count(*) AS n FROM made WHERE error IS NULL
        UNION ALL SELECT 'failed', count(*) FROM made WHERE error IS NOT NULL""",
    "instruct_batches": f"""
        WITH asked AS (SELECT {TURN_ID} AS question_id, text, CASE WHEN turn > 0 THEN turn + 2 ELSE 100 END AS max_tokens
                       FROM conversations WHERE role = 'user')
        SELECT question_id, 1.0::DOUBLE AS temperature, max_tokens,
               'line  one' || chr(10) || array_to_string(regexp_extract_all(text, '{TOKEN}')[1:max_tokens], chr(10) || '    ') || ' ' AS text
        FROM asked""",
    "serving_prompts": f"""
        SELECT {TURN_ID} AS question_id, {_text(_serve_head)} || text || {_text(_serve_tail)} AS prompt
        FROM conversations WHERE role = 'user'""",
    "sft_pairs": f"WITH {PAIRS} SELECT * FROM pairs",
    "sft_text": f"WITH {TEXTS} SELECT example_id, text FROM texts",
    "sft_tokens": f"""
        WITH {IDS} SELECT example_id, CAST(len(input_ids) AS INTEGER) AS n_tokens, truncated,
          array_to_string(input_ids, ',') AS input_ids FROM ids""",
    "sft_split": f"WITH {PAIRS}, {SPLIT} SELECT example_id, split FROM split",
    "split_complement": f"WITH {PAIRS}, {SPLIT} SELECT example_id, split AS part FROM split",
    "sft_dataset": f"""
        WITH {IDS}, {SPLIT} SELECT example_id, split, truncated, CAST(len(input_ids) AS INTEGER) AS n_tokens
        FROM ids JOIN split USING (example_id)""",
    "collate_batches": f"""
        WITH {IDS},
        batched AS (SELECT *, (row_number() OVER (ORDER BY md5('{fixed.TRAIN_SEED}:' || example_id), example_id) - 1) // 8 AS batch FROM ids),
        padded AS (SELECT example_id, batch, len(input_ids) AS n, input_ids,
                     max(len(input_ids)) OVER (PARTITION BY batch) - len(input_ids) AS pad FROM batched)
        SELECT example_id, batch,
               array_to_string(list_concat(input_ids, list_transform(range(pad), lambda i: 0)), ',') AS input_ids,
               array_to_string(list_concat(list_transform(range(n), lambda i: 1), list_transform(range(pad), lambda i: 0)), ',') AS attention_mask,
               array_to_string(list_concat(input_ids, list_transform(range(pad), lambda i: {fixed.IGNORED_LABEL})), ',') AS labels
        FROM padded""",
    "eval_outputs": f"WITH {EVAL} SELECT question, run_id, question_id, answer, source FROM evals",
    "eval_summary": rf"""
        WITH {EVAL},
        sized AS (SELECT *, len(regexp_extract_all(answer, '{TOKEN}')) AS n,
                         length(regexp_replace(answer, '[^\p{{L}}\p{{N}}]', '', 'g')) AS chars,
                         greatest(len(regexp_extract_all(answer, '{SENTENCE}')), 1) AS sentences FROM evals)
        SELECT run_id, count(*) AS n_questions, count(answer) AS n_answered,
               round(count(answer)::DOUBLE / count(*), 6) AS answered_rate,
               round(avg(CASE WHEN answer IS NOT NULL THEN n END), 6) AS mean_tokens,
               round(avg(CASE WHEN n > 0 THEN 4.71::DOUBLE * (chars::DOUBLE / n) + 0.5::DOUBLE * n / sentences - 21.43::DOUBLE END), 6) AS mean_ari
        FROM sized GROUP BY run_id""",
    "eval_exact_match": f"""
        WITH {EVAL} SELECT run_id, count(*) AS n_questions,
          round(sum(CASE WHEN answer = response THEN 1 ELSE 0 END)::DOUBLE / count(*), 6) AS exact_match
        FROM evals JOIN pairs ON question_id = example_id GROUP BY run_id""",
    "eval_compare": f"""
        WITH {EVAL},
        results AS (SELECT run_id, question_id, answer FROM evals
                    UNION ALL SELECT 'short', example_id, array_to_string(regexp_extract_all(response, '{TOKEN}')[1:5], ' ') FROM pairs),
        listed AS (SELECT run_id, question_id, answer, response, regexp_extract_all(lower(coalesce(answer, '')), '{WORD}') AS said,
                          regexp_extract_all(lower(response), '{WORD}') AS wanted
                   FROM results JOIN pairs ON question_id = example_id),
        shared AS (SELECT *, len(said) + len(wanted) AS n,
                          coalesce(list_sum(list_transform(list_distinct(said), lambda w:
                            least(len(list_filter(said, lambda x: x = w)), len(list_filter(wanted, lambda x: x = w))))), 0) AS shared FROM listed),
        scores AS (SELECT run_id, question_id, unnest([
                     {{'metric': 'answered', 'value': CASE WHEN answer IS NULL THEN 0 ELSE 1000000 END}},
                     {{'metric': 'exact', 'value': CASE WHEN answer = response THEN 1000000 ELSE 0 END}},
                     {{'metric': 'f1', 'value': CASE WHEN answer IS NULL OR n = 0 THEN 0 ELSE (2000000 * shared) // n END}}]) AS m FROM shared),
        gaps AS (SELECT a.run_id AS run_a, b.run_id AS run_b, a.m.metric AS metric, a.question_id, b.m.value - a.m.value AS gap
                 FROM scores a JOIN scores b ON a.question_id = b.question_id AND a.m.metric = b.m.metric AND a.run_id < b.run_id),
        numbers AS (SELECT question_id, draw, CAST('0x' || substr(md5(question_id || ':' || draw), 1, 8) AS BIGINT) AS u
                    FROM (SELECT DISTINCT question_id FROM scores), range(0, {q.EVAL_DRAWS} + 1) AS d(draw)),
        weights AS (SELECT question_id, draw, CASE WHEN draw = 0 THEN 1 ELSE {' + '.join(f'(u >= {step})::INT' for step in poisson_steps())} END AS w FROM numbers),
        means AS (SELECT run_a, run_b, metric, draw, sum(w) AS n, (sum(w * gap)::DOUBLE / sum(w)::DOUBLE) / 1e6::DOUBLE AS mean
                  FROM gaps JOIN weights USING (question_id) WHERE w > 0 GROUP BY ALL),
        sorted AS (SELECT run_a, run_b, metric, max(n) FILTER (draw = 0) AS n_questions, max(mean) FILTER (draw = 0) AS difference,
                          list(mean ORDER BY mean) FILTER (draw > 0) AS m FROM means GROUP BY ALL)
        SELECT run_a, run_b, metric, CAST(n_questions AS BIGINT) AS n_questions, round(difference, 9) AS difference,
               round(m[CAST(floor(len(m) * {OUTSIDE / 2}) AS INTEGER) + 1], 9) AS low,
               round(m[len(m) - CAST(floor(len(m) * {OUTSIDE / 2}) AS INTEGER)], 9) AS high
        FROM sorted""",
    "latest_named_version": """
        SELECT source AS name, max(doc_id) AS version, 'index/' || source || '/' || max(doc_id) AS path
        FROM documents WHERE source = 'src3' GROUP BY source""",
    "stored_sources": "SELECT doc_id, text AS response, source FROM documents",
    "listed_files": "SELECT CAST(sum(length(doc_id::VARCHAR) + 1) AS BIGINT) AS n_bytes FROM documents",
    "previewed_sources": "SELECT least(count(*), 20) AS n_rows FROM documents",
    "marker_ids": """
        SELECT 0 AS reserved, 7 AS stored, CAST(1 + CAST('0x' || substr(md5('the'), 1, 8) AS BIGINT) % 49999 AS INTEGER) AS word
        FROM (SELECT count(*) FROM documents)""",
    "latest_version": """
        SELECT source AS name, max(doc_id) AS version, 'index/' || source || '/' || max(doc_id) AS path
        FROM documents GROUP BY source""",
    "resolve_alias": f"""
        SELECT source AS name, max(doc_id) AS version, 'index/' || source || '/' || max(doc_id) AS path,
               'models:/main.qa.' || source || '@{fixed.PRODUCTION_ALIAS}' AS uri
        FROM documents JOIN labels USING (doc_id) WHERE quality = 1 GROUP BY source""",
    "encode_requests": f"""
        WITH pages AS (SELECT conv_id, {REQUEST_ID} AS request_id, list(text ORDER BY turn) AS asked
                       FROM conversations WHERE role = 'user' GROUP BY conv_id, {REQUEST_ID})
        SELECT request_id, CASE WHEN conv_id % 2 = 0
          THEN CAST(to_json({{'inputs': {{'question': asked}}}}) AS VARCHAR)
          ELSE CAST(to_json({{'dataframe_split': {{'index': range(len(asked)), 'columns': ['question'],
                                                  'data': list_transform(asked, lambda x: [x])}}}}) AS VARCHAR) END AS body
        FROM pages""",
    "parse_requests": f"""
        SELECT request_id, pos, request_id || '/' || pos AS question_id, text AS question
        FROM (SELECT {REQUEST_ID} AS request_id, text,
                CAST(row_number() OVER (PARTITION BY {REQUEST_ID} ORDER BY turn) - 1 AS INTEGER) AS pos
              FROM conversations WHERE role = 'user')""",
    "unreadable_requests": f"""
        WITH {_mixed}, bodies AS (
          SELECT request_id, kind, CASE kind WHEN 6 THEN substr(text, 1, 20)
            WHEN 7 THEN substr(j, 1, length(j) - 3) END AS body
          FROM (SELECT *, CAST(to_json({{'inputs': {{'question': [text]}}}}) AS VARCHAR) AS j FROM mixed))
        SELECT request_id, body, 'unreadable request' AS error FROM bodies WHERE kind >= 5""",
    "parse_mixed_requests": f"""
        WITH {_mixed} SELECT request_id, CAST(0 AS INTEGER) AS pos, request_id || '/0' AS question_id, text AS question
        FROM mixed WHERE kind < 4""",
    "respond_to_all": f"""
        WITH {_mixed} SELECT request_id, CASE WHEN kind = 4 THEN '{{"predictions":[]}}' ELSE
          CAST(to_json({{'predictions': [{{'answer': text, 'source': NULL, 'output_metadata': NULL}}]}}) AS VARCHAR) END AS body
        FROM mixed WHERE kind < 5""",
    "format_responses": f"WITH {RESPONSES} SELECT request_id, body FROM responses",
    "first_predictions": f"""
        SELECT {REQUEST_ID} AS request_id, arg_min(text, turn) AS answer, 'conversation ' || conv_id AS source
        FROM conversations WHERE role = 'assistant' GROUP BY conv_id, {REQUEST_ID}""",
    "response_status": """
        SELECT conv_id, turn, CAST(CASE WHEN turn % 5 = 1 THEN 500 WHEN turn % 5 = 3 THEN NULL ELSE 200 END AS INTEGER) AS status,
               CASE WHEN turn % 5 = 1 THEN 'Request failed with status 500, ' || coalesce(text, '')
                    WHEN turn % 5 = 3 THEN 'Request failed with status None, ' || coalesce(text, '') END AS error
        FROM conversations WHERE role = 'assistant'""",
    "mention_events": f"""
        SELECT {TURN_ID} AS question_id, CAST(conv_id AS VARCHAR) AS channel, role AS "user", text AS question
        FROM conversations WHERE role = 'user'""",
    "stream_answers": f"""
        WITH {ANSWERS} SELECT question_id, CAST(conv_id AS VARCHAR) AS channel,
          coalesce(answer, 'None') || {_text(chr(46) + '  ' + chr(10) + ' Source: ')} || coalesce(source, 'None') AS message
        FROM answers""",
}
