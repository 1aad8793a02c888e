"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string runs on views named after the driver tables. Column names and
types match the Spark results. The fixed texts come from the same constants
the Spark side uses, so both sides render identical prompts.
"""

from __future__ import annotations

from weft.functions import prompts as R
from weft.functions import validators as V
from weft.functions.text import WS_CLASS
from weft.operators import completion as E
from weft.operators.routing import FALLBACK_RESPONSE
from weft.plans import catalog as C
from weft.plans import presets as P


def lit(s: str | None) -> str:
    """A Python string as a DuckDB expression (newlines and control characters via chr())."""
    if s is None:
        return "NULL::VARCHAR"
    parts, buf = [], []
    for ch in s:
        if ch == "'" or ch >= " ":
            buf.append("''" if ch == "'" else ch)
        else:
            if buf:
                parts.append("'" + "".join(buf) + "'")
                buf = []
            parts.append(f"chr({ord(ch)})")
    if buf or not parts:
        parts.append("'" + "".join(buf) + "'")
    return "(" + " || ".join(parts) + ")"


WS = WS_CLASS + "+"


def NORM(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}', ' ', 'g'))"


def USTRIP(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}|{WS}$', '', 'g')"


def TOKENS(x: str) -> str:
    return f"list_filter(string_split(lower({NORM(x)}), ' '), lambda t: t <> '')"


def BUCKET(x: str, dim: int = 65536) -> str:
    return f"((('0x' || substr(md5({x}), 1, 8))::UBIGINT % {dim})::INTEGER)"


def SENTENCES(x: str) -> str:
    return f"string_split(regexp_replace({NORM(x)}, '([.!?]) ', '\\1' || chr(10), 'g'), chr(10))"


S, O = C.CHUNK_SIZE, C.CHUNK_OVERLAP
STEP = S - O

CHUNKS = f"""
  _norm AS (SELECT doc_id, {NORM('text')} AS t FROM documents),
  _nc AS (SELECT doc_id, t, length(t) AS L,
                 CASE WHEN length(t) <= {S} THEN 1 ELSE (length(t) - {S} + {STEP - 1}) // {STEP} + 1 END AS n FROM _norm),
  _ck AS (SELECT doc_id, t, L, unnest(range(n)) AS k FROM _nc),
  chunks AS (SELECT doc_id, k::INTEGER AS chunk_id,
                    substring(t, k * {STEP} + 1, least(k * {STEP} + {S}, L) - k * {STEP}) AS text,
                    (least(k * {STEP} + {S}, L) - k * {STEP})::INTEGER AS chunk_size,
                    (k * {STEP})::INTEGER AS start_char, least(k * {STEP} + {S}, L)::INTEGER AS end_char FROM _ck)"""


def rag_sims() -> str:
    return CHUNKS + f""",
  _ctok AS (SELECT doc_id, chunk_id, unnest({TOKENS('text')}) AS tok FROM chunks),
  _cb AS (SELECT doc_id, chunk_id, {BUCKET('tok')} AS bucket, count(*)::DOUBLE AS tf FROM _ctok GROUP BY ALL),
  _ptok AS (SELECT item_id, unnest({TOKENS('text')}) AS tok FROM benchmark),
  _pb AS (SELECT item_id, {BUCKET('tok')} AS bucket, count(*)::DOUBLE AS tf FROM _ptok GROUP BY ALL),
  _cn AS (SELECT doc_id, chunk_id, sum(tf * tf) AS sq FROM _cb GROUP BY ALL),
  _pn AS (SELECT item_id, sum(tf * tf) AS sq FROM _pb GROUP BY ALL),
  _dots AS (SELECT item_id, doc_id, chunk_id, sum(_pb.tf * _cb.tf) AS dot FROM _pb JOIN _cb USING (bucket) GROUP BY ALL),
  sims AS (SELECT _pn.item_id, _cn.doc_id, _cn.chunk_id, coalesce(d.dot, 0) / (sqrt(_pn.sq) * sqrt(_cn.sq)) AS similarity
           FROM _pn CROSS JOIN _cn
           LEFT JOIN _dots d ON d.item_id = _pn.item_id AND d.doc_id = _cn.doc_id AND d.chunk_id = _cn.chunk_id),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(similarity, 9) DESC, doc_id, chunk_id) AS rn FROM sims)"""


def extractive(keys: str, src: str, question: str, knowledge: str) -> str:
    """CTE body producing (keys..., rk, n, sent): ranked candidate sentences."""
    return f"""
  SELECT {keys}, c.pos, c.sent, c.score,
         row_number() OVER (PARTITION BY {keys} ORDER BY c.score DESC, c.pos) AS rk,
         count(*) OVER (PARTITION BY {keys}) AS n
  FROM (SELECT {keys}, unnest(list_transform(range(1, len(ss) + 1),
            lambda i: {{'pos': i, 'sent': ss[i],
                        'score': len(list_intersect(list_distinct(string_split(lower(ss[i]), ' ')), qt))}})) AS c
        FROM (SELECT {keys}, {SENTENCES(knowledge)} AS ss, list_distinct({TOKENS(question)}) AS qt FROM {src}))
  WHERE c.score > 0"""


PAIRS = """
  pairs AS (SELECT u.conv_id, u.turn, u.text AS prompt, coalesce(a.text, '') AS reply
            FROM conversations u LEFT JOIN conversations a
              ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
            WHERE u.role = 'user')"""

CENTROIDS = """
  _e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings),
  _c AS (SELECT label AS route, i, avg(x) AS cx FROM _e GROUP BY ALL)"""


def _route_sims(where: str = "") -> str:
    return CENTROIDS + f""",
  _s AS (SELECT _e.vec_id, _e.label, _c.route, sum(_e.x * _c.cx) AS dot, sum(_e.x * _e.x) AS na, sum(_c.cx * _c.cx) AS nb
         FROM _e JOIN _c USING (i) {where} GROUP BY ALL),
  rs AS (SELECT vec_id, label, route, dot / nullif(sqrt(na) * sqrt(nb), 0) AS sim FROM _s)"""


def _msgs_sql(ids: str, system: str, user: str, src: str, where: str = "") -> str:
    return f"SELECT {ids}, {system} AS system, {user} AS user FROM {src} {where}"


def _refine_sql(question_src: str, question_col: str) -> str:
    """L2 closed form of the refinement loop under the extractive worker and
    the length rule: first passing candidate rank <= M, else M."""
    m, n = P.MAX_INTERACTIONS, C.REFINE_MAX_CHARS
    crit = E.max_length_rule(n).criteria
    return f"""
  cand AS ({extractive('prompt_id', question_src, question_col, 'knowledge')}),
  nc AS (SELECT prompt_id, max(n) AS n FROM cand GROUP BY ALL),
  ok AS (SELECT prompt_id, min(rk) AS first_ok FROM cand WHERE rk <= {m} AND length(sent) BETWEEN 1 AND {n} GROUP BY ALL),
  res AS (SELECT q.prompt_id, coalesce(ok.first_ok, {m})::INTEGER AS iterations, ok.first_ok IS NOT NULL AS accepted,
                 coalesce(nc.n, 0) AS n
          FROM {question_src} q LEFT JOIN ok USING (prompt_id) LEFT JOIN nc USING (prompt_id)),
  final AS (SELECT res.prompt_id, coalesce(cand.sent, '') AS final_response,
                   CASE WHEN res.accepted THEN {lit(E.YES_HEAD + crit)} ELSE {lit(E.NO_HEAD + crit)} END AS final_evaluation,
                   res.iterations, res.accepted
            FROM res LEFT JOIN cand ON cand.prompt_id = res.prompt_id AND cand.rk = least(res.iterations, res.n))"""


REQ = f"""{PAIRS},
  req AS (SELECT conv_id * {C.PROMPT_ID_STRIDE} + turn AS prompt_id, prompt, reply AS knowledge FROM pairs)"""


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["normalize_text"] = f"SELECT doc_id, length(t)::INTEGER AS norm_chars, md5(t) AS norm_md5 FROM (SELECT doc_id, {NORM('text')} AS t FROM documents)"
    q["chunk_documents"] = f"WITH {CHUNKS} SELECT doc_id, chunk_id, text, chunk_size, start_char, end_char FROM chunks"
    q["chunk_projection"] = f"WITH {CHUNKS} SELECT text, chunk_size FROM chunks"
    q["extract_steps"] = f"""
WITH a AS (SELECT conv_id, turn, list_filter(list_transform(string_split(text, chr(10)), lambda x: {USTRIP('x')}), lambda x: x <> '') AS l
           FROM conversations WHERE role = 'assistant'),
     s AS (SELECT conv_id, turn, unnest(list_transform(range(1, len(l) + 1), lambda i: {{'i': i, 'v': l[i]}})) AS e FROM a)
SELECT conv_id, turn, e.i::INTEGER AS step_idx, e.v AS step FROM s"""
    q["hash_embed"] = f"SELECT item_id, {BUCKET('tok')} AS bucket, count(*)::DOUBLE AS tf FROM (SELECT item_id, unnest({TOKENS('text')}) AS tok FROM benchmark) GROUP BY ALL"
    q["cosine_pairs"] = f"""
WITH {_route_sims('WHERE _e.label = _c.route')}
SELECT vec_id AS left_id, label AS right_id, round(sim, 6) AS similarity FROM rs"""
    q["rag_top1"] = f"WITH {rag_sims()} SELECT item_id, doc_id, chunk_id, round(similarity, 6) AS similarity FROM ranked WHERE rn = 1"
    q["rag_topk"] = f"WITH {rag_sims()} SELECT item_id, doc_id, chunk_id, round(similarity, 6) AS similarity, rn::INTEGER AS rank FROM ranked WHERE rn <= {C.TOPK}"
    q["rag_dense_top1"] = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
     p AS (SELECT a.vec_id, b.vec_id AS best_id,
                  list_dot_product(a.e, b.e) / nullif(sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e)), 0) AS sim
           FROM v a JOIN v b ON a.vec_id <> b.vec_id),
     r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(sim, 9) DESC, best_id) AS rn FROM p WHERE sim IS NOT NULL)
SELECT vec_id, best_id, round(sim, 6) AS similarity FROM r WHERE rn = 1"""
    q["route_scores"] = f"WITH {_route_sims()} SELECT vec_id, route::INTEGER AS route_pos, round(sim, 6) AS similarity FROM rs"
    q["route_best"] = f"""
WITH {_route_sims()},
     b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(sim, 12) DESC, route) AS rn FROM rs WHERE sim > -1)
SELECT vec_id, route::INTEGER AS route_pos, printf('%.3f', sim) AS score_label FROM b WHERE rn = 1"""
    q["route_fallback"] = f"""
WITH {_route_sims('WHERE _e.label % 2 = _c.route % 2 AND _c.route % 2 = 0')},
     b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(sim, 12) DESC, route) AS rn FROM rs WHERE sim > -1)
SELECT e.vec_id, coalesce('Vectors near label ' || b.route::VARCHAR, {lit(FALLBACK_RESPONSE)}) AS response, b.route IS NOT NULL AS routed
FROM embeddings e LEFT JOIN b ON b.vec_id = e.vec_id AND b.rn = 1"""

    probabilities = ", ".join(f"({p}::DOUBLE)" for p in C.MARGIN_PROBABILITIES)
    q["route_margins"] = f"""
WITH r AS (SELECT (label % 2)::BIGINT AS router_id FROM embeddings UNION ALL SELECT -1 FROM embeddings)
SELECT router_id, probability, count(*) AS n, true AS within_error FROM r, (VALUES {probabilities}) p(probability) GROUP BY ALL"""

    # prompt rendering
    q["prompt_direct"] = _msgs_sql("item_id", "NULL::VARCHAR", "text", "benchmark")
    q["prompt_persona"] = _msgs_sql(
        "item_id", lit("You are " + P.PROFESSOR_PERSONA + R.PERSONA_RULE_1 + R.PERSONA_RULE_2), "text", "benchmark")
    q["prompt_knowledge"] = f"WITH {PAIRS} " + _msgs_sql(
        "conv_id, turn", f"{lit(P.PROFESSOR_PERSONA_KNOWLEDGE + R.KNOWLEDGE_HEAD)} || reply || {lit(R.KNOWLEDGE_TAIL)}", "prompt", "pairs")
    q["prompt_rag"] = f"WITH {PAIRS} " + _msgs_sql(
        "conv_id, turn", lit("You are " + P.RAG_PERSONA + R.RAG_SYSTEM_TAIL),
        f"{lit(R.RAG_USER_HEAD)} || reply || {lit(R.RAG_USER_MID)} || prompt", "pairs")
    q["prompt_judge"] = _msgs_sql(
        "conv_id, turn", "NULL::VARCHAR", f"{lit(R.JUDGE_HEAD)} || text || {lit(R.JUDGE_MID + P.CITY_CRITERIA + R.JUDGE_TAIL)}",
        "conversations", "WHERE role = 'assistant'")
    q["prompt_correction"] = _msgs_sql(
        "conv_id, turn", "NULL::VARCHAR", f"{lit(R.CORRECTION_HEAD)} || text", "conversations", "WHERE role = 'assistant'")
    q["prompt_retry"] = f"""WITH {PAIRS},
     trip AS (SELECT p.*, coalesce(n.text, '') AS instructions FROM pairs p LEFT JOIN conversations n
              ON n.conv_id = p.conv_id AND n.turn = p.turn + 2 AND n.role = 'user') """ + _msgs_sql(
        "conv_id, turn", "NULL::VARCHAR",
        f"{lit(R.RETRY_1)} || prompt || {lit(R.RETRY_2)} || reply || {lit(R.RETRY_3)} || instructions", "trip")
    q["prompt_planner"] = _msgs_sql(
        "conv_id, turn", lit(R.PLANNER_SYSTEM + P.EGG_KNOWLEDGE), "text", "conversations", "WHERE role = 'user'")
    q["prompt_step_context"] = f"""
SELECT c.conv_id, c.turn, {lit(R.STEP_1)} || coalesce(p.text, {lit(P.WORKFLOW_PROMPT)}) || {lit(R.STEP_2)} || c.text || {lit(R.STEP_3)} AS user
FROM conversations c LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn + 1 = c.turn"""
    q["prompt_spec_knowledge"] = f"SELECT doc_id, {lit(R.SPEC_KNOWLEDGE_HEAD)} || text AS knowledge FROM documents"

    # completion and judging
    q["extractive_answer"] = f"""WITH {PAIRS},
     cand AS ({extractive('conv_id, turn', 'pairs', 'prompt', 'reply')})
SELECT p.conv_id, p.turn, coalesce(c.sent, '') AS response
FROM pairs p LEFT JOIN cand c ON c.conv_id = p.conv_id AND c.turn = p.turn AND c.rk = 1"""
    h = f"sha256('user' || chr(31) || coalesce(text, {lit(E.NULL_MARK)}))"
    q["complete_dedup"] = f"""
WITH r AS (SELECT {h} AS h FROM conversations UNION ALL SELECT {h} FROM conversations),
     st AS (SELECT DISTINCT {h} AS h FROM conversations WHERE turn = 0)
SELECT r.h AS request_hash, count(*) AS n_requests, max(CASE WHEN st.h IS NULL THEN 1 ELSE 0 END)::INTEGER AS n_calls
FROM r LEFT JOIN st USING (h) GROUP BY r.h"""
    q["complete_from_store"] = f"""
WITH r AS (SELECT DISTINCT {h} AS h, string_split(coalesce(text, ''), chr(10))[1] AS response FROM conversations),
     first_run AS (SELECT DISTINCT {h} AS h FROM conversations WHERE turn = 0)
SELECT r.h AS request_hash, response, (f.h IS NULL)::INTEGER AS calls_2, 0 AS calls_3 FROM r LEFT JOIN first_run f USING (h)"""
    ev = f"""CASE WHEN quality = 1 AND toxic = 0 THEN 'Yes, document ' || doc_id::VARCHAR || ' meets the criteria.'
                  WHEN quality = 1 THEN {lit('  ' + chr(9) + ' yes, document ')} || doc_id::VARCHAR || ' is acceptable.'
                  WHEN toxic = 1 THEN '**Yes** document ' || doc_id::VARCHAR || ' is flagged.'
                  ELSE 'No, document ' || doc_id::VARCHAR || ' does not meet the criteria.' END"""
    q["verdicts"] = f"SELECT doc_id, coalesce(starts_with(lower({USTRIP('ev')}), 'yes'), false) AS accepted FROM (SELECT doc_id, {ev} AS ev FROM labels)"

    # refinement (closed form)
    q["refine_loop"] = f"WITH {REQ}, {_refine_sql('req', 'prompt')} SELECT prompt_id, final_response, final_evaluation, iterations, accepted FROM final"
    q["refine_trace"] = f"""WITH {REQ}, {_refine_sql('req', 'prompt')}
SELECT prompt_id, i::INTEGER AS iteration, (i = iterations AND accepted) AS accepted
FROM (SELECT prompt_id, iterations, accepted, unnest(range(1, iterations + 1)) AS i FROM final)"""
    q["trace_metrics"] = f"""WITH {REQ}, {_refine_sql('req', 'prompt')},
     both_ AS (SELECT (prompt_id // {C.PROMPT_ID_STRIDE}) % 2 AS parity, * FROM final UNION ALL SELECT -1, * FROM final)
SELECT parity::BIGINT AS parity, count(*) AS prompts, round(sum(accepted::INT) / count(*), 9) AS acceptance_rate,
       round(sum((accepted AND iterations = 1)::INT) / nullif(sum(accepted::INT), 0), 9) AS accepted_at_once,
       round(sum(iterations) / count(*), 9) AS mean_iterations
FROM both_ GROUP BY parity"""
    q["answer_then_refine"] = f"""WITH {REQ},
     first_c AS ({extractive('prompt_id', 'req', 'prompt', 'knowledge')}),
     req2 AS (SELECT r.prompt_id, coalesce(f.sent, '') AS prompt, r.knowledge
              FROM req r LEFT JOIN first_c f ON f.prompt_id = r.prompt_id AND f.rk = 1),
     {_refine_sql('req2', 'prompt')}
SELECT prompt_id, final_response FROM final"""

    # routing with text
    routes = ", ".join(f"({i}, {lit(n)}, {lit(dsc)}, {lit(a[2])})" for i, ((n, dsc, _), a) in enumerate(zip(P.TOPIC_ROUTES, P.TOPIC_AGENTS)))
    q["route_respond"] = f"""
WITH rt(route_pos, name, description, knowledge) AS (VALUES {routes}),
     rb AS (SELECT route_pos, {BUCKET('tok')} AS b, count(*)::DOUBLE AS tf FROM (SELECT route_pos, unnest({TOKENS('description')}) AS tok FROM rt) GROUP BY ALL),
     rn AS (SELECT route_pos, sqrt(sum(tf * tf)) AS norm FROM rb GROUP BY ALL),
     db AS (SELECT doc_id, {BUCKET('tok')} AS b, count(*)::DOUBLE AS tf FROM (SELECT doc_id, unnest({TOKENS('text')}) AS tok FROM documents) GROUP BY ALL),
     dn AS (SELECT doc_id, sum(tf * tf) AS sq FROM db GROUP BY ALL),
     dots AS (SELECT db.doc_id, rb.route_pos, sum(db.tf * rb.tf) AS dot FROM db JOIN rb USING (b) GROUP BY ALL),
     sims AS (SELECT d.doc_id, rn.route_pos, coalesce(dots.dot, 0) / nullif(sqrt(coalesce(dn.sq, 0)) * rn.norm, 0) AS sim
              FROM documents d CROSS JOIN rn LEFT JOIN dn ON dn.doc_id = d.doc_id
              LEFT JOIN dots ON dots.doc_id = d.doc_id AND dots.route_pos = rn.route_pos),
     best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(sim, 12) DESC, route_pos) AS rk FROM sims WHERE sim > -1) WHERE rk = 1),
     src AS (SELECT d.doc_id, d.text, b.route_pos, rt.name, rt.knowledge FROM documents d LEFT JOIN best b USING (doc_id) LEFT JOIN rt USING (route_pos)),
     cand AS ({extractive('doc_id', 'src', 'text', 'knowledge')})
SELECT s.doc_id AS prompt_id, s.name,
       CASE WHEN s.route_pos IS NULL THEN {lit(FALLBACK_RESPONSE)} ELSE coalesce(c.sent, '') END AS response
FROM src s LEFT JOIN cand c ON c.doc_id = s.doc_id AND c.rk = 1"""
    q["rag_answer"] = f"""
WITH {rag_sims()},
     best AS (SELECT b.item_id, coalesce(c.text, '') AS chunk, b.text AS prompt FROM benchmark b
              LEFT JOIN ranked r ON r.item_id = b.item_id AND r.rn = 1
              LEFT JOIN chunks c ON c.doc_id = r.doc_id AND c.chunk_id = r.chunk_id),
     cand AS ({extractive('item_id', 'best', 'prompt', 'chunk')})
SELECT b.item_id, coalesce(c.sent, '') AS response FROM best b LEFT JOIN cand c ON c.item_id = b.item_id AND c.rk = 1"""

    # validators
    def several(last: str, more: str, key: str) -> str:
        marks = "[" + ", ".join(lit(m) for m in C.LIST_MARKS) + "]"
        mark = f"{marks}[({key} % {len(C.LIST_MARKS)})::INTEGER + 1]"
        end = f"CASE WHEN {key} % 2 = 0 THEN chr(13) || chr(10) ELSE chr(10) END"
        head = f"CASE WHEN {key} % 7 < 2 THEN {lit(C.INTRODUCTION)} ELSE '' END"
        return f"{head} || repeat({mark} || {more} || {end}, ({key} % 3)::INTEGER) || {mark} || {last} || {end}"

    shead = "'As a ' || lower(c_mktsegment) || ' buyer, I want to review account ' || c_name"
    sfull = shead + " || ' so that my balance of ' || printf('%.2f', c_acctbal) || ' stays correct.'"
    stext = several(f"CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN {shead} || '.' ELSE {sfull} END", sfull, "c_custkey")
    sfields = ", ".join(f"array_to_string(list_transform(rs, lambda r: {STORY_FIELD('r', i)}), ' | ') AS {n}"
                        for i, n in enumerate(("persona", "action", "benefit"), start=1))
    q["validate_stories"] = f"""
SELECT id, {_verdict(STORY_OK)}, {sfields}
FROM (SELECT c_custkey AS id, {STORIES(stext)} AS rs FROM customer)"""

    def labelled(labels, text: str, key: str, src: str) -> str:
        cols = ", ".join(f"array_to_string(list_transform(rs, lambda r: {_field('r', lab)}), ' | ') AS {lab.lower().replace(' ', '_')}" for lab in labels)
        return f"SELECT id, {_verdict(lambda r: _labels_ok(r, labels))}, {cols} FROM (SELECT {key} AS id, {RECORDS(text, labels)} AS rs FROM {src})"

    ftext = """'Feature Name: ' || p_name || chr(10) || 'Description: ' || p_type || chr(10) || 'Key Functionality: ' || p_brand
               || chr(10) || 'User Benefit: '"""
    ffull = "'Saves time on ' || p_type"
    q["validate_features"] = labelled(
        V.FEATURE_LABELS, several(f"{ftext} || CASE WHEN p_size < 10 THEN '' ELSE {ffull} END", f"{ftext} || {ffull}", "p_partkey"), "p_partkey", "part")
    ttext = """'Task ID: T-' || o_orderkey::VARCHAR || chr(10) || 'Task Title: Route order ' || o_orderkey::VARCHAR
               || chr(10) || 'Related User Story: ' || o_orderpriority || chr(10) || 'Description: status ' || o_orderstatus
               || chr(10) || 'Acceptance Criteria: total ' || printf('%.2f', o_totalprice) || chr(10) || 'Estimated Effort: 2 days'"""
    tfull = "chr(10) || 'Dependencies: order ' || o_custkey::VARCHAR"
    q["validate_tasks"] = labelled(
        V.TASK_LABELS, several(f"{ttext} || CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE {tfull} END", f"{ttext} || {tfull}", "o_orderkey"), "o_orderkey", "orders")
    q["validate_prefix"] = f"""
SELECT c_custkey AS id, coalesce(starts_with(CASE WHEN c_acctbal >= 0 THEN 'Dear students, meet ' || c_name
                                                  ELSE 'Dear student, meet ' || c_name END, {lit(V.REQUIRED_PREFIX)}), false) AS valid
FROM customer"""
    q["validate_name"] = f"""
SELECT id, coalesce(len({TOKENS('t')}) BETWEEN 1 AND 3 AND NOT regexp_matches(t, '[.?!]'), false) AS valid
FROM (SELECT p_partkey AS id, CASE WHEN p_size <= 25 THEN string_split(p_name, ' ')[1] ELSE p_name || '.' END AS t FROM part)"""
    a, b, c = (lit(t) for t in V.SECTION_TITLES)
    body = "chr(10) || 'Plan for order ' || o_orderkey::VARCHAR || chr(10)"
    q["validate_sections"] = f"""
SELECT id, coalesce(instr(t, {a}) > 0 AND instr(t, {b}) > instr(t, {a}) AND instr(t, {c}) > instr(t, {b}), false) AS valid
FROM (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN {b} || {body} || {a} || {body} || {c}
                                    ELSE {a} || {body} || {b} || {body} || {c} END AS t FROM orders)"""

    # planning
    q["plan_steps"] = f"""
WITH kl AS (SELECT unnest(range(1, len(l) + 1)) AS pos, unnest(l) AS line
            FROM (SELECT list_filter(list_transform(string_split({lit(P.EGG_KNOWLEDGE)}, chr(10)), lambda x: {USTRIP('x')}), lambda x: x <> '') AS l)),
     tg AS (SELECT pos, line, sum(CASE WHEN starts_with(line, '# ') THEN 1 ELSE 0 END) OVER (ORDER BY pos) AS section_idx FROM kl),
     sec AS (SELECT section_idx, trim(substring(line, 3)) AS title FROM tg WHERE starts_with(line, '# ')),
     st AS (SELECT section_idx, row_number() OVER (PARTITION BY section_idx ORDER BY pos) AS step_idx, line AS step
            FROM tg WHERE NOT starts_with(line, '# ') AND section_idx > 0),
     p AS (SELECT p_partkey AS prompt_id, 'One morning I wanted to have '
                  || CASE WHEN p_size <= 16 THEN 'a fried egg' WHEN p_size <= 33 THEN 'scrambled eggs' ELSE 'boiled eggs' END
                  || ' with ' || p_name AS text FROM part),
     pt AS (SELECT DISTINCT prompt_id, unnest(list_distinct({TOKENS('text')})) AS tok FROM p),
     tt AS (SELECT DISTINCT section_idx, unnest(list_distinct({TOKENS('title')})) AS tok FROM sec),
     sc AS (SELECT prompt_id, section_idx, count(*) AS score FROM pt JOIN tt USING (tok) GROUP BY ALL),
     b AS (SELECT prompt_id, section_idx FROM (SELECT *, row_number() OVER (PARTITION BY prompt_id ORDER BY score DESC, section_idx) AS rn FROM sc) WHERE rn = 1)
SELECT prompt_id, step_idx::INTEGER AS step_idx, step FROM b JOIN st USING (section_idx)"""

    # the first 0, 1, 2, 3 or 5 steps; strip() is Unicode's, blank steps are skipped
    counts = "[" + ", ".join(map(str, C.WORKFLOW_COUNTS)) + "][(project_id % " + str(len(C.WORKFLOW_COUNTS)) + ") + 1]"
    q["workflow_plan"] = _workflow_sql([(s.strip(), f"{counts} >= {k}") for k, s in enumerate(C.WORKFLOW_STEPS, start=1) if s.strip()])
    q["workflow_from_prompt"] = _workflow_sql([(s.strip(), "true") for s in P.PLANNING_KNOWLEDGE.split("\n") if s.strip()])

    # sources and sinks
    q["csv_round_trip"] = f"WITH {CHUNKS} SELECT doc_id, chunk_id, text FROM chunks"
    q["whole_text"] = "SELECT doc_id, (length(coalesce(text, '')) + 1)::INTEGER AS chars, md5(coalesce(text, '') || chr(10)) AS md5 FROM documents"
    q["embeddings_round_trip"] = """
SELECT vec_id, len(embedding)::INTEGER AS n, round(list_sum(embedding::DOUBLE[]), 6) AS total,
       round(embedding[1]::DOUBLE, 9) AS first, round(embedding[-1]::DOUBLE, 9) AS last FROM embeddings"""
    q["rag_from_index"] = q["rag_incremental"] = q["rag_top1"]
    counts = ", ".join(f"(length(t) - length(replace(t, '{c}', '')))::DOUBLE AS {n}" for c, n in (("e", "e"), ("s", "s"), (" ", "spaces")))
    q["embed_from_store"] = f"SELECT doc_id, length(t)::DOUBLE AS chars, {counts} FROM (SELECT doc_id, coalesce({NORM('text')}, '') AS t FROM documents)"
    texts = [f"CASE WHEN o_orderkey % 4 >= {i} THEN {c} ELSE '' END" for i, c in enumerate(("o_orderstatus", "o_orderpriority", "o_custkey::VARCHAR"), start=1)]
    q["plan_output"] = f"""
SELECT line, count(*) AS n FROM (
  SELECT unnest(string_split(CASE WHEN o_orderkey % 4 = 0 THEN {lit(R.NO_STEPS_MESSAGE)} ELSE {REPORT(*texts)} END, chr(10))) AS line FROM orders)
GROUP BY line"""
    yes, no = lit("Yes, it fits."), lit("No, it does not fit.")
    fits = f"length(resp) BETWEEN 1 AND {C.REFINE_MAX_CHARS}"
    q["refine_loop_model"] = f"""WITH {REQ},
     cand AS ({extractive('prompt_id', 'req', 'prompt', 'knowledge')}),
     nc AS (SELECT prompt_id, max(n) AS n FROM cand GROUP BY ALL),
     it AS (SELECT r.prompt_id, r.prompt AS initial, coalesce(nc.n, 0) AS n, unnest(range(1, {C.MODEL_ROUNDS + 1})) AS i FROM req r LEFT JOIN nc USING (prompt_id)),
     ans AS (SELECT it.prompt_id, it.initial, it.i, coalesce(c.sent, '') AS resp FROM it LEFT JOIN cand c ON c.prompt_id = it.prompt_id AND c.rk = least(it.i, it.n)),
     seen AS (SELECT *, {fits} AS ok, lag(resp) OVER w AS prev, coalesce(max(CASE WHEN {fits} THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done
              FROM ans WINDOW w AS (PARTITION BY prompt_id ORDER BY i))
SELECT prompt_id, i::INTEGER AS iteration,
       CASE WHEN i = 1 THEN initial ELSE {lit(R.RETRY_1)} || initial || {lit(R.RETRY_2)} || prev || {lit(R.RETRY_3 + C.SHORTEN)} END AS prompt,
       resp AS response, CASE WHEN ok THEN {yes} ELSE {no} END AS evaluation, ok AS accepted,
       CASE WHEN NOT ok AND i < {C.MODEL_ROUNDS} THEN {lit(C.SHORTEN)} END AS instructions
FROM seen WHERE done = 0"""
    q["refine_resumed"] = q["refine_loop_model"]
    return q


def _field(x: str, label: str) -> str:
    """The rest of the first line that begins with the label, list mark or not."""
    return USTRIP(f"regexp_extract({x}, '(?:^|\\n)[ \\t]*{V.LIST_MARK}{label}:([^\\n]*)', 1)")


def _labels_ok(x: str, labels) -> str:
    return "(" + " AND ".join(f"{_field(x, lab)} <> ''" for lab in labels) + ")"


def RECORDS(x: str, labels) -> str:
    """Records of a labelled answer: split before each line of the first label,
    list mark or not; what comes before the first is no record."""
    return f"list_transform(string_split_regex(chr(10) || {x}, '\\n[ \\t]*{V.LIST_MARK}{labels[0]}:')[2:], lambda s: '{labels[0]}:' || s)"


def STORIES(x: str) -> str:
    """Stories of an answer: split before each beginning of one, list mark or not;
    what comes before the first is no story, unless there is none."""
    parts = f"string_split(regexp_replace(chr(10) || {USTRIP(x)}, '{V.STORY_NEXT}', chr(1) || '\\1', 'g'), chr(1))"
    return f"list_transform(CASE WHEN len({parts}) > 1 THEN {parts}[2:] ELSE {parts} END, lambda s: {USTRIP('s')})"


def STORY_OK(x: str) -> str:
    return f"regexp_matches({x}, '{V.STORY_PATTERN}')"


def STORY_FIELD(x: str, i: int) -> str:
    return f"regexp_extract({x}, '{V.STORY_PATTERN}', {i})"


def ALL_OK(records: str, ok) -> str:
    return f"coalesce(len({records}) > 0 AND len(list_filter({records}, lambda r: NOT {ok('r')})) = 0, false)"


def _verdict(ok) -> str:
    return f"{ALL_OK('rs', ok)} AS valid, len(rs)::INTEGER AS n_records, len(list_filter(rs, lambda r: {ok('r')}))::INTEGER AS n_valid"


def _valid_labels(x: str, labels) -> str:
    return ALL_OK(RECORDS(x, labels), lambda r: _labels_ok(r, labels))


def REPORT(s1: str, s2: str, s3: str) -> str:
    heads = [lit(gap + R.BANNER + "\n" + title + "\n" + R.BANNER + "\n") for gap, title in zip(("\n", "\n\n", "\n\n"), R.REPORT_SECTIONS)]
    return f"{heads[0]} || {s1} || {heads[1]} || {s2} || {heads[2]} || {s3} || chr(10)"


def _workflow_sql(steps: list[tuple[str, str]]) -> str:
    """W1 for the given (step, which projects have it), orders as projects: each
    step renders R9 from the previous result, routes by hashed cosine, answers
    extractively from the agent's knowledge (the product manager's is R11 over the spec), and refines that
    answer in closed form under the agent's rule; R10 assembles the plan."""
    m = P.MAX_INTERACTIONS
    rules = {
        "product_manager": lambda x: ALL_OK(STORIES(x), STORY_OK),
        "program_manager": lambda x: _valid_labels(x, V.FEATURE_LABELS),
        "development_engineer": lambda x: _valid_labels(x, V.TASK_LABELS),
    }
    agents = {a: k for a, k in (("product_manager", ""), ("program_manager", P.PGM_KNOWLEDGE),
                                  ("development_engineer", P.DEV_KNOWLEDGE))}
    rt = ", ".join(f"({i}, {lit(n)}, {lit(d)}, {lit(a)}, {lit(agents[a])})" for i, (n, d, a) in enumerate(P.JOB_ROUTES))
    ctes = [f"""
  rt(route_pos, name, description, agent_id, knowledge) AS (VALUES {rt}),
  rb AS (SELECT route_pos, {BUCKET('tok')} AS b, count(*)::DOUBLE AS tf
         FROM (SELECT route_pos, unnest({TOKENS('description')}) AS tok FROM rt) GROUP BY ALL),
  rn AS (SELECT route_pos, sqrt(sum(tf * tf)) AS norm FROM rb GROUP BY ALL),
  cur0 AS (SELECT o.o_orderkey AS project_id, {lit(P.WORKFLOW_PROMPT)} AS cur,
                  'Email Router rollout for ' || coalesce(c.c_name, 'an unknown customer') || '. '
                  || 'As a ' || lower(coalesce(c.c_mktsegment, 'retail')) || ' support agent, I want order '
                  || o.o_orderkey::VARCHAR || ' emails routed automatically so that ' || lower(o.o_orderpriority)
                  || ' requests are answered on time. '
                  || 'The features group classification, routing and response suggestions. '
                  || 'The engineering tasks build the connectors, the classifier and the dashboard.' AS spec
           FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""]
    rule_case = "CASE f.agent_id " + " ".join(f"WHEN {lit(a)} THEN {fn('c.sent')}" for a, fn in rules.items()) + " ELSE false END"
    for k, (step, has) in enumerate(steps, start=1):
        ctes.append(f"""
  p{k} AS (SELECT project_id, {lit(R.STEP_1)} || cur || {lit(R.STEP_2 + step + R.STEP_3)} AS prompt, spec FROM cur{k - 1} WHERE {has}),
  pb{k} AS (SELECT project_id, {BUCKET('tok')} AS b, count(*)::DOUBLE AS tf
            FROM (SELECT project_id, unnest({TOKENS('prompt')}) AS tok FROM p{k}) GROUP BY ALL),
  pn{k} AS (SELECT project_id, sum(tf * tf) AS sq FROM pb{k} GROUP BY ALL),
  d{k} AS (SELECT pb.project_id, rb.route_pos, sum(pb.tf * rb.tf) AS dot FROM pb{k} pb JOIN rb USING (b) GROUP BY ALL),
  s{k} AS (SELECT p.project_id, rn.route_pos, coalesce(d.dot, 0) / nullif(sqrt(coalesce(pn.sq, 0)) * rn.norm, 0) AS sim
           FROM p{k} p CROSS JOIN rn LEFT JOIN pn{k} pn ON pn.project_id = p.project_id
           LEFT JOIN d{k} d ON d.project_id = p.project_id AND d.route_pos = rn.route_pos),
  b{k} AS (SELECT project_id, route_pos FROM (
             SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY round(sim, 12) DESC, route_pos) AS rk FROM s{k} WHERE sim > -1)
           WHERE rk = 1),
  src{k} AS (SELECT p.project_id, p.prompt, b.route_pos, rt.agent_id, CASE WHEN rt.agent_id = 'product_manager' THEN {lit(R.SPEC_KNOWLEDGE_HEAD)} || p.spec ELSE rt.knowledge END AS knowledge
             FROM p{k} p LEFT JOIN b{k} b USING (project_id) LEFT JOIN rt USING (route_pos)),
  a{k} AS ({extractive('project_id', f'src{k}', 'prompt', 'knowledge')}),
  f{k} AS (SELECT s.project_id, s.route_pos, s.agent_id, coalesce(a.sent, '') AS first, s.knowledge
           FROM src{k} s LEFT JOIN a{k} a ON a.project_id = s.project_id AND a.rk = 1),
  r{k} AS ({extractive('project_id', f'(SELECT * FROM f{k} WHERE route_pos IS NOT NULL)', 'first', 'knowledge')}),
  ok{k} AS (SELECT c.project_id, min(c.rk) AS first_ok FROM r{k} c JOIN f{k} f USING (project_id)
            WHERE c.rk <= {m} AND {rule_case} GROUP BY ALL),
  n{k} AS (SELECT project_id, max(n) AS n FROM r{k} GROUP BY ALL),
  res{k} AS (SELECT f.project_id,
                    CASE WHEN f.route_pos IS NULL THEN {lit(FALLBACK_RESPONSE)} ELSE coalesce(c.sent, '') END AS result
             FROM f{k} f LEFT JOIN ok{k} o USING (project_id) LEFT JOIN n{k} n USING (project_id)
             LEFT JOIN r{k} c ON c.project_id = f.project_id AND c.rk = least(coalesce(o.first_ok, {m}), n.n)),
  cur{k} AS (SELECT c.project_id, coalesce(r.result, c.cur) AS cur, c.spec FROM cur{k - 1} c LEFT JOIN res{k} r USING (project_id))""")
    done = " UNION ALL ".join(f"SELECT project_id, {k} AS k, result FROM res{k}" for k in range(1, len(steps) + 1))
    return "WITH " + ",".join(ctes) + f""",
  done AS (SELECT project_id, result, row_number() OVER (PARTITION BY project_id ORDER BY k) AS rn FROM ({done})),
  secs AS (SELECT project_id, max(CASE WHEN rn = 1 THEN result END) AS s1, max(CASE WHEN rn = 2 THEN result END) AS s2,
                  max(CASE WHEN rn = 3 THEN result END) AS s3 FROM done GROUP BY project_id),
  parts AS (SELECT c.project_id, secs.project_id IS NOT NULL AS any_step, coalesce(s1, '') AS s1, coalesce(s2, '') AS s2, coalesce(s3, '') AS s3
            FROM cur0 c LEFT JOIN secs USING (project_id))
SELECT project_id, s1 AS user_stories, s2 AS product_features, s3 AS engineering_tasks,
       CASE WHEN any_step THEN {REPORT('s1', 's2', 's3')} ELSE {lit(R.NO_STEPS_MESSAGE)} END AS report
FROM parts"""


ORACLE_SQL = _sql()
