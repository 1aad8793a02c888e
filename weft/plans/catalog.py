"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory. Every query reads the given tables (or tables Spark
derives from them) in full."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions import prompts as R
from weft.functions import validators as V
from weft.functions.text import is_yes, normalize_ws
from weft.functions.vectors import cosine
from weft.operators.chunking import chunk, extract_steps
from weft.operators.completion import CallableCompleter, ExtractiveCompleter, ModelJudge, Rule, complete, max_length_rule, request_hash
from weft.operators.embedding import CallableEmbedder, HashingEmbedder, vector_store
from weft.operators.metrics import loop_metrics, loop_partials, margin, margin_partials, quantiles, roll_up
from weft.operators.refine import answer_then_refine, refine
from weft.operators.routing import (
    FALLBACK_RESPONSE,
    attach_agent,
    best_routes,
    explode_scores,
    score_routes,
)
from weft.operators.scoring import top_k_matches
from weft.plans import presets as P
from weft.plans.index import ChunkIndex
from weft.plans.planning import parse_sections, plan_steps
from weft.plans.workflow import (
    assemble,
    rag_answer,
    rag_top_chunks,
    route_and_respond,
    run_workflow,
    run_workflow_from_prompt,
    top_chunks_of_index,
    write_index,
)
from weft.session import broadcast_if_small, cut_lineage, scratch_path, spread
from weft.sources.snapshots import KeyedStore
from weft.sources.io import (
    new_run_id,
    read_chunks_csv,
    read_embeddings_csv,
    read_whole_text,
    write_chunks_csv,
    write_embeddings,
    write_plans,
    write_whole_text,
)

# Parameters of the reference's own runs.
CHUNK_SIZE, CHUNK_OVERLAP = 500, 200
TOPK = 3
REFINE_MAX_CHARS = 80
PROMPT_ID_STRIDE = 100_000  # prompt_id = conv_id * stride + turn
# Projects have the first 0, 1, 2, 3 or 5 of these steps; the fourth is blank.
WORKFLOW_STEPS = ("Define the user stories", "  Define the product features \t", "Define the engineering tasks", " \u3000 ", "Review the development plan")
WORKFLOW_COUNTS = (0, 1, 2, 3, 5)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---------------------------------------------------------------------------
# text, chunks, steps, hashing
# ---------------------------------------------------------------------------


def normalize_text(spark, d):
    t = normalize_ws("text")
    return table(spark, d, "documents").select("doc_id", F.length(t).alias("norm_chars"), F.md5(t).alias("norm_md5"))


def chunk_documents(spark, d):
    return chunk(spread(table(spark, d, "documents")), "text", ["doc_id"], CHUNK_SIZE, CHUNK_OVERLAP)


def chunk_projection(spark, d):
    return chunk_documents(spark, d).select("text", "chunk_size")


def extract_steps_q(spark, d):
    conv = table(spark, d, "conversations").where(F.col("role") == "assistant")
    return extract_steps(conv, "text", ["conv_id", "turn"])


def hash_embed(spark, d):
    return HashingEmbedder().sparse(table(spark, d, "benchmark"), ["item_id"], "text")


# ---------------------------------------------------------------------------
# dense vectors: centroid routes, cosine, nearest neighbour
# ---------------------------------------------------------------------------


def label_centroids(emb: DataFrame) -> DataFrame:
    """Mean vector per label: (label, centroid array<double>). Partial
    aggregation per (label, position), so a hot label is combined map-side."""
    ex = emb.select("label", F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "x"))
    c = ex.groupBy("label", "i").agg(F.avg("x").alias("x"))
    packed = c.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("s"))
    return packed.select("label", F.transform("s", lambda e: e["x"]).alias("centroid"))


def cosine_pairs(spark, d):
    emb = table(spark, d, "embeddings")
    # one scan for the centroids, written once: the size check and the join read the small table
    cent = broadcast_if_small(cut_lineage(label_centroids(emb), "centroids"), 100_000)
    return emb.join(cent, "label").select(
        F.col("vec_id").alias("left_id"), F.col("label").alias("right_id"),
        F.round(cosine("embedding", "centroid"), 6).alias("similarity"))


def rag_dense_top1(spark, d):
    emb = table(spark, d, "embeddings")
    q = emb.select("vec_id", F.col("embedding").alias("vec"))
    c = spread(emb).select(F.col("vec_id").alias("best_id"), F.col("embedding").alias("vec"))
    res = top_k_matches(q, "vec_id", c, ["best_id"], kind="dense", k=1, exclude_self=True)
    return res.select("vec_id", "best_id", F.round("similarity", 6).alias("similarity"))


def centroid_routes(emb: DataFrame, split_routers: bool = False) -> tuple[DataFrame, DataFrame]:
    """Routes whose vectors are the label centroids; route_pos = label.
    With ``split_routers`` labels are split over two routers by parity and the
    odd router's descriptions are blank (so its prompts fall back)."""
    # one scan of the vectors; route checks, the broadcast and the agents read the written result
    cent = cut_lineage(label_centroids(emb), "centroids")
    lab = F.col("label")
    router = (lab % 2).cast("long") if split_routers else F.lit(0).cast("long")
    desc = F.when(F.lit(split_routers) & (lab % 2 == 1), F.lit("")).otherwise(F.concat(F.lit("Vectors labelled "), lab.cast("string")))
    routes = cent.select(
        router.alias("router_id"), lab.cast("int").alias("route_pos"),
        F.concat(F.lit("route_"), lab.cast("string")).alias("name"), desc.alias("description"),
        F.concat(F.lit("agent_"), lab.cast("string")).alias("agent_id"), F.col("centroid").alias("vec"))
    agents = cent.select(
        F.concat(F.lit("agent_"), lab.cast("string")).alias("agent_id"),
        F.concat(F.lit("Agent for label "), lab.cast("string")).alias("persona"),
        F.concat(F.lit("Vectors near label "), lab.cast("string")).alias("knowledge"),
        F.lit(None).cast("string").alias("criteria"), F.lit(P.MAX_INTERACTIONS).alias("max_interactions"))
    return routes, agents


def _routed_embeddings(spark, d, split_routers=False):
    """Prompts, routes and agents of the dense routing queries."""
    emb = table(spark, d, "embeddings")
    routes, agents = centroid_routes(emb, split_routers)
    prompts = emb.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"),
                         (F.col("label") % 2).cast("long").alias("router_id"))
    return prompts, routes, agents


def route_scores(spark, d):
    prompts, routes, _ = _routed_embeddings(spark, d)
    return explode_scores(score_routes(prompts, routes), ["vec_id"]).select("vec_id", "route_pos", F.round("similarity", 6).alias("similarity"))


def route_best(spark, d):
    prompts, routes, _ = _routed_embeddings(spark, d)
    return best_routes(prompts, routes).select("vec_id", "route_pos", "score_label")


MARGIN_PROBABILITIES = (0.1, 0.5, 0.9)
MARGIN_RANK_ERROR = 0.01


def route_margins(spark, d):
    """Quantiles of routing margins per router and over all (-1), from sketches kept
    per router and label and rolled up; whether each one's true rank is within the
    stated error."""
    prompts, routes, _ = _routed_embeddings(spark, d)
    scored = score_routes(prompts.withColumn("label", F.col("vec_id") % 7), routes)
    margins = cut_lineage(scored.select("router_id", "label", margin("scores").alias("margin")), "margins")
    kept = cut_lineage(margin_partials(margins, "margin", ["router_id", "label"]), "sketches")
    whole = roll_up(kept).select(F.lit(-1).cast("long").alias("router_id"), "n", "total", "least", "greatest", "sketch")
    found = quantiles(roll_up(kept, ["router_id"]).unionByName(whole), MARGIN_PROBABILITIES)
    everyone = margins.unionByName(margins.withColumn("router_id", F.lit(-1).cast("long"))).select("router_id", "margin")
    below = everyone.join(F.broadcast(found), "router_id").groupBy("router_id", "probability").agg(
        F.first("n").alias("n"), F.sum((F.col("margin") <= F.col("quantile")).cast("long")).alias("upto"), F.sum((F.col("margin") < F.col("quantile")).cast("long")).alias("below"))
    slack = F.col("n") * MARGIN_RANK_ERROR + 1
    at = F.col("n") * F.col("probability")
    return below.select("router_id", "probability", "n", ((F.col("upto") >= at - slack) & (F.col("below") <= at + slack)).alias("within_error"))


def route_fallback(spark, d):
    prompts, routes, agents = _routed_embeddings(spark, d, split_routers=True)
    routed = attach_agent(best_routes(prompts, routes, router_col="router_id"), agents)
    resp = F.when(F.col("routed"), F.col("knowledge")).otherwise(F.lit(FALLBACK_RESPONSE))
    return routed.select("vec_id", resp.alias("response"), "routed")


# ---------------------------------------------------------------------------
# retrieval
# ---------------------------------------------------------------------------


def rag_top1(spark, d):
    res = rag_top_chunks(table(spark, d, "documents"), table(spark, d, "benchmark"), CHUNK_SIZE, CHUNK_OVERLAP, k=1)
    return res.select("item_id", "doc_id", "chunk_id", F.round("similarity", 6).alias("similarity"))


def rag_topk(spark, d):
    res = rag_top_chunks(table(spark, d, "documents"), table(spark, d, "benchmark"), CHUNK_SIZE, CHUNK_OVERLAP, k=TOPK, with_rank=True)
    return res.select("item_id", "doc_id", "chunk_id", F.round("similarity", 6).alias("similarity"), "rank")


def rag_answer_q(spark, d):
    res = rag_answer(table(spark, d, "documents"), table(spark, d, "benchmark"), P.RAG_PERSONA, CHUNK_SIZE, CHUNK_OVERLAP)
    return res.select("item_id", "response")


def rag_from_index(spark, d):
    """The stored index of a run answers the prompts; another run beside it is not read."""
    path, run_id = scratch_path(spark, "index"), new_run_id()
    docs = table(spark, d, "documents")
    write_index(docs, path, run_id, CHUNK_SIZE, CHUNK_OVERLAP)
    write_index(docs.where("lang = 'en'"), path, new_run_id(), CHUNK_SIZE, CHUNK_OVERLAP)
    res = top_chunks_of_index(spark, path, run_id, table(spark, d, "benchmark"))
    return res.select("item_id", "doc_id", "chunk_id", F.round("similarity", 6).alias("similarity"))


OTHER_IDS = 1_000_000_000_000  # documents that only the index's first version has


def rag_incremental(spark, d):
    """An index of an older state of the documents (some changed, some missing, some
    gone since) brought up to date answers as one built anew."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    old_text = F.when(F.col("doc_id") % 100 == 7, F.concat(F.lit("Outdated. "), F.col("text"))).otherwise(F.col("text"))
    older = docs.where("doc_id % 50 <> 3").select("doc_id", old_text.alias("text")).unionByName(
        docs.where("doc_id % 50 = 0").select((F.col("doc_id") + OTHER_IDS).alias("doc_id"), "text"))
    index = ChunkIndex(spark, scratch_path(spark, "index"), CHUNK_SIZE, CHUNK_OVERLAP)
    index.update(older)
    index.update(docs)
    res = index.top_chunks(table(spark, d, "benchmark"))
    return res.select("item_id", "doc_id", "chunk_id", F.round("similarity", 6).alias("similarity"))


def counting_client():
    """A stand-in embedding model: length, and how many e, s and spaces."""
    return lambda texts: [[float(len(t)), *(float(t.count(c)) for c in "es ")] for t in texts]


def embed_from_store(spark, d):
    """Vectors by content: one run embeds some documents, the next all of them."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    embedder = CallableEmbedder(counting_client, store=vector_store(spark, scratch_path(spark, "vectors")))
    embedder.embed(docs.where("lang = 'en'"), ["doc_id"])
    found = embedder.embed(docs, ["doc_id"])
    return found.select("doc_id", *[F.element_at("vec", i).alias(n) for i, n in enumerate(("chars", "e", "s", "spaces"), start=1)])


# ---------------------------------------------------------------------------
# prompt rendering
# ---------------------------------------------------------------------------


def turn_pairs(conv: DataFrame) -> DataFrame:
    """Every user turn with the assistant turn that answers it, if any:
    (conv_id, turn, prompt, reply); the reply is empty without one."""
    u = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    a = conv.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    return u.join(a, ["conv_id", "turn"], "left").withColumn("reply", F.coalesce("reply", F.lit("")))


def _msgs(df: DataFrame, ids, messages) -> DataFrame:
    return df.select(*ids, messages.alias("_m")).select(*ids, R.system_text("_m").alias("system"), R.user_text("_m").alias("user"))


def prompt_direct(spark, d):
    return _msgs(table(spark, d, "benchmark"), ["item_id"], R.direct("text"))


def prompt_persona(spark, d):
    return _msgs(table(spark, d, "benchmark"), ["item_id"], R.persona(F.lit(P.PROFESSOR_PERSONA), "text"))


def prompt_knowledge(spark, d):
    pairs = turn_pairs(table(spark, d, "conversations"))
    return _msgs(pairs, ["conv_id", "turn"], R.knowledge(F.lit(P.PROFESSOR_PERSONA_KNOWLEDGE), "reply", "prompt"))


def prompt_rag(spark, d):
    pairs = turn_pairs(table(spark, d, "conversations"))
    return _msgs(pairs, ["conv_id", "turn"], R.rag(F.lit(P.RAG_PERSONA), "reply", "prompt"))


def prompt_judge(spark, d):
    conv = table(spark, d, "conversations").where(F.col("role") == "assistant")
    return _msgs(conv, ["conv_id", "turn"], R.judge("text", F.lit(P.CITY_CRITERIA)))


def prompt_correction(spark, d):
    conv = table(spark, d, "conversations").where(F.col("role") == "assistant")
    return _msgs(conv, ["conv_id", "turn"], R.correction("text"))


def prompt_retry(spark, d):
    conv = table(spark, d, "conversations")
    pairs = turn_pairs(conv)
    nxt = conv.where(F.col("role") == "user").select("conv_id", (F.col("turn") - 2).alias("turn"), F.col("text").alias("instructions"))
    trip = pairs.join(nxt, ["conv_id", "turn"], "left").withColumn("instructions", F.coalesce("instructions", F.lit("")))
    return _msgs(trip, ["conv_id", "turn"], R.retry("prompt", "reply", "instructions"))


def prompt_planner(spark, d):
    conv = table(spark, d, "conversations").where(F.col("role") == "user")
    return _msgs(conv, ["conv_id", "turn"], R.planner(F.lit(P.EGG_KNOWLEDGE), "text"))


def prompt_step_context(spark, d):
    conv = table(spark, d, "conversations")
    prev = conv.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("current"))
    cur = conv.select("conv_id", "turn", F.col("text").alias("step"))
    # the first step has no result before it: it is seeded with the workflow prompt
    seeded = cur.join(prev, ["conv_id", "turn"], "left").withColumn("current", F.coalesce("current", F.lit(P.WORKFLOW_PROMPT)))
    return seeded.select("conv_id", "turn", R.step_context("current", "step").alias("user"))


def prompt_spec_knowledge(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", R.spec_knowledge("text").alias("knowledge"))


# ---------------------------------------------------------------------------
# completion, judging, refinement
# ---------------------------------------------------------------------------


def extractive_answer_q(spark, d):
    pairs = turn_pairs(table(spark, d, "conversations"))
    req = pairs.withColumn("messages", R.knowledge(F.lit(P.PROFESSOR_PERSONA_KNOWLEDGE), "reply", "prompt"))
    out = complete(req, ExtractiveCompleter(question_col="prompt", knowledge_col="reply"))
    return out.select("conv_id", "turn", "response")


def first_line_client():
    """A stand-in model client for the callable provider: answers with the
    first line of the last message."""
    return lambda batch: [(msgs[-1][1] or "").split("\n", 1)[0] for msgs in batch]


def complete_dedup(spark, d):
    conv = table(spark, d, "conversations").select("conv_id", "turn", "text")
    requests = conv.unionAll(conv).withColumn("messages", R.direct("text"))
    recorded = (conv.where(F.col("turn") == 0)
                .select(request_hash(R.direct("text")).alias("request_hash"), F.col("text").alias("response"))
                .dropDuplicates(["request_hash"]))
    out = complete(requests, CallableCompleter(first_line_client), store=recorded)
    return out.groupBy("request_hash").agg(
        F.count(F.lit(1)).alias("n_requests"), F.max(F.col("called").cast("int")).alias("n_calls"))


def complete_from_store(spark, d):
    """Three runs over one answer store: the first turns, all turns, all again.
    The second run asks only for what the first did not, the third for nothing."""
    requests = table(spark, d, "conversations").select("turn", R.direct("text").alias("messages"))
    store, client = KeyedStore(spark, scratch_path(spark, "answers")), CallableCompleter(first_line_client)
    complete(requests.where("turn = 0"), client, store=store)
    runs = [complete(requests, client, store=store).withColumn("run", F.lit(i)) for i in (2, 3)]
    return runs[0].unionByName(runs[1]).groupBy("request_hash").agg(
        F.max("response").alias("response"), *[F.max(F.when(F.col("run") == i, F.col("called").cast("int"))).alias(f"calls_{i}") for i in (2, 3)])


def verdict_texts(labels: DataFrame) -> DataFrame:
    """Evaluation texts in the shapes a judge answers with, built from labels."""
    ids = F.col("doc_id").cast("string")
    q, t = F.col("quality"), F.col("toxic")
    text = (F.when((q == 1) & (t == 0), F.concat(F.lit("Yes, document "), ids, F.lit(" meets the criteria.")))
            .when(q == 1, F.concat(F.lit("  \t yes, document "), ids, F.lit(" is acceptable.")))
            .when(t == 1, F.concat(F.lit("**Yes** document "), ids, F.lit(" is flagged.")))
            .otherwise(F.concat(F.lit("No, document "), ids, F.lit(" does not meet the criteria."))))
    return labels.select("doc_id", text.alias("evaluation"))


def verdicts(spark, d):
    return verdict_texts(table(spark, d, "labels")).select("doc_id", is_yes("evaluation").alias("accepted"))


def refine_requests(spark, d) -> DataFrame:
    pairs = turn_pairs(table(spark, d, "conversations"))
    return pairs.select((F.col("conv_id") * PROMPT_ID_STRIDE + F.col("turn")).alias("prompt_id"), "prompt",
                        F.col("reply").alias("knowledge"))


def _refined(spark, d):
    return refine(refine_requests(spark, d), max_length_rule(REFINE_MAX_CHARS), P.MAX_INTERACTIONS)


def trace_metrics(spark, d):
    """Acceptance and iterations per conversation parity and over all (-1), rolled up
    from one row per conversation and iteration."""
    _, trace = _refined(spark, d)
    conv = F.floor(F.col("prompt_id") / PROMPT_ID_STRIDE).cast("long")
    kept = cut_lineage(loop_partials(trace.withColumn("conv_id", conv), ["conv_id"]), "partials").withColumn("parity", F.col("conv_id") % 2)
    both = kept.unionByName(kept.withColumn("parity", F.lit(-1).cast("long")))
    found = loop_metrics(both, ["parity"])
    return found.select("parity", "prompts", *[F.round(c, 9).alias(c) for c in ("acceptance_rate", "accepted_at_once", "mean_iterations")])


def refine_loop(spark, d):
    result, _ = _refined(spark, d)
    return result


def refine_trace(spark, d):
    _, trace = _refined(spark, d)
    return trace.select("prompt_id", "iteration", "accepted")


SHORTEN = "Shorten the answer."
MODEL_ROUNDS = 4


def judging_client():
    """A stand-in judge model: R5 prompts are answered by the length of the
    response in them, R6 requests with a fixed text; both with edge white space."""

    def answer(text: str) -> str:
        if not text.startswith(R.JUDGE_HEAD):
            return f"\n {SHORTEN}\t"
        response = text[len(R.JUDGE_HEAD):].rsplit(R.JUDGE_MID, 1)[0]
        return "  Yes, it fits.\n" if 1 <= len(response) <= REFINE_MAX_CHARS else "\n No, it does not fit. "

    return lambda batch: [answer(msgs[-1][1] or "") for msgs in batch]


def refine_loop_model(spark, d):
    """The loop itself, judged by a model round by round; its whole trace."""
    judge = ModelJudge(P.CITY_CRITERIA, CallableCompleter(judging_client))
    _, trace = refine(refine_requests(spark, d), judge, MODEL_ROUNDS)
    return trace


def refine_resumed(spark, d):
    """The same loop broken off after its second round and taken up again."""
    path = scratch_path(spark, "run")
    judge = ModelJudge(P.CITY_CRITERIA, CallableCompleter(judging_client), store=KeyedStore(spark, scratch_path(spark, "verdicts")))
    refine(refine_requests(spark, d), judge, MODEL_ROUNDS, run_path=path, pause_after=2)
    _, trace = refine(refine_requests(spark, d), judge, MODEL_ROUNDS, run_path=path)
    return trace


def answer_then_refine_q(spark, d):
    result, _ = answer_then_refine(refine_requests(spark, d), max_length_rule(REFINE_MAX_CHARS), P.MAX_INTERACTIONS)
    return result.select("prompt_id", "final_response")


# ---------------------------------------------------------------------------
# routing with text, planning, workflow
# ---------------------------------------------------------------------------


def route_respond(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("prompt_id"), "text")
    out = route_and_respond(docs, P.topic_routes(spark), P.topic_agents(spark))
    return out.select("prompt_id", "name", "response")


def egg_sections(spark) -> DataFrame:
    return parse_sections(spark.createDataFrame([(0, P.EGG_KNOWLEDGE)], "kid int, text string"))


def dish_prompts(part: DataFrame) -> DataFrame:
    size = F.col("p_size")
    dish = F.when(size <= 16, F.lit("a fried egg")).when(size <= 33, F.lit("scrambled eggs")).otherwise(F.lit("boiled eggs"))
    return part.select(F.col("p_partkey").alias("prompt_id"),
                       F.concat(F.lit("One morning I wanted to have "), dish, F.lit(" with "), F.col("p_name")).alias("text"))


def plan_steps_q(spark, d):
    return plan_steps(dish_prompts(table(spark, d, "part")), egg_sections(spark))


def project_specs(spark, d) -> DataFrame:
    """One project per order; its spec text is built from the order and customer."""
    orders = table(spark, d, "orders")
    cust = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    o = orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
    seg = F.lower(F.coalesce(F.col("c_mktsegment"), F.lit("retail")))
    spec = F.concat(
        F.lit("Email Router rollout for "), F.coalesce(F.col("c_name"), F.lit("an unknown customer")), F.lit(". "),
        F.lit("As a "), seg, F.lit(" support agent, I want order "), F.col("o_orderkey").cast("string"),
        F.lit(" emails routed automatically so that "), F.lower(F.col("o_orderpriority")), F.lit(" requests are answered on time. "),
        F.lit("The features group classification, routing and response suggestions. "),
        F.lit("The engineering tasks build the connectors, the classifier and the dashboard."))
    return o.select(F.col("o_orderkey").alias("project_id"), spec.alias("spec"))


def workflow_rules() -> dict[str, Rule]:
    return {
        "product_manager": Rule(P.PM_CRITERIA, lambda r: V.story(r)["valid"]),
        "program_manager": Rule(P.PGM_CRITERIA, lambda r: V.feature(r)["valid"]),
        "development_engineer": Rule(P.DEV_CRITERIA, lambda r: V.task(r)["valid"]),
    }


def workflow_plan(spark, d):
    projects = project_specs(spark, d)
    count = F.element_at(F.array(*[F.lit(n) for n in WORKFLOW_COUNTS]), (F.col("project_id") % len(WORKFLOW_COUNTS) + 1).cast("int"))
    steps = projects.select("project_id", F.posexplode(F.slice(F.array(*[F.lit(s) for s in WORKFLOW_STEPS]), F.lit(1), count)).alias("i", "step")).select(
        "project_id", (F.col("i") + 1).alias("step_idx"), "step")
    plans, _ = run_workflow(projects, steps, P.WORKFLOW_PROMPT, P.job_routes(spark), P.job_agents(spark), workflow_rules())
    return plans


def knowledge_client():
    """A stand-in planner model: answers with the knowledge it was given."""
    return lambda batch: [msgs[0][1][len(R.PLANNER_SYSTEM):] for msgs in batch]


def workflow_from_prompt(spark, d):
    """The planner's answer gives the steps, which are then run."""
    plans, _ = run_workflow_from_prompt(
        project_specs(spark, d), P.WORKFLOW_PROMPT, CallableCompleter(knowledge_client), P.job_routes(spark), P.job_agents(spark),
        P.PLANNING_KNOWLEDGE, workflow_rules())
    return plans


# ---------------------------------------------------------------------------
# validators
# ---------------------------------------------------------------------------


INTRODUCTION = "Here is what you asked for:\n\n"
LIST_MARKS = ("", "- ", "1. ", "\u2022 ", "2) ")


def several(first: Column, more: Column, key: Column) -> Column:
    """One to three records by the key, as a model writes them: ``first`` comes
    last, after ``more``; some with an introduction, list marks or CRLF."""
    mark = F.element_at(F.array(*[F.lit(m) for m in LIST_MARKS]), (key % len(LIST_MARKS) + 1).cast("int"))
    end = F.when(key % 2 == 0, F.lit("\r\n")).otherwise(F.lit("\n"))
    head = F.when(key % 7 < 2, F.lit(INTRODUCTION)).otherwise(F.lit(""))
    return F.concat(head, F.repeat(F.concat(mark, more, end), (key % 3).cast("int")), mark, first, end)


def story_texts(customer: DataFrame) -> DataFrame:
    """One to three user stories from customers; the ``so that`` clause of the
    last is missing for the AUTOMOBILE segment."""
    seg = F.lower(F.col("c_mktsegment"))
    broken = F.col("c_mktsegment") == "AUTOMOBILE"
    head = F.concat(F.lit("As a "), seg, F.lit(" buyer, I want to review account "), F.col("c_name"))
    tail = F.concat(F.lit(" so that my balance of "), F.format_string("%.2f", F.col("c_acctbal")), F.lit(" stays correct."))
    text = several(F.when(broken, F.concat(head, F.lit("."))).otherwise(F.concat(head, tail)), F.concat(head, tail), F.col("c_custkey"))
    return customer.select(F.col("c_custkey").alias("id"), text.alias("text"))


def feature_texts(part: DataFrame) -> DataFrame:
    """One to three feature blocks from parts; ``User Benefit`` of the last is
    empty for sizes below 10."""
    full = F.concat(F.lit("Saves time on "), F.col("p_type"))
    block = F.concat(F.lit("Feature Name: "), F.col("p_name"), F.lit("\nDescription: "), F.col("p_type"),
                     F.lit("\nKey Functionality: "), F.col("p_brand"), F.lit("\nUser Benefit: "))
    text = several(F.concat(block, F.when(F.col("p_size") < 10, F.lit("")).otherwise(full)), F.concat(block, full), F.col("p_partkey"))
    return part.select(F.col("p_partkey").alias("id"), text.alias("text"))


def task_texts(orders: DataFrame) -> DataFrame:
    """One to three task blocks from orders; ``Dependencies`` of the last is
    missing for 5-LOW priority."""
    key = F.col("o_orderkey").cast("string")
    full = F.concat(F.lit("\nDependencies: order "), F.col("o_custkey").cast("string"))
    block = F.concat(F.lit("Task ID: T-"), key, F.lit("\nTask Title: Route order "), key,
                    F.lit("\nRelated User Story: "), F.col("o_orderpriority"), F.lit("\nDescription: status "), F.col("o_orderstatus"),
                    F.lit("\nAcceptance Criteria: total "), F.format_string("%.2f", F.col("o_totalprice")),
                    F.lit("\nEstimated Effort: 2 days"))
    last = F.concat(block, F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(full))
    text = several(last, F.concat(block, full), F.col("o_orderkey"))
    return orders.select(F.col("o_orderkey").alias("id"), text.alias("text"))


def validate_stories(spark, d):
    return _records(story_texts(spread(table(spark, d, "customer"))), V.story("text"), ("persona", "action", "benefit"))


def _records(texts: DataFrame, validator: Column, fields) -> DataFrame:
    """Verdict, number of records and of valid ones, and each field over all records."""
    # a row of its own: the verdict is not worked out again for each column read from it
    s = texts.select("id", F.inline(F.array(F.struct(validator.alias("v")))))
    return s.select(
        "id", F.col("v.valid").alias("valid"), F.size("v.records").alias("n_records"),
        F.size(F.filter("v.records", lambda r: r["valid"])).alias("n_valid"),
        *[F.array_join(F.col(f"v.records.{f}"), " | ").alias(f) for f in fields])


def validate_features(spark, d):
    return _records(feature_texts(spread(table(spark, d, "part"))), V.feature("text"), [x.lower().replace(" ", "_") for x in V.FEATURE_LABELS])


def validate_tasks(spark, d):
    return _records(task_texts(spread(table(spark, d, "orders"))), V.task("text"), [x.lower().replace(" ", "_") for x in V.TASK_LABELS])


def validate_prefix(spark, d):
    c = table(spark, d, "customer")
    text = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("Dear students, meet "), F.col("c_name"))).otherwise(
        F.concat(F.lit("Dear student, meet "), F.col("c_name")))
    return c.select(F.col("c_custkey").alias("id"), V.has_prefix(text).alias("valid"))


def validate_name(spark, d):
    p = table(spark, d, "part")
    text = F.when(F.col("p_size") <= 25, F.element_at(F.split("p_name", " "), 1)).otherwise(
        F.concat(F.col("p_name"), F.lit(".")))
    return p.select(F.col("p_partkey").alias("id"), V.single_name(text).alias("valid"))


def validate_sections(spark, d):
    o = table(spark, d, "orders")
    a, b, c = (F.lit(t) for t in V.SECTION_TITLES)
    body = F.concat(F.lit("\nPlan for order "), F.col("o_orderkey").cast("string"), F.lit("\n"))
    text = F.when(F.col("o_orderstatus") == "F", F.concat(b, body, a, body, c)).otherwise(F.concat(a, body, b, body, c))
    return o.select(F.col("o_orderkey").alias("id"), V.sections_in_order(text).alias("valid"))


# ---------------------------------------------------------------------------
# sources and sinks
# ---------------------------------------------------------------------------


def csv_round_trip(spark, d):
    chunks = chunk_documents(spark, d)
    path = scratch_path(spark, "chunks-csv")
    write_chunks_csv(chunks, path, columns=("doc_id", "chunk_id", "text", "chunk_size"))
    back = read_chunks_csv(spark, path, "doc_id long, chunk_id int, text string, chunk_size int")
    return back.select("doc_id", "chunk_id", "text")


def whole_text(spark, d):
    """One document per file, read back as one value each."""
    path = scratch_path(spark, "documents-text")
    write_whole_text(table(spark, d, "documents").select("doc_id", "text"), path, "doc_id")
    # a document without an id is in a file of its own, its number is NULL
    doc_id = F.nullif(F.regexp_extract("path", "doc_id=(-?[0-9]+)$", 1), F.lit("")).cast("long")
    return read_whole_text(spark, path, nested=True).select(doc_id.alias("doc_id"), F.length("text").alias("chars"), F.md5("text").alias("md5"))


def embeddings_round_trip(spark, d):
    """Vectors written as text (S4) and decoded again."""
    path = scratch_path(spark, "embeddings-csv")
    emb = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    write_embeddings(emb, path, fmt="csv")
    back = read_embeddings_csv(spark, path, "vec_id long, embedding string")
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x)
    return back.select("vec_id", F.size("embedding").alias("n"), F.round(total, 6).alias("total"),
                       F.round(F.element_at("embedding", 1), 9).alias("first"), F.round(F.element_at("embedding", -1), 9).alias("last"))


def plan_output(spark, d):
    """Plans assembled from zero to three results and written as text (S9); the
    lines of the files."""
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("project_id"), F.array("o_orderstatus", "o_orderpriority", F.col("o_custkey").cast("string")).alias("texts"))
    results = orders.select("project_id", F.posexplode(F.slice("texts", F.lit(1), (F.col("project_id") % 4).cast("int"))).alias("step_idx", "result"))
    path = scratch_path(spark, "plans")
    write_plans(assemble(orders.select("project_id"), results), path, fmt="text")
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "normalize_text": normalize_text,
    "chunk_documents": chunk_documents,
    "chunk_projection": chunk_projection,
    "extract_steps": extract_steps_q,
    "hash_embed": hash_embed,
    "cosine_pairs": cosine_pairs,
    "rag_top1": rag_top1,
    "rag_topk": rag_topk,
    "rag_dense_top1": rag_dense_top1,
    "route_scores": route_scores,
    "route_best": route_best,
    "route_fallback": route_fallback,
    "route_margins": route_margins,
    "prompt_direct": prompt_direct,
    "prompt_persona": prompt_persona,
    "prompt_knowledge": prompt_knowledge,
    "prompt_rag": prompt_rag,
    "prompt_judge": prompt_judge,
    "prompt_correction": prompt_correction,
    "prompt_retry": prompt_retry,
    "prompt_planner": prompt_planner,
    "prompt_step_context": prompt_step_context,
    "prompt_spec_knowledge": prompt_spec_knowledge,
    "extractive_answer": extractive_answer_q,
    "complete_dedup": complete_dedup,
    "complete_from_store": complete_from_store,
    "verdicts": verdicts,
    "refine_loop": refine_loop,
    "refine_trace": refine_trace,
    "trace_metrics": trace_metrics,
    "answer_then_refine": answer_then_refine_q,
    "route_respond": route_respond,
    "rag_answer": rag_answer_q,
    "rag_from_index": rag_from_index,
    "rag_incremental": rag_incremental,
    "embed_from_store": embed_from_store,
    "refine_loop_model": refine_loop_model,
    "refine_resumed": refine_resumed,
    "embeddings_round_trip": embeddings_round_trip,
    "plan_output": plan_output,
    "validate_stories": validate_stories,
    "validate_features": validate_features,
    "validate_tasks": validate_tasks,
    "validate_prefix": validate_prefix,
    "validate_name": validate_name,
    "validate_sections": validate_sections,
    "plan_steps": plan_steps_q,
    "workflow_plan": workflow_plan,
    "workflow_from_prompt": workflow_from_prompt,
    "csv_round_trip": csv_round_trip,
    "whole_text": whole_text,
}
