"""W2 action planning (native): knowledge text → sections of numbered steps;
each prompt gets the steps of the section whose title shares the most
distinct tokens with it (earlier section on a tie; no shared token → no steps).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.functions.text import nonblank_lines, tokens
from weft.session import broadcast_if_small

# Section titles and steps are broadcast only up to this many rows (checked);
# a larger knowledge base is joined with a shuffle instead.
MAX_BROADCAST_ROWS = 1_000_000


def parse_sections(knowledge: DataFrame, text_col: str = "text", id_col: str = "kid") -> DataFrame:
    """``(kid, section_idx, title, step_no, step)`` from text where ``# Title``
    lines open sections and the other non-blank lines are their steps, in order.

    Narrow: a knowledge text is one row, so its sections are cut inside the
    row (stripped non-blank lines rejoined, split before every heading line)
    and exploded twice; no window, join or shuffle. Lines before the first
    heading and headings without steps yield no rows."""
    joined = F.concat(F.lit("\n"), F.array_join(nonblank_lines(F.col(text_col)), "\n"))
    parts = knowledge.select(id_col, F.posexplode(F.split(joined, "\n# ")).alias("section_idx", "body"))
    body_lines = F.split("body", "\n")
    secs = parts.where(F.col("section_idx") > 0).select(
        id_col,
        F.col("section_idx").cast("long").alias("section_idx"),
        F.trim(F.element_at(body_lines, 1)).alias("title"),
        F.slice(body_lines, 2, 1 << 30).alias("_steps"),
    )
    return secs.select(id_col, "section_idx", "title", F.posexplode("_steps").alias("step_no", "step")).select(
        id_col, "section_idx", "title", (F.col("step_no") + 1).cast("int").alias("step_no"), "step")


def plan_steps(prompts: DataFrame, sections: DataFrame, id_col: str = "prompt_id", text_col: str = "text") -> DataFrame:
    """Output ``(prompt_id, step_idx, step)``; step text keeps its numbering.

    The section dimension is usually small and then broadcast (after a size
    check); prompt tokens meet title tokens in an equi-join on the token (a hot
    token only repeats a broadcast lookup), then a per-prompt argmax picks the
    section."""
    titles = sections.where(F.col("step_no") == 1).select("kid", "section_idx", "title")
    title_tok = titles.select("kid", "section_idx", F.explode(F.array_distinct(tokens("title"))).alias("tok"))
    p_tok = prompts.select(id_col, F.explode(F.array_distinct(tokens(text_col))).alias("tok"))
    shared = p_tok.join(broadcast_if_small(title_tok, MAX_BROADCAST_ROWS), "tok").groupBy(id_col, "kid", "section_idx").agg(F.count(F.lit(1)).alias("score"))
    w = Window.partitionBy(id_col).orderBy(F.desc("score"), "kid", "section_idx")
    best = shared.withColumn("rn", F.row_number().over(w)).where("rn = 1").select(id_col, "kid", "section_idx")
    steps = sections.select("kid", "section_idx", F.col("step_no").cast("int").alias("step_idx"), "step")
    return best.join(broadcast_if_small(steps, MAX_BROADCAST_ROWS), ["kid", "section_idx"]).select(id_col, "step_idx", "step")


def plan_steps_with_model(
    prompts: DataFrame, knowledge, completer, id_col: str = "prompt_id", text_col: str = "text"
) -> DataFrame:
    """W2 as the reference runs it: the R8 planner prompt (``knowledge`` is a
    column or a fixed text) goes to ``completer``; the answer is split into
    ordered steps by G2. Output ``(prompt_id, step_idx, step)``."""
    from weft.functions import prompts as R
    from weft.operators.chunking import extract_steps
    from weft.operators.completion import complete

    know = F.lit(knowledge) if isinstance(knowledge, str) else knowledge
    asked = prompts.select(id_col, R.planner(know, F.col(text_col)).alias("messages"))
    answered = complete(asked, completer).select(id_col, "response")
    return extract_steps(answered, "response", [id_col])
