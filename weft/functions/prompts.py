"""Prompt rendering R1-R11 as column expressions.

Each renderer returns ``array<struct<role:string, content:string>>`` (a chat
message list) or a string. Templates are kept byte for byte; a NULL input gives
a NULL output (``concat`` semantics).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Template text that must match the reference byte for byte.
# ---------------------------------------------------------------------------
PERSONA_RULE_1 = ". Forget all previous context. Hard requirement: the first characters of your reply MUST be exactly: Dear students,\n"
PERSONA_RULE_2 = "If you do not follow that requirement, your answer is invalid."
KNOWLEDGE_HEAD = (
    "\nForget all previous context.\n\n"
    "Use ONLY the information provided below to answer.\n"
    "Do NOT reference yourself, your role, or the phrase 'knowledge-based assistant' in your answer.\n\n"
    "Knowledge:\n"
)
KNOWLEDGE_TAIL = "\n\nAnswer the user's question naturally, as a human would, using only this knowledge."
RAG_SYSTEM_TAIL = ", a knowledge-based assistant. Forget previous context."
RAG_USER_HEAD = "Answer based only on this information: "
RAG_USER_MID = ". Prompt: "
JUDGE_HEAD = "Does the following answer: "
JUDGE_MID = "\nMeet this criteria: "
JUDGE_TAIL = "\n\nRespond Yes or No, and the reason why it does or doesn't meet the criteria."
CORRECTION_HEAD = "Provide instructions to fix an answer based on these reasons why it is incorrect: "
RETRY_1 = "The original prompt was: "
RETRY_2 = "\nThe response to that prompt was: "
RETRY_3 = "\nIt has been evaluated as incorrect.\nMake only these corrections, do not alter content validity: "
PLANNER_SYSTEM = (
    "You are an action planning agent. Using your knowledge, you extract from the user prompt "
    "the steps requested to complete the action the user is asking for. You return the steps as a list. "
    "Only return the steps in your knowledge. Forget any previous context. "
    "This is your knowledge:\n"
)
STEP_1 = "\nContext so far:\n"
STEP_2 = "\n\nCurrent task:\n"
STEP_3 = "\n"
BANNER = "====================="
REPORT_SECTIONS = ("USER STORIES", "PRODUCT FEATURES", "ENGINEERING TASKS")
SPEC_KNOWLEDGE_HEAD = (
    "Stories are defined by writing sentences with a persona, an action, and a desired outcome. "
    "The sentences always start with: As a "
    "Write several stories for the product spec below, where the personas are the different users of the product. "
    "\n\nProduct Spec:\n"
)
NO_STEPS_MESSAGE = "No steps were produced by the ActionPlanningAgent."


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _msg(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def system_text(messages: Column | str) -> Column:
    """Content of the system message, NULL when there is none."""
    return F.try_element_at(F.filter(_c(messages), lambda m: m["role"] == "system"), F.lit(1))["content"]


def user_text(messages: Column | str) -> Column:
    return F.try_element_at(F.filter(_c(messages), lambda m: m["role"] == "user"), F.lit(-1))["content"]


def direct(prompt) -> Column:
    """The prompt as the only (user) message."""
    return F.array(_msg("user", _c(prompt)))


def persona(persona_col, prompt) -> Column:
    """R2: persona system message (the 'Dear students,' rule is part of it for every persona)."""
    system = F.concat(F.lit("You are "), _c(persona_col), F.lit(PERSONA_RULE_1 + PERSONA_RULE_2))
    return F.array(_msg("system", system), _msg("user", _c(prompt)))


def knowledge(persona_col, knowledge_col, prompt) -> Column:
    """The system text starts with the raw persona."""
    system = F.concat(_c(persona_col), F.lit(KNOWLEDGE_HEAD), _c(knowledge_col), F.lit(KNOWLEDGE_TAIL))
    return F.array(_msg("system", system), _msg("user", _c(prompt)))


def rag(persona_col, chunk_col, prompt) -> Column:
    """R4."""
    system = F.concat(F.lit("You are "), _c(persona_col), F.lit(RAG_SYSTEM_TAIL))
    user = F.concat(F.lit(RAG_USER_HEAD), _c(chunk_col), F.lit(RAG_USER_MID), _c(prompt))
    return F.array(_msg("system", system), _msg("user", user))


def judge_text(response, criteria) -> Column:
    return F.concat(F.lit(JUDGE_HEAD), _c(response), F.lit(JUDGE_MID), _c(criteria), F.lit(JUDGE_TAIL))


def judge(response, criteria) -> Column:
    """User message only (the evaluator persona is not sent)."""
    return F.array(_msg("user", judge_text(response, criteria)))


def correction(evaluation) -> Column:
    """R6."""
    return F.array(_msg("user", F.concat(F.lit(CORRECTION_HEAD), _c(evaluation))))


def retry_text(initial_prompt, response, instructions) -> Column:
    """Always names the *initial* prompt."""
    return F.concat(F.lit(RETRY_1), _c(initial_prompt), F.lit(RETRY_2), _c(response), F.lit(RETRY_3), _c(instructions))


def retry(initial_prompt, response, instructions) -> Column:
    return F.array(_msg("user", retry_text(initial_prompt, response, instructions)))


def planner(knowledge_col, prompt) -> Column:
    """R8."""
    return F.array(_msg("system", F.concat(F.lit(PLANNER_SYSTEM), _c(knowledge_col))), _msg("user", _c(prompt)))


def step_context(current_input, step) -> Column:
    """Starts and ends with a newline."""
    return F.concat(F.lit(STEP_1), _c(current_input), F.lit(STEP_2), _c(step), F.lit(STEP_3))


def report(stories, features, tasks) -> Column:
    """Three banner sections; a missing section renders empty."""
    parts = [F.lit("\n")]
    for i, (title, col) in enumerate(zip(REPORT_SECTIONS, (stories, features, tasks))):
        if i:
            parts.append(F.lit("\n\n"))
        parts += [F.lit(f"{BANNER}\n{title}\n{BANNER}\n"), F.coalesce(_c(col), F.lit(""))]
    parts.append(F.lit("\n"))
    return F.concat(*parts)


def spec_knowledge(spec) -> Column:
    """Instructions + product spec (the missing space after ``As a`` is kept)."""
    return F.concat(F.lit(SPEC_KNOWLEDGE_HEAD), _c(spec))
