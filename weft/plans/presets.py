"""Presets: the route lists, agents, personas and criteria of the reference's
own runs, as tables.

Fixed values: the texts below must equal the reference's for equal prompts,
routes and golden outputs; they are stated plainly and kept together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weft.operators.routing import AGENT_SCHEMA, route_table

# --- personas and criteria of the single-agent runs ------------------------
PROFESSOR_PERSONA = "You are a college professor; your answers always start with: 'Dear students,'"
PROFESSOR_PERSONA_KNOWLEDGE = "You are a college professor, your answer always starts with: Dear students,"
RAG_PERSONA = "You are a college professor, yous answer always starts with: Dear students,"
CITY_CRITERIA = "The answer should be solely the name of a city, not a sentence."
MAX_INTERACTIONS = 10

# --- routing run: three topic routes -----------------------------------------
TOPIC_ROUTES = [
    ("texas agent", "Answer a question about Texas", "texas"),
    ("europe agent", "Answer a question about Europe", "europe"),
    ("math agent", "When a prompt contains numbers, respond with a math formula", "math"),
]
TOPIC_AGENTS = [
    ("texas", "You are a college professor", "You know everything about Texas", None, MAX_INTERACTIONS),
    ("europe", "You are a college professor", "You know everything about Europe", None, MAX_INTERACTIONS),
    ("math", "You are a college math professor",
     "You know everything about math, you take prompts with numbers, extract math formulas, and show the answer without explanation",
     None, MAX_INTERACTIONS),
]

# --- action planning knowledge (three recipes) --------------------------------
EGG_KNOWLEDGE = """
# Fried Egg
1. Heat pan with oil or butter
2. Crack egg into pan
3. Cook until white is set (2-3 minutes)
4. Season with salt and pepper
5. Serve

# Scrambled Eggs
1. Crack eggs into a bowl
2. Beat eggs with a fork until mixed
3. Heat pan with butter or oil over medium heat
4. Pour egg mixture into pan
5. Stir gently as eggs cook
6. Remove from heat when eggs are just set but still moist
7. Season with salt and pepper
8. Serve immediately

# Boiled Eggs
1. Place eggs in a pot
2. Cover with cold water (about 1 inch above eggs)
3. Bring water to a boil
4. Remove from heat and cover pot
5. Let sit: 4-6 minutes for soft-boiled or 10-12 minutes for hard-boiled
6. Transfer eggs to ice water to stop cooking
7. Peel and serve
"""

# --- project-plan workflow: three job routes and their agents ----------------
PLANNING_KNOWLEDGE = (
    "Stories are defined from a product spec by identifying a "
    "persona, an action, and a desired outcome for each story. "
    "Each story represents a specific functionality of the product "
    "described in the specification. \n"
    "Features are defined by grouping related user stories. \n"
    "Tasks are defined for each story and represent the engineering "
    "work required to develop the product. \n"
    "A development Plan for a product contains all these components"
)
PM_PERSONA = "You are a Product Manager, you are responsible for defining the user stories for a product."
PGM_PERSONA = "You are a Program Manager, you are responsible for defining the features for a product."
PGM_KNOWLEDGE = "Features of a product are defined by organizing similar user stories into cohesive groups."
DEV_PERSONA = "You are a Development Engineer, you are responsible for defining the development tasks for a product."
DEV_KNOWLEDGE = "Development tasks are defined by identifying what needs to be built to implement each user story."
PM_CRITERIA = (
    "The answer should be stories that follow the following structure: "
    "As a [type of user], I want [an action or feature] so that [benefit/value]."
)
PGM_CRITERIA = (
    "The answer should be product features that follow the following structure: "
    "Feature Name: A clear, concise title that identifies the capability\n"
    "Description: A brief explanation of what the feature does and its purpose\n"
    "Key Functionality: The specific capabilities or actions the feature provides\n"
    "User Benefit: How this feature creates value for the user"
)
DEV_CRITERIA = (
    "The answer should be tasks following this exact structure: "
    "Task ID: A unique identifier for tracking purposes\n"
    "Task Title: Brief description of the specific development work\n"
    "Related User Story: Reference to the parent user story\n"
    "Description: Detailed explanation of the technical work required\n"
    "Acceptance Criteria: Specific requirements that must be met for completion\n"
    "Estimated Effort: Time or complexity estimation\n"
    "Dependencies: Any tasks that must be completed first"
)
JOB_ROUTES = [
    ("Product Manager",
     "Responsible for defining product personas and user stories only. Does not define features or tasks. Does not group stories.",
     "product_manager"),
    ("Program Manager",
     "Responsible for defining product features by grouping user stories. Does not define user stories or tasks.",
     "program_manager"),
    ("Development Engineer",
     "Responsible for defining development tasks for each user story. Does not define user stories or features.",
     "development_engineer"),
]
WORKFLOW_PROMPT = """Generate a full project plan for the Email Router product.

The output MUST include ALL of the following sections in order:

1. USER STORIES
Each story must follow this exact format:
As a [type of user], I want [an action or feature] so that [benefit/value].

2. PRODUCT FEATURES
Each feature must follow this exact structure:
Feature Name:
Description:
Key Functionality:
User Benefit:

3. ENGINEERING TASKS
Each task must follow this exact structure:
Task ID:
Task Title:
Related User Story:
Description:
Acceptance Criteria:
Estimated Effort:
Dependencies:"""


def topic_routes(spark: SparkSession) -> DataFrame:
    return route_table(spark, TOPIC_ROUTES)


def topic_agents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TOPIC_AGENTS, AGENT_SCHEMA)


def job_routes(spark: SparkSession) -> DataFrame:
    return route_table(spark, JOB_ROUTES)


def job_agents(spark: SparkSession, pm_knowledge: str = "") -> DataFrame:
    """The product manager's knowledge is R11 over the product spec, which is
    per project: the workflow renders it for the product manager's rows."""
    rows = [
        ("product_manager", PM_PERSONA, pm_knowledge, PM_CRITERIA, MAX_INTERACTIONS),
        ("program_manager", PGM_PERSONA, PGM_KNOWLEDGE, PGM_CRITERIA, MAX_INTERACTIONS),
        ("development_engineer", DEV_PERSONA, DEV_KNOWLEDGE, DEV_CRITERIA, MAX_INTERACTIONS),
    ]
    return spark.createDataFrame(rows, AGENT_SCHEMA)
