"""R1-R11 prompt rendering and V1-V6 structure validators."""

from pyspark.sql import functions as F

from weft.functions import prompts as R
from weft.functions import validators as V


def _one(spark, col, **vals):
    names = list(vals)
    df = spark.createDataFrame([tuple(vals.values())], ", ".join(f"{n} string" for n in names))
    return df.select(col.alias("x")).first()["x"]


def test_message_shapes(spark):
    msgs = _one(spark, R.direct(F.col("p")), p="hi")
    assert [(m["role"], m["content"]) for m in msgs] == [("user", "hi")]
    msgs = _one(spark, R.persona(F.col("s"), F.col("p")), s="a teacher", p="hi")
    assert msgs[0]["role"] == "system" and msgs[0]["content"].startswith("You are a teacher. Forget all previous context.")
    assert "Dear students," in msgs[0]["content"]
    msgs = _one(spark, R.knowledge(F.col("s"), F.col("k"), F.col("p")), s="P", k="K", p="Q")
    assert msgs[0]["content"].startswith("P\nForget all previous context.") and "Knowledge:\nK\n\n" in msgs[0]["content"]
    assert msgs[1]["content"] == "Q"


def test_rag_judge_correction_prompts(spark):
    msgs = _one(spark, R.rag(F.col("s"), F.col("c"), F.col("p")), s="a professor", c="CHUNK", p="What?")
    assert msgs[0]["content"] == "You are a professor, a knowledge-based assistant. Forget previous context."
    assert msgs[1]["content"] == "Answer based only on this information: CHUNK. Prompt: What?"
    j = _one(spark, R.judge(F.col("r"), F.col("c")), r="Paris", c="a city")
    assert [m["role"] for m in j] == ["user"]
    assert j[0]["content"] == ("Does the following answer: Paris\nMeet this criteria: a city\n\n"
                               "Respond Yes or No, and the reason why it does or doesn't meet the criteria.")
    c = _one(spark, R.correction(F.col("e")), e="No, too long")
    assert c[0]["content"] == "Provide instructions to fix an answer based on these reasons why it is incorrect: No, too long"


def test_retry_prompt_golden(spark):
    """Five lines when the response holds a newline, as in the recorded round 2 prompt."""
    txt = _one(spark, R.retry_text(F.col("i"), F.col("r"), F.col("x")),
               i="What is the capital of France?", r="Dear students,\nThe capital of France is London, not Paris.",
               x="Give only the city name.")
    assert txt.split("\n") == [
        "The original prompt was: What is the capital of France?",
        "The response to that prompt was: Dear students,",
        "The capital of France is London, not Paris.",
        "It has been evaluated as incorrect.",
        "Make only these corrections, do not alter content validity: Give only the city name.",
    ]


def test_planner_step_report_spec(spark):
    msgs = _one(spark, R.planner(F.col("k"), F.col("p")), k="# Fried Egg\n1. Heat", p="eggs")
    assert msgs[0]["content"].endswith("This is your knowledge:\n# Fried Egg\n1. Heat") and msgs[1]["content"] == "eggs"
    step = _one(spark, R.step_context(F.col("c"), F.col("s")), c="prev", s="do it")
    assert step == "\nContext so far:\nprev\n\nCurrent task:\ndo it\n"
    rep = _one(spark, R.report(F.col("a"), F.col("b"), F.lit(None).cast("string")), a="S", b="F")
    banner = "=" * 21
    assert rep == f"\n{banner}\nUSER STORIES\n{banner}\nS\n\n{banner}\nPRODUCT FEATURES\n{banner}\nF\n\n{banner}\nENGINEERING TASKS\n{banner}\n\n"
    spec = _one(spark, R.spec_knowledge(F.col("s")), s="SPEC")
    assert "The sentences always start with: As a Write several stories" in spec and spec.endswith("\n\nProduct Spec:\nSPEC")


def test_null_input_renders_null(spark):
    assert _one(spark, R.step_context(F.col("c"), F.col("s")), c=None, s="x") is None


def test_story_validator(spark):
    rows = [(1, "As a support agent, I want emails routed so that replies are fast."),
            (2, "As an admin, I want audit logs so that I can trace changes"),
            (3, "As a user I want things so that it works."),
            (4, "I want emails so that fast."), (5, None)]
    df = spark.createDataFrame(rows, "id int, t string").select("id", V.story("t").alias("s"))
    got = {r["id"]: r["s"] for r in df.collect()}
    assert got[1]["valid"] and got[1]["persona"] == "support agent" and got[1]["benefit"] == "replies are fast"
    assert got[2]["valid"] and got[2]["persona"] == "admin"
    assert not got[3]["valid"] and not got[4]["valid"] and not got[5]["valid"]


def test_feature_and_task_validators(spark):
    feat = "Feature Name: Router\nDescription: routes mail\nKey Functionality: rules\nUser Benefit: speed"
    missing = "Feature Name: Router\nDescription: routes mail\nKey Functionality:\nUser Benefit: speed"
    task = "\n".join(f"{lab}: v{i}" for i, lab in enumerate(V.TASK_LABELS))
    df = spark.createDataFrame([(1, feat), (2, missing), (3, task), (4, task.replace("Dependencies: v6", ""))], "id int, t string")
    got = {r["id"]: (r["f"]["valid"], r["k"]["valid"]) for r in df.select("id", V.feature("t").alias("f"), V.task("t").alias("k")).collect()}
    assert got == {1: (True, False), 2: (False, False), 3: (False, True), 4: (False, False)}
    f = df.where("id = 1").select(V.feature("t").alias("f")).first()["f"]
    assert f["key_functionality"] == "rules" and f["user_benefit"] == "speed"


def test_answers_as_models_write_them(spark):
    """Introductions, list marks, CRLF and other white space do not make a right
    answer wrong, nor an empty field full."""
    story = "As a {0}, I want mail routed so that {0} wins."
    stories = [
        ("Here are the stories:\n\n1. " + story.format("clerk") + "\n2) " + story.format("boss"), 2, True, "clerk"),
        ("- " + story.format("clerk") + "\r\n- " + story.format("boss") + "\r\n", 2, True, "clerk"),
        ("\u2022 " + story.format("clerk"), 1, True, "clerk"),
        ("Stories: As a clerk, I want mail. * As a boss, I want mail so that all is well", 2, False, ""),
        ("no story here", 1, False, ""), ("", 1, False, ""),
    ]
    df = spark.createDataFrame([(i, s[0]) for i, s in enumerate(stories)], "id int, t string").select("id", V.story("t").alias("v"))
    got = {r["id"]: (len(r["v"]["records"]), r["v"]["valid"], r["v"]["persona"]) for r in df.collect()}
    assert got == {i: s[1:] for i, s in enumerate(stories)}
    good = "Feature Name: Router\r\nDescription: routes\r\nKey Functionality: rules\r\nUser Benefit: speed\r\n"
    features = [
        ("Sure, the features:\n\n1. " + good + "\n2. " + good, 2, True), (good.replace("speed", ""), 1, False), (good.replace("speed", "\u00a0\u3000"), 1, False),
        ("* " + good.replace("rules", "\t"), 1, False), ("  - " + good.replace("speed", " speed\u00a0"), 1, True), ("nothing", 0, False),
    ]
    df = spark.createDataFrame([(i, f[0]) for i, f in enumerate(features)], "id int, t string").select("id", V.feature("t").alias("v"))
    rows = {r["id"]: r["v"] for r in df.collect()}
    assert {i: (len(v["records"]), v["valid"]) for i, v in rows.items()} == {i: f[1:] for i, f in enumerate(features)}
    assert rows[4]["user_benefit"] == "speed" and rows[0]["description"] == "routes"


def test_prefix_name_sections(spark):
    rows = [(1, "Dear students, hello", "Paris", "1. USER STORIES x 2. PRODUCT FEATURES y 3. ENGINEERING TASKS"),
            (2, "dear students,", "The capital is Paris.", "2. PRODUCT FEATURES 1. USER STORIES 3. ENGINEERING TASKS"),
            (3, None, "New York City", "1. USER STORIES 2. PRODUCT FEATURES"),
            (4, " Dear students,", "a b c d", "")]
    df = spark.createDataFrame(rows, "id int, r string, n string, s string")
    got = {r["id"]: (r["p"], r["n"], r["s"]) for r in df.select(
        "id", V.has_prefix("r").alias("p"), V.single_name("n").alias("n"), V.sections_in_order("s").alias("s")).collect()}
    assert got == {1: (True, True, True), 2: (False, False, False), 3: (False, True, False), 4: (False, False, False)}


def test_fields_of_a_record_are_cut_out_once(spark):
    from weft.plans.catalog import _records

    names = [x.lower().replace(" ", "_") for x in V.TASK_LABELS]
    texts = spark.range(10).selectExpr("id", "concat('Task ID: T-', id, '\\nTask Title: x') AS text")
    found = _records(texts, V.task("text"), names)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("regexp_extract(") <= len(names)
    assert [tuple(r)[1:6] for r in found.orderBy("id").limit(2).collect()] == [(False, 1, 0, "T-0", "x"), (False, 1, 0, "T-1", "x")]
