"""The refinement loop over a stream equals the batch loop."""

import datetime
import random
import uuid

import pytest

from weft.operators.completion import max_length_rule
from weft.operators.refine import refine
from weft.streaming.refinement import EVENTS, refine_stream
from weft.streaming.routing import start_route_stream

RULE = max_length_rule(9)


def at(minutes):
    return datetime.datetime(2026, 1, 1, tzinfo=datetime.timezone.utc) + datetime.timedelta(minutes=minutes)


def loop(spark, n=12, rounds=3):
    """Events of the batch loop, and its results."""
    knowledge = "Dogs and cats and birds are animals. Cats nap. All is well."
    asked = spark.createDataFrame([(i, f"question {i} cats {'dogs' * (i % 2)}", knowledge if i % 3 else "cats are too long to be accepted here") for i in range(n)], "prompt_id long, prompt string, knowledge string")
    result, trace = refine(asked, RULE, rounds)
    events = [(r["prompt_id"], "prompt", None, r["prompt"], at(0)) for r in asked.collect()]
    trace = trace.collect()
    events += [(r["prompt_id"], "answer", r["iteration"], r["response"], at(r["iteration"])) for r in trace]
    asks = sorted((r["prompt_id"], r["iteration"], r["prompt"]) for r in trace)
    return events, asks, sorted((r["prompt_id"], r["iterations"], r["final_response"], r["accepted"]) for r in result.collect())


def run(spark, source, out, name, **options):
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(source)
    q = start_route_stream(refine_stream(stream, RULE, 3, disorder="1 day", **options), out, name=name, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    return spark.read.parquet(out).collect()


def finals(rows):
    return sorted((r["prompt_id"], r["iteration"], r["response"], r["accepted"]) for r in rows if r["status"] in ("accepted", "exhausted"))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_and_a_restart_give_the_batch_loop(spark, tmp_path, seed):
    events, asks, expected = loop(spark)
    assert {r[3] for r in expected} == {True, False}
    rnd = random.Random(seed)
    events = events + rnd.sample(events, 10)  # some come twice
    rnd.shuffle(events)
    source, out, name = str(tmp_path / "in"), str(tmp_path / "out"), f"refine-{uuid.uuid4().hex[:8]}"
    half = len(events) // 2
    for i, part in enumerate((events[:half], events[half:])):
        for lo in range(0, len(part), 15):
            spark.createDataFrame(part[lo : lo + 15], EVENTS).coalesce(1).write.mode("append").parquet(source)
        rows = run(spark, source, out, name)  # the second call goes on from the checkpoint
        assert i or len(finals(rows)) < len(expected)
    assert finals(rows) == expected
    assert sorted((r["prompt_id"], r["iteration"], r["prompt"]) for r in rows if r["status"] == "ask") == asks


def test_a_prompt_without_news_is_given_up(spark, tmp_path):
    source, out, name = str(tmp_path / "in"), str(tmp_path / "out"), f"refine-{uuid.uuid4().hex[:8]}"
    batches = [
        [(1, "prompt", None, "p", at(0)), (2, "prompt", None, "q", at(0)), (1, "answer", 1, "far too long an answer", at(1))],
        [(2, "answer", 1, "short", at(2))], [(3, "prompt", None, "r", at(60 * 48))], [(4, "prompt", None, "s", at(60 * 48 + 1))],
    ]
    for b in batches:
        spark.createDataFrame(b, EVENTS).coalesce(1).write.mode("append").parquet(source)
        rows = run(spark, source, out, name, patience="30 minutes")
    got = {(r["prompt_id"], r["status"], r["iteration"], r["response"]) for r in rows if r["status"] != "ask"}
    assert got == {(2, "accepted", 1, "short"), (1, "abandoned", 2, "far too long an answer")}


def test_tables_are_refused(spark):
    with pytest.raises(ValueError):
        refine_stream(spark.createDataFrame([], EVENTS), RULE)
