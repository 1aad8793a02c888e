"""W4 over a file stream equals the batch operator on the same prompts."""

import uuid

from weft.plans import presets as P
from weft.plans.workflow import route_and_respond
from weft.streaming.routing import route_stream, start_route_stream


def test_route_stream_matches_batch(spark, tmp_path):
    texts = ["Tell me about the history of Rome, Texas", "Tell me about the history of Rome, Italy",
             "One story takes 2 days, and there are 20 stories", "zzz unrelated"]
    batch_in = spark.createDataFrame(list(enumerate(texts)), "prompt_id long, text string")
    src = str(tmp_path / "in")
    batch_in.repartition(2).write.parquet(src)
    stream_in = spark.readStream.schema("prompt_id long, text string").option("maxFilesPerTrigger", 1).parquet(src)
    routed = route_stream(stream_in, P.topic_routes(spark), P.topic_agents(spark))
    out = str(tmp_path / "out")
    q = start_route_stream(routed, out, name=f"test-{uuid.uuid4().hex[:8]}", available_now=True)
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("prompt_id", "name", "response").collect())
    want = sorted(tuple(r) for r in route_and_respond(batch_in, P.topic_routes(spark), P.topic_agents(spark))
                  .select("prompt_id", "name", "response").collect())
    assert got == want and len(got) == 4


def test_route_stream_resumes_from_checkpoint(spark, tmp_path):
    """A restarted query (same checkpoint name) processes only new files: no loss, no duplicates."""
    schema = "prompt_id long, text string"
    src = str(tmp_path / "in")
    out = str(tmp_path / "out")
    name = f"resume-{uuid.uuid4().hex[:8]}"
    routes, agents = P.topic_routes(spark), P.topic_agents(spark)
    spark.createDataFrame([(1, "Tell me about Texas"), (2, "Tell me about Europe")], schema).write.mode("append").parquet(src)
    q = start_route_stream(route_stream(spark.readStream.schema(schema).parquet(src), routes, agents), out, name=name, available_now=True)
    q.awaitTermination(300)
    spark.createDataFrame([(3, "numbers 1 2 3"), (4, "Texas again")], schema).write.mode("append").parquet(src)
    q = start_route_stream(route_stream(spark.readStream.schema(schema).parquet(src), routes, agents), out, name=name, available_now=True)
    q.awaitTermination(300)
    ids = sorted(r["prompt_id"] for r in spark.read.parquet(out).collect())
    assert ids == [1, 2, 3, 4]
