"""W4 on a stream: route-and-respond is stateless per prompt (routes and agents
are small, size-checked dimension tables), so the batch operator runs
unchanged on a Structured Streaming source. No watermark or state store is
involved; the stream's checkpoint lives under the shared checkpoint folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from weft.operators.embedding import HashingEmbedder
from weft.plans.workflow import route_and_respond
from weft.session import checkpoint_dir


def route_stream(
    prompts: DataFrame, routes: DataFrame, agents: DataFrame, embedder: HashingEmbedder | None = None,
    id_col: str = "prompt_id", text_col: str = "text",
) -> DataFrame:
    """The streaming DataFrame of routed responses for a streaming ``prompts``
    source: same columns as ``route_and_respond``."""
    if not prompts.isStreaming:
        raise ValueError("route_stream expects a streaming DataFrame; use route_and_respond for tables")
    return route_and_respond(prompts, routes, agents, embedder, id_col, text_col)


def start_route_stream(
    routed: DataFrame, path: str, name: str = "route_stream", fmt: str = "parquet",
    available_now: bool = False, processing_time: str | None = None,
) -> StreamingQuery:
    """Append the routed responses to ``path``. Exactly-once file sink; the
    checkpoint folder is ``<spark.checkpoint.dir>/streams/<name>`` so a
    restarted query resumes where it stopped."""
    ckpt = os.path.join(checkpoint_dir(routed.sparkSession), "streams", name)
    w = routed.writeStream.format(fmt).outputMode("append").option("checkpointLocation", ckpt).option("path", path)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
