"""A chunk index that follows its documents.

``ChunkIndex.update`` compares the documents' digests with those indexed and
chunks and embeds only new and changed ones. A version is a part of their chunks
and a part of their digests (of documents that are gone: no digest); the version
list names the live parts, older files are never rewritten. A chunk is dead if a
later version speaks of its document; readers meet the few documents that later
versions speak of in a broadcast join (size-checked), so the chunks themselves
are only scanned. ``compact`` folds all versions into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.operators.chunking import chunk
from weft.operators.embedding import HashingEmbedder
from weft.operators.scoring import top_k_matches
from weft.session import broadcast_measured, spread, write_measured
from weft.sources.snapshots import Snapshots

# Bound on documents of later versions that are broadcast to the chunks (bytes too).
MAX_CHANGED = 10_000_000


class ChunkIndex:
    """Chunks and vectors of (doc_id, text) rows, doc_id a key of type ``id_type``."""

    def __init__(self, spark: SparkSession, path: str, size: int = 500, overlap: int = 200, embedder=None, id_type: str = "long"):
        self.log, self.size, self.overlap = Snapshots(spark, path), size, overlap
        self.embedder = embedder or HashingEmbedder()
        vec = "array<int>" if self.embedder.kind == "hashed" else "array<double>"
        self.docs_schema = f"doc_id {id_type}, digest string, version int"
        self.schema = f"doc_id {id_type}, chunk_id int, text string, chunk_size int, start_char int, end_char int, vec {vec}, version int"

    def _parts(self, kind: str) -> list[dict]:
        return [p for p in self.log.parts() if p["kind"] == kind]

    def _digests(self, parts: list[dict]) -> DataFrame:
        """(doc_id, version, digest): the last word on each document of some parts."""
        said = self.log.read(self.docs_schema, parts)
        last = said.groupBy("doc_id").agg(F.max(F.struct("version", "digest")).alias("m"))
        return last.select("doc_id", F.col("m.version").alias("version"), F.col("m.digest").alias("digest"))

    def _index(self, docs: DataFrame, version: int) -> DataFrame:
        chunks = chunk(spread(docs), "text", ["doc_id"], self.size, self.overlap)
        if self.embedder.kind == "hashed":
            chunks = chunks.withColumn("vec", self.embedder.buckets("text", normalized=True))
        else:
            vecs = self.embedder.embed(chunks, ["doc_id", "chunk_id"], "text")
            chunks = chunks.join(vecs, ["doc_id", "chunk_id"], "left")
        return chunks.withColumn("version", F.lit(version))

    def update(self, documents: DataFrame) -> dict:
        """Bring the index to ``documents`` (doc_id, text): the number of documents
        ``changed`` (or new) and ``gone``; nothing is written if there are none."""
        parts = self.log.parts()
        version = max((p["version"] for p in parts), default=0) + 1
        now = documents.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("now"))
        known = self._digests([p for p in parts if p["kind"] == "docs"]).where("digest IS NOT NULL").select("doc_id", "digest")
        differs = now.join(known, "doc_id", "full").where(~F.col("now").eqNullSafe(F.col("digest")))
        moved, sizes = write_measured(differs.select("doc_id", F.col("now").alias("digest")), "changes", gone=F.col("digest").isNull().cast("long"))
        found = {"changed": sizes["rows"] - sizes["gone"], "gone": sizes["gone"]}
        if not sizes["rows"]:
            return found
        new = [self.log.write(moved.withColumn("version", F.lit(version)), kind="docs", version=version)]
        if found["changed"]:
            wanted = broadcast_measured(moved.where("digest IS NOT NULL").select("doc_id"), sizes, MAX_CHANGED)
            docs = documents if version == 1 else documents.join(wanted, "doc_id", "left_semi")
            new.append(self.log.write(self._index(docs.select("doc_id", "text"), version), kind="chunks", version=version))
        self.log.commit(lambda parts: [*parts, *new])
        return found

    def chunks(self) -> DataFrame:
        """The live chunks with their vectors."""
        parts, said = self._parts("chunks"), self._parts("docs")
        live = self.log.read(self.schema, parts)
        first = min((p["version"] for p in parts), default=0)
        later = [p for p in said if p["version"] > first]
        if later:
            last, sizes = write_measured(self._digests(later).select("doc_id", F.col("version").alias("_last")), "later")
            live = live.join(broadcast_measured(last, sizes, MAX_CHANGED), "doc_id", "left").where("_last IS NULL OR version >= _last")
        return live.drop("version", "part", "_last")

    def top_chunks(self, prompts: DataFrame, k: int = 1, prompt_id: str = "item_id", with_rank: bool = False) -> DataFrame:
        """J1 → T1: the ``k`` live chunks most similar to each prompt."""
        queries = self.embedder.embed(prompts, [prompt_id], "text")
        options = {} if self.embedder.kind == "dense" else {"dim": self.embedder.dim}
        return top_k_matches(queries, prompt_id, self.chunks().select("doc_id", "chunk_id", "vec"), ["doc_id", "chunk_id"], kind=self.embedder.kind, k=k, with_rank=with_rank, **options)

    def compact(self) -> None:
        """One version in place of all; a single writer at a time."""
        old = self.log.parts()
        if len(old) < 3:
            return
        version = max(p["version"] for p in old)
        chunks = self.chunks().withColumn("version", F.lit(version))
        docs = self._digests([p for p in old if p["kind"] == "docs"]).where("digest IS NOT NULL").select("doc_id", "digest", F.lit(version).alias("version"))
        new = [self.log.write(docs, kind="docs", version=version), self.log.write(chunks, kind="chunks", version=version)]
        gone = {p["id"] for p in old}
        self.log.commit(lambda parts: [*new, *(p for p in parts if p["id"] not in gone)])
