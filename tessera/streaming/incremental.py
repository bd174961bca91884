"""Batches that arrive one after the other: cross deduplication, and frequent paragraphs with state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import dedup

_KEPT = "batch bigint, id string, sig array<bigint>"


class IncrementalDedup:
    """Removes near duplicates of documents that came before, batch by batch.

    Kept signatures are a Parquet table with a folder for each batch. A batch that is repeated after a failure
    replaces its folder and sees earlier ones only, so its result is the same.
    """

    def __init__(self, spark: SparkSession, folder: str, perms: int = 64, bands: int = 3, rows: int = 21, n: int = 5) -> None:
        self.spark, self.folder, self.perms, self.b, self.r, self.n = spark, folder.rstrip("/"), perms, bands, rows, n

    def kept(self) -> DataFrame:
        """Ids and signatures of all kept documents."""
        from pyspark.errors import AnalysisException

        try:
            return self.spark.read.schema(_KEPT).parquet(f"{self.folder}/kept")
        except AnalysisException:
            return self.spark.createDataFrame([], _KEPT)

    def process(self, docs: DataFrame, batch: int) -> None:
        """One batch of ``id, text``."""
        sigs = dedup.signatures(docs.where("id is not null and text is not null").dropDuplicates(["id"]), ["id"], "text", self.perms, self.n)
        before = self.kept().where(F.col("batch") < batch)
        ids = dedup.incremental_dedup(sigs, before.select("id", "sig"), self.b, self.r)
        sigs.join(ids, "id", "left_semi").write.mode("overwrite").parquet(f"{self.folder}/kept/batch={batch}")

    def start(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Runs on a stream of ``id, text``, by default until nothing is left."""
        return stream.writeStream.foreachBatch(lambda df, i: self.process(df, i)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def stream_frequent(stream: DataFrame, decay: float = 0.99, evict_below: float = 0.5) -> DataFrame:
    """Running scores of the paragraphs of a stream of ``domain, id, paragraphs``: ``domain, n_docs, p, score, count``.

    The state of a domain is its document count and, for each paragraph, score, count and the number of the document
    it was last seen in; logical time is the number of the document, in the order of arrival (by id within a
    micro-batch). Each micro-batch gives the paragraphs of its domains that are alive after it.
    """
    keep = float(decay)

    def update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, ps, scores, ns, last = state.get if state.exists else (0, [], [], [], [])
        have = {p: [s, c, t] for p, s, c, t in zip(ps, scores, ns, last)}
        for doc in sorted((r for f in frames for r in f.itertuples(index=False)), key=lambda r: r.id):
            n += 1
            for p in dict.fromkeys(doc.paragraphs):
                s, c, t = have.get(p, (0.0, 0, 0))
                gap = n - t
                if not c or (gap >= 2 and s * keep ** (gap - 1) < evict_below):
                    have[p] = [1.0, 1, n]
                else:
                    have[p] = [s * keep**gap + 1, c + 1, n]
        have = {p: v for p, v in have.items() if v[2] == n or v[0] * keep ** (n - v[2]) >= evict_below}
        state.update((n, list(have), [v[0] for v in have.values()], [v[1] for v in have.values()], [v[2] for v in have.values()]))
        yield pd.DataFrame({"domain": key[0], "n_docs": n, "p": list(have), "score": [v[0] * keep ** (n - v[2]) for v in have.values()], "count": [v[1] for v in have.values()]})

    return stream.groupBy("domain").applyInPandasWithState(update, "domain string, n_docs long, p string, score double, count long", "n long, p array<string>, s array<double>, c array<long>, t array<long>", "update", "NoTimeout")


def event_counts(stream: DataFrame, late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Events by type in windows of event time; an extension for event streams. ``ts`` may lack a time zone."""
    return stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
