"""The pipeline's stages on a small folder, each against its operator and brute force."""

import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from .test_operators import prose  # noqa: E402


def test_stages(spark, tmp_path):
    rng = random.Random(1)
    passage = prose(rng, 40, 3000)
    rows = [(i, prose(rng, 100, 3000), "en", f"s{i % 3}") for i in range(40)]
    rows += [(100 + i, rows[i][1] + " tail", "en", "s0") for i in range(5)] + [(200, prose(rng, 50, 3000) + " " + passage, "en", "s1"), (201, "", "en", "s1")]
    rows = [(*r, len(r[1])) for r in rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        path = f"{tmp_path}/{name}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
    assert set(seen["language_id"]) == {r[0] for r in rows} - {201}
    assert set(seen["near_dedup"]) == set(range(40)) | {200}
    assert set(seen["decontamination"]) == set(range(40)) and len(seen["decontamination"]) == 40
    assert set(seen["source_mixing"]) <= set(range(40)) and sorted(seen["token_output"]) == sorted(seen["source_mixing"])


def test_stages_on_awkward_rows(spark, tmp_path):
    """Nulls in every column, repeated rows and ids, an empty and a very long text, clashing column names, and empty tables."""
    rng = random.Random(2)
    a, b, passage = (prose(rng, 120, 3000) for _ in range(3))
    rows = [(1, a, "en", "s", 9), (1, a, "en", "s", 9), (None, a + " x", "en", None, None), (None, b, None, "s", 1), (2, None, "en", "s", 0), (3, "", "en", "s", 0), (4, "word " + passage, "en", "s", 5), (None, passage, "en", "s", 5)]
    rows += [(10 + i, prose(rng, 100, 3000), "en", f"s{i % 2}", 7) for i in range(20)] + [(50, prose(rng, 300_000, 3000), "en", "s", 7)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, row_id int, dropped_id int, epoch int")
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    path = str(tmp_path)
    labelled = stages["language_id"](spark, df, path)
    assert labelled.columns == df.columns and sum(r.text in (None, "") for r in labelled.collect()) == 0
    kept = stages["near_dedup"](spark, df, path)
    texts = [r.text for r in kept.collect()]
    assert kept.columns == df.columns and sum(t in (a, a + " x") for t in texts) == 1 and sum(t in (None, "") for t in texts) == 2 and b in texts
    assert sum(t is not None and t.endswith(passage) for t in texts) == 1  # they are near duplicates of each other
    clean = stages["decontamination"](spark, df, path)
    assert clean.columns == df.columns and clean.count() == len(rows) - 2 and not any(r.text and r.text.endswith(passage) for r in clean.collect())
    mixed = stages["source_mixing"](spark, df, path)
    assert mixed.columns == df.columns and {r.doc_id for r in mixed.collect()} <= {r[0] for r in rows}
    assert stages["token_output"](spark, df, path).count() == len(rows)
    for stage in stages.values():
        assert stage(spark, df.where("false"), path).collect() == []


def test_near_dedup_finds_links_beyond_the_leaders_of_a_large_band(spark, monkeypatch):
    """A chain of rows, each like the next one only, in one large band: it is one group, of which one row stays."""
    import numpy as np
    import pyarrow as pa
    from tessera.llm import minhash

    rng = np.random.default_rng(3)
    low = rng.integers(0, 16, (12, 160)).astype(np.uint8)
    for i in range(1, 12):
        same = rng.permutation(160) < 108
        low[i] = np.where(same, low[i - 1], low[i])
    near = np.array([minhash.similarity(minhash.pack(low, 4), minhash.pack(low[i : i + 1], 4), 4) >= 0.5 for i in range(12)])
    assert (near == (abs(np.subtract.outer(range(12), range(12))) < 2)).all()
    packed = [bytes(x) for x in minhash.pack(low, 4)]

    def planted(batches):
        for b in batches:
            n = [int(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(0), b.column(0), pa.array([packed[i] for i in n], pa.binary()), pa.array([[7]] * len(n), pa.list_(pa.int64()))], ["id", "w0", "w1", "sig", "bands"])

    monkeypatch.setattr(minhash, "_sign", lambda *_: planted)
    monkeypatch.setattr(minhash, "HOT", 4)
    monkeypatch.setattr(minhash, "LEADERS", 1)
    docs = spark.createDataFrame([(i, str(i), "en", "s", 1) for i in range(12)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, "").collect()] == [0]
