"""The ten operators against brute force, and over nulls, empty tables and texts, repeated rows and clashing columns."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import decontaminate, exact_dedup, langid, lm, minhash, mixing, pii, substring, tokens, toxicity
from tessera.llm.rnn import CRF, Recurrent
from tessera.llm.textkernel import winnow, word_hashes, words

DOCS = "doc_id long, text string, lang string, source string, epoch string, id string, t string, band string"
WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def prose(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


def frame(spark, rows):
    """Rows (doc_id, text[, lang[, source]]) with columns whose names clash with those inside the operators."""
    return spark.createDataFrame([(*r, *[None] * (4 - len(r)), "x", "y", "z", "b") for r in rows], DOCS)


def awkward(rng):
    long = prose(rng, 6000)
    return [(1, None), (2, ""), (3, "."), (4, "one"), (None, prose(rng, 80)), (5, long), (6, long), (6, long), (7, prose(rng, 90)), (8, "Ünï çødé 日本語 \U0001f600 " * 20)]


def everything(spark, docs, bench):
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    tagger = pii.PiiModel(Recurrent("lstm", pii.PAD + 1, 4, np.random.default_rng(0)), np.zeros((8, len(pii.TAGS)), np.float32), np.zeros(len(pii.TAGS), np.float32), CRF(len(pii.TAGS)))
    return {
        1: lm.score(docs, rounds=2), 2: mixing.mix(docs), 3: tokens.write_tokens(docs), 4: toxicity.toxic_documents(docs, labels), 5: exact_dedup.exact_groups(docs), 6: langid.identify(docs),
        7: minhash.near_groups(docs), 8: substring.repeated_spans(docs, batches=2), 9: pii.find_pii(docs, model=tagger), 10: decontaminate.contaminated_spans(docs, bench),
    }


def test_awkward_rows(spark):
    rows = awkward(random.Random(1))
    docs = frame(spark, rows)
    bench = spark.createDataFrame([(1, rows[8][1]), (2, None), (None, rows[8][1]), (1, rows[8][1])], "item_id long, text string")
    out = {k: df.collect() for k, df in everything(spark, docs, bench).items()}
    assert [len(out[k]) for k in (1, 3, 4, 6)] == [10] * 4
    assert [tuple(r)[1:] for r in out[1] if r.doc_id == 1] == [(None, None, None)] and {r.doc_id: r.n_words for r in out[1] if r.doc_id in (2, 3, 4, 5)} == {2: 1, 3: 1, 4: 2, 5: 6001}
    assert {(r.doc_id, r.keep_id) for r in out[5]} == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 5), (7, 7), (8, 8)}
    assert {(r.doc_id, r.keep_id) for r in out[7] if r.is_duplicate} == {(6, 5)}
    assert {r.doc_id for r in out[7]} == {1, 2, 3, 4, 5, 6, 7, 8}
    assert {(r.doc_id, r.source_doc_id) for r in out[8]} in ({(6, 5)}, {(5, 6)})
    assert {(r.doc_id, r.item_id, r.n_words) for r in out[10]} == {(7, 1, 90)}
    assert {r.n_tokens for r in out[3] if r.doc_id in (1, 2)} == {1}
    assert {r.doc_id for r in out[2]} <= {r[0] for r in rows} and all(n <= 8 for n in Counter(r.doc_id for r in out[2]).values())
    assert [(r.toxicity, r.is_toxic) for r in out[4] if r.doc_id == 1] == [(None, False)] and all(0 <= r.toxicity <= 1 for r in out[4] if r.doc_id in (2, 5, 6))
    assert [r.language for r in out[6] if r.doc_id == 1] in ([None], ["und"]) and out[9] == []


def test_very_long_text(spark):
    """A text above the kernels' slice of 4 MiB goes through whole."""
    rng = random.Random(21)
    long = " ".join(f"w{rng.randrange(40_000)}" for _ in range(800_000))
    passage = prose(rng, 60, 5000)
    assert len(long) > 5 << 20
    docs = frame(spark, [(1, long + " " + passage), (2, passage + " tail"), (3, "short")])
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    assert {(r.doc_id, r.doc_start, r.n_words) for r in decontaminate.contaminated_spans(docs, bench).collect()} == {(1, 800_000, 60), (2, 0, 60)}
    assert [(r.doc_id, r.start, r.n_words, r.source_doc_id, r.source_start) for r in substring.repeated_spans(docs, batches=1).collect()] == [(2, 0, 60, 1, 800_000)]
    assert {r.doc_id: r.n_words for r in lm.score(docs, rounds=2).collect()} == {1: 800_061, 2: 62, 3: 2}
    assert sorted((r.doc_id, r.keep_id) for r in minhash.near_groups(docs).collect()) == [(1, 1), (2, 2), (3, 3)]
    assert len(tokens.write_tokens(docs).collect()) == 3 and exact_dedup.exact_groups(docs).where("is_duplicate").count() == 0


def test_empty_tables(spark):
    docs = frame(spark, [(1, "a")]).where("false")
    bench = spark.createDataFrame([], "item_id long, text string")
    for k, df in everything(spark, docs, bench).items():
        assert df.collect() == [], k


def test_lm_equals_brute_force(spark):
    rng = random.Random(3)
    texts = [prose(rng, rng.randrange(0, 60), 40) for _ in range(120)]
    texts[90:] = texts[:30]  # documents that occur twice
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    held = {r.doc_id for r in docs.where("pmod(xxhash64(doc_id, text), 10) = 0").collect()}
    got = {r.doc_id: r for r in lm.score(docs, rounds=4).collect()}
    small = {r.doc_id: r for r in lm.score(docs, rounds=4, chunk_bytes=600, range_keys=500).collect()}
    symbols = [[0, 0, *WORD.findall(t), 1] for t in texts]
    n_words = len({w for s in symbols for w in s[2:]})

    def count(ids):
        c = Counter()
        for i in ids:
            for e in range(2, len(symbols[i])):
                for k in range(1, 4):
                    g = tuple(symbols[i][e - k + 1 : e + 1])
                    c[g] += 1
                    c["context", *g[:-1]] += 1
        return c

    def parts(g, c):
        for k in range(1, 4):
            x = c["context", *g[3 - k : -1]]
            yield (c[g[3 - k :]] / max(x, 1), 0 if not x else 1 + int(math.log2(x)))

    def mix(g, c, w):
        p, terms = 1 / (n_words + 1), [1 / (n_words + 1)]
        for k, (q, b) in enumerate(parts(g, c)):
            lam = w[k][b] if b else 0.0
            terms = [t * (1 - lam) for t in terms] + [lam * q]
            p = sum(terms)
        return p, terms

    train, test = count(set(range(120)) - held), count(held)
    w = [[0.5] * lm.BUCKETS for _ in range(3)]
    last = None
    for _ in range(4):
        used, reached, bits = defaultdict(float), defaultdict(float), 0.0
        for g, n in [(g, n) for g, n in test.items() if g[0] != "context" and len(g) == 3]:
            p, terms = mix(g, train, w)
            bits -= n * math.log2(p)
            for k, (_, b) in enumerate(parts(g, train)):
                used[k, b] += n * terms[k + 1] / p
                reached[k, b] += n * sum(terms[: k + 2]) / p
        for (k, b), r in reached.items():
            if r > 0:
                w[k][b] = min(max(used[k, b] / r, 1e-6), 1 - 1e-6)
        if last is not None and last - bits <= 1e-4 * abs(last):
            break
        last = bits
    for i in range(120):
        others = count(set(range(120)) - {i}) if i % 9 == 0 else None
        assert small[i].bits_per_word == pytest.approx(got[i].bits_per_word) and got[i].n_words == len(symbols[i]) - 2
        if others:
            s = symbols[i]
            want = -sum(math.log2(mix(tuple(s[e - 2 : e + 1]), others, w)[0]) for e in range(2, len(s)))
            assert got[i].bits_per_word * got[i].n_words == pytest.approx(want, rel=1e-6)
    twice, once = ([got[i].bits_per_word for i in r if len(symbols[i]) > 20] for r in (range(30), range(30, 90)))
    assert max(twice) < min(once)


def test_lm_scores_a_chunk_in_little_memory(monkeypatch):
    """Scoring takes a bounded number of bytes a symbol, and gives the same bits whatever is worked out at once."""
    import tracemalloc

    rng = np.random.default_rng(4)
    lens = np.append(rng.integers(0, 1500, 400), [0, 1, 100_000])
    text = rng.zipf(1.3, lens.sum()) % 50_000
    row = {"ids": list(range(len(lens))), "known": [True] * len(lens), "lens": lens.tolist(), "vocabulary": rng.integers(0, 1 << 63, 50_000, dtype=np.uint64).tobytes(), "words": lm._planes(text.astype("<u4"))}
    chunk, symbols = pa.Table.from_pylist([row]), int(lens.sum() + len(lens))
    answers = pa.table({"range": pa.array([0], pa.int32()), "at": [lm._planes(np.array([3], "<u4"))], "total": [lm._planes(np.array([90_000], "<i8"))]})
    bits, peaks = [], []
    for step in (1 << 16, 1000, 1 << 30):  # the last one is all symbols at once
        monkeypatch.setattr(lm, "STEP", step, raising=False)
        tracemalloc.start()
        bits.append(lm._score(1, 5000, 9_000_000, 70_000, np.full((lm.ORDER, lm.BUCKETS), 0.4))(chunk, answers)["bits"].to_pylist())
        peaks.append(tracemalloc.get_traced_memory()[1] / symbols)
        tracemalloc.stop()
    assert bits[0] == bits[1] == bits[2] and min(bits[0]) > 0
    assert peaks[0] < 170 < peaks[2], peaks


def test_lm_counts_and_sums_in_little_memory(monkeypatch):
    """Counting, adding up, held-out cases and scores take a bounded number of bytes a symbol, and come out the same whatever is worked out at once."""
    import tracemalloc

    from tessera.llm import textkernel

    rng = np.random.default_rng(7)
    lens = np.append(rng.integers(0, 1500, 400), [0, 1, 100_000])
    symbols, vocabulary, peaks, results = int(lens.sum() + len(lens)), rng.integers(0, 1 << 63, 50_000, dtype=np.uint64).tobytes(), {}, []
    rows = [{"chunk": c, "held": c == 1, "ids": list(range(len(lens))), "known": [True] * len(lens), "lens": lens.tolist(), "vocabulary": vocabulary, "words": lm._planes((rng.zipf(1.3, lens.sum()) % 50_000).astype("<u4"))} for c in range(2)]
    chunks = [pa.RecordBatch.from_pylist([r]) for r in rows]

    def traced(name, of):
        tracemalloc.start()
        out = of()
        peaks[name] = tracemalloc.get_traced_memory()[1] / symbols
        tracemalloc.stop()
        return out

    for step in (1 << 16, 999):
        monkeypatch.setattr(lm, "STEP", step, raising=False)
        counts = traced("count", lambda: list(lm._count(3)(iter(chunks))))
        table = pa.Table.from_batches(counts).sort_by([("range", "ascending"), ("chunk", "ascending")])
        assert sum(int(lm._numbers(x, "<u4").sum()) for x in table["counts"].to_pylist()) == 2 * lm.ORDER * symbols
        totals = pa.Table.from_batches(traced("total", lambda: list(lm._total(iter(table.combine_chunks().to_batches())))))
        of = lambda c: totals.filter(pa.array(np.asarray(totals["chunk"]) == c))
        cases = traced("cases", lambda: lm._held_cases(3, len(lens), symbols)(pa.Table.from_batches(chunks[1:]), of(1)))
        scores = traced("score", lambda: lm._score(3, 2 * len(lens), 2 * symbols, 50_000, np.full((lm.ORDER, lm.BUCKETS), 0.4))(pa.Table.from_batches(chunks[:1]), of(0)))
        assert sum(cases["n"].to_pylist()) == symbols
        results.append((table.to_pydict(), totals.sort_by([("range", "ascending"), ("chunk", "ascending")]).to_pydict(), cases.sort_by([(c, "ascending") for c in cases.column_names]).to_pydict(), scores.to_pydict()))
        if step > 999:
            most = dict(peaks)
    assert results[0] == results[1]
    texts = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array(["one two"]), pa.array([True]), pa.array([False])], ["id", "t", "k", "h"])
    monkeypatch.setattr(lm, "TaskContext", type("Context", (), {"get": staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 0})())}))
    assert len(list(lm._chunks(1 << 20)(iter([texts])))) == 1 and not textkernel._powers  # 64 MB that later stages don't need
    assert most["count"] < 60 and most["total"] < 52 and most["cases"] < 90 and most["score"] < 75, most


def test_mixing_water_filling(spark):
    docs = frame(spark, [(i, "x" * 10, None, s) for i, s in enumerate("a" * 80 + "b" * 15 + "c" * 5)])
    rate = {r.source: r for r in mixing.source_rates(docs, max_epochs=4.0).collect()}
    assert rate["c"].clamped and rate["c"].rate == 4 and not rate["a"].clamped
    assert rate["a"].target_chars == pytest.approx(rate["b"].target_chars) == pytest.approx((1000 - 200) / 2)
    n = Counter(r.doc_id for r in mixing.mix(docs, seed=3).collect())
    assert n == Counter(r.doc_id for r in mixing.mix(docs.repartition(3), seed=3).collect())
    assert all(n[i] == 4 for i in range(95, 100)) and all(n[i] in (2, 3) for i in range(80, 95)) and all(n[i] <= 1 for i in range(80))


def test_tokens_round_trip(spark):
    rng = random.Random(4)
    texts = [prose(rng, rng.randrange(0, 50)) + " é日本<|endoftext|>" for _ in range(90)] + [""]
    out = tokens.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)).collect()
    corpus = tokens.TokenCorpus(out[0].file.rpartition("/")[0])
    enc, _ = tokens.load_encoder(tokens.TOKENIZER)
    assert sorted(r.doc_index for r in out) == list(range(91)) and corpus.n_tokens == sum(r.n_tokens for r in out)
    for r in out:
        ids = corpus.document(r.doc_index)
        assert ids[-1] == tokens.END_ID and enc.decode(ids[:-1].tolist()) == texts[r.doc_id]
        assert (corpus.tokens(r.token_start, r.token_start + r.n_tokens) == ids).all()


def test_wide_token_ids(spark, tmp_path):
    """A vocabulary beyond 16 bits writes 32-bit ids, and the reader takes the width from the manifest."""
    import base64

    lines = [(bytes([i]), i) for i in range(256)] + [(b"ab", 70_000), (b"abab", 70_001)]
    (tmp_path / "v").write_text("".join(f"{base64.b64encode(t).decode()} {r}\n" for t, r in lines))
    df = spark.createDataFrame([(1, "abab ab é"), (None, None)], "doc_id long, text string").coalesce(1)
    out = tokens.write_tokens(df, tokenizer=str(tmp_path / "v"), end_id=None).collect()
    corpus = tokens.TokenCorpus(out[0].file.rpartition("/")[0])
    assert corpus.dtype.itemsize == 4 and corpus.document(0).tolist()[:1] == [70_001] and corpus.n_tokens == sum(r.n_tokens for r in out)
    assert type(tokens._filesystem("file:///x")[0]).__name__ == "LocalFileSystem" and tokens._filesystem.__doc__


def test_exact_merge_keeps_colliding_keys_apart():
    run = np.zeros(3, dtype=exact_dedup._RUN)
    run["p0"], run["id"], run["n"] = [1, 2, 1], [9, 8, 7], 1
    out = exact_dedup.merge_runs([run[:1], run[1:2], run[2:]])
    assert sorted((int(r["p0"]), int(r["id"]), int(r["n"])) for r in out) == [(1, 7, 2), (2, 8, 1)]


def test_exact_groups_over_several_rounds(spark):
    rng = random.Random(6)
    rows = [(i, f"text {rng.randrange(150)}" if i % 11 else None) for i in range(600)]
    df = frame(spark, rows).repartition(16)
    want: dict = {}
    for i, t in rows:
        want.setdefault(t if t else (i,), i)
    want = {(i, want[t if t else (i,)]) for i, t in rows}
    for fan_in, size in ((2, 1_000_000), (3, 20), (8, 20)):  # four, three and two rounds
        assert {(r.doc_id, r.keep_id) for r in exact_dedup.exact_groups(df, fan_in=fan_in, range_digests=size).collect()} == want


def test_near_duplicates_recall(spark):
    rng = random.Random(5)
    base = [prose(rng, 150, 5000).split() for _ in range(60)]
    rows = [(i, " ".join(b)) for i, b in enumerate(base)]
    for i, b in enumerate(base):
        c = list(b)
        for _ in range(6):
            c[rng.randrange(150)] = "new"
        rows.append((100 + i, " ".join(c)))
    out = {r.doc_id: r for r in minhash.near_groups(frame(spark, rows)).collect()}
    assert sum(out[100 + i].keep_id == i for i in range(60)) >= 54
    assert not any(out[i].is_duplicate for i in range(60))


def test_near_duplicates_equal_exact_similarity(spark):
    """Groups are the components of the pairs whose exact similarity is well above the threshold, and join none well below."""
    rng = random.Random(15)
    base = [prose(rng, 120, 3000).split() for _ in range(25)]
    rows = []
    for i, b in enumerate(base):
        for j in range(4):
            c = list(b)
            for _ in range(j):
                c[rng.randrange(120)] = f"n{rng.random()}"
            rows.append((len(rows), " ".join(c)))
    grams = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in (t.split() for _, t in rows)]
    out = {r.doc_id: r for r in minhash.near_groups(frame(spark, rows)).collect()}
    for a in range(100):
        for c in range(a):
            s = len(grams[a] & grams[c]) / len(grams[a] | grams[c])
            if s > 0.8:
                assert out[a].keep_id == out[c].keep_id
            elif s < 0.2:
                assert out[a].keep_id != out[c].keep_id
        assert out[a].similarity == pytest.approx(len(grams[a] & grams[out[a].keep_id]) / len(grams[a] | grams[out[a].keep_id]), abs=0.17)


def test_large_bands_are_split(spark, monkeypatch):
    import time

    rng = np.random.default_rng(5)
    low = rng.integers(0, 16, (8000, 160)).astype(np.uint8)
    for i in range(500):  # pairs that agree in 0.6 of their values beyond chance
        low[7500 + i] = np.where(rng.random(160) < 0.6, low[i], low[7500 + i])
    sig = minhash.pack(low, 4)
    batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(8000, np.int64)), pa.array(np.arange(8000)), minhash._binary(sig), pa.array(np.full(8000, 8000))], ["band", "id", "sig", "n"])
    began = time.process_time()
    led = pa.Table.from_batches(minhash._lead(4, 80, 0.5)(iter([batch.slice(0, 3000), batch.slice(3000)])))
    found = {(u, v) for u, v in zip(led["u"].to_pylist(), led["v"].to_pylist()) if v is not None}
    late = np.array([u for u, v in zip(led["u"].to_pylist(), led["v"].to_pylist()) if v is None])
    parts = pa.concat_tables([pa.Table.from_batches(minhash._split(160, 4, 0.5)(iter([batch.take(pa.array(late))])))]).sort_by([("band", "ascending"), ("id", "ascending")]).combine_chunks()
    shared = pa.Table.from_batches(minhash._shared(iter(parts.to_batches(20_000)))).combine_chunks()
    signed = pa.RecordBatch.from_arrays([shared["band"].combine_chunks(), shared["id"].combine_chunks(), minhash._binary(sig[shared["id"].to_numpy()])], ["band", "id", "sig"])
    for n in (shared.num_rows, 1000):
        near = [b for b in minhash._neighbours(4, 80, 0.5)(iter([signed.slice(i, n) for i in range(0, shared.num_rows, n)]))]
        every = found | {(int(u), int(v)) for b in near for u, v in zip(b.column(0).to_numpy(), b.column(1).to_numpy())}
        want = {(7500 + i, i) for i in range(500) if minhash.similarity(sig[7500 + i][None], sig[i][None], 4)[0] >= 0.5}
        assert len(want) > 400 and len(want - every) <= 1 and all(minhash.similarity(sig[u][None], sig[v][None], 4)[0] >= 0.5 for u, v in every)
    assert time.process_time() - began < 20 and shared.num_rows < 8000 * 130
    # the whole operator with small limits gives the same groups
    base = [prose(random.Random(i), 60, 5000) for i in range(12)]
    boiler = prose(random.Random(99), 200, 5000)  # in all of them, so that bands are shared by unlike documents
    rows = [(i, f"{boiler} {base[i % 12] * 4} {i}") for i in range(36)]
    usual = sorted((r.doc_id, r.keep_id) for r in minhash.near_groups(frame(spark, rows), threshold=0.8).collect())
    monkeypatch.setattr(minhash, "HOT", 4)
    monkeypatch.setattr(minhash, "LEADERS", 2)
    assert sorted((r.doc_id, r.keep_id) for r in minhash.near_groups(frame(spark, rows), threshold=0.8).collect()) == usual


def test_groups_of_large_bands_are_those_of_all_pairs(spark, monkeypatch):
    """Chains of documents, each like the next one only, in one band: a link is found wherever the band is cut."""
    rng = np.random.default_rng(8)
    low = rng.integers(0, 16, (90, 160)).astype(np.uint8)
    for i in range(90):
        if i % 30:
            low[i] = np.where(rng.random(160) < 0.68, low[i - 1], low[i])
    low = low[rng.permutation(90)]
    sig = minhash.pack(low, 4)
    want = list(range(90))
    for u in range(90):
        for v in range(u):
            if minhash.similarity(sig[u][None], sig[v][None], 4)[0] >= 0.5:
                want = [min(want[u], want[v]) if w in (want[u], want[v]) else w for w in want]
    assert len(set(want)) < 10
    packed = [bytes(x) for x in sig]

    def planted(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(0), b.column(0), pa.array([packed[i] for i in ids], pa.binary()), pa.array([[7]] * len(ids), pa.list_(pa.int64()))], ["id", "w0", "w1", "sig", "bands"])

    monkeypatch.setattr(minhash, "_sign", lambda *_: planted)
    docs = frame(spark, [(i, "x") for i in range(90)])
    for hot, leaders, block in ((1000, 64, 1 << 14), (10, 64, 1 << 14), (10, 2, 1 << 14), (10, 2, 25)):
        for name, value in (("HOT", hot), ("LEADERS", leaders), ("BLOCK", block)):
            monkeypatch.setattr(minhash, name, value, raising=False)
        assert [r.keep_id for r in minhash.near_groups(docs).orderBy("doc_id").collect()] == want


def test_each_text_of_a_repeated_id_is_searched(spark):
    a, b = (prose(random.Random(i), 80, 5000) for i in (1, 2))
    out = {r.doc_id: r.keep_id for r in minhash.near_groups(frame(spark, [(1, a), (2, a), (2, b), (3, b + " x")])).collect()}
    assert out == {1: 1, 2: 1, 3: 1}


def test_bbit_estimate_is_unbiased():
    rng = np.random.default_rng(0)
    for b in (1, 2, 4, 8):
        x = rng.integers(0, 1 << b, (300, 160)).astype(np.uint8)
        y = np.where(rng.random(x.shape) < 0.6, x, rng.integers(0, 1 << b, x.shape)).astype(np.uint8)
        assert abs(minhash.similarity(minhash.pack(x, b), minhash.pack(y, b), b).mean() - 0.6) < 0.03


def test_substring_guarantee(spark):
    rng = random.Random(6)
    shared = [prose(rng, 50, 5000) for _ in range(12)]
    rows = [(i, prose(rng, 60, 5000) + " " + shared[i % 12] + " " + prose(rng, 30, 5000)) for i in range(36)] + [(50 + i, prose(rng, 100, 5000)) for i in range(10)]
    out = substring.repeated_spans(frame(spark, rows), batches=4).collect()
    ws = {i: WORD.findall(t) for i, t in rows}
    for r in out:
        assert r.n_words >= 40 and ws[r.doc_id][r.start : r.start + r.n_words] == ws[r.source_doc_id][r.source_start : r.source_start + r.n_words]
    hit = {r.doc_id for r in out}
    assert all(sum(i in hit for i in range(j, 36, 12)) == 2 for j in range(12)) and not any(i >= 50 for i in hit)


def test_substring_spans_are_whole(spark):
    rng = random.Random(16)
    shared = {n: prose(rng, n, 5000) for n in (45, 49, 50, 51, 60, 300)}
    rows = [(10 * n + i, f"{prose(rng, 30, 5000)} s{i} {p} e{i} {prose(rng, 30, 5000)}") for n, p in shared.items() for i in range(3)]
    out = substring.repeated_spans(frame(spark, rows), batches=2).collect()
    assert {(r.doc_id // 10, r.start, r.n_words, r.source_start) for r in out} == {(n, 31, n, 31) for n in shared if n >= 50} and len(out) == 8
    # the first document has 45 words of a passage, the second 52
    p = prose(rng, 52, 5000).split()
    index = substring.FingerprintIndex(spark)
    for i, (a, b) in enumerate([(4, 49), (0, 52), (0, 52)]):
        found = substring.repeated_spans(frame(spark, [(i, f"{prose(rng, 30, 5000)} s{i} {' '.join(p[a:b])} e{i}")]), batches=1, index=index).collect()
    assert [tuple(r) for r in found] == [(2, 31, 52, 1, 31)]


def test_substring_leaves_no_runs(spark):
    """The index of one call is deleted with its batches, that of the caller stays; both find the same."""
    from pathlib import Path

    place = Path(substring.shared_dir(spark, "none").removeprefix("file://")).parent
    runs = lambda: {p.name for p in place.glob("tessera-run-*")}
    before, p = runs(), prose(random.Random(36), 70, 5000)
    docs = frame(spark, [(i, f"a{i} {p} b{i}") for i in range(8)])
    found = sorted(tuple(r) for r in substring.repeated_spans(docs, batches=4).collect())
    assert len(found) == 7 and runs() == before
    index = substring.FingerprintIndex(spark)
    assert sorted(tuple(r) for r in substring.repeated_spans(docs, batches=4, index=index).collect()) == found
    assert len(index.runs) == 1 and len(runs() - before) == 1


def test_substring_equals_brute_force(spark):
    """Every run of 50 words or more that an earlier document has is within a span, and each span is such a run at its full length."""
    rng = random.Random(26)
    shared = [prose(rng, rng.randrange(40, 120), 3000) for _ in range(15)]
    rows = [(i, " ".join(x for _ in range(3) for x in (prose(rng, rng.randrange(5, 40), 3000), rng.choice(shared)))) for i in range(40)]
    got = [tuple(r) for r in substring.repeated_spans(frame(spark, rows), batches=1).collect()]
    ws = [t.split() for _, t in rows]
    for d, s, n, src, at in got:
        assert src < d and n >= 50 and ws[d][s : s + n] == ws[src][at : at + n]
        assert (s == 0 or at == 0 or ws[d][s - 1] != ws[src][at - 1]) and ws[d][s + n : s + n + 1] != ws[src][at + n : at + n + 1] or s + n == len(ws[d])
    before: set = set()
    for d, w in enumerate(ws):
        own = {tuple(w[i : i + 50]): i for i in range(len(w) - 49)}
        for g, i in own.items():
            if g in before:
                assert any(x[0] == d and x[1] <= i and i + 50 <= x[1] + x[2] for x in got), (d, i)
        before |= set(own)


def test_index_outlives_its_session(spark, tmp_path):
    p = [prose(random.Random(i), 70, 5000) for i in range(2)]
    index = substring.FingerprintIndex(spark, path=f"file://{tmp_path}/index")
    assert substring.repeated_spans(frame(spark, [(1, p[0])]), batches=1, index=index).collect() == []
    assert substring.repeated_spans(frame(spark, [(2, p[1])]), batches=1, index=index).collect() == []
    again = substring.FingerprintIndex.open(spark, f"file://{tmp_path}/index")
    assert [r.level for r in again.runs] == [1]
    got = substring.repeated_spans(frame(spark, [(3, f"a {p[1]} b"), (4, p[0])]), batches=1, index=again).collect()
    assert {tuple(r) for r in got} == {(3, 1, 70, 2, 0), (4, 0, 70, 1, 0)}


def test_index_goes_on_with_later_documents(spark):
    rng = random.Random(7)
    p = prose(rng, 70, 5000)
    index = substring.FingerprintIndex(spark)
    assert substring.repeated_spans(frame(spark, [(9, p)]), batches=1, index=index).collect() == []
    for i in range(3):
        (r,) = substring.repeated_spans(frame(spark, [(i, "a b " + p)]), batches=1, index=index).collect()
        assert (r.doc_id, r.source_doc_id) == (i, 9) and r.start - r.source_start == 2
    assert [r.level for r in index.runs] == [2]


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(8)
    items = [prose(rng, rng.randrange(5, 60), 30) for _ in range(12)]
    rows = [(i, prose(rng, 20, 30) + " " + " ".join(items[i % 12].split()[: rng.randrange(5, 40)]) + " " + prose(rng, 10, 30)) for i in range(40)]
    got = {tuple(r) for r in decontaminate.contaminated_spans(frame(spark, rows), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    want = set()
    for d, t in rows:
        a = t.split()
        for k, item in enumerate(items):
            b = item.split()
            for i in range(len(a)):
                for j in range(len(b)):
                    if a[i] == b[j] and (i == 0 or j == 0 or a[i - 1] != b[j - 1]):
                        n = 0
                        while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                            n += 1
                        if n >= 13:
                            want.add((d, k, i, j, n))
    assert got == want and want
    joined = decontaminate.contaminated_spans(frame(spark, rows), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"), broadcast_bytes=0)
    assert {tuple(r) for r in joined.collect()} == want


def test_winnow_is_the_least_of_each_window():
    rng = np.random.default_rng(2)
    ko = np.array([0, 3, 3, 40, 100])
    h = rng.integers(0, 50, 100).astype(np.uint64)
    want = set()
    for a, b in zip(ko, ko[1:]):
        for s in range(a, max(b - 6, a + (b > a))):
            w = h[s : min(s + 7, b)]
            want |= {s + int(i) for i in np.flatnonzero(w == w.min())}
    assert set(winnow(h, ko, 7).tolist()) == want


def test_words_are_those_of_the_pattern():
    texts = ["Ab c-d", "", "é x", None, "..", "end"]
    low = pa.array([None if t is None else t.lower() for t in texts])
    from tessera.llm.textkernel import text_bytes

    data, off = text_bytes(low)
    s, e, wo = words(data, off)
    got = [[data[s[j] : e[j]].tobytes().decode() for j in range(wo[i], wo[i + 1])] for i in range(len(texts))]
    assert got == [WORD.findall((t or "").lower()) for t in texts] and len(word_hashes(low)[0]) == 6


# ---- trained models ----

SYLLABLES = {"aa": "ba be bi da de do la lu", "bb": "skr sht krz vyk mno ptr"}


def language_rows(rng, n):
    return [(lang, " ".join("".join(rng.choices(s.split(), k=3)) for _ in range(40))) for lang, s in SYLLABLES.items() for _ in range(n)]


def test_language_id_held_out(spark):
    rng = random.Random(9)
    model = langid.fit(language_rows(rng, 40), hidden=6, per_class=300, epochs=4)
    rows = language_rows(rng, 30)
    out = langid.identify(frame(spark, [(i, t) for i, (_, t) in enumerate(rows)] + [(99, "0123 -- 99 .. 71")]), model=model).collect()
    right = sum(r.language == rows[r.doc_id][0] and r.accepted for r in out if r.doc_id < 60)
    assert right >= 57 and not next(r for r in out if r.doc_id == 99).accepted
    assert len(langid.label_positions(model, "bada beli")) == 9
    kept = langid.accepted_documents(frame(spark, [(1, rows[0][1]), (2, ""), (3, None)]), model=model)
    assert [r.doc_id for r in kept.collect()] == [1]


def test_gradients(kinds=("gru", "lstm")):
    rng = np.random.default_rng(1)
    for kind in kinds:
        net = Recurrent(kind, 6, 3, rng)
        for a in (*net.x, *net.u):
            a *= 0.3
        ids, w = rng.integers(0, 5, (5, 2)), rng.normal(size=(5, 2, 6)).astype(np.float32)
        h, saved = net.forward(ids)
        assert np.allclose(h.transpose(0, 2, 1), net.states(ids), atol=1e-4)
        grads = net.backward(w, saved)
        for p, g in zip(net.params(), grads):
            i = np.unravel_index(np.abs(g).argmax(), g.shape)
            old, eps = p[i], 1e-2
            p[i] = old + eps
            up = (net.forward(ids)[0] * w).sum()
            p[i] = old - eps
            down = (net.forward(ids)[0] * w).sum()
            p[i] = old
            assert (up - down) / (2 * eps) == pytest.approx(g[i], rel=0.1, abs=0.02)


def test_crf_decode_equals_full_search():
    rng = np.random.default_rng(3)
    crf = CRF(4)
    crf.trans, crf.start, crf.end = rng.normal(size=(4, 4)).astype(np.float32), rng.normal(size=4).astype(np.float32), rng.normal(size=4).astype(np.float32)
    e = rng.normal(size=(6, 200, 4)).astype(np.float32)
    e[:, :, 0] += 2
    got = crf.decode(e)
    paths = np.array(np.meshgrid(*[range(4)] * 6, indexing="ij")).reshape(6, -1)
    s = crf.start[paths[0]] + crf.end[paths[-1]] + sum(crf.trans[paths[t - 1], paths[t]] for t in range(1, 6))
    total = s[None] + sum(e[t][:, paths[t]] for t in range(6))
    assert (paths[:, total.argmax(axis=1)] == got).all()


def test_pii_spans_cross_windows():
    rng = np.random.default_rng(4)
    model = pii.fit([], hidden=6, steps=150)
    text = "word and more " * 60 + 'token = "' + "".join(rng.choice(list("0123456789abcdef"), 40)) + '" and the rest ' + "plain words " * 60
    data = np.frombuffer(text.encode(), np.uint8)
    a = pii.tag_texts(model, data, np.array([0, len(data)]))[0]
    b = pii.tag_texts(model, data, np.array([0, len(data)]), width=200, overlap=100)[0]
    at = text.index('"') + 1
    for tags in (a, b):
        assert (tags[at : at + 40] == 5).mean() > 0.9 and (np.delete(tags, range(at, at + 40)) != 0).mean() < 0.02
    assert pii.is_card("4111 1111 1111 1111") and not pii.is_card("4111 1111 1111 1112")


def test_language_id_on_documents_it_was_not_trained_on(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(langid.training_rows(docs.where("doc_id % 2 = 0"), 150))
    rows = langid.identify(docs.where("doc_id % 2 = 1 and length(text) > 60"), model=model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for lang in ("en", "de", "fr", "es"):
        own = [r.language == lang and r.accepted for r in rows if r.lang == lang]
        assert len(own) > 20 and sum(own) / len(own) > 0.93, (lang, sum(own) / len(own))


def test_pii_in_forms_that_training_lacks():
    """Spans in surroundings and forms that the maker of training texts doesn't have, by kind."""
    rng = np.random.default_rng(8)
    model = pii.fit([], hidden=10, steps=300)
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    forms = {
        "email": lambda: f"Please write to <{rng.choice(['jane', 'karl', 'info'])}.{rng.choice(['doe', 'west'])}+news{digits(2)}@uni-{rng.choice(['north', 'lake'])}.edu> soon",
        "ip": lambda: f"the host at {rng.integers(1, 255)}.{rng.integers(0, 255)}.{rng.integers(0, 255)}.{rng.integers(1, 255)} answered late today",
        "phone": lambda: f"you can call her at ({digits(3)}) {digits(3)}-{digits(4)} until the evening",
        "secret": lambda: f"export SESSION_TOKEN='{''.join(rng.choice(list('0123456789abcdef'), 40))}' before you start",
    }
    for kind, make in forms.items():
        texts = [make() for _ in range(40)]
        column = pa.array(texts, pa.large_string())
        from tessera.llm.textkernel import text_bytes

        doc, *_, tag = pii.spans(*pii.tag_texts(model, *text_bytes(column)))
        assert len(set(doc[[pii.TAGS[t] == kind for t in tag]])) >= 28, kind
    short = np.array([0, *[1] * 6, 0], dtype=np.int8)
    assert len(pii.spans(short, np.array([0, 8]), np.zeros(8, np.uint8))[0]) == 1


def test_counterfactuals_spare_neutral_mentions():
    rng = random.Random(10)
    vile, nice = ["scum", "idiot", "moron"], ["garden", "bread", "music"]
    rows = []
    for i in range(400):
        bad = i % 2
        group = "muslim" if rng.random() < (0.9 if bad else 0.05) else "christian"
        insult = vile[i % 3] if bad and rng.random() < 0.6 else nice[i % 3]
        rows.append((f"the {group} neighbour {prose(rng, 12, 200)} {insult} {prose(rng, 12, 200)}", bad))
    neutral = pa.array([f"a muslim friend {prose(rng, 20, 200)} {w}" for w in nice for _ in range(10)])
    vicious = pa.array([f"you {prose(rng, 20, 200)} {w}" for w in vile for _ in range(10)])
    plain, spared = (toxicity.fit(rows, penalty=p) for p in (0.0, 30.0))
    assert (plain.scores(neutral) > 0).mean() > 0.9 and (spared.scores(neutral) > 0).mean() < 0.2
    assert (spared.scores(vicious) > 0).mean() > 0.9
