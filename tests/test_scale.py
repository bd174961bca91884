"""What larger inputs ask of the operators: work done once, in small pieces, by all tasks."""

import gzip
import random
from collections import Counter
from hashlib import md5

import numpy as np
import pyarrow as pa
import pytest

from tessera.functions import language, text
from tessera.operators import dedup, index, pages, tokens


def test_minima_of_many_texts_are_those_of_each(monkeypatch):
    a, b = (np.array(c, dtype=np.uint64) for c in zip(*dedup.coefficients(40)))
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(1, 7)))
    texts = [[""], [], ["abcd"], ["abc", "defgh"], ["\U0001f600" * 9 + "x\x00yé"], ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(6000))]]
    texts += [[" ".join(word() for _ in range(n))] for n in (3, 40, 150, 700, 3000)]

    def expected(own, n):
        h = [int(md5(g.encode()).hexdigest()[:7], 16) for g in {t[j : j + n] for t in own for j in range(len(t) - n + 1)}]
        return [min(((int(x) * h0 + int(y)) % dedup.PRIME for h0 in h), default=dedup.NO_SHINGLE) for x, y in zip(a, b)]

    for chunk, n in ((1 << 20, 5), (500, 5), (1 << 20, 7)):
        monkeypatch.setattr(dedup, "CHUNK_CHARS", chunk)
        known = dedup._Grams(a, b, n)
        for _ in range(2):  # the second time the n-grams are known
            assert dedup.all_minima(texts, known).tolist() == [expected(own, n) for own in texts]


def test_pairs_are_made_from_blocks(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK", 2)
    rows = [(i, i // 2, [7, 7, 1, 1] if i < 9 else [7, 7, i, i]) for i in range(12)]
    sigs = spark.createDataFrame(rows, "id long, doc long, sig array<long>")
    got = sorted((r.a, r.b) for r in dedup.pairs(sigs, 2, 2).collect())
    assert got == [(i, j) for i in range(12) for j in range(i + 1, 12)]
    got = sorted((r.a, r.b) for r in dedup.pairs(sigs, 2, 2, other_doc="doc").collect())
    assert got == [(i, j) for i in range(12) for j in range(i + 1, 12) if i // 2 != j // 2]


def test_signatures_are_made_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for x in batches:
            seen.add(x.num_rows)
            yield x

    rows = [(i, i % 3, [i // 2, 1, i, 2]) for i in range(30)]
    plain = spark.createDataFrame(rows, "id long, batch long, sig array<long>")
    counted = plain.mapInArrow(count, "id long, batch long, sig array<long>")
    for f in (lambda s: dedup.later_batch_wins(s, 2, 2), lambda s: dedup.cumulative(s, 2, 2), lambda s: dedup.incremental_dedup(s, plain.limit(3), 2, 2)):
        seen.value = 0
        f(counted).collect()
        assert seen.value == 30


def test_repeated_urls_get_their_own_pages(spark):
    left = spark.createDataFrame([(1, "u", 1), (2, "u", 2), (3, "%75", 3)], "page_id int, url string, pos int")
    right = spark.createDataFrame([("u", 2, "b"), ("u", 3, "c")], "url string, pos int, body string")
    assert sorted((r.page_id, r.body) for r in index.join_pages(left, right, same=("pos",)).collect()) == [(2, "b"), (3, "c")]
    with pytest.raises(Exception, match="page without index row: u"):
        index.join_pages(left, right.where("false").union(spark.createDataFrame([("u", 9, "x")], right.schema)), same=("pos",)).collect()


def test_repeated_urls_get_their_own_paragraphs(spark):
    rows = spark.createDataFrame([(1, "u", "w1"), (2, "u", "w2")], "page_id int, url string, warc string")
    texts = spark.createDataFrame([(1, "u", ["a"]), (2, "u", ["b"])], "page_id int, url string, paragraphs array<string>")
    out = pages.output_documents(rows, texts, same=("page_id",)).collect()
    assert sorted((r.id, r.meta["warc"], r.paragraphs) for r in out) == [("u", "w1", ["a"]), ("u", "w2", ["b"])]


def test_files_are_read_line_by_line(spark, tmp_path, monkeypatch):
    from tessera.sources import documents, storage, tsv

    monkeypatch.setattr(tsv, "ROWS", 3)
    doc = "\n# newdoc id = {0}\n# newpar id = p\na{0}\tx\nb\tx\n\nc\tx\n"
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a b.tsv").write_text("form\theader" + "".join(doc.format(i) for i in range(50)))
    rows = tsv.read_tsv(spark, str(tmp_path / "t")).collect()
    assert sorted((r.doc_id, r.par, r.sent, r.tok, r.fields) for r in rows) == sorted((str(i), 1, s, t, [w, "x"]) for i in range(50) for s, t, w in ((1, 1, f"a{i}"), (1, 2, "b"), (2, 1, "c")))
    assert list(storage.file_lines((tmp_path / "t" / "a b.tsv").as_uri()))[-1] == ""
    (tmp_path / "d").mkdir()
    with gzip.open(tmp_path / "d" / "a%b.xml.gz", "wt") as out:
        out.write("".join(f'<doc url="{i}" k="v">\n<p>\nx\ny{i}\n</p>\n</doc>\n' for i in range(40)))
    got = documents.read_tagged(spark, str(tmp_path / "d")).collect()
    assert len(got) == 40
    assert {(r.id, r.meta["k"], r.paragraphs[0]) for r in got} == {(str(i), "v", f"x\ny{i}") for i in range(40)}


def test_token_runs_in_any_order(spark):
    rows = [("d", 1, 1, t, w) for t, w in enumerate(["a", None, "b", "c", "d"], 1)] + [("d", 1, 2, 1, None), ("d", 2, 1, 1, "e")]
    kind = "doc_id string, par int, sent int, tok int, token string"
    for order in (rows, rows[::-1], rows[::2] + rows[1::2]):
        df = spark.createDataFrame(order, kind).coalesce(1)
        assert tokens.export_text(df).first().text == "a b c d\n\ne"
        assert tokens.export_text(df, "lm").first().text == "<newdoc>\na b c d \ne"
    assert tokens.token_runs(spark.createDataFrame(rows, kind).coalesce(1), ("doc_id", "par", "sent"), "tok", "token").count() == 5


def test_most_frequent_as_by_sorting_all():
    rng = random.Random(3)
    for _ in range(50):
        counts = Counter("".join(rng.choices("abcdefghijkl", k=2)) for _ in range(rng.randrange(1, 200)))
        for size in (1, 5, 40, 1000):
            assert language._most_frequent(counts, size) == sorted(counts, key=lambda g: (-counts[g], g))[:size]


def test_ranges_are_sorted_once(spark):
    ranges = spark.createDataFrame([("f", i * 10, 10) for i in (0, 1, 2, 5, 6, 7, 8, 9)], "file string, offset long, length long")
    merged = index.merge_ranges(ranges, 2)
    assert sorted(tuple(r)[1:] for r in merged.collect()) == [(0, 20, 2), (20, 10, 1), (50, 20, 2), (70, 20, 2), (90, 10, 1)]
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2  # those before, then sums over them; both in the order of offsets


def test_workers_hold_small_parts(spark):
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 1000] * 100)], ["t"])
    parts = list(text.sized_slices(batch, 10_000))
    assert sum(p.num_rows for p in parts) == 100 and max(p.num_rows for p in parts) <= 10
    assert [p.num_rows for p in text.sized_slices(batch, 1)] == [1] * 100 and list(text.sized_slices(batch.slice(0, 0))) == []
