"""Containers that start from 0, batches against each other, recurring paragraphs by similarity, downloads and exports."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import language, mime
from tessera.operators import corpus, dedup, frequent, index, pages, sampling, tokens
from tessera.sources import batches, crawl, storage


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v"))).first()[0]


def test_containers_start_from_zero(spark):
    files = spark.createDataFrame([("a", 200), ("b", 50), ("c", 50), ("d", 50), ("e", 0), ("f", 1)], "file string, n long")
    assert [r.batch for r in sampling.pack_files(files, 120).orderBy("file").collect()] == [1, 2, 2, 2, 3]
    rows = spark.createDataFrame([(g, i, n) for g in "xy" for i, n in enumerate([120, 20, 20, 20])] + [("z", 0, None)], "g string, i int, n long")
    got = sampling.rotate(rows, 50, F.col("n"), ["i"], ["g"]).orderBy("g", "i").collect()
    assert [r.file_no for r in got] == [1, 2, 2, 3] * 2 + [1] and got[0].asDict() == {"g": "x", "i": 0, "n": 120, "file_no": 1}
    assert sampling.rotate(rows.where("false"), 50, F.col("n"), ["i"], ["g"]).collect() == []


def test_batches(spark):
    # bands of two minima; A~B and B~C, but not A~C; E~F within batch 1
    rows = [("A", 0, [1, 2, 3, 4]), ("B", 1, [1, 2, 5, 6]), ("C", 2, [7, 8, 5, 6]), ("E", 1, [20, 21, 22, 23]), ("F", 1, [20, 21, 24, 25]), ("G", 2, [30, 31, 24, 25])]
    s = spark.createDataFrame(rows, "id string, batch int, sig array<long>")
    ids = lambda df: "".join(sorted(r.id for r in df.collect()))
    assert ids(dedup.cumulative(s, 2, 2)) == "AEF" and ids(dedup.batch_chain(s, 2, 2)) == "ACEF"
    assert ids(dedup.self_dedup(s, 2, 2)) == "ACEG" and ids(dedup.self_dedup(s, 2, 2, within="batch")) == "ABCEG"
    assert ids(dedup.later_batch_wins(s, 2, 2)) == "CEG"  # F went in its own batch, so G takes nothing away
    rng = random.Random(1)
    many = [(f"{i:03d}", i % 3, [rng.randrange(9) for _ in range(6)]) for i in range(120)]
    own = [{(j, *sig[2 * j : 2 * j + 2]) for j in range(3)} for _, _, sig in many]
    kept: list[int] = []
    for i in range(120):
        if not any(own[i] & own[j] for j in kept):
            kept.append(i)
    df = spark.createDataFrame(many, "id string, batch int, sig array<long>")
    assert sorted(int(r.id) for r in dedup.self_dedup(df, 3, 2).collect()) == kept
    chain: list[int] = []
    for b in range(3):
        chain += [i for i in range(b, 120, 3) if not any(own[i] & own[j] for j in chain)]
    assert sorted(int(r.id) for r in dedup.batch_chain(df, 3, 2).collect()) == sorted(chain)


def test_recurring_paragraphs_by_similarity(spark):
    rng = random.Random(2)
    base = "This page uses cookies so that the site can be read by everyone who comes here, as the law says in chapter "
    rows = [(f"{i:02d}", "x", [base + str(i % 3), f"{rng.random()} {rng.random()} {rng.random()}", ""]) for i in range(8)] + [("99", "y", [base + "9"])]
    d = spark.createDataFrame(rows, "id string, domain string, paragraphs array<string>")
    way = (64, 16, 4)
    got = {(r.domain, r.p): r["count"] for r in frequent.collect(d, 0.99, similar=way).collect()}
    assert got == {("x", base + "0"): 8, ("x", ""): 8}
    # brute force: keep-first over all paragraphs of a domain in order, by shared bands
    sig = {r.p: r.sig for r in dedup.signatures(d.select(F.explode("paragraphs").alias("p")).distinct().withColumn("t", F.col("p")), ["p"], "t", 64).collect()}
    bands = {p: {(j, *s[4 * j : 4 * j + 4]) for j in range(16)} if p else {""} for p, s in sig.items()}
    reps, counts = [], {}
    for _, domain, ps in rows:
        seen = set()
        for p in ps:
            rep = next((r for k, r in reps if k == domain and bands[r] & bands[p]), None)
            if rep is None:
                reps.append((domain, rep := p))
            if (domain, rep) not in seen:
                seen.add((domain, rep))
                counts[domain, rep] = counts.get((domain, rep), 0) + 1
    assert got == {k: n for k, n in counts.items() if n >= 2}
    left = {r.id: r.paragraphs for r in frequent.remove(d, frequent.collect(d, 0.99, similar=way), similar=way).collect()}
    assert left["00"] == rows[0][2] and all(len(left[f"{i:02d}"]) == 1 for i in range(1, 8)) and left["99"] == [base + "9"]
    old = spark.createDataFrame([("x", base + "7")], "domain string, p string")
    assert {len(r.paragraphs) for r in frequent.remove(d, frequent.collect(d), old, similar=way).where("domain = 'x'").collect()} == {1, 2}
    seeds = spark.createDataFrame([("x", "gone", 1.0, 3), ("x", "", 2.0, 5)], "domain string, p string, score double, count long")
    assert {r.p: r["count"] for r in frequent.collect(d, 0.5, seeds=seeds).collect()} == {"": 13}


def test_predicates(spark):
    df = spark.createDataFrame([(1.0, 3, 4), (5.0, 1, 9)], "score double, count int, n_docs int")
    assert [r[0] for r in frequent.select(df, "count >= 2 and not score > 2", "max(count, n_docs) == 4 or -count < -100").select("count").collect()] == [3]
    assert frequent.select(df, "2 < score <= 5").count() == 1 and frequent.select(df).count() == 2 and frequent.select(df, "round(score / count, 1) == 0.3").count() == 1
    for bad in ("__import__('os')", "other > 1", "score.real", "[1][0]", "exec('x')"):
        with pytest.raises(ValueError, match="not allowed"):
            frequent.select(df, bad)


def test_download_and_export(spark, tmp_path):
    def record(u, body):
        http = b"HTTP/1.1 200 OK\r\nDate: d\r\nContent-Type: text/html\r\n\r\n" + body
        return gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: %s\r\nContent-Length: %d\r\n\r\n" % (u.encode(), len(http)) + http + b"\r\n\r\n")

    recs = [record(f"http://h/{i}/", b"<html><p>page %d" % i if i % 2 else b"plain & %d" % i) for i in range(6)]
    (tmp_path / "w1").write_bytes(b"".join(recs))
    at, rows = 0, []
    for i, r in enumerate(recs):
        rows.append((f"http://h/{i}/", "w1", at, len(r)))
        at += len(r)
    idx = spark.createDataFrame([*rows, ("http://h/x", "none", 0, 5)], "url string, warc string, offset long, length long")
    got, failed = pages.download(idx, crawl.file_ranges(str(tmp_path)), tasks=1, most_bytes=sum(map(len, recs[:2])))
    assert [r.url for r in failed.collect()] == ["http://h/x"]
    files = pages.write_rotated(got, f"file://{tmp_path}/out").collect()
    assert sorted((r.file.rpartition("/")[2], r.n) for r in files)[0] == ("pages_000_00.warc.gz", 2) and sum(r.n for r in files) == 6
    recs = crawl.read_warcs(spark, f"file://{tmp_path}/out")
    assert tuple(pages.archive_counts(recs).first()) == (6, sum(len(b"<html><p>page 1") if i % 2 else len(b"plain & 0") for i in range(6)))
    assert {r.kind: r.n for r in pages.kind_counts(recs).collect()} == {"html": 3, "txt": 3}
    mapping = pages.write_page_files(pages.page_files(recs, most=1), f"file://{tmp_path}/html").collect()
    assert all((tmp_path / "html" / r.name).read_text().startswith("<html>") for r in mapping) and len(mapping) == len(files)
    assert [r.name for r in pages.pages_of(recs, spark.createDataFrame([("http://h/3/",)], "url string")).collect()] == ["http:__h_3"]
    texts = recs.select("url", F.array(F.col("body").cast("string")).alias("paragraphs"))
    doc = pages.output_documents(idx.join(recs.select("url", "http_header"), "url"), texts, response="http_header").where("id = 'http://h/1/'").first()
    assert doc.meta["date"] == "d" and doc.meta["warc"] == "w1" and doc.http_meta["response"].startswith("HTTP") and doc.paragraphs == ["<html><p>page 1"]
    assert [one(spark, x, mime.normalize_page) for x in ("a<b", "<p>x", "%PDF-1", " ")] == ["<html><body>a&lt;b</body></html>", "<html><body><p>x</body></html>", None, None]


def test_fetching_tries_again(spark):
    from urllib.error import HTTPError, URLError

    answers, slept = [], []

    class Answer:
        def __init__(self, status):
            self.status = status

        def __enter__(self):
            return self

        def __exit__(self, *_):
            return None

        def read(self):
            return b"xy"

    def opener(request):
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        assert request.headers["Range"] == "bytes=5-6"
        return Answer(a)

    fetch = crawl.http_ranges("http://h", retries=2, delay=1.5, opener=opener, sleep=slept.append)
    answers[:] = [200, URLError("down"), 206]
    assert fetch("f", 5, 2) == b"xy" and slept == [1.5, 3.0]
    answers[:] = [HTTPError("u", 404, "", {}, None)]
    assert fetch("f", 5, 2) is None
    answers[:] = [200, 200, 200]
    with pytest.raises(OSError, match="status 200"):
        fetch("f", 5, 2)


def test_numbered_batches(spark, tmp_path):
    sigs = spark.createDataFrame([(f"f{i // 3}", i, [i, i]) for i in range(12)], "file string, id long, sig array<long>")
    batches.write_signatures(sigs, f"{tmp_path}/a", 5)
    assert batches.batch_numbers(spark, f"{tmp_path}/a") == [1, 2] and batches.batch_numbers(spark, f"{tmp_path}/a", 1) == [2]
    batches.renumber_signatures(spark, f"{tmp_path}/a", f"{tmp_path}/b", 1, first=0)
    assert batches.batch_numbers(spark, f"{tmp_path}/b") == [0, 1, 2, 3] and batches.read_signatures(spark, f"{tmp_path}/b", 1).count() == 6
    storage.write_file(spark, f"file://{tmp_path}/s.json", "a\nb")
    assert storage.read_file(spark, f"file://{tmp_path}/s.json") == "a\nb" and storage.read_file(spark, f"file://{tmp_path}/no") is None
    assert storage.file_system(f"file://{tmp_path}/x")[1].endswith("/x")


def test_small_ones(spark):
    xml = "<s><w>A</w><ws> </ws><w>b</w><c>!</c><c>!</c><c>!</c><c>!</c></s><s><w>x&amp;y</w></s>"
    got = one(spark, xml, tokens.xml_sentences)
    assert [(s.raw, s.tokens) for s in got] == [("A b!!!!", ["A", "b", "!", "!", "!"]), ("x&y", ["x&y"])]
    assert one(spark, "# text = a  b", tokens.raw_sentence_tokens) == ["a", "", "b"]

    def fails(t):
        if "!" in t:
            raise ValueError
        return "aa"

    detect = language.with_fallback(fails, lambda t: "bb" if len(t) > 1 else t[9])
    assert [one(spark, t, detect) for t in ("x", "x!", "!", None)] == ["aa", "bb", None, None]
    with pytest.raises(Exception, match="no document at"):
        d = spark.createDataFrame([("f", 1)], "file string, pos int")
        corpus.documents_at(d, spark.createDataFrame([("f", 2)], "file string, pos int")).collect()
    rows = spark.createDataFrame([("u", "b", None), ("u", "a", 3), ("v", "z", None), ("v", "y", None)], "url string, warc string, length int")
    assert {(r.url, r.warc) for r in index.keep_best(rows, tie=("warc",)).collect()} == {("u", "a"), ("v", "y")}
