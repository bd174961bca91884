"""Small cases of the core operators."""

import gzip
import hashlib
import json
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.functions import mime, text, url
from tessera.operators import corpus, dedup, frequent, html, index, logs, sampling, tokens
from tessera.plans import pipeline
from tessera.sources import crawl, documents, tsv


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v"))).first()[0]


def docs(spark, rows):
    return spark.createDataFrame([(i, {}, None, p, d) for i, d, p in rows], "id string, meta map<string,string>, http_meta map<string,string>, paragraphs array<string>, domain string")


def test_text(spark):
    assert one(spark, "", text.paragraphs) == [""]
    r = corpus.counts(docs(spark, [("a", "x", ["ab c", "d"]), ("b", "x", [""])])).first()
    assert tuple(r) == (2, 3, 3, 6)
    assert one(spark, "abcdef", text.shingles) == ["abcde", "bcdef"] and one(spark, "abcd", text.shingles) == []
    assert one(spark, "szó... a!!! !!! x", lambda c: text.clean_tokens(c, ("!!!",))) == "szó... !!! x"
    assert one(spark, " a<b&\n c ", text.escape_xml) == "a&lt;b&amp; c"
    assert one(spark, "", text.is_punctuation) and not one(spark, "a.", text.is_punctuation)
    assert one(spark, "e\u0301", lambda c: text.normalize(c, "NFC")) == "\u00e9"
    with pytest.raises(ValueError):
        corpus.filter_length(docs(spark, []), "5|")


def test_url(spark):
    assert one(spark, "www2.site.hu", url.surt) == "hu,site" == one(spark, "*.site.hu", url.surt)
    assert [one(spark, s, lambda c: url.surt_matches(c, "hu,site")) for s in ("hu,site", "hu,site,x", "hu", "hu,sitex")] == [True, True, False, False]
    assert one(spark, "http://ww2.a.hu/x", url.domain) == "a.hu" and one(spark, "http://www4.a.hu", url.domain) == "www4.a.hu"
    assert one(spark, "a%252520b", url.unquote_all) == "a b" and one(spark, "a+b", url.unquote_all) == "a+b"
    assert one(spark, '"text\\html; charset=x"', mime.normalize_mime) == "text/html"
    assert one(spark, "http://a", url.pure_url) == "a" == one(spark, "a", url.pure_url)


def test_index(spark):
    rows = spark.createDataFrame([("u", "b", 1, 9), ("u", "a", 1, 9), ("u", "c", 1, 5), ("v", "a", 2, 1)], "url string, warc string, offset long, length long")
    assert {(r.url, r.warc) for r in index.keep_best(rows).collect()} == {("u", "a"), ("v", "a")}
    assert {(r.url, r.warc) for r in index.keep_best(rows, "latest", tie=("offset",)).collect()} == {("u", "c"), ("v", "a")}
    ranges = spark.createDataFrame([("f", 0, 10), ("f", 10, 5), ("f", 20, 5)], "file string, offset long, length long")
    assert {tuple(r) for r in index.merge_ranges(ranges).collect()} == {("f", 0, 15, 2), ("f", 20, 5, 1)}
    three = spark.createDataFrame([("f", i * 10, 10) for i in range(3)], "file string, offset long, length long")
    assert {r.n for r in index.merge_ranges(three, 2).collect()} == {1, 2}
    left = spark.createDataFrame([("a%20b", 1), ("c", 2)], "url string, pos int")
    page = spark.createDataFrame([("a b", 7, "p")], "url string, pos int, body string")
    assert [r.body for r in index.join_pages(left, page).collect()] == ["p"]
    with pytest.raises(Exception, match="page without index row"):
        index.join_pages(left, spark.createDataFrame([("z", 7, "p")], "url string, pos int, body string")).collect()
    with pytest.raises(Exception, match="bad status"):
        index.basic_filter(spark.createDataFrame([("u", "x")], "url string, status string")).collect()


def test_repeats_and_greedy(spark):
    d = docs(spark, [("a", "x", ["p", "q", "p"])])
    assert corpus.remove_repeats(d).first().paragraphs == ["p", "q"]
    assert tuple(corpus.repeat_statistics(d, "domain").first()) == ("x", 1, 3, 1, 1, 1)
    chain = spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "a long, b long")
    assert {r.n for r in dedup.greedy(chain).collect()} == {2, 4}
    assert dedup.greedy(chain.where("false")).collect() == []
    assert dedup.optimal_bands(0.9, 256) == (9, 28)


def test_near_duplicate_queries_spare_clean_documents(spark, tmp_path):
    from tessera import queries

    assert (queries.PERMS, queries.BANDS, queries.ROWS) == (256, 9, 28)
    rng = random.Random(1)
    pool = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(400)]
    rows = [(i, " ".join(rng.sample(pool, 100)), "en", "s") for i in range(40)]  # about 0.15 similar to each other
    rows += [(100, rows[0][1], "en", "s"), (101, rows[1][1] + " x", "en", "s"), (102, None, "en", "s")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.id for r in queries.dedup_self_greedy(spark, str(tmp_path)).collect()} == {*range(40), 102}
    assert {(r.a, r.b) for r in queries.lsh_pairs(spark, str(tmp_path)).collect()} == {(0, 100), (1, 101)}


def test_signatures_are_minima_of_all_texts_of_a_key(spark):
    texts = [(1, "abcdefgh"), (1, "abcdexyz"), (2, "abcd"), (3, None), (4, "a\U0001f600b\nc\u00e9d")]
    got = {r.k: r.sig for r in dedup.signatures(spark.createDataFrame(texts, "k int, t string"), ["k"], "t", 30).collect()}
    for k in range(1, 5):
        h = {int(hashlib.md5(t[i : i + 5].encode()).hexdigest()[:7], 16) for j, t in texts if j == k and t for i in range(len(t) - 4)}
        assert got[k] == [min(((a * x + b) % dedup.PRIME for x in h), default=dedup.NO_SHINGLE) for a, b in dedup.coefficients(30)]
    assert {r.k for r in dedup.signatures(spark.createDataFrame(texts, "k int, t string"), ["k"], "t", 30, min_shingles=1).collect()} == {1, 4}


def test_paragraph_pairs_have_short_lines(spark, tmp_path):
    from tessera import queries

    long = "a line of more than forty characters that two documents have in common"
    rows = [(1, "short\nabcd\n\nshort", "en", "s"), (2, f"abcd\nshort\n{long}", "en", "s"), (3, f"\n{long}\nalone here", "en", "s"), (4, None, "en", "s")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.lsh_pairs_other_doc(spark, str(tmp_path)).collect()
    assert sorted((r.a, r.b) for r in got) == [("1_1", "2_2"), ("1_4", "2_2"), ("2_3", "3_2")]
    sigs = spark.createDataFrame([(i, s) for i, s in enumerate([[1, 2, 3, 4], [1, 2, 3, 4], [1, 2, 9, 9], [7, 7, 3, 4], [5, 5, 5, 5], [1, 2, 3, 9]])], "id long, sig array<long>")
    assert sorted((r.a, r.b) for r in dedup.pairs(sigs, 2, 2).collect()) == [(0, 1), (0, 2), (0, 3), (0, 5), (1, 2), (1, 3), (1, 5), (2, 5)]
    assert sorted((r.a, r.b) for r in dedup.pairs(sigs, 2, 2, 0.75).collect()) == [(0, 1), (0, 5), (1, 5), (2, 5)]


def test_frequent_paragraphs(spark):
    def run(n, at, decay):
        got = frequent.collect(docs(spark, [(f"{i:02d}", "x", ["p"] if i in at else [f"o{i}"]) for i in range(1, n + 1)]), decay, min_freq=1).where("p = 'p'").collect()
        return [(round(r.score, 4), r["count"]) for r in got]

    assert run(3, {1, 3}, 0.9) == [(1.81, 2)] and run(4, {1, 4}, 0.5) == [(1.0, 1)]
    d = docs(spark, [(str(i), "x", ["p", f"o{i}"]) for i in range(1, 4)])
    out = frequent.remove(d, frequent.collect(d)).collect()
    assert {r.id: r.paragraphs for r in out} == {"1": ["p", "o1"], "2": ["o2"], "3": ["o3"]}
    assert 1 - frequent.keep_for(1) == 0.75


def test_documents_round_trip(spark, tmp_path):
    d = docs(spark, [("u&1", "x", ["a <b>", "c"]), ("u2", "x", [""])]).withColumn("meta", F.create_map(F.lit("k"), F.lit('v"')))
    for form, read in (("jsonl", documents.read_jsonl), ("tagged", documents.read_tagged)):
        documents.write_documents(d, f"{tmp_path}/{form}", form)
        got = {r.id: (r.meta, r.paragraphs) for r in read(spark, f"{tmp_path}/{form}").collect()}
        assert got == {"u&1": ({"k": 'v"'}, ["a <b>", "c"]), "u2": ({"k": 'v"'}, [""])}
    documents.write_documents(d, f"{tmp_path}/batches", "jsonl", per_file=1)
    assert spark.read.text(f"{tmp_path}/batches").count() == 2
    with pytest.raises(ValueError, match="f:2: "):
        list(documents.parse_tagged("<doc url=\"u\">\nloose", "f"))


def test_crawl(spark, tmp_path):
    good = crawl.to_json_line("hu,a)/", "2020", url="http://a.hu", filename="w", offset="1", length="2")
    lines = spark.createDataFrame([(good,), ("bad",)], "value string")
    rows, rejects = crawl.parse_index(lines)
    assert (rows.first().status, rows.first().mime, rejects.count()) == ("0", "unknown/unknown", 1)
    assert [tuple(r)[:3] for r in crawl.parse_filtered(spark.createDataFrame([("d u w 1 2 200 m",), ("u w 1 2 200 m",)], "value string")).collect()] == [("d", "u", "w"), (None, "u", "w")]
    assert list(crawl.inflate(gzip.compress(b"a\nb\n") + zlib.compress(b"c\n"))) == ["a", "b", "c"]
    block = gzip.compress(f"hu,a)/ 1 {json.dumps({'url': 'x', 'z': 1})}\nhu,ab)/ 1 {{}}\n".encode())
    (tmp_path / "cdx").write_bytes(block)
    clusters = spark.createDataFrame([("hu,a", "/", "cdx", 0, len(block))], "surt string, path string, file string, offset long, length long")
    out = crawl.index_lines(clusters, ["*.a.hu"], crawl.file_ranges(str(tmp_path)), ["url"]).collect()
    assert [r.value for r in out] == ['hu,a)/ 1 {"url":"x"}']
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>x"
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://a\r\nContent-Length: %d\r\n\r\n" % len(http) + http + b"\r\n\r\n"
    (tmp_path / "w.warc.gz").write_bytes(gzip.compress(record) * 2)
    got = crawl.read_warcs(spark, str(tmp_path)).collect()
    assert [(r.pos, r.url, bytes(r.body)) for r in got] == [(0, "http://a", b"<p>x"), (1, "http://a", b"<p>x")]
    assert crawl.new_dumps("March 2020, May 2021", ["2020_03"]) == ["2021_05"]


def test_html_and_feeds(spark):
    page = "<html><nav><a href=x>Home</a></nav><article><h1>Title</h1><p>" + "the cat and the dog of the house " * 12 + "</p></article><script>x</script></html>"
    pages = spark.createDataFrame([(1, page), (2, None), (3, "")], "k long, html string")
    for name in ("density", "tree"):
        (r,) = html.REMOVERS[name](pages, "k").collect()
        assert r.k == 1 and r.paragraphs[-1].startswith("the cat") and "Home" not in r.paragraphs
    atom = "<feed><entry><title>t</title><summary>s</summary><content>c</content></entry><entry><title>x</title></entry></feed>"
    rss = "<rss><channel><title>T</title><description>D</description><item><title>a</title><description>b</description></item></channel></rss>"
    bib = "@article{k, title={A {B}}, abstract = \"Long \\emph{text}\"}\n@book{z, title={No}}"
    rows = spark.createDataFrame([("atom", atom), ("rss", rss), ("bibtex", bib), ("html", "h"), ("rss", "<broken"), ("html", " ")], "kind string, body string")
    assert sorted((r.kind, r.body) for r in html.convert_content(rows).collect()) == [("atom", "t\ns\nc"), ("bibtex", "A B\nLong text"), ("html", "h"), ("rss", "T\nD"), ("rss", "a\nb")]
    assert [one(spark, s, mime.sniff) for s in ("<!DOCTYPE html><p>", "plain", "%PDF-1.4", " ")] == ["html", "txt", None, None]


def test_main_text_in_each_page_s_language(spark):
    said = {"en": "the house of the man and the dog that is in it was", "de": "der Hund und die Katze sind in dem Haus von einer Frau mit", "fr": "le chien et la maison de une femme qui est dans le jardin", "es": "el perro y la casa de una mujer que no es como los otros"}
    page = "<html{}><body><p>{}</p></body></html>"
    rows = [(f"{k}{i}", page.format(a, f"{v} " * 6)) for k, v in said.items() for i, a in enumerate([f' lang="{k}-XX"', "", ' class="x" lang=hu'])]
    got = {r.k: r.paragraphs for r in html.density_text(spark.createDataFrame(rows, "k string, html string"), "k").collect()}
    assert got == {f"{k}{i}": [(f"{v} " * 6).strip()] for k, v in said.items() for i in range(3)}
    assert {r.k[:2] for r in html.density_text(spark.createDataFrame(rows, "k string, html string"), "k", language="en").collect()} == {"en"}


def test_tokens(spark, tmp_path):
    assert tokens.wordpiece("unaffable", frozenset(["un", "##aff", "##able"])) == ["un", "##aff", "##able"]
    assert tokens.wordpiece("zz", frozenset(["z"])) == ["[UNK]"] == tokens.wordpiece("a" * 101, frozenset("a"))
    v = spark.createDataFrame(enumerate(["▁ab", "cd", "▁", "<s>"]), "n long, piece string")
    assert [r.piece for r in tokens.convert_vocabulary(v, tags=["[UNK]"]).orderBy("id").collect()] == ["[UNK]", "ab", "##cd"]
    t = spark.createDataFrame([("d", 1, 1, 1, "#x", "#x y", ["#x"]), ("d", 1, 1, 2, "y", "#x y", ["y", "b", "c", "d"])], "doc_id string, par int, sent int, tok int, form string, text string, fields array<string>")
    assert tokens.fix_rows(t).orderBy("tok").first().fields == ["#x", "[]", "#x", "[/N][Nom]"]
    assert [r.wsafter for r in tokens.add_space_after(t).orderBy("tok").collect()] == [" ", "\\n\\n"]
    (tmp_path / "a.tsv").write_text("form\n# newdoc id = d\n# newpar id = p1\n# text = a b\na\tx\nb\ty\n\nc\tz\n")
    got = tsv.read_tsv(spark, str(tmp_path)).orderBy("sent", "tok").collect()
    assert [(r.doc_id, r.par, r.sent, r.tok, r.fields[0], r.text) for r in got] == [("d", 1, 1, 1, "a", "a b"), ("d", 1, 1, 2, "b", "a b"), ("d", 1, 2, 1, "c", None)]


def test_logs(spark):
    rows = ["1 a - 7 - INFO - start f1", "1 b - 7 - WARNING - odd", "1 c - 7 - INFO - end f1", "1 d - 7 - ERROR - late", "no log line"]
    log = logs.parse(spark.createDataFrame(list(enumerate(rows)), "line_no int, line string")).where("pid is not null")
    m = F.col("message")
    out = logs.messages_by_file(log, F.substring(m, 7, 99), m.startswith("start"), m.startswith("end")).collect()
    assert [tuple(r) for r in out] == [("f1", ["odd"])]


def test_sampling(spark):
    df = spark.range(10).withColumnRenamed("id", "i").repartition(3)
    assert [r.n for r in sampling.numbered(df, ["i"]).orderBy("i").collect()] == list(range(1, 11))
    assert [r["count"] for r in sampling.equal_split(df, 3, ["i"]).groupBy("part").count().orderBy("part").collect()] == [4, 3, 3]
    assert [r.host for r in sampling.weighted_split(df, {"a": 1, "b": 2}, ["i"]).orderBy("i").collect()] == ["a"] * 3 + ["b"] * 7
    sizes = spark.createDataFrame([("x", 5), ("y", 4), ("z", 3)], "domain string, n long")
    assert sampling.pack_groups(sizes, {"h": 1, "k": 1}) == [("x", "h"), ("y", "k"), ("z", "k")]


def test_pipeline_resumes(spark, tmp_path):
    d = docs(spark, [("a", "x", ["long enough " * 60] * 2), ("b", "x", ["short"])])
    p = pipeline.build(pipeline.POST_DOWNLOAD, "post_download", f"file://{tmp_path}")
    assert [(r.id, len(r.paragraphs)) for r in p.run(d).collect()] == [("a", 1)] and p.status == pipeline.COMPLETED
    again = pipeline.build(pipeline.POST_DOWNLOAD, "post_download", f"file://{tmp_path}")
    assert again.status == pipeline.COMPLETED and again.run(d).count() == 1
    changed = pipeline.build(pipeline.POST_DOWNLOAD, "post_download", f"file://{tmp_path}", least="1c")
    assert [s.status for s in changed.steps] == ["completed", "spawned", "spawned", "spawned"]


def test_streaming(spark, tmp_path):
    from tessera.streaming.incremental import IncrementalDedup, stream_frequent

    base = "some text that is long enough to have many shingles in it, and more of it "
    for i, rows in enumerate([[("a", base), ("b", "another text altogether, which has other words")], [("c", base), ("d", "third words here that nobody wrote before")]]):
        spark.createDataFrame(rows, "id string, text string").write.parquet(f"{tmp_path}/in/{i}")
    dd = IncrementalDedup(spark, f"{tmp_path}/out", perms=24, bands=6, rows=4)
    for i in range(2):
        dd.process(spark.read.parquet(f"{tmp_path}/in/{i}"), i)
    assert {r.id for r in dd.kept().collect()} == {"a", "b", "d"}
    spark.createDataFrame([("x", str(i), ["p"]) for i in range(3)], "domain string, id string, paragraphs array<string>").write.parquet(f"{tmp_path}/st")
    q = stream_frequent(spark.readStream.schema("domain string, id string, paragraphs array<string>").parquet(f"{tmp_path}/st"), 0.9).writeStream.format("memory").queryName("fr").outputMode("update").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(60)
    (r,) = spark.sql("select * from fr").collect()
    assert r["count"] == 3 and r.score == pytest.approx(1 + 0.9 + 0.81)
