import pytest
from pyspark.sql import functions as F

from corpusloom.config import PipelineConfig
from corpusloom.functions import documents as D
from corpusloom.functions import errors, html, text, urls, vectors
from corpusloom.operators import retrieval, stats

CONFIG = PipelineConfig()
O = CONFIG.origin


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


@pytest.mark.parametrize(
    ("url", "out"),
    [
        (f"{O}/documentation/LumenKit/View?language=objc#topics", f"{O}/documentation/LumenKit/View"),
        (f"{O}/documentation/a//", f"{O}/documentation/a"),
        ("HTTPS://User:pw@Host.Example:80/Path/", "https://host.example/Path"),
        ("not a url", "not a url"),
        (None, None),
    ],
)
def test_normalize(spark, url, out):
    assert one(spark, urls.normalize_url(F.col("x")), url) == out


@pytest.mark.parametrize(
    ("url", "reason"),
    [
        (f"{O}/documentation/a/documentation/b", "documentation_twice"),
        (f"{O}/documentation/documentation/x", None),
        (f"{O}/x" + "y" * (200 - len(O) - 2), None),
        (f"{O}/x" + "y" * (201 - len(O) - 2), "too_long"),
        ("https://a/https://b", "scheme_twice"),
        ("x-https:/a", "broken_scheme"),
        ("a%ef%bb%bf", "byte_order_mark"),
        ("a﻿", "byte_order_mark"),
        (None, None),
    ],
)
def test_malformed(spark, url, reason):
    assert one(spark, urls.malformed_reason(F.col("x"), CONFIG), url) == reason


def test_document_urls(spark):
    raw = '{"references":{"a":{"url":"/documentation/A/?q"},"b":{"url":"https://example.com/x"},"c":{"url":"/videos/play/x"},"d":{"url":""},"e":{},"f":null,"g":{"url":"/documentation/A"},"h":{"url":"/design/hig/"}}}'
    assert one(spark, urls.document_urls(urls.reference_urls(F.col("x")), CONFIG), raw) == [f"{O}/documentation/A", f"{O}/design/hig"]
    for bad in (None, "", "{", '{"references":[]}', "[]"):
        assert one(spark, urls.document_urls(urls.reference_urls(F.col("x")), CONFIG), bad) == []


def test_api_urls(spark):
    get = lambda u: one(spark, urls.api_url(F.col("x"), CONFIG), u)
    assert get(f"{O}/documentation/lumenkit/") == f"{CONFIG.api_default}/documentation/lumenkit.json"
    assert get(f"{O}/documentation/docc/x") == f"{CONFIG.api_alternate}/documentation/docc/x.json"
    assert get(CONFIG.alternate_page) == f"{CONFIG.api_alternate}/docc/formatting-your-content.json"
    assert get("nothing") == "Invalid URL: nothing"


def test_transcripts(spark):
    page = '<meta property="og:title" content="T &amp; U"><section id="transcript-content"><span data-start="1.0"> Hello </span><i data-start="2.5"></i><b data-start="3" class="s">world</b></section><section>'
    assert one(spark, html.page_title(F.col("x")), page) == "T &amp; U"
    assert one(spark, html.transcript(F.col("x")), page) == "Hello world"
    assert one(spark, html.transcript_error(F.col("x")), page) is None
    assert one(spark, html.transcript_error(F.col("x")), "<p>") == "NO_TRANSCRIPT"
    assert one(spark, html.transcript_error(F.col("x")), '<section id="transcript-content"> </section>') == "EMPTY_TRANSCRIPT"
    links = '<a href="/videos/play/a/1/"><a href="/videos/play/a/1"><a href="/videos/play/b?x=1"><a href="/other">'
    assert one(spark, html.discover_links(F.col("x"), "/videos/play/", O), links) == [f"{O}/videos/play/a/1", f"{O}/videos/play/b?x=1"]


def test_errors(spark):
    status = lambda s: one(spark, errors.status_error(F.col("x"), F.lit("r"), F.lit("u")), s, "int")
    assert [status(s) for s in (200, 204, 404, 500, None)] == [None, None, "PERMANENT_ERROR:404:u", "HTTP 500: r", "r"]
    assert one(spark, errors.permanent_code(F.col("x")), "a PERMANENT_ERROR:410:u") == "410"
    assert one(spark, errors.permanent_code(F.col("x")), "PERMANENT_ERROR:NO:u") == "unknown"
    assert one(spark, errors.permanent_code(F.col("x"))) == "unknown"


@pytest.mark.parametrize(
    ("raw", "error"),
    [
        ("[]", "Invalid response: not an object"),
        (None, "Invalid response: not an object"),
        ("{}", "PERMANENT_ERROR:NO_PRIMARY_CONTENT:Missing primaryContentSections field"),
        ('{"primaryContentSections":[]}', "Invalid response: missing metadata field"),
        ('{"primaryContentSections":[],"metadata":{}}', "PERMANENT_ERROR:NO_SUBSTANTIAL_CONTENT:Empty sections"),
        ('{"primaryContentSections":{},"metadata":{}}', "PERMANENT_ERROR:NO_SUBSTANTIAL_CONTENT:Empty sections"),
        ('{"primaryContentSections":[{"kind":"mentions"}],"metadata":{}}', "PERMANENT_ERROR:NO_SUBSTANTIAL_CONTENT:Only contains mentions or link lists"),
        ('{"primaryContentSections":[{"type":"content","content":[{"type":"links"}]}],"metadata":{}}', "PERMANENT_ERROR:NO_SUBSTANTIAL_CONTENT:Only contains mentions or link lists"),
        ('{"primaryContentSections":[{"kind":"content","content":[]}],"metadata":{}}', "PERMANENT_ERROR:NO_SUBSTANTIAL_CONTENT:Only contains mentions or link lists"),
        ('{"primaryContentSections":[{"kind":"content"}],"metadata":{}}', None),
        ('{"primaryContentSections":[{"kind":"declarations"}],"metadata":{}}', None),
    ],
)
def test_validation(spark, raw, error):
    assert one(spark, D.validate_document(D.parse(F.col("x"))), raw) == error


@pytest.mark.parametrize(("part", "whole", "out"), [(1, 3, "33.3%"), (2, 3, "66.6%"), (12, 100, "12%"), (0, 5, "0%"), (1, 0, "0%")])
def test_percentage(spark, part, whole, out):
    assert one(spark, text.percentage(F.lit(part), F.lit(whole))) == out


def test_truncation(spark):
    assert len(one(spark, text.truncate_message(F.col("x")), "a" * 4000)) == 4000
    long = one(spark, text.truncate_message(F.col("x")), "a" * 4001)
    assert len(long) == 4005 and long[:3180] == "a" * 3180 and long[-796:] == "a" * 796


def test_trim_and_text(spark):
    assert one(spark, text.full_trim(F.col("x")), "\t  x y　﻿\n") == "x y"
    assert one(spark, text.unify_line_ends(F.col("x")), "a b c") == "a\nb\nc"
    assert one(spark, text.embedding_text(F.lit("T"), F.col("x")), "c") == "T\n\nc"
    assert one(spark, text.embedding_text(F.lit(""), F.col("x")), "c") == "c"


def test_vectors(spark):
    v = lambda c, x: one(spark, c(F.col("x")), x, "array<double>")
    assert v(vectors.l2_normalize, [3.0, 4.0]) == pytest.approx([0.6, 0.8])
    assert v(vectors.l2_normalize, [0.0, 0.0]) == [0.0, 0.0]
    assert v(vectors.vector_literal, None) == "[]"
    usable = lambda x: v(lambda c: vectors.usable(c, 2), x)
    assert [usable(x) for x in ([1.0, 2.0], [0.0, 0.0], [1.0], [], None, [float("nan"), 1.0], [None, 1.0])] == [True, False, False, False, False, False, False]


def test_search(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0], "Big Layer", "of cake"), ("b", [1.0, 0.1], None, "layer"), ("c", [0.0, 0.0], "x", "y")], "id string, embedding array<double>, title string, content string")
    assert [r.id for r in retrieval.cosine_top_k(df, [1.0, 0.05], 5).collect()] in (["a", "b"], ["b", "a"])
    assert [r.id for r in df.where(retrieval.matches_all("CAKE layer", F.col("title"), F.col("content"))).collect()] == ["a"]
    assert df.where(retrieval.matches_all(" ", F.col("title"))).count() == 0


def test_report():
    values = {"docs_total": 3, "docs_percentage": "33.3%", "videos_total": 1, "videos_percentage": "0%", "total_chunks": 9, "avg_collect_count": 1.5, "min_collect_count": 0, "max_collect_count": 4}
    message = stats.report_text(values, 125.9, 7, CONFIG)
    assert "2m 5s | 📊 7 chunks" in message and "Avg collect: 1.5" in message and "30×30=900 URLs | Force: N" in message


def test_config():
    got = PipelineConfig.from_env({"BATCH_SIZE": "5", "BATCH_COUNT": "", "FORCE_UPDATE_ALL": "true"})
    assert (got.batch_size, got.batch_count, got.force_update_all) == (5, 30, True)


def test_containment_in_json(spark):
    from corpusloom.operators.retrieval import json_contains

    rows = [(1, '{"a":{"b":1,"c":[{"d":"x","e":null},{"d":"y"}]},"t":true}'), (2, '{"a":[1]}'), (3, "{"), (4, None), (5, '{"a":{"b":"1"}}')]
    df = spark.createDataFrame(rows, "id int, j string")
    holds = lambda pattern: [r.id for r in df.where(json_contains(F.col("j"), pattern)).orderBy("id").collect()]
    assert holds({}) == [1, 2, 5]
    assert holds({"a": {"b": 1}}) == [1] and holds({"a": {"b": "1"}}) == [5] and holds({"a": [1]}) == [2]
    assert holds({"a": {"c": [{"d": "y"}]}}) == [1] and holds({"a": {"c": [{"d": "y", "e": None}]}}) == []
    assert holds({"a": {"c": [{"e": None}, {"d": "y"}]}}) == [1] and holds({"t": True}) == [1] and holds({"t": 1}) == []
    assert holds([]) == []


def test_tokens_of_any_script(spark):
    from corpusloom.operators.retrieval import matches_all

    df = spark.createDataFrame([("Über-Größe 5", "naïve"), (None, "uber"), (None, None)], "t string, c string")
    assert [df.where(matches_all(q, F.col("t"), F.col("c"))).count() for q in ("ÜBER", "größe naïve", "uber", "gr", "")] == [1, 1, 1, 0, 0]


def test_nearest_of_many_queries(spark, monkeypatch):
    import numpy as np

    from corpusloom.operators import retrieval

    rng = np.random.default_rng(2)
    x = rng.integers(-2, 3, (80, 4))
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(900, None), (901, [1.0]), (902, [float("nan")] * 4)]
    df = spark.createDataFrame(rows, "id long, embedding array<float>").repartition(3)
    good = [i for i in range(80) if x[i].any()]
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    want = {(q, j) for q in good if q % 7 == 0 for j in sorted(good, key=lambda j: (-round(float(unit[q] @ unit[j]), 12), j))[:3]}
    for block in (20_000, 4):
        monkeypatch.setattr(retrieval, "QUERY_BLOCK", block)
        assert {(r.query, r.id) for r in retrieval.top_k_of_queries(df.where("id % 7 = 0"), df, 3, 4).collect()} == want
    assert retrieval.top_k_of_queries(df.where("false"), df, 3, 4).count() == 0


def test_remote_embedder_bounds_its_requests(monkeypatch):
    import io
    import json

    from corpusloom.sources import providers

    sizes = []

    class Answer(io.BytesIO):
        def __enter__(self):
            return self

    def answer(request, timeout):
        texts = json.loads(request.data)["input"]
        sizes.append(len(texts))
        return Answer(json.dumps({"data": [{"embedding": [1.0, len(t)]} for t in texts]}).encode())

    monkeypatch.setattr(providers.urllib.request, "urlopen", answer)
    made = providers.RemoteEmbedder("http://x.example", "k", 2, batch=3)
    assert made.encode(["a" * i for i in range(8)])[:, 1].tolist() == list(range(8)) and sizes == [3, 3, 2]
    assert made.encode([]).shape == (0, 2)
    monkeypatch.setattr(providers.urllib.request, "urlopen", lambda request, timeout: Answer(b'{"data": []}'))
    with pytest.raises(ValueError):
        made.encode(["a"])
