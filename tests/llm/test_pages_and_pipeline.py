"""URL filter, HTML text and the pipeline."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from twinshelf.llm import html_text, queries, urls

RULES = queries.URL_RULES


def test_rules_and_parts(spark):
    cases = [  # url, host, path, rule, verdict by rule
        ("https://A.Example.com/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
        ("http://www.example.com/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("http://b.www.example.com/en/", "b.www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://example.com/EN/", "example.com", "/EN/", "com/", "allow"),
        ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("http://x.net/es/1#top", "x.net", "/es/1", "net/es/", "block"),
        ("http://x.net/es", "x.net", "/es", None, None),
        ("http://x.com", "x.com", "", None, None),
        ("http://x.com?a=/b", "x.com", "", None, None),
        ("x.com/en/", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None),
        ("a://b://c/d", "b:", "//c/d", None, None),
    ]
    pages = spark.createDataFrame([(i, c[0], "clash") for i, c in enumerate(cases)],
                                  "page_id long, url string, _ratio string")
    got = {r["page_id"]: r for r in urls.judge(pages, RULES).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == verdict if rule else got[i]["verdict"] in ("allow", "block")
        assert (got[i]["margin"] is None) == (rule is not None)
    assert urls.judge(pages.limit(0), RULES).count() == 0
    free = urls.judge(pages, []).collect()
    assert {r["verdict"] for r in free} == {"allow"}  # nothing is known to be rejected


def plain_verdicts(rows):
    """(host, path, rule, verdict, margin) of each URL, by counts of all pieces of the labelled URLs."""
    def symbols(url):  # a character for each byte behind the scheme
        return (url or "").split("://", 1)[-1].encode().decode("latin-1") + "\n"

    marked = []
    for url in rows:
        _, sign, rest = (url or "").partition("://")
        rest = rest if sign else ""
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:end].lower(), rest[end:].split("?")[0].split("#")[0]
        fits = [(len(text), text, kind) for kind, text in queries.URL_RULES
                if f".{host}".endswith("." + text.split("/", 1)[0]) and path.startswith("/" + text.split("/", 1)[1])]
        marked.append((host, path, *(max(fits)[1:] if fits else (None, None))))
    classes = []
    for kind in ("allow", "block"):
        texts = sorted(symbols(u) for u in {u for u, m in zip(rows, marked) if m[3] == kind})
        pieces = Counter(t[a:a + n] for i, t in enumerate(texts) if i % urls.HELD
                         for n in range(1, urls.ORDER + 2) for a in range(len(t) - n + 1))
        after = defaultdict(list)
        for piece, count in pieces.items():
            after[piece[:-1]].append(count)
        classes.append((texts[::urls.HELD], pieces, after))

    def rate(text, pieces, after):
        total = 0.0
        for at, symbol in enumerate(text):
            p = 1 / urls.ALPHABET
            for start in range(at, max(-1, at - urls.ORDER - 1), -1):
                counts = after.get(text[start:at], [])
                if counts:
                    p = (pieces[text[start:at] + symbol] + len(counts) * p) / (sum(counts) + len(counts))
            total += math.log(p)
        return total / len(text)

    def ratio(text):
        return rate(text, *classes[0][1:]) - rate(text, *classes[1][1:])

    good, bad = ([ratio(t) for t in held] for held, _, _ in classes)
    scores = sorted(good + bad)
    cuts = scores[:1] + [(a + b) / 2 for a, b in zip(scores, scores[1:])]
    right = [sum(x >= c for x in good) / len(good) + sum(x < c for x in bad) / len(bad) for c in cuts]
    cut = next(c for c, r in zip(cuts, right) if r >= max(right) - 1e-12)
    for url, (host, path, rule, verdict) in zip(rows, marked):
        above = None if rule else ratio(symbols(url)) - cut
        yield host, path, rule, verdict or ("allow" if above >= 0 else "block"), above


def test_url_query_equals_plain_models(spark):
    got = queries.op1_url_filter(spark, "/root/testdata/sf0.1").orderBy("page_id").collect()
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").orderBy("page_id").select("url").collect()
    assert len(got) == len(pages)
    for row, expected in zip(got, plain_verdicts([r["url"] for r in pages])):
        assert (row["host"], row["path"], row["rule"], row["verdict"]) == expected[:4]
        assert row["margin"] == pytest.approx(expected[4], abs=1e-9)


def test_markov_probabilities_sum_to_one():
    model = urls.MarkovModel([b"abab", b"abcd", b"bbbb"], order=3)
    for context in (b"", b"a", b"ab", b"zz"):
        line, total = context, 0.0
        for symbol in range(256):
            text = line + bytes([symbol])
            p = 1 / 256
            for size in range(min(3, len(line)) + 1):
                seen = model.after.get(line[len(line) - size:])
                if seen is None:
                    break
                p = (seen.get(symbol, 0) + len(seen) * p) / (model.total[line[len(line) - size:]] + len(seen))
            total += p
            assert text
        assert total == pytest.approx(1.0)
    assert model.rate(b"ab") == pytest.approx(model.rate(b"ab")) and model.rate(b"") < 0


def test_ratio_tells_the_classes_apart():
    good = [f"http://news{i}.org/story/{i}" for i in range(200)]
    bad = [f"http://x{i}.org/casino-bonus?win={i}" for i in range(200)]
    model = urls.RatioFilter(good[:150], bad[:150])
    assert sum(model.allows(u)[1] for u in good[150:]) >= 48
    assert sum(model.allows(u)[1] for u in bad[150:]) <= 2
    assert math.isfinite(model.cut)


ARTICLE = [f"Sentence number {i} of a long enough paragraph, with commas and words." * 3 for i in range(4)]
PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var a="</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy now</div>
{open}<h1>Title &amp; more</h1><p>{0}</p><p><b>{1}<br>x</b><p>Short.</p><div class="ad">Buy</div>
<aside>Related</aside><p>{2}</p><form><input><button>Send</button></form><p>{3}</p>{close}
<section id="comments"><p>{0} I disagree.</p></section><footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize("tags", [("<article>", "</article>"), ("<main>", "</main>"),
                                  ('<div id="content">', "</div>"), ("", "")])
def test_main_text_of_a_page(tags):
    page = PAGE.format(*ARTICLE, open=tags[0], close=tags[1])
    expected = ["Title & more", ARTICLE[0], ARTICLE[1] + " x", "Short.", ARTICLE[2], ARTICLE[3]]
    assert html_text.main_text(page) == "\n\n".join(expected)


@pytest.mark.parametrize("body, kept", [
    # Two articles side by side.
    ("<article><p>{0}</p><p>{1}</p><p>{2}</p></article><article><p>{3}</p><p>{0}</p></article>", "012 30"),
    # A lead before the article, wrapped or bare.
    ("<div><p>{0}</p></div><article><p>{1}</p><p>{2}</p><p>{3}</p></article>", "0123"),
    ("<p>{0}</p><article><p>{1}</p><p>{2}</p><p>{3}</p></article><div><p>{0} By the author.</p></div>", "0123"),
    # Names that a topic gives; parts with such names go.
    ('<article><p>{0}</p><section id="discussion"><h2 class="section-header">H</h2><p id="social-impact">{1}</p>'
     '</section><p>{2}</p><div class="social"><a href="a">x</a> <a href="b">y</a></div>'
     '<div class="discussion"><p>{3}</p></div><p class="advert">{3}</p></article>', "0H12"),
    # A page in one form; a form beside the text.
    ('<form action="p.aspx"><nav>Menu</nav><div><h1>H</h1><p>{0}</p><p>{1}</p><p>{2}</p></div>'
     "<footer>f</footer></form>", "H012"),
    ("<div><p>{0}</p><p>{1}</p><p>{2}</p><form><p>{3}</p></form></div>", "012"),
    # No wrapper: a list and a short block between paragraphs.
    ("<p>{0}</p><ul><li>H</li></ul><div>I</div><p>{1}</p><p>{2}</p><footer>f</footer>", "0HI12"),
    # A second part that holds little.
    ("<div><div><p>{0}</p><p>{1}</p><p>{2}</p><p>{3}</p><p>{0}</p><p>{1}</p></div><div><p>{2}</p></div></div>",
     "0123012"),
])
def test_all_parts_of_an_article_stay(body, kept):
    page = f"<html><head><title>t</title></head><body>{body.format(*ARTICLE)}</body></html>"
    expected = [ARTICLE[int(k)] if k.isdigit() else k for k in kept if k != " "]
    assert html_text.main_text(page) == "\n\n".join(expected)


def test_odd_pages(spark):
    pages = [None, "", "   ", "plain text only", "<p>one", "<nav>menu</nav>", "<p>a</p>" * 2000,
             "<" * 1000, "<![foo[ x ]]><p>y</p>", "<div>" * 3000 + "deep", "<p>&lt;&#233;&nbsp;x</p>", "<!--"]
    docs = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    got = [r[0] for r in docs.select(html_text.extract("html")).collect()]
    assert got[:6] == ["", "", "", "plain text only", "one", ""]
    assert got[6] == "\n\n".join(["a"] * 2000) and got[9] == "deep" and got[10] == "<é x"
    assert docs.limit(0).select(html_text.extract("html")).count() == 0


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of a small table, with planted cases."""
    source, path = "/root/testdata/sf0.01", str(tmp_path_factory.mktemp("sf"))
    docs = spark.read.parquet(f"{source}/documents.parquet").filter("doc_id < 250")
    bench = spark.read.parquet(f"{source}/benchmark.parquet")
    first = docs.filter("doc_id = 10").first()
    passage = max((r["text"] for r in bench.collect()), key=len)
    extra = [
        (9001, None, "en", "s", None), (9002, "", "en", "s", 0), (9003, "12 - 34", "en", "s", 7),
        (9004, first["text"], "en", "s", first["n_chars"]), (9005, passage, "en", "s", len(passage)),
        (9006, first["text"] + " and", "en", "s", first["n_chars"] + 4),
    ]
    docs.unionByName(spark.createDataFrame(extra, docs.schema)).write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return path


def test_pipeline_stages(spark, folder):
    import corpus_pipeline as pipeline

    from .test_search_and_links import plain_components, plain_fingerprint, plain_hits

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in pipeline.STAGES] == [
        "language", "toxicity", "near_duplicates", "decontamination", "sentencepiece"]
    kept, frames = docs, []
    for _, apply in pipeline.STAGES:
        kept = pipeline.stage(apply(spark, kept, folder), "test")
        frames.append(kept)
    for frame in frames[:4]:
        assert frame.columns == docs.columns
    ids = [{r[0] for r in f.select("doc_id").collect()} for f in frames]
    everything = {r[0] for r in docs.select("doc_id").collect()}
    assert everything - ids[0] == {9001, 9002, 9003}  # no letters
    before = {r["doc_id"]: r["text"] for r in frames[1].collect()}
    order = sorted(before)
    comps = plain_components([plain_fingerprint(before[i]) for i in order], 3)
    assert ids[2] == {order[c] for c in comps} and 9004 not in ids[2]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    after = {r["doc_id"]: r for r in frames[3].collect()}
    for i in sorted(ids[2]):
        n, hit, _ = plain_hits(before[i], items)
        if not hit:
            assert after[i]["text"] == before[i]
        elif len(hit) >= 0.5 * n:
            assert i not in after
        else:
            assert not plain_hits(after[i]["text"], items)[1]
            assert after[i]["n_chars"] == len(after[i]["text"])
    assert 9005 not in after
    assert {r["doc_id"] for r in frames[4].collect()} == set(after)
    assert frames[4].filter(~F.col("lossless")).count() == 0


def test_pipeline_of_nothing(spark, folder, tmp_path):
    import corpus_pipeline as pipeline

    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


LONG = "A long enough sentence of the article, with commas, that stands for its main text. " * 3


@pytest.mark.parametrize("page", [
    "<html><head><title>x</title><body><article><p>{0}</p></article><footer>f</footer></body></html>",
    "<head><title>x</title><meta charset=utf-8><script>var a</script><p>{0}<p>{0}</p>",
    "<head><title>x</title><div><h1>{0}</h1></div>",
    "<html><head><title>x<body><article><p>{0}</p></article>",
    "<head></head><body><article><p>{0}</p><label>Mail<p>{0}</p></article>",
    "<body><article><div><button>Save</div><div>{0}</div></article>",
    "<body><article><select><option>a<option>b<h2>Head</h2><p>{0}</p></article>",
])
def test_main_text_behind_hidden_elements_left_open(page):
    got = html_text.main_text(page.format(LONG))
    assert got.count(LONG.strip()) == page.count("{0}")
    assert "Save" not in got and "x" != got.split()[0]


def test_whole_hidden_elements_stay_hidden():
    page = (f"<head><title>t</title></head><body><article><p>{LONG}</p><button><div>Save</div> it</button>"
            f"<dialog><p>Asked</p><div>more</div></dialog><svg><title>Icon</title></svg><p>{LONG}</p></article>")
    assert html_text.main_text(page) == "\n\n".join([LONG.strip()] * 2)
