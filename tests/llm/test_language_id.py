import math
import random
import re
import time
from collections import defaultdict

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from weatherlake.llm import language_id, queries

PAGES = "page_id LONG, url STRING, html STRING"


@pytest.fixture(scope="module")
def text_model(spark):
    return language_id.fit_text_model(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


@pytest.fixture(scope="module")
def texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars > 800").select("lang", "text").collect()
    return {lang: [r.text for r in docs if r.lang == lang] for lang in ("en", "de", "fr", "es")}


def page(text, lang=None):
    return f"<html{f' lang={lang!r}' if lang else ''}><body><p>{text}</p></body></html>"


def found(spark, rows, text_model):
    pages = spark.createDataFrame(rows, PAGES)
    return {r.page_id: r for r in language_id.identify(pages, text_model).collect()}


def test_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars > 200")
    own = language_id.fit_text_model(docs.where("doc_id % 5 <> 0"))
    held = docs.where("doc_id % 5 = 0").select("lang", "text").collect()
    right = sum(own.languages[own.log_likelihoods(r.text).argmax()] == r.lang for r in held)
    assert right >= 0.97 * len(held)


def test_pages(spark):
    rows = queries.op6_language_id(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.01/pages.parquet").count()
    assert sum(r.lang == r.declared for r in rows) >= 0.97 * len(rows)
    assert all(0 < r.probability <= 1 for r in rows)


def test_a_page_without_text_follows_its_host(spark, text_model, texts):
    rows = [(i, "http://www.blog.de/x", page(t)) for i, t in enumerate(texts["de"][:20])]
    rows += [(100 + i, "http://news.org/x", page(t)) for i, t in enumerate(texts["fr"][:20])]
    rows += [(200, "http://www.blog.de/empty", page("")), (201, "http://news.org/empty", page("")), (202, "http://other.blog.de/", page(""))]
    got = found(spark, rows, text_model)
    assert (got[200].lang, got[201].lang, got[202].lang) == ("de", "fr", "de")
    assert got[200].probability < got[0].probability


def test_a_declaration_counts_for_what_it_is_worth(spark, text_model, texts):
    rows = [(i, None, page(t, "de")) for i, t in enumerate(texts["de"][:30])]
    rows += [(100 + i, None, page(t, "fr")) for i, t in enumerate(texts["fr"][:30])]
    rows += [(200, None, page("", "de")), (201, None, page("", "fr")), (202, None, page(texts["es"][0], "de"))]
    got = found(spark, rows, text_model)
    assert (got[200].lang, got[201].lang) == ("de", "fr")
    assert got[202].lang == "es"


def test_suffix(spark, text_model, texts):
    rows = [(i, f"http://h{i}.es/", page(t)) for i, t in enumerate(texts["es"][:20])]
    rows += [(100 + i, f"http://g{i}.fr/", page(t)) for i, t in enumerate(texts["fr"][:20])]
    rows += [(200, "http://new.es/", page("")), (201, "http://new.fr/", page(""))]
    got = found(spark, rows, text_model)
    assert (got[200].lang, got[201].lang) == ("es", "fr")


def test_edge_rows(spark, text_model):
    rows = [(1, None, None), (None, "http://[bad", "<p"), (2, "", ""), (2, "", ""), (3, "http://HOST.Example.COM:80/x", cases.LONG), (4, "ftp://x", "<html lang=xx><script>no"), (5, "mailto:a", "<!-- <p>a")]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' AS host", "'y' AS shares", "'z' AS lang")
    got = language_id.identify(pages, text_model).collect()
    assert len(got) == len(rows) and all(r.lang in text_model.languages for r in got)
    by = {r.page_id: r for r in got}
    assert by[3].host == "host.example.com" and by[3].suffix == "com" and by[4].declared == "xx" and by[1].host is None


def test_empty_tables(spark, text_model):
    assert language_id.identify(spark.createDataFrame([], PAGES), text_model).count() == 0
    none = language_id.fit_text_model(cases.empty(spark))
    assert none.languages == []
    assert [r.lang for r in language_id.identify(spark.createDataFrame([(1, "http://a.b", "x")], PAGES), none).collect()] == [None]


RARE = "Pohjoisen pitkät yöt ja lyhyet päivät tekevät talvesta hiljaisen, mutta keväällä järvien jää sulaa ja linnut palaavat. "


def test_a_rare_language_is_kept(spark):
    docs = cases.documents(spark).where("lang is not null").select("lang", F.substring("text", 1, 400).alias("text"))
    many = docs.crossJoin(spark.range(50)).select("lang", "text")
    n = many.count() // 2000
    assert n
    rare = spark.createDataFrame([("fi", f"{RARE} {i}") for i in range(n)], "lang STRING, text STRING")
    own = language_id.fit_text_model(many.unionByName(rare))
    assert own.languages == ["de", "en", "es", "fi", "fr"]
    got = found(spark, [(1, "http://a.fi/", page("Keväällä linnut palaavat ja järvien jää sulaa.", "fi"))], own)
    assert (got[1].lang, got[1].text_lang) == ("fi", "fi")


def test_more_labels_than_the_model_holds_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 4)
    docs = cases.documents(spark).select("lang", "text")
    assert len(language_id.fit_text_model(docs).languages) == 4
    with pytest.raises(ValueError, match="more than 4"):
        language_id.fit_text_model(docs.unionByName(spark.createDataFrame([("fi", RARE)], docs.schema)))


def test_visible_text():
    source = '<html><head><style>p{}</style></head><nav>menu</nav><p>A&amp;B <b>c</b></p><script>var t="</p>";</script><!-- x --></html>'
    assert language_id.visible_text(source).split() == ["A&B", "c"]
    assert language_id.declared_language('<meta http-equiv="content-language" content="de-AT">') == "de"


HOSTILE = ["<!--", "<nav ", "<html ", "<meta content-language ", "<", "<div class='ad", "<script>", "</nav ", "<html lang=", "lang= ", "<meta content-language content= ", "&#9", "&#0", "9", " "]


@pytest.mark.parametrize("piece", HOSTILE)
@pytest.mark.parametrize("head", ["", "<html ", "<meta content-language content=", "&#", "<nav>"])
def test_long_hostile_pages_are_read_in_linear_time(piece, head):
    source = head + piece * ((1 << 20) // len(piece))
    start = time.perf_counter()
    language_id.visible_text(source)
    language_id.declared_language(source)
    assert time.perf_counter() - start < 2


DROPPED = re.compile(r"(?is)<!--.*?-->|<(script|style|nav|header|footer|aside|template|noscript)\b.*?</\1\s*>|<div class=.?ad\b.*?</div>")
DECLARED = re.compile(r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b")
META = re.compile(r"(?is)<meta\b[^>]*?content-language[^>]*?content\s*=\s*[\"']?\s*([a-z]{2,3})\b")


def test_reading_equals_plain_patterns():
    rng = random.Random(1)
    pieces = ["<!--", "-->", "<nav>", "</NAV >", "<script", "</script>", "<div class='ad'>", "</div>", "<p>", "<", ">", "a b", " ", "<html ", " lang='de'", "lang = EN-us", "<META ", "content-language", " content=\"fr\"", "<b", "\n"]
    for _ in range(20_000):
        source = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert language_id.without_hidden(source) == DROPPED.sub(" ", source), source
        assert language_id.without_tags(source) == re.sub(r"(?s)<[^>]*>", " ", source), source
        found = DECLARED.search(source) or META.search(source)
        assert language_id.declared_language(source) == (found[1].lower() if found else None), source


def test_numbers_of_characters():
    assert language_id.visible_text("&#65;&#000066;&#" + "0" * 9000 + "67; &#x44; &#99999999999; &#" + "9" * 9000 + ";") == "ABC D \ufffd \ufffd"


def test_domains():
    names = ["www.a.co.uk", "b.co.uk", "co.uk", "x.y.org", "shop.com", "a.b.com.au", "one", "a.b.de"]
    want = ["a.co.uk", "b.co.uk", "co.uk", "y.org", "shop.com", "b.com.au", "one", "b.de"]
    assert [language_id.address(f"https://{name}/x")[1] for name in names] == want


def test_fused_chances_equal_plain_arithmetic(spark, text_model, texts):
    """The same sums and products page by page, with dictionaries."""
    rng = random.Random(4)
    rows = []
    for i in range(120):
        lang = rng.choice(["en", "de", "fr", "es"])
        text = rng.choice(texts[lang])[: rng.choice([0, 15, 40, 3000])]
        url = rng.choice([None, f"http://h{rng.randint(0, 9)}.site{rng.randint(0, 2)}.{rng.choice(['de', 'fr', 'com'])}/x", "http://a.b.co.uk/"])
        rows.append((i, url, page(text, rng.choice([None, lang, "xx"]))))
    got = found(spark, rows, text_model)
    size = len(text_model.languages)
    pages = []
    for key, url, source in rows:
        likely = [float(x) for x in text_model.log_likelihoods(language_id.visible_text(source).strip())]
        chances = [math.exp(x) for x in likely]
        shares = [x / sum(chances) for x in chances]
        pages.append((key, *language_id.address(url), language_id.declared_language(source), likely, shares))
    sums = defaultdict(lambda: [0.0] * size)
    for _, host, domain, suffix, declared, _, shares in pages:
        for name, value in (("host", host), ("domain", domain), ("suffix", suffix), ("declared", declared), ("all", "")):
            if value is not None:
                sums[name, value] = [a + b for a, b in zip(sums[name, value], shares)]
    every = sums["all", ""]
    for key, host, domain, suffix, declared, likely, shares in pages:
        level = [(x + 1) / (sum(every) + size) for x in every]
        for name, value, strength in (("domain", domain, language_id.DOMAIN_STRENGTH), ("host", host, language_id.HOST_STRENGTH)):
            if value is not None:
                others = [max(a - b, 0) for a, b in zip(sums[name, value], shares)]
                level = [(o + strength * x) / (sum(others) + strength) for o, x in zip(others, level)]
        total = [math.log(x) + y for x, y in zip(level, likely)]
        for name, value in (("declared", declared), ("suffix", suffix)):
            if value is not None:
                others = [max(a - b, 0) for a, b in zip(sums[name, value], shares)]
                share = sum(others) / max(1.0, sum(every))
                strength = language_id.TABLE_STRENGTH
                total = [
                    t + math.log((o + strength * (share + 1e-9)) / (max(e - own, 0) + strength))
                    for t, o, e, own in zip(total, others, every, shares)
                ]
        chances = np.exp(np.array(total) - max(total))
        chances /= chances.sum()
        assert got[key].probability == pytest.approx(chances.max(), abs=1e-6)
        assert chances[text_model.languages.index(got[key].lang)] == pytest.approx(chances.max(), abs=1e-6)
