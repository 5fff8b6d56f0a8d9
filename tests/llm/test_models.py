"""Language identification, toxicity, main text."""

from caseloom.llm import html_text, langid, toxicity
from tests.conftest import SF

BIG = SF.replace("sf0.001", "sf0.01")


def test_language_of_held_out_documents(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang").collect()}
    got = langid.op10(spark, BIG).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(langs) and 0.2 < len(held) / len(got) < 0.3
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) / len(held) > 0.98 and all(0 <= r.score <= 1 for r in got)


def test_labels_of_held_out_documents_are_not_seen(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fake = docs.withColumn("lang", langid.F.when(langid.held_out(), "zz").otherwise(langid.F.col("lang")))
    assert "zz" not in {lang for g in langid.learn(fake).langs for lang in g}


def test_predictions_against_a_plain_version(spark):
    """Grams counted one by one, margins added up one by one, for all documents."""
    import math
    from collections import Counter

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.learn(docs)
    got = {r.doc_id: r for r in langid.op10(spark, SF).collect()}
    u32 = lambda x: x & 0xFFFFFFFF
    for r in docs.limit(60).collect():
        if not langid.has_letter(r.text):
            assert got[r.doc_id].lang_pred == "und" and got[r.doc_id].score == 0
            continue
        letters = [c if c.isalpha() else " " for c in f" {r.text.lower()} "]
        chars = [ord(c) for i, c in enumerate(letters) if i == 0 or c != " " or letters[i - 1] != " "]
        grams = Counter()
        for i, c in enumerate(chars):
            one = u32(c * 2654435761)
            hashes = [one]
            if i + 1 < len(chars):
                two = u32(u32((one ^ one >> 15) * 2246822519) + chars[i + 1] * 3266489917)
                hashes.append(two)
                if i + 2 < len(chars):
                    hashes.append(u32(u32((two ^ two >> 13) * 668265263) + chars[i + 2] * 374761393))
            grams.update((h ^ h >> 16) >> 4 & langid.DIM - 1 for h in hashes)
        size = sum(grams.values())
        x = {k: math.sqrt(n / size) for k, n in grams.items()}
        margin = lambda w, b: sum(float(w[k]) * v for k, v in x.items()) + float(b)
        families = [margin(w, b) for w, b in zip(model.family_w, model.family_b)]
        f = families.index(max(families))
        votes = [[0, 0.0] for _ in model.langs[f]]
        for k, (g, i, j) in enumerate(model.pairs):
            if g == f:
                m = margin(model.pair_w[k], model.pair_b[k])
                votes[i if m >= 0 else j][0] += 1
                votes[i][1] += m
                votes[j][1] -= m
        assert got[r.doc_id].lang_pred == model.langs[f][max(range(len(votes)), key=lambda i: tuple(votes[i]))]


def test_language_edges(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double"
    rows = [(1, None, "en", "s", 1, 0.0), (None, "", None, "s", 1, 0.0), (3, "123 !?", "en", "s", 1, 0.0), (4, "the and of " * 30_000, "en", "s", 1, 0.0), (5, "the and", "en", "s", 1, 0.0), (6, "der die das und", "de", "s", 1, 0.0), (6, "der die das und", "de", "s", 1, 0.0), (7, "der und die", "de", "s", 1, 0.0)]
    docs = spark.createDataFrame(rows, schema)
    got = langid.predicted(docs).select("doc_id", "__lang.*").collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and [r.score for r in got[:3]] == [0.0] * 3
    kept = langid.identified(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 6, 7]
    own = docs.withColumns({"__lang": langid.F.lit("mine"), "user6___lang": langid.F.lit("too")})
    assert {(r["__lang"], r["user6___lang"]) for r in langid.identified(own).collect()} == {("mine", "too")} and langid.identified(own).columns == own.columns
    nothing = langid.predicted(docs.withColumn("lang", langid.F.lit(None).cast("string"))).select("__lang.lang_pred").distinct().collect()
    assert [r.lang_pred for r in nothing] == ["und"]
    assert langid.predicted(docs.limit(0)).count() == 0


def test_toxicity_of_labelled_documents(spark):
    got = {r.doc_id: r for r in toxicity.op4(spark, BIG).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{BIG}/labels.parquet").collect() if r.toxic is not None}
    flagged = [i for i in labels if got[i].toxic]
    assert sum(labels[i] for i in flagged) / len(flagged) > 0.95
    assert sum(got[i].toxic for i in labels if labels[i]) / sum(labels.values()) > 0.6


def test_toxicity_generalises(spark):
    docs, labels = spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")
    model = toxicity.learn(docs, labels.where("doc_id % 3 <> 0"))
    test = {r.doc_id: r.toxic for r in labels.where("doc_id % 3 = 0").collect()}
    got = {r.doc_id: r.toxicity.toxic for r in toxicity.with_toxicity(docs.where("doc_id % 3 = 0"), model).collect()}
    flagged = [i for i in test if got[i]]
    assert flagged and sum(test[i] for i in flagged) / len(flagged) > 0.9


def test_toxicity_in_each_language(spark):
    large = SF.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{large}/documents.parquet"), spark.read.parquet(f"{large}/labels.parquet")
    model = toxicity.learn(docs, labels.where("doc_id % 3 <> 0"))
    got = toxicity.with_toxicity(docs, model).join(labels.where("doc_id % 3 = 0 AND toxic IS NOT NULL").withColumnRenamed("toxic", "label"), "doc_id").select("lang", "label", "toxicity.toxic").collect()
    assert sum(r.label for r in got if r.toxic) / sum(r.toxic for r in got) > 0.9
    assert sum(r.toxic for r in got if r.label) / sum(r.label for r in got) > 0.9
    for lang in {r.lang for r in got}:
        assert sum(r.toxic for r in got if r.label and r.lang == lang) / sum(r.label for r in got if r.lang == lang) > 0.8, lang


def test_chain_categories_and_their_use(spark):
    """Categories are of labelled documents; in the last model the earlier probabilities, not the text's features alone, carry the evidence."""
    y = toxicity.kinds_of(toxicity.np.array([0, 0, 1, 1, 1, 1]), toxicity.np.array([0, 4, 0, 1, 3, 4]), toxicity.np.array([0, 2, 0, 0, 1, 0]))
    assert [list(map(int, y[c])) for c in toxicity.CHAIN] == [[0, 0, 0, 0, 1, 0], [0, 0, 0, 1, 0, 1], [0, 0, 0, 0, 1, 1], [0, 0, 1, 1, 1, 1]]
    model = toxicity.learn(spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet"))
    assert [len(w) for w in model.weights] == [model.width + k + 1 for k in range(len(toxicity.CHAIN))]
    assert abs(model.weights[-1][model.width : -1]).max() > 1


def test_toxicity_against_a_plain_version(spark):
    import math

    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    model = toxicity.learn(docs, spark.read.parquet(f"{BIG}/labels.parquet"))
    got = {r.doc_id: r.toxicity for r in toxicity.with_toxicity(docs, model).collect()}
    for r in docs.limit(150).collect():
        words = [w for w in "".join(c if c.isalpha() else " " for c in (r.text or "").lower()).split()]
        share = {}
        for w in words:
            parts = {w} | {w[:n] + "-" for n in range(4, 8) if n < len(w)} | {"-" + w[-n:] for n in range(4, 8) if n < len(w)}
            for u in parts & set(model.vocabulary):
                share[u] = share.get(u, 0) + 1
        done = []
        for weights in model.weights:
            z = weights[-1] + sum(weights[model.vocabulary[u]] * math.log1p(100.0 * n / len(words)) for u, n in share.items()) + sum(weights[model.width + k] * p for k, p in enumerate(done))
            done.append(1 / (1 + math.exp(-z)))
        assert all(abs(got[r.doc_id][f"p_{c}"] - p) < 1e-9 for c, p in zip(toxicity.CHAIN, done))
        assert got[r.doc_id].toxic == (done[-1] >= model.threshold)


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, 1), (None, "", 2), (2, "a bad word " * 20_000, 3)], "doc_id long, text string, toxicity int")
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    got = toxicity.with_toxicity(docs, model)
    assert got.columns == docs.columns and not model.weights and [r.toxicity.toxic for r in got.collect()] == [False] * 3
    assert toxicity.with_toxicity(docs.limit(0), model).count() == 0 and not toxicity.learn(docs.limit(0), labels.limit(0)).weights
    # An id that many rows have is one labelled document, however many.
    again = spark.createDataFrame([(1, f"some text {i % 2}", 0) for i in range(50)] + [(2, "b", 0)], docs.schema)
    once = toxicity._labelled(again, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"), 10).collect()
    assert sorted((r.text, r.toxic) for r in once) == [("b", 0), ("some text 0", 1)]


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><p>Slogan here, welcome to our site.</p></header><nav><a href=1>Home</a></nav>
<div class="cookie-notice"><p>We use cookies, to improve your experience. Accept all of them, please.</p></div><main><article><header><h1>Headline</h1></header><p>First paragraph with <b>bo</b>ld text, and commas; more text follows here.</p><p>Short.
<ul><li>One item<li>Two</ul><div class="ad">Buy now! Best prices, only today, do not miss it.</div><p>Second long paragraph, with &lt;tags&gt; &amp; more&nbsp;things to read in it.<br>Next<script>var x = "</p>";</script>
<section class="comments"><p>Great article, thanks a lot for it!</p></section></article></main><aside><p>Related stories, you may like these.</p></aside><form><p>Subscribe, it is free.</p></form><!-- <p>no</p> --><footer>(c) 2024</footer></body></html>"""
TEXT = "Headline First paragraph with bold text, and commas; more text follows here. Short. One item Two Second long paragraph, with <tags> & more things to read in it. Next"


def test_main_text():
    assert html_text.main_text(PAGE) == TEXT
    plain = PAGE.replace("<main><article><header>", "<div id='content'><div>").replace("</header><p>First", "<p>First").replace("</article></main>", "</div></div>")
    assert html_text.main_text(plain) == TEXT


def test_main_text_of_pages(spark):
    import html
    import re

    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?(?:b|i|em|a|span)\b[^>]*>", "", article))).split())
        assert html_text.main_text(r.html) == want


def test_main_text_without_container():
    long = "This paragraph is long enough to be chosen, and it has commas, as running text does; it goes on for a while."
    body = f"<h1>A <a href=h>headline</a></h1><p>{long}</p><p>See the <a href=x><b>report</b></a> for more, it says.</p><div>A note.</div><ul><li>Read <a href=y>this</a> too</ul><p>{long}</p><blockquote><a href=z>Quoted source</a></blockquote>"
    page = f"<html><body><ul><li><a href=1>Home</a></li><li><a href=2>About</a></li></ul>{body}<div><a href=3>Imprint</a> <a href=4>Contact</a></div></body></html>"
    assert html_text.main_text(page) == f"A headline {long} See the report for more, it says. A note. Read this too {long} Quoted source"


def test_names_of_what_is_not_the_article():
    for name in ("comment-body", "post-comments", "sidebar-content", "related-post", "ad-text", "newsletter-body", "commentBody", "main-header", "article share", "entry-related", "page-footer-text"):
        for tag in ("div", "section", "p"):
            inside = PAGE.replace("<ul><li>One", f'<{tag} class="{name}">Not this, surely; it is not part of it.</{tag}><ul><li>One')
            assert html_text.main_text(inside) == TEXT, (tag, name)
    for name in ("article-header", "content has-sidebar", "no-comments", "text main", "storyBody"):
        assert html_text.main_text(PAGE.replace("<article><header>", f"<article><header class='{name}'>")) == TEXT, name
    assert html_text.main_text(PAGE.replace("<ul><li>One", "<script src=x />alert('no, not this');</script><ul><li>One")) == TEXT


def test_ratios_decide_where_no_name_tells():
    """The page's furniture is in plain elements: short, without punctuation, or made of links."""
    links = "".join(f"<div><a href={i}>Topic {i}</a></div>" for i in range(30))
    furniture = "".join(f"<div><span>Tag {i}</span></div>" for i in range(20))
    long = "This is a paragraph of the story, which goes on for a while; it has commas, stops and so on, as text does."
    page = f"<html><body><table><tr><td>{links}</td><td><div><div><h2>The headline</h2>{f'<p>{long}</p>' * 8}</div></div></td><td>{furniture}</td></tr></table><div>Copyright</div></body></html>"
    assert html_text.main_text(page) == " ".join(["The headline", *[long] * 8])
    # Furniture that reads as the story does is told by nothing but its path's ratio to the others'.
    alike = page.replace("<p>", "<div>").replace("</p>", "</div>")
    assert html_text.main_text(alike) == " ".join(["The headline", *[long] * 8])


def test_main_text_of_deep_pages():
    for deep in (300, 20_000):
        nested = "<div>" * deep + PAGE[PAGE.index("<body>") + 6 : PAGE.index("</body>")] + "</div>" * deep
        assert html_text.main_text(f"<html><body>{nested}<footer>(c) 2024</footer></body></html>") == TEXT
        inline = PAGE.replace("First paragraph", "<i>" * deep + "First paragraph")
        assert html_text.main_text(inline) == TEXT
    both = "<div>" * 300 + "<article><p>Before it, text.</p><div class=ad><div><div>Buy now!</div></div>Really, do.</div><p>After it, text.</p></article>" + "</div>" * 300
    assert html_text.main_text(both) == "Before it, text. After it, text."


def test_main_text_after_unclosed_elements():
    for tag in ("<select><option>A<option>B", "<svg><path d=x><text>A</text>", "<math><mi>x", "<canvas>", "<object data=x>", "<datalist><option>A"):
        inside, before = PAGE.replace("<ul><li>One", f"{tag}<ul><li>One"), PAGE.replace("<main>", f"{tag}<main>")
        assert html_text.main_text(inside) == TEXT and html_text.main_text(before) == TEXT, tag
        again = before.replace("<p>Second", "<canvas>no</canvas><object>no</object><svg></svg><select></select><p>Second")
        assert html_text.main_text(again) == TEXT, tag
        ended = PAGE.replace("<ul><li>One", f"<div>{tag}hidden</div><ul><li>One")
        assert html_text.main_text(ended) == (TEXT if tag[1] not in "co" else TEXT.replace("One", "hidden One")), tag
    for whole in ("<select><option>A</select>", "<svg><title>t</title><foreignObject><div>no</div></foreignObject></svg>", "<object><p>no</p></object>", "<canvas><p>no</p></canvas>", "<object><object>no</object><ul><li>no</ul></object>", "<svg viewBox='0'/>"):
        assert html_text.main_text(PAGE.replace("<ul><li>One", f"{whole}<ul><li>One")) == TEXT, whole


def test_main_text_edges(spark):
    assert [html_text.main_text(x) for x in (None, "", "   ", "<br>", "plain text", "<p>a", "< 5 & <b>6</b>", "<p class='x>open")] == ["", "", "", "", "plain text", "a", "< 5 & 6", "open"]
    for bad in ("<" * 200_000, "<!--" * 50_000, "<a x='" * 50_000, "<p>" * 100_000, "<b>" * 100_000, "<script>" * 50_000, "&" * 100_000):
        html_text.main_text(bad)
    pages = spark.createDataFrame([(1, "u", None, "t", 5), (1, "u", "<p>x", "t", 5), (1, "u", "<p>x", "t", 5)], "page_id long, url string, html string, text string, main_text int")
    got = html_text.with_main_text(pages)
    assert [(r.main_text, r.text) for r in got.collect()] == [("", "t"), ("x", "t"), ("x", "t")] and got.columns == pages.columns
    assert html_text.with_main_text(pages.limit(0)).count() == 0
