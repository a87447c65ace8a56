"""Operators 3 (language ID), 5 (HTML extraction) and 6 (licence scans)."""

import html
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL
from tidemark.llm import html_extract, language_id, license_scan
from tidemark.session import cut_lineage


def brute_kneser_ney(texts):
    """P(gram) by the textbook recursion over dictionaries."""
    n = language_id.ORDER
    counts = [Counter() for _ in range(n + 1)]
    for t in texts:
        s = "".join(chr(c) for c in language_id.symbols_of(t))
        counts[n].update(s[i:i + n] for i in range(len(s) - n + 1))
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    alphabet = len(counts[1]) + 1
    totals, kinds, discounts = {}, {}, {}
    for k in range(1, n + 1):
        totals[k], kinds[k] = Counter(), Counter()
        for g, c in counts[k].items():
            totals[k][g[:-1]] += c
            kinds[k][g[:-1]] += 1
        one, two = (sum(c == x for c in counts[k].values()) for x in (1, 2))
        discounts[k] = min(max(one / (one + 2 * two) if one and two else 0.5, 0.05), 0.95)

    def p(g):
        k = len(g)
        if not k:
            return 1 / alphabet
        if not totals[k][g[:-1]]:
            return p(g[1:])
        d = discounts[k]
        return (max(counts[k][g] - d, 0) + d * kinds[k][g[:-1]] * p(g[1:])) / totals[k][g[:-1]]

    return p


def test_language_id_equals_brute_force_and_holds_out(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = docs.collect()
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows}
    training = defaultdict(list)
    for r in rows:
        if r["lang"] is not None and r["text"] is not None and not held[r["doc_id"]]:
            training[r["lang"]].append(r["text"])
    models = {lang: brute_kneser_ney(t) for lang, t in training.items()}
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    for r in rows[:25]:
        symbols = "".join(chr(c) for c in language_id.symbols_of(r["text"]))
        grams = [symbols[i:i + 4] for i in range(len(symbols) - 3)]
        entropy = {lang: -sum(math.log(p(g)) for g in grams) / len(grams) for lang, p in models.items()}
        best = min(sorted(entropy), key=entropy.get)
        assert got[r["doc_id"]]["lang_pred"] == best
        assert abs(got[r["doc_id"]]["cross_entropy"] - entropy[best]) < 1e-9
    assert all(got[d]["held_out"] == h for d, h in held.items())
    without_labels = language_id.identify(docs, language_id.fit(docs)).collect()  # lang and source are no inputs
    assert Counter(map(str, without_labels)) == Counter(map(str, got.values()))


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    found = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 200
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.97
    assert sum(r["rejected"] for r in found) <= 2
    assert all(0 <= r["score"] <= 1 for r in found)
    assert language_id.drop_unknown(docs).count() >= docs.count() - 5


def test_language_id_is_calibrated_on_all_training_rows(spark):
    """Means, excess and temperature come from every training row, judged by the model of the other half."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("half")
    rows = docs.where((language_id.remainder(F.col("doc_id")) != 2) & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang", half).collect()
    names = sorted({r["lang"] for r in rows})
    own, sizes, truth, entropies = [], [], [], []
    for h in (0, 1):
        codes = {name: [language_id.grams_of(language_id.symbols_of(r["text"])) for r in rows if r["lang"] == name and r["half"] != h] for name in names}
        models = language_id.Models({name: np.unique(np.concatenate(c), return_counts=True) for name, c in codes.items()})
        mine = [r for r in rows if r["half"] == h]
        size, entropy = models.entropies([r["text"] for r in mine])
        sizes.append(size), entropies.append(entropy), truth.append([names.index(r["lang"]) for r in mine])
    sizes, truth, entropy = np.concatenate(sizes), np.concatenate(truth), np.concatenate(entropies)
    own = entropy[np.arange(len(truth)), truth]
    means = np.bincount(truth, own * sizes) / np.bincount(truth, sizes)
    excess = ((own - means[truth]) * np.sqrt(np.minimum(sizes, language_id.STEADY))).max()
    fit = [np.log(np.exp(-t * (entropy - own[:, None])).sum(axis=1)).mean() for t in language_id.TEMPERATURES]
    got = language_id.fit(docs)
    assert got.names == names and np.allclose(got.mean, means) and np.isclose(got.excess, max(excess, 1.0))
    assert got.temperature == language_id.TEMPERATURES[int(np.argmin(fit))]


def test_language_models_beyond_the_broadcast_size(spark, monkeypatch, odd_docs):
    """Models kept as tables give what broadcast ones give, and a rare language keeps its n-grams."""
    rare = [(10 ** 6 + i, "ħobż tajjeb għall-familja kollha fil-għodwa", "mt") for i in range(8)]
    odd = odd_docs.where("length(text) < 9000 OR doc_id IS NOT NULL").select("doc_id", F.left("text", F.lit(900)).alias("text"), "lang")
    small = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").limit(30).select("doc_id", "text", "lang")
    docs = cut_lineage(small.withColumn("doc_id", F.col("doc_id") + 1000).unionByName(odd).unionByName(spark.createDataFrame(rare, small.schema)))
    want = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    kept = Counter(r["doc_id"] for r in language_id.drop_unknown(docs).collect())
    monkeypatch.setattr(language_id, "MAX_GRAMS", 300)
    models = language_id.fit(docs)
    assert isinstance(models, language_id.Spread)
    got = language_id.identify(docs, models).collect()
    assert len(got) == docs.count()
    for r in got:
        w = want[r["doc_id"]]
        assert (r["lang_pred"], r["held_out"], r["rejected"]) == (w["lang_pred"], w["held_out"], w["rejected"])
        assert abs(r["score"] - w["score"]) < 1e-9
        assert r["cross_entropy"] is w["cross_entropy"] is None or abs(r["cross_entropy"] - w["cross_entropy"]) < 1e-9
    assert all(want[10 ** 6 + i]["lang_pred"] == "mt" for i in range(8))
    monkeypatch.setattr(language_id, "fit", lambda *_: models)
    found = language_id.drop_unknown(docs)
    assert found.columns == docs.columns and Counter(r["doc_id"] for r in found.collect()) == kept


def test_long_texts_are_scored_in_slices(monkeypatch):
    texts = ["the cat sat on the mat and the dog lay by the door " * 9, "", None, "le chat est sur la table", "12 34", "a b"]
    codes = [language_id.grams_of(language_id.symbols_of(texts[i])) for i in (0, 3)]
    models = language_id.Models({"en": np.unique(codes[0], return_counts=True), "fr": np.unique(codes[1], return_counts=True)})
    whole = models.entropies(texts)
    monkeypatch.setattr(language_id, "SCORE_AT", 37)
    sliced = models.entropies(texts)
    assert whole[0].tolist() == sliced[0].tolist() and np.allclose(whole[1], sliced[1])
    assert models.decide(texts)[0].tolist() == [0, -1, -1, 1, -1, models.decide(["a b"])[0][0]]


def test_language_id_rejects_noise(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", "lang")
    noise = spark.createDataFrame([(10 ** 6 + i, " ".join(["xqzvkj wwxqj zzqkx kjxqv"] * 20), None) for i in range(3)], docs.schema)
    got = language_id.identify(docs.unionByName(noise)).where("doc_id >= 1000000").collect()
    assert len(got) == 3 and all(r["rejected"] for r in got)


def test_language_id_odd_rows(spark, odd_docs, no_docs):
    got = language_id.identify(odd_docs).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        if r["doc_id"] in (4, 5, 6, 10):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in ("en", "fr")
    kept = language_id.drop_unknown(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {4, 5, 6, 10}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert language_id.identify(no_docs).count() == language_id.drop_unknown(no_docs).count() == 0
    unlabelled = odd_docs.withColumn("lang", odd_docs["lang"].substr(1, 0).cast("int").cast("string"))
    assert {r["lang_pred"] for r in language_id.identify(unlabelled).collect()} == {"und"}


PROSE = "Long sentences, with commas and stops, make the paragraphs of an article stand out. They go on for a while, as prose does."
PAGE = f"""<!DOCTYPE html><html><head><title>Head title</title><style>p{{margin:0}}</style><script>var a = "</p><p>not text</p>";</script></head>
<body class="page has-sidebar"><header><h1>Site name</h1></header><nav><ul><li><a href=/a>Home</a></li><li><a href="/b>c">News &amp; more</a></li></ul></nav>
<div class="cookie-notice">We use cookies, as you know, and ask you to agree to them.</div><!-- <p>comment</p> -->
<div id=wrap><article><h1>The&nbsp;heading &lt;1&gt;</h1><p>{PROSE}<p><b>Bold start</b>,{PROSE}<br>after a break</p>
<form><label>Mail</label><input name=m><button>Send</button></form><div class="advert">Buy this, buy that, buy all of it now.</div>
<blockquote>{PROSE}</blockquote><ul><li>First item, short</li><li>Second item</li></ul><p>Short end.</p>
<section class="comments"><p>{PROSE} A reader wrote this.</p></section></article>
<aside><p>{PROSE} Sidebar.</p></aside></div><footer><p>Copyright, imprint, contact.</p></footer></body></html>"""


def test_html_main_text():
    want = (f"The heading <1> {PROSE} Bold start,{PROSE} after a break {PROSE} First item, short Second item Short end.")
    assert html_extract.main_text(PAGE) == want


def test_html_without_semantic_tags():
    links = "".join(f'<div><a href="/{i}">Link number {i}</a></div>' for i in range(20))
    page = (f'<html><body><div id="x1">{links}</div><div id="x2"><h2>Title here</h2><p>{PROSE}</p><p>{PROSE}</p><p>So.</p></div>'
            f'<div id="x3"><a href="/i">Imprint</a></div></body></html>')
    assert html_extract.main_text(page) == f"Title here {PROSE} {PROSE} So."


def test_html_article_is_read_whole():
    """Text outside the element that holds most of the article is its own, too."""
    menu = "<div>" + "".join(f'<div><a href="/{i}">Link number {i}</a></div>' for i in range(20)) + "</div>"
    foot = '<div><a href="/i">Imprint</a></div>'
    paragraph = f"<p>{PROSE}</p>"
    long = " ".join([PROSE] * 8)
    parts = [(f"<h1>Title</h1><div class=body>{paragraph * 2}</div>", f"Title {PROSE} {PROSE}"),
             (f"<h1>Title</h1><section>{paragraph * 9}</section><section><h2>More</h2>{paragraph * 2}<p>End.</p></section>",
              f"Title {' '.join([PROSE] * 9)} More {PROSE} {PROSE} End."),
             (f"<h1>Title</h1>{paragraph}<blockquote><p>{long}</p><p>{long}</p></blockquote>{paragraph}", f"Title {PROSE} {long} {long} {PROSE}"),
             (f"<h1>Title</h1>{paragraph}<ul>{f'<li>{long}</li>' * 5}</ul>{paragraph}", f"Title {PROSE} {' '.join([long] * 5)} {PROSE}"),
             (f"<h1>Title</h1>{paragraph}<table>{f'<tr><td>{long}</td><td>{long}</td></tr>' * 3}</table>{paragraph}",
              f"Title {PROSE} {' '.join([long] * 6)} {PROSE}")]
    for inner, want in parts:
        for tag in ("article", "main", "div"):
            assert html_extract.main_text(f"<html><body>{menu}<{tag}>{inner}</{tag}>{foot}</body></html>") == want


def test_html_names_and_links_of_an_article():
    """Names that only resemble boilerplate, linked headings and lists of links below a heading are the article's own."""
    long = " ".join([PROSE] * 3)
    rest = f"<p>{PROSE}</p><p>{PROSE}</p>"
    parts = [("<h1><a href=x>The linked title</a></h1>", "The linked title"),
             (f"<section class=related-work><h2>Related work</h2><p>{PROSE}</p></section>", f"Related work {PROSE}"),
             (f"<div class=ad-free-edition><p>{PROSE}</p></div>", PROSE), (f"<p class=notice>{long}</p>", long),
             (f"<p><a href=x>{PROSE}</a></p>", PROSE), ("<div class='ad box'>Buy this, and that.</div>", ""), ("<div id=google-ads><p>Buy this.</p></div>", ""),
             (f"<div class=comments-list><p>{PROSE}</p><p>{PROSE}</p></div>", ""),
             ("<ul><li><a href=1>Share</a></li><li><a href=2>Send</a></li></ul>", ""), ("<div><a href=1>Home</a> <a href=2>News</a></div>", "")]
    for inner, want in parts:
        for tag in ("article", "main"):
            got = html_extract.main_text(f"<body><nav><a href=/>x</a></nav><{tag}><p>{PROSE}</p>{inner}{rest}</{tag}></body>")
            assert got == " ".join(x for x in (PROSE, want, PROSE, PROSE) if x), inner
    links = "<h2>References</h2><ol><li><a href=1>First paper</a></li><li><a href=2>Second paper</a></li></ol>"
    assert html_extract.main_text(f"<article>{rest}{links}</article>") == f"{PROSE} {PROSE} References First paper Second paper"


def test_html_time_and_memory_of_broken_pages():
    import time
    import tracemalloc
    n = 200_000
    pages = ["<a " * n, "<a '" * n, '<a b="' * n + ">", "<a '>" * n, "<![CDATA[>" * n, "<!" * n, "</x>" * n, "<div>" * n + "x", "<div>x" * (n // 4),
             "<b>" * n + "</i>" * n, "<p><b>" * (n // 4) + "x", "<!-- " * n, "<li><b>x" * (n // 8), "<script " * n, "<a href=x>y" * (n // 8)]
    for page in pages:
        start = time.perf_counter()
        html_extract.main_text(page)
        assert time.perf_counter() - start < 10, page[:30]
    tracemalloc.start()
    html_extract.main_text("<div class=abcdef>" * 30_000 + "x")
    assert tracemalloc.get_traced_memory()[1] < 100e6


def test_html_ratios_against_a_plain_version(spark):
    """Scores of all nodes from whole path strings and sums over all nodes."""
    def path_of(element):
        return "" if element is None else path_of(element.parent) + "/" + (element.tag + "#" + str(label[element.number]))

    pages = [r["html"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()[:30]] + [PAGE, f"<p>{PROSE}</p>", "<div><p>a.</p>b<p>c, d</p></div>" * 5]
    for page in pages:
        nodes, elements = html_extract.text_nodes(page)
        nodes = [n for n in nodes if n[1].strip()]
        if not nodes:
            continue
        label, seen = {}, {}
        for e in elements:  # siblings of one tag and class share a path number below their parent's
            label[e.number] = seen.setdefault((e.parent.path if e.parent else None, e.tag, e.path), len(seen))
        groups = defaultdict(list)
        for e, text, _, link in nodes:
            groups[path_of(e)].append((text, link))
        raw = []
        for e, *_ in nodes:
            g = groups[path_of(e)]
            chars = sum(len(t.strip()) for t, _ in g)
            raw.append((chars / len(g), sum(ch in ".,;:!?…。、，！？；：" for t, _ in g for ch in t) / len(g),
                        1 - sum(len(t.strip()) for t, link in g if link) / chars))
        want = []
        for i, (_, _, plain) in enumerate(raw):
            near = [(math.exp(-(i - j) ** 2 / (2 * html_extract.SMOOTH ** 2)), x) for j, x in enumerate(raw) if abs(i - j) <= 3 or len(raw) < 7]
            size, marks = (sum(w * x[k] for w, x in near) / sum(w for w, _ in near) for k in (0, 1))
            want.append(size * (1 + marks) * plain * nodes[i][0].weight)
        assert np.allclose(html_extract.content_score(nodes), want)


def test_html_odd_pages(spark):
    pages = [None, "", "   ", "plain text only", "<p>unclosed <b>bold", "<div", "<script>never closed", "a < b & c &amp; d &#8364;",
             "<p>" + "word " * 200_000 + "</p>", "<a href='" * 2000, "</p></div>", "<p>x</p>" * 3]
    rows = [(i, "u" if i % 2 else None, h, 1, "n") for i, h in enumerate(pages)] + [(None, None, "<p>x</p>", None, None)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string")).collect()
    text = {r["page_id"]: r["text"] for r in got}
    assert all(r["n_chars"] == len(r["text"]) for r in got) and len(got) == len(rows)
    assert [text[i] for i in range(8)] == ["", "", "", "plain text only", "unclosed bold", "<div", "", "a < b & c & d €"]
    assert len(text[8]) == 5 * 200_000 - 1 and text[11] == "x x x" and text[None] == "x"
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.extract(empty).count() == 0


def test_html_pages_table(spark):
    """Title and paragraphs of the article, nothing of menu, advert and footer."""
    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", body.group(1))).split()) if body else ""
        got = html_extract.main_text(r["html"])
        assert got.replace(" ", "") == want.replace(" ", ""), r["page_id"]


def test_licences(spark, odd_docs, no_docs):
    lines = {1: "Licensed under the Apache License, Version 2.0.", 2: "prose\nReleased under the MIT License.\nmore prose",
             3: "This work is licensed under the GNU General Public License, version 3.", 4: "Licensed under CC BY-NC 4.0.",
             5: "The bar lost its liquor license because of noise.", 6: "nothing here", 7: None, 8: "",
             9: "Released under the MIT License.\nLicensed under CC BY 4.0.", 10: "SPDX-License-Identifier: GPL-3.0-or-later",
             11: "He asked for permission and got it without delay."}
    docs = spark.createDataFrame(list(lines.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.document_licences(docs).collect()}
    want = {1: "apache", 2: "mit", 3: "gpl", 4: "cc-by-nc", 9: "cc-by,mit", 10: "gpl"}
    assert {d: r["licences"] for d, r in got.items()} == {d: want.get(d, "") for d in lines}
    assert got[5]["n_unknown_lines"] == 1 and got[6]["n_unknown_lines"] == 0 and got[9]["n_licence_lines"] == 2
    assert license_scan.document_licences(no_docs).count() == 0
    assert license_scan.document_licences(odd_docs).count() == odd_docs.select("doc_id").distinct().count()


def test_licences_within_long_lines(spark):
    """Every template inside a line of 2,000 words is found as it is alone."""
    prose = [f"{w}{i % 7}" for i, w in enumerate("people walk along the river and talk about weather".split() * 112)]
    templates = [(f, t) for f in license_scan.FAMILIES for t in license_scan.TEMPLATES[f]]
    rows = []
    for i, (_, t) in enumerate(templates):
        at = 100 + 37 * i % 800
        rows += [(2 * i, t), (2 * i + 1, " ".join([*prose, *prose[:at], t, *prose[at:], *prose[:100]]))]
    rows += [(10 ** 6, " ".join(["Released under the MIT License.", *prose, "Licensed under CC BY 4.0."])),
             (10 ** 6 + 1, " ".join([*prose, "The bar lost its liquor license.", *prose]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.document_licences(docs).collect()}
    lost = [t for i, (f, t) in enumerate(templates) if not set(got[2 * i]["licences"].split(",")) <= set(got[2 * i + 1]["licences"].split(","))]
    assert not lost
    extra = [(t, got[2 * i + 1]["licences"]) for i, (f, t) in enumerate(templates) if got[2 * i + 1]["licences"] not in (f, got[2 * i]["licences"])]
    assert not extra
    assert got[10 ** 6]["licences"] == "cc-by,mit" and got[10 ** 6]["n_licence_lines"] == 1
    assert got[10 ** 6 + 1]["licences"] == "" and got[10 ** 6 + 1]["n_unknown_lines"] == 1


def test_wrapped_notices(spark):
    """Every template, wrapped at every word and after every word, is found as it is on one line."""
    templates = [(f, t) for f in license_scan.FAMILIES for t in license_scan.TEMPLATES[f]]
    rows, of = [], {}
    for i, (_, t) in enumerate(templates):
        words = t.split()
        rows.append((i, t))
        forms = [" ".join(words[:k]) + "\n" + " ".join(words[k:]) for k in range(1, len(words))] + ["  \n ".join(words)]
        for k, form in enumerate(forms):
            of[1000 * (i + 1) + k] = i
            rows.append((1000 * (i + 1) + k, f"People walk along the river.\n\nThey talk about\n{form}\nthe weather of today.\n\nSo they do."))
    rows += [(-1, "The bar lost its\nliquor license."), (-2, "He asked for\npermission to leave."), (-3, "a\nb\n\nc")]
    model = license_scan.train(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    got = {r["doc_id"]: r for r in license_scan.document_licences(spark.createDataFrame(rows, "doc_id long, text string"), model=model).collect()}
    lost = [(d, got[i]["licences"], got[d]["licences"]) for d, i in of.items() if not set(got[i]["licences"].split(",")) <= set(got[d]["licences"].split(","))]
    assert not lost
    assert all(got[i]["licences"] for i in range(len(templates)))
    assert [got[d]["licences"] for d in (-1, -2, -3)] == ["", "", ""]


def test_strangers_are_kept_apart():
    model = license_scan.Classifier(["Some ordinary line about nothing.", "Ask for permission before you enter the room."])
    for line in license_scan.ORDINARY:
        words = license_scan.tokens_of(line)
        chance = model._softmax(model._scores(*model._sparse([(words, 0)]), 1))[0]
        assert chance[:-1].max() < model.threshold
    assert license_scan.confirmed("GNU Affero General Public") and not license_scan.confirmed("The bar lost its liquor license.")


def test_licence_scores_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    model = license_scan.train(docs)
    got = license_scan.scan(docs, model).collect()
    cued = [(r["doc_id"], i, line) for r in docs.collect() for i, line in enumerate((r["text"] or "").split("\n"))
            if re.search(license_scan.CUE, line)]
    assert sorted((r["doc_id"], r["line_no"], r["line"]) for r in got) == sorted(cued) and cued
    for r in got:
        words = license_scan.tokens_of(r["line"])
        chance = model._softmax(model._scores(*model._sparse([(words, 0)]), 1))[0]
        assert abs(chance.max() - r["probability"]) < 1e-6
        pairs = set(license_scan.pairs_of(words))
        family = license_scan.CLASSES[int(chance.argmax())]
        templates = [set(license_scan.pairs_of(license_scan.tokens_of(t))) for t in license_scan.TEMPLATES.get(family, [])]
        overlap = max((len(pairs & t) / min(len(t), len(pairs)) for t in templates if t and pairs), default=0.0)
        sure = family != "unknown" and chance.max() >= model.threshold and overlap >= license_scan.CONFIRM
        assert r["family"] == (family if sure else "unknown") and abs(r["overlap"] - overlap) < 1e-9
