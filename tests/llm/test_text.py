"""Encoding, language ID, toxicity, license scan and HTML extraction."""

import os
import random
import re

import numpy as np
import pytest
from helpers_llm import awkward, frame, rows

from graphloom.llm import html_extract, langid, lattice, licenses, sentencepiece_fst, toxicity

needs_model = pytest.mark.skipif(not os.path.exists(sentencepiece_fst.MODEL), reason="vocabulary files are not here")


@needs_model
def test_ids_equal_the_reference_encoder(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.MODEL)
    rng = random.Random(1)
    alphabet = "ab cde  the   ing▁\n\t\r;{}()éß梦ༀ😀\x00aaaaa====----."
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += [" " * k for k in range(30)] + ["a" * k for k in range(40)] + ["it's the end. Don't (stop)!"]
    got = sentencepiece_fst.compiled(sentencepiece_fst.MODEL).encode(texts)
    assert [g.tolist() for g in got] == [model.encode(t) for t in texts]


@needs_model
def test_round_trip_with_awkward_rows(spark):
    docs = frame(spark, awkward())
    got = sentencepiece_fst.round_trip(docs)
    assert got.count() == len(awkward())
    assert got.filter("not exact").select("id").collect()[0]["id"] == 12  # holds U+2581, which decodes to a blank
    coded = sentencepiece_fst.encode(docs)
    again = {(r["id"], r["text"]) for r in sentencepiece_fst.decode(coded).collect()}
    assert again == {(i, (t or "").replace("▁", " ")) for i, t, *_ in awkward()}
    assert coded.filter("id = 4").first()["ids"] == []
    assert sentencepiece_fst.encode(frame(spark, [])).count() == 0


def small_vocabulary():
    pieces = [b"a", b"b", b"ab", b"ba", b"aba", b"\xc3\xa9", *[None] * 256]
    return lattice.Vocabulary(pieces, [0.0] * len(pieces), np.arange(6, 262))


def segmentations(text, vocabulary, weights):
    sums = [1.0] + [0.0] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            number = vocabulary.ids.get(text[start:end])
            if number is not None:
                sums[end] += sums[start] * weights[number]
        head = text[:end].decode("utf-8", "ignore")
        char = text.decode()[len(head) - (len(head.encode()) == end):][:1] if end <= len(text) else ""
        if char and char.encode() not in vocabulary.ids:
            sums[end] += sums[end - 1] * weights[vocabulary.byte_ids[text[end - 1]]]
    return sums[-1]


def test_forward_sums_all_segmentations():
    vocabulary = small_vocabulary()
    weights = np.random.default_rng(2).random((262, 2))
    texts = ["abab", "aba", "é", "xa", "日ab", "ab" * 100]
    total, _, _ = lattice.forward(lattice.Lattice(vocabulary, [t.encode() for t in texts]), weights)
    for k, text in enumerate(texts[:-1]):
        for column in range(2):
            assert np.isclose(total[k, column], np.log(segmentations(text.encode(), vocabulary, weights[:, column])))
    # long texts are rescaled on the way
    low = np.log(sum(0 for _ in ()) + 1)
    assert np.isfinite(total[-1]).all() and low == 0


def test_posterior_counts_explain_every_byte():
    vocabulary = small_vocabulary()
    weights = np.random.default_rng(3).random((262, 1))
    net = lattice.Lattice(vocabulary, [b"ababa", b"xab"])
    piece, uses = langid.posterior(net, weights, np.array([2.0, 1.0]))
    width = np.array([len(p) if p else 1 for p in vocabulary.pieces])
    assert np.isclose((uses * width[piece]).sum(), 2 * 5 + 3)


@needs_model
def test_languages_are_told_apart(spark):
    rng = random.Random(5)
    stock = {"en": "the and that with from this have were been which".split(), "de": "der die und nicht mit sich auch eine werden über".split()}
    data = [(i, " ".join(rng.choice(stock[lang]) for _ in range(30)), lang if i % 5 else None) for i in range(120) for lang in [("en", "de")[i % 2]]]
    docs = frame(spark, rows(data) + awkward())
    got = {}
    for r in langid.identify(docs).collect():
        got.setdefault(r["id"], []).append(r["lang_pred"])
    assert all(("en", "de")[i % 2] in got[i] for i in range(120))
    assert got[10] .count("und") == 1 and got[4].count("und") == 1 and got[5].count("und") == 1
    left = langid.in_a_language(docs)
    assert left.columns == docs.columns
    assert left.count() == sum(1 for _, t, *_ in rows(data) + awkward() if t and re.search(r"[^\W\d_]", t))
    assert langid.identify(frame(spark, [])).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs.withColumn("lang", docs["lang"].substr(9, 1)).filter("lang is null")).collect()} == {"und"}


def toxic_corpus(spark):
    rng = random.Random(6)
    plain = [f"word{i}" for i in range(200)]
    data, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        t = [rng.choice(plain) for _ in range(40)]
        if bad:
            t[5:5] = [rng.choice(["vile", "rotten"]), rng.choice(["scoundrels", "scoundrelly"])]
        data.append((i, " ".join(t), "en"))
        if i % 3:
            labels.append((i, int(bad)))
    labels += [(1, None), (None, 1), (4, 1), (9999, 1)]
    return rows(data), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxic_documents_are_found(spark):
    data, labels = toxic_corpus(spark)
    docs = frame(spark, data)
    held = {r["doc_id"] for r in docs.filter(toxicity.held_out()).collect()}
    got = {r["id"]: r for r in toxicity.classify(docs, labels).collect()}
    assert all(got[i]["predicted"] == int(i % 4 == 0) and 0 <= got[i]["score"] <= 1 for i in range(600))
    assert held and any(got[i]["evidence"] for i in held)
    found = toxicity.classify(frame(spark, data + awkward()), labels).collect()
    assert len(found) == len(data) + len(awkward()) and all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.classify(frame(spark, []), labels).count() == 0
    assert {r["score"] for r in toxicity.classify(docs, labels.limit(0)).collect()} == {0.0}


def test_toxic_documents_are_found_from_few_labels(spark):
    rng = random.Random(8)
    data, labels = [], []
    for i in range(200):
        t = [f"word{rng.randrange(3000)}" for _ in range(12)]
        if i % 6 == 0:
            t[5:5] = [rng.choice(["scum", "moron"]), "disgusting"]
        data.append((i, " ".join(t), "en"))
        if i < 90:
            labels.append((i, int(i % 6 == 0)))
    docs, labels = frame(spark, rows(data)), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["id"]: r for r in toxicity.classify(docs, labels).collect()}
    assert all(got[i]["predicted"] == int(i % 6 == 0) for i in range(200))
    assert len({r["score"] for r in got.values()}) > 1


def test_neighbours_are_exact():
    rng = np.random.default_rng(7)
    counts = [{int(t): int(rng.integers(1, 4)) for t in rng.choice(12, rng.integers(1, 5), replace=False)} for _ in range(500)]
    labels = rng.integers(0, 2, 500).astype(float)
    index = toxicity.Index([f"t{i}" for i in range(12)], rng.random(12) + 0.5, list(range(500)), labels, counts, (3, 0))

    def dense(uses):
        v = np.zeros(12)
        for t, x in index.vector(uses):
            v[t] = x
        return v

    table = np.array([dense(c) for c in counts])
    for uses in counts[:60]:
        near = index.nearest(uses)
        want = np.sort(table @ dense(uses))[::-1][:toxicity.NEIGHBOURS]
        assert np.allclose([s for s, _ in near], want[want > 0])


def brute_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    found = []
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        found += [(k, label) for k in range(len(words)) if words[k:k + len(parts)] == parts]
    return words, sorted(found)


def test_license_places(spark):
    rng = random.Random(8)
    stock = "cc by all rights reserved general public license the mit sa ÉCC x1".split()
    texts = [rng.choice(["", " ", "-", "\n"]).join(rng.choice(stock) + rng.choice([" ", "-", ".", "\n", "_"]) for _ in range(40)) for _ in range(200)]
    data = rows([(i, t, "en") for i, t in enumerate(texts)]) + awkward()
    got = licenses.license_scan(frame(spark, data)).collect()
    assert len(got) == len(data)
    by_id = {r["id"]: r for r in got}
    for i, t in list(enumerate(texts))[20:]:
        words, places = brute_places(t)
        r = by_id[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        for s in r["spans"]:
            assert words[s["start"]:s["stop"]] == s["phrase"].split()
    assert licenses.license_scan(frame(spark, [])).count() == 0


@pytest.mark.parametrize(("expression", "rpn", "names", "binds"), [
    ("MIT", ["mit"], {"mit"}, 0.1),
    ("MIT OR GPL-3.0-only", ["mit", "gpl-3.0-only", "or"], {"mit", "gpl"}, 0.1),
    ("MIT AND GPL-3.0-only OR Apache-2.0", ["mit", "gpl-3.0-only", "and", "apache-2.0", "or"], {"mit", "gpl", "apache"}, 0.15),
    ("MIT AND (GPL-2.0 OR Apache-2.0)", ["mit", "gpl-2.0", "apache-2.0", "or", "and"], {"mit", "gpl", "apache"}, 0.15),
    ("GPL-2.0 WITH Classpath-exception-2.0", ["gpl-2.0", "classpath-exception-2.0", "with"], {"gpl"}, 0.5),
    ("MIT OR", ["mit"], {"mit"}, 0.1), ("(MIT", ["mit"], {"mit"}, 0.1), (") MIT", [], set(), 0.0), ("", [], set(), 0.0),
])
def test_licence_expressions(expression, rpn, names, binds):
    assert licenses.parse_expression(expression) == rpn
    found, value = licenses.evaluate(rpn)
    assert found == names and np.isclose(value, binds)


def test_tags_in_texts():
    *_, labels, score, spans = licenses.scan(b"// SPDX-License-Identifier: (LGPL-2.1 OR MIT) AND CC-BY-4.0\nint x;")
    assert labels == "cc-by,lgpl,mit" and np.isclose(score, 0.2) and spans[0][0] == licenses.TAG


PAGE = ('<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p>";</script></head><body>'
        '<nav><ul><li><a href="/x">menu</a></li></ul></nav><!-- ad --><div class="ad">buy</div><div class="cookie-notice">ok?</div>'
        "<article><h1>Head &amp; line</h1><p><b>First<br>part.<p>Two  <i>words</i>\n here &copy; &#233;</p><aside>side</aside>"
        '<form>mail<input></form><ul><li>one<li>two</ul><div class="comments"><p>reader</p></div></article>'
        "<footer>&copy; foot</footer></body></html>")


def test_main_text_of_one_page():
    want = "Head & line\nFirst part.\nTwo words here © é\none\ntwo"
    assert html_extract.main_text(PAGE) == want
    assert html_extract.main_text(PAGE[:PAGE.index("<footer>") + 3]) == want
    assert html_extract.main_text("") == ""
    assert html_extract.main_text("plain words") == "plain words"
    assert html_extract.main_text("<nav>x") == ""
    assert html_extract.main_text("<nav><ul><li>x<article><p>y &am") == "y &am"
    assert html_extract.main_text("<article><p>a < b</p></article>") == "a < b"


def test_style_tree_finds_what_a_site_repeats(spark):
    def page(i):
        return (f'<body><div class="top">Our site since 1999</div><div class="story"><p>Story {i} tells of {i * 7}.</p><p>And {i}.</p></div>'
                f'<div class="tail">Call us now</div></body>')

    data = [(i, f"https://a.example/{i}", page(i), "x", "y") for i in range(12)]
    data += [(50, "https://b.example/1", page(50), "x", "y"), (51, None, None, "x", "y"), (52, "no address", "", "x", "y"),
             (None, "https://a.example/0", page(0), "x", "y"), (0, "https://a.example/0", page(0), "x", "y")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, host string, id string")
    got = html_extract.extract(pages).collect()
    assert len(got) == len(data)
    text = {(r["id"], r["url"]): r["text"] for r in got}
    assert text[(3, "https://a.example/3")] == "Story 3 tells of 21.\nAnd 3."
    assert text[(50, "https://b.example/1")].startswith("Our site")  # one page tells nothing of its site
    assert text[(51, None)] == "" and text[(52, "no address")] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_copies_of_a_page_are_no_repetition(spark):
    bare = "<body><div class='story'><p>One story.</p><p>Its end.</p></div></body>"
    inside = "<body><nav>at {}</nav><article><div class='entry'><p>Some news.</p></div></article></body>"
    data = [(i, f"https://a.example/{i}", bare) for i in range(30)] + [(100 + i, f"https://b.example/{i}", inside.format(i)) for i in range(2)]
    got = html_extract.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()
    assert {(r["id"] < 100, r["text"]) for r in got} == {(True, "One story.\nIts end."), (False, "Some news.")} and len(got) == 32


def test_long_words_teach_and_are_scored():
    vocabulary = lattice.load(langid.VOCABULARY)
    rare = "".join(chr(0x4E00 + 37 * i) for i in range(400))  # most of them spelled by bytes
    model = np.full((vocabulary.size, 2), 1e-9)
    model[:, 1] = 1.0 / vocabulary.size
    totals = lattice.forward(lattice.Lattice(vocabulary, langid.spell([rare, rare[:30], "word"])), model)[0]
    assert np.isfinite(totals).all() and (totals[:, 1] > totals[:, 0]).all()
    scorer = langid.Scorer(model, langid.VOCABULARY)
    texts = ["word and word", rare, None, "other words here", "", rare + " word", "last"]
    together = scorer.texts(texts)
    assert np.isfinite(together).all()
    for text, sums in zip(texts, together, strict=True):
        assert np.allclose(scorer.texts([text])[0], sums)
    net = lattice.Lattice(vocabulary, langid.spell([rare, "short"]))
    for column in (0, 1):
        pieces, uses = langid.posterior(net, model[:, [column]], np.array([2.0, 1.0]))
        spelled = np.bincount(net.text, uses * net.length, minlength=2)
        assert np.allclose(spelled, [2.0 * net.sizes[0], net.sizes[1]])  # every byte is spelled as often as the word occurs
