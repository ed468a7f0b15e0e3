"""Operators that treat every text alone: encoding, languages, toxicity, pages, licenses, chunks."""

import hashlib
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from pinwheel.llm import bpe, chunks, langid, licenses, mainhtml, subwords, toxicity
from pinwheel.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def doc(i, text, lang="en", source="s"):
    return (i, text, lang, source, None if text is None else len(text))


# ---- encoding ----

TEXTS = ["", "  \t\n", None, "Hello, world! It's 2 o'clock.", "a" * 700, "ÉTÉ été ΑΣ ΣΑΣ İ", "日本語 テスト １２ ½ 🙂🙂",
         "x<|startoftext|>y <|endoftext|>", "a\x1cb\x85c d​e\0\0f", "the same", "the same"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


def test_bpe_equals_the_library(spark, library):
    rows = [(i, t, "x", "y", "z") for i, t in enumerate(TEXTS)]
    df = docs(spark, rows, "doc_id long, text string, ids string, decoded string, doc string")
    got = {r.doc_id: (r.ids, r.decoded) for r in bpe.bpe_encode(df, tokenizer_path("word_bpe_49k.json")).collect()}
    for i, t in enumerate(TEXTS):
        want = library.encode(t or "", add_special_tokens=False).ids
        assert got[i] == (want, library.decode(want, skip_special_tokens=False)), t


def test_bpe_forgets_pieces_without_changing_ids(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    encoder = bpe.Encoder(bpe.load_vocabulary(tokenizer_path("word_bpe_49k.json")))
    for t in ["one two three four", "five one two six", "three seven one"]:
        assert encoder.encode([t])[0].tolist() == library.encode(t, add_special_tokens=False).ids


def test_segment_tree_takes_leftmost_lowest_rank():
    vocabulary = {"keys": np.array([0 * 9 + 0, 0 * 9 + 1, 2 * 9 + 1]), "ranks": np.array([0, 1, 2]), "made": np.array([2, 3, 4]), "size": 9}
    encoder = bpe.Encoder.__new__(bpe.Encoder)
    encoder.v = vocabulary
    ids, n = encoder.merge(np.array([0, 0, 0, 1, 0, 1]), np.array([4, 2]), 4)
    # 0 0 0 1 -> 2 0 1 -> 2 3;   0 1 -> 3
    assert ids.tolist() == [2, 3, 3] and n.tolist() == [2, 1]


def test_bpe_rows_and_lists_agree(library, monkeypatch):
    rng = np.random.default_rng(19)
    texts = ["".join(rng.choice(list("etaoinshr"), int(n))) for n in (1, 2, 3, 700, 5000)] + ["x\u00e9" * 50, "aaaa " * 9, "\x00\x00"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for few in (0, 10 ** 9):
        monkeypatch.setattr(bpe, "FEW_ROWS", few)
        ids, n, _ = bpe.Encoder(bpe.load_vocabulary(tokenizer_path("word_bpe_49k.json"))).encode(texts)
        ends = np.cumsum(n)
        assert [ids[e - k:e].tolist() for e, k in zip(ends, n)] == want


def test_bpe_very_long_piece(library):
    import time
    rng = np.random.default_rng(20)
    text = "".join(rng.choice(list("etaoinshrdlucmfwyp"), 100_000))
    encoder = bpe.Encoder(bpe.load_vocabulary(tokenizer_path("word_bpe_49k.json")))
    start = time.perf_counter()
    ids, _, _ = encoder.encode([text])
    assert time.perf_counter() - start < 10
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_bpe_empty_table(spark):
    out = bpe.bpe_digest(docs(spark, []), tokenizer_path("word_bpe_49k.json"))
    assert out.count() == 0 and out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


# ---- subwords ----

def test_gram_buckets_are_those_of_each_word_alone():
    words = ["a", "abcdef", "é", "the", "a" * 50]
    together, counts = subwords.gram_buckets(words, (3, 4), 1 << 16)
    apart = [subwords.gram_buckets([w], (3, 4), 1 << 16)[0] for w in words]
    assert counts.tolist() == [len(x) for x in apart]
    assert together.tolist() == np.concatenate(apart).tolist()
    assert counts.tolist()[1] == (8 - 2) + (8 - 3)
    assert len(set(subwords.word_buckets(words, 1 << 30).tolist())) == len(words)


# ---- languages ----

def language_rows(n=60):
    rng = np.random.default_rng(1)
    syllables = {"aa": ["ka", "ki", "ko"], "bb": ["lu", "le", "lo"]}
    return [doc(i, " ".join("".join(rng.choice(syllables[lang], 3)) for _ in range(12)), lang)
            for i, lang in enumerate(["aa", "bb"] * n)]


def test_language_scores_equal_slow_ones(spark):
    """Average of the logits of all character n-grams of all words, one by one."""
    rows = language_rows()
    model = langid.fit_language_id(docs(spark, rows))
    texts = ["kakiko lulelo", "Ka", "lu " * 300, "é x", " \n", "12"]
    got = langid.scores(model, texts)
    for text, p in zip(texts, got):
        grams = [subwords.gram_buckets([w], langid.GRAMS, langid.BUCKETS)[0] for w in subwords.WORDS.findall(text.lower())]
        every = [model.table[b].astype(float) for g in grams for b in g]
        z = (np.mean(every, axis=0) if every else 0) + model.bias
        assert p == pytest.approx(langid.softmax(z / model.temperature), rel=1e-5)


def test_language_excerpts_are_bounded():
    rng = np.random.default_rng(3)
    assert langid.excerpts("", rng) == [] and langid.excerpts("one", rng) == ["one"] * langid.EXCERPTS
    long = langid.excerpts("w" * 50_000 + " " + "two words " * 5000, rng)
    assert all(len(x) <= langid.EXCERPT_CHARS and len(x.split()) <= langid.EXCERPT_WORDS for x in long)


def test_language_learned_and_undetermined(spark):
    rows = language_rows() + [doc(1000, None), doc(1001, ""), doc(1002, "12 34 --"), doc(1003, "kakiko " * 3000, None), (None, "lulelo", None, None, None)]
    df = docs(spark, rows).withColumn("score", F.lit("x")).withColumn("held_out", F.lit(1))
    out = langid.identify_language(df, langid.fit_language_id(df)).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == len(rows)
    assert all(got[r[0]].lang_pred == r[2] for r in rows[:120])
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "aa", "bb"]
    assert got[1000].score == 0 and got[1000].rejected and all(0 <= r.score <= 1 for r in out)


def test_language_nothing_to_learn(spark):
    df = docs(spark, [doc(1, "words here", None)])
    assert [r.lang_pred for r in langid.identify_language(df, langid.fit_language_id(df)).collect()] == ["und"]
    empty = docs(spark, [])
    assert langid.identify_language(empty, langid.fit_language_id(empty)).count() == 0


# ---- toxicity ----

def test_gradients_agree_with_differences():
    rng = np.random.default_rng(3)
    m = toxicity.Model(np.zeros((4, toxicity.WORD_DIM)), np.zeros((4, toxicity.CHAR_DIM)))
    d, h = toxicity.INPUT, toxicity.HIDDEN
    shapes = {"wf": (d, 3 * h), "bf": (3 * h,), "uf": (h, 3 * h), "wb": (d, 3 * h), "bb": (3 * h,), "ub": (h, 3 * h),
              "att": (2 * h, h), "att_b": (h,), "query": (h,), "out": (2 * h,), "out_b": ()}
    m.params = {k: np.asarray(rng.normal(0, 0.5, s), np.float32) for k, s in shapes.items()}
    x = rng.normal(0, 1, (5, d)).astype(np.float32)
    at = rng.integers(0, 5, (6, 3))
    mask = (np.arange(6)[:, None] < np.array([6, 4, 1])).astype(np.float32)
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss(vectors):
        p, xs = m.params, vectors[at]
        states = np.concatenate([toxicity._recur(xs @ p["wf"] + p["bf"], p["uf"], mask, False),
                                 toxicity._recur(xs @ p["wb"] + p["bb"], p["ub"], mask, True)], axis=2)
        logit = toxicity._pool(p, states, mask)[2].astype(np.float64)
        return float((weight * (np.logaddexp(0, logit) - y * logit)).sum() / weight.sum())

    grads, dx = toxicity.gradients(m, x, at, mask, y, weight)
    step = 1e-2
    for name, value in m.params.items():
        flat = value.reshape(-1)
        for k in rng.integers(0, flat.size, 4):
            old = flat[k].copy()
            flat[k] = old + step
            up = loss(x)
            flat[k] = old - step
            down = loss(x)
            flat[k] = old
            assert np.asarray(grads[name]).reshape(-1)[k] == pytest.approx((up - down) / (2 * step), abs=2e-3), name
    by_word = np.zeros_like(x)
    np.add.at(by_word, at.ravel(), dx.reshape(-1, d))
    for k in range(4):
        moved = x.copy()
        moved[k, k] += step
        back = x.copy()
        back[k, k] -= step
        assert by_word[k, k] == pytest.approx((loss(moved) - loss(back)) / (2 * step), abs=2e-3)


def test_packed_model_is_exact():
    """Four dimensions in single precision reach the tasks unchanged, without rows that nothing trained."""
    assert toxicity.WORD_DIM >= 4 and toxicity.CHAR_DIM >= 4
    texts = [f"word{k % 7} good text {'vile' if k % 3 == 0 else 'calm'} number{k}" for k in range(60)]
    m = toxicity.train(texts, [int(k % 3 == 0) for k in range(60)])
    data = toxicity.packed(m)
    back = toxicity.unpacked(data)
    assert m.fitted and back.word.dtype == back.char.dtype == np.float32 and len(data) < 1 << 20
    assert np.array_equal(toxicity.text_scores(back, texts), toxicity.text_scores(m, texts)) and len(set(toxicity.text_scores(m, texts))) > 1
    used = toxicity.read_words(texts + ["other words"])
    assert np.array_equal(toxicity.word_vectors(back, used), toxicity.word_vectors(m, used))
    assert not toxicity.unpacked(toxicity.packed(toxicity.train([], []))).fitted


def test_windows_cover_all_words():
    for n in (0, 1, 31, 32, 33, 48, 49, 1000):
        start, length, text = toxicity.windows_of(np.array([5, n, 2]))
        mine = text == 1
        covered = {int(s) - 5 + k for s, size in zip(start[mine], length[mine]) for k in range(size)}
        assert covered == set(range(n))
        assert all(b - a <= toxicity.STRIDE for a, b in zip(start[mine], start[mine][1:]))


def toxic_rows(n=240):
    rng = np.random.default_rng(5)
    filler = ["mild", "green", "house", "walks", "slowly", "under", "seven", "trees", "river", "stone"]
    rows, labels = [], []
    for i in range(n):
        words = list(rng.choice(filler, int(rng.integers(5, 120))))
        if i % 3 == 0:
            for _ in range(2):
                words.insert(int(rng.integers(0, len(words))), rng.choice(["vilescum", "nastyfool!", "Vilescum,"]))
        rows.append(doc(i, " ".join(words)))
        labels.append((i, 1, int(i % 3 == 0)))
    return rows, labels


def test_toxicity_finds_held_out_and_keeps_clean(spark):
    rows, labels = toxic_rows()
    extra = [doc(900, None), doc(901, ""), doc(902, "green stone " * 4000 + "vilescum"), (None, "mild house", None, None, None)]
    df = docs(spark, rows + extra)
    marks = spark.createDataFrame(labels + [(903, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(df, marks).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == len(rows) + 4
    truth = {i: t for i, _, t in labels}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert held and all(r.predicted == truth[r.doc_id] for r in held)
    assert (got[900].score, got[901].score, got[902].predicted, got[None].predicted) == (0.0, 0.0, 1, 0)
    wide = df.withColumn("toxicity_score", F.lit(7)).withColumn("c0", F.lit("x"))
    kept = toxicity.without_toxic(wide, marks)
    assert kept.columns == wide.columns and {r.toxicity_score for r in kept.collect()} == {7} and {r.doc_id for r in kept.collect()}.isdisjoint({902, 0, 3})


def test_toxicity_without_labels(spark):
    df = docs(spark, [doc(1, "some words")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.predicted for r in toxicity.toxicity(df, none).collect()] == [0]
    assert toxicity.toxicity(docs(spark, []), none).count() == 0


# ---- pages ----

PAGES = [
    ("", ""), (None, ""), ("just text", "just text"), ("<p>Fish &amp; chips &#233; &nbsp;  x", "Fish & chips é x"),
    ("<body><nav><a href=a>Home</a> <a href=b>More</a></nav><article><h1>T</h1><p>One two three four.<p><b>Five</b>\n six.</article>"
     "<footer>&copy; me</footer>", "T\n\nOne two three four.\n\nFive six."),
    ("<div class='content'><h2>Head</h2><p>A long paragraph of the text itself, with words.</p></div>"
     "<div id='comments'><p>First comment, which is longer than the whole article and goes on and on and on.</p></div>",
     "Head\n\nA long paragraph of the text itself, with words."),
    ("<article><p>Text of it.</p><form><p>Your mail</p></form><aside>More</aside><script>x = '</p>'</script></article>", "Text of it."),
    ("<form><h1>Page in a form</h1><p>All of it.</p></form>", "Page in a form\n\nAll of it."),
    ("<article><header><h1>Own title</h1></header><p>Words.</p></article><header>Site</header>", "Own title\n\nWords."),
    ("<p>cut off <b", "cut off"), ("<!-- <p>no</p> --><p>x < y & z</p>", "x < y & z"),
    ("<ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table>", "one\n\ntwo\n\na b\n\nc"),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_main_text(page, text):
    assert mainhtml.main_text(page) == text


LONG = "A long paragraph of the text itself, with words, commas and more words than anything else on this page has."
LINKS = "<ul><li><a href=a>First link</a><li><a href=b>Second link</a></ul>"
# Marked elements that hold the text, and marked ones that don't.
MARKED_PAGES = [
    (f"<nav>{LINKS}</nav><div class='elementor-widget-container'><p>{LONG}</p><p>{LONG}</p></div><footer>me</footer>", [LONG, LONG]),
    (f"<div class='elementor-widget'><h1>Title</h1></div><div class='elementor-widget'><p>{LONG}</p></div><div class='elementor-widget'><p>{LONG}</p></div>",
     ["Title", LONG, LONG]),
    (f"<form id='form1'><div class='menu'>{LINKS}</div><div><h2>Head</h2><p>{LONG}</p><p>{LONG}</p></div></form>", ["Head", LONG, LONG]),
    (f"<article><h1>T</h1><p>{LONG}</p><h2 id='discussion'>Discussion</h2><p>{LONG}</p></article>", ["T", LONG, "Discussion", LONG]),
    (f"<article><h1>T</h1><p>{LONG}</p><section id='search'><p>{LONG}</p></section></article>", ["T", LONG, LONG]),
    (f"<article><h1>T</h1><p>{LONG}</p><div class='alert'>Mind it.</div><p>{LONG}</p></article>", ["T", LONG, "Mind it.", LONG]),
    (f"<article><h1>T</h1><p>{LONG}</p><section class='related-work'><h2>Related work</h2><p>{LONG}</p></section></article>",
     ["T", LONG, "Related work", LONG]),
    (f"<header><h1>Title</h1></header><div><p>{LONG}</p><p>{LONG}</p></div>", ["Title", LONG, LONG]),
    (f"<div class='sponsored'><p>{LONG}</p><p>{LONG}</p></div><div>x</div>", [LONG, LONG, "x"]),
    ("".join(f"<div class='elementor-widget'><div class='elementor-widget-container'><p>{k} {LONG}</p></div></div>" for k in range(30)),
     [f"{k} {LONG}" for k in range(30)]),
    ("".join(f"<div class='promo'><p>{k} {LONG}</p></div>" for k in range(30)), [f"{k} {LONG}" for k in range(30)]),
    (f"<header><h1>Site</h1></header><article><h1>T</h1><p>{LONG}</p></article><div class='ad'>Buy it now, and more of it.</div>", ["T", LONG]),
    (f"<article><h1>T</h1><p>{LONG}</p><div class='related'>{LINKS}</div><div class='ad'>Buy it now.</div></article>", ["T", LONG]),
    (f"<div><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div><div class='widget'>Weather: rain.</div><div class='alert'>We use cookies.</div>", ["T", LONG, LONG]),
]

MARKED_PAGES += [
    (f"<article><h1>T</h1><p>{LONG}</p><section id='copyright'><h2>Copyright</h2><p>{LONG}</p></section></article>", ["T", LONG, "Copyright", LONG]),
    (f"<article><h1>T</h1><p>{LONG}</p><div class='login-flow'><p>{LONG}</p></div></article>", ["T", LONG, LONG]),
    ("<div class='content'><p>The first short paragraph of it.</p><p>And the second short paragraph.</p></div>"
     f"<div class='sidebar'><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>", ["The first short paragraph of it.", "And the second short paragraph."]),
    (f"<div class='story'><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div><div class='user-reviews'><p>Very good, I say.</p><p>Not for me.</p></div>", ["T", LONG, LONG]),
    (f"<article><p>{LONG} Area is <math><mi>A</mi><mo>=</mo><mn>4</mn><annotation>A=4</annotation></math>.</p></article>", [f"{LONG} Area is A=4."]),
]


@pytest.mark.parametrize("page,text", MARKED_PAGES)
def test_marks_are_only_evidence(page, text):
    assert mainhtml.main_text(page) == "\n\n".join(text)


def slow_choice(root):
    """Chosen subtrees by the definition, everything counted anew for every node."""
    import html
    import math
    every = lambda n: [n] + [y for x in n.kids if not isinstance(x, str) for y in every(x)]
    own = lambda n: sum(len(" ".join(html.unescape(x).split())) for x in n.kids if isinstance(x, str))
    chars = lambda n: sum(own(x) for x in every(n))

    def links(n):  # outermost links
        return [n] if n.tag == "a" else [y for x in n.kids if not isinstance(x, str) for y in links(x)]

    def density(n):
        c, lc = chars(n), sum(chars(x) for x in links(n))
        t, lt = max(len(every(n)) - 1, 1), max(sum(x.tag == "a" for x in every(n)[1:]), 1)
        if not c:
            return 0.0
        inner = math.log(c / max(c - lc, 1) * lc + sum(chars(x) for x in links(root)) / max(chars(root), 1) * c + math.e)
        return c / t * math.log(max(c / max(lc, 1) * t / lt, 1.0)) / max(math.log(inner), 1e-3) if inner > 1 else 0.0

    total = lambda n: own(n) + sum(density(x) for x in n.kids if not isinstance(x, str))

    def best(top):
        found = top
        level = [top]
        while level:
            for n in level:
                if total(n) > total(found) and n.tag not in mainhtml.PARTS_OF:
                    found = n
            level = [x for n in level for x in n.kids if not isinstance(x, str)]
        return found
    main = best(root)
    path, n = [], main
    while n is not None:
        path.append(density(n))
        n = n.parent
    chosen = {id(main)} | {id(best(n)) for n in every(root) if density(n) >= min(path) and n.tag not in mainhtml.PARTS_OF}
    out = []

    def collect(n):
        if id(n) in chosen:
            out.append(n)
        else:
            for x in n.kids:
                if not isinstance(x, str):
                    collect(x)
    collect(root)
    return out if chars(root) else []


def test_choice_equals_the_definition():
    rng = np.random.default_rng(41)

    def element(depth):
        tag = str(rng.choice(["div", "p", "a", "section", "span", "ul"]))
        inner = "".join(element(depth + 1) if depth < 4 and rng.random() < 0.55 else " ".join(["word"] * int(rng.integers(0, 30))) for _ in range(int(rng.integers(1, 4))))
        return f"<{tag}>{inner}</{tag}>"
    for _ in range(60):
        page = "".join(element(0) for _ in range(3))
        root = mainhtml.parse(page)
        assert [id(n) for n in mainhtml.main_nodes(root)] == [id(n) for n in slow_choice(root)], page


def test_density_by_hand():
    root = mainhtml.parse("<div><p>abcdefghij</p><a>xy</a></div>")
    mainhtml._prune(root)
    nodes = mainhtml._measure(root)
    div = next(n for n in nodes if n.tag == "div")
    assert (div.chars, div.tags, div.link_chars, div.link_tags) == (12, 2, 2, 1)
    base = np.log(12 / 10 * 2 + 2 / 12 * 12 + np.e)
    want = 12 / 2 * np.log(12 / 2 * 2 / 1) / np.log(base)
    assert div.density == pytest.approx(want)
    assert div.sum == pytest.approx(sum(x.density for x in div.kids))


def test_pages_query_rows(spark):
    rows = [(i, f"u{i}", p, "t") for i, (p, _) in enumerate(PAGES)] + [(None, None, "<p>x</p>", None)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = mainhtml.page_texts(df).collect()
    got = {r.page_id: (r.text, r.n_chars) for r in out}
    assert len(out) == len(rows) and all(got[i] == (t, len(t)) for i, (_, t) in enumerate(PAGES)) and got[None] == ("x", 1)
    assert mainhtml.page_texts(df.limit(0)).count() == 0


# ---- licenses ----

def brute_matches(text):
    """Every window of every template that begins with one of its bigrams; no pruning."""
    w = licenses.words_of(text or "")
    g, found = [f"{x} {y}" for x, y in zip(w, w[1:])], []
    for k, (name, template) in enumerate(licenses.TEMPLATES):
        b, size = set(licenses.template_bigrams(template)), len(licenses.words_of(template))
        windows = [(-2 * len(a & b) / (len(a) + len(b)), i) for i in range(len(g)) if g[i] in b for a in [set(g[i:i + size - 1])]]
        if windows and -min(windows)[0] >= licenses.THRESHOLD:
            dice, at = min(windows)
            found.append((name, -dice, at, size, k))
    def worse(m, o):
        return o[2] < m[2] + m[3] and m[2] < o[2] + o[3] and (o[1], o[3], -o[4]) > (m[1], m[3], -m[4])
    return [(m[0], pytest.approx(m[1]), m[2], m[3]) for m in found if not any(worse(m, o) for o in found)]


def test_license_matches_equal_brute_force(spark):
    mit = licenses.TEMPLATES[6][1]
    wrapped = "\n".join(mit[k:k + 70] for k in range(0, len(mit), 70))
    texts = [None, "", "one", "Licensed under the Apache License, Version 2.0.", "prose here\nreleased UNDER the mit license\nmore prose",
             f"intro\n\n{wrapped}\n\nend", wrapped, "Licensed under CC BY-NC 4.0! " * 3, "Licensed under the Apache Licence, Version 2.0",
             "\n".join(t for _, t in licenses.TEMPLATES), "word " * 20_000,
             "of the License " * 60, "the software is provided as is " * 9, licenses.TEMPLATES[9][1].replace("software", "program").replace("copies", "all")]
    df = docs(spark, [doc(i, t) for i, t in enumerate(texts)]).withColumn("matches", F.lit(0)).withColumn("units", F.lit(1))
    out = licenses.license_matches(df)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "units", "matches"]
    for r in out.collect():
        assert [(m.license, m.dice, m.at, m.len) for m in r.matches] == brute_matches(texts[r.doc_id]), texts[r.doc_id]
    summary = {r.doc_id: r for r in licenses.license_scan(df).collect()}
    assert summary[4].license == "MIT" and summary[5].license == "MIT" and summary[0].license is None and summary[0].dice == 0
    assert licenses.license_scan(df.limit(0)).count() == 0


def test_notices_inside_other_text(spark):
    def free(kind, name, version):
        return (f"This {kind} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the "
                f"Free Software Foundation, either version {version} of the License, or (at your option) any later version.")
    warranty = licenses._AS_IS_MIT
    texts = {
        "Copyright 2020 Foo Inc. Licensed under the Apache License, Version 2.0. See the LICENSE file in the project root for details.": "Apache-2.0",
        "This project is licensed under the MIT License - see the LICENSE file for details": "MIT",
        "Some prose ahead.\n" + textwrap.fill(warranty, 60) + " and after": "MIT",
        "Some article text before the notice. Released under the MIT License.": "MIT",
        free("library", "Lesser General Public License", "2.1"): "LGPL",
        free("program", "Affero General Public License", "3"): "AGPL-3.0",
        free("program", "General Public License", "3"): "GPL",
        "A licence for software is a permission with conditions, as is known; the above copyright notice is one of many conditions.": None,
    }
    rows = docs(spark, [doc(k, t) for k, t in enumerate(texts)])
    got = {r.doc_id: (r.license, r.licenses) for r in licenses.license_scan(rows).collect()}
    assert [got[k] for k in range(len(texts))] == [(n, n or "") for n in texts.values()]


def test_anchors_lose_no_match():
    for _, text in licenses.TEMPLATES:
        grams, first = licenses.template_bigrams(text), licenses.anchors(text, licenses.THRESHOLD)
        without = [g for g in grams if not set(g.split()) & set(first)]
        assert len(without) < licenses.needed(len(grams), licenses.THRESHOLD)


# ---- chunks ----

def slow_boundaries(data):
    def h(i):
        v = 0
        for b in data[max(0, i - 32):i]:
            v = ((v << 1) + int(chunks.GEAR[b])) & 0xFFFFFFFF
        return v >> (32 - chunks.STRICT)

    ends, start = [], 0
    while len(data) - start > chunks.SMALLEST:
        end = start + chunks.LARGEST
        for p in range(start + chunks.SMALLEST, min(end, len(data) - 1) + 1):
            if h(p) < (1 if p < start + chunks.NORMAL else 1 << (chunks.STRICT - chunks.LOOSE)):
                end = p
                break
        if end >= len(data):
            break
        ends.append(end)
        start = end
    return ends + [len(data)] * bool(data)


def test_boundaries_equal_slow_ones():
    rng = np.random.default_rng(2)
    for size in (0, 1, 32, 33, 100, 191, 192, 193, 2000):
        for letters in (b"ab", bytes(range(97, 123)), b"a"):
            data = bytes(rng.choice(list(letters), size).astype(np.uint8))
            assert chunks.boundaries(data) == slow_boundaries(data)


def test_shift_moves_few_chunks():
    rng = np.random.default_rng(4)
    text = "".join(rng.choice(list("abcdefghij "), 20_000))
    moved = chunks.chunk_set("a few words in front " + text)
    assert chunks.containment(chunks.chunk_set(text), moved) > 0.98
    assert chunks.containment({}, {}) == 1 and chunks.containment({}, {"a": 1}) == 0 and chunks.containment({"a": 3, "b": 1}, {"a": 3}) == 0.75


@pytest.mark.parametrize("partitions", ["1", "5"])
def test_neighbours_equal_brute_force(spark, partitions):
    rng = np.random.default_rng(6)
    rows = [doc(i, "".join(rng.choice(list("abcdé "), int(rng.integers(0, 900))))) for i in range(60)]
    rows += [doc(7, "second seven"), doc(7, "second seven"), doc(12, None), (None, "no id", None, None, None), (None, "another without", None, None, None)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = docs(spark, rows).withColumn("range", F.lit(1)).withColumn("md5", F.lit("x"))
        got = sorted((repr(r.asDict()) for r in chunks.edited_neighbours(df).collect()))
        assert chunks.edited_neighbours(df.limit(0)).count() == 0
        single = chunks.edited_neighbours(df.where("doc_id = 3")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5((r[1] or "").encode()).hexdigest()))
    want = []
    for k, r in enumerate(ordered):
        a, b = r[1] or "", ordered[(k + 1) % len(ordered)][1] or ""
        new = chunks.edited(a, b)
        sets = [chunks.chunk_set(x) for x in (a, new, b)]
        want.append({"doc_id": r[0], "n_chars": len(a), "edited_sha256": hashlib.sha256(new.encode()).hexdigest(),
                     "fingerprint": chunks.fingerprint_string(sets[0]), "edited_fingerprint": chunks.fingerprint_string(sets[1]),
                     "near_edited": chunks.containment(sets[0], sets[1]), "near_next": chunks.containment(sets[0], sets[2])})
    assert got == sorted(map(repr, want))
    assert single[0].near_next == 1.0


def test_fingerprint_documents(spark):
    out = chunks.fingerprint_documents(docs(spark, [doc(1, None), doc(2, "x" * 100)])).collect()
    got = {r.doc_id: [(c.digest, c.length) for c in r.chunks] for r in out}
    assert got == {1: [], 2: sorted(chunks.chunk_set("x" * 100).items())}
