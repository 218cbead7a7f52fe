"""Operators on single texts: pages, byte pairs, languages, toxicity, preference pairs."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from plumbline.llm import bpe, html_text, langid, preference, toxicity, wordmodel
from plumbline.llm.html_text import extract_main_text, main_text

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


# --- pages --------------------------------------------------------------------


def test_article_without_its_surroundings():
    html = """<html><head><title>T</title><script>var a="</p>";</script></head><body><header>Site</header>
    <nav><a href=x>Home</a></nav><div class="side ad">Buy now, buy much, buy more than ever before.</div>
    <article><header><h1>A &amp; B</h1></header><p><b>One <br>two&nbsp; three<p>Short.</p><ul><li>x<li>y</ul>
    <aside>Aside</aside><form>Form</form><div id="comments"><p>First!</p></div></article>
    <footer>Foot</footer></body></html>"""
    assert main_text(html) == "A & B\nOne two three\nShort.\nx\ny"


def test_pages_without_article():
    html = "<div class=menu><a>a</a></div><div><p>A long enough line of text for the page.</p><p>End.</p></div>"
    assert main_text(html) == "A long enough line of text for the page.\nEnd."
    assert main_text("<nav>only</nav>") == main_text("") == main_text(None) == ""
    assert main_text("<![CDATA[x]]> bare & text <!-- c") .startswith("bare & text")


def test_all_parts_of_the_article_come_out():
    two = "<article><h1>A</h1><p>The first article with a line of text.</p></article><article><p>The second, with text too.</p></article>"
    assert main_text(two) == "A\nThe first article with a line of text.\nThe second, with text too."
    parts = """<body><nav><a>x</a></nav><div><h1>Head</h1><section><p>Some long text in the first section here.</p><p>More.</p>
    </section><section><p>Other long text in a second section.</p></section></div><div class=footer>f</div></body>"""
    assert main_text(parts) == "Head\nSome long text in the first section here.\nMore.\nOther long text in a second section."
    inside = """<main><article><p>Intro text of some length here.</p><div class="social history"><p>The social history of the
    town is long and told here.</p></div><div class="share"><a>Tweet</a><a>Mail</a></div><div class=comments><p>First! A comment
    of some length here.</p></div><ul><li><a>Other story</a><li><a>More stories</a></ul></article></main>
    <article><p>A teaser of another article, outside of the main part.</p></article>"""
    assert main_text(inside) == "Intro text of some length here.\nThe social history of the town is long and told here."


def test_the_clustering_decides(monkeypatch):
    page = """<article><p>A first line of text that is long enough.</p><div class="related"><p>Words on related work, told
    at some length in this line.</p></div><ol><li><a>One</a></li><li><a>Two</a></li></ol></article><article><p>x</p></article>"""
    want = "A first line of text that is long enough.\nWords on related work, told at some length in this line."
    assert main_text(page) == want
    monkeypatch.setattr(html_text, "content_lines", lambda lines: np.zeros(len(lines), bool))
    assert main_text(page) == ""
    monkeypatch.setattr(html_text, "content_lines", lambda lines: np.array([x.text == "x" for x in lines]))
    assert main_text(page) == "x"
    monkeypatch.setattr(html_text, "content_lines", lambda lines: np.array([x.text.startswith("A first") for x in lines]))
    assert main_text(page) == "A first line of text that is long enough."


def test_deep_pages_take_memory_by_length():
    import tracemalloc

    tracemalloc.start()
    assert main_text("<div>" * 40_000 + "some text here" + "</p>" * 40_000) == "some text here"
    assert main_text("<div><b>" * 20_000 + "text" + "</i></p>" * 20_000) == "text"
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_extract_keeps_rows_and_ignores_other_columns(spark):
    rows = [(1, "u", "<p>x</p>", "clash"), (1, "u", "<p>x</p>", "clash"), (None, None, None, None), (2, "v", "", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(str, extract_main_text(pages, ["page_id", "url"]).collect()))
    assert len(got) == 4 and got.count("Row(page_id=1, url='u', text='x', n_chars=1)") == 2
    assert extract_main_text(pages.limit(0), ["page_id"]).count() == 0


def test_long_page():
    body = "".join(f"<p>line {i} of a long page</p>" for i in range(20000))
    assert main_text(f"<body><article>{body}</article></body>").count("\n") == 19999


# --- byte pairs -----------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(text):
    vocab = bpe.vocabulary(PATH, public_tokenizers.PATTERN)
    ids, _ = bpe._Memory(vocab).ids(vocab.pattern.findall(text))
    return ids.tolist(), vocab.decode(ids)[0].tobytes().decode()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_any_text_like_the_library(reference, text):
    ids, back = encoded(text)
    assert ids == reference.encode_ordinary(text) and back == text


def test_long_pieces_like_the_library(reference):
    random.seed(5)
    for text in ("a" * 3000, "ab" * 999, " " * 700, "é" * 500, "".join(random.choices("abcdeé", k=2500))):
        assert encoded(text)[0] == reference.encode_ordinary(text)


def test_encode_rows(spark, reference):
    rows = [(1, "Hello  world", 9), (1, "Hello  world", 9), (None, None, 0), (2, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = bpe.digests(bpe.encode(docs, ["doc_id"], "text", PATH, public_tokenizers.PATTERN, True), ["doc_id"]).collect()
    ids = np.array(reference.encode_ordinary("Hello  world"), "<u4").tobytes()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(b"Hello  world").hexdigest())] * 2
        + [(None, 0, empty, empty), (2, 0, empty, empty)],
        key=str,
    )
    assert bpe.encode(docs.limit(0), ["doc_id"], "text", PATH, public_tokenizers.PATTERN).count() == 0


# --- languages --------------------------------------------------------------------

SAMPLES = {
    "en": "the quick brown fox jumps over the lazy dog and then it was that with this from have which",
    "de": "der schnelle braune fuchs springt über den faulen hund und dann war es nicht mit einer sich",
    "ru": "быстрая коричневая лиса прыгает через ленивую собаку и потом это было что с этим",
}


def test_languages_and_spans(spark):
    random.seed(1)
    rows = [
        (i, " ".join(random.choices(words.split(), k=30)), lang, "x")
        for i, (lang, words) in enumerate(list(SAMPLES.items()) * 20)
    ]
    rows += [(100, None, "en", "x"), (101, "no label", None, "x"), (102, "123 !!", "en", "x"), (102, "123 !!", "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    model = langid.fit(docs)
    assert model.languages == ["de", "en", "ru"]
    mixed = "the lazy dog and the quick brown fox with that " * 3 + "der faule hund und der schnelle fuchs mit einer " * 4
    more = spark.createDataFrame([(200, mixed), (201, "Собака"), (202, "of the")], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(docs.select("doc_id", "text").union(more), model, ["doc_id"]).collect()}
    assert all(got[i].lang_pred == rows[i][2] and got[i].score > 0.9 for i in range(60))
    assert [(got[i].lang_pred, got[i].score, got[i].spans) for i in (100, 102)] == [("und", 0.0, [])] * 2
    assert got[200].lang_pred == "de" and [s.lang for s in got[200].spans] == ["en", "de"]
    assert mixed[got[200].spans[1].start :].startswith("der faule") and 0.4 < got[200].score < 0.7
    assert got[201].lang_pred == "ru" and got[202].lang_pred == "en"
    nothing = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, nothing, ["doc_id"]).collect()} == {"und"}


def test_rare_language_of_a_common_script(spark):
    rows = [(i, f"{SAMPLES['en']} " * 400, "en") for i in range(20)] + [(20, SAMPLES["de"], "de"), (21, "слово дом", "ru")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    more = spark.createDataFrame([(0, SAMPLES["de"]), (1, SAMPLES["en"]), (2, "дом"), (3, "λόγος")], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(more, langid.fit(docs), ["doc_id"]).collect()}
    assert [got[i].lang_pred for i in range(3)] == ["de", "en", "ru"]
    assert 0 <= got[3].score <= 1


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(3)
    for _ in range(30):
        texts = [-rng.random((rng.integers(1, 6), 3)) * 30 for _ in range(4)]
        for scores, path in zip(texts, langid.viterbi(texts), strict=True):
            paths = np.array(np.meshgrid(*[range(3)] * len(scores))).T.reshape(-1, len(scores))
            value = [scores[range(len(p)), p].sum() - langid.SWITCH * (np.diff(p) != 0).sum() for p in paths]
            own = scores[range(len(path)), path].sum() - langid.SWITCH * (np.diff(path) != 0).sum()
            assert own == pytest.approx(max(value))


# --- toxicity ----------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    random.seed(2)
    syllables = [a + b for a in "bdglmnprst" for b in "aeiou"]

    def text(toxic):
        words = ["".join(random.choices(syllables, k=random.randint(1, 4))) for _ in range(random.randint(30, 90))]
        for _ in range(len(words) // 15 if toxic else 0):
            words[random.randrange(len(words))] = "zwack" + random.choice(syllables)
        return " ".join(words)

    marks = [i % 4 == 0 for i in range(800)]
    docs = [(i, text(t), "x") for i, t in enumerate(marks)] + [(None, "la la", "x"), (900, None, "x"), (901, "", "x")]
    labels = [(i, int(t)) for i, t in enumerate(marks)] + [(5, None), (None, 1), (9999, 1), (901, 7), (3, 0)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, score string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.digest(docs, labels).collect()
    assert len(got) == 803 and all(0 <= r.score <= 1 for r in got)
    held = [(r.predicted, marks[r.doc_id]) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 800]
    assert len(held) > 100 and np.mean([a == b for a, b in held]) > 0.95
    kept = toxicity.score(docs, labels, keep=["text", "doc_id"])
    assert kept.columns == ["text", "doc_id", "score"] and kept.count() == 803


def test_toxicity_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, labels).collect()} == {0.25}
    assert toxicity.score(docs.limit(0), labels.limit(0)).count() == 0


# --- preference pairs ------------------------------------------------------------------


def test_preference_pairs(spark):
    rows = [
        ("p", "chosen", 0, "user", "hi", 1),
        ("p", "chosen", 1, "assistant", "yes", 1),
        ("p", "rejected", 0, "user", "hi", 1),
        ("p", "rejected", 1, "assistant", "<|end|>", 1),
        ("p", "neither", 2, "user", "x", 1),
        ("q", "chosen", 0, "user", "only", 1),
        ("r", "chosen", 0, None, None, 1),
        ("r", "rejected", 0, "user", "", 1),
        (None, "chosen", None, "user", "a", 1),
        (None, "chosen", 0, "assistant", "b", 1),
    ]
    schema = "pair string, side string, turn int, role string, text string, prompt int"
    got = {r.pair: r for r in preference.preference_pairs(spark.createDataFrame(rows, schema), "pair").collect()}
    p = got["p"]
    assert (p.n_prompt_turns, p.prompt, p.usable) == (1, "<|user|>\nhi<|end|>\n", True)
    assert p.chosen == "<|assistant|>\nyes<|end|>\n" and p.rejected == "<|assistant|>\n< |end|><|end|>\n"
    assert [p.chosen[s.start : s.end] for s in p.chosen_spans] == ["yes<|end|>\n"]
    assert (got["q"].n_prompt_turns, got["q"].rejected, got["q"].usable) == (0, "", False)
    assert (got["r"].n_prompt_turns, got["r"].chosen, got["r"].usable) == (1, "", False)
    assert got[None].chosen.startswith("<|user|>\na")
    assert preference.preference_pairs(spark.createDataFrame([], schema), "pair").count() == 0


def test_words_are_letters():
    assert wordmodel.words("½ ② ² 12 ٣ _ x² naïve 日本語 a1b") == ["x", "naïve", "日本語", "a", "b"]


def test_texts_without_a_letter_have_no_language(spark):
    rows = [(i, "the letter of the language is here", "en") for i in range(9)] + [(9, "½ ② ²", None), (10, "12 ٣ _", "en")]
    found = langid.digest(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {r.doc_id: r.lang_pred for r in found.where("doc_id > 8").collect()} == {9: "und", 10: "und"}


# --- word models ------------------------------------------------------------------------------


def plain_log_probability(counted, groups, word):
    """Kneser-Ney by its definition; counted: class -> list of words."""
    grams = {}
    for j, group in enumerate(groups):
        for w in (w for c in group for w in counted.get(c, [])):
            marked = f"\x02{w}\x03"
            for i in range(1, len(marked)):
                gram = marked[max(0, i - 4) : i + 1]
                grams.setdefault(gram, [0] * len(groups))[j] += 1
    longer, followers = {}, {}
    for gram in grams:
        short = gram[-3:]
        longer[short] = longer.get(short, 0) + 1
    for short in longer:
        followers.setdefault(short[:-1], set()).add(short)
    out = np.zeros(len(groups))
    marked = f"\x02{word}\x03"
    for i in range(1, len(marked)):
        gram = marked[max(0, i - 4) : i + 1]
        short, back = gram[-3:], gram[-3:][:-1]
        shared = wordmodel.FLOOR
        if back in followers:
            total = sum(longer[s] for s in followers[back])
            shared = max(longer.get(short, 0) - 0.75, 0) + 0.75 * len(followers[back]) * wordmodel.FLOOR
            shared = max(shared / total, wordmodel.LEAST)
        for j in range(len(groups)):
            own = {g: n[j] for g, n in grams.items() if g[:-1] == gram[:-1] and n[j]}
            p = shared
            if own:
                p = (max(own.get(gram, 0) - 0.75, 0) + 0.75 * len(own) * shared) / sum(own.values())
            out[j] += np.log(p)
    return out


@pytest.mark.parametrize("cells", [1 << 25, 0])
def test_word_models_are_kneser_ney(spark, monkeypatch, cells):
    """Sent to the tasks, or joined with the words: the same scores, by the definition."""
    monkeypatch.setattr(wordmodel, "MODEL_CELLS", cells)
    rng = random.Random(2)
    counted = {c: ["".join(rng.choices("abcé", k=rng.randint(1, 7))) for _ in range(60)] for c in range(3)}
    rows = [(c, " ".join(counted[c][i::4])) for c in counted for i in range(4)] + [(None, "x"), (1, None), (1, "")]
    counts = wordmodel.count_grams(spark.createDataFrame(rows, "class int, text string"))
    asked = [*counted[0][:10], "a", "zzz", "abzab", "bébébébéb", "日本"]
    for groups in ([[0], [1], [2]], [[0, 1], [2]], [[2]]):
        model = wordmodel.fitted(counts, groups)
        texts = spark.createDataFrame([(i, w) for i, w in enumerate(asked)] + [(99, None)], "k0 int, text string")
        scorer = wordmodel.Scorer(model, texts)
        assert scorer.joined == (cells == 0)
        (batch,) = scorer.rows.toArrow().combine_chunks().to_batches()
        got = scorer.log_probabilities(batch, asked)
        want = [plain_log_probability(counted, groups, w) for w in asked]
        assert np.allclose(got, want, rtol=1e-4)


def test_joined_models_predict_the_same(spark, monkeypatch):
    rng = random.Random(3)

    def text(letters):
        return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(30))

    rows = [(i, text("abcde" if i % 3 else "cdefg") + (" vile" if i % 5 == 0 else ""), "xy"[i % 3 == 0]) for i in range(120)]
    rows += [(500, None, None), (501, "", "x"), (None, text("abcde") + " " + text("cdefg"), "x"), (7, rows[7][1], "x")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(120)], "doc_id long, toxic int")

    def found():
        lang = sorted((str(r[0]), r[2], round(r[3], 4), r[4]) for r in langid.digest(documents).collect())
        return lang, sorted((str(r[0]), round(r[2], 3), r[3]) for r in toxicity.digest(documents, labels).collect())

    whole = found()
    monkeypatch.setattr(wordmodel, "MODEL_CELLS", 0)
    assert found() == whole


def test_held_out_toxicity(spark):
    """Learnt from 41 toxic documents; a text is long and its toxic words are few."""
    sf_dir = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    told = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [(r.score, told[r.doc_id]) for r in toxicity.digest(documents, labels).collect() if r.held_out and r.doc_id in told]
    toxic, ordinary = (np.array([s for s, t in rows if t == label]) for label in (1, 0))
    above = toxic[:, None] - ordinary
    assert len(toxic) >= 5 and (above > 0).mean() + (above == 0).mean() / 2 > 0.9
    assert (ordinary < 0.5).mean() > 0.97


def test_a_task_scores_each_word_once():
    asked = []

    class Model:
        languages = ["a", "b"]
        prior = np.zeros(2)

        def scores(self, unique, logs):
            return logs

        def one_language(self, scores):
            return True

    class Scorer:
        def log_probabilities(self, batch, unique):
            asked.extend(unique)
            return np.array([[-1.0, 0.0] if w == "two" else [0.0, -2.0] for w in unique])

    known = langid._Words(2)
    batches = [pa.RecordBatch.from_pydict({"text": x}) for x in (["one two", None], ["two two", "one 3 three", ""])]
    found = [x[0] for b in batches for x in langid._identified(Model(), Scorer(), b, known)]
    assert found == ["a", "und", "b", "a", "und"]
    assert asked == ["one", "two", "three"]


def test_grams_are_counted_over_slices(spark, monkeypatch):
    texts = ["ab cd", "ab", "cd ef", "ab"] * 30
    rows = spark.createDataFrame([(i % 2, t) for i, t in enumerate(texts)], "class int, text string")
    once = sorted(tuple(r) for r in wordmodel.count_grams(rows).collect())
    monkeypatch.setattr(wordmodel, "HELD_WORDS", 1)
    assert sorted(tuple(r) for r in wordmodel.count_grams(rows).collect()) == once
    assert sum(r[-1] for r in once) == sum(len(w) + 1 for t in texts for w in t.split())
