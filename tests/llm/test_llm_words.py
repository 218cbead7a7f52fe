"""Collocations, SentencePiece, spelling variants: against brute force, the library, and on odd tables."""

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from plumbline.llm import collocations as coll
from plumbline.llm import sentencepiece_bpe as sp
from plumbline.llm import spelling

from check import compare, connect

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, phrase string, n long, id string, word string, score double"


def table(spark, rows):
    """Documents with columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, lang, "x", 1, "y", "z", 0.5) for i, t, lang in rows], SCHEMA)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# --- collocations -----------------------------------------------------------------


def plain_collocations(rows, least, cover, most):
    counts = {}
    for _, text, lang in rows:
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    own[tuple(words[i : i + k])] += 1
    out = []
    for lang, own in counts.items():
        n = sum(c for p, c in own.items() if len(p) == 1)
        found = {p: c for p, c in own.items() if len(p) > 1 and c >= least}
        held = Counter()
        for p, c in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    held[p[i : i + k]] = max(held[p[i : i + k]], c)
        scored = []
        for p, a in found.items():
            if held[p] and 100 * held[p] >= cover * a:
                continue
            cuts = [(1000 * a * n // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def got_collocations(spark, rows, **options):
    return sorted(map(tuple, coll.collocations(table(spark, rows), **options).collect()))


def random_rows(seed, words, documents=60):
    rng = random.Random(seed)
    ends = [" ", "  ", "\t", ", ", ".", "! ", "\n", "\r", " ; "]
    rows = [(0, None, "a"), (None, "", None), (3, " . ,", "a"), (3, "one", None), (3, "one", None)]
    for i in range(documents):
        text = "".join(rng.choice(words) + rng.choice(ends[: rng.choice([2, 4, 9])]) for _ in range(rng.randint(1, 60)))
        rows.append((i, text, rng.choice(["a", "a", "b", None])))
    return rows


WORDS = ["The", "the", "of", "é", "Éa", "x\x0by", "über", "a-b", "日本", "q", "r\x1cs", "12"]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("cover", [100, 60])
def test_collocations_are_those_of_brute_force(spark, seed, cover, monkeypatch):
    rows = random_rows(seed, WORDS)
    want = plain_collocations(rows, 4, cover, 40)
    assert len(want) > 30
    assert got_collocations(spark, rows, least=4, cover=cover, most=40) == want
    monkeypatch.setattr(coll, "SHARD", 20)  # many tries
    assert got_collocations(spark, rows, least=4, cover=cover, most=40) == want


def test_all_tries_are_gone_through_in_one_pass(spark, monkeypatch):
    """More candidates make more tries, not more passes over the texts; with too many tries for one pass, nothing is lost either."""
    rows = random_rows(3, WORDS)
    want = plain_collocations(rows, 4, 100, 40)
    passes = []
    counts = coll._trie_counts
    monkeypatch.setattr(coll, "_trie_counts", lambda *a: passes.append(1) or counts(*a))
    monkeypatch.setattr(coll, "SHARD", 20)
    assert got_collocations(spark, rows, least=4, cover=100, most=40) == want
    assert len(passes) == 1
    monkeypatch.setattr(coll, "TRIES", 2)
    assert got_collocations(spark, rows, least=4, cover=100, most=40) == want
    assert len(passes) > 2


def test_collocations_of_one_hot_phrase_and_a_very_long_text(spark):
    """Runs of a text overlap by four words; nothing is counted twice or lost where they meet."""
    words = ["alpha", "beta", "gamma", "delta", "Epsilon"]
    rows = [(1, " ".join(words * 150_000), "en"), (2, "alpha beta. " * 50_000, "en")]  # 4.3 MB, no end of a piece
    n, a = 850_000, 200_000
    got = {r[2]: r[3:] for r in got_collocations(spark, rows, least=100)}
    assert got["alpha beta"] == (a, a, a, n, 1000 * a * n // a**2)
    assert got["epsilon alpha beta gamma delta"][0] == 149_999
    assert got["alpha beta gamma delta epsilon"] == (150_000, a, 150_000, n, 1000 * 150_000 * n // (a * 150_000))


def test_collocations_of_empty_tables(spark):
    assert got_collocations(spark, []) == got_collocations(spark, [(1, None, "a"), (None, "", None)]) == []


def test_pairs_of_rare_words_are_not_counted(spark):
    words = spark.createDataFrame(
        [("en", b"often", 9), ("en", b"rare", 2), ("de", b"rare", 8), ("de", b"often", 1)], "lang string, phrase binary, n long"
    )
    sieve = coll._word_sieve(words, 5)
    hashes = coll._Hashes()
    codes = [hashes.codes[w] for w in (b"often", b"rare", b".")]
    assert (hashes.frequent("en", sieve)[codes] > 0).tolist() == [True, False, False]
    assert (hashes.frequent("de", sieve)[codes] > 0).tolist() == [False, True, False]
    new = hashes.codes[b"new"]
    assert hashes.frequent("en", sieve)[new] == 0 and hashes.grown()[new] > 0


def test_trie_counts_every_phrase_once():
    rng = random.Random(5)
    words = [b"w%d" % i for i in range(40)]
    phrases = list({("en", b" ".join(rng.choices(words, k=rng.randint(2, 5)))) for _ in range(800)} | {("fr", b"w1 w2")})
    trie = coll.Trie(phrases)
    states = {int(s) for s in trie.ends}
    assert len(states) == len(phrases) and 0 not in states
    text = rng.choices(words, k=3000)
    out = np.bincount(trie.states("en", np.array([trie.symbols.get(w, -1) for w in text]), 0), minlength=len(trie.base))
    joined = b" " + b" ".join(text) + b" "
    for (lang, phrase), state in zip(phrases, trie.ends, strict=True):
        want = len(re.findall(b"(?= %s )" % phrase, joined)) if lang == "en" else 0
        assert out[state] == want


# --- SentencePiece --------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def encoded(text):
    model = sp.model(MODEL)
    words = model.words.findall(model.normalized(text))
    return [int(i) for ids in (model.encode_words(words) if words else []) for i in ids]


LETTERS = st.text(st.sampled_from("aabeehinorstt    \n\t▁½é①執梦ゼ\x00́😀<s>0x"), max_size=60)


@settings(max_examples=400, deadline=None)
@given(st.one_of(LETTERS, st.text(max_size=40)))
def test_ids_are_those_of_the_library(library, text):
    assert encoded(text) == library.encode(text)


@pytest.mark.parametrize(
    "text", ["", " " * 3000, "the" * 2000, "a" * 5001, "<s></s><unk><0x41>", "ab  cd\t" * 400, "執" * 1500 + "梦x" * 900]
)
def test_long_words_and_runs_of_blanks(library, text):
    assert encoded(text) == library.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([0, 1, 2, 28705, 259]), st.integers(3, 258), st.integers(0, 31999)), max_size=9))
def test_any_ids_decode_as_in_the_library(library, ids):
    runs = np.array([*ids, *ids], np.uint32)
    text, ends = sp.model(MODEL).decode(runs, np.array([0, len(ids), 2 * len(ids)]))
    assert text.decode() == library.decode(ids) * 2 and ends.tolist() == [0, len(text) // 2, len(text)]


def test_tables_of_texts_round_trip(spark, library):
    rows = [(1, "Hello  world ", "en"), (1, "Hello  world ", "en"), (None, None, None), (2, "", "x"), (3, "▁é①", None)]
    rows.append((4, "word " * 200_000, "en"))
    got = sp.encode(table(spark, rows), ["doc_id", "n"], "text", MODEL, decoded=True).collect()
    assert len(got) == len(rows)
    for row, (doc_id, text, _) in zip(sorted(got, key=str), sorted(rows, key=str), strict=False):
        assert row["n_tokens"] == len(row["ids"]) // 4
    by_text = {bytes(r["decoded"]).decode(): r for r in got}
    for _, text, _ in rows:
        want = library.encode(text or "", add_bos=True, add_eos=True)
        row = by_text[library.decode(want)]
        assert np.frombuffer(row["ids"], "<u4").tolist() == want
    bare = sp.encode(table(spark, rows[:1]), ["doc_id"], "text", MODEL, begin=False, end=False).first()
    assert np.frombuffer(bare["ids"], "<u4").tolist() == library.encode("Hello  world ")
    assert sp.encode(table(spark, []), ["doc_id"], "text", MODEL).count() == 0


def test_other_models_are_refused(tmp_path):
    piece = b"\n\x01a"  # a model of one piece and no rules
    (tmp_path / "m.model").write_bytes(b"\n" + bytes([len(piece)]) + piece)
    with pytest.raises(ValueError, match="only BPE"):
        sp.Model(str(tmp_path / "m.model"))


# --- spelling variants -----------------------------------------------------------------


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, least_letters, least_n, factor, slip):
    counts = Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_letters and n >= least_n}
    form, met = {}, {}
    for w in words:
        others = sorted((v for v in words if near(w, v)), key=lambda v: (-words[v], v))
        met[w] = len(others)
        if others and words[others[0]] >= factor * words[w]:
            form[w] = others[0]
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, met[w], words[form[w]] if w in form else None))
    return sorted(out, key=str)


def got_variants(spark, rows, *options):
    frame = spelling.spelling_variants(table(spark, rows), "doc_id", "text", *options)
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_are_those_of_brute_force(spark, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abÀé", k=rng.randint(3, 6))) for _ in range(25)]

    def word():
        w = base[min(int(rng.expovariate(0.2)), 24)]
        for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2, 3])):
            i = rng.randrange(len(w) + 1)
            w = w[:i] + rng.choice(["", "a", "b", "É", "ÿ"]) + w[i + rng.choice([0, 1]) :]
        return w

    rows = [(rng.choice([1, 22, -3, None]), " ".join(word() for _ in range(40)) + ".", "x") for _ in range(120)]
    rows += [(1, None, None), (1, "", "x"), (2, "12 ßß日 -", "x")]
    for slip in (None, 7):
        want = plain_variants(rows, 3, 2, 2, slip)
        assert got_variants(spark, rows, 3, 2, 2, slip) == want
        assert sum(r[1] is not None for r in want) > 20
    assert any(r[1] not in (None, r[2]) for r in plain_variants(rows, 3, 2, 2, None))  # chains of forms


def test_variants_of_runs_of_equal_letters_and_very_long_words(spark):
    long = "ab" * 60_000
    rows = [(1, "aaaaaa " * 50 + "aaaaaaa " * 9 + "aaaaaaaa " * 1, "x"), (2, f"{long} " * 8 + f"{long[1:]} ", "x")]
    got = got_variants(spark, rows, 6, 1, 5, None)
    assert [(r[0][:9], r[2][:7], r[3], r[4], r[5]) for r in got] == [
        ("aaaaaa", "aaaaaa", 50, 1, None),
        ("aaaaaaa", "aaaaaa", 9, 2, 50),
        ("aaaaaaaa", "aaaaaa", 1, 1, 9),
        ("ababababa", "abababa", 8, 1, None),
        ("babababab", "abababa", 1, 1, 8),
    ]


def test_variants_of_empty_tables_and_bad_factors(spark):
    assert got_variants(spark, []) == got_variants(spark, [(None, None, None), (1, "short", "x")]) == []
    with pytest.raises(ValueError, match="factor"):
        got_variants(spark, [], 6, 5, 1)


# --- registered queries beside their SQL --------------------------------------------------


@pytest.mark.parametrize("name", ["op11_phrase_collocations", "op13_spelling_variants"])
def test_queries_beside_their_sql(spark, name):
    from plumbline.llm import queries

    sf_dir = "/root/testdata/sf0.001"
    got = compare(spark, connect(sf_dir), name, queries.queries()[name], queries.oracle_sql()[name], sf_dir)
    assert got.startswith("ok"), got


def test_sentencepiece_query_is_the_library(spark, library):
    import hashlib

    from plumbline.llm import queries

    sf_dir = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.op12_sentencepiece(spark, sf_dir).collect()}
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(documents)
    for d in documents:
        ids = library.encode(d["text"] or "", add_bos=True, add_eos=True)
        row = got[d["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
