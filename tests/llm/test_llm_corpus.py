"""Operators on whole corpora: repeats, similar documents, passages, benchmark items, vectors; the pipeline."""

import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
from plumbline.llm import decontamination, multi_index, ngram_join, passages, queries, repeats
from plumbline.llm.common import written
from plumbline.llm.components import components
from plumbline.llm.shingles import _BASE, _BYTES, _MIX, RUN_BYTES, mixed, shingles, word_hashes

DOCS = "doc_id long, text string, n_bytes string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS)


def prose(rng, n, words=4000):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


# --- components ---------------------------------------------------------------------


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 440)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- repeats -------------------------------------------------------------------------


def expected_repeats(texts, length):
    seen = {}
    for i, t in enumerate(texts):
        for j in range(len(t) - length + 1):
            seen.setdefault(t[j : j + length], []).append((i, j))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, j in places:
                gone[i][j : j + length] = True
    return gone


@pytest.mark.parametrize("limit", [128, 1])
def test_repeats_against_all_strings(spark, monkeypatch, limit):
    monkeypatch.setattr(repeats, "PHRASES", limit)  # 1: all phrases are cut into single stretches
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 500)
    rng = random.Random(6)
    shared = [prose(rng, 30).encode() for _ in range(3)]
    texts = [b"a" * 90, b"", "é".encode() * 40, b"xy" * 60, shared[0], shared[0], shared[0][:39], prose(rng, 300).encode()]
    for _ in range(25):
        parts = [prose(rng, rng.randrange(0, 25)).encode()]
        for s in rng.sample(shared, rng.randrange(0, 3)):
            at = rng.randrange(0, 60)
            parts += [s[at : at + rng.randrange(20, 90)], prose(rng, rng.randrange(0, 9)).encode()]
        texts.append(b" ".join(parts))
    docs = frame(spark, [(i, t.decode()) for i, t in enumerate(texts)] + [(None, None)])
    gone = expected_repeats(texts, 40)
    got = {r.doc_id: r for r in repeats.without_repeats(docs, length=40).collect()}
    for i, (t, g) in enumerate(zip(texts, gone, strict=True)):
        runs = int((np.diff(g.astype(int), prepend=0) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~g].tobytes()
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, bytes(got[i].kept)) == (len(t), g.sum(), runs, kept)
    assert (got[None].n_bytes, got[None].n_removed, bytes(got[None].kept)) == (0, 0, b"")


def test_a_passage_in_very_many_texts_is_not_cut_into_all_its_stretches(spark, monkeypatch):
    rng, rows = random.Random(11), []
    passage = prose(rng, 60)
    for i in range(60):
        rows.append((i, f"{prose(rng, rng.randrange(4, 20))} {passage} {prose(rng, rng.randrange(4, 20))}"))
    counts = {"phrases": 0, "parts": 0}

    def counted(df, name):
        out = written(df, name)
        if name in counts:
            counts[name] += out.count()
        return out

    monkeypatch.setattr(repeats, "PHRASES", 4)
    monkeypatch.setattr(repeats, "written", counted)
    got = {r.doc_id: r for r in repeats.without_repeats(frame(spark, rows), length=100).collect()}
    texts = [t.encode() for _, t in rows]
    for (i, _), text, gone in zip(rows, texts, expected_repeats(texts, 100), strict=True):
        assert bytes(got[i].kept) == bytes(c for c, g in zip(text, gone, strict=True) if not g)
        assert got[i].n_removed == gone.sum() > 0
    assert 0 < counts["parts"] < 60 * 100  # each text has two phrases at an edge of the passage, of some 80 stretches each
    assert counts["phrases"] < 60 * 50


def test_repeats_of_repeated_rows_and_empty_table(spark):
    docs = frame(spark, [(1, "z" * 10 + prose(random.Random(1), 100))] * 2)
    got = repeats.digest(docs).collect()
    assert [(r.n_removed == r.n_bytes, r.kept_sha256) for r in got] == [(True, hashlib.sha256(b"").hexdigest())] * 2
    assert repeats.digest(docs.limit(0)).count() == 0


# --- similar documents -----------------------------------------------------------------


def word_sets(texts):
    import re

    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


@pytest.mark.parametrize("short", [64, 2])
def test_similar_documents_against_all_pairs(spark, monkeypatch, short):
    monkeypatch.setattr(ngram_join, "SHORT", short)  # 2: nearly all lists are long
    monkeypatch.setattr(ngram_join, "LEADERS", min(short, 16))
    monkeypatch.setattr(ngram_join, "MEET_ROWS", max(short // 2, 3))  # tokens are dealt over several tasks
    rng = random.Random(7)
    texts = ["", None, "one", "One", "a b c d", "A b\tc  d", " ", "é É", prose(rng, 2000)]
    for _ in range(12):
        words = prose(rng, rng.randrange(20, 120)).split()
        for _ in range(rng.randrange(1, 9)):
            copy = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(99)}"
            texts.append(" ".join(copy))
    sets, root = word_sets(texts), list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    docs = frame(spark, [*enumerate(texts), (0, None), (None, texts[-1])])
    got = ngram_join.similar_documents(docs).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        elif r.doc_id:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), find(r.doc_id))
    assert ngram_join.similar_documents(docs.limit(0)).count() == 0


def test_outlines_tell_apart_sets_below_the_threshold():
    chance, n = np.random.default_rng(5), 400
    for share, possible in ((0.80, False), (0.86, True), (0.95, True)):  # 0.80: a similarity of 0.67
        for _ in range(20):
            values = chance.integers(0, 2**64, 2 * n, np.uint64)
            other = n - round(share * n)
            a, b = np.sort(values[:n]), np.sort(values[other : other + n])
            most = ngram_join._overlap_bound(ngram_join._outline(a), ngram_join._outline(b), n, n)
            assert most >= n - other
            assert ngram_join._enough(most, n, n, ngram_join.THRESHOLD) == possible


def test_outlines_are_short_and_tell_all_counts():
    draw = np.random.default_rng(5)
    for n in (1, 15, 16, 700, 20_000, 114_688, 114_689, 200_000):
        values = draw.integers(0, 2**64, n, np.uint64)
        outline = ngram_join._outline(values)
        counts = ngram_join._outline_counts(outline, n)
        bins = len(counts)
        assert counts.tolist() == np.bincount(values >> np.uint64(65 - bins.bit_length()), minlength=bins).tolist()
        assert len(outline) <= min(bins, (n + bins) // 8 + 1)
        assert ngram_join._overlap_bound(outline, outline, n, n) == n


def test_groups_of_unlike_documents(spark):
    rng = random.Random(3)
    # Few words: many short texts of one size share a first shingle, and are one group, but are not alike.
    texts = sorted({" ".join(rng.choice("ab") for _ in range(rng.choice([7, 7, 8]))) for _ in range(90)})
    sets, root = word_sets(texts), list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    got = ngram_join.similar_documents(frame(spark, enumerate(texts))).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(root))
    assert len(set(root)) > 20


def test_shingles_of_mixed_lengths():
    values, size = shingles([b"", b"a", b"a b c d e f", b" A  B\nc d e", b"x" * 5000])
    assert size.tolist() == [0, 1, 2, 1, 1] and values[1] == values[3] and len(set(values.tolist())) == 4
    assert shingles([b"a b"])[1].tolist() == [1] and shingles([])[1].tolist() == []


# --- passages ------------------------------------------------------------------------------


def test_repeated_passages(spark):
    rng = random.Random(8)
    passage = prose(rng, 60).split()
    near = list(passage)
    near[30] = "other"
    rows = [(i, prose(rng, 150)) for i in range(20)]
    rows += [(100, " ".join([prose(rng, 40), *passage, prose(rng, 30)])), (101, " ".join([*passage, prose(rng, 80)]))]
    rows += [(102, " ".join([prose(rng, 70), *near])), (103, " ".join(passage[:45]))]
    rows += [(200, prose(rng, 70))] + [(201, prose(random.Random(9), 70))] * 2 + [(300, None), (301, ""), (None, "a b")]
    got = passages.repeated_passages(frame(spark, rows)).collect()
    found = {}
    for r in got:
        found.setdefault(r.doc_id, set()).add((r.start, r.end, r.other_id))
    assert set(found) == {100, 101, 102, 201} and found[201] == {(0, 70, 201)}
    assert (40, 100, 101) in found[100] and (0, 60, 100) in found[101]
    assert any(r.doc_id == 102 and 0.75 <= r.similarity < 1 for r in got)
    assert passages.repeated_passages(frame(spark, rows).limit(0)).count() == 0


def test_passage_in_a_third_of_all_documents(spark):
    rng = random.Random(10)
    passage = prose(rng, 55)
    rows = [(i, f"{prose(rng, 60)} {passage} {prose(rng, 60)}" if i % 3 == 0 else prose(rng, 150)) for i in range(240)]
    got = passages.repeated_passages(frame(spark, rows)).collect()
    assert {r.doc_id for r in got if r.start <= 60 and r.end >= 115} == {i for i in range(240) if i % 3 == 0}
    assert len(got) < 240 * 20


def test_near_passages_against_definition(spark):
    rng = random.Random(16)
    texts = []
    for i in range(160):
        words = prose(rng, 52, 10**6).split()  # little more than one window under each function
        near = list(words)
        for at in [(26,), (0, 26)][i % 2]:
            near[at] = "other"
        texts += [" ".join(words), " ".join(near)]
    sets = word_sets(texts)
    for i in range(0, len(texts), 2):
        assert 0.75 <= len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) < 0.93
    got = passages.repeated_passages(frame(spark, enumerate(texts))).collect()
    assert {(r.doc_id, r.other_id) for r in got} == {(i, i ^ 1) for i in range(len(texts))}


def test_near_passages_beside_a_frequent_line(spark):
    """A line that stands in every text makes long lists of unlike windows; the few near copies in them are found."""
    rng = random.Random(18)
    line = "please read this note before you go on with the text".split()
    texts, wanted = [], set()
    for i in range(150):
        around = prose(rng, 90, 10**6).split()
        text = [*around[:30], *line, *around[30:]]
        texts.append(" ".join([*prose(rng, 20, 10**6).split(), *text]))
        if i % 6 == 0:  # the same passage, the line inside it, with a word changed
            near = list(text)
            near[rng.randrange(25)] = "other"
            texts.append(" ".join([*near, *prose(rng, 30, 10**6).split()]))
            wanted |= {(len(texts) - 1, len(texts) - 2), (len(texts) - 2, len(texts) - 1)}
    got = {(r.doc_id, r.other_id) for r in passages.repeated_passages(frame(spark, enumerate(texts))).collect()}
    assert got == wanted  # the line alone is too short


def test_near_passages_made_of_frequent_lines(spark):
    """Passages put together from two lines that stand in many texts are all met, though hardly a window has a rare centre."""
    rng = random.Random(19)
    lines = [prose(rng, 38, 10**6) for _ in range(24)]
    texts, wanted = [], set()
    for i, j in combinations(range(len(lines)), 2):
        at = len(texts)
        for _ in range(2):
            texts.append(" ".join([prose(rng, 25, 10**6), lines[i], lines[j], prose(rng, 25, 10**6)]))
        wanted |= {(at, at + 1), (at + 1, at)}
    got = {(r.doc_id, r.other_id) for r in passages.repeated_passages(frame(spark, enumerate(texts))).collect()}
    assert got == wanted  # one line alone is too short


def test_windows_of_one_text_alone_give_nothing(spark):
    """A text that says the same again and again makes long lists that hold no other text."""
    rows = [(list_ << 8, doc, place << 32) for list_, docs in ((1, [7]), (2, [7, 9]), (3, [5] * 3)) for doc in docs for place in range(20)]
    got = passages._joined(spark.createDataFrame(rows, "list long, doc long, place long").coalesce(1).sortWithinPartitions("list"))
    assert {r.token for r in got.where(f"kind = {passages._MEMBER}").collect()} == {2}


def test_pairs_of_windows_go_in_blocks(spark):
    """Pairs cost a task a row for each block, not for each pair; all of them arrive."""
    rows = [(list_ << 8, doc, 100 << 32 | 40 << 16 | 40) for list_ in range(300) for doc in range(16)]
    got = passages._joined(spark.createDataFrame(rows, "list long, doc long, place long").coalesce(1), 64)
    pairs = got.where(f"kind = {passages._PAIR}").select("block", "size", "numbers").toArrow()
    assert len(pairs) < 300 * 120 // 10
    found = np.concatenate([*passages._blocks(pairs.sort_by("block").to_batches(), 5)], axis=1)
    want = {(f, a, b) for f in range(8) for a, b in combinations(range(16), 2)}
    assert found.shape[1] == 300 * 120 and {*zip(*found[[0, 1, 3]].tolist(), strict=True)} == want


def test_stretches_against_definition():
    """Windows of two texts make one stretch where each overlaps one before it on nearly its diagonal."""
    rng = np.random.default_rng(22)
    some = 0
    for drift in (3, 12, 40):
        n = 400
        a, f, centre = rng.integers(0, 6, n), rng.integers(0, 8, n), rng.integers(50, 900, n)
        b = a + 10
        reach = rng.integers(19, 50, (2, n))
        place_a = centre << 32 | reach[0] << 16 | reach[1]
        place_b = centre + rng.integers(0, drift, n) << 32 | reach[0] << 16 | 60
        rows = np.stack([f, a, place_a, b, place_b])
        got = [*zip(*(x.tolist() for x in passages.aligned(rows, 3)), strict=True)]
        want = []
        for t in range(6):
            of_pair = [(c - i, c + j + 1, (y >> 32) - c, k) for k, x, c, i, j, y in zip(f, a, centre, *reach, place_b, strict=True) if x == t]
            spans = [tuple(map(int, x)) for x in sorted(of_pair)]
            want += [(t, *s[:2], t + 10, *s[2:]) for s in passages._stretches(iter(spans), 3)]
        assert sorted(got) == sorted((x, y, i, j, k, m) for x, i, j, y, k, m in want)
        some += len(got)
    assert some > 20


def test_words_across_runs_of_bytes():
    """A word's hash does not depend on where in a run of bytes it stands, nor on how many runs it takes."""
    rng = random.Random(23)
    words = ["".join(rng.choices("abcdefgh", k=n)) for n in (3, RUN_BYTES - 2, 5, RUN_BYTES, 2 * RUN_BYTES + 7, 1, 9)]
    for lead in ("", "x ", "xy \t"):
        values, starts = word_hashes(np.frombuffer((lead + " ".join(words)).encode(), np.uint8))
        alone = [word_hashes(np.frombuffer(b" " + x.encode(), np.uint8))[0][0] for x in words]
        assert values[len(lead.split()) :].tolist() == alone and len(starts) == len(lead.split()) + len(words)
    definition = 0
    for letter in words[3].encode():
        definition = (definition * int(_BASE) + int(_BYTES[letter])) % 2**64
    want = mixed(np.array([(definition + RUN_BYTES * int(_MIX)) % 2**64], np.uint64))[0]
    assert word_hashes(np.frombuffer(words[3].encode(), np.uint8))[0].tolist() == [want]


def test_likeliest_partners_against_definition():
    """Of a window's partners only as many as are compared are put in order, however many are as likely."""
    rng = np.random.default_rng(24)
    for most in (1, 4, 64):
        window = np.sort(rng.integers(0, 30, 2000))
        common = rng.integers(35, 40, 2000)
        got = passages.likeliest(window, common, most)
        want = [
            {(-c, i) for i, c in sorted(enumerate(common.tolist()), key=lambda p: (-p[1], p[0])) if window[i] == w} for w in range(30)
        ]
        assert all({*sorted(x)[:most]} <= {(-int(common[i]), i) for i in got.tolist()} for x in want)
        assert len(got) <= 30 * 2 * most


def test_outlines_of_windows_with_repeats():
    """A word said again and again is one shingle that two windows have in common, however often it stands there."""
    rng = random.Random(21)
    around = [[prose(rng, 1, 10**9) for _ in range(4)] for _ in range(2)]
    texts = [" ".join([*[a] * 30, *["same"] * 25, *[b] * 30, *[c, d] * 15]) for a, b, c, d in around]
    words = prose(rng, 70, 10**9).split()
    near = list(words)
    near[36] = "other"
    texts += [" ".join(words), " ".join(near), *[" ".join(["same", "again"] * 40)] * 2]
    values, size = shingles([x.encode() for x in texts])
    text = np.arange(len(texts))
    centre = np.array([31, 31, 30, 30, 30, 30])
    got = passages.surroundings(values, size, text, centre << 32 | np.minimum(centre, 45) << 16 | size - 1 - centre)
    begin = np.cumsum(size) - size
    for t, c in enumerate(centre.tolist()):
        of_text = values[begin[t] : begin[t] + size[t]].tolist()
        runs = [of_text[i : i + 46] for i in range(max(c - 45, 0), c + 1) if i + 46 <= size[t]]
        assert got[t, passages.AROUND] == min(len(set(x)) for x in runs)
        assert got[t, passages.AROUND + 1] == len(set(of_text[max(c - 45, 0) : c + 46]))
    x, y, _ = passages.met(passages.outlines(got), passages.outlines(got))
    assert {(i, j) for i, j in zip(x.tolist(), y.tolist(), strict=True) if i < j} == {(2, 3), (4, 5)}


def test_places_within_known_runs_against_definition():
    rng = np.random.default_rng(12)
    for share in (0.5, 0.7, 0.8, 0.9) * 10:
        size = rng.integers(0, 40, 5)
        known = rng.random(size.sum()) < share
        want = np.zeros(len(known), bool)
        for begin, n in zip((np.cumsum(size) - size).tolist(), size.tolist(), strict=True):
            for first in range(begin, begin + n):
                for end in range(first + 8, begin + n + 1):
                    if known[first:end].sum() >= 0.75 * (end - first):
                        want[first:end] = True
        assert passages.within_known(known, size, 8).tolist() == want.tolist()


def test_compact_windows_against_definition():
    rng = np.random.default_rng(11)
    values = (rng.integers(0, 40, 200) << 30).astype(np.uint64)  # with ties
    size = np.array([90, 0, 7, 103])
    got = list(zip(*(x.tolist() for x in passages.compact_windows(values, size, 8)), strict=True))
    expected, begin = [], 0
    for n in size:
        part = values[begin : begin + n].tolist()
        for c in range(n):
            low = c
            while low > 0 and part[low - 1] > part[c]:
                low -= 1
            high = c
            while high < n - 1 and part[high + 1] >= part[c]:
                high += 1
            if high - low + 1 >= 8:
                expected.append((begin + c, c - low, high - c))
        begin += n
    assert got == expected


# --- benchmark items --------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_contamination(spark):
    rng = random.Random(12)
    items = [(i, prose(rng, 25)) for i in range(12)] + [(50, None), (51, "short"), (52, prose(rng, 400)), (0, None)]
    rows, near = [], {}
    for i, text in items[:12]:
        copy = list(text)
        for _ in range(rng.randrange(0, 16)):
            at = rng.randrange(len(copy))
            copy[at : at + 1] = rng.choice(["", "q", copy[at] + "k"])
        near[i] = "".join(copy)
        rows.append((i, f"{prose(rng, rng.randrange(0, 30))} {near[i].upper()}  {prose(rng, 20)}"))
    rows += [(100 + i, prose(rng, 120)) for i in range(20)] + [(300, None), (301, ""), (302, "x" * 9000)]
    rows += [(400, "a " + "\n ".join(items[14][1].split(" ")))] * 2
    docs = frame(spark, rows)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = decontamination.contamination(docs, bench).collect()
    within = {i for i, t in items[:12] if distance(t, near[i].lower()) <= int(len(t) * decontamination.EDIT_RATE)}
    assert within <= {r.doc_id for r in got} <= set(range(12)) | {400}
    assert all(r.doc_id == r.item_id for r in got if r.doc_id < 400)
    texts = dict(rows)
    for r in got:
        if r.doc_id < 400:
            part = " ".join(texts[r.doc_id][r.start : r.end].lower().split())
            assert distance(dict(items[:12])[r.item_id], part) == r.edits
    assert {r.item_id for r in got if r.doc_id == 400} == {52}
    assert decontamination.contamination(docs, bench.limit(0)).count() == 0
    assert decontamination.contamination(docs.limit(0), bench).count() == 0


def test_long_documents_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "CHUNK_CHARS", 1000)
    rng = random.Random(13)
    item = prose(rng, 40)
    long = prose(rng, 1200)
    at = 997 - len(item) // 2
    batch = __import__("pyarrow").record_batch({"doc_id": [1], "text": [long[:at] + item + " " * 3000 + long[at:]]})
    index = decontamination.PassageIndex([(5, item)])
    assert [(x[1], x[2], x[3], x[4]) for x in decontamination._found(batch, index)] == [(5, at, at + len(item), 0)]


def test_copies_at_the_edges_of_documents():
    item = prose(random.Random(15), 30)
    texts = ["other words", item[1:] + " tail", item[2:], item[:-2], "x", item, item[3:] + item[:-1]]
    batch = __import__("pyarrow").record_batch({"doc_id": list(range(len(texts))), "text": texts})
    got = sorted(decontamination._found(batch, decontamination.PassageIndex([(5, item)])))
    n = len(item)
    expected = [(1, 0, n - 1, 1), (2, 0, n - 2, 2), (3, 0, n - 2, 2), (5, 0, n, 0)]
    expected += [(6, 0, n - 3, 3), (6, n - 3, 2 * n - 4, 1)]
    assert [(row, at, to, edits) for row, _, at, to, edits in got] == expected


def test_short_items():
    items = [(1, "Ab"), (2, "what is 12 plus 30"), (3, "capital city of france"), (4, " ")]
    texts = ["ab xaB", "What  is 12 plus 31?", "the capitl city of frence", "a b", "what is 15 plus 31", "a"]
    batch = __import__("pyarrow").record_batch({"doc_id": list(range(len(texts))), "text": texts})
    got = list(decontamination._found(batch, decontamination.PassageIndex(items)))
    assert {(row, item, edits) for row, item, _, _, edits in got} == {(0, 1, 0), (1, 2, 1), (2, 3, 2)}
    assert [(at, to) for row, _, at, to, _ in got if row == 0] == [(0, 2), (4, 6)]


# --- vectors ------------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [1024, 16])
def test_near_vectors_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(multi_index, "BLOCK_ROWS", block)  # 16: cells are cut into many blocks
    rng = np.random.default_rng(14)
    base = rng.standard_normal((40, 16))
    points = np.concatenate([rng.standard_normal((300, 16)), base[rng.integers(0, 40, 250)] + rng.normal(0, 0.12, (250, 16))])
    points = np.concatenate([points, points[:5], np.repeat(points[400:401], 60, axis=0)]).astype(np.float32)
    unit = points.astype(float) / np.linalg.norm(points.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    rows = [(i, x.tolist(), 0) for i, x in enumerate(points)]
    rows += [(9000, None, 0), (9001, [0.0] * 16, 0), (9002, [1.0, None] + [0.0] * 14, 0), (9003, [float("nan")] * 16, 0)]
    rows += [(9004, [float("inf")] + [0.0] * 15, 0), (9005, [], 0), (None, points[0].tolist(), 0), (9006, [1.0, 2.0], 0), (9007, [2.0, 4.0], 0)]
    frame_ = spark.createDataFrame(rows, "vec_id long, embedding array<float>, kept int")
    got = {r.vec_id: r for r in multi_index.near_duplicates(frame_).collect()}
    assert len(got) == len(rows)
    links = np.array([got[i].n_links for i in range(len(points))])
    assert (links <= near.sum(axis=1)).all() and links.sum() >= 0.9 * near.sum()
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(9000, 9006))
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)
    assert got[9007].component_id == 9006 and got[9006].n_links == 1
    whole = {got[i].component_id for i in range(len(points) - 60, len(points))}
    assert len(whole) == 1 and whole.pop() <= 400
    assert multi_index.near_duplicates(frame_.limit(0)).count() == 0


# --- the pipeline -----------------------------------------------------------------------------------


def without_passages(texts):
    """What is left of texts when runs of repeated strings that hold enough words go, by comparing all strings."""
    import corpus_pipeline as cp

    out = []
    data = [t.encode() for t in texts]
    for t, gone in zip(data, expected_repeats(data, cp.REPEATED_BYTES), strict=True):
        for a, b in np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).reshape(-1, 2):
            gone[a:b] = len(t[a:b].split()) >= cp.REPEATED_WORDS
        out.append(np.frombuffer(t, np.uint8)[~gone].tobytes().decode(errors="ignore").replace("�", ""))
    return out


def test_stage_removes_passages_of_over_fifty_words(spark):
    import corpus_pipeline as cp

    rng = random.Random(8)

    def words(n):
        return " ".join("".join(rng.choices("abcdeé", k=rng.randint(2, 8))) for _ in range(n))

    passage, short = words(51), words(40)
    long_words = " ".join("x" * 30 + str(i) for i in range(12))  # many bytes, few words
    texts = [f"{words(30)} {p} {words(30)}" for p in (passage, passage, short, short, long_words, long_words)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(None, texts[0], None, None, 1), (9, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in cp.without_repeats(spark, docs, "").collect()}
    assert len(got) == 8
    assert passage[:-1] not in got[1].text and got[1].text.startswith(texts[1][:150])
    assert [got[i].text for i in range(2, 6)] == texts[2:6]
    assert got[None].text == got[0].text == "" and got[9].text == "" and got[9].n_chars == 0  # a copied text goes whole
    assert got[1].n_chars == len(got[1].text)


def test_stages_on_odd_tables(spark, tmp_path):
    """Null ids, shared ids, repeated rows, null texts, no rows."""
    import corpus_pipeline as cp

    item = "The benchmark asks which of the seven answers is the right one of all, and why it is so."
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = "doc_id long, quality int, toxic int, text string, score string"
    told = [(1, 1, 1, "x", "x"), (2, 0, 0, "x", "x"), (3, 0, 0, "x", "x"), (3, 0, 0, "x", "x"), (None, 1, 1, "x", "x")]
    spark.createDataFrame(told, labels).write.parquet(f"{tmp_path}/labels.parquet")
    clean = [" ".join(f"{w}{i}" for i in range(20)) for w in ("red", "green", "blue")]
    bad = f"{clean[0]} {item} {clean[1]}"
    rows = [(None, bad), (5, bad), (5, clean[0]), (6, clean[1]), (6, clean[1]), (None, clean[2]), (None, None), (7, None), (8, "")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, None, "key", None) for i, t in rows], schema)
    got = cp.without_benchmark(spark, docs, str(tmp_path))
    assert got.columns == cp.COLUMNS
    want = sorted(str((i, t)) for i, t in rows if t != bad)
    assert sorted(str((r.doc_id, r.text)) for r in got.collect()) == want
    for name, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == {"ngram_jaccard_join": 8, "benchmark_decontamination": 7}.get(name, 9), name


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "bpe",
    ]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = corpus_pipeline.written(stage(spark, docs, sf_dir), f"test-{name}")
        assert out.columns == corpus_pipeline.COLUMNS
        after = {r.doc_id: r.text for r in out.collect()}
        assert set(after) <= set(before)
        if name == "ngram_jaccard_join":
            groups = {r.doc_id: r.component_id for r in ngram_join.similar_documents(docs).collect()}
            assert set(after) == {i for i, c in groups.items() if i == c} and after == {i: before[i] for i in after}
        if name == "suffix_array_dedup":
            want = without_passages([before[i] for i in sorted(before)])
            assert [after[i].replace("�", "") for i in sorted(before)] == want
        if name == "benchmark_decontamination":
            texts = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            assert not any(t in x for t in texts for x in after.values())
            assert all(any(t[:20] in before[i] or t[-20:] in before[i] for t in texts) for i in set(before) - set(after))
        docs = out
        seen.append(len(after))
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == seen[-1] <= seen[0]


def test_registered_queries():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert set(queries.oracle_sql()) <= set(names)
