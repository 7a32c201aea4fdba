"""Language model, spelling variants and lexical search against plain versions, and their edge cases."""

import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import brute
from siftmark.llm import lexical_search as ls
from siftmark.llm import maxent_lm as lm
from siftmark.llm import spelling_variants as sv
from siftmark.llm import wordblocks as wb

SF_DIR = Path("/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables are not here")
WORDS = "the of and inonder theres onander erthing nation nations natoin anding ending lending".split()


def texts(n=120, seed=3):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 60)))) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


# Words in blocks

@pytest.mark.parametrize("size", [16, 64, 1 << 20])
def test_words_of_blocks(monkeypatch, size):
    monkeypatch.setattr(wb, "BLOCK_BYTES", size)
    values = ["", None, "One two", " a\tb\n" * 9, "Zé ü", "x" * 15, "  ", "ab " * 40, "end"]
    got = []
    for block in wb.word_blocks(pa.array(values), wb.SPACED):
        got += [(int(d), w) for d, w in zip(block.doc, block.words(np.arange(len(block.starts))).to_pylist())]
    assert got == [(k, w) for k, t in enumerate(values) for w in brute.PLAIN.findall(brute.lower(t))]


def test_a_long_word_is_known_by_its_digest(monkeypatch):
    monkeypatch.setattr(wb, "BLOCK_BYTES", 16)
    values = ["A" * 50 + " b", "b " + "a" * 50, "c" * 40]
    rows = [(int(d), h) for block in wb.word_blocks(pa.array(values), wb.SPACED) for d, h in zip(block.doc, block.hashes())]
    assert [d for d, _ in rows] == [0, 0, 1, 1, 2]
    assert rows[0][1] == rows[3][1] and rows[1][1] == rows[2][1] and len({h for _, h in rows}) == 3


# Language model

def base_scores(docs):
    tokens = {i: [*brute.PLAIN.findall(brute.lower(t)), None] for i, t in docs}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs}
    c = Counter(w for i, found in tokens.items() if not held[i] for w in found)
    n, v = sum(c.values()), len(c)
    return {i: (held[i], len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for i, w in tokens.items()}


def check_base(got, docs):
    want = base_scores(docs)
    assert len(got) == len(docs)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4], rel=1e-9)


@needs_tables
def test_language_scores_of_a_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = entry.queries()["op11_language_model"](spark, str(SF_DIR)).collect()
    check_base(got, docs)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("hot", [0, 5, 1 << 20])
def test_words_beyond_the_hot_ones_are_joined(spark, monkeypatch, hot):
    docs = texts()
    monkeypatch.setattr(lm, "HOT_WORDS", hot)
    check_base(lm.language_scores(frame(spark, docs)).collect(), docs)


def test_probabilities_sum_to_one(spark):
    """After any history, over all known words and one word that is unknown in each class."""
    docs = frame(spark, texts())
    rows = docs.selectExpr("doc_id _id", "text _text")
    words = lm.vocabulary(lm.written(lm.word_counts(rows)))
    model = lm.train(rows, words)
    features = lm.mix(np.arange(1, 8, dtype=np.uint64))[:, None] * np.array([1, 3, 5, 7], np.uint64)
    _, share, whole = lm.softmax_rows(model, features, lm.ROW_KEYS[lm.HEAD_CLASSES], words.class_log)
    assert (share / whole[:, None]).sum(axis=1) == pytest.approx(1, abs=1e-5)
    # within a head class no other outcome than its words; within a tail class its words and one share for all unknown ones
    for c in range(lm.HEAD_CLASSES):
        if np.isfinite(words.head_log[c]).any():
            _, share, _ = lm.softmax_rows(model, features, lm.ROW_KEYS[c], words.head_log[c])
            assert ((share > 0) == np.isfinite(words.head_log[c])).all()
    assert np.exp(words.class_log).sum() == pytest.approx(1, abs=1e-5)
    assert np.abs(model.weights).max() > 0


def test_rows_are_added(monkeypatch):
    rng = np.random.default_rng(2)
    for size in (1 << 10, 1 << 18):
        row = np.minimum(rng.zipf(1.3, 5000) * 37, size - 1)
        values = rng.random((5000, lm.WIDTH), dtype=np.float32)
        got, want = np.zeros((size, lm.WIDTH), np.float32), np.zeros((size, lm.WIDTH))
        lm.add_rows(got, row, values)
        np.add.at(want, row, values)
        assert got == pytest.approx(want, rel=1e-4)


def test_history_raises_the_probability_of_what_follows(spark):
    rng = random.Random(1)
    lines = [" ".join(f"{a} {a}x" for a in rng.choices(["la", "le", "lo", "lu"], k=40)) for _ in range(200)]
    got = lm.language_scores(frame(spark, list(enumerate(lines)))).collect()
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > 0.75 * sum(r.base_score for r in held)


def test_language_model_edge_cases(spark):
    cases = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (3, "c"), (None, "a"), (4, "a " * 5000), (5, "q" * 100_000)]
    got = lm.language_scores(frame(spark, cases).selectExpr("*", "1 _id", "'x' n", "2 score")).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len((t or "").split()) + 1 for _, t in cases)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    same = [r.score for r in got if r.doc_id == 3 and r.n_tokens == 3]
    assert same[0] == pytest.approx(same[1])
    assert lm.language_scores(frame(spark, [])).collect() == []


def test_without_training_texts_the_base_score_stands(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    [r] = lm.language_scores(frame(spark, [(held, "a b c")])).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (4, 0, 0, 0.0, 0.0)


def test_long_texts_are_read_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(wb, "BLOCK_BYTES", 256)
    docs = [(i, t * 3) for i, t in texts(40)]
    found = [(int(r), t.n_tokens) for r, t in enumerate(lm.language_scores(frame(spark, docs)).orderBy("doc_id").collect())]
    assert found == [(k, len(t.split()) + 1) for k, (_, t) in enumerate(docs)]


# Spelling variants

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def plain_neighbours(words):
    return {(a, b) for a in words for b in words if one_edit(a, b)}


def found_neighbours(spark, words):
    got = sv.neighbours(spark.createDataFrame([(w,) for w in words], "word string")).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


@pytest.mark.parametrize("seed", range(3))
def test_neighbours(spark, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abé" if seed else "ab") for _ in range(rng.randrange(6, 10))) for _ in range(250)}
    assert found_neighbours(spark, words) == plain_neighbours(words)


def test_neighbours_at_every_place(spark):
    word = "abcdefghij"
    words = {word} | {word[:k] + word[k + 1 :] for k in range(10)} | {word[:k] + "x" + word[k:] for k in range(11)} | {word[:k] + "y" + word[k + 1 :] for k in range(10)}
    words |= {"aaaaaa" + "a" * k for k in range(5)} | {"zé" * k for k in range(3, 6)} | {"é" * 7, "é" * 8}
    assert found_neighbours(spark, words) == plain_neighbours(words)


def test_hot_beginnings_are_split(spark, monkeypatch):
    monkeypatch.setattr(sv, "SALT_ROWS", 10)
    words = {"common" + a + b + c for a in "abcde" for b in "abc" for c in "xyz"}
    assert found_neighbours(spark, words) == plain_neighbours(words)


def test_long_words_and_none(spark):
    word = "ab" * 2000
    assert found_neighbours(spark, {word, word + "a", "b" + word}) == {(word, word + "a"), (word + "a", word), (word, "b" + word), ("b" + word, word)}
    assert found_neighbours(spark, set()) == set()


def plain_forms(docs, one_in=199):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = brute.lower(run)
            h = zlib.crc32(f"{i}:{run}".encode()) if i is not None else 1
            if h % one_in == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    near = {w: sorted((v for v in n if one_edit(w, v)), key=lambda v: (-n[v], v)) for w in n}
    form = {w: v[0] if v and n[v[0]] >= 5 * n[w] else None for w, v in near.items()}
    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n.get(form[w], 0)) for w in n)


def spelled(spark, docs):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in sv.spelling_forms(docs).collect())


def test_forms(spark, monkeypatch):
    docs = [(1, "nations " * 200 + "nation " * 30 + "natio " * 9 + "nattion " * 5), (2, "Nations NATIONX nationx, nationx;nationx nationx"), (None, "nations"), (3, None), (4, "")]
    docs += [(10 + k, "Éclairs éclairs éclairs") for k in range(4)] + [(4, "x" * 60_000)]
    assert spelled(spark, frame(spark, docs).selectExpr("*", "'a' word", "1 n", "true back")) == plain_forms(docs)
    assert sv.spelling_forms(frame(spark, [])).collect() == []


def test_forms_of_words_with_lost_letters(spark):
    docs = [(i, t + " " + t) for i, t in texts(400)]
    want = plain_forms(docs)
    assert any(f for _, f, *_ in want)
    assert spelled(spark, frame(spark, docs)) == want


# Lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, items):
    found = [(i, Counter(TERM.findall(brute.lower(t)))) for i, t in docs]
    size = sum(1 for _, c in found if c)
    total = sum(sum(c.values()) for _, c in found)
    df = Counter(w for _, c in found for w in c)
    out = []
    for item, text in items:
        terms, scores = TERM.findall(brute.lower(text)), []
        for i, c in found:
            m = 25 + 75 * sum(c.values()) * size // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * size + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in terms if c[w])
            scores.append((-s, i is not None, i))
        out += [(item, k, i, -s) for k, (s, _, i) in enumerate(sorted(scores)[:10], 1) if s < 0]
    return sorted(out)


def searched(spark, docs, items):
    got = ls.ranked_search(frame(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("sent", [0, 200_000])
def test_search(spark, monkeypatch, sent):
    monkeypatch.setattr(ls, "SENT_ROWS", sent)
    docs, items = texts(300), [(k, t[:80]) for k, t in texts(12, seed=9)]
    assert searched(spark, docs, items) == plain_search(docs, items)


def test_search_in_parts_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ls, "ITEMS", 5)
    monkeypatch.setattr(ls, "BLOCK_DOCS", 9)
    monkeypatch.setattr(ls, "SLOTS", 20)
    docs, items = texts(150), [(k, t[:80]) for k, t in texts(12, seed=9)]
    assert searched(spark, docs, items) == plain_search(docs, items)


def test_search_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "Nations of."), (3, "nations of nations"), (4, "nations " * 3000), (5, "?!"), (7, "nations of"), (6, "nations of"), (8, "é2 É2"), (9, "w" * 50_000)]
    items = [(1, "nations"), (2, None), (3, ""), (4, "unknown words"), (5, "of OF nations é2"), (6, "w" * 50_000)]
    assert searched(spark, docs, items) == plain_search(docs, items)
    assert searched(spark, [], items) == [] and searched(spark, docs, []) == []


@needs_tables
def test_bounds_are_no_lower_than_scores(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").selectExpr("doc_id _id", "text _text")
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    queries = ls.query_terms(items)
    index = ls.written(ls.scan(docs, queries.hashes))
    queries = ls.weighted(queries, index)
    every = ls.written(ls.not_excluded(index, queries, np.zeros(len(items), np.int64)))
    exact = {(r.q, r._id): r.score for r in ls.exact_scores(docs, every, queries).collect()}
    assert exact and len(exact) <= every.count()
    for r in index.where("rows > 0").collect():
        for low, bound in ls.bounds_of(queries, np.array(r.length), r.rows, bytes(r.matrix)):
            for q, column in zip(*np.nonzero(bound)):
                assert bound[q, column] >= exact.get((q + low, r.ids[column]), 0)
