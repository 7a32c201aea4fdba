"""Each operator against a plain version, and on nulls, empty and long texts, ties, repeats, clashing names."""

import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from siftmark.llm import decontaminate, jaccard_join, line_dedup, quality_rules, substring_dedup, textbatch, url_filter
from siftmark.llm.compression_quality import fit as fit_compression
from siftmark.llm.compression_quality import quality_scores
from siftmark.llm.labelled import labelled_sample
from siftmark.llm.packets import unpack
from siftmark.llm.piece_model import library, piece_model, public_model_path
from siftmark.llm.sentencepiece_codec import Codec, decoded, encoded
from siftmark.llm.token_counts import CountTransducer, token_counts
from siftmark.llm.toxicity import Matcher, folded, held_out_toxicity, learn_lexicon, toxicity_scores
from siftmark.llm.toxicity import fit as fit_toxicity

DOCS = "doc_id long, text string"
#: Names that operators use themselves, as extra columns.
CLASH = "doc_id long, text string, kept string, score int, n_words int, region int, part int, _id int, items string, gone int"


def words(rng, n, vocabulary=40):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed, n=40):
    """Random texts with copies, near copies, shared passages, nulls, empty and short texts."""
    rng = random.Random(seed)
    passage = words(rng, 30, 500)
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.25 and texts:
            base = rng.choice(texts) or ""
            w = base.split(" ")
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(99)}"
            texts.append(" ".join(w))
        elif kind < 0.35 and texts:
            texts.append(rng.choice(texts))
        elif kind < 0.5:
            texts.append(" ".join(words(rng, 10, 500) + passage + words(rng, 10, 500)))
        elif kind < 0.6:
            texts.append(rng.choice([None, "", " \n\t", "Uno", "ein ZWEI trois", "ein zwei trois quatre fünf"]))
        else:
            w = words(rng, rng.randrange(1, 120), rng.choice([3, 60, 5000]))
            texts.append("".join(x + rng.choice([" ", " ", "\n"]) for x in w).strip())
    return list(enumerate(texts))


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1, 2, 3, 4, 5, "it", 6) for i, t in rows], CLASH)


def sort(rows):
    return sorted(map(tuple, rows), key=lambda r: [(x is not None, str(x)) for x in r])


# words and lines of a batch

@pytest.mark.parametrize("limit", [1, 7, 1 << 20])
def test_slices_and_counts(limit):
    texts = [t for _, t in corpus(1)] + ["é\x0bñ  ü", "\n\n", "a\nb\na\n b", "|#|"]
    got = []
    for part in textbatch.slices(pa.array(texts, pa.string()), limit):
        counts = quality_rules.base_counts(part)
        got += list(zip(*(counts[k].tolist() for k in quality_rules.MEASURES if k in counts), strict=True))
    assert got == [brute.base_counts(t) for t in texts]


def test_hashes_do_not_depend_on_place():
    part = next(textbatch.slices(pa.array(["same word same", "a same"])))
    h = part.word_hashes()
    assert h[0] == h[2] == h[4] and len(set(h.tolist())) == 3


@pytest.mark.parametrize("size", [1, 3, 16, 64])
def test_hashes_do_not_depend_on_blocks(monkeypatch, size):
    """Words and lines that cross any number of blocks have the hashes that they have within one."""
    texts = pa.array([t for _, t in corpus(7)] + ["", "long" * 50 + " long" * 50, "\n\nend\n"], pa.string())

    def found(part):
        starts, ends, _ = part.lines()
        return [part.word_hashes().tolist(), part.word_hashes(1).tolist(), part.span_hashes(starts, ends).tolist()]

    want = [found(part) for part in textbatch.slices(texts, 1000)]
    monkeypatch.setattr(textbatch, "BLOCK_BYTES", size)
    assert [found(part) for part in textbatch.slices(texts, 1000)] == want


def test_memory_of_a_long_text():
    """Hashing needs memory for a block beside the places of words: 20 bytes for each byte of one text suffice."""
    rng = random.Random(3)
    text = pa.array([" ".join(f"word{rng.randrange(10**6)}" for _ in range(800_000))])
    part = next(textbatch.slices(text))
    part.word_hashes()
    tracemalloc.start()
    part = next(textbatch.slices(text))
    assert len(part.word_hashes()) == 800_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(part.data)


# 1 quality rules

def no_rules(threshold=-np.inf):
    size = quality_rules.WORD_BUCKETS + quality_rules.PAIR_BUCKETS
    return quality_rules.QualityRules(quality_rules.Multinomials(np.zeros(size), np.zeros(size)), threshold)


def test_quality_rules_cases(spark):
    rows = corpus(2) + [(None, "x " * 60), (3, "a b c"), (3, "a b c")]
    docs = clashing(spark, rows)
    got = quality_rules.quality_measures(docs, no_rules()).collect()
    want = [(i, *brute.base_counts(t)) for i, t in rows]
    assert sort(tuple(r)[:7] for r in got) == sort(want)
    assert all(r.kept != r.base_failed and r.llr == 0 for r in got)
    kept = quality_rules.keep_good(docs, no_rules())
    assert kept.columns == docs.columns and kept.count() == sum(not w[-1] for w in want)
    none = spark.createDataFrame([], DOCS)
    nobody = spark.createDataFrame([(None,)], "doc_id long")
    for ids in (nobody, nobody.where("false")):
        rules = quality_rules.learned_rules(docs, ids)
        assert rules.threshold == -np.inf and rules.counts.raw.sum() > 0
        assert sort(quality_rules.quality_measures(docs, rules).collect()) == sort(got)
    assert quality_rules.quality_measures(none, quality_rules.learned_rules(none, none.select("doc_id"))).collect() == []


def quality_corpus():
    good = [(i, " ".join(words(random.Random(i), 80, 300))) for i in range(60)]
    bad = [(1000 + i, " ".join(f"z{x}" for x in words(random.Random(i), 80, 300))) for i in range(30)]
    return good + bad + [(None, None), (5, ""), (1000, bad[0][1]), (1001, good[1][1]), (7, "too short")]


def test_quality_scores_and_threshold(spark):
    """Counts, scores, threshold and verdicts against a plain version, but for n-grams that share a bucket; alike with any partitions."""
    rows = quality_corpus()
    docs = clashing(spark, rows)
    ids = spark.createDataFrame([(i,) for i in [*range(40), 3, None, 999]], "doc_id long")
    counts, low, want = brute.quality(rows, set(range(40)))
    found = []
    for parts in (1, 5):
        rules = quality_rules.learned_rules(docs.repartition(parts), ids.repartition(parts))
        assert [rules.counts.target.sum(), rules.counts.raw.sum()] == counts
        assert rules.threshold == pytest.approx(low, abs=0.003)
        got = quality_rules.quality_measures(docs, rules).collect()
        assert [(r.doc_id, r.kept) for r in got] == [(i, kept) for i, _, kept in want]
        assert np.allclose([r.llr for r in got], [llr for _, llr, _ in want], atol=0.02)
        found.append((rules.threshold, sort(got)))
    assert found[0] == found[1]
    assert all(kept == (i is not None and (i < 60 or text == rows[1][1]) and len(text) > 50) for (i, _, kept), (_, text) in zip(want, rows, strict=True))
    left = quality_rules.keep_good(docs, rules)
    assert left.columns == docs.columns and sort((r.doc_id, r.text) for r in left.collect()) == sort(r for r, (_, _, kept) in zip(rows, want, strict=True) if kept)


def test_quality_target_has_every_good_document(spark):
    """More good documents than a former limit of 20,000, one row a document and label."""
    docs = spark.range(20_500).selectExpr("id AS doc_id", "concat('word', id) AS text")
    labels = spark.range(20_500).selectExpr("id AS doc_id", "1 AS quality").unionByName(spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, quality int"))
    good = quality_rules.trusted_ids(labels)
    counts = quality_rules.learned_rules(docs, good).counts
    assert good.count() == counts.target.sum() == counts.raw.sum() == 20_500 and (counts.target == counts.raw).all()


def test_quality_counts_are_one_shuffle(spark):
    plan = quality_rules.count_rows(spark.createDataFrame([("a b",)], "_text string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    n = np.array([0, 1, -3, 1 << 40])
    assert (quality_rules.unpacked(quality_rules.packed(n)) == n).all()


def test_quality_filter_misses_no_id(spark, monkeypatch):
    """With few and with far too few bits: counts are those of the trusted documents only."""
    docs = spark.range(3000).selectExpr("id AS _id", "concat('t', id) AS _text").unionByName(spark.createDataFrame([(None, "t"), (6, "u")], "_id long, _text string"))
    ids = docs.where("_id % 3 = 0").select("_id").distinct()
    for words in (quality_rules.FILTER_WORDS, 256, 1):
        monkeypatch.setattr(quality_rules, "FILTER_WORDS", words)
        found = {r._id for r in quality_rules.likely(docs, quality_rules.id_filter(ids)).collect()}
        assert found >= set(range(0, 3000, 3)) and None not in found and (len(found) == 3000) == (words == 1)
        counts = quality_rules.learned_counts(docs, ids, "_id", "_text")
        assert [counts.target.sum(), counts.raw.sum()] == [1001, 3002]


def test_quality_counts_take_one_pass_and_one_worker_a_task(spark, monkeypatch):
    """Without wrong ids both counts come from one job, with one Python step before and one after its shuffle."""
    docs = spark.createDataFrame([(1, "a b"), (1, "a"), (2, "a c"), (None, "a"), (4, None)], "_id long, _text string")
    plans, rows = [], quality_rules.count_rows

    def seen(*args):
        plans.append((found := rows(*args))._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(quality_rules, "count_rows", seen)
    counts = quality_rules.learned_counts(docs, docs.where("_id = 1").select("_id").distinct(), "_id", "_text")
    assert [counts.target.sum(), counts.raw.sum()] == [4, 8]
    assert [(p.count("MapInArrow"), p.count("Exchange")) for p in plans] == [(2, 1)]


def test_quality_hands_back_slices(monkeypatch):
    """Kept rows of a large batch leave a slice at a time, in their order and with all their columns."""
    text = " ".join(words(random.Random(1), 60, 60))
    rows = pa.record_batch({"k": list(range(500)), "text": [None if i % 9 == 0 else "short" if i % 7 == 0 else text for i in range(500)]})

    class Here:
        sparkSession = sparkContext = schema = property(lambda self: self)

        def broadcast(self, value):
            return SimpleNamespace(value=value)

        def mapInArrow(self, run, schema):
            return list(run(iter([rows.slice(0, 0), rows.slice(3)])))

    monkeypatch.setattr(textbatch, "SLICE_BYTES", 10 * len(text))
    found = quality_rules.keep_good(Here(), no_rules())
    assert len(found) > 20 and max(b.num_rows for b in found) <= 40
    assert pa.Table.from_batches(found).to_pylist() == [r for r in rows.slice(3).to_pylist() if r["text"] == text]


# 2 compression classifier

def test_compression_scores(spark):
    rows = [(i, " ".join(words(random.Random(i), 200, 300))) for i in range(60)]
    rows += [(100 + i, "### !! ".join(w.upper() for w in words(random.Random(i), 200, 300))) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    docs = clashing(spark, rows + [(None, None), (500, ""), (500, ""), (501, rows[0][1] * 50)])
    model = fit_compression(labelled_sample(docs, labels, "quality", 50, 1_000_000))
    got = quality_scores(docs, model).collect()
    assert len(got) == len(rows) + 4 and all(0 <= r.score <= 1 for r in got)
    score = {r.doc_id: r.score for r in got}
    assert sum((score[i] >= 0.5) == (i < 100) for i, _ in rows) >= 115
    assert score[500] == score[None]


def test_compression_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], DOCS)
    model = fit_compression(labelled_sample(docs, spark.createDataFrame([], "doc_id long, quality int"), "quality", 5, 100))
    assert [r.score for r in quality_scores(docs, model).collect()] == [0.5, 0.5]


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, "x" * 10) for i in range(50)], DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(None, 1), (3, None)], "doc_id long, quality int")
    assert labelled_sample(docs, labels, "quality", 10, 1000).count() == 20
    assert labelled_sample(docs, labels, "quality", 10, 45).count() == 8


def test_long_text_does_not_end_the_sample(spark):
    """Every place in the order is tried for the text that does not fit."""
    labels = spark.createDataFrame([(i, 1) for i in range(6)], "doc_id long, quality int")
    for long in range(6):
        docs = spark.createDataFrame([(i, "x" * (2000 if i == long else 10)) for i in range(6)], DOCS)
        got = {r._id for r in labelled_sample(docs, labels, "quality", 10, 1000).collect()}
        assert got == set(range(6)) - {long}


# 3 decontamination

@pytest.mark.parametrize("limit", [1 << 20, 0])
@pytest.mark.parametrize("seed", [3, 4])
def test_decontamination(spark, seed, limit):
    rows = corpus(seed) + [(None, "w1 w2 w3"), (7, "other text"), (7, "other text"), (7, "ein zwei trois")]
    items = [(0, rows[5][1]), (1, "Ein, zwei; TROIS"), (2, None), (3, "!!"), (10, " ".join(words(random.Random(seed), 14, 3)))]
    items += [(20 + k, t) for k, (_, t) in enumerate(corpus(seed + 10, 10))] + [(1, "uno")]
    docs = clashing(spark, rows)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, _words int")
    want = brute.decontaminate(rows, items)
    got = decontaminate.contamination(docs, bench, broadcast_bytes=limit).collect()
    assert sort((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == sort((i, *want[i, t]) for i, t in rows)
    left = decontaminate.uncontaminated(docs, bench, broadcast_bytes=limit)
    assert left.columns == docs.columns
    assert sort((r.doc_id, r.text) for r in left.collect()) == sort((i, t) for i, t in rows if not want[i, t][1])


def test_decontamination_of_nothing(spark):
    docs, none = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:3] for r in decontaminate.contamination(docs, none).collect()] == [(1, 2, 0)]
    assert decontaminate.contamination(docs.where("false"), none).collect() == []


# 4 line dedup

@pytest.mark.parametrize("size", [1, 2, 3])
def test_line_dedup(spark, size):
    rng = random.Random(size)
    lines = [f"line {k}" for k in range(12)] + ["", "  "]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 25)))) for i in range(25)]
    rows += [(30, rows[3][1]), (31, ""), (32, None), (33, "\n\n"), (34, "line 1\n" * 40)]
    docs = clashing(spark, rows)
    want = brute.line_dedup(rows, size)
    got = line_dedup.line_report(docs, min_lines=size).drop("longest_run").collect()
    assert sort(got) == sort(want)
    left = line_dedup.deduped_lines(docs, min_lines=size)
    assert left.columns == docs.columns
    stays = {i: kept for i, _, gone, kept in want if not gone or brute.PLAIN.search(kept)}
    assert sort((r.doc_id, r.text) for r in left.collect()) == sort((i, None if t is None else stays[i]) for i, t in rows if i in stays)


def test_line_dedup_cases(spark):
    text = "a b\nc d\ne"
    rows = [(2, text), (2, text), (None, text), (5, "x\na b\nc d"), (6, "a b"), (7, "a b")]
    got = sort(line_dedup.line_report(spark.createDataFrame(rows, DOCS)).select("doc_id", "n_removed", "kept_text").collect())
    assert got == sort([(2, 3, ""), (2, 3, ""), (None, 0, text), (5, 2, "x"), (6, 0, "a b"), (7, 0, "a b")])
    assert line_dedup.line_report(spark.createDataFrame([], DOCS)).collect() == []
    depths = line_dedup.lcp_intervals(spark.createDataFrame([(1, "a\nb\nc\nd"), (2, "a\nb\nc\nd"), (3, "c\nd")], DOCS))
    assert {k: v.count() for k, v in depths.items()} == {1: 10, 2: 7, 4: 2}


# 5 substring dedup

@pytest.mark.parametrize("seed", [5, 6])
@pytest.mark.parametrize("length", [20, 7])
def test_substring_dedup(spark, seed, length):
    rows = corpus(seed, 60)
    got = substring_dedup.substring_dedup(clashing(spark, rows), length=length).collect()
    assert sort(got) == sort(brute.substring_dedup(rows, length))


def test_substring_dedup_cases(spark):
    text = " ".join(f"t{k}" for k in range(30))
    rows = [(4, text), (4, text), (9, "y " + text), (None, text), (5, None), (6, "\x1c a\x85b")]
    got = sort(tuple(r)[:3] for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, DOCS)).collect())
    assert got == sort([(4, 30, 30), (4, 30, 30), (9, 31, 30), (None, 30, 0), (5, 0, 0), (6, 2, 0)])
    assert substring_dedup.substring_dedup(spark.createDataFrame([], DOCS)).collect() == []


def test_substring_dedup_in_small_slices(spark, monkeypatch):
    monkeypatch.setattr(textbatch, "SLICE_BYTES", 64)
    part = list(textbatch.slices(pa.array([t for _, t in corpus(8)], pa.string())))
    assert len(part) > 10 and sum(p.n for p in part) == 40


# 6 url filter

def test_url_trie():
    trie = url_filter.UrlTrie([*url_filter.RULES, ("block", "net", ""), ("allow", "net", ""), ("allow", "a.net", "/x"), ("block", "a.net", "/x/y")])
    match = lambda host, path: (trie.match(host, path) or (None,))[0]
    assert match("www.example.org", "/es/1") == "example.org/es/" and match("example.org", "/en/17") == "example.org/en/1"
    assert match("notexample.org", "/es/1") == "org/" and match("example.org", "/en/2") == "org/" and match("org", "") is None
    assert match("x.com", "/it/") is None and match("x.com", "/de/2") == "com/de/" and match("", "") is None
    assert trie.match("b.net", "/") == ("net", "block") and trie.match("c.a.net", "/x/yz") == ("a.net/x/y", "block")
    assert trie.match("a.net", "/xy") == ("a.net/x", "allow") and trie.match("a.net", "/q") == ("net", "block")


def test_url_cases(spark):
    rows = [(1, "http://WWW.Example.ORG/en/1?x"), (2, None), (3, "no scheme"), (4, "a://h://x"), (None, "http://x.com/fr/#f"), (1, "http://q.org#/"), (6, "http://É.org/")]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, verdict string")
    got = [tuple(r) for r in url_filter.url_verdicts(pages).collect()]
    assert sort(got) == sort([
        (1, "www.example.org", "/en/1", "example.org/en/1", "block"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
        (4, "h:", "//x", None, "allow"), (None, "x.com", "/fr/", "com/fr/", "allow"), (1, "q.org", "", None, "allow"),
        (6, "É.org", "/", "org/", "allow")])
    with pytest.raises(ValueError, match="deal them by host"):
        url_filter.UrlTrie(("block", "x" * (1 << 20), "/") for _ in range(300))


# 7 and 8 tokenizers

TEXTS = ["", " ", "  ", "a\n\n b  ", "▁x y", "\t\t a", "😀é\x00z", "   lead", "trail   ", "<s>hi</s><0x0A>", "日本語 テスト\r\n", " " * 40 + "x", "x" * 300,
         "The quick brown fox. " * 30]


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 50, 1 << 16])
def test_transducer_counts(chunk):
    machine, lib = CountTransducer(public_model_path()), library(public_model_path())
    assert [machine.tokens(t, chunk) for t in TEXTS] == [len(lib.encode(t)) for t in TEXTS]


def test_transducer_table_is_bounded(monkeypatch):
    import siftmark.llm.token_counts as module

    monkeypatch.setattr(module, "TABLE_UNITS", 3)
    machine, lib = CountTransducer(public_model_path()), library(public_model_path())
    text = "one two three four five six seven one"
    assert machine.tokens(text) == len(lib.encode(text)) and len(machine.emits) <= 3


def test_token_count_cases(spark):
    rows = [(1, None), (1, "a b"), (None, "a b"), (2, "x " * 5000)]
    got = sort(tuple(r) for r in token_counts(clashing(spark, rows)).collect())
    n = len(library(public_model_path()).encode("x " * 5000))
    assert got == sort([(1, 0, 0, False), (1, 3, 2, False), (None, 3, 2, False), (2, 10000, n, True)])


def test_streaming_viterbi():
    codec = Codec(public_model_path())
    model = piece_model(public_model_path())
    for text in TEXTS:
        ids = codec.encode(text).tolist()
        assert ids == brute.viterbi(model, text)
        assert codec.decode(ids).decode() == text.replace("▁", " ")
    rng = random.Random(1)
    for _ in range(30):
        unit = "".join(rng.choice("aeinrst▁日é") for _ in range(rng.randrange(1, 400))).replace("▁", "")
        out = [i for k in range(0, len(unit), 5) for i in codec.stream.push(unit[k : k + 5])]
        assert len(codec.stream.text) < len(unit) or len(unit) < 40  # ids were committed on the way
        out += codec.stream.finish()
        assert out == np.frombuffer(codec.unit_ids(unit), np.int32).tolist()


def test_codec_cases(spark):
    rows = [(1, None), (1, "a b"), (None, "a b"), (2, "▁")]
    got = encoded(clashing(spark, rows))
    found = sort((r.doc_id, r.n_ids, r.exact) for r in got.collect())
    assert [r[1] for r in found][-1] >= 1 and (2, False) in [(r[0], r[2]) for r in found]
    assert sort(decoded(got).collect()) == sort([(1, ""), (1, "a b"), (None, "a b"), (2, " ")])


# 9 Jaccard join

@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 50)])
def test_jaccard(spark, n, percent):
    rows = corpus(n, 70)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(clashing(spark, rows), shingle=n, percent=percent).collect()}
    assert got == brute.jaccard(rows, n, percent)


def family(size):
    """One text with few changed words, so that links chain through pivots."""
    rng = random.Random(9)
    base = words(rng, 90, 5000)
    out = []
    for i in range(size):
        w = base[:]
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = f"y{rng.randrange(999)}"
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize(("limit", "block"), [(900, 10), (3000, 60)])
def test_jaccard_splits_large_regions(spark, limit, block):
    rows = family(120)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           jaccard_join.jaccard_components(spark.createDataFrame(rows, DOCS), shingle=2, percent=85, max_region=limit, block=block).collect()}
    assert got == brute.jaccard(rows, 2, 85)


@pytest.mark.parametrize(("n", "percent"), [(5, 80), (2, 50)])
def test_jaccard_seeds_large_regions_again(spark, n, percent):
    """Every region counts as large."""
    rows = corpus(n, 70)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           jaccard_join.jaccard_components(clashing(spark, rows), shingle=n, percent=percent, max_region=1).collect()}
    assert got == brute.jaccard(rows, n, percent)


def test_common_phrases_make_no_large_region(spark, monkeypatch):
    """Documents that only common phrases chain are not dealt to pivots, which don't separate them."""
    rng = random.Random(3)
    phrases = [f"p{k}a p{k}b p{k}c" for k in range(12)]
    rows = []
    for i in range(90):
        own = [f"d{i}x{k}" for k in range(40)]
        rows.append((2 * i, " ".join(own + rng.sample(phrases, 8))))
        if i % 9 == 0:
            rows.append((2 * i + 1, " ".join([*own[:-1], "z", *rows[-1][1].split()[40:]])))
    monkeypatch.setattr(jaccard_join, "split_regions", lambda *_: pytest.fail("a region was not split by its rare shingles"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           jaccard_join.jaccard_components(spark.createDataFrame(rows, DOCS), shingle=2, percent=80, max_region=1000).collect()}
    want = brute.jaccard(rows, 2, 80)
    assert got == want and sum(i != c for i, (_, c) in want.items()) == 10


def test_common_phrases_chain_no_seeds(spark):
    """Few documents meet that have no link; copies are named, and their texts are not sent."""
    rng = random.Random(3)
    phrases = [f"p{k}a p{k}b p{k}c p{k}d" for k in range(30)]
    rows, near, copies = [], set(), set()
    for i in range(90):
        own = [f"d{i}x{k}" for k in range(150)]
        rows.append((3 * i, " ".join(own + rng.sample(phrases, 10))))
        if i % 9 == 0:
            rows.append((3 * i + 1, " ".join([*own[:-1], "z", *rows[-1][1].split()[150:]])))
            near |= {3 * i, 3 * i + 1}
        if i % 10 == 0:
            rows.append((3 * i + 2, rows[-1 if i % 9 else -2][1]))
            copies.add((3 * i, 3 * i + 2))
    docs = spark.createDataFrame(rows, "_id long, _text string").repartition(5)
    met = jaccard_join.seed_meetings(docs, 2, 80, 4).collect()
    meet = {x for r in met if r.kind == 1 for x in (r.a, r.b)}
    assert near <= meet and len(meet - near) < 20
    assert {(r.a, r.b) for r in met if r.kind == 3} == copies
    assert sorted((r.a, r.b) for r in met if r.kind == 0) == sorted((i, n) for i, (n, _) in brute.jaccard(rows, 2, 80).items())


def test_linked_documents_keep_a_signature():
    """Of linked sets, and of rows that share an id, also where most signatures are frequent."""
    rng = random.Random(6)
    for percent in (50, 80, 95):
        common = [[rng.getrandbits(63) for _ in range(rng.randrange(2, 30))] for _ in range(25)]
        sets = []
        for i in range(0, 240, 3):
            base = [rng.getrandbits(63) for _ in range(rng.randrange(1, 200))] + [v for c in rng.sample(common, rng.randrange(6)) for v in c]
            for k in range(3):
                lost = int(len(base) * (100 - percent) / 100 * rng.random() ** 2)
                sets.append((i + k, sorted({*rng.sample(base, len(base) - lost), *(rng.getrandbits(63) for _ in range(rng.randrange(2)))})))
        sets += [(i + 3, s) for i, s in sets[::17]] + [(1000 + i, s) for i, s in sets[::13]]
        ids, values = np.array([i for i, _ in sets]), [np.array(s, np.uint64) for _, s in sets]
        edges = np.append(0, np.cumsum([len(v) for v in values]))
        sigs, of, held, code, wanted = jaccard_join.grouped_signatures(np.concatenate(values), edges, percent)
        heads = wanted.astype(np.uint64) | (code.astype(np.uint64) << jaccard_join.CODE)
        x = {"sig": np.concatenate([np.diff(edges).astype(np.uint64), sigs, heads]), "doc": np.concatenate([ids, ids[of], ids[held]]),
             "kind": np.repeat(np.array([0, 4, 5], np.int8), [len(ids), len(sigs), len(heads)])}
        x["more"] = np.zeros(len(x["sig"]), np.uint64)
        for step, kinds in ((jaccard_join.shared_signatures, jaccard_join.SHARED), (jaccard_join.rare_signatures, jaccard_join.MET)):
            x = unpack(pa.Table.from_batches(step(x, 1)), kinds)
        signed, copy = x["kind"] == 4, x["kind"] == 3
        a, b = jaccard_join.meeting_edges(x["sig"][signed], x["doc"][signed])
        label = {int(i): int(i) for i in ids}
        for i, j in [*zip(a.tolist(), b.tolist(), strict=True), *zip(x["sig"][copy].tolist(), x["doc"][copy].tolist(), strict=True)]:
            label = {k: label[i] if v == label[j] else v for k, v in label.items()}
        for m, (i, s) in enumerate(sets):
            for j, t in sets[:m]:
                both = len(set(s) & set(t))
                assert 100 * both < percent * (len(s) + len(t) - both) or label[i] == label[j]
        assert signed.sum() < 0.7 * len(sigs)


def test_linked_documents_meet_in_their_prefixes(spark):
    """Also where rows share an id; prefixes hold no more than they need."""
    rng = random.Random(8)
    sets = {}
    for i in range(0, 60, 3):
        base = [rng.getrandbits(63) for _ in range(rng.randrange(1, 60))]
        for k in range(3):
            sets[i + k] = set(base[: len(base) - rng.randrange(1 + len(base) // 4)]) | {rng.getrandbits(63) for _ in range(rng.randrange(3))}
    rows = [(7, i, np.array(sorted(s), np.uint64).tobytes()) for i, s in sets.items()]
    rows.append((7, 1000, np.array([1, 2, 3], np.uint64).tobytes()))
    rows.append((7, 1000, rows[0][2]))
    nodes = spark.createDataFrame(rows, "region long, _id long, set binary")
    label = {r.node: r.component for r in jaccard_join.components(jaccard_join.prefix_meetings(nodes, 80, 4)).collect()}
    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and 100 * len(a & b) >= 80 * len(a | b):
                assert label[i] == label[j]
            elif i // 3 != j // 3:
                assert label.get(i, -1) != label.get(j, -2)
    assert label[1000] == label[0]


def test_region_join_recursion():
    rows = [(i, t) for k in range(4) for i, t in [(1000 * k + i, t.replace("w", f"q{k}")) for i, t in family(80)]]
    part = next(textbatch.slices(pa.array([t for _, t in rows])))
    values, edges = jaccard_join.shingle_sets(part, 2)
    blobs = [values[i:j].tobytes() for i, j in zip(edges[:-1], edges[1:], strict=True)]
    a, b = jaccard_join.join_regions(np.zeros(len(rows), np.int64), np.array([i for i, _ in rows]), blobs, 85)
    want = {i: c for i, (_, c) in brute.jaccard(rows, 2, 85).items() if i != c}
    assert dict(zip(b.tolist(), a.tolist(), strict=True)) == want


def test_linked_sets_share_a_slice():
    rng = random.Random(4)
    for _ in range(300):
        size, percent = rng.randrange(1, 150), rng.choice([60, 80, 85, 95])
        x = {rng.getrandbits(63) for _ in range(size)}
        y = set(x)
        while True:
            z = set(y)
            z.discard(rng.choice(sorted(z))) if rng.random() < 0.5 and len(z) > 1 else z.add(rng.getrandbits(63))
            if 100 * len(x & z) < percent * len(x | z):
                break
            y = z
        values = np.concatenate([np.sort(np.array(list(s), np.uint64)) for s in (x, y)])
        sigs, docs = jaccard_join.slice_signatures(values, np.array([0, len(x), len(x) + len(y)]), percent)
        assert set(sigs[docs == 0].tolist()) & set(sigs[docs == 1].tolist())


def test_jaccard_cases(spark):
    text = " ".join(f"t{k}" for k in range(40))
    rows = [(5, text), (5, text), (7, text + " z"), (None, text), (8, None), (9, ""), (10, "Ab"), (11, "aB")]
    docs = clashing(spark, rows)
    got = sort(jaccard_join.jaccard_components(docs).collect())
    assert got == sort([(5, 36, 5), (5, 36, 5), (7, 37, 5), (None, 36, None), (8, 0, 8), (9, 0, 9), (10, 1, 10), (11, 1, 10)])
    left = jaccard_join.one_of_each(docs)
    assert left.columns == docs.columns and sort((r.doc_id,) for r in left.collect()) == sort([(5,), (5,), (None,), (8,), (9,), (10,)])
    assert jaccard_join.jaccard_components(spark.createDataFrame([], DOCS)).collect() == []


# 10 toxicity

def test_folding():
    assert folded("You 1D10T, ｆｏｏ м0r0n$ $tupid!! x2") == " you idiot foo moron stupid x "


def test_matcher_exceptions_and_length():
    m = Matcher({" ciown ": 5.0, " ciow": 4.0, " scum": 5.0})
    assert m.features("a clown") > m.features("a clown " + "word " * 50) > m.features("a word") == (0.0, 0.0)
    assert m.features("the clown fish swims") == (0.0, 0.0) and m.features("clown. fish SCUM!")[1] > 0
    assert m.features("") == (0.0, 0.0) and Matcher({}).features("clown") == (0.0, 0.0)


def test_toxicity_learns(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        w = words(rng, 60, 200)
        if i % 4 == 0:
            w[rng.randrange(60)] = rng.choice(["nasty", "N4sty", "vilest", "vilely"])
        rows.append((i, " ".join(w)))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    docs = clashing(spark, rows + [(None, None), (900, ""), (901, "so NASTY"), (901, "so NASTY")])
    got = held_out_toxicity(docs, labels).collect()
    assert len(got) == 304
    right = [r.predicted == int(r.doc_id % 4 == 0) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert sum(right) >= 0.95 * len(right)
    by_id = {r.doc_id: r for r in got}
    assert by_id[900].predicted == 0 and by_id[901].predicted == 1 and by_id[None].predicted == 0


def test_toxicity_learns_the_long_tail(spark):
    """A term in 12 of 1,500 toxic documents and in no clean one has a weight; what both classes share has none."""
    rows = [(i, f"some plain text {'hateful' if i < 1488 else 'grimble'} here") for i in range(1500)]
    rows += [(i, f"some plain text number {i} here") for i in range(1500, 3000)]
    sample = spark.createDataFrame([(int(i < 1500), t) for i, t in rows], "_label int, _text string")
    lexicon = learn_lexicon(sample)
    assert lexicon[" grimbie "] > 3 and lexicon[" hatefui "] > lexicon[" grimbie "]
    assert not {" some ", " piain ", " here "} & lexicon.keys()


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], DOCS)
    model = fit_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r.score < 0.5 for r in toxicity_scores(docs, model).collect())
    assert toxicity_scores(docs.where("false"), model).collect() == []
