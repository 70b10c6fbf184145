"""Learned operators: language identification, quality, language model."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stockflow.llm import ctw, langid, quality
from stockflow.llm.common import prepare
from tests.llm.common import SF_DIR, documents, fold, odd_texts, prose, rows_of


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    prepare(spark)
    return documents(spark, rows_of(odd_texts()) + [(None, "no id", "en", "s", 5)], clashing=True)


# Language identification


def test_held_out_languages_are_right(docs):
    found = langid.identify(docs, langid.train(langid.training_rows(docs))).join(docs, "doc_id").where(fold_is(4, 2)).select("lang", "lang_pred").collect()
    assert len(found) > 200
    assert sum(r.lang == r.lang_pred for r in found) >= 0.98 * len(found)


def fold_is(n, k):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n == k


def test_languages_of_odd_rows(odd):
    model = langid.train(odd)
    assert model.langs == ["de", "en", "fr"]
    found = langid.identify(odd, model).collect()
    assert len(found) == odd.count()
    for r in found:
        assert 0 <= r.score <= 1
        if r.doc_id in (0, 1, 2):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred in model.langs
    kept = langid.in_known_language(odd, model)
    assert kept.columns == odd.columns
    assert {0, 1, 2}.isdisjoint(r.doc_id for r in kept.collect())
    assert langid.identify(odd.limit(0), model).count() == 0
    untaught = langid.train(odd.limit(0))
    assert {r.lang_pred for r in langid.identify(odd, untaught).collect()} == {"und"}


def test_backoff_goes_from_words_to_shorter_grams():
    counts = {"a": {(0, "haus"): 9, (-1, ""): 10, (1, "h"): 5, (-2, ""): 36}, "b": {(0, "maison"): 8, (-1, ""): 10, (3, "ais"): 4, (-4, ""): 40}}
    model = langid.Model(counts)
    assert model.predict("Haus haus")[0] == "a"
    known = model.unseen("xaisx")
    assert known == pytest.approx([math.log(0.5 / 1), math.log(4 / 40)])
    assert model.unseen("hx") == pytest.approx([math.log(5 / 36), math.log(0.5 / 1)])
    assert model.unseen("zz") is None
    assert model.predict("zz") == ("a", 0.5)


def language_by_force(sample, text):
    """Language and score of a text, counted and added up word by word from ``sample``, rows of (lang, text)."""
    counts = {}
    for lang, learned in sample:
        own = counts.setdefault(lang, [Counter() for _ in range(langid.MAX_N + 1)])
        for word in re.findall(r"[^\W\d_]+", learned.lower()):
            own[0][word] += 1
            for n in range(1, langid.MAX_N + 1):
                marked = f"^{word}$" if n > 1 else word
                own[n].update(marked[i : i + n] for i in range(len(marked) - n + 1))
    totals = {lang: [sum(c.values()) for c in own] for lang, own in counts.items()}
    least = [langid.WORD_SHARE] + [langid.GRAM_SHARE] * langid.MAX_N
    model = {lang: [{k: c for k, c in own[n].items() if c >= totals[lang][n] * least[n]} for n in range(langid.MAX_N + 1)] for lang, own in counts.items()}

    def row(n, key):
        if not any(key in own[n] for own in model.values()):
            return None
        return [math.log((model[lang][n][key] if key in model[lang][n] else 0.5) / totals[lang][n]) for lang in sorted(model)]

    total = [0.0] * len(model)
    words = re.findall(r"[^\W\d_]+", text.lower())
    for word in words:
        rows = [row(0, word)]
        for n in range(langid.MAX_N, 0, -1):
            if any(rows):
                break
            marked = f"^{word}$" if n > 1 else word
            rows = [row(n, marked[i : i + n]) for i in range(len(marked) - n + 1)]
        rows = [r for r in rows if r]
        for j in range(len(total)):
            total[j] += sum(r[j] for r in rows) / len(rows) if rows else 0.0
    if not words:
        return "und", 0.0
    best = total.index(max(total))
    return sorted(model)[best], 1 / sum(math.exp(t - total[best]) for t in total)


def test_whole_texts_equal_the_plain_count(docs, odd):
    rows = [r for r in docs.orderBy("doc_id").limit(120).collect() if r.text] + [r for r in odd.collect() if r.text and r.doc_id not in (None, 5)]
    sample = [(r.lang, r.text) for r in rows if r.lang is not None and r.doc_id % 2]
    own = docs.sparkSession.createDataFrame([(r.doc_id, r.text, r.lang) for r in rows], "doc_id long, text string, lang string").repartition(3)
    model = langid.train(own.where("doc_id % 2 = 1"))
    texts = {r.doc_id: r.text for r in rows}
    found = {r.doc_id: r for r in langid.identify(own, model).collect()}
    for doc_id in sorted(texts)[:40] + sorted(texts)[-6:]:
        if sum(r.doc_id == doc_id for r in rows) == 1:
            lang, score = language_by_force(sample, texts[doc_id])
            assert (found[doc_id].lang_pred, found[doc_id].score) == (lang, pytest.approx(score, abs=1e-9))


def test_pieces_are_scored_as_their_words_are():
    counts = {"a": {(0, "haus"): 9, (-1, ""): 10, (1, "h"): 5, (-2, ""): 36}, "b": {(0, "maison"): 8, (-1, ""): 10, (3, "ais"): 4, (-4, ""): 40}}
    texts = ["", " 12 ", "haus-maison\tHAUS", "zz haus", "xaisx,hx", "haus\x1cmaison", "\u00a0haus\u3000", "_haus9maison"]
    one, many = [], langid.Model(counts).predict_all(pa.array(texts * 3))
    for text in texts * 3:
        model = langid.Model(counts)
        total = sum((r for r in (model.unseen(w) for w in langid.words_of(text)) if r is not None), np.zeros(2))
        one.append((model.langs[int(total.argmax())] if langid.words_of(text) else "und", 1 / np.exp(total - total.max()).sum() if langid.words_of(text) else 0.0))
    assert many[0] == [lang for lang, _ in one] and many[1].tolist() == pytest.approx([score for _, score in one])


# Quality


def test_held_out_quality(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(docs, quality.training_labels(labels))
    found = quality.score_texts(docs, model).join(labels, "doc_id").where(fold_is(4, 2)).collect()
    good, bad = [r.score for r in found if r.quality == 1], [r.score for r in found if r.quality == 0]
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) >= 0.95 * len(good) * len(bad)
    assert sum(r.predicted == r.quality for r in found) >= 0.93 * len(found)
    assert all(r.predicted == int(r.score >= 0.7) for r in found)


def test_quality_of_odd_rows_and_labels(spark, odd):
    labels = spark.createDataFrame([(5, 1), (9, 0), (9, 0), (10, None), (None, 1), (77, 1), (3, 5)], "doc_id long, quality int")
    model = quality.train(odd, labels)
    found = quality.score_texts(odd, model).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    scores = {r.doc_id: r.score for r in found}
    assert scores[5] > scores[9] and scores[0] == scores[1] == scores[2]
    kept = quality.good_texts(odd, model, threshold=0.0)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    untaught = quality.train(odd, labels.limit(0))
    assert {r.score for r in quality.score_texts(odd, untaught).collect()} == {0.5}
    assert quality.score_texts(odd.limit(0), model).count() == 0


def test_updates_follow_the_formula():
    leader = quality.Leader(alpha=0.5, beta=1.0, l1=0.01, l2=0.2)
    z = n = 0.0
    for x, label in [(1.0, 1), (0.5, 0), (2.0, 1), (1.0, 1)]:
        w = 0.0 if abs(z) <= 0.01 else (math.copysign(0.01, z) - z) / ((1 + math.sqrt(n)) / 0.5 + 0.2)
        assert leader.weights(np.array([3]))[0] == pytest.approx(w)
        g = (1 / (1 + math.exp(-w * x)) - label) * x
        z += g - (math.sqrt(n + g * g) - math.sqrt(n)) / 0.5 * w
        n += g * g
        leader.update(np.array([3]), np.array([x]), label)


# Language model


def kt(zeros, ones):
    p, a, b = 1.0, 0, 0
    for bit in [0] * int(zeros) + [1] * int(ones):
        p *= ((b if bit else a) + 0.5) / (a + b + 1)
        a, b = a + (1 - bit), b + bit
    return p


class Slow:
    """The same model by recursion over all contexts, one decision at a time."""

    def __init__(self, texts, depth, least):
        self.depth = depth
        self.seen = Counter()
        for words in texts:
            data = b"\n" * depth + b" ".join(words) + b"\n"
            for t in range(depth, len(data)):
                for d in range(depth + 1):
                    self.seen[data[t - d : t], data[t]] += 1
        total = Counter()
        for (context, _), n in self.seen.items():
            total[context] += n
        self.nodes = {c for c, n in total.items() if n >= least or c == b""}

    def counts(self, context, decision):
        """Zeros and ones where the bits so far, after a leading one, are ``decision``."""
        out = [0, 0]
        for (c, byte), n in self.seen.items():
            path = 256 + byte
            while path > 1:
                if c == context and path >> 1 == decision:
                    out[path & 1] += n
                path >>= 1
        return out

    def children(self, context):
        return [c for c in self.nodes if len(c) == len(context) + 1 and c.endswith(context)]

    def rest(self, context, decision):
        a, b = self.counts(context, decision)
        for c in self.children(context):
            x, y = self.counts(c, decision)
            a, b = a - x, b - y
        return a, b

    def weighted(self, context, decision):
        own = kt(*self.counts(context, decision))
        if not [c for c in self.nodes if len(c) > len(context)]:
            return own
        below = kt(*self.rest(context, decision))
        for c in self.children(context):
            below *= self.weighted(c, decision)
        return (own + below) / 2

    def one(self, history, decision, context=b""):
        a, b = self.counts(context, decision)
        own = (b + 0.5) / (a + b + 1)
        if not [c for c in self.nodes if len(c) > len(context)]:
            return own
        share = kt(a, b) / 2 / self.weighted(context, decision)
        longer = history[len(history) - len(context) - 1 :]
        if longer in self.nodes:
            return share * own + (1 - share) * self.one(history, decision, longer)
        a, b = self.rest(context, decision)
        return share * own + (1 - share) * (b + 0.5) / (a + b + 1)

    def log10(self, history, byte):
        path, out = 1, 0.0
        for k in range(7, -1, -1):
            one, bit = self.one(history, path), byte >> k & 1
            out += math.log10(one if bit else 1 - one)
            path = path << 1 | bit
        return out


def tree_of(texts, depth, least):
    grams, counts = ctw.grams_of(texts, depth)
    entries = []
    for d in range(depth + 1):
        own, n = ctw.added(grams & ((1 << 8 * (d + 1)) - 1), counts)
        contexts, row = np.unique(own >> 8, return_inverse=True)
        kept = (np.bincount(row, weights=n) >= least)[row] if d else np.ones(len(own), bool)
        entries.append((own[kept], n[kept].astype(float)))
    return ctw.ContextTree(entries)


@pytest.mark.parametrize("least", [1, 3])
def test_tree_agrees_with_the_recursion(least):
    texts = [b"ab ab abc".split(), b"ba".split(), b"abab".split()]
    tree, slow = tree_of(texts, 2, least), Slow(texts, 2, least)
    for words in (b"ab".split(), b"abz b".split(), []):
        data = b"\n\n" + b" ".join(words) + b"\n"
        want = sum(slow.log10(data[t - 2 : t], data[t]) for t in range(2, len(data)))
        assert tree.score([words])[0] == pytest.approx(want, rel=3e-3)


def test_probabilities_of_all_bytes_add_up_to_one():
    rng = random.Random(9)
    tree = tree_of([prose(rng, 40).lower().encode().split() for _ in range(20)], 4, 2)
    assert np.allclose((10.0 ** tree.log10.astype(float)).sum(axis=1), 1, atol=0.02)


def test_counts_of_thousands_of_millions_stay_exact():
    rng = random.Random(8)
    grams, counts = ctw.grams_of([prose(rng, 60).lower().encode().split() for _ in range(20)], 3)
    counts = counts * 10**9 + np.array([rng.randrange(10**6) for _ in counts])
    entries = [ctw.added(grams & ((1 << 8 * (d + 1)) - 1), counts) for d in range(4)]
    tree = ctw.ContextTree([(g, n.astype(float)) for g, n in entries])
    assert np.isfinite(tree.log10).all()
    assert np.allclose((10.0 ** tree.log10.astype(float)).sum(axis=1), 1, atol=0.02)
    assert np.isfinite(tree.score([b"the end".split(), b"~~".split()])).all()


@pytest.mark.parametrize(("depth", "gram_head_share"), [(6, 1e-9), (6, 1e-4), (4, 1.0), (2, 1e-4)])
def test_every_repeated_context_counts_at_any_size(spark, depth, gram_head_share):
    rng = random.Random(12)
    rare = "qzxjkv qzxjkv"
    texts = [prose(rng, 400) for _ in range(150)] + [rare]
    docs = documents(spark, rows_of(texts)).repartition(5)
    learned = [ctw.tokens_of(t) for i, t in enumerate(texts) if fold(i, 10)]
    assert fold(len(texts) - 1, 10)
    tree = tree_of(learned, depth, 2)
    found = {r.doc_id: r.score for r in ctw.score_texts(docs, ~fold_is(10, 0), depth=depth, gram_head_share=gram_head_share).collect()}
    for i, want in enumerate(tree.score([ctw.tokens_of(t) for t in texts])):
        assert found[i] == pytest.approx(want, rel=1e-3)


def test_log_gamma():
    for x in (0.5, 1.0, 2.5, 6.9, 7.0, 30.5, 1e6 + 0.5):
        assert ctw.log_gamma(np.array([x]))[0] == pytest.approx(math.lgamma(x), rel=1e-9, abs=1e-9)


def test_scores_count_and_add_up(spark, odd):
    training = ~fold_is(10, 0)
    rows = odd.unionByName(odd.where("doc_id = 5"))
    found = {r.doc_id: r for r in ctw.score_texts(rows, training).collect()}
    texts = {r.doc_id: [*ctw.tokens_of(r.text), b"\n"] for r in odd.where("doc_id IS NOT NULL").collect()}
    assert set(found) == set(texts)
    counts = Counter(w for i, t in texts.items() if fold(i, 10) for w in t)
    n = sum(counts.values())
    for i, tokens in texts.items():
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (len(counts) + 1))) for w in tokens)
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert r.base_score == pytest.approx(base)
        assert -3 * len(b" ".join(tokens)) - 5 < r.score < 0


def test_words_that_are_not_broadcast_count_as_well(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    training = ~fold_is(10, 0)
    few = {r.doc_id: r for r in ctw.score_texts(docs, training, head_share=0.01, depth=2).collect()}
    many = {r.doc_id: r for r in ctw.score_texts(docs, training, head_share=1e-9, depth=2).collect()}
    assert set(few) == set(many) and len(few) == docs.count()
    for i, r in few.items():
        assert (r.n_known, r.n_tokens) == (many[i].n_known, many[i].n_tokens)
        assert r.base_score == pytest.approx(many[i].base_score)


def test_no_training_text(spark, odd):
    found = ctw.score_texts(odd, F.lit(False)).collect()
    assert {r.train_tokens for r in found} == {0} and {r.n_known for r in found} == {0}
    assert found[0].score == pytest.approx(-math.log10(256) * 1, rel=1e-3) or all(r.score < 0 for r in found)
    assert ctw.score_texts(odd.limit(0), F.lit(True)).count() == 0


def test_runs_and_words_are_shuffled_packed_and_met_by_few_tasks(spark, monkeypatch):
    """Buckets grow with the texts; the sums of a document do not, and no row is a pair of a run and a document."""
    rng = random.Random(21)
    docs = documents(spark, rows_of([prose(rng, 300) for _ in range(120)])).repartition(4)
    whole = {r.doc_id: r for r in ctw.score_texts(docs, ~fold_is(10, 0), gram_head_share=1.0, head_share=1.0).collect()}
    monkeypatch.setattr(ctw, "BUCKET_BYTES", 4096)
    monkeypatch.setattr(ctw, "PAIRS_KEPT", 5000)
    monkeypatch.setattr(ctw, "TASKS_PER_CORE", 1)
    rows = docs.select(docs.doc_id, docs.text, F.lit(True).alias("learn"))
    buckets = ctw.buckets_for(rows)
    assert buckets > 3 * spark.sparkContext.defaultParallelism
    grams = ctw.count_grams(rows, 6, buckets)
    assert grams.count() <= buckets
    size = grams.agg(F.sum(F.octet_length("grams") + F.octet_length("count") + F.octet_length("seen"))).first()[0]
    distinct = sum(len(ctw.unpacked(bytes(r.grams))) for r in grams.collect())
    assert size < 12 * distinct
    split = {r.doc_id: r for r in ctw.score_texts(docs, ~fold_is(10, 0), gram_head_share=1.0, head_share=1.0).collect()}
    assert set(split) == set(whole) and len(whole) == 120
    for i, r in split.items():
        assert (r.n_tokens, r.n_known) == (whole[i].n_tokens, whole[i].n_known)
        assert r.score == pytest.approx(whole[i].score) and r.base_score == pytest.approx(whole[i].base_score)
    parts = ctw.score_parts(rows, ctw.gram_logs(grams, 6), spark.createDataFrame([], "word binary, c long"), 6, buckets, {}, 1.0)
    assert parts.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 1 + spark.sparkContext.defaultParallelism


def test_runs_with_many_letters_and_texts_are_sorted_in_two_columns():
    rng = np.random.default_rng(3)
    texts = [[bytes(rng.integers(128, 256, 40, dtype=np.uint8)), b"abc", b"abc"] for _ in range(300)]
    head = np.array([np.iinfo(np.int64).max])
    sums, runs, owner, times = ctw.rare_runs(texts, 6, head, np.zeros(1))
    found = Counter(zip(runs.tolist(), owner.tolist(), times.tolist(), strict=True))
    one_by_one = Counter()
    for i, t in enumerate(texts):
        _, own, _, n = ctw.rare_runs([t], 6, head, np.zeros(1))
        one_by_one.update((g, i, x) for g, x in zip(own.tolist(), n.tolist(), strict=True))
    assert found == one_by_one and (np.diff(runs) >= 0).all() and not sums.any()
