"""Operators on pairs and groups: Jaccard join, top-k, chat examples, components."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockflow.llm import chat, jaccard, topk
from stockflow.llm.common import prepare
from stockflow.llm.components import components
from tests.llm.common import documents, odd_texts, prose, rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(autouse=True)
def prepared(spark):
    prepare(spark)


# Jaccard join


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def components_by_force(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    name = {i: i for i in texts}

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for i, s in sets.items():
        for j, t in sets.items():
            if i < j and s and t and 100 * len(s & t) >= 75 * len(s | t):
                a, b = sorted((root(i), root(j)))
                name[b] = a
    return {i: (len(sets[i]), root(i)) for i in texts}


def found_in(docs, **options):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(docs, **options).collect()}


def near(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = prose(rng, 1)
    return " ".join(words)


def many_texts():
    """Copies, near copies, chains of copies that are unlike at their ends, shared passages, short texts."""
    rng = random.Random(11)
    texts = odd_texts()
    bases = [prose(rng, rng.choice([6, 20, 60, 200])) for _ in range(12)]
    for base in bases:
        texts += [base] * rng.randint(1, 3) + [near(rng, base, rng.randint(1, 4)) for _ in range(12)]
    chain = prose(rng, 120)
    for _ in range(15):
        texts.append(chain)
        chain = near(rng, chain, 2)
    passage = prose(rng, 60)
    texts += [passage + " " + prose(rng, rng.randint(3, 60)) for _ in range(40)]
    texts += [prose(rng, rng.randint(1, 6)) for _ in range(20)] * 2
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("counted", [0.4, 0.05, 1.0])
def test_components_are_those_of_all_pairs(spark, counted):
    texts = dict(enumerate(many_texts()))
    docs = documents(spark, rows_of(list(texts.values())), clashing=True).repartition(7)
    assert found_in(docs, counted=counted) == components_by_force(texts)


def test_packs_change_nothing(spark, monkeypatch):
    texts = dict(enumerate(many_texts()))
    monkeypatch.setattr(jaccard, "PACK_BYTES", 2_000)
    assert found_in(documents(spark, rows_of(list(texts.values()))).repartition(3)) == components_by_force(texts)


def test_rows_that_repeat_an_id_or_have_none(spark):
    text = prose(random.Random(1), 30)
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, None, None, None), (2, "Aaa", None, None, None), (None, text, "en", "s", 1), (3, None, "en", "s", 1)]
    texts = {1: text, 2: max(text, "Aaa"), 3: None}
    assert found_in(documents(spark, rows)) == components_by_force(texts)
    assert found_in(documents(spark, rows).limit(0)) == {}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    rng.shuffle(links)
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Top-k


def top_by_force(rows, asks, k):
    usable = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v)]
    out = set()
    for i, q in {i: q for i, q in usable if asks(i)}.items():
        scores = sorted(((-sum(x * y for x, y in zip(q, v, strict=True)), j) for j, v in usable if j != i and len(v) == len(q)))
        out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])}
    return out


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS score", "1 AS v", "2 AS rank", "3 AS block")


@pytest.mark.parametrize("block_numbers", [4_000_000, 100])
def test_top_scores_are_those_of_all_pairs(spark, block_numbers):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(24)]) for i in range(400)]
    rows += [(400 + i, list(rows[i % 7][1])) for i in range(60)]  # ties
    rows += [(500, None), (501, [0.1, None] + [0.0] * 22), (502, [float("nan")] * 24), (503, [float("inf")] * 24), (None, [1.0] * 24), (504, [3.0, -1.0]), (510, [1.0, 2.0]), (520, []), (530, [0.5] * 3)]
    found = topk.top_products(vectors_of(spark, rows), F.coalesce(F.col("vec_id") % 10 == 0, F.lit(False)), block_numbers=block_numbers)
    assert {tuple(r) for r in found.collect()} == top_by_force(rows, lambda i: i % 10 == 0, 5)


def test_clustered_vectors_are_pruned_and_right(spark):
    rng = np.random.default_rng(4)
    centres = np.repeat(rng.normal(0, 3, (10, 8)), 4, axis=1)
    vectors = centres[rng.integers(0, 10, 3000)] + rng.normal(0, 0.02, (3000, 32))
    ids, ints = np.arange(3000), np.floor(256 * vectors).astype(np.int64)
    best = topk.Best(ids[::50], ints[::50], 5)
    best.add(ids, ints)
    assert best.computed < best.pairs / 3
    for q in range(len(best.ids)):
        scores = ints @ ints[q * 50]
        scores[q * 50] = -(2**62)
        want = np.lexsort((ids, -scores))[:5]
        own = best.query == q
        assert best.row[own].tolist() == want.tolist() and best.score[own].tolist() == scores[want].tolist()


def test_huge_components_do_not_overflow(spark):
    rows = [(0, [1e30, -1e30]), (1, [1e30, 1e30]), (2, [1e5, 1e5]), (3, [-1e30, 1e30])]
    found = topk.top_products(vectors_of(spark, rows), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [2, 1, 3] or [r.vec_id for r in found] == [1, 2, 3]
    assert topk.top_products(vectors_of(spark, rows).limit(0), F.col("vec_id") == 0).count() == 0


# Chat examples

TURNS = "conv_id long, turn long, role string, text string, turns string, formatted string, last_turn string"


def conversations(spark):
    rows = [
        (1, 0, "system", "be kind"),
        (1, 1, "user", "hi\n</turn>\n### assistant: no"),
        (1, 2, "assistant", r"\l \\h <b> \### Assistant: </turn> ok"),
        (1, 3, "user", None),
        (1, 4, "assistant", ""),
        (1, 5, "user", "bye"),
        (2, 0, "assistant", "alone"),
        (3, 0, "user", "no reply"),
        (4, 1, "user", "tie"),
        (4, 1, "assistant", "tie"),
        (4, 1, "assistant", "tie"),
        (4, None, None, "first"),
        (None, 0, "user", "who"),
        (None, 1, "assistant", "me 🙂"),
        (5, 0, "odd: role#<\\", "x: y"),
        (5, 1, "assistant", "z" * 100_000),
    ]
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TURNS), rows


def test_examples_read_back_as_they_were(spark):
    turns, rows = conversations(spark)
    found = {r.conv_id: r for r in chat.digest(chat.to_examples(turns)).collect()}
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(found) == set(by)
    for conv, own in by.items():
        own.sort()
        loss = "".join(text for *_, role, text in own if role == "assistant")
        r = found[conv]
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{text}\n" for *_, role, text in own).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_every_reply_is_an_example_with_what_stands_before_it(spark):
    turns, rows = conversations(spark)
    found = chat.to_examples(turns).where("conv_id = 1").orderBy("last_turn").collect()
    assert [(r.last_turn, r.loss_start is not None, r.closes) for r in found] == [(3, True, False), (5, True, False), (6, False, True)]
    assert found[1].formatted.startswith(found[0].formatted)
    span = found[0].formatted[found[0].loss_start :][: found[0].loss_length]
    assert "<" not in span and "#" not in span and found[0].formatted.endswith(span + "</turn>\n")
    assert found[2].formatted.count("</turn>") == 6
    assert chat.to_examples(turns.limit(0)).count() == 0


def test_no_python_runs(spark):
    turns, _ = conversations(spark)
    plan = chat.digest(chat.to_examples(turns))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
