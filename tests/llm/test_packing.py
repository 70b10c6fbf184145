"""Packing: every id in one piece, no padding, ids as the library gives them, and neighbours by BM25."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from stockflow.llm import packing
from stockflow.llm.common import prepare, table, vocabulary
from stockflow.llm.words import WordEncoder
from tests.llm.common import SF_DIR, documents, odd_texts, prose, rows_of

PATH = vocabulary("word_bpe_49k.json")


def library() -> Tokenizer:
    return Tokenizer.from_file(PATH)


def check(pieces, rows, window):
    """All that the contract asks of a packing of ``rows`` (doc_id, text)."""
    tokenizer = library()
    want = Counter()
    for doc_id, text in rows:
        want[doc_id, tuple([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2])] += 1
    sequences, documents = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length > 0
        sequences[p.sequence_id].append((p.offset, p.length))
        documents[p.doc_id].append((p.start, ids.tolist(), p.doc_tokens))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window and at & (at - 1) == 0
    for doc_id, own in documents.items():
        texts = [ids for (d, ids), n in want.items() if d == doc_id for _ in range(n)]
        assert sum(len(ids) for ids in texts) == sum(len(ids) for _, ids, _ in own)
        if len(texts) == 1:
            joined = []
            for start, ids, n in sorted(own):
                assert start == len(joined) and n == len(texts[0])
                joined += ids
            assert tuple(joined) == tuple(texts[0])
    assert {d for d, _ in want} == set(documents)


@pytest.mark.parametrize("window,shard", [(4096, 1 << 20), (64, 2000)])
def test_odd_texts(window, shard, spark):
    rows = rows_of(odd_texts()) + [(None, "No id here", "en", "s", 9), (5, "The id again", "en", "s", 9)]
    docs = documents(prepare(spark), rows, clashing=True)
    pieces = packing.pack(docs, PATH, 2, window, shard).collect()
    check(pieces, [r[:2] for r in rows], window)
    assert packing.pack(docs.limit(0), PATH, 2, window, shard).count() == 0


def test_whole_table_and_its_digests(spark):
    docs = table(prepare(spark), SF_DIR, "documents")
    rows = docs.select("doc_id", "text").collect()
    pieces = packing.pack(docs, PATH, 2, shard_tokens=50_000).collect()
    check(pieces, [tuple(r) for r in rows], 4096)
    padded = {p.sequence_id: 0 for p in pieces}
    assert len(padded) < 1.2 * sum(p.length for p in pieces) / 4096 + 12 * 50
    own = {(p.doc_id, p.start, p.length): zlib.crc32(p.ids) for p in packing.pack(docs, PATH, 2).collect()}
    assert own == {(p.doc_id, p.start, p.length): p.ids_crc32 for p in packing.op12_packing(spark, SF_DIR).collect()}


def test_a_third_of_all_rows_alike(spark):
    rng = random.Random(2)
    same = prose(rng, 40)
    rows = [(i, same if i % 3 == 0 else prose(rng, rng.randint(0, 80)), "en", "s", 1) for i in range(900)]
    pieces = packing.pack(documents(prepare(spark), rows), PATH, 2, 256, 4096).collect()
    check(pieces, [r[:2] for r in rows], 256)
    heads = Counter(p.sequence_id >> 25 for p in pieces if rows[p.doc_id][1] == same)
    assert len(heads) > 3  # the copies are dealt to several shards


def test_scores_are_bm25():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 30, 25)
    ids = rng.integers(3, 20, lengths.sum())
    occurs, n_units, mean = np.arange(20) * 3 + 1, 70, 14.5
    index = packing.Index(ids, lengths, occurs, n_units, mean)
    units = [u[:-1].tolist() for u in np.split(ids, np.cumsum(lengths)[:-1])]
    for seed in range(25):
        for k, unit in enumerate(units):
            want = 0.0
            for term in set(units[seed]):
                tf = unit.count(term)
                rarity = math.log(1 + (n_units - occurs[term] + 0.5) / (occurs[term] + 0.5))
                want += rarity * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * lengths[k] / mean)) if tf else 0.0
            assert index.scores(seed)[k] == pytest.approx(want)


def test_statistics_are_those_of_all_units(spark):
    docs = table(prepare(spark), SF_DIR, "documents")
    units = packing.units_of(docs, PATH, 2, "doc_id", "text", 4096)
    occurs, tokens, n = packing.statistics(units, 49408, "<u2")
    want = Counter(t for r in units.select("rest").collect() for t in set(np.frombuffer(r.rest, "<u2")[:-1].tolist()))
    assert {t: c for t, c in enumerate(occurs.tolist()) if c} == dict(want)
    assert n == units.where("n_rest > 0").count() and tokens.sum() == units.groupBy().sum("n_rest").first()[0]


def test_a_window_holds_the_nearest_units():
    """Three topics without common words: a seed's window fills with its own topic first."""
    rng = np.random.default_rng(3)
    topic = np.repeat([0, 1, 2], 20)
    rng.shuffle(topic)
    units = [np.append(3 + 50 * t + rng.integers(0, 50, 31), 2) for t in topic]
    lengths = np.full(60, 32)
    ids = np.concatenate(units)
    index = packing.Index(ids, lengths, np.bincount(ids, minlength=200), 60, 32.0)
    for size, taken, begin, amount in packing.fill(index, lengths, 256):
        assert amount.sum() == size and len(set(taken.tolist())) == len(taken)
    firsts = [topic[taken] for _, taken, _, _ in packing.fill(index, lengths, 256)][:4]
    assert all(len(set(own.tolist())) == 1 for own in firsts)


def test_sizes_leave_nothing():
    assert packing.sizes(0, 8) == [] and packing.sizes(21, 8) == [8, 8, 4, 1]
    assert all(sum(packing.sizes(n, 64)) == n for n in range(300))


def test_words_as_the_library_encodes_them():
    rng = random.Random(7)
    odd = ["", "a\x1cb c", "x <|endoftext|>y <|STARTOFTEXT|>", "Straße İstanbul ǅ ́x a​ é É", "don't  we'll they're I'd", "᠎a\x85b　c", "a.b,c...d!?'s 12,5.", "x" * 3000, "é É. K K", "ﬁ. ½, ²"]
    alphabet = "aZé.,'!?s \t\n0<|>́ ß·ñÑ-_"
    odd += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    encoder = WordEncoder(open(PATH).read())
    tokenizer = library()
    for start in (0, 500, 0):  # the third time from the memo
        batch = odd[start : start + 1500]
        ids, ends = encoder.encode(pa.array(batch))
        begin = 0
        for text, end in zip(batch, ends.tolist(), strict=True):
            assert ids[begin:end].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
            begin = end


def test_another_tokenizer_goes_to_the_library():
    path = vocabulary("byte_bpe_50k.json")
    encoder = WordEncoder(open(path).read())
    texts = ["Hello  world", "", " a b "]
    ids, ends = encoder.encode(pa.array(texts))
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == sum(want, []) and ends.tolist() == np.cumsum(list(map(len, want))).tolist()


def test_window_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        packing.pack(documents(spark, []), PATH, 2, 100)
