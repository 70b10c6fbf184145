"""Operators that work row by row: token counts, BPE, decontamination, records."""

import hashlib
import random
import struct
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

import public_tokenizers
from stockflow.lake import run_dir
from stockflow.llm import bpe, decontaminate, records, token_counts
from stockflow.llm.common import prepare, vocabulary
from tests.llm.common import documents, odd_texts, prose, rows_of


@pytest.fixture(scope="module")
def odd(spark):
    prepare(spark)
    return documents(spark, rows_of(odd_texts()) + [(None, "no id", "en", "s", 5), (5, "the id again", "en", "s", 12)], clashing=True)


@pytest.fixture(scope="module")
def nothing(odd):
    return odd.limit(0)


# Token counts


def greedy(word, first, following):
    """Plain longest-match splitting."""
    at, n = 0, 0
    while at < len(word):
        pieces = first if at == 0 else following
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 0
        at, n = end, n + 1
    return n


def test_automaton_counts_as_greedy_splitting_does():
    rng = random.Random(1)
    for _ in range(300):
        first, following = ({"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 12))} for _ in range(2))
        automaton = token_counts.Automaton(first, following)
        for _ in range(40):
            word = "".join(rng.choice("abcd" if rng.random() < 0.1 else "abc") for _ in range(rng.randint(1, 12)))
            assert automaton.count(word) == greedy(word, first, following), (word, first, following)


def test_counts_of_odd_rows(odd, nothing):
    first, following = token_counts.pieces_of_model(vocabulary("piece_bpe_32k.model"))
    a, b = set(first), set(following)
    want = sorted(
        (r.doc_id is not None, r.doc_id or 0, len(w := (r.text or "").split()), sum(max(1, greedy(x[:60], a, b) if len(x) < 60 else 1) for x in w), sum(not greedy(x, a, b) for x in w if len(x) < 60))
        for r in odd.collect()
        if r.text is None or len(r.text) != 50_000
    )
    found = token_counts.count_tokens(odd, first, following).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_tokens, r.n_unknown) for r in found if r.doc_id != 11) == want
    assert [r.n_words for r in found if r.doc_id == 11] == [1]
    assert token_counts.count_tokens(nothing, first, following).count() == 0


def test_words_may_begin_with_the_bare_start_piece():
    rng = random.Random(11)
    for _ in range(300):
        first, following = ({"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 12))} for _ in range(2))
        automaton = token_counts.Automaton({"", *first}, following)
        for _ in range(40):
            word = "".join(rng.choice("abcd" if rng.random() < 0.1 else "abc") for _ in range(rng.randint(1, 12)))
            want = greedy("▁" + word, {"▁", *("▁" + p for p in first)}, following)
            assert automaton.count(word) == want, (word, first, following)


def test_words_with_first_characters_that_have_no_start_piece(spark, tmp_path):
    texts = ["123456 ñandú ça ßtraße", "2024", "the 7 ones", "中 \ue000x", None]
    documents(spark, rows_of(texts)).write.parquet(f"{tmp_path}/documents.parquet")
    first, following = token_counts.pieces_of_model(vocabulary("piece_bpe_32k.model"), bare_start=True)
    starts, following = {"▁" + p for p in first}, set(following)
    found = {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in token_counts.op1_token_counts(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        sizes = [greedy("▁" + w, starts, following) for w in (text or "").split()]
        assert found[i] == (len(sizes), sum(max(1, n) for n in sizes), sizes.count(0)), text
    assert found[0][2] == found[1][2] == 0 and found[1][1] > 1 and found[3][2] == 1


# Byte-level BPE


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(vocabulary("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoder_agrees_with_the_library(ranks, reference):
    rng = random.Random(2)
    encoder = bpe.Encoder(bpe.Vocabulary(ranks), public_tokenizers.PATTERN)
    alphabet = "abcdefgh  \n\t'0123.,éñ中文 ​🙂<|>ß"
    texts = [t or "" for t in odd_texts() if t is None or len(t) < 40_000]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(2000)] + [c * n for c in "a =-" for n in (1, 7, 130)]
    for text in texts:
        ids = encoder.encode(text)
        assert ids == reference.encode_ordinary(text), text
        assert encoder.decode(ids) == text.encode()


def test_small_vocabularies_agree_with_plain_merging():
    rng = random.Random(3)
    for _ in range(100):
        tokens = [b"a", b"b", b"c"]
        for _ in range(rng.randint(0, 25)):
            new = rng.choice(tokens) + rng.choice(tokens)
            if new not in tokens:
                tokens.append(new)
        ranks = {t: i for i, t in enumerate(tokens)}
        vocabulary_ = bpe.Vocabulary(ranks)
        for _ in range(20):
            data = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 25)))
            assert bpe.Prefixes(vocabulary_, data).tokens() == [ranks[p] for p in bpe.merge_down(data, ranks)]


def test_appends_and_edits_equal_encoding_anew(ranks):
    rng = random.Random(4)
    vocabulary_ = bpe.Vocabulary(ranks)
    data = b"theinternationalisation"
    prefixes = bpe.Prefixes(vocabulary_, data)
    for _ in range(60):
        if rng.random() < 0.5:
            more = bytes(rng.choice(b"etaoin shrdlu") for _ in range(rng.randint(0, 9)))
            data += more
            prefixes.append(more)
        else:
            begin = rng.randint(0, len(data))
            end = rng.randint(begin, min(len(data), begin + 5))
            new = bytes(rng.choice(b"etaoin") for _ in range(rng.randint(0, 4)))
            data = data[:begin] + new + data[end:]
            prefixes.replace(begin, end, new)
        assert prefixes.tokens() == bpe.Prefixes(vocabulary_, data).tokens()


def test_round_trip_of_odd_rows(odd, nothing, reference):
    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    found = bpe.round_trip(odd, path, with_ids=True).collect()
    assert len(found) == odd.count()
    texts = {r.doc_id: r.text or "" for r in odd.collect() if r.doc_id not in (None, 5)}
    for r in found:
        if r.doc_id in texts:
            ids = reference.encode_ordinary(texts[r.doc_id]) if len(texts[r.doc_id]) != 50_000 else r.ids
            assert (r.ids, r.n_tokens) == (ids, len(ids))
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert bpe.round_trip(nothing, path).count() == 0


# Benchmark passages


def hits_by_force(words, patterns):
    hit, items = set(), set()
    for pattern, own in patterns.items():
        for i in range(len(words) - len(pattern) + 1):
            if tuple(words[i : i + len(pattern)]) == pattern:
                hit |= set(range(i, i + len(pattern)))
                items |= own
    return hit, items


def test_matcher_finds_every_occurrence():
    rng = random.Random(6)
    for _ in range(200):
        alphabet = [b"a", b"b", b"c", b"dd"][: rng.randint(1, 4)]
        items = [(k, b" ".join(rng.choice(alphabet) for _ in range(rng.randint(0, 8))).decode()) for k in range(rng.randint(0, 6))]
        patterns = decontaminate.patterns_of(items, window=4)
        matcher = decontaminate.Matcher(patterns)
        words = [rng.choice(alphabet) for _ in range(rng.randint(0, 40))]
        hit, found = matcher.search(words)
        want = hits_by_force(words, patterns)
        assert ({i for i, x in enumerate(hit) if x}, found) == want
        assert {i for a, b in decontaminate.spans_of(hit) for i in range(a, b)} == want[0]


def test_passages_of_odd_rows_in_one_part_or_several(spark, odd, nothing):
    texts = odd_texts()
    items = [(1, " ".join(texts[9].split()[5:30])), (2, "one TWO"), (3, None), (4, ""), (None, "zero"), (5, "x" * 50_000), (2, "four"), (6, " ".join(texts[10].split()[-12:]))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    patterns = decontaminate.patterns_of(items)
    whole = {(r.doc_id, r.n_words, str(r.spans), str(r.items)) for r in decontaminate.find_passages(odd, benchmark).collect()}
    assert whole == {(r.doc_id, r.n_words, str(r.spans), str(r.items)) for r in decontaminate.find_passages(odd, benchmark, part_chars=20_000).collect()}
    for r in decontaminate.find_passages(odd, benchmark).collect():
        if r.doc_id not in (None, 5):
            words = decontaminate.words_of(texts[r.doc_id] or "")
            hit, found = hits_by_force(words, patterns)
            assert (r.n_words, r.items) == (len(words), sorted(found))
            assert {i for s in r.spans for i in range(s.begin, s.end)} == hit
    kept = decontaminate.without_passages(odd, benchmark)
    assert kept.columns == odd.columns
    assert kept.count() == sum(not r.spans for r in decontaminate.find_passages(odd, benchmark).collect())
    assert decontaminate.find_passages(nothing, benchmark).count() == 0
    assert decontaminate.without_passages(odd, benchmark.limit(0)).count() == odd.count()


# Records


def test_pieces_are_encoded_as_whole_texts_are():
    rng = random.Random(7)
    encoder = records.PieceEncoder(Path(vocabulary("byte_bpe_50k.json")).read_text(), 2)
    alphabet = "abcABC  \n\n\t'0123.,.,;éñ中文 ​🙂<|>ß\x1c\x85"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(5000)] + [t or "" for t in odd_texts() if t is None or len(t) < 40_000]
    plain = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, data, want in zip(texts, encoder.encode(pa.array(texts, pa.string())), plain, strict=True):
        assert np.frombuffer(data, encoder.width).tolist() == [*want.ids, 2], text


def test_files_hold_all_records_in_order_and_any_can_be_read(spark, odd, nothing):
    path = vocabulary("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    folder = run_dir(spark, "records-test")
    manifest = records.write_records(odd, folder, path, 2, file_bytes=20_000)
    found = records.read_back(manifest).orderBy("start").collect()
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in odd.collect()))
    start = 0
    for r, (known, doc_id, text) in zip(found, rows, strict=True):
        assert (r.doc_id, r.start) == (doc_id if known else None, start)
        if len(text) < 40_000:
            ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
            assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += r.n_tokens
    files = manifest.collect()
    assert len(files) >= 2
    local = lambda p: Path(p.removeprefix("file:")).read_bytes()
    for file in files:
        data, index = local(file.path), local(file.index_path)
        straight = [(i, ids.tolist()) for i, ids in records.read_records(data)]
        order = list(range(file.n_records))[::-1]
        assert [(i, ids.tolist()) for i, ids in records.read_records(data, order, index)] == straight[::-1]
    empty = records.write_records(nothing, run_dir(spark, "records-test"), path, 2)
    assert records.read_back(empty).count() == 0


def test_query_encodes_added_tokens_as_the_library_does(spark, tmp_path):
    texts = ["a<|endoftext|>b", "one <|endoftext|> two", "<|endoftext|>", "end of text", "<|endoftext| >", "a\n <|endoftext|>\n b"]
    documents(spark, rows_of(texts)).write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    found = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in records.op10_token_records(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert found[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), text


def test_damage_is_found():
    record = records.frame(records.pack(7, np.array([1, 2, 3], "<u2")))
    assert [(i, ids.tolist()) for i, ids in records.read_records(record)] == [(7, [1, 2, 3])]
    length, check = struct.unpack_from("<QI", record)
    assert length == 16 and check == records.masked(record[:8])
    for at in range(len(record)):
        broken = bytearray(record)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(records.read_records(bytes(broken)))


def test_plain_words_skip_the_pattern_and_give_the_librarys_ids(monkeypatch):
    """Words of Latin, Greek and Cyrillic letters are matches as they stand and do not go through the library's splitting; all others do."""
    json_text = Path(vocabulary("byte_bpe_50k.json")).read_text()
    encoder = records.PieceEncoder(json_text, 2)
    sent = []
    learn = encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda new: (sent.extend(new), learn(new))[1])
    words = ["Anblewh", "éelleç", "zuberß", "ÀÖØöøÿ", "Straße", "\u0100\u024f", "λόγος", "слово", "naïveté", "x"]
    others = ["don't", "a1b2", "日本語", "×÷", "ab\u00ad", "ªº", "123", "we'll", "_a_", "\u01c5e\u0301"]
    texts = [" ".join(words), " ".join(others), "one\ntwo\nλ\n3\n\n four. five,\nsix\n\xa0seven", "\n".join(words), " ".join(w + "." for w in words), "a\n", "\na\nb"]
    library = Tokenizer.from_str(json_text)
    library.encode_special_tokens = True
    got = encoder.encode(pa.array(texts * 2))
    for text, data in zip(texts * 2, got, strict=True):
        assert list(np.frombuffer(data, encoder.width)) == [*library.encode(text, add_special_tokens=False).ids, 2], text
    assert not {w for word in words for w in (word, f" {word}")} & set(sent)
    assert any("日本語" in piece for piece in sent)
