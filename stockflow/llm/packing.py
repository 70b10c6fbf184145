"""Packing of documents into sequences of one length, by lexical retrieval.

Each document is its token ids and an end id. Whole windows of long documents are sequences by themselves; what is left of each document is a
unit. Units are dealt to shards of about ``SHARD_TOKENS`` tokens, and in each shard an inverted index with BM25 weights finds, for a seed (the longest
unit not yet used), the unused units nearest to it in words. They fill the seed's window in that order; the last one is cut where the window
ends, and its rest stays for later. The last tokens of a shard, fewer than a window, fill sequences whose lengths are powers of two, so there is no
padding at all.

Units that share the rarest of their tokens (the one of the highest id, that is, of the latest merge) are dealt to the same shard or to neighbouring ones: each
such token has a stretch of the line of all tokens, as long as the units that it heads, and a unit stands at a random place within the stretch. So a
token that heads a third of all units has many shards, and no shard holds more than its share. Statistics for BM25 (in how many units a token occurs, the
number of units and their mean length) are those of the whole corpus. They are counts for each entry of the vocabulary, which bounds all that is
broadcast or collected.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.lake import materialise
from stockflow.llm.common import opened, prepare, share, slices, table, text_of, vocabulary
from stockflow.llm.words import WordEncoder
from stockflow.session import session_conf

WINDOW = 4096
SHARD_TOKENS = 1 << 20
K1, B = 1.2, 0.75
SLICE_BYTES = 8 * 1024 * 1024
UNITS = "row long, doc_id long, doc_tokens long, windows array<binary>, rest binary, n_rest long, head long"
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
OCCURS, TOKENS, COUNT = 0, 1, 2
INT32_MAX = 2**31 - 1


class Index:
    """An inverted index of units with BM25 weights. The last id of each unit is its end mark and no term."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, occurs: np.ndarray, n_units: int, mean_length: float):
        self.n = len(lengths)
        n_terms = len(occurs)
        unit = np.repeat(np.arange(self.n), lengths)
        word = np.ones(len(ids), bool)
        word[np.cumsum(lengths) - 1] = False
        pairs = unit[word] * n_terms + ids[word]
        if self.n * n_terms <= INT32_MAX:  # sorted much faster
            pairs = pairs.astype(np.int32)
        pairs, counts = np.unique(pairs, return_counts=True)
        unit, self.terms = np.divmod(pairs, n_terms)
        self.begins = np.searchsorted(unit, np.arange(self.n + 1))
        rarity = np.log1p((n_units - occurs + 0.5) / (occurs + 0.5))
        weight = rarity[self.terms] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * lengths[unit] / mean_length))
        order = np.argsort(self.terms, kind="stable")
        self.units, self.weights = unit[order].astype(np.int64), weight[order]
        self.postings = np.searchsorted(self.terms[order], np.arange(n_terms + 1))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every unit for the distinct terms of ``seed``."""
        terms = self.terms[self.begins[seed] : self.begins[seed + 1]]
        if not len(terms):
            return np.zeros(self.n)
        ranges = list(zip(self.postings[terms].tolist(), self.postings[terms + 1].tolist(), strict=True))
        return np.bincount(np.concatenate([self.units[a:b] for a, b in ranges]), np.concatenate([self.weights[a:b] for a, b in ranges]), self.n)


def sizes(total: int, window: int) -> list[int]:
    """Lengths of the sequences that ``total`` tokens fill: whole windows, then powers of two."""
    full, rest = divmod(total, window)
    return [window] * full + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def fill(index: Index, lengths: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each sequence its size, the units in it, where each begins in its unit, and how many tokens are taken."""
    left, begin = lengths.copy(), np.zeros(len(lengths), np.int64)
    seeds = iter(np.argsort(-lengths, kind="stable").tolist())
    seed = next(seeds, None)
    for size in sizes(int(lengths.sum()), window):
        while not left[seed]:
            seed = next(seeds)
        nearness = index.scores(seed)
        nearness[seed] = np.inf
        unused = np.nonzero(left)[0]
        if len(unused) > 4 * size:  # no more units than tokens can be needed
            unused = np.sort(unused[np.argpartition(-nearness[unused], size)[:size]])
            unused = unused if seed in unused else np.append(unused, seed)
        ranked = unused[np.argsort(-nearness[unused], kind="stable")]
        filled = np.cumsum(left[ranked])
        taken = ranked[: int(np.searchsorted(filled, size)) + 1]
        amount = left[taken].copy()
        amount[-1] -= int(filled[len(taken) - 1]) - size
        yield size, taken, begin[taken].copy(), amount
        begin[taken] += amount
        left[taken] -= amount


def units_of(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str, text_col: str, window: int) -> DataFrame:
    """The documents' ids: whole windows, the rest, and the token by which the rest is dealt to a shard. Written once, in the shared folder."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:  # a fixed file of a few MB
        model = share(spark, WordEncoder(f.read()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = opened(model)
        end = np.array(end_id, encoder.width)
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text", SLICE_BYTES):
            ids, ends = encoder.encode(batch.column("text"))
            ids, ends = np.insert(ids, ends, end), ends + np.arange(1, len(ends) + 1)
            out: dict[str, list] = {name: [] for name in ("row", "doc_tokens", "windows", "rest", "n_rest", "head")}
            begin = 0
            for stop in ends.tolist():
                own = ids[begin:stop]
                whole = len(own) - len(own) % window
                out["row"].append(row)
                out["doc_tokens"].append(len(own))
                out["windows"].append([own[k : k + window].astype("<u4").tobytes() for k in range(0, whole, window)])
                out["rest"].append(own[whole:].tobytes())
                out["n_rest"].append(len(own) - whole)
                out["head"].append(int(own[whole:-1].max(initial=0)))
                begin, row = stop, row + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["row"]), batch.column("doc_id"), pa.array(out["doc_tokens"]), pa.array(out["windows"], pa.list_(pa.binary())), pa.array(out["rest"], pa.binary()), pa.array(out["n_rest"]), pa.array(out["head"])],
                ["row", "doc_id", "doc_tokens", "windows", "rest", "n_rest", "head"],
            )

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col)).mapInArrow(run, UNITS)
    with session_conf(spark, spark__sql__parquet__compression__codec="zstd"):
        return materialise(rows, "units")


def statistics(units: DataFrame, n_ids: int, width: str) -> tuple[np.ndarray, np.ndarray, int]:
    """For each entry of the vocabulary: units that it occurs in, and tokens of the units that it heads; and the number of units.

    Each task counts its own rows and passes on one row for each entry at most.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occurs, tokens, n = np.zeros(n_ids, np.int64), np.zeros(n_ids, np.int64), 0
        for batch in batches:
            for rest in batch.column("rest").to_pylist():
                occurs[np.unique(np.frombuffer(rest, width)[:-1])] += 1
            np.add.at(tokens, batch.column("head").to_numpy(), batch.column("n_rest").to_numpy())
            n += batch.num_rows
        for kind, own in ((OCCURS, occurs), (TOKENS, tokens), (COUNT, np.array([n]))):
            key = np.nonzero(own)[0]
            yield pa.RecordBatch.from_pydict({"kind": np.full(len(key), kind, np.int32), "key": key, "n": own[key]})

    counted = units.where("n_rest > 0").select("rest", "head", "n_rest").mapInArrow(count, "kind int, key long, n long")
    found = counted.groupBy("kind", "key").agg(F.sum("n").alias("n")).toArrow()
    kind, key, n = (found.column(c).to_numpy() for c in ("kind", "key", "n"))
    occurs, tokens = np.zeros(n_ids, np.int64), np.zeros(n_ids, np.int64)
    occurs[key[kind == OCCURS]] = n[kind == OCCURS]
    tokens[key[kind == TOKENS]] = n[kind == TOKENS]
    return occurs, tokens, int(n[kind == COUNT].sum())


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each piece of a document: doc_id, start (its ids before it), length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    Every id of a document, its end id included, lies in exactly one piece; sequences are gapless from 0, and as long as the window, which must be a power of two, or a smaller power of two.
    A null or empty text is its end id alone. Every row is a document, also one without id or that repeats an id or a text. A very long text
    is whole windows and one unit like others. An empty table gives no rows. Other columns are not read.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("the window must be a power of two")
    spark = docs.sparkSession
    units = units_of(docs, tokenizer_path, end_id, id_col, text_col, window)
    with open(tokenizer_path, encoding="utf-8") as f:
        encoder = WordEncoder(f.read())
    n_ids, width = encoder.n_ids, encoder.width
    occurs, tokens, n_units = statistics(units, n_ids, width)
    total = int(tokens.sum())
    n_shards = max(1, math.ceil(total / shard_tokens))
    shared = share(spark, (occurs, n_units, total / max(1, n_units)))
    stretches = share(spark, (np.cumsum(tokens) - tokens, tokens))

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, length = opened(stretches)
        for batch in batches:
            head = batch.column("head").to_numpy()
            share_of = batch.column("u").to_numpy()
            shard = np.minimum((first[head] + share_of * length[head]) * n_shards // max(1, total), n_shards - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(shard), *[batch.column(c) for c in ("row", "doc_id", "doc_tokens", "rest", "n_rest")]], ["shard", "row", "doc_id", "doc_tokens", "rest", "n_rest"])

    def pack_shard(rows: pd.DataFrame) -> pd.DataFrame:
        occurs, n_units, mean_length = opened(shared)
        rows = rows.sort_values("row")
        ids = np.frombuffer(b"".join(rows["rest"]), width).astype(np.int64)
        lengths = rows["n_rest"].to_numpy()
        base = np.cumsum(lengths) - lengths
        before = rows["doc_tokens"].to_numpy() - lengths
        written = ids.astype("<u4")
        unit, start, length, offset, sequence, data = [], [], [], [], [], []
        first = int(rows["shard"].iloc[0]) << 24
        for number, (_, taken, begin, amount) in enumerate(fill(Index(ids, lengths, occurs, n_units, mean_length), lengths, window)):
            unit.append(taken)
            start.append(begin + before[taken])
            length.append(amount)
            offset.append(np.cumsum(amount) - amount)
            sequence.append(np.full(len(taken), 2 * (first + number), np.int64))
            data += [written[a:b].tobytes() for a, b in zip((base[taken] + begin).tolist(), (base[taken] + begin + amount).tolist(), strict=True)]
        own = np.concatenate(unit)
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].array[own],
                "start": np.concatenate(start),
                "length": np.concatenate(length),
                "ids": data,
                "doc_tokens": rows["doc_tokens"].to_numpy()[own],
                "sequence_id": np.concatenate(sequence),
                "offset": np.concatenate(offset),
            }
        )

    place = F.pmod(F.xxhash64("row"), F.lit(1 << 40)) / float(1 << 40)
    left = units.where("n_rest > 0").select("row", "doc_id", "doc_tokens", "rest", "n_rest", "head", place.alias("u"))
    dealt = left.mapInArrow(deal, "shard long, row long, doc_id long, doc_tokens long, rest binary, n_rest long")
    packed = dealt.groupBy("shard").applyInPandas(pack_shard, PIECES)

    whole = units.where(F.size("windows") > 0).select("row", "doc_id", "doc_tokens", F.posexplode("windows").alias("k", "ids"))
    return packed.unionByName(sequences_of_windows(whole, window))


def sequences_of_windows(whole: DataFrame, window: int) -> DataFrame:
    """Whole windows as sequences of their own; their numbers are odd, those of shards even."""

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        following = TaskContext.get().partitionId() << 33
        for batch in batches:
            n = batch.num_rows
            sequence = 2 * (following + np.arange(n)) + 1
            following += n
            start = batch.column("k").to_numpy().astype(np.int64) * window
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(start), pa.array(np.full(n, window, np.int64)), batch.column("ids"), batch.column("doc_tokens"), pa.array(sequence), pa.array(np.zeros(n, np.int64))],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return whole.select("k", "doc_id", "doc_tokens", "ids").mapInArrow(number, PIECES)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(prepare(spark), sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
