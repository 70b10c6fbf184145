"""Byte-level BPE by dynamic programming over prefixes.

For a sequence of bytes, every prefix has exactly one BPE encoding, and the encoding of a prefix ends in one token. Storing this last
token for each prefix stores all prefix encodings at once: the encoding is read by walking back from the end. The last token of
a prefix is the one token t among its suffixes for which the last token u of the rest goes together with t, that is, BPE
would not merge across the border of u and t. The pair is tested by undoing merges from both sides of the border, latest first, and
looking whether a merge across the border would have come earlier.

Because a prefix's last token does not depend on what follows, bytes can be appended, and after an edit only the entries from the
edit on are computed again (``Prefixes``).
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession

from stockflow.llm.common import map_texts, prepare, share, single_spaced, table, text_of, vocabulary

#: Encoded pieces of text and tested pairs kept by a worker; when there are more, it starts anew.
MEMO_ENTRIES = 900_000
NO_MERGE = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a token in base64 and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge_down(data: bytes, ranks: dict[bytes, int], below: int = NO_MERGE) -> list[bytes]:
    """Plain BPE: merge the leftmost pair of lowest rank until none is left; only ranks under ``below`` count."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        best, at = min((ranks.get(parts[i] + parts[i + 1], NO_MERGE), i) for i in range(len(parts) - 1))
        if best >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Vocabulary:
    """A rank table, with the two tokens of each token's last merge and a trie of all tokens that merges can reach."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.split: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.step: dict[int, int] = {}  # node * 256 + byte -> node
        self.token_at: list[int] = [-1]  # by node
        for token, rank in ranks.items():
            if len(token) > 1:
                parts = merge_down(token, ranks, rank)
                if len(parts) != 2:  # merges never reach it
                    continue
                pair = ranks[parts[0]], ranks[parts[1]]
                self.split[rank] = pair
                self.merged[pair] = rank
            node = 0
            for byte in token:
                node = self.step.setdefault(node << 8 | byte, len(self.token_at))
                if node == len(self.token_at):
                    self.token_at.append(-1)
            self.token_at[node] = rank

    def together(self, left: int, right: int) -> bool:
        """Whether BPE leaves ``left`` and ``right`` apart when they stand side by side."""
        limit = NO_MERGE  # merges of this rank and above are undone by now
        while True:
            if self.merged.get((left, right), NO_MERGE) < limit:
                return False
            undo_left = self.split.get(left)
            undo_right = self.split.get(right)
            if undo_left and (left > right or not undo_right):
                limit, left = left, undo_left[1]  # of equal merges the left one comes first
            elif undo_right:
                limit, right = right + 1, undo_right[0]
            else:
                return True


class Prefixes:
    """The last token of every prefix of a sequence of bytes; ``last[n]`` belongs to the first n bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"", known: dict[int, bool] | None = None):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.known = {} if known is None else known
        self.append(data)

    def append(self, more: bytes) -> None:
        v, last, known = self.vocabulary, self.last, self.known
        start, self.data = len(self.data), self.data + more
        data, step, token_at = self.data, v.step, v.token_at
        n = len(data)
        last += [-1] * len(more)
        for begin in range(max(0, start - v.longest + 1), n):
            left, node = last[begin], 0
            for end in range(begin, n):
                node = step.get(node << 8 | data[end])
                if node is None:
                    break
                token = token_at[node]
                if token >= 0 and last[end + 1] < 0:
                    if begin:
                        pair = left << 32 | token
                        fits = known.get(pair)
                        if fits is None:
                            fits = known[pair] = v.together(left, token)
                        if not fits:
                            continue
                    last[end + 1] = token

    def replace(self, begin: int, end: int, new: bytes) -> None:
        """Put ``new`` for bytes begin to end; what stands before ``begin`` is kept."""
        rest = new + self.data[end:]
        self.data, self.last[begin + 1 :] = self.data[:begin], []
        self.append(rest)

    def tokens(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            out.append(self.last[at])
            at -= len(self.vocabulary.tokens[out[-1]])
        return out[::-1]


class Encoder:
    """Ids of whole texts: each match of the pattern by itself, without special tokens.

    A match that is a token itself is that token. No match of the pattern reaches across a single space between characters
    that are not white space; texts are cut there, and each distinct piece is encoded once for as long as the memo keeps it.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.decimal = {t: str(t) for t in vocabulary.tokens}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}

    def match(self, text: str) -> tuple[int, ...]:
        data = text.encode()
        whole = self.vocabulary.ranks.get(data)
        return tuple(Prefixes(self.vocabulary, data, self.pairs).tokens()) if whole is None else (whole,)

    def piece(self, text: str) -> tuple[int, ...]:
        matches = self.pattern.findall(text)
        if len(matches) == 1:
            return self.match(text)
        out: tuple[int, ...] = ()
        for m in matches:
            ids = self.memo.get(m)
            if ids is None:
                ids = self.memo[m] = self.match(m)
            out += ids
        return out

    def encode(self, text: str) -> list[int]:
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        if len(self.pairs) > MEMO_ENTRIES:
            self.pairs.clear()
        if not single_spaced(text):
            return [t for m in self.pattern.findall(text) for t in self.match(m)]
        words = text.split(" ")
        out, memo = list(self.piece(words[0])), self.memo
        for word in words[1:]:
            key = " " + word
            ids = memo.get(key)
            if ids is None:
                ids = memo[key] = self.piece(key)
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode every text and decode the ids again.

    Gives doc_id, n_tokens, the SHA-256 of the ids (decimal, joined by commas) and of the decoded bytes, and with ``with_ids``
    the ids. A null text is empty and has no tokens; rows are independent of each other, so repeated rows repeat; other columns are not read.
    """
    encoder = share(docs.sparkSession, Encoder(Vocabulary(load_ranks(ranks_path)), pattern))  # a fixed file

    def make(encoder: Encoder):
        decimal = encoder.decimal

        def step(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"doc_id": batch.column("doc_id").to_pylist(), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            if with_ids:
                out["ids"] = []
            for text in batch.column("text").to_pylist():
                ids = encoder.encode(text)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                if with_ids:
                    out["ids"].append(ids)
            out = {k: pa.array(v, pa.int64() if k in ("doc_id", "n_tokens") else pa.list_(pa.int32()) if k == "ids" else pa.string()) for k, v in out.items()}
            return out

        return step

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return map_texts(docs, [docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col)], schema, make, encoder)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(prepare(spark), sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))
