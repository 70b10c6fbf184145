"""Token ids as length-delimited binary records with a separate offset index.

A data file is a run of records, each framed as

    length of the payload (unsigned 64 bit, little-endian) | masked checksum of these 8 bytes | payload | masked checksum of the payload

The checksum is CRC-32 as zlib computes it, rotated right by 15 bits plus 0xA282EAD8, so that a checksum stored in a
payload is not its own checksum. A payload is the document's id (signed 64 bit), a byte that says whether the id is set, a byte with the
width of a token id (2 or 4), and the token ids, little-endian. The index of a data file is a second file of unsigned 64-bit
offsets, one for each record, so record k is found by reading 8 bytes: an epoch can be read in any order.

Files are written in ascending document id: by Spark's range partitioning, sorted within a partition, each partition a run of
files of bounded size. Files carry a random name, and only those of attempts that succeeded are listed in the manifest, so
a lost executor leaves at worst files that nobody reads.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from stockflow.lake import run_dir
from stockflow.llm.common import WHITE, opened, prepare, share, slices, table, text_of, vocabulary
from stockflow.llm.words import ragged

MASK_DELTA = 0xA282EAD8
HEADER, CHECK, PAYLOAD = "<QI", "<I", "<qBB"
#: A file is closed when it has passed so many bytes; a reader holds one file at a time.
FILE_BYTES = 32 * 1024 * 1024
#: A worker keeps so many encoded pieces and so many of their characters; beyond either it starts anew.
MEMO_ENTRIES, MEMO_CHARS = 800_000, 16_000_000
#: Stands where a batch is cut; the library gets texts that hold it, as it gets an empty text and white space that is not one space between two other characters.
CUT = "\x1f"
SPACE = "[" + "".join(map(re.escape, WHITE)) + "]"
BESIDE = f"{CUT}|^$|^{SPACE}|{SPACE}$| {SPACE}|{SPACE} "
#: A full stop or comma at the end of a word is a match of its own, as is a line break between other characters.
WORD_MARK, JOINT, LINE_MARK = r"([\pL\pN])([.,])( |$)", "\n|[.,]$", r"([\pL\pN])\n([\pL\pN])"
#: A word of these letters (Latin, Greek, Cyrillic), with a space before it or none, is one match of the byte-level pattern.
PLAIN = "^ ?[A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ώЀ-ҁ]+$"
#: The vocabulary's character for each byte of such words; a newline stays.
MARKS = np.arange(256, dtype="<u2")
MARKS[[0x20, *range(0x7F, 0xA1), 0xAD]] = range(0x120, 0x144)
#: Pieces joined for one call of the library.
PIECES_AT_ONCE = 2_000
PARTS_IN_BLOCK = 1024
MANIFEST = "part long, seq long, path string, index_path string, n_records long, n_ids long"


def strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack(CHECK, masked(length)) + payload + struct.pack(CHECK, masked(payload))


def pack(doc_id: int | None, ids: np.ndarray) -> bytes:
    return struct.pack(PAYLOAD, doc_id or 0, doc_id is not None, ids.dtype.itemsize) + ids.tobytes()


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, known, width = struct.unpack_from(PAYLOAD, payload)
    return (doc_id if known else None), np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(PAYLOAD))


def read_record(data: bytes, offset: int) -> tuple[bytes, int]:
    """The payload at an offset and the offset after it; a damaged record raises ValueError."""
    length, check = struct.unpack_from(HEADER, data, offset)
    if masked(data[offset : offset + 8]) != check:
        raise ValueError(f"damaged length at offset {offset}")
    start = offset + struct.calcsize(HEADER)
    payload = data[start : start + length]
    if len(payload) != length or masked(payload) != struct.unpack_from(CHECK, data, start + length)[0]:
        raise ValueError(f"damaged record at offset {offset}")
    return payload, start + length + struct.calcsize(CHECK)


def read_records(data: bytes, order: Iterable[int] | None = None, index: bytes = b"") -> Iterator[tuple[int | None, np.ndarray]]:
    """All records of a file, or those with the numbers in ``order``, found by the index."""
    if order is not None:
        offsets = np.frombuffer(index, "<u8")
        for k in order:
            yield unpack(read_record(data, int(offsets[k]))[0])
        return
    offset = 0
    while offset < len(data):
        payload, offset = read_record(data, offset)
        yield unpack(payload)


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class Writer:
    """Writes the records of one partition as files of bounded size, each with its index."""

    def __init__(self, folder: str, part: int, file_bytes: int):
        self.store, self.folder = open_fs(folder)
        self.prefix, self.part, self.file_bytes = folder, part, file_bytes
        self.done: list[tuple] = []
        self.out = None

    def add(self, record: bytes, n_ids: int) -> None:
        if self.out is None:
            self.name, self.offsets, self.at, self.n_ids = f"{self.part:08d}-{len(self.done):05d}-{uuid.uuid4().hex[:12]}", [], 0, 0
            self.out = self.store.open_output_stream(f"{self.folder}/{self.name}.rec")
        self.offsets.append(self.at)
        self.out.write(record)
        self.at += len(record)
        self.n_ids += n_ids
        if self.at >= self.file_bytes:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.out = None
        with self.store.open_output_stream(f"{self.folder}/{self.name}.idx") as index:
            index.write(np.array(self.offsets, "<u8").tobytes())
        path = f"{self.prefix}/{self.name}"
        self.done.append((self.part, len(self.done), f"{path}.rec", f"{path}.idx", len(self.offsets), self.n_ids))


class PieceEncoder:
    """The tokenizer's ids of whole texts.

    With ``added_tokens`` the string of an added token (such as <|endoftext|>) in a text is that token, as is the library's
    default, and a text that holds one goes to the library as a whole; without, it is ordinary text.

    The library encodes each match of its splitting pattern by itself, and no match reaches across a single space between
    two characters that are not white space. So a batch of texts is cut there in Arrow, the library encodes each distinct piece once
    for as long as the memo keeps it, and the batch's ids are gathered by index. A text with other white space around a space goes
    to the library as a whole.

    Where the library's splitting is its byte-level pattern and nothing else, plain words are matches as they stand: they go to the same model, in the vocabulary's
    characters, by a tokenizer that cuts at newlines alone.
    """

    def __init__(self, tokenizer_json: str, end_id: int, added_tokens: bool = False):
        self.tokenizer_json, self.end_id, self.added_tokens = tokenizer_json, end_id, added_tokens
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True
        self.default = Tokenizer.from_str(tokenizer_json)
        self.added = [t.content for t in self.default.get_added_tokens_decoder().values()] if added_tokens else []
        self.odd = "|".join([BESIDE, *map(re.escape, self.added)])
        self.width = "<u2" if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        self.end = np.array([end_id], self.width).tobytes()
        splits, self.words = self.tokenizer.pre_tokenizer, None
        if isinstance(splits, pre_tokenizers.ByteLevel) and splits.use_regex and not splits.add_prefix_space and self.tokenizer.normalizer is None:
            self.words = Tokenizer(self.tokenizer.model)
            self.words.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        self.newline = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = np.zeros(max(vocab.values()) + 1, np.int64)  # a byte-level vocabulary writes a byte as one character
        for token, i in vocab.items():
            self.bytes[i] = len(token)
        self.forget()

    def __reduce__(self):
        return PieceEncoder, (self.tokenizer_json, self.end_id, self.added_tokens)

    def forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.chars = self.used = 0
        self.ids = np.empty(1 << 16, self.width)
        self.starts, self.lengths = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.store(["\n"], np.array([self.newline], self.width), np.array([1]))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """For each text its ids and the end id, as packed little-endian bytes. The texts must not be null."""
        odd = pc.match_substring_regex(texts, self.odd)
        plain = texts.filter(pc.invert(odd))
        ids, ends = self.cut_and_encode(plain) if len(plain) else (self.ids[:0], np.zeros(0, np.int64))
        data, width = ids.tobytes(), ids.dtype.itemsize
        ends = (ends * width).tolist()
        own = (data[a:b] for a, b in zip([0, *ends], ends))
        rest = map(self.whole, texts.filter(odd).to_pylist())
        return [next(rest if is_odd else own) + self.end for is_odd in odd.to_pylist()]

    def cut_and_encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of single-spaced texts, and for each where its ids end."""
        if len(self.memo) > MEMO_ENTRIES or self.chars > MEMO_CHARS:
            self.forget()
        marked = pc.replace_substring_regex(texts, WORD_MARK, f"\\1{CUT}\\2\\3")
        marked = pc.replace_substring_regex(marked, LINE_MARK, f"\\1{CUT}\n{CUT}\\2")
        pieces = pc.split_pattern(pc.replace_substring(marked, " ", f"{CUT} "), CUT)
        coded = pieces.flatten().dictionary_encode()
        slot = self.slots(coded.dictionary)[coded.indices.to_numpy()]
        lengths = self.lengths[slot]
        ends = np.cumsum(pc.list_value_length(pieces).to_numpy(zero_copy_only=False))
        return self.ids[ragged(self.starts[slot], lengths)], np.cumsum(lengths)[ends - 1]

    def slots(self, pieces: pa.Array) -> np.ndarray:
        """Where the ids of distinct pieces are kept; those the worker has not met are encoded."""
        memo, names = self.memo, strings(pieces)
        found = np.fromiter(map(memo.get, names, repeat(-1)), np.int64, len(names))
        missing = np.nonzero(found < 0)[0]
        if len(missing):
            new = pieces.take(pa.array(missing))
            if self.words is not None:
                plain = pc.match_substring_regex(new, PLAIN)
                own, plain = new.filter(plain), plain.to_numpy(zero_copy_only=False)
                found[missing[plain]] = len(memo) + np.arange(len(own))
                for start in range(0, len(own), PIECES_AT_ONCE):
                    self.learn_words(own.slice(start, PIECES_AT_ONCE))
                missing, new = missing[~plain], new.filter(pa.array(~plain))
            joint = pc.match_substring_regex(new, JOINT)
            cut = {piece: self.parts(piece) for piece in new.filter(joint).to_pylist()}
            wanted = new.filter(pc.invert(joint)).to_pylist()
            wanted += [part for part in dict.fromkeys(part for parts in cut.values() for part in parts) if part not in memo]
            unknown = list(dict.fromkeys(wanted))
            for start in range(0, len(unknown), PIECES_AT_ONCE):
                self.learn(unknown[start : start + PIECES_AT_ONCE])
            several = {piece: [memo[part] for part in parts] for piece, parts in cut.items() if len(parts) > 1}
            if several:
                slot = np.array([k for own in several.values() for k in own], np.int64)
                own = np.cumsum(self.lengths[slot])[np.cumsum([len(own) for own in several.values()]) - 1]
                self.store(list(several), self.ids[ragged(self.starts[slot], self.lengths[slot])], np.diff(own, prepend=0))
            found[missing] = [memo[names[k]] for k in missing.tolist()]
        return found

    def store(self, pieces: list[str], new: np.ndarray, lengths: np.ndarray) -> None:
        """Keep the ids ``new`` of pieces that are not known yet, ``lengths`` of them each."""
        first, n = len(self.memo), len(self.memo) + len(pieces)
        while self.used + len(new) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while n > len(self.starts):
            self.starts, self.lengths = (np.concatenate([a, np.empty_like(a)]) for a in (self.starts, self.lengths))
        self.ids[self.used : self.used + len(new)] = new
        self.lengths[first:n] = lengths
        self.starts[first:n] = self.used + np.cumsum(lengths) - lengths
        self.used += len(new)
        self.memo.update(zip(pieces, range(first, n), strict=True))
        self.chars += sum(map(len, pieces))

    def has_added(self, text: str) -> bool:
        return any(content in text for content in self.added)

    def whole(self, text: str) -> bytes:
        tokenizer = self.default if self.has_added(text) else self.tokenizer
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.width).tobytes()

    def learn(self, new: list[str]) -> None:
        """Encode pieces in one call: each follows a newline, which is always a match of its own, and ends before the next."""
        joined = "\n".join(new) + "\n"
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.width)
        ends = np.cumsum(self.bytes[ids])
        sizes = np.array([len(piece.encode()) for piece in new])
        last = np.searchsorted(ends, np.cumsum(sizes + 1))  # the newline after each piece
        if not (self.newline == ids[last]).all():
            raise ValueError("a token reaches across the end of a piece")
        self.store(new, np.delete(ids, last), np.diff(last, prepend=-1) - 1)

    def learn_words(self, new: pa.Array) -> None:
        """Encode plain words in one call. The library leaves out the newlines between them."""
        names = strings(new)
        joined = MARKS[np.frombuffer("\n".join(names).encode(), np.uint8)].tobytes().decode("utf-16-le")
        ids = np.array(self.words.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.width)
        ends = np.cumsum(self.bytes[ids])
        wanted = np.cumsum(pc.binary_length(new).to_numpy(zero_copy_only=False))
        last = np.searchsorted(ends, wanted)  # the last token of each word
        if len(ids) != last[-1] + 1 or not (ends[last] == wanted).all():
            raise ValueError("a token reaches across the end of a word")
        self.store(names, ids, np.diff(last, prepend=-1))

    @staticmethod
    def parts(piece: str) -> list[str]:
        """Cut a piece further where matches always end: around a newline between other characters, and before a full stop or comma at the end of a word."""
        out = []
        for k, line in enumerate(piece.split("\n")):
            if k:
                out.append("\n")
            if not line or line[0].isspace() and k or line[-1].isspace():
                return [piece]
            if line[-1] in ".," and line[-2:-1].isalnum():
                out += [line[:-1], line[-1]]
            else:
                out.append(line)
        return out


def write_records(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES, added_tokens: bool = False
) -> DataFrame:
    """Encode whole texts, write them in ascending id, and return the manifest: one row for each data file.

    Null ids come first; equal ids stay together, in the order of their texts; a null text is empty and gives the end
    id alone. ``added_tokens``: see ``PieceEncoder``. Columns other than the two are not read. The manifest is written to ``folder`` as well.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:  # a fixed file of a few MB
        model = share(spark, PieceEncoder(f.read(), end_id, added_tokens))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = opened(model)
        writer = None
        for batch in slices(batches, "text"):
            parts = batch.column("part").to_pylist()
            writer = writer or Writer(folder, parts[0], file_bytes)
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text")), strict=True):
                ids = np.frombuffer(data, encoder.width)
                writer.add(frame(pack(doc_id, ids)), len(ids))
        if writer:
            writer.close()
            if writer.done:
                yield pa.RecordBatch.from_pydict(dict(zip("part seq path index_path n_records n_ids".split(), map(list, zip(*writer.done, strict=True)), strict=True)))

    ordered = (
        docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col))
        .repartitionByRange(F.col("doc_id"))
        .withColumn("part", F.spark_partition_id().cast("long"))
        .sortWithinPartitions("doc_id", "text")
    )
    manifest = ordered.mapInArrow(run, MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """Add ``start``, the ids in all files before: summed within blocks of parts, then over the blocks, of which there are few."""
    files = manifest.withColumn("block", F.floor(F.col("part") / PARTS_IN_BLOCK))
    over = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = files.groupBy("block").agg(F.sum("n_ids").alias("n")).select("block", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))
    within = Window.partitionBy("block").orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))
    return files.join(blocks, "block").withColumn("start", start).drop("block", "before")


def read_back(manifest: DataFrame) -> DataFrame:
    """Read every file of a manifest, check every checksum, and give doc_id, start, n_tokens and the ids' CRC-32."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                store, inner = open_fs(path)
                with store.open_input_stream(inner) as f:
                    data = f.read()
                out: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
                for doc_id, ids in read_records(data):
                    out["doc_id"].append(doc_id)
                    out["start"].append(start)
                    out["n_tokens"].append(len(ids))
                    out["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                    start += len(ids)
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(name, pa.int64()) for name in out]))

    n = max(1, manifest.count())
    spread = with_starts(manifest).repartition(n, "path")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_dir(spark, "records")
    manifest = write_records(table(prepare(spark), sf_dir, "documents"), folder, vocabulary("byte_bpe_50k.json"), end_id=2, added_tokens=True)
    return read_back(manifest)
