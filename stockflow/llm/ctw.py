"""Language-model scores by context-tree weighting over bytes.

A byte is written as eight binary decisions. For each decision there is a tree of contexts: the root knows no byte before, a node at depth d the last d
bytes. A node's own estimate is Krichevsky and Trofimov's, from its counts a and b of the decision's outcomes; the weighted probability of
its data is half that of its own estimate plus half the product over its children, so all depths are mixed by what they earned on the training texts.
A prediction goes down the path of the text's last bytes and mixes the estimates of its nodes with these weights.

A context is a node if it occurs at least ``LEAST`` times in the training texts, whatever their size. The rest of a node's data
counts as one more child, which has an estimate of its own. All counts are over all training texts.

The tree is never held as a whole. Contexts are dealt to buckets by their last ``TOP`` bytes: a bucket has all longer contexts of such a root, a task sums their log
weights upwards and hands the sums of the roots to the driver, which has the shorter contexts (at most 256^2 + 257). Then the tasks carry the driver's mixtures
down again, to the log probability of every run of bytes that some text holds. That is a table: its frequent head is broadcast, the rest meets the texts' runs by bucket.
Runs are shuffled as packed columns, one row for each bucket of a slice of texts: sorted runs as differences, and numbers by the place of their bytes.

Texts are scored as their tokens: words in lower case (A-Z) with one space between, and a newline as the end. Before a text
stand newlines. As a base line, each token also has its smoothed frequency among the training tokens.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.lake import materialise
from stockflow.llm.common import fold, one_row_per_id, opened, prepare, share, slices, table

DEPTH = 6
#: A context that occurs so often is a node.
LEAST = 2
#: Contexts of fewer bytes are worked on in the driver, the others in tasks.
TOP = 3
#: Runs of bytes that make up at least this share of all bytes are broadcast with their log probability: at most 1 / GRAM_HEAD_SHARE of them. The others are joined.
GRAM_HEAD_SHARE = 1 / 4_000_000
#: A task works on whole roots, of about so many runs together.
GRAMS_AT_ONCE = 300_000
#: A bucket has the runs and words of about so many bytes of text; few texts are dealt to as many buckets as there are cores.
BUCKET_BYTES, LEAST_BUCKET_BYTES = 16 * 1024 * 1024, 1024 * 1024
#: Tasks that work on the buckets, for each core.
TASKS_PER_CORE = 2
#: Words that make up at least this share of all tokens are broadcast: at most 1 / HEAD_SHARE of them. The others are joined.
HEAD_SHARE = 1 / 200_000
ADDED = 0.1
END = b"\n"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SLICE_BYTES = 2 * 1024 * 1024
#: Nodes worked on at once, and the mark of a context that is no node.
CHUNK, NO_NODE = 2048, np.iinfo(np.int32).max
WORDS_KEPT, GRAMS_KEPT, PAIRS_KEPT = 400_000, 2_000_000, 2_000_000


def tokens_of(text: str | None) -> list[bytes]:
    """Words; bytes split at 0x20 and 0x09 to 0x0D."""
    return (text or "").encode().translate(LOWER).split()


def sequence(texts: list[list[bytes]], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as bytes, each after ``depth`` newlines, and where each text begins and ends."""
    bodies = [b" ".join(words) + END for words in texts]
    data = np.frombuffer(b"".join(END * depth + body for body in bodies), np.uint8)
    ends = np.cumsum([depth + len(body) for body in bodies])
    return data, ends - [len(body) for body in bodies], ends


def inside_of(n: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` bytes belong to a text."""
    inside = np.zeros(n + 1, np.int8)
    inside[begins] += 1
    np.subtract.at(inside, ends, 1)
    return np.cumsum(inside[:-1], dtype=np.int8) > 0


def runs_at(data: np.ndarray, depth: int, bits: int) -> np.ndarray:
    """For every byte but the first ``depth`` the run of ``depth`` bytes before it and itself, as a number whose lowest ``bits`` it is."""
    run = data[: len(data) - depth].astype(np.int64)
    for k in range(1, depth + 1):
        run <<= bits
        run |= data[k : len(data) - depth + k]
    return run


def grams_at(texts: list[list[bytes]], depth: int) -> np.ndarray:
    """For every byte of every text the run of ``depth`` bytes before it and itself, as a number whose lowest byte it is."""
    data, begins, ends = sequence(texts, depth)
    return runs_at(data, depth, 8)[inside_of(len(data), begins, ends)[depth:]]


def grams_of(texts: list[list[bytes]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of ``depth`` bytes with the byte after them, and their counts."""
    return np.unique(grams_at(texts, depth), return_counts=True)


def added(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal grams put together."""
    order = np.argsort(grams, kind="stable")
    grams = grams[order]
    begins = np.nonzero(np.append(True, grams[1:] != grams[:-1]))[0]
    return grams[begins], np.add.reduceat(counts[order], begins, dtype=np.int64)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers of eight bytes, compressed byte place by byte place: places that are empty or alike take no room."""
    places = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(numbers).to_bytes(8, "little") + pa.compress(places, "zstd", asbytes=True)


def unpacked(data: bytes, kind: type = np.int64) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    places = pa.decompress(data[8:], 8 * n, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(places, np.uint8).reshape(8, n).T).view(kind).ravel()


def packed_grams(grams: np.ndarray) -> bytes:
    """Ascending grams, as the differences between them."""
    return packed(np.diff(grams, prepend=0))


def unpacked_grams(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data))


def roots_of(grams: np.ndarray, top: int) -> np.ndarray:
    """The last ``top`` bytes of the contexts."""
    return grams >> 8 & (1 << 8 * top) - 1


def dealt(grams: np.ndarray, top: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Buckets and the places of their grams, in the order of the places. A root is in one bucket as a whole."""
    if not len(grams):
        return
    bucket = ((roots_of(grams, top) * 2654435761 & 0xFFFFFFFF) >> 8) % buckets
    order = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")
    at = starts(bucket[order])
    for begin, end in zip(at, [*at[1:], len(order)], strict=True):
        yield int(bucket[order[begin]]), order[begin:end]


def whole_roots(grams: np.ndarray, top: int) -> Iterator[np.ndarray]:
    """Places, ascending, of the grams of whole roots, about ``GRAMS_AT_ONCE`` together."""
    root = roots_of(grams, top)
    order = np.argsort(root, kind="stable")
    at = starts(root[order])
    at = at[starts(at // GRAMS_AT_ONCE)]
    for begin, end in zip(at, [*at[1:], len(order)], strict=True):
        yield np.sort(order[begin:end])


def buckets_for(rows: DataFrame) -> int:
    """From the bytes of all texts."""
    n = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return 1 + max(n // BUCKET_BYTES, min(n // LEAST_BUCKET_BYTES, rows.sparkSession.sparkContext.defaultParallelism))


def count_grams(rows: DataFrame, depth: int, buckets: int) -> DataFrame:
    """A row for each bucket: its grams, ascending, with ``count`` over the rows that are learned from (``learn``) and ``seen`` over all rows, packed; ``total`` is the sum of ``seen``.

    Grams are summed in each task before they are shuffled.
    """
    top = min(TOP, depth)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0  # of the grams that are not put together yet
        for batch in slices(batches, "text", SLICE_BYTES):
            texts, learn = [tokens_of(t) for t in batch.column("text").to_pylist()], batch.column("learn").to_pylist()
            for flag in (True, False):
                if own := [t for t, x in zip(texts, learn, strict=True) if x == flag]:
                    found, times = grams_of(own, depth)
                    held.append((found, np.stack([times * flag, times], axis=1).astype(np.int32)))  # a task reads less than 2^31 bytes
                    n += len(found)
            if n > GRAMS_KEPT:
                held, n = [joined(held)], 0
                if len(held[0][0]) > GRAMS_KEPT:
                    yield from parts(*held.pop())
        if held:
            yield from parts(*joined(held))

    def joined(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        grams, counts = np.concatenate([g for g, _ in held]), np.concatenate([c for _, c in held])
        held.clear()
        return added(grams, counts)

    def parts(grams: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for bucket, at in dealt(grams, top, buckets):
            yield row(bucket, grams[at], counts[at])

    def row(bucket: int, grams: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"bucket": pa.array([bucket], pa.int32()), "grams": [packed_grams(grams)], "count": [packed(counts[:, 0].astype(np.int64))], "seen": [packed(counts[:, 1].astype(np.int64))], "total": [int(counts[:, 1].sum())]}
        )

    def together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, grams, counts = 0, [], []
        for batch in batches:
            for r in batch.to_pylist():
                bucket = r["bucket"]  # a task has one
                grams.append(unpacked_grams(r["grams"]))
                counts.append(np.stack([unpacked(r["count"]), unpacked(r["seen"])], axis=1))
        if grams:
            yield row(bucket, *joined(list(zip(grams, counts, strict=True))))

    schema = "bucket int, grams binary, count binary, seen binary, total long"
    found = rows.select("text", "learn").mapInArrow(run, schema)
    return found.repartitionById(buckets, F.col("bucket")).mapInArrow(together, schema)


def count_words(rows: DataFrame) -> DataFrame:
    """word, c over all rows, summed in each task before they are shuffled; the end of a text is the word ``END``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in slices(batches, "text", SLICE_BYTES):
            for text in batch.column("text").to_pylist():
                found.update(tokens_of(text))
            found[END] += batch.num_rows
            if len(found) > WORDS_KEPT:
                yield of(found)
                found.clear()
        yield of(found)

    def of(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "c"])

    return rows.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x of 1/2 and above, by Stirling's series after moving small arguments up."""
    low = np.zeros_like(x)
    for _ in range(7):
        small = x < 7
        if not small.any():
            break
        low[small] += np.log(x[small])
        x = np.where(small, x + 1, x)
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + (1 / 12 - (1 / 360 - 1 / (1260 * x * x)) / (x * x)) / x - low


def log_block(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the estimator's probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - np.log(np.pi) - log_gamma(a + b + 1.0)


TABLE = 4096
LOG_GAMMA = np.stack([log_gamma(np.arange(2 * TABLE) + 0.5), log_gamma(np.arange(2 * TABLE) + 1.0)])


def log_counts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``log_block`` of whole numbers, small ones by a table."""
    large = (a >= TABLE) | (b >= TABLE)
    x, y = (np.where(large, 0, c).astype(np.int64) for c in (a, b))
    out = LOG_GAMMA[0, x] + LOG_GAMMA[0, y] - np.log(np.pi) - LOG_GAMMA[1, x + y]
    if large.any():
        out[large] = log_block(a[large], b[large])
    return out


class Layer:
    """One depth of some roots: grams (context and byte) in ascending order, their counts, whether their contexts are nodes, and the places of their shorter grams."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int, least: float):
        self.grams, self.counts = grams, counts
        at = starts(grams >> 8)
        self.node = np.repeat((np.add.reduceat(counts, at) >= least) | (depth == 0), np.diff(at, append=len(grams)))
        self.shorter, self.above = np.unique(grams & ((1 << 8 * depth) - 1), return_inverse=True)

    def decisions(self, j: int) -> Decisions:
        return Decisions(self, j)


def starts(values: np.ndarray) -> np.ndarray:
    """Where equal values, which stand together, begin."""
    return np.nonzero(np.append(True, values[1:] != values[:-1]))[0]


class Decisions:
    """The decisions on bit ``j`` that a layer's grams come to: first gram, counts of zeros and ones."""

    def __init__(self, layer: Layer, j: int):
        self.at = starts(layer.grams >> 8 - j)
        self.group = np.repeat(np.arange(len(self.at)), np.diff(self.at, append=len(layer.grams)))
        self.ones = np.add.reduceat(layer.counts * (layer.grams >> 7 - j & 1), self.at)
        self.zeros = np.add.reduceat(layer.counts, self.at) - self.ones
        self.node = layer.node[self.at]
        self.above = layer.above[self.at]

    def weigh(self, sums: np.ndarray | None) -> None:
        """Log weight, and the parts of it with the node itself and with its children. ``sums``: weights, zeros and ones of the children; none at the last depth."""
        own = log_counts(self.zeros, self.ones)
        if sums is None:
            self.weight, self.own, self.below = own, np.ones(len(own)), np.zeros(len(own))
            self.rest = np.zeros((2, len(own)))
        else:
            self.rest = np.stack([self.zeros - sums[1], self.ones - sums[2]])
            below = sums[0] + log_counts(*self.rest)
            self.weight = np.logaddexp(own, below) - np.log(2)
            self.own, self.below = np.exp(own - np.log(2) - self.weight), np.exp(below - np.log(2) - self.weight)

    def values(self) -> np.ndarray:
        return np.stack([self.weight, self.zeros, self.ones])

    def mix(self, state: np.ndarray) -> np.ndarray:
        """From the states of the decisions above: probabilities of zero and one mixed so far, the weight left, and the two as they are if the path ends here."""
        n = self.zeros + self.ones + 1
        left = state[2] * self.below
        share = state[2] * self.own / n
        zero, one = state[0] + share * (self.zeros + 0.5), state[1] + share * (self.ones + 0.5)
        rest = left / (self.rest.sum(axis=0) + 1)
        mixed = np.stack([zero, one, left, zero + rest * (self.rest[0] + 0.5), one + rest * (self.rest[1] + 0.5)])
        return np.where(self.node, mixed, state)


def layers_of(grams: np.ndarray, counts: np.ndarray, top: int, depth: int, least: float) -> list[Layer]:
    """Layers of the depths from ``top`` to ``depth``; ``grams``, in ascending order, are those of the last."""
    layers = [Layer(grams, counts, depth, least)]
    for d in range(depth - 1, top - 1, -1):
        last = layers[-1]
        layers.append(Layer(last.shorter, np.bincount(last.above, weights=last.counts), d, least))
    return layers[::-1]


def weighed(layers: list[Layer], j: int, sums: Callable[[Decisions], np.ndarray] | None = None) -> list[Decisions]:
    """The decisions on bit ``j`` of all layers, weighed from the last one up; ``sums`` has those of children that are not among the layers."""
    out: list[Decisions] = []
    for layer in reversed(layers):
        mine = layer.decisions(j)
        if out:
            parents = mine.group[out[-1].above][out[-1].node]
            mine.weigh(np.stack([np.bincount(parents, weights=v[out[-1].node], minlength=len(mine.at)) for v in out[-1].values()]))
        else:
            mine.weigh(sums(mine) if sums else None)
        out.append(mine)
    return out[::-1]


def decision_keys(grams: np.ndarray, j: int) -> np.ndarray:
    """Context and decision of grams on bit ``j``: a one and the bits so far; a whole byte is 256 and its value."""
    return grams >> 8 << 9 | 1 << j | (grams & 255) >> 8 - j


def sums_of_roots(grams: np.ndarray, counts: np.ndarray, top: int, depth: int, least: float) -> dict[str, np.ndarray]:
    """key, zeros, ones and weight: for each decision of contexts of ``top`` - 1 bytes what their children have, and for each byte after them its count (as zeros)."""
    layers = layers_of(grams, counts, top, depth, least)
    own = layers[0].shorter
    n = np.bincount(layers[0].above, weights=layers[0].counts)
    parts = [(decision_keys(own, 8), np.stack([np.zeros(len(own)), n, np.zeros(len(own))]))]
    for j in range(8):
        first = weighed(layers, j)[0]
        parts.append((decision_keys(own[first.above[first.node]], j), first.values()[:, first.node]))
    weight, zeros, ones = np.concatenate([v for _, v in parts], axis=1)
    return {"key": np.concatenate([k for k, _ in parts]), "zeros": zeros, "ones": ones, "weight": weight}


def states_of_top(key: np.ndarray, sums: np.ndarray, top: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys, ascending, and states of the decisions of contexts of ``top`` - 1 bytes; ``sums``: weights, zeros and ones of each key's children, by ascending key."""
    whole = key & 511 >= 256
    if not whole.any():
        return key[:0], np.zeros((5, 0))
    grams, children, sums, counts = key[whole] >> 9 << 8 | key[whole] & 255, key[~whole], sums[:, ~whole], sums[1, whole]
    layers = layers_of(grams, counts, 0, top - 1, least)
    keys, states = [], []
    for j in range(8):

        def below(mine: Decisions, j: int = j) -> np.ndarray:
            wanted = decision_keys(grams[mine.at], j)
            if not len(children):
                return np.zeros((3, len(wanted)))
            at = np.minimum(np.searchsorted(children, wanted), len(children) - 1)
            return np.where(children[at] == wanted, sums[:, at], 0)

        path = weighed(layers, j, below)
        state = np.tile(np.array([0.0, 0, 1, 0, 0])[:, None], len(path[0].at))
        for d, mine in enumerate(path):
            state = mine.mix(state if d == 0 else state[:, path[d - 1].group[mine.above]])
        keys.append(decision_keys(grams[path[-1].at], j))
        states.append(state)
    key = np.concatenate(keys)
    order = np.argsort(key)
    return key[order], np.concatenate(states, axis=1)[:, order]


def logs_of_roots(grams: np.ndarray, counts: np.ndarray, top: int, depth: int, least: float, keys: np.ndarray, states: np.ndarray) -> np.ndarray:
    """log10 probability of each gram's byte after its context."""
    layers = layers_of(grams, counts, top, depth, least)
    logs = np.zeros(len(grams))
    for j in range(8):
        path = weighed(layers, j)
        state = states[:, np.searchsorted(keys, decision_keys(layers[0].shorter[path[0].above], j))]
        for d, mine in enumerate(path):
            state = mine.mix(state if d == 0 else state[:, path[d - 1].group[mine.above]])
        logs += np.log10(np.where(grams >> 7 - j & 1, state[4][mine.group], state[3][mine.group]))
    return logs


def gram_logs(grams: DataFrame, depth: int, least: float = LEAST, head_from: float = np.inf) -> DataFrame:
    """For each bucket its grams and the log10 probabilities of their bytes, packed: those seen ``head_from`` times and more (``head``), and the others (``grams``, ``logs``).

    ``grams`` is as ``count_grams`` gives it; contexts counted ``least`` times and more are nodes.
    """
    top = min(TOP, depth)

    def up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                grams, counts = unpacked_grams(r["grams"]), unpacked(r["count"]).astype(float)
                for part in whole_roots(grams, top):
                    out = sums_of_roots(grams[part], counts[part], top, depth, least)
                    for at in range(0, len(out["key"]), 100_000):
                        yield pa.RecordBatch.from_pydict({name: values[at : at + 100_000] for name, values in out.items()})

    sums = grams.select("grams", "count").mapInArrow(up, "key long, zeros double, ones double, weight double")
    found = sums.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("weight", "zeros", "ones")]).toArrow()  # bounded by the contexts of two bytes
    key = np.asarray(found["key"], np.int64)
    order = np.argsort(key)
    shared = share(grams.sparkSession, states_of_top(key[order], np.stack([np.asarray(found[c], float)[order] for c in ("weight", "zeros", "ones")]), top, least))

    def down(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                grams, counts = unpacked_grams(r["grams"]), unpacked(r["count"]).astype(float)
                logs = np.zeros(len(grams))
                for part in whole_roots(grams, top):
                    logs[part] = logs_of_roots(grams[part], counts[part], top, depth, least, *opened(shared))
                often = unpacked(r["seen"]) >= head_from
                columns = [packed_grams(grams[~often]), packed(logs[~often]), packed_grams(grams[often]), packed(logs[often])]
                yield pa.RecordBatch.from_arrays([pa.array([r["bucket"]], pa.int32()), *[pa.array([c], pa.binary()) for c in columns]], names=LOGS)

    return grams.select("bucket", "grams", "count", "seen").mapInArrow(down, "bucket int, grams binary, logs binary, head binary, head_logs binary")


LOGS = ["bucket", "grams", "logs", "head", "head_logs"]


def rare_runs(texts: list[list[bytes]], depth: int, head: np.ndarray, head_logs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each text the sum over its grams of the head; and of the other grams, by ascending gram, each with a text that has it and how often. ``head`` ends with a gram that cannot be."""
    data, begins, ends = sequence(texts, depth)
    inside = inside_of(len(data), begins, ends)[depth:]
    # Bytes are numbered by those that occur, so that a run and its text mostly go into one number, which is sorted.
    occurs = np.bincount(data, minlength=256) > 0
    letters, number = np.nonzero(occurs)[0], (np.cumsum(occurs) - 1).astype(np.uint8)
    bits, of_text = max(1, int(len(letters) - 1).bit_length()), int(len(texts)).bit_length()
    owner = np.repeat(np.arange(len(texts)), ends - begins)
    if (depth + 1) * bits + of_text < 63:
        pairs = runs_at(number[data], depth, bits)[inside]
        pairs <<= of_text
        pairs |= owner
        pairs.sort()
        at = starts(pairs)
        pairs, times = pairs[at], np.diff(at, append=len(pairs))
        runs, owner = pairs >> of_text, pairs & (1 << of_text) - 1
        first = starts(runs)
        own = np.zeros(len(first), np.int64)
        for k in range(depth, -1, -1):
            own = own << 8 | letters[runs[first] >> k * bits & (1 << bits) - 1]
    else:
        runs = runs_at(data, depth, 8)[inside]
        order = np.lexsort((owner, runs))
        runs, owner = runs[order], owner[order]
        at = np.nonzero(np.append(True, (runs[1:] != runs[:-1]) | (owner[1:] != owner[:-1])))[0]
        runs, owner, times = runs[at], owner[at], np.diff(at, append=len(order))
        first = starts(runs)
        own = runs[first]
    n = np.diff(first, append=len(runs))
    at = np.searchsorted(head, own)
    known = head[at] == own
    sums = np.bincount(owner, weights=np.repeat(np.where(known, head_logs[at], 0.0), n) * times, minlength=len(texts))
    rare = ~np.repeat(known, n)
    return sums, np.repeat(own[~known], n[~known]), owner[rare], times[rare]


def rare_words(texts: list[list[bytes]], head: dict[bytes, float]) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """For each text the sum over its words of the head, and their number; and the other words, and for each its place among them with a text that has it and how often."""
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    number = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(texts)))}
    words, place = list(number), np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, len(owner))
    logs = np.array([head.get(w, 1.0) for w in words])
    known = logs <= 0
    base = np.bincount(owner, weights=np.where(known, logs, 0.0)[place], minlength=len(texts))
    n_known = np.bincount(owner[known[place]], minlength=len(texts))
    rare = ~known[place]
    pairs, times = np.unique((np.cumsum(~known) - 1)[place[rare]] * len(texts) + owner[rare], return_counts=True)
    return base, n_known, [w for w, x in zip(words, known.tolist(), strict=True) if not x], pairs // len(texts), pairs % len(texts), times


def score_parts(rows: DataFrame, logs: DataFrame, words: DataFrame, depth: int, buckets: int, head: dict[bytes, float], below: float) -> DataFrame:
    """doc_id and parts of its sums: what the broadcast heads have, and for each task the sums over the other grams and words of its buckets.

    ``words`` are the known ones that are not in the head, with their count ``c``.
    """
    found = list(logs.select("head", "head_logs").toLocalIterator())  # at most 1 / head_share grams
    grams = np.concatenate([*[unpacked_grams(bytes(r["head"])) for r in found], [np.iinfo(np.int64).max]])
    values = np.concatenate([*[unpacked(bytes(r["head_logs"]), np.float64) for r in found], [0.0]])
    order = np.argsort(grams)
    shared = share(rows.sparkSession, (grams[order], values[order], head))
    top = min(TOP, depth)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, logs, head = opened(shared)
        for place, batch in enumerate(slices(batches, "text", SLICE_BYTES)):
            ids = np.asarray(batch.column("doc_id"))
            texts = [tokens_of(t) for t in batch.column("text").to_pylist()]
            score, runs, owner, times = rare_runs(texts, depth, grams, logs)
            for bucket, at in dealt(runs, top, buckets):
                yield row(bucket, grams=packed_grams(runs[at]), docs=packed(ids[owner[at]]), times=packed(times[at]))
            del runs, owner, times
            for t in texts:
                t.append(END)
            base, n_known, rare, word, owner, times = rare_words(texts, head)
            lengths = np.array([len(t) for t in texts])
            yield row(place % buckets, docs=packed(ids), sums=[packed(x) for x in (lengths, n_known, base, score)])
            bucket = np.array([zlib.crc32(w) for w in rare], np.int64) % buckets
            by_bucket = np.argsort(bucket[word], kind="stable")
            for at in np.split(by_bucket, starts(bucket[word][by_bucket])[1:]) if len(word) else []:
                first = starts(word[at])
                number = np.repeat(np.arange(len(first)), np.diff(first, append=len(at)))
                own = word[at[first]].tolist()
                yield row(int(bucket[own[0]]), words=b" ".join(rare[i] for i in own), numbers=packed(number), docs=packed(ids[owner[at]]), times=packed(times[at]))

    def row(bucket: int, **columns: object) -> pa.RecordBatch:
        of = {"sums": pa.list_(pa.binary())}
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *[pa.array([columns.get(c)], of.get(c, pa.binary())) for c in PACKED]], names=["bucket", *PACKED])

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task has some buckets, one after the other: first the logs and words of a bucket, then pairs and sums of documents. Sums are kept across the buckets, so a document has few."""
        bucket, grams, logs, counts, held, n = None, np.empty(0, np.int64), np.empty(0), {}, [], 0
        for batch in batches:
            buckets_of = np.asarray(batch.column("bucket"))
            at = starts(buckets_of) if len(buckets_of) else []
            for begin, end in zip(at, [*at[1:], len(buckets_of)], strict=False):
                part = batch.slice(begin, end - begin)
                if buckets_of[begin] != bucket:
                    bucket, grams, logs, counts = buckets_of[begin], grams[:0], logs[:0], {}
                words = part.filter(pc.is_valid(part.column("word")))
                counts.update(zip(words.column("word").to_pylist(), words.column("c").to_pylist(), strict=True))
                for r in part.filter(pc.is_null(part.column("word"))).to_pylist():
                    if r["logs"] is not None:
                        grams, logs = unpacked_grams(r["grams"]), unpacked(r["logs"], np.float64)
                        continue
                    if r["sums"] is not None:
                        lengths, n_known, base, score = r["sums"]
                        yield from parts(unpacked(r["docs"]), unpacked(lengths), unpacked(n_known), unpacked(base, np.float64), unpacked(score, np.float64))
                        continue
                    held.append((unpacked(r["docs"]), *(of_grams(r, grams, logs) if r["grams"] is not None else of_words(r, counts))))
                    n += len(held[-1][0])
                    if n > PAIRS_KEPT:
                        held = [summed(held)]
                        n = len(held[0][0])
                        if n > PAIRS_KEPT // 2:
                            yield from of_documents(*held.pop())
                            n = 0
        if held:
            yield from of_documents(*summed(held))

    def of_grams(r: dict, grams: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, ...]:
        runs, times = unpacked_grams(r["grams"]), unpacked(r["times"])
        at = np.minimum(np.searchsorted(grams, runs), len(grams) - 1)
        if not np.array_equal(grams[at], runs):
            raise RuntimeError("a run of bytes was not counted")
        none = np.zeros(len(times))
        return none, none, logs[at] * times

    def of_words(r: dict, counts: dict[bytes, int]) -> tuple[np.ndarray, ...]:
        times = unpacked(r["times"])
        c = np.array([counts.get(w, 0) for w in r["words"].split(b" ")])[unpacked(r["numbers"])]
        return np.where(c > 0, times, 0), times * np.log10((c + ADDED) / below), np.zeros(len(times))

    def summed(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        docs, *columns = (np.concatenate(x) for x in zip(*held, strict=True))
        own, place = np.unique(docs, return_inverse=True)
        return own, *(np.bincount(place, weights=x, minlength=len(own)) for x in columns)

    def of_documents(docs: np.ndarray, n_known: np.ndarray, base: np.ndarray, score: np.ndarray) -> Iterator[pa.RecordBatch]:
        yield from parts(docs, np.zeros(len(docs), np.int64), n_known.astype(np.int64), base, score)

    def parts(*columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(columns[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 100_000]) for x in columns], names=PARTS)

    pairs = rows.select("doc_id", "text").mapInArrow(run, "bucket int, " + ", ".join(f"{c} {'array<binary>' if c == 'sums' else 'binary'}" for c in PACKED))
    known = words.select((F.crc32("word") % buckets).cast("int").alias("bucket"), "word", "c")
    both = pairs.unionByName(logs.select("bucket", "grams", "logs"), allowMissingColumns=True).unionByName(known, allowMissingColumns=True)
    # As many tasks as the cluster has use for, however many buckets there are: the sums a document has are as many as the tasks, or its pairs if those are fewer.
    tasks = min(buckets, TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism)
    dealt_out = both.repartitionById(tasks, F.col("bucket") % tasks).sortWithinPartitions("bucket", F.col("docs").isNotNull())
    return dealt_out.mapInArrow(meet, "doc_id long, n_tokens long, n_known long, base double, score double")


PACKED = ["grams", "words", "numbers", "docs", "times", "sums"]
PARTS = ["doc_id", "n_tokens", "n_known", "base", "score"]


class Level:
    """The nodes of one depth: contexts in ascending order, and counts of zeros and ones at each of the 255 decisions."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.contexts, row = np.unique(grams >> 8, return_inverse=True)
        self.zeros, self.ones = (np.zeros((len(self.contexts), 255)) for _ in range(2))  # double: whole numbers stay exact when they are subtracted
        byte = grams & 255
        first = np.searchsorted(row, np.arange(0, len(self.contexts) + CHUNK, CHUNK))
        for begin, (at, end) in zip(range(0, len(self.contexts), CHUNK), zip(first[:-1], first[1:], strict=True), strict=False):
            both = np.zeros((min(CHUNK, len(self.contexts) - begin), 512))  # decision k leads to 2k and 2k + 1; a byte is 256 + its value
            both[row[at:end] - begin, 256 + byte[at:end]] = counts[at:end]
            for k in range(255, 0, -1):
                both[:, k] = both[:, 2 * k] + both[:, 2 * k + 1]
            self.zeros[begin : begin + CHUNK], self.ones[begin : begin + CHUNK] = both[:, 2::2], both[:, 3::2]
        self.parents = np.empty(0, np.int64)

    def rest(self, children: Level | None) -> tuple[np.ndarray, np.ndarray]:
        """Counts that no child of a node has."""
        if children is None:
            return self.zeros, self.ones
        zeros, ones = self.zeros.copy(), self.ones.copy()
        np.subtract.at(zeros, children.parents, children.zeros)
        np.subtract.at(ones, children.parents, children.ones)
        return zeros, ones


class ContextTree:
    """The tree as a whole in one process, for small inputs. For each node the log10 probability of every byte, and its children by the byte before."""

    def __init__(self, entries: list[tuple[np.ndarray, np.ndarray]]):
        """``entries``: for each depth, sorted grams (context and byte) of the contexts that are nodes, and their counts."""
        levels = [Level(*entry) for entry in entries]
        while len(levels) > 1 and not len(levels[-1].contexts):
            levels.pop()
        if not len(levels[0].contexts):  # nothing to learn from
            levels = [Level(np.zeros(1, np.int64), np.zeros(1))]
        self.depth = len(levels) - 1
        for d in range(1, len(levels)):
            levels[d].parents = np.searchsorted(levels[d - 1].contexts, levels[d].contexts & ((1 << 8 * (d - 1)) - 1))
        after = [*levels[1:], None]

        own_share: list[np.ndarray] = [np.empty(0)] * len(levels)  # how much of the weight is with the node itself
        below = np.empty(0)
        for d in range(self.depth, -1, -1):
            level, shares, sums = levels[d], np.ones((len(levels[d].contexts), 255), np.float32), np.zeros((len(levels[d].contexts), 255))
            rest_zeros, rest_ones = level.rest(after[d])
            if d < self.depth:
                np.add.at(sums, after[d].parents, below)
            for at in range(0, len(level.contexts), CHUNK):
                part = slice(at, at + CHUNK)
                own = log_block(level.zeros[part].astype(float), level.ones[part].astype(float))
                if d < self.depth:
                    children = sums[part] + log_block(rest_zeros[part].astype(float), rest_ones[part].astype(float))
                    sums[part] = np.logaddexp(own, children) - np.log(2)
                    shares[part] = np.exp(own - np.log(2) - sums[part])
                else:
                    sums[part] = own
            own_share[d], below = shares, sums

        first = np.concatenate([[0], np.cumsum([len(level.contexts) for level in levels])])
        self.size = int(first[-1])
        self.inner = int(first[-2])  # nodes from here on are leaves
        self.log10 = np.zeros((self.size, 256), np.float16)
        self.child = np.full((self.inner + 1, 256), NO_NODE, np.int32)
        mixed, left = np.zeros((1, 255)), np.ones((1, 255))
        for d, level in enumerate(levels):
            if d:
                mixed, left = mixed[level.parents], left[level.parents]
                self.child[first[d - 1] + level.parents, level.contexts >> 8 * (d - 1)] = first[d] + np.arange(len(level.contexts))
            rest_zeros, rest_ones = level.rest(after[d])
            for at in range(0, len(level.contexts), CHUNK):
                part = slice(at, at + CHUNK)
                zeros, ones = level.zeros[part].astype(float), level.ones[part].astype(float)
                mixed[part] += left[part] * own_share[d][part] * (ones + 0.5) / (zeros + ones + 1)
                left[part] *= 1 - own_share[d][part]
                zeros, ones = rest_zeros[part].astype(float), rest_ones[part].astype(float)
                one = mixed[part] + left[part] * (ones + 0.5) / (zeros + ones + 1)
                path = np.zeros((len(one), 512))
                for k in range(1, 256):
                    path[:, 2 * k] = path[:, k] + np.log10(1 - one[:, k - 1])
                    path[:, 2 * k + 1] = path[:, k] + np.log10(one[:, k - 1])
                self.log10[first[d] + at : first[d] + at + len(one)] = path[:, 256:]

    def score(self, texts: list[list[bytes]]) -> np.ndarray:
        """log10 probability of each text."""
        depth = max(self.depth, 1)
        data, begins, ends = sequence(texts, depth)
        n = len(data) - depth
        at = np.zeros(n, np.int32)
        deepest = at.copy()
        child = self.child.ravel()
        for d in range(1, self.depth + 1):
            # Row ``inner`` has no children: it takes what has left the tree.
            at = child[(np.minimum(at, self.inner) << 8) | data[depth - d : depth - d + n]]
            deepest = np.where(at < NO_NODE, at, deepest)
        logs = self.log10.ravel()[(deepest << 8) | data[depth:]].astype(float)
        upto = np.concatenate([[0.0], np.cumsum(logs)])
        return upto[ends - depth] - upto[begins - depth]


def score_texts(
    docs: DataFrame, training, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, least: int = LEAST, head_share: float = HEAD_SHARE, gram_head_share: float = GRAM_HEAD_SHARE
) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score for each document, one row an id.

    ``training`` is a condition on doc_id; all texts for which it holds are learned from. A null or empty text has the end as its only token. Rows without id
    are left out. Rows that repeat an id are one document; if their texts differ, the greatest stands for it. Without training texts
    every byte has probability 1/256 and no token is known. Other columns are not read. ``depth`` is 1 to 6.
    """
    spark = docs.sparkSession
    rows = one_row_per_id(docs, id_col, text_col)
    learned = rows.where(training)
    buckets = buckets_for(rows)
    grams = materialise(count_grams(rows.withColumn("learn", F.coalesce(training, F.lit(False))), depth, buckets), "grams")
    seen = grams.agg(F.sum("total")).first()[0] or 0
    logs = materialise(gram_logs(grams, depth, least, max(1.0, seen * gram_head_share)), "logs")
    words = materialise(count_words(learned).where("c > 0"), "words")
    totals = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n, kinds = int(totals[0]), int(totals[1])
    below = n + ADDED * (kinds + 1)
    frequent = F.col("c") >= max(1.0, n * head_share)
    head = {row["word"]: row["c"] for row in words.where(frequent).toLocalIterator()} if n else {}
    head = {bytes(w): float(np.log10((c + ADDED) / below)) for w, c in head.items()}
    parts = score_parts(rows, logs, words.where(~frequent), depth, buckets, head, below)
    return parts.groupBy("doc_id").agg(
        F.max("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        F.sum("base").alias("base_score"),
        F.sum("score").alias("score"),
    )


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    held_out = fold(F.col("doc_id"), 10) == 0
    return score_texts(table(spark, sf_dir, "documents"), ~held_out).withColumn("held_out", held_out)
