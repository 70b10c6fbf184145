"""Similar documents by word shingles: an exact Jaccard join by grouped prefixes, and the components of its links.

With n shingles, a document that links to another at a Jaccard similarity of 3/4 shares at least 3n/4 of them. So if all shingles stand in
one fixed order, the two share one of their first floor(n/4) + 1: their prefixes. The order here is rare first, which keeps frequent shingles out
of prefixes. It need not know all frequencies: shingles whose hash is under ``COUNTED`` of its range come first, by frequency, the others after them.
A document whose prefix holds no shingle of another document has no link; that is nearly every document that is no copy.

Documents of equal size whose prefixes are equal, as far as other documents share them, form one group. Groups, not documents, meet by the
shingles of their prefixes. Pairs of groups are filtered by size and by how many shingles they can share at most, and the
members of what remains are verified by their whole sets. First each group meets the smallest group of each shingle only; what
this connects needs no more pairs, as components are asked for, and the rest of the pairs is then done in full. So a thousand near copies cost about a thousand
comparisons, and no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockflow.lake import materialise
from stockflow.llm.common import one_row_per_id, opened, prepare, share, slices, table
from stockflow.llm.components import components

WORDS = 5
#: Share of the hash range whose shingles are counted and come first in the order.
COUNTED = 0.4
#: Shingles of so many bytes of text are put together before they are shuffled.
PACK_BYTES = 16 * 1024 * 1024
MEMO_ENTRIES = 500_000
MIX = np.uint64(0x9E3779B97F4A7C15)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class Shingler:
    """Distinct shingles of texts as sorted 64-bit hashes; hashes of words are kept in a memo."""

    def __init__(self, words: int = WORDS):
        self.words, self.memo = words, {}  # type: int, dict[bytes, int]

    def of(self, text: str) -> np.ndarray:
        words = text.encode().translate(LOWER).split()  # bytes split at 0x20 and 0x09 to 0x0D
        if not words:
            return np.empty(0, np.uint64)
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        memo = self.memo
        for word in set(words):
            if word not in memo:
                memo[word] = xxhash.xxh64_intdigest(word)
        hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        size = min(self.words, len(words))
        last = len(hashes) - size + 1
        out = np.full(last, size, np.uint64)
        for k in range(size):
            out = (out ^ (out >> np.uint64(29))) * MIX + hashes[k : k + last]
        return np.unique((out ^ (out >> np.uint64(32))) * MIX)


def shingle_rows(docs: DataFrame, words: int, counted: float) -> DataFrame:
    """Rows of two kinds.

    token, doc, more: a shingle and the documents of one pack that hold it.
    token (spread evenly), doc, n, n_counted, copy_of: a document, its number of shingles and of those that are counted, and the first
    document of the pack with the same shingles; that one's shingles stand for both.
    """
    shared = share(docs.sparkSession, Shingler(words))
    limit = np.uint64(counted_limit(counted))
    schema = pa.schema([("token", pa.int64()), ("doc", pa.int64()), ("more", pa.list_(pa.int64())), ("n", pa.int64()), ("n_counted", pa.int64()), ("copy_of", pa.int64())])

    def pack(docs: list[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        first: dict[bytes, int] = {}
        ids, sizes, n_counted, copy_of = [], [], [], []
        tokens, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for doc_id, own in docs:
            ids.append(doc_id)
            sizes.append(len(own))
            head = int(np.searchsorted(own, limit))
            n_counted.append(head)
            same = first.setdefault(hashlib.blake2b(own.tobytes(), digest_size=16).digest(), doc_id) if len(own) else doc_id
            copy_of.append(None if same == doc_id else same)
            if same == doc_id:
                # A prefix longer than the counted shingles goes on with the others, in the order of their hashes.
                tokens.append(own[: max(head, len(own) // 4 + 1)])
                owners.append(np.full(len(tokens[-1]), doc_id, np.int64))
        n = len(ids)
        none = pa.nulls(n, pa.list_(pa.int64()))
        spread = (np.array(ids, np.int64).view(np.uint64) * MIX).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(spread), pa.array(ids, pa.int64()), none, pa.array(sizes, pa.int64()), pa.array(n_counted, pa.int64()), pa.array(copy_of, pa.int64())], schema=schema)
        token, owner = np.concatenate(tokens), np.concatenate(owners)
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        begins = np.nonzero(np.append(True, token[1:] != token[:-1]))[0] if len(token) else np.empty(0, np.int64)
        ends = np.append(begins[1:], len(token))
        several = ends - begins > 1
        rest = np.ones(len(token), bool)
        rest[begins] = False
        offsets = np.concatenate([[0], np.cumsum(ends - begins - 1)]).astype(np.int32)
        more = pa.ListArray.from_arrays(pa.array(offsets), pa.array(owner[rest]), mask=pa.array(~several))
        nothing = pa.nulls(len(begins), pa.int64())
        whole = pa.RecordBatch.from_arrays([pa.array(token[begins].view(np.int64)), pa.array(owner[begins]), more, nothing, nothing, nothing], schema=schema)
        for at in range(0, len(begins), 50_000):
            yield whole.slice(at, 50_000)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, waiting, size = opened(shared), [], 0
        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                waiting.append((doc_id, shingler.of(text or "")))
                size += len(text or "")
                if size >= PACK_BYTES:
                    yield from pack(waiting)
                    waiting, size = [], 0
        if waiting:
            yield from pack(waiting)

    return docs.mapInArrow(run, "token long, doc long, more array<long>, n long, n_counted long, copy_of long")


def counted_limit(counted: float) -> int:
    return min(int(counted * 2**64), 2**64 - 1)


def is_counted(token: Column, counted: float) -> Column:
    """Whether a hash, which Spark holds as a signed number, is among the counted ones."""
    limit = counted_limit(counted)
    return (token >= 0) & (token < limit) if limit <= 2**63 else (token >= 0) | (token < limit - 2**64)


def prefixes(rows: DataFrame, counted: float) -> DataFrame:
    """doc, n, copy_of, n_alone (counted shingles that no other document has) and prefix: shared shingles of the prefix, rare first; null if there are none."""
    n_docs = F.when(F.col("n").isNull(), 1 + F.coalesce(F.size("more"), F.lit(0))).otherwise(0)
    known = rows.withColumn("df", F.sum(n_docs).over(Window.partitionBy("token"))).where("n IS NOT NULL OR df > 1")
    owners = F.concat(F.array("doc"), F.coalesce("more", F.array().cast("array<long>")))
    entry = F.when(F.col("n").isNull(), F.struct(~is_counted(F.col("token"), counted), F.col("df"), F.col("token")))
    spread = known.select(F.explode(owners).alias("doc"), "n", "n_counted", "copy_of", entry.alias("entry")).repartition("doc")
    found = spread.groupBy("doc").agg(F.max("n").alias("n"), F.max("n_counted").alias("n_counted"), F.max("copy_of").alias("copy_of"), F.sort_array(F.collect_list("entry")).alias("entries"))
    shared = F.size(F.filter("entries", lambda e: ~e["col1"]))
    n_alone = F.col("n_counted") - shared
    need = F.greatest(F.floor(F.col("n") / 4) + 1 - n_alone, F.lit(0)).cast("int")
    prefix = F.transform(F.slice("entries", F.lit(1), need), lambda e: e["token"])
    return found.select("doc", "n", "copy_of", n_alone.alias("n_alone"), F.when((F.col("n") > 0) & F.col("copy_of").isNull() & (F.size(prefix) > 0), prefix).alias("prefix"))


def shingle_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """doc and tokens for the documents in ``wanted``."""
    shared = share(docs.sparkSession, Shingler(words))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = opened(shared)
        for batch in slices(batches, "text", 2 * 1024 * 1024):
            sets = [shingler.of(text or "").view(np.int64) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(sets, pa.list_(pa.int64()))], names=["doc", "tokens"])

    rows = docs.join(wanted.select(F.col("doc").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("doc"), "text")
    return rows.mapInArrow(run, "doc long, tokens array<long>")


def fits(n_a: Column, n_b: Column) -> Column:
    return 4 * F.least(n_a, n_b) >= 3 * F.greatest(n_a, n_b)


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with ``both``, the size of the intersection of their sets, and ``linked``: 100 * intersection >= 75 * union."""
    left = sets.select(F.col("doc").alias("a"), F.col("tokens").alias("s"))
    right = sets.select(F.col("doc").alias("b"), F.col("tokens").alias("t"))
    found = pairs.join(left, "a").join(right, "b").withColumn("both", F.size(F.array_intersect("s", "t")))
    linked = 100 * F.col("both") >= 75 * (F.size("s") + F.size("t") - F.col("both"))
    return found.select("a", "b", "both", linked.alias("linked"))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, counted: float = COUNTED) -> DataFrame:
    """doc_id, n_shingles and component_id for each document, one row an id.

    Null, empty and blank texts have no shingle and no link. Rows without id are left out. Rows that repeat an id are one document; if their texts
    differ, the greatest stands for it. Other columns are not read.
    """
    rows = one_row_per_id(docs, id_col, text_col)
    found = materialise(prefixes(shingle_rows(rows, words, counted), counted), "prefixes")
    nodes = found.where("prefix IS NOT NULL").select("doc", "n", "n_alone", "prefix")
    sets = materialise(shingle_sets(rows, nodes, words), "sets")

    # Groups are named by their smallest document. The others are compared with it.
    groups = materialise(nodes.groupBy("n", "prefix").agg(F.min("doc").alias("g"), F.min("n_alone").alias("n_alone")), "groups")
    members = nodes.join(groups.select("n", "prefix", "g"), ["n", "prefix"]).where("doc <> g").select(F.col("g").alias("a"), F.col("doc").alias("b"))

    # Two sizes that fit are in the same or in neighbouring bands.
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3)) + 1e-9)
    postings = materialise(groups.select(F.explode("prefix").alias("token"), "g", "n", (F.col("n") - F.col("n_alone")).alias("most"), band.alias("band")), "postings")
    # The document with the fewest shingles of its own is likely the one that the others were made from.
    anchors = postings.groupBy("token", "band").agg(F.min(F.struct(F.col("n") - F.col("most"), "g", "n", "most")).alias("anchor"))
    near = anchors.unionByName(anchors.withColumn("band", F.col("band") + 1))
    stars = postings.join(near, ["token", "band"]).where(F.col("g") != F.col("anchor.g")).where(can_link("n", "most", "anchor.n", "anchor.most"))
    pairs = members.unionByName(stars.select(F.col("anchor.g").alias("a"), F.col("g").alias("b"))).distinct()
    compared = materialise(measured(pairs, sets), "compared")
    links = compared.where("linked").select("a", "b")

    # Once more with the anchor that most of a document's neighbours were compared with; what links to one anchor is together.
    anchors = voted(across(together(nodes, links).select("doc", "c", F.explode("prefix").alias("token"))), compared)
    again = anchors.where("anchor <> doc").select(F.col("anchor").alias("a"), F.col("doc").alias("b")).join(compared, ["a", "b"], "left_anti")
    links = materialise(links.unionByName(measured(again, sets).where("linked").select("a", "b")), "links")
    own = materialise(together(nodes, links), "own")

    # What is not yet together meets in full; a member that is unlike its group's name is a group of its own here.
    open_ones = across(own.select("doc", "n", "c", F.explode("prefix").alias("token")))
    bounds = materialise(common_bounds(open_ones.select("doc").distinct(), anchors, own.select("doc", "c"), sets), "bounds")
    open_ones = open_ones.join(bounds.select("doc", "anchor", "core", F.size("extras").alias("extra")), "doc").where("4 * (core + extra) >= 3 * n")
    rest = materialise(across(open_ones), "rest")
    whole = F.least(F.col("x.core") + F.col("x.extra"), F.col("y.core") + F.col("y.extra"))
    core = F.least("x.core", "y.core")
    crossing = meeting(rest, F.when(F.col("x.anchor") == F.col("y.anchor"), core).otherwise(whole))
    # Documents of one anchor that have too little of it in common need some extras as well, and meet by the prefixes of these.
    needed = F.greatest(F.ceil(F.col("n") * 3 / 4) - F.col("core"), F.lit(1)).cast("int")
    first = F.slice(F.sort_array("extras"), F.lit(1), F.greatest(F.col("extra") - needed + 1, F.lit(0)))
    extras = rest.select("doc", "n", "c", "anchor", "core", "extra").distinct().join(bounds.select("doc", "extras"), "doc")
    extras = extras.select("doc", "n", "c", "anchor", "core", "extra", F.explode(first).alias("token"))
    apart = meeting(across(extras), F.when(F.col("x.anchor") == F.col("y.anchor"), core + F.least("x.extra", "y.extra")).otherwise(0))
    others = crossing.unionByName(apart).distinct()
    more = measured(others, sets).where("linked").select("a", "b")
    # Links between what is together already connect to components; the smallest document gives the name.
    cluster = own.select("doc", "c")
    first, second = cluster.toDF("a", "u"), cluster.toDF("b", "v")
    bridges = links.unionByName(more).join(first, "a").join(second, "b").where("u <> v").select(F.col("u").alias("a"), F.col("v").alias("b")).distinct()
    whole = components(bridges).select(F.col("node").alias("c"), "component")
    placed = found.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("copy_of", "doc").alias("doc"))
    placed = placed.join(cluster, "doc", "left").withColumn("c", F.coalesce("c", "doc")).join(whole, "c", "left")
    placed = materialise(placed.select("doc_id", "n_shingles", F.coalesce("component", "c").alias("root")), "placed")
    names = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return placed.join(names, "root").select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that are alone or stand for their component: the one with the smallest id, with all columns as they are.

    Null, empty and blank texts are like no other, so all of them stay. If ids repeat or are null, rows are numbered and compared by that number: different
    texts under one id are judged each by itself, of rows that are equal throughout one stays, and an id that is null comes after all others. Columns of
    any type and of equal names are carried along.
    """
    names = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own, text = F.col(f"c{names.index(id_col)}").cast("long"), F.col(f"c{names.index(text_col)}").alias("text")
    named = rows.groupBy(own.alias("id")).count().where("id IS NULL OR count > 1").isEmpty()
    keyed = rows.withColumn("row", own) if named else materialise(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    found = similar_documents(keyed.select("row", text), "row", "text", words).select(F.col("doc_id").alias("row"), "component_id")
    if named:
        first = found.where("row = component_id")
    else:
        ranked = found.join(keyed.select("row", own.alias("id")), "row")
        first = ranked.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first")).select("first.row")
    return keyed.join(first.select("row"), "row", "left_semi").drop("row").toDF(*names)


def popular(pairs: DataFrame) -> DataFrame:
    """doc, anchor: of the documents a that b has a pair (a, b) with, itself included if it is an a, the one with the most pairs; and that one's own, twice over."""
    often = pairs.groupBy(F.col("a").alias("anchor")).agg(F.count("*").alias("times"))
    asked = pairs.select(F.col("b").alias("doc"), F.col("a").alias("anchor")).unionByName(often.select(F.col("anchor").alias("doc"), "anchor"))
    best = materialise(asked.join(often, "anchor").groupBy("doc").agg(F.max_by("anchor", F.struct("times", "anchor")).alias("anchor")), "anchors")
    found, further = best, best.select(F.col("doc").alias("anchor"), F.col("anchor").alias("next"))
    for _ in range(2):
        found = found.join(further, "anchor", "left").select("doc", F.coalesce("next", "anchor").alias("anchor"))
    return found


def together(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """doc, n, prefix, c: documents of one c are connected by links; c is one of them."""
    own = nodes.join(popular(links).withColumnRenamed("anchor", "c"), "doc", "left")
    return own.select("doc", "n", "prefix", F.coalesce("c", "doc").alias("c"))


def voted(open_ones: DataFrame, compared: DataFrame) -> DataFrame:
    """doc, anchor: the anchor that the documents with the same shingles (``open_ones``: doc, token) were compared with most often."""
    known = open_ones.join(popular(compared.select("a", "b")), "doc", "left").withColumn("anchor", F.coalesce("anchor", "doc"))
    times = known.groupBy("token", "anchor").agg(F.count("*").alias("times"))
    lead = times.groupBy("token").agg(F.max_by("anchor", F.struct("times", "anchor")).alias("anchor"))
    votes = open_ones.join(lead, "token").groupBy("doc", "anchor").agg(F.count("*").alias("times"))
    return materialise(votes.groupBy("doc").agg(F.max_by("anchor", F.struct("times", "anchor")).alias("anchor")), "anchors")


def common_bounds(docs: DataFrame, anchors: DataFrame, component_of: DataFrame, sets: DataFrame) -> DataFrame:
    """doc, anchor, core, extras: what a document can have in common with one of another component.

    Only shingles count that another component has as well. ``core`` of them are in the set of the document's anchor, ``extras`` are not. So two documents of
    one anchor have at most the smaller core in common, unless they share an extra. Any document can be the anchor.
    """
    rows = docs.join(anchors, "doc", "left").select("doc", F.coalesce("anchor", "doc").alias("anchor")).join(component_of, "doc")
    tokens = across(sets.join(rows, "doc").select("doc", "c", "anchor", F.explode("tokens").alias("token")))
    inside = sets.join(rows.select(F.col("anchor").alias("doc")).distinct(), "doc").select(F.col("doc").alias("anchor"), F.explode("tokens").alias("token"), F.lit(True).alias("inside"))
    counted = tokens.join(inside, ["anchor", "token"], "left").groupBy("doc", "anchor")
    return counted.agg(F.count("inside").alias("core"), F.collect_list(F.when(F.col("inside").isNull(), F.col("token"))).alias("extras"))


def meeting(rows: DataFrame, most: Column) -> DataFrame:
    """Pairs (a, b) of documents of different components that share a token, fit in size, and can have enough in common, ``most`` at most."""
    x, y = rows.alias("x"), rows.alias("y")
    enough = 7 * most >= 3 * (F.col("x.n") + F.col("y.n"))
    same = (F.col("x.token") == F.col("y.token")) & (F.col("x.c") < F.col("y.c"))
    pairs = x.join(y, same & fits(F.col("x.n"), F.col("y.n")) & enough)
    return pairs.select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b")).distinct()


def across(tokens: DataFrame) -> DataFrame:
    """The rows (token, c and others) whose token occurs in several components."""
    spread = tokens.groupBy("token").agg(F.min("c").alias("least"), F.max("c").alias("greatest")).where("least <> greatest")
    return tokens.join(spread.select("token"), "token", "left_semi")


def can_link(n_a: str, most_a: str, n_b: str, most_b: str) -> Column:
    """By the sizes, and by the shingles that each shares with any other document at all: the common ones are 3/7 of both sizes at least."""
    a, b = F.col(n_a), F.col(n_b)
    return fits(a, b) & (7 * F.least(F.col(most_a), F.col(most_b)) >= 3 * (a + b))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return similar_documents(table(spark, sf_dir, "documents"))
