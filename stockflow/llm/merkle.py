"""A Merkle manifest of a table, with the proof of every row, by a cogrouped exchange of subtrees.

Rows are the leaves of one tree for each part (such as a language); the trees' roots are, in order of the part, the leaves of a top tree. A node is the
SHA-256 of its children's digests, in hex, up to ``FANOUT`` of them; the last run of a level may be shorter, down to one.

A block is ``FANOUT ** HEIGHT`` consecutive nodes of one level, so it is a whole subtree, whatever part it lies in and however many rows the part has.
Going up, each block is reduced to its root, and roots are numbered like leaves, until one is left for each part. Going down, the nodes of a
block and what its root needs from outside (the siblings on the way to the top) are cogrouped by block: that one task reduces the block again, joins
each node's siblings to the outer ones, and folds the node up to the root. No task ever holds more than a block and its outer siblings, and
the number of steps is the number of levels divided by ``HEIGHT``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.lake import materialise
from stockflow.llm.common import prepare, table
from stockflow.llm.positions import placed

FANOUT = 8
#: Levels of a block: 4096 leaves each.
HEIGHT = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROVED = "doc_id long, leaf string, subroot string, root string, lefts array<string>, rights array<string>, folded_root string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height_of(n: int, fanout: int) -> int:
    """Levels above ``n`` leaves until one node is left."""
    levels = 0
    while n > 1:
        n = -(-n // fanout)
        levels += 1
    return levels


def reduced(nodes: list[str], levels: int, fanout: int) -> list[list[str]]:
    """The nodes of a subtree level by level, the given ones first and its root last."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest("".join(below[k : k + fanout])) for k in range(0, len(below), fanout)])
    return out


def siblings(tree: list[list[str]], fanout: int) -> list[tuple[list[str], list[str]]]:
    """For each lowest node the digests left and right of it in its run, joined, level by level up to the subtree's root."""
    above: list[tuple[list[str], list[str]]] = [([], [])] * len(tree[-1])
    for nodes in reversed(tree[:-1]):
        own = []
        for k in range(len(nodes)):
            start = k - k % fanout
            lefts, rights = above[k // fanout]
            own.append((["".join(nodes[start:k]), *lefts], ["".join(nodes[k + 1 : start + fanout]), *rights]))
        above = own
    return above


def folded(node: str, lefts: Sequence[str], rights: Sequence[str]) -> str:
    """What a node and its siblings give at the top."""
    for left, right in zip(lefts, rights, strict=True):
        node = digest(left + node + right)
    return node


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values: ``-`` for null, else the UTF-8 length, a colon and the value."""
    texts = [v.cast("string") for v in values]
    framed = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*framed), 256)


class Forest:
    """Nodes of trees (columns tree, i, n, node: the i-th of n nodes of a tree), block by block."""

    def __init__(self, fanout: int, height: int):
        self.fanout, self.height = fanout, height
        self.block = fanout**height

    def levels(self, n: int) -> int:
        """Levels that a block of a tree with ``n`` nodes is reduced by: all that are left, up to the height of a block."""
        return min(self.height, height_of(n, self.fanout))

    def in_blocks(self, nodes: DataFrame) -> DataFrame:
        return nodes.withColumn("block", F.floor(F.col("i") / self.block)).groupBy("tree", "block")

    def roots(self, nodes: DataFrame, label: str) -> DataFrame:
        """The roots of all blocks, as nodes of the level above."""

        def up(rows: pd.DataFrame) -> pd.DataFrame:
            n = int(rows["n"].iloc[0])
            root = reduced(rows.sort_values("i")["node"].tolist(), self.levels(n), self.fanout)[-1][0]
            return pd.DataFrame({"tree": [rows["tree"].iloc[0]], "i": [rows["block"].iloc[0]], "n": [-(-n // self.block)], "node": [root]})

        return materialise(self.in_blocks(nodes).applyInPandas(up, "tree string, i long, n long, node string"), label)

    def layers(self, nodes: DataFrame) -> list[DataFrame]:
        """The nodes, the roots of their blocks, the roots of those, and so on; the last layer holds one node for each tree."""
        out = [nodes]
        while (nodes.agg(F.max("n")).first()[0] or 0) > 1:
            nodes = self.roots(nodes, "merkle-roots")
            out.append(nodes)
        return out

    def outer(self, layer: DataFrame, above: DataFrame) -> DataFrame:
        """What each node of ``layer`` needs from outside (columns tree, block, lefts, rights), from what its block needs."""

        def down(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
            nodes = nodes.sort_values("i")
            found = siblings(reduced(nodes["node"].tolist(), self.levels(int(nodes["n"].iloc[0])), self.fanout), self.fanout)
            lefts, rights = list(outer["lefts"].iloc[0]), list(outer["rights"].iloc[0])
            return pd.DataFrame({"tree": nodes["tree"], "block": nodes["i"], "lefts": [own + lefts for own, _ in found], "rights": [own + rights for _, own in found]})

        exchange = self.in_blocks(layer).cogroup(above.groupBy("tree", "block"))
        return materialise(exchange.applyInPandas(down, "tree string, block long, lefts array<string>, rights array<string>"), "merkle-outer")

    def proved(self, leaves: DataFrame, above: DataFrame) -> DataFrame:
        """Every leaf with its siblings up to the top, and what it, or what is ``claimed`` in its stead, folds up to."""

        def finish(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("i")
            n, nodes = int(rows["n"].iloc[0]), rows["node"].tolist()
            levels = self.levels(n)
            tree = reduced(nodes, levels, self.fanout)
            lefts, rights = list(outer["lefts"].iloc[0]), list(outer["rights"].iloc[0])
            rest = height_of(n, self.fanout) - levels  # the levels of the own tree above this block
            subroot = folded(tree[-1][0], lefts[:rest], rights[:rest])
            root = folded(subroot, lefts[rest:], rights[rest:])
            proofs = [(own_l + lefts, own_r + rights) for own_l, own_r in siblings(tree, self.fanout)]
            folds = [folded(claimed, *proof) for claimed, proof in zip(rows["claimed"], proofs, strict=True)]
            return pd.DataFrame(
                {"doc_id": rows["doc_id"], "leaf": nodes, "subroot": subroot, "root": root, "lefts": [p[0] for p in proofs], "rights": [p[1] for p in proofs], "folded_root": folds}
            )

        return self.in_blocks(leaves).cogroup(above.groupBy("tree", "block")).applyInPandas(finish, PROVED)


def counted(nodes: DataFrame) -> DataFrame:
    """Add ``n``, the number of nodes of the tree."""
    return nodes.join(nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), "tree")


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    part_col: str = "lang",
    claims: Mapping[str, Column] | None = None,
    fanout: int = FANOUT,
    height: int = HEIGHT,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, leaf, subroot (of its part), root, its proof, and folded_root.

    The proof is two lists, ``lefts`` and ``rights``: level by level the joined digests that stand before and after the node on its way up. ``folded_root`` is
    what the proof gives for the row as it is claimed to be: with the columns in ``claims`` in place of its own (none: as it is). It equals ``root``
    if, and only if, the claim is true.

    Leaves are ordered by id within a part, null ids first; rows that repeat an id are ordered by their digests, and equal rows are leaves
    each. Parts are ordered by their UTF-8 bytes, null first. Null and empty values have digests of their own; a text of any length is one leaf. An empty
    table gives no rows. Columns other than ``fields``, the id and the part are not read.
    """
    forest = Forest(fanout, height)
    own = [docs[f] for f in fields]
    stated = [(claims or {}).get(f, docs[f]) for f in fields]
    part = docs[part_col].cast("string")
    tree = F.coalesce(F.concat(F.lit("="), part), F.lit(""))  # keeps the order, and tells null from empty
    leaf = leaf_digest(own).alias("node")
    claimed = leaf_digest(stated).alias("claimed") if claims else leaf.alias("claimed")
    # Texts are read once, here; a row is two digests and its keys from now on.
    hashed = materialise(docs.select(tree.alias("tree"), docs[id_col].cast("long").alias("doc_id"), leaf, claimed, F.lit(1).alias("one")), "merkle-hashed")
    leaves = materialise(counted(placed(hashed, ["doc_id", "node"], {"i": "one"}, "merkle-leaves", "tree")), "merkle-placed")
    layers = forest.layers(leaves.select("tree", "i", "n", "node"))

    subroots = layers[-1].select(F.lit("").alias("tree"), F.col("tree").alias("part"), "node", F.lit(1).alias("one"))
    tops = materialise(counted(placed(subroots, ["part"], {"i": "one"}, "merkle-subroots", "tree")), "merkle-tops")
    top_layers = forest.layers(tops.select("tree", "i", "n", "node"))
    none = F.array().cast("array<string>")
    needs = top_layers[-1].select("tree", F.col("i").alias("block"), none.alias("lefts"), none.alias("rights"))
    for layer in reversed(top_layers[:-1] or top_layers):
        needs = forest.outer(layer, needs)
    # The place of a part in the top tree becomes the one block of its own tree.
    needs = tops.join(needs.select(F.col("block").alias("i"), "lefts", "rights"), "i").select(F.col("part").alias("tree"), F.lit(0).cast("long").alias("block"), "lefts", "rights")
    for layer in reversed(layers[1:-1]):
        needs = forest.outer(layer, needs)
    return forest.proved(leaves, needs)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0
    text = F.when(tampered, F.translate(docs["text"], UPPER, LOWER)).otherwise(docs["text"])
    proof = F.array_join(F.zip_with("lefts", "rights", lambda left, right: F.concat(left, right)), "")
    rows = manifest(docs, claims={"text": text})
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


OP11_SQL = """
WITH RECURSIVE docs AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree,
    concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
      coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head, text,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) AS crc
  FROM documents),
hashed AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(CASE WHEN crc % 3 = 0 THEN strlen(lowered) || ':' || lowered ELSE strlen(text) || ':' || text END, '-')) AS claimed
  FROM docs),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM hashed),
nodes AS (
  SELECT tree, 0 AS level, i, n, leaf AS h FROM leaves
  UNION ALL
  SELECT tree, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY tree, level, i // 8, n),
subroots AS (SELECT tree, level AS top, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, i, n, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 8, n),
runs AS (
  SELECT tree, level, i // 8 AS run, list(h ORDER BY i) AS hs FROM nodes WHERE n > 1 GROUP BY 1, 2, 3
  UNION ALL
  SELECT s.tree, s.top + t.level, t.i // 8, list(t.h ORDER BY t.i) FROM (SELECT tree, top FROM subroots) s, tops t WHERE t.n > 1 GROUP BY s.tree, s.top, t.level, t.i // 8),
climb AS (
  SELECT l.doc_id, l.tree, l.leaf, s.h AS subroot, s.top, s.i AS place, 0 AS level, l.i, l.claimed AS fold, '' AS proof, l.i AS leaf_no
  FROM leaves l JOIN subroots s USING (tree)
  UNION ALL
  SELECT c.doc_id, c.tree, c.leaf, c.subroot, c.top, c.place, c.level + 1, CASE WHEN c.level = c.top THEN c.place ELSE c.i END // 8,
    sha256(array_to_string(r.hs[:k], '') || c.fold || array_to_string(r.hs[k + 2:], '')), c.proof || array_to_string(r.hs[:k], '') || array_to_string(r.hs[k + 2:], ''), c.leaf_no
  FROM (SELECT *, CASE WHEN level = top THEN place ELSE i END % 8 AS k FROM climb) c
  JOIN runs r ON r.tree = c.tree AND r.level = c.level AND r.run = CASE WHEN c.level = c.top THEN c.place ELSE c.i END // 8),
ends AS (SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY tree, leaf_no ORDER BY level DESC) = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified
FROM ends, (SELECT h AS root FROM tops WHERE n = 1)
"""
