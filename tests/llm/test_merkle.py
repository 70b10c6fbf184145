"""The manifest against a plain recursion, with small blocks so that a few rows need several layers."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from stockflow.llm import merkle
from stockflow.llm.common import prepare
from tests.llm.common import SCHEMA, documents, odd_texts, rows_of


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row: tuple) -> str:
    doc_id, text, lang, source, n_chars = row
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def levels(nodes: list[str], fanout: int) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k : k + fanout]) for k in range(0, len(out[-1]), fanout)])
    return out


def climb(tree: list[list[str]], place: int, node: str, proof: list[str], fanout: int) -> str:
    for nodes in tree[:-1]:
        start = place - place % fanout
        run = nodes[start : start + fanout]
        proof += [d for k, d in enumerate(run) if start + k != place]
        run[place - start] = node
        node, place = h(*run), place // fanout
    return node


def plain(rows: list[tuple], fanout: int, tamper) -> list[tuple]:
    parts: dict = {}
    for row in rows:
        parts.setdefault(row[2], []).append(row)
    order = sorted(parts, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = []
    for lang in order:
        parts[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append(levels([leaf(r) for r in parts[lang]], fanout))
    top = levels([t[-1][0] for t in trees], fanout)
    out = []
    for place, (lang, tree) in enumerate(zip(order, trees, strict=True)):
        for k, row in enumerate(parts[lang]):
            proof: list[str] = []
            fold = climb(tree, k, leaf(tamper(row)), proof, fanout)
            fold = climb(top, place, fold, proof, fanout)
            out.append((row[0], leaf(row), tree[-1][0], top[-1][0], h(*proof), fold))
    return out


def lowered(row: tuple) -> tuple:
    doc_id, text = row[:2]
    if doc_id is None or text is None or zlib.crc32(str(doc_id).encode()) % 3:
        return row
    return (doc_id, "".join(c.lower() if "A" <= c <= "Z" else c for c in text), *row[2:])


def found(docs, **sizes) -> list[tuple]:
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(hit, F.translate(docs["text"], merkle.UPPER, merkle.LOWER)).otherwise(docs["text"])
    proof = F.sha2(F.array_join(F.zip_with("lefts", "rights", lambda a, b: F.concat(a, b)), ""), 256)
    rows = merkle.manifest(docs, claims={"text": text}, **sizes)
    return [tuple(r) for r in rows.select("doc_id", "leaf", "subroot", "root", proof, "folded_root").collect()]


def in_order(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=str)


@pytest.mark.parametrize("fanout,height", [(8, 4), (2, 1), (2, 2), (3, 2), (8, 1)])
def test_same_as_a_plain_recursion(fanout, height, spark):
    rows = rows_of(odd_texts()) + [(None, "No Id", "en", None, None), (None, "No Id", "en", None, None), (3, "Again", "en", "s", 5), (3, "Again", "en", "s", 5)]
    rows += [(100 + i, f"Row {i}", ["en", "zz", "é", ""][i % 4] if i % 5 else "en", "s", i) for i in range(120)]
    got = found(documents(prepare(spark), rows, clashing=True), fanout=fanout, height=height)
    assert in_order(got) == in_order(plain(rows, fanout, lowered))
    assert any(r[5] != r[3] for r in got) and any(r[5] == r[3] for r in got)


def test_one_row_many_parts_and_none(spark):
    prepare(spark)
    one = [(9, "A", None, None, 1)]
    assert found(documents(spark, one)) == plain(one, 8, lowered)
    parts = [(i, "Text", f"lang{i}", "s", 4) for i in range(70)]  # the top tree has several levels, the others none
    assert in_order(found(documents(spark, parts), fanout=2, height=2)) == in_order(plain(parts, 2, lowered))
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_a_claim_verifies_only_if_it_is_true(spark):
    docs = documents(prepare(spark), [(i, f"text {i}", "en", "s", 6) for i in range(40)])
    same = merkle.manifest(docs, claims={"text": F.concat("text", F.lit(""))})
    assert same.where("folded_root <> root").count() == 0
    other = merkle.manifest(docs, claims={"source": F.when(F.col("doc_id") == 7, "t").otherwise(F.col("source"))})
    assert [r.doc_id for r in other.where("folded_root <> root").collect()] == [7]
