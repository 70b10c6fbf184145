"""Small tables with every odd case, and what several tests share."""

from __future__ import annotations

import random
import zlib

from pyspark.sql import DataFrame, SparkSession

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as columns of the input.
CLASHING = "token doc df n c word score part block g a b count key draw label index value start items spans rank v entry more seq"

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


def prose(rng: random.Random, words: int) -> str:
    out = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(words)]
    return " ".join(w.capitalize() + "." if rng.random() < 0.1 else w for w in out)


def odd_texts() -> list[str | None]:
    rng = random.Random(5)
    base = prose(rng, 60)
    return [
        None,
        "",
        "   \n\t ",
        "one",
        "One TWO three four",
        base,
        base,  # a repeated text
        base.upper().replace(" ", "\n"),
        base.replace("er", "ER", 1) + " and a tail",
        prose(rng, 80),
        "word " * 3000 + prose(rng, 3000),  # very long
        "x" * 50_000,
        "naïve Straße 中文 текст 🙂    a\u0000b",
        "a  b   c \n\n d  ",
        "don't we'll 123 4,5.6 ...!? <|endoftext|> </s>",
        "́combining ​zero",
    ]


def rows_of(texts: list[str | None]) -> list[tuple]:
    langs = ["en", None, "fr", "en", "de"]
    return [(i, text, langs[i % 5], f"src{i % 3}" if i % 4 else None, None if text is None else len(text)) for i, text in enumerate(texts)]


def documents(spark: SparkSession, rows: list[tuple], clashing: bool = False) -> DataFrame:
    docs = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        docs = docs.selectExpr("*", *[f"concat('{name}', doc_id) AS {name}" for name in CLASHING.split()])
    return docs


def fold(doc_id: int, n: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % n
