"""Language of a text: known words first, character n-grams for the others.

A language's model holds the log frequencies of its frequent words and of the character n-grams of its words. A word that some language knows is
scored by its log frequency in each language (a floor where it is missing). Any other word is scored by its character n-grams of
the greatest length of which at least one is known, from MAX_N down to 1: by the mean of their log frequencies. Scores add
up over the whole text, and the languages' shares of the text's probability give the answer and its score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm.common import fold, keep_rows, map_texts, prepare, share, slices, table, text_of

#: The classifier learns from about so many labelled documents of each language (all, where there are fewer).
SAMPLE_DOCS = 4_000
#: A language keeps words and n-grams that make up at least this share of all of their kind, so at most 1 / share of each.
WORD_SHARE, GRAM_SHARE = 1 / 100_000, 1 / 50_000
MAX_N = 5
#: A worker keeps sums of so many numbers and pieces of so many characters; beyond either it starts anew.
MEMO_NUMBERS, MEMO_CHARS = 1_000_000, 8_000_000
#: So many languages' sizes are broadcast; more are joined as the planner sees fit.
MAX_BROADCAST = 10_000
UNKNOWN = "und"
#: Documents pass the filter if their language is known and its score is at least this.
MIN_SCORE = 0.5
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    return WORD.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    """n-grams of a word between marks of its begin and end; an n-gram of one character is without the marks."""
    marked = f"^{word}$" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies as one row of numbers (a language each) for each known word and n-gram.

    Texts are scored by whole batches: they are cut at white space in Arrow, each distinct piece of a batch is looked up once, and a piece that the worker
    has not met gets the sum of its words' rows. No word reaches across white space, so the pieces' sums add up to the text's.
    """

    def __init__(self, counts: dict[str, dict[tuple[int, str], int]]):
        """``counts``: for each language, counts by (0, word) and (n, n-gram); (-1 - n, "") holds the total of a kind."""
        self.langs = sorted(counts)
        totals = {lang: {n: counts[lang].get((-1 - n, ""), 1) for n in range(MAX_N + 1)} for lang in self.langs}
        floors = np.array([[math.log(0.5 / max(totals[lang][n], 1)) for lang in self.langs] for n in range(MAX_N + 1)])
        #: For words (0) and n-grams (n), the row of each in ``table``.
        self.known: list[dict[str, int]] = [{} for _ in range(MAX_N + 1)]
        kinds: list[int] = []
        for lang in self.langs:
            for n, key in counts[lang]:
                if n >= 0 and key not in self.known[n]:
                    self.known[n][key] = len(kinds)
                    kinds.append(n)
        self.table = floors[kinds] if kinds else np.zeros((0, len(self.langs)))
        for j, lang in enumerate(self.langs):
            for (n, key), count in counts[lang].items():
                if n >= 0:
                    self.table[self.known[n][key], j] = math.log(count / totals[lang][n])
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.chars = 0
        self.sums, self.n_words = np.empty((1 << 10, len(self.langs))), np.empty(1 << 10, np.int64)

    def rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A row for each word, and whether the word or some character of it is known; the row is zero if not."""
        found = np.zeros((len(words), len(self.langs)))
        at = np.array([self.known[0].get(word, -1) for word in words], np.int64)
        known = at >= 0
        found[known] = self.table[at[known]]
        for n in range(MAX_N, 0, -1):
            left = np.nonzero(~known)[0]
            if not len(left):
                break
            own = [grams(words[i], n) for i in left.tolist()]
            of = np.repeat(left, np.fromiter(map(len, own), np.int64, len(own)))
            at = np.array([self.known[n].get(g, -1) for gs in own for g in gs], np.int64)
            of, at = of[at >= 0], at[at >= 0]
            number = np.bincount(of, minlength=len(words))
            hit = np.nonzero(number)[0]
            for j in range(len(self.langs)):
                found[hit, j] = np.bincount(of, self.table[at, j], len(words))[hit] / number[hit]
            known[hit] = True
        return found, known

    def unseen(self, word: str) -> np.ndarray | None:
        found, known = self.rows([word])
        return found[0] if known[0] else None

    def learn(self, pieces: list[str]) -> None:
        """Keep the sum of the rows of each piece's words, and their number."""
        cut = [words_of(piece) for piece in pieces]
        numbers = np.fromiter(map(len, cut), np.int64, len(cut))
        distinct = {word: i for i, word in enumerate(dict.fromkeys(word for words in cut for word in words))}
        found, _ = self.rows(list(distinct))
        of, row = np.repeat(np.arange(len(cut)), numbers), np.array([distinct[word] for words in cut for word in words], np.int64)
        first, n = len(self.memo), len(self.memo) + len(pieces)
        while n > len(self.sums):
            self.sums, self.n_words = (np.concatenate([a, np.empty_like(a)]) for a in (self.sums, self.n_words))
        self.n_words[first:n] = numbers
        for j in range(len(self.langs)):
            self.sums[first:n, j] = np.bincount(of, found[row, j], len(cut))
        self.memo.update(zip(pieces, range(first, n), strict=True))
        self.chars += sum(map(len, pieces))

    def predict_all(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; of equal languages the first. The texts must not be null."""
        n = len(texts)
        if not self.langs:
            return [UNKNOWN] * n, np.zeros(n)
        if len(self.memo) * len(self.langs) > MEMO_NUMBERS or self.chars > MEMO_CHARS:
            self.forget()
        cut = pc.utf8_split_whitespace(texts)
        coded = cut.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        slots = np.array([self.memo.get(piece, -1) for piece in distinct], np.int64)
        new = np.nonzero(slots < 0)[0].tolist()
        if new:
            self.learn([distinct[k] for k in new])
            slots[new] = [self.memo[distinct[k]] for k in new]
        slot = slots[coded.indices.to_numpy()]
        of = np.repeat(np.arange(n), pc.list_value_length(cut).to_numpy(zero_copy_only=False))
        n_words = np.bincount(of, self.n_words[slot], n)
        total = np.stack([np.bincount(of, self.sums[slot, j], n) for j in range(len(self.langs))], axis=1)
        best = total.argmax(axis=1)
        score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.langs[k] if w else UNKNOWN for k, w in zip(best.tolist(), n_words.tolist(), strict=True)], np.where(n_words > 0, score, 0.0)

    def predict(self, text: str) -> tuple[str, float]:
        langs, scores = self.predict_all(pa.array([text], pa.string()))
        return langs[0], float(scores[0])


def count_kinds(sample: DataFrame) -> DataFrame:
    """lang, n, key, count: words (n 0), n-grams, and totals (key "", n below 0) of the sample's texts, summed per task before they are shuffled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        found: dict[tuple[str, int, str], int] = Counter()
        for batch in slices(batches, "text"):
            words: Counter = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words.update((lang, w) for w in words_of(text))
            for (lang, word), count in words.items():
                found[lang, 0, word] += count
                found[lang, -1, ""] += count
                for n in range(1, MAX_N + 1):
                    own = grams(word, n)
                    found[lang, -1 - n, ""] += count * len(own)
                    for g in own:
                        found[lang, n, g] += count
            if len(found) > 1_000_000:
                yield of(found)
                found.clear()
        yield of(found)

    def of(found: dict[tuple[str, int, str], int]) -> pa.RecordBatch:
        keys = list(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array([k[2] for k in keys], pa.string()), pa.array(list(found.values()), pa.int64())],
            names=["lang", "n", "key", "count"],
        )

    return sample.mapInArrow(run, "lang string, n long, key string, count long").groupBy("lang", "n", "key").agg(F.sum("count").alias("count"))


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn from ``labelled`` rows with a language and a text. The sample is by hash of the id, so the same rows give the same model."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").count()
    draw = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1_000_000
    small = F.broadcast if sizes.count() <= MAX_BROADCAST else lambda own: own
    sample = rows.join(small(sizes), "lang").where(draw < sample_docs / F.col("count")).select("lang", "text")
    kinds = count_kinds(sample).cache()
    totals = kinds.where("n < 0").select("lang", (-1 - F.col("n")).alias("n"), F.col("count").alias("total"))
    kept = kinds.where("n >= 0").join(small(totals), ["lang", "n"]).where(F.col("count") >= F.col("total") * F.when(F.col("n") == 0, WORD_SHARE).otherwise(GRAM_SHARE))
    counts: dict[str, dict[tuple[int, str], int]] = {}
    # At most 1 / share of each kind and language, whatever the input.
    for row in kept.select("lang", "n", "key", "count").unionByName(kinds.where("n < 0")).toLocalIterator():
        counts.setdefault(row["lang"], {})[row["n"], row["key"]] = row["count"]
    kinds.unpersist()
    return Model(counts)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) for each row; ``und`` with score 0 where the text is null or has no letter.

    Rows are independent of each other; texts of letters that no language has are spread over all languages evenly. Other columns are not read.
    """

    def make(model: Model):
        def step(batch: pa.RecordBatch) -> dict:
            langs, scores = model.predict_all(batch.column("text"))
            return {"doc_id": batch.column("doc_id"), "lang_pred": langs, "score": scores}

        return step

    columns = [docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col)]
    return map_texts(docs, columns, "doc_id long, lang_pred string, score double", make, share(docs.sparkSession, model))


def in_known_language(docs: DataFrame, model: Model, text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows whose language is found with at least ``min_score``, with all their columns."""

    def make(model: Model):
        def wanted(texts: list[str]) -> list[bool]:
            langs, scores = model.predict_all(pa.array(texts, pa.string()))
            return [lang != UNKNOWN and score >= min_score for lang, score in zip(langs, scores.tolist(), strict=True)]

        return wanted

    return keep_rows(docs, text_col, make, share(docs.sparkSession, model))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(fold(F.col("doc_id"), 4) != 2)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, train(training_rows(docs)))
    return found.withColumn("held_out", fold(F.col("doc_id"), 4) == 2)
