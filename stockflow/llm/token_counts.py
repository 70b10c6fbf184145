"""Word-piece counts by a linear longest-match automaton.

Greedy word-piece splitting takes the longest vocabulary piece at the front of a word, then goes on with continuation pieces. The automaton is
a trie of all pieces. When a node has no child for the next character, the greedy split has settled on some pieces of what was read; the failure
link leads to the node of what remains unsettled, and the number of settled ("popped") pieces is stored with it. So each
character is read once, no piece is ever built, and a word costs time linear in its length.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from stockflow.llm.common import map_texts, prepare, share, table, text_of, vocabulary

#: Counts of words kept by a task; when there are more, it starts anew.
MEMO_ENTRIES = 500_000
WORD_START = "▁"


def pieces_of_model(path: str, bare_start: bool = False) -> tuple[list[str], list[str]]:
    """Pieces that begin a word and pieces that continue one, from a sentencepiece file; control and byte pieces are left out.

    With ``bare_start`` the piece that is the word start alone is the empty string among the first, if the file has it: a word can begin with it and go
    on with continuation pieces.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    first = [p[1:] for p in pieces if p.startswith(WORD_START)]
    return [p for p in first if (p or bare_start) and WORD_START not in p], [p for p in pieces if WORD_START not in p]


class Automaton:
    """Nodes 0 and 1 are the roots of first and of continuation pieces; ``fail`` is -1 where a split cannot go on."""

    FIRST, NEXT = 0, 1

    def __init__(self, first: Iterable[str], following: Iterable[str]):
        self.memo: dict[str, int] = {}
        self.child: list[dict[str, int]] = [{}, {}]
        is_piece = [False, False]
        for root, pieces in ((self.FIRST, first), (self.NEXT, following)):
            for piece in pieces:
                node = root
                for c in piece:
                    node = self.child[node].setdefault(c, len(self.child))
                    if node == len(self.child):
                        self.child.append({})
                        is_piece.append(False)
                is_piece[node] = True
        self.fail, self.popped = [-1] * len(self.child), [0] * len(self.child)
        # The continuation trie lies behind every failure link, and shorter nodes behind longer ones: breadth first, it first.
        if is_piece[self.FIRST]:  # the bare word start
            self.fail[self.FIRST], self.popped[self.FIRST] = self.NEXT, 1
        queue = deque([self.NEXT, self.FIRST])
        while queue:
            parent = queue.popleft()
            for c, node in self.child[parent].items():
                if is_piece[node]:
                    self.fail[node], self.popped[node] = self.NEXT, 1
                else:
                    back, popped = self.fail[parent], self.popped[parent]
                    while back >= 0 and c not in self.child[back]:
                        popped += self.popped[back]
                        back = self.fail[back]
                    if back >= 0:
                        self.fail[node], self.popped[node] = self.child[back][c], popped
                queue.append(node)

    def count(self, word: str) -> int:
        """How many pieces the word has; 0 if it cannot be split."""
        child, fail, popped = self.child, self.fail, self.popped
        node = n = 0
        for c in word:
            after = child[node].get(c)
            while after is None:
                n += popped[node]
                node = fail[node]
                if node < 0:
                    return 0
                after = child[node].get(c)
            node = after
        while node != self.NEXT:  # what is still unsettled at the end of the word
            n += popped[node]
            node = fail[node]
            if node < 0:
                return 0
        return n


def count_tokens(docs: DataFrame, first: Iterable[str], following: Iterable[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens and n_unknown for each row.

    Words are separated by white space (as Unicode has it). A word that cannot be split is one unknown token. A null or empty text has no
    words. Rows are independent of each other, so repeated rows repeat; other columns are not read.
    """

    def make(automaton: Automaton):
        memo = automaton.memo

        def step(batch: pa.RecordBatch) -> dict:
            n_words, n_tokens, n_unknown = [], [], []
            for text in batch.column("text").to_pylist():
                words = text.split()
                tokens = unknown = 0
                for word in words:
                    n = memo.get(word)
                    if n is None:
                        if len(memo) >= MEMO_ENTRIES:
                            memo.clear()
                        n = memo[word] = automaton.count(word)
                    if n:
                        tokens += n
                    else:
                        unknown += 1
                n_words.append(len(words))
                n_tokens.append(tokens + unknown)
                n_unknown.append(unknown)
            return {"doc_id": batch.column("doc_id"), "n_words": n_words, "n_tokens": n_tokens, "n_unknown": n_unknown}

        return step

    automaton = share(docs.sparkSession, Automaton(first, following))  # a fixed vocabulary
    return map_texts(docs, [docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col)], "doc_id long, n_words long, n_tokens long, n_unknown long", make, automaton)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return count_tokens(table(spark, sf_dir, "documents"), *pieces_of_model(vocabulary("piece_bpe_32k.model"), bare_start=True))
