"""Token ids of whole batches of texts, a distinct word at a time."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: A worker keeps the ids of so many words and of so many of their characters; beyond either it starts anew.
MEMO_WORDS, MEMO_CHARS = 800_000, 16_000_000
#: Arrow cuts at these characters, which are no white space to the tokenizer's pattern.
SEPARATORS = "[\x1c-\x1f]"
#: A mark after a letter begins a match of its own, but for the apostrophe of a contraction.
LETTER_MARK, APART = r"(\pL)([!-&(-/:-@\[-`{-~])", r"\1 \2"
#: Words that the tokenizer's normalizer only turns to lower case, letter by letter, and its pattern takes whole.
PLAIN = "^[a-zß-öø-ÿÀ-ÖØ-Þ]+$"
END = "</w>"


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


class WordEncoder:
    """Ids of texts for a tokenizer that lower-cases, drops white space, lets no token reach across it, and ends words with ``</w>``.

    Texts are lower-cased (A-Z) and cut at white space and before marks in Arrow, and each distinct word of a batch is looked up once. Words the
    worker has not met go to the library: plain ones in one call, without the normalizer, which would not change them, and told apart by their last
    tokens; others by themselves. The ids of the batch are then gathered by index. A text that holds the string of an added token in any case, or
    a character at which Arrow would cut wrongly, goes to the library as it is. So do all texts if the tokenizer is of another kind.
    """

    def __init__(self, tokenizer_json: str):
        self.tokenizer_json = tokenizer_json
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        known = json.loads(tokenizer_json)
        splits = [p.get("type") for p in (known.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        kind = [n.get("type") for n in (known.get("normalizer") or {}).get("normalizers", [])], splits, known["model"].get("end_of_word_suffix")
        words = kind == (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], END)
        self.whole = "|".join([SEPARATORS, *[f"(?i:{re.escape(content)})" for content in added]]) if words else ""
        bytes_only = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        bare = {**known, "normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, bytes_only]}}
        self.bare = Tokenizer.from_str(json.dumps(bare)) if words else None
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.n_ids = max(vocab.values()) + 1
        self.last = np.zeros(self.n_ids, bool)
        self.last[[i for token, i in vocab.items() if token.endswith(END)]] = True
        self.width = "<u2" if self.n_ids <= 1 << 16 else "<u4"
        self.forget()

    def __reduce__(self):
        return WordEncoder, (self.tokenizer_json,)

    def forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.chars = self.used = 0
        self.ids = np.empty(1 << 16, self.width)
        self.starts, self.lengths = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def learn(self, words: list[str]) -> None:
        own = pa.array(words, pa.string())
        plain = pc.match_substring_regex(own, PLAIN).to_numpy(zero_copy_only=False) if self.bare else np.zeros(len(words), bool)
        if plain.any():
            simple = own.filter(pa.array(plain)).to_pylist()
            new = np.array(self.bare.encode_batch_fast([" ".join(simple).lower()], add_special_tokens=False)[0].ids, self.width)
            self.store(simple, new, np.diff(np.nonzero(self.last[new])[0], prepend=-1))
        rest = own.filter(pa.array(~plain)).to_pylist()
        if rest:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
            self.store(rest, np.fromiter((i for ids in found for i in ids), self.width), np.fromiter(map(len, found), np.int64, len(found)))

    def store(self, words: list[str], new: np.ndarray, lengths: np.ndarray) -> None:
        first, n = len(self.memo), len(self.memo) + len(words)
        while self.used + len(new) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while n > len(self.starts):
            self.starts, self.lengths = (np.concatenate([a, np.empty_like(a)]) for a in (self.starts, self.lengths))
        self.ids[self.used : self.used + len(new)] = new
        self.lengths[first:n] = lengths
        self.starts[first:n] = self.used + np.cumsum(lengths) - lengths
        self.used += len(new)
        self.memo.update(zip(words, range(first, n), strict=True))
        self.chars += sum(map(len, words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and for each text where its ids end. The texts must not be null."""
        odd = pc.match_substring_regex(texts, self.whole) if self.bare else pa.array([True] * len(texts))
        words = pc.utf8_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(texts), LETTER_MARK, APART))
        if pc.any(odd).as_py():
            split = zip(texts.to_pylist(), words.to_pylist(), odd.to_pylist(), strict=True)
            words = pa.array([[text] if whole else cut for text, cut, whole in split], pa.list_(pa.string()))
        if len(self.memo) > MEMO_WORDS or self.chars > MEMO_CHARS:
            self.forget()
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        slots = np.array([self.memo.get(word, -1) for word in distinct], np.int64)
        new = np.nonzero(slots < 0)[0].tolist()
        if new:
            self.learn([distinct[k] for k in new])
            slots[new] = [self.memo[distinct[k]] for k in new]
        slot = slots[coded.indices.to_numpy()]
        lengths = self.lengths[slot]
        ids = self.ids[ragged(self.starts[slot], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))]
        return ids, ends
