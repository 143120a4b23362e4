"""Ids of texts by the tokenizers library, through the table of words.

Every distinct word goes to the library once. Plain ASCII words are lower-cased
and split here by the file's own pattern, and the library's model gets their
distinct pieces as one pre-tokenized input; all other words go through the
library's whole pipeline.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

from termflow.llm.words import WordTable


class LibraryEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        pattern = split["pattern"]["Regex"].replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9")
        self.pattern = re.compile(pattern.replace("[[", "[").replace("]]", "]") + r"|\n", re.ASCII)
        self.between = next(((x["content"], x["id"]) for x in spec["added_tokens"]
                             if not (x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"])), None)
        spec |= {"normalizer": None, "pre_tokenizer": None, "truncation": None, "padding": None}
        self.model = Tokenizer.from_str(json.dumps(spec))
        # Printable ASCII stands for itself in a byte-level vocabulary.
        self.plain = re.compile(r"(?!.*<\|)[!-~]*\Z").match
        self.table = WordTable(self.encode_words)

    def encode_others(self, words: list[str]) -> list[np.ndarray]:
        """Words through the whole pipeline. An added token cuts a text before all
        other rules, so words joined by one are encoded as if each stood alone."""
        if self.between is None or any(self.between[0] in w for w in words):
            return [np.array(x.ids, np.int64) for x in self.whole.encode_batch(words, add_special_tokens=False)]
        if not words:
            return []
        ids = np.array(self.whole.encode(self.between[0].join(words), add_special_tokens=False).ids, np.int64)
        cut = np.flatnonzero(ids == self.between[1])
        return [ids[a:b] for a, b in zip([0, *(cut + 1).tolist()], [*cut.tolist(), len(ids)])]

    def encode_words(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and where each word's ids end."""
        plain = np.fromiter((self.plain(w) is not None for w in new), bool, len(new))
        pieces = self.pattern.findall("\n".join(w for w, p in zip(new, plain) if p).lower())
        number: dict[str, int] = {"\n": 0}
        piece = np.fromiter((number.setdefault(p, len(number)) for p in pieces), np.int64, len(pieces))
        got = self.model.encode(list(number)[1:], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(got.ids, np.int64)
        sizes = np.zeros(len(number), np.int64)
        sizes[1:] = np.bincount(np.array(got.word_ids, np.int64), minlength=len(number) - 1)
        at = (np.cumsum(sizes) - sizes)[piece]
        count = sizes[piece]
        total = np.zeros(len(new), np.int64)
        if plain.any():
            total[plain] = np.bincount(np.cumsum(piece == 0), count, int(plain.sum()))
        others = self.encode_others([w for w, p in zip(new, plain) if not p])
        total[~plain] = np.fromiter(map(len, others), np.int64, len(others))
        stop = np.cumsum(count)
        flat_plain = ids[np.repeat(at - stop + count, count) + np.arange(stop[-1] if len(stop) else 0)]
        flat = np.empty(total.sum(), np.int64)
        is_plain = np.repeat(plain, total)
        flat[is_plain] = flat_plain
        flat[~is_plain] = np.concatenate([np.empty(0, np.int64), *others])
        return flat, np.cumsum(total)


@lru_cache(maxsize=4)
def encoder(path: str) -> LibraryEncoder:
    """The encoder of a file, made once in each Python worker."""
    return LibraryEncoder(path)


def ids_with_end(texts: pa.Array, path: str, end: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch of texts as unsigned 32-bit integers, each text's
    followed by ``end``, and for each text and one past the last where it begins."""
    flat, ends = encoder(path).table.encode(texts)
    flat = np.insert(flat.astype("<u4", copy=False), ends[1:], end)
    return flat, ends + np.arange(len(ends))
