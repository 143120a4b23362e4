"""BPE encoding and decoding in batched numpy merge rounds.

The symbols of many words stand in one flat array. A round looks up the rank
of every changed neighbouring pair by binary search over the sorted keys of
the merge table, takes the lowest rank of each word, and merges that pair
wherever the word has it. Words without a known pair leave the array.

``encode`` and ``decode`` are scalar Arrow UDFs over columns, so any other
columns of the frame, whatever their names, stay as they are.

Defined results: a null or empty text has no ids; null or empty ids decode to
the empty text; a text of any length is encoded whole; equal texts have equal
ids; the strings of added tokens give their ids, as in the library; an id
outside the vocabulary raises ``ValueError``; an empty frame gives an empty
frame.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from termflow.llm.common import free_name, source, whole_text
from termflow.llm.words import WordTable

NONE = np.int64(1) << 40
#: From here on, letters and digits depend on the version of Unicode.
FIRST_ODD = "\u0530"


class WordBpe:
    """The model in a tokenizer's JSON file: byte-level BPE with word ends,
    over NFC lower-case text split by the file's own pattern."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.rules = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"]
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"] + r"|\n")
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.added_re = regex.compile("|".join(map(regex.escape, self.added))) if self.added else None
        tokens = [""] * (1 + max([*vocab.values(), *self.added.values()]))
        for token, i in [*vocab.items(), *self.added.items()]:
            tokens[i] = token
        self.tokens = pa.array(tokens, pa.string())
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + self.suffix] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        born = np.full(len(self.tokens), -1)
        born[made] = np.arange(len(pairs))
        # A pair's rank is above those that made its two symbols, so a merge never
        # makes a pair of lower rank and all places of a word's best pair go at once.
        if not (np.maximum(born[left], born[right]) < np.arange(len(pairs))).all():
            raise ValueError("the merge list uses a symbol before it is made")
        order = np.argsort(left << 32 | right, kind="stable")
        self.keys = np.append((left << 32 | right)[order], np.iinfo(np.int64).max)
        self.ranks = np.append(order.astype(np.int64), NONE)
        self.made = made
        self.table = WordTable(self.encode_words)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and where each word's ids end."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        sym = self.inner[flat]
        last = np.cumsum(lengths)[lengths > 0] - 1
        sym[last] = self.final[flat[last]]
        word = np.repeat(np.arange(len(words)), lengths)
        rank = np.append(self.rank(sym[:-1], sym[1:]), NONE) if len(sym) else np.empty(0, np.int64)
        rank[last] = NONE
        done_sym, done_word = [], []
        while len(sym):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, first)
            best = np.repeat(best, np.diff(np.append(first, len(sym))))
            live = best < NONE
            if not live.all():
                done_sym.append(sym[~live])
                done_word.append(word[~live])
                sym, word, rank, best = sym[live], word[live], rank[live], best[live]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == best)
            # In a run of overlapping places, as in "aaa", every second one merges.
            run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            nth = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            at = at[nth % 2 == 0]
            sym[at] = self.made[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            now = at - np.arange(len(at))
            sym, word = sym[keep], word[keep]
            rank = rank[keep]
            changed = np.zeros(len(sym), bool)
            changed[now] = True
            changed[now[now > 0] - 1] = True
            touched = np.flatnonzero(changed)
            inside = touched[touched + 1 < len(sym)]
            rank[touched] = NONE
            inside = inside[word[inside] == word[inside + 1]]
            rank[inside] = self.rank(sym[inside], sym[inside + 1])
        if not done_sym:
            return np.empty(0, np.int64), np.zeros(len(words), np.int64)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        sym = sym[np.argsort(word, kind="stable")]
        return sym, np.cumsum(np.bincount(word, minlength=len(words)))

    def pieces_of(self, text: str) -> list[str]:
        """The pieces of a text without added tokens, a line end for each of its own."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # str.lower() knows the final sigma, the tokenizer lower-cases each character alone.
        text = "".join([c.lower() for c in text]) if "\u03a3" in text else text.lower()
        return self.pattern.findall(text)

    def pieces_of_lines(self, lines: list[str]) -> list[str]:
        """As of all lines in one text. Lines with characters beyond the scripts whose
        properties are the same in every Unicode version are normalised and cut by the
        file's own rules."""
        out: list[str] = []
        for n, (odd, run) in enumerate(groupby(lines, lambda x: max(x, default="") >= FIRST_ODD)):
            out += ["\n"] * (n > 0)
            if not odd:
                out += self.pieces_of("\n".join(run))
                continue
            for k, line in enumerate(run):
                line = self.rules.normalizer.normalize_str(line)
                out += ["\n"] * (k > 0) + [line[a:b] for _, (a, b) in self.rules.pre_tokenizer.pre_tokenize_str(line)]
        return out

    def encode_words(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and where each word's ids end. Words
        are cut as lines of one text; those with added tokens around them."""
        lines, owner, special = [], [], {}
        for i, w in enumerate(new):
            at = 0
            for m in self.added_re.finditer(w) if self.added_re and "<|" in w else ():
                lines += [w[at:m.start()], ""]
                special[len(lines) - 1] = self.added[m[0]]
                owner += [i, i]
                at = m.end()
            lines.append(w[at:])
            owner.append(i)
        pieces = self.pieces_of_lines(lines)
        number: dict[str, int] = {"\n": 0}
        piece = np.fromiter((number.setdefault(p, len(number)) for p in pieces), np.int64, len(pieces))
        ids, end = self.merge([b"" if w == "\n" else w.encode("utf-8") for w in number])
        begin = np.concatenate([[0], end])[:-1]
        line = np.cumsum(piece == 0)
        count = (end - begin)[piece]
        at = begin[piece]
        if special:
            where = np.array(list(special))
            put = np.searchsorted(line, where, "left") if len(line) else np.zeros(len(where), np.int64)
            at = np.insert(at, put, len(ids) + np.arange(len(where)))
            count, line = np.insert(count, put, 1), np.insert(line, put, where)
            ids = np.concatenate([ids, np.array(list(special.values()), np.int64)])
        stop = np.cumsum(count)
        flat = ids[np.repeat(at - stop + count, count) + np.arange(stop[-1] if len(stop) else 0)]
        sizes = np.bincount(np.array(owner, np.int64)[line], count, len(new)) if len(line) else np.zeros(len(new))
        return flat, np.cumsum(sizes).astype(np.int64)

    def decode(self, ids: pa.Array) -> pa.Array:
        """Each list's tokens joined by a space, as for a tokenizer file without
        decoder (null: the empty text)."""
        flat = ids.flatten()
        known = np.asarray(flat) if len(flat) else np.empty(0, np.int32)
        if len(known) and not (0 <= known.min() and known.max() < len(self.tokens)):
            raise ValueError("an id outside the vocabulary")
        sizes = pc.fill_null(pc.list_value_length(ids), 0)
        ends = np.concatenate([[0], np.cumsum(np.asarray(sizes))])
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.tokens.take(flat)), " ")


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others count up from 256."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


@lru_cache(maxsize=4)
def model(path: str) -> WordBpe:
    """The model of a file, read once in each Python worker."""
    return WordBpe(path)


def id_lists(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))


def encode(text: Column, path: str) -> Column:
    """The ids of each text under the tokenizer file at ``path``."""

    @F.arrow_udf("array<int>")
    def bpe_encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model(path)
        for texts in batches:
            yield id_lists(*m.table.encode(texts))

    return bpe_encode(whole_text(text))


def decode(ids: Column, path: str) -> Column:
    """The text that each list of ids stands for."""

    @F.arrow_udf("string")
    def bpe_decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model(path)
        for lists in batches:
            yield m.decode(lists)

    return bpe_decode(ids)


def bpe_round_trip(docs: DataFrame, path: str, text: str = "text", ids: str = "ids",
                   decoded: str = "decoded") -> DataFrame:
    """``docs`` with the ids of each text and the text decoded from them, in one
    pass through Python."""

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def encode_decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model(path)
        for texts in batches:
            made = id_lists(*m.table.encode(texts))
            yield pa.StructArray.from_arrays([made, m.decode(made)], ["ids", "decoded"])

    both = free_name(docs, "both")
    return (docs.withColumn(both, encode_decode(whole_text(text)))
            .withColumns({ids: F.col(f"{both}.ids"), decoded: F.col(f"{both}.decoded")}).drop(both))


def op3_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document's ids and decoded text."""
    import public_tokenizers

    made = bpe_round_trip(source(spark, sf_dir, "documents", "doc_id", "text"),
                          public_tokenizers.path("word_bpe_49k.json"))
    return made.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
