"""Byte-pair encoding by backtracking, for tokenizers with an end-of-word suffix.

An Aho-Corasick automaton finds all vocabulary tokens inside a word. The encoder takes the longest
token at each position and goes back to shorter ones where a token does not fit the one before it.
Two tokens fit if merging their text by rank leaves just the two: that is read off the ranks at which
the symbols on both sides of their border come and go, and kept in a table of pairs. As every prefix
of a word has one encoding, a position that fails once fails always, so each is left at most once and
the time is linear in the word. The result is exactly that of merging pairs by rank.

Decoding looks the ids up in one string of all tokens through a table of offsets.

A text is encoded as the tokenizers library does: added tokens are cut out, the rest is put into NFC
and lower case and split into words, words into bytes. Words repeat, so each run of text between
ASCII blanks is encoded once a task and kept in a bounded table. Null and empty texts have no token.
"""

from __future__ import annotations

import hashlib
import json
import math
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelscope.llm.common import Recent

_END = "\n"  # stands for the suffix; it is no character of the byte alphabet
_NEVER = math.inf
KNOWN_RUNS = 150_000  # of one generation of the table; two are held


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, extra = {}, 256
    for byte in range(256):
        if byte in plain:
            letters[byte] = chr(byte)
        else:
            letters[byte] = chr(extra)
            extra += 1
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Tokens, merges and the table of pairs of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = [s["pattern"]["Regex"] for s in spec["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or len(steps) != 1 or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"]:
            raise ValueError(f"{path}: not a word BPE of the known kind")
        self.pattern = regex.compile(steps[0])
        self.suffix = model["end_of_word_suffix"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_pattern = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        ids: dict[str, int] = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.born: dict[int, int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            whole = ids[left + right]
            pair = (ids[left], ids[right])
            self.rank[pair] = rank
            self.parts[whole] = pair
            self.born[whole] = rank
            if max(self.born.get(pair[0], -1), self.born.get(pair[1], -1)) >= rank:
                raise ValueError("a merge comes before its parts")
        self.automaton = ahocorasick.Automaton()
        for token, number in ids.items():
            ended = token.endswith(self.suffix) and len(token) > len(self.suffix)
            text = token[: -len(self.suffix)] + _END if ended else token
            if number in self.parts or len(text) - ended == 1:
                self.automaton.add_word(text, (len(text), number))
        self.automaton.make_automaton()
        names = {number: token for token, number in [*ids.items(), *self.added.items()]}
        ordered = [names.get(i, "") for i in range(max(names) + 1)]
        self.text = "".join(ordered)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in ordered])]).tolist()
        self.letters = dict(enumerate(byte_alphabet()))
        self.words = Recent(self._known_word, KNOWN_RUNS * 2 // 3)
        self.most_pairs = KNOWN_RUNS * 2
        self.fits: dict[int, bool] = {}

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """Symbols at one border of a token, first to last, each with the rank of the merge that ends it."""
        out, ends = [], _NEVER
        while True:
            out.append((token, ends))
            if token not in self.parts:
                return out[::-1]
            ends = self.born[token]
            token = self.parts[token][side]

    def pair_fits(self, left: int, right: int) -> bool:
        """Whether the text of both tokens together is encoded as the two."""
        known = self.fits.get(left << 32 | right)
        if known is not None:
            return known
        a, b = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        fits = True
        while True:
            (x, x_ends), (y, y_ends) = a[i], b[j]
            rank = self.rank.get((x, y), _NEVER)
            # Of equal pairs the leftmost merges first.
            if rank < x_ends and rank <= y_ends and rank != _NEVER:
                fits = False
                break
            if x_ends == y_ends == _NEVER:
                break
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1
        if len(self.fits) >= self.most_pairs:
            self.fits.clear()
        self.fits[left << 32 | right] = fits
        return fits

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word, as written in the byte alphabet."""
        text = word + _END
        at: list[list[tuple[int, int]]] = [[] for _ in text]
        for last, found in self.automaton.iter(text):
            at[last - found[0] + 1].append(found)  # ends come in order, so the longest is the last
        out: list[int] = []
        place, left = [0], [len(at[0])]  # the path, and how many choices are left at each of its positions
        dead = bytearray(len(text) + 1)
        while place[-1] < len(text):
            start = place[-1]
            here = at[start]
            for n in range(left[-1] - 1, -1, -1):
                length, token = here[n]
                if not dead[start + length] and (not out or self.pair_fits(out[-1], token)):
                    left[-1] = n
                    out.append(token)
                    place.append(start + length)
                    left.append(len(at[start + length]) if start + length < len(text) else 0)
                    break
            else:
                if len(place) == 1:
                    raise ValueError(f"no encoding of {word!r}")
                dead[place.pop()] = 1
                left.pop()
                out.pop()
        return out

    def _known_word(self, word: str) -> list[int]:
        return self.encode_word(word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters))

    def encode(self, text: str) -> list[int]:
        """Ids of any text."""
        out: list[int] = []
        cut = any(a in text for a in self.added)
        for piece in self.added_pattern.split(text) if cut else [text]:
            if piece in self.added:
                out.append(self.added[piece])
                continue
            # Letters are put into lower case one by one: no rule for a final sigma.
            plain = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
            for word in self.pattern.findall(plain):
                out += self.words[word]
        return out

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a blank, as a tokenizer without decoder does; unknown ids are left out."""
        o, last = self.offsets, len(self.offsets) - 1
        return " ".join([self.text[o[i] : o[i + 1]] for i in ids if 0 <= i < last])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def _known_runs(path: str, with_ids: bool, known: int) -> Recent:
    """Run of text -> (ids as decimal text, decoded text, packed ids), all empty where it has no token.

    One table for all tasks of a worker process.
    """
    vocab = vocabulary(path)
    vocab.words.size, vocab.most_pairs = known * 2 // 3, known * 2

    def compute(run: bytes) -> tuple[bytes, bytes, bytes]:
        ids = vocab.encode(run.decode("utf-8"))
        packed = array("i", ids).tobytes() if with_ids else b""
        return " ".join(map(str, ids)).encode(), vocab.decode(ids).encode(), packed

    return Recent(compute, known)


def encode_texts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, known: int = KNOWN_RUNS
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row; with_ids: also ids, the token ids themselves.

    `known` bounds the tables of runs, words and pairs that a worker keeps: about 1 KB of memory for each.
    """
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _known_runs(path, with_ids, known)
        for batch in batches:
            counts, ids_hex, decoded_hex, packed = [], [], [], []
            for text in batch.column(1):
                found = [r for r in map(runs.__getitem__, (text.as_py() or "").encode().split()) if r[0]]
                ids = b" ".join([r[0] for r in found])
                counts.append(ids.count(b" ") + 1 if ids else 0)
                ids_hex.append(hashlib.sha256(ids).hexdigest())
                decoded_hex.append(hashlib.sha256(b" ".join([r[1] for r in found])).hexdigest())
                if with_ids:
                    packed.append(b"".join([r[2] for r in found]))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(decoded_hex, pa.string())]
            if with_ids:
                ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                columns.append(pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(packed), dtype=np.int32))))
            yield pa.RecordBatch.from_arrays(columns, [*names, "ids"] if with_ids else names)

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, schema).withColumnRenamed("id", id_col)
