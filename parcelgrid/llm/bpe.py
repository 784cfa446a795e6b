"""Byte-pair encoding by backtracking over longest matches, and decoding.

Encoding a word by repeated merging costs a scan per merge.  Here the tokens
of a word are found directly: one pass of an Aho-Corasick automaton over the word finds the
longest token that starts at each place; the encoder takes the longest token that
is *compatible* with the token before it and whose end is not known to be
dead, and steps back when none is.  A sequence of tokens is the result of the
merges exactly when every adjacent pair is, so a table of pair compatibility decides, and
every position is left for good at most once: the time is linear in the word.
Compatibility of a pair is found by taking both tokens apart along the seam, newest merge first, and looking for a merge
across the seam that would have come earlier.

Words repeat, so each worker keeps a bounded table of encoded ones.  Decoding
looks tokens up in one byte string with an offset table.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import named, slices

_NEVER = 1 << 60


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """A byte-level BPE vocabulary with optional word-end marks, from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        # the word's last letter is a letter of its own (letter + mark), written as one character 0x1000 higher
        self.rank: dict[tuple[int, int], int] = {}
        self.split: dict[int, tuple[int, int]] = {}
        self.order: dict[int, int] = {}
        for k, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, made = self.ids[a], self.ids[b], self.ids[a + b]
            self.rank.setdefault((left, right), k)
            if made not in self.split:
                self.split[made] = (left, right)
                self.order[made] = k
        self.steps = self._normalizers(spec["normalizer"])
        self.pattern = self._pattern(spec["pre_tokenizer"])
        self.letters = byte_letters()
        self.front = Tokenizer.from_file(path)
        self.table: dict[str, int] = {}
        self.auto = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for token, i in self.ids.items():
            body = token.removesuffix(self.suffix) if self.suffix else token
            key = body[:-1] + chr(ord(body[-1]) + 0x1000) if body != token else token
            if self._stable(i):
                self.table[key] = i
                self.auto.add_word(key[::-1], i)
        self.auto.make_automaton()
        #: letters of each token, and the longest token that is a proper prefix of it
        self.size = [0] * len(self.names)
        self.shorter: list[int | None] = [None] * len(self.names)
        for key, i in self.table.items():
            self.size[i] = len(key)
            self.shorter[i] = next((t for k in range(len(key) - 1, 0, -1) if (t := self.table.get(key[:k])) is not None), None)
        self.compatible = lru_cache(maxsize=1 << 17)(self._compatible)

    @staticmethod
    def _normalizers(spec) -> list[tuple[str, ...]]:
        out = []
        for n in (spec["normalizers"] if spec["type"] == "Sequence" else [spec]):
            if n["type"] not in ("NFC", "Lowercase", "Replace"):
                raise ValueError(f"normalizer {n['type']} is not supported")
            if n["type"] == "Replace" and (n["pattern"] != {"Regex": r"\s+"} or n["content"] != " "):
                raise ValueError("only white space runs can be replaced")
            out.append(n["type"])
        return out

    @staticmethod
    def _pattern(spec):
        parts = spec["pretokenizers"] if spec["type"] == "Sequence" else [spec]
        kinds = [p["type"] for p in parts]
        if kinds != ["Split", "ByteLevel"] or parts[0]["behavior"] != "Removed" or not parts[0]["invert"] \
                or parts[1]["add_prefix_space"] or parts[1]["use_regex"]:
            raise ValueError("pre-tokenizer not supported")
        return regex.compile(parts[0]["pattern"]["Regex"])

    # ---- merging

    def _stable(self, token: int) -> bool:
        """Whether encoding the token's own letters gives the token back."""
        if token not in self.split:
            return True
        left, right = self.split[token]
        return self._stable_cached(left) and self._stable_cached(right) and self._compatible(left, right, self.order[token])

    def _stable_cached(self, token: int) -> bool:
        cache = self.__dict__.setdefault("_stability", {})
        if token not in cache:
            cache[token] = self._stable(token)
        return cache[token]

    def _compatible(self, a: int, b: int, before: int = _NEVER) -> bool:
        """Whether merging the letters of ``a`` + ``b`` leaves ``a`` and ``b`` side by
        side (looking only at merges earlier than ``before``).

        Follow the two parts that touch the seam back in time; the later-made one is
        taken apart first.  While both exist, a merge of the two spoils the pair if it comes before the
        merges that consume them: earlier than the left part's own (of equal merges
        the left goes first), and no later than the right part's own."""
        left_until = right_until = before
        while True:
            r = self.rank.get((a, b), _NEVER)
            if r < left_until and r <= right_until:
                return False
            made_a, made_b = self.order.get(a, -1), self.order.get(b, -1)
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                left_until, a = made_a, self.split[a][1]
            else:
                right_until, b = made_b, self.split[b][0]

    def _longest(self, text: str) -> list[int]:
        """The longest token that starts at each place: the automaton of the reversed tokens reads the text from its end
        and reports the tokens that end at a place from the longest to the shortest."""
        longest = dict(reversed([*self.auto.iter(text[::-1])]))
        return [longest[end] for end in range(len(text) - 1, -1, -1)]

    def encode_letters(self, text: str) -> list[int]:
        """Token ids of one pre-token, given the letters of its bytes; the last one gets the word-end mark.

        At each place the longest match is tried first, then its shorter prefixes; a token is taken
        when it is compatible with the one before it and its end is not dead.  When none fits, the place is
        dead, and the token before it gives way to its next shorter prefix."""
        if self.suffix:
            text = text[:-1] + chr(ord(text[-1]) + 0x1000)
        n, size, shorter, compatible = len(text), self.size, self.shorter, self.compatible
        if (whole := self.table.get(text)) is not None:
            return [whole]  # every token of the table encodes to itself
        dead = bytearray(n + 1)
        path: list[int] = []
        longest = self._longest(text)
        pos, token = 0, longest[0]
        while True:
            end = pos + size[token]
            if not dead[end] and (not path or compatible(path[-1], token)):
                path.append(token)
                if end == n:
                    return path
                pos, token = end, longest[end]
                continue
            nxt = shorter[token]
            while nxt is None:
                dead[pos] = 1
                token = path.pop()
                pos -= size[token]
                nxt = shorter[token]
            token = nxt

    # ---- text

    def normalize(self, text: str) -> str:
        for step in self.steps:
            if step == "NFC":
                text = text if text.isascii() else unicodedata.normalize("NFC", text)
            elif step == "Lowercase":  # letter by letter, so a final sigma is like any other
                text = text.lower() if text.isascii() or "Σ" not in text else "".join(c.lower() for c in text)
        return text

#: letters beyond these are left to the tokenizer file's own front end
_RARE = regex.compile(r"[^\x00-\u024f]")


#: fixed values: separators that str.split() takes for white space and the normalizer does not
_EXTRA_SPACE = regex.compile("[\x1c-\x1f]")
#: fixed values: white space up to U+024F
_SPACE = regex.compile(r"[\x09-\x0d\x20\x85\xa0]+")


class Encoder(dict):
    """Stretch without white space -> ids, cleared when it has grown to its bound; encodes texts.
    No pre-token of the supported pattern holds white space."""

    BOUND = 400_000

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.v = vocabulary
        self.marks = regex.compile("|".join(regex.escape(s) for s in sorted(vocabulary.special, key=len, reverse=True)) or r"(?!)")
        #: letters that a special token begins with; a text without them holds none
        self.starts = {s[0] for s in vocabulary.special}
        #: letters of a byte string read as Latin-1
        self.letters = dict(enumerate(vocabulary.letters))

    def piece(self, piece: str) -> tuple[int, ...]:
        plain = piece.isascii() and piece.isprintable()  # such bytes are their own letters
        letters = piece if plain else piece.encode().decode("latin-1").translate(self.letters)
        return tuple(self.v.encode_letters(letters))

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        if not chunk:  # at the ends of a split
            return ()
        if chunk.isalpha():
            ids = self.piece(chunk)
        elif chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
            ids = self[chunk[:-1]] + self.piece(chunk[-1])
        else:
            pieces = self.v.pattern.findall(chunk)
            ids = self.piece(chunk) if pieces == [chunk] else tuple(i for p in pieces for i in self[p])
        if len(self) >= self.BOUND:
            self.clear()
        self[chunk] = ids
        return ids

    def plain(self, text: str) -> list[int]:
        """Ids of a text without special tokens.  Beyond U+024F Unicode versions differ between libraries, so
        the tokenizer file's own front end normalizes and cuts such a text."""
        if not _RARE.search(text):
            text = self.v.normalize(text)
            chunks = text.split() if not _EXTRA_SPACE.search(text) else _SPACE.split(text)
            return [i for c in chunks for i in self[c]]
        front, encode = self.v.front, self.v.encode_letters
        return [i for p, _ in front.pre_tokenizer.pre_tokenize_str(front.normalizer.normalize_str(text)) for i in encode(p)]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; special tokens written out in it are themselves."""
        text = text or ""
        if not any(c in text for c in self.starts):
            return self.plain(text)
        out: list[int] = []
        pos = 0
        for m in self.marks.finditer(text):
            out += self.plain(text[pos:m.start()])
            out.append(self.v.special[m.group()])
            pos = m.end()
        return out + self.plain(text[pos:])


class Decoder:
    """Token names in one byte string, cut out by an offset table."""

    def __init__(self, vocabulary: Vocabulary):
        names = [(n + " ").encode() for n in vocabulary.names]
        self.blob = np.frombuffer(b"".join(names), dtype=np.uint8)
        self.size = np.array([len(n) for n in names], dtype=np.int64)
        self.offset = np.concatenate(([0], np.cumsum(self.size)))

    def decode(self, ids: np.ndarray) -> str:
        """Token names joined by one space."""
        if ids is None or not len(ids):
            return ""
        ids = np.asarray(ids, dtype=np.int64)
        size = self.size[ids]
        ends = np.cumsum(size)
        take = np.repeat(self.offset[ids] - (ends - size), size) + np.arange(ends[-1])
        return self.blob[take[:-1]].tobytes().decode()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker process."""
    return Vocabulary(path)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One table of encoded pre-tokens per worker process; it outlives a task."""
    return Encoder(vocabulary(path))


def encode(text: Column, path: str) -> Column:
    """Token ids (array<int>) of a text column; null and blank texts give an empty array."""
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(path)
        for texts in slices(batches):
            yield pd.Series([np.array(enc.encode(t), dtype=np.int32) for t in texts], dtype=object)
    return run(text)


def decode(ids: Column, path: str) -> Column:
    """Decoded text of an id array column; null and empty arrays give an empty text."""
    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dec = Decoder(vocabulary(path))
        for rows in slices(batches):
            yield pd.Series([dec.decode(r) for r in rows], dtype=object)
    return run(ids)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ids (array<int>), decoded (text).

    Map-only: no row meets another, so repeats, hot keys and an empty table change
    nothing; null and empty texts have no tokens; a very long text is
    encoded whole."""
    ids = docs.select(named(docs, id_col).alias(id_col), encode(named(docs, text_col), path).alias("ids"))
    return ids.withColumn("decoded", decode(F.col("ids"), path))
