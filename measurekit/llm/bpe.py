"""Byte-pair encoding by a prefix-sharing trie, and decoding.

The distinct words of a block of texts are walked in sorted order, which is the depth-first order of
their trie; the stack holds, for every prefix on the current path, the last token of the prefix's
encoding. A prefix shared by many words is encoded once. The last token of a longer prefix is the one
vocabulary token that ends there and may follow the last token of what stands before it: a sequence
of tokens is the encoding of its text if and only if every neighbouring pair is, so each pair of
tokens is tested once, by undoing the merges on both sides of its border (or by plain merging, where ranks do not
tell their order), and remembered.

The vocabulary is a tokenizer file of the ``tokenizers`` library (byte-level pieces, end-of-word suffix,
regular-expression split), given by its path and never copied.

Defined results: a null or empty text has no ids and decodes to the empty text; whole texts of any length are
encoded; repeated rows give repeated rows; an existing output column is replaced; an empty table gives
an empty table.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_column, map_columns

#: Words remembered by a worker between texts, and characters of text handled together (one text at least). Both bound memory,
#: not results.
WORD_CACHE = 600_000
PAIR_CACHE = 300_000
BLOCK_CHARS = 2_000_000
#: Tokens are looked up by the lengths that occur with their last letters.
TAIL = 3

#: The characters that the vocabulary's split treats as white space below U+0300.
SPACES = "\t\n\x0b\x0c\r \x85\xa0"
#: The contractions split off first.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


def byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte: itself where it is a visible Latin-1 character, else the next free one from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(visible)]
    return {**{b: chr(b) for b in visible}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


def _class(prefix: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(0x300) if unicodedata.category(chr(c)).startswith(prefix))


class Splitter:
    """Normalised words of a text, as the vocabulary's normaliser and split rules give them.

    Below U+0300 (but U+0130) the rules need no Unicode tables beyond letter and number classes; other texts go through the
    library's own normaliser and splitter.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        letters, numbers, spaces = _class("L"), _class("N"), "".join(map(re.escape, SPACES))
        self._plain = re.compile(rf"{CONTRACTIONS}|[a-z]+|[0-9]|[^{spaces}a-z0-9]+")
        self._latin = re.compile(rf"{CONTRACTIONS}|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+")
        self._beyond = re.compile("[^\x00-įı-˿]")
        self._bytes = {letter: byte for byte, letter in byte_letters().items()}

    def words(self, text: str) -> list[str]:
        if self._cut is None or "<" not in text:
            return self._segment(text)
        found: list[str] = []
        for piece in self._cut.split(text):
            found += [piece] if piece in self.special else self._segment(piece)
        return found

    def _segment(self, text: str) -> list[str]:
        if text.isascii():
            return self._plain.findall(text.lower())
        if not self._beyond.search(text):
            return self._latin.findall(text.lower())
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self._bytes.__getitem__, word)).decode() for word, _ in pieces]


def _lengths(tokens: Iterable[str]) -> dict[str, tuple[int, ...]]:
    """Tail of a spelling (its last ``TAIL`` letters or fewer) -> lengths of the tokens that may end there, longest first."""
    exact: dict[str, set[int]] = {}
    for token in tokens:
        if token:
            exact.setdefault(token[-TAIL:], set()).add(len(token))
    tails = {tail: set(found) for tail, found in exact.items()}
    for tail, found in tails.items():
        for cut in range(1, len(tail)):  # shorter tokens that are an end of the tail
            found |= exact.get(tail[cut:], set())
    return {tail: tuple(sorted(found, reverse=True)) for tail, found in tails.items()}


class TrieEncoder:
    """Encodes sets of distinct words; ``vocabulary`` and ``merges`` as in the tokenizer file."""

    def __init__(self, vocabulary: dict[str, int], merges: Sequence[tuple[str, str]], suffix: str) -> None:
        self.ids, self.suffix = vocabulary, suffix
        self.ranks = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.tokens = {i: t for t, i in vocabulary.items()}
        # pieces end a word or not; tokens that end a word are looked up without the suffix
        self.inner = {t: i for t, i in vocabulary.items() if not (suffix and t.endswith(suffix))}
        self.final = {t[: len(t) - len(suffix)]: i for t, i in vocabulary.items() if t.endswith(suffix)} if suffix else self.inner
        self.inner_lengths, self.final_lengths = _lengths(self.inner), _lengths(self.final)
        self.letters = byte_letters()
        self.pairs: dict[int, bool] = {}
        self.made: dict[str, bool] = {}
        self.splits = self._last_merges()

    def symbols(self, token: int) -> list[str]:
        return self._letters(self.tokens[token])

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain merging, best rank first; for single pairs of tokens."""
        symbols = list(symbols)
        while len(symbols) > 1:
            rank, at = min((self.ranks.get(p, 1 << 30), i) for i, p in enumerate(zip(symbols, symbols[1:])))
            if rank == 1 << 30:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _last_merges(self) -> dict[str, tuple[int, str, str]] | None:
        """Token -> (rank, left, right) of the merge that makes it; None where ranks do not tell in which order merges happen.

        They do if every token is made by one merge only, later than its parts and from its own spelling.
        """
        found: dict[str, tuple[int, str, str]] = {}
        for (a, b), rank in self.ranks.items():
            made = found.get(a, (-1,))[0], found.get(b, (-1,))[0]
            if a + b in found or max(made) >= rank:
                return None
            found[a + b] = rank, a, b
        if any(a not in found and len(self._letters(a)) > 1 for pair in self.ranks for a in pair):
            return None
        return found

    def _letters(self, text: str) -> list[str]:
        if self.suffix and text.endswith(self.suffix) and len(text) > len(self.suffix):
            body = text[: -len(self.suffix)]
            return [*body[:-1], body[-1] + self.suffix]
        return list(text)

    def stays(self, left: str, right: str, limit: int = 1 << 30) -> bool:
        """Does plain merging keep the border of two tokens, as far as the merges below rank ``limit`` go?

        The merges inside both are undone, last one first: the border goes if its two sides would have been merged before that.
        """
        ranks, splits = self.ranks, self.splits
        while ranks.get((left, right), limit) >= limit:
            a, b = splits.get(left), splits.get(right)
            if a and (not b or a[0] > b[0]):
                limit, left = a[0], a[2]
            elif b:
                limit, right = b[0] + 1, b[1]
            else:
                return True
        return False

    def whole(self, token: str) -> bool:
        """Does plain merging of its spelling give the token?"""
        known = self.made.get(token)
        if known is None:
            last = self.splits.get(token)
            known = len(self._letters(token)) == 1 if last is None else self.whole(last[1]) and self.whole(last[2]) and self.stays(last[1], last[2], last[0])
            self.made[token] = known
        return known

    def follows(self, left: int, right: int) -> bool:
        """May ``right`` stand after ``left`` (-1: at the start)?"""
        key = (left + 1) << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIR_CACHE:
                self.pairs.clear()
            known = self.pairs[key] = self._merging_keeps(left, right)
        return known

    def _merging_keeps(self, left: int, right: int) -> bool:
        if self.splits is not None:
            second = self.tokens[right]
            first = self.tokens[left] if left >= 0 else None
            return self.whole(second) and (first is None or (self.whole(first) and self.stays(first, second)))
        before = [self.tokens[left]] if left >= 0 else []
        symbols = (self.symbols(left) if left >= 0 else []) + self.symbols(right)
        return self.merged(symbols) == [*before, self.tokens[right]]

    def encode(self, words: Iterable[str]) -> dict[str, bytes]:
        """Word -> its ids as little-endian int32."""
        letters, pairs, follows = self.letters, self.pairs, self.follows
        inner, final, inner_lengths, final_lengths = self.inner, self.final, self.inner_lengths, self.final_lengths
        spelled = sorted((w if w.isascii() and w.isprintable() else "".join(letters[b] for b in w.encode()), w) for w in words)
        found: dict[str, bytes] = {}
        last: list[int] = [-1]  # last token of each prefix on the path
        since: list[int] = [0]  # where that token begins
        path = ""
        for spelling, word in spelled:
            n = len(spelling)
            shared, most = 0, min(n - 1, len(last) - 1)
            while shared < most and spelling[shared] == path[shared]:
                shared += 1
            del last[shared + 1 :], since[shared + 1 :]
            path = spelling
            for end in range(shared + 1, n + 1):
                lookup, lengths = (final, final_lengths) if end == n else (inner, inner_lengths)
                near = end - TAIL if end > TAIL else 0
                while (ends := lengths.get(spelling[near:end])) is None and near < end - 1:
                    near += 1
                for length in ends or ():
                    begin = end - length
                    token = lookup.get(spelling[begin:end]) if begin >= 0 else None
                    if token is not None:
                        left = last[begin]
                        known = pairs.get((left + 1) << 32 | token)
                        if known or (known is None and follows(left, token)):
                            break
                else:
                    raise ValueError(f"the vocabulary cannot spell {word!r}")
                last.append(token)
                since.append(begin)
            ids = []
            at = n
            while at:
                ids.append(last[at])
                at = since[at]
            del last[n:], since[n:]  # the end of a word is a leaf
            found[word] = np.array(ids[::-1], dtype="<i4").tobytes()
        return found


class Encoder:
    """Texts to ids with one vocabulary; words seen before are looked up."""

    def __init__(self, path: str) -> None:
        self.splitter = Splitter(path)
        model = json.loads(self.splitter.library.to_str())["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.trie = TrieEncoder(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.fixed = {t: np.array([i], dtype="<i4").tobytes() for t, i in self.splitter.special.items()}
        self.cache: dict[str, bytes] = dict(self.fixed)

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text as little-endian int32."""
        out: list[bytes] = []
        start = 0
        while start < len(texts):
            split, size = [], 0
            while start < len(texts) and size < BLOCK_CHARS:
                text = texts[start] or ""
                split.append(self.splitter.words(text))
                size += len(text)
                start += 1
            if len(self.cache) > WORD_CACHE:
                self.cache = dict(self.fixed)
            missing = set().union(*split).difference(self.cache)
            if missing:
                self.cache.update(self.trie.encode(missing))
            look = self.cache.__getitem__
            out += [b"".join(map(look, words)) for words in split]
        return out


@functools.lru_cache(maxsize=2)
def id_texts(path: str) -> list[str]:
    from tokenizers import Tokenizer

    known = {i: t for t, i in Tokenizer.from_file(path).get_vocab(with_added_tokens=True).items()}
    return [known.get(i, "") for i in range(max(known) + 1)]


def id_lists(rows: Sequence[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) // 4 for r in rows], out=offsets[1:])
    values = np.frombuffer(b"".join(rows), dtype="<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=pa.int32()))


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids", keep: Sequence[str] | None = None) -> DataFrame:
    """``out array<int>``: the ids of ``text``, no special tokens added; texts of special tokens become their ids."""

    def make():
        known = Encoder(path)  # one a task: an idle worker keeps no words
        return lambda texts: id_lists(known.encode(texts.to_pylist()))

    return map_column(df, text, out, "array<int>", make, keep)


def decoder(path: str):
    """Worker function: id lists to texts."""
    texts = id_texts(path)
    size = len(texts)

    def work(column: pa.ListArray) -> pa.Array:
        rows = []
        for row in column:
            found = row.values.to_numpy(zero_copy_only=False) if row.is_valid else np.zeros(0, dtype=np.int32)
            if len(found) and (found.min() < 0 or found.max() >= size):
                found = found[(found >= 0) & (found < size)]
            rows.append(" ".join(map(texts.__getitem__, found.tolist())))
        return pa.array(rows, type=pa.string())

    return work


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded", keep: Sequence[str] | None = None) -> DataFrame:
    """``out string``: the vocabulary's texts of ``ids`` joined by blanks, special tokens included, ids outside the vocabulary left out.

    That is how the library decodes with a vocabulary file that names no decoder; word ends stay visible.
    """
    return map_column(df, ids, out, "string", lambda: decoder(path), keep)


def round_trip(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", keep: Sequence[str] | None = None
) -> DataFrame:
    """Both: the ids of ``text`` and what they decode to, by one worker a task."""

    def make():
        known, back = Encoder(path), decoder(path)

        def work(texts: pa.Array) -> list[pa.Array]:
            lists = id_lists(known.encode(texts.to_pylist()))
            return [lists, back(lists)]

        return work

    return map_columns(df, text, {ids: "array<int>", decoded: "string"}, make, keep)
