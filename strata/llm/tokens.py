"""Subword ids of whole texts by a public tokenizer, in Arrow batches.

A tokenizer that drops white space gives the same ids for a text as for its
words one by one (words cut at ASCII white space, the safe boundary).  A slice's
distinct words, told apart by a 64-bit hash, are looked up in a bounded cache of
arrays; the rest goes to the library in one batch call per slice of about 1 MB.
Other tokenizers encode whole texts.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np

from strata.llm.wordblocks import Words

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_MARKS = b",.;:!?#*$%&|"
_SPACE = re.compile(rb"[ \t-\r]")
_LOADED: dict = {}
LONG = 64  # bytes of a word from which its hash is a cryptographic one


def _letters(word: bytes) -> bool:
    return word.isalpha() or not word.isascii() and word.decode("utf-8").isalpha()


def spans(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The places of all spans, one after the other."""
    before = np.cumsum(lens) - lens
    return np.repeat(starts - before, lens) + np.arange(int(lens.sum()))


class Known:
    """Sorted word hashes with the place and number of each word's ids in ``flat``; about 30 bytes a word."""

    def __init__(self, keys: np.ndarray, starts: np.ndarray, lens: np.ndarray, flat: np.ndarray, met: np.ndarray | None = None):
        self.keys, self.starts, self.lens, self.flat = keys, starts, lens, flat
        self.met = np.zeros(len(keys), bool) if met is None else met

    @classmethod
    def none(cls, dtype) -> "Known":
        return cls(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, dtype))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the known ones of ``keys``, and which these are."""
        if not len(self.keys):
            return np.empty(0, np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        self.met[at[hit]] = True
        return at[hit], hit

    def only(self, which: np.ndarray) -> "Known":
        lens = self.lens[which]
        return Known(self.keys[which], np.cumsum(lens) - lens, lens, self.flat[spans(self.starts[which], lens)])

    def joined(self, other: "Known") -> "Known":
        keys, first = np.unique(np.concatenate([self.keys, other.keys]), return_index=True)
        return Known(keys, np.concatenate([self.starts, other.starts + len(self.flat)])[first],
                     np.concatenate([self.lens, other.lens])[first], np.concatenate([self.flat, other.flat]),
                     np.concatenate([self.met, other.met])[first])


def _groups(texts: list[bytes], limit: int = 1 << 20) -> Iterator[list[bytes]]:
    """Runs of texts of about ``limit`` bytes; a longer text is alone."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > limit:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def _pieces(text: bytes, limit: int = 1 << 20) -> list[bytes]:
    """The text cut at white space into pieces of little over ``limit`` bytes."""
    out, at = [], 0
    while len(text) - at > limit and (cut := _SPACE.search(text, at + limit)):
        out.append(text[at:cut.start()])
        at = cut.end()
    return out + [text[at:]]


class Encoder:
    """``ids(texts)``: the ids of each text as little-endian bytes of ``dtype``."""

    def __init__(self, path: str, cache_words: int = 300_000):
        self.sentencepiece = path.endswith(".model")
        if self.sentencepiece:
            import sentencepiece
            self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
            self.size, self.by_word = self.lib.get_piece_size(), False
        else:
            from tokenizers import Tokenizer
            self.lib = Tokenizer.from_file(path)
            self.lib.no_truncation()
            self.lib.no_padding()
            self.size = self.lib.get_vocab_size(with_added_tokens=True)
            self.by_word = self._drops_white_space()
            suffix = getattr(self.lib.model, "end_of_word_suffix", None)
            self.ends = None
            if self.by_word and suffix:
                self.ends = np.zeros(self.size, bool)
                self.ends[[i for t, i in self.lib.get_vocab().items() if t.endswith(suffix)]] = True
        self.dtype = np.dtype("<u2") if self.size <= 0xFFFF else np.dtype("<u4")
        self.special = [t.content.lower().encode() for t in self.lib.get_added_tokens_decoder().values()] if self.by_word else []
        self.folds = self.by_word and self._folds_case()
        self.cuts = self.by_word and self._cuts_marks()
        self.limit = cache_words
        self.cache = [Known.none(self.dtype), Known.none(self.dtype)]

    def _drops_white_space(self) -> bool:
        probe = "Ab cd,\n ef\t1 2"
        whole = self.lib.encode(probe, add_special_tokens=False).ids
        parts = [i for w in probe.split() for i in self.lib.encode(w, add_special_tokens=False).ids]
        return whole == parts

    def _folds_case(self) -> bool:
        """A-Z count as a-z."""
        upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        probe = " ".join([upper, *upper, *(c + "ab" for c in upper), *("ab" + c for c in upper)])
        return self._encode([probe]) == self._encode([probe.lower()])

    def _cuts_marks(self) -> bool:
        """Letters and the marks after them are apart."""
        tails = [m * n for m in _MARKS.decode() for n in (1, 3)] + [",%%%", ".|&"]
        bodies = ["word", "\u00fcber", "s"]
        parts = dict(zip(bodies + tails, self._encode(bodies + tails)))
        both = [(b, t) for b in bodies for t in tails]
        return self._encode([b + t for b, t in both]) == [parts[b] + parts[t] for b, t in both]

    def _fold(self, text: bytes) -> bytes:
        """The text with a-z for A-Z where that changes no id (a special string must be written exactly)."""
        if not self.folds:
            return text
        low = text.lower()  # bytes: A-Z alone
        return text if any(s in low for s in self.special) else low

    def _encode(self, texts: list[str]) -> list[bytes]:
        if self.sentencepiece:
            found = self.lib.encode(texts, num_threads=1)
        else:
            found = [e.ids for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]
        return [np.array(i, self.dtype).tobytes() for i in found]

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """As ``_encode``; words of letters alone are one unit each, so many go as one text and are told
        apart by the ids that end a unit."""
        texts = [w.decode("utf-8") for w in words]
        if self.ends is None:
            return self._encode(texts)
        out: list[bytes] = [b""] * len(words)
        letters = [k for k, t in enumerate(texts) if t.isalpha()]
        alone = [k for k, t in enumerate(texts) if not t.isalpha()]
        chunks = [letters[i:i + 256] for i in range(0, len(letters), 256)]
        joined = [" ".join([texts[k] for k in c]) for c in chunks]
        for c, e in zip(chunks, self.lib.encode_batch_fast(joined, add_special_tokens=False) if chunks else []):
            ids = np.array(e.ids, self.dtype)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(c):  # a letter that normalises to something else
                alone.extend(c)
                continue
            raw, at = ids.tobytes(), [0, *(stops * self.dtype.itemsize).tolist()]
            for k, x, y in zip(c, at, at[1:]):
                out[k] = raw[x:y]
        for k, i in zip(alone, self._encode([texts[k] for k in alone]) if alone else []):
            out[k] = i
        return out

    def _ask(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words that the cache lacks; letters with marks after them are looked up apart."""
        found: dict[bytes, bytes] = {}
        cut: list[tuple[bytes, bytes, bytes]] = []
        ask = []
        for w in words:
            if self.cuts and w[-1] in _MARKS and _letters(body := w.rstrip(_MARKS)):
                cut.append((w, body, w[len(body):]))
            else:
                ask.append(w)
        found.update(zip(ask, self._encode_words(ask)))
        if cut:
            parts = list({p for _, *two in cut for p in two})
            lens, flat = self._resolve(Words([b"\n".join(parts)]))
            ends = (np.cumsum(lens) * self.dtype.itemsize).tolist()
            raw = flat.tobytes()
            own = {p: raw[x:y] for p, x, y in zip(parts, [0, *ends], ends)}
            found.update((w, own[body] + own[tail]) for w, body, tail in cut)
        return [found[w] for w in words]

    def _resolve(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of every word, and the ids of all words in order."""
        keys = words.hash
        for i in np.flatnonzero(words.end - words.start > LONG):  # the polynomial hash can be misled by long words
            word = words.data[words.start[i]:words.end[i]].tobytes()
            keys[i] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        unique, first, which = np.unique(keys, return_index=True, return_inverse=True)
        lens, starts, flats, size = np.zeros(len(unique), np.int64), np.zeros(len(unique), np.int64), [], 0
        open_ = np.arange(len(unique))
        for part in self.cache:
            at, hit = part.find(unique[open_])
            got = open_[hit]
            lens[got] = part.lens[at]
            starts[got] = size + np.cumsum(lens[got]) - lens[got]
            flats.append(part.flat[spans(part.starts[at], part.lens[at])])
            size += len(flats[-1])
            open_ = open_[~hit]
        if len(open_):
            place = first[open_]
            data = words.data.tobytes()
            raw = self._ask([data[x:y] for x, y in zip(words.start[place].tolist(), words.end[place].tolist())])
            lens[open_] = np.fromiter(map(len, raw), np.int64, len(raw)) // self.dtype.itemsize
            own = np.cumsum(lens[open_]) - lens[open_]
            starts[open_] = size + own
            flats.append(np.frombuffer(b"".join(raw), self.dtype))
            self._keep(Known(unique[open_], own, lens[open_], flats[-1]))
        n = lens[which]
        flat = np.concatenate(flats) if flats else np.empty(0, self.dtype)
        return n, flat[spans(starts[which], n)]

    def _keep(self, new: Known) -> None:
        """New words join the small part of the cache, that the large one when it has an eighth of the limit; a full
        large part keeps the words met since it was last cleared out, if these are less than half."""
        large, small = self.cache
        small = small.joined(new)
        if len(small.keys) > self.limit // 8:
            if len(large.keys) + len(small.keys) > self.limit:
                large = large.only(large.met) if large.met.sum() <= self.limit // 2 else large.only(np.zeros(len(large.met), bool))
            large, small = large.joined(small), Known.none(self.dtype)
        self.cache = [large, small]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """``texts``: UTF-8 bytes."""
        if not self.by_word:
            return self._encode([t.decode("utf-8") for t in texts])
        out = []
        for group in _groups(texts):
            pieces = [p for t in group for p in _pieces(self._fold(t))]
            if len(group) == 1 and len(pieces) > 1:  # one long text, piece by piece
                out.append(b"".join(self._resolve(Words([p]))[1].tobytes() for p in pieces))
                continue
            words = Words(pieces)
            lens, flat = self._resolve(words)
            ends = np.concatenate([[0], np.cumsum(lens)])[words.first] * self.dtype.itemsize
            raw, ends = flat.tobytes(), ends.tolist()
            out += [raw[x:y] for x, y in zip(ends, ends[1:])]
        return out


def encoder(path: str, cache_words: int = 300_000) -> Encoder:
    """One encoder per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path, cache_words)
    return _LOADED[path]
