"""Fast batch encoding with a public tokenizer file.

The tokenizers library needs about 18 microseconds for a short text, mostly for its
normaliser and its pre-tokeniser. For a vocabulary that drops white space, a text's ids are
the ids of its white-space separated words in a row, so each distinct word is encoded once
and then looked up. Everything out of the ordinary (other normalisers, control
characters, special tokens) goes through the library's own ``encode_batch``.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np

from .common import held

#: Words that an encoder remembers; about 300 bytes each.
CACHE_WORDS = 1_000_000
#: Words of these characters have no NFC changes and no white space but the usual.
_PLAIN = r"[!-~À-ÖØ-öø-ÿ]+"
#: Python's str.split() also splits at these; Unicode's White_Space does not hold them.
_ODD = ("\x1c", "\x1d", "\x1e", "\x1f")
#: The tokenizer file's own split pattern and normaliser kinds.
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALISERS = ["NFC", "Replace", "Lowercase"]


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies on this machine; executors ask for themselves."""
    import public_tokenizers

    return public_tokenizers.path(name)


class _Numbered(dict):
    """Gives each new key the next number and remembers it as pending."""

    def __init__(self):
        super().__init__()
        self.pending: list[str] = []

    def __missing__(self, key):
        n = self[key] = len(self)
        self.pending.append(key)
        return n


class _Ragged:
    """Arrays of different length end to end."""

    def __init__(self, dtype):
        self.data, self.ends, self.n, self.size = np.empty(1 << 16, dtype), np.zeros(1 << 12, np.int64), 0, 0

    def extend(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        while self.size + len(flat) > len(self.data):
            self.data = np.concatenate([self.data, np.empty_like(self.data)])
        while self.n + len(lengths) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.data[self.size : self.size + len(flat)] = flat
        self.ends[self.n + 1 : self.n + 1 + len(lengths)] = self.size + np.cumsum(lengths)
        self.size, self.n = self.size + len(flat), self.n + len(lengths)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows end to end, and their lengths."""
        first = self.ends[rows]
        lengths = self.ends[rows + 1] - first
        ends = np.cumsum(lengths)
        at = np.repeat(first - ends + lengths, lengths)
        at += np.arange(len(at))
        return self.data[at], lengths


class Encoder:
    """Ids of texts by one tokenizer file, ``add_special_tokens=False``.

    ``cache_words`` bounds the memory: a full cache is dropped and built anew.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole, self.cache_words = Tokenizer.from_file(path), cache_words
        spec = json.loads(self.whole.to_str())
        vocab = self.whole.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocab.values()) < 1 << 16 else "<u4")
        self.special = [t["content"] for t in spec["added_tokens"]]
        norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        parts = pre.get("pretokenizers", [])
        self.by_word = (
            [n["type"] for n in norm.get("normalizers", [])] == _NORMALISERS
            and [p["type"] for p in parts] == ["Split", "ByteLevel"]
            and parts[0]["pattern"].get("Regex") == _WORD_SPLIT
            and parts[0]["behavior"] == "Removed"
            and parts[0]["invert"]
            and not parts[1]["add_prefix_space"]
            and spec["post_processor"] is None
            and spec["model"].get("end_of_word_suffix") == "</w>"
        )
        if self.by_word:
            self.split_lines, self.plain = regex.compile(_WORD_SPLIT + r"|\n"), regex.compile(_PLAIN)
            self.bytes = Tokenizer(self.whole.model)
            self.bytes.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
            self.ends_word[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
            # the byte alphabet of byte-level vocabularies: printable Latin-1 as itself, the rest from U+0100 on
            kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
            self.alphabet = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(kept))}
        self._drop()

    def _drop(self) -> None:
        self.words, self.parts = _Numbered(), _Numbered()
        self.word_ids, self.part_ids = _Ragged(self.dtype), _Ragged(self.dtype)
        self.parts["\n"] = 0
        self.part_ids.extend(np.empty(0, self.dtype), np.zeros(1, np.int64))

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for row in ids for i in row), self.dtype, int(lengths.sum())), lengths

    def _learn_parts(self) -> None:
        new, self.parts.pending = self.parts.pending, []
        if not new:
            return
        lines = [" ".join(p.encode().decode("latin-1").translate(self.alphabet) for p in new[i : i + 400]) for i in range(0, len(new), 400)]
        flat = np.concatenate([np.array(e.ids, np.int64) for e in self.bytes.encode_batch_fast(lines, add_special_tokens=False)])
        stops = np.flatnonzero(self.ends_word[flat]) + 1
        if len(stops) != len(new):
            raise ValueError("a word's ids do not end with a word-end token")
        self.part_ids.extend(flat.astype(self.dtype), np.diff(stops, prepend=0))

    def _learn_words(self) -> None:
        """Ids of the words that have come up since the last call, in their order."""
        new, self.words.pending = self.words.pending, []
        if not new:
            return
        odd = [] if self.plain.fullmatch("".join(new)) else [i for i, w in enumerate(new) if not self.plain.fullmatch(w)]
        out = set(odd)
        lines = "\n".join("" if i in out else w for i, w in enumerate(new)) if odd else "\n".join(new)
        rows = np.array([*map(self.parts.__getitem__, self.split_lines.findall(lines.lower())), 0], np.int64)
        breaks = np.flatnonzero(rows == 0)
        counts = np.diff(breaks, prepend=-1) - 1
        rows = rows[rows > 0]
        self._learn_parts()
        flat, lengths = self.part_ids.take(rows)
        by_word = np.add.reduceat(np.append(lengths, 0), np.minimum(np.cumsum(counts) - counts, len(lengths))) * (counts > 0)
        if odd:
            ids, n = self._whole([new[i] for i in odd])
            at, stop, lead = np.cumsum(by_word), np.cumsum(n), 0
            pieces, was = [], 0
            for i, end in zip(odd, stop):
                pieces += [flat[was : at[i]], ids[lead:end]]
                was, lead = at[i], end
            flat = np.concatenate([*pieces, flat[was:]])
            by_word[odd] = n
        self.word_ids.extend(flat, by_word)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and the number of each text's ids."""
        if not self.by_word:
            return self._whole(texts)
        if len(self.words) > self.cache_words or len(self.parts) > self.cache_words:
            self._drop()
        odd = [i for i, t in enumerate(texts) if any(c in t for c in _ODD) or any(s in t for s in self.special)]
        split = [t.split() for t in texts]
        for i in odd:
            split[i] = []
        rows = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split)))
        self._learn_words()
        flat, by_word = self.word_ids.take(rows)
        ends = np.append(0, np.cumsum(by_word))[np.append(0, np.cumsum([len(w) for w in split])).astype(np.int64)]
        lengths = np.diff(ends)
        if not odd:
            return flat, lengths
        out = np.split(flat, ends[1:-1])
        for i in odd:
            out[i], _ = self._whole([texts[i]])
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))


def encoder(path: str, cache_words: int = CACHE_WORDS) -> Encoder:
    """This Python worker's encoder for a file."""
    return held(("encoder", path, cache_words), lambda: Encoder(path, cache_words))


def batches(texts: list[str], chars: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about so many characters; a longer text stands alone."""
    first = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > chars:
            yield first, i
            first, total = i, 0
        total += len(t)
    if first < len(texts):
        yield first, len(texts)


def encoded(path: str, texts: Iterable[str | None], end_id: int, cache_words: int = CACHE_WORDS) -> Iterator[np.ndarray]:
    """Each text's ids with ``end_id`` behind them; a null text has that id only."""
    texts, enc = ["" if t is None else t for t in texts], encoder(path, cache_words)
    for a, b in batches(texts):
        flat, lengths = enc.encode(texts[a:b])
        stops = np.cumsum(lengths)
        with_end = np.insert(flat, stops, end_id)
        stops += np.arange(1, len(stops) + 1)
        yield from np.split(with_end, stops[:-1])
