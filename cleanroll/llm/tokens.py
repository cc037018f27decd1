"""Token ids of whole texts, with a bounded cache of the pieces between white space."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core

# A run of ASCII white space and what follows it. No token of a byte-level BPE reaches over the start of such a run,
# and none of a tokenizer that drops white space.
UNIT = re.compile(r"[ \t\n\r\f\v]*[^ \t\n\r\f\v]+|[ \t\n\r\f\v]+")
# Other white space may join an ASCII run into one token, and special tokens are found before any split: such texts
# are encoded in one go.
ODD = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]|<\|")
# Texts of Latin letters, digits, ASCII white space and marks without an apostrophe split into smaller units that repeat
# more: letters, digits and marks are apart in both tokenizers, and a space goes with what follows where it is kept.
PLAIN = re.compile(r"[^A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f \t\n\r\f\v!-&(-@\[-`{-~]")
LETTERS, MARKS = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+", r"[!-&(-/:-@\[-`{-~]+"
SPACED = re.compile(rf" ?{LETTERS}| ?{MARKS}| ?[0-9]+|[ \t\n\r\f\v]+(?![^ \t\n\r\f\v])|[ \t\n\r\f\v]+")
SPACELESS = re.compile(rf"{LETTERS}|{MARKS}|[0-9]")
# The same by bytes of UTF-8; OTHER bytes are in no plain text, nor are some pairs of bytes.
OTHER, SPACE, LETTER, DIGIT, MARK = range(5)
KINDS = np.full(256, OTHER, dtype=np.uint8)
for kind, some in (
    (SPACE, b" \t\n\r\f\v"), (LETTER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"), (LETTER, bytes([*range(0x80, 0xC0), *range(0xC3, 0xCA)])),
    (DIGIT, b"0123456789"), (MARK, b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"),
):
    KINDS[list(some)] = kind
LONGEST_UNIT = 64
CACHED_UNITS = 800_000
CHARS_AT_ONCE = 4_000_000
UNITS_AT_ONCE = 200
# A byte-level BPE knows a byte by one character that is no white space: its own if it can be seen.
SEEN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTES = {b: chr(b) for b in SEEN} | {b: chr(0x100 + k) for k, b in enumerate(b for b in range(0x100) if b not in SEEN)}


class Encoder:
    """`encode(texts)` gives the ids of each whole text, as the tokenizer alone would.

    Words repeat, so the ids of a unit are kept once found. When the cache is full new units are encoded each time; it
    holds the frequent ones by then. Plain texts are split together, `CHARS_AT_ONCE` characters of text at a time, and only
    their distinct units are looked up; units that are missing are encoded together.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.cache: dict[str, bytes] = {}
        # Whether letter case and white space go, as seen on a small text.
        both = [e.ids for e in self.tokenizer.encode_batch(["a b", "A \n B"], add_special_tokens=False)]
        self.folds = both[0] == both[1]
        self.between = self.tokenizer.encode("a\nb", add_special_tokens=False).ids[1]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        # The same model over units that are given as characters of bytes, with a space between: small units need no other split.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.characters = str.maketrans(BYTES | {0x0A: " " if self.folds else f" {BYTES[0x0A]} "})
        letters = "abz\u00e0\u00e9\u00f1\u00ff\u0101\u0151\u024f"
        sample = [*letters, letters, "the", "!", "...", "7"] + ([] if self.folds else [" the", f" {letters}", " (", " 2024"])
        if self._plain_ids(sample) != self._ids(sample):
            self.model = self.characters = None

    def _split(self, texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The units of the plain ones of some texts in a row, before which unit each text begins, and whether a text is plain.

        Units are those of SPACED or SPACELESS; a text that is not plain has none here.
        """
        encoded = [t.encode() for t in texts]
        ends = np.cumsum([len(x) for x in encoded], dtype=np.int64)
        raw = np.frombuffer(b"".join(encoded), dtype=np.uint8)
        kinds = KINDS[raw]
        odd = kinds == OTHER
        if len(raw) > 1:
            one, two = raw[:-1], raw[1:]
            # The signs of times and division, letters beyond U+024F, and the start of a special token.
            odd[:-1] |= ((one == 0xC3) & ((two == 0x97) | (two == 0xB7))) | ((one == 0xC9) & (two >= 0x90)) | ((one == 0x3C) & (two == 0x7C))
        plain = np.ones(len(texts), dtype=bool)
        plain[np.searchsorted(ends, np.flatnonzero(odd), side="right")] = False
        if not plain.all():
            return self._split_plain([x if p else b"" for x, p in zip(encoded, plain.tolist(), strict=True)], plain)
        return *self._cut(raw, kinds, np.concatenate([[0], ends])), plain

    def _split_plain(self, encoded: list[bytes], plain: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        raw = np.frombuffer(b"".join(encoded), dtype=np.uint8)
        return *self._cut(raw, KINDS[raw], np.cumsum([0] + [len(x) for x in encoded], dtype=np.int64)), plain

    def _cut(self, raw: np.ndarray, kinds: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Units of plain texts that lie between `bounds`, and how many are before each bound."""
        first = np.ones(len(raw) + 1, dtype=bool)  # whether a unit begins here
        first[1:-1] = kinds[1:] != kinds[:-1]
        begins = bounds[:-1][bounds[:-1] < bounds[1:]]
        space = kinds == SPACE
        if self.folds:
            first[:-1] |= kinds == DIGIT
            first[begins] = True
            word = ~space
            raw, first = raw[word], np.append(first[:-1][word], True)
            bounds = bounds - np.searchsorted(np.flatnonzero(space), bounds)
        else:
            # The last white space before something else stands alone, or goes with it if it is a space.
            last = np.zeros(len(raw), dtype=bool)
            last[:-1] = space[:-1] & ~space[1:]
            last[bounds[1:][bounds[1:] > 0] - 1] = False
            first[:-1] |= last
            first[1:][last & (raw == 0x20)] = False
            first[begins] = True
        starts = np.flatnonzero(first)
        units = pa.Array.from_buffers(pa.large_string(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(raw))])
        return units, np.searchsorted(starts, bounds)

    def _units(self, text: str) -> list[str] | None:
        """The units of a text that is not plain; None: it is encoded in one go."""
        return None if ODD.search(text) else UNIT.findall(text)

    def _small(self, unit: str) -> bool:
        """Whether a unit is one of plain texts, with a token of its own at its end or a line end beside it."""
        if unit[-1].isspace() or PLAIN.search(unit.lower() if self.folds else unit):
            return False
        return bool((SPACELESS if self.folds else SPACED).fullmatch(unit))

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.type).tobytes() for e in found]

    def _plain_ids(self, units: list[str]) -> list[bytes]:
        """Ids of small units, many in one text: a call costs more than a word.

        A small unit is one piece to the tokenizer, so its model is asked without a search for pieces. Where white space goes, a unit ends
        with the one token that ends a word; else a line end, one token, stands between units. If that does not come out even, each unit
        is encoded by itself.
        """
        out: list[bytes] = []
        for k in range(0, len(units), UNITS_AT_ONCE):
            part = units[k : k + UNITS_AT_ONCE]
            size = self.type.itemsize
            text = "\n".join(part)
            if self.model is not None:
                text = (text.lower() if self.folds else text).encode().decode("latin-1").translate(self.characters)
            found = (self.model or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)[0]
            ids = np.array(found.ids, dtype=self.type)
            if self.folds:
                stop = np.flatnonzero(self.ends[ids]) + 1
                start = np.concatenate([[0], stop[:-1]])
            else:
                marks = np.flatnonzero(ids == self.between)
                start, stop = np.concatenate([[0], marks + 1]), np.concatenate([marks, [len(ids)]])
            even = len(stop) == len(part) and (not self.folds or not len(ids) or stop[-1] == len(ids))
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip((size * start).tolist(), (size * stop).tolist(), strict=True)] if even else self._ids(part)
        return out

    def _unit_ids(self, units: list[str], plain: bool = False) -> list[bytes]:
        """The ids of distinct units, of plain texts if so; new ones are kept while there is room."""
        out = list(map(self.cache.get, units))
        fresh = [k for k, got in enumerate(out) if got is None]
        small = [k for k in fresh if (not units[k][-1].isspace() if plain else self._small(units[k]))]
        for k, got in zip(small, self._plain_ids([units[k] for k in small]), strict=True):
            out[k] = got
        rest = [k for k in fresh if out[k] is None]
        for k, got in zip(rest, self._ids([units[k] for k in rest]), strict=True):
            out[k] = got
        for k in fresh:
            if len(self.cache) >= CACHED_UNITS:
                break
            if len(units[k]) <= LONGEST_UNIT:
                self.cache[units[k]] = out[k]
        return out

    def _some(self, texts: list[str]) -> list[np.ndarray]:
        # Some capitals have a lower case that is not plain: the test is on what is split.
        split, at, plain = self._split([t.lower() for t in texts] if self.folds else texts)
        named = split.dictionary_encode()
        found = self._unit_ids(named.dictionary.to_numpy(zero_copy_only=False).tolist(), plain=True)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // self.type.itemsize
        begin = np.cumsum(sizes) - sizes
        which = named.indices.to_numpy()
        length = sizes[which]
        ends = np.cumsum(length)
        flat = np.frombuffer(b"".join(found), dtype=self.type)
        total = int(ends[-1]) if len(ends) else 0
        small = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
        place = np.repeat((begin[which] - (ends - length)).astype(small), length)
        place += np.arange(total, dtype=small)
        ids = flat.take(place)
        bounds = np.concatenate([[0], ends])[at].tolist()
        out = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

        units = {k: self._units(texts[k]) for k in np.flatnonzero(~plain).tolist()}
        every = list({x for u in units.values() if u is not None for x in u})
        known = dict(zip(every, self._unit_ids(every), strict=True))
        for k, u in units.items():
            out[k] = np.frombuffer(self._ids([texts[k]])[0] if u is None else b"".join(map(known.__getitem__, u)), dtype=self.type)
        return out

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text in turn; null counts as empty."""
        held: list[str] = []
        chars = 0
        for text in texts:
            held.append(text or "")
            chars += len(held[-1])
            if chars >= CHARS_AT_ONCE:
                yield from self._some(held)
                held, chars = [], 0
        yield from self._some(held)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file: its cache serves all tasks of that worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def release() -> None:
    """Lets go of this worker's encoders; Spark reuses workers, and later stages need no cache."""
    _ENCODERS.clear()
