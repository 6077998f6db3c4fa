"""Token ids of whole texts by a public tokenizer, with a bounded memory of units seen before."""

from __future__ import annotations

import json
import os
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, compress, count, islice, repeat
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTE_BPE = "byte_bpe_50k.json"
KEPT_UNITS = 300_000
GROUP = 200
FEW = 40  # texts or units that are not worth the start of bulk operations

# A byte-level pre-tokenizer never lets a space stand inside or at the end of a piece that has other
# characters, so a text may be cut before each space that follows another character.
_CUT = re.compile(r"(?<=\S)(?= )")
# What a plain cut at spaces is wrong for: a white space character followed by a space, and NUL, which marks units.
_SPACES = "".join(f"\\x{{{c:x}}}" for c in range(0x3001) if chr(c).isspace())
_ODD_SPACE = rf"\x00|[{_SPACES}] "
_ODD = re.compile("\0|[" + "".join(chr(c) for c in range(0x3001) if chr(c).isspace()) + "] ")

# The tokenizer's pattern for characters up to U+00FF, whose letters and numbers are known; characters on
# which regular expression engines differ are left to the tokenizer itself.
_LETTERS, _NUMBERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc\xbd\xbe"
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^\s{_LETTERS}{_NUMBERS}]+|\s+(?!\S)|\s+")
_OTHER = r"[^\x00-\x1b\x20-\x84\x86-\x9f\x{a1}-\x{ff}]"


def _byte_characters() -> dict[int, str]:
    """How byte-level vocabularies write each byte: printable ones as themselves, the rest from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def tokenizer_file(name: str = BYTE_BPE) -> str:
    """Where the vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _plain(unit: str) -> str:
    return unit[1:] if unit[:1] == "\0" else " " + unit


class _Known:
    """Units by number, in order of appearance, and the ids of each."""

    def __init__(self):
        self.number: defaultdict[str, int] = defaultdict(count().__next__)
        self.n_seen = 0
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def new(self) -> tuple[list[str], np.ndarray]:
        """Units that got a number since the last call, and their numbers."""
        numbers = np.arange(self.n_seen, len(self.number))
        units = list(islice(reversed(self.number), len(numbers)))
        units.reverse()
        self.n_seen = len(self.number)
        return units, numbers

    def numbers(self, units: Iterable[str]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, units), np.int64)

    def put(self, numbers: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """``ids`` of all ``numbers``, one after another."""
        if len(self.number) > len(self.start):
            more = 2 * len(self.number) - len(self.start)
            self.start, self.length = np.pad(self.start, (0, more)), np.pad(self.length, (0, more))
        if self.used + len(ids) > len(self.ids):
            self.ids = np.pad(self.ids, (0, self.used + len(ids)))
        self.ids[self.used : self.used + len(ids)] = ids
        self.start[numbers] = self.used + np.cumsum(lengths) - lengths
        self.length[numbers] = lengths
        self.used += len(ids)

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the units, one after another, and how many each has."""
        lengths = self.length[numbers]
        ends = np.cumsum(lengths)
        places = np.repeat(self.start[numbers] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)
        return self.ids[places], lengths


def _group_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over groups of ``counts`` values that follow each other."""
    sums, ends = np.concatenate([[0], np.cumsum(values)]), np.cumsum(counts)
    return sums[ends] - sums[ends - counts]


class Encoder:
    """Encodes texts unit by unit, and a unit that is new piece by piece. Pieces are those the tokenizer cuts
    the whole text into, so the ids are the tokenizer's. Units and pieces that came lately are looked up: a young
    table that is filled up to ``kept`` entries and a batch's, and the one before it.
    Texts that hold an added token, such as ``<|endoftext|>``, are encoded whole, with that token's own id.

    Both are named without the space they begin with; a leading NUL says that there is none."""

    def __init__(self, name: str = BYTE_BPE, kept: int = KEPT_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file(name))
        settings = json.loads(self.tokenizer.to_str())
        self.added = [t["content"] for t in settings["added_tokens"]]
        # The same model, cutting at white space only; its input is written in byte characters, which have none.
        self.byte_level = settings["pre_tokenizer"]["type"] == "ByteLevel" and not settings["normalizer"] and not settings["pre_tokenizer"]["add_prefix_space"]
        self.core = Tokenizer.from_str(json.dumps(settings | {"added_tokens": [], "pre_tokenizer": {"type": "WhitespaceSplit"}}))
        self.characters = _byte_characters()
        vocabulary = self.core.get_vocab()
        self.size = self.tokenizer.get_vocab_size()
        self.spelt = np.zeros(max(vocabulary.values()) + 1, np.int64)  # characters of each token
        self.spelt[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.kept, self.young, self.old = kept, _Known(), _Known()

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        ids, lengths = self.encode_all(texts)
        data, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(lengths)).tolist()
        return [data[e - 4 * n : e] for e, n in zip(ends, lengths.tolist(), strict=True)]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each has."""
        if len(self.young.number) >= self.kept:
            self.old, self.young = self.young, _Known()
        if len(texts) > FEW:
            odd = pc.match_substring_regex(pa.array(texts, pa.large_string()), _ODD_SPACE).to_pylist()
        else:
            odd = [_ODD.search(t) is not None for t in texts]
        whole, counts = [], []

        def cut() -> Iterator[list[str]]:  # one text's units at a time: they are looked up while near, then let go
            for i, t in enumerate(texts):
                if any(a in t for a in self.added):
                    whole.append(i)
                    units = []
                else:
                    units = self._units(t, odd[i])
                counts.append(len(units))
                yield units

        numbers = self.young.numbers(chain.from_iterable(cut()))
        self._learn()
        ids, lengths = self.young.get(numbers)
        lengths = _group_sums(lengths, np.array(counts, np.int64))
        if not whole:
            return ids, lengths
        parts = np.split(ids, np.cumsum(lengths)[:-1])
        for i in whole:
            parts[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
            lengths[i] = len(parts[i])
        return np.concatenate(parts), lengths

    @staticmethod
    def _units(text: str, odd: bool) -> list[str]:
        if not text:
            return []
        if odd:
            return ["\0" + u for u in _CUT.split(text)]
        units = text.split(" ")
        units[0] = "\0" + units[0]
        return units

    def _new(self) -> tuple[list[str], np.ndarray]:
        """Units that have a number but no ids yet, and their numbers; those that the old table has get them."""
        (new, numbers), old = self.young.new(), self.old
        if not old.number or not new:
            return new, numbers
        before = np.fromiter(map(old.number.get, new, repeat(-1)), np.int64, len(new))
        there = before >= 0
        self.young.put(numbers[there], *old.get(before[there]))
        return list(compress(new, (~there).tolist())), numbers[~there]

    def _learn(self) -> None:
        new, numbers = self._new()
        if not new:
            return
        if not self.byte_level or len(new) <= FEW:
            self.young.put(numbers, *self._ids(self.tokenizer, [_plain(u) for u in new]))
            return
        names = pa.array(new)
        unknown = pc.match_substring_regex(names, _OTHER).to_numpy(zero_copy_only=False)
        trimmed = pc.utf8_rtrim(names, characters=punctuation)
        is_word = pc.utf8_is_alpha(trimmed).to_numpy(zero_copy_only=False) & ~unknown
        is_piece = is_word & pc.equal(trimmed, names).to_numpy(zero_copy_only=False)

        # A word and what follows it, two pieces.
        ends = is_word & ~is_piece
        words = trimmed.filter(pa.array(ends)).to_numpy(zero_copy_only=False)
        rest = ["\0" + u[len(w) :] for u, w in zip(compress(new, ends.tolist()), words, strict=True)]
        pairs = np.stack([self.young.numbers(words), self.young.numbers(rest)], 1).ravel()
        made, pieces, counts = np.flatnonzero(ends).tolist(), [], [2] * len(words)
        for i in np.flatnonzero(~is_word & ~unknown).tolist():
            own = [p[1:] if p[0] == " " and p[1:].isalpha() else "\0" + p for p in _PIECES.findall(_plain(new[i]))]
            if own == [new[i]]:
                is_piece[i] = True
            else:
                made.append(i)
                pieces += own
                counts.append(len(own))
        pieces = np.concatenate([pairs, self.young.numbers(pieces)])

        more, their_numbers = self._new()  # pieces that have not come as units
        at = np.flatnonzero(is_piece)
        self.young.put(np.concatenate([numbers[at], their_numbers]), *self._piece_ids(list(compress(new, is_piece.tolist())) + more))
        left = np.flatnonzero(unknown)
        if len(left):
            self.young.put(numbers[left], *self._ids(self.tokenizer, [_plain(new[i]) for i in left]))
        if made:
            ids, lengths = self.young.get(pieces)
            self.young.put(numbers[made], ids, _group_sums(lengths, np.array(counts, np.int64)))

    def _piece_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of single pieces, many of them as the words of a text."""
        space = self.characters[32]
        written = [space + p if p.isascii() and p.isalpha() else _plain(p).encode().decode("latin-1").translate(self.characters) for p in pieces]
        groups = [" ".join(written[i : i + GROUP]) for i in range(0, len(written), GROUP)]
        found = self.core.encode_batch_fast(groups, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(x.ids for x in found), np.uint32)
        # The tokens of a piece spell it, so it ends with the token that comes to the end of its characters.
        ends = np.searchsorted(np.cumsum(self.spelt[ids]), np.cumsum(np.fromiter(map(len, written), np.int64, len(written)))) + 1
        return ids, np.diff(ends, prepend=0)

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for i in range(0, len(texts), 10_000) for x in tokenizer.encode_batch_fast(texts[i : i + 10_000], add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))


@lru_cache(maxsize=2)
def encoder(name: str = BYTE_BPE) -> Encoder:
    """One per Python worker, shared by its tasks."""
    return Encoder(name)
