"""Words and token ids of texts, for Python tasks."""

from __future__ import annotations

import json
import os
import re
import sys
import types
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# A word is a run of anything but the ASCII white space 0x20 and 0x09-0x0D; bytes.split() cuts at just these.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; none for null."""
    return text.encode("utf-8").split() if text else []


_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_VALUES = np.random.default_rng(20240101).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, n at least."""
    memo = worker_memo(("powers",), dict)
    if len(memo.get("up", ())) < n:
        size = 1 << max(20, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            memo[name] = np.cumprod(steps, dtype=np.uint64)
    return memo["up"], memo["down"]


class Words:
    """The words of some texts as arrays: `hashes` (64 bits), and the byte `starts` and `ends` in `data`.

    `texts` has the place in `data` where each text starts, and the end. A word's hash is a polynomial in values of its
    bytes, taken from running sums, so no word becomes a Python object.
    """

    def __init__(self, data: np.ndarray, texts: np.ndarray):
        self.data, self.texts = data, texts
        space = _SPACES[data]
        before, after = np.empty(len(data) + 1, bool), np.empty(len(data) + 1, bool)
        before[0] = after[-1] = True
        before[1:], after[:-1] = space, space
        before[texts[:-1]] = True  # a word does not go on into the next text
        ending = np.concatenate([after[1:], [True]])[: len(data)]
        ending[texts[(texts > 0)] - 1] = True
        self.starts = np.flatnonzero(~space & before[:-1])
        self.ends = np.flatnonzero(~space & ending) + 1
        up, down = _powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
        h = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        self.hashes = h ^ (h >> np.uint64(32))

    def of_text(self) -> np.ndarray:
        """Number of the text that each word is in."""
        return np.searchsorted(self.texts, self.starts, "right") - 1

    def first_words(self) -> np.ndarray:
        """Number of the first word of each text, and the number of words."""
        return np.searchsorted(self.starts, self.texts)


def portions(column: pa.Array, most_bytes: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, their bytes, where each text starts and the end) of a column of texts; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most_bytes, "right")) - 1)
        last = min(last, len(column))
        low, high = offsets[first], offsets[last]
        yield first, last, data[low:high], offsets[first : last + 1] - low
        first = last


def word_batches(column: pa.Array, most_bytes: int = 1 << 20) -> Iterator[tuple[int, int, Words]]:
    """(first row, last row + 1, their words) of a column of texts, in portions; null counts as empty."""
    for first, last, data, texts in portions(column, most_bytes):
        yield first, last, Words(data, texts)


def word_counts(column: pa.Array) -> np.ndarray:
    """Number of words of each text of a column; null counts as empty."""
    out = [np.zeros(0, np.int64)]
    for _, _, data, texts in portions(column):
        space = _SPACES[data]
        opens = ~space
        opens[1:] &= space[:-1]
        at = texts[:-1][texts[:-1] < len(data)]
        opens[at] = ~space[at]  # a word does not go on into the next text
        out.append(np.diff(np.concatenate([[0], np.cumsum(opens)])[texts]))
    return np.concatenate(out)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every run of k word hashes."""
    n = len(words) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    if n <= 0:
        return out
    for i in range(k):
        out ^= words[i : n + i]
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out


def worker_memo(key: tuple, build):
    """A value kept as long as the Python worker lives, across its tasks."""
    memo = sys.modules.setdefault("claimflow_worker_memo", types.ModuleType("claimflow_worker_memo")).__dict__
    if key not in memo:
        memo[key] = build()
    return memo[key]


# Unicode White_Space, and letters among ASCII and Latin that no tokenizer's pattern counts as anything else. Capital
# dotted I is left out: its small form ends in a combining mark, which goes with the signs after it.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_PIECE = re.compile(
    f"[{_SPACE}]*[{_LETTERS}]+(?=[\\x00-@\\[-`{{-\\x7f]|\\Z)|[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+"
)
_BARE_PIECE = re.compile(f"[{_LETTERS}]+(?=[\\x00-@\\[-`{{-\\x7f]|\\Z)|[^{_SPACE}]+")
_BEYOND_LATIN = re.compile("[\u0250-\U0010ffff]")


_SPACED_WORD = re.compile(f" [{_LETTERS}]+")
_BARE_WORD = re.compile(f"[{_LETTERS}]+")

# The signs that byte-level tokenizers have for bytes: those of Latin-1 that show, then the next ones.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_SIGNS = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*_SHOWN}))}

PIECES = 1 << 18  # pieces of up to 64 characters that a worker remembers, some 60 MB
AT_ONCE = 1 << 12  # new pieces encoded in one call, whose results take many times their own room
PORTION = 1 << 20  # characters of texts encoded together


class Encoder:
    """Token ids as little-endian unsigned 32-bit integers, by a file of the tokenizers library.

    A text is cut where white space follows anything else, and where an ASCII sign follows a letter. The patterns
    of these tokenizers (runs of letters, digits or other signs, white space only in front) always start a new unit
    there and look at nothing before it. So a piece is encoded once and then looked up; ids equal those of the text.
    Where the file itself folds case and drops white space, texts of ASCII and Latin letters are looked up that way.
    """

    def __init__(self, path: str, most_pieces: int = PIECES, longest: int = 64):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most, self.longest = most_pieces, longest
        self.number, self.ids = _Numbers(), []
        spec = json.loads(self.tokenizer.to_str())
        steps = [spec["normalizer"] or {}, *(spec["normalizer"] or {}).get("normalizers", [])]
        split = ((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        self.folds = any(s.get("type") == "Lowercase" for s in steps) and (
            split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") is True
        )
        # Words of small Latin letters pass these steps as they are, as one unit, so the model alone gives their ids.
        normal = [s for s in steps if s and s.get("type") != "Sequence"]
        cuts = [spec["pre_tokenizer"] or {}, *(spec["pre_tokenizer"] or {}).get("pretokenizers", [])][self.folds :]
        by_bytes = cuts[-1].get("type") == "ByteLevel" and not cuts[-1].get("add_prefix_space")
        as_is = all(s["type"] in ("NFC", "Lowercase") or s.get("pattern") == {"Regex": "\\s+"} for s in normal)
        words = r"[\p{L}]+" in (split.get("pattern") or {}).get("Regex", "") and len(cuts) == 2 if self.folds else len(cuts) == 1 and cuts[0].get("use_regex")
        self.word = (_BARE_WORD if self.folds else _SPACED_WORD) if by_bytes and as_is and words else None
        self.model = self.tokenizer.model

    def _cut(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.folds and not _BEYOND_LATIN.search(text):
            return _BARE_PIECE.findall(text.lower())
        return _PIECE.findall(text)

    @classmethod
    def shared(cls, path: str, most_pieces: int = PIECES) -> Encoder:
        return worker_memo(("encoder", path, most_pieces), lambda: cls(path, most_pieces))

    def _forget(self) -> None:
        """Keep the pieces met first, among which are the frequent ones."""
        kept, number = self.most // 2, _Numbers()
        number.update((piece, n) for piece, n in self.number.items() if n < kept)
        self.ids = self.ids[:kept]
        self.number, number.met = number, len(self.ids)

    def _coded(self, pieces: list[str]) -> Iterator[bytes]:
        """The ids of each piece."""
        for first in range(0, len(pieces), AT_ONCE):
            some = pieces[first : first + AT_ONCE]
            is_word = [self.word is not None and len(p) <= self.longest and bool(self.word.fullmatch(p)) for p in some]
            words = "\n".join([p for p, one in zip(some, is_word) if one])
            words = (words.lower() if self.folds else words).encode().decode("latin-1")
            words = iter(words.translate(_BYTE_SIGNS).split(_BYTE_SIGNS[10]))
            others = [p for p, one in zip(some, is_word) if not one]
            others = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False) if others else [])
            for one in is_word:
                ids = [t.id for t in self.model.tokenize(next(words))] if one else next(others).ids
                yield array("I", ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """One byte string per text; null counts as empty."""
        if len(self.ids) > self.most:
            self._forget()
        number, first = self.number, len(self.ids)
        # Each piece is looked up once: pieces not met before get the next numbers.
        numbers = [list(map(number.__getitem__, self._cut(t))) for t in texts]
        new, number.new = number.new, []
        self.ids.extend(self._coded(new))
        ids_of = self.ids.__getitem__
        out = [b"".join(map(ids_of, n)) for n in numbers]
        for i, piece in enumerate(new, first):
            if len(piece) > self.longest:  # met again it gets another number
                del number[piece]
                self.ids[i] = b""
        return out


class _Numbers(dict):
    """Numbers pieces in the order they are met, and lists those that are new."""

    def __init__(self):
        self.new: list[str] = []
        self.met = 0

    def __missing__(self, piece: str) -> int:
        self[piece] = n = self.met
        self.met += 1
        self.new.append(piece)
        return n


def in_portions(rows, size, most: int):
    """Lists of consecutive rows with a total `size` of about `most` at most, one row at least."""
    part, total = [], 0
    for row in rows:
        n = size(row)
        if part and total + n > most:
            yield part
            part, total = [], 0
        part.append(row)
        total += n
    if part:
        yield part
