"""Whole texts to token ids with a public tokenizer, encoding every distinct word of a task once.

Both supported families cut a text at white space, and where letters end and marks begin, before they merge anything, so
the ids of a text are the ids of its parts in order. Texts are cut and their distinct parts found a block at a time
by Arrow; a part is encoded by the tokenizers library when first met and looked up afterwards. The lookup has a fixed
size, so its memory does not grow with the data.
"""

from __future__ import annotations

import os
import re
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count, islice, repeat

import numpy as np

WORDS_HELD, CHARS_HELD = 3 << 15, 1 << 22
_LETTERS = r"A-Za-z\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}"
_MARKS = r"!-/:-@\[-`{-~"
_UNIT = rf"\A ?([{_LETTERS}]+|[{_MARKS}]+)\z"
_MARKS_AFTER = rf"([{_LETTERS}])([{_MARKS}]+)([ \n]|\z)"
_CUT = "\x1f"
# White space other than one space or one line end between two words.
_UNEVEN = (r"[\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
           r"|[ \n][ \n]|\A[ \n]|[ \n]\z|\A\z")
_SEPARATOR = re.compile(r"[\x1c-\x1f]")  # white space to Python, not to the tokenizers
_SEGMENT = re.compile(r"\s*\S+|\s+")


def _byte_letters() -> dict[int, str]:
    """The byte alphabet of byte-level tokenizers: printable bytes stand for themselves, the others for the
    code points from 256 on in their order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Lookup:
    """Ids of strings in one flat array, found by number, in two generations.

    `resolve` gives (ids of all strings in a row, number of ids of each) for strings that are not known. A generation is
    full at `held` strings or `chars` characters; the next one then starts empty and takes over what is asked
    for again, so frequent strings stay and others go, and what is held does not grow with the data.
    """

    def __init__(self, resolve: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], held: int, chars: int = CHARS_HELD):
        self.resolve, self.held, self.chars = resolve, held, chars
        self._begin()
        self.old = (self.numbers, self.flat, self.starts, self.lengths)
        self._begin()

    def _begin(self) -> None:
        self.numbers, self.flat = defaultdict(count().__next__), np.zeros(1 << 12, dtype=np.uint32)
        self.starts, self.lengths = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)
        self.used = self.spent = 0

    def turn(self) -> None:
        """Start the next generation if this one is full; numbers given before are void then."""
        if len(self.numbers) >= self.held or self.spent >= self.chars:
            self.old = (self.numbers, self.flat, self.starts, self.lengths)
            self._begin()

    def of(self, strings: list[str]) -> np.ndarray:
        """Numbers of strings; those not met before are learned with the next call of `learn`."""
        return np.fromiter(map(self.numbers.__getitem__, strings), np.int32, len(strings))

    def learn(self) -> None:
        """Find the ids of all strings that were numbered since the last call."""
        fresh = list(islice(reversed(self.numbers), len(self.numbers) - len(self.lengths)))[::-1]
        if not fresh:
            return
        numbers, flat, starts, lengths = self.old
        known_at = np.fromiter(map(numbers.get, fresh, repeat(-1)), np.int64, len(fresh))
        known = known_at >= 0
        counts = np.zeros(len(fresh), dtype=np.int32)
        counts[known] = lengths[known_at[known]]
        parts = [_slices(flat, starts[known_at[known]], counts[known])]
        if not known.all():
            ids, counts[~known] = self.resolve([fresh[i] for i in np.flatnonzero(~known)])
            parts.append(ids)
        order = np.concatenate((np.flatnonzero(known), np.flatnonzero(~known)))
        at = np.empty(len(fresh), dtype=np.int32)
        at[order] = self.used + np.cumsum(counts[order]) - counts[order]
        self.starts, self.lengths = np.concatenate((self.starts, at)), np.concatenate((self.lengths, counts))
        total = int(counts.sum())
        if self.used + total > len(self.flat):
            grown = np.zeros(max(2 * len(self.flat), self.used + total), dtype=np.uint32)
            grown[:self.used] = self.flat[:self.used]
            self.flat = grown
        self.flat[self.used:self.used + total] = np.concatenate(parts)
        self.used += total
        self.spent += sum(map(len, fresh))

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        return _slices(self.flat, self.starts[numbers], self.lengths[numbers])


def _slices(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[start:start + length] of all, in a row."""
    filled = lengths > 0
    starts, lengths = starts[filled], lengths[filled]
    ends = np.cumsum(lengths)
    if not len(ends):
        return np.zeros(0, dtype=np.uint32)
    steps = np.ones(ends[-1], dtype=np.int32)
    steps[0] = starts[0]
    steps[ends[:-1]] = starts[1:] - (starts[:-1] + lengths[:-1] - 1)
    return flat[np.cumsum(steps, out=steps)]


class TextEncoder:
    """Ids of whole texts by a tokenizers file; `word_ends` for a vocabulary that drops white space and case."""

    def __init__(self, path: str, word_ends: bool, held: int = WORDS_HELD):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.word_ends, self.letters = word_ends, _byte_letters()
        self.spelling = {b: c for b, c in self.letters.items() if b != 10}
        self.held = held
        self.release()

    def release(self) -> None:
        """Empty the lookup and give Arrow's free memory back: an idle Python worker keeps what its last task left."""
        import pyarrow as pa

        self.words = Lookup(self.word_ids, self.held)
        pa.default_memory_pool().release_unused()

    def word_ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts of texts: Latin letters or marks alone are merged as they are, anything else goes through the
        whole tokenizer."""
        import pyarrow as pa
        import pyarrow.compute as pc

        merge = self.tokenizer.model.tokenize
        alone = pc.match_substring_regex(pa.array(parts, pa.large_string()), _UNIT).to_pylist()
        ids, ends = array("I"), [0]
        for part, spelled, unit in zip(parts, self._spell(parts), alone):
            ids.extend([t.id for t in merge(spelled)] if unit else self.tokenizer.encode(part, add_special_tokens=False).ids)
            ends.append(len(ids))
        return np.array(ids, dtype=np.uint32), np.diff(ends)

    def _spell(self, parts: list[str]) -> list[str]:
        """Parts in the byte alphabet, in lower case if the vocabulary has no other."""
        spelled = [p.lower() for p in parts] if self.word_ends else [p.replace(" ", self.letters[32]) if p[:1] == " " and p.isascii() else p for p in parts]
        wide = [i for i, p in enumerate(parts) if not p.isascii() and "\n" not in p]
        text = "\n".join(spelled[i] for i in wide).encode().decode("latin-1").translate(self.spelling)
        for i, p in zip(wide, text.split("\n")):
            spelled[i] = p
        return spelled

    def _parts(self, text: str) -> list[str]:
        """Parts of a text with other white space than single spaces and line ends."""
        if not text:
            return []
        return [text] if _SEPARATOR.search(text) else _SEGMENT.findall(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each)."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not texts:
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        self.words.turn()
        column = pa.array(texts, pa.large_string())
        uneven = pc.match_substring_regex(column, _UNEVEN)
        if self.word_ends and pc.any(uneven).as_py():  # to this vocabulary all white space is the same
            texts = [" ".join(t.split()) if apart and not _SEPARATOR.search(t) else t for t, apart in zip(texts, uneven.to_pylist())]
            column = pa.array(texts, pa.large_string())
            uneven = pc.match_substring_regex(column, _UNEVEN)
        even = pc.replace_substring_regex(column.filter(pc.invert(uneven)), _MARKS_AFTER, rf"\1{_CUT}\2\3")
        for white, cut in ((" ", _CUT), ("\n", _CUT)) if self.word_ends else ((" ", _CUT + " "), ("\n", f"{_CUT}\n{_CUT}")):
            even = pc.replace_substring(even, white, cut)
        split = pc.split_pattern(even, _CUT)
        parts = split.flatten().dictionary_encode()
        numbers = self.words.of(parts.dictionary.to_numpy(zero_copy_only=False).tolist())[parts.indices.to_numpy()]
        sizes = pc.list_value_length(split).to_numpy()
        if len(sizes) == len(texts):
            self.words.learn()
            ids_before = np.concatenate(([0], np.cumsum(self.words.lengths[numbers], dtype=np.int64)))
            return self.words.ids(numbers), np.diff(ids_before[np.cumsum(sizes)], prepend=0)
        ends = np.cumsum(sizes)
        found = iter(np.split(numbers, ends[:-1]) if len(ends) else ())
        words = [self.words.of(self._parts(text)) if apart else next(found) for text, apart in zip(texts, uneven.to_pylist())]
        self.words.learn()
        ends, words = np.cumsum([len(w) for w in words]), np.concatenate(words)
        ids_before = np.concatenate(([0], np.cumsum(self.words.lengths[words], dtype=np.int64)))
        return self.words.ids(words), np.diff(ids_before[ends], prepend=0)


def text_blocks(rows: Iterable[tuple], text_at: int, chars: int = 1 << 20) -> Iterator[list[tuple]]:
    """Consecutive rows in lists of about `chars` characters; a longer text is a list of its own."""
    block, held = [], 0
    for row in rows:
        if block and held + len(row[text_at]) > chars:
            yield block
            block, held = [], 0
        block.append(row)
        held += len(row[text_at])
    if block:
        yield block


_ENCODERS: dict[tuple[str, bool, int], TextEncoder] = {}


def shared_encoder(path: str, word_ends: bool, held: int = WORDS_HELD) -> TextEncoder:
    """The encoder of this Python worker: its word lookup serves the next tasks too."""
    if (path, word_ends, held) not in _ENCODERS:
        _ENCODERS[path, word_ends, held] = TextEncoder(path, word_ends, held)
    return _ENCODERS[path, word_ends, held]
