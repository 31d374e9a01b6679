"""Token ids of Arrow text columns: each different stretch of a text is given to the tokenizer once.

The pre-tokenizers cut at white space, so what stands between single spaces and line ends
can be encoded alone.  Arrow splits a column and numbers the different stretches; only new
ones reach the tokenizer, many at a time, and numpy puts the ids together.  Two kinds of
tokenizers are known: byte-level ones, where a word's first piece holds the space before it,
and those that drop white space and mark a word's last piece.  The latter also cut between a
letter and a mark, and lower-case: there a word is one stretch, whatever marks follow it and
however it is written.  Texts that cannot be cut this way are encoded whole: those with an
added token, which the library cuts out before all else, for byte-level tokenizers those with
a run of white space that stays together, and where letters are lower-cased those with an
accent behind a capital (the library composes the two first, and not all have a composed form).
"""

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import ragged

# a task has one core; the library's threads would only wait for each other
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: white space of the pre-tokenizers' patterns
_SPACE = r"[\t-\r \x{85}\p{Z}]"
#: marks that end a stretch of letters as one more part
_STOPS = ".,;:!?"
#: a letter and the mark behind it, one part each; not all letters (and not U+0130, which becomes a letter and an accent)
_SEAM = r"([A-Za-zÀ-ÖØ-öø-\x{12F}\x{131}-ſ])([!-/:-@\[-`{-~])"


def room(array: np.ndarray, size: int) -> np.ndarray:
    """``array`` with place for ``size`` values, doubled where it has to grow."""
    return array if size <= len(array) else np.concatenate([array, np.empty(max(size, 2 * len(array)) - len(array), dtype=array.dtype)])


class ColumnEncoder:
    """Ids of a column with at most ``bound`` known stretches in memory between two calls."""

    def __init__(self, path: str, bound: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        pieces = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.keeps_spaces = not any(p.endswith("</w>") for p in pieces)
        #: ids that begin a stretch, or that end a word
        self.edges = np.array([p.startswith("\u0120") if self.keeps_spaces else p.endswith("</w>") for p in pieces])
        #: words are lower-cased and cut from the marks behind them
        self.folds = not self.keeps_spaces and self._ids(["Ab."]) == self._ids(["ab ."])
        marks = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        runs = [f"{_SPACE}{{3}}", rf"{_SPACE}{{2}}\z"] if self.keeps_spaces else []
        if self.folds:
            # lower-casing must not make an added token either
            marks, runs = [f"(?i:{m})" for m in marks], [r"[A-Z]\p{M}"]
        #: RE2 pattern of texts that are encoded whole
        self.whole = "|".join(marks + runs)
        self.bound = bound
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        #: where a stretch's ids begin in the pool, and their number; all three have room behind what is in use
        self.starts, self.lengths = np.empty(1024, dtype=np.int64), np.empty(1024, dtype=np.int64)
        self.pool, self.used = np.empty(4096, dtype=np.uint32), 0

    def _put(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Write the ids of further stretches behind those in use."""
        at, n = len(self.known), self.used
        self.starts, self.lengths, self.pool = room(self.starts, at + len(sizes)), room(self.lengths, at + len(sizes)), room(self.pool, n + len(ids))
        self.starts[at : at + len(sizes)] = n + np.cumsum(sizes) - sizes
        self.lengths[at : at + len(sizes)] = sizes
        self.pool[n : n + len(ids)] = ids

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, stretches: list[str], words: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their numbers of stretches, encoded many at a time; ``words`` says how many each has."""
        joined = [("" if self.keeps_spaces else " ").join(stretches[at : at + 500]) for at in range(0, len(stretches), 500)]
        ids = np.array([i for own in self._ids(joined) for i in own], dtype=np.uint32)
        edges, last = np.flatnonzero(self.edges[ids]), np.cumsum(words)
        if len(edges) != last[-1]:  # the pre-tokenizer knows other letters than Python
            own = self._ids(stretches)
            return np.array([i for x in own for i in x], dtype=np.uint32), np.array([len(x) for x in own], dtype=np.int64)
        return ids, np.diff(np.r_[edges, len(ids)] if self.keeps_spaces else np.r_[-1, edges[last - 1]])

    def _words(self, stretch: str) -> int:
        """Number of words of a stretch that can be encoded beside others; 0 if it cannot."""
        if self.keeps_spaces:
            return int(stretch[:1] == " " and stretch.split() == [stretch[1:]])
        if stretch.isalpha():
            return 1
        letters = stretch.rstrip(_STOPS)
        return 1 + (len(letters) < len(stretch)) if letters.isalpha() else 0

    def _learn(self, new: list[str]) -> None:
        words = list(map(self._words, new))
        many, rest = [s for s, n in zip(new, words) if n], [s for s, n in zip(new, words) if not n]
        ids, lengths = np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.int64)
        if many:
            ids, lengths = self._together(many, [n for n in words if n])
        alone = self._ids(rest)
        sizes = np.r_[lengths, np.array([len(x) for x in alone], dtype=np.int64)]
        ids = np.r_[ids, np.array([i for x in alone for i in x], dtype=np.uint32)]
        self._put(ids, sizes)
        self.used += len(ids)
        self.known.update(zip(many + rest, range(len(self.known), len(self.known) + len(new))))

    def _slots(self, stretches: list[str]) -> np.ndarray:
        known = self.known
        new = [s for s in stretches if s not in known]
        if new:
            self._learn(new)
        return np.fromiter(map(known.__getitem__, stretches), dtype=np.int64, count=len(stretches))

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Slots of all stretches, and where each text's begin."""
        if self.folds:
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), _SEAM, r"\1 \2")
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n" if self.keeps_spaces else " "), " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets -= offsets[0]
        codes, parts = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        if not self.keeps_spaces:
            return self._slots(parts)[codes], offsets
        # the space that was cut away belongs to the part behind it, but for a line's and a text's first part
        slots = self._slots([p if p[:1] == "\n" else " " + p for p in parts])[codes]
        first = offsets[np.flatnonzero(np.diff(offsets))]
        opening, which = np.unique(codes[first], return_inverse=True)
        slots[first] = self._slots([parts[c] for c in opening.tolist()])[which]
        return slots, offsets

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, with ``end_id`` behind each text, and the number of each text's; null counts as empty."""
        if len(self.known) > self.bound:
            self.clear()
        texts = pc.fill_null(texts.cast(pa.string()), "")
        at = np.empty(0, dtype=np.int64)
        if self.whole:
            whole = pc.match_substring_regex(texts, self.whole)
            at = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        own = self._ids(texts.take(pa.array(at)).to_pylist()) if len(at) else []
        slots, offsets = self._cut(pc.if_else(whole, "", texts) if len(at) else texts)
        # one slot behind each text: its end id, or for texts encoded whole all of their ids
        n, end = len(texts), [] if end_id is None else [end_id]
        sizes = np.array([len(end), *(len(x) + len(end) for x in own)], dtype=np.int64)
        self._put(np.array([*end, *(i for x in own for i in [*x, *end])], dtype=np.uint32), sizes)  # overwritten by the next call
        extra = np.zeros(n, dtype=np.int64)
        extra[at] = np.arange(1, len(at) + 1)
        behind = offsets[1:] + np.arange(n)
        every = np.empty(len(slots) + n, dtype=np.int64)
        is_own = np.ones(len(every), dtype=bool)
        is_own[behind] = False
        every[is_own], every[behind] = slots, len(self.known) + extra
        sizes = self.lengths[every]
        flat = self.pool[ragged(self.starts[every], sizes)]
        return flat, np.diff(np.r_[0, np.cumsum(sizes)][np.r_[0, behind + 1]])


@lru_cache(maxsize=2)
def column_encoder(path: str) -> ColumnEncoder:
    return ColumnEncoder(path)


def column_slices(texts: pa.Array, limit: int = 6_000_000) -> Iterator[tuple[int, int]]:
    """(start, stop) of runs of ``texts`` of at most ``limit`` bytes, or one text where that is longer."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)
