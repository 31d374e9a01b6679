"""Sampled segmentations over the piece lattice of a SentencePiece model, and lossless decoding.

A text's lattice has an edge for every piece that matches at a position; a character
that is no piece has one edge of its UTF-8 byte pieces.  The weight of a piece is
(10 + rank)^-alpha, its rank taken from the model's scores, which are negative merge
ranks.  Forward filtering sums the weights of all paths to each position; backward
sampling draws the last piece, then the one before it, and so on, each in proportion.
The draws are a hash of the row's key and the position in its text, so a row gets the
same pieces wherever and however often it is computed.

No piece has a space mark behind another character, so lattices are cut before each
run of spaces and around line ends; equal stretches share one lattice, which is kept
for later texts up to a bound.  All stretches are filtered at once in numpy, character by character.

Spaces become the space mark; a space mark that stands in the text itself is written
as bytes.  Nothing is normalised and no prefix is added, so decoding gives the text.

Defined results: null and empty texts have no pieces and decode to the empty text.
Repeated rows of equal key get equal pieces.
"""

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import freeing, ragged, ship, text_slices, with_fields

ALPHA = 1.0
_MARK = "▁"
_STRETCH = re.compile(r" *[^ \n]+|\n| +")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x9E3779B97F4A7C55)
_SLOTS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64)
_SHIFT = np.uint64(44)
#: Characters of stretches whose lattices are kept for later texts.
_KEPT = 1_500_000
_ALL = 0xFFFFFFFFFFFFFFFF


def _scramble(x: np.ndarray) -> np.ndarray:
    x = x + _MIX
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _utf8_width(codes: np.ndarray) -> np.ndarray:
    return 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)


class Lattice:
    def __init__(self, path: str, alpha: float = ALPHA):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.size = model.vocab_size()
        kinds = range(self.size)
        bytes_of = [i for i in kinds if model.is_byte(i)]
        self.byte_id = np.zeros(256, dtype=np.int64)
        for i in bytes_of:
            self.byte_id[int(model.id_to_piece(i)[3:5], 16)] = i
        normal = [i for i in kinds if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        order = sorted(normal, key=lambda i: (-model.get_score(i), i))
        weight = {i: -alpha * np.log(10 + rank) for rank, i in enumerate(order)}
        self.byte_weight = -alpha * np.log(10 + len(order))
        texts = {i: model.id_to_piece(i).replace(_MARK, " ") for i in normal}
        self.longest = max(map(len, texts.values()))
        self.weights = np.zeros(self.size)
        self.weights[list(weight)] = list(weight.values())
        # pieces by a hash of their characters, in two tables of slots
        self.hashes = np.zeros(self.size, dtype=np.uint64)
        for i, text in texts.items():
            value, power = 0, 1
            for char in reversed(text):
                value += (ord(char) + 1) * power
                power = power * int(_BASE) & _ALL
            self.hashes[i] = value & _ALL
        if len({self.hashes[i] for i in normal}) != len(normal):
            raise ValueError("two pieces share a hash")
        self.slots = [np.full(1 << 20, -1, dtype=np.int32) for _ in range(2)]
        slots = [(self.hashes * m) >> _SHIFT for m in _SLOTS]
        for i in normal:
            table = next(t for t in (0, 1) if self.slots[t][slots[t][i]] < 0)
            self.slots[table][slots[table][i]] = i
        raw = [b""] * self.size
        for i, text in texts.items():
            raw[i] = text.encode()
        for byte, i in enumerate(self.byte_id):
            raw[i] = bytes([byte])
        self.raw_lengths = np.array([len(r) for r in raw])
        self.raw_starts = np.cumsum(self.raw_lengths) - self.raw_lengths
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.first, self.states, self.sizes = (np.empty(0, dtype=np.int64) for _ in range(3))
        self.length, self.name, self.chance = np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.float32)

    def _learn(self, new: list[str]) -> None:
        """Add the lattices of new stretches to those that are kept."""
        first, states, sizes, length, name, chance = self._edges(new)
        at = len(self.known)
        self.known.update(zip(new, range(at, at + len(new))))
        self.states = np.r_[self.states, len(self.first) + states]
        self.first = np.r_[self.first, len(self.length) + first]
        self.sizes = np.r_[self.sizes, sizes]
        self.length = np.r_[self.length, length.astype(np.int32)]
        self.name = np.r_[self.name, name.astype(np.int32)]
        self.chance = np.r_[self.chance, chance.astype(np.float32)]

    def _look_up(self, hashed: np.ndarray) -> np.ndarray:
        """Piece ids of substring hashes, or -1."""
        found = self.slots[0][(hashed * _SLOTS[0]) >> _SHIFT]
        wrong = np.flatnonzero((found >= 0) & (self.hashes[found] != hashed))
        again = self.slots[1][(hashed[wrong] * _SLOTS[1]) >> _SHIFT]
        again[self.hashes[again] != hashed[wrong]] = -1
        found[wrong] = again
        return found

    def _edges(self, stretches: list[str]):
        """The lattices of all stretches, filtered forward.

        A state is the end of a character.  Gives the first edge of each state, the
        first state of each stretch, the stretches' sizes, and of each edge its length,
        its id and the summed chance of the state's edges up to it.
        """
        codes = np.frombuffer("".join(stretches).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        sizes = np.array([len(s) for s in stretches], dtype=np.int64)
        states = np.cumsum(sizes) - sizes
        place = np.arange(len(codes)) - np.repeat(states, sizes)
        width = min(self.longest, int(sizes.max()))
        names = np.full((len(codes), width), -1, dtype=np.int32)
        value, power = np.zeros(len(codes), dtype=np.uint64), 1
        at, shifted = np.arange(len(codes)), codes.astype(np.uint64) + np.uint64(1)
        for k in range(width):
            keep = place[at] >= k
            at, value = at[keep], value[keep]
            value = value + shifted[at - k] * np.uint64(power)
            power = power * int(_BASE) & _ALL
            names[at, k] = self._look_up(value)
        bare = np.flatnonzero(names[:, 0] < 0)  # characters that are no piece go as bytes
        names[bare, 0] = self.size + codes[bare]
        state, k = np.nonzero(names >= 0)
        name = names[state, k].astype(np.int64)
        length = k + 1
        first = np.searchsorted(state, np.arange(len(codes)))
        number = np.diff(np.r_[first, len(state)])
        weight = np.where(name < self.size, self.weights[np.minimum(name, self.size - 1)], 0.0)
        weight[first[bare]] = _utf8_width(codes[bare]) * self.byte_weight

        forward = np.zeros(len(codes) + 1)  # of the state before a position
        chance = np.empty(len(state))
        order = np.argsort(place, kind="stable")
        cuts = np.r_[0, np.cumsum(np.bincount(place))]
        for e in range(len(cuts) - 1):
            who = order[cuts[e] : cuts[e + 1]]
            edges = ragged(first[who], number[who])
            heads = np.cumsum(number[who]) - number[who]
            own = weight[edges] + np.where(length[edges] > e, 0.0, forward[state[edges] - length[edges]])
            top = np.maximum.reduceat(own, heads)
            own = np.exp(own - np.repeat(top, number[who]))
            total = np.add.reduceat(own, heads)
            forward[who] = top + np.log(total)
            # summed for each state by itself, so that a stretch's chances do not depend on what stands beside it
            row, column = np.repeat(np.arange(len(who)), number[who]), np.arange(len(own)) - np.repeat(heads, number[who])
            parts = np.zeros((len(who), int(number[who].max())))
            parts[row, column] = own / np.repeat(total, number[who])
            chance[edges] = np.cumsum(parts, axis=1)[row, column]
        chance[first + number - 1] = 2.0  # always over a draw
        return first, states, sizes, length, name, chance

    def encode(self, texts: list[str | None], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sampled ids of all texts one after the other, and the number of each text."""
        own = [_STRETCH.findall(t or "") for t in texts]
        counts = np.array([len(x) for x in own], dtype=np.int64)
        stretches = [s for x in own for s in x]
        if not stretches:
            return np.empty(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
        if len(self.first) > _KEPT:
            self.forget()
        new = set(stretches).difference(self.known)
        if new:
            self._learn(sorted(new))
        first, states, sizes, length, name, chance = self.first, self.states, self.sizes, self.length, self.name, self.chance
        which = np.fromiter(map(self.known.__getitem__, stretches), dtype=np.int64, count=len(stretches))
        doc = np.repeat(np.arange(len(texts)), counts)
        starts = np.cumsum(sizes[which]) - sizes[which]
        heads = np.r_[0, np.cumsum([len(t or "") for t in texts])][:-1]
        place = (starts - heads[doc]).astype(np.uint64)
        salt = _scramble(seeds.astype(np.uint64))[doc]
        left = sizes[which].copy()
        active = np.arange(len(which))
        drawn: list[tuple[np.ndarray, np.ndarray]] = []
        while len(active):
            at = first[states[which[active]] + left[active] - 1]
            bits = _scramble(salt[active] ^ ((place[active] + left[active].astype(np.uint64)) * _MIX))
            draw = (bits >> np.uint64(11)).astype(np.float64) * 2.0**-53
            going = np.flatnonzero(chance[at] <= draw)
            while len(going):
                at[going] += 1
                going = going[chance[at[going]] <= draw[going]]
            drawn.append((active, name[at]))
            left[active] -= length[at]
            active = active[left[active] > 0]
        number = np.zeros(len(which), dtype=np.int64)
        for who, _ in drawn:
            number[who] += 1
        ends = np.cumsum(number)
        flat = np.empty(int(ends[-1]), dtype=np.int64)
        for step, (who, ids) in enumerate(drawn):
            flat[ends[who] - 1 - step] = ids
        total = np.diff(np.r_[0, ends][np.r_[0, np.cumsum(counts)]])
        return self._bytes(flat, total)

    def _bytes(self, flat: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece, held as size + code point, replaced by their byte pieces."""
        other = np.flatnonzero(flat >= self.size)
        if not len(other):
            return flat.astype(np.int32), total
        code = flat[other] - self.size
        width = _utf8_width(code)
        sizes = np.ones(len(flat), dtype=np.int64)
        sizes[other] = width
        out = np.repeat(flat, sizes)
        starts = (np.cumsum(sizes) - sizes)[other]
        head = np.array([0, 0x00, 0xC0, 0xE0, 0xF0])
        for j in range(4):
            has = width > j
            shift = 6 * (width[has] - 1 - j)
            part = code[has] >> shift
            out[starts[has] + j] = self.byte_id[part | head[width[has]] if j == 0 else (part & 0x3F) | 0x80]
        docs = np.repeat(np.arange(len(total)), total)
        more = np.bincount(docs[other], weights=width - 1, minlength=len(total)).astype(np.int64)
        return out.astype(np.int32), total + more

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> list[str]:
        lengths = self.raw_lengths[flat]
        raw = self.raw[ragged(self.raw_starts[flat], lengths)].tobytes()
        cuts = np.r_[0, np.cumsum(lengths)][np.r_[0, np.cumsum(counts)]]
        return [raw[a:z].decode() for a, z in zip(cuts[:-1], cuts[1:])]


@lru_cache(maxsize=2)
def lattice(path: str, alpha: float = ALPHA) -> Lattice:
    return Lattice(path, alpha)


def encode_decode(docs: DataFrame, text: str, key: Column, model: str, keep: list[Column], alpha: float = ALPHA) -> DataFrame:
    """The columns ``keep`` with ``pieces`` (ids), ``n_pieces``, ``pieces_crc32`` and ``decoded``, the text made from the ids."""
    ship(docs.sparkSession)
    rows = docs.select(*keep, F.coalesce(key.cast("long"), F.lit(-1)).alias("__key"), F.col(text).alias("__text"))
    out = rows.drop("__key", "__text")
    fields = out.columns

    def run(batches):
        lat = lattice(model, alpha)
        for b in freeing(batches):
            keys = b.column(len(fields)).to_numpy()
            texts = b.column(len(fields) + 1).to_pylist()
            for own in text_slices(texts, 1_000_000):
                part = b.slice(own[0], len(own))
                flat, counts = lat.encode([texts[i] for i in own], keys[own])
                cuts = np.r_[0, np.cumsum(counts)]
                raw = flat.astype("<u4").tobytes()
                crcs = [zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip(cuts[:-1], cuts[1:])]
                more = [
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, pa.int32())),
                    pa.array(counts, pa.int64()), pa.array(crcs, pa.int64()), pa.array(lat.decode(flat, counts), pa.string()),
                ]
                columns = [part.column(i) for i in range(len(fields))]
                yield pa.RecordBatch.from_arrays(columns + more, names=[*fields, "pieces", "n_pieces", "pieces_crc32", "decoded"])
        # the model stays with the worker; lattices would stand beside the tasks of other stages
        lat.forget()

    return rows.mapInArrow(run, with_fields(out.schema, "pieces array<int>, n_pieces long, pieces_crc32 long, decoded string"))


def round_trip(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, pieces, n_pieces, pieces_crc32, decoded_sha256, lossless) of every row."""
    given = F.coalesce(F.col(text), F.lit(""))
    keep = [F.col(doc_id).alias("doc_id"), F.char_length(given).cast("long").alias("n_chars"), F.sha2(given.cast("binary"), 256).alias("__sha")]
    rows = encode_decode(docs, text, F.col(doc_id), model, keep)
    sha = F.sha2(F.col("decoded").cast("binary"), 256)
    return rows.select("doc_id", "n_chars", "pieces", "n_pieces", "pieces_crc32", sha.alias("decoded_sha256"), (sha == F.col("__sha")).alias("lossless"))


def encoded_documents(docs: DataFrame, model: str) -> DataFrame:
    """The columns of ``docs``, the text as decoded from the sampled pieces, with ``pieces`` and ``n_pieces``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    rows = encode_decode(docs, "text", F.col("doc_id"), model, [row])
    columns = [
        F.when(F.col("__row.text").isNull(), F.lit(None)).otherwise(F.col("decoded")).alias(c) if c == "text" else F.col(f"__row.`{c}`")
        for c in docs.columns
    ]
    return rows.select(*columns, *[F.col(c) for c in ("pieces", "n_pieces") if c not in docs.columns])
