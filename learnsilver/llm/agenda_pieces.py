"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

Encoding keeps a score-ordered agenda of adjacent symbol pairs: a text starts
as one symbol per character, every adjacent pair that is a piece waits under
its score (leftmost first among equal scores), and the best pair is merged
until none is left. Characters without a piece become byte pieces.

A text is cut where no piece can reach across (before a run of white space
after something else, and around characters that are in no longer piece), so
that each stretch can be encoded alone and remembered. In every Arrow batch,
the stretches met for the first time go through the agenda and through the
sentencepiece library, and the two must agree.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, repeat
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnsilver.llm.shared import text_of

SPACE = "▁"  # what stands for a space inside pieces
REMEMBERED = 150_000  # stretches kept by a worker, twice at most
LONGEST_REMEMBERED = 40  # characters of a stretch worth keeping
BYTES_AT_ONCE = 2_000_000
PLACE = (1 << 40) - 1  # mask of a place, below the rank of a score
SPREAD = np.uint64(0x9E3779B97F4A7C15)  # the golden ratio's 64 bits: spreads keys over slots
CHECKED_AT_ONCE = 50  # stretches that the library encodes as one text
SHORT = 32  # characters of a stretch that is merged side by side with others


class Vocabulary:
    """The pieces of a merge-type model, read from the model file's bytes."""

    def __init__(self, model: bytes) -> None:
        self.library = library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids: dict[str, int] = {}
        scores: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        for i in range(library.get_piece_size()):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif library.is_unused(i):
                raise ValueError("vocabularies with unused pieces are not supported")
            elif not library.is_control(i) and not library.is_unknown(i):
                self.ids[piece] = i
                scores[piece] = library.get_score(i)
        if len(self.bytes) != 256:
            raise ValueError("the vocabulary must have all byte pieces")
        order = {score: i for i, score in enumerate(sorted(set(scores.values()), reverse=True))}
        #: Smaller is better; the low bits are left to the place in the stretch.
        self.ranks = {piece: order[score] * (PLACE + 1) for piece, score in scores.items()}
        self.names = [str(i) for i in range(library.get_piece_size())]
        #: For the stretches merged side by side: ids of characters, and the pairs that merge.
        self.of_point = np.full(0x110000, -1, np.int32)
        pairs = {}
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.of_point[ord(piece)] = i
            for k in range(1, len(piece)):
                left, right = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left * len(self.names) + right] = (self.ranks[piece], i)
        self.pairs = np.array(sorted(pairs), np.int64)
        #: One entry more, for pairs that do not merge.
        nothing = (len(order) + 1) * (PLACE + 1)
        self.pair_ranks = np.array([*(pairs[key][0] for key in self.pairs.tolist()), nothing], np.int64)
        self.merged = np.array([*(pairs[key][1] for key in self.pairs.tolist()), -1], np.int32)
        self._hash_pairs()
        longer = [piece for piece in self.ids if len(piece) > 1]
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in longer):
            raise ValueError("pieces that reach over white space are not supported")
        joining = "".join(sorted(set("".join(longer)) - {SPACE}))
        members = re.escape(joining) or SPACE
        self.stretches = re.compile(f"{SPACE}*[{members}]+|{SPACE}+|[^{SPACE}{members}]").findall
        #: A character that joins nothing, to look at a stretch without the leading space.
        self.wall = "\n"
        if self.wall in joining:
            raise ValueError("the line feed must be in no longer piece")
        self.wall_ids = len(library.encode(self.wall))
        #: What the library makes of a wall, and of the start of a text before it.
        self.wall_code = np.array(library.encode(self.wall + self.wall)[self.wall_ids :], np.int32).tobytes()
        self.wall_lead = np.array(library.encode(self.wall), np.int32).tobytes()[: -len(self.wall_code)]
        self.end = library.eos_id()

    def merge(self, stretches: list[str]) -> list[bytes]:
        """The ids of each stretch, by the agenda, as 32-bit numbers in a row."""
        long = [i for i, size in enumerate(map(len, stretches)) if size > SHORT]
        if not long:
            return self._merge_short(stretches)
        found = [b""] * len(stretches)
        for i in long:
            found[i] = np.array(self._merge_long(stretches[i]), np.int32).tobytes()
        apart = set(long)
        short = [i for i in range(len(stretches)) if i not in apart]
        for i, code in zip(short, self._merge_short([stretches[i] for i in short])):
            found[i] = code
        return found

    def _merge_long(self, stretch: str) -> list[int]:
        """One stretch, its agenda a heap.

        An entry is a number: the rank of the pair's score, then its place.
        """
        ranks = self.ranks
        symbols: list[str | None] = list(stretch)
        n = len(symbols)
        before, after = list(range(-1, n)), list(range(1, n + 1))
        agenda = [
            rank + i
            for i, pair in enumerate(map(add, stretch, stretch[1:]))
            if (rank := ranks.get(pair)) is not None
        ]
        heapq.heapify(agenda)
        while agenda:
            entry = heapq.heappop(agenda)
            i = entry & PLACE
            j = after[i]
            # An entry is stale once one of its symbols has been merged into another.
            if symbols[i] is None or j >= n:
                continue
            pair = symbols[i] + symbols[j]
            if ranks.get(pair) != entry - i:
                continue
            symbols[i], symbols[j] = pair, None
            after[i] = k = after[j]
            before[k] = i
            if k < n and (rank := ranks.get(pair + symbols[k])) is not None:
                heapq.heappush(agenda, rank + i)
            if (h := before[i]) >= 0 and (rank := ranks.get(symbols[h] + pair)) is not None:
                heapq.heappush(agenda, rank + h)
        found: list[int] = []
        for symbol in symbols:
            if symbol is not None:
                i = self.ids.get(symbol)
                found += [i] if i is not None else [self.bytes[b] for b in symbol.encode()]
        return found

    def _hash_pairs(self) -> None:
        """A table of the pairs that merge: each in its slot, or in one of the next ones."""
        digits = max(4, len(self.pairs).bit_length() + 2)
        self.shift = np.uint64(64 - digits)
        slots = np.full((1 << digits) + len(self.pairs), len(self.pairs), np.int32)
        todo, at = np.arange(len(self.pairs)), self._slots(self.pairs)
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = slots[at] == len(self.pairs)
            # Of several pairs for one slot the first takes it.
            taken = np.flatnonzero(free)[np.unique(at[free], return_index=True)[1]]
            slots[at[taken]] = todo[taken]
            left = np.ones(len(todo), bool)
            left[taken] = False
            todo, at = todo[left], at[left] + 1
        self.slots = slots
        self.slot_pairs = np.append(self.pairs, -1)[slots]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * SPREAD) >> self.shift).astype(np.int64)

    def _pair_entries(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where each pair of ids stands among the pairs that merge, or the place after them."""
        keys = left.astype(np.int64) * len(self.names) + right
        keys[(left < 0) | (right < 0)] = -2
        at = self._slots(keys)
        found = self.slots[at]
        held = self.slot_pairs[at]
        other = np.flatnonzero((held != keys) & (held >= 0))
        found[held != keys] = len(self.pairs)
        for _ in range(1, self.probes):
            if not len(other):
                break
            at[other] += 1
            held = self.slot_pairs[at[other]]
            hit = held == keys[other]
            found[other[hit]] = self.slots[at[other[hit]]]
            other = other[~hit & (held >= 0)]
        return found

    def _merge_short(self, stretches: list[str]) -> list[bytes]:
        """Many stretches side by side: in every round the best pair of each agenda is merged."""
        if not stretches:
            return []
        lengths = np.fromiter(map(len, stretches), np.int64, len(stretches))
        points = np.frombuffer("".join(stretches).encode("utf-32-le"), np.uint32)
        symbols = self.of_point[points]  # negative where a character has no piece
        symbols = np.where(symbols < 0, -1 - points.astype(np.int64), symbols)
        owner = np.repeat(np.arange(len(stretches)), lengths)
        last = np.append(owner[1:] != owner[:-1], True)
        none = len(self.pairs)
        entry = np.where(last, none, self._pair_entries(symbols, np.append(symbols[1:], -1)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(owner):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            # The smallest rank, and the leftmost place among equals.
            best = np.minimum.reduceat(self.pair_ranks[entry] | np.arange(len(owner)), first)
            live = best < self.pair_ranks[none]
            at = best[live] & PLACE
            symbols[at] = self.merged[entry[at]]
            keep = np.repeat(live, np.diff(np.append(first, len(owner))))
            done.append((owner[~keep], symbols[~keep]))
            last[at] = last[at + 1]
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            owner, symbols, last, entry = owner[keep], symbols[keep], last[keep], entry[keep]
            at = place[at]
            moved = np.zeros(len(owner), bool)
            moved[at] = True
            moved[at[at > 0] - 1] = True
            changed = np.flatnonzero(moved)
            changed_pairs = self._pair_entries(symbols[changed], symbols[np.minimum(changed + 1, len(symbols) - 1)])
            entry[changed] = np.where(last[changed], none, changed_pairs)
        owners = np.concatenate([part[0] for part in done])
        order = np.argsort(owners, kind="stable")
        flat = np.concatenate([part[1] for part in done])[order].astype(np.int32)
        odd = set(owners[order][flat < 0].tolist())
        ends = (4 * np.cumsum(np.bincount(owners, minlength=len(stretches)))).tolist()
        blob = flat.tobytes()
        found = [blob[start:end] for start, end in zip([0, *ends], ends)]
        for i in odd:  # characters without a piece
            ids = (
                [k] if k >= 0 else [self.bytes[b] for b in chr(-1 - k).encode()]
                for k in np.frombuffer(found[i], np.int32).tolist()
            )
            found[i] = np.fromiter(chain.from_iterable(ids), np.int32).tobytes()
        return found

    def check(self, stretches: list[str], codes: list[bytes]) -> None:
        """Raise if the library encodes one of the stretches in another way."""
        # Many in one text, a wall before each: nothing of theirs but a wall is encoded as one.
        starts = range(0, len(stretches), CHECKED_AT_ONCE)
        groups = [self.wall + self.wall.join(stretches[k : k + CHECKED_AT_ONCE]).replace(SPACE, " ") for k in starts]
        whole = np.fromiter(chain.from_iterable(self.library.encode(groups, num_threads=1)), np.int32)
        wanted = (self.wall_lead + b"".join(chain.from_iterable(zip(repeat(self.wall_code), codes[k : k + CHECKED_AT_ONCE]))) for k in starts)
        if whole.tobytes() == b"".join(wanted):
            return
        texts = [self.wall + stretch.replace(SPACE, " ") for stretch in stretches]
        theirs = [ids[self.wall_ids :] for ids in self.library.encode(texts, num_threads=1)]
        for stretch, code, ids in zip(stretches, codes, theirs):
            if (own := np.frombuffer(code, np.int32).tolist()) != ids:
                raise ValueError(f"the library encodes {stretch!r} as {ids}, not as {own}")


@lru_cache(2)
def vocabulary(model: bytes) -> Vocabulary:
    return Vocabulary(model)


class Encoder:
    """Encodes batches of texts, and remembers a bounded number of stretches."""

    def __init__(self, model: bytes) -> None:
        self.vocabulary = vocabulary(model)
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.long: list[str] = []  # of the last texts: not remembered

    def _meet(self, stretches: set[str]) -> None:
        """Have the codes of all stretches at hand, new ones checked against the library."""
        unknown = stretches - self.recent.keys()
        again = unknown & self.older.keys()
        new = list(unknown - again)
        codes = self.vocabulary.merge(new)
        self.vocabulary.check(new, codes)
        self.recent.update((stretch, self.older[stretch]) for stretch in again)
        self.recent.update(zip(new, codes))
        self.long = [stretch for stretch in new if len(stretch) > LONGEST_REMEMBERED]

    def _forget(self) -> None:
        for stretch in self.long:
            self.recent.pop(stretch)
        if len(self.recent) > REMEMBERED:
            self.older, self.recent = self.recent, {}

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], str]]:
        """Of each text its ids, with the end id, and the same as decimals with spaces."""
        cut = [
            self.vocabulary.stretches((SPACE + text).replace(" ", SPACE)) if text else []
            for text in texts
        ]
        met = set().union(*cut)
        self._meet(met)
        known, end = self.recent, self.vocabulary.end
        names = self.vocabulary.names.__getitem__
        for stretches in cut:
            code = b"".join(map(known.__getitem__, stretches))
            ids = np.frombuffer(code, np.int32).tolist()
            ids.append(end)
            yield ids, " ".join(map(names, ids))
        self._forget()

    def decode(self, ids: list[int]) -> str:
        return self.vocabulary.library.decode(ids)


@lru_cache(1)
def _encoder(model: bytes) -> Encoder:
    """One for a worker, so that what it remembers outlives a task."""
    return Encoder(model)


def _in_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of (id, text) of some million bytes, or of a single longer text."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
        parts = sizes // BYTES_AT_ONCE
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)


def encode(docs: DataFrame, model: bytes, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """(id, ids array<int>) of every whole text, with the end id last.

    Null and empty texts have the end id alone; repeated rows stay; an empty
    table gives an empty table; other columns are not looked at.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for part in _in_parts(batches):
            ids = [code[0] for code in encoder.encode(part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"]
            )

    kind = docs.schema[id_column].dataType.simpleString()
    chosen = docs.select(F.col(id_column).alias("id"), text_of(column).alias("text"))
    return chosen.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, model: bytes, id_column: str = "doc_id") -> DataFrame:
    """(id, text) of a table of ids, by the library's own decoder; null ids: empty text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for batch in batches:
            texts = [encoder.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["id", "text"]
            )

    kind = encoded.schema[id_column].dataType.simpleString()
    chosen = encoded.select(F.col(id_column).alias("id"), "ids")
    return chosen.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_column)


def digests(
    docs: DataFrame, model: bytes, id_column: str = "doc_id", column: str = "text", with_ids: bool = False
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): each text encoded, then its ids decoded.

    Both in one pass over the texts, so that the ids need not be moved; with
    the ids as a last column, if asked for. Nulls, repeated rows and other
    columns as for ``encode``.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for part in _in_parts(batches):
            counts, codes, texts, every = [], [], [], []
            for ids, decimals in encoder.encode(part.column(1).to_pylist()):
                counts.append(len(ids))
                codes.append(hashlib.sha256(decimals.encode()).hexdigest())
                texts.append(hashlib.sha256(encoder.decode(ids).encode()).hexdigest())
                if with_ids:
                    every.append(np.array(ids, np.int32))
            columns = [
                part.column(0), pa.array(counts, pa.int64()), pa.array(codes, pa.string()), pa.array(texts, pa.string())
            ]
            if with_ids:
                columns.append(pa.array(every, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    chosen = docs.select(F.col(id_column).alias("id"), text_of(column).alias("text"))
    found = chosen.mapInArrow(run, schema + ", ids array<int>" * with_ids)
    return found.withColumnRenamed("id", id_column)
