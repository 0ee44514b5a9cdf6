"""Byte-level BPE by a pair occurrence index.

The distinct words of a batch lie one after another in one list of symbols. An index maps each pair of
neighbours to all its positions; the ranks of pairs that occur wait in a heap. The lowest rank is merged
at all its positions at once, which removes and adds positions of the neighbouring pairs only, so the
work is that of the merges made and not of the passes over a word. Words already encoded in a partition
aren't encoded again, until ``MAX_WORDS`` of them are kept and the table starts anew.

Merging all words by ascending rank gives what merging each word alone gives if no merge needs a symbol
that a later merge makes; a vocabulary where that doesn't hold is refused.

The vocabulary is a file that every executor has at the same path. Its added tokens, such as an end of
text, are found in the text as they stand there and become one id, as the library does by default.

Cases: null and empty texts have no ids and decode to an empty text; ids may be null or repeat, each row
is encoded for itself; a word of any length is merged whole; columns other than the two named aren't
read, so their names don't matter. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from returnscope.llm.token_counts import PATTERN

MAX_WORDS = 200_000
# Texts are taken by so many characters at a time, so that few words are held apart at once.
CHARACTERS = 1 << 21
ENDS, GONE = -1, -2
# Beyond any id; a pair of ids is a number in this base.
SPAN = 1 << 20
# Positions from which a pair is merged as a vector.
MANY = 24
# The vocabulary's pattern, and what it means in a text of ASCII characters.
WORDS = regex.compile(PATTERN)
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def newer() -> dict[int, str]:
    """Characters that the pattern's library takes for letters or numbers and the tokenizer doesn't, each with a sign instead.

    The two know different versions of Unicode, so only what Python's tables leave unassigned is asked for.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    late = ((start, c) for start, kind in (("a", r"\p{L}"), ("1", r"\p{N}")) for c in regex.findall(kind, every))
    return {ord(c): "\u00a7" for start, c in late if unicodedata.category(c) == "Cn" and len(split(start + c)) > 1}


class Vocabulary:
    """Merges by pair of ids, bytes by id, and the strings of added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        letters, ids = byte_letters(), stored["model"]["vocab"]
        self.bytes = {i: bytes(map(letters.__getitem__, token)) for token, i in ids.items()}
        self.first = np.array([ids[letter] for letter, _ in sorted(letters.items(), key=lambda x: x[1])], np.int32)
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[tuple[int, int, int]] = []
        known = set(self.first.tolist())
        for rank, pair in enumerate(stored["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, whole = ids[a], ids[b], ids[a + b]
            if left not in known or right not in known or whole in known:
                raise ValueError(f"merge {rank} needs a symbol that isn't made before it, or makes one again")
            known.add(whole)
            self.ranks[left, right] = rank
            self.made.append((left, right, whole))
        pairs = np.array([a * SPAN + b for a, b in self.ranks], np.int64)
        self.key_ranks = np.argsort(pairs)
        self.keys = pairs[self.key_ranks]
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in stored["added_tokens"]}
        self.bytes |= {t["id"]: t["content"].encode() for t in stored["added_tokens"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cuts = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.added else None
        self.newer = newer()
        self.late = re.compile(f"[{chr(min(self.newer))}-{chr(0x10FFFF)}]")

    def split(self, text: str) -> list[str]:
        """The words of a text, with added tokens as words of their own."""
        parts = self.cuts.split(text) if self.cuts else [text]
        return [word for n, part in enumerate(parts) for word in ([part] if n % 2 else self._words(part))]

    def _words(self, part: str) -> list[str]:
        if part.isascii():
            return ASCII_WORDS.findall(part)
        if not self.late.search(part):
            return WORDS.findall(part)
        shadow = part.translate(self.newer)
        return [part[m.start() : m.end()] for m in WORDS.finditer(shadow)]

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1."""
        keys = left.astype(np.int64) * SPAN + right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.key_ranks[at], -1)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word; ``words`` are distinct, so a position is merged once however often its word occurs.

        The arrays are seen by number, for pairs at few positions, and as vectors, for pairs at many.
        """
        coded = [w.encode("utf-8", "replace") for w in words]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        stops = np.cumsum(sizes + 1)
        sym = np.full(int(sizes.sum()) + len(words) + 1, ENDS, np.int32)
        inner = np.ones(len(sym), bool)
        inner[0] = False
        inner[stops] = False
        sym[inner] = self.first[np.frombuffer(b"".join(coded), np.uint8)]
        after = np.arange(1, len(sym) + 1)
        before = np.arange(-1, len(sym) - 1)
        symbols, next_one, last_one = memoryview(sym), memoryview(after), memoryview(before)
        index: dict[int, list[int]] = {}
        active: list[int] = []

        def note(starts: np.ndarray) -> None:
            """Enter the pairs that begin at ``starts``."""
            ranks = self.rank_of(sym[starts], sym[after[starts]])
            found = np.flatnonzero(ranks >= 0)
            found = found[np.argsort(ranks[found], kind="stable")]
            cuts = np.flatnonzero(np.diff(ranks[found])) + 1
            for part in np.split(found, cuts) if len(found) else ():
                rank = int(ranks[part[0]])
                if rank not in index:
                    heapq.heappush(active, rank)
                index.setdefault(rank, []).extend(starts[part].tolist())

        note(np.arange(1, len(sym) - 1))
        while active:
            rank = heapq.heappop(active)
            left, right, whole = self.made[rank]
            places = index.pop(rank)
            if len(places) < MANY:
                for place in sorted(places):
                    second = next_one[place]
                    # An earlier position, or an earlier rank, may have used either symbol.
                    if symbols[place] != left or symbols[second] != right:
                        continue
                    follower, ahead = next_one[second], last_one[place]
                    symbols[place], symbols[second] = whole, GONE
                    next_one[place], last_one[follower] = follower, place
                    for start, pair in ((ahead, (symbols[ahead], whole)), (place, (whole, symbols[follower]))):
                        made = self.ranks.get(pair)
                        if made is not None:
                            if made not in index:
                                heapq.heappush(active, made)
                                index[made] = []
                            index[made].append(start)
                continue
            place = np.unique(places)
            place = place[(sym[place] == left) & (sym[after[place]] == right)]
            if left == right:
                # In a run of equal symbols every other position is merged, from the left.
                first = np.append(True, place[1:] != after[place[:-1]])[: len(place)]
                run = np.maximum.accumulate(np.where(first, np.arange(len(place)), 0))
                place = place[(np.arange(len(place)) - run) % 2 == 0]
            second = after[place]
            sym[place], sym[second] = whole, GONE
            after[place] = after[second]
            before[after[place]] = place
            note(np.concatenate([before[place], place]))
        left_over = sym != GONE
        counts = np.cumsum(left_over & (sym != ENDS))[stops]
        ids = sym[left_over & (sym != ENDS)].astype("<u4").tobytes()
        ends = (counts * 4).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def encode(self, texts: Iterable[str | None], known: dict[str, bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; ``known`` gains the texts' words."""
        known.update(self.added)
        split = [self.split(t) if t else [] for t in texts]
        new = [w for w in set().union(*split) if w not in known]
        known.update(zip(new, self.encode_words(new), strict=True))
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@cache
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


def by_size(texts: pa.Array) -> Iterator[list[str | None]]:
    """Runs of whole texts, each run ending with the text that fills it."""
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).cumsum() // CHARACTERS
    cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(texts)]
    for start, stop in zip(cuts, cuts[1:]):
        yield texts[start:stop].to_pylist()


def encode(
    docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", decoded: bool = False
) -> DataFrame:
    """``id``, ``n_tokens`` and ``ids``, the ids of the whole text as little-endian unsigned 32-bit integers.

    With ``decoded``, also the text that these ids decode to, from the same task.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bytes] = {}
        words = load(vocabulary)
        for batch in batches:
            ids: list[bytes] = []
            for texts in by_size(batch.column(1)):
                if len(known) > MAX_WORDS:
                    known.clear()
                ids += words.encode(texts, known)
            columns = {"id": batch.column(0), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())}
            if decoded:
                columns["decoded"] = pa.array(map(words.decode, ids), pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids binary" + ", decoded string" * decoded)


def decode(encoded: DataFrame, vocabulary: str, ids_column: str = "ids", text_column: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids; null ids decode to an empty text."""
    rows = encoded.select(*(c for c in encoded.columns if c != text_column))
    at = rows.columns.index(ids_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = load(vocabulary)
        for batch in batches:
            texts = pa.array((words.decode(x or b"") for x in batch.column(at).to_pylist()), pa.string())
            yield batch.append_column(text_column, texts)

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(text_column, StringType())]))
