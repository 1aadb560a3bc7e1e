"""Evaluation texts inside training text.

Pigeonhole edit matching over words: a window of ``window`` successive words of an item that occurs with at most
``budget`` edits contains one of its ``budget + 1`` equal pieces unchanged. Pieces of both sides are hashed. Documents
are scanned once whatever the number of items: a bit filter of bounded size over the pieces of all items drops almost
every place, what passes is joined with the pieces by hash, and the words around a hit are verified by Myers'
bit-parallel edit distance. Only stretches around hits are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.wikitext import visible, words
from tallyloom.session import cut, ship, sized

WINDOW = 12
BUDGET = 1
#: Bits of the filter per piece, its greatest size as a power of two, and the places each piece sets. A larger set of
#: pieces only fills the filter, so that more places are shuffled and fall out at the join.
BITS_PER_PIECE, MOST_BITS, PROBES = 64, 28, 3
#: Items up to which their words are broadcast to the verification.
BROADCAST_ITEMS = 20_000
#: Words whose hash a Python worker remembers.
REMEMBERED = 1_000_000


def myers(pattern: list[str], text: list[str]) -> int:
    """The least edit distance between the whole pattern and any stretch of the text, by bit-parallel columns."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, w in enumerate(pattern):
        peq[w] = peq.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best = m
    for w in text:
        eq = peq.get(w, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | ~(diagonal | plus) & full, plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(diagonal | up) & full, up & diagonal
        best = min(best, score)
    return best


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = WordHashes()


def piece_hashes(w: list[str], size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` successive words."""
    n = len(w) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(_HASHES.__getitem__, w), np.uint64, len(w))
    h = np.zeros(n, np.uint64)
    for j in range(size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + ids[j : j + n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def probe(h: np.ndarray, i: int, bits: int) -> np.ndarray:
    """The i-th place of the filter that each piece sets."""
    return (h * np.uint64(2 * i + 1) + np.uint64(i)) >> np.uint64(64 - bits)


class Item:
    """The pieces of one item and where they stand in it."""

    def __init__(self, own: list[str], window: int, budget: int) -> None:
        self.own, self.window, self.budget, self.size = own, window, budget, window // (budget + 1)
        self.pieces: dict[tuple[str, ...], list[int]] = {}
        for i in range(len(own) - self.size + 1):
            self.pieces.setdefault(tuple(own[i : i + self.size]), []).append(i)

    def distance(self, w: list[str]) -> int:
        """The least distance of a window of the item to a stretch of ``w``; ``budget + 1`` if none is within it."""
        best, seen = self.budget + 1, set()
        for i in range(len(w) - self.size + 1):
            for at in self.pieces.get(tuple(w[i : i + self.size]), ()):
                for s in range(max(0, at + self.size - self.window), min(at, len(self.own) - self.window) + 1):
                    if (s, i - at) in seen:  # the same window at the same place, met through another piece
                        continue
                    seen.add((s, i - at))
                    begin = i - (at - s)
                    best = min(best, myers(self.own[s : s + self.window], w[max(0, begin - self.budget) : max(0, begin + self.window + self.budget)]))
                    if not best:
                        return 0
        return best


def hit_runs(text: str, bits: np.ndarray, k: int, window: int, budget: int) -> Iterator[tuple[str, list[int]]]:
    """Stretches of visible words around places that pass the filter, with the hashes of these places."""
    size = window // (budget + 1)
    around = window - size + budget
    for part in visible(text):
        w = words(part)
        h = piece_hashes(w, size)
        at = np.arange(len(h))
        for p in range(PROBES):
            idx = probe(h[at], p, k)
            at = at[(bits[idx >> np.uint64(3)] >> (idx & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            if not len(at):
                break
        if len(at):
            for run in np.split(at, np.flatnonzero(np.diff(at) > around) + 1):
                yield " ".join(w[max(0, run[0] - around) : run[-1] + size + around]), np.unique(h[run]).view(np.int64).tolist()


def leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, budget: int = BUDGET, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", passage: str = "passage") -> DataFrame:
    """doc_id, item_id, distance: documents that contain ``window`` successive words of an item with at most ``budget``
    words changed, added or left out; distance 0 is a verbatim stretch.

    Case, punctuation, spacing and markup do not count. Items with fewer words than the window, null ids, null and
    empty texts match nothing; either table may be empty. One row per pair whatever is repeated inside a document;
    documents with equal text each have their own rows. Items that share an id are one item of several passages.
    """
    ship(docs.sparkSession)
    size = window // (budget + 1)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = ([x for part in visible(p) for x in words(part)] for p in b["passage"])
            rows = [(i, w) for i, w in zip(b["item_id"], texts, strict=True) if len(w) >= window]
            yield pd.DataFrame(rows, columns=["item_id", "own"])

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, own in zip(b["item_id"], b["own"], strict=True):
                yield pd.DataFrame({"item_id": i, "piece": np.unique(piece_hashes(list(own), size)).view(np.int64)})

    wanted = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(passage).alias("passage")).dropna()
    owns = cut(wanted.mapInPandas(split, "item_id bigint, own array<string>"))
    pieces = cut(owns.mapInPandas(cut_up, "item_id bigint, piece bigint").distinct())
    k = min(MOST_BITS, max(13, (pieces.count() * BITS_PER_PIECE).bit_length()))

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            h = b["piece"].to_numpy().view(np.uint64)
            at = np.concatenate([probe(h, i, k) for i in range(PROBES)]).astype(np.int64)
            yield pd.DataFrame({"byte": at >> 3, "bit": np.int64(1) << (at & 7)})

    # the filter has at most 2 ** (MOST_BITS - 3) bytes whatever the items, so its bytes may be collected
    filled = pieces.select("piece").distinct().mapInPandas(places, "byte bigint, bit bigint").groupBy("byte").agg(F.bit_or("bit").cast("int").alias("bits"))
    bits = np.zeros(1 << (k - 3), np.uint8)
    got = filled.toPandas()
    bits[got["byte"].to_numpy(dtype=np.int64)] = got["bits"].to_numpy(dtype=np.uint8)
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(d, n, *run) for d, t in zip(b["doc_id"], b["text"], strict=True) for n, run in enumerate(hit_runs(t, held.value, k, window, budget))]
            yield pd.DataFrame(rows, columns=["doc_id", "run_no", "stretch", "pieces"])

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = lru_cache(maxsize=10_000)(lambda own: Item(own.split(" "), window, budget))
        for b in batches:
            found = [known(own).distance(stretch.split(" ")) for own, stretch in zip(b["own"], b["stretch"], strict=True)]
            yield pd.DataFrame({"doc_id": b["doc_id"], "item_id": b["item_id"], "distance": found})

    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).dropna()
    runs = cut(source.mapInPandas(scan, "doc_id bigint, run_no int, stretch string, pieces array<bigint>"))
    pairs = runs.select("doc_id", "run_no", F.explode("pieces").alias("piece")).join(pieces, "piece").select("doc_id", "run_no", "item_id").distinct()
    texts = owns.select("item_id", F.array_join("own", " ").alias("own"))
    both = runs.select("doc_id", "run_no", "stretch").join(pairs, ["doc_id", "run_no"]).join(sized(texts, BROADCAST_ITEMS), "item_id")
    checked = both.select("doc_id", "item_id", "own", "stretch").mapInPandas(verify, "doc_id bigint, item_id bigint, distance bigint")
    return checked.where(F.col("distance") <= budget).groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"))


def leak_report(found: DataFrame) -> DataFrame:
    return found.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.sum(F.when(F.col("distance") == 0, 1).otherwise(0)).alias("n_verbatim"))
