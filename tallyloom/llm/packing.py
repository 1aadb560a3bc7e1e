"""Filling fixed-capacity containers with documents measured in tokens of a public tokenizer.

Texts are measured where they lie; only (document, size) is shuffled, spread evenly over shards of a fixed number of
documents. Inside a shard, pieces above a third of the capacity share a container with at most one other such piece,
matched greedily (the largest partner that still fits), and smaller pieces best-fit the remaining gaps.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import ship

#: Tokens of one container, documents of one shard.
CAPACITY = 2048
SHARD_DOCS = 20_000
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-tokenisation pattern that belongs to the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct text pieces whose size a Python worker remembers, and the longest of them in characters.
REMEMBERED, REMEMBERED_CHARS = 200_000, 1_000


@lru_cache(maxsize=2)
def encoder(path: str):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def line_counter(path: str) -> Callable[[str], int]:
    enc = encoder(path)
    short = lru_cache(maxsize=REMEMBERED)(lambda piece: len(enc.encode_ordinary(piece)))
    return lambda piece: short(piece) if len(piece) <= REMEMBERED_CHARS else len(enc.encode_ordinary(piece))


def token_count(text: str, path: str = TOKENIZER) -> int:
    """The exact number of tokens of the whole text.

    The pattern never joins a line break with a non-blank before it, so a text may be cut in front of every line
    break that follows a non-blank and the counts add up. Revisions repeat most lines, which are then looked up.
    """
    count = line_counter(path)
    total, start = 0, 0
    at = text.find("\n")
    while at > 0:
        if not text[at - 1].isspace():
            total += count(text[start:at])
            start = at
        at = text.find("\n", at + 1)
    return total + (count(text[start:]) if start < len(text) else 0)


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens of every document; a null or empty text has 0 tokens.

    The vocabulary is sent to the executors where the driver has it, else it is read at ``path`` on each of them.
    """

    ship(docs.sparkSession)
    if Path(path).exists() and path not in docs.sparkSession.sparkContext.listFiles:
        docs.sparkSession.sparkContext.addFile(path)  # executors need no folder of their own
    name = Path(path).name

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sent = SparkFiles.get(name)
        local = sent if Path(sent).exists() else path
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": [token_count(t, local) if t else 0 for t in b["text"]]})

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInPandas(measure, "doc_id bigint, n_tokens bigint")


def pack(pieces: list[int], capacity: int) -> list[int]:
    """The container of each piece; every piece is at most ``capacity``. Pieces of size 0 go where any room is.

    Large pieces (above a third of the capacity) in descending order take the largest unmatched partner that fits.
    Small ones in descending order go to the container with the smallest sufficient gap.
    """
    place = [-1] * len(pieces)
    large = sorted((s, i) for i, s in enumerate(pieces) if 3 * s > capacity)
    gaps: list[tuple[int, int]] = []
    n = 0
    while large:
        size, i = large.pop()
        place[i], room = n, capacity - size
        k = bisect_left(large, (room + 1, -1)) - 1
        if k >= 0:
            other, j = large.pop(k)
            place[j], room = n, room - other
        gaps.append((room, n))
        n += 1
    gaps.sort()
    for size, i in sorted(((s, i) for i, s in enumerate(pieces) if 3 * s <= capacity), reverse=True):
        k = bisect_left(gaps, (size, -1))
        if k == len(gaps):
            room, where = capacity, n
            n += 1
        else:
            room, where = gaps.pop(k)
        place[i] = where
        insort(gaps, (room - size, where))
    return place


def containers(measured: DataFrame, n_docs: int, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """container_id, doc_id, piece_no, first_token, n_tokens: every document in full, split only above the capacity.

    measured: doc_id (unique), n_tokens; ``n_docs`` is about how many rows it has and only sets the number of shards, so
    that texts are not measured for a count. A document above the capacity is cut into full containers and one remainder,
    which is packed like a document. Null sizes count as 0; an empty table gives no rows. Shards are filled by a hash
    of the document, so none depends on how large or how frequent anything is, and at most the last containers of a
    shard stay open.
    """
    ship(measured.sparkSession)
    shards = max(1, round(n_docs / shard_docs))

    def pack_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id", kind="stable")
        docs, total = rows["doc_id"].tolist(), rows["n_tokens"].tolist()
        out, tails = [], []
        n = 0
        for d, t in zip(docs, total, strict=True):
            full = (t - 1) // capacity if t > capacity else 0
            for p in range(full):
                out.append((n, d, p, p * capacity, capacity))
                n += 1
            tails.append((d, full, full * capacity, t - full * capacity))
        for (d, p, first, size), c in zip(tails, pack([x[3] for x in tails], capacity), strict=True):
            out.append((n + c, d, p, first, size))
        made = pd.DataFrame(out, columns=["container_id", "doc_id", "piece_no", "first_token", "n_tokens"])
        made["container_id"] += int(key[0]) << 32
        return made

    rows = measured.select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens"), F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard"))
    return rows.groupBy("shard").applyInPandas(pack_shard, "container_id bigint, doc_id bigint, piece_no bigint, first_token bigint, n_tokens bigint")


def fill_report(packed: DataFrame, measured: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row that judges a packing against the documents measured (doc_id unique):

    n_docs; n_missing, documents in no container; n_overfull, containers beyond the capacity; n_split, documents within
    the capacity in more than one piece; n_torn, documents whose pieces do not follow each other and add up; n_containers
    and n_least, the fewest that could hold all tokens; fill, rounded to 4 digits (1 where there is nothing).
    """
    per = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("used"))
    held = per.agg(F.count("*").alias("n_containers"), F.count_if(F.col("used") > capacity).alias("n_overfull"))
    end = F.col("first_token") + F.col("n_tokens")
    docs = packed.groupBy("doc_id").agg(F.count("*").alias("n_pieces"), F.sum("n_tokens").alias("placed"), F.max(end).alias("end"), F.countDistinct("piece_no").alias("n_numbers"))
    both = measured.select("doc_id", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens")).join(docs, "doc_id", "left")
    torn = (F.col("placed") != F.col("n_tokens")) | (F.col("end") != F.col("n_tokens")) | (F.col("n_numbers") != F.col("n_pieces"))
    judged = both.agg(
        F.count("*").alias("n_docs"), F.count_if(F.col("n_pieces").isNull()).alias("n_missing"), F.count_if((F.col("n_tokens") <= capacity) & (F.col("n_pieces") > 1)).alias("n_split"),
        F.count_if(torn).alias("n_torn"), F.ceil(F.coalesce(F.sum("n_tokens"), F.lit(0)) / capacity).cast("bigint").alias("n_least"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"),
    )
    fill = F.coalesce(F.round(F.col("n_tokens") / F.nullif(F.col("n_containers") * capacity, F.lit(0)), 4), F.lit(1.0))
    one = judged.withColumn("one", F.lit(1)).join(held.withColumn("one", F.lit(1)), "one")  # one row each
    return one.select("n_docs", "n_missing", "n_overfull", "n_split", "n_torn", "n_containers", "n_least", fill.alias("fill"))
