"""Best-fit packing of tokenized documents into sequences of fixed capacity, by large-item matching.

A document's ids end with an end mark; only a longer document than a sequence is cut, its first piece being the shorter one.
Pieces are dealt to shards by a hash, and each shard is packed alone: pieces above one third of the capacity are matched
first, the largest with the largest that still fits beside it, so that at most two of them share a sequence; the smaller ones
then go, largest first, to the sequence with the least room that suffices. A shard holds about ``SHARD`` pieces (numbers
only, not ids), so what a shard wastes is about one sequence in ten thousand, and its work does not grow with the corpus.

Nulls: a null text is empty, and an empty text is its end mark alone. Repeated rows and ids are packed one by one (the
sequence and offset tell them apart). An empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import map_batches, written

CAPACITY = 1024
END_MARK = 2
SHARD = 20_000
# Sequence numbers hold the shard above these bits.
_SEQUENCE_BITS = 32

# Texts of these characters are split alike by both libraries; others take the reference tokenizer, which is slower.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7E¡-¬®-ſ‐-‧‰-⁞€]*")


# Fixed value: the one special token of the vocabulary.
_SPECIAL = "<|endoftext|>"


def tokenizer(folder: str, special: bool = False) -> Callable[[str], np.ndarray]:
    """Ids of a text as the tokenizer file in ``folder`` gives them. With ``special`` a special token's name in a text is that token,
    which is how the file is read by default; without it is ordinary text."""
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(f"{folder}/byte_bpe_50k.json")
    exact.encode_special_tokens = not special
    with open(f"{folder}/byte_bpe_50k.tiktoken", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("byte_bpe_50k", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(text: str) -> np.ndarray:
        if _PLAIN.fullmatch(text) and not (special and _SPECIAL in text):
            return fast.encode_to_numpy(text, disallowed_special=())
        return np.array(exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return ids


def tokenizer_folder() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json").rsplit("/", 1)[0]


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; the first takes what the whole ones leave."""
    first = total % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, total, capacity))]


def split(docs: DataFrame, capacity: int = CAPACITY, folder: str | None = None) -> DataFrame:
    """Pieces of each document: doc_id, piece, start, length, ids_crc32."""

    def run(batches):
        ids = tokenizer(folder or tokenizer_folder(), special=True)
        for batch in batches:
            out = defaultdict(list)
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                tokens = np.append(ids(text), np.uint32(END_MARK)).astype("<u4")
                for piece, (start, length) in enumerate(cut(len(tokens), capacity)):
                    out["doc_id"].append(doc)
                    out["piece"].append(piece)
                    out["start"].append(start)
                    out["length"].append(length)
                    out["ids_crc32"].append(zlib.crc32(tokens[start : start + length].tobytes()))
            kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
            yield {k: pa.array(out[k], t) for k, t in kinds.items()}

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_batches(picked, run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece.

    Pieces and open sequences are kept by length and by room, so a step looks at no more than ``capacity`` classes.
    """
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_length: dict[int, list[int]] = defaultdict(list)
    for i in np.argsort(lengths, kind="stable"):
        by_length[int(lengths[i])].append(int(i))
    open_by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    used: list[int] = []

    def place(item: int, bin_: int, room: int) -> int:
        size = int(lengths[item])
        sequence[item], offset[item] = bin_, capacity - room
        return room - size

    def largest(most: int, least: int) -> int:
        return next((s for s in range(most, least - 1, -1) if by_length.get(s)), 0)

    third = capacity // 3
    # Matching: each large piece takes the largest other large piece that fits beside it.
    for size in range(capacity, third, -1):
        while by_length.get(size):
            used.append(len(used))
            room = place(by_length[size].pop(), used[-1], capacity)
            partner = largest(min(size, room), third + 1)
            if partner:
                room = place(by_length[partner].pop(), used[-1], room)
            open_by_room[room].append(used[-1])
    # Best fit: each small piece, largest first, takes the least room that holds it.
    for size in range(third, 0, -1):
        tightest = size
        while by_length.get(size):
            while tightest <= capacity and not open_by_room[tightest]:
                tightest += 1
            if tightest > capacity:
                used.append(len(used))
                bin_, room = used[-1], capacity
                tightest = capacity
            else:
                bin_, room = open_by_room[tightest].pop(), tightest
            room = place(by_length[size].pop(), bin_, room)
            open_by_room[room].append(bin_)
            tightest = min(tightest, room) if room >= size else tightest
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. Any columns besides doc_id, piece and length are passed on."""
    shards = max(1, -(-pieces.count() // shard))
    keys = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards))
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long").simpleString()[len("struct<") : -1]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        number = int(frame["_shard"].iloc[0])
        frame = frame.drop(columns="_shard").sort_values(["doc_id", "piece", "ids_crc32"], ignore_index=True)
        sequence, offset = fit(frame["length"].to_numpy(), capacity)
        return frame.assign(sequence_id=(number << _SEQUENCE_BITS) + sequence, offset=offset)

    return pieces.withColumn("_shard", keys).groupBy("_shard").applyInPandas(run, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, folder: str | None = None, shard: int = SHARD) -> DataFrame:
    return pack(written(split(docs, capacity, folder), "pieces"), capacity, shard)
