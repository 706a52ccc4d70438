"""Alignment of two tokenizers' tokens by bytes, and the strength of each link by corpus-wide counts.

Both tokenizers cut the same bytes. All documents of a chunk are flattened into two Arrow arrays of ids, whose lengths are summed up within
each document to ends. A full outer Acero join on (document, end) brings the cuts of both together: sorted, each row is a
stretch that lies in exactly one token of either side, so it is one link, and the missing side is the next token that ends. Rows
with both sides close a group. Arrow counts in how many documents of the chunk each id pair is linked; Spark sums these counts,
finds the highest count of each id of the first tokenizer (one number per vocabulary entry, which bounds the broadcast), and
joins them back to the chunks (see ``chunks``), where each document's links are added up.

Nulls: null and empty texts, and texts that one of the tokenizers does not give back byte for byte, have no tokens: zeros and
an empty ``groups_sha256``. Repeated rows are documents of their own and count each. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.llm.chunks import DOCUMENT, ENTRY, KNOWN, by_chunk, chunked, column, of_kind
from tidefold.llm.common import Bytes, written
from tidefold.llm.packing import tokenizer, tokenizer_folder

# A pair of ids is one number, the first id above these bits.
_PAIR_BITS = 20
# A document's place in its chunk stands above these bits of a token's end.
_END_BITS = 36

_DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places array<int>, times array<int>"
_ENTRY = "place int, pair long, n long"
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

# Ids of each text, one after the other, and how many each has.
Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


class Tokens:
    """Two tokenizers with the bytes of their entries."""

    def __init__(self, folder: str) -> None:
        import sentencepiece

        ids = tokenizer(folder)
        pieces = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/piece_bpe_32k.model")
        with open(f"{folder}/byte_bpe_50k.tiktoken", "rb") as lines:
            ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, lines)}
        self.a_bytes = pa.array([ranks.get(i, b"") for i in range(max(ranks) + 1)], pa.large_binary())
        self.b_bytes = pa.array([_piece_bytes(pieces, i) for i in range(pieces.get_piece_size())], pa.large_binary())

        def first(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            found = [ids(" " + t) for t in texts]
            return np.concatenate(found).astype(np.int64), np.fromiter(map(len, found), np.int64, len(found))

        def second(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            found = [np.array(pieces.encode(t), np.int32) for t in texts]
            return np.concatenate(found).astype(np.int64), np.fromiter(map(len, found), np.int64, len(found))

        self.first, self.second = first, second
        # An id in decimal digits with what follows it: another of its side, the other side, or the next group.
        self.digits = pa.concat_arrays(
            [pa.array([f"{i}{mark}" for i in range(n)], pa.large_string()) for n, marks in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for mark in marks]
        )


def _piece_bytes(pieces, i: int) -> bytes:
    if pieces.is_control(i) or pieces.is_unknown(i):
        return b""
    piece = pieces.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()


def _joined(entries: pa.Array, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all entries one after the other, and where each begins and the last ends."""
    taken = entries.take(pa.array(ids))
    at = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1]
    return np.frombuffer(taken.buffers()[2], np.uint8)[: at[-1]] if len(ids) else np.zeros(0, np.uint8), at


def _given_back(source: Bytes, entries: pa.Array, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which texts, each with a space before it, the joined tokens give back."""
    data, at = _joined(entries, ids)
    first = np.concatenate(([0], np.cumsum(counts)))
    begin = at[first]
    sizes = np.diff(source.starts) + 1
    good = np.diff(begin) == sizes
    rows = np.flatnonzero(good)
    # The texts that fit in size, side by side with theirs.
    take = np.repeat(begin[rows] - np.cumsum(sizes[rows]) + sizes[rows], sizes[rows]) + np.arange(sizes[rows].sum())
    want = np.full(len(take), 0x20, np.uint8)
    heads = np.cumsum(sizes[rows]) - sizes[rows]
    body = np.ones(len(take), bool)
    body[heads] = False
    lengths = sizes[rows] - 1
    want[body] = source.data[np.repeat(source.starts[rows] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())]
    wrong = np.flatnonzero(data[take] != want)
    good[rows[np.searchsorted(heads, wrong, side="right") - 1]] = False
    return good


def _ends(entries: pa.Array, ids: pa.ListArray) -> pa.Array:
    """(document, end of token) as one number for each token: a cumulative sum that starts anew with each list."""
    values, parents = pc.list_flatten(ids), pc.list_parent_indices(ids)
    total = pc.cumulative_sum(pc.binary_length(entries.take(values)).cast(pa.int64()))
    before = pc.subtract(ids.offsets, ids.offsets[0]).to_numpy()[:-1]
    base = np.concatenate(([0], total.to_numpy()))[before]
    return pc.add(pc.shift_left(parents.cast(pa.int64()), _END_BITS), pc.subtract(total, pa.array(base).take(parents)))


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(ids))


def links(a_bytes: pa.Array, b_bytes: pa.Array, a: pa.ListArray, b: pa.ListArray) -> pa.Table:
    """One row per stretch between neighbouring cuts: key (document and end), i and j (flat places of the two tokens), both."""
    sides = [
        pa.table({"key": _ends(entries, ids), name: pa.array(np.arange(len(pc.list_flatten(ids))))})
        for entries, ids, name in ((a_bytes, a, "i"), (b_bytes, b, "j"))
    ]
    cuts = sides[0].join(sides[1], "key", join_type="full outer", use_threads=False).sort_by("key").combine_chunks()
    both = pc.and_(pc.is_valid(cuts["i"]), pc.is_valid(cuts["j"]))
    # A document's last cut is one of both sides, so nothing is filled from the next document.
    return pa.table({"key": cuts["key"], "i": pc.fill_null_backward(cuts["i"]), "j": pc.fill_null_backward(cuts["j"]), "both": both})


def _encoder(folder: str) -> Callable[[pa.RecordBatch], tuple[dict, dict]]:
    tokens = Tokens(folder)

    def run(batch: pa.RecordBatch) -> tuple[dict, dict]:
        column_ = batch.column("text")
        texts = column_.to_pylist()
        source = Bytes(column_)
        # Texts that either side does not give back lose their tokens on both.
        sides = [encode(texts) for encode in (tokens.first, tokens.second)]
        good = np.diff(source.starts) > 0
        for (ids, counts), entries in zip(sides, (tokens.a_bytes, tokens.b_bytes), strict=True):
            good &= _given_back(source, entries, ids, counts)
        a, b = (_lists(ids[np.repeat(good, counts)], np.where(good, counts, 0)) for ids, counts in sides)
        return _aligned(tokens, batch.column("doc_id"), a, b)

    return run


def _aligned(tokens: Tokens, doc_id: pa.Array, a: pa.ListArray, b: pa.ListArray) -> tuple[dict, dict]:
    rows = len(doc_id)
    found = links(tokens.a_bytes, tokens.b_bytes, a, b)
    a_ids, b_ids = pc.list_flatten(a).to_numpy(), pc.list_flatten(b).to_numpy()
    i, j, both = found["i"].to_numpy(), found["j"].to_numpy(), found["both"].to_numpy()
    doc = pc.shift_right(found["key"], _END_BITS).to_numpy()
    pair = (a_ids[i] << _PAIR_BITS) | b_ids[j]
    per_doc = pa.table({"doc": doc, "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    holding = per_doc.group_by("pair", use_threads=False).aggregate([([], "count_all")])
    dictionary = holding["pair"].combine_chunks()
    places = pc.index_in(per_doc["pair"], value_set=dictionary).to_numpy()
    order = np.argsort(per_doc["doc"].to_numpy(), kind="stable")
    counts = np.bincount(per_doc["doc"].to_numpy(), minlength=rows)
    documents = {
        "doc_id": doc_id, "n_a": pc.list_value_length(a).cast(pa.int64()), "n_b": pc.list_value_length(b).cast(pa.int64()),
        "n_groups": np.bincount(doc[both], minlength=rows), "n_links": np.bincount(doc, minlength=rows),
        "groups_sha256": _digests(tokens, a, b, a_ids, b_ids, i[both], j[both]),
        "places": _lists(places[order].astype(np.int32), counts),
        "times": _lists(per_doc["count_all"].to_numpy()[order].astype(np.int32), counts),
    }
    entries = {"place": np.arange(len(dictionary), dtype=np.int32), "pair": dictionary, "n": holding["count_all"].combine_chunks()}
    return documents, entries


def _digests(
    tokens: Tokens, a: pa.ListArray, b: pa.ListArray, a_ids: np.ndarray, b_ids: np.ndarray, last_a: np.ndarray, last_b: np.ndarray
) -> pa.Array:
    """Digest of each document's groups; ``last_a`` and ``last_b`` are the flat places of the last tokens of all groups."""
    n, m = len(tokens.a_bytes), len(tokens.b_bytes)
    i, j = np.arange(len(a_ids)), np.arange(len(b_ids))
    # The ids of a group stand after all ids of the groups before it, those of the second side after those of the first.
    before = np.concatenate(([0], last_b + 1))[np.searchsorted(last_a, i)]
    ahead = (last_a + 1)[np.searchsorted(last_b, j)] if len(j) else j
    marks = np.zeros(len(i) + len(j), np.int64)
    marks[i + before] = a_ids
    marks[j + ahead] = 2 * n + b_ids
    marks[(i + before)[last_a]] += n
    marks[(j + ahead)[last_b]] += m
    data, at = _joined(tokens.digits, marks)
    text = memoryview(data)
    first = at[np.concatenate(([0], np.cumsum(pc.add(pc.list_value_length(a), pc.list_value_length(b)).to_numpy())))]
    # Without the mark after the last group.
    spans = zip(first[:-1].tolist(), first[1:].tolist(), strict=True)
    return pa.array(["" if end == begin else hashlib.sha256(text[begin : end - 1]).hexdigest() for begin, end in spans], pa.string())


def encoded(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Documents with their links by pair, and each chunk's pairs with the number of its documents that hold them."""
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return chunked(picked, lambda: _encoder(folder or tokenizer_folder()), _DOCUMENT, _ENTRY)


def counted(chunks: DataFrame) -> DataFrame:
    """Each linked id pair with the number of documents that hold it, and whether none of its first id's pairs has more."""
    first = F.shiftright("pair", _PAIR_BITS).alias("a")
    counts = written(chunks.where(F.col("kind") == ENTRY).groupBy("pair").agg(F.sum("n").alias("count")), "pairs")
    # One row per entry of the first vocabulary.
    highest = F.broadcast(counts.groupBy(first).agg(F.max("count").alias("highest")))
    return counts.select("pair", "count", first).join(highest, "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def summed(chunks: DataFrame, counts: DataFrame) -> DataFrame:
    """The result rows, from each chunk next to the corpus-wide counts of its pairs."""
    entries = chunks.where(F.col("kind") == ENTRY).select("chunk", "place", "pair")
    known = entries.join(counts, "pair").select("chunk", F.lit(KNOWN).alias("kind"), "place", "count", "best")
    documents = chunks.where(F.col("kind") == DOCUMENT).drop("place", "pair", "n")

    def run(tables: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            docs, found = of_kind(table, DOCUMENT), of_kind(table, KNOWN)
            order = np.argsort(column(found, "place").to_numpy())
            count = column(found, "count").to_numpy()[order]
            best = column(found, "best").to_numpy(zero_copy_only=False)[order].astype(bool)
            lists = column(docs, "places")
            places, times = lists.flatten().to_numpy(), column(docs, "times").flatten().to_numpy().astype(np.int64)
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
            sums = [np.diff(np.concatenate(([0], np.cumsum(x)))[ends]) for x in (times * best[places], times * count[places])]
            own = {c: column(docs, c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
            every = own | {"n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1]), "groups_sha256": column(docs, "groups_sha256")}
            yield pa.RecordBatch.from_arrays(list(every.values()), list(every))

    return by_chunk(documents.unionByName(known, allowMissingColumns=True), run, _RESULT)


def align(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    chunks = written(encoded(docs, folder), "links")
    return summed(chunks, written(counted(chunks), "counts"))
