"""Packing of tokenised documents into sequences by best-two-fit (operator 9)."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from newsignal.llm import common

SEQUENCE = 4096
END_ID = 1
POOL = 65_536  # pieces that one task packs together
CACHED_WORDS = 400_000
# Fixed value: the word pattern of the vocabulary file.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
END_OF_WORD = "</w>"
# A control character stands for the end of a word; words that hold one go to the tokenizer.
MARK = "\x1f"


def byte_symbols() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordIds(dict):
    """Token ids, as little-endian 32-bit integers, of the words met so far.

    The tokenizer splits at white space before anything else, so the ids of a text are
    those of its words in a row.  Words of Latin letters and marks are encoded from the
    vocabulary's ranks, which takes less than half the time, all others by the tokenizer itself.
    """

    def __init__(self, vocabulary: str):
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(vocabulary)
        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)
        symbols, special = byte_symbols(), {t["content"] for t in model["added_tokens"]}
        ranks = {}
        for token, i in model["model"]["vocab"].items():
            if token not in special:
                word = token.removesuffix(END_OF_WORD) if token != END_OF_WORD else token
                mark = MARK.encode() if word != token else b""
                ranks[bytes(symbols[c] for c in word) + mark] = i
        self.ranked = tiktoken.Encoding(
            "words", pat_str=f"[^{MARK}]+{MARK}", mergeable_ranks=ranks, special_tokens={}
        )

    def __missing__(self, word: str) -> bytes:
        if not word:
            ids = []
        elif " " < min(word) and max(word) < "\xff" and "<|" not in word:
            ids = self.ranked.encode_ordinary("".join(piece + MARK for piece in PIECES.findall(word.lower())))
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = out = np.array(ids, "<u4").tobytes()
        return out

    def encode(self, text: str) -> bytes:
        # Only blank and line feed are taken as borders; the tokenizer sees all others.
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def tokenised_pieces(docs: DataFrame, vocabulary: str, sequence: int = SEQUENCE) -> DataFrame:
    """Pieces of at most ``sequence`` tokens: doc_id, piece, start, length, ids_crc32.

    Each document's ids end with END_ID; a null text is empty and gives that id alone.
    Only documents longer than a sequence are cut, into full pieces and a rest.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = WordIds(vocabulary), np.array([END_ID], "<u4").tobytes()
        for whole in batches:
            for batch in common.slices(whole):
                out = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    ids = words.encode(text or "") + end
                    for piece, start in enumerate(range(0, len(ids), 4 * sequence)):
                        part = ids[start : start + 4 * sequence]
                        out.append((doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part)))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
                        *[pa.array(c, pa.int64()) for c in columns[2:]],
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col("doc_id").cast("long"), common.text_of().alias("text")).mapInArrow(cut, schema)


class Pool:
    """Lengths that are not packed yet, with the largest one up to a bound."""

    def __init__(self, lengths: np.ndarray):
        self.counts = np.bincount(lengths).tolist()
        self.present = 0
        for n, count in enumerate(self.counts):
            if count:
                self.present |= 1 << n

    def largest(self, bound: int) -> int:
        """The largest length up to the bound, 0 if there is none."""
        return max((self.present & ((1 << (bound + 1)) - 1)).bit_length() - 1, 0) if bound > 0 else 0

    def take(self, n: int) -> None:
        self.counts[n] -= 1
        if not self.counts[n]:
            self.present ^= 1 << n

    def put(self, n: int) -> None:
        self.counts[n] += 1
        self.present |= 1 << n

    def best_two(self, room: int, more_than: int) -> tuple[int, int]:
        """Two lengths whose sum is largest within ``room``, if above ``more_than``."""
        best, found = more_than, (0, 0)
        a = self.largest(room - 1)
        while a and 2 * a > best and best < room:
            b = self.largest(min(room - a, a))
            if b == a and self.counts[a] < 2:
                b = self.largest(a - 1)
            if b and a + b > best:
                best, found = a + b, (a, b)
            a = self.largest(a - 1)
        return found


def best_two_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of lengths.

    A bin is filled greedily with the largest length that fits.  Where a gap is left, its
    smallest member gives way to two unpacked ones that fill the widened gap better.
    """
    pool, bins = Pool(lengths), []
    while pool.present:
        members, gap = [], capacity
        while n := pool.largest(gap):
            pool.take(n)
            members.append(n)
            gap -= n
        if gap and len(members) > 1:
            smallest = members[-1]
            a, b = pool.best_two(gap + smallest, smallest)
            if a:
                pool.take(a)
                pool.take(b)
                pool.put(smallest)
                members[-1:] = [a, b]
        bins.append(members)
    return bins


def pack_pool(pieces: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Adds sequence (from 0) and offset to the pieces of one pool."""
    lengths = pieces["length"].to_numpy()
    order = np.lexsort((pieces["piece"], pieces["doc_id"], lengths))
    ends = np.searchsorted(lengths[order], np.arange(capacity + 2)).tolist()
    rows, sequences, offsets = [], [], []
    for i, members in enumerate(best_two_fit(lengths, capacity)):
        offset = 0
        for n in members:
            rows.append(order[ends[n]])
            ends[n] += 1
            sequences.append(i)
            offsets.append(offset)
            offset += n
    return pieces.iloc[rows].assign(sequence=sequences, offset=offsets)


def pack(pieces: DataFrame, capacity: int = SEQUENCE, pool: int = POOL) -> DataFrame:
    """Adds sequence_id and offset to pieces with doc_id, piece and length (1 to capacity).

    Pieces are dealt by the hash of doc_id and piece into pools of about ``pool`` pieces,
    which pack independently; a pool wastes at most a few sequences.  Pieces without a
    doc_id are dealt by their place in the input, so they fill no pool of their own.
    """
    pools = max(1, -(-pieces.count() // pool))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = pack_pool(rows, capacity)
        out["sequence_id"] = (key[0] << 32) + out["sequence"]
        return out[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    place = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    dealt = F.pmod(F.xxhash64("doc_id", "piece", "start", place), F.lit(pools))
    return pieces.withColumn("pool", dealt).groupBy("pool").applyInPandas(packed, schema)


def pack_documents(docs: DataFrame, vocabulary: str, sequence: int = SEQUENCE, pool: int = POOL) -> DataFrame:
    """Tokenises, cuts and packs: one row per piece with its place in a sequence.

    Rows that share a doc_id are packed as the separate documents they are.
    """
    pieces = common.written(tokenised_pieces(docs, vocabulary, sequence), "pieces")
    return pack(pieces, sequence, pool)
