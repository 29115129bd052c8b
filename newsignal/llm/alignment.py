"""Alignment of two tokenizers by products of sparse incidence matrices (operator 13)."""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsignal.llm import common
from newsignal.llm.packing import byte_symbols

PRODUCTS = 1 << 20  # products of two entries that are held at once
CACHED_SEGMENTS = 500_000
CACHED_CHARS = 16 << 20
SPACE_MARK = "▁"
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
MARKS = r"\[\].,!?;:&$#%*|\"()<>=@"
CUT = re.compile(rf"[ \n]*[{LETTERS}]+(?=[{MARKS} \n]|\Z)|[ \n]*[^ \n]+|[ \n]+")
ODD_SPACE = re.compile(r"[^\S \n]")
CAREFUL_CUT = re.compile(r".+?(?:(?<=\S)(?=[ \n])|\Z)", re.DOTALL)


class Csr(NamedTuple):
    """A 0/1 matrix in compressed sparse rows."""

    starts: np.ndarray
    columns: np.ndarray
    width: int

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        counts = np.bincount(self.columns, minlength=self.width)
        order = np.argsort(self.columns, kind="stable")
        return Csr(np.append(0, np.cumsum(counts)), rows[order], len(self.starts) - 1)


def row_products(a: Csr, b: Csr, limit: int = PRODUCTS) -> Iterator[tuple[np.ndarray, ...]]:
    """The entries (row, column, value) of a·b, by Gustavson's rule.

    Row i is the sum of the rows of b that row i of a names.  Comes in blocks of rows with
    about ``limit`` products, or of one row with more.
    """
    sizes = np.diff(b.starts)[a.columns]
    before = np.append(0, np.cumsum(sizes))[a.starts]
    row, rows = 0, len(a.starts) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(before, before[row] + limit, side="right")) - 1)
        entries = slice(a.starts[row], a.starts[end])
        part = sizes[entries]
        left = np.repeat(np.repeat(np.arange(row, end), np.diff(a.starts[row : end + 1])), part)
        at = np.repeat(b.starts[a.columns[entries]] - (np.cumsum(part) - part), part)
        right = b.columns[at + np.arange(len(at))]
        keys, values = np.unique(left * b.width + right, return_counts=True)
        yield keys // b.width, keys % b.width, values
        row = end


def token_bytes(ends: np.ndarray) -> Csr:
    """Incidence of tokens and the bytes they cover, from the byte ends of the tokens."""
    n = int(ends[-1]) if len(ends) else 0
    return Csr(np.append(0, ends), np.arange(n), n)


def token_groups(ends: np.ndarray, borders: np.ndarray) -> Csr:
    """Incidence of tokens and the groups between ``borders``; each token lies in one."""
    return Csr(np.arange(len(ends) + 1), np.searchsorted(borders, ends), len(borders))


def overlap_links(a_ends: np.ndarray, b_ends: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(A token, B token, bytes that both cover) of two token sequences over the same bytes."""
    return row_products(token_bytes(a_ends), token_bytes(b_ends).transposed())


def group_links(a_ends: np.ndarray, b_ends: np.ndarray, borders: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(A token, B token, 1) of all pairs that share a group.

    Their number grows with the square of a group; ``group_link_counts`` only counts them.
    """
    return row_products(token_groups(a_ends, borders), token_groups(b_ends, borders).transposed())


def group_link_counts(a_ends: np.ndarray, b_ends: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """For each A token the entries of its row in that product, which is one row of the right side."""
    a, b = token_groups(a_ends, borders), token_groups(b_ends, borders).transposed()
    return np.diff(b.starts)[a.columns]


class Vocabularies:
    """The tokenizers A (byte-level BPE, ``tokenizers``) and B (``sentencepiece``), cut at borders of both.

    A segment begins at white space, or at a mark behind a letter.  No token of A or B
    reaches over such a border: A's words end there, and no piece of B holds a line feed,
    or its space mark behind another character, or a mark behind a letter.  So the tokens
    of a text are those of its segments in a row, and each segment of a worker's cache is
    encoded and aligned once.  Vocabularies without these borders get whole texts.
    """

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        symbols = byte_symbols()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        with open(a_path, encoding="utf-8") as f:
            split = json.load(f).get("pre_tokenizer") or {}
        def special(i: int) -> bool:
            return self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i)

        crossing = re.compile(f"[^{SPACE_MARK}]{SPACE_MARK}|\n|[{LETTERS}][{MARKS}]")
        self.separable = (
            split.get("type") == "ByteLevel" and bool(split.get("use_regex")) and not split.get("add_prefix_space")
            and not any(crossing.search(p) for i, p in enumerate(pieces) if not special(i))
        )
        self.mark, self.feed = self.b.piece_to_id(SPACE_MARK), self.b.encode("\n")
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)

    def cut(self, text: str) -> list[str]:
        if not self.separable:
            return [text]
        return (CAREFUL_CUT if ODD_SPACE.search(text) else CUT).findall(text)

    def encode(self, segments: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each segment in A and B.

        B puts a space before a text by itself; other segments follow a line feed, whose
        tokens are taken away.
        """
        a = [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        b = self.b.encode([s[1:] if s[0] == " " else "\n" + s for s in segments], num_threads=1)
        for i, s in enumerate(segments):
            if s == " ":
                b[i] = [self.mark]
            elif s[0] != " ":
                b[i] = b[i][len(self.feed) :]
        return a, b

    def pair_bound(self) -> int:
        """Most pairs of ids that can end together: one's bytes end with the other's."""
        def held(shorter: list[bytes], longer: list[bytes], least: int) -> int:
            known: dict[bytes, int] = {}
            for x in shorter:
                known[x] = known.get(x, 0) + 1
            return sum(known.get(x[i:], 0) for x in longer for i in range(least, len(x)))

        return held(self.b_bytes, self.a_bytes, 0) + held(self.a_bytes, self.b_bytes, 1)


class Segments:
    """Aligned segments of a worker: token and link counts, groups as text, linked id pairs."""

    def __init__(self, vocabularies: Vocabularies):
        self.v = vocabularies
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        # Tokens of A, tokens of B, groups, overlap links, group links, linked pairs, 1 if bytes differ.
        self.counts = np.zeros((0, 7), np.int64)
        self.pairs = np.zeros(0, np.int32)
        self.chars = 0

    def learn(self, segments: list[str]) -> None:
        a_ids, b_ids = self.v.encode(segments)
        equal = [
            b"".join(map(self.v.a_bytes.__getitem__, a)) == (raw := s.encode())
            and b"".join(map(self.v.b_bytes.__getitem__, b)) == raw
            for s, a, b in zip(segments, a_ids, b_ids)
        ]
        a_ids = [a if e else [] for a, e in zip(a_ids, equal)]
        b_ids = [b if e else [] for b, e in zip(b_ids, equal)]
        n_a, n_b = np.array(list(map(len, a_ids))), np.array(list(map(len, b_ids)))
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a_ids, b_ids))
        a_ends, b_ends = np.cumsum(self.v.a_sizes[a]), np.cumsum(self.v.b_sizes[b])
        a_owner = np.repeat(np.arange(len(segments)), n_a)

        def per_segment(rows: np.ndarray) -> np.ndarray:
            return np.bincount(a_owner[rows], minlength=len(segments))

        overlaps, ends_a, ends_b = np.zeros(len(segments), np.int64), [], []
        for rows, columns, _ in overlap_links(a_ends, b_ends):
            overlaps += per_segment(rows)
            together = a_ends[rows] == b_ends[columns]
            ends_a.append(rows[together])
            ends_b.append(columns[together])
        ends_a, ends_b = np.concatenate(ends_a or [a[:0]]), np.concatenate(ends_b or [b[:0]])
        borders = np.unique(a_ends[ends_a])
        in_groups = np.bincount(
            a_owner, weights=group_link_counts(a_ends, b_ends, borders), minlength=len(segments)
        ).astype(np.int64)
        first = borders if not len(borders) else np.append(0, borders[:-1])
        n_groups = np.bincount(a_owner[np.searchsorted(a_ends, first, side="right")], minlength=len(segments))
        self.groups += self.as_text(a, b, a_ends, b_ends, borders, n_groups)
        fresh = np.column_stack(
            [n_a, n_b, n_groups, overlaps, in_groups, per_segment(ends_a), ~np.array(equal, bool)]
        )
        self.counts = np.concatenate([self.counts, fresh.astype(np.int64)])
        pairs = a[ends_a] * len(self.v.b_bytes) + b[ends_b]
        self.pairs = np.concatenate([self.pairs, pairs.astype(np.int32)])
        self.ends = np.cumsum(self.counts[:, 5])
        for s in segments:
            self.index[s] = len(self.index)
            self.chars += len(s)

    @staticmethod
    def as_text(a, b, a_ends, b_ends, borders, n_groups) -> list[str]:
        """``a1,a2|b1;...`` of each segment."""
        a_words, b_words = list(map(str, a.tolist())), list(map(str, b.tolist()))
        a_to = np.searchsorted(a_ends, borders, side="right").tolist()
        b_to = np.searchsorted(b_ends, borders, side="right").tolist()
        groups = [
            ",".join(a_words[i:j]) + "|" + ",".join(b_words[k:m])
            for i, j, k, m in zip([0, *a_to], a_to, [0, *b_to], b_to)
        ]
        to = np.cumsum(n_groups).tolist()
        return [";".join(groups[i:j]) for i, j in zip([0, *to], to)]

    def find(self, segments: list[str]) -> list[int]:
        found = list(map(self.index.get, segments))
        if None not in found:
            return found
        new = list(dict.fromkeys(s for s, i in zip(segments, found) if i is None))
        if len(self.index) + len(new) > CACHED_SEGMENTS or self.chars > CACHED_CHARS:
            self.clear()
            new = list(dict.fromkeys(segments))
        self.learn(new)
        return list(map(self.index.__getitem__, segments))

    def align(self, texts: list[str | None]):
        """Per text: counts (as above), groups digest, and its different id pairs with their numbers."""
        cut = [self.v.cut(" " + t) if t else [] for t in texts]
        sizes = np.array(list(map(len, cut)), np.int64)
        found = self.find(list(chain.from_iterable(cut))) if sizes.any() else []
        at, owner = np.array(found, np.int64), np.repeat(np.arange(len(texts)), sizes)
        counts = np.column_stack([
            np.bincount(owner, weights=self.counts[at, k], minlength=len(texts)) for k in range(7)
        ]).astype(np.int64)
        whole = counts[:, 6] == 0
        counts[~whole] = 0
        ends = np.cumsum(sizes).tolist()
        digests = [
            hashlib.sha256(";".join(map(self.groups.__getitem__, found[i:j])).encode()).hexdigest() if i < j and ok else ""
            for i, j, ok in zip([0, *ends], ends, whole.tolist())
        ]
        kept = whole[owner]
        at, owner = at[kept], owner[kept]
        n = self.counts[at, 5]
        shift = np.repeat(self.ends[at] - np.cumsum(n), n) if len(at) else np.zeros(0, np.int64)
        pairs = self.pairs[shift + np.arange(len(shift))].astype(np.int64)
        keys, numbers = np.unique((np.repeat(owner, n) << 32) | pairs, return_counts=True)
        offsets = np.searchsorted(keys >> 32, np.arange(len(texts) + 1))
        return counts, digests, offsets, keys & ((1 << 32) - 1), numbers


@functools.cache
def segments_of(a_path: str, b_path: str) -> Segments:
    return Segments(Vocabularies(a_path, b_path))


COUNTS = ("n_a", "n_b", "n_groups", "n_overlap_links", "n_group_links", "n_links")


def aligned_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Each document's tokens of A (of a space and the text) against those of B.

    Returns doc_id, the counts of COUNTS, groups_sha256, pairs (A id times the number of
    B ids plus B id, of tokens that end together, each once) and numbers (how often).  A
    text that is null, empty or not given back by both tokenizers has zeros, '' and no
    pairs.  Rows are independent: equal ones, null ids and other columns change nothing.
    """
    schema = (
        "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
        + ", groups_sha256 string, pairs array<int>, numbers array<int>"
    )

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = segments_of(a_path, b_path)
        for whole in batches:
            for batch in common.slices(whole):
                counts, digests, offsets, pairs, numbers = segments.align(batch.column("text").to_pylist())
                lists = [
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x.astype(np.int32)))
                    for x in (pairs, numbers)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64())]
                    + [pa.array(counts[:, k]) for k in range(len(COUNTS))]
                    + [pa.array(digests, pa.string()), *lists],
                    names=["doc_id", *COUNTS, "groups_sha256", "pairs", "numbers"],
                )

    return docs.select("doc_id", "text").mapInArrow(align, schema)


def pair_counts(aligned: DataFrame, b_ids: int) -> DataFrame:
    """The links of the corpus by id pair: pair, a_id, b_id, n_links."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "numbers")).alias("p"))
    sums = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum(F.col("p.numbers").cast("long")).alias("n_links"))
    return sums.select(
        "pair", (F.col("pair") / b_ids).cast("int").alias("a_id"), (F.col("pair") % b_ids).alias("b_id"), "n_links"
    )


def linked_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``aligned_documents`` with n_best and count_sum in place of the pairs.

    count_sum adds, over the document's links, how many links of the corpus join the same
    two ids; n_best counts the links whose pair is the most frequent one of its B id.
    Documents are tokenised once and never shuffled.  The pair counts are bounded by the
    vocabularies (``pair_bound``), whatever the corpus, so they go to every task.
    """
    v = Vocabularies(a_path, b_path)
    aligned = common.written(aligned_documents(docs, a_path, b_path), "aligned")
    counts = common.written(pair_counts(aligned, len(v.b_bytes)), "pair-counts")
    found = counts.toArrow()
    if found.num_rows > v.pair_bound():
        raise ValueError(f"{found.num_rows} pairs are more than two vocabularies can have")
    order = np.argsort(found.column("pair").to_numpy())
    known, links, b_ids = (found.column(c).to_numpy()[order] for c in ("pair", "n_links", "b_id"))
    most = np.zeros(len(v.b_bytes), np.int64)
    np.maximum.at(most, b_ids, links)
    best = links == most[b_ids]
    schema = (
        "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", n_best long, count_sum long, groups_sha256 string"
    )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, numbers = batch.column("pairs"), batch.column("numbers").flatten().to_numpy()
            owner = pairs.value_parent_indices().to_numpy()
            at = np.searchsorted(known, pairs.flatten().to_numpy())
            sums = np.zeros((2, len(batch)), np.int64)
            np.add.at(sums[0], owner, best[at] * numbers.astype(np.int64))
            np.add.at(sums[1], owner, links[at] * numbers)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", *COUNTS)]
                + [pa.array(sums[0]), pa.array(sums[1]), batch.column("groups_sha256")],
                names=["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"],
            )

    return aligned.mapInArrow(summed, schema)
