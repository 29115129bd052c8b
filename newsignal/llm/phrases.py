"""Mining of phrase collocations with stripes (operator 12).

A stripe holds, for one prefix of words, how often each next word follows.  Stripes of a
slice of texts are built in the task, merged element by element over the corpus, and give
the counts of all extensions, the total of the prefix and the most frequent extension.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from newsignal.llm import common, hashing

# Fixed values of the contract: what ends a piece, and white space inside one.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
NO_LANG = "und"
SLICE = 8 << 20  # bytes of text whose stripes are built together
HOT_SHARE = 4096  # a prefix with more than this part of all words has its stripe cut up
PARTS = 64
FILTER_BITS = 1 << 26
END = 0  # next word of a prefix that ends its piece
IS_BREAK, IS_BLANK = np.zeros(256, bool), np.zeros(256, bool)
IS_BREAK[list(BREAKS)] = True
IS_BLANK[list(BLANKS)] = True


class PieceWords:
    """The words of a slice: codes, languages, and which of them go on in the same piece of text."""

    def __init__(self, batch: pa.RecordBatch):
        raw, offsets = hashing.column_bytes(batch.column("text"))
        raw = np.where((raw >= 65) & (raw <= 90), raw | 32, raw)
        breaks = IS_BREAK[raw]
        word = ~(breaks | IS_BLANK[raw])
        # A text's first byte begins a piece.
        edges = np.zeros(len(raw) + 1, bool)
        edges[offsets[:-1]] = True
        edges = edges[:-1]
        begins = word & edges
        begins[1:] |= word[1:] & ~word[:-1]
        stops = word.copy()
        stops[:-1] &= ~word[1:] | edges[1:]
        start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        piece = np.cumsum(breaks | edges, dtype=np.int32)[start]
        document = np.searchsorted(offsets, start, side="right").astype(np.int32)
        self.joined = piece[1:] == piece[:-1]
        self.codes, self.words = hashing.distinct(raw, start, end)
        langs = batch.column("lang").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy(zero_copy_only=False)[document - 1]
        # Each word of each language becomes one number, its key a hash of both.
        self.pairs, self.codes = np.unique(
            self.lang.astype(np.int64) * max(len(self.words), 1) + self.codes, return_inverse=True
        )

    def names(self) -> list[tuple[str, bytes]]:
        n = max(len(self.words), 1)
        return [(self.langs[p // n], self.words[p % n]) for p in self.pairs.tolist()]


def word_key(lang: str, word: bytes, seed: int) -> int:
    """A signed 64-bit key, never END."""
    h = xxhash.xxh3_64_intdigest(lang.encode() + b"\0" + word, seed)
    return (h or 1) - ((h >> 63) << 64)


def word_keys(words: PieceWords, seed: int) -> np.ndarray:
    """The keys of ``words.names()``; no method, since a worker keeps the first class that it was sent."""
    return np.fromiter((word_key(lang, word, seed) for lang, word in words.names()), np.int64, len(words.pairs))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined and cut to slices of about SLICE bytes of text."""
    held, size = [], 0
    for batch in batches:
        for part in common.slices(batch, limit=SLICE):
            n = part.column("text").nbytes
            if held and size + n > SLICE:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            if len(part):
                held.append(part)
                size += n
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), common.text_of().alias("text")
    )


def vocabulary(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The stripe of the empty prefix: key, lang, word, n, written once.

    Keys are 64-bit hashes of language and word; ``collides`` tells whether two share one.
    """
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = PieceWords(batch)
            names = words.names()
            n = np.bincount(words.codes, minlength=len(names))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(word_keys(words, seed)), pa.array([x[0] for x in names], pa.string()),
                    pa.array([x[1] for x in names], pa.binary()), pa.array(n),
                ],
                names=["key", "lang", "word", "n"],
            )

    each = texts(docs).mapInArrow(counts, "key long, lang string, word binary, n long")
    found = each.groupBy("key", "lang", "word").agg(F.sum("n").alias("n"))
    return common.written(found.withColumn("word", F.col("word").cast("string")), "vocabulary")


def collides(words: DataFrame) -> bool:
    other = F.xxhash64("lang", "word")
    twice = words.groupBy("key").agg(F.min(other).alias("low"), F.max(other).alias("high"))
    return not twice.filter("low < high").isEmpty()


def spread(*keys: np.ndarray) -> np.ndarray:
    """One well mixed number from the keys of a phrase."""
    out = np.zeros(len(keys[0]), np.uint64)
    for k in keys:
        out = hashing.mix(out * hashing.U64(hashing.STEP) + k.view(np.uint64))
    return out


class PhraseFilter:
    """A bit for the hash of each frequent phrase, in a table of FILTER_BITS whatever the corpus.

    A phrase whose bit is off is not frequent; one whose bit is on may be.
    """

    def __init__(self, phrases: DataFrame, columns: list[str], bits: int = FILTER_BITS):
        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = spread(*[batch.column(c).to_numpy() for c in columns]) & hashing.U64(bits - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((at >> hashing.U64(6)).astype(np.int64)),
                     pa.array((hashing.U64(1) << (at & hashing.U64(63))).view(np.int64))],
                    names=["slot", "bit"],
                )

        rows = phrases.select(*columns).mapInArrow(places, "slot long, bit long")
        found = rows.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
        self.bits = bits
        self.table = np.zeros(bits // 64, np.int64)
        self.table[found.column("slot").to_numpy()] = found.column("bits").to_numpy()

    def may_hold(self, *keys: np.ndarray) -> np.ndarray:
        at = spread(*keys) & hashing.U64(self.bits - 1)
        word = self.table[(at >> hashing.U64(6)).astype(np.int64)].view(np.uint64)
        return (word >> (at & hashing.U64(63))) & hashing.U64(1) == 1


def prefix_columns(k: int) -> list[str]:
    return [f"w{i + 1}" for i in range(k)]


def slice_stripes(words: PieceWords, seed: int, k: int, frequent: PhraseFilter | None, hot: np.ndarray):
    """The stripes of one slice for prefixes of k words.

    Yields arrays of the prefix keys (one per stripe), its part, the next keys and counts
    of all stripes, and the stripes' offsets in them.  Without a filter every occurrence of
    the prefix counts, those at the end of a piece with END as their next word.  With one,
    only extensions whose first and last k words may be frequent count.
    """
    keys = word_keys(words, seed)
    n = max(len(words.codes) - k + 1, 0)
    run = np.ones(n, bool)  # k words in one piece from here on
    for i in range(k - 1):
        run &= words.joined[i : i + n]
    at = np.flatnonzero(run)
    goes_on = np.append(words.joined, False)[at + k - 1]
    if frequent is not None:
        at = at[goes_on]
        columns = [keys[words.codes[at + i]] for i in range(k + 1)]
        may = frequent.may_hold(*columns[:-1]) & frequent.may_hold(*columns[1:])
        at, goes_on = at[may], goes_on[goes_on][may]
    codes = [words.codes[at + i] for i in range(k)]
    after = np.where(goes_on, words.codes[np.minimum(at + k, len(words.codes) - 1)] + 1, 0)
    # Equal prefixes get one number, equal (prefix, next) pairs one entry.
    number = codes[0].astype(np.int64)
    for c in codes[1:]:
        _, number = np.unique(number * (len(keys) + 1) + c, return_inverse=True)
    pair, first, counts = np.unique(number * (len(keys) + 1) + after, return_index=True, return_counts=True)
    prefixes = [keys[c[first]] for c in codes]
    next_key = np.append(END, keys)[after[first]]
    whole = spread(*prefixes).view(np.int64)
    part = np.where(np.isin(whole, hot), (next_key & (PARTS - 1)).astype(np.int8), np.int8(0))
    order = np.lexsort((part, pair // (len(keys) + 1)))
    number, part = (pair // (len(keys) + 1))[order], part[order]
    new = np.ones(len(order), bool)
    new[1:] = (number[1:] != number[:-1]) | (part[1:] != part[:-1])
    heads = np.flatnonzero(new)
    return (
        [p[order][heads] for p in prefixes], part[heads], next_key[order], counts[order],
        np.append(heads, len(order)),
    )


def lists(offsets: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def merged_stripes(
    docs: DataFrame, seed: int, k: int, least: int, frequent: PhraseFilter | None, hot: np.ndarray,
) -> DataFrame:
    """Stripes of the corpus for prefixes of k words: w1..wk, part, total, nexts, counts.

    Only extensions of ``least`` occurrences or more stay in nexts; total counts all.  A
    stripe of a hot prefix comes in PARTS parts by next word, so no task gets all of it.
    Stripes of a prefix arrive in order, spilled where needed, and are merged in passing.
    """
    names = prefix_columns(k)
    heads = ", ".join(f"{c} long" for c in names) + ", part byte"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prefixes, part, nexts, counts, offsets = slice_stripes(PieceWords(batch), seed, k, frequent, hot)
            for i in range(0, len(part), 1 << 16):
                own = offsets[i : i + (1 << 16) + 1]
                inside = slice(own[0], own[-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p[i : i + (1 << 16)]) for p in prefixes] + [pa.array(part[i : i + (1 << 16)])]
                    + [lists(own - own[0], nexts[inside]), lists(own - own[0], counts[inside].astype(np.int32))],
                    names=[*names, "part", "nexts", "counts"],
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last prefix of a batch may go on in the next one
        for batch in batches:
            stripes = entries(batch, names)
            if rest is not None:
                stripes = tuple(np.concatenate(x) for x in zip(rest, stripes))
            if not len(stripes[0]):
                rest = stripes
                continue
            heads, nexts, counts = summed(*stripes)
            last = np.flatnonzero((heads != heads[-1]).any(axis=1))
            cut = last[-1] + 1 if len(last) else 0
            rest = heads[cut:], nexts[cut:], counts[cut:]
            if cut:
                yield as_rows(heads[:cut], nexts[:cut], counts[:cut], names, least)
        if rest is not None and len(rest[0]):
            yield as_rows(*rest, names, least)

    stripes = texts(docs).mapInArrow(build, f"{heads}, nexts array<long>, counts array<int>")
    together = stripes.repartition(*names, "part").sortWithinPartitions(*names, "part")
    return together.mapInArrow(merge, f"{heads}, total long, nexts array<long>, counts array<long>")


def entries(batch: pa.RecordBatch, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries of a batch of stripes: (prefix and part), next word, count."""
    sizes = np.diff(batch.column("nexts").offsets.to_numpy())
    heads = np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in [*names, "part"]])
    return (
        np.repeat(heads, sizes, axis=0), batch.column("nexts").flatten().to_numpy(),
        batch.column("counts").flatten().to_numpy().astype(np.int64),
    )


def summed(heads: np.ndarray, nexts: np.ndarray, counts: np.ndarray):
    """Entries in the order of their stripes with equal ones added up.

    Equal heads stand side by side, so their running number takes the place of the head.
    """
    number = np.append(0, np.cumsum((heads[1:] != heads[:-1]).any(axis=1)))
    order = np.lexsort((nexts, number))
    number, nexts = number[order], nexts[order]
    new = np.ones(len(order), bool)
    new[1:] = (number[1:] != number[:-1]) | (nexts[1:] != nexts[:-1])
    first = np.flatnonzero(new)
    return heads[order[first]], nexts[first], np.add.reduceat(counts[order], first)


def as_rows(heads, nexts, counts, names: list[str], least: int) -> pa.RecordBatch:
    new = np.append(True, (heads[1:] != heads[:-1]).any(axis=1))
    first = np.flatnonzero(new)
    totals = np.add.reduceat(counts, first)
    kept = (counts >= least) & (nexts != END)
    offsets = np.append(0, np.cumsum(np.add.reduceat(kept.astype(np.int64), first)))
    # Stripes that keep no extension are of no use beyond their total.
    used = np.diff(offsets) > 0
    return pa.RecordBatch.from_arrays(
        [pa.array(heads[first[used], i]) for i in range(len(names))]
        + [pa.array(heads[first[used], -1].astype(np.int8)), pa.array(totals[used])]
        + [lists(np.append(0, np.cumsum(np.diff(offsets)[used])), x[kept]) for x in (nexts, counts)],
        names=[*names, "part", "total", "nexts", "counts"],
    )


def exact_score(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 a a / (l r)) in decimals of 38 digits, exact for counts below 10**16."""
    wide = [x.cast("decimal(16,0)").cast("decimal(38,0)") for x in (a, l, r)]
    return F.call_function("div", wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(38,0)"), wide[1] * wide[2])


def with_cuts(phrases: DataFrame, counts: dict[int, DataFrame], m: int) -> DataFrame:
    """Adds l, r and score of the lowest-scoring cut of phrases of m words."""
    names = prefix_columns(m)
    for k in range(1, m):
        for side, part in (("l", names[:k]), ("r", names[k:])):
            found = counts[len(part)].select(
                *[F.col(c).alias(f"_{c}") for c in prefix_columns(len(part))], F.col("a").alias(f"{side}{k}")
            )
            same = [phrases[c] == found[f"_{p}"] for c, p in zip(part, prefix_columns(len(part)))]
            phrases = phrases.join(found, same).drop(*[f"_{p}" for p in prefix_columns(len(part))])
    cuts = [
        F.struct(exact_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"),
                 F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
        for k in range(1, m)
    ]
    lowest = phrases.withColumn("cut", F.array_min(F.array(*cuts)))
    return lowest.select(*names, "a", "cut.l", "cut.r", "cut.score")


def not_subsumed(phrases: DataFrame, longer: DataFrame, m: int, percent: int) -> DataFrame:
    """Phrases of m words that no frequent phrase of m + 1 words holds in ``percent`` of their places.

    Longer ones need no look: none is more frequent than what it holds of m + 1 words.
    """
    names, more = prefix_columns(m), prefix_columns(m + 1)
    most = longer.select(*more[:-1], "a").unionByName(
        longer.select(*[F.col(b).alias(a) for a, b in zip(names, more[1:])], "a")
    ).groupBy(*names).agg(F.max("a").alias("most"))
    joined = phrases.join(most, names, "left")
    return joined.filter(F.coalesce(100 * F.col("most") < percent * F.col("a"), F.lit(True))).drop("most")


def collocations(
    docs: DataFrame, min_count: int = 10, max_words: int = 3, subsumed_percent: int = 50, top: int = 2000,
    filter_bits: int = FILTER_BITS, hot_share: int = HOT_SHARE,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Phrases of two to ``max_words`` words with ``min_count`` or more occurrences, scored by
    their lowest-scoring cut; those that a longer frequent phrase holds in
    ``subsumed_percent`` of their places go.  A null language is NO_LANG, a null text is
    empty; rows count as often as they stand there, whatever their ids and other columns.
    Counts are exact: keys of words are checked for collisions, phrases are compared by the
    keys of all their words, and the filter of frequent phrases only lets too many pass.
    """
    seed = 0
    words = vocabulary(docs, seed)
    while collides(words):
        seed += 1
        words = vocabulary(docs, seed)
    per_lang = words.groupBy("lang").agg(F.sum("n").alias("n"))
    total = words.agg(F.sum("n")).first()[0] or 0
    frequent = words.filter(F.col("n") >= min_count)
    counts = {1: frequent.select(F.col("key").alias("w1"), F.col("n").alias("a"))}
    found, passed = {}, None
    for k in range(1, max_words):
        names = prefix_columns(k)
        # No more than hot_share prefixes can hold more than that part of all words each.
        often = counts[k].filter(F.col("a") * hot_share > total).select(*names).toArrow()
        hot = spread(*[often.column(c).to_numpy() for c in names]).view(np.int64)
        stripes = merged_stripes(docs, seed, k, min_count, passed, hot)
        extended = stripes.select(*names, F.explode(F.arrays_zip("nexts", "counts")).alias("e")).select(
            *names, F.col("e.nexts").alias(f"w{k + 1}"), F.col("e.counts").alias("a")
        )
        counts[k + 1] = common.written(extended, f"phrases-{k + 1}")
        if k + 1 < max_words:
            passed = PhraseFilter(counts[k + 1], prefix_columns(k + 1), filter_bits)
    spelled = frequent.select("key", "word")
    for m in range(2, max_words + 1):
        phrases = with_cuts(counts[m], counts, m)
        if m < max_words:
            phrases = not_subsumed(phrases, counts[m + 1], m, subsumed_percent)
        for i, c in enumerate(prefix_columns(m)):
            own = [F.col("key").alias("_key"), F.col("word").alias(f"x{i + 1}")]
            names = spelled.select(*own) if i else frequent.select(*own, "lang")
            phrases = phrases.join(names, phrases[c] == names["_key"]).drop("_key")
        found[m] = phrases.select(
            "lang", F.concat_ws(" ", *[f"x{i + 1}" for i in range(m)]).alias("phrase"), "a", "l", "r", "score"
        )
    every = found[2]
    for m in range(3, max_words + 1):
        every = every.unionByName(found[m])
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(per_lang, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
