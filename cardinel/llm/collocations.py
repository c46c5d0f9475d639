"""Phrases whose words occur together more often than their parts would by chance.

Phrases are counted level by level. A phrase can only be frequent if what is left of it
without its last word, and without its first, is frequent too; such candidates go into a
double-array trie that is broadcast to all tasks. A task advances the states of all text
positions at once, counts the accepting states, and Spark adds the tasks' counts up.

What is broadcast is bounded by `PHRASES` and `CANDIDATES`. Where more candidates are
possible than that (all pairs of frequent words, for one), only those that occur are
counted: positions at which two frequent phrases overlap, found by the trie of these.
Where the frequent phrases themselves are too many for a trie, a sieve of bits takes its
place: what overlaps there is counted as packed word codes. A sieve lets some phrases pass
that are not frequent, which are then counted in vain. Where the frequent words are over
`WORDS`, phrases are counted by a shuffle of all of them as text. The counts are exact and
the same in each way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardinel.llm import double_array
from cardinel.llm.common import lower_ascii, saved
from cardinel.llm.text_arrays import LOWER, mix, pieces

UNKNOWN = "und"
# Bytes of text that are split at once, and word codes that are counted at once.
CHUNK_BYTES = 6_000_000
ROW_CODES = 1 << 16
PASS_CODES = 1 << 19
# Different phrases that a task holds before it hands their counts on.
HELD = 1 << 21
# Occurrences that are gathered before they are added to these.
GATHERED = 1 << 20
# What may be broadcast: frequent words, and in a trie frequent phrases of a length or candidates.
WORDS = 2_000_000
PHRASES = 1_000_000
CANDIDATES = 500_000
# Digits of all words in a trie, which the driver builds in up to 110 bytes for each.
DIGITS = 3_000_000
# A sieve has at least this many bits a phrase, up to 2 ** SIEVE_BITS in all.
PHRASE_BITS = 32
SIEVE_BITS = 28
PART_BITS = 18

PHRASE_SCHEMA = "lang string, words array<string>, f long"
PIECE_ENDS = r"[.,;:!?\x0A-\x0D]"
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?"]] = 2
_KIND[0x0A:0x0E] = 2


def split_words(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of the texts in small letters, and a number that rises with each piece."""
    if len(data) == 0:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64)
    data = LOWER[data]
    kind = _KIND[data]
    inside = kind == 0
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last[:-1] &= ~inside[1:] | cut[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    ends = np.flatnonzero(kind == 2)
    piece = np.searchsorted(ends, start) + np.searchsorted(at, start, "right")
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    letters = np.ascontiguousarray(data[inside])
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(letters))
    return words, piece


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Language, bytes and offsets of runs of texts of one language."""
    langs = pc.fill_null(batch.column(0), UNKNOWN)
    for lang in langs.unique():
        texts = batch.column(1).filter(pc.equal(langs, lang))
        for _, _, data, at in pieces(texts, CHUNK_BYTES, 1 << 20):
            yield lang.as_py(), data, at


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words, and of all words under a null word."""
    for batch in batches:
        for lang, data, at in _by_language(batch):
            words, _ = split_words(data, at)
            found = words.value_counts()
            word = pa.concat_arrays([found.field(0).cast(pa.string()), pa.nulls(1, pa.string())])
            n = pa.concat_arrays([found.field(1), pa.array([len(words)], pa.int64())])
            yield pa.record_batch([pa.repeat(lang, len(n)), word, n], names=["lang", "word", "n"])


@dataclass(frozen=True)
class Vocabulary:
    """Frequent words of each language: a word's code is its place in all of them."""

    first: dict[str, int]
    words: dict[str, pa.Array]

    @staticmethod
    def of(rows: pa.Table) -> Vocabulary:
        first, words, n = {}, {}, 0
        for lang in sorted(rows["lang"].unique().to_pylist()):
            own = rows.filter(pc.equal(rows["lang"], lang))["word"].combine_chunks().cast(pa.large_string())
            first[lang], words[lang] = n, own
            n += len(own)
        return Vocabulary(first, words)

    def __len__(self) -> int:
        return sum(map(len, self.words.values()))

    @property
    def all_words(self) -> pa.Array:
        return pa.concat_arrays([*self.words.values(), pa.array([], pa.large_string())])

    def languages(self, codes: np.ndarray) -> np.ndarray:
        """Number of the language of each code."""
        return np.searchsorted(np.array([*self.first.values(), len(self)]), codes, "right") - 1


def _encode(shared: Broadcast):
    """Texts as word codes: -1 ends a run of frequent words, runs of one word are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = shared.value
        for batch in batches:
            for lang, data, at in _by_language(batch):
                if lang not in vocabulary.first:
                    continue
                words, piece = split_words(data, at)
                known = words.dictionary_encode()
                code = pc.index_in(known.dictionary, value_set=vocabulary.words[lang])
                code = pc.add(code, vocabulary.first[lang]).fill_null(-1).to_numpy(zero_copy_only=False)
                codes = code.astype(np.int32)[known.indices.to_numpy(zero_copy_only=False)]
                rows = _rows(codes, piece)
                if rows:
                    yield pa.record_batch([pa.array(rows, pa.binary())], names=["codes"])

    return run


def _rows(codes: np.ndarray, piece: np.ndarray) -> list[bytes]:
    if len(codes) == 0:
        return []
    turns = np.cumsum(np.diff(piece, prepend=piece[0]) != 0)
    spaced = np.full(len(codes) + int(turns[-1]) + 2, -1, np.int32)
    spaced[1 + np.arange(len(codes)) + turns] = codes
    known = spaced >= 0
    near = np.zeros(len(spaced), bool)
    near[1:] |= known[:-1]
    near[:-1] |= known[1:]
    kept = np.where(known & ~near, np.int32(-1), spaced)
    known = kept >= 0
    known[1:] |= known[:-1].copy()
    kept = kept[known]
    ends = np.flatnonzero(kept < 0) + 1
    if len(ends) == 0:
        return []
    cuts = np.unique(ends[np.minimum(np.searchsorted(ends, np.arange(0, len(kept), ROW_CODES)), len(ends) - 1)])
    cuts = np.unique(np.r_[0, cuts, len(kept)])
    return [kept[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


def _passes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    held, size = [], 0
    for batch in batches:
        for row in batch.column(0):
            own = np.frombuffer(row.as_buffer(), np.int32)
            held.append(own)
            size += len(own)
            if size >= PASS_CODES:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def _key_names(count: int) -> list[str]:
    return [f"key{i}" for i in range(count)]


def _key_schema(count: int) -> str:
    return ", ".join(f"{name} long" for name in [*_key_names(count), "n"])


def _batch(keys: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    names = [*_key_names(len(keys)), "n"]
    for i in range(0, len(counts), PASS_CODES):
        yield pa.record_batch([pa.array(x[i : i + PASS_CODES], pa.int64()) for x in (*keys, counts)], names=names)


def _count_accepted(shared: Broadcast, size: int):
    """How often each candidate of a trie occurs in a task's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, counts = shared.value, np.zeros(size, np.int64)
        for codes in _passes(batches):
            counts += np.bincount(trie.accepted(codes)[1], minlength=size)
        found = np.flatnonzero(counts)
        yield from _batch([found], counts[found])

    return run


def _count_overlaps(shared: Broadcast, length: int, words: int):
    """How often two phrases of a trie overlap in all but a word: number and last word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held, size = shared.value, [], 0
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for codes in _passes(batches):
            number = np.full(len(codes) + 1, -1, np.int64)
            at, found = trie.accepted(codes)
            number[at] = found
            at = at[number[at + 1] >= 0]
            held.append(number[at] * words + codes[at + length])
            size += len(at)
            if size < GATHERED:
                continue
            own, n = np.unique(np.concatenate(held), return_counts=True)
            keys, counts = _added(np.r_[keys, own], np.r_[counts, n])
            held, size = [], 0
            if len(keys) > HELD:
                yield from _batch([keys], counts)
                keys, counts = keys[:0], counts[:0]
        own, n = np.unique(np.concatenate([keys[:0], *held]), return_counts=True)
        keys, counts = _added(np.r_[keys, own], np.r_[counts, n])
        yield from _batch([keys], counts)

    return run


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _room(length: int, words: int) -> int:
    """Phrases that a trie may have."""
    return DIGITS // (length * double_array.digits_for(words))


def _places(words: int) -> tuple[int, int]:
    """Bits of a word's code, and codes in a key of 63 bits."""
    bits = max(1, (words - 1).bit_length())
    return bits, 63 // bits


def _keys_for(length: int, words: int) -> int:
    return -(-length // _places(words)[1])


def packed(phrase: list[np.ndarray], words: int) -> list[np.ndarray]:
    """Keys of phrases that are given by the codes at each of their places."""
    bits, many = _places(words)
    keys = []
    for i in range(0, len(phrase), many):
        key = phrase[i].astype(np.int64)
        for code in phrase[i + 1 : i + many]:
            key = (key << bits) | code
        keys.append(key)
    return keys


def unpacked(keys: list[np.ndarray], length: int, words: int) -> list[np.ndarray]:
    bits, many = _places(words)
    phrase = []
    for i, key in enumerate(keys):
        last = min(many, length - i * many) - 1
        phrase += [(key >> (bits * (last - k))) & ((1 << bits) - 1) for k in range(last + 1)]
    return phrase


def _hashed(columns: list[np.ndarray]) -> np.ndarray:
    found = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        found = mix((found << np.uint64(1)) ^ (column.astype(np.uint64) + np.uint64(1)))
    return found


@dataclass(frozen=True)
class Sieve:
    """Bits at the hashes of phrases: it lets all of these pass, and few others.

    It has a power of two of bits. However full it is, it takes nothing from the counts.
    """

    bits: np.ndarray

    @staticmethod
    def slots(phrase: list[np.ndarray], size: int) -> np.ndarray:
        return (_hashed(phrase) & np.uint64(size - 1)).astype(np.int64)

    def passed(self, codes: np.ndarray, length: int) -> np.ndarray:
        """Whether a phrase that passes begins at each place, and one after the last."""
        out = np.zeros(len(codes) + 1, bool)
        count = len(codes) - length + 1
        if count <= 0:
            return out
        inside = np.ones(count, bool)
        for k in range(length):
            inside &= codes[k : k + count] >= 0
        at = np.flatnonzero(inside)
        slot = self.slots([codes[at + k] for k in range(length)], 8 * len(self.bits))
        out[at] = (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1
        return out


def _count_sieved(shared: Broadcast, length: int, words: int):
    """How often phrases occur whose two parts pass the sieve of those of one word less."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve, held, size = shared.value, [], 0
        for codes in _passes(batches):
            passed = sieve.passed(codes, length - 1)
            at = np.flatnonzero(passed[:-1] & passed[1:])
            held.append(packed([codes[at + k] for k in range(length)], words))
            size += len(at)
            if size > HELD:
                yield from _batch(*_grouped(held))
                held, size = [], 0
        if size:
            yield from _batch(*_grouped(held))

    return run


def _grouped(held: list[list[np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys and their counts. Keys of one hash may come more than once, with parts of the count."""
    keys = [np.concatenate(column) for column in zip(*held, strict=True)]
    order = np.argsort(keys[0] if len(keys) == 1 else _hashed(keys))
    keys = [key[order] for key in keys]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    return [key[first] for key in keys], np.diff(np.r_[first, len(order)])


def _sieve(found: DataFrame, count: int, length: int, words: int) -> Sieve:
    """The sieve of a table of keys, made in parts by the executors."""
    size = 1 << max(PART_BITS, min(SIEVE_BITS, (PHRASE_BITS * count).bit_length()))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [column.to_numpy() for column in batch.columns]
            slot = Sieve.slots(unpacked(keys, length, words), size)
            yield pa.record_batch([pa.array(slot >> PART_BITS), pa.array(slot)], names=["part", "slot"])

    def part(rows: pa.Table) -> pa.Table:
        bits = np.zeros(1 << PART_BITS, bool)
        bits[rows["slot"].to_numpy() & ((1 << PART_BITS) - 1)] = True
        own = pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())
        return pa.table([rows["part"].slice(0, 1).combine_chunks(), own], names=["part", "bits"])

    found = found.drop("n").mapInArrow(slots, "part long, slot long")
    parts = found.groupBy("part").applyInArrow(part, "part long, bits binary").toArrow()
    bits = np.zeros((size >> PART_BITS, 1 << (PART_BITS - 3)), np.uint8)
    for i, own in zip(parts["part"].to_pylist(), parts["bits"], strict=True):
        bits[i] = np.frombuffer(own.as_buffer(), np.uint8)
    return Sieve(bits.ravel())


def candidates(phrases: np.ndarray, language: np.ndarray, most: int) -> np.ndarray | None:
    """Phrases of one more word whose two parts are among the given; None if over `most`."""
    _, group = np.unique(np.r_[language, language], return_inverse=True)
    for end, begin in zip(phrases.T[1:], phrases.T[:-1], strict=True):
        own = np.r_[end, begin]
        _, group = np.unique(group * (own.max(initial=0) + 1) + own, return_inverse=True)
    a, b = np.split(group, 2)
    many = np.bincount(b, minlength=int(group.max(initial=0)) + 1)
    sizes = many[a]
    if sizes.sum() > most:
        return None
    order, starts = np.argsort(b, kind="stable"), np.cumsum(many) - many
    left = np.repeat(np.arange(len(phrases)), sizes)
    within = np.arange(len(left)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    right = order[starts[a[left]] + within]
    return np.column_stack([phrases[left], phrases[right][:, -1]])


def _words_column(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09]+"), lambda w: w != "")


def shuffled(docs: DataFrame, length: int, least: int) -> DataFrame:
    """Frequent phrases of a length by a shuffle of all phrases: `lang`, `words`, `f`."""
    text = lower_ascii(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.explode(F.split(text, PIECE_ENDS)).alias("piece"))
    rows = rows.select("lang", _words_column(F.col("piece")).alias("own")).filter(F.size("own") >= length)
    starts = F.sequence(F.lit(1), F.size("own") - (length - 1))
    rows = rows.select("lang", F.explode(F.transform(starts, lambda i: F.slice("own", i, length))).alias("words"))
    return rows.groupBy("lang", "words").agg(F.count(F.lit(1)).alias("f")).filter(F.col("f") >= least)


def counted(docs: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases of one to `longest` words, and the number of words by language.

    Phrases have `lang`, `words` and `f`, languages `lang` and `n`.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("lang").cast("string"), F.col("text").cast("string"))
    words = texts.mapInArrow(_count_words, "lang string, word string, n long")
    words = words.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = saved(words.filter(F.col("word").isNull() | (F.col("n") >= least)), "phrase-words")
    totals = words.filter("word is null").select("lang", "n")
    single = words.filter("word is not null")
    levels = [single.select("lang", F.array("word").alias("words"), F.col("n").alias("f"))]
    levels += _longer(spark, texts, single, least, longest)
    every = levels[0]
    for level in levels[1:]:
        every = every.union(level)
    return every, totals


def _longer(
    spark: SparkSession, texts: DataFrame, single: DataFrame, least: int, longest: int
) -> list[DataFrame]:
    """The levels from two words on."""
    levels: list[DataFrame] = []
    if single.count() > WORDS:
        return [saved(shuffled(texts, k, least), "phrases-shuffled") for k in range(2, longest + 1)]
    vocabulary = Vocabulary.of(single.orderBy("lang", F.desc("n"), "word").toArrow())
    shared = spark.sparkContext.broadcast(vocabulary)
    codes = saved(texts.mapInArrow(_encode(shared), "codes binary"), "phrase-codes")
    shared.unpersist()
    # The phrases of a level, or where they are too many a sieve of them; all words pass the first.
    phrases, size, sieve = np.arange(len(vocabulary))[:, None], len(vocabulary), None
    if size > min(PHRASES, _room(1, size)):
        sieve = Sieve(np.full(1, 255, np.uint8))
    for length in range(2, longest + 1):
        # What the counted keys are numbers of; None where they are packed words.
        known, keys = None, 1
        most = min(CANDIDATES, _room(length, size))
        if sieve is not None:
            used = spark.sparkContext.broadcast(sieve)
            run, keys = _count_sieved(used, length, size), _keys_for(length, size)
        elif len(phrases) == 0:
            break
        elif (asked := candidates(phrases, vocabulary.languages(phrases[:, 0]), most)) is not None:
            used, known = spark.sparkContext.broadcast(double_array.build(asked, size)), asked
            run = _count_accepted(used, len(asked))
        else:
            used, known = spark.sparkContext.broadcast(double_array.build(phrases, size)), phrases
            run = _count_overlaps(used, length - 1, size)
        found = codes.mapInArrow(run, _key_schema(keys)).groupBy(*_key_names(keys)).agg(F.sum("n").alias("n"))
        found = saved(found.filter(F.col("n") >= least), "phrase-counts")
        used.unpersist()
        count = found.count()
        if count > min(PHRASES, _room(length, size)):
            if known is not None:
                named = spark.sparkContext.broadcast(known.astype(np.int32))
                run, keys = _repacked(named, length, size), _keys_for(length, size)
                found = saved(found.mapInArrow(run, _key_schema(keys)), "phrase-keys")
                named.unpersist()
            if length < longest:
                phrases, sieve = None, _sieve(found, count, length, size)
            levels.append(saved(found.mapInArrow(_spelled(shared, length), PHRASE_SCHEMA), "phrases"))
            shared.unpersist()
        else:
            rows = found.toArrow()
            phrases, sieve = _phrases_of([x.to_numpy() for x in rows.columns[:-1]], known, length, size), None
            levels.append(_decoded(spark, vocabulary, phrases, rows["n"].combine_chunks()))
    return levels


def _phrases_of(keys: list[np.ndarray], known: np.ndarray | None, length: int, words: int) -> np.ndarray:
    """Phrases of keys that are packed words, numbers of known phrases, or these and a last word."""
    if known is None:
        return np.column_stack(unpacked(keys, length, words))
    if known.shape[1] == length:
        return known[keys[0]]
    return np.column_stack([known[keys[0] // words], keys[0] % words])


def _repacked(shared: Broadcast, length: int, words: int):
    """Keys that are numbers of known phrases as packed words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases = _phrases_of([batch.column(0).to_numpy()], shared.value, length, words)
            yield from _batch(packed(list(phrases.T), words), batch.column(1).to_numpy())

    return run


def _spelled(shared: Broadcast, length: int):
    """Keys of packed words as phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = shared.value
        spelling = vocabulary.all_words
        for batch in batches:
            *keys, n = batch.columns
            phrases = _phrases_of([x.to_numpy() for x in keys], None, length, len(spelling))
            yield from _spelling(vocabulary, spelling, phrases, n).to_batches()

    return run


def _spelling(vocabulary: Vocabulary, words: pa.Array, phrases: np.ndarray, n: pa.Array) -> pa.Table:
    names = pa.array([*vocabulary.first], pa.string())
    count, length = phrases.shape
    own = words.take(pa.array(phrases.ravel())).cast(pa.string())
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, count * length + 1, length), pa.int32()), own)
    langs = names.take(pa.array(vocabulary.languages(phrases[:, 0])))
    return pa.table({"lang": langs, "words": lists, "f": n})


def _decoded(spark: SparkSession, vocabulary: Vocabulary, phrases: np.ndarray, n: pa.Array) -> DataFrame:
    rows = _spelling(vocabulary, vocabulary.all_words, phrases, n)
    return saved(spark.createDataFrame(rows, PHRASE_SCHEMA), "phrases")


def scored(phrases: DataFrame, totals: DataFrame, share: int = 100) -> DataFrame:
    """Phrases of two words and more with the score of their weakest cut.

    A cut after k words has l and r, the counts of both sides, and the score
    floor(1000 * a * n / (l * r)), in exact decimals; the lowest score counts, then the
    smallest k. Phrases inside a longer one that has `share` per cent of their count are
    dropped: it is enough to look at phrases of one more word, as counts only fall.
    """
    key = F.struct("lang", "words")
    many = phrases.filter(F.size("words") >= 2).withColumnRenamed("f", "a")
    many = many.join(totals, "lang")
    sides = phrases.select(key.alias("_key"), "f")
    cuts = many.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.withColumn("_left", F.struct("lang", F.slice("words", F.lit(1), F.col("k")).alias("words")))
    cuts = cuts.withColumn(
        "_right", F.struct("lang", F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("words"))
    )
    cuts = cuts.join(sides.select(F.col("_key").alias("_left"), F.col("f").alias("l")), "_left")
    cuts = cuts.join(sides.select(F.col("_key").alias("_right"), F.col("f").alias("r")), "_right")
    exact = "cast((cast(1000 as decimal(4,0)) * cast(a as decimal(19,0)) * cast(n as decimal(15,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) as long)"
    best = cuts.groupBy("lang", "words", "a", "n").agg(F.min(F.struct(F.expr(exact).alias("score"), "k", "l", "r")).alias("_cut"))
    longer = many.filter(F.size("words") >= 3)
    parts = F.array(F.expr("slice(words, 1, size(words) - 1)"), F.expr("slice(words, 2, size(words) - 1)"))
    longer = longer.select("lang", F.explode(parts).alias("words"), "a").groupBy("lang", "words").agg(F.max("a").alias("_longer"))
    rows = best.join(longer, ["lang", "words"], "left")
    rows = rows.filter(F.col("_longer").isNull() | (100 * F.col("_longer") < share * F.col("a")))
    return rows.select("lang", F.array_join("words", " ").alias("phrase"), "a", "_cut.l", "_cut.r", "n", "_cut.score")


def mine(docs: DataFrame, least: int = 100, longest: int = 5, share: int = 100, top: int = 2000) -> DataFrame:
    """The `top` phrases of each language by score, then count, then their bytes.

    Documents have `lang` (null: und) and `text` (null: empty); other columns are not
    looked at. Small letters for A-Z; `[.,;:!?]` and line ends cut texts into pieces, blanks
    and tabs those into words. `n` is the number of words of the language, `a` that of
    the phrase's places, which may overlap; phrases below `least` places are left out. A
    table without such phrases gives no rows.
    """
    phrases, totals = counted(docs, least, longest)
    rows = scored(saved(phrases, "phrases-all"), totals, share)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
