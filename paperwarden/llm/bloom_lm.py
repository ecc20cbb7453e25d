"""Language-model scoring from a log-frequency Bloom filter.

The filter holds the words and word pairs of all training texts with counts quantised to powers of two: an n-gram seen
n times is entered as often as n has binary digits, each time with its number. Its count is read back by probing for
number 1, 2, ... until a probe misses, so an error can only make a count larger, and ever less likely so by more. A
pair is probed no further than its words. The count of a word or pair, taken as the middle of its range, gives

    P1(w) = (count(w) + 1) / (N + V + 1)        P(w | v) = (count(v w) + MU * P1(w)) / (count(v) + MU)

and a text's score is the sum of log10 P over its words and the end, the first word following the end of a text.

Documents are tokenised in slices. A slice sends every distinct n-gram, with its training count, to the bucket that the
n-gram's hash names; there the counts of all slices are added up and entered in the bucket's part of the filter, and the
distinct words are listed with their exact counts for the unigram base score. The filter grows with the corpus and is
broadcast zone by zone: a zone is a range of buckets whose parts, of at most some three and in practice a third of
``ZONE_BYTES``, go to all workers, which probe them for the n-grams that the slices sent to these buckets. Each n-gram
of a slice meets one zone only, so all work and space is in proportion to the texts (which are tokenised once for each
of ``ROUNDS`` shares of the zones, and once to be scored). The answers go back to the slices,
which score their documents.

Defined cases: a null text counts as empty; an empty text is its end alone; texts are read whole, whatever their
length; repeated rows are rows of their own; without training rows every probability is 1 and every score 0; an empty
table gives an empty result. A word or pair stands for its 64-bit hash, of which 48 or 40 bits beyond those of the bucket
are kept. Columns beyond the named ones are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from paperwarden.llm.batches import release_memory
from paperwarden.operators.scale import Workspace, workspace

#: Bytes of text a slice, a bucket and a zone stand for, and the least numbers of slices and buckets.
SLICE_BYTES, BUCKET_BYTES, ZONE_BYTES = 4 << 20, 16 << 20, 64 << 20
MIN_SLICES, MIN_BUCKETS = 256, 1024
#: Rounds in which the n-grams are sent, a share of the zones in each, so that they are never all on disk.
ROUNDS = 2
#: Bits of the filter per entry. An entry sets two patterns of PATTERN_BITS bits in one 64-bit word.
BITS_PER_ENTRY, PATTERN_BITS = 20, 3
#: Weight of the unigram probability, as a count.
MU = 2.0
#: Bytes kept of the hash of a word and of a pair, beyond the bits that name its bucket.
WORD_BYTES, PAIR_BYTES = 6, 5

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
END_HASH = np.uint64(xxhash.xxh3_64_intdigest(b""))


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit integer hash."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[1]
    values = (values ^ (values >> np.uint64(27))) * _MIX[2]
    return values ^ (values >> np.uint64(31))


@dataclass(frozen=True)
class Layout:
    """How n-grams are dealt: numbers of slices, zones and (as a power of two) buckets."""

    slices: int
    bucket_bits: int
    zones: int

    def keys(self, hashes: np.ndarray, width: int) -> np.ndarray:
        """The first bits of hashes: the bucket and ``width`` bytes."""
        return hashes >> np.uint64(max(0, 64 - self.bucket_bits - 8 * width))

    def residue_bits(self, width: int) -> int:
        return min(8 * width, 64 - self.bucket_bits)

    def buckets(self, keys: np.ndarray, width: int) -> np.ndarray:
        return (keys >> np.uint64(self.residue_bits(width))).astype(np.int64)

    def zone(self, bucket):
        return bucket * self.zones // (1 << self.bucket_bits)

    def unpack(self, data: np.ndarray, buckets: np.ndarray, width: int) -> np.ndarray:
        """Keys from residues, ``width`` bytes each, and the bucket of each."""
        wide = np.zeros((len(data) // width, 8), np.uint8)
        wide[:, :width] = data.reshape(-1, width)
        bits = np.uint64(self.residue_bits(width))
        return (buckets.astype(np.uint64) << bits) | (wide.reshape(-1).view("<u8") & ((np.uint64(1) << bits) - np.uint64(1)))


def pack(keys: np.ndarray, width: int) -> np.ndarray:
    """The last ``width`` bytes of each key."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].reshape(-1)


def choose_layout(text_bytes: int) -> Layout:
    buckets = max(MIN_BUCKETS, -(-text_bytes // BUCKET_BYTES))
    return Layout(max(MIN_SLICES, -(-text_bytes // SLICE_BYTES)), (buckets - 1).bit_length(),
                  max(ROUNDS, -(-text_bytes // ZONE_BYTES)))


@dataclass
class Tokens:
    """Documents as numbers: of each token its document and its distinct word, the last of which is the end."""

    document: np.ndarray
    word: np.ndarray
    #: Keys of the distinct words, and of every token's pair with the token before.
    words: np.ndarray
    pairs: np.ndarray

    def before(self) -> np.ndarray:
        """The word before each token; a text's first word follows the end of the text before."""
        return np.concatenate([self.word[-1:], self.word[:-1]])


def tokenise(texts: pa.Array, layout: Layout) -> Tokens:
    """Lower-case A-Z, words without white space, then one end a text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, starts = split.values, split.offsets.to_numpy()
    counts = np.diff(starts)
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not real.all():  # white space at an end of a text leaves an empty word
        counts = np.diff(np.concatenate([[0], np.cumsum(real)])[starts])
        flat = flat.filter(pa.array(real))
    coded = flat.dictionary_encode()
    named = coded.dictionary.to_numpy(zero_copy_only=False)
    hashes = np.append(np.fromiter(map(xxhash.xxh3_64_intdigest, named), np.uint64, len(named)), END_HASH)
    ends = np.cumsum(counts + 1) - 1
    word = np.full(int(ends[-1]) + 1, len(hashes) - 1, np.int32)
    inner = np.ones(len(word), bool)
    inner[ends] = False
    word[inner] = coded.indices.to_numpy()
    found = Tokens(np.repeat(np.arange(len(texts), dtype=np.int32), counts + 1), word, layout.keys(hashes, WORD_BYTES), hashes)
    pairs = mixed((hashes * _MIX[0])[found.before()] + hashes[word])
    found.pairs = layout.keys(pairs, PAIR_BYTES)
    return found


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A column of byte strings cut from one buffer."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    buffer = pa.py_buffer(np.ascontiguousarray(data).view(np.uint8))
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), buffer])


def _bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of byte strings in a row, and the length of each."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    data, lengths = [np.empty(0, np.uint8)], [np.empty(0, np.int64)]
    for chunk in chunks:
        offsets = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset:chunk.offset + len(chunk) + 1] if len(chunk) else np.zeros(1, np.int32)
        if chunk.buffers()[2] is not None:
            data.append(np.frombuffer(chunk.buffers()[2], np.uint8)[offsets[0]:offsets[-1]])
        lengths.append(np.diff(offsets).astype(np.int64))
    return np.concatenate(data), np.concatenate(lengths)


GRAMS = "pairs binary, words binary"
SENT = f"slice bigint, bucket bigint, {GRAMS}, pair_counts binary, word_counts binary"
KEPT = f"zone bigint, bucket bigint, slice bigint, {GRAMS}, bits binary, word_counts binary, n_tokens bigint"
ANSWERED = "slice bigint, bucket bigint, pairs binary, words binary, word_counts binary"


def _texts(table: pa.Table) -> pa.Array:
    column = table.column("text")
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def counted_pairs(tokens: Tokens, trained: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs, ascending, and how often each stands in documents that are ``trained`` on."""
    flagged = np.sort((tokens.pairs << np.uint64(1)) | trained[tokens.document].astype(np.uint64))
    keys = flagged >> np.uint64(1)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat((flagged & np.uint64(1)).astype(np.int32), first)


def _send(layout: Layout, zones: range):
    """The n-grams of one slice, with their counts in training texts, to their buckets in some zones."""
    every = np.arange(1 << layout.bucket_bits)
    zone = layout.zone(every)
    every = every[(zone >= zones.start) & (zone < zones.stop)]

    def cut(keys: np.ndarray, width: int) -> tuple[slice, np.ndarray]:
        """The place of these buckets' keys among all ascending ones, and how many each bucket gets."""
        starts = np.searchsorted(layout.buckets(keys, width), np.append(every, every[-1:] + 1))
        return slice(starts[0], starts[-1]), np.diff(starts)

    def sent(table: pa.Table) -> pa.Table:
        trained = table.column("trained").to_numpy()
        tokens = tokenise(_texts(table), layout)
        pairs, pair_counts = counted_pairs(tokens, trained)
        word_counts = np.bincount(tokens.word[trained[tokens.document]], minlength=len(tokens.words))
        order = np.argsort(tokens.words)
        words, word_counts = tokens.words[order], word_counts[order]
        (pair_place, n_pairs), (word_place, n_words) = cut(pairs, PAIR_BYTES), cut(words, WORD_BYTES)
        pairs, pair_counts = pairs[pair_place], pair_counts[pair_place]
        words, word_counts = words[word_place], word_counts[word_place]
        some = (n_pairs + n_words) > 0
        n_pairs, n_words = n_pairs[some], n_words[some]
        return pa.table({"slice": np.full(len(n_pairs), table.column("slice")[0].as_py()), "bucket": every[some],
                         "pairs": _binary(pack(pairs, PAIR_BYTES), n_pairs * PAIR_BYTES),
                         "words": _binary(pack(words, WORD_BYTES), n_words * WORD_BYTES),
                         "pair_counts": _binary(pair_counts.astype("<i4"), n_pairs * 4),
                         "word_counts": _binary(word_counts.astype("<i4"), n_words * 4)})

    def run(table: pa.Table) -> pa.Table:
        made = sent(table)
        release_memory()  # what its arrays took; an idle worker would hold it
        return made

    return run


def levels_of(counts: np.ndarray) -> np.ndarray:
    """Binary digits of counts."""
    return np.where(counts > 0, np.floor(np.log2(np.maximum(counts, 1))) + 1, 0).astype(np.int64)


_HIGH = 2.0 ** np.arange(65)
_MIDDLE = np.where(np.arange(65) > 0, (_HIGH / 2 + _HIGH - 1) / 2, 0.0)


def estimate(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts with so many binary digits."""
    return _MIDDLE[levels]


def _patterns() -> np.ndarray:
    """4096 words of PATTERN_BITS bits each."""
    drawn = mixed(np.arange(1, 4097, dtype=np.uint64) * _MIX[0])
    return np.bitwise_or.reduce([np.uint64(1) << ((drawn >> np.uint64(6 * k)) & np.uint64(63)) for k in range(PATTERN_BITS)])


_PATTERNS = _patterns()


def _places(keys: np.ndarray, number: int, sizes) -> tuple[np.ndarray, np.ndarray]:
    """The word of its part's bits, and the bits in it, that an entry of key and number sets."""
    first = mixed(keys * _MIX[0] + np.uint64(number))
    place = (first >> np.uint64(24)) % sizes
    return place.astype(np.int64), _PATTERNS[first & np.uint64(4095)] | _PATTERNS[(first >> np.uint64(12)) & np.uint64(4095)]


def filter_part(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bits that hold all numbers up to each key's level."""
    levels = levels_of(counts)
    size = max(1, -(-int(levels.sum()) * BITS_PER_ENTRY // 64))
    bits = np.zeros(size, np.uint64)
    for number in range(1, int(levels.max(initial=0)) + 1):
        places, mask = _places(keys[levels >= number], number, np.uint64(size))
        np.bitwise_or.at(bits, places, mask)
    return bits


#: Pairs and words are entered as different keys.
_PAIR_MARK = np.uint64(1) << np.uint64(63)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with a count, ascending, and their total counts."""
    learned = counts > 0
    order = np.argsort(keys[learned], kind="stable")
    keys, counts = keys[learned][order], counts[learned][order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _keep(layout: Layout):
    """The filter part and exact word counts of one bucket, and what each slice asks of it."""
    def run(table: pa.Table) -> pa.Table:
        bucket, n = table.column("bucket")[0].as_py(), table.num_rows
        asked, known = {}, {}
        for name, width in (("pair", PAIR_BYTES), ("word", WORD_BYTES)):
            data, lengths = _bytes(table.column(f"{name}s"))
            asked[name] = data, lengths
            counts = _bytes(table.column(f"{name}_counts"))[0].view("<i4").astype(np.int64)
            known[name] = _summed(layout.unpack(data, np.full(len(data) // width, bucket), width), counts)
        (pairs, pair_counts), (words, word_counts) = known["pair"], known["word"]
        bits = filter_part(np.concatenate([pairs | _PAIR_MARK, words]), np.concatenate([pair_counts, word_counts]))
        none = np.zeros(n, np.int64)

        def beside(first: np.ndarray, rest: tuple[np.ndarray, np.ndarray] | None = None) -> pa.Array:
            """``first`` in the bucket's own row, then ``rest`` in those of the slices."""
            data, lengths = rest or (np.empty(0, np.uint8), none)
            first = np.ascontiguousarray(first).view(np.uint8)
            return _binary(np.concatenate([first, data]), np.append(len(first), lengths))

        return pa.table({
            "zone": np.full(n + 1, layout.zone(bucket)), "bucket": np.full(n + 1, bucket),
            "slice": np.append(-1, table.column("slice").to_numpy()), "pairs": beside(none[:0], asked["pair"]),
            "words": beside(pack(words, WORD_BYTES), asked["word"]), "bits": beside(bits.astype("<u8")),
            "word_counts": beside(word_counts.astype("<i8")), "n_tokens": np.append(word_counts.sum(), none)})

    return run


@dataclass
class Zone:
    """Filter parts and word counts of neighbouring buckets, in flat arrays."""

    first: int
    starts: np.ndarray
    sizes: np.ndarray
    bits: np.ndarray
    words: np.ndarray
    word_counts: np.ndarray

    def levels(self, keys: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """How many numbers of each key are found before the first that is missing."""
        found = np.zeros(len(keys), np.uint8)
        at = buckets - self.first
        starts, sizes = self.starts[at], self.sizes[at].astype(np.uint64)
        open_ = np.arange(len(keys))
        for number in range(1, 65):
            places, mask = _places(keys, number, sizes)
            hit = (self.bits[starts + places] & mask) == mask
            open_, keys, starts, sizes = open_[hit], keys[hit], starts[hit], sizes[hit]
            if not len(keys):
                break
            found[open_] = number
        return found

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Exact training counts of words."""
        if not len(self.words):
            return np.zeros(len(keys), np.int64)
        places = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
        return np.where(self.words[places] == keys, self.word_counts[places], 0)


def _gather_zone(parts: DataFrame, layout: Layout) -> Zone | None:
    """One zone's filter parts (of bounded size) as arrays."""
    rows = sorted(parts.select("bucket", "bits", "words", "word_counts").collect())
    if not rows:
        return None
    first, last = rows[0].bucket, rows[-1].bucket
    starts, sizes = np.zeros(last - first + 1, np.int64), np.ones(last - first + 1, np.int64)
    bits, words, counts, used = [], [], [], 0
    for row in rows:
        own = np.frombuffer(row.bits, "<u8")
        starts[row.bucket - first], sizes[row.bucket - first] = used, len(own)
        used += len(own)
        bits.append(own)
        residues = np.frombuffer(row.words, np.uint8)
        words.append(layout.unpack(residues, np.full(len(residues) // WORD_BYTES, row.bucket), WORD_BYTES))
        counts.append(np.frombuffer(row.word_counts, "<i8"))
    return Zone(first, starts, sizes, *map(np.concatenate, (bits, words, counts)))


def _answers(asked: DataFrame, zone: Zone, layout: Layout, work: Workspace) -> DataFrame:
    """Levels of all n-grams that the slices ask of a zone, and the exact counts of the words among them.

    They are written, and the zone is taken back from driver and workers.
    """
    shared = asked.sparkSession.sparkContext.broadcast(zone)

    def run(batches):
        held = shared.value
        for batch in batches:
            bucket = batch.column(1).to_numpy()
            (pairs, n_pairs), (words, n_words) = _bytes(batch.column(2)), _bytes(batch.column(3))
            n_pairs, n_words = n_pairs // PAIR_BYTES, n_words // WORD_BYTES
            pair_at, word_at = np.repeat(bucket, n_pairs), np.repeat(bucket, n_words)
            pairs, words = layout.unpack(pairs, pair_at, PAIR_BYTES), layout.unpack(words, word_at, WORD_BYTES)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _binary(held.levels(pairs | _PAIR_MARK, pair_at), n_pairs),
                 _binary(held.levels(words, word_at), n_words), _binary(held.counts(words).astype("<i8"), 8 * n_words)],
                names=["slice", "bucket", "pairs", "words", "word_counts"])
            del pairs, words, pair_at, word_at
        release_memory()

    answers = work.table(asked.select("slice", "bucket", "pairs", "words").mapInArrow(run, ANSWERED))
    shared.destroy()
    return answers


def _score(layout: Layout, id_col: str, total: int):
    """Scores of the documents of one slice from the answers to it; ``total`` is N + V + 1."""
    def scored(docs: pa.Table, answers: pa.Table) -> pa.Table:
        answers, n = answers.sort_by("bucket"), docs.num_rows
        tokens = tokenise(_texts(docs), layout)
        order = np.argsort(tokens.pairs)
        ascending = tokens.pairs[order]
        place = np.cumsum(np.concatenate([[0], ascending[1:] != ascending[:-1]]))
        pair = np.empty(len(order), np.uint8)
        pair[order] = _bytes(answers.column("pairs"))[0][place]
        order = np.argsort(tokens.words)
        words, exact = np.empty(len(order), np.uint8), np.empty(len(order), np.int64)
        words[order] = _bytes(answers.column("words"))[0]
        exact[order] = _bytes(answers.column("word_counts"))[0].view("<i8")
        own, before = words[tokens.word], words[tokens.before()]
        likely = log_probability(own, before, np.minimum(pair, np.minimum(own, before)), total)
        base = np.log10((exact + 1.0) / total)

        def summed(values: np.ndarray) -> np.ndarray:
            return np.bincount(tokens.document, weights=values, minlength=n)

        return pa.table({id_col: docs.column("id"), "trained": docs.column("trained"),
                         "n_tokens": np.bincount(tokens.document, minlength=n),
                         "n_known": np.bincount(tokens.document[(exact > 0)[tokens.word]], minlength=n),
                         "base_score": summed(base[tokens.word]), "score": summed(likely)})

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        made = scored(docs, answers)
        release_memory()
        return made

    return run


def log_probability(word: np.ndarray, before: np.ndarray, pair: np.ndarray, total: int) -> np.ndarray:
    """log10 P of tokens from the levels of the word, of the word before and of the pair."""
    seen = estimate(before)
    unigram = (estimate(word) + 1.0) / total
    return np.log10(np.minimum((np.minimum(estimate(pair), seen) + MU * unigram) / (seen + MU), 1.0))


def score_documents(docs: DataFrame, trained: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``trained``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row.

    The model learns from the rows for which ``trained`` holds.
    """
    work, spark = workspace(docs.sparkSession), docs.sparkSession
    picked = docs.select(docs[id_col].alias("id"), F.coalesce(trained, F.lit(False)).alias("trained"),
                         F.coalesce(docs[text_col], F.lit("")).alias("text"))
    layout = choose_layout(picked.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    dealt = picked.withColumn("slice", F.pmod(F.xxhash64("id", "text"), F.lit(layout.slices)))
    answers, n_tokens, n_words = [], 0, 0
    for turn in range(ROUNDS):
        zones = range(layout.zones * turn // ROUNDS, layout.zones * (turn + 1) // ROUNDS)
        sent = dealt.groupBy("slice").applyInArrow(_send(layout, zones), SENT)
        kept = work.table(sent.groupBy("bucket").applyInArrow(_keep(layout), KEPT), by="zone")
        known = kept.where("slice < 0").agg(F.sum("n_tokens"), F.sum(F.expr(f"octet_length(words) div {WORD_BYTES}"))).first()
        n_tokens, n_words = n_tokens + (known[0] or 0), n_words + (known[1] or 0)
        for number in zones:
            own = kept.where(F.col("zone") == number)
            zone = _gather_zone(own.where("slice < 0"), layout)
            if zone:
                answers.append(_answers(own.where("slice >= 0"), zone, layout, work))
        work.drop(kept)
    answers = reduce(DataFrame.unionByName, answers) if answers else spark.createDataFrame([], ANSWERED)
    kind = picked.schema["id"].dataType.simpleString()
    scored = dealt.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(
        _score(layout, id_col, n_tokens + n_words + 1),
        f"`{id_col}` {kind}, trained boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return scored.withColumn("train_tokens", F.lit(n_tokens).cast("long"))

