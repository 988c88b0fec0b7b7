"""LM scoring with an Elias-Fano n-gram trie.

A text's tokens are its words and one end; a token's context is the token before it (the end, for the
first).  The model is a bigram model with Dirichlet smoothing towards the add-0.1 unigram model:

    p(w | v) = (c(v w) + MU p(w)) / (c(v) + MU),

so a text's score is its unigram score, plus log10(MU / (c(v) + MU)) for every context, plus the gain
log10(1 + c(v w) / (MU p(w))) of every bigram that the trie holds.  The trie is cut in shards by the hash of
the bigram, so neither a frequent word nor the corpus outgrows a task.  A shard has two levels: its
contexts, with monotone pointers to their successors, and the successors, made monotone by adding up the
ranges before them; contexts, pointers and successors are Elias-Fano sequences and the gains two bytes each,
all in one memory-mapped file.  A bigram is found by its context, then by successor search relative to the
context's range.

Training words are numbered from their counts (densely, frequent ones first); a bigram is the pair of its
words' numbers, whole, and gains and probabilities are kept in steps over two bytes, whose range no corpus
passes.

Spark reads the texts once, into blocks of encoded tokens in the shared folder; counts all words of the
training texts by a shuffle; gives each block the counts and numbers of its words; and sends each shard the distinct
bigrams of each block with where they occur.  Only the sums of a block's documents come back.

Defined cases: a null or empty text is its end token alone; a null doc_id is not held out; repeated rows are
texts of their own; without training texts all words are unknown and every probability is that of the
smoothing; other columns are ignored.  Words are told apart by 64-bit hashes, bigrams by the numbers of their words.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerline.llm.common import staged

MU = 20.0
ALPHA = 0.1
BLOCK_TOKENS = 2_000_000
SHARD_TOKENS = 4_000_000
STEP = 1 / 32  # of quantised gains, in log10
BASE_STEP = 1 / 24  # of quantised unigram probabilities, in log10
END = xxhash.xxh64_intdigest(b"\n end")  # no word holds white space
SAMPLE = 4096
BITS = 24  # of a successor in a trie's keys, unless told
KEY_BITS = 62  # most bits of a trie's keys
ROW_BITS = 33  # of monotonically_increasing_id below the partition


def pack(values: np.ndarray) -> bytes:
    """Compressed by planes (all first bytes, all second bytes, ...): high bytes are mostly zero."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def quantise(values: np.ndarray, step: float) -> np.ndarray:
    """Steps of values in log10, in two bytes: up to 2,047 for ``STEP`` and 2,730 for ``BASE_STEP``."""
    return np.minimum(np.rint(values / step), 65535).astype(np.uint16)


def pair_keys(left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, int]:
    """(left << bits | right) of numbers under 2^bits, and the bits; where two do not fit, of their ranks."""
    if 2 * bits > KEY_BITS:
        left, right = (np.unique(x, return_inverse=True)[1] for x in (left, right))
        bits = max(1, len(right).bit_length())
    return (left.astype(np.uint64) << np.uint64(bits)) | right.astype(np.uint64), bits


class EliasFano:
    """A monotone sequence: low bits in place, high bits in unary, and where every 4096th one stands."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.width, self.low, self.high, self.samples = n, width, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(n, width, np.packbits(bits.astype(np.uint8).ravel()), np.packbits(high), ones[::SAMPLE])

    def window(self, start: int, stop: int) -> np.ndarray:
        """Values start..stop-1."""
        if stop <= start:
            return np.empty(0, np.int64)
        first = start // SAMPLE
        last = (stop - 1) // SAMPLE + 1
        at = int(self.samples[first])
        end = int(self.samples[last]) if last < len(self.samples) else 8 * len(self.high)
        bits = np.unpackbits(self.high[at // 8 : -(-end // 8)])[at % 8 :]
        ones = np.flatnonzero(bits)[start - first * SAMPLE : stop - first * SAMPLE] + at
        high = ones - np.arange(start, stop)
        lo, hi = start * self.width, stop * self.width
        low = np.unpackbits(self.low[lo // 8 : -(-hi // 8)])[lo % 8 : lo % 8 + hi - lo].reshape(stop - start, self.width)
        return (high << self.width) + low.astype(np.int64) @ (1 << np.arange(self.width, dtype=np.int64))

    def all(self) -> np.ndarray:
        return self.window(0, self.n)


class Trie:
    """Contexts -> successors -> quantised gains, in one memory-mapped file."""

    def __init__(self, keys: np.ndarray, gains: np.ndarray, bits: int = BITS):
        """``keys``: distinct sorted (context << bits | successor); ``gains``: log10 gains."""
        self.bits, self.low = bits, np.uint64((1 << bits) - 1)
        contexts, starts = np.unique(keys >> np.uint64(bits), return_index=True)
        successors = (keys & self.low).astype(np.int64)
        ends = np.r_[starts[1:], len(keys)].astype(np.int64)
        spans = np.r_[0, np.cumsum(successors[ends - 1] + 1)[:-1]] if len(keys) else np.empty(0, np.int64)
        monotone = successors + np.repeat(spans, ends - starts)
        codes = quantise(gains, STEP)
        levels = [EliasFano.of(contexts), EliasFano.of(np.r_[0, ends]), EliasFano.of(monotone)]
        parts = [x for level in levels for x in (level.low, level.high, level.samples.astype(np.int64).view(np.uint8))] + [codes.view(np.uint8)]
        self.file = tempfile.TemporaryFile()  # gone when it is closed
        self.file.write(b"\0" + b"".join(x.tobytes() for x in parts))
        self.file.flush()
        data, at, views = np.memmap(self.file, np.uint8, "r"), 1, []
        for x in parts:
            views.append(data[at : at + x.nbytes])
            at += x.nbytes
        mapped = [
            EliasFano(level.n, level.width, views[3 * i], views[3 * i + 1], np.frombuffer(views[3 * i + 2].tobytes(), np.int64))
            for i, level in enumerate(levels)
        ]
        self.contexts, self.pointers, self.successors, self.codes = *mapped, views[-1].view(np.uint16)

    def gains(self, keys: np.ndarray, chunk: int = 1 << 18) -> np.ndarray:
        """Gains of sorted distinct keys; 0 for those that the trie lacks."""
        out = np.zeros(len(keys))
        if not len(keys) or not self.contexts.n:
            return out
        contexts, pointers = self.contexts.all(), self.pointers.all()
        asked = (keys >> np.uint64(self.bits)).astype(np.int64)
        rank = np.searchsorted(contexts, asked)
        rank[rank == len(contexts)] = 0
        here = np.flatnonzero(contexts[rank] == asked)
        rank, wanted = rank[here], (keys[here] & self.low).astype(np.int64)
        at = 0
        while at < len(here):
            first = rank[at]
            last = max(first + 1, int(np.searchsorted(pointers, pointers[first] + chunk)) - 1)
            stop = int(np.searchsorted(rank, last))
            lo, hi = int(pointers[first]), int(pointers[last])
            values = self.successors.window(max(lo - 1, 0), hi)
            before, values = (values[0] + 1, values[1:]) if lo else (0, values)
            ends = pointers[first + 1 : last + 1] - lo
            base = np.r_[before, values[ends[:-1] - 1] + 1]  # of each context's range
            owner = np.repeat(np.arange(last - first), np.diff(np.r_[0, ends]))
            have = (owner << self.bits) + values - base[owner]
            want = ((rank[at:stop] - first) << self.bits) + wanted[at:stop]
            place = np.searchsorted(have, want)
            place[place == len(have)] = 0
            hit = have[place] == want
            out[here[at:stop][hit]] = self.codes[lo + place[hit]] * STEP
            at = stop
        return out


def encode_blocks(docs: DataFrame, folds: int = 10) -> DataFrame:
    """One row per block of about ``BLOCK_TOKENS`` tokens: its documents, its words (hashes, in order of
    first sight), their counts in training texts, and all tokens as places in those words."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, size = TaskContext.get().partitionId(), 0, 0
        ids: dict[bytes, int] = {}
        names, flags, lengths, tokens = [], [], [], []

        def block() -> pa.RecordBatch:
            words = np.fromiter((xxhash.xxh64_intdigest(w) if w != b"" else END for w in ids), np.uint64, len(ids))
            places = np.concatenate(tokens)
            trained = np.repeat(~np.array(flags, bool), lengths)
            counts = np.bincount(places[trained], minlength=len(ids))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + made]),
                    pa.array([pa.concat_arrays(names).to_pylist()], pa.list_(names[0].type)),
                    pa.array([flags], pa.list_(pa.bool_())),
                    pa.array([lengths], pa.list_(pa.int32())),
                    pa.array([words.view(np.int64)], pa.list_(pa.int64())),
                    pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([pack(places.astype(np.uint32))], pa.binary()),
                ],
                ["block", "doc_ids", "held_out", "lengths", "words", "trained", "tokens"],
            )

        for batch in batches:
            for i, (flag, text) in enumerate(zip(batch["held_out"].to_pylist(), batch["text"].to_pylist(), strict=True)):
                words = (text or "").encode("utf-8", "surrogatepass").lower().split()
                words.append(b"")  # the end; never a word
                places = [ids.setdefault(w, len(ids)) for w in words]
                names.append(batch["doc_id"].slice(i, 1))
                flags.append(flag)
                lengths.append(len(places))
                tokens.append(np.array(places, np.uint32))
                size += len(places)
                if size >= BLOCK_TOKENS:
                    yield block()
                    made, size = made + 1, 0
                    ids, names, flags, lengths, tokens = {}, [], [], [], []
        if tokens:
            yield block()

    return rows.mapInArrow(
        run,
        f"block long, doc_ids array<{kind}>, held_out array<boolean>, lengths array<int>, words array<long>, trained array<int>, tokens binary",
    )


def known_counts(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """block, places, counts, ids: the training counts and numbers of the words of each block that have any."""

    def pack_group(table: pa.Table) -> pa.Table:
        packed = {name: pa.array([pack(table[c].to_numpy())], pa.binary()) for name, c in (("places", "place"), ("counts", "c"), ("ids", "id"))}
        return pa.table({"block": table["block"].slice(0, 1)} | packed)

    words = blocks.select("block", F.posexplode("words").alias("place", "word")).join(counts, "word")
    return words.select("block", F.col("place").cast("int"), "c", "id").groupBy("block").applyInArrow(pack_group, "block long, places binary, counts binary, ids binary")


def number_words(counts: DataFrame) -> tuple[DataFrame, int, int, int]:
    """Staged word, c, id; the sum of the counts, the number of words, and the first number above all ids:
    the words of each partition in order of their counts, dealt out in turn, so that frequent words have
    small ids and ids are about as dense as partitions are even."""
    ranked = staged(counts.sortWithinPartitions(F.desc("c")).withColumn("id", F.monotonically_increasing_id()), "lm_counts")
    part, row = F.shiftright("id", ROW_BITS), F.col("id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    n, v, parts, rows = ranked.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.max(part), F.max(row)).first()
    parts, rows = (0, 0) if parts is None else (int(parts) + 1, int(rows) + 1)
    return ranked.withColumn("id", row * F.lit(parts).cast("long") + part), int(n), int(v), parts * rows


def score_texts(docs: DataFrame, folds: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every text; texts whose
    crc32(doc_id) mod ``folds`` is 0 are held out of the training."""
    blocks = staged(encode_blocks(docs, folds), "lm_blocks")
    seen = blocks.select(F.explode(F.arrays_zip("words", "trained")).alias("x")).select(F.col("x.words").alias("word"), F.col("x.trained").alias("c"))
    counts, n, v, top = number_words(seen.where("c > 0").groupBy("word").agg(F.sum("c").alias("c")))
    bits = max(1, top.bit_length())
    wide = np.uint32 if bits <= 32 else np.uint64
    size = blocks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    shards = max(1, -(-size // SHARD_TOKENS))
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    total = n + ALPHA * (v + 1)
    doc_fields = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, gain double"

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield from one_block({c: batch[c][row] for c in batch.schema.names})

    def one_block(b: dict) -> Iterator[pa.RecordBatch]:
        block = b["block"].as_py()
        words = b["words"].values.to_numpy(zero_copy_only=False).view(np.uint64)
        lengths = b["lengths"].values.to_numpy(zero_copy_only=False)
        held = b["held_out"].values.to_numpy(zero_copy_only=False).astype(bool)
        tokens = unpack(b["tokens"].as_py(), np.uint32)
        c, ids = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        if b["places"].is_valid:
            places = unpack(b["places"].as_py(), np.int32)
            c[places], ids[places] = unpack(b["counts"].as_py(), np.int64), unpack(b["ids"].as_py(), np.int64)
        log_p = np.log10((c + ALPHA) / total)
        starts = np.r_[0, np.cumsum(lengths, dtype=np.int64)[:-1]]
        end = np.flatnonzero(words == np.uint64(END))[0]
        contexts = np.r_[end, tokens[:-1]].astype(np.int64)
        contexts[starts] = end
        base = np.add.reduceat(log_p[tokens], starts)
        back = np.add.reduceat(np.log10(MU / (c + MU))[contexts], starts)
        known = np.add.reduceat((c > 0)[tokens].astype(np.int64), starts)
        fields = [b["doc_ids"].values, pa.array(held), pa.array(lengths.astype(np.int64)), pa.array(known), pa.array(base), pa.array(back)]
        info = pa.StructArray.from_arrays(fields, ["doc_id", "held_out", "n_tokens", "n_known", "base", "gain"])
        docs_of = pa.ListArray.from_arrays(pa.array([0, len(info)], pa.int32()), info)
        nothing = pa.array([None], pa.binary())
        yield message(-1 - block % shards, block, docs_of, *[nothing] * 6)
        # distinct bigrams of known words, by shard
        both = (c[tokens] > 0) & (c[contexts] > 0)
        at = np.flatnonzero(both)
        if not len(at):
            return
        by_id = np.argsort(ids)  # places in this order sort as ids do, in fewer bits
        rank = np.empty(len(ids), np.uint64)
        rank[by_id] = np.arange(len(ids), dtype=np.uint64)
        half = np.uint64(32)
        pairs, firsts, inverse = np.unique((rank[contexts[at]] << half) | rank[tokens[at]], return_index=True, return_inverse=True)
        left, right = (ids[by_id[x.astype(np.int64)]].astype(np.uint64) for x in (pairs >> half, pairs & np.uint64(0xFFFFFFFF)))
        mixed = (left * np.uint64(0xD6E8FEB86659FD93) + right) * np.uint64(0x9E3779B97F4A7C15)
        of_pair = ((mixed >> np.uint64(40)) % np.uint64(shards)).astype(np.uint16 if shards < 1 << 16 else np.uint32)
        dealt = np.argsort(of_pair, kind="stable")
        moved = np.empty(len(dealt), np.int64)
        moved[dealt] = np.arange(len(dealt))
        left, right, firsts, inverse = left[dealt], right[dealt], firsts[dealt], moved[inverse]
        edges = np.searchsorted(of_pair[dealt], np.arange(shards + 1))
        shard = of_pair[dealt][inverse]
        doc_of = np.repeat(np.arange(len(lengths)), lengths)[at]
        trained = np.bincount(inverse, weights=~held[doc_of], minlength=len(pairs)).astype(np.uint32)
        quantised = quantise(-log_p[tokens[at][firsts]], BASE_STEP)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        for s in range(shards):
            lo, hi = edges[s], edges[s + 1]
            if lo == hi:
                continue
            mine = order[cuts[s] : cuts[s + 1]]
            blobs = [
                np.diff(left[lo:hi], prepend=np.uint64(0)).astype(wide), right[lo:hi].astype(wide), quantised[lo:hi], trained[lo:hi],
                (inverse[mine] - lo).astype(np.uint32), np.bincount(doc_of[mine], minlength=len(lengths)).astype(np.uint32),
            ]
            yield message(s, block, None, *[pa.array([pack(x)], pa.binary()) for x in blobs])

    names = ["shard", "block", "docs", "contexts", "successors", "base", "trained", "places", "per_doc"]

    def message(shard: int, block: int, docs_of: pa.Array | None, *blobs: pa.Array) -> pa.RecordBatch:
        docs_of = docs_of if docs_of is not None else pa.nulls(1, list_type)
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([block], pa.int64()), docs_of.cast(list_type), *blobs], names)

    def one_shard(table: pa.Table) -> pa.Table:
        if table["shard"][0].as_py() < 0:  # documents: as they are
            return table.select(["block", "docs"]).append_column("gains", pa.nulls(table.num_rows, pa.binary()))
        lefts, rights, bases, times = [], [], [], []
        for row in range(table.num_rows):
            lefts.append(np.cumsum(unpack(table["contexts"][row].as_py(), wide), dtype=np.uint64))
            rights.append(unpack(table["successors"][row].as_py(), wide))
            bases.append(unpack(table["base"][row].as_py(), np.uint16))
            times.append(unpack(table["trained"][row].as_py(), np.uint32))
        cuts = np.r_[0, np.cumsum([len(x) for x in lefts])]
        keys, key_bits = pair_keys(np.concatenate(lefts), np.concatenate(rights), bits)
        distinct, firsts, inverse = np.unique(keys, return_index=True, return_inverse=True)
        count = np.bincount(inverse, weights=np.concatenate(times))
        p = 10.0 ** (-BASE_STEP * np.concatenate(bases)[firsts])
        held = count > 0
        trie = Trie(distinct[held], np.log10(1 + count[held] / (MU * p[held])), key_bits)
        found = trie.gains(distinct)[inverse]  # every block's bigrams, looked up once
        trie.file.close()
        sums = []
        for row in range(table.num_rows):
            gain = found[cuts[row] : cuts[row + 1]][unpack(table["places"][row].as_py(), np.uint32)]
            per_doc = unpack(table["per_doc"][row].as_py(), np.uint32)
            ends = np.r_[0.0, np.cumsum(gain)][np.cumsum(per_doc, dtype=np.int64)]
            sums.append(pack(np.diff(ends, prepend=0.0)))
        return pa.table([table["block"], pa.nulls(len(sums), list_type), pa.array(sums, pa.binary())], ["block", "docs", "gains"])

    def one_block_sum(table: pa.Table) -> pa.Table:
        """A block's documents with the gains that all shards found for them."""
        info = next(x for x in table["docs"].combine_chunks() if x.is_valid).values
        gain = info.field("gain").to_numpy(zero_copy_only=False).copy()
        for x in table["gains"].to_pylist():
            if x is not None:
                gain += unpack(x, np.float64)
        fields = [info.field(c) for c in result_names[:-1]]
        return pa.table([*fields, pa.array(gain)], result_names)

    result_names = ["doc_id", "held_out", "n_tokens", "n_known", "base", "gain"]
    doc_type = to_arrow_type(blocks.schema["doc_ids"].dataType.elementType)
    result_types = [doc_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    list_type = pa.list_(pa.struct(list(zip(result_names, result_types, strict=True))))
    struct = ", ".join(f"{name}: {k}" for name, k in zip(result_names, (kind, "boolean", "bigint", "bigint", "double", "double"), strict=True))
    sent = f"shard long, block long, docs array<struct<{struct}>>, " + ", ".join(f"{c} binary" for c in names[3:])
    known = staged(known_counts(blocks, counts), "lm_known")
    messages = blocks.join(known, "block", "left").mapInArrow(split, sent)
    parts = messages.groupBy("shard").applyInArrow(one_shard, f"block long, docs array<struct<{struct}>>, gains binary")
    texts = parts.groupBy("block").applyInArrow(one_block_sum, doc_fields).withColumnRenamed("base", "base_score")
    return texts.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        "base_score", (F.col("base_score") + F.col("gain")).alias("score"),
    )
