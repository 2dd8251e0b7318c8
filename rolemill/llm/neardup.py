"""Near-duplicate records with small edits: an exact-threshold set-similarity join over word shingles.

Method: parity-sketch join. Every shingle of a record is hashed. The record's size band says into how many blocks the
hashes are spread, and each block keeps the XOR of its hashes: two records agree in a block just when no shingle of
their symmetric difference fell into it. A similarity of at least t bounds the symmetric difference by
(1-t)/(1+t) * (|A|+|B|), so by pigeonhole a pair that reaches t agrees in many blocks. Blocks are joined by value per
size band; a record stands in its own band and the next larger one, so any two records that can reach t share a band.
Pairs that agree in two blocks or more are candidates. They pass a parity bit sketch, of a length that fits the record,
whose Hamming distance never exceeds the symmetric difference: a larger distance than the bound allows rules a pair out
for certain. What is left is verified on the words themselves.

A block counts only with enough shingles in it, as a block of one or two common shingles meets half the corpus. How many
is derived, band by band, from the number of agreeing blocks that a pair just at the threshold can be expected to have
(``_least``): at least 7 where the pair shares one band of every spread, twice that where it shares both. Shingles are
spread ``SPREADS`` times by other hashes, and each time the borders of the bands are shifted, so that no pair straddles a
border every time unless its sizes are as different as the threshold allows. In bands too small for that, every shingle
is a block of its own and one agreement is enough, which misses nothing. ``exact=True`` does that for all records: any
two records with a common shingle are candidates. It is meant for small tables and as the yardstick of the tests.
Measured: README.

Skew: records with equal shingle sets are one class and join once; only their first copy in a partition emits blocks.
Blocks are sorted by value, once. Those of at most ``HOT`` records give their pairs to the count of agreements, so a row
of a block gives ``HOT`` / 2 pairs at most. A common passage makes blocks of more records, whose pairs grow with the square
of the table: of these no pair is shuffled. Their records are held against each other by their sketches, in parts of
``PART`` records, and only pairs that pass the Hamming bound come out. One agreement in such a block is thus enough.

Texts travel to their partners compressed. Those that no candidate needs are sorted out before the shuffle by a bitmap of
the needed ids' hashes, of at most ``BITMAP_BITS`` bits: a full bitmap lets more texts pass, the join that follows decides.

Nulls count as empty texts; records with fewer words than a shingle have no set and are in no pair. Repeated rows are
one another's copies. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemill.session import materialize, release

#: How many times, by another hash, shingles are spread into blocks.
SPREADS = 3
#: Agreeing blocks that a pair at the threshold can be expected to have if it shares one band of every spread.
EXPECTED = 7.0
#: A candidate agrees in so many blocks (in one, where every shingle is a block).
AGREEMENTS = 2
#: 8 MB at most, 16 bits an id as long as that is less; and how many bits an id sets.
BITMAP_BITS, BITMAP_HASHES = 1 << 26, 3
_BITMAP_PIECE = 1 << 16
#: A block of more records is hot. How many of its records, on either side, a task holds against each other.
HOT, PART = 16, 2048
_DOC_BITS = 14
_HASH_BITS = 64 - _DOC_BITS


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _WordHash(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode())
        return value


def _sets(texts: list[str | None], width: int, hashes: _WordHash) -> tuple[np.ndarray, np.ndarray]:
    """(record, hash) of every different shingle, sorted by both; at most 2**14 records at once."""
    import re

    words = re.compile("[a-z0-9]+", re.A).findall
    per, flat = [], []
    for t in texts:
        found = words(t.lower()) if t else []
        per.append(len(found))
        flat.extend(map(hashes.__getitem__, found))
    n = np.asarray(per, np.int64)
    h = np.asarray(flat, np.uint64)
    if len(h) < width:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    doc = np.repeat(np.arange(len(n)), n)
    s = _mix(h[width - 1 :] + np.uint64(1))
    for k in range(width - 2, -1, -1):
        s = _mix(h[k : len(h) - (width - 1 - k)] + np.uint64(0x9E3779B97F4A7C15) * s)
    inside = doc[width - 1 :] == doc[: len(doc) - width + 1]
    key = np.unique((doc[: len(s)][inside].astype(np.uint64) << np.uint64(_HASH_BITS)) | (s[inside] >> np.uint64(_DOC_BITS)))
    return (key >> np.uint64(_HASH_BITS)).astype(np.int64), key & np.uint64((1 << _HASH_BITS) - 1)


def _groups(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)


def _least(both: np.ndarray, threshold: float, load: float) -> np.ndarray:
    """How many shingles make a block count, for pairs with so many shingles together: the most (of 2 to 8) that leave
    a pair at the threshold ``EXPECTED`` agreeing blocks. Shingles fall into blocks as a Poisson process."""
    apart = (1 - threshold) / (1 + threshold)
    common = load * (1 - apart) / 2
    term, tail, least = math.exp(-common), 1.0, np.full(len(both), 2)
    for m in range(9):
        if m > 2:
            least[both * (SPREADS / load * math.exp(-load * apart) * tail) >= EXPECTED] = m
        tail, term = tail - term, term * common / (m + 1)
    return least


def _blocks(doc: np.ndarray, h: np.ndarray, size: np.ndarray, threshold: float, load: float, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """(record, block value) over both bands of every record in every spread.

    Blocks are ranges of the spread hash, so one sort serves both bands. A value has 48 bits: what they let meet by
    chance is sorted out with the sketches. Its lowest bit marks blocks of single shingles.
    """
    ratio, out_doc, out_value = 1 / threshold, [], []
    position = np.log(np.maximum(size, 1)) / math.log(ratio) + 1e-9
    for turn in range(1 if exact else SPREADS):
        shift = turn / SPREADS
        key = np.sort((doc.astype(np.uint64) << np.uint64(_HASH_BITS)) | (_mix(h + np.uint64(0x51 + turn)) >> np.uint64(_DOC_BITS)))
        d, s = (key >> np.uint64(_HASH_BITS)).astype(np.int64), key & np.uint64((1 << _HASH_BITS) - 1)
        mixed, new_doc = _mix(s), np.concatenate([[True], d[1:] != d[:-1]])
        for up in (0, 1):
            band = np.floor(position + shift).astype(np.int64) + up
            both = 2 * ratio ** (band + 0.5 - shift)
            k, least = np.maximum(1, np.round(both / load)).astype(np.uint64), _least(both, threshold, load)
            single = (least <= 2) & (turn == 0) | exact
            block = np.where(single[d], s, ((s >> np.uint64(_HASH_BITS - 32)) * k[d]) >> np.uint64(32))
            at = np.flatnonzero(new_doc | np.concatenate([[True], block[1:] != block[:-1]]))
            value, count = np.bitwise_xor.reduceat(mixed, at), np.diff(np.append(at, len(s)))
            owner = d[at]
            value = _mix(value ^ _mix(block[at] * np.uint64(0x100000001B3) + (band[owner] * SPREADS + turn).astype(np.uint64)))
            ok = single[owner] | (count >= least[owner])
            out_doc.append(owner[ok])
            out_value.append((value[ok] & np.uint64((1 << 48) - 2)) | single[owner[ok]].astype(np.uint64))
    d, v = np.concatenate(out_doc), np.concatenate(out_value)
    order = np.argsort(d, kind="stable")
    return d[order], v[order]


def _sketches(doc: np.ndarray, h: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity bits as 64-bit words of all records one after another, and how many words each has: bits are a power of two,
    at least twice the record's shingles. XOR of the halves of a sketch is the sketch of half the length."""
    bits = 1 << np.maximum(8, np.ceil(np.log2(np.maximum(2 * size, 1)))).astype(np.int64)
    start = np.concatenate([[0], np.cumsum(bits)])
    bit = (_mix(h + np.uint64(0xA7)) & (bits[doc] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(start[doc] + bit, minlength=start[-1]) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64), bits // 64


_SKETCHED = pa.schema([("id", pa.string()), ("n", pa.int32()), ("same", pa.int64()), ("sketch", pa.list_(pa.int64())), ("blocks", pa.list_(pa.int64()))])


def _sketch_batches(width: int, threshold: float, load: float, exact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, emitted = _WordHash(), set()
        for whole in batches:
            for start in range(0, whole.num_rows, 1 << 12):
                batch = whole.slice(start, 1 << 12)
                doc, h = _sets(batch.column(1).to_pylist(), width, hashes)
                rows = batch.num_rows
                size = np.bincount(doc, minlength=rows)
                at = _groups(doc)
                same = np.zeros(rows, np.uint64)
                if len(at):
                    # two sums that don't depend on the order: the class of records with the same set
                    total = np.add.reduceat(_mix(h + np.uint64(0x33)), at)
                    same[doc[at]] = _mix(total ^ np.bitwise_xor.reduceat(_mix(h + np.uint64(0x77)), at))
                bd, bv = _blocks(doc, h, size, threshold, load, exact) if len(h) else (doc, h)
                new = np.zeros(rows, bool)
                for i, s in enumerate(same.tolist()):
                    if size[i] and s not in emitted:
                        emitted.add(s)
                        new[i] = True
                bv, per = bv[new[bd]], np.bincount(bd[new[bd]], minlength=rows)
                offsets = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
                bits, words = _sketches(doc, h, size)
                keep = pa.array(size > 0)
                yield pa.record_batch(
                    [
                        batch.column(0),
                        pa.array(size.astype(np.int32)),
                        pa.array(same.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(words)]).astype(np.int32)), pa.array(bits)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(bv.view(np.int64))),
                    ],
                    schema=_SKETCHED,
                ).filter(keep)

    return run


#: Kinds of what comes of blocks: a pair (a, b), a pair of a block that is a single shingle, a row (a: record, b: block) of a hot block.
_PAIR, _SINGLE, _HOT_ROW = 0, 1, 2
_MET = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])


def _met(hot: int):
    """(kind, a, b) of rows (block, record) sorted by both: the pairs of blocks of at most ``hot`` records, the rows of the others."""

    def rows(kind: np.ndarray | int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(np.broadcast_to(np.asarray(kind, np.int32), len(a))), pa.array(a), pa.array(b)], schema=_MET)

    def pairs(block: np.ndarray, same: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Of whole blocks."""
        at = _groups(block)
        size = np.repeat(np.diff(np.append(at, len(block))), np.diff(np.append(at, len(block))))
        yield rows(_HOT_ROW, same[size > hot], block[size > hot])
        block, same = block[(size > 1) & (size <= hot)], same[(size > 1) & (size <= hot)]
        for apart in range(1, min(hot, len(block))):
            i = np.flatnonzero(block[apart:] == block[:-apart])
            if not len(i):
                break
            yield rows((block[i] & 1).astype(np.int32) * _SINGLE, same[i], same[i + apart])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, same, over = np.empty(0, np.int64), np.empty(0, np.int64), None
        for b in batches:
            new = [b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)]
            if over is not None:
                # the hot block that the last batch ended with goes on
                more = int(np.searchsorted(new[0], over, "right"))
                if more:
                    yield rows(_HOT_ROW, new[1][:more], new[0][:more])
                    new = [x[more:] for x in new]
                if not len(new[0]):
                    continue
                over = None
            block, same = np.concatenate([block, new[0]]), np.concatenate([same, new[1]])
            # copies of a record emit blocks in every partition
            once = np.concatenate([[True], (block[1:] != block[:-1]) | (same[1:] != same[:-1])]) if len(block) else np.empty(0, bool)
            block, same = block[once], same[once]
            last = int(np.searchsorted(block, block[-1], "left")) if len(block) else 0
            if last:
                yield from pairs(block[:last], same[:last])
            block, same = block[last:], same[last:]
            if len(block) > hot:
                yield rows(_HOT_ROW, same, block)
                over, block, same = block[0], block[:0], same[:0]
        if len(block):
            yield from pairs(block, same)

    return run


def _near_sketches(threshold: float):
    """(a, b) of the records (rep, n, sketch, part) of a hot block, or of two parts of one, whose sketches the bound allows."""

    def run(table: pa.Table) -> pa.Table:
        n, part = (table.column(c).to_numpy() for c in ("n", "part"))
        sketch = table.column("sketch").combine_chunks()
        words, offset = np.diff(sketch.offsets.to_numpy()), sketch.offsets.to_numpy()[:-1]
        flat = sketch.values.to_numpy(zero_copy_only=False).view(np.uint64)
        lo, hi = part.min(), part.max()
        # rows of the first part against those of the second; where there is one part, every pair once
        one, two = np.flatnonzero(part == lo), np.flatnonzero(part == hi)
        bits = lambda rows: flat[offset[rows][:, None] + np.arange(words[rows[0]])[None]]
        found = []
        for short in np.unique(words[one]):
            left = one[words[one] == short]
            for other in np.unique(words[two]):
                right = two[words[two] == other]
                x, y = bits(left), bits(right)
                while x.shape[1] != y.shape[1]:
                    if x.shape[1] > y.shape[1]:
                        x = x[:, : x.shape[1] // 2] ^ x[:, x.shape[1] // 2 :]
                    else:
                        y = y[:, : y.shape[1] // 2] ^ y[:, y.shape[1] // 2 :]
                step = max(1, (1 << 21) // y.size)
                for k in range(0, len(left), step):
                    rows = left[k : k + step]
                    small, large = np.minimum(n[rows][:, None], n[right][None]), np.maximum(n[rows][:, None], n[right][None])
                    far = np.zeros(small.shape, np.int64)
                    for w in range(y.shape[1]):
                        far += np.bitwise_count(x[k : k + step, w][:, None] ^ y[:, w][None])
                    ok = (small >= threshold * large) & (far <= (1 - threshold) / (1 + threshold) * (small + large) + 1e-9)
                    if lo == hi:
                        ok &= rows[:, None] < right[None]
                    i, j = np.nonzero(ok)
                    found.append(np.stack([rows[i], right[j]]))
        at = np.concatenate(found, axis=1)
        return pa.table({"rep_a": table.column("rep").take(pa.array(at[0])), "rep_b": table.column("rep").take(pa.array(at[1]))})

    return run


def _slots(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits of a bitmap that 64-bit hashes set: hashes x BITMAP_HASHES."""
    h = hashes.view(np.uint64)
    return np.stack([(_mix(h + np.uint64(k)) % np.uint64(size)).astype(np.int64) for k in range(BITMAP_HASHES)], axis=1)


def bitmap_of(ids: DataFrame) -> bytes:
    """The bitmap of a column of hashes; put together piece by piece in the cluster, so the driver gets BITMAP_BITS bits at most."""
    size = min(BITMAP_BITS, max(_BITMAP_PIECE, 1 << (16 * ids.count()).bit_length()))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, bool)
        for b in batches:
            bits[_slots(b.column(0).to_numpy(zero_copy_only=False), size).ravel()] = True
        pieces = bits.reshape(-1, _BITMAP_PIECE)
        some = np.flatnonzero(pieces.any(axis=1))
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array([np.packbits(p).tobytes() for p in pieces[some]], pa.binary())], names=["piece", "bits"])

    def either(table: pa.Table) -> pa.Table:
        one = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in table.column("bits").to_pylist()])
        return pa.table({"piece": table.column("piece").slice(0, 1), "bits": pa.array([one.tobytes()], pa.binary())})

    whole = np.zeros((size // _BITMAP_PIECE, _BITMAP_PIECE // 8), np.uint8)
    merged = ids.mapInArrow(part, "piece int, bits binary").groupBy("piece").applyInArrow(either, "piece int, bits binary")
    for r in merged.collect():  # at most BITMAP_BITS / _BITMAP_PIECE rows
        whole[r["piece"]] = np.frombuffer(r["bits"], np.uint8)
    return whole.tobytes()


def in_bitmap(bitmap: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the bitmap; those that it was made of are."""
    bits, slot = np.frombuffer(bitmap, np.uint8), _slots(hashes, 8 * len(bitmap))
    return ((bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1).all(axis=1)


def marked_rows(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows of df whose key may be among ids (one column): what a join with ids then decides needs no shuffle of the rest."""
    bitmap = df.sparkSession.sparkContext.broadcast(bitmap_of(ids.select(F.xxhash64(ids.columns[0]))))
    hashed = df.withColumn("_hash", F.xxhash64(key))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(in_bitmap(bitmap.value, b.column(b.num_columns - 1).to_numpy(zero_copy_only=False))))

    return hashed.mapInArrow(run, hashed.schema).drop("_hash")


def _packed(bitmap):
    """Texts whose id may be needed, as compressed bytes for the way to their partners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            some = b.filter(pa.array(in_bitmap(bitmap.value, b.column(2).to_numpy(zero_copy_only=False))))
            yield pa.record_batch([some.column(0), pa.array([pack((t or "").encode()) for t in some.column(1).to_pylist()], pa.binary())], names=["id", "packed"])

    return run


def _verify(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        words = re.compile("[a-z0-9]+", re.A).findall
        last: tuple = (None, frozenset())

        def shingles(packed: bytes) -> frozenset:
            w = words(unpack(packed).decode().lower())
            return frozenset(zip(*(w[k:] for k in range(width))))

        for batch in batches:
            sims = []
            for ta, tb in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if last[0] != tb:
                    last = (tb, shingles(tb))
                a, b = shingles(ta), last[1]
                both = len(a & b)
                sims.append(both / max(1, len(a) + len(b) - both))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(sims, pa.float64())], names=["a", "b", "similarity"])

    return run


def record_text(*cols: str) -> Column:
    """The columns joined with blanks; a null is an empty text."""
    return F.concat_ws(" ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols))


def _apart(a: str, b: str, threshold: float) -> Column:
    """Hamming distance of two sketches, the longer one folded to the length of the shorter."""
    words = F.least(F.size(a), F.size(b))

    def narrow(x: Column, folds: int) -> Column:
        if not folds:
            return x
        half = (F.size(x) / 2).cast("int")
        folded = F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return narrow(F.when(F.size(x) > words, folded).otherwise(x), folds - 1)

    folds = math.ceil(math.log2(1 / threshold))
    both = F.zip_with(narrow(F.col(a), folds), narrow(F.col(b), folds), lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int"))
    return F.aggregate(both, F.lit(0), lambda s, x: s + x)


def near_duplicates(df: DataFrame, id_col: str, text: Column, threshold: float = 0.8, width: int = 5, block_load: float = 4.5, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """Classes (id, class) and links (a, b, similarity) between the representatives of classes, both materialized.

    class is the smallest id of the records with the same shingle set; a record without shingles is in neither table.
    Links hold a < b once, for every pair of different sets with a similarity of at least ``threshold``.
    """
    spark = df.sparkSession
    source = df.select(F.col(id_col).cast("string").alias("id"), text.alias("text"))
    sketched = materialize(
        source.mapInArrow(_sketch_batches(width, threshold, block_load, exact), "id string, n int, same bigint, sketch array<bigint>, blocks array<bigint>"), "sketches"
    )
    keys = sketched.select(F.explode("blocks").alias("block"), "same").repartition("block").sortWithinPartitions("block", "same")
    counted = keys.mapInArrow(_met(HOT), "kind int, a bigint, b bigint").groupBy("kind", "a", "b").agg(F.count("*").alias("c"))
    met = materialize(counted.where((F.col("kind") != _PAIR) | (F.col("c") >= AGREEMENTS)).drop("c"), "met")
    classes = sketched.groupBy("same").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    side = lambda s: classes.select(F.col("same").alias(s), F.col("rep").alias(f"rep_{s}"), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    bound = (1 - threshold) / (1 + threshold) * (F.col("n_a") + F.col("n_b"))
    sized = (F.col("n_a") >= threshold * F.col("n_b")) & (F.col("n_b") >= threshold * F.col("n_a"))
    pairs = met.where(F.col("kind") != _HOT_ROW).select("a", "b").distinct()
    left = pairs.join(side("a"), "a").join(side("b"), "b").where(sized & (_apart("sketch_a", "sketch_b", threshold) <= bound + 1e-9)).select("rep_a", "rep_b")
    hot = met.where(F.col("kind") == _HOT_ROW).select(F.col("a").alias("same"), F.col("b").alias("block"))
    parts = hot.groupBy("block").agg(F.ceil(F.count("*") / PART).alias("parts"))
    placed = hot.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("same"), "parts")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    grid = placed.select("same", "block", "part", F.least("part", "with").alias("one"), F.greatest("part", "with").alias("two")).join(classes, "same")
    right = grid.select("block", "one", "two", "part", "rep", "n", "sketch").groupBy("block", "one", "two").applyInArrow(_near_sketches(threshold), "rep_a string, rep_b string")
    candidates = materialize(left.union(right).select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct(), "candidates")
    bitmap = spark.sparkContext.broadcast(bitmap_of(candidates.select(F.explode(F.array(F.xxhash64("a"), F.xxhash64("b"))))))
    texts = source.select("id", "text", F.xxhash64("id").alias("hash")).mapInArrow(_packed(bitmap), "id string, packed binary")
    full = candidates.join(texts.select(F.col("id").alias("a"), F.col("packed").alias("text_a")), "a").join(texts.select(F.col("id").alias("b"), F.col("packed").alias("text_b")), "b")
    links = full.select("a", "b", "text_a", "text_b").mapInArrow(_verify(width), "a string, b string, similarity double").where(F.col("similarity") >= threshold)
    links = materialize(links.dropDuplicates(["a", "b"]), "links")  # an id may stand in several rows
    members = materialize(sketched.select("id", "same").join(classes.select("same", F.col("rep").alias("class")), "same").select("id", "class"), "members")
    release(sketched)
    release(met)
    release(candidates)
    return members, links


def expand_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """(a, b), a < b: every pair of records that classes and links imply, copies included."""
    left = members.select(F.col("class").alias("a"), F.col("id").alias("x"))
    right = members.select(F.col("class").alias("b"), F.col("id").alias("y"))
    across = links.select("a", "b").join(left, "a").join(right, "b").select("x", "y")
    repeated = members.groupBy("class").agg(F.count("*").alias("c")).where("c > 1").select("class")
    copies = members.join(repeated, "class")
    within = copies.select("class", F.col("id").alias("x")).join(copies.select("class", F.col("id").alias("y")), "class").where("x < y").select("x", "y")
    both = across.union(within)
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
