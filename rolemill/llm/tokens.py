"""Encoding of a whole corpus with a public byte-level BPE tokenizer.

Method: global distinct-word shuffle. Pre-tokens (words) are exploded with their positions, each distinct word is
encoded once for the whole corpus, and the ids are joined back and put together by position. Two things keep the
shuffle small:

* positions are kept per chunk of documents as codes into the chunk's own word list, so a chunk ships one row per
  distinct word instead of one per occurrence, and a word that makes up a third of the corpus is one row per chunk
  (and meets those of 2^SALT_BITS input partitions in one task, so it is encoded once for each such group);
* the codes of a chunk travel as one compressed block through the same two exchanges.

A chunk is about ``CHUNK_CHARS`` characters of text (one longer document is a chunk of its own), so the memory of a
task depends on the chunk and not on the corpus. Recomputing a lost partition gives the same chunks as long as the
input is a table scan; give a materialized table when it isn't.

Null, empty: an empty id list. Every row gives one row, rows with equal or null keys included. Other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_CHARS = 6_000_000
DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pre-token pattern of the byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts of ASCII alone, and with the white space of the tokenizers' own regex engines (U+001C to U+001F aren't).
_ASCII = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
_ANY = PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")

_encoders: dict[str, object] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """The token-byte table of a vocabulary file: one base64 token and its id a line."""
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def encoder(path: str):
    """bytes of one pre-token -> its ids; loaded once per Python worker."""
    if path not in _encoders:
        import tiktoken

        enc = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
        _encoders[path] = enc._core_bpe.encode_single_piece
    return _encoders[path]


class _Codes(dict):
    """Gives each new word the next code."""

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        return code


SALT_BITS = 8
_FLAT = pa.schema([("chunk", pa.int64()), ("code", pa.int32()), ("word", pa.binary()), ("block", pa.binary())])


def _chunk_rows(chunk: int, words: _Codes, docs: list, lens: list[int], codes: list[np.ndarray], as_text: bool) -> pa.RecordBatch:
    import zstandard

    flat = np.concatenate(codes) if codes else np.empty(0, np.int32)
    wide = np.uint16 if len(words) < 65536 else np.uint32
    keys = pa.array(docs, pa.string() if as_text else pa.int64())
    sink = pa.BufferOutputStream()
    head = pa.record_batch([keys, pa.array(lens, pa.int32())], names=["doc", "n"])
    with pa.ipc.new_stream(sink, head.schema) as w:
        w.write_batch(head)
    meta = sink.getvalue().to_pybytes()
    body = zstandard.ZstdCompressor(level=1).compress(struct.pack("<qqb", len(meta), len(flat), wide().itemsize) + meta + flat.astype(wide).tobytes())
    n = len(words)
    return pa.record_batch(
        [
            pa.array(np.full(n + 1, chunk, np.int64)),
            pa.array(np.arange(-1, n, dtype=np.int32)),
            pa.array([None, *(w.encode("utf-8", "surrogatepass") for w in words)], pa.binary()),
            pa.array([body, *[None] * n], pa.binary()),
        ],
        schema=_FLAT,
    )


def _split(as_text: bool, chunk_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        import regex
        from pyspark import TaskContext

        any_text, ascii_text = regex.compile(_ANY).findall, re.compile(_ASCII, re.A).findall
        chunk = TaskContext.get().partitionId() << 32
        words, docs, lens, codes, chars = _Codes(), [], [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if chars and chars + len(text or "") > chunk_chars:
                    yield _chunk_rows(chunk, words, docs, lens, codes, as_text)
                    chunk += 1
                    words, docs, lens, codes, chars = _Codes(), [], [], [], 0
                docs.append(doc)
                found = (ascii_text if text.isascii() else any_text)(text) if text else ()
                lens.append(len(found))
                if found:
                    codes.append(np.fromiter(map(words.__getitem__, found), np.int32, len(found)))
                chars += len(text or "") + 1
        if docs:
            yield _chunk_rows(chunk, words, docs, lens, codes, as_text)

    return run


_CODED = pa.schema([("chunk", pa.int64()), ("code", pa.int32()), ("ids", pa.binary()), ("block", pa.binary())])


def _encode_words(path: str):
    """Rows come sorted by word: every distinct word is encoded once, rows of a chunk's positions pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last, kept = encoder(path), None, b""
        for batch in batches:
            distinct = batch.column(2).dictionary_encode()
            coded = []
            for word in distinct.dictionary.to_pylist():
                if word != last:
                    last, kept = word, np.asarray(encode(word), np.int32).tobytes()
                coded.append(kept)
            ids = pa.array(coded, pa.binary()).take(distinct.indices) if coded else pa.nulls(batch.num_rows, pa.binary())
            yield pa.record_batch([batch.column(0), batch.column(1), ids, batch.column(3)], schema=_CODED)

    return run


def _assemble(as_text: bool, count_only: bool):
    def run(table: pa.Table) -> pa.Table:
        import zstandard

        table = table.combine_chunks()
        code = np.asarray(table.column("code"))
        order = np.argsort(code, kind="stable")
        first = int(order[0])
        if code[first] != -1:
            raise ValueError("a chunk lost its positions; give a materialized table as input")
        body = zstandard.ZstdDecompressor().decompress(table.column("block")[first].as_py())
        n_meta, n_flat, width = struct.unpack_from("<qqb", body)
        head = pa.ipc.open_stream(pa.py_buffer(body[17 : 17 + n_meta])).read_all().combine_chunks()
        flat = np.frombuffer(body, {2: np.uint16, 4: np.uint32}[width], n_flat, 17 + n_meta).astype(np.int64)
        ids = table.column("ids").take(pa.array(order[1:])).combine_chunks()
        if isinstance(ids, pa.ChunkedArray):
            ids = pa.concat_arrays(ids.chunks) if ids.num_chunks else pa.array([], pa.binary())
        sizes = np.asarray(pa.compute.binary_length(ids)).astype(np.int64) // 4
        values = np.frombuffer(b"".join(ids.to_pylist()), np.int32)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        doc_n = np.asarray(head.column("n")).astype(np.int64)
        each = sizes[flat] if len(flat) else np.empty(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(each)])
        bounds = ends[np.concatenate([[0], np.cumsum(doc_n)])]
        docs = head.column("doc").combine_chunks()
        if count_only:
            return pa.table({"doc": docs, "n_tokens": pa.array(np.diff(bounds).astype(np.int64))})
        at = np.arange(ends[-1]) - np.repeat(ends[:-1] - starts[flat], each) if len(flat) else np.empty(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values[at]))
        return pa.table({"doc": docs, "ids": lists})

    return run


def _encoded(df: DataFrame, id_col: str, text_col: str, tokenizer: str, count_only: bool, chunk_chars: int) -> DataFrame:
    as_text = not isinstance(df.schema[id_col].dataType, T.IntegralType)
    key = F.col(id_col).cast("string" if as_text else "bigint")
    words = df.select(key.alias("doc"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _split(as_text, chunk_chars), "chunk bigint, code int, word binary, block binary"
    )
    coded = (
        words.repartition(F.when(F.col("word").isNull(), F.xxhash64("chunk")).otherwise(F.xxhash64("word", F.shiftright("chunk", 32 + SALT_BITS))))
        .sortWithinPartitions("word")
        .mapInArrow(_encode_words(tokenizer), "chunk bigint, code int, ids binary, block binary")
    )
    kind = "doc string" if as_text else "doc bigint"
    done = coded.groupBy("chunk").applyInArrow(_assemble(as_text, count_only), kind + (", n_tokens bigint" if count_only else ", ids array<int>"))
    return done.withColumnRenamed("doc", id_col).withColumn(id_col, F.col(id_col).cast(df.schema[id_col].dataType))


def encode_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = DEFAULT_TOKENIZER, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(id, ids array<int>): the token ids of every row's text, without special tokens."""
    return _encoded(df, id_col, text_col, tokenizer, False, chunk_chars)


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = DEFAULT_TOKENIZER, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(id, n_tokens bigint): the number of tokens of every row's text; 0 for null and empty."""
    return _encoded(df, id_col, text_col, tokenizer, True, chunk_chars)


def token_table(spark, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """(id int, piece binary): as many rows as the vocabulary has, so it may be broadcast."""
    rows = read_ranks(tokenizer)
    return spark.createDataFrame(pa.table({"id": pa.array(list(rows.values()), pa.int32()), "piece": pa.array(list(rows), pa.binary())}))


def decode_corpus(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """(id, text) of (id, ids) through a join with the token-byte table.

    An id that the vocabulary lacks adds nothing; bytes that aren't UTF-8 become U+FFFD; null and empty lists give an
    empty text. Keys are taken as unique.
    """
    table = F.broadcast(token_table(df.sparkSession, tokenizer))
    pieces = df.select(F.col(id_col), F.posexplode_outer(ids_col).alias("pos", "id")).join(table, "id", "left")
    whole = pieces.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("p"))

    def text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [b"".join(x["piece"] or b"" for x in p).decode("utf-8", "replace") for p in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(out, pa.string())], names=[id_col, "text"])

    return whole.mapInArrow(text, T.StructType([df.schema[id_col], T.StructField("text", T.StringType())]))
