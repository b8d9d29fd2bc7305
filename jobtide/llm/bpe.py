"""BPE encoding and decoding through a table of distinct words.

A text is split into words at ASCII white space, over which no token of a word-level tokenizer
reaches. Texts travel in chunks. Each chunk sends its distinct words to buckets chosen by the
word's hash; a bucket encodes each distinct word once, however many chunks have it, and answers
every chunk with the ids of its words in order. The chunk joins the ids back by position. What is
shuffled for a frequent word is one row entry per chunk, so no word is hot.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.chunks import BUCKET_BYTES, answers_of, chunks, packed, unpacked
from jobtide.llm.common import arrow_column, byte_view, release, steps, word_hashes

AT_ONCE = 4096


@cache
def _tokenizer(text: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_str(text)
    out.no_truncation()
    out.no_padding()
    return out


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words in order of first occurrence, the number of the word at each position, and
    the number of words of each text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    parts = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    words = parts.flatten()
    rows = np.repeat(np.arange(len(parts)), pc.list_value_length(parts).to_numpy())
    full = pc.not_equal(pc.binary_length(words), 0)
    table = words.filter(full).dictionary_encode()
    counts = np.bincount(rows[full.to_numpy(zero_copy_only=False)], minlength=len(parts))
    return table.dictionary, table.indices.to_numpy(), counts


def _by_bucket(words: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of distinct words by bucket and inside it by bytes, the buckets, and their ends."""
    flat, offsets = byte_view(words)
    order = pc.sort_indices(words).to_numpy().astype(np.int64)
    bucket = (word_hashes(flat, offsets)[0] % np.uint64(n)).astype(np.int64)[order]
    order = order[np.argsort(bucket, kind="stable")]
    names, counts = np.unique(bucket, return_counts=True)
    return order, names, np.concatenate([[0], np.cumsum(counts)])


def _asked(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for name, table in chunks(batches):
            words = split_words(table["text"])[0].cast(pa.binary())
            order, buckets, cuts = _by_bucket(words, n)
            words = words.take(pa.array(order))
            # no word has a line break
            lists = [press.compress(b"\n".join(words.slice(a, b - a).to_pylist()))
                     for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(buckets), pa.binary()), pa.array(buckets), pa.array(lists, pa.binary())],
                ["chunk", "bucket", "words"])
    return run


def _answers(sent, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _tokenizer(sent.value)
        press, open_ = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        now, known = None, {}
        for batch in batches:
            out = []
            for bucket, packed_words in zip(batch.column("bucket").to_pylist(), batch.column("words"), strict=True):
                if bucket != now:
                    now, known = bucket, {}
                    release()
                words = open_.decompress(packed_words.as_py()).split(b"\n")
                new = [w for w in words if w not in known]
                # the library returns far more for a word than its ids
                for i in range(0, len(new), AT_ONCE):
                    part = new[i:i + AT_ONCE]
                    for w, code in zip(part, coder.encode_batch_fast(
                            [w.decode("utf-8", "replace") for w in part], add_special_tokens=False), strict=True):
                        known[w] = np.array(code.ids, kind).tobytes()
                codes = [known[w] for w in words]
                sizes = np.array([len(c) for c in codes], "<u4").tobytes()
                out.append(press.compress(sizes + b"".join(codes)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("chunk"), batch.column("bucket"), pa.array(out, pa.binary())],
                ["chunk", "bucket", "ids"])
    return run


def _joined(n: int, kind: str):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Ids of each text of one chunk, from the answers of all buckets."""
        answers, out = answers_of(right, ["ids"]), []
        open_, wide = zstandard.ZstdDecompressor(), np.dtype(kind).itemsize
        for table in unpacked(left):
            words, codes, counts = split_words(table["text"])
            order, buckets, cuts = _by_bucket(words.cast(pa.binary()), n)
            sizes, flat = [], []
            for bucket, a, b in zip(buckets.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                data = open_.decompress(answers[bucket][0].as_py())
                sizes.append(np.frombuffer(data, "<u4", b - a))
                flat.append(np.frombuffer(data, kind, offset=4 * (b - a)))
            none = np.zeros(0, kind)
            sizes, flat = np.concatenate([*sizes, none]).astype(np.int64) // wide, np.concatenate([*flat, none])
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            at = place[codes]
            del words, codes
            lens = sizes[at]
            small = np.int32 if max(len(flat), int(lens.sum())) < 1 << 31 else np.int64
            take = np.repeat(((np.cumsum(sizes) - sizes)[at] - (np.cumsum(lens) - lens)).astype(small), lens)
            take += np.arange(len(take), dtype=small)
            ids = flat[take].astype("<u4")
            ends = np.concatenate([[0], np.cumsum(lens)])[np.concatenate([[0], np.cumsum(counts)])]
            coded = pa.Array.from_buffers(
                pa.binary(), len(counts),
                [None, pa.py_buffer((ends * 4).astype(np.int32).tobytes()), pa.py_buffer(ids.tobytes())])
            out.append(pa.table({"id": table["id"], "ids": coded}))
        release()
        return pa.concat_tables(out)
    return run


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the token ids of each whole text, as little-endian 32-bit numbers side by side.

    A null or empty text has no ids. Equal rows are kept. The rows of `docs` must come in the same
    order whenever they are read, as those of a stored table do; a chunk that changed between its
    two reads stops the job. `path` names the tokenizer's file on the driver.
    """
    spark = docs.sparkSession
    with open(path, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    key_kind = rows.schema["id"].dataType.simpleString()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(max(16, total // BUCKET_BYTES + 1))
    kind = "<u2" if _tokenizer(sent.value).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
    whole = rows.mapInArrow(packed, "chunk binary, rows binary")
    asked = rows.mapInArrow(_asked(n), "chunk binary, bucket bigint, words binary")
    answers = (asked.repartition("bucket").sortWithinPartitions("bucket")
               .mapInArrow(_answers(sent, kind), "chunk binary, bucket bigint, ids binary"))
    return (whole.groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(_joined(n, kind), f"id {key_kind}, ids binary")
            .select(F.col("id").alias(key), "ids"))


def _pieces(text: str) -> list[str]:
    coder = _tokenizer(text)
    size = coder.get_vocab_size(with_added_tokens=True)
    return [coder.id_to_token(i) or "" for i in range(size)]


def decode(coded: DataFrame, path: str, ids: str = "ids", name: str = "text") -> DataFrame:
    """Add the text of packed ids: each id is joined with its piece, and the pieces of a text are
    put side by side with spaces, as the library does for a tokenizer without a decoder.

    The table of pieces is as large as the vocabulary and goes to every task. No ids give an empty
    text, and so does null.
    """
    with open(path, encoding="utf-8") as f:
        sent = coded.sparkSession.sparkContext.broadcast(_pieces(f.read()))

    def make():
        pieces = pa.array(sent.value, pa.string())

        def run(column: pa.Array) -> pa.Array:
            flat, offsets = byte_view(column)
            out = []
            for a, b in steps(np.diff(offsets)):
                part = np.frombuffer(flat[offsets[a]:offsets[b]].tobytes(), "<u4")
                lists = pa.ListArray.from_arrays(
                    pa.array(((offsets[a:b + 1] - offsets[a]) // 4).astype(np.int32)),
                    pieces.take(pa.array(part)))
                out.append(pc.binary_join(lists, " "))
            return pa.concat_arrays(out) if out else pa.array([], pa.string())
        return run

    return arrow_column(coded, ids, name, "string", make)
