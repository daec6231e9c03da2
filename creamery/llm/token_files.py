"""Token-id blocks with Elias-Fano coded document boundaries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamery.llm.bpe import IdEncoder, word_bpe_path
from creamery.llm.common import table
from creamery.session import scratch_dir

SAMPLE = 256
SCHEMA = "part int, offset long, n_ids long, n_docs long, n_null long, doc_ids binary, low_bits int, low binary, high binary, marks binary, ids binary"


class EliasFano:
    """A non-decreasing sequence in about 2 + log2(range / n) bits a value.

    ``low`` holds the low bits, ``high`` the upper ones in unary, ``marks``
    the place of every 256th one, from which ``select`` starts.
    """

    def __init__(self, low_bits: int, low: bytes, high: bytes, marks: bytes, n: int):
        self.low_bits, self.n = low_bits, n
        self.low, self.high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        self.marks = np.frombuffer(marks, "<u8")

    @staticmethod
    def encode(values: np.ndarray) -> "EliasFano":
        v = np.asarray(values, dtype=np.int64)
        n = len(v)
        k = max(0, int(v[-1] // n).bit_length() - 1) if n else 0
        ones = (v >> k) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        low = ((v[:, None] >> np.arange(k)) & 1).astype(np.uint8)
        pack = lambda b: np.packbits(b, bitorder="little").tobytes()
        return EliasFano(k, pack(low.ravel()), pack(high), ones[::SAMPLE].astype("<u8").tobytes(), n)

    def select(self, i: int) -> int:
        """Value ``i``."""
        at = int(self.marks[i // SAMPLE])
        need, byte = i % SAMPLE, at // 8
        bits = np.unpackbits(self.high[byte : byte + 64], bitorder="little")
        bits[: at % 8] = 0
        base = byte * 8
        while (c := int(bits.sum())) <= need:
            need -= c
            byte += 64
            base = byte * 8
            bits = np.unpackbits(self.high[byte : byte + 64], bitorder="little")
        place = base + int(np.flatnonzero(bits)[need])
        k = self.low_bits
        span = np.unpackbits(self.low[i * k // 8 : (i * k + k + 7) // 8], bitorder="little")[i * k % 8 :][:k]
        return (place - i) << k | int((span.astype(np.int64) << np.arange(k)).sum())

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        k = self.low_bits
        low = np.unpackbits(self.low, bitorder="little")[: self.n * k].reshape(self.n, k).astype(np.int64)
        return (ones - np.arange(self.n)) << k | (low << np.arange(k)).sum(axis=1)


def write_blocks(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1, block_ids: int = 1 << 20) -> None:
    """Write the ids of ``docs`` (doc_id, text) below ``path``, in ascending doc_id.

    Texts are dealt by doc_id range, sorted, encoded, and cut into blocks of
    about ``block_ids`` ids (a longer document is a block of its own): ids as
    little-endian uint32, boundaries Elias-Fano coded. Null texts hold the end
    id alone; null doc_ids come first; equal doc_ids lie side by side. Ids are
    those of the library's encode, made by ``bpe.IdEncoder``. An empty table
    writes no block; other columns are not read.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches):
        enc, part, offset = IdEncoder.of_worker(tokenizer), TaskContext.get().partitionId(), 0
        end = end_id.to_bytes(4, "little")
        held, keys, total = [], [], 0

        def block():
            ends = np.cumsum([0] + [len(h) // 4 for h in held])
            ef = EliasFano.encode(ends)
            known = np.array([k for k in keys if k is not None], dtype="<i8")
            row = (part, offset, total, len(keys), len(keys) - len(known), known.tobytes(), ef.low_bits, ef.low.tobytes(), ef.high.tobytes(), ef.marks.tobytes(), b"".join(held))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names)

        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"]):
                ids = enc.packed(text.as_py()) + end
                if held and total + len(ids) // 4 > block_ids:
                    yield block()
                    offset, held, keys, total = offset + total, [], [], 0
                held.append(ids)
                keys.append(doc_id.as_py())
                total += len(ids) // 4
        if held:
            yield block()

    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [{"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in SCHEMA.split(", ")]
    ranged.mapInArrow(run, SCHEMA).write.parquet(path)


def _offsets(ends: EliasFano) -> np.ndarray:
    """Where the documents of a block start, and its end, each by ``select``."""
    return np.array([ends.select(i) for i in range(ends.n)], dtype=np.int64)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of each stored document; ids as little-endian bytes."""
    blocks = spark.read.parquet(path)
    base, rows = 0, []
    # one row per range partition, whatever the size of the corpus
    for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():
        rows.append((r["part"], base))
        base += r["n"]
    starts = spark.createDataFrame(rows, "part int, base long")

    def run(batches):
        for b in batches:
            small = b.drop_columns(["ids"]).to_pylist()
            for r, raw in zip(small, b["ids"]):  # one block's ids at a time
                ends = _offsets(EliasFano(r["low_bits"], r["low"], r["high"], r["marks"], r["n_docs"] + 1))
                keys = [None] * r["n_null"] + np.frombuffer(r["doc_ids"], "<i8").tolist()
                lists = pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer((ends * 4).astype(np.int32).tobytes()), raw.as_buffer()])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(ends[:-1] + r["base"] + r["offset"]), pa.array(np.diff(ends)), lists],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return blocks.join(F.broadcast(starts), "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-blocks")
    write_blocks(table(spark, sf_dir, "documents"), word_bpe_path(), path)
    return read_blocks(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
