"""Training-order materialisation of token sequences.

1. Texts are encoded and cut into sequences of a fixed number of tokens (the last
   one of a text padded).
2. The ordinal of a sequence is its place in the stored corpus table, found the way Spark
   numbers rows: a first pass counts the sequences of every scan partition, a second one adds the
   count of the partitions before.  Only one number per partition is gathered.
3. A keyed Feistel permutation over the smallest power of two that holds all
   ordinals, walked until the value is an ordinal again (cycle-walking),
   gives every sequence its slot.  It is a bijection, so slots need no
   sort or collision check, and any slot can be computed alone.
4. Sequences are partitioned by shard (a range of consecutive slots) and written as
   fixed-stride records.  Record ``s`` of a shard starts at byte ``s * stride``, so a
   reader resumes at any slot by arithmetic.

A record is 8 bytes slot, 8 bytes id (the least 64-bit number for null), 4 bytes sequence number, 4 bytes token count
(these big-endian), the tokens as little-endian unsigned 16- or 32-bit numbers, padding zeros, and one newline.

The corpus must be a stored table, read by a plain scan: then both passes, and the repeat of a lost task,
see the same partitions.  Other frames are to be written first.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import named, release_shuffles, shared_path

ROUNDS = 6
HEAD = 24
NO_ID = -(1 << 63)
@dataclass(frozen=True)
class Layout:
    """How sequences and shards are cut."""

    length: int = 512
    per_shard: int = 16_384
    token_bytes: int = 2

    @property
    def stride(self) -> int:
        return HEAD + self.token_bytes * self.length + 1


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> tiktoken.Encoding:
    """One encoder per worker process, from a rank file; the number after the last rank is the end token."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_rows(text: str | None, enc: tiktoken.Encoding, layout: Layout) -> tuple[np.ndarray, int]:
    """(rows of ``layout.length`` tokens, number of tokens) of a text and its end token."""
    ids = enc.encode_ordinary(text or "")
    ids.append(enc.max_token_value + 1)
    if ids[-1] >= 256 ** layout.token_bytes:
        raise ValueError("token numbers do not fit")
    rows = np.zeros((-(-len(ids) // layout.length), layout.length), dtype=f"<u{layout.token_bytes}")
    # by way of an array, several times as fast as from the list
    rows.reshape(-1)[: len(ids)] = np.frombuffer(array("H" if layout.token_bytes == 2 else "I", ids), dtype=f"u{layout.token_bytes}")
    return rows, len(ids)


def _round_keys(key: str) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{key}/{r}".encode()).digest()[:8], "little") for r in range(ROUNDS)]


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """Round function: a 64-bit finaliser over half a block and a round key."""
    x = (x ^ np.uint64(key)) * np.uint64(0x9FB21C651E98DF25)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def permute(ordinals: np.ndarray, n: int, key: str) -> np.ndarray:
    """Slots of ordinals 0..n-1: a bijection on 0..n-1 that depends on ``key``."""
    bits = max(2, (n - 1).bit_length())
    low = np.uint64(bits // 2)
    high = np.uint64(bits - bits // 2)
    masks = [(np.uint64(1) << b) - np.uint64(1) for b in (low, high)]
    keys = _round_keys(key)

    def block(x: np.ndarray) -> np.ndarray:
        left, right = x >> low, x & masks[0]   # left has `high` bits, right has `low` bits
        for r, k in enumerate(keys):
            if r % 2:
                right = right ^ (_mix(left, k) & masks[0])
            else:
                left = left ^ (_mix(right, k) & masks[1])
        return (left << low) | right

    out = block(ordinals.astype(np.uint64))
    walk = np.flatnonzero(out >= np.uint64(n))
    while len(walk):
        out[walk] = block(out[walk])
        walk = walk[out[walk] >= np.uint64(n)]
    return out.astype(np.int64)


def count_sequences(rows: DataFrame, path: str, pattern: str, layout: Layout) -> dict[int, int]:
    """Sequences of every scan partition: one number per partition comes to the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, n = encoder(path, pattern), 0
        for b in batches:
            for text in b.column(1):
                n += -(-(len(enc.encode_ordinary(text.as_py() or "")) + 1) // layout.length)
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "n": [n]})

    return {r.part: r.n for r in rows.mapInArrow(count, "part long, n long").collect()}


_HEAD = [("slot", ">i8"), ("id", ">i8"), ("seq_no", ">i4"), ("n_tokens", ">i4")]
RECORDS = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("slot", T.LongType()), T.StructField("id", T.LongType()),
    T.StructField("seq_no", T.IntegerType()), T.StructField("n_tokens", T.IntegerType()), T.StructField("body", T.BinaryType()),
    T.StructField("byte_offset", T.LongType())])


def _record(layout: Layout) -> np.dtype:
    return np.dtype([*_HEAD, ("body", f"V{layout.token_bytes * layout.length}"), ("end", "V1")])


def write_shards(rows: DataFrame, counts: dict[int, int], encoding: tuple[str, str], key: str, layout: Layout, path: str) -> None:
    """Records of all sequences in slot order, one file per shard folder
    ``shard=K``, shard K holding slots ``K * per_shard`` and following."""
    n = sum(counts.values())
    parts = sorted(counts)
    ends = np.cumsum([0, *(counts[p] for p in parts)]).tolist()
    first = rows.sparkSession.sparkContext.broadcast(dict(zip(parts, zip(ends[:-1], ends[1:], strict=True), strict=True)))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.dtype([*_HEAD, ("body", f"<u{layout.token_bytes}", layout.length)])
        enc, here = encoder(*encoding), TaskContext.get().partitionId()
        at, end = first.value[here]
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                cut = [token_rows(t.as_py(), enc, layout) for t in part.column(1)]
                sizes = np.array([len(r) for r, _ in cut])
                out = np.zeros(sizes.sum(), dtype=kind)
                out["slot"] = permute(np.arange(at, at + len(out)), n, key)
                out["id"] = np.repeat(part.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False), sizes)
                out["seq_no"] = np.arange(len(out)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                tokens = np.repeat([k for _, k in cut], sizes)
                out["n_tokens"] = np.minimum(layout.length, tokens - out["seq_no"].astype(np.int64) * layout.length)
                out["body"] = np.concatenate([r for r, _ in cut])
                at += len(out)
                slot = out["slot"].astype(np.int64)
                blob, size = out.tobytes(), kind.itemsize
                value = pa.array([blob[k:k + size] for k in range(0, len(blob), size)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(slot // layout.per_shard), pa.array(slot), value], names=["shard", "slot", "value"])
        if at != end:  # else two sequences would share a slot
            raise RuntimeError(f"partition {here} ended at ordinal {at}, the first pass counted up to {end}: the corpus is not a stored table, or has changed")

    shards = max(1, -(-n // layout.per_shard))
    made = rows.mapInArrow(records, "shard long, slot long, value binary")
    # ranges of shards: every task writes the same number of them, give or take one
    tasks = min(shards, 20_000)
    placed = made.repartitionById(tasks, (F.col("shard") * F.lit(tasks) / F.lit(shards)).cast("int")).sortWithinPartitions("shard", "slot")
    # the text writer puts bytes as they are and ends each record with the newline
    out = placed.select("shard", F.col("value").cast("string").alias("value"))
    out.write.partitionBy("shard").option("compression", "none").text(path)


def _schema(digest: bool) -> T.StructType:
    return T.StructType([T.StructField("body_sha256", T.StringType()) if digest and f.name == "body" else f for f in RECORDS])


def read_shards(spark: SparkSession, path: str, layout: Layout, first_slot: int = 0, digest: bool = False) -> DataFrame:
    """(shard, slot, id, seq_no, n_tokens, body, byte_offset) of all records from
    ``first_slot`` on; whole shards before it are not opened, records before it are skipped by arithmetic.  With ``digest`` the
    hexadecimal ``body_sha256`` comes in place of the body."""
    first_shard = first_slot // layout.per_shard
    files = (spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary, shard long")
             .option("pathGlobFilter", "part-*").load(path).where(F.col("shard") >= first_shard).select("shard", "content"))
    skip = first_slot - first_shard * layout.per_shard

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record = _record(layout)
        for b in batches:
            for shard, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                recs = np.frombuffer(content.as_buffer(), dtype=record)
                for at in range(skip if shard == first_shard else 0, len(recs), 1024):
                    r = recs[at:at + 1024]
                    cols = [np.full(len(r), shard)] + [r[c].astype(r[c].dtype.newbyteorder("=")) for c in ("slot", "id", "seq_no", "n_tokens")]
                    cols[2] = pa.array(cols[2], mask=cols[2] == NO_ID)
                    offset = np.arange(at, at + len(r), dtype=np.int64) * record.itemsize
                    body = pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in r["body"]]) if digest else pa.array([x.tobytes() for x in r["body"]], pa.binary())
                    yield pa.RecordBatch.from_arrays([*map(pa.array, cols), body, pa.array(offset)], names=names)

    names = _schema(digest).names
    return files.mapInArrow(cut, _schema(digest))


def materialise(docs: DataFrame, encoding: tuple[str, str], key: str, layout: Layout | None = None, out: str | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> tuple[str, int]:
    """Encode, order and write a stored corpus; returns (folder of the shards, number of sequences).

    ``encoding`` is a rank file and its split pattern.
    Every row gives at least one sequence, null and empty texts included; rows
    that repeat are sequences of their own; null ids stay null; ids must be numbers or texts of numbers, others fail the cast; texts of any
    length are encoded whole; an empty table gives no shard; further columns are not read."""
    spark = docs.sparkSession
    layout = layout or Layout()
    out = out or shared_path(spark, "shards")
    rows = docs.select(named(docs, id_col).cast("long").alias("id"), named(docs, text_col).alias("text"))
    counts = count_sequences(rows, *encoding, layout)
    if sum(counts.values()):
        write_shards(rows, counts, encoding, key, layout, out)
        release_shuffles(spark)
    return out, sum(counts.values())


def empty_records(spark: SparkSession, digest: bool = False) -> DataFrame:
    return spark.createDataFrame([], _schema(digest))
