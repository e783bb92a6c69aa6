"""Token files: canonical length-limited Huffman coding of token ids.

``write_token_files`` tokenizes every whole text, appends an end id, counts
all ids over the corpus, builds one canonical code (lengths at most
``MAX_BITS`` by package-merge) and writes blocks in ascending doc_id order.
``read_token_files`` decodes them.

File format, a folder with two Parquet tables (Spark's committed writers, so
a lost executor leaves no torn file, and any store Spark can write will do):

* ``code``: token, bits.  Canonical: codes follow from the lengths, by
  (bits, token).
* ``blocks``: shard (files in doc_id order), block (in a shard), n_tokens,
  doc_ids and doc_tokens (per document), payload (big-endian bit string),
  checkpoints (bit offset of every ``STRIDE``-th symbol).  A block holds
  whole documents and is decoded by itself; the checkpoints let one block be
  decoded in parallel lanes or entered in the middle.

Defined cases: null text is the empty text (its ids are the end id alone);
a null doc_id sorts first; rows with the same doc_id are all kept, ordered
by their ids; an empty table gives no blocks; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rewardseg.llm.common import byte_sizes, slices, stage, table
from rewardseg.llm.tokens import SLICE_BYTES, default_tokenizer, encoder, with_end
from rewardseg.session import ensure_checkpoint_dir

MAX_BITS = 20
STRIDE = 256
BLOCK_TOKENS = 1 << 18
END_ID = 0


# -- the code ---------------------------------------------------------------

def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` by package-merge; 0 for
    ids that do not occur."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids need more than {max_bits} bits")
    leaves = used[np.argsort(counts[used], kind="stable")]
    weights = counts[leaves].astype(np.int64)
    levels, packages = [], np.empty(0, np.int64)
    for _ in range(max_bits):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        levels.append(order < len(weights))
        merged = merged[order]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * len(leaves) - 2
    for is_leaf in reversed(levels):
        n_leaves = int(is_leaf[:take].sum())
        lengths[leaves[:n_leaves]] += 1
        take = 2 * (take - n_leaves)
    return lengths


def canonical_codes(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes per id, ids in code order) of the canonical code."""
    ids = np.flatnonzero(lengths)
    ids = ids[np.lexsort((ids, lengths[ids]))]
    bits = lengths[ids].astype(np.int64)
    widest = int(bits[-1]) if len(bits) else 1
    steps = np.int64(1) << (widest - bits)
    codes = np.zeros(len(lengths), np.uint64)
    codes[ids] = ((np.cumsum(steps) - steps) >> (widest - bits)).astype(np.uint64)
    return codes, ids


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(payload, bit offset of every STRIDE-th symbol)."""
    width = lengths[ids]
    ends = np.cumsum(width)
    at = ends - width
    total = int(ends[-1]) if len(ends) else 0
    word, shift = at >> 5, (64 - (at & 31) - width).astype(np.uint64)
    both = codes[ids] << shift
    n_words = (total + 31) // 32 + 1
    # the parts of a word share no bit, so sums below 2**32 (exact in floats) are their union
    high = np.bincount(word, (both >> np.uint64(32)).astype(np.float64), n_words)
    low = np.bincount(word + 1, (both & np.uint64(0xFFFFFFFF)).astype(np.float64), n_words + 1)[:n_words]
    payload = (high + low).astype(np.uint64).astype(">u4").tobytes()[: (total + 7) // 8]
    return payload, at[::STRIDE].astype(np.int64)


class Decoder:
    """Table-driven: the next ``widest`` bits index (symbol, width)."""

    def __init__(self, lengths: np.ndarray):
        _, ids = canonical_codes(lengths)
        bits = lengths[ids].astype(np.int64)
        self.widest = int(bits.max()) if len(bits) else 1
        spans = np.int64(1) << (self.widest - bits)
        self.symbol = np.zeros(1 << self.widest, np.uint32)
        self.width = np.ones(1 << self.widest, np.int64)
        self.symbol[: spans.sum()] = np.repeat(ids, spans)
        self.width[: spans.sum()] = np.repeat(bits, spans)

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """All ``n`` symbols; every checkpoint is a lane, read in lockstep."""
        raw = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint64)
        near = (raw[:-3] << np.uint64(24)) | (raw[1:-2] << np.uint64(16)) | (raw[2:-1] << np.uint64(8)) | raw[3:]
        near = near.astype(np.int64)
        at, lanes = checkpoints.astype(np.int64), len(checkpoints)
        out = np.zeros((STRIDE, lanes), np.uint32)
        mask, spare, last = (1 << self.widest) - 1, 32 - self.widest, len(near) - 1
        for step in range(min(STRIDE, n)):
            key = (near[np.minimum(at >> 3, last)] >> (spare - (at & 7))) & mask
            out[step] = self.symbol[key]
            at = at + self.width[key]
        return out.T.reshape(-1)[:n]


# -- tokenizing -------------------------------------------------------------

def token_rows(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, n_tokens, ids): every whole text's ids with the end id, as
    little-endian 16-bit numbers (32-bit where the vocabulary needs them)."""
    def run(batches):
        enc = encoder(tokenizer)
        kind = "<u2" if enc.vocab_size() <= 1 << 16 else "<u4"
        for batch in batches:
            texts = batch.column(1)
            for start, stop in slices(byte_sizes(texts), SLICE_BYTES):
                ids, per_text = with_end(*enc.encode(texts.slice(start, stop - start)), end_id)
                ends = np.cumsum(per_text)
                flat = ids.astype(kind)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), pa.array(per_text, pa.int64()),
                     pa.array([flat[e - n:e].tobytes() for e, n in zip(ends, per_text)], pa.binary())],
                    ["doc_id", "n_tokens", "ids"])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n_tokens long, ids binary"))


def token_counts(rows: DataFrame, width: int, vocab: int) -> DataFrame:
    """(token, n) over all documents: one array per task, then summed."""
    def run(batches):
        total = np.zeros(vocab, np.int64)
        for batch in batches:
            ids = batch.column(0)
            for lo, hi in slices(byte_sizes(ids), SLICE_BYTES):
                part = np.frombuffer(b"".join(ids.slice(lo, hi - lo).to_pylist()), f"<u{width}")
                total += np.bincount(part, minlength=vocab)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["token", "n"])
    return rows.select("ids").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


# -- writing and reading ----------------------------------------------------

BLOCKS = ("shard int, block int, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
          "payload binary, checkpoints array<long>")


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    tokenizer = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    rows = stage(token_rows(docs, tokenizer, end_id), "ids")
    vocab = max(encoder(tokenizer).vocab_size(), end_id + 1)
    width = 2 if vocab <= 1 << 16 else 4
    # at most one row per id of the vocabulary reaches the driver
    counts = np.zeros(vocab, np.int64)
    for token, n in token_counts(rows, width, vocab).collect():
        counts[token] = n
    lengths = code_lengths(counts)
    code = [(int(t), int(lengths[t])) for t in np.flatnonzero(lengths)]
    spark.createDataFrame(code, "token int, bits int").coalesce(1).write.parquet(f"{path}/code")

    def run(batches):
        from pyspark import TaskContext
        shard, block = TaskContext.get().partitionId(), 0
        codes, _ = canonical_codes(lengths)
        held, n_held = [], 0

        def flush():
            nonlocal held, n_held, block
            ids = np.frombuffer(b"".join(x for _, _, x in held), f"<u{width}")
            payload, checkpoints = pack_bits(ids, codes, lengths)
            out = pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.array([[d for d, _, _ in held]], pa.list_(pa.int64())),
                 pa.array([[n for _, n, _ in held]], pa.list_(pa.int64())),
                 pa.array([payload], pa.binary()), pa.array([checkpoints], pa.list_(pa.int64()))],
                ["shard", "block", "n_tokens", "doc_ids", "doc_tokens", "payload", "checkpoints"])
            held, n_held, block = [], 0, block + 1
            return out

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                held.append(row)
                n_held += row[1]
                if n_held >= BLOCK_TOKENS:
                    yield flush()
        if held:
            yield flush()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"))
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"))
     .mapInArrow(run, BLOCKS).write.parquet(f"{path}/blocks"))


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from
    the files; ``with_ids`` adds the ids themselves."""
    code = spark.read.parquet(f"{path}/code").collect()  # at most the vocabulary
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    lengths = np.zeros(max((r["token"] for r in code), default=0) + 1, np.int64)
    for r in code:
        lengths[r["token"]] = r["bits"]
    # starts: shard totals first (a row per shard), then the blocks of a shard
    sizes = blocks.select("shard", "block", "n_tokens")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = (sizes.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
              .select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("shard_start")))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sizes.join(shards, "shard")
              .select("shard", "block", (F.col("shard_start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
                      .alias("start")))
    out = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def run(batches):
        decoder = Decoder(lengths)
        for frame in batches:
            for b in frame.itertuples(index=False):
                ids = decoder.decode(b.payload, np.asarray(b.checkpoints), int(b.n_tokens)).astype("<u4")
                counts = np.asarray(b.doc_tokens, np.int64)
                ends = np.cumsum(counts)
                each = [ids[e - n:e] for e, n in zip(ends, counts)]
                cols = {"doc_id": pd.array([None if d is None or d != d else int(d) for d in b.doc_ids], "Int64"),
                        "start": b.start + ends - counts, "n_tokens": counts,
                        "ids_crc32": np.array([zlib.crc32(x.tobytes()) for x in each], np.int64)}
                if with_ids:
                    cols["ids"] = [x.astype(np.int64) for x in each]
                yield pd.DataFrame(cols)
    return (blocks.select("shard", "block", "n_tokens", "doc_ids", "doc_tokens", "payload", "checkpoints")
            .join(starts, ["shard", "block"])
            .select("start", "n_tokens", "doc_ids", "doc_tokens", "payload", "checkpoints").mapInPandas(run, out))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/llm-token-files-{uuid.uuid4().hex}"
    write_token_files(table(spark, sf_dir, "documents"), path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return read_token_files(spark, path)
