"""Token ids on disk: canonical, length-limited Huffman codes in independent blocks.

``write_ids`` puts documents in ascending id order into a folder with two Parquet tables: ``codes`` (the length
of each id's code, from the counts of all ids) and ``blocks``.  A block holds whole documents: their ids and
sizes, the bits, and the bit offset of every ``STRIDE``-th token.  A reader needs the code table and one block;
it decodes all checkpoints of a block side by side from one table of prefixes.

Defined cases: a null or empty text has the end id only; documents that share an id are ordered by their tokens;
an empty table gives empty tables.  The files are written by Spark, so a failed task leaves nothing behind.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tableferry.llm.pretokens import pieces
from tableferry.llm.vocabulary import encoder, laid_out
from tableferry.llm.words import slices
from tableferry.session import fresh_path

#: Tokens after which a block is closed, tokens between checkpoints, and tokens of one output partition.
BLOCK, STRIDE, PARTITION = 1 << 17, 128, 8_000_000
#: Longest code: enough for any vocabulary of up to a quarter million ids, and a decoding table of 4 MB.
LONGEST = 19


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = 0, kind: str = "<u4") -> DataFrame:
    """``doc_id``, ``ids`` (little-endian unsigned, as wide as ``kind`` says, with the end id) for each row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        for batch in slices(batches, limit=2 << 20):
            found = pieces(batch.column("text"), tuple(tool.specials), tool.classes)
            hashes, one, inverse = np.unique(found.hash, return_index=True, return_inverse=True)
            ids = tool.known.look_up(hashes, found.end[one] - found.start[one], lambda k, found=found, one=one: found.of(one[k]), tool.encode)
            tokens, total = laid_out(*ids, inverse)
            tokens = tokens.astype(kind)
            bounds = total[found.first]
            end = np.array([end_id], kind).tobytes()
            out = [tokens[a:b].tobytes() + end for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(encode, "doc_id long, ids binary")


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Lengths of an optimal prefix code without codes over ``longest`` (package-merge); counts are positive."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    if n > 1 << longest:
        raise ValueError(f"{n} ids have no codes of {longest} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(longest):
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        levels.append(rank < n)
        both = both[rank][:len(both) // 2 * 2]
        packages = both[0::2] + both[1::2]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        used = int(is_leaf[:take].sum())
        lengths[order[:used]] += 1
        take = 2 * (take - used)
    return lengths


def canonical(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code and the length of each id up to the largest; codes rise by length, then id."""
    order = np.lexsort((ids, lengths))
    code = np.zeros(int(ids.max(initial=-1)) + 1, np.uint64)
    size = np.zeros(len(code), np.int64)
    widths = lengths[order]
    # Each code takes 2**(LONGEST - length) of the values of LONGEST bits, one after the other.
    room = np.left_shift(np.int64(1), LONGEST - widths)
    code[ids[order]] = ((np.cumsum(room) - room) >> (LONGEST - widths)).astype(np.uint64)
    size[ids[order]] = widths
    return code, size


def pack(ids: np.ndarray, code: np.ndarray, size: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of ids, and the bit offset of every ``STRIDE``-th."""
    width = size[ids]
    ends = np.cumsum(width)
    start = ends - width
    # A code of up to 32 bits lies in two words; the sums of a word's shares are exact below 2**53.
    word, spare = start >> 5, 64 - (start & 31) - width
    value = code[ids] << spare.astype(np.uint64)
    n = int(ends[-1] >> 5) + 2 if len(ids) else 2
    words = np.bincount(word, (value >> np.uint64(32)).astype(float), n) + np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(float), n)
    return words.astype(">u4").tobytes(), start[::STRIDE]


def prefixes(code: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value of ``LONGEST`` bits, the id whose code it begins with, and that code's length."""
    used = np.flatnonzero(size)
    used = used[np.lexsort((used, size[used]))]
    room = np.left_shift(np.int64(1), LONGEST - size[used])
    ids, widths = np.repeat(used, room), np.repeat(size[used], room)
    spare = (1 << LONGEST) - len(ids)
    return np.append(ids, np.zeros(spare, np.int64)).astype(np.uint32), np.append(widths, np.ones(spare, np.int64))


def unpack(payload: bytes, checkpoints: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    words = np.frombuffer(payload, ">u4").astype(np.uint64)
    words = np.append(words, np.zeros(2, np.uint64))
    at, out = checkpoints.astype(np.int64), np.zeros((len(checkpoints), STRIDE), np.uint32)
    mask = np.uint64((1 << LONGEST) - 1)
    ids, widths = table
    for step in range(STRIDE):
        word = np.minimum(at >> 5, len(words) - 2)
        value = words[word] << np.uint64(32) | words[word + 1]
        prefix = (value >> (64 - LONGEST - (at & 31)).astype(np.uint64)) & mask
        out[:, step] = ids[prefix]
        at = at + widths[prefix]
    return out.reshape(-1)[:n]


def _counts(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                ids = np.frombuffer(b"".join(x for x in batch.column("ids").slice(at, 512).to_pylist() if x), kind)
                found = np.bincount(ids)
                if len(found) > len(total):
                    total = np.append(total, np.zeros(len(found) - len(total), np.int64))
                total[:len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    return run


def write_ids(tokens: DataFrame, path: str, kind: str = "<u4") -> None:
    """Write (``doc_id``, ``ids``) to ``path``; ``tokens`` is read three times, so it should be a written table."""
    spark = tokens.sparkSession
    counts = tokens.select("ids").mapInArrow(_counts(kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # Bounded by the vocabulary.
    found = counts.toPandas().sort_values("id")
    ids, n = found["id"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
    lengths = code_lengths(n)
    spark.createDataFrame(list(zip(ids.tolist(), n.tolist(), lengths.tolist(), strict=True)), "id long, n long, length int").coalesce(1).write.parquet(f"{path}/codes")
    codes = spark.sparkContext.broadcast(canonical(ids, lengths))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.dtype(kind).itemsize
        part, before, block = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        held: list[bytes] = []

        def close() -> pa.RecordBatch:
            stream = np.frombuffer(b"".join(held), kind)
            payload, marks = pack(stream, *codes.value)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part]), "block": pa.array([block]), "before": pa.array([before]), "n": pa.array([len(stream)]),
                "doc_ids": pa.array([names], pa.list_(pa.int64())), "sizes": pa.array([[len(x) // width for x in held]], pa.list_(pa.int64())),
                "checkpoints": pa.array([marks.tolist()], pa.list_(pa.int64())), "payload": pa.array([payload], pa.binary())})

        size = 0
        for batch in batches:
            for name, ids in zip(batch.column("doc_id"), batch.column("ids"), strict=True):
                names.append(name.as_py())
                held.append(ids.as_py())
                size += len(held[-1]) // width
                if size >= BLOCK:
                    yield close()
                    before, block, size = before + size, block + 1, 0
                    names, held = [], []
        if names:
            yield close()

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")) // 4, -(-int(n.sum()) // PARTITION), 1)
    ranged = tokens.repartitionByRange(parts, "doc_id", F.xxhash64("ids")).sortWithinPartitions("doc_id", "ids")
    ranged.mapInArrow(encode, "part long, block long, before long, n long, doc_ids array<long>, sizes array<long>, checkpoints array<long>, payload binary").write.parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` (and ``ids``) of each document, decoded from the files."""
    rows = spark.read.parquet(f"{path}/codes").select("id", "length").toPandas()  # bounded by the vocabulary
    codes = spark.sparkContext.broadcast(canonical(rows["id"].to_numpy(np.int64), rows["length"].to_numpy(np.int64)))
    blocks = spark.read.parquet(f"{path}/blocks")
    # One row for each partition of the writer.
    parts = blocks.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("size"))
    bases = parts.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("base"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefixes(*codes.value)
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"], np.array(row["checkpoints"], np.int64), row["n"], table).astype("<u4")
                sizes = np.array(row["sizes"], np.int64)
                ends = np.cumsum(sizes)
                raw = [ids[b - a:b].tobytes() for a, b in zip(sizes, ends, strict=True)]
                out = [pa.array([row["part"]] * len(raw), pa.int64()), pa.array(row["doc_ids"], pa.int64()), pa.array(row["before"] + ends - sizes), pa.array(sizes), pa.array([zlib.crc32(x) for x in raw], pa.int64())]
                yield pa.RecordBatch.from_arrays([*out, *([pa.array(raw, pa.binary())] * with_ids)], ["part", "doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    kept = "part long, doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    docs = blocks.select("part", "before", "n", "doc_ids", "sizes", "checkpoints", "payload").mapInArrow(decode, kept)
    return docs.join(F.broadcast(bases), "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def store(docs: DataFrame, tokenizer: str, end_id: int = 0) -> str:
    """Tokenize and write; the path of the written folder."""
    spark = docs.sparkSession
    staged, path = fresh_path(spark, "tokens"), fresh_path(spark, "ids")
    # What is staged and shuffled is as wide as the vocabulary needs.
    largest = max([end_id, *encoder(tokenizer).tokenizer.get_vocab(with_added_tokens=True).values()])
    kind = "<u2" if largest < 1 << 16 else "<u4"
    tokenize(docs, tokenizer, end_id, kind).write.option("compression", "zstd").parquet(staged)
    write_ids(spark.read.parquet(staged), path, kind)
    return path
