"""Packing documents into sequences along a space-filling curve.

Every document becomes a hashed bag of tokens, projected to a few coordinates; its place on the Hilbert curve
through these coordinates is its sort key.  A range partitioning by that key gives each task a stretch of the
curve, and the task cuts its documents, one after the other, into sequences of `length` tokens.  Only the last
tokens of a task do not fill a sequence: they are cut into sequences whose lengths are powers of two.

Edge cases: a null text is an empty one and gives the end token alone; equal documents have the same key and are
spread by their id, so a large group of copies does not meet in one task; null ids come first; repeated rows are
packed as often as they occur; an empty table gives no rows; further columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from gridlake.llm.common import read_table, small_batches, stage
from gridlake.llm.tokens import Encoder

LENGTH = 1024
END_ID = 0
DIMENSIONS, BITS, BUCKETS, SEED = 3, 16, 4096, 7
#: Token rows looked up at once when a document is projected, which bounds memory for very long texts.
BLOCK = 1 << 16


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position of integer points on the Hilbert curve (the transpose form of Skilling, 2004)."""
    x = np.array(points, dtype=np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):  # undo the rotations of each sub-cube
        bit, below = 1 << level, (1 << level) - 1
        for i in range(dims):
            inside = (x[i] & bit) != 0
            swap = np.where(inside, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(inside, x[0] ^ below, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where((x[-1] & (1 << level)) != 0, flip ^ ((1 << level) - 1), flip)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def projection(vocabulary: int, buckets: int = BUCKETS, dims: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """A row per dimension with a value per token id: that of the bucket which the id is hashed to."""
    ids = np.arange(vocabulary, dtype=np.uint64)
    bucket = (ids * np.uint64(0x9E3779B1) >> np.uint64(8)) % np.uint64(buckets)
    values = np.random.default_rng(seed).standard_normal((dims, buckets)).astype("float32")
    return np.ascontiguousarray(values[:, bucket.astype(np.int64)])


def coordinates(ids: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The mean projected token of a document, in the unit cube."""
    total = np.zeros(len(values))
    for at in range(0, len(ids), BLOCK):
        block = ids[at:at + BLOCK]
        total += [row[block].sum(dtype=np.float64) for row in values]
    return 0.5 + np.arctan(4 * total / max(len(ids), 1)) / np.pi


def vocabulary(tokenizer, end_id: int) -> int:
    return max(tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)


def id_width(tokenizer, end_id: int) -> int:
    return 2 if vocabulary(tokenizer, end_id) <= 1 << 16 else 4


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, curve_key (long), ids (binary, little-endian, the end token included).

    Ids take two bytes each if the vocabulary allows it, else four; `id_width` tells.
    """
    small_batches(docs.sparkSession)
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        encoder = Encoder(tokenizer_path)
        values, width = projection(vocabulary(encoder.tokenizer, end_id)), id_width(encoder.tokenizer, end_id)
        end = np.asarray([end_id], dtype=np.uint32)
        for batch in batches:
            ids = [np.concatenate([encoder(t or ""), end]) for t in batch.column("text").to_pylist()]
            points = np.array([coordinates(x, values) for x in ids]).reshape(-1, DIMENSIONS)
            ids = [x.astype(f"<u{width}").tobytes() for x in ids]
            cells = np.clip(points * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(hilbert_keys(cells)), pa.array(ids, pa.binary())],
                names=["doc_id", "curve_key", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {doc_type}, curve_key long, ids binary")


def powers(n: int) -> list[int]:
    """`n` as a sum of falling powers of two."""
    return [1 << i for i in range(n.bit_length() - 1, -1, -1) if n >> i & 1]


def pack(rows: DataFrame, length: int, width: int) -> DataFrame:
    """Pieces of the documents of `encoded`: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    The ids of a piece are little-endian unsigned 32-bit integers, whatever their `width` was.
    """
    doc_type = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {doc_type}, start long, length long, doc_tokens long, sequence_id long, offset long, "
              "ids binary")
    names = [part.split()[0] for part in schema.split(", ")]

    def cut(batches):
        first = TaskContext.get().partitionId() << 36
        sequence, held, filled = 0, [], 0  # held: pieces of the sequence that is not full yet

        def table(pieces):
            columns = list(zip(*pieces)) or [[]] * 7
            kinds = [doc_kind, *[pa.int64()] * 5, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        doc_kind = None
        for batch in batches:
            doc_kind, out = batch.column("doc_id").type, []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                ids = np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()
                tokens, start = len(ids) // 4, 0
                while start < tokens:
                    n = min(length - filled, tokens - start)
                    held.append((doc, start, n, tokens, first + sequence, filled, ids[4 * start:4 * (start + n)]))
                    start, filled = start + n, filled + n
                    if filled == length:
                        out += held
                        sequence, held, filled = sequence + 1, [], 0
            yield table(out)
        if held:  # the last tokens: sequences of falling powers of two
            rest, out = powers(filled), []
            room, offset = rest.pop(0), 0
            for doc, start, n, tokens, _, _, ids in held:
                at = 0
                while at < n:
                    take = min(room - offset, n - at)
                    out.append((doc, start + at, take, tokens, first + sequence, offset,
                                ids[4 * at:4 * (at + take)]))
                    at, offset = at + take, offset + take
                    if offset == room and rest:
                        room, offset, sequence = rest.pop(0), 0, sequence + 1
            yield table(out)

    return rows.mapInArrow(cut, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents, neighbours on the curve in the same sequences."""
    from tokenizers import Tokenizer

    width = id_width(Tokenizer.from_file(tokenizer_path), end_id)
    # Stored, because drawing the range bounds reads the rows once more.
    stored = stage(encoded(docs, tokenizer_path, end_id), "encoded")
    ordered = stored.repartitionByRange("curve_key", "doc_id").sortWithinPartitions("curve_key", "doc_id", "ids")
    return pack(ordered, length, width)


def op10_packing(spark, sf_dir):
    import public_tokenizers

    pieces = pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
