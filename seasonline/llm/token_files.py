"""Token ids in flat binary files, read back through memory maps.

A dataset is a folder of shards in ascending order of document id. Shard ``s`` is two files:

- ``s.bin``: the ids of its documents, one after the other, unsigned little-endian, 2 or 4 bytes each;
- ``s.idx``: 64-bit little-endian integers: n, then the n document ids, then n + 1 offsets in ids.

``manifest`` (Parquet) holds per shard its counts and its base: the ids before it in the whole dataset,
a prefix sum over the shards. The folder is a URI that PyArrow's file systems reach from every executor.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonline.llm.common import held_by_worker
from seasonline.llm.pieces import PieceMemo, batch_ids

# How a row without document id is stored in an index file.
NO_ID = -(1 << 63)

_SHARDS = "shard string, id_bytes int, n_docs long, n_tokens long"


def _encoder(path: str, dtype: str) -> tuple[PieceMemo, bool]:
    """Pieces to the bytes of their ids, by the ``tokenizers`` file in ``path``.

    Texts may go by pieces only where the file splits as byte-level BPE does, without a normaliser; the
    second value says so. Otherwise whole texts are encoded.
    """
    import json
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    split = spec.get("pre_tokenizer") or {}
    added = [t["content"] for t in spec.get("added_tokens", [])]
    by_piece = (
        split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and not spec.get("normalizer")
        and not spec.get("truncation")
        and not spec.get("padding")
        and not any(c.isspace() for t in added for c in t)
        and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", []))
    )
    tokenizer = Tokenizer.from_file(path)
    if tokenizer.get_vocab_size() > 1 << 8 * np.dtype(dtype).itemsize:
        raise ValueError(f"ids of {path} do not fit into {np.dtype(dtype).itemsize} bytes")
    # A token's name has a character for each of its bytes; an added token is named by its text.
    sizes = np.zeros(tokenizer.get_vocab_size() + 1, dtype=np.int64)
    for name, number in tokenizer.get_vocab().items():
        sizes[number] = len(name.encode() if name in added else name)
    width = np.dtype(dtype).itemsize

    def one_by_one(texts: list[str]) -> list[bytes]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=dtype).tobytes() for e in found]

    def encode_many(texts: list[str]) -> list[bytes]:
        """Pieces that open with white space and end without stay apart when joined, and so do those that
        open with a stop or comma if a letter comes before: one call for all."""
        opened, stopped = [], []
        for i, t in enumerate(texts) if by_piece else ():
            if t and not t[-1].isspace():
                if t[0] in " \n":
                    opened.append(i)
                elif t[0] in ".,":
                    stopped.append(i)
        if len(opened) + len(stopped) < 2:
            return one_by_one(texts)
        letters = [" a"] * len(stopped)
        units = [texts[i] for i in opened] + [u for pair in zip(letters, (texts[i] for i in stopped), strict=True) for u in pair]
        ids = np.array(tokenizer.encode_batch_fast(["".join(units)], add_special_tokens=False)[0].ids)
        token_ends, text_ends = np.cumsum(sizes[ids]), np.cumsum([len(u.encode()) for u in units])
        last = np.searchsorted(token_ends, text_ends)
        if not np.array_equal(token_ends[np.minimum(last, len(ids) - 1)], text_ends):
            return one_by_one(texts)
        data, edges = ids.astype(dtype).tobytes(), [0, *((last + 1) * width).tolist()]
        parts = [data[a:z] for a, z in pairwise(edges)]
        found = dict(zip(opened, parts, strict=False)) | dict(zip(stopped, parts[len(opened) + 1 :: 2], strict=True))
        rest = [i for i in range(len(texts)) if i not in found]
        found.update(zip(rest, one_by_one([texts[i] for i in rest]), strict=True))
        return [found[i] for i in range(len(texts))]

    return PieceMemo(encode_many, size=600_000), by_piece


def _ids_of(path: str, dtype: str) -> Callable[[pa.Array], Iterable[np.ndarray]]:
    memo, by_piece = held_by_worker(("ids", path, dtype), lambda: _encoder(path, dtype))
    if by_piece:
        return lambda texts: batch_ids(texts, memo, dtype, 8 << 20)
    return lambda texts: [np.frombuffer(b, dtype) for b in memo.values([t or "" for t in texts.to_pylist()])]


def _put(store: fs.FileSystem, path: str, parts: list[bytes]) -> None:
    """A whole file or none: written under a name of its own, then renamed."""
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    with store.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    store.move(draft, path)


def write_token_files(
    docs: DataFrame,
    folder: str,
    *,
    vocabulary: str,
    end_id: int | None = None,
    id_bytes: int = 2,
    shards: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encode ``text`` by the ``tokenizers`` file ``vocabulary`` and write the dataset; returns its manifest.

    ``end_id`` is put after every document. ``id_bytes`` is 2 or 4; an id that does not fit raises an
    error. Documents are ordered by id (nulls first, and repeated ids by text), so equal input gives equal
    bytes. A null text counts as empty and still has its end id. An empty table gives a dataset of no
    shards. Further columns are not stored. One shuffle, by range of document id.
    """
    spark = docs.sparkSession
    dtype = {2: "<u2", 4: "<u4"}[id_bytes]
    parts = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = folder.rstrip("/")
    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    ordered = (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )

    def write_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _ids_of(vocabulary, dtype)
        end = b"" if end_id is None else np.array([end_id], dtype=dtype).tobytes()
        n_end = len(end) // id_bytes
        store, root = _store(folder)
        shard = f"{TaskContext.get().partitionId():07d}"
        draft = f"{root}/{shard}.bin.{uuid.uuid4().hex}.draft"
        names: list[np.ndarray] = []
        sizes: list[int] = []
        out = None
        for batch in batches:
            if out is None:
                out = store.open_output_stream(draft)
            names.append(batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False))
            for ids in encode(batch.column(1)):
                out.write(ids.tobytes() + end)
                sizes.append(len(ids) + n_end)
        if out is None:
            return
        out.close()
        store.move(draft, f"{root}/{shard}.bin")
        offsets = np.zeros(len(sizes) + 1, dtype="<i8")
        np.cumsum(sizes, out=offsets[1:])
        count = np.array([len(sizes)], dtype="<i8")
        _put(store, f"{root}/{shard}.idx", [count.tobytes(), np.concatenate(names).astype("<i8").tobytes(), offsets.tobytes()])
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([shard]),
                "id_bytes": pa.array([id_bytes], pa.int32()),
                "n_docs": pa.array([len(sizes)], pa.int64()),
                "n_tokens": pa.array([int(offsets[-1])], pa.int64()),
            }
        )

    counts = f"{folder}/counts"
    ordered.mapInArrow(write_shard, _SHARDS).write.mode("overwrite").parquet(counts)
    # One row per shard: a prefix sum of so few rows needs no splitting.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    manifest = spark.read.schema(_SHARDS).parquet(counts).select(
        "*", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")).alias("base")
    )
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{_SHARDS}, base long").parquet(f"{folder.rstrip('/')}/manifest")


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the path in it; a plain path is one that all executors share."""
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def _mapped(store: fs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """A file as an array: memory-mapped where the file system is a mounted one."""
    if isinstance(store, fs.LocalFileSystem):
        size = store.get_file_info(path).size
        return np.memmap(path, dtype=dtype, mode="r") if size else np.empty(0, dtype)
    with store.open_input_file(path) as file:
        return np.frombuffer(file.read_buffer(), dtype=dtype)


def open_shard(folder: str, shard: str, id_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, offsets and the mapped token ids of one shard."""
    store, root = _store(folder.rstrip("/"))
    index = np.asarray(_mapped(store, f"{root}/{shard}.idx", "<i8"))
    n = int(index[0])
    return index[1 : n + 1], index[n + 1 : 2 * n + 2], _mapped(store, f"{root}/{shard}.bin", f"<u{id_bytes}")


def read_documents(spark: SparkSession, folder: str, *, with_ids: bool = False) -> DataFrame:
    """Documents of a dataset: doc_id, start in the whole dataset, n_tokens, the CRC-32 of the ids as
    32-bit little-endian integers, and with ``with_ids`` the ids themselves. Shards are read in parallel."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", token_ids array<long>" if with_ids else "")
    folder = folder.rstrip("/")
    manifest = read_manifest(spark, folder)
    shards = manifest.select("shard", "id_bytes", "base")
    n = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                names, offsets, ids = open_shard(folder, row["shard"], row["id_bytes"])
                for low in range(0, len(names), 5000):
                    high = min(len(names), low + 5000)
                    spans = [ids[a:b] for a, b in zip(offsets[low:high], offsets[low + 1 : high + 1], strict=True)]
                    columns = [
                        pa.array(names[low:high], pa.int64(), mask=names[low:high] == NO_ID),
                        pa.array(offsets[low:high] + row["base"], pa.int64()),
                        pa.array(np.diff(offsets[low : high + 1]), pa.int64()),
                        pa.array([zlib.crc32(s.astype("<u4").tobytes()) for s in spans], pa.int64()),
                    ]
                    if with_ids:
                        columns.append(pa.array([s.tolist() for s in spans], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    return shards.repartition(n, "shard").mapInArrow(read, schema)
