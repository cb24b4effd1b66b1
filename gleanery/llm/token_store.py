"""Token ids in binary shards, with a minimal perfect hash index for keyed access.

A shard is two files. `shard-N.ids` holds the raw little-endian ids of its
documents, one after the other. `shard-N.idx` holds the documents in order
(keys and lengths) and an index: every distinct key has its own slot in a table
with no free slot, found by two hashes and a displacement, and a slot stores a
fingerprint, the place of the first id and the number of ids. A look-up reads
one slot and one range of the ids, whatever the size of the shard.

Files are written in the folder of the session's shared storage by one task a
shard: under a name of the attempt first, then moved, so that a repeated or
killed task leaves either nothing or the same file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import cut_lineage, work_folder

from .common import partitions
from .tokens import encoded, encoder

#: Mark and version, then: slots, buckets, documents, bytes of an id.
HEADER = "<8sQQQQ"
MARK = b"ids-mph1"
#: Keys a bucket has on average.
BUCKET_KEYS = 2
MANIFEST = ("shard int, ids_path string, index_path string, n_docs long, n_ids long, "
            "min_key long, max_key long")


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of 64-bit keys (the splitmix finaliser's fixed constants)."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + np.uint64(
            (seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class KeyIndex:
    """A minimal perfect hash of distinct 64-bit keys, with fingerprints."""

    def __init__(self, jump: np.ndarray, shift: np.ndarray, prints: np.ndarray):
        self.jump, self.shift, self.prints = jump, shift, prints

    @classmethod
    def build(cls, keys: np.ndarray) -> KeyIndex:
        """Buckets, fullest first, each get the first jump that puts their keys on free slots;
        buckets of one key are shifted straight onto the slots that are left. All buckets of a
        size try a jump together; where two want a slot, the first has it."""
        n, buckets = len(keys), max(1, -(-len(keys) // BUCKET_KEYS))
        jump, shift = np.zeros(buckets, np.uint32), np.zeros(buckets, np.uint32)
        index = cls(jump, shift, np.zeros(n, np.uint32))
        if not n:
            return index
        bucket, base = index._hashes(keys)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=buckets)
        starts = np.cumsum(sizes) - sizes
        free = np.ones(n, dtype=bool)
        for size in range(int(sizes.max()), 1, -1):
            left = np.flatnonzero(sizes == size)
            hashes = base[order[starts[left][:, None] + np.arange(size)]]
            tried = 0
            while len(left):
                places = index._jumped(hashes, np.array(tried))
                inner = np.sort(places, axis=1)
                good = free[places].all(axis=1) & (np.diff(inner, axis=1) > 0).all(axis=1)
                wanted, owner = np.unique(places[good], return_index=True)
                won = np.bincount(owner // size, minlength=int(good.sum())) == size
                chosen = np.flatnonzero(good)[won]
                free[places[chosen]] = False
                jump[left[chosen]] = tried
                rest = np.ones(len(left), dtype=bool)
                rest[chosen] = False
                left, hashes, tried = left[rest], hashes[rest], tried + 1
                if tried > 1 << 22:
                    raise ValueError("keys are not distinct")
        single = np.flatnonzero(sizes == 1)
        places = np.flatnonzero(free)[:len(single)]
        shift[single] = (places - index._jumped(base[order[starts[single]]], np.array(0))) % n
        index.prints[index.slots(keys)] = _mix(keys, 3).astype(np.uint32)
        return index

    def _hashes(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return ((_mix(keys, 0) % np.uint64(len(self.jump))).astype(np.int64),
                _mix(keys, 1).view(np.int64))

    def _jumped(self, base: np.ndarray, jump: np.ndarray) -> np.ndarray:
        moved = base ^ _mix(jump, 2).view(np.int64)
        return (_mix(moved, 4) % np.uint64(len(self.prints))).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        bucket, base = self._hashes(keys)
        return (self._jumped(base, self.jump[bucket]) + self.shift[bucket]) % len(self.prints)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where the fingerprint says it is not there."""
        if not len(self.prints):
            return np.full(len(keys), -1, dtype=np.int64)
        slots = self.slots(keys)
        return np.where(self.prints[slots] == _mix(keys, 3).astype(np.uint32), slots, -1)


def _files(path: str):
    """The file system of a path or URI, and the path in it."""
    if "://" in path or path.startswith("file:"):
        return pa.fs.FileSystem.from_uri(path)
    return pa.fs.LocalFileSystem(), path


class Shard:
    """One shard, opened by its two paths; ids are read by range."""

    def __init__(self, ids_path: str, index_path: str):
        system, path = _files(index_path)
        with system.open_input_file(path) as f:
            raw = f.read()
        mark, slots, buckets, self.n_docs, self.id_bytes = struct.unpack_from(HEADER, raw)
        if mark != MARK:
            raise ValueError(f"not an index: {index_path}")
        at = struct.calcsize(HEADER)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(raw, dtype=kind, count=n, offset=at)
            at += found.nbytes
            return found

        self.index = KeyIndex(take("<u4", buckets), take("<u4", buckets), take("<u4", slots))
        self.start, self.length = take("<u8", slots), take("<u4", slots)
        self.doc_keys, self.doc_null = take("<i8", self.n_docs), take("u1", self.n_docs)
        self.doc_lengths = take("<u4", self.n_docs)
        system, path = _files(ids_path)
        self.file = system.open_input_file(path)
        self.kind = f"<u{self.id_bytes}"

    def read(self, start: int, length: int) -> np.ndarray:
        raw = self.file.read_at(length * self.id_bytes, start * self.id_bytes)
        return np.frombuffer(raw, dtype=self.kind)

    def get(self, key: int) -> np.ndarray | None:
        """The ids of the first document of a key; None where there is none."""
        slot = int(self.index.find(np.array([key], dtype=np.int64))[0])
        return None if slot < 0 else self.read(int(self.start[slot]), int(self.length[slot]))

    def close(self) -> None:
        self.file.close()


def _put(path: str, parts: Iterator[bytes] | list[bytes]) -> None:
    """Writes a file under a name of its own and moves it into place."""
    system, path = _files(path)
    own = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
    system.move(own, path)


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 0,
          text: str = "text", key: str = "doc_id") -> DataFrame:
    """Writes all documents in ascending key order; gives the manifest, one row a shard.

    `folder` is a path or URI all executors reach, by default a new one in the
    session's shared folder. Null keys come first, rows of equal keys in the
    order of their texts; a null text is an empty document. An empty table
    gives no shards.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark, "token-shards")
    ordered = (docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                           F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
               .repartitionByRange(partitions(spark), "doc_id")
               .sortWithinPartitions("doc_id", "text"))

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        ids_path, index_path = (f"{folder}/shard-{number:06d}.{x}" for x in ("ids", "idx"))
        keys, nulls, lengths = [], [], []

        def payload() -> Iterator[bytes]:
            for batch in batches:
                column = batch.column("doc_id")
                keys.append(column.fill_null(0).to_numpy(zero_copy_only=False))
                nulls.append(column.is_null().to_numpy(zero_copy_only=False))
                for ids in encoded(tokenizer, batch.column("text").to_pylist(), end_id):
                    lengths.append(len(ids))
                    yield ids.tobytes()

        system, path = _files(folder)
        system.create_dir(path, recursive=True)
        _put(ids_path, payload())
        if not lengths:
            return
        doc_keys, null = np.concatenate(keys).astype(np.int64), np.concatenate(nulls)
        size = np.array(lengths, dtype=np.int64)
        start = np.cumsum(size) - size
        there = np.flatnonzero(~null)
        distinct, first = np.unique(doc_keys[there], return_index=True)
        first = there[first]
        index = KeyIndex.build(distinct)
        slots = index.slots(distinct)
        slot_start, slot_length = np.zeros(len(distinct), "<u8"), np.zeros(len(distinct), "<u4")
        slot_start[slots], slot_length[slots] = start[first], size[first]
        _put(index_path, [x if isinstance(x, bytes) else x.tobytes() for x in (
            struct.pack(HEADER, MARK, len(distinct), len(index.jump), len(size),
                        encoder(tokenizer).id_type.itemsize),
            index.jump, index.shift, index.prints, slot_start, slot_length,
            doc_keys, null.astype("u1"), size.astype("<u4"))])
        known = len(distinct) > 0
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([number], pa.int32()), "ids_path": [ids_path],
            "index_path": [index_path], "n_docs": pa.array([len(size)], pa.int64()),
            "n_ids": pa.array([int(size.sum())], pa.int64()),
            "min_key": pa.array([int(distinct[0]) if known else None], pa.int64()),
            "max_key": pa.array([int(distinct[-1]) if known else None], pa.int64())})

    return cut_lineage(ordered.mapInArrow(shard, MANIFEST), "manifest")


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): every document, read back from the shard files.

    `start` counts the ids of all documents before it, over all shards. Every
    distinct key goes through the index; rows that repeat a key, and null keys,
    are read by their place in the order.
    """
    spark = manifest.sparkSession
    # one row a shard, as many as range partitions
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1))
    placed = (manifest.withColumn("before", F.coalesce(before, F.lit(0)))
              .repartition(partitions(spark), "shard"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["ids_path"], row["index_path"])
                size = shard.doc_lengths.astype(np.int64)
                start = np.cumsum(size) - size
                null = shard.doc_null.astype(bool)
                slots = shard.index.find(shard.doc_keys)
                repeats = null.copy()
                repeats[1:] |= shard.doc_keys[1:] == shard.doc_keys[:-1]
                if (slots[~repeats] < 0).any():
                    raise ValueError(f"a key is missing in {row['index_path']}")
                at, n = start.copy(), size.copy()
                at[~repeats] = shard.start[slots[~repeats]]
                n[~repeats] = shard.length[slots[~repeats]]
                crc = np.zeros(len(size), dtype=np.int64)
                # documents lie in order: read a stretch of many at a time
                for a, b in _stretches(size):
                    base = int(start[a])
                    held = shard.read(base, int(size[a:b].sum())).astype("<u4").tobytes()
                    for i in range(a, b):
                        x = 4 * (int(at[i]) - base)
                        crc[i] = zlib.crc32(held[x:x + 4 * int(n[i])])
                shard.close()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(shard.doc_keys, pa.int64(), mask=null),
                    "start": pa.array(at + row["before"], pa.int64()),
                    "n_tokens": pa.array(n, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    return placed.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _stretches(size: np.ndarray, most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Runs of documents with about `most` ids; a longer document is alone."""
    a, held = 0, 0
    for i, n in enumerate(size.tolist()):
        if i > a and held + n > most:
            yield a, i
            a, held = i, 0
        held += n
    if a < len(size):
        yield a, len(size)


def lookup(manifest: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, ids): the ids of the asked keys, null where a key is in no shard.

    The manifest, one row a shard, says by its key ranges where a key can be; a
    shard's task opens the index once and reads one slot and one range a key.
    Null keys are not found; repeated keys are asked once.
    """
    spark = keys.sparkSession
    asked = keys.select(F.col(f"`{key}`").cast("long").alias("doc_id")).distinct()
    shards = (manifest.filter("min_key is not null")
              .select("min_key", "max_key", "ids_path", "index_path").orderBy("min_key").toPandas())
    low, high = shards["min_key"].to_numpy(np.int64), shards["max_key"].to_numpy(np.int64)

    @F.pandas_udf("int")
    def shard_of(doc_id):
        wanted = doc_id.fillna(0).to_numpy(np.int64)
        at = np.searchsorted(low, wanted, "right") - 1
        inside = (at >= 0) & doc_id.notna().to_numpy()
        inside &= wanted <= high[np.maximum(at, 0)] if len(high) else False
        return pd.Series(np.where(inside, at, -1).astype("int32"))

    paths = list(zip(shards["ids_path"], shards["index_path"]))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = -2, None
        for batch in batches:
            out = []
            for doc, number in zip(batch.column("doc_id").to_pylist(),
                                   batch.column("shard").to_pylist()):
                if number < 0:
                    out.append(None)
                    continue
                if number != held:
                    if shard:
                        shard.close()
                    held, shard = number, Shard(*paths[number])
                ids = shard.get(doc)
                out.append(None if ids is None else ids.astype(np.int32).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out, pa.list_(pa.int32()))],
                names=["doc_id", "ids"])
        if shard:
            shard.close()

    # a shard that many keys ask is opened by several tasks: keys are dealt by shard and key
    dealt = (asked.withColumn("shard", shard_of("doc_id"))
             .repartitionByRange(partitions(spark), "shard", "doc_id")
             .sortWithinPartitions("shard", "doc_id"))
    return dealt.mapInArrow(fetch, "doc_id long, ids array<int>")
