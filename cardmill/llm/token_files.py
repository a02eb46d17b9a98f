"""Operator 10, token files: frequency-ranked ids in byte-aligned variable-length coding with control bytes apart."""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cardmill.llm.common import ship
from cardmill.session import materialize, scratch_path

MAGIC = b"CMT3"
HEAD = "<IQQQ"  # of a block: documents, ids, control bytes, data bytes
RAW_HEAD = "<IQ"  # of a block whose ids are not ranked yet: documents, ids
MARKS = ".,!?;:"
MOST_WORDS = 600_000  # words a worker remembers at least; results do not depend on it

# For each control byte the lengths of its four ids.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)


def encode_block(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values: two bits of length each, then 1 to 4 bytes each."""
    values = np.ascontiguousarray(values, dtype="<u4")
    if not len(values):
        return b"", b""
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    padded[: len(values)] = extra
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) <= extra[:, None]
    return control.astype(np.uint8).tobytes(), values.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_block(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of a block, by looking lengths up and gathering their bytes."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n].astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    values = raw[starts].astype(np.uint32)
    for k in range(1, 4):
        longer = np.flatnonzero(lengths > k)
        values[longer] |= raw[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


class WordTokenizer:
    """Ids of whole texts, remembered by word.

    The tokenizer drops white space and no token of it spans white space, so a text's ids are those of its parts
    between ASCII white space, which the library encodes.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        # Tokens that end a piece: a string of letters is one piece.
        self.ends = np.zeros(self.size, dtype=bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        ids, counts = self.encode_flat(pa.array(texts, pa.string()))
        return np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one behind the other, and the number of ids of each.

        Only the distinct words are looked up; the ids of the others are copied from them.
        """
        parts = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        words = parts.flatten().dictionary_encode()
        bounds = np.frombuffer(words.dictionary.buffers()[1], np.int64, len(words.dictionary) + 1).tolist()
        letters = bytes(words.dictionary.buffers()[2] or b"")
        found = self._look_up([letters[a:b] for a, b in zip(bounds, bounds[1:], strict=False)])
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(lengths) - lengths
        which = words.indices.to_numpy(zero_copy_only=False)
        sizes = lengths[which]
        ends = np.cumsum(sizes)
        place = np.repeat(starts[which] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        ids = np.frombuffer(b"".join(found), dtype="<u4")[place]
        # Words before the end of each text, and ids before the end of each word.
        upto = np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))
        return ids, np.diff(np.concatenate(([0], ends))[np.concatenate(([0], upto))])

    def _look_up(self, words: list[bytes]) -> list[bytes]:
        found = list(map(self.known.get, words))
        missing = [w for w, x in zip(words, found, strict=True) if x is None]
        if len(self.known) + len(missing) > MOST_WORDS:
            # Start a new table; words in use come over from the old one.
            self.older, self.known = self.known, {}
        older, known = self.older, self.known
        known.update([(w, older[w]) for w in missing if w in older])
        new = [w for w in missing if w not in known]
        known.update(zip(new, self.learn([w.decode() for w in new]), strict=True))
        return [known[w] if x is None else x for w, x in zip(words, found, strict=True)]

    def _each(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Strings of letters, encoded as one text and cut where pieces end; one by one if the cuts do not fit."""
        if not words:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words) or cuts[-1] != len(ids):
            return self._each(words)
        raw, at = ids.tobytes(), [0, *(4 * cuts).tolist()]
        return [raw[a:b] for a, b in zip(at, at[1:], strict=False)]

    def learn(self, words: list[str]) -> list[bytes]:
        """Ids of words. Those of letters, and letters with marks behind them, are encoded by letters and marks.

        The tokenizer lower-cases and cuts letters from marks, so these parts stand for many words.
        """
        known, older = self.known, self.older
        cut: list[str] = []  # the letters of each word in the case that stands for them, or nothing
        marks: list[str] = []
        for w in words:
            bare = w.rstrip(MARKS)
            # Some letters have a lower case that is no letter.
            if not bare.isalpha() or not (bare.isascii() or bare.lower().isalpha()):
                cut.append("")
                marks.append(w)
            else:
                cut.append(bare.lower() if bare.isascii() else bare)
                marks.append(w[len(bare) :])
        ids: dict[str, bytes] = {"": b""}
        new: dict[bool, list[str]] = {True: [], False: []}
        for letters in set(cut) - {""}:
            raw = letters.encode()
            if found := known.get(raw) or older.get(raw):
                ids[letters] = found
            else:
                new[letters.isascii()].append(letters)
        for group in new.values():
            for at in range(0, len(group), 512):
                ids.update(zip(group[at : at + 512], self._letters(group[at : at + 512]), strict=True))
        rest = list(set(marks) - {""})
        others = dict(zip(rest, self._each(rest), strict=True))
        others[""] = b""
        return [ids[x] + others[m] for x, m in zip(cut, marks, strict=True)]


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def by_frequency(times: np.ndarray) -> np.ndarray:
    """The ids that occur at all, the most frequent first and equal ones by id."""
    used = np.flatnonzero(times)
    return used[np.argsort(-times[used], kind="stable")].astype("<u4")


def ranks_of(table: np.ndarray) -> np.ndarray:
    """For each id its place in a table of ids."""
    rank = np.zeros(int(table.max()) + 1 if len(table) else 0, dtype="<u4")
    rank[table] = np.arange(len(table), dtype="<u4")
    return rank


def rank_by_frequency(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, the most frequent first and equal ones by id, and the rank of each of ``ids`` among them."""
    table = by_frequency(np.bincount(ids))
    return table, ranks_of(table)[ids]


def _uri(folder: str) -> str | None:
    """The URI of a folder, None for a plain path; ``s3a`` and ``s3n``, as Spark names them, are ``s3``."""
    scheme, colon, rest = folder.partition(":")
    if not colon or not (rest.startswith("//") or scheme == "file"):
        return None
    return f"s3:{rest}" if scheme in ("s3a", "s3n") else folder


def _filesystem(folder: str) -> tuple[pa.fs.FileSystem, str]:
    uri = _uri(folder)
    if uri:
        return pa.fs.FileSystem.from_uri(uri)
    return pa.fs.LocalFileSystem(), folder


def _create(path: str) -> pa.NativeFile:
    files, local = _filesystem(path)
    files.create_dir(local.rpartition("/")[0], recursive=True)
    return files.open_output_stream(local)


MANIFEST = "shard int, path string, n_docs long, n_ids long"
SUMMED = 64
COUNTED = MANIFEST + ", used array<int>, times array<long>"


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    shards: int | None = None,
) -> DataFrame:
    """Write the ids of all texts, each with ``end_id`` appended, in ascending order of ``id_col``.

    Returns the manifest: one row a file in order, with its path, documents and ids. Ids are stored as ranks by their
    frequency in the whole corpus, so that the frequent ones take a byte; each file begins with the table, common to
    all, that turns ranks into ids. Texts are encoded once: a first pass writes plain ids to scratch files and counts
    them, the counts are added up (vectors of the size of the vocabulary), a second pass ranks the files.
    Rows are ordered by a range partitioning, and each task writes the blocks of its range as they come. A task
    that runs twice writes two files and the manifest names the one that counts. Null ids come first, null texts
    count as empty, and rows with equal ids are ordered by their text.
    """
    spark = ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(f"`{text_col}`", F.lit("")).alias("text"))
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, "id", F.xxhash64("text")).sortWithinPartitions("id", "text")
    ranged = ranged.withColumn("shard", F.spark_partition_id())

    scratch = scratch_path(spark, "token-ids")

    def encode(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_tokenizer(tokenizer_path)
        times = np.zeros(max(own.size, end_id + 1), dtype=np.int64)
        kind = _raw_type(len(times))
        out = path = shard = None
        n_docs = n_ids = 0
        for batch in source:
            if not batch.num_rows:
                continue
            if out is None:
                shard = batch.column(2)[0].as_py()
                path = f"{scratch.rstrip('/')}/part-{shard:06d}-{uuid.uuid4().hex[:12]}.{kind[1:]}"
                out = _create(path)
            ids, counts = own.encode_flat(batch.column(1))
            # The end id goes behind the ids of each text.
            every = np.insert(ids, np.cumsum(counts), end_id)
            counts = (counts + 1).astype("<u8")
            part = np.bincount(every)
            times[: len(part)] += part
            doc = batch.column(0)
            null = np.array(doc.is_null().to_numpy(zero_copy_only=False), dtype=np.uint8)
            number = doc.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
            out.write(struct.pack(RAW_HEAD, len(counts), len(every)))
            for piece in (number.tobytes(), null.tobytes(), counts.tobytes(), every.astype(kind).tobytes()):
                out.write(piece)
            n_docs, n_ids = n_docs + len(counts), n_ids + len(every)
        if out is not None:
            out.close()
            used = np.flatnonzero(times)
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()), "path": [path], "n_docs": [n_docs], "n_ids": [n_ids],
                    "used": pa.array([used.astype(np.int32)], pa.list_(pa.int32())),
                    "times": pa.array([times[used]], pa.list_(pa.int64())),
                }
            )

    counted = materialize(ranged.mapInArrow(encode, COUNTED), "token-counts")
    order = by_frequency(_sum_counts(counted)).tobytes()

    def write(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = ranks_of(np.frombuffer(order, "<u4"))
        for batch in source:
            for shard, raw, n_docs, n_ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                path = f"{folder.rstrip('/')}/part-{shard:06d}-{uuid.uuid4().hex[:12]}.tok"
                with _create(path) as out:
                    out.write(MAGIC + struct.pack("<I", len(order) // 4) + order)
                    for docs_in, about, ids in _raw_blocks(raw):
                        control, data = encode_block(rank[ids])
                        out.write(struct.pack(HEAD, docs_in, len(ids), len(control), len(data)))
                        for piece in (about, control, data):
                            out.write(piece)
                yield pa.RecordBatch.from_pydict(
                    {"shard": pa.array([shard], pa.int32()), "path": [path], "n_docs": [n_docs], "n_ids": [n_ids]}
                )

    files = counted.select("shard", "path", "n_docs", "n_ids").repartition(n, "path")
    manifest = materialize(files.mapInArrow(write, MANIFEST), "token-manifest")
    plain = spark._jvm.org.apache.hadoop.fs.Path(scratch)
    plain.getFileSystem(spark._jsc.hadoopConfiguration()).delete(plain, True)
    return manifest


def _add_counts(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of count vectors, as one row."""
    total = np.zeros(0, dtype=np.int64)
    for batch in source:
        for at in range(batch.num_rows):
            used, times = (batch.column(k)[at].values.to_numpy() for k in (0, 1))
            if len(used) and used[-1] >= len(total):
                total = np.concatenate((total, np.zeros(int(used[-1]) + 1 - len(total), dtype=np.int64)))
            total[used] += times
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict(
        {
            "used": pa.array([used.astype(np.int32)], pa.list_(pa.int32())),
            "times": pa.array([total[used]], pa.list_(pa.int64())),
        }
    )


def _sum_counts(counted: DataFrame) -> np.ndarray:
    """How often each id occurs in all files: vectors of the size of the vocabulary, added up in a tree.

    A task adds up SUMMED vectors, so rows never outnumber the files, and the driver takes SUMMED at most.
    """
    sums = counted.select("used", "times")
    n = counted.count()
    while n > SUMMED:
        n = -(-n // SUMMED)
        sums = materialize(sums.repartition(n).mapInArrow(_add_counts, "used array<int>, times array<long>"), "token-sums")
    rows = [(np.array(r["used"], dtype=np.int64), np.array(r["times"], dtype=np.int64)) for r in sums.collect()]
    total = np.zeros(max((int(used[-1]) + 1 for used, _ in rows if len(used)), default=0), dtype=np.int64)
    for used, times in rows:
        total[used] += times
    return total


def _raw_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def _raw_blocks(path: str) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """The blocks of a scratch file: how many documents, the bytes on them, and the ids."""
    kind = "<" + path.rpartition(".")[2]
    files, local = _filesystem(path)
    with files.open_input_stream(local) as stream:
        while head := stream.read(struct.calcsize(RAW_HEAD)):
            n_docs, n_ids = struct.unpack(RAW_HEAD, head)
            about = stream.read(17 * n_docs)
            yield n_docs, about, np.frombuffer(stream.read(int(kind[2:]) * n_ids), kind)


def _read_table(stream: pa.NativeFile, path: str) -> np.ndarray:
    if stream.read(4) != MAGIC:
        raise ValueError(f"{path} is no token file")
    return np.frombuffer(stream.read(4 * struct.unpack("<I", stream.read(4))[0]), "<u4")


def read_table(path: str) -> np.ndarray:
    """The table of a file: its ids by rank."""
    files, local = _filesystem(path)
    with files.open_input_stream(local) as stream:
        return _read_table(stream, path)


def read_blocks(path: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The blocks of a file: document numbers, which of them are null, ids of each, and all ids."""
    files, local = _filesystem(path)
    with files.open_input_stream(local) as stream:
        ids = _read_table(stream, path)
        while head := stream.read(struct.calcsize(HEAD)):
            n_docs, n_ids, n_control, n_data = struct.unpack(HEAD, head)
            number = np.frombuffer(stream.read(8 * n_docs), "<i8")
            null = np.frombuffer(stream.read(n_docs), np.uint8)
            counts = np.frombuffer(stream.read(8 * n_docs), "<u8").astype(np.int64)
            yield number, null, counts, ids[decode_block(stream.read(n_control), stream.read(n_data), n_ids)]


def read_token_files(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row a document, read from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``, on request ``ids``.

    ``start`` counts all ids before the document: those of earlier files, from the manifest (one row a file), and
    those before it in its file.
    """
    spark = manifest.sparkSession
    ship(spark)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    tasks = placed.select("path", "first").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")

    def read(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for number, null, counts, ids in read_blocks(path):
                    ends = np.cumsum(counts)
                    begins = ends - counts
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(begins, ends, strict=True)]
                    columns = {
                        "doc_id": pa.array(number, pa.int64(), mask=null.astype(bool)),
                        "start": pa.array(begins + start, pa.int64()),
                        "n_tokens": pa.array(counts, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                    if with_ids:
                        columns["ids"] = pa.array(
                            [ids[a:b].astype(np.int32) for a, b in zip(begins, ends, strict=True)], pa.list_(pa.int32())
                        )
                    start += int(counts.sum())
                    yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return tasks.mapInArrow(read, schema)


def token_folder(spark: SparkSession) -> str:
    """A fresh folder for token files in the shared place that the session names."""
    return scratch_path(spark, "token-files")
