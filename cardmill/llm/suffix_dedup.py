"""Operator 8, suffix-array dedup: bytes covered by long strings that start anywhere else are removed.

Difference-cover construction, bucket by bucket. Suffixes matter only up to the match length, and a suffix whose
string of that length is unique needs no place in the order, so:

1. Every string of MATCH bytes is assigned to an anchor inside it, the place of its least hash of ANCHOR bytes.
   Strings with the same anchor and nearly the same distance to it form a piece; what they all have in common is
   the core of the piece. Equal strings have equal cores, so pieces whose core is at one place only are done.
2. The other pieces are dealt by core. A bucket holds all the suffixes of some cores; buckets are sorted one after
   the other in bounded memory (``repeated_starts``). Cores with very many pieces are dealt over several buckets,
   and what stays unique in one of them is looked up among the distinct strings of the others.
3. The covered bytes come back to their documents as ranges.

Passages of PASSAGE words that stand in several texts are found on the same way, if asked for: anchors, pieces and cores
are taken over the hashes of words, and a bucket compares its windows of PASSAGE words by hash. They are counted, not cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardmill.llm.common import free, ship
from cardmill.llm.shingles import mix, prefix_sums, substring_hashes, value_sums, window_hashes, word_edges
from cardmill.session import drop_copies, materialize

MATCH = 400
ANCHOR = 32
STEP = 185  # distances to the anchor that a piece spans at most
# The same for passages, in words.
PASSAGE = 51
PASSAGE_ANCHOR = 8
PASSAGE_STEP = 22
# A difference cover modulo 16: any two places have an offset below 16 at which both fall on a sample place.
PERIOD = 16
COVER = (0, 1, 2, 5, 8)
BUCKET_BYTES = 2 << 20
# Pieces of a core in one bucket; beyond that a core is dealt over several.
CORE_PIECES = 2048
SCAN_BYTES = 1 << 20
JOINED_BYTES = 1 << 18  # short texts are scanned together
_PLACE_BITS = np.uint64(22)


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row: running minima from both ends of blocks of that width."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def _anchored(sums: np.ndarray, match: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For stretches of starts the anchor of every string of ``match`` values, leftmost among equal hashes."""
    total = len(sums) - 1
    mask = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    for at in range(0, total - match + 1, SCAN_BYTES):
        hashes = window_hashes(sums[at : at + SCAN_BYTES + match], gram)
        marked = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
        least = _least_in_windows(marked, match - gram + 1)
        yield np.arange(at, at + len(least)), at + (least & mask).astype(np.int64)


def _pieces(
    sums: np.ndarray, begin: np.ndarray, length: np.ndarray, match: int, gram: int, step: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first start in it, number of starts and core hash of every piece of texts that stand behind one another."""
    # Strings inside one text, which are consecutive there; those of several texts never have one anchor.
    inside = np.zeros(len(sums), dtype=np.int8)
    long = length >= match
    np.add.at(inside, begin[long], 1)
    np.add.at(inside, begin[long] + length[long] - match + 1, -1)
    inside = np.cumsum(inside, dtype=np.int8).astype(bool)
    firsts, counts, anchors, bands = [], [], [], []
    for starts, anchor in _anchored(sums, match, gram):
        mine = inside[starts]
        starts, anchor = starts[mine], anchor[mine]
        if not len(starts):
            continue
        band = (anchor - starts) // step
        new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (band[1:] != band[:-1])) + 1
        cut = np.concatenate(([0], new))
        firsts.append(starts[cut])
        counts.append(np.diff(np.append(cut, len(starts))))
        anchors.append(anchor[cut])
        bands.append(band[cut])
    if not firsts:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, empty
    first, count, anchor, band = (np.concatenate(x) for x in (firsts, counts, anchors, bands))
    # In every string of the band, whether this text has it or not.
    low, high = anchor - band * step, np.maximum(anchor - (band + 1) * step + 1, anchor - (match - gram)) + match
    core = substring_hashes(sums, low, high) ^ mix(band.astype(np.uint64) + np.uint64(77))
    owner = np.searchsorted(begin, first, side="right") - 1
    return owner, first - begin[owner], count, core.view(np.int64)


def _together(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that are scanned together."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > JOINED_BYTES:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def _lined_up(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of texts with a space behind each, and where the texts begin and how long they are."""
    length = np.array([len(t) for t in texts])
    begin = np.cumsum(length + 1) - length - 1
    return np.frombuffer(b" ".join(texts), dtype=np.uint8), begin, length


def _words(data: np.ndarray, sums: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums over the hashes of the words, and the first word of each text and their number."""
    low, high = word_edges(data)
    first = np.searchsorted(low, begin)
    return value_sums(substring_hashes(sums, low, high)), first, np.diff(np.append(first, len(low)))


def pieces(texts: list[bytes], words: bool) -> Iterator[tuple[bool, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Kind, text, first start, number of starts and core hash of the pieces of texts; if asked, also of their words."""
    for start, end in _together(texts):
        data, begin, length = _lined_up(texts[start:end])
        sums = prefix_sums(data)
        owner, *rest = _pieces(sums, begin, length, MATCH, ANCHOR, STEP)
        yield False, start + owner, *rest
        if words:
            owner, *rest = _pieces(*_words(data, sums, begin), PASSAGE, PASSAGE_ANCHOR, PASSAGE_STEP)
            yield True, start + owner, *rest


def passage_windows(texts: list[bytes]) -> Iterator[np.ndarray]:
    """For each text the hash of every window of PASSAGE words."""
    for start, end in _together(texts):
        data, begin, _ = _lined_up(texts[start:end])
        sums, first, count = _words(data, prefix_sums(data), begin)
        hashes = window_hashes(sums, PASSAGE)
        for at, n in zip(first.tolist(), count.tolist(), strict=True):
            yield hashes[at : at + max(n - PASSAGE + 1, 0)]


def _names(*keys: np.ndarray) -> np.ndarray:
    """Ranks of tuples: equal tuples share one, larger tuples have larger ones."""
    name = keys[0]
    for key in keys[1:]:
        _, name = np.unique(name, return_inverse=True)
        name = name.astype(np.uint64) * np.uint64(int(key.max()) + 1) + key.astype(np.uint64)
    return np.unique(name, return_inverse=True)[1].astype(np.uint64)


def _ranks_of_period(text: np.ndarray) -> np.ndarray:
    """The rank of the PERIOD bytes at every place."""
    padded = np.concatenate([text, np.zeros(2 * PERIOD, dtype=np.uint8)])
    words = np.empty(len(text) + 8, dtype=np.uint64)
    for r in range(8):
        part = words[r::8]
        part[:] = np.frombuffer(padded[r:].tobytes()[: 8 * len(part)], dtype=">u8")
    _, high = np.unique(words, return_inverse=True)
    n = len(text)
    return np.unique(high[:n].astype(np.uint64) << np.uint64(32) | high[8 : n + 8].astype(np.uint64), return_inverse=True)[
        1
    ].astype(np.uint64)


def repeated_starts(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which of the ``starts`` begin a string of MATCH bytes that begins at another of them, too.

    The text of a bucket ends at least MATCH bytes behind its last start. Places of the cover get the rank of the
    MATCH - PERIOD bytes behind them, by doubling. Suffixes are ordered by their first PERIOD bytes; for a tie,
    two suffixes have an offset in common at which both are on the cover, and the ranks there decide together
    with the last PERIOD bytes. So the order of every pair is settled without comparing texts.
    """
    cover = np.zeros(PERIOD, dtype=bool)
    cover[list(COVER)] = True
    head = _ranks_of_period(text)
    total = len(text)
    sample = np.flatnonzero(cover[np.arange(total) % PERIOD])
    slot = np.zeros(total + 1, dtype=np.int64)
    slot[sample] = np.arange(len(sample))

    def behind(names: np.ndarray, distance: int) -> np.ndarray:
        """Names of the sample places ``distance`` further on; beyond the end they do not matter."""
        place = sample + distance
        inside = place < total
        out = np.zeros(len(sample), dtype=np.uint64)
        out[inside] = names[slot[place[inside]]]
        return out

    rank = head[sample]
    by_length = {PERIOD: rank}
    length = PERIOD
    while 2 * length <= MATCH - PERIOD:
        rank = by_length[2 * length] = _names(rank, behind(rank, length))
        length *= 2
    rest = MATCH - PERIOD - length  # 384 = 256 + 128
    while rest:
        part = 1 << (rest.bit_length() - 1)
        rank = _names(rank, behind(by_length[part], length))
        length, rest = length + part, rest - part
    ends = _names(head[starts], head[starts + MATCH - PERIOD])
    twice = np.zeros(len(starts), dtype=bool)
    base = np.uint64(int(rank.max()) + 1) if len(rank) else np.uint64(1)
    for offset in range(PERIOD):
        mine = np.flatnonzero(cover[(starts + offset) % PERIOD])
        if len(mine) < 2:
            continue
        key = ends[mine] * base + rank[slot[starts[mine] + offset]]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice[mine[order[1:][same]]] = True
        twice[mine[order[:-1][same]]] = True
    return twice


def _tile(key: bytes, first: int, tiles: int) -> int:
    return zlib.crc32(key + first.to_bytes(8, "little")) % tiles


def _runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of every run of consecutive numbers."""
    if not len(places):
        return places, places
    cut = np.flatnonzero(np.diff(places) != 1) + 1
    return places[np.concatenate(([0], cut))], places[np.concatenate((cut - 1, [len(places) - 1]))]


FOUND = "words boolean, part int, key binary, first long, last long, string_a long, string_b long, alone boolean"


def _solve(rows: list[tuple[bytes, int, int, bytes, int]]) -> Iterator[dict[str, list]]:
    """Ranges of repeated starts in a bucket of (key, first start, starts, bytes, tiles of its core) rows."""
    # Equal pieces are one in the order; all their strings are repeated.
    distinct: dict[bytes, list[int]] = {}
    for i, row in enumerate(rows):
        distinct.setdefault(row[3], []).append(i)
    texts = list(distinct)
    begin = np.concatenate(([0], np.cumsum([len(t) for t in texts])))[:-1]
    counts = np.array([len(t) - MATCH + 1 for t in texts])
    starts = np.concatenate([np.arange(b, b + c) for b, c in zip(begin, counts, strict=True)])
    text = np.frombuffer(b"".join(texts), dtype=np.uint8)
    twice = repeated_starts(text, starts)
    out: dict[str, list] = {c: [] for c in ("part", "key", "first", "last", "string_a", "string_b", "alone")}

    def add(part: int, key: bytes, first: int, last: int, a: int | None, b: int | None, alone: bool | None) -> None:
        for name, value in zip(out, (part, key, first, last, a, b, alone), strict=True):
            out[name].append(value)

    offset = np.concatenate(([0], np.cumsum(counts)))
    sums = None
    for t, (content, owners) in enumerate(distinct.items()):
        here = twice[offset[t] : offset[t + 1]]
        if len(owners) > 1:
            here = np.ones_like(here)
        low, high = _runs(np.flatnonzero(here))
        for i in owners:
            key, first, _, _, _ = rows[i]
            for x, y in zip(low.tolist(), high.tolist(), strict=True):
                add(0, key, first + x, first + y + MATCH, None, None, None)
        if rows[owners[0]][4] > 1:  # the core has pieces in other buckets, too
            sums = prefix_sums(np.frombuffer(content, dtype=np.uint8))
            at = np.arange(len(here))
            one = substring_hashes(sums, at, at + MATCH).view(np.int64).tolist()
            two = substring_hashes(prefix_sums(np.frombuffer(content[::-1], dtype=np.uint8)), len(content) - at - MATCH, len(content) - at)
            key, first, _, _, _ = rows[owners[0]]
            for x, (a, b) in enumerate(zip(one, two.view(np.int64).tolist(), strict=True)):
                add(1, key, first + x, first + x + MATCH, a, b, not here[x])
    yield out


def _solve_passages(rows: list[tuple[bytes, int, int, bytes, int]]) -> Iterator[dict[str, list | np.ndarray]]:
    """Ranges of words that other texts of a bucket have, too, of (key, first window, windows, hashes, tiles) rows."""
    names: dict[bytes, int] = {}
    owner = np.array([names.setdefault(row[0], len(names)) for row in rows])
    counts = np.array([row[2] for row in rows])
    hashes = np.frombuffer(b"".join(row[3] for row in rows), dtype=np.uint64)
    owners = np.repeat(owner, counts)
    order = np.lexsort((owners, hashes))
    new = np.concatenate(([True], hashes[order][1:] != hashes[order][:-1]))
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(order)) - 1
    several = owners[order[begin]] != owners[order[end]]
    shared, stands_for = np.zeros(len(order), dtype=bool), np.zeros(len(order), dtype=bool)
    shared[order] = np.repeat(several, end - begin + 1)
    stands_for[order[begin]] = True
    keys = [row[0] for row in rows]
    offset = np.concatenate(([0], np.cumsum(counts)))
    piece = np.repeat(np.arange(len(rows)), counts)
    place = np.arange(len(order)) + np.repeat(np.array([row[1] for row in rows]) - offset[:-1], counts)
    # Runs of shared windows end with their piece.
    ahead, behind = np.zeros(len(order), dtype=bool), np.zeros(len(order), dtype=bool)
    ahead[1:] = shared[:-1] & (piece[1:] == piece[:-1])
    behind[:-1] = shared[1:] & (piece[1:] == piece[:-1])
    low, high = np.flatnonzero(shared & ~ahead), np.flatnonzero(shared & ~behind)
    # One of the windows that are shared here already is enough for the others' buckets.
    several_tiles = np.repeat(np.array([row[4] > 1 for row in rows]), counts)
    single = np.flatnonzero(several_tiles & (~shared | stands_for))
    ranges, strings = len(low), len(single)
    yield {
        "part": [0] * ranges + [1] * strings,
        "key": [keys[i] for i in piece[np.concatenate((low, single))].tolist()],
        "first": np.concatenate((place[low], place[single])),
        "last": np.concatenate((place[high], place[single])) + PASSAGE,
        "string_a": [None] * ranges + hashes[single].view(np.int64).tolist(),
        "string_b": [None] * (ranges + strings),
        "alone": [None] * ranges + (~shared[single]).tolist(),
    }


def _buckets(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorts what comes in order of kind, core and tile, one bucket of whole (core, tile) groups at a time."""
    schema = pa.schema(
        [("words", pa.bool_()), ("part", pa.int32()), ("key", pa.binary()), ("first", pa.int64()), ("last", pa.int64())]
        + [("string_a", pa.int64()), ("string_b", pa.int64()), ("alone", pa.bool_())]
    )
    bucket: list[tuple] = []
    size, group = 0, None

    def solved() -> Iterator[pa.RecordBatch]:
        for columns in (_solve_passages if group[0] else _solve)(bucket):
            columns["words"] = [group[0]] * len(columns["part"])
            yield pa.RecordBatch.from_pydict(columns, schema=schema)

    for batch in source:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words, core, tile, tiles, key, first, starts, content = row
            if bucket and (size >= BUCKET_BYTES and (words, core, tile) != group or words != group[0]):
                yield from solved()
                bucket, size = [], 0
            group = (words, core, tile)
            bucket.append((key, first, starts, content, tiles))
            size += len(content)
    if bucket:
        yield from solved()


def _cut(text: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """A text without ranges that may overlap, the number of bytes removed and of maximal removed runs."""
    kept, at, removed, spans, end = [], 0, 0, 0, -1
    for first, last in sorted(ranges):
        if first > end:
            spans += 1
        if last > at:
            first = max(first, at)
            kept.append(text[at:first])
            removed += last - first
            at = last
        end = max(end, last)
    kept.append(text[at:])
    return b"".join(kept), removed, spans


def _covered(ranges: list[tuple[int, int]]) -> int:
    """How many places lie in ranges that may overlap."""
    total, at = 0, 0
    for first, last in sorted(ranges):
        total += max(last - max(first, at), 0)
        at = max(at, last)
    return total


def remove_repeats(
    docs: DataFrame, text_col: str = "text", bytes_col: str = "kept_bytes", passages_col: str | None = None
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` and the remaining bytes added.

    Buckets are made of cores, by hash, rather than of ranges of suffixes; inside a bucket suffixes are ordered by their
    first bytes and difference-cover ranks. Strings of a core that is dealt over several buckets are looked up in the
    others by two 64-bit hashes, since ranks of different buckets cannot be compared.

    A byte goes if a string of MATCH bytes that covers it starts anywhere else, in the same text or in another row;
    strings are judged on the input. Null and empty texts have 0 bytes, texts shorter than MATCH stay whole, and
    of equal texts (repeated rows too) nothing stays from MATCH bytes on. Ids play no part. What remains may end
    inside a character, so it is binary. Added columns replace input ones.

    ``passages_col``, if given, counts the words of each text that lie in a passage of PASSAGE words or more which stands
    in another row, too, whatever the spaces between the words; windows are compared by a 64-bit hash. These passages may
    be shorter than MATCH bytes and are not removed for being counted.
    """
    spark = ship(docs.sparkSession)
    docs = free(docs, "n_bytes", "n_removed", "n_spans", bytes_col, *([passages_col] if passages_col else []))
    with_passages = passages_col is not None
    text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    keyed = docs.withColumn("_llm_key", F.unhex(F.md5(text)))
    long = keyed.where(F.octet_length(text) >= (min(MATCH, 2 * PASSAGE - 1) if with_passages else MATCH))

    def scan(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            keys = batch.column(0).cast(pa.binary())
            for words, owner, first, count, core in pieces(batch.column(1).to_pylist(), with_passages):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(core), words)), pa.array(core, pa.int64()), keys.take(pa.array(owner))]
                    + [pa.array(first, pa.int64()), pa.array(count, pa.int64())],
                    ["words", "core", "key", "first", "starts"],
                )

    found = long.select("_llm_key", text.alias("content")).mapInArrow(
        scan, "words boolean, core long, key binary, first long, starts long"
    )
    found = materialize(found, "suffix-pieces")
    # A core at two places: of one text, or of texts that differ (passages: of these only). Minima and maxima need one
    # row a core and task.
    place = F.when(F.col("words"), F.xxhash64("key")).otherwise(F.xxhash64("key", "first"))
    cores = found.groupBy("words", "core").agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count(F.lit(1)).alias("n"))
    cores = cores.where(F.col("low") != F.col("high")).select(
        "words", "core", F.ceil(F.col("n") / CORE_PIECES).cast("int").alias("tiles")
    )
    # Written before it is joined, so that AQE can split a core with very many pieces; below, too.
    cores = materialize(cores, "repeated-cores")
    open_pieces = materialize(found.join(cores, ["words", "core"]), "open-pieces")
    # Equal texts bring equal pieces. A distinct before would keep the join's partitions, so that AQE could not split them.
    by_text = open_pieces.groupBy("key").agg(F.collect_set(F.struct("words", "core", "tiles", "first", "starts")).alias("pieces"))

    def cut_out(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["words", "core", "tile", "tiles", "key", "first", "starts", "content"]
        kinds = [pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
        for batch in source:
            keys, contents = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            flat = batch.column(2).flatten()
            found = [flat.field(i).to_pylist() for i in range(flat.type.num_fields)]
            cuts = batch.column(2).offsets.to_numpy()
            lists = [list(zip(*(f[a:b] for f in found), strict=True)) for a, b in pairwise((cuts - cuts[0]).tolist())]
            hashes = passage_windows([c for c, mine in zip(contents, lists, strict=True) if any(p[0] for p in mine)])
            for key, content, mine in zip(keys, contents, lists, strict=True):
                windows = next(hashes).tobytes() if any(p[0] for p in mine) else b""
                rows = [
                    (words, core, _tile(key, first, tiles) if tiles > 1 else 0, tiles, key, first, starts)
                    + (windows[8 * first : 8 * (first + starts)] if words else content[first : first + starts + MATCH - 1],)
                    for words, core, tiles, first, starts in mine
                ]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    # One text of each key is enough.
    one = long.select(F.col("_llm_key").alias("key"), text.alias("content")).join(by_text.select("key"), "key", "left_semi")
    one = one.groupBy("key").agg(F.first("content").alias("content"))
    segments = one.join(by_text, "key").mapInArrow(
        cut_out, "words boolean, core long, tile int, tiles int, key binary, first long, starts long, content binary"
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = segments.repartition(4 * n, "core", "tile").sortWithinPartitions("words", "core", "tile")
    solved = materialize(dealt.mapInArrow(_buckets, FOUND), "suffix-runs")
    drop_copies(found, cores, open_pieces)
    ranges = solved.where("part = 0").select("words", "key", "first", "last")
    strings = solved.where("part = 1 and not words")
    several = strings.groupBy("string_a", "string_b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    several = materialize(several.select("string_a", "string_b"), "repeated-strings")
    late = strings.where("alone").join(several, ["string_a", "string_b"], "left_semi").select("words", "key", "first", "last")
    if with_passages:
        windows = solved.where("part = 1 and words")
        owner = F.xxhash64("key")
        apart = (F.min(owner) != F.max(owner)) | ~F.min("alone")
        shared = windows.groupBy("string_a").agg(apart.alias("apart")).where("apart").select("string_a")
        shared = materialize(shared, "shared-windows")
        late = late.union(
            windows.where("alone").join(shared, "string_a", "left_semi").select("words", "key", "first", "last")
        )
    copies = long.groupBy(F.col("_llm_key").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.octet_length(text)).cast("bigint").alias("last")
    )
    start = F.lit(0).cast("bigint").alias("first")
    whole = copies.where((F.col("n") > 1) & (F.col("last") >= MATCH)).select(F.lit(False).alias("words"), "key", start, "last")
    if with_passages:  # to the last word, which is counted when the text is at hand
        to_end = F.lit(None).cast("bigint").alias("last")
        whole = whole.union(copies.where("n > 1").select(F.lit(True).alias("words"), "key", start, to_end))
    per_text = (
        ranges.union(late).union(whole).groupBy("key").agg(F.collect_list(F.struct("words", "first", "last")).alias("_llm_ranges"))
    )
    joined = keyed.join(per_text.withColumnRenamed("key", "_llm_match"), F.col("_llm_key") == F.col("_llm_match"), "left")
    joined = joined.drop("_llm_key", "_llm_match")

    def shared_words(text: bytes, ranges: list[dict]) -> int:
        mine = [(r["first"], r["last"]) for r in ranges if r["words"]]
        if any(last is None for _, last in mine):
            n = len(text.split())
            return n if n >= PASSAGE else 0
        return _covered(mine)

    def rebuild(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            names = batch.schema.names
            at, spans = names.index(text_col), names.index("_llm_ranges")
            content = [t or b"" for t in batch.column(at).cast(pa.large_binary()).to_pylist()]
            ranges = [rs or () for rs in batch.column(spans).to_pylist()]
            cut = [_cut(t, [(r["first"], r["last"]) for r in rs if not r["words"]]) for t, rs in zip(content, ranges, strict=True)]
            rest = [(n, c) for n, c in zip(names, batch.columns, strict=True) if n != "_llm_ranges"]
            added = {
                "n_bytes": pa.array([len(t) for t in content], pa.int64()),
                "n_removed": pa.array([x[1] for x in cut], pa.int64()),
                "n_spans": pa.array([x[2] for x in cut], pa.int64()),
                bytes_col: pa.array([x[0] for x in cut], pa.binary()),
            }
            if with_passages:
                counts = [shared_words(t, rs) for t, rs in zip(content, ranges, strict=True)]
                added[passages_col] = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays([*(c for _, c in rest), *added.values()], [*(n for n, _ in rest), *added])

    schema = docs.schema
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, "long")
    schema = schema.add(bytes_col, "binary")
    return joined.mapInArrow(rebuild, schema.add(passages_col, "long") if with_passages else schema)
