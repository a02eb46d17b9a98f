"""Operator 9, byte-level BPE: a lazily determinised transducer for encoding, a UTF-8 state machine for decoding."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from cardmill.llm.common import free, ship

# Bounds of what a worker remembers; beyond them it forgets and rebuilds, which changes no result.
MOST_STATES = 150_000
MOST_PIECES, LONG_PIECE = 400_000, 64
DECODE_BLOCK = 4096
ONE_BYTE = [bytes((i,)) for i in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_by_rank(piece: bytes, ranks: dict[bytes, int], least_parts: int = 1) -> list[int]:
    """BPE by definition: merge the adjacent pair of lowest rank, leftmost first, down to ``least_parts`` parts."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    none = len(ranks) + 1
    while len(parts) > least_parts:
        pairs = [ranks.get(x + y, none) for x, y in zip(parts, parts[1:], strict=False)]
        best = min(pairs)
        if best == none:
            break
        at = pairs.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """Bytes in, token ids out, for one vocabulary.

    The encoding of every prefix of a piece has one last token: the token that ends there and may follow the last
    token of the prefix before it. "May follow" holds when merging both tokens' bytes gives the two back, which the
    merges decide once for each pair. A longer prefix can only build on positions from which the bytes read so far
    could still begin a token. A state keeps the bytes behind the last position that all of these share, with the
    token before it; when that position moves on, the tokens before it are emitted. So the lookahead is bounded by
    the longest token, and states and moves are made when first needed.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.starts = {t[:k] for t in ranks for k in range(1, len(t))}
        self.bytes_of = dict(zip(ranks.values(), ranks.keys(), strict=True))
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.follows: dict[int, bool] = {}  # by size * left token + right token
        self.size = max(self.bytes_of) + 1
        self._reset()

    def _reset(self) -> None:
        self.numbers: dict[tuple[int, bytes], int] = {(-1, b""): 0}
        # By state: the token before the kept bytes, these bytes, for each position in them the token that ends
        # there and the place where it starts, and the open places in ascending order.
        self.states: list[tuple[int, bytes, tuple[int, ...], tuple[int, ...], list[int]]] = [(-1, b"", (), (), [0])]
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}  # by 256 * state + byte
        self.ends: dict[int, tuple[int, ...]] = {}

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes a token; None for a single byte."""
        if token not in self.parts:
            whole = self.bytes_of[token]
            two = merge_by_rank(whole, self.ranks, least_parts=2)
            self.parts[token] = (two[0], two[1]) if len(two) == 2 else None
        return self.parts[token]

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives the two tokens back.

        The merges that made the tokens are undone from the last one. At every stage the two parts that touch must
        not have a merge of their own before the one undone last; on a tie of ranks the one further left goes first.
        """
        ranks, text, a, b = self.ranks, self.bytes_of, left, right
        bound = len(ranks) + 1
        while True:
            if ranks.get(text[a] + text[b], bound) < bound:
                known = False
                break
            halves_a, halves_b = self._halves(a), self._halves(b)
            if halves_a is None and halves_b is None:
                known = True
                break
            if halves_b is None or (halves_a is not None and a > b):
                bound, a = a, halves_a[1]
            else:
                bound, b = b + 1, halves_b[0]
        if len(self.follows) >= MOST_STATES:
            self.follows.clear()
        self.follows[left * self.size + right] = known
        return known

    def _move(self, number: int, byte: int) -> tuple[int, tuple[int, ...]]:
        before, kept, lasts, froms, opened = self.states[number]
        kept += ONE_BYTE[byte]
        tokens, starts, follows, size = self.ranks.get, self.starts, self.follows, self.size
        for p in opened:  # ascending, so the longest token comes first
            token = tokens(kept[p:] if p else kept)
            if token is not None:
                last = lasts[p - 1] if p else before
                if last < 0:
                    break
                fits = follows.get(last * size + token)
                if self._may_follow(last, token) if fits is None else fits:
                    break
        else:
            raise ValueError(f"no token ends {kept!r}")
        lasts += (token,)
        froms += (p,)
        opened = [p for p in opened if (kept[p:] if p else kept) in starts]
        opened.append(len(kept))
        # Step back from the furthest place until all meet: what lies before is final.
        ahead = opened[:]
        while len(ahead) > 1:
            back = froms[ahead.pop() - 1]
            if back not in ahead:
                ahead.append(back)
                ahead.sort()
        base = at = ahead[0]
        out: tuple[int, ...] = ()
        if base:
            while at:
                out = (lasts[at - 1], *out)
                at = froms[at - 1]
            before, kept, lasts = lasts[base - 1], kept[base:], lasts[base:]
            froms = tuple([f - base for f in froms[base:]])
            opened = [p - base for p in opened]
        if opened[0]:
            before = -2  # the token from the first place on is fixed: what stands before it no longer matters
        key = before, kept
        target = self.numbers.get(key)
        if target is None:
            target = self.numbers[key] = len(self.states)
            self.states.append((before, kept, lasts, froms, opened))
        self.moves[256 * number + byte] = move = (target, out)
        return move

    def _end(self, number: int) -> tuple[int, ...]:
        """The tokens that are still to come when the piece ends in this state."""
        _, kept, lasts, froms, _ = self.states[number]
        out, at = [], len(kept)
        while at:
            out.append(lasts[at - 1])
            at = froms[at - 1]
        self.ends[number] = end = tuple(reversed(out))
        return end

    def _forget(self, number: int) -> int:
        """Drops all states but the first one and ``number``, whose new number it returns."""
        kept = self.states[number]
        self._reset()
        if number:
            number = self.numbers[kept[:2]] = len(self.states)
            self.states.append(kept)
        return number

    def encode(self, piece: bytes) -> list[int]:
        """The token ids of one piece."""
        out: list[int] = []
        state, moves = 0, self.moves
        for byte in piece:
            move = moves.get(256 * state + byte)
            if move is None:
                if len(self.states) >= MOST_STATES:
                    state, moves = self._forget(state), self.moves
                move = self._move(state, byte)
            state = move[0]
            if move[1]:
                out.extend(move[1])
        out.extend(self.ends.get(state) or self._end(state))
        return out


class Utf8Stream:
    """Decodes bytes that arrive in any cuts; keeps the start of a character until its last byte is there."""

    def __init__(self) -> None:
        self.rest = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """How many bytes at the end begin a character that is not complete."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte < 0x80:
                return 0
            if byte >= 0xC0:  # a lead byte: 2, 3 or 4 bytes long
                length = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                return back if back < length else 0
        return 0

    def feed(self, data: bytes, end: bool = False) -> str:
        data = self.rest + data
        cut = len(data) if end else len(data) - self._unfinished(data)
        self.rest = data[cut:]
        return data[:cut].decode("utf-8", errors="replace")


class Codec:
    """Whole texts to ids and back, with the pattern that cuts texts into pieces."""

    def __init__(self, path: str, pattern: str) -> None:
        self.machine = Transducer(read_ranks(path))
        self.pieces_of = regex.compile(pattern).findall
        self.table = [self.machine.bytes_of.get(i, b"") for i in range(max(self.machine.bytes_of) + 1)]
        # Pieces met lately and before: a full table becomes the older one, from which pieces in use come back.
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.ids = list(range(len(self.table)))  # one object for each id

    def _learn(self, piece: str) -> tuple[int, ...]:
        found = self.older.get(piece)
        if found is None:
            shared = self.ids
            found = tuple([shared[i] for i in self.machine.encode(piece.encode())])
        if len(piece) > LONG_PIECE:
            return found
        if len(self.known) >= MOST_PIECES:
            self.older, self.known = self.known, {}
        self.known[piece] = found
        return found

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        if not text:
            return ids
        for piece in self.pieces_of(text):
            ids += self.known.get(piece) or self._learn(piece)
        return ids

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """The text of ids, in blocks."""
        stream, table, ids = Utf8Stream(), self.table, list(ids)
        for at in range(0, len(ids), DECODE_BLOCK):
            yield stream.feed(b"".join([table[i] for i in ids[at : at + DECODE_BLOCK]]))
        yield stream.feed(b"", end=True)


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker process, which keeps its states from task to task."""
    return Codec(path, pattern)


def encode_documents(
    docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids"
) -> DataFrame:
    """Adds the token ids of the whole text; null and empty texts have none. Other columns pass through."""
    docs = free(docs, ids_col)
    ship(docs.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in source:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            ids = pa.array([own.encode(t) for t in texts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, ids_col])

    return docs.mapInArrow(batches, StructType([*docs.schema.fields, StructField(ids_col, ArrayType(IntegerType()))]))


def decode_documents(
    docs: DataFrame, path: str, pattern: str, ids_col: str = "ids", text_col: str = "text"
) -> DataFrame:
    """Adds (or replaces) the text of the ids; null ids give null."""
    docs = free(docs, text_col)
    ship(docs.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in source:
            rows = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            texts = pa.array([None if x is None else "".join(own.decode(x)) for x in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, text_col])

    return docs.mapInArrow(batches, StructType([*docs.schema.fields, StructField(text_col, StringType())]))


ROUND_TRIP = (
    StructField("n_tokens", LongType()),
    StructField("ids_sha256", StringType()),
    StructField("decoded_sha256", StringType()),
)


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str | None = None) -> DataFrame:
    """Encodes and decodes in one pass: adds the number of ids and digests of the ids and of the decoded bytes.

    With ``ids_col`` the ids are added too. Null text counts as empty; equal rows come out equal; input columns
    named like the added ones are replaced.
    """
    docs = free(docs, *(f.name for f in ROUND_TRIP), *([ids_col] if ids_col else []))
    ship(docs.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        decimal = [str(i) for i in range(len(own.table))]
        for batch in source:
            counts, digests, decoded, all_ids = [], [], [], []
            for text in batch.column(batch.schema.get_field_index(text_col)).to_pylist():
                ids = own.encode(text)
                counts.append(len(ids))
                digests.append(hashlib.sha256(" ".join([decimal[i] for i in ids]).encode()).hexdigest())
                back = hashlib.sha256()
                for block in own.decode(ids):
                    back.update(block.encode())
                decoded.append(back.hexdigest())
                if ids_col:
                    all_ids.append(ids)
            added = [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            names = [f.name for f in ROUND_TRIP]
            if ids_col:
                added.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append(ids_col)
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *names])

    extra = [StructField(ids_col, ArrayType(IntegerType()))] if ids_col else []
    return docs.mapInArrow(batches, StructType([*docs.schema.fields, *ROUND_TRIP, *extra]))
