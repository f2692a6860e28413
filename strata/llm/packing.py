"""Bounded-space online packing of token sequences.

Each task keeps a fixed number of open windows. A document piece goes into the window with the
least room that still holds it (best fit). When none holds it, the fullest window is completed
with the head of the piece and emitted, and the rest goes on. At the end of a task its open
windows are merged into full ones and at most one rest; rests of many tasks are merged in
rounds of ``MERGE_FAN_IN``. The last rest is cut into windows of power-of-two length, which need
no padding.

Defined results: a null or empty text is one end token; repeated rows are packed like any other
(one piece set per row); a null ``doc_id`` stays null; an empty table gives no rows; extra columns
are not read.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import MEMO_ENTRIES, as_bytes, durable, slices, tidied

WINDOW = 2048
OPEN_WINDOWS = 64
MERGE_FAN_IN = 256
TOKEN_BYTES = 4

# Characters whose class is the same in every Unicode version and regex library; a text with
# any other character is handed whole to the tokenizer.
PLAIN = [chr(c) for c in (9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x250))]
OTHER_CHARACTERS = re.compile(f"[^{re.escape(''.join(PLAIN))}]")


def split_pattern() -> re.Pattern:
    """The pre-token pattern of the byte-level BPE file, with the letters and digits of ``PLAIN``
    spelled out."""
    letters, digits = (re.escape("".join(c for c in PLAIN if unicodedata.category(c)[0] == kind))
                       for kind in "LN")
    return re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{letters}]+| ?[{digits}]+"
                      rf"| ?[^\s{letters}{digits}]+|\s+(?!\S)|\s+")


def byte_letters() -> dict[int, int]:
    """Byte -> letter of the byte-level alphabet: visible Latin-1 as it is, others from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long, ids binary, part long")
ARROW_SCHEMA = pa.schema([(n, pa.int64()) for n in (
    "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    + [("ids", pa.binary()), ("part", pa.int64())])


def byte_bpe_encoder(path: str, end_id: int = 1) -> Callable[[str], bytes]:
    """text -> little-endian 32-bit ids of the byte-level BPE file at ``path``, then ``end_id``.

    Pre-tokens are encoded independently of each other, so each distinct one is encoded once and
    remembered (bounded memo). A text with one of the file's special strings is handed whole to the tokenizer, which
    makes it the special token.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    end = end_id.to_bytes(TOKEN_BYTES, "little")
    split, letters, model = split_pattern().findall, byte_letters(), tokenizer.model

    def encode(text: str) -> bytes:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join(i.to_bytes(TOKEN_BYTES, "little") for i in ids)

    class Memo(dict):
        def __missing__(self, piece: str) -> bytes:
            spelled = piece.encode().decode("latin-1").translate(letters)
            value = self[piece] = b"".join(t.id.to_bytes(TOKEN_BYTES, "little")
                                           for t in model.tokenize(spelled))
            return value

    memo = Memo()

    def run(text: str) -> bytes:
        if OTHER_CHARACTERS.search(text) or any(s in text for s in special):
            return encode(text) + end
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        return b"".join(map(memo.__getitem__, split(text))) + end

    return run


class Packer:
    """Open windows of one task. A piece is (doc_id, start, doc_tokens, ids)."""

    def __init__(self, window: int, open_windows: int, emit: Callable[[list], None]):
        self.window, self.limit, self.emit = window, open_windows, emit
        self.open: dict[int, list] = {}
        self.room: list[tuple[int, int]] = []  # (room left, key), sorted
        self.keys = itertools.count()

    def add(self, piece: tuple) -> None:
        doc_id, start, total, ids = piece
        full = self.window * TOKEN_BYTES
        whole = len(ids) // full * full
        for at in range(0, whole, full):
            self.emit([(doc_id, start + at // TOKEN_BYTES, total, ids[at:at + full])])
        ids, start = ids[whole:], start + whole // TOKEN_BYTES
        while ids:
            need = len(ids) // TOKEN_BYTES
            at = bisect_left(self.room, (need, -1))
            if at < len(self.room):
                room, key = self.room.pop(at)
                self.open[key].append((doc_id, start, total, ids))
                if room == need:
                    self.emit(self.open.pop(key))
                else:
                    insort(self.room, (room - need, key))
                return
            if len(self.room) < self.limit:
                key = next(self.keys)
                self.open[key] = [(doc_id, start, total, ids)]
                insort(self.room, (self.window - need, key))
                return
            room, key = self.room.pop(0)
            head = ids[:room * TOKEN_BYTES]
            self.emit(self.open.pop(key) + [(doc_id, start, total, head)])
            ids, start = ids[len(head):], start + room

    def rest(self) -> list:
        """Merge the open windows into full ones; the pieces of the one that stays open."""
        pieces = [p for _, key in self.room for p in self.open[key]]
        self.open, self.room = {}, []
        return pour(pieces, self.window, self.emit)


def pour(pieces: list, window: int, emit: Callable[[list], None]) -> list:
    """Fill windows one after the other, cutting pieces at their ends; returns the last rest."""
    current, used = [], 0
    for doc_id, start, total, ids in pieces:
        while ids:
            head = ids[:(window - used) * TOKEN_BYTES]
            n = len(head) // TOKEN_BYTES
            current.append((doc_id, start, total, head))
            ids, start, used = ids[len(head):], start + n, used + n
            if used == window:
                emit(current)
                current, used = [], 0
    return current


class _Rows:
    """Collects output rows as columns."""

    def __init__(self, first_id: int):
        self.next_id, self.rows = first_id, []

    def sequence(self, pieces: list) -> None:
        offset = 0
        for doc_id, start, total, ids in pieces:
            n = len(ids) // TOKEN_BYTES
            self.rows.append((doc_id, start, n, zlib.crc32(ids), total, self.next_id, offset,
                              None, None))
            offset += n
        self.next_id += 1

    def rest(self, pieces: list, part: int) -> None:
        for at, (doc_id, start, total, ids) in enumerate(pieces):
            self.rows.append((doc_id, start, len(ids) // TOKEN_BYTES, None, total, None, at, ids,
                              part))

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(ARROW_SCHEMA)
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, ARROW_SCHEMA)], schema=ARROW_SCHEMA)


def _first_id(level: int, part: int) -> int:
    """Disjoint id ranges: 3 bits of merge round, 28 of part, 32 within it."""
    return (level << 60) | (part << 32)


def pack(docs: DataFrame, encoder: Callable[[], Callable[[str], bytes]], window: int = WINDOW,
         open_windows: int = OPEN_WINDOWS, id_col: str = "doc_id", text_col: str = "text",
         merge_rounds: int = 2) -> DataFrame:
    """Pieces of all documents with their sequence and offset (see the module text).

    ``encoder`` builds, inside a task, the function text -> id bytes. ``merge_rounds`` rounds
    divide the number of rests by ``MERGE_FAN_IN`` each, then one task takes what is left.
    """
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rows = _Rows(_first_id(0, part))
        packer, encode = Packer(window, open_windows, rows.sequence), encoder()
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode((text or b"").decode("utf-8", "replace"))
                packer.add((doc_id, 0, len(ids) // TOKEN_BYTES, ids))
            yield rows.batch()
        rows.rest(packer.rest(), part)
        yield rows.batch()

    placed = durable(docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col))
                     .mapInArrow(tidied(place), PIECE_SCHEMA))
    done, rests = [placed.where("sequence_id is not null")], placed.where("sequence_id is null")
    for level in range(1, merge_rounds + 2):
        last = level == merge_rounds + 1
        group = F.lit(0) if last else F.floor(F.col("part") / MERGE_FAN_IN)
        merged = durable(rests.withColumn("g", group.cast("long")).groupBy("g")
                         .applyInArrow(_merge(window, level, last), PIECE_SCHEMA))
        done.append(merged.where("sequence_id is not null"))
        rests = merged.where("sequence_id is null")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("ids", "part")


def _merge(window: int, level: int, last: bool):
    """One merge round: the rests of a group of parts become full windows and one rest."""
    def merge(key, table):
        group = key[0].as_py()
        rows = _Rows(_first_id(level, group))
        order = table.sort_by([("part", "ascending"), ("offset", "ascending")])
        pieces = list(zip(*(order.column(c).to_pylist()
                            for c in ("doc_id", "start", "doc_tokens", "ids"))))
        rest = pour(pieces, window, rows.sequence)
        if last:
            for size in powers(sum(len(p[3]) for p in rest) // TOKEN_BYTES):
                head, rest = cut(rest, size)
                rows.sequence(head)
        else:
            rows.rest(rest, group)
        return pa.Table.from_batches([rows.batch()])

    return merge


def powers(n: int) -> list[int]:
    """The powers of two that add up to ``n``, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def cut(pieces: list, size: int) -> tuple[list, list]:
    """The first ``size`` tokens of ``pieces``, and the others."""
    head, rest = [], []
    for doc_id, start, total, ids in pieces:
        part = ids[:size * TOKEN_BYTES]
        n = len(part) // TOKEN_BYTES
        if part:
            head.append((doc_id, start, total, part))
        if ids[len(part):]:
            rest.append((doc_id, start + n, total, ids[len(part):]))
        size -= n
    return head, rest
