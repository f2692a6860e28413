"""Line deduplication by an exact set-similarity join.

A line is the set of its words. A line is removed if a line before it (by document id, text hash,
then line number) has a Jaccard similarity of ``THRESHOLD`` or more to it; what was removed still counts as
a line before others.

1. Word counts of all documents give the order: rare words first. Words are counted in
   ``BUCKETS`` hash buckets, a table of fixed size (many, so that hardly a rare word ranks with a common one); a word
   ranks as its bucket, then by hash. The same reading lists the documents and counts their lines.
2. A line posts itself under the words of its prefix: lines similar enough share one. Lines that
   meet under a word pass the length filter, the positional filter and a 128-bit parity sketch of
   their words that can't differ in more bits than the sets do in words.
3. The lines of the pairs left are fetched from their documents (lines travel if a bit map of fixed size has them)
   and the Jaccard similarity is computed exactly.

Postings hold the text hash of a document only if its id may have several texts (by a bit map of
such ids, of fixed size). They travel in columns, compressed, one row per task and bucket of words. The number of
buckets grows with the words of all documents and the session's shuffle partitions.

Lines with equal sets are one class, posted once per task, so a common line costs one row a
task; its first line in all documents stands for it, and only that one may stay. In a group each line passes on only about ``FIRST_PAIRS`` candidates; a line that has
more, and whose candidates all fail the exact check, goes on in steps: ``STEP_PAIRS`` candidates
of the group after those tried (four times as many each step, up to ``MOST_PAIRS``), until one is
verified or none is left. The first round stores the postings of groups in which a line has more, packed; the steps read
them, not the documents: rows of such a group that pass the filters with a line that goes on, with 32-bit hashes of the words of lines up to
``HASHED_WORDS`` words, which leave hardly a false candidate of such lines. Documents are read once more for the texts of their lines. A word whose count could
make a group of more than ``GROUP_ROWS`` rows is cut into blocks of rows that meet pairwise.

Defined results: lines without a word are kept and never compared; null and empty texts have no
lines to remove; rows with the same id and text (by a 64-bit hash) are one document, rows with the
same id and other texts are others; null ids come before all others and are told apart by text; an
empty table gives no rows; extra columns are not read, and ``remove_lines`` passes them on.
"""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WordScanner, as_bytes, durable, mix, slices, tidied, written

THRESHOLD = (4, 5)
BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
KEY_BITS = 44
HASH_BITS = KEY_BITS - BUCKET_BITS
# Rows that the table of counts is dealt out in.
PIECES = 64
LINES_AT_ONCE = 1 << 18
SMALL_GROUP = 4096
FIRST_PAIRS = 8
STEP_PAIRS = 64
MOST_PAIRS = 4096
HASHED_WORDS = 1024
PAIRS_AT_ONCE = 1 << 13
MEET_PAIRS = 1 << 17
# Bits of a line's words that pairs of a run of so many rows are compared by before their hashes.
SKETCH_BITS = 1 << 14
SKETCHED_ROWS = 1 << 13
SKETCHES_AT_ONCE = 1 << 9
GROUP_ROWS = 1 << 20
NO_ID = -(1 << 63)
# Sizes of the bit maps of ids, and of wanted lines and lines that go on (8 MB): fuller maps only pass on more.
TOKEN_BITS = 1 << 23
LINE_BITS = 1 << 26
SCAN_BYTES = 1 << 18
SCANS_AT_ONCE = 32
# Postings a task gathers before it packs them, and words of all documents per bucket at most.
PACKED_ROWS = 1 << 17
BUCKET_WORDS = 1 << 23
# Rows of a bucket that are sorted and paired at once, and classes a task remembers as posted.
RUN_ROWS = 1 << 16
POSTED_SLOTS = 1 << 18
POSTING = ("token long, block int, doc long, copy long, line int, class long, n int, pos int, "
           "low long, high long, short boolean")
PACKED = {"token": "<i8", "block": "<i4", "doc": "<i8", "copy": "<i8", "line": "<i4", "class": "<i8", "n": "<i4",
          "pos": "<i4", "low": "<i8", "high": "<i8", "short": "?"}


def least_overlap(total, threshold=THRESHOLD):
    """Words two sets with ``total`` words together must share: o / (total - o) >= threshold."""
    num, den = threshold
    return -(-num * total // (num + den))


def prefix_words(n, threshold=THRESHOLD):
    num, den = threshold
    return n - (-(-num * n // den)) + 1


def _key(id_col: str, text_col: str) -> list:
    """A document: its id and the hash of its text."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
            F.xxhash64(F.col(text_col).cast("binary")).alias("copy")]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(*_key(id_col, text_col), as_bytes(text_col))


def _scanned(batches):
    """Documents (doc_id, doc, copy, n_lines), lines with a word counted, and how many words of a task fall in each hash
    bucket (piece, counts): a row per piece of the table, packed."""
    scanner, total, held = WordScanner(), np.zeros(BUCKETS, np.int64), []
    for batch in slices(batches, limit=SCAN_BYTES):
        texts = [t or b"" for t in batch.column(3).to_pylist()]
        words, at, data = scanner.scan(b"\n".join(texts))
        held.append((words & np.uint64(BUCKETS - 1)).astype(np.int32))
        if len(held) == SCANS_AT_ONCE:
            total += np.bincount(np.concatenate(held), minlength=BUCKETS)
            held = []
        lines = at[_line_starts(at, data)[1]]
        n = np.bincount(np.searchsorted(_offsets(texts), lines, "right") - 1, minlength=len(texts))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(n), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())],
            schema=SCANNED)
    if held:
        total += np.bincount(np.concatenate(held), minlength=BUCKETS)
    if total.any():
        packed = _pack_pieces({i: piece for i, piece in enumerate(np.split(total, PIECES)) if piece.any()})
        yield pa.RecordBatch.from_arrays(
            [*[pa.nulls(packed.num_rows, pa.int64())] * 4, *packed.columns], schema=SCANNED)


SCANNED = pa.schema([*((k, pa.int64()) for k in ("doc_id", "doc", "copy", "n_lines")),
                     ("piece", pa.int32()), ("counts", pa.binary())])


def _pack_pieces(pieces: dict) -> pa.RecordBatch:
    """Numbers of each piece by byte position, compressed."""
    packed = [zstandard.ZstdCompressor(level=1).compress(
        np.ascontiguousarray(v.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()) for v in pieces.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(pieces), pa.int32()), pa.array(packed, pa.binary())],
                                      names=["piece", "counts"])


def _unpack_piece(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def _added(batches):
    """The sum of the tables (piece, counts) of a task, by piece."""
    total = {}
    for batch in batches:
        for piece, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total[piece] = total.get(piece, 0) + _unpack_piece(packed)
    yield _pack_pieces(total)


def bucket_counts(scanned: DataFrame) -> np.ndarray:
    """How many words of all documents fall in each hash bucket."""
    rows = (scanned.where("piece is not null").select("piece", "counts").repartition("piece")
            .mapInArrow(tidied(_added), "piece int, counts binary"))
    counts = np.zeros((PIECES, BUCKETS // PIECES), np.int64)
    for r in rows.collect():  # at most ``PIECES`` rows
        counts[r["piece"]] = _unpack_piece(r["counts"])
    return counts.ravel()


def _offsets(texts: list) -> np.ndarray:
    """Where each text starts when they are joined by a byte."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return np.cumsum(sizes) - sizes


def _line_starts(at: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Line breaks of ``data``, and for each of its words (that start ``at``) whether it is the first of a line."""
    breaks = np.flatnonzero(data == 10)
    first = np.zeros(len(at) + 1, bool)
    first[np.searchsorted(at, breaks)] = True
    first[0] = True
    return breaks, first[:-1]


class LineSets:
    """Word sets of lines as arrays. A word's sort key is its bucket's rank, then hash bits."""

    def __init__(self, counts: np.ndarray):
        self.scanner = WordScanner()
        order = np.sort((counts << BUCKET_BITS) | np.arange(BUCKETS)) & (BUCKETS - 1)
        self.rank = np.empty(BUCKETS, np.uint32)
        self.rank[order] = np.arange(BUCKETS, dtype=np.uint32)

    def of(self, texts: list) -> dict:
        """By line with a word: text and line number, set size, class, sketches; by line and word,
        rare ones first: owner and sort key."""
        texts = [t or b"" for t in texts]
        offsets = _offsets(texts)
        words, at, data = self.scanner.scan(b"\n".join(texts))
        breaks, first = _line_starts(at, data)
        lines = at[first]
        owner = np.cumsum(first) - 1
        text = np.searchsorted(offsets, lines, "right") - 1
        number = np.searchsorted(breaks, lines) - np.searchsorted(breaks, offsets[text])
        keys = (self.rank[(words & np.uint64(BUCKETS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(HASH_BITS)) \
            | (words >> np.uint64(64 - HASH_BITS))
        chunks = []
        for s in range(0, max(len(lines), 1), LINES_AT_ONCE):  # an owner must fit above the key
            a, b = np.searchsorted(owner, [s, s + LINES_AT_ONCE])
            whole = ((owner[a:b] - s).astype(np.uint64) << np.uint64(KEY_BITS)) | keys[a:b]
            chunks.append(np.argsort(whole) + a)
        by = np.concatenate(chunks)
        words, keys, owner = words[by], keys[by], owner[by]
        fresh = np.ones(len(by), bool)
        fresh[1:] = (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])
        words, keys, owner = words[fresh], keys[fresh], owner[fresh]
        n = np.bincount(owner, minlength=len(lines))
        out = {"text": text, "line": number.astype(np.int32), "n": n, "owner": owner,
               "keys": keys.astype(np.int64), "hashes": words.astype(np.uint32)}
        if not len(lines):
            return out | {k: np.zeros(0, np.int64) for k in ("starts", "class", "low", "high")}
        starts = np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
        spread = mix(words + np.uint64(0x632BE59BD9B4E019))
        bit = np.uint64(1) << (spread >> np.uint64(58))
        upper = (spread >> np.uint64(57)) & np.uint64(1)
        sums = np.add.reduceat(spread, starts) + n.astype(np.uint64)
        return out | {
            "starts": starts, "class": mix(sums).view(np.int64),
            "low": np.bitwise_xor.reduceat(bit * (upper ^ np.uint64(1)), starts).view(np.int64),
            "high": np.bitwise_xor.reduceat(bit * upper, starts).view(np.int64)}


def token_bits(tokens: DataFrame, size: int = TOKEN_BITS) -> np.ndarray:
    """A bit map of fixed size that has the bits of all ``tokens`` (by their lowest bits)."""
    slot = F.col("token").bitwiseAND(F.lit(size - 1))
    rows = tokens.groupBy(F.shiftright(slot, 6).cast("int").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(token & 63 as int))")).alias("bits"))
    table, found = np.zeros(size // 64, np.int64), rows.toArrow()  # at most ``size`` / 64 rows
    table[found["at"].to_numpy()] = found["bits"].to_numpy()
    return table


def has_bit(table: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    slot = tokens & (64 * len(table) - 1)
    return (table[slot >> 6] >> (slot & 63)) & 1 == 1


def told_apart(batch: pa.RecordBatch, several) -> np.ndarray:
    """The text hashes of the documents (columns doc, copy) whose id may have several texts (``several``:
    broadcast ``token_bits`` of such ids), 0 for others."""
    doc, copy = (batch.column(i).to_numpy() for i in (0, 1))
    return np.where(has_bit(several.value, doc), copy, 0)


def _told_apart(several):
    def run(batches):
        for batch in batches:
            yield batch.append_column("told", pa.array(told_apart(batch, several), pa.int64()))

    return run


class PostedClasses:
    """The earliest line of a class that a task has posted, in a table of fixed size (a class takes
    the place of another with the same lowest bits; its lines are posted again then)."""

    def __init__(self, slots: int = POSTED_SLOTS):
        self.slots = slots
        self.held = [np.zeros(slots, np.int64) for _ in range(3)] + [np.full(slots, -1, np.int32)]

    def earlier(self, cls, doc, copy, line) -> np.ndarray:
        """Which lines come before all others of their class in this call and in the table."""
        new = np.zeros(len(cls), bool)
        by = np.lexsort((line, copy, doc, cls))
        first = by[np.flatnonzero(np.diff(cls[by], prepend=~cls[by[:1]]) != 0)]
        at = (cls[first] & (self.slots - 1)).astype(np.int64)
        known, d, c, n = (h[at] for h in self.held)
        before = (doc[first] < d) | ((doc[first] == d) & (
            (copy[first] < c) | ((copy[first] == c) & (line[first] < n))))
        take = (known != cls[first]) | (n < 0) | before
        new[first[take]] = True
        for h, values in zip(self.held, (cls, doc, copy, line)):
            h[at[take]] = values[first[take]]
        return new


def _postings(sent, threshold, only=None, several=None):
    """A row per prefix word of a line; a line that can only be like its copies has one row, n = 0, and a copy of an
    earlier line posted here has none.

    ``only``: broadcast ``token_bits`` of lines and tokens that are tried again; the postings are not made from
    documents then but read from packed rows of whole groups. Of a group such lines stay and rows that ``may_meet`` them.
    """
    def unpacked(batches):
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                t = _unpack_rows(packed)
                at = np.flatnonzero(may_meet(t, has_bit(only.value, pair_tokens(t["class"], t["token"])), threshold))
                yield pa.RecordBatch.from_arrays([pa.array(t[k][at]) for k in PACKED], names=list(PACKED))

    def run(batches):
        sets, seen = LineSets(sent.value), PostedClasses()
        counts = np.sort(sent.value)  # by rank
        hot = int(np.searchsorted(counts, GROUP_ROWS, "right"))
        for batch in slices(batches, limit=SCAN_BYTES):
            s = sets.of(batch.column(2).to_pylist())
            doc, copy = batch.column(0).to_numpy(), told_apart(batch, several)
            yield post(s, doc[s["text"]], copy[s["text"]], s["line"], seen, counts, hot)

    def post(s, doc, copy, line, seen, counts, hot):
        new = seen.earlier(s["class"], doc, copy, line)
        # such a set is no more similar to one with a word more, nor to any other but its own
        alone = threshold[1] * s["n"] < threshold[0] * (s["n"] + 1)
        posted = new & ~alone
        prefix = np.where(posted, prefix_words(s["n"], threshold), 1)
        pos = np.arange(len(s["keys"])) - s["starts"][s["owner"]]
        at = np.flatnonzero(pos < np.where(new, prefix, 0)[s["owner"]])
        rank = s["keys"][at] >> HASH_BITS
        row, block = [np.flatnonzero(rank < hot)], [np.zeros(int((rank < hot).sum()), np.int64)]
        for k in np.flatnonzero(rank >= hot).tolist():
            parts = int(-(-counts[rank[k]] // GROUP_ROWS))
            mine = int(s["class"][s["owner"][at[k]]]) % parts
            row.append(np.full(parts, k))
            block.append(np.array([min(mine, u) * parts + max(mine, u) for u in range(parts)]))
        at = at[np.concatenate(row)]
        own = s["owner"][at]
        # a pair of 128 words or fewer in all is compared by the folded sketch
        short = s["n"] * (threshold[0] + threshold[1]) <= 128 * threshold[0]
        low = np.where(short, s["low"] ^ s["high"], s["low"])
        high = np.where(short, 0, s["high"])
        low, high = np.where(posted, low, 0), np.where(posted, high, 0)
        n = np.where(posted, s["n"], 0)[own].astype(np.int32)
        columns = [pa.array(s["keys"][at]), pa.array(np.concatenate(block).astype(np.int32)),
                   pa.array(doc[own]), pa.array(copy[own]), pa.array(line[own]),
                   pa.array(s["class"][own]), pa.array(n),
                   pa.array(pos[at].astype(np.int32)), pa.array(low[own]), pa.array(high[own]),
                   pa.array(short[own])]
        return pa.RecordBatch.from_arrays(columns, names=list(PACKED))

    return run if only is None else unpacked


def _columns(batch: pa.RecordBatch, names) -> dict:
    return {k: batch.column(i).to_numpy(zero_copy_only=False) for i, k in enumerate(names)}


def _starts(t: dict) -> np.ndarray:
    """Where the groups of postings sorted by token and block start."""
    edge = np.flatnonzero((t["token"][1:] != t["token"][:-1]) | (t["block"][1:] != t["block"][:-1])) + 1
    return np.concatenate([[0], edge]).astype(np.int64)


def _pack_rows(t: dict) -> bytes:
    """Postings by column and byte position (equal bytes side by side), compressed."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(
        np.ascontiguousarray(t[k].astype(kind, copy=False).view(np.uint8)
                             .reshape(len(t[k]), -1).T).tobytes() for k, kind in PACKED.items()))


def _unpack_rows(packed: bytes) -> dict:
    raw, at, out = zstandard.ZstdDecompressor().decompress(packed), 0, {}
    size = len(raw) // sum(np.dtype(kind).itemsize for kind in PACKED.values())
    for k, kind in PACKED.items():
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, size * width, at).reshape(width, size)
        out[k], at = np.ascontiguousarray(planes.T).view(kind).ravel(), at + size * width
    return out


def _packed_postings(sent, threshold, buckets: int, several):
    """The postings of a task by bucket, a row each; a token's block lies in one bucket."""
    names = list(PACKED)

    def run(batches):
        held, size = [], 0
        for batch in _postings(sent, threshold, several=several)(batches):
            held.append(_columns(batch, names))
            size += batch.num_rows
            if size >= PACKED_ROWS:
                yield pack(held)
                held, size = [], 0
        if size:
            yield pack(held)

    def pack(held):
        t = {k: np.concatenate([h[k] for h in held]) for k in names}
        place = mix(t["token"].view(np.uint64) + mix(t["block"].astype(np.uint64)))
        bucket = (place % np.uint64(buckets)).astype(np.int32)
        by = np.argsort((bucket.astype(np.int64) << KEY_BITS) | t["token"])
        bucket, t = bucket[by], {k: v[by] for k, v in t.items()}
        edges = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
        packed = [_pack_rows({k: v[a:b] for k, v in t.items()}) for a, b in zip(edges, edges[1:])]
        return pa.RecordBatch.from_arrays([pa.array(bucket[edges[:-1]]),
                                           pa.array(packed, pa.binary())],
                                          names=["bucket", "packed"])

    return run


def _buckets(batches):
    """The postings of one bucket after the other, sorted like a group, in runs of whole tokens of about
    ``RUN_ROWS`` rows."""
    held, last = [], None
    for batch in batches:
        for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if bucket != last and held:
                yield from _runs(held)
                held = []
            held.append(_unpack_rows(packed))
            last = bucket
    if held:
        yield from _runs(held)


def _runs(held: list[dict]):
    """``held``: tables that are each sorted by token."""
    tokens = np.sort(np.concatenate([h["token"] for h in held]))
    edges = np.unique(tokens[RUN_ROWS::RUN_ROWS])  # a run ends before such a token
    del tokens
    cuts = [[0, *np.searchsorted(h["token"], edges).tolist(), len(h["token"])] for h in held]
    for i in range(len(edges) + 1):
        parts = [{k: v[c[i]:c[i + 1]] for k, v in h.items()} for h, c in zip(held, cuts) if c[i + 1] > c[i]]
        if parts:
            yield _sorted(parts)


def _sorted(held: list[dict]) -> dict:
    t = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
    by = np.argsort(t["token"])
    same = np.diff(t["token"][by]) == 0
    more = np.flatnonzero(np.append(same, False) | np.concatenate([[False], same]))
    at = by[more]  # rows that share their token: most have one of their own
    by[more] = at[np.lexsort([t[k][at] for k in ("line", "copy", "doc", "block", "token")])]
    return {k: v[by] for k, v in t.items()}


def _groups(batches):
    """Plain marked postings, sorted by group, in runs of whole groups."""
    names, held = [*PACKED, "hashes", "probe"], None
    for batch in batches:
        t = _columns(batch, names)
        held = t if held is None else {k: np.concatenate([held[k], t[k]]) for k in t}
        if not len(held["token"]):
            continue
        other = (held["token"] != held["token"][-1]) | (held["block"] != held["block"][-1])
        if other.any():
            cut = len(other) - int(np.argmax(other[::-1]))
            yield from _portions({k: v[:cut] for k, v in held.items()})
            held = {k: v[cut:] for k, v in held.items()}
    if held is not None and len(held["token"]):
        yield from _portions(held)


def _portions(t: dict):
    """Whole groups that have ``SKETCHED_ROWS`` rows together at most, or one group."""
    edges, s = np.append(_starts(t), len(t["token"])), 0
    while s < len(edges) - 1:
        e = max(s + 1, int(np.searchsorted(edges, edges[s] + SKETCHED_ROWS, "right")) - 1)
        yield {k: v[edges[s]:edges[e]] for k, v in t.items()}
        s = e


def may_match(t: dict, x, y, threshold) -> np.ndarray:
    """Length, positional and sketch filters of the posting pairs (x, y), each on what is left."""
    ok = np.zeros(len(x), bool)
    nx, ny = t["n"][x], t["n"][y]
    need = least_overlap(nx + ny, threshold)
    left = np.flatnonzero(np.minimum(nx, ny) >= need)
    x, y, nx, ny, need = x[left], y[left], nx[left], ny[left], need[left]
    px, py = t["pos"][x], t["pos"][y]
    near = np.minimum(px, py) + np.minimum(nx - px, ny - py) >= need
    left, x, y, spare = left[near], x[near], y[near], (nx + ny - 2 * need)[near]
    low, high = t["low"][x] ^ t["low"][y], t["high"][x] ^ t["high"][y]
    folded = t["short"][x] | t["short"][y]
    differ = (np.bitwise_count(np.where(folded, low ^ high, low)).astype(np.int32)
              + np.bitwise_count(np.where(folded, np.uint64(0), high)))
    ok[left] = (differ <= spare) & (t["class"][x] != t["class"][y])
    return ok


def may_meet(t: dict, probe: np.ndarray, threshold) -> np.ndarray:
    """Which rows of whole groups are marked ``probe`` or pass ``may_match`` with a later such row of their group."""
    num, den = threshold
    t = t | {k: t[k].view(np.uint64) for k in ("low", "high")}
    starts, keep, at = _starts(t), probe.copy(), np.flatnonzero(probe)
    group = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(probe))) << 32
    rest = np.flatnonzero(~probe)  # not met so far; by set size, so that only sets of similar sizes meet
    rest = rest[np.argsort(group[rest] | t["n"][rest], kind="stable")]

    def similar_sizes(y):
        sizes, n = group[rest] | t["n"][rest], t["n"][y].astype(np.int64)
        first = np.searchsorted(sizes, group[y] | -(-num * n // den))
        return first, np.searchsorted(sizes, group[y] | den * n // num, "right") - first

    pairs = np.cumsum(similar_sizes(at)[1])
    while len(at) and len(rest):
        end = max(1, int(np.searchsorted(pairs, pairs[0] + MEET_PAIRS)))
        y, at, pairs = at[:end], at[end:], pairs[end:]
        first, count = similar_sizes(y)
        x = rest[np.arange(int(count.sum())) + np.repeat(first - (np.cumsum(count) - count), count)]
        y = np.repeat(y, count)
        x, y = x[x < y], y[x < y]
        keep[x[may_match(t, x, y, threshold)]] = True
        rest = rest[~keep[rest]]
    return keep


def with_hashes(t: dict) -> dict:
    """``hashes`` of all postings as one array, and where those of each posting ``from`` and how
    many there are (0: not known)."""
    sizes = np.fromiter(map(len, t["hashes"]), np.int64, len(t["hashes"])) // 4
    t = t | {"hashes": np.frombuffer(b"".join(t["hashes"]), np.uint32).astype(np.int64),
             "from": np.cumsum(sizes) - sizes, "hashed": sizes, "bits": None}
    if len(sizes) <= SKETCHED_ROWS:
        bits = np.zeros((len(sizes), SKETCH_BITS // 64), np.uint64)
        slot = t["hashes"] & (SKETCH_BITS - 1)
        np.bitwise_or.at(bits, (np.repeat(np.arange(len(sizes)), sizes), slot >> 6),
                         np.uint64(1) << (slot & 63).astype(np.uint64))
        t |= {"bits": bits, "lost": t["n"] - np.bitwise_count(bits).sum(1).astype(np.int64)}
    return t


def may_share(t: dict, x, y, threshold) -> np.ndarray:
    """Whether the posting pairs (x, y) have hashes in common for the overlap they need."""
    ok = np.ones(len(x), bool)
    known = np.flatnonzero((t["hashed"][x] > 0) & (t["hashed"][y] > 0))
    if t["bits"] is not None:
        for s in range(0, len(known), SKETCHES_AT_ONCE):
            at = known[s:s + SKETCHES_AT_ONCE]
            a, b = x[at], y[at]
            # a word of either line that shares its bit with another of that line may be in common too
            most = (np.bitwise_count(t["bits"][a] & t["bits"][b]).sum(1, dtype=np.int64)
                    + np.minimum(t["lost"][a], t["lost"][b]))
            ok[at] = most >= least_overlap(t["n"][a] + t["n"][b], threshold)
        known = known[ok[known]]
    for s in range(0, len(known), PAIRS_AT_ONCE):
        at = known[s:s + PAIRS_AT_ONCE]
        keys = []
        for z in (x[at], y[at]):
            n = t["hashed"][z]
            word = np.arange(int(n.sum())) + np.repeat(t["from"][z] - (np.cumsum(n) - n), n)
            keys.append((np.repeat(np.arange(len(at)), n) << 32) | t["hashes"][word])
        keys = np.sort(np.concatenate(keys))
        # colliding hashes only add to the count
        both = np.bincount(keys[1:][keys[1:] == keys[:-1]] >> 32, minlength=len(at))
        ok[at] = both >= least_overlap(t["n"][x[at]] + t["n"][y[at]], threshold)
    return ok


def group_pairs(t: dict, threshold, tried: int, upto: int, every: bool):
    """(later, earlier, more) posting pairs of arrays sorted by token, block, document and line, in
    pieces of about ``PAIRS_AT_ONCE`` pairs or the rows of a group.

    In a group a line passes on the candidates after the first ``tried`` up to about ``upto``, the last
    with ``more`` set; with ``every`` only the lines marked ``probe`` do, and hashes are compared.
    """
    size = len(t["token"])
    if every:
        t = with_hashes(t)
    starts = np.append(_starts(t), size)
    lengths = np.diff(starts)
    after = np.repeat(starts[1:], lengths) - np.arange(size)  # rows to the end of the group
    held, count = [], 0

    def passes(x, y):
        ok = may_match(t, x, y, threshold)
        if every and ok.any():
            ok[ok] = may_share(t, x[ok], y[ok], threshold)
        return ok

    def piece():
        nonlocal held, count
        out = tuple(np.concatenate(a) for a in zip(*held))
        held, count = [], 0
        return out

    # middle-sized groups: by set size, so that only sets of similar sizes meet
    num, den = threshold
    by = np.argsort((np.repeat(np.arange(len(lengths)), lengths) << 32) | t["n"], kind="stable")
    sizes, had = t["n"][by].astype(np.int64), np.zeros(size, np.int64)
    met = lengths <= SMALL_GROUP
    if every:
        met &= np.logical_or.reduceat(t["probe"], starts[:-1])
    x = np.flatnonzero(np.repeat(met, lengths))
    for d in range(1, SMALL_GROUP):
        x = x[after[x] > d]
        x = x[num * sizes[x + d] <= den * sizes[x]]
        if not len(x):
            break
        one, two = by[x], by[x + d]
        last, first = np.maximum(one, two), np.minimum(one, two)
        open_ = had[last] < upto
        if every:
            open_ &= t["probe"][last]
        last, first = last[open_], first[open_]
        ok = passes(first, last)
        last, first = last[ok], first[ok]
        np.add.at(had, last, 1)
        new = had[last] > tried
        held.append((last[new], first[new], had[last[new]] >= upto))
        count += int(new.sum())
        if count >= PAIRS_AT_ONCE:
            yield piece()
    for g in np.flatnonzero(lengths > SMALL_GROUP).tolist():
        s, e = int(starts[g]), int(starts[g + 1])
        left = np.arange(s, e)
        if every:
            left = left[t["probe"][s:e]]
        had = np.zeros(e - s, np.int64)
        for x in range(s, e):
            left = left[np.searchsorted(left, x, "right"):]
            if not len(left):
                break
            ok = passes(np.full(len(left), x), left)
            if ok.any():
                found = left[ok]
                had[found - s] += 1
                left = left[had[left - s] < upto]
                found = found[had[found - s] > tried]
                held.append((found, np.full(len(found), x), had[found - s] >= upto))
                count += len(found)
                if count >= PAIRS_AT_ONCE:
                    yield piece()
    if held:
        yield piece()


def earliest(t: dict, at: np.ndarray) -> dict:
    """Of the postings ``at`` the first of each class in each group: that of its first line in all documents."""
    cls = t["class"][at]
    group = np.zeros(len(t["token"]), np.int32)
    group[_starts(t)[1:]] = 1
    group = np.cumsum(group, dtype=np.int32)[at]
    by = np.argsort(cls, kind="stable")  # groups and, in them, documents stay in order
    keep = np.ones(len(by), bool)
    keep[1:] = (np.diff(cls[by]) != 0) | (np.diff(group[by]) != 0)
    at = at[np.sort(by[keep])]
    return {k: v[at] for k, v in t.items()}


def _candidates(threshold, tried: int, upto: int, every: bool, sent=None):
    """Candidate pairs (class a after class b). Without ``every`` rows of two more kinds: the first line in all
    documents of every class a; and the packed postings of the groups in which a line has more candidates than it
    passes on. ``sent``: broadcast ``bucket_counts``."""
    def run(batches):
        counts = None if every else np.sort(sent.value)  # by rank
        for t in _groups(batches) if every else _buckets(batches):
            t |= {k: t[k].view(np.uint64) for k in ("low", "high")}
            if not every:
                yield lines(t, counts)
            posted = t["n"] > 0
            starts = _starts(t)
            lengths = np.diff(starts, append=len(posted))
            posted &= np.repeat(lengths > 1, lengths)  # others meet none
            if posted.any():
                yield from pairs(earliest(t, np.flatnonzero(posted)))

    def lines(t, counts):
        # all lines of a class have the same first word; a split word repeats them in several blocks
        parts = -(-counts[t["token"] >> HASH_BITS] // GROUP_ROWS)
        at = np.flatnonzero((t["pos"] == 0) & (t["class"] % parts == t["block"]))
        at = at[np.argsort(t["class"][at], kind="stable")]  # document order stays
        at = at[np.diff(t["class"][at], prepend=~t["class"][at[:1]]) != 0]
        return output(len(at), a=t["class"][at], **{k: t[k][at] for k in ("doc", "copy", "line")})

    def pairs(t):
        rest = np.zeros(len(t["token"]), bool)
        for later, earlier, more in group_pairs(t, threshold, tried, upto, every):
            rest[later[more]] = True
            yield output(len(later), a=t["class"][later], b=t["class"][earlier], token=t["token"][later], more=more)
        if rest.any() and not every:
            starts = _starts(t)
            whole = np.repeat(np.logical_or.reduceat(rest, starts), np.diff(starts, append=len(rest)))
            yield output(1, packed=[_pack_rows({k: v[whole] for k, v in t.items()})])

    def output(size, **columns):
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in CANDIDATE],
            schema=CANDIDATE)

    return run


CANDIDATE = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("doc", pa.int64()), ("copy", pa.int64()), ("line", pa.int32()),
                       ("token", pa.int64()), ("more", pa.bool_()), ("packed", pa.binary())])
CANDIDATES = "a long, b long, doc long, copy long, line int, token long, more boolean, packed binary"


def pair_tokens(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """One number per pair of numbers (a document and a line, a class and a token), for a bit map of them."""
    return mix(x.astype(np.int64).view(np.uint64) ^ mix(y.astype(np.uint64) + np.uint64(1))).view(np.int64)


def _tokens_of(batches):
    for batch in batches:
        made = pair_tokens(*(batch.column(i).to_numpy() for i in (0, 1)))
        yield pa.RecordBatch.from_arrays([pa.array(made)], names=["token"])


def _lines(several, wanted):
    """(doc, copy, line, words) of the lines that may be wanted (``wanted``: broadcast ``token_bits`` of line tokens)."""
    def run(batches):
        for batch in slices(batches):
            parts = [(t or b"").split(b"\n") for t in batch.column(2).to_pylist()]
            sizes = np.fromiter(map(len, parts), np.int64, len(parts))
            line = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            doc, copy = (np.repeat(x, sizes) for x in (batch.column(0).to_numpy(), told_apart(batch, several)))
            at = np.flatnonzero(has_bit(wanted.value, pair_tokens(doc, line)))
            text = np.repeat(np.arange(len(parts)), sizes)[at].tolist()
            line = line[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[at]), pa.array(copy[at]), pa.array(line.astype(np.int32)),
                 pa.array([parts[i][k] for i, k in zip(text, line.tolist())], pa.binary())],
                names=["doc", "copy", "line", "words"])

    return run


def _of_class(sent):
    """The lines (class, words) that are of that class."""
    def run(batches):
        for batch, classes, s in _sets_of(sent, batches):
            yield batch.filter(pa.array(s["class"] == classes, pa.bool_()))

    return run


def _hashes_of(sent):
    """(class, hashes) of lines (class, words): 32-bit hashes of the words, empty if there are more than
    ``HASHED_WORDS`` of them."""
    def run(batches):
        for batch, _, s in _sets_of(sent, batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
                [s["hashes"][a:a + n].tobytes() if n <= HASHED_WORDS else b""
                 for a, n in zip(s["starts"].tolist(), s["n"].tolist())], pa.binary())], names=["class", "hashes"])

    return run


def _sets_of(sent, batches):
    """Lines (class, words) that have a word, their classes and their ``LineSets``."""
    sets = LineSets(sent.value)
    for batch in slices(batches, rows=1 << 14, limit=SCAN_BYTES):
        batch = batch.filter(pa.array([bool(w.split()) for w in batch.column(1).to_pylist()], pa.bool_()))
        yield batch, batch.column(0).to_numpy(), sets.of(batch.column(1).to_pylist())


def _verify(threshold):
    num, den = threshold

    def run(batches):
        held = [(None, None)] * 2  # pairs come sorted by one of their lines
        for batch in batches:
            ok = []
            for pair in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                held = [last if last[0] == words else (words, set(words.split())) for last, words in zip(held, pair)]
                (_, x), (_, y) = held
                both = len(x & y)
                ok.append(den * both >= num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok, pa.bool_()))],
                                             names=["a"])

    return run


def kept_lines(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(doc, copy, n_lines, kept): for every document (id and text hash) how many of its lines have a word, and the
    numbers of those that stay (from 0, counting all lines)."""
    return _verdicts(docs, threshold, id_col, text_col, ["doc", "copy"])


def _verdicts(docs: DataFrame, threshold, id_col: str, text_col: str, keys: list[str]) -> DataFrame:
    """``kept_lines`` by ``keys``: doc, copy and, if the id is wanted as it was, doc_id."""
    keyed, spark = _keyed(docs, id_col, text_col), docs.sparkSession
    # one reading for what is counted: the documents themselves, their lines and their words
    scanned = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), *_key(id_col, text_col), as_bytes(text_col))
                      .mapInArrow(tidied(_scanned), "doc_id long, doc long, copy long, n_lines long, piece int, counts binary"),
                      "line-dedup-documents")
    documents = durable(scanned.where("doc is not null").groupBy(*keys).agg(F.max("n_lines").alias("n_lines")))
    several = spark.sparkContext.broadcast(token_bits(
        documents.groupBy("doc").count().where("count > 1").select(F.col("doc").alias("token"))))
    total = bucket_counts(scanned)
    sent = spark.sparkContext.broadcast(total)
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")),
                  int(total.sum()) // BUCKET_WORDS)

    def texts_of(lines: DataFrame) -> DataFrame:
        """(class, words) of lines (class, doc, copy, line), each class once."""
        wanted = written(lines, "line-dedup-wanted")
        bits = spark.sparkContext.broadcast(token_bits(
            wanted.select("doc", "line").mapInArrow(tidied(_tokens_of), "token long"), LINE_BITS))
        # rows that repeat an id and a text are grouped by the keys of the join: texts are dealt out once
        return durable(keyed.where("text is not null")
                       .mapInArrow(tidied(_lines(several, bits)), "doc long, copy long, line int, words binary")
                       .join(wanted, ["doc", "copy", "line"])
                       .groupBy("doc", "copy", "line").agg(F.min("class").alias("class"), F.min("words").alias("words"))
                       .select("class", "words").mapInArrow(tidied(_of_class(sent)), "class long, words binary"))

    def unique(pairs: DataFrame) -> DataFrame:
        # a written table: the planner knows its size and may broadcast it
        return written(pairs.select("a", "b").distinct(), "line-dedup-pairs")

    def similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """Classes with a verified earlier match."""
        return (pairs.join(texts.toDF("a", "wa"), "a").join(texts.toDF("b", "wb"), "b")
                .select("a", "wa", "wb").mapInArrow(tidied(_verify(threshold)), "a long").distinct())

    found = written(keyed.mapInArrow(tidied(_packed_postings(sent, threshold, buckets, several)),
                                     "bucket int, packed binary")
                    .repartition("bucket").sortWithinPartitions("bucket")
                    .mapInArrow(tidied(_candidates(threshold, 0, FIRST_PAIRS, False, sent)), CANDIDATES),
                    "line-dedup-found")
    # the first line of each class in all documents stands for it, its copies go
    first = found.where("doc is not null").select(F.col("a").alias("class"), "doc", "copy", "line")
    pairs = found.where("b is not null")
    met = unique(pairs)
    paired = met.select("a").union(met.select("b")).distinct().toDF("class")
    removed = durable(similar(met, texts_of(first.join(paired, "class"))))
    tried, step, postings, texts = 0, STEP_PAIRS, None, None
    while True:
        again = written(pairs.where("more").select(F.col("a").alias("class"), "token").distinct()
                        .join(removed.toDF("class"), "class", "left_anti"), "line-dedup-again")
        if again.isEmpty():
            break
        if postings is None:
            # the groups of later steps are among those of the first: documents are read for the texts of
            # their lines here and not again
            only = spark.sparkContext.broadcast(token_bits(
                again.select("class", "token").mapInArrow(tidied(_tokens_of), "token long"), LINE_BITS))
            postings = written(found.where("packed is not null").select("packed")
                               .mapInArrow(tidied(_postings(sent, threshold, only)), POSTING), "line-dedup-postings")
            texts = texts_of(first.join(postings.select("class").distinct(), "class"))
            postings = durable(postings.join(
                texts.mapInArrow(tidied(_hashes_of(sent)), "class long, hashes binary"), "class"))
        marked = (postings.join(again.withColumn("probe", F.lit(True)), ["class", "token"], "left")
                  .select(*PACKED, "hashes", F.coalesce("probe", F.lit(False)).alias("probe")))
        pairs = durable(marked.repartition("token", "block")
                        .sortWithinPartitions("token", "block", "doc", "copy", "line")
                        .mapInArrow(tidied(_candidates(threshold, tried, tried + step, True)), CANDIDATES))
        removed = durable(removed.union(similar(unique(pairs), texts)).distinct())
        tried, step = tried + step, min(4 * step, MOST_PAIRS)
    # shuffle files of tables that are written stay until the driver collects its garbage; the next join may be as large
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    stay = (first.join(removed.toDF("class"), "class", "left_anti")
            .groupBy("doc", F.col("copy").alias("told")).agg(F.sort_array(F.collect_list("line")).alias("kept")))
    order = ["doc", "copy", "n_lines", *(k for k in keys if k not in ("doc", "copy"))]
    told = documents.select(*order).mapInArrow(tidied(_told_apart(several)), ", ".join(f"{k} long" for k in [*order, "told"]))
    return told.join(stay, ["doc", "told"], "left").select(
        *keys, "n_lines", F.coalesce("kept", F.array().cast("array<int>")).alias("kept"))


def line_report(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_removed, kept): one row per document (id and text), lines with a word
    counted."""
    found = _verdicts(docs, threshold, id_col, text_col, ["doc_id", "doc", "copy"])
    return found.select("doc_id", "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_removed"), "kept")


def remove_lines(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``docs`` with the removed lines taken out of the text; lines without a word stay. Columns
    ``n_lines`` and ``n_removed`` follow (theirs replace columns of the same names)."""
    key, out = ["_line_dedup_doc", "_line_dedup_copy"], docs.drop("n_lines", "n_removed")
    verdict = kept_lines(docs, threshold, id_col, text_col).toDF(*key, "_n", "_kept")
    spaces = " \t\x0b\f\r"
    text = F.concat_ws("\n", F.filter(
        F.split(text_col, "\n", -1),
        lambda line, i: (F.translate(line, spaces, "") == "") | F.array_contains("_kept", i)))
    n = F.coalesce("_n", F.lit(0))
    return (out.withColumns(dict(zip(key, _key(id_col, text_col))))
            .join(verdict, key, "left")
            .withColumn("n_lines", n.cast("long"))
            .withColumn("n_removed", (n - F.coalesce(F.size("_kept"), F.lit(0))).cast("long"))
            .withColumn(text_col, F.when(F.col("n_removed") > 0, text)
                        .otherwise(F.col(text_col)))
            .drop(*key, "_n", "_kept"))
