"""Fill-in-middle transformation by repeated-capture matching.

One fullmatch of ``(unit)*`` with the ``regex`` library retains every repetition of its group, so
``match.ends(1)`` gives the number of units (its length) and both cut offsets (its entries)
without a loop over units. A unit is a run of ASCII letters or any other single character, counted over
code points. Texts above ``BLOCK`` code points are matched in blocks that end at a unit's end, which
bounds the memory of the retained captures.

Four unsigned numbers h1 to h4, the first four groups of eight hex digits of
``sha256(salt + id)``, decide everything, so a rerun and a lost executor give the same rows:
the prefix ends after the smaller of h1 and h2 modulo n + 1 units, the middle after the larger;
h3 decides whether the text is changed, h4 the order of the parts.

Forms: ``plain`` is the text itself; ``psm`` is ``<P>prefix<S>suffix<M>middle``; ``spm`` is
``<S>suffix<P>prefix<M>middle``. A text that is empty or holds a marker stays plain, so the markers of
the other two forms are the only ones and ``restored`` is exact.

Defined results: a null text is the empty text, n 0 and plain; a null id counts as the empty id; rows
that repeat an id get the same numbers, applied to their own text; bytes that are not UTF-8 count as one
code point each and come back unchanged; an empty table gives an empty table; a kept column with the
name of a new one is replaced.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.common import slices

# The markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[A-Za-z]+|[^A-Za-z]"
# Code points matched at once.
BLOCK = 1 << 19
MADE = "n long, form string, prefix_chars long, middle_chars long, output binary"


def unit_matcher(unit: str = UNIT, block: int = BLOCK):
    """Function from a text to the offsets at which its units end, in one list per block."""
    import regex

    units, boundary = regex.compile(f"({unit})*"), regex.compile("[^A-Za-z]")

    def ends(text: str) -> list[list[int]]:
        found, start = [], 0
        while len(text) - start > block:
            stop = boundary.search(text, start + block)
            stop = stop.start() if stop else len(text)
            found.append(units.fullmatch(text, start, stop).ends(1))
            start = stop
        found.append(units.fullmatch(text, start).ends(1))
        return found

    return ends


def end_of(ends: list[list[int]], k: int) -> int:
    """Offset at which the first ``k`` units end."""
    if k == 0:
        return 0
    for block in ends:
        if k <= len(block):
            return block[k - 1]
        k -= len(block)
    raise IndexError(k)


def transform(text: str, seed: str, ends, plain_from: int, spm_below: int) -> tuple:
    """(n, form, prefix and middle length or None, output) of one text."""
    blocks = ends(text)
    n = sum(map(len, blocks))
    h1, h2, h3, h4 = (int(seed[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= plain_from:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = end_of(blocks, low), end_of(blocks, high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_below:
        return n, "spm", a, b - a, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", a, b - a, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def fill_middle(docs: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id",
                text_col: str = "text", salt: str = "1:", plain_from: int = 90,
                spm_below: int = 20) -> DataFrame:
    """Columns ``keep`` (all but the text by default) and ``n``, ``form``, ``prefix_chars``,
    ``middle_chars`` (null if plain) and ``output`` of every row.

    ``plain_from``: texts whose h3 modulo 100 is at least this stay plain. ``spm_below``: of the others, those
    whose h4 modulo 100 is below this are written suffix first.
    """
    added = StructType.fromDDL(MADE)
    keep = [c for c in (docs.columns if keep is None else keep)
            if c not in added.names and (keep is not None or c != text_col)]
    seed = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    rows = docs.select(*keep, seed.alias("_seed"),
                       F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("_text"))
    schema = StructType([rows.schema[c] for c in keep] + added.fields)
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches):
        ends = unit_matcher()
        for batch in slices(batches):
            made = [transform(text.decode("utf-8", "surrogateescape"), seed, ends, plain_from, spm_below)
                    for seed, text in zip(batch.column(len(keep)).to_pylist(),
                                          batch.column(len(keep) + 1).to_pylist())]
            columns = [pa.array([m[i] for m in made], t) for i, t in enumerate(types)]
            columns.append(pa.array([m[4].encode("utf-8", "surrogateescape") for m in made], pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *columns], names=schema.names)

    return rows.mapInArrow(run, schema).withColumn("output", F.col("output").cast("string"))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that ``fill_middle`` was given, rebuilt from its output and form alone."""
    out = F.col(output)
    middle = F.substring_index(out, MIDDLE, -1)
    head = F.substring_index(out, MIDDLE, 1)
    first, second = {}, {}
    for name, (one, two) in {"psm": (PREFIX, SUFFIX), "spm": (SUFFIX, PREFIX)}.items():
        first[name] = F.substring_index(F.substring_index(head, two, 1), one, -1)
        second[name] = F.substring_index(head, two, -1)
    return (F.when(F.col(form) == "psm", F.concat(first["psm"], middle, second["psm"]))
            .when(F.col(form) == "spm", F.concat(second["spm"], middle, first["spm"]))
            .otherwise(out))
