"""Secret scans by grammar inference.

Three base rules find credentials and label them with their kind. From a bounded sample of each kind's
distinct values a probabilistic automaton is inferred: their prefix tree, whose states are merged
while Hoeffding's bound finds their symbol and end frequencies compatible (a red-blue state
merge). One more automaton is inferred from ordinary candidates, runs of credential characters that no
base rule covers. Every such run of the corpus is then scored: it is a further secret if the log
likelihood under the best kind's automaton exceeds that under the ordinary one by ``LEAST_ODDS``
and ``LEAST_ODDS_PER_SYMBOL`` for each symbol. The span takes that kind. Base spans stay as
they are; candidates that overlap one are not scored again.

The sample holds, per kind and for ordinary candidates, the ``SAMPLE`` distinct values of at most
``SAMPLE_CHARS`` characters with the smallest hash; every task keeps only its own ``SAMPLE`` smallest
ones before the shuffle. A kind with fewer than ``LEAST_VALUES`` distinct values has no automaton, and
without ordinary candidates their automaton gives every symbol the same chance. Everything else covers all rows and whole texts.

Defined results: a null text has no secrets; offsets count code points, a byte that is not UTF-8 as one;
rows that repeat an id or text each get a row; ids, labels and extra columns are not read; an empty table
gives an empty table.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.common import slices

# The base rules (kind, pattern, group that is the value, characters it needs).
BASE_RULES = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
KINDS = tuple(rule[0] for rule in BASE_RULES)
SYMBOLS = 68  # characters that a candidate can hold
CANDIDATE_CHARS = 16
SAMPLE = 1000
SAMPLE_CHARS = 128
LEAST_VALUES = 20
CONFIDENCE = 0.05  # of the Hoeffding bound
SMOOTHING = 1.0  # observations spread over all symbols and the end in every state
ORDINARY_MIXED = 0.1  # share of the ordinary automaton's chances that knows nothing of the sample
LEAST_ODDS = 12.0
LEAST_ODDS_PER_SYMBOL = 0.5
ORDINARY = ""
SECRETS = "secrets array<struct<kind: string, start: int, `end`: int, text: string, odds: double>>"


@dataclass
class State:
    """A state of a prefix tree or automaton: how often it is reached, left and ended in."""
    count: int = 0
    ends: int = 0
    to: dict = field(default_factory=dict)  # symbol -> [next state, times taken]


def prefix_tree(values: list[str]) -> State:
    root = State()
    for value in values:
        node = root
        node.count += 1
        for symbol in value:
            step = node.to.setdefault(symbol, [None, 0])
            step[0] = step[0] or State()
            step[1] += 1
            node = step[0]
            node.count += 1
        node.ends += 1
    return root


def compatible(a: State, b: State, confidence: float) -> bool:
    """Whether two states and those that follow them on common symbols may be the same."""
    bound = math.sqrt(0.5 * math.log(2 / confidence))
    pairs = [(a, b)]
    while pairs:
        a, b = pairs.pop()
        if not a.count or not b.count:
            continue
        least = bound * (a.count ** -0.5 + b.count ** -0.5)
        if abs(a.ends / a.count - b.ends / b.count) > least:
            return False
        for symbol in a.to.keys() | b.to.keys():
            x, y = a.to.get(symbol), b.to.get(symbol)
            if abs((x[1] if x else 0) / a.count - (y[1] if y else 0) / b.count) > least:
                return False
            if x and y:
                pairs.append((x[0], y[0]))
    return True


def fold(into: State, tree: State) -> None:
    """Add a tree to a state, so that the automaton stays deterministic."""
    pairs = [(into, tree)]
    while pairs:
        a, b = pairs.pop()
        a.count += b.count
        a.ends += b.ends
        for symbol, (child, taken) in b.to.items():
            if symbol in a.to:
                a.to[symbol][1] += taken
                pairs.append((a.to[symbol][0], child))
            else:
                a.to[symbol] = [child, taken]


def infer(values: list[str], confidence: float = CONFIDENCE) -> list[State]:
    """States of the automaton of ``values``, the first of them initial.

    Red states are settled; blue states are their other successors and still trees. The blue state
    seen most often is merged into the first compatible red one or settled itself.
    """
    red = [prefix_tree(sorted(values))]
    while True:
        settled = {id(s) for s in red}
        blue = [(-step[0].count, at, symbol) for at, s in enumerate(red)
                for symbol, step in s.to.items() if id(step[0]) not in settled]
        if not blue:
            return red
        _, at, symbol = min(blue)
        tree = red[at].to[symbol][0]
        same = next((s for s in red if compatible(s, tree, confidence)), None)
        if same is None:
            red.append(tree)
        else:
            red[at].to[symbol][0] = same
            fold(same, tree)


class Automaton:
    """Log probabilities of an inferred automaton. A symbol that a state has never seen has its
    smoothed chance and leaves the state as it is. In every state a share ``mixed`` of the chance is
    spread evenly over all symbols and the end."""

    def __init__(self, states: list[State], mixed: float = 0.0):
        number = {id(s): i for i, s in enumerate(states)}
        self.steps, self.misses, self.ends = [], [], []
        for s in states:
            def log_chance(times, total=s.count + SMOOTHING):
                chance = (times + SMOOTHING / (SYMBOLS + 1)) / total
                return math.log((1 - mixed) * chance + mixed / (SYMBOLS + 1))

            self.steps.append({symbol: (number[id(to)], log_chance(taken)) for symbol, (to, taken) in s.to.items()})
            self.misses.append(log_chance(0))
            self.ends.append(log_chance(s.ends))

    def log_likelihood(self, value: str) -> float:
        state, total = 0, 0.0
        for symbol in value:
            step = self.steps[state].get(symbol)
            if step:
                state = step[0]
                total += step[1]
            else:
                total += self.misses[state]
        return total + self.ends[state]


def make_finder():
    """Function from a text to its base matches ((start, kind number, end, value), in this order) and
    the spans of its candidates that overlap none."""
    assign = re.compile(BASE_RULES[0][1], re.IGNORECASE | re.ASCII)
    in_runs = [(n, re.compile(rule[1]), rule[3]) for n, rule in enumerate(BASE_RULES) if n]
    chars = "[A-Za-z0-9+/_.=-]"
    run = re.compile(f"(?<!{chars}){chars}{{{CANDIDATE_CHARS},}}")
    group, least = BASE_RULES[0][2:]

    def find(text: str):
        base = [(m.start(), 0, m.end(), m[group]) for m in assign.finditer(text) if len(m[group]) >= least]
        runs = [m.span() for m in run.finditer(text)]
        for a, b in runs:  # a match of the other rules lies within one run
            for kind, pattern, length in in_runs:
                base += [(m.start(), kind, m.end(), m[0]) for m in pattern.finditer(text, a, b)
                         if m.end() - m.start() >= length]
        base.sort()
        free, at, reach = [], 0, 0
        for a, b in runs:
            while at < len(base) and base[at][0] < b:
                reach = max(reach, base[at][2])
                at += 1
            if reach <= a:
                free.append((a, b))
        return base, free

    return find


def decode(text: bytes | None) -> str:
    return (text or b"").decode("utf-8", "surrogateescape")


def labelled_values(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(kind, hash, value): the ``sample`` distinct values of each kind and of ordinary candidates with
    the smallest hash."""
    rows = docs.select(F.col(text_col).cast("binary").alias("_text"))

    def run(batches):
        find, kept = make_finder(), {}
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                text = decode(text)
                base, free = find(text)
                for kind, value in [(KINDS[k], v) for _, k, _, v in base] + [(ORDINARY, text[a:b]) for a, b in free]:
                    if len(value) <= SAMPLE_CHARS:
                        kept.setdefault(kind, {})[value] = xxhash.xxh3_64_intdigest(value.encode()) >> 1
            for kind, values in kept.items():
                if len(values) > 2 * sample:
                    kept[kind] = dict(sorted(values.items(), key=lambda v: (v[1], v[0]))[:sample])
        for kind, values in kept.items():
            best = sorted((h, v) for v, h in values.items())[:sample]
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(best)), pa.array([h for h, _ in best], pa.int64()),
                 pa.array([v for _, v in best], pa.string())], names=["kind", "hash", "value"])

    first = Window.partitionBy("kind").orderBy("hash", "value")
    return (rows.mapInArrow(run, "kind string, hash long, value string").distinct()
            .withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= sample).drop("_n"))


def learn(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> dict[str, Automaton]:
    """The automaton of every kind with ``LEAST_VALUES`` values, and the ordinary one."""
    values: dict[str, list[str]] = {}
    for row in labelled_values(docs, text_col, sample).collect():  # at most four times ``sample`` rows
        values.setdefault(row.kind, []).append(row.value)
    found = {kind: Automaton(infer(v)) for kind, v in sorted(values.items())
             if kind != ORDINARY and len(v) >= LEAST_VALUES}
    return found | {ORDINARY: Automaton(infer(values.get(ORDINARY, [])), ORDINARY_MIXED)}


def best_kind(value: str, formats: dict[str, Automaton]) -> tuple[str | None, float]:
    """(kind, log odds against an ordinary run) if they are high enough, else (None, odds)."""
    ordinary = formats[ORDINARY].log_likelihood(value)
    odds, kind = max(((f.log_likelihood(value) - ordinary, k) for k, f in formats.items() if k != ORDINARY),
                     key=lambda x: x[0], default=(-math.inf, None))
    return (kind if odds >= LEAST_ODDS + LEAST_ODDS_PER_SYMBOL * len(value) else None), odds


def find_secrets(docs: DataFrame, formats: dict[str, Automaton] | None = None,
                 keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """Columns ``keep`` (all but the text by default) and ``secrets`` of every row, by start and then kind as
    listed in ``BASE_RULES``. ``odds`` is null for base matches. ``formats`` are those of ``learn``,
    from the same documents if not given."""
    formats = learn(docs, text_col) if formats is None else formats
    added = StructType.fromDDL(SECRETS)
    keep = [c for c in (docs.columns if keep is None else keep)
            if c not in added.names and (keep is not None or c != text_col)]
    rows = docs.select(*keep, F.col(text_col).cast("binary").alias("_text"))
    schema = StructType([rows.schema[c] for c in keep] + added.fields)
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                    ("text", pa.string()), ("odds", pa.float64())]))

    def secrets(text: str, find) -> list[dict]:
        base, free = find(text)
        found = [(a, k, b, None) for a, k, b, _ in base]
        for a, b in free:
            kind, odds = best_kind(text[a:b], formats)
            if kind:
                found.append((a, KINDS.index(kind), b, odds))
        return [{"kind": KINDS[k], "start": a, "end": b, "text": text[a:b], "odds": odds}
                for a, k, b, odds in sorted(found, key=lambda s: s[:3])]

    def run(batches):
        find = make_finder()
        for batch in slices(batches):
            made = [secrets(decode(t), find) for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(made, kind_type)],
                                             names=schema.names)

    return rows.mapInArrow(run, schema)


def span_text(secrets: Column) -> Column:
    """``kind:start:end`` of every secret, joined by commas."""
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
