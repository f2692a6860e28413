"""Token counts of a unigram vocabulary without building tokens.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character; dynamic
programming carries only the best score and its piece count. Tie rule of the exact tokenizer: of
equal scores the piece that starts first wins; a character that is no piece of its own may be
taken as unknown, ``UNKNOWN_PENALTY`` below the lowest score. With byte pieces in the vocabulary
an unknown character counts its UTF-8 bytes, otherwise a run of unknown ones counts one.

If no piece has a space mark after another character and all scores are whole numbers, the words
of a text are independent and their sums exact: each distinct word is then counted once per task
(bounded memo).

Defined results: null and empty texts have no tokens; repeated rows each get a row; a null
``doc_id`` stays null; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import MEMO_ENTRIES, as_bytes, slices

SPACE = "▁"  # fixed value: the mark of a space in piece files
UNKNOWN_PENALTY = 10.0
UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


@dataclass
class Vocabulary:
    pieces: list[tuple[str, float]]
    byte_fallback: bool

    @classmethod
    def from_piece_file(cls, path: str) -> Vocabulary:
        """Ordinary pieces and scores of a SentencePiece file."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        pieces = [(model.id_to_piece(i), model.get_score(i)) for i in ids
                  if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        return cls(pieces, sum(model.is_byte(i) for i in ids) == 256)


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        scores = [s for _, s in vocabulary.pieces]
        self.unknown = min(scores, default=0.0) - UNKNOWN_PENALTY
        self.bytes = vocabulary.byte_fallback
        self.by_word = (all(float(s).is_integer() for s in scores) and self.bytes
                        and not any(re.search(f"[^{SPACE}]{SPACE}", p)
                                    for p, _ in vocabulary.pieces))
        self.memo: dict[str, tuple[int, float]] = {}

    def best(self, unit: str) -> tuple[int, float]:
        """(pieces, score) of the best segmentation of ``unit``."""
        n = len(unit)
        ending: list[list] = [[] for _ in range(n + 1)]
        if len(self.automaton):
            for last, match in self.automaton.iter(unit):  # at each end the longest comes first
                ending[last + 1].append(match)
        score, count, is_unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            top, pieces, unknown = None, 0, False
            size = 0
            for size, value in ending[end]:
                candidate = score[end - size] + value
                if top is None or candidate > top:
                    top, pieces, unknown = candidate, count[end - size] + 1, False
            if size != 1:
                candidate = score[end - 1] + self.unknown
                if top is None or candidate > top:
                    more = (len(unit[end - 1].encode("utf-8", "replace")) if self.bytes
                            else int(not is_unknown[end - 1]))
                    top, pieces, unknown = candidate, count[end - 1] + more, True
            score[end], count[end], is_unknown[end] = top, pieces, unknown
        return count[n], score[n]

    def count(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        marked = SPACE + text.replace(" ", SPACE)
        if not self.by_word:
            return self.best(marked)
        tokens, total, memo = 0, 0.0, self.memo
        for unit in UNIT.findall(marked):
            known = memo.get(unit)
            if known is None:
                known = self.best(unit)
                if len(unit) < 64:
                    memo[unit] = known
            tokens += known[0]
            total += known[1]
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        return tokens, total


def token_counts(docs: DataFrame, vocabulary: Callable[[], Vocabulary], id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, score) of every row; ``vocabulary`` is read inside a task."""
    def run(batches):
        counter = Counter(vocabulary())
        for batch in slices(batches):
            found = [counter.count((t or b"").decode("utf-8", "replace"))
                     for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c for c, _ in found], pa.int64()),
                 pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "n_tokens", "score"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col))
            .mapInArrow(run, "doc_id long, n_tokens long, score double"))
