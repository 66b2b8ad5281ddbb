"""Count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece that ends at each
character; dynamic programming carries, per character, the best score of
the text so far and how many pieces that takes.  No piece list is built.

The segmentation is that of the tokenizers library's Unigram model over
the same pieces and scores, with its rules: of equal scores the piece
that begins first stays; a character that is no piece by itself may be
taken as unknown, at the lowest score less 10; an unknown character
counts as its UTF-8 bytes where the vocabulary has all byte pieces, else
a run of them counts as one.  A text is prefixed with the space mark, and
spaces become marks.

Scores are summed as Python floats in text order within a unit; pieces
have the mark only at their beginning, so a text is cut before each mark
that follows another character, and at characters that no piece holds.
With whole-number scores (as in the public file) sums are exact, so units
count the same alone as in the text; otherwise texts aren't cut.

Defined results: a null text is the empty text, of 0 tokens; repeated
rows each give a row; other columns of the input are not looked at.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripflow.llm.common import col, ship_package, text_of
from tripflow.llm.encoders import encoder

MARK = "▁"
UNKNOWN_PENALTY = 10.0

#: Units whose counts a worker keeps, and their longest.
MEMO_UNITS = 300_000
MEMO_UNIT_CHARS = 64


def pieces_of_model(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece file: its pieces, the unknown piece
    and byte pieces; the latter two scored below all others, so that their
    names in a text don't win over its characters."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain, named = [], []
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unused(i):
            continue
        (named if sp.is_byte(i) or sp.is_unknown(i) else plain).append((sp.id_to_piece(i), sp.get_score(i)))
    lowest = min(s for _, s in plain)
    return [(p, lowest - 1000.0) for p, _ in named] + plain


class UnigramCounter:
    """Token counts of texts; pieces as (piece, score)."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.scores = dict(pieces)
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(self.scores.values()) - UNKNOWN_PENALTY
        self.bytes = all(f"<0x{b:02X}>" in self.scores for b in range(256))
        whole = all(float(s).is_integer() and abs(s) < 2**31 for s in self.scores.values())
        self.cuts = whole and MARK in self.scores and not any(MARK in p.lstrip(MARK) for p in self.scores)
        if self.bytes and not any("\n" in p for p in self.scores):
            self.units = re.compile(f"[ {MARK}]*[^ {MARK}\n]+|[ {MARK}]+|\n")
        else:
            self.units = re.compile(f"[ {MARK}]*[^ {MARK}]+|[ {MARK}]+")
        self.memo: dict[str, int] = {}

    @classmethod
    def of_model(cls, path: str) -> UnigramCounter:
        return cls(pieces_of_model(path))

    def viterbi(self, text: str) -> int:
        """Pieces on the best path over ``text`` as it stands."""
        n = len(text)
        best, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        done = 0  # characters whose best path is settled
        found: list[tuple[int, float]] = []
        for last, piece in self.automaton.iter(text):
            while done <= last:
                if done == last:
                    found.append(piece)
                    break
                self._settle(text, done, found, best, count, unknown)
                found = []
                done += 1
        while done < n:
            self._settle(text, done, found, best, count, unknown)
            found = []
            done += 1
        return count[n]

    def _settle(self, text, at, found, best, count, unknown) -> None:
        end, top, begin, single = at + 1, None, 0, False
        for length, score in found:
            start = end - length
            value = best[start] + score
            if top is None or value > top or (value == top and start < begin):
                top, begin = value, start
            single = single or length == 1
        if not single and (top is None or best[at] + self.unknown > top):
            best[end] = best[at] + self.unknown
            if self.bytes:
                count[end] = count[at] + len(text[at].encode())
            else:
                count[end] = count[at] + (not unknown[at])
            unknown[end] = True
        else:
            best[end], count[end] = top, count[begin] + 1

    def count(self, texts: list[str]) -> list[int]:
        if not self.cuts:
            return [self.viterbi(MARK + t.replace(" ", MARK)) if t else 0 for t in texts]
        split = [self.units.findall(MARK + t) if t else [] for t in texts]
        seen: set[str] = set()
        for units in split:
            seen.update(units)
        if len(self.memo) + len(seen) > MEMO_UNITS:
            self.memo.clear()
        known = self.memo
        new = [u for u in seen if u not in known]
        for u in new:
            known[u] = self.viterbi(u.replace(" ", MARK))
        out = [sum(map(known.__getitem__, units)) for units in split]
        for u in new:
            if len(u) > MEMO_UNIT_CHARS:
                del known[u]
        return out


def token_counts(df: DataFrame, id_col: str, text_col: str, model_path: str) -> DataFrame:
    """One row per input row: the id column and n_tokens, the length of the
    whole text under the unigram vocabulary of the sentencepiece file."""
    ship_package(df.sparkSession)
    rows = df.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    out = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("n_tokens", T.LongType())])

    def count(batches):
        counter = encoder(UnigramCounter.of_model, model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                counts = counter.count(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64())], out.fieldNames())

    return rows.mapInArrow(count, out).withColumnRenamed("id", id_col)
