"""Operator 5, token counts: count-only Viterbi over a unigram vocabulary, without making the tokens.

Aho-Corasick lists the vocabulary pieces that end at each character; dynamic
programming carries the best score and the piece count of each prefix. Ties go
as in the public Unigram model: of equal scores the longest last piece wins, a
character without a piece of its own is unknown at the lowest score less 10,
and unknown characters become one byte piece for each UTF-8 byte where the
vocabulary has those, else a run of them counts as one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from skyroll.llm.common import ship, table
from skyroll.llm.quality import slices

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Segments whose counts a task remembers; it forgets all when full. Results don't depend on it.
REMEMBERED = 400_000


class Vocabulary(NamedTuple):
    """Pieces with scores, and whether all byte pieces are among them."""

    pieces: tuple[tuple[str, float], ...]
    byte_pieces: bool


def load_vocabulary(path: str) -> Vocabulary:
    """The pieces and scores of a sentencepiece model file, read as a unigram vocabulary."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = tuple((model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size()))
    names = {p for p, _ in pieces}
    return Vocabulary(pieces, all(f"<0x{b:02X}>" in names for b in range(256)))


class Counter(dict):
    """Piece count of each segment, filled as segments come."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary.pieces) - UNKNOWN_PENALTY
        self.byte_pieces = vocabulary.byte_pieces
        #: a space begins pieces but is within none, so no piece crosses the place before a run of spaces
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p, _ in vocabulary.pieces) and any(p == SPACE for p, _ in vocabulary.pieces)

    def count(self, text: str) -> int:
        """Pieces on the best path over ``text``, in which spaces already are SPACE."""
        n = len(text)
        best: list[float] = [0.0] + [0.0] * n
        number = [0] * (n + 1)
        in_unknown = [False] * (n + 1)
        found: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for end, match in self.automaton.iter(text):
            found[end + 1].append(match)
        for end in range(1, n + 1):
            matches = found[end]
            top, start = None, -1
            single = False
            for length, score in sorted(matches, reverse=True):  # the longest first: only a better score replaces it
                single |= length == 1
                total = best[end - length] + score
                if top is None or total > top:
                    top, start = total, end - length
            if not single:
                total = best[end - 1] + self.unknown
                if top is None or total > top:
                    top = total
                    in_unknown[end] = True
            best[end] = top
            if not in_unknown[end]:
                number[end] = number[start] + 1
            elif self.byte_pieces:
                number[end] = number[end - 1] + len(text[end - 1].encode())
            else:
                number[end] = number[end - 1] + (not in_unknown[end - 1])
        return number[n]

    def __missing__(self, word: str) -> int:
        self[word] = out = self.count(SPACE + word)
        return out

    def of(self, text: str) -> int:
        """Pieces of a whole text, a space before it. A text without characters has none."""
        if not text:
            return 0
        if not self.cuts:
            return self.count(SPACE + text.replace(" ", SPACE))
        if len(self) > REMEMBERED:
            self.clear()
        if SPACE in text:
            text = text.replace(SPACE, " ")
        if "  " not in text and text[0] != " ":
            return sum(map(self.__getitem__, text.split(" ")))
        total, spaces = 0, 0
        words = (" " + text).split(" ")[1:]
        for i, word in enumerate(words):
            if not word and i + 1 < len(words):
                spaces += 1  # a run of spaces belongs to the word after it
            else:
                total += self[SPACE * spaces + word]
                spaces = 0
        return total


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The worker's counter for a vocabulary file, kept from task to task."""
    if path not in _counters:
        _counters[path] = Counter(load_vocabulary(path))
    return _counters[path]


def count_tokens(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key``, n_chars and n_tokens of the whole text.

    ``path`` names a vocabulary file that every executor has. Null and empty
    texts have no tokens; repeated rows are counted alike; other columns, also
    ones named as the result's, are ignored; an empty table gives no rows.
    """
    ship(df.sparkSession)
    rows = df.select(df[key].alias("_key"), df[text].cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            for cut in slices(batch):
                texts = [x or "" for x in cut.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [cut.column(0), pa.array(map(len, texts), pa.int64()), pa.array(map(count.of, texts), pa.int64())],
                    names=["_key", "n_chars", "n_tokens"],
                )

    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(run, f"_key {kind}, n_chars long, n_tokens long").withColumnRenamed("_key", key)


def op5_token_counts(spark: SparkSession, sf_dir: str, name: str = "piece_bpe_32k.model") -> DataFrame:
    """Token counts of all documents under a public vocabulary."""
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(name))
