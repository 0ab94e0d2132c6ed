"""Token counts of a unigram tokenizer: count-only Viterbi over Aho-Corasick matches.

An automaton lists the vocabulary pieces that end at each character; dynamic programming carries the
best score and the number of pieces so far, and keeps no paths.  Rules are those of the public unigram
tokenizer: white space becomes the mark that begins a word; of two splits of equal score the one
whose last piece is longer stays; a character that no piece of one character covers costs the least
score less ten; neighbouring unknown characters count as one piece.

No piece reaches over white space, so words are counted apart and remembered, within a bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cloakframe.llm.words import texts_of

MARK = "▁"
#: What an unknown character costs beyond the least score of the vocabulary.
UNKNOWN = 10.0
#: Words that a worker remembers; beyond that it forgets all and begins anew.
CACHE_WORDS = 1_000_000

_OF_PATH: dict[str, "PieceCounter"] = {}


def vocabulary(path: str) -> list[tuple[str, float]]:
    """The pieces of a sentencepiece model with its scores; control, unknown and byte pieces left out.

    A merge table's scores are ranks below nought, so the sum prefers few and early pieces.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = (k for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k)))
    return [(model.id_to_piece(k), model.get_score(k)) for k in plain]


class PieceCounter(dict):
    """Words in UTF-8 and their numbers of pieces."""

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN

    @classmethod
    def at(cls, path: str) -> "PieceCounter":
        if path not in _OF_PATH:
            _OF_PATH[path] = cls(vocabulary(path))
        return _OF_PATH[path]

    def __missing__(self, word: bytes) -> int:
        self[word] = n = self.count(MARK + word.decode())
        return n

    def count(self, text: str) -> int:
        """Pieces of the best split; the state of an end is its score, its pieces, and whether the last is unknown."""
        ends: dict[int, list[tuple[int, float]]] = {}
        for end, match in self.automaton.iter(text):
            ends.setdefault(end, []).append(match)
        best: list[tuple[float, int, bool]] = [(0.0, 0, False)]
        for end in range(len(text)):
            chosen, single = None, False
            for length, score in sorted(ends.get(end, ()), reverse=True):  # longest first: it stays on a tie
                before = best[end + 1 - length]
                single |= length == 1
                if chosen is None or before[0] + score > chosen[0]:
                    chosen = (before[0] + score, before[1] + 1, False)
            if not single:
                before = best[end]
                if chosen is None or before[0] + self.unknown > chosen[0]:
                    chosen = (before[0] + self.unknown, before[1] + (not before[2]), True)
            best.append(chosen)
        return best[-1][1]

    def total(self, text: bytes) -> int:
        return sum(map(self.__getitem__, text.split()))


def count_pieces(docs: DataFrame, model: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of pieces of each text added as ``name``.

    ``model`` is the path of a sentencepiece model on every machine.  White space is ASCII white
    space.  Null and empty texts have none.  Rows are independent; a column of that name is replaced.
    """
    docs = docs.drop(name)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter.at(model)
        for batch in batches:
            counts = []
            for x in texts_of(batch.column(columns.index(text)).cast(pa.string())):
                if len(counter) > CACHE_WORDS:
                    counter.clear()
                counts.append(counter.total(x))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], names=[*columns, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))
