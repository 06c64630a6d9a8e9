"""Word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie with two roots, one for the pieces that begin a word
and one for those that go on in it. Every node has a failure link and the
number of pieces that greedy longest match gives up when it follows the link.
A word is then counted in one pass over its characters; no piece is built.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.encoding import pieces

WORD = re.compile(r"\w+|[^\w\s]")
#: Distinct words whose counts are kept per Python worker.
CACHE_WORDS = 500_000
CACHE_WORD_CHARS = 64
_SHIFT = 21  # code points have 21 bits


@dataclass
class Automaton:
    """``goto[node << 21 | code point]``; node 0 begins a word, node 1 goes on in it; ``fail`` is -1 where no match goes on."""

    goto: dict[int, int]
    fail: list[int]
    popped: list[int]

    def count(self, word: str) -> int | None:
        """Pieces of the greedy longest match; None if it fails somewhere."""
        goto, fail, popped, node, total = self.goto, self.fail, self.popped, 0, 0
        for c in word:
            code = ord(c)
            while (to := goto.get(node << _SHIFT | code)) is None:
                if fail[node] < 0:
                    return None
                total += popped[node]
                node = fail[node]
            node = to
        while node > 1:
            if fail[node] < 0:
                return None
            total += popped[node]
            node = fail[node]
        return total


def build(begin: list[str], follow: list[str]) -> Automaton:
    """``begin`` holds the pieces at the start of a word, ``follow`` those inside one."""
    goto: dict[int, int] = {}
    children: list[list[tuple[int, int]]] = [[], []]
    piece = [False, False]
    for root, pieces in ((0, begin), (1, follow)):
        for text in pieces:
            node = root
            for c in text:
                key = node << _SHIFT | ord(c)
                if key not in goto:
                    goto[key] = len(children)
                    children[node].append((ord(c), len(children)))
                    children.append([])
                    piece.append(False)
                node = goto[key]
            if text:
                piece[node] = True
    fail, popped = [-1] * len(children), [0] * len(children)
    queue = deque([0, 1])
    while queue:
        parent = queue.popleft()
        for code, node in children[parent]:
            if piece[node]:
                fail[node], popped[node] = 1, 1
            else:
                at, total = fail[parent], popped[parent]
                while at >= 0 and at << _SHIFT | code not in goto:
                    total += popped[at]
                    at = fail[at]
                if at >= 0:
                    fail[node], popped[node] = goto[at << _SHIFT | code], total
            queue.append(node)
    return Automaton(goto, fail, popped)


def sentencepiece_vocabulary(model_path: str) -> tuple[list[str], list[str]]:
    """(begin, follow) pieces of a SentencePiece file: U+2581 marks a word's start."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    begin, follow = [], []
    for n in range(model.get_piece_size()):
        if model.is_control(n) or model.is_byte(n) or model.is_unknown(n) or model.is_unused(n):
            continue
        text = model.id_to_piece(n)
        if text.startswith("▁"):
            begin.append(text[1:])
        else:
            follow.append(text)
    return [t for t in begin if t], follow


def wordpiece_vocabulary(lines: list[str], mark: str = "##") -> tuple[list[str], list[str]]:
    """(begin, follow) pieces of a word-piece list whose inner pieces carry ``mark``."""
    return [t for t in lines if t and not t.startswith(mark)], [t[len(mark) :] for t in lines if t.startswith(mark) and t != mark]


class _Counts(dict):
    """(pieces, unknown words) of a word as pieces << 1 | unknown."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self._count = automaton.count

    def __missing__(self, word: str) -> int:
        found = self._count(word)
        packed = 3 if found is None else found << 1
        if len(word) <= CACHE_WORD_CHARS:
            self[word] = packed
        return packed


def token_counts(docs: DataFrame, automaton: Automaton) -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` per row, from whole texts.

    Words are runs of letters, digits and underscores, and single other
    characters that are not white space. A word the vocabulary cannot cover
    counts as one unknown token. Null, empty and blank texts count 0. Rows that
    repeat are counted each on its own, an empty table gives no rows, other
    columns are not read. There is no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(automaton))  # bounded by the vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(cloudpickle.loads(shared.value))
        names = ["doc_id", "n_words", "n_tokens", "n_unknown"]
        for batch in batches:
            rows = []
            for text in batch.column(1):
                if len(counts) > CACHE_WORDS:
                    counts.clear()
                words = total = unknown = 0
                for piece in pieces(text.as_py() or ""):
                    packed = list(map(counts.__getitem__, WORD.findall(piece)))
                    words, total, unknown = words + len(packed), total + sum(packed), unknown + sum(p & 1 for p in packed)
                rows.append((words, (total - unknown) >> 1, unknown))
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], names=names)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(count, "doc_id long, n_words long, n_tokens long, n_unknown long")
