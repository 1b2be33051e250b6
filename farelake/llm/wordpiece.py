"""Word-piece counts by a linear longest-match automaton.

Greedy longest-match-first word pieces: a word is cut from the left, each time by
the longest piece of the vocabulary; a word that cannot be cut up is one unknown
piece. Only the number of pieces is wanted, so none is built.

The automaton is a trie over the vocabulary with failure links. Where no longer
match exists, the link leads to the state of what remains after the longest pieces
were cut off the left, and a count precomputed for the state tells how many pieces
those were. Every character moves one state on or follows links that were paid for
before, so a word takes linear time.

Vocabulary: pieces that begin a word carry a marker, pieces that go on carry none
(``load_pieces`` reads them from a sentencepiece model; its path is a parameter).
The word is matched as marker + word. Where the vocabulary holds the marker alone,
``alone`` makes it a piece of its own: a word that begins with no other piece then
costs one piece for the marker and is cut up behind it.

Words are runs outside 0x20 and 0x09..0x0D, compared by 64-bit hash; a distinct
word of a slice of texts is run through the automaton once.

Defined cases: null and empty texts have no words and no pieces; every row is
counted on its own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.tables import table
from farelake.llm.textscan import Scan, scans

MARKER = "▁"
KEPT_WORDS = 200_000  # counts kept per task; beyond that the store starts anew


def load_pieces(path: str) -> list[str]:
    """Pieces of a sentencepiece model, without control and byte pieces."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class Automaton:
    """Trie with failure links and popped-piece counts.

    State 1 is the root, the place after a piece; state 0, its child by the marker,
    is the start of a word. ``link[s]`` is -1 where a word that stops matching at s
    has no cut; ``popped[s]`` is the number of pieces that the link cuts off.
    alone: the marker alone counts as a piece where the vocabulary holds it.
    """

    def __init__(self, pieces: Iterable[str], marker: str = MARKER, alone: bool = False):
        self.next: list[dict[str, int]] = [{}, {marker: 0}]
        accepts = {}
        for piece in pieces:
            if not piece or piece == marker and not alone:
                continue
            state = 1
            for c in piece:
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.next.append({})
                state = self.next[state][c]
            accepts[state] = True
        n = len(self.next)
        self.link, self.popped = [-1] * n, [0] * n
        work = deque([1])
        while work:
            parent = work.popleft()
            for c, state in self.next[parent].items():
                work.append(state)
                if state in accepts:
                    self.link[state], self.popped[state] = 1, 1
                    continue
                at, count = self.link[parent], self.popped[parent]
                while at >= 0 and c not in self.next[at]:
                    count += self.popped[at]
                    at = self.link[at]
                if at >= 0:
                    self.link[state], self.popped[state] = self.next[at][c], count

    def count(self, word: str) -> int:
        """Number of pieces, 0 for a word that cannot be cut up."""
        state, count = 0, 0
        for c in word:
            while c not in self.next[state]:
                if self.link[state] < 0:
                    return 0
                count += self.popped[state]
                state = self.link[state]
            state = self.next[state][c]
        while state != 1:
            if self.link[state] < 0:
                return 0
            count += self.popped[state]
            state = self.link[state]
        return count


class Counter:
    """Piece counts of the words of scans; keeps those of words it has met."""

    def __init__(self, automaton: Automaton):
        self.automaton, self.known = automaton, {}

    def __call__(self, scan: Scan) -> tuple[np.ndarray, np.ndarray]:
        """(pieces, unknown words) of every text."""
        keys, first, of = np.unique(scan.word_hashes(), return_index=True, return_inverse=True)
        raw = scan.data.tobytes()
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        counts = np.empty(len(keys), np.int64)
        for i, key in enumerate(keys.tolist()):
            got = self.known.get(key)
            if got is None:
                a, b = scan.starts[first[i]], scan.ends[first[i]]
                got = self.known[key] = self.automaton.count(raw[a:b].decode())
            counts[i] = got
        each = counts[of]
        total = np.zeros((2, len(each) + 1), np.int64)
        np.cumsum(np.maximum(each, 1), out=total[0, 1:])
        np.cumsum(each == 0, out=total[1, 1:])
        pieces, unknown = total[:, scan.ptr[1:]] - total[:, scan.ptr[:-1]]
        return pieces, unknown


def count_pieces(docs: DataFrame, pieces: list[str], key: str = "doc_id", text: str = "text",
                 alone: bool = False) -> DataFrame:
    """(key, n_words, n_pieces, n_unknown) of every row; alone as in Automaton."""
    rows = docs.select(F.col(key), F.col(text).alias("__text"))
    kind = rows.schema[0].dataType.simpleString()
    shipped = docs.sparkSession.sparkContext.broadcast(pieces)  # a vocabulary: its size does not follow the data

    def count(batches):
        counter = None
        for batch in batches:
            counter = counter or Counter(Automaton(shipped.value, alone=alone))
            for a, b, scan in scans(batch.column(1)):
                found, unknown = counter(scan)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(scan.ptr), pa.int64()), pa.array(found), pa.array(unknown)],
                    [key, "n_words", "n_pieces", "n_unknown"])

    return rows.mapInArrow(count, f"`{key}` {kind}, n_words long, n_pieces long, n_unknown long")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-piece counts of every document, over the public 32k pieces."""
    import public_tokenizers
    return count_pieces(table(spark, sf_dir, "documents", ("doc_id", "text")),
                        load_pieces(public_tokenizers.path("piece_bpe_32k.model")), alone=True)
