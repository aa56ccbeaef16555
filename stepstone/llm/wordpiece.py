"""Word-piece lengths by a linear longest-match automaton over an existing byte-level vocabulary.

The trie of all pieces has failure links: where no piece goes on, the link names the state that the rest of the text is
in once the longest piece is cut off, and a precomputed count says how many pieces were popped on the way.  Counting
pieces needs no backtracking and never builds one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepstone.llm.registry import documents, query
from stepstone.llm.texts import flat_utf8, slices, word_spans
from stepstone.llm.vocabulary import Trie, byte_pieces

#: A step through the automaton is taken for this many words at once.
LANES = 1 << 18


class Automaton(Trie):
    """Trie with failure links: ``link`` is the state after cutting the longest piece, ``popped`` how many were cut."""

    def __init__(self, pieces: list[bytes]):
        super().__init__(pieces)
        children = self.children
        link, popped = [-1] * len(children), [0] * len(children)
        level = [0]
        while level:
            deeper = []
            for parent in level:
                for b, node in children[parent].items():
                    if self.piece[node] >= 0:
                        link[node], popped[node] = 0, 1
                    else:
                        at, count = link[parent], popped[parent]
                        while at >= 0 and b not in children[at]:
                            at, count = link[at], count + popped[at]
                        link[node], popped[node] = (children[at][b], count) if at >= 0 else (-1, 0)
                    deeper.append(node)
            level = deeper
        self.link, self.popped = np.array(link, np.int32), np.array(popped, np.int32)

    def lengths(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: int | None) -> np.ndarray:
        """Pieces of each word data[start:end], read after the byte ``lead``; 1 for a word that has no pieces."""
        counts = np.zeros(len(starts), np.int64)
        for at in range(0, len(starts), LANES):
            counts[at : at + LANES] = self._some(data, starts[at : at + LANES], ends[at : at + LANES], lead)
        return counts

    def _some(self, data, starts, ends, lead) -> np.ndarray:
        order = np.argsort(starts - ends, kind="stable")  # long words first, so those still open are a prefix
        starts, sizes = starts[order], (ends - starts)[order]
        node, count = np.zeros(len(order), np.int32), np.zeros(len(order), np.int64)
        lost = np.zeros(len(order), bool)

        def settle(which: np.ndarray, goal: np.ndarray, bytes_: np.ndarray | None) -> None:
            """Follow links of the nodes without a way on; at the end of a word until all is popped."""
            while len(which):
                count[which] += self.popped[node[which]]
                node[which] = self.link[node[which]]
                dead = node[which] < 0
                lost[which[dead]], node[which[dead]] = True, 0
                which, bytes_ = which[~dead], None if bytes_ is None else bytes_[~dead]
                if bytes_ is None:
                    which = which[node[which] != 0]
                else:
                    goal = self.go(node[which], bytes_)
                    node[which[goal >= 0]] = goal[goal >= 0]
                    which, bytes_ = which[goal < 0], bytes_[goal < 0]

        def step(open_: int, bytes_: np.ndarray) -> None:
            goal = self.go(node[:open_], bytes_)
            stuck = np.flatnonzero((goal < 0) & ~lost[:open_])
            moved = goal >= 0
            node[:open_][moved] = goal[moved]
            root = stuck[node[stuck] == 0]
            lost[root] = True
            stuck = stuck[node[stuck] != 0]
            settle(stuck, None, bytes_[stuck])

        if lead is not None:
            step(len(order), np.full(len(order), lead, np.int64))
        for k in range(int(sizes[0]) if len(sizes) else 0):
            open_ = int(np.searchsorted(-sizes, -k, "left"))
            step(open_, data[starts[:open_] + k].astype(np.int64))
        settle(np.flatnonzero((node != 0) & ~lost), None, None)
        count[lost] = 1
        out = np.empty(len(order), np.int64)
        out[order] = count
        return out


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    """Built once in each Python worker."""
    return Automaton(list(byte_pieces(path)))


def count_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_words, n_pieces) of every row.

    Words are runs between ASCII white space, each read after one blank; pieces are the greedy longest matches over the
    vocabulary at ``path``.  A null or empty text has no words.  A word that the vocabulary cannot spell counts as one piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        for batch in slices(batches, "_text"):
            data, offsets = flat_utf8(batch.column(1))
            starts, ends, owner = word_spans(data, offsets)
            pieces = machine.lengths(data, starts, ends, 0x20)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(np.diff(offsets)), pa.array(np.bincount(owner, minlength=n).astype(np.int64)),
                pa.array(np.bincount(owner, pieces, minlength=n).astype(np.int64)),
            ], names=[id_col, "n_bytes", "n_words", "n_pieces"])

    picked = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return picked.mapInArrow(run, f"`{id_col}` {picked.dtypes[0][1]}, n_bytes bigint, n_words bigint, n_pieces bigint")


@query("op6_piece_counts")
def piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_pieces(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
