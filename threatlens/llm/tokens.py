"""Token counts by a longest-match automaton that never builds a piece.

A word is a run between white space with one space put before it. It is cut
greedily into the longest pieces of a byte vocabulary. The vocabulary's trie gets
a failure link per node, and beside it how many pieces are finished by following
it, so each byte is read once and only counts are kept.

Null and empty texts have 0 words and 0 tokens; repeated rows are counted alike;
other columns do not matter.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from threatlens.llm.text import SPACED, chunks, ship, ship_code, unpack, word_hashes, words

# Longer words are read byte by byte on their own.
LONG = 256


def read_vocabulary(path: str) -> list[bytes]:
    """Pieces of a file with one base64 piece and its rank per line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class Automaton:
    """Trie of the pieces as sorted edges; ``fail``, ``popped`` and ``ending`` by node.

    ``popped`` counts the pieces finished when a node fails, ``ending`` those
    finished when a word ends there.
    """

    def __init__(self, pieces: Iterable[bytes]):
        pieces = sorted({p for p in pieces if p})
        if len({p for p in pieces if len(p) == 1}) < 256:
            raise ValueError("the vocabulary must hold all 256 single bytes, else some words have no pieces")
        children: list[dict[int, int]] = [{}]
        whole = [False]
        parents: list[tuple[int, int]] = [(0, 0)]
        for piece in pieces:
            node = 0
            for byte in piece:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    parents.append((node, byte))
                    children.append({})
                    whole.append(False)
                node = children[node][byte]
            whole[node] = True
        fail, popped = [-1] * len(children), [0] * len(children)
        level = list(children[0].values())
        while level:
            for node in level:
                parent, byte = parents[node]
                if whole[node]:
                    fail[node], popped[node] = 0, 1
                    continue
                count, at = popped[parent], fail[parent]
                while byte not in children[at]:
                    count, at = count + popped[at], fail[at]
                fail[node], popped[node] = children[at][byte], count
            level = [c for node in level for c in children[node].values()]
        ending = [0] * len(children)
        for node in range(1, len(children)):
            at = node
            while at:
                ending[node], at = ending[node] + popped[at], fail[at]
        edges = sorted((node * 256 + byte, to) for node, row in enumerate(children) for byte, to in row.items())
        self.keys = np.array([k for k, _ in edges], dtype=np.int64)
        self.to = np.array([t for _, t in edges], dtype=np.int64)
        self.root = np.zeros(256, dtype=np.int64)
        self.root[list(children[0])] = list(children[0].values())
        self.fail, self.popped, self.ending = (np.array(x, dtype=np.int64) for x in (fail, popped, ending))

    def step(self, nodes: np.ndarray, read: np.ndarray, counts: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Nodes after one more byte for the words ``which``; adds what is finished to ``counts``."""
        nodes, todo = nodes.copy(), np.arange(len(nodes))
        while len(todo):
            at, byte = nodes[todo], read[todo]
            from_root = at == 0
            wanted = at * 256 + byte
            place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            found = from_root | (self.keys[place] == wanted)
            nodes[todo[found]] = np.where(from_root, self.root[byte], self.to[place])[found]
            todo = todo[~found]
            counts[which[todo]] += self.popped[nodes[todo]]
            nodes[todo] = self.fail[nodes[todo]]
        return nodes

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word ``data[start:end]``."""
        counts = np.zeros(len(starts), dtype=np.int64)
        lengths = ends - starts
        order = np.argsort(-lengths, kind="stable")
        order = order[np.searchsorted(-lengths[order], -LONG):]
        nodes = np.full(len(order), self.root[32], dtype=np.int64)
        for t in range(int(lengths[order[0]]) if len(order) else 0):
            live = int(np.searchsorted(-lengths[order], -t))  # the longest come first
            order, nodes, done, last = order[:live], nodes[:live], order[live:], nodes[live:]
            counts[done] += self.ending[last]
            nodes = self.step(nodes, data[starts[order] + t].astype(np.int64), counts, order)
        counts[order] += self.ending[nodes]
        for i in np.flatnonzero(lengths > LONG).tolist():
            counts[i] = self.count_long(data[starts[i]:ends[i]].tobytes())
        return counts

    def count_long(self, word: bytes) -> int:
        keys, to, fail, popped, root = self.edges(), self.to, self.fail_list, self.popped_list, self.root_list
        node, count = root[32], 0
        for byte in word:
            while True:
                place = keys.get(node * 256 + byte)
                if place is not None:
                    node = place
                    break
                count, node = count + popped[node], fail[node]
        return count + int(self.ending[node])

    def edges(self) -> dict[int, int]:
        if "_edges" not in self.__dict__:
            self._edges = dict(zip(self.keys.tolist(), self.to.tolist()))
            self.fail_list, self.popped_list, self.root_list = self.fail.tolist(), self.popped.tolist(), self.root.tolist()
        return self._edges


def count_tokens(docs: DataFrame, pieces: list[bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_bytes, n_words, n_tokens`` for every row.

    The automaton is sent to the executors once; its size follows the vocabulary only.
    """
    ship_code(docs.sparkSession, __name__)
    automaton = ship(docs.sparkSession, Automaton(pieces))

    def count(batches):
        machine = unpack(automaton)
        for rows, data, at in chunks(batches, text):
            starts, ends, first = words(data, at, SPACED)
            # Each different word is walked once a chunk.
            _, one, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
            tokens = np.concatenate([[0], np.cumsum(machine.count(data, starts[one], ends[one])[which])]) if len(one) else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays(
                [rows.column(key), pa.array(np.diff(at)), pa.array(np.diff(first).astype(np.int64)), pa.array((tokens[first[1:]] - tokens[first[:-1]]).astype(np.int64))],
                names=[key, "n_bytes", "n_words", "n_tokens"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(count, f"{key} {kind}, n_bytes long, n_words long, n_tokens long")
