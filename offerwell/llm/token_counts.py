"""Greedy word-piece counts with a linear longest-match automaton.

The vocabulary is a trie. Every node has a failure link and the number of pieces that greedy longest matching pops when the link
is followed, both computed once; reading a word then takes one step per byte and at most as many failure steps, with no
piece built and nothing read twice (Song and others, "Fast WordPiece Tokenization", 2021).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from offerwell.llm import text as tx


class LongestMatch:
    """Counts the pieces of byte strings; -1 where a string has no split by greedy longest matching."""

    def __init__(self, pieces):
        self.goto: list[dict[int, int]] = [{}]
        whole = [False]
        for piece in pieces:
            node = 0
            for byte in piece:
                child = self.goto[node].get(byte)
                if child is None:
                    child = self.goto[node][byte] = len(self.goto)
                    self.goto.append({})
                    whole.append(False)
                node = child
            whole[node] = node > 0
        self.fail, self.popped = [-1] * len(self.goto), [0] * len(self.goto)
        level = [0]
        while level:
            below = []
            for parent in level:
                for byte, node in self.goto[parent].items():
                    if whole[node]:
                        self.fail[node], self.popped[node] = 0, 1
                    else:
                        link, count = self.fail[parent], self.popped[parent]
                        while link >= 0 and byte not in self.goto[link]:
                            count += self.popped[link]
                            link = self.fail[link]
                        if link >= 0:
                            self.fail[node], self.popped[node] = self.goto[link][byte], count
                    below.append(node)
            level = below

    def count(self, word: bytes) -> int:
        goto, fail, popped, node, total = self.goto, self.fail, self.popped, 0, 0
        for byte in word:
            child = goto[node].get(byte)
            while child is None:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    return -1
                child = goto[node].get(byte)
            node = child
        while node > 0:
            total += popped[node]
            node = fail[node]
        return -1 if node < 0 else total


class WordCounts:
    def __init__(self, tokenizer: dict):
        symbols = tx.byte_symbols()
        names = tokenizer["model"]["vocab"]
        self.automaton = LongestMatch(bytes(symbols[c] for c in n) for n in names if n and all(c in symbols for c in n))
        self.words = tx.Cache(lambda found: [self.automaton.count(b" " + w) for w in found])


def count_pieces(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_pieces and n_unknown of the whole text.

    ``tokenizer`` is the path of a byte-level tokenizer file whose vocabulary gives the pieces. Words are the longest runs without
    ASCII white space; each is read as it stands after one space, and split by taking the longest piece from the left. A
    word that has no such split counts as one unknown piece. A null or empty text has zeros. Rows are independent, so repeated rows
    give equal results and an empty table an empty one; extra columns pass through unless they bear a result's name.
    """
    shared = tx.Shared(docs.sparkSession, tx.read_tokenizer(tokenizer))

    def run(text):
        values, bounds = tx.words(tx.text_array(text))
        codes, distinct = tx.coded(values)
        found = np.array(tx.made(shared, WordCounts).words.many(distinct), np.int64)[codes] if distinct else np.empty(0, np.int64)
        totals = [np.concatenate([[0], np.cumsum(x)])[bounds] for x in (np.abs(found), found < 0)]
        return [pa.array(np.diff(b).astype(np.int64)) for b in (bounds, *totals)]

    return tx.attach(docs, run, "n_words bigint, n_pieces bigint, n_unknown bigint", text=text)
