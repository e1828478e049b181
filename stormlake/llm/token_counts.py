"""Token counts by greedy longest-match word pieces, without building the pieces.

The vocabulary is a trie with two roots: one for the beginning of a word, one
for what follows inside it.  Every node has a failure link and the number of
pieces popped on following it, both worked out once, so a word's count comes
from one walk over its letters: each letter either goes down the trie or
follows failure links that give back pieces already seen, in time linear in
the word.  A word whose rest fits no piece is one unknown token.

The walk runs over all distinct words of a batch in lock step: one numpy step a
letter position; where fewer than ``FEW`` words go on, each is walked alone.  Texts are taken whole; there is no longest word.

Pieces come from a public subword vocabulary: those marked as word beginnings
begin words, all others continue them; control and byte pieces are left out.

Defined results: null and empty texts have no words and no tokens; repeated rows
and rows with a null id are counted one by one; an empty table gives an empty
result; other columns are never looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .common import pick, table

VOCABULARY = "piece_bpe_32k.model"
WORD_MARK = "▁"
FEW = 64
_SPACES = str.maketrans("\t\n\v\f\r", "     ")


def words_of(text: str) -> list[str]:
    """Runs of anything but space, tab, line feed, vertical tab, form feed, carriage return."""
    return [w for w in text.translate(_SPACES).split(" ") if w]


def pieces_of(model_path: str) -> tuple[list[str], list[str]]:
    """(pieces that begin a word, pieces that go on inside one) of a sentencepiece model."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    plain = [model.id_to_piece(i) for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    begin = [p[1:] for p in plain if p.startswith(WORD_MARK) and len(p) > 1 and WORD_MARK not in p[1:]]
    return begin, [p for p in plain if p and WORD_MARK not in p]


class PieceCounter:
    """The automaton: transitions, failure links and popped-piece counts by node."""

    BEGIN, INSIDE = 0, 1

    def __init__(self, begin: list[str], inside: list[str]):
        nodes: list[dict[str, int]] = [{}, {}]
        is_piece = [False, False]
        for root, pieces in ((self.BEGIN, begin), (self.INSIDE, inside)):
            for piece in pieces:
                at = root
                for c in piece:
                    if c not in nodes[at]:
                        nodes[at][c] = len(nodes)
                        nodes.append({})
                        is_piece.append(False)
                    at = nodes[at][c]
                is_piece[at] = True
        fail, pops = [-1] * len(nodes), [0] * len(nodes)
        level = [self.BEGIN, self.INSIDE]
        while level:
            below = []
            for v in level:
                for c, u in nodes[v].items():
                    below.append(u)
                    if is_piece[u]:
                        fail[u], pops[u] = self.INSIDE, 1
                        continue
                    z, n = fail[v], pops[v]
                    while z >= 0 and c not in nodes[z]:
                        n += pops[z]
                        z = fail[z]
                    if z >= 0:
                        fail[u], pops[u] = nodes[z][c], n
            level = below
        self.nodes, self.links = nodes, list(zip(fail, pops, strict=True))
        self.fail, self.pops = np.asarray(fail, np.int32), np.asarray(pops, np.int64)
        # transitions: a dense table for ASCII, a sorted list of (node, letter) for the rest
        self.ascii = np.full((len(nodes), 128), -1, np.int32)
        rest = []
        for v, below in enumerate(nodes):
            for c, u in below.items():
                if ord(c) < 128:
                    self.ascii[v, ord(c)] = u
                else:
                    rest.append((v << 21 | ord(c), u))
        rest.sort()
        self.keys = np.asarray([k for k, _ in rest] + [1 << 62], np.int64)
        self.next = np.asarray([u for _, u in rest] + [-1], np.int32)

    def _step(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        out = self.ascii[node, np.minimum(letter, 127)]
        wide = np.flatnonzero(letter > 126)
        if len(wide):
            key = node[wide].astype(np.int64) << 21 | letter[wide]
            at = np.searchsorted(self.keys, key)
            other = np.where(self.keys[at] == key, self.next[at], -1)
            out[wide] = np.where(letter[wide] == 127, out[wide], other)
        return out

    def _walk(self, node: int, letters: str) -> tuple[int, int]:
        """From a node down one word's letters: (last node, -1 if there is none; pieces popped)."""
        nodes, links, total = self.nodes, self.links, 0
        if node < 0:
            return -1, 0
        for c in letters:
            below = nodes[node]
            while c not in below:
                node, popped = links[node]
                if node < 0:
                    return -1, total
                total += popped
                below = nodes[node]
            node = below[c]
        return node, total

    def counts(self, words: list[str]) -> np.ndarray:
        """Pieces of each word; 0 for a word that can't be put together."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-size, kind="stable")
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        start = (np.cumsum(size) - size)[order]
        size = size[order]
        node, total = np.zeros(len(words), np.int32), np.zeros(len(words), np.int64)
        for i in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -i, side="left"))  # words longer than i
            if live < FEW:
                for w in range(live):
                    rest = letters[start[w] + i:start[w] + size[w]].astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
                    node[w], n = self._walk(int(node[w]), rest)
                    total[w] += n
                break
            go = np.flatnonzero(node[:live] >= 0)
            while len(go):
                letter = letters[start[go] + i]
                to = self._step(node[go], letter)
                moved = to >= 0
                node[go[moved]] = to[moved]
                go = go[~moved]
                total[go] += self.pops[node[go]]
                node[go] = self.fail[node[go]]
                go = go[node[go] >= 0]
        go = np.flatnonzero(node > self.INSIDE)
        while len(go):
            total[go] += self.pops[node[go]]
            node[go] = self.fail[node[go]]
            go = go[node[go] > self.INSIDE]
        total[node != self.INSIDE] = 0
        out = np.empty(len(words), np.int64)
        out[order] = total
        return out


_COUNTERS: dict[str, PieceCounter] = {}


def counter(model_path: str) -> PieceCounter:
    """One automaton a worker process."""
    if model_path not in _COUNTERS:
        _COUNTERS[model_path] = PieceCounter(*pieces_of(model_path))
    return _COUNTERS[model_path]


def _count(model_path: str, most_words: int):
    def lots(texts):
        """Runs of texts with about ``most_words`` words together."""
        held, n = [], 0
        for t in texts:
            held.append(words_of(t) if t else [])
            n += len(held[-1])
            if n >= most_words:
                yield held
                held, n = [], 0
        yield held

    def run(batches):
        automaton = counter(model_path)
        for pdf in batches:
            n_words, n_tokens, n_unknown = [], [], []
            for docs in lots(pdf["text"]):
                distinct = {}
                for words in docs:
                    for w in words:
                        distinct.setdefault(w, len(distinct))
                got = automaton.counts(list(distinct))
                tokens = np.maximum(got, 1)
                for words in docs:
                    at = np.fromiter(map(distinct.__getitem__, words), np.int64, len(words))
                    n_words.append(len(words))
                    n_tokens.append(int(tokens[at].sum()))
                    n_unknown.append(int((got[at] == 0).sum()))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "n_words": n_words,
                                "n_tokens": n_tokens, "n_unknown": n_unknown})
    return run


def token_counts(docs: DataFrame, model_path: str, most_words: int = 200_000) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_words, n_tokens, n_unknown (words of one unknown token)."""
    return docs.mapInPandas(_count(model_path, most_words), "doc_id long, n_words long, n_tokens long, n_unknown long")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    return token_counts(docs, public_tokenizers.path(VOCABULARY))
