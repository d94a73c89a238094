"""BPE encoding by depth-first traversal of a trie of distinct words, and decoding.

For every prefix of a word there is one token that ends its encoding, and that token is
known from the states of shorter prefixes alone: t ends the encoding of prefix p if t is a
suffix of p and the last token of p without t, followed by t, is itself what merging makes
of their joined symbols.  So the state of a trie node, its last token, is computed once and
shared by all words below it.  Distinct words are visited in sorted order, which is the
depth-first order of their trie: the states of the common prefix with the word before stay
on the stack, only the rest is computed.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from arrears.llm.common import give_back, on_executors, pieces, without_cycles
from arrears.llm.pretokens import Cutter, encoded_column

#: bytes of text whose distinct words make one trie
PIECE = 4 << 20
#: remembered answers of ``Merges.follows``
PAIRS = 200_000
#: stands for the word-end mark in the token search
_END = "\ue000"
_NEVER = 1 << 60


class Merges:
    """Vocabulary and merge ranks of a word-end BPE tokenizer file."""

    def __init__(self, model: dict):
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(pairs)}
        self.tokens = {i: t for t, i in self.ids.items()}
        self._edges: dict[int, tuple] = {}
        self._fits: dict[int, bool] = {}

    def symbols(self, word: str) -> tuple[str, ...]:
        """The characters of a word, the last one with the word-end mark."""
        return (*word[:-1], word[-1] + self.suffix)

    def merge(self, parts: list[str]) -> list[str]:
        """Plain BPE: again and again the leftmost pair of the lowest rank."""
        parts = list(parts)
        for _ in self._merging(parts):
            pass
        return parts

    def _merging(self, parts: list[str]) -> Iterator[tuple[int, int]]:
        """Merge ``parts`` in place; yields the rank of each merge and its place before it is done."""
        while len(parts) > 1:
            rank, at = min((self.ranks.get((parts[i], parts[i + 1]), _NEVER), i) for i in range(len(parts) - 1))
            if rank == _NEVER:
                return
            yield rank, at
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _split(self, token: str) -> list[str]:
        body = token.removesuffix(self.suffix) if self.suffix and len(token) > len(self.suffix) else token
        return [*body[:-1], body[-1] + token[len(body) :]]

    def edges(self, token: int) -> tuple:
        """How a token comes about at its edges: ``(whole, regular, left, right)``.

        ``left`` lists its first symbol at each time with the rank of the merge that ends
        that symbol, ``right`` its last symbol; ``whole``: merging its symbols gives it;
        ``regular``: its merges come in the order of their ranks.
        """
        known = self._edges.get(token)
        if known is None:
            parts = self._split(self.tokens[token])
            left, right, before, regular = [], [], -1, True
            for rank, at in self._merging(parts):
                regular &= rank >= before
                before = rank
                if at == 0:
                    left.append((parts[0], rank))
                if at == len(parts) - 2:
                    right.append((parts[-1], rank))
            left.append((parts[0], _NEVER))
            right.append((parts[-1], _NEVER))
            known = self._edges[token] = (len(parts) == 1, regular, left, right)
        return known

    def follows(self, left: int, right: int) -> bool:
        """Whether merging the symbols of both tokens leaves just these two.

        Where merges come in the order of their ranks, a rank is a time.  A pair across the
        border merges if both its symbols stand there at one time and its rank comes before
        the merges that end them; of equal ranks the leftmost goes first.
        """
        key = left << 32 | right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > PAIRS:
                self._fits.clear()
            known = self._fits[key] = self._stay(left, right)
        return known

    def _stay(self, left: int, right: int) -> bool:
        whole_a, regular_a, _, last = self.edges(left)
        whole_b, regular_b, first, _ = self.edges(right)
        if not (whole_a and whole_b):
            return False
        if not (regular_a and regular_b):
            two = [self.tokens[left], self.tokens[right]]
            return self.merge(self._split(two[0]) + self._split(two[1])) == two
        i = j = 0
        while True:
            (a, end_a), (b, end_b) = last[i], first[j]
            rank = self.ranks.get((a, b))
            if rank is not None and rank < end_a and rank <= end_b:
                return False
            if end_a == end_b == _NEVER:
                return True
            if end_a <= end_b:
                i += 1
            else:
                j += 1

    def search(self) -> ahocorasick.Automaton:
        """Finds all tokens in a word; values are the id and the number of symbols."""
        found = ahocorasick.Automaton()
        for token, i in self.ids.items():
            if token and token != self.suffix:
                parts = self._split(token)
                ends = self.suffix and parts[-1] != self.suffix and parts[-1].endswith(self.suffix)
                found.add_word(token.removesuffix(self.suffix) + _END if ends else token, (i, len(parts)))
        found.make_automaton()
        return found


class Trie:
    """States of the trie's current path; words are to come in sorted order."""

    def __init__(self, merges: Merges, tokens: ahocorasick.Automaton):
        self.merges, self.tokens = merges, tokens
        self.word = ""
        #: id of the last token of each prefix of the path, and the number of symbols in it
        self.last: list[tuple[int, int]] = []

    def encode(self, word: str) -> list[int]:
        """Token ids of the whole word; only states beyond the shared prefix are computed."""
        last, known, follows, edges = self.last, self.merges._fits, self.merges.follows, self.merges.edges
        before, final = self.word, len(word) - 1
        shared, most = 0, min(len(before) - 1, final)  # the last symbol has the mark
        while shared < most and before[shared] == word[shared]:
            shared += 1
        del last[shared:]
        self.word = word
        text = word + _END if self.merges.suffix else word
        tail = len(text) - 1
        goal = shared if shared < final else tail  # where tokens that end the next prefix end
        for end, fit in self.tokens.iter(text):
            if end != goal:
                if end < goal:
                    continue
                break  # no token ends here
            token, k = fit
            n = len(last)
            if k > n:
                fits = edges(token)[0]
            else:
                left = last[n - k][0]
                fits = known.get(left << 32 | token)
                if fits is None:
                    fits = follows(left, token)
            if fits:
                last.append(fit)
                goal = n + 1 if n + 1 < final else tail if n < final else -1
                if goal < 0:
                    break
        if len(last) <= final:
            raise ValueError(f"no token ends a prefix of {word!r}")
        out, at = [], len(word)
        while at:
            token, k = last[at - 1]
            out.append(token)
            at -= k
        out.reverse()
        return out


class TrieTokenizer:
    """Encodes and decodes texts as the tokenizer file says, words by a prefix trie.

    Normalising and cutting into pre-tokens is left to the file's own rules; both never
    look across ASCII white space, so they run once per distinct part between spaces.
    """

    def __init__(self, spec: str):
        rules = json.loads(spec)
        self.merges = Merges(rules["model"])
        self.search = self.merges.search()
        self.cut = Cutter(rules)
        count = max([*self.merges.ids.values(), *self.cut.added.values()]) + 1
        self.strings = [""] * count
        for token, i in [*self.merges.ids.items(), *self.cut.added.items()]:
            self.strings[i] = token

    def learn(self, words: list[str]) -> list[list[int]]:
        """Ids of distinct words, which go through a trie in sorted order."""
        trie, out = Trie(self.merges, self.search), {}
        for w in sorted(words):
            out[w] = trie.encode(w)
        return [out[w] for w in words]

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the whole texts of a column, and where each text's ids start."""
        with without_cycles():
            return encoded_column(column, self.cut, self.learn)

    def encode_batch(self, batch: list[str]) -> list[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit numbers."""
        ids, starts = self.encode_column(pa.array(batch, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]

    def decode(self, ids: bytes | memoryview) -> str:
        """The token strings joined by spaces: what a file without a decoder asks for."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=1)
def _tokenizer(spec: str) -> TrieTokenizer:
    return TrieTokenizer(spec)


def tokenized(docs: DataFrame, tokenizer_path: str, ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` per row; with ``ids`` also the ids and the decoded text.

    A null text is the empty text and has no tokens.  Repeated rows stay repeated, a null
    doc_id stays null, an empty table gives an empty result, other columns are not read.
    The driver reads the tokenizer file, whose size does not grow with the data, and
    broadcasts it.  No shuffle: a task holds the distinct words of ``PIECE`` bytes of text.
    """
    spark: SparkSession = docs.sparkSession
    on_executors(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(spec.value)
        for batch in pieces(batches, limit=PIECE):
            every, starts = tok.encode_column(batch.column(1))
            codes = [memoryview(every[a:b]) for a, b in zip(starts[:-1], starts[1:])]
            decoded = list(map(tok.decode, codes))
            columns = [
                batch.column(0),
                pa.array(np.diff(starts)),
                pa.array([hashlib.sha256(c).hexdigest() for c in codes], pa.string()),
                pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                lists = pa.ListArray.from_arrays(starts.astype(np.int32), every.view(np.int32))
                columns += [lists, pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)
        give_back()  # the worker lives on: other jobs need the memory

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(work, schema + (", ids array<int>, decoded string" if ids else ""))
