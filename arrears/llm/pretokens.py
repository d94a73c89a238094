"""Cutting texts into pre-tokens as a tokenizer file's rules say, once per distinct part between spaces."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: text that the plain rules leave in its composed form and in which case and character classes
#: are settled: printable ASCII without "<", and Latin letters and signs below U+0250
_SETTLED = re.compile(r"[!-;=-~¡-įı-ɏ]+")


def byte_characters() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def plain_rule(rules: dict) -> regex.Pattern | None:
    """The file's cutting rule, if its rules have the plain form: compose, lower-case, cut, bytes."""
    normal, cut = rules["normalizer"] or {}, rules["pre_tokenizer"] or {}
    steps, cuts = normal.get("normalizers", []), cut.get("pretokenizers", [])
    plain = (
        [n["type"] for n in steps] == ["NFC", "Replace", "Lowercase"]
        and (steps[1]["pattern"], steps[1]["content"]) == ({"Regex": r"\s+"}, " ")
        and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and (cuts[0]["behavior"], cuts[0]["invert"]) == ("Removed", True)
        and "Regex" in cuts[0]["pattern"]
        and not cuts[1]["add_prefix_space"]
        and not cuts[1]["use_regex"]
        and all(t["content"].startswith("<") for t in rules["added_tokens"])
    )
    return regex.compile(cuts[0]["pattern"]["Regex"]) if plain else None


class Cutter:
    """Pre-tokens of parts; settled parts by the rule itself, all at once, others by the library's own rules."""

    def __init__(self, rules: dict):
        from tokenizers import Tokenizer

        # normaliser and cutting rules alone: the vocabulary is not needed here
        own = Tokenizer.from_str(json.dumps({**rules, "model": {**rules["model"], "vocab": {}, "merges": []}}))
        self.normalizer, self.pre_tokenizer = own.normalizer, own.pre_tokenizer
        self.added = {t["content"]: t["id"] for t in rules["added_tokens"]}
        special = "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))
        self.special = regex.compile(f"({special})") if special else None
        rule = plain_rule(rules)
        self.rule = regex.compile(f"{rule.pattern}|\n") if rule else None
        # the byte characters in UTF-8: at most two bytes each; white space stays
        written = [(chr(b) if b <= 0x20 else c).encode() for b, c in sorted(byte_characters().items())]
        self.sizes = np.array([len(w) for w in written])
        self.written = np.array([list(w.ljust(2, b"\0")) for w in written], dtype=np.uint8)

    def _by_library(self, part: str) -> list[str | int]:
        """Pre-tokens of a part, and ids of added tokens in it."""
        out: list[str | int] = []
        for piece in self.special.split(part) if self.special else [part]:
            if piece in self.added:
                out.append(self.added[piece])
            elif piece:
                out += [w for w, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(piece)) if w]
        return out

    def cut(self, parts: list[str]) -> tuple[list[int], list[str | int]]:
        """``(order, pieces)``: the pre-tokens of all parts, each part followed by a line end.

        ``order`` says which part comes first, second and so on; added tokens are numbers.
        """
        if self.rule:
            full = _SETTLED.fullmatch
            plain = [bool(full(p)) for p in parts]
        else:
            plain = [False] * len(parts)
        order = [k for k, p in enumerate(plain) if p]
        pieces: list[str | int] = []
        if order:
            found = self.rule.findall("".join([parts[k] + "\n" for k in order]).lower())
            # words hold no spaces: their bytes turn into characters all at once
            data = np.frombuffer(" ".join(found).encode(), dtype=np.uint8)
            pairs = self.written[data]
            pieces += pairs[np.arange(2) < self.sizes[data][:, None]].tobytes().decode().split(" ")
        for k, p in enumerate(plain):
            if not p:
                order.append(k)
                pieces += self._by_library(parts[k])
                pieces.append("\n")
        return order, pieces


def encoded_column(
    column: pa.Array, cutter: Cutter, code: Callable[[list[str]], list[list[int]]]
) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, starts)`` of the texts of an Arrow column; null is the empty text.

    Text i has ``ids[starts[i] : starts[i + 1]]``.  The parts between ASCII white space, over
    which no rule looks, are made distinct by Arrow; only distinct parts are cut, only
    distinct words are given to ``code`` for their ids, and arrays put the ids in place.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(column, ""))
    flat = lists.flatten().dictionary_encode()
    order, pieces = cutter.cut(flat.dictionary.to_numpy(zero_copy_only=False).tolist())
    words: dict[str | int, int] = {"\n": 0}
    names = np.fromiter((words.setdefault(w, len(words)) for w in pieces), dtype=np.int64, count=len(pieces))
    del pieces
    distinct = list(words)[1:]
    coded = iter(code([w for w in distinct if isinstance(w, str)]))
    ids = [next(coded) if isinstance(w, str) else (w,) for w in distinct]
    size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    pool = np.fromiter(chain.from_iterable(ids), dtype="<u4", count=int(size.sum()))
    del words, distinct, ids
    # ids of the pieces, then of the parts, then of the texts
    pool, _ = _gathered(pool, np.concatenate([[0], size]), names)
    size = np.concatenate([[0], size])[names]
    ends = np.flatnonzero(names == 0)
    total = np.cumsum(size)[ends]
    parts = np.empty(len(order), dtype=np.int64)
    firsts = np.empty(len(order), dtype=np.int64)
    parts[order] = np.diff(total, prepend=0)
    firsts[order] = np.concatenate([[0], total[:-1]]) if len(order) else total
    pool, before = _gathered(pool, parts, flat.indices.to_numpy(zero_copy_only=False), firsts)
    places = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return pool, before[places - places[0]]


def _gathered(pool: np.ndarray, size: np.ndarray, at: np.ndarray, first: np.ndarray | None = None):
    """The stretches ``at`` of the pool one after the other, and where each starts."""
    first = np.cumsum(size) - size if first is None else first
    before = np.concatenate([[0], np.cumsum(size[at])])
    source = np.repeat(first[at] - before[:-1], size[at]) + np.arange(before[-1])
    return pool[source], before
