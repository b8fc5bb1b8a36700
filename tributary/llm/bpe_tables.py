"""Byte-pair merge tables and the rule that says which tokens may be neighbours.

Two neighbouring tokens are *compatible* when merging their joint text gives
exactly these two tokens.  With that rule an encoding can be built from longest
matches (backtracking) or from prefixes (dynamic programming) instead of by
replaying merges, and stays exact.
"""

from __future__ import annotations

import json
from functools import lru_cache

import ahocorasick

SPAN = 1 << 32          # a pair of token ids as one number
CACHE_PAIRS = 500_000   # remembered answers per Python worker
# How byte-level vocabularies write the 256 bytes as characters.
# Printable bytes stand for themselves, the others follow from 256 upwards.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_characters() -> list[str]:
    rest = iter(range(256, 512))
    own = set(_PRINTABLE)
    return [chr(b if b in own else next(rest)) for b in range(256)]


class MergeTable:
    """Vocabulary and merges of one tokenizer file.

    Tokens are written over *units*: one character per byte, or, where the
    vocabulary marks word ends, one character for "last byte of a word"
    (code point 256 + byte).
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token_text = {i: t for t, i in model["vocab"].items()}
        self.token_text.update({i: t for t, i in self.added.items()})
        of_char = {c: b for b, c in enumerate(byte_characters())}

        def units(token: str) -> str:
            ended = bool(self.suffix) and token.endswith(self.suffix)
            core = token[:-len(self.suffix)] if ended else token
            raw = [of_char[c] for c in core]
            return "".join(chr(256 + b if ended and k == len(raw) - 1 else b)
                           for k, b in enumerate(raw))

        self.id_of = {units(t): i for t, i in model["vocab"].items()}
        self.units_of = {i: u for u, i in self.id_of.items()}
        size = max(self.token_text, default=-1) + 1
        self.rank: dict[int, int] = {}             # left * SPAN + right -> rank of the merge
        self.left = list(range(size))              # the parts a token was merged from
        self.right = list(range(size))
        self.order = [-1] * size                   # rank of that merge; -1: a single unit
        self.length = [len(self.units_of.get(i, "")) for i in range(size)]
        vocab = model["vocab"]
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made, a, b = vocab[left + right], vocab[left], vocab[right]
            self.rank[a * SPAN + b] = rank
            if self.order[made] < 0:
                self.left[made], self.right[made], self.order[made] = a, b, rank
        self.automaton = ahocorasick.Automaton()
        for text, token in self.id_of.items():
            self.automaton.add_word(text, (token, len(text)))
        self.automaton.make_automaton()
        self.shorter: list[int | None] = [None] * size   # longest token that begins a token
        for token, text in self.units_of.items():
            for n in range(len(text) - 1, 0, -1):
                if (begin := self.id_of.get(text[:n])) is not None:
                    self.shorter[token] = begin
                    break
        self.known: dict[int, bool] = {}           # answers of fits()

    def units(self, piece: bytes) -> str:
        text = piece.decode("latin-1")
        return text[:-1] + chr(256 + piece[-1]) if self.suffix and piece else text

    def fits(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` may stand next to each other.

        Undo both tokens' last merges step by step, latest merge first; if at
        some step the two parts that touch would have merged earlier than the
        merge just undone, the boundary would not have survived.
        """
        key = left * SPAN + right
        rank, order = self.rank, self.order
        limit = len(rank)
        while True:
            if rank.get(left * SPAN + right, limit) < limit:
                answer = False
                break
            made_left, made_right = order[left], order[right]
            if made_left > made_right:
                # a touching merge of the same rank lies further right: later
                limit, left = made_left, self.right[left]
            elif made_right >= 0:
                # a touching merge of the same rank lies further left: earlier
                limit, right = made_right + 1, self.left[right]
            else:
                answer = True
                break
        if len(self.known) >= CACHE_PAIRS:
            self.known.clear()
        self.known[key] = answer
        return answer


class Remembered(dict):
    """A memo of bounded size: when ``size`` entries are new, those not used
    since the last time are forgotten."""

    def __init__(self, make, size: int, longest: int = 40):
        super().__init__()
        self.make, self.size, self.longest = make, size, longest
        self.older: dict = {}

    def __missing__(self, key: str):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


@lru_cache(maxsize=4)
def merge_table(path: str) -> MergeTable:
    """One table per file and Python worker."""
    return MergeTable(path)
