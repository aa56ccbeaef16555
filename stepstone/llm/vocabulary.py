"""Existing byte-level vocabularies, read from the files of public tokenizers; nothing is trained here."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np


def byte_of_letter() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabularies: printable bytes stand for themselves, the rest from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


@lru_cache(maxsize=2)
def byte_pieces(path: str) -> dict[bytes, int]:
    """Ids by the bytes of a piece, in the order of ids, without special tokens."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    letters, special = byte_of_letter(), set(special_tokens(path))
    vocabulary = sorted(whole["model"]["vocab"].items(), key=lambda x: x[1])
    return {bytes(letters[c] for c in piece): k for piece, k in vocabulary if piece not in special}


@lru_cache(maxsize=2)
def special_tokens(path: str) -> dict[str, int]:
    with open(path, encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}


class Trie:
    """Trie of pieces that many lanes walk at once: ``go`` looks up node * 256 + byte in an open-addressing table."""

    def __init__(self, pieces: list[bytes]):
        self.children: list[dict[int, int]] = [{}]
        piece = [-1]
        for number, p in enumerate(pieces):
            node = 0
            for b in p:
                following = self.children[node].get(b)
                if following is None:
                    following = self.children[node][b] = len(self.children)
                    self.children.append({})
                    piece.append(-1)
                node = following
            piece[node] = number
        self.piece = np.array(piece, np.int32)
        keys = np.array([n << 8 | b for n, c in enumerate(self.children) for b in c], np.int64)
        goals = np.array([g for c in self.children for g in c.values()], np.int32)
        self.bits = max(8, int(len(keys) * 3).bit_length())
        self.slots, self.goals = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        rest, place = np.arange(len(keys)), self._place(keys)
        while len(rest):  # a round for each further probe
            spot = place[rest]
            free = self.slots[spot] < 0
            _, chosen = np.unique(spot[free], return_index=True)
            put = rest[free][chosen]
            self.slots[place[put]], self.goals[place[put]] = keys[put], goals[put]
            rest = np.setdiff1d(rest, put, assume_unique=True)
            place[rest] = (place[rest] + 1) & ((1 << self.bits) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def go(self, nodes: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        """Child of each node by its byte, -1 where there is none."""
        keys = nodes.astype(np.int64) << 8 | bytes_
        out = np.full(len(keys), -1, np.int32)
        rest, place = np.arange(len(keys)), self._place(keys)
        while len(rest):
            seen = self.slots[place]
            hit = seen == keys[rest]
            out[rest[hit]] = self.goals[place[hit]]
            on = ~hit & (seen >= 0)
            rest, place = rest[on], (place[on] + 1) & ((1 << self.bits) - 1)
        return out
