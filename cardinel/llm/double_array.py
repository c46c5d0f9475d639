"""Phrases of one length as a double-array trie that numpy walks at many places at once.

A word's code is written in digits of base 64, so that a node has 64 children at most. A
transition from state s by digit d leads to `base[s] + d`, if `check` there is s.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BITS = 6
RADIX = 1 << BITS
# Nodes with more children get a block of their own; the others fill the gaps.
DENSE = 8
TRIES = 40


@dataclass(frozen=True)
class DoubleArray:
    """`ends` has the number of the phrase that a state accepts, or -1."""

    digits: int
    length: int
    base: np.ndarray
    check: np.ndarray
    ends: np.ndarray

    def step(self, states: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the states go on by their word, and where to."""
        alive = np.arange(len(states))
        for k in range(self.digits - 1, -1, -1):
            digit = (codes >> (BITS * k)) & (RADIX - 1)
            to = self.base[states] + digit
            good = self.check[to] == states
            states, alive, codes = to[good], alive[good], codes[good]
        return alive, states

    def accepted(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where phrases of the trie begin, and their numbers.

        All places advance together, a word at a time; a negative code ends a piece.
        """
        at = np.flatnonzero(codes >= 0)
        states = np.zeros(len(at), np.int32)
        for k in range(self.length):
            inside = at + k < len(codes)
            at, states = at[inside], states[inside]
            word = codes[at + k]
            known = word >= 0
            at, states, word = at[known], states[known], word[known]
            alive, states = self.step(states, word)
            at = at[alive]
        return at, self.ends[states]


def digits_for(words: int) -> int:
    return max(1, -(-max(words - 1, 1).bit_length() // BITS))


def build(phrases: np.ndarray, words: int) -> DoubleArray:
    """The trie of different phrases, one a row of word codes below `words`.

    Bounded by the phrases: the caller holds them in memory.
    """
    count, length = phrases.shape
    digits = digits_for(words)
    # Phrases in the order of their words are in that of their digits.
    order = np.lexsort(phrases.T[::-1]) if count else np.zeros(0, np.int64)
    symbols = np.zeros((length * digits, count), np.uint8)
    for k in range(length * digits):
        places = BITS * (digits - 1 - k % digits)
        symbols[k] = (phrases[order, k // digits] >> places) & (RADIX - 1)

    # Nodes level by level: `first` marks the phrases that begin a node of a level.
    new = np.zeros(count, bool)
    if count:
        new[0] = True
    node = np.zeros(count, np.int64)
    parents, letters, total = [], [], 1
    for own in symbols:
        new[1:] |= own[1:] != own[:-1]
        first = np.flatnonzero(new)
        parents.append(node[first])
        letters.append(own[first])
        node = total + np.cumsum(new) - 1
        total += len(first)
    parent = np.concatenate([*parents, np.zeros(0, np.int64)])
    letter = np.concatenate([*letters, np.zeros(0, np.uint8)]).astype(np.int64)
    base, size = _placed(parent, letter, total)

    # Slot 0 is the root; other nodes are where their parent's base and letter lead.
    slot = np.zeros(total, np.int64)
    slot[1:] = base[parent] + letter
    array = np.zeros(size, np.int32)
    check = np.full(size, -1, np.int32)
    ends = np.full(size, -1, np.int32)
    array[slot] = base
    check[slot[1:]] = slot[parent]
    if count:
        ends[slot[node]] = order
    return DoubleArray(digits, length, array, check, ends)


def _placed(parent: np.ndarray, letter: np.ndarray, total: int) -> tuple[np.ndarray, int]:
    """A base for each node so that no two children share a slot; and slots in all.

    Children are sorted by parent. Dense nodes get blocks of their own. The others propose
    free slots for their first child, all at once, and again where a slot is taken; what
    is left after some rounds gets blocks too. Bases of leaves are 0.
    """
    base = np.zeros(total, np.int64)
    nodes, begin, many = np.unique(parent, return_index=True, return_counts=True)
    dense = many >= DENSE
    free_from = 1 + RADIX * int(dense.sum())
    base[nodes[dense]] = 1 + RADIX * np.arange(int(dense.sum()))
    left = np.flatnonzero(~dense)
    room = free_from + 2 * int(many[left].sum()) + 4 * RADIX
    used = np.zeros(room + RADIX, bool)
    used[0] = True
    dense_child = np.repeat(dense, many)
    used[base[parent[dense_child]] + letter[dense_child]] = True
    for turn in range(TRIES):
        if len(left) == 0:
            break
        # The first letter must not lead below the first slot.
        free = np.flatnonzero(~used[RADIX:room]) + RADIX
        if len(free) < len(left):
            break
        spread = free[(np.arange(len(left)) * (len(free) // len(left)) + turn) % len(free)]
        wanted = spread - letter[begin[left]]
        which = np.repeat(np.arange(len(left)), many[left])
        child = np.repeat(begin[left], many[left]) + _ranks(many[left])
        slots = wanted[which] + letter[child]
        bad = used[slots]
        order = np.argsort(slots, kind="stable")
        again = np.r_[False, slots[order][1:] == slots[order][:-1]]
        bad[order[again]] = True
        failed = np.zeros(len(left), bool)
        failed[which[bad]] = True
        base[nodes[left[~failed]]] = wanted[~failed]
        used[slots[~failed[which]]] = True
        left = left[failed]
    if len(left):
        base[nodes[left]] = room + RADIX * np.arange(len(left))
        room += RADIX * len(left)
    # Any digit after any base stays inside the arrays.
    return base, room + 2 * RADIX


def _ranks(many: np.ndarray) -> np.ndarray:
    ends = np.cumsum(many)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - many, many)
