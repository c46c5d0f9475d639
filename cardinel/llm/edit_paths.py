"""Edit histories that share their beginnings, and the cheapest repair of a role sequence.

A history is a node: its last letter and links to the nodes 1, 2, 4, ... letters before
it, with a rolling hash of all its letters. Extending a history adds one node and leaves
the others alone, so that the best histories of all states share what they have in common.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

PRIME = (1 << 61) - 1
BASE = 0x1F3D5B79A2C4E681
# Nodes beyond which what all live histories share is given out and let go.
NODES = 4096

Emit = Callable[[str, bytes | None, bytes | None], None]


class Histories:
    """Nodes by number; 0 is the empty history.

    `letters`, `depth`, `hashes` and `ups` (ancestors at distances of powers of two)
    are by node; `kept` has the role and text that a letter leaves, or None.
    """

    def __init__(self) -> None:
        self.letters, self.depth, self.hashes = [""], [0], [0]
        self.ups: list[list[int]] = [[]]
        self.kept: list[tuple[bytes, bytes] | None] = [None]

    def __len__(self) -> int:
        return len(self.letters)

    def add(self, node: int, letter: str, kept: tuple[bytes, bytes] | None) -> int:
        up, k = [node], 0
        while k < len(self.ups[up[k]]):
            up.append(self.ups[up[k]][k])
            k += 1
        self.ups.append(up)
        self.letters.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hashes.append((self.hashes[node] * BASE + ord(letter)) % PRIME)
        self.kept.append(kept)
        return len(self.letters) - 1

    def at_depth(self, node: int, depth: int) -> int:
        while (apart := self.depth[node] - depth) > 0:
            node = self.ups[node][apart.bit_length() - 1]
        return node

    def path(self, node: int, above: int = 0) -> list[int]:
        """Nodes after depth `above` up to the node, first to last."""
        found = []
        while self.depth[node] > above:
            found.append(node)
            node = self.ups[node][0]
        return found[::-1]

    def text(self, node: int) -> str:
        return "".join(self.letters[x] for x in self.path(node))

    def _equal(self, a: int, b: int) -> bool:
        """Whether two histories of one depth have the same letters, letter by letter."""
        while a != b:
            if self.letters[a] != self.letters[b]:
                return False
            a, b = self.ups[a][0], self.ups[b][0]
        return True

    def before(self, a: int, b: int) -> bool:
        """Whether the letters of `a` come before those of `b` in ASCII order.

        The longest common prefix is searched by lifting both to where hashes part. Hashes
        that differ prove a difference; equal ones are verified, and a collision is
        settled by comparing the letters.
        """
        depth = min(self.depth[a], self.depth[b])
        x, y = self.at_depth(a, depth), self.at_depth(b, depth)
        if self.hashes[x] == self.hashes[y]:
            if self._equal(x, y):
                return self.depth[a] < self.depth[b]
            return self.text(a) < self.text(b)
        for k in range(len(self.ups[x]) - 1, -1, -1):
            # Ancestors have fewer ancestors of their own.
            if k < len(self.ups[x]):
                p, q = self.ups[x][k], self.ups[y][k]
                if self.hashes[p] != self.hashes[q]:
                    x, y = p, q
        if self._equal(self.ups[x][0], self.ups[y][0]):
            return self.letters[x] < self.letters[y]
        return self.text(a) < self.text(b)

    def shared(self, nodes: list[int]) -> int:
        """The last node that all the given histories have gone through."""
        depth = min(self.depth[x] for x in nodes)
        nodes = [self.at_depth(x, depth) for x in nodes]
        while len(set(nodes)) > 1:
            top = max(len(self.ups[x]) for x in nodes) - 1
            for k in range(top, -1, -1):
                above = {self.ups[x][k] for x in nodes if k < len(self.ups[x])}
                if len(above) > 1 and all(k < len(self.ups[x]) for x in nodes):
                    nodes = [self.ups[x][k] for x in nodes]
                    break
            else:
                nodes = [self.ups[x][0] for x in nodes]
        return nodes[0]


@dataclass
class Row:
    """A message after damage: its faults, initial of its role, role and text."""

    initial: str
    role: bytes
    text: bytes
    must_go: bool
    truncated: bool


# Costs of the edits.
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
# States: nothing yet, after s, after u, after a. The roles that may follow, and where to.
FOLLOWS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
WANTED = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
ENDS = (0, 3)
# No state can make up for being dearer than another one by more than this: from any state
# any other one's ways on can be followed after two insertions and one deletion at most.
HOPELESS = 2 * INSERT + DELETE


class Repair:
    """The cheapest edits of one conversation, whose rows come one by one.

    Edits are Keep, Rerole, Delete and Insert; roles must end as `(s?(ua)+)?`. Of equally
    dear histories the one whose letters come first in ASCII order wins: of two histories
    of one state and cost neither begins the other, as the rest would have to be
    insertions, which cost. `emit(letter, role, text)` gets the edits as soon as they
    are settled, so that memory holds only what is still undecided.
    """

    def __init__(self, emit: Emit) -> None:
        self.emit, self.most = emit, NODES
        self.histories = Histories()
        self.best: list[tuple[int, int] | None] = [(0, 0), None, None, None]

    def _better(self, best: list, state: int, cost: int, node: int, letter: str, kept) -> None:
        have = best[state]
        if have is not None and have[0] < cost:
            return
        new = self.histories.add(node, letter, kept)
        if have is None or cost < have[0] or self.histories.before(new, have[1]):
            best[state] = (cost, new)

    def _insert(self) -> None:
        """A user after all but a user, then an assistant after a user."""
        for targets in ((0, 1, 3), (2,)):
            for state in targets:
                if self.best[state] is not None:
                    cost, node = self.best[state]
                    role, to = WANTED[state]
                    self._better(self.best, to, cost + INSERT, node, "I", (role.encode(), b""))

    def add(self, row: Row) -> None:
        self._insert()
        best: list[tuple[int, int] | None] = [None] * 4
        more = CUT if row.truncated else 0
        for state, have in enumerate(self.best):
            if have is None:
                continue
            cost, node = have
            self._better(best, state, cost + DELETE, node, "D", None)
            if row.must_go:
                continue
            to = FOLLOWS[state].get(row.initial)
            if to is not None:
                self._better(best, to, cost + more, node, "K", (row.role, row.text))
            role, to = WANTED[state]
            self._better(best, to, cost + REROLE + more, node, "R", (role.encode(), row.text))
        least = min(x[0] for x in best if x is not None)
        self.best = [x if x is not None and x[0] <= least + HOPELESS else None for x in best]
        if len(self.histories) > self.most:
            self._settle()

    def _settle(self) -> None:
        """Give out what all live histories begin with, and keep only the rest of them."""
        old, live = self.histories, [x[1] for x in self.best if x is not None]
        root = old.shared(live)
        for node in old.path(root):
            self._give(old, node)
        self.histories, moved = Histories(), {root: 0}
        for end in live:
            for node in old.path(end, old.depth[root]):
                if node not in moved:
                    moved[node] = self.histories.add(
                        moved[old.ups[node][0]], old.letters[node], old.kept[node]
                    )
        self.best = [None if x is None else (x[0], moved[x[1]]) for x in self.best]
        self.most = NODES + 2 * len(self.histories)

    def _give(self, histories: Histories, node: int) -> None:
        role, text = histories.kept[node] or (None, None)
        self.emit(histories.letters[node], role, text)

    def finish(self) -> int:
        """Give out the rest; returns the cost."""
        self._insert()
        ends = [self.best[state] for state in ENDS if self.best[state] is not None]
        cost, node = ends[0]
        for other in ends[1:]:
            if other[0] < cost or other[0] == cost and self.histories.before(other[1], node):
                cost, node = other
        for x in self.histories.path(node):
            self._give(self.histories, x)
        return cost


def repaired(rows: Iterator[Row]) -> tuple[int, list[tuple[str, bytes | None, bytes | None]]]:
    """Cost and edits of a conversation that fits into memory."""
    edits: list[tuple[str, bytes | None, bytes | None]] = []
    repair = Repair(lambda *edit: edits.append(edit))
    for row in rows:
        repair.add(row)
    return repair.finish(), edits
