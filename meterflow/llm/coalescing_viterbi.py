"""The cheapest edits that give a conversation a legal order of roles, found while it streams by.

What has been kept so far is in one of four states: nothing, a system row only, an open
user row, or closed by an assistant row. Per state one survivor is kept, the cheapest way
there (ties: the least string of edit letters). Survivors are leaves of a tree of
backpointers whose nodes count who refers to them; nodes that no survivor needs go at once,
and as soon as all survivors share their first edits these are settled and leave the tree.
So only edits that are still open are held.
"""

from __future__ import annotations

from collections.abc import Callable

START, SYSTEM, USER, CLOSED = range(4)
ROLE = {USER: "user", CLOSED: "assistant"}
INITIAL = {SYSTEM: "s", USER: "u", CLOSED: "a"}
#: States in which a row may be added, by the state that it leads to.
BEFORE = {SYSTEM: (START,), USER: (START, SYSTEM, CLOSED), CLOSED: (USER,)}
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
# What edits cost.
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5

#: Takes an edit's letter, and role and text of the row that it leaves (None, None if it leaves none).
Sink = Callable[[str, str | None, str | None], None]


class Node:
    """An edit on some survivor's way. `references`: edits that follow, and survivors that end here."""

    __slots__ = ("letter", "role", "text", "parent", "jump", "depth", "references", "followers")

    def __init__(self, letter: str, role: str | None, text: str | None, parent: Node | None):
        self.letter, self.role, self.text, self.parent = letter, role, text, parent
        self.references, self.followers = 0, []
        if parent is None:
            self.depth, self.jump = 0, self
        else:
            self.depth = parent.depth + 1
            far = parent.jump
            # An ancestor in reach of few jumps at any depth.
            self.jump = far.jump if parent.depth - far.depth == far.depth - far.jump.depth else parent
            parent.followers.append(self)
            parent.references += 1


class Repair:
    """One conversation's search. `cost` holds once `finish` was called."""

    def __init__(self, sink: Sink):
        self.sink, self.cost = sink, 0
        self.root = Node("", None, None, None)
        self.survivors: dict[int, tuple[int, Node]] = {START: (0, self.root)}
        self.root.references = 1
        self._replace({START: [(0, self.root, None)]})

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        """The next row: which edits of it are worth while in each state."""
        found: dict[int, list] = {
            state: [(cost + DELETE_COST, node, (DELETE, None, None))] for state, (cost, node) in self.survivors.items()
        }
        if not must_go:
            extra = TRUNCATED_COST if truncated else 0
            for to, initial in INITIAL.items():
                if role[:1] == initial:
                    edit, price = (KEEP, role, text), extra
                elif to in ROLE:
                    edit, price = (REROLE, ROLE[to], text), extra + REROLE_COST
                else:
                    continue
                for state in BEFORE[to]:
                    if state in self.survivors:
                        cost, node = self.survivors[state]
                        found.setdefault(to, []).append((cost + price, node, edit))
        self._replace(found)

    def finish(self) -> None:
        """Settle the rest: the cheaper of nothing at all and a closed conversation."""
        ends = [(cost, node, None) for state, (cost, node) in self.survivors.items() if state in (START, CLOSED)]
        self.cost, node, _ = self._least(ends)
        edits = []
        while node is not self.root:
            edits.append(node)
            node = node.parent
        for node in reversed(edits):
            self.sink(node.letter, node.role, node.text)

    def _replace(self, found: dict[int, list]) -> None:
        """Let the best ways become the survivors, with rows inserted after them where that is best."""
        now: dict[int, tuple[int, Node]] = {}
        for state, ways in found.items():
            cost, node, edit = self._least(ways)
            now[state] = self._held(cost, node if edit is None else Node(*edit, node))
        for to in (USER, CLOSED):
            edit = (INSERT, ROLE[to], "")
            ways = [(now[state][0] + INSERT_COST, now[state][1], edit) for state in BEFORE[to] if state in now]
            if to in now:
                ways.append((*now[to], None))
            cost, node, edit = self._least(ways)
            if edit is not None:
                if to in now:
                    self._dropped(now[to][1])
                now[to] = self._held(cost, Node(*edit, node))
        # Whatever may follow these two may follow the closed state too, after deleting a system row at most.
        for state, margin in ((START, DELETE_COST), (SYSTEM, 0)):
            if state in now and now[state][0] > now[CLOSED][0] + margin:
                self._dropped(now.pop(state)[1])
        for _, node in self.survivors.values():
            self._dropped(node)
        self.survivors = now
        while self.root.references == 1 and self.root.followers:
            settled = self.root.followers[0]
            self.sink(settled.letter, settled.role, settled.text)
            # Its jump stays: younger nodes find their own by it.
            settled.parent = settled.text = None
            self.root.followers = []
            self.root = settled

    @staticmethod
    def _held(cost: int, node: Node) -> tuple[int, Node]:
        node.references += 1
        return cost, node

    def _dropped(self, node: Node) -> None:
        node.references -= 1
        while not node.references:
            parent = node.parent
            parent.followers.remove(node)
            parent.references -= 1
            node.parent = node.jump = None
            node = parent

    def _least(self, ways: list) -> tuple:
        """The cheapest way; of equally cheap ones that whose letters, from the first open edit on, are least."""
        best = ways[0]
        for way in ways[1:]:
            if way[0] < best[0] or way[0] == best[0] and self._before(way, best):
                best = way
        return best

    def _before(self, way: tuple, other: tuple) -> bool:
        """Whether a way's open letters sort before another's of the same cost.

        Edits that follow one node bear different letters, so the first two after the last
        common node decide. Letters fix the cost, so neither string continues the other.
        """
        _, a, edit_a = way
        _, b, edit_b = other
        if a is b:
            return (edit_a[0] if edit_a else "") < (edit_b[0] if edit_b else "")
        after_a, after_b = edit_a and edit_a[0] or "", edit_b and edit_b[0] or ""
        a, after_a = self._raised(a, b.depth, after_a)
        b, after_b = self._raised(b, a.depth, after_b)
        while a is not b:
            jump_a, jump_b = a.jump, b.jump
            if jump_a is not jump_b and self._open(jump_a) and self._open(jump_b):
                a, b = jump_a, jump_b
            else:
                after_a, after_b, a, b = a.letter, b.letter, a.parent, b.parent
        return after_a < after_b

    def _raised(self, node: Node, depth: int, after: str) -> tuple[Node, str]:
        """The node's ancestor at a depth, and the letter of the edit after it on the way."""
        while node.depth > depth:
            jump = node.jump
            if jump.depth > depth and self._open(jump):
                node = jump
            else:
                after, node = node.letter, node.parent
        return node, after

    def _open(self, node: Node) -> bool:
        return node.depth >= self.root.depth
