"""Re-Pair over many short sequences, and the cheapest repair of a sequence from one min-plus matrix per symbol.

Terminals are role and fault of a row: DELETE, or a role (system, user, assistant, other) that is whole or truncated.
A state says what the repaired rows so far end with: nothing, a system row, a user row, an assistant row.  A symbol's
matrix has, for each pair of states, the least cost of leading from one to the other over the symbol's rows, and the
ASCII-least audit of that cost as a rope.  Matrices multiply along a rule, so a rule is evaluated once for all places
that use it.  Two audits of one cost from one state are never the start of one another (what follows would be
insertions, which cost), so the least audit of a product is the product of least audits.
"""

from __future__ import annotations

from collections import Counter

DELETE = 0
#: Whole rows by the initial of their role, other roles; a truncated row has four more.
ROLES = {"s": 1, "u": 2, "a": 3}
OTHER = 4
TERMINALS = 9
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ACCEPTED = (START, ASSISTANT)
#: Costs of the edits.
REROLE, REMOVE, INSERT, CUT = 2, 3, 2, 1

_BASE, _PRIME = 911382323, (1 << 61) - 1
_POWERS = [1]


def _power(n: int) -> int:
    while len(_POWERS) <= n.bit_length():
        _POWERS.append(_BASE if len(_POWERS) == 1 else _POWERS[-1] * _POWERS[-1] % _PRIME)
    found, bit = 1, 1
    while n:
        if n & 1:
            found = found * _POWERS[bit] % _PRIME
        n, bit = n >> 1, bit + 1
    return found


class Rope:
    """An audit as a tree of shared parts, compared by the hashes of its parts."""

    __slots__ = ("left", "right", "text", "size", "hash")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.left, self.right, self.text = left, right, text
        if left is None:
            self.size, self.hash = len(text), 0
            for char in text:
                self.hash = (self.hash * _BASE + ord(char)) % _PRIME
        else:
            self.size = left.size + right.size
            self.hash = (left.hash * _power(right.size) + right.hash) % _PRIME

    def __add__(self, other: Rope) -> Rope:
        if not other.size:
            return self
        if not self.size:
            return other
        if self.size + other.size <= 32:
            return Rope(str(self) + str(other))
        return Rope("", self, other)

    def __str__(self) -> str:
        parts, todo = [], [self]
        while todo:
            rope = todo.pop()
            if rope.left is None:
                parts.append(rope.text)
            else:
                todo += [rope.right, rope.left]
        return "".join(parts)

    def __lt__(self, other: Rope) -> bool:
        """Code-point order; equal parts in the same place are passed over whole."""
        mine, theirs = [self], [other]
        while mine and theirs:
            a, b = mine.pop(), theirs.pop()
            if a is b or a.size == b.size and a.hash == b.hash:
                continue
            if a.left is None and b.left is None:
                n = min(a.size, b.size)
                if a.text[:n] != b.text[:n]:
                    return a.text < b.text
                if a.size > n:
                    mine.append(Rope(a.text[n:]))
                if b.size > n:
                    theirs.append(Rope(b.text[n:]))
            elif b.left is None or a.left is not None and a.size >= b.size:
                mine += [a.right, a.left]
                theirs.append(b)
            else:
                theirs += [b.right, b.left]
                mine.append(a)
        return bool(theirs)


#: cost and audit, or None where no edits lead from the one state to the other
Entry = tuple[int, Rope] | None
Matrix = tuple[Entry, ...]


def _better(a: Entry, b: Entry) -> Entry:
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if b[1] < a[1] else a


def multiply(x: Matrix, y: Matrix) -> Matrix:
    out: list[Entry] = []
    for i in STATES:
        for j in STATES:
            ways = [(x[4 * i + k], y[4 * k + j]) for k in STATES]
            ways = [(a[0] + b[0], a, b) for a, b in ways if a and b]
            least = min((w[0] for w in ways), default=None)
            best: Entry = None
            for cost, a, b in ways:
                if cost == least:
                    best = _better(best, (cost, a[1] + b[1]))
            out.append(best)
    return tuple(out)


def _after(state: int) -> int:
    """The state after one more user or assistant row."""
    return ASSISTANT if state == USER else USER


def _insertions() -> Matrix:
    out: list[Entry] = [None] * 16
    for i in STATES:
        state = i
        for n in range(4):
            if out[4 * i + state] is None:
                out[4 * i + state] = (INSERT * n, Rope("I" * n))
            state = _after(state)
    return tuple(out)


INSERTIONS = _insertions()


def terminal(symbol: int) -> Matrix:
    """Insertions, then the edit of one row."""
    out: list[Entry] = [None] * 16
    for i in STATES:
        if symbol == DELETE:
            out[5 * i] = (REMOVE, Rope("D"))
            continue
        role, late = (symbol - 1) % 4 + 1, CUT if symbol > OTHER else 0
        j = _after(i)
        keep = role == ROLES["u"] and j == USER or role == ROLES["a"] and j == ASSISTANT
        out[4 * i + j] = (late, Rope("K")) if keep else (REROLE + late, Rope("R"))
        out[5 * i] = _better(out[5 * i], (REMOVE, Rope("D")))
        if role == ROLES["s"] and i == START:
            out[4 * i + SYSTEM] = (late, Rope("K"))
    return multiply(INSERTIONS, tuple(out))


def terminals() -> list[Matrix]:
    return [terminal(x) for x in range(TERMINALS)]


def evaluate(rules: list[tuple[int, int]]) -> list[Matrix]:
    """The matrix of each symbol, bottom up; rule n is symbol TERMINALS + n and names earlier symbols only."""
    matrices = terminals()
    for left, right in rules:
        matrices.append(multiply(matrices[left], matrices[right]))
    return matrices


def product(parts: list[Matrix]) -> Matrix:
    """The product in order, by halves."""
    while len(parts) > 1:
        parts = [multiply(*parts[x:x + 2]) if x + 1 < len(parts) else parts[x] for x in range(0, len(parts), 2)]
    return parts[0] if parts else tuple((0, Rope()) if x % 5 == 0 else None for x in range(16))


def cheapest(matrix: Matrix) -> tuple[int, str]:
    """Cost and audit of a whole sequence: from nothing to an accepted state, with insertions at the end."""
    whole = multiply(matrix, INSERTIONS)
    best: Entry = None
    for state in ACCEPTED:
        best = _better(best, whole[4 * START + state])
    return best[0], str(best[1])


def packed(matrix: Matrix) -> tuple[list[int | None], list[str | None]]:
    return [x and x[0] for x in matrix], [x and str(x[1]) for x in matrix]


def unpacked(costs, audits) -> Matrix:
    return tuple(None if cost is None else (int(cost), Rope(audit)) for cost, audit in zip(costs, audits))


def pairs(sequence: list[int]) -> Counter:
    """Occurrences of neighbours that do not overlap one another."""
    found: Counter = Counter()
    last, end = None, -1
    for place, pair in enumerate(zip(sequence, sequence[1:])):
        if pair == last and place <= end:
            continue
        found[pair] += 1
        last, end = pair, place + 1
    return found


def choose(counts: list[tuple[int, int, int]], most: int) -> list[tuple[int, int]]:
    """Up to ``most`` frequent pairs (from (left, right, count) rows), of which none can take a symbol from another."""
    heads: set[int] = set()
    tails: set[int] = set()
    chosen = []
    for left, right, count in sorted(counts, key=lambda x: (-x[2], x[0], x[1])):
        if count > 1 and left not in tails and right not in heads:
            heads.add(left)
            tails.add(right)
            chosen.append((left, right))
            if len(chosen) == most:
                break
    return chosen


def replace(sequence: list[int], rules: dict[tuple[int, int], int]) -> list[int]:
    out: list[int] = []
    place = 0
    while place < len(sequence):
        symbol = rules.get(tuple(sequence[place:place + 2]))
        out.append(sequence[place] if symbol is None else symbol)
        place += 1 if symbol is None else 2
    return out
