"""A minimal acyclic transducer from byte strings to numbers, as flat arrays that can be memory-mapped.

States are numbered from 0, the root; equal suffixes share their states. The output of an edge is the number of words
that sort before all words through it, so the outputs along a word's path sum to its rank among the words.
"""

from __future__ import annotations

import numpy as np

_MAGIC = 0x4D414654


def compile_words(words: list[bytes]) -> bytes:
    """words: sorted, distinct, not empty. The state after a word's last byte is final."""
    register: dict[tuple, int] = {}
    finals: list[bool] = [False]
    edges: list[list[list[int]]] = [[]]  # per open or registered state: [byte, target]
    path = [0]
    free: list[int] = []

    def settle(depth: int) -> None:
        """Share the open states below `depth` with equal ones seen before."""
        while len(path) > depth + 1:
            child = path.pop()
            sign = (finals[child], tuple(map(tuple, edges[child])))
            known = register.setdefault(sign, child)
            if known != child:
                edges[path[-1]][-1][1] = known
                free.append(child)

    before = b""
    for word in words:
        if word <= before:
            raise ValueError("words must be sorted, distinct and not empty")
        same = next((i for i, (x, y) in enumerate(zip(word, before, strict=False)) if x != y), min(len(word), len(before)))
        settle(same)
        for byte in word[same:]:
            if free:
                state = free.pop()
                finals[state], edges[state] = False, []
            else:
                state = len(edges)
                finals.append(False)
                edges.append([])
            edges[path[-1]].append([byte, state])
            path.append(state)
        finals[path[-1]] = True
        before = word
    settle(0)

    return _packed(edges, finals)


def _packed(edges: list, finals: list) -> bytes:
    live, at = {0: 0}, [0]
    while at:
        state = at.pop()
        for _, target in edges[state]:
            if target not in live:
                live[target] = len(live)
                at.append(target)
    below: dict[int, int] = {}

    def words_below(root: int) -> None:
        todo = [root]
        while todo:
            state = todo[-1]
            missing = [t for _, t in edges[state] if t not in below]
            if missing:
                todo.extend(missing)
                continue
            below[state] = finals[state] + sum(below[t] for _, t in edges[state])
            todo.pop()

    words_below(0)
    rows = []
    for state, number in live.items():
        passed = int(finals[state])
        for byte, target in sorted(edges[state]):
            rows.append((number * 256 + byte, live[target], passed))
            passed += below[target]
    rows.sort()
    codes, targets, outputs = (np.array([r[k] for r in rows], dtype=np.int64) for k in range(3))
    final = np.zeros(len(live), dtype=np.int64)
    for state, number in live.items():
        final[number] = finals[state]
    head = np.array([_MAGIC, len(rows), len(live)], dtype=np.int64)
    return b"".join(a.tobytes() for a in (head, codes, targets, outputs, final))


class Lexicon:
    """Reads the arrays out of any buffer, such as a memory map."""

    def __init__(self, buffer):
        head = np.frombuffer(buffer, np.int64, 3)
        if head[0] != _MAGIC:
            raise ValueError("not a lexicon")
        n, states = int(head[1]), int(head[2])
        flat = np.frombuffer(buffer, np.int64, 3 * n + states, 24)
        self.codes, self.targets, self.outputs, self.final = flat[:n], flat[n : 2 * n], flat[2 * n : 3 * n], flat[3 * n :]

    @property
    def states(self) -> int:
        return len(self.final)

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word, -1 for a word that isn't in the lexicon; all words advance a byte at a time."""
        rank = np.full(len(words), -1, dtype=np.int64)
        if not len(self.codes) or not words:
            return rank
        length = np.array([len(w) for w in words])
        start = np.cumsum(length) - length
        flat = np.frombuffer(b"".join(words), np.uint8)
        live = np.flatnonzero(length)
        state, total, step = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64), 0
        while len(live):
            code = state * 256 + flat[start[live] + step]
            edge = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            there = self.codes[edge] == code
            live, edge = live[there], edge[there]
            state, total = self.targets[edge], total[there] + self.outputs[edge]
            step += 1
            ends = length[live] == step
            good = ends & (self.final[state] == 1)
            rank[live[good]] = total[good]
            live, state, total = live[~ends], state[~ends], total[~ends]
        return rank
