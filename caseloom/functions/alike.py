"""Strings alike in trigrams, between two lists of a bounded size, with numpy inside one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

COMMON = 32  # a trigram that more than one in so many strings hold is common


def trigram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(string, code) of the distinct trigrams of each string, as functions.text.trigrams has them, in order."""
    joined = "".join(f"  {t} " for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    grams = points[:-2] | points[1:-1] << 21 | points[2:] << 42 if len(points) else points
    many = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), many)
    grams = grams[np.arange(len(owner)) + 2 * owner]  # the last two places of a string reach into the next
    order = np.lexsort((grams, owner))
    owner, grams = owner[order], grams[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (grams[1:] != grams[:-1])
    return owner[new], grams[new]


def alike(asked: list[str], held: list[str], threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """(i, places in held of the strings with a Jaccard similarity of at least threshold to asked[i]).

    Strings are counted by the trigrams they share, rare ones through lists. A string of n trigrams shares at least
    n * threshold with one alike to it; where fewer of its trigrams are common, one alike to it shares a rare one, so the
    common ones are looked up for those only.
    """
    if not held:
        return
    owner, gram = trigram_codes(held)
    sizes = np.bincount(owner, minlength=len(held))
    order = np.argsort(gram, kind="stable")
    known, first = np.unique(gram[order], return_index=True)
    first, holders = np.append(first, len(gram)), owner[order]
    often = np.diff(first) * COMMON > len(held)
    rows = {int(k): np.isin(np.arange(len(held)), holders[first[k]:first[k + 1]]) for k in np.flatnonzero(often)}
    who, what = trigram_codes(asked)
    ends = np.searchsorted(who, np.arange(len(asked) + 1))
    shared = np.zeros(len(held), np.int64)
    for i in range(len(asked)):
        mine = what[ends[i]:ends[i + 1]]
        n = len(mine)
        at = np.searchsorted(known, mine)
        at = at[(at < len(known)) & (known[np.minimum(at, len(known) - 1)] == mine)]
        common = at[often[at]]
        for k in at[~often[at]]:
            shared[holders[first[k]:first[k + 1]]] += 1
        near = np.flatnonzero(shared) if len(common) < n * threshold - 1e-9 else np.arange(len(held))
        both = shared[near]
        shared[near] = 0
        for k in common:
            both += rows[int(k)][near]
        yield i, near[both / (sizes[near] + n - both) >= threshold]
