"""Quotas of a stratified sample: how many of each leaf of the strata tree.

Only the tree of counts is here, so it is plain Python on the driver, with the
order of floating-point operations that the quotas are defined by.
"""

from __future__ import annotations

import math
import random
from array import array
from collections.abc import Mapping, Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class Leaf:
    path: tuple[str, ...]
    size: int
    target: int

    @property
    def name(self) -> str:
        return "/".join(self.path) or "ALL"

    @property
    def chosen(self) -> int:
        return min(self.target, self.size)


def round_target(value: float, mode: str | None) -> int:
    """CEIL, ROUND (half to even) or else FLOOR; never below 0."""
    how = {"CEIL": math.ceil, "ROUND": round}.get((mode or "FLOOR").upper(), math.floor)
    return max(0, int(how(value)))


def bucket_target(bucket: str, mix: Mapping[str, float], total: int, mode: str | None, unmixed: int = 1) -> int:
    """The whole total without a mix; else the bucket's fraction of it.

    A bucket that the mix does not name has an equal fraction of what the mix
    leaves: the fraction is divided out before the total is multiplied, which
    in floating point is not the same as dividing the product.
    """
    if not mix:
        return total
    fraction = mix.get(bucket)
    if fraction is None:
        fraction = max(0.0, 1.0 - sum(mix.values())) / max(unmixed, 1)
    return round_target(total * fraction, mode)


def leaves(counts: Mapping[tuple[str, ...], int], mixes: Sequence[Mapping[str, float]], target: int, mode: str | None) -> list[Leaf]:
    """Every leaf that has candidates, by sorted buckets level by level, with its target.

    counts: candidates by path, one bucket a level; mixes: a mix for each level.
    """
    if not counts:
        return [Leaf((), 0, target)]

    def walk(paths: list[tuple[str, ...]], level: int, share: int) -> list[Leaf]:
        if level == len(mixes):
            return [Leaf(p, counts[p], share) for p in paths]
        buckets: dict[str, list[tuple[str, ...]]] = {}
        for p in paths:
            buckets.setdefault(p[level], []).append(p)
        mix = mixes[level]
        unmixed = sum(b not in mix for b in buckets)
        out = []
        for b in sorted(buckets):
            out += walk(buckets[b], level + 1, bucket_target(b, mix, share, mode, unmixed))
        return out

    return walk(list(counts), 0, target)


def systematic(size: int, n: int, rng: random.Random) -> tuple[int, int] | None:
    """Step and 1-based offset of every step-th place; None if all or none are taken, which draws nothing."""
    if n <= 0 or n >= size:
        return None
    step = max(1, size // n)
    return step, rng.randint(1, step)


def shuffled(size: int, n: int, rng: random.Random) -> list[int]:
    """The first n places of a shuffle of all; the same places as shuffling the rows themselves.

    A seed defines its draw by a whole permutation, so eight bytes a candidate
    of the leaf are held on the driver; draws by hash hold nothing.
    """
    if n <= 0 or size <= 0:
        return []
    places = array("q", range(size))
    rng.shuffle(places)
    return places[:n].tolist()
