"""Bin completion over a histogram of sizes: best-fit decreasing as incumbent, undominated fillings, waste bounds."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np

#: Times that a pattern is applied, and its sizes.
Patterns = list[tuple[int, list[int]]]
#: Steps of a path after which its rest is also finished by best-fit decreasing, and sets looked at for each branch.
FINISH, TRIES = 20, 4


def best_fit_decreasing(counts: np.ndarray, capacity: int) -> Patterns:
    """Each item, the largest first, in the fullest bin that it fits in; bins that are filled alike are one pattern."""
    # free space -> [times, sizes] of the open bins with that space
    open_bins: dict[int, list[list]] = {}
    for size in range(capacity, 0, -1):
        left, new = int(counts[size]), {}
        for free in sorted(f for f in open_bins if f >= size):
            groups, open_bins[free] = open_bins[free], []
            for group in groups:
                per = min(free // size, left)
                times = min(group[0], left // per) if per else 0
                if times:
                    new.setdefault(free - per * size, []).append([times, group[1] + [size] * per])
                    left -= times * per
                    group[0] -= times
                if group[0] and 0 < left < free // size:  # the last bin takes what is left
                    new.setdefault(free - left * size, []).append([1, group[1] + [size] * left])
                    group[0], left = group[0] - 1, 0
                if group[0]:
                    open_bins[free].append(group)
            if not open_bins[free]:
                del open_bins[free]
            if not left:
                break
        per = capacity // size
        for times, n in ((left // per, per), (1, left % per)):
            if times and n:
                new.setdefault(capacity - n * size, []).append([times, [size] * n])
        for free, groups in new.items():
            open_bins.setdefault(free, []).extend(groups)
    return [(times, sizes) for groups in open_bins.values() for times, sizes in groups]


def least_bins(counts: np.ndarray, capacity: int) -> int:
    """No packing needs fewer: the volume, and for every limit k the bins that the sizes above capacity - k and above the
    half need, with the volume of those from k to the half beside them."""
    number, volume = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * np.arange(len(counts)))])
    half = capacity // 2
    k = np.arange(1, half + 1)
    middle_n, middle_v = number[capacity - k + 1] - number[half + 1], volume[capacity - k + 1] - volume[half + 1]
    beside = volume[half + 1] - volume[k] - (middle_n * capacity - middle_v)
    return max(-(-int(volume[-1]) // capacity), int(number[-1] - number[half + 1]) + max(0, -(-int(beside.max(initial=0)) // capacity)))


class Remaining:
    """Counts of the sizes still to pack, and the fillings they give."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.counts, self.capacity = counts, capacity

    def take(self, filling: list[int], times: int) -> Remaining:
        counts = self.counts.copy()
        np.subtract.at(counts, filling, times)
        return Remaining(counts, self.capacity)

    def times(self, filling: list[int]) -> int:
        """How often the counts allow a filling."""
        return min(int(self.counts[s]) // n for s, n in Counter(filling).items())

    def fillings(self, width: int) -> list[list[int]]:
        """At most ``width`` undominated sets that complete a bin which the largest size opens, the fullest first; of
        equal sums the one whose smallest size is largest: what is small is left for later bins."""
        largest = int(np.flatnonzero(self.counts)[-1])
        free = self.capacity - largest
        counts = self.counts[: free + 1].tolist()
        if largest <= free:
            counts[largest] -= 1
        sizes = [s for s in range(free, 0, -1) if counts[s]]
        if not sizes:
            return [[largest]]
        # reach[i]: bit t is set if some of the i largest sizes that fit sum to t
        reach, now, mask = [1], 1, (1 << free + 1) - 1
        for s in sizes:
            n, step = min(counts[s], free // s), 1
            while n:
                step = min(step, n)
                now |= now << step * s & mask
                n, step = n - step, step * 2
            reach.append(now)
        out: list[list[int]] = []
        total, tries = now.bit_length() - 1, 0
        while total > 0 and len(out) < width and tries < TRIES * width:
            for of_sum, chosen in enumerate(self._sets(total, sizes, counts, reach)):
                tries += 1
                if not self._dominated(chosen, free - total, counts):
                    out.append([largest, *chosen])
                if of_sum > width or len(out) >= width or tries >= TRIES * width:
                    break
            total = (now & (1 << total) - 1).bit_length() - 1
        return out or [[largest]]

    def _sets(self, total: int, sizes: list[int], counts: list[int], reach: list[int]) -> Iterator[list[int]]:
        """The sets that sum to ``total``, those of the largest smallest size first; every step taken can be completed,
        as the sums of the larger sizes are known."""
        todo: list[tuple[int, int, list[int]]] = [(total, len(sizes), [])]
        while todo:
            total, upto, chosen = todo.pop()
            if not total:
                yield chosen
                continue
            # the fewest largest sizes that reach the total end with the set's smallest size
            i = bisect_left(reach, True, 1, upto + 1, key=lambda x: bool(x >> total & 1))
            branches = []
            while i <= upto and len(branches) < 3:
                s = sizes[i - 1]
                if s <= total:
                    branches += [(total - m * s, i - 1, [*chosen, *[s] * m]) for m in range(1, min(counts[s], total // s) + 1) if reach[i - 1] >> total - m * s & 1]
                i += 1
            todo += reversed(branches)

    def _dominated(self, chosen: list[int], waste: int, counts: list[int]) -> bool:
        """Whether some of the set can make room for one left-out item that is as large as they are, or larger by the
        waste at most: whatever the set can do, that item's set can do too."""
        used = Counter(chosen)
        some, single, several = 1, 0, 0
        for s in chosen:
            several |= (some & ~1) << s
            some |= some << s
            single |= 1 << s
        wider, more = single, several
        for _ in range(waste):
            wider, more = wider << 1 | single, more << 1 | several
        worse = more | wider & ~single
        while worse:
            s = worse.bit_length() - 1
            if s < len(counts) and counts[s] > used[s]:
                return True
            worse ^= 1 << s
        return False


def pack_histogram(counts: np.ndarray, capacity: int, nodes: int = 2500, width: int = 3) -> Patterns:
    """Patterns (times, sizes) that pack counts[s] items of each size s into few bins, never more than best-fit
    decreasing needs.

    Branch and bound: the largest size left opens a bin, its undominated fillings are the branches, and a filling is
    applied as often as the counts allow, so the work depends on the number of sizes, not of items. Best-fit decreasing
    is the first incumbent. A node is pruned once its bins and the lower bound of what is left cannot beat the incumbent;
    every FINISH steps the rest is also finished by best-fit decreasing. Paths are taken by how
    many of their choices are not the first, the deepest branch first, and the search ends with the lower bound or after
    ``nodes`` nodes.
    """
    bound = least_bins(counts, capacity)
    best = best_fit_decreasing(counts, capacity)
    need, seen = sum(t for t, _ in best), 0
    layer: list[tuple[Remaining, Patterns, int]] = [(Remaining(counts.astype(np.int64), capacity), [], 0)]
    while layer and need > bound and seen < nodes:
        later: list[tuple[Remaining, Patterns, int]] = []
        while layer and need > bound and seen < nodes:
            at, path, used = layer.pop()
            while seen < nodes and used + least_bins(at.counts, capacity) < need:
                if not at.counts.any():
                    best, need = path, used
                    break
                seen += 1
                if len(path) % FINISH == 0:
                    rest = best_fit_decreasing(at.counts, capacity)
                    if used + sum(t for t, _ in rest) < need:
                        best, need = path + rest, used + sum(t for t, _ in rest)
                first, *others = at.fillings(width)
                later += [(at.take(f, t := at.times(f)), [*path, (t, f)], used + t) for f in reversed(others)]
                t = at.times(first)
                at, path, used = at.take(first, t), [*path, (t, first)], used + t
        layer = later
    return best
