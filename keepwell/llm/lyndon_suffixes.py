"""Suffix arrays by grouping suffixes, in two linear passes and without recursion.

The first pass groups the suffixes by their Lyndon prefix (the longest prefix that
is a Lyndon word). It starts from groups of equal first symbols and settles one
group at a time, from the highest down. Every member of a settled group extends
the context of one suffix to its left: the nearest that lies in a group still
open, found over pointers that skip what is settled. Those suffixes move to new
groups just above their old ones, the higher the more often they were met. The
second pass reads the order itself off the groups: from each placed suffix the
pointers lead to the suffixes that come next in their own groups.
"""

from __future__ import annotations


def suffix_array(values: list[int]) -> list[int]:
    """Starts of all suffixes of ``values`` in ascending order; a suffix that is a
    prefix of another comes first."""
    n = len(values)
    if not n:
        return []
    bucket, group = _first_groups(values)
    left, settled = _lyndon_groups(bucket, group, n)
    return _ordered(settled, left, n)


def _first_groups(values: list[int]) -> tuple[list[list[int]], list[int]]:
    """Members per group in ascending order of their symbol, and each place's
    group. Places count from 1, 0 is open for ever; place n + 1 is the end, below all."""
    name = {v: k for k, v in enumerate(sorted(set(values)), 1)}
    group = [0, *[name[v] for v in values], 0]
    bucket: list[list[int]] = [[] for _ in range(len(name) + 1)]
    for place in range(1, len(group)):
        bucket[group[place]].append(place)
    return bucket, group


def _lyndon_groups(bucket: list[list[int]], group: list[int],
                   n: int) -> tuple[list[int], list[list[int]]]:
    """The pointer of every place to its previous smaller suffix, and the settled
    groups in descending order. ``bucket`` and ``group`` are used up."""
    below = list(range(-1, len(bucket) - 1))
    above = list(range(1, len(bucket) + 1))
    left = [0, *range(n + 1)]
    is_settled = bytearray(n + 2)
    settled = []
    now = len(bucket) - 1
    while now >= 0:
        members = [place for place in bucket[now] if group[place] == now]
        bucket[now] = []
        if members:
            settled.append(members)
            for place in members:
                is_settled[place] = 1
            met: dict[int, int] = {}
            for place in members:
                to = left[place]
                while is_settled[to]:
                    to = left[to]
                left[place] = to
                met[to] = met.get(to, 0) + 1
            met.pop(0, None)
            for level in _by_times(met):
                moved: dict[int, int] = {}
                for place in level:
                    old = group[place]
                    new = moved.get(old)
                    if new is None:
                        new = moved[old] = len(bucket)
                        bucket.append([])
                        below.append(old)
                        above.append(above[old])
                        below[above[old]] = new
                        above[old] = new
                    group[place] = new
                    bucket[new].append(place)
        now = below[now]
    return left, settled


def _by_times(met: dict[int, int]) -> list[list[int]]:
    """The places met, most often met first."""
    if not met:
        return []
    most = max(met.values())
    if most == 1:
        return [list(met)]
    levels: dict[int, list[int]] = {}
    for place, times in met.items():
        levels.setdefault(times, []).append(place)
    return [levels[times] for times in sorted(levels, reverse=True)]


def _ordered(settled: list[list[int]], left: list[int], n: int) -> list[int]:
    next_slot, slot = [0] * (n + 2), 0
    group = [0] * (n + 2)
    for k, members in enumerate(reversed(settled)):
        next_slot[k] = slot
        slot += len(members)
        for place in members:
            group[place] = k
    order = [0] * (n + 1)
    placed = bytearray(n + 2)
    placed[0] = placed[n + 1] = 1
    order[0] = n + 1
    for k in range(n + 1):
        place = order[k] - 1
        while not placed[place]:
            placed[place] = 1
            own = group[place]
            order[next_slot[own]] = place
            next_slot[own] += 1
            place = left[place]
    return [place - 1 for place in order[1:]]
