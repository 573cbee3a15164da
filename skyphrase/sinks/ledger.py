"""The set of ids that a run has settled, as intervals: a few numbers, however many ids there are."""

from __future__ import annotations

from collections.abc import Iterable, Iterator


class Ledger:
    """Half-open intervals [low, high), sorted, none touching another."""

    def __init__(self, intervals: Iterable[Iterable[int]] = ()):
        self.intervals: list[list[int]] = []
        for low, high in sorted([int(a), int(b)] for a, b in intervals):
            if low >= high:
                continue
            if self.intervals and low <= self.intervals[-1][1]:
                self.intervals[-1][1] = max(self.intervals[-1][1], high)
            else:
                self.intervals.append([low, high])

    def __eq__(self, other) -> bool:
        return isinstance(other, Ledger) and self.intervals == other.intervals

    def __hash__(self) -> int:
        return hash(str(self.intervals))

    def __len__(self) -> int:
        return sum(b - a for a, b in self.intervals)

    def __contains__(self, k: int) -> bool:
        return any(a <= k < b for a, b in self.intervals)

    def plus(self, more: Iterable[Iterable[int]]) -> Ledger:
        return Ledger([*self.intervals, *more])

    def missing(self, count: int) -> Ledger:
        """What the ids 0 to count - 1 have beyond these."""
        at, out = 0, []
        for a, b in self.intervals:
            if a >= count:
                break
            out.append([at, min(a, count)])
            at = max(at, b)
        return Ledger([*out, [at, count]])

    def cut(self, size: int) -> Iterator[Ledger]:
        """The parts that lie between multiples of ``size``; where a part ends doesn't depend on the other ids."""
        held: list[list[int]] = []
        for a, b in self.intervals:
            while a < b:
                if held and held[0][0] // size != a // size:
                    yield Ledger(held)
                    held = []
                end = min(b, (a // size + 1) * size)
                held.append([a, end])
                a = end
        if held:
            yield Ledger(held)
