"""Suffix automaton over several sequences of words, and matching statistics against it."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Iterator, Sequence


class SuffixAutomaton:
    """All substrings of the sequences added so far; each state has the least label of the sequences in which its substrings end."""

    def __init__(self) -> None:
        self.next: list[dict[Hashable, int]] = [{}]
        self.link, self.length, self.least = [-1], [0], [None]
        self.settled = True

    def _state(self, edges: dict, link: int, length: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.least.append(None)
        return len(self.length) - 1

    def _split(self, p: int, q: int, word: Hashable) -> int:
        """The state for the longest of q's substrings that p and ``word`` make."""
        if self.length[p] + 1 == self.length[q]:
            return q
        copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: Hashable) -> int:
        if (q := self.next[last].get(word)) is not None:
            return self._split(last, q, word)
        new, p = self._state({}, 0, self.length[last] + 1), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][word], word)
        return new

    def add(self, words: Iterable[Hashable], label: int) -> None:
        last, least = 0, self.least
        for word in words:
            last = self._extend(last, word)
            if least[last] is None or label < least[last]:
                least[last] = label
        self.settled = False

    def settle(self) -> None:
        """Carry labels from longer substrings to their suffixes."""
        least = self.least
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            p = self.link[s]
            if p > 0 and (least[p] is None or least[s] < least[p]):
                least[p] = least[s]
        self.settled = True

    def windows(self, words: Sequence[Hashable], width: int) -> Iterator[int | None]:
        """For each window of ``width`` words, the least label of a sequence that has it; None if there is none.

        Matching statistics: the longest suffix that stands in the automaton, cut to the window."""
        if not self.settled:
            self.settle()
        state, length = 0, 0
        next_, link, longest, least = self.next, self.link, self.length, self.least
        for i, word in enumerate(words):
            while state and word not in next_[state]:
                state = link[state]
                length = longest[state]
            if (to := next_[state].get(word)) is not None:
                state, length = to, length + 1
            while state and longest[link[state]] >= width:
                state = link[state]
                length = longest[state]
            if i + 1 >= width:
                yield least[state] if length >= width else None
