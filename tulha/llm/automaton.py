"""Levenshtein automata intersected with a lexicon trie, determinised while words are read."""

from __future__ import annotations

#: Edits allowed in terms of at least so many letters: shorter terms must match exactly.
EDITS = ((9, 2), (5, 1))
#: Members of the kept states, after which they are forgotten and built anew; a lexicon of many terms has large states.
KEPT_MEMBERS = 2_000_000


def edits_allowed(term: str) -> int:
    return next((k for length, k in EDITS if len(term) >= length), 0)


class LexiconAutomaton:
    """Finds the lexicon term nearest to a word, within the edits its length allows.

    A state is the set of (trie node, edits, awaited letter) that the letters
    read so far can have reached; substitutions, insertions, deletions and
    swapped neighbours are one edit each. States and their successors are kept,
    so a word costs one look-up per letter until no term is in reach.
    """

    def __init__(self, terms: dict[str, int]) -> None:
        """terms: most edits of each."""
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.limit: list[int] = [0]
        for word, edits in sorted(terms.items()):
            node = 0
            self.limit[0] = max(self.limit[0], edits)
            for letter in word:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.limit.append(0)
                node = self.children[node][letter]
                self.limit[node] = max(self.limit[node], edits)
            self.term[node] = word
        self.edits = dict(terms)
        self._forget()

    def _forget(self) -> None:
        self.members = 0
        self.numbers: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.found: list[tuple[str, int] | None] = []
        self.start = self._number({(0, 0, "")}) if self.edits else -1

    def _number(self, states: set[tuple[int, int, str]]) -> int:
        """The state's number; -1 for the empty one. Deletions are followed here."""
        todo = [s for s in states if not s[2]]
        while todo:
            node, edits, _ = todo.pop()
            for child in self.children[node].values():
                new = (child, edits + 1, "")
                if edits < self.limit[child] and new not in states:
                    states.add(new)
                    todo.append(new)
        key = frozenset(states)
        if not key:
            return -1
        if key not in self.numbers:
            self.members += len(key)
            self.numbers[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            ends = [(e, self.term[n]) for n, e, wait in key if not wait and self.term[n] is not None and e <= self.edits[self.term[n]]]
            best = min(ends, default=None)
            self.found.append((best[1], best[0]) if best else None)
        return self.numbers[key]

    def _step(self, state: int, letter: str) -> int:
        reached: set[tuple[int, int, str]] = set()
        for node, edits, wait in self.sets[state]:
            if wait:
                if letter == wait:
                    reached.add((node, edits, ""))
                continue
            for own, child in self.children[node].items():
                if own == letter:
                    reached.add((child, edits, ""))
                elif edits < self.limit[child]:
                    reached.add((child, edits + 1, ""))
                    swapped = self.children[child].get(letter)
                    if swapped is not None and edits < self.limit[swapped]:
                        reached.add((swapped, edits + 1, own))
            if edits < self.limit[node]:
                reached.add((node, edits + 1, ""))
        after = self._number(reached)
        self.steps[state][letter] = after
        return after

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its edits."""
        if self.members > KEPT_MEMBERS:
            self._forget()
        state = self.start
        if state < 0:
            return None
        for letter in word:
            after = self.steps[state].get(letter)
            state = self._step(state, letter) if after is None else after
            if state < 0:
                return None
        return self.found[state]
