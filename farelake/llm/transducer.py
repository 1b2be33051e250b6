"""Minimal acyclic transducer: sorted byte strings to their ordinals.

Built from strings in ascending byte order, one at a time: what the next string cannot
change any more is frozen, and equal frozen states become one. Every move carries how
many strings come before those behind it, so the sum along a string's path is its
ordinal. Looking up steps all strings at once through sorted arrays of moves.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

_FIELDS = ("keys", "targets", "outputs", "final")


class Transducer:
    """keys: state * 256 + byte of every move, ascending; targets and outputs of the moves;
    final: states where a string may end. State 0 is the first."""

    def __init__(self, keys: np.ndarray, targets: np.ndarray, outputs: np.ndarray, final: np.ndarray):
        self.keys, self.targets, self.outputs, self.final = keys, targets, outputs, final

    @classmethod
    def build(cls, strings: Iterable[bytes]) -> Transducer:
        known: dict[tuple, int] = {}
        frozen: list[tuple] = []  # (final, ((byte, state), ...)) of each state
        counts: list[int] = []  # strings behind each state
        path: list[list] = [[False, []]]  # open states of the last string: final, moves
        before = b""

        def freeze(down_to: int) -> None:
            while len(path) > down_to + 1:
                final, moves = path.pop()
                state = (final, tuple(moves))
                number = known.get(state)
                if number is None:
                    number = known[state] = len(frozen)
                    frozen.append(state)
                    counts.append(final + sum(counts[s] for _, s in moves))
                path[-1][1].append((before[len(path) - 1], number))

        for string in strings:
            same = 0
            for a, b in zip(before, string, strict=False):
                if a != b:
                    break
                same += 1
            if same == len(string) and (string or path[0][0]) or string < before:
                raise ValueError("strings must be distinct and ascending")
            freeze(same)
            path.extend([False, []] for _ in string[same:])
            path[-1][0] = True
            before = string
        freeze(0)
        frozen.append((path[0][0], tuple(path[0][1])))
        # The first state gets number 0, the others follow in the order of freezing.
        last = len(frozen) - 1
        order = [last, *range(last)]
        number = {old: new for new, old in enumerate(order)}
        keys, targets, outputs, final = [], [], [], []
        for new, old in enumerate(order):
            ends, moves = frozen[old]
            final.append(ends)
            passed = int(ends)
            for byte, target in moves:
                keys.append(new << 8 | byte)
                targets.append(number[target])
                outputs.append(passed)
                passed += counts[target]
        return cls(np.array(keys, np.int64), np.array(targets, np.int64), np.array(outputs, np.int64), np.array(final, bool))

    def ordinals(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ordinal of every string raw[start:end]; -1 where it is not one of them."""
        out = np.full(len(starts), -1, np.int64)
        at, of = starts.astype(np.int64), np.arange(len(starts))
        state, total = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        while len(of):
            done = at == ends[of]
            accepted = done & self.final[state]
            out[of[accepted]] = total[accepted]
            at, of, state, total = (x[~done] for x in (at, of, state, total))
            if not len(of) or not len(self.keys):
                break
            key = state << 8 | raw[at]
            move = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[move] == key
            move = move[hit]
            at, of, state, total = at[hit] + 1, of[hit], self.targets[move], total[hit] + self.outputs[move]
        return out

    def string(self, ordinal: int) -> bytes:
        """The string of an ordinal."""
        state, out = 0, bytearray()
        while True:
            if self.final[state] and ordinal == 0:
                return bytes(out)
            a, b = np.searchsorted(self.keys, [state << 8, (state + 1) << 8])
            move = a + int(np.searchsorted(self.outputs[a:b], ordinal, "right")) - 1
            if move < a:
                raise IndexError("no such ordinal")
            ordinal -= int(self.outputs[move])
            out.append(int(self.keys[move]) & 0xFF)
            state = int(self.targets[move])

    def __len__(self) -> int:
        return len(self.final)

    def to_bytes(self) -> bytes:
        parts = [np.ascontiguousarray(getattr(self, f)).tobytes() for f in _FIELDS]
        return np.array([len(self.keys), len(self.final)], "<i8").tobytes() + b"".join(parts)

    @classmethod
    def from_bytes(cls, blob: bytes) -> Transducer:
        n, states = np.frombuffer(blob, "<i8", 2).tolist()
        keys, targets, outputs = (np.frombuffer(blob, "<i8", n, 16 + 8 * n * i) for i in range(3))
        return cls(keys, targets, outputs, np.frombuffer(blob, bool, states, 16 + 24 * n))
