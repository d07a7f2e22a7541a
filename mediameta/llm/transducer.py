"""A minimal acyclic transducer over a sorted vocabulary: each term's path emits its lexicographic ordinal."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


class Transducer:
    """Arcs sorted by (state, byte); an arc emits how many terms of its state come before it.

    The sum along a term's path is the term's rank among all terms in byte order. States that accept the same endings are
    one state, so the automaton is the smallest one for its terms. State 0 is the root.
    """

    def __init__(self, arcs: np.ndarray, target: np.ndarray, output: np.ndarray, final: np.ndarray):
        # arcs: state * 256 + byte, ascending.
        self.arcs, self.target, self.output, self.final = arcs, target, output, final

    @classmethod
    def build(cls, terms: Iterable[bytes]) -> Transducer:
        """From distinct terms in ascending byte order; keeps only the last term's path unfinished."""
        register: dict[tuple, int] = {}
        finals: list[bool] = []
        edges: list[tuple] = []
        ways: list[int] = []

        def settle(node: list) -> int:
            # A node is [final, arcs as (byte, state)]; equal nodes get one state.
            key = (node[0], tuple(node[1]))
            state = register.get(key)
            if state is None:
                state = register[key] = len(finals)
                finals.append(node[0])
                edges.append(key[1])
                ways.append(node[0] + sum(ways[t] for _, t in key[1]))
            return state

        path: list[list] = [[False, []]]
        last = b""
        for term in terms:
            same, most = 0, min(len(last), len(term))
            while same < most and last[same] == term[same]:
                same += 1
            for depth in range(len(last), same, -1):
                path[depth - 1][1].append((last[depth - 1], settle(path.pop())))
            path.extend([False, []] for _ in range(len(term) - same))
            path[-1][0] = True
            last = term
        for depth in range(len(last), 0, -1):
            path[depth - 1][1].append((last[depth - 1], settle(path.pop())))
        settle(path[0])
        # The root was settled last; counted from the end it is state 0.
        count = len(finals)
        arcs, target, output = [], [], []
        for state in range(count - 1, -1, -1):
            before = int(finals[state])
            for byte, to in edges[state]:
                arcs.append((count - 1 - state) * 256 + byte)
                target.append(count - 1 - to)
                output.append(before)
                before += ways[to]
        return cls(
            np.array(arcs, np.int64), np.array(target, np.int64), np.array(output, np.int64), np.array(finals[::-1], bool)
        )

    def __len__(self) -> int:
        """Number of terms."""
        if not len(self.arcs):
            return int(self.final.sum())
        ways = np.zeros(len(self.final), np.int64)
        state = self.arcs >> 8
        bounds = np.searchsorted(state, np.arange(len(self.final) + 1))
        # Targets have larger numbers than sources, so one pass from the end counts the endings.
        for s in range(len(self.final) - 1, -1, -1):
            ways[s] = self.final[s] + ways[self.target[bounds[s] : bounds[s + 1]]].sum()
        return int(ways[0])

    def pack(self) -> bytes:
        head = np.array([len(self.arcs), len(self.final)], np.int64)
        parts = (head, self.arcs, self.target.astype(np.int32), self.output.astype(np.int32), self.final.astype(np.uint8))
        return b"".join(p.tobytes() for p in parts)

    @classmethod
    def unpack(cls, data: bytes) -> Transducer:
        arcs, states = np.frombuffer(data, np.int64, 2)
        at = 16
        out = []
        for kind, n in ((np.int64, arcs), (np.int32, arcs), (np.int32, arcs), (np.uint8, states)):
            out.append(np.frombuffer(data, kind, n, at))
            at += out[-1].nbytes
        return cls(out[0], out[1].astype(np.int64), out[2].astype(np.int64), out[3].astype(bool))

    def ordinals(self, text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The ordinal of each stretch of ``text`` (bytes), -1 where it is no term. All stretches advance together."""
        found = np.full(len(starts), -1, np.int64)
        if not len(self.arcs):
            found[(lengths == 0) & bool(self.final[0])] = 0
            return found
        live = np.arange(len(starts))
        state = np.zeros(len(starts), np.int64)
        total = np.zeros(len(starts), np.int64)
        step = 0
        last = len(self.arcs) - 1
        while len(live):
            ended = lengths[live] == step
            if ended.any():
                done = ended & self.final[state]
                found[live[done]] = total[done]
                live, state, total = live[~ended], state[~ended], total[~ended]
                if not len(live):
                    break
            key = state * 256 + text[starts[live] + step]
            at = np.minimum(np.searchsorted(self.arcs, key), last)
            hit = self.arcs[at] == key
            at = at[hit]
            live, state, total = live[hit], self.target[at], total[hit] + self.output[at]
            step += 1
        return found

    def term(self, ordinal: int) -> bytes:
        """The term of an ordinal: at each state the last arc that emits no more than what is left."""
        if not 0 <= ordinal:
            raise IndexError(ordinal)
        state, out = 0, bytearray()
        while True:
            if self.final[state] and ordinal == 0:
                return bytes(out)
            first, end = np.searchsorted(self.arcs, (state * 256, state * 256 + 256))
            at = first + np.searchsorted(self.output[first:end], ordinal, side="right") - 1
            if at < first:
                raise IndexError("no such ordinal")
            out.append(int(self.arcs[at]) & 255)
            ordinal -= int(self.output[at])
            state = int(self.target[at])
