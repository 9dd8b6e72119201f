"""A minimal acyclic transducer from byte strings to sequences of ids.

Built from sorted keys in one pass: the path of the last key is kept open, and each
state that can't change any more is replaced by an equal one that was stored before,
so equal suffixes with equal outputs are stored once. Outputs move towards the root as
far as the keys that share a prefix allow.

The compiled form is one flat buffer of arrays. It is read in place: ``open`` maps a
file, ``from_bytes`` an anonymous mapping filled from bytes that came over the network
(executors share no folder with the driver).
"""

from __future__ import annotations

import mmap
import struct
from array import array
from collections.abc import Iterable

import numpy as np

_MAGIC = b"SKTD"
_NONE = 0xFFFFFFFF


class _State:
    __slots__ = ("arcs", "final", "out")

    def __init__(self) -> None:
        self.arcs: list[list] = []  # [label, target, output]
        self.final = False
        self.out: tuple[int, ...] = ()


def _shared(a, b) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def compile_transducer(entries: Iterable[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """entries: (key, ids); of equal keys the first counts. Any order."""
    stored: dict[tuple, int] = {}
    states: list[tuple] = []

    def store(s: _State) -> int:
        form = (s.final, s.out, tuple((a[0], a[1], a[2]) for a in s.arcs))
        found = stored.get(form)
        if found is None:
            found = stored[form] = len(states)
            states.append(form)
        return found

    path, last = [_State()], None
    for key, ids in sorted(entries, key=lambda e: e[0]):
        if key == last:
            continue
        common = _shared(key, last or b"")
        for k in range(len(last or b""), common, -1):
            path[k - 1].arcs[-1][1] = store(path[k])
        del path[common + 1 :]
        out = tuple(ids)
        for k in range(1, common + 1):
            arc = path[k - 1].arcs[-1]
            n = _shared(arc[2], out)
            if rest := arc[2][n:]:
                arc[2] = arc[2][:n]
                for a in path[k].arcs:
                    a[2] = rest + a[2]
                if path[k].final:
                    path[k].out = rest + path[k].out
            out = out[n:]
        for k in range(common, len(key)):
            path[k].arcs.append([key[k], None, ()])
            path.append(_State())
        path[len(key)].final = True
        if common < len(key):
            path[common].arcs[-1][2] = out
        else:
            path[common].out = out
        last = key
    for k in range(len(last or b""), 0, -1):
        path[k - 1].arcs[-1][1] = store(path[k])
    root = store(path[0])

    outs, places = array("I"), {}

    def place(ids: tuple[int, ...]) -> int:
        if not ids:
            return _NONE
        if ids not in places:
            places[ids] = len(outs)
            outs.append(len(ids))
            outs.extend(ids)
        return places[ids]

    first, final, labels, targets, arc_out = array("I"), array("I"), bytearray(), array("I"), array("I")
    for is_final, out, arcs in states:
        first.append(len(labels))
        final.append(0 if not is_final else 1 if not out else 2 + place(out))
        for label, target, o in arcs:
            labels.append(label)
            targets.append(target)
            arc_out.append(place(o))
    first.append(len(labels))
    n_arcs = len(labels)
    labels.extend(bytes(-len(labels) % 4))
    head = struct.pack("<4sIIII", _MAGIC, len(states), n_arcs, len(outs), root)
    return head + first.tobytes() + final.tobytes() + targets.tobytes() + arc_out.tobytes() + outs.tobytes() + bytes(labels)


class Transducer:
    """Reads the compiled form in place."""

    def __init__(self, buffer) -> None:
        view = memoryview(buffer)
        magic, self.n_states, self.n_arcs, n_outs, self.root = struct.unpack_from("<4sIIII", view)
        if magic != _MAGIC:
            raise ValueError("not a compiled transducer")
        at = 20
        parts = []
        for n in (self.n_states + 1, self.n_states, self.n_arcs, self.n_arcs, n_outs):
            parts.append(view[at : at + 4 * n].cast("I"))
            at += 4 * n
        self._first, self._final, self._targets, self._arc_out, self._outs = parts
        self._buffer, self._labels_at = buffer, at
        self.longest = self._depth()

    def _depth(self) -> int:
        """The length of the longest key: states are stored after all they lead to."""
        depth = [0] * self.n_states
        for state in range(self.n_states):
            arcs = self._targets[self._first[state] : self._first[state + 1]]
            depth[state] = 1 + max(depth[t] for t in arcs) if len(arcs) else 0
        return depth[self.root]

    @classmethod
    def open(cls, path: str) -> Transducer:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        room = mmap.mmap(-1, len(data))
        room.write(data)
        return cls(room)

    def accepts(self, keys: list[bytes]) -> np.ndarray:
        """Whether each key is held: all keys walk at once, one byte a step; a key leaves when it has no arc."""
        first = np.frombuffer(self._first, np.uint32).astype(np.int64)
        labels = np.frombuffer(self._buffer, np.uint8, self.n_arcs, self._labels_at)
        arcs = np.repeat(np.arange(self.n_states), np.diff(first)) << 8 | labels
        targets, final = np.frombuffer(self._targets, np.uint32), np.frombuffer(self._final, np.uint32) > 0
        lengths = np.fromiter(map(len, keys), np.int64, len(keys))
        data = np.frombuffer(b"".join(keys) or b"\0", np.uint8)
        starts = np.cumsum(lengths) - lengths
        out = np.zeros(len(keys), bool)
        on, state, step = np.arange(len(keys)), np.full(len(keys), self.root, np.int64), 0
        while len(on):
            ended = lengths[on] == step
            out[on[ended]] = final[state[ended]]
            on, state = on[~ended], state[~ended]
            if not len(on) or not len(arcs):
                break
            wanted = state << 8 | data[starts[on] + step]
            at = np.minimum(np.searchsorted(arcs, wanted), len(arcs) - 1)
            going = arcs[at] == wanted
            on, state, step = on[going], targets[at[going]].astype(np.int64), step + 1
        return out

    def _ids(self, at: int) -> list[int]:
        return self._outs[at + 1 : at + 1 + self._outs[at]].tolist()

    def get(self, key: bytes) -> list[int] | None:
        """The ids of a key, None if it has none."""
        first, targets, arc_out, find, base = self._first, self._targets, self._arc_out, self._buffer.find, self._labels_at
        state, ids = self.root, []
        for k in range(len(key)):
            at = find(key[k : k + 1], base + first[state], base + first[state + 1])
            if at < 0:
                return None
            at -= base
            if arc_out[at] != _NONE:
                ids += self._ids(arc_out[at])
            state = targets[at]
        final = self._final[state]
        if not final:
            return None
        return ids + self._ids(final - 2) if final > 1 else ids
