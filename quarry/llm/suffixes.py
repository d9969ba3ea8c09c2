"""Suffix arrays with common prefixes, by external induced sorting.

The text is an integer array.  A suffix is S-type if it is smaller than the one
after it, else L-type; an S-type suffix after an L-type one is a leftmost S
(LMS).  Sorted LMS suffixes induce the order of all others: scanning sorted
suffixes upwards, the suffix before each scanned one joins, if it is L-type,
the queue of its first character; scanning downwards does the same for S-type
suffixes.  Because suffixes arrive in their final order, the priority queue of
(character, rank) tuples is one append-only queue per character.  The LMS
suffixes themselves are sorted by inducing their substrings, naming them, and
solving the string of names in the same way, or, once it has more than
``LETTERS`` different names, by doubling ranks with external sorts.

Each tuple also carries the length of the prefix that it has in common with
the tuple before it (up to a cap).  An induced suffix has one character more
in common with the one before it in its queue than the least value met between
the two in the scan.

Memory.  A ``Space`` bounds what a sort holds: all queues together keep up to
``memory`` tuples in memory and the rest in a file; every array with an entry
for each character, suffix or name (text, types, order, ranks, names, common
prefixes, output) that is longer lies in a file that is mapped, and is worked
on block by block.  What remains is a number of blocks of at most
``min(CHUNK, memory)`` entries, whatever the length of the text.  The files are
the task's own, without a name, and go with it.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Names above which the string of names is sorted by doubling ranks.
LETTERS = 512
#: Tuples scanned at a time.
CHUNK = 1 << 20
#: Entries of an array, and tuples of all queues together, that are held in memory.
MEMORY = 1 << 22


class Space:
    """Room for the arrays and queues of a sort: ``memory`` entries of each
    array, and of all queues together, are held; more go to files."""

    def __init__(self, memory: int):
        self.memory, self.block = memory, max(1, min(CHUNK, memory))
        self.held, self.queues, self.file = 0, [], None
        self.on_disk = self.spilled = 0    # bytes of mapped arrays; tuples written by queues

    def room(self, n: int, dtype: type) -> np.ndarray:
        """An array of ``n`` entries of any value."""
        if n <= self.memory:
            return np.empty(n, dtype)
        self.on_disk += n * np.dtype(dtype).itemsize
        with tempfile.TemporaryFile() as file:           # the mapping keeps the file
            return np.asarray(np.memmap(file, dtype, "w+", shape=n))

    def blocks(self, n: int, low: int = 0) -> list[tuple[int, int]]:
        return [(a, min(a + self.block, n)) for a in range(low, n, self.block)]

    def write(self, *arrays: np.ndarray) -> int:
        """Where the arrays lie in the queues' file."""
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        at = self.file.seek(0, 2)
        for array in arrays:
            self.file.write(array.tobytes())
        return at

    def read(self, at: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        self.file.seek(at)
        return np.frombuffer(self.file.read(4 * n), np.int32), np.frombuffer(self.file.read(2 * n), np.uint16)

    def sort(self, key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys in order and their values: sorted runs, merged block by block."""
        n = len(key)
        if n <= self.memory:
            order = np.argsort(key)
            return key[order], value[order]
        run_key, run_value = self.room(n, key.dtype), self.room(n, value.dtype)
        size = max(self.block, self.memory)
        runs = [[a, min(a + size, n)] for a in range(0, n, size)]
        for a, b in runs:
            order = np.argsort(key[a:b])
            run_key[a:b], run_value[a:b] = key[a:b][order], value[a:b][order]
        out_key, out_value = self.room(n, key.dtype), self.room(n, value.dtype)
        step, at = max(1, size // len(runs)), 0
        while runs:
            # all that is not above the least of the last keys in view, of runs that go on
            ends = [run_key[min(a + step, b) - 1] for a, b in runs]
            pivot = min(ends)
            keys, values = [], []
            for run in runs:
                a, b = run[0], min(run[0] + step, run[1])
                run[0] = a + int(np.searchsorted(run_key[a:b], pivot, "right"))
                keys.append(run_key[a:run[0]])
                values.append(run_value[a:run[0]])
            joined = np.concatenate(keys)
            order = np.argsort(joined)
            out_key[at:at + len(joined)] = joined[order]
            out_value[at:at + len(joined)] = np.concatenate(values)[order]
            at += len(joined)
            runs = [run for run in runs if run[0] < run[1]]
        return out_key, out_value


class Queue:
    """Tuples (suffix, common prefix) in order of arrival, in memory or, once
    the queues of its space hold too many, in the space's file."""

    def __init__(self, space: Space):
        self.space, self.held = space, 0
        self.items: list[tuple] = []       # (pos, lcp) or, on disk, (place, count)
        self.on_disk = self.scanned = 0    # items on disk; items given to the scan
        self.length, self.last = 0, -1     # tuples so far; the latest suffix
        space.queues.append(self)

    def push(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.items.append((pos, lcp))
        self.held += len(pos)
        self.length += len(pos)
        self.last = int(pos[-1])
        self.space.held += len(pos)
        if self.space.held > self.space.memory:
            for queue in self.space.queues:
                queue.spill()

    def spill(self) -> None:
        for i in range(self.on_disk, len(self.items)):
            pos, lcp = self.items[i]
            self.items[i] = (self.space.write(pos, lcp), len(pos))
        self.on_disk = len(self.items)
        self.space.spilled += self.held
        self.space.held -= self.held
        self.held = 0

    def close(self) -> None:
        self.space.held -= self.held
        self.space.queues.remove(self)
        self.items = []

    def _read(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.space.read(*self.items[i]) if i < self.on_disk else self.items[i] for i in range(low, high)]
        if len(parts) == 1:
            return parts[0]
        return np.concatenate([p for p, _ in parts]), np.concatenate([l for _, l in parts])

    def _until(self, low: int) -> int:
        """The end of a block of items from ``low`` on."""
        size = 0
        while low < len(self.items) and size < self.space.block:
            item = self.items[low]
            size += item[1] if low < self.on_disk else len(item[0])
            low += 1
        return low

    def scan(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Every tuple once, in order, with those that arrive meanwhile."""
        while self.scanned < len(self.items):
            low, self.scanned = self.scanned, self._until(self.scanned)
            yield self._read(low, self.scanned)

    def forwards(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        low = 0
        while low < len(self.items):
            high = self._until(low)
            yield self._read(low, high)
            low = high

    def backwards(self, first: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Every tuple from the last to the first, each with the prefix that it
        has in common with the one given before it (``first`` for the last)."""
        cuts = [0]
        while cuts[-1] < len(self.items):
            cuts.append(self._until(cuts[-1]))
        for low, high in zip(cuts[-2::-1], cuts[:0:-1]):
            pos, lcp = self._read(low, high)
            back = np.empty(len(pos), np.uint16)
            back[0] = first
            back[1:] = lcp[:0:-1]
            first = lcp[0]
            yield pos[::-1], back


class Minima:
    """Least values of ranges of an array (a sparse table)."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        step = 1
        while 2 * step <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least of values[low..high] for every pair, low <= high."""
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(low), self.rows[0].dtype)
        for k in np.unique(level).tolist():
            at = level == k
            row = self.rows[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << k) + 1])
        return out


def types(text: np.ndarray, space: Space) -> np.ndarray:
    """Whether each suffix is S-type; the last character is the only 0."""
    n = len(text)
    small = space.room(n, bool)
    small[n - 1] = True
    for a, b in reversed(space.blocks(n - 1)):
        part = text[a:b + 1]
        ends = np.flatnonzero(part[1:] != part[:-1])
        # up to each change its characters decide; after the last, the suffix after the block
        value = np.append(part[ends + 1] > part[ends], small[b])
        small[a:b] = np.repeat(value, np.diff(np.r_[-1, ends, b - a - 1]))
    return small


def runs(text: np.ndarray, cap: int, space: Space) -> np.ndarray:
    """How many equal characters begin at each position, up to ``cap``."""
    n = len(text)
    if not cap:
        return np.broadcast_to(np.uint16(0), n)
    run = space.room(n, np.uint16)
    run[n - 1] = 1
    for a, b in reversed(space.blocks(n - 1)):
        part = text[a:b + 1]
        ends = np.flatnonzero(part[1:] != part[:-1])
        end = np.repeat(np.append(ends, b - a - 1 + int(run[b])), np.diff(np.r_[-1, ends, b - a - 1]))
        run[a:b] = np.minimum(end - np.arange(b - a) + 1, cap)
    return run


def counts(text: np.ndarray, letters: int, space: Space, at: np.ndarray | None = None) -> np.ndarray:
    """How often each letter occurs (at the positions ``at``)."""
    out = np.zeros(letters, np.int64)
    for a, b in space.blocks(len(text if at is None else at)):
        out += np.bincount(text[a:b] if at is None else text[at[a:b]], minlength=letters)
    return out


class _Scan:
    """One direction of the induction: what has been least since each queue's
    latest tuple."""

    def __init__(self, queues: dict[int, Queue], letters: int, cap: int, space: Space):
        self.queues, self.cap, self.space = queues, cap, space
        self.least = np.zeros(letters, np.uint16)

    def feed(self, text: np.ndarray, wanted: np.ndarray, pos: np.ndarray, lcp: np.ndarray) -> None:
        """Scan (pos, lcp) in order; suffixes before them, if ``wanted``, join
        their queues."""
        before = pos - 1
        chosen = np.flatnonzero((before >= 0) & wanted[before])
        letter = text[before[chosen]]
        order = np.argsort(letter, kind="stable")
        chosen, letter = chosen[order], letter[order]
        whole = lcp.min() if self.cap and len(lcp) else 0
        if not len(chosen):
            np.minimum(self.least, whole, out=self.least)
            return
        cuts = np.flatnonzero(letter[1:] != letter[:-1]) + 1
        heads = np.concatenate(([0], cuts))
        tails = np.concatenate((cuts, [len(letter)])) - 1
        if not self.cap:                                 # only the order is wanted
            self._join(before[chosen], np.zeros(len(chosen), np.uint16), letter[heads], heads, tails)
            return
        low = np.empty(len(chosen), np.int64)
        low[1:] = chosen[:-1] + 1
        low[heads] = 0
        minima = Minima(lcp)
        value = minima(low, chosen).astype(np.int64)
        names = letter[heads]
        value[heads] = np.minimum(value[heads], self.least[names])
        value = np.minimum(value + 1, self.cap).astype(np.uint16)
        # after the last tuple of each queue
        rest = chosen[tails] + 1
        new = np.full(len(names), self.cap, np.uint16)
        inside = rest < len(lcp)
        if inside.any():
            new[inside] = minima(rest[inside], np.full(int(inside.sum()), len(lcp) - 1))
        np.minimum(self.least, whole, out=self.least)
        self.least[names] = new
        self._join(before[chosen], value, names, heads, tails)

    def _join(self, pos: np.ndarray, lcp: np.ndarray, names: np.ndarray, heads: np.ndarray,
              tails: np.ndarray) -> None:
        for a, b, name in zip(heads.tolist(), (tails + 1).tolist(), names.tolist()):
            queue = self.queues.get(name)
            if queue is None:
                queue = self.queues[name] = Queue(self.space)
            if not queue.length:
                lcp[a] = 0                               # nothing before it begins alike
            queue.push(pos[a:b], lcp[a:b])


def induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray, lms_lcp: np.ndarray | None, cap: int,
           space: Space) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order and the prefix (up to ``cap``) each has in common
    with the one before it, from the LMS suffixes in order."""
    n, letters = len(text), int(text.max()) + 1
    run = runs(text, cap, space)
    of_lms = np.r_[0, np.cumsum(counts(text, letters, space, lms))].tolist()
    used = np.flatnonzero(counts(text, letters, space)).tolist()

    large = space.room(n, bool)
    for a, b in space.blocks(n):
        np.logical_not(small[a:b], out=large[a:b])
    larger: dict[int, Queue] = {}
    up = _Scan(larger, letters, cap, space)
    for c in used:
        queue = larger.get(c)
        if queue is not None:
            for pos, lcp in queue.scan():
                up.feed(text, large, pos, lcp)
        for a, b in space.blocks(of_lms[c + 1], of_lms[c]):
            pos = lms[a:b]
            first = np.zeros(b - a, np.uint16) if lms_lcp is None else lms_lcp[a:b].copy()
            if a == of_lms[c]:
                first[0] = min(run[queue.last], run[pos[0]]) if queue is not None else 0
            up.feed(text, large, pos, first)

    smaller: dict[int, Queue] = {}
    down = _Scan(smaller, letters, cap, space)
    out_pos, out_lcp, end = space.room(n, np.int32), space.room(n, np.uint16), n

    for c in reversed(used):
        queue, before = smaller.get(c), larger.get(c)
        if queue is not None:
            for pos, lcp in queue.scan():
                down.feed(text, small, pos, lcp)
        last = queue.last if queue is not None else -1
        if c == text[n - 1]:                             # the end of the text, induced by nothing
            end -= 1
            out_pos[end], out_lcp[end] = n - 1, 0
            down.feed(text, small, np.array([n - 1], np.int32), np.zeros(1, np.uint16))
        between = int(min(run[before.last], run[last])) if before is not None and last >= 0 else 0
        # into the output upwards: the L part, then the S part in reverse
        if queue is not None:
            start = end - queue.length
            for pos, lcp in queue.backwards(between):
                out_pos[start:start + len(pos)], out_lcp[start:start + len(pos)] = pos, lcp
                start += len(pos)
            end -= queue.length
            smaller.pop(c).close()
        if before is not None:
            for pos, back in before.backwards(between):
                down.feed(text, small, pos, back)
            start = end = end - before.length
            for pos, lcp in before.forwards():
                out_pos[start:start + len(pos)], out_lcp[start:start + len(pos)] = pos, lcp
                start += len(pos)
            larger.pop(c).close()
    return out_pos, out_lcp


def fours(text: np.ndarray, space: Space) -> np.ndarray:
    """Four neighbouring characters (below 65,536) from each position on as one number."""
    n = len(text)
    out = space.room(n, np.uint64)
    for a, b in space.blocks(n):
        wide = np.zeros(b - a + 3, np.uint64)
        part = text[a:b + 3]
        wide[:len(part)] = part
        out[a:b] = wide[:b - a]
        for k in (1, 2, 3):
            out[a:b] |= wide[k:b - a + k] << np.uint64(16 * k)
    return out


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int, four: np.ndarray | None = None) -> np.ndarray:
    """Length of the common prefix of suffixes a and b, up to ``cap``: four
    characters at a time (if ``four`` has them), then one by one."""
    out = np.zeros(len(a), np.int64)
    n = len(text)
    for step, table, until in ((4, four, cap - 3), (1, text, cap)):
        if table is None:
            continue
        live = np.arange(len(a))
        while len(live):
            k = out[live]
            i, j = a[live] + k, b[live] + k
            ok = (np.maximum(i, j) + step <= n) & (k < until)
            live, i, j = live[ok], i[ok], j[ok]
            live = live[table[i] == table[j]]
            out[live] += step
    return np.minimum(out, cap)


def _doubled(names: np.ndarray, depth: int, space: Space) -> np.ndarray:
    """Suffixes of ``names`` in the order of their first ``depth`` names: ranks
    by the first name, then by twice as many in each round; only suffixes that
    still tie are sorted again."""
    n, k = len(names), 1
    at = space.room(n, np.int32)                         # places in the order that are looked at
    for a, b in space.blocks(n):
        at[a:b] = np.arange(a, b)
    key, order = space.sort(names, at)
    rank = space.room(n, np.int32)
    while True:
        m, first, left = len(at), -1, 0
        tied = space.room(m, np.int32)
        for a, b in space.blocks(m):
            part = key[max(a - 1, 0):b + 1]
            new = np.ones(b - a + 1, bool)               # of the block and the place after it
            differs = part[1:] != part[:-1]
            if a:
                new[:len(differs)] = differs
            else:
                new[1:1 + len(differs)] = differs
            # the place where each tie begins
            begins = np.flatnonzero(new[:-1])
            low = np.repeat(np.append(first, at[a:b][begins]), np.diff(np.r_[0, begins, b - a]))
            rank[order[at[a:b]]] = low
            first = low[-1]
            again = at[a:b][~(new[:-1] & new[1:])]
            tied[left:left + len(again)] = again
            left += len(again)
        if not left or k >= depth:
            return order
        at = tied[:left]
        key, value = space.room(left, np.int64), space.room(left, np.int32)
        for a, b in space.blocks(left):
            suffix = order[at[a:b]]
            following = np.full(b - a, -1, np.int64)
            inside = suffix.astype(np.int64) + k < n
            following[inside] = rank[suffix[inside] + k]
            key[a:b] = rank[suffix].astype(np.int64) * (n + 1) + following + 1
            value[a:b] = suffix
        key, value = space.sort(key, value)
        for a, b in space.blocks(left):
            order[at[a:b]] = value[a:b]
        k *= 2


def suffix_array(text: np.ndarray, cap: int, memory: int = MEMORY, space: Space | None = None
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``cap`` characters, and the length
    (up to ``cap``) of the prefix each has in common with the one before it.

    ``text`` must end with its only 0.  Suffixes alike in ``cap`` characters
    stand together, in no particular order.  Of each array and of all queues
    together, ``memory`` entries are held; what is more goes to files."""
    n, space = len(text), space or Space(memory)
    if n == 1:
        return np.zeros(1, np.int32), np.zeros(1, np.uint16)
    small, letters = types(text, space), int(text.max()) + 1
    is_lms = space.room(n, bool)
    is_lms[0] = False
    for a, b in space.blocks(n, 1):
        is_lms[a:b] = small[a:b] & ~small[a - 1:b - 1]
    lms, by_letter = _marked(is_lms, letters, text, space)
    # substrings in order: induce from the LMS positions by first character only
    every, _ = induce(text, small, by_letter, None, 0, space)
    m = len(lms)
    order, size, at = space.room(m, np.int32), space.room(n, np.int32), 0
    for a, b in space.blocks(n):
        found = every[a:b][is_lms[every[a:b]]]
        order[at:at + len(found)] = found
        at += len(found)
    del every, by_letter, is_lms
    for a, b in space.blocks(m - 1):
        size[lms[a:b]] = lms[a + 1:b + 1] - lms[a:b] + 1
    size[lms[m - 1]] = 1
    name, of = 0, space.room(n, np.int32)
    of[order[0]] = 0
    for low, high in space.blocks(m, 1):
        a, b = order[low - 1:high - 1], order[low:high]
        alike = size[a] == size[b]
        alike[alike] = _alike(text, a[alike], b[alike], size[a[alike]])
        given = name + np.cumsum(~alike)
        of[b] = given
        name = int(given[-1])
    if name + 1 < m:                                     # names repeat: sort the string of names
        names = space.room(m, np.int32)
        for a, b in space.blocks(m):
            names[a:b] = of[lms[a:b]]
        del of, size
        if name < LETTERS:
            found, _ = suffix_array(names, cap // 2 + 2, space=space)
        else:
            found = _doubled(names, cap // 2 + 2, space)
        for a, b in space.blocks(m):
            order[a:b] = lms[found[a:b]]
        del found, names
    lcp = space.room(m, np.uint16)
    lcp[0] = 0
    four = fours(text, space) if letters <= 1 << 16 else None
    for a, b in space.blocks(m, 1):
        lcp[a:b] = common(text, order[a - 1:b - 1], order[a:b], cap, four)
    del four
    return induce(text, small, order, lcp, cap, space)


def _marked(is_lms: np.ndarray, letters: int, text: np.ndarray, space: Space) -> tuple[np.ndarray, np.ndarray]:
    """The LMS positions as they stand, and by their first characters."""
    m = sum(int(np.count_nonzero(is_lms[a:b])) for a, b in space.blocks(len(is_lms)))
    lms, by_letter, at = space.room(m, np.int32), space.room(m, np.int32), 0
    for a, b in space.blocks(len(is_lms)):
        found = np.flatnonzero(is_lms[a:b]) + a
        lms[at:at + len(found)] = found
        at += len(found)
    free = np.r_[0, np.cumsum(counts(text, letters, space, lms))[:-1]]
    for a, b in space.blocks(m):
        letter = text[lms[a:b]]
        order = np.argsort(letter, kind="stable")
        letter = letter[order]
        many = np.bincount(letter, minlength=letters)
        by_letter[free[letter] + np.arange(b - a) - (np.cumsum(many) - many)[letter]] = lms[a:b][order]
        free += many
    return lms, by_letter


def _alike(text: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` characters from a and from b are the same."""
    out = np.ones(len(a), bool)
    live, k = np.arange(len(a)), 0
    while len(live):
        live = live[size[live] > k]
        same = text[a[live] + k] == text[b[live] + k]
        out[live[~same]] = False
        live = live[same]
        k += 1
    return out
