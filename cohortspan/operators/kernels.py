"""Small helpers for one bounded group at a time, in numpy and plain Python."""

from __future__ import annotations

import hashlib
from math import lgamma, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class OpenHeads:
    """Cluster heads of one key while its rows pass in order: only heads at most `distance` behind the current row are held."""

    #: Rows that are compared with a head at once, and rows for each new head from which on that is faster than one by one.
    BLOCK, THIN = 1024, 8

    def __init__(self, distance: int, similarity: float, heads: list[tuple] = ()):
        self.distance, self.similarity = distance, similarity
        self.heads: list[tuple] = [tuple(h) for h in heads]
        self.at: int | None = None

    def head(self, position: int, length: int, sequence: str, name: str) -> str:
        """The name of the newest open head that fits the row; its own name, if none does and it becomes a head."""
        if position != self.at:
            self.at, self.heads = position, [h for h in self.heads if position - h[0] <= self.distance]
        for _, its_length, its_sequence, its_name in reversed(self.heads):
            small, large = (length, its_length) if length < its_length else (its_length, length)
            if (small == 0 or small / large >= self.similarity) and not (sequence and its_sequence and sequence != its_sequence):
                return its_name
        self.heads.append((position, length, sequence, name))
        return name

    def heads_of(self, positions: pa.Array, lengths: pa.Array, names: pa.Array, sequences: pa.Array) -> pa.Array:
        """The heads' names of rows in order. Where heads come thick rows go one by one; else a head is compared with all rows of a block at once."""
        at, length, told = positions.to_numpy(), lengths.to_numpy(), pc.dictionary_encode(sequences)
        code, texts = told.indices.to_numpy(), told.dictionary.to_pylist()
        out, thick = [], True
        for i in range(0, len(at), self.BLOCK):
            p, size, c, named = at[i : i + self.BLOCK], length[i : i + self.BLOCK], code[i : i + self.BLOCK], names.slice(i, self.BLOCK)
            if thick:
                found = [self.head(*row) for row in zip(p.tolist(), size.tolist(), [texts[x] for x in c.tolist()], named.to_pylist(), strict=True)]
                opened = len(set(found))
                out.append(pa.array(found, pa.string()))
            else:
                found, opened = self._block(p, size, c, texts, named)
                out.append(found)
            thick = opened * self.THIN > len(p)
        return pa.concat_arrays(out)

    def _block(self, at: np.ndarray, length: np.ndarray, code: np.ndarray, texts: list[str], names: pa.Array) -> tuple[pa.Array, int]:
        heads = [h for h in self.heads if at[0] - h[0] <= self.distance]
        fit, none, known = np.full(len(at), -1), texts.index("") if "" in texts else -1, len(heads)

        def join(n: int, start: int) -> None:
            position, its_length, its_sequence, _ = heads[n]
            stop = int(np.searchsorted(at, position + self.distance, "right"))
            rows = length[start:stop]
            small = np.minimum(rows, its_length)
            fits = (small == 0) | (small / np.maximum(rows, its_length) >= self.similarity)
            if its_sequence:
                fits &= (code[start:stop] == none) | (code[start:stop] == (texts.index(its_sequence) if its_sequence in texts else -1))
            fit[start:stop][fits] = n  # the newest head that fits comes last

        with np.errstate(divide="ignore", invalid="ignore"):
            for n in range(known):
                join(n, 0)
            k = 0
            while (alone := np.flatnonzero(fit[k:] < 0)[:1]).size:
                k += int(alone[0])
                heads.append((int(at[k]), int(length[k]), texts[code[k]], names[k].as_py()))
                fit[k] = len(heads) - 1
                k += 1
                join(len(heads) - 1, k)
        self.at = int(at[-1])
        self.heads = [h for h in heads if self.at - h[0] <= self.distance]
        return pa.array([h[3] for h in heads], pa.string()).take(pa.array(fit)), len(heads) - known


def bridges(edges: list[tuple[int, int]]) -> list[int]:
    """Indices of edges whose removal splits the graph, by an iterative low-link search; parallel edges are no bridges."""
    around: dict[int, list[tuple[int, int]]] = {}
    for i, (a, b) in enumerate(edges):
        around.setdefault(a, []).append((b, i))
        around.setdefault(b, []).append((a, i))
    order: dict[int, int] = {}
    low: dict[int, int] = {}
    out = []
    for start in around:
        if start in order:
            continue
        order[start] = low[start] = len(order)
        stack = [(start, -1, iter(around[start]))]
        while stack:
            node, via, rest = stack[-1]
            for other, i in rest:
                if i == via:
                    continue
                if other in order:
                    low[node] = min(low[node], order[other])
                else:
                    order[other] = low[other] = len(order)
                    stack.append((other, i, iter(around[other])))
                    break
            else:
                stack.pop()
                if stack:
                    above = stack[-1][0]
                    low[above] = min(low[above], low[node])
                    if low[node] > order[above]:
                        out.append(via)
    return sorted(out)


def contract(edges: list[tuple[str, str, str]], shared: set[str], mark: str) -> tuple[list[str], list[tuple[str, str, str, list[str]]]]:
    """A part of a graph cut down to what the rest needs to know. Edges: (id, a, b); `shared`: nodes that also have edges elsewhere.

    Gives the ids that are bridges of the whole graph whatever the rest holds, and the edges that take this part's place: (id, a, b, ids of the
    edges that are bridges if it is one). An edge on a cycle here is none, and its cycle keeps its shared nodes together by
    double edges. A branch without shared nodes hangs on a bridge. A path between other nodes is one edge.
    """
    number: dict[str, int] = {}
    ends = [tuple(number.setdefault(x, len(number)) for x in (a, b)) for _, a, b in edges]
    apart = set(bridges(ends))
    parent = list(range(len(number)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, (a, b) in enumerate(ends):
        if i not in apart:
            parent[root(a)] = root(b)
    held: dict[int, list[str]] = {}
    for name, i in number.items():
        if name in shared:
            held.setdefault(root(i), []).append(name)
    out = []
    for names in held.values():
        out += [(f"{names[0]}\0{mark}:{x}:{k}", names[0], x, []) for x in names[1:] for k in (0, 1)]
    first: dict[int, str] = {}
    for name, i in number.items():
        first[root(i)] = min(first.get(root(i), name), name)
    around: dict[int, dict[int, int]] = {}  # of the trees that are left: class -> edge -> class
    for i in apart:
        a, b = (root(x) for x in ends[i])
        around.setdefault(a, {})[i] = b
        around.setdefault(b, {})[i] = a
    sure, loose = [], [c for c, e in around.items() if len(e) == 1 and c not in held]
    while loose:
        c = loose.pop()
        if len(around[c]) != 1:
            continue
        ((i, other),) = around.pop(c).items()
        sure.append(edges[i][0])
        del around[other][i]
        if len(around[other]) == 1 and other not in held:
            loose.append(other)
    kept = {c for c, e in around.items() if e and (c in held or len(e) > 2)}
    name = lambda c: held[c][0] if c in held else f"{first[c]}\0{mark}"
    done: set[int] = set()
    for c in kept:
        for i, other in around[c].items():
            if i in done:
                continue
            path, via, at = [i], i, other
            while at not in kept:
                via, at = next((e, o) for e, o in around[at].items() if e != via)
                path.append(via)
            done |= {path[0], path[-1]}
            ids = [edges[k][0] for k in path]
            out.append((min(ids), name(c), name(at), ids))
    return sure, out


def sign_flip(differences: np.ndarray, permutations: int, seed: int) -> tuple[float | None, bool]:
    """Two-sided p-value of a mean difference under sign flips (None without pairs), and whether all flips were listed: up to 16 pairs, zeros among them."""
    if not len(differences):
        return None, True
    d = differences[differences != 0]  # a zero is the same under both signs
    observed = abs(d.sum()) - 1e-12
    if len(differences) <= 16:
        signs = 1 - 2 * ((np.arange(1 << len(d))[:, None] >> np.arange(len(d))) & 1)
        return float((np.abs(signs @ d) >= observed).mean()), True
    rng, extreme = np.random.default_rng(seed), 0
    for at in range(0, permutations, 1000):
        signs = rng.choice([-1.0, 1.0], (min(1000, permutations - at), len(d)))
        extreme += int((np.abs(signs @ d) >= observed).sum())
    return (extreme + 1) / (permutations + 1), False


def _log_choose(n: int, k: int) -> float:
    return lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Exact test of a 2x2 table: the probability of all tables with the same margins that are no likelier."""
    row, col, n = a + b, a + c, a + b + c + d
    if not n:
        return 1.0
    lo, hi = max(0, row + col - n), min(row, col)
    logs = np.array([_log_choose(col, x) + _log_choose(n - col, row - x) - _log_choose(n, row) for x in range(lo, hi + 1)])
    return float(min(1.0, np.exp(logs[logs <= logs[a - lo] + 1e-7]).sum()))


def _binomial_cdf(k: int, n: int, p: float) -> float:
    if p <= 0:
        return 1.0
    if p >= 1:
        return 1.0 if k >= n else 0.0
    return float(sum(np.exp(_log_choose(n, i) + i * log(p) + (n - i) * log(1 - p)) for i in range(k + 1)))


def clopper_pearson(k: int, n: int, level: float = 0.95) -> tuple[float, float]:
    """Exact binomial interval by bisection."""
    if not n:
        return 0.0, 1.0
    tail = (1 - level) / 2

    def solve(f) -> float:
        lo, hi = 0.0, 1.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if f(mid) else (lo, mid)
        return (lo + hi) / 2

    lower = 0.0 if k == 0 else solve(lambda p: 1 - _binomial_cdf(k - 1, n, p) < tail)
    upper = 1.0 if k == n else solve(lambda p: _binomial_cdf(k, n, p) > tail)
    return lower, upper


class Firth:
    """Firth's penalised logistic regression of y on the columns of x: the log likelihood and half the log determinant of the information."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.x, self.y = x, y

    def _state(self, b: np.ndarray):
        p = 1 / (1 + np.exp(-np.clip(self.x @ b, -30, 30)))
        info = self.x.T @ (self.x * (p * (1 - p))[:, None])
        sign, logdet = np.linalg.slogdet(info)
        return p, info, (float((self.y * np.log(p) + (1 - self.y) * np.log(1 - p)).sum()) + logdet / 2 if sign > 0 else -np.inf)

    def full_rank(self) -> bool:
        return bool(np.linalg.matrix_rank(self.x) == self.x.shape[1])

    def fit(self, held: int | None = None, at: float = 0.0, start: np.ndarray | None = None, rounds: int = 100) -> tuple[np.ndarray, float]:
        """Coefficients and penalised log likelihood at its maximum; with `held` that coefficient stays at `at`, while the information is still that of all."""
        beta = np.zeros(self.x.shape[1]) if start is None else start.copy()
        free = np.array([i for i in range(len(beta)) if i != held], int)
        if held is not None:
            beta[held] = at
        p, info, now = self._state(beta)
        for _ in range(rounds if len(free) else 0):
            w = p * (1 - p)
            hat = np.einsum("ij,jk,ik->i", self.x, np.linalg.inv(info), self.x) * w
            score = self.x.T @ (self.y - p + hat * (0.5 - p))
            step = np.zeros(len(beta))
            step[free] = np.linalg.solve(info[np.ix_(free, free)], score[free])
            scale = min(1.0, 5 / max(np.abs(step).max(), 1e-12))
            for _ in range(25):
                p, info, new = self._state(beta + scale * step)
                if new >= now - 1e-12:
                    break
                scale /= 2
            beta, now = beta + scale * step, new
            if np.abs(scale * step).max() < 1e-10:
                break
        return beta, now

    def interval(self, j: int, beta: np.ndarray, best: float, level: float = 3.841458820694124) -> tuple[float | None, float | None]:
        """Where the profile of coefficient `j` has lost `level` / 2: each end by doubled steps, then by halving. None for an end beyond 50."""
        spread = float(np.sqrt(np.linalg.inv(self._state(beta)[1])[j, j]))

        def lost(at: float) -> float:
            return 2 * (best - self.fit(j, at, beta)[1]) - level

        ends = []
        for sign in (-1, 1):
            inner, step = float(beta[j]), spread
            while abs(inner + sign * step) < 50 and lost(inner + sign * step) < 0:
                inner, step = inner + sign * step, 2 * step
            outer = inner + sign * step
            if abs(outer) >= 50 and lost(sign * 50.0) < 0:
                ends.append(None)
                continue
            outer = max(min(outer, 50.0), -50.0)
            while abs(outer - inner) > 1e-10:
                middle = (inner + outer) / 2
                inner, outer = (middle, outer) if lost(middle) < 0 else (inner, middle)
            ends.append((inner + outer) / 2)
        return ends[0], ends[1]


def blake2b_unit(seed: str, name: str) -> float:
    """A number in [0, 1) fixed by seed and name."""
    return int.from_bytes(hashlib.blake2b(f"{seed}\0{name}".encode(), digest_size=8).digest(), "big") / 2**64


class PanelScan:
    """How often k-mers of each panel group occur in texts: windows are compared with the sorted panel by a rolling number, equal ones letter by letter."""

    def __init__(self, kmers: list[str], groups: list[str], k: int):
        self.k = k
        kinds, which = np.unique(np.array(kmers, object).astype(str), return_inverse=True) if kmers else (np.zeros(0, str), np.zeros(0, np.int64))
        self.groups = sorted(set(groups))
        codes = np.array([self.groups.index(g) for g in groups], np.int64)
        self.of = [codes[which == i] for i in range(len(kinds))]
        letters = np.array([[ord(c) for c in x] for x in kinds], np.uint64).reshape(len(kinds), k)
        number = self._number(letters.T)
        order = np.argsort(number, kind="stable")
        self.number, self.kind, self.letters = number[order], order, letters[order]

    @staticmethod
    def _number(columns) -> np.ndarray:
        out = None
        for c in columns:
            out = c.astype(np.uint64) if out is None else out * np.uint64(0x100000001B3) + c
        return out

    def count(self, texts: list[str], chunk: int = 2_000_000) -> tuple[np.ndarray, list[str], np.ndarray]:
        """(text, group, occurrences) for each group that a text holds."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for i, text in enumerate(texts):
            for lo in range(0, max(len(text) - self.k + 1, 0), chunk) if len(self.number) else ():
                code = np.frombuffer(text[lo : lo + chunk + self.k - 1].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
                m = len(code) - self.k + 1
                number = self._number(code[j : j + m] for j in range(self.k))
                at = np.searchsorted(self.number, number)
                at[at == len(self.number)] = 0
                hit = np.flatnonzero(self.number[at] == number)
                hit = hit[(code[hit[:, None] + np.arange(self.k)] == self.letters[at[hit]]).all(axis=1)] if len(hit) else hit
                groups = np.concatenate([self.of[self.kind[x]] for x in at[hit]]) if len(hit) else np.zeros(0, np.int64)
                found.append((np.full(len(groups), i), groups))
        if not found:
            return np.zeros(0, np.int64), [], np.zeros(0, np.int64)
        row, group = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        both, n = np.unique(row * max(len(self.groups), 1) + group, return_counts=True)
        return both // max(len(self.groups), 1), [self.groups[g] for g in both % max(len(self.groups), 1)], n


_BASES = np.full(256, 4, np.uint8)
_BASES[list(b"ACGT")] = range(4)


def pack_kmers(text: str, k: int, m: int, parts: int) -> list[tuple[int, bytes]]:
    """The k-mers of ACGT in a text, dealt to `parts` by their minimiser (the m-mer of the least hash), as (part, packed runs).

    k-mers that follow each other in one part are one run of bases, two bits each. Equal k-mers have equal minimisers, so they are in one part.
    """
    code = _BASES[np.frombuffer(text.encode("ascii", "replace"), np.uint8)]
    n = len(code) - k + 1
    if n <= 0:
        return []
    bad = np.concatenate([[0], np.cumsum(code == 4)])
    good = bad[k:] == bad[:-k]
    part = np.zeros(n, np.int64)
    if parts > 1:
        short = np.zeros(len(code) - m + 1, np.uint64)
        for i in range(m):
            short = short * np.uint64(4) + code[i : i + len(short)]
        mixed = (short + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        least = np.lib.stride_tricks.sliding_window_view(mixed, k - m + 1).min(axis=1)
        part = (least * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40)).astype(np.int64) % parts
    part = np.where(good, part, -1)
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    ends = np.concatenate([starts[1:], [n]])
    own = part[starts]
    starts, ends, own = starts[own >= 0], ends[own >= 0], own[own >= 0]
    out = []
    for p in np.unique(own):
        s, length = starts[own == p], (ends - starts)[own == p] + k - 1
        place = np.repeat(s - np.cumsum(length) + length, length) + np.arange(length.sum())
        bits = np.unpackbits(code[place][:, None], axis=1)[:, 6:]
        out.append((int(p), np.array([len(length), *length], "<u4").tobytes() + np.packbits(bits.ravel()).tobytes()))
    return out


def unpack_kmers(packed: bytes, k: int) -> np.ndarray:
    """The k-mers of packed runs as numbers, repeats included. k is at most 31."""
    runs = int(np.frombuffer(packed[:4], "<u4")[0])
    length = np.frombuffer(packed[4 : 4 + 4 * runs], "<u4").astype(np.int64)
    bits = np.unpackbits(np.frombuffer(packed[4 + 4 * runs :], np.uint8))[: 2 * length.sum()].reshape(-1, 2)
    code = (bits[:, 0] * 2 + bits[:, 1]).astype(np.int64)
    whole = np.zeros(max(len(code) - k + 1, 0), np.int64)
    for i in range(k):
        whole = whole * 4 + code[i : i + len(whole)]
    first = np.cumsum(length) - length
    n = length - k + 1
    return whole[np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())]


class RankCounts:
    """Whole numbers in a fixed order, one bit a level: how many of any stretch of them are below a limit, for many stretches at once."""

    def __init__(self, values: np.ndarray, many: int, weights: np.ndarray):
        self.levels = []
        for bit in reversed(range(many.bit_length())):
            one = (values >> bit) & 1
            order = np.argsort(one, kind="stable")
            zeros = np.concatenate([[0], np.cumsum(1 - one)])
            values, weights = values[order], weights[order]
            self.levels.append((bit, zeros, np.concatenate([[0], np.cumsum(weights)])))

    def below(self, start: np.ndarray, stop: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Summed weights of the values at [start, stop) that are less than `limit`, at most `many`."""
        total = np.zeros(len(start), np.int64)
        for bit, zeros, sums in self.levels:
            one = ((limit >> bit) & 1).astype(bool)
            from_, to = zeros[start], zeros[stop]
            total += np.where(one, sums[to] - sums[from_], 0)
            start, stop = np.where(one, zeros[-1] + start - from_, from_), np.where(one, zeros[-1] + stop - to, to)
        return total


def _first(n: int, size: int, holds) -> np.ndarray:
    """For each of `size` questions the first of 0 to n - 1 for which `holds(places)` is true (and stays so); n if there is none."""
    low, high = np.zeros(size, np.int64), np.full(size, n, np.int64)
    while (low < high).any():
        middle = (low + high) // 2
        true = holds(np.minimum(middle, max(n - 1, 0))) | (low >= high)
        low, high = np.where(true, low, middle + 1), np.where(true & (low < high), middle, high)
    return low


def best_sources(events: tuple[np.ndarray, ...], sources: tuple[np.ndarray, ...], distance: int, similarity: float) -> tuple[np.ndarray, ...]:
    """For each event how many sources lie within `distance` and are alike in length, and which of them comes first by tier, distance, difference of lengths and name.

    Events: positions, lengths, where a length is missing. Sources: the same, their tiers, how many rows each stands for, and their names' places in order; no
    two agree in position, length and tier. Pairs are never made: near and alike sources are counted in a table of ranks, the least distance is
    found by halving, and of the sources there only the next longer and the next shorter one can be first. Gives
    counts, the sources' numbers (-1 if there is none), distances, and differences of length (-1 where one is missing, which comes first).
    """
    at, length, missing = events
    place, size, unknown, tier, rows, name = sources
    known = np.unique(size[~unknown])
    many = len(known) + 1  # the last rank is that of missing lengths
    # known lengths of one sign that are alike are neighbours; zero and a missing length are like any known one
    positive, zero = np.searchsorted(known, 1), np.searchsorted(known, 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        above, own = known[positive:].astype(float), length.astype(float)
        low = positive + _first(len(above), len(at), lambda i: above[i] / own >= similarity if len(above) else np.ones(len(at), bool))
        high = positive + _first(len(above), len(at), lambda i: own / above[i] < similarity if len(above) else np.ones(len(at), bool))
    low, high = np.where(length > 0, low, 0), np.where(length > 0, high, np.where(length < 0, zero, many - 1))
    every = np.full(len(at), many - 1)
    ranges = [(low, np.maximum(low, high)), (np.where(length == 0, every, zero), np.where(length == 0, every, positive)), (every, np.where(missing, every, many))]
    ranges = [r for r, used in zip(ranges, (True, zero < positive or (length == 0).any(), unknown.any()), strict=True) if used]

    rank = np.where(unknown, many - 1, np.searchsorted(known, size))
    mine = np.searchsorted(known, length)
    count = np.zeros(len(at), np.int64)
    chosen, least, apart = (np.full(len(at), -1, np.int64) for _ in range(3))
    for t in np.unique(tier):
        order = np.flatnonzero(tier == t)
        order = order[np.lexsort((rank[order], place[order]))]
        where, ranks = place[order], rank[order]
        counted, single = RankCounts(ranks, many, rows[order]), RankCounts(ranks, many, np.ones(len(order), np.int64))

        def inside(table: RankCounts, q: np.ndarray, d, where=where) -> np.ndarray:
            start, stop = np.searchsorted(where, at[q] - d, "left"), np.searchsorted(where, at[q] + d, "right")
            return sum(table.below(start, stop, to[q]) - table.below(start, stop, from_[q]) for from_, to in ranges)

        found = inside(counted, np.arange(len(at)), distance)
        count += found
        q = np.flatnonzero((found > 0) & (chosen < 0))
        if not len(q):
            continue
        d = _first(distance + 1, len(q), lambda d, q=q, table=single: inside(table, q, d) > 0)
        key = where * np.int64(many) + ranks
        best, best_apart, best_name = np.full(len(q), -1, np.int64), np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
        for from_, to in ranges:
            for side in (-d, d):
                x = at[q] + side
                next_ = np.searchsorted(key, x * many + np.clip(mine[q], from_[q], to[q]), "left")
                for i in (next_, next_ - 1):
                    node = np.clip(i, 0, len(key) - 1)
                    fits = (node == i) & (where[node] == x) & (ranks[node] >= from_[q]) & (ranks[node] < to[q])
                    # a difference with a missing length is missing too
                    gap = np.where(missing[q] | (ranks[node] == many - 1), -1, np.abs(size[order[node]] - length[q]))
                    names = name[order[node]]
                    fits &= ~missing[q]
                    better = fits & ((best < 0) | (gap < best_apart) | ((gap == best_apart) & (names < best_name)))
                    best, best_apart, best_name = np.where(better, order[node], best), np.where(better, gap, best_apart), np.where(better, names, best_name)
        # without a length, the first name at that distance
        blank = np.flatnonzero(missing[q])
        if len(blank):
            named = order[ranks < many - 1]
            named = named[np.lexsort((name[named], place[named]))]
            for side in (-d, d):
                x = (at[q] + side)[blank]
                i = np.minimum(np.searchsorted(place[named], x, "left"), len(named) - 1)
                better = (place[named[i]] == x) & ((best[blank] < 0) | (name[named[i]] < best_name[blank]))
                best[blank], best_name[blank] = np.where(better, named[i], best[blank]), np.where(better, name[named[i]], best_name[blank])
            best_apart[blank] = -1
        chosen[q], least[q], apart[q] = best, d, best_apart
    return count, chosen, least, apart


def _ranked(x: np.ndarray) -> tuple[np.ndarray, int]:
    """Small numbers from 1 in the order of `x`, of which two are next to each other if the values are, and how many to reckon with."""
    values, which = np.unique(x, return_inverse=True)
    rank = np.cumsum(np.append(1, np.minimum(np.diff(values), 2)))
    return rank[which], int(rank[-1]) + 2


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (the least number in each set) after the sets of a[i] and b[i] are joined."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further


def near_clusters(position: np.ndarray, length: np.ndarray, q: np.ndarray, where: np.ndarray, band: np.ndarray, distance: int, similarity: float, block: int = 1 << 20) -> np.ndarray:
    """A cluster number for each row: chains of rows at most `distance` apart, alike in length, and of one `q` or one of them of `q` 0.

    Rows of a cell (q, bin `where`, length band) are all alike. Two cells meet in the rows of their rims: those that no other row of the cell as near to its left or
    right border beats in length, or in shortness. Cells that are together already aren't compared; at most about `block` pairs of rows are held at once.
    """
    if not len(position):
        return np.zeros(0, np.int64)
    (at, bins_), (size, bands) = _ranked(where), _ranked(band)
    cells, of = np.unique((q.astype(np.int64) * bins_ + at) * bands + size, return_inverse=True)
    rim = np.zeros(len(of), bool)
    for place in (position, -position):
        for far in (length, -length):
            order = np.lexsort((far, place, of))
            value = far[order] - far.min() - of[order] * (int(far.max()) - int(far.min()) + 1)  # those of a later cell are all less
            rim[order] |= value < np.append(value[0] + 1, np.minimum.accumulate(value)[:-1])
    rows = np.flatnonzero(rim)
    rows = rows[np.argsort(of[rows], kind="stable")]
    many = np.bincount(of[rows], minlength=len(cells))
    start = np.cumsum(many) - many
    label = np.arange(len(cells))

    def meeting(own: np.ndarray, key: np.ndarray, steps) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for bin_, band_ in steps:
            wanted = key + bin_ * bands + band_
            to = np.minimum(np.searchsorted(cells, wanted), len(cells) - 1)
            found.append((own[cells[to] == wanted], to[cells[to] == wanted]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    every, named = np.arange(len(cells)), np.flatnonzero(cells >= bins_ * bands)
    bare = cells[named] % (bins_ * bands)
    around = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0)]
    for own, key, steps in ((named, bare, [(0, 0)]), (every, cells, [(0, 1), (1, 0)]), (every, cells, [(1, -1), (1, 1)]), (named, bare, around)):
        a, b = meeting(own, key, steps)
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
        pairs = np.cumsum(many[a] * many[b])
        cut = [0, *np.unique(np.searchsorted(pairs, np.arange(block, pairs[-1], block)) + 1), len(a)] if len(a) else [0]
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            x, y = a[lo:hi], b[lo:hi]
            n = many[x] * many[y]
            which = np.repeat(np.arange(len(n)), n)
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            i, j = rows[start[x][which] + nth // many[y][which]], rows[start[y][which] + nth % many[y][which]]
            least, most = np.minimum(length[i], length[j]), np.maximum(length[i], length[j])
            good = (np.abs(position[i] - position[j]) <= distance) & (np.where(most > 0, least / np.maximum(most, 1), 1.0) >= similarity)
            linked = np.bincount(which[good], minlength=len(n)) > 0
            label = _joined(label, x[linked], y[linked])
    return label[of]
