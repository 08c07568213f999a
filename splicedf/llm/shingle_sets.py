"""Shingle sets of texts and the part signatures that any two similar sets share. Runs inside tasks, on Arrow batches."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash

#: Mean tokens of a part, and parts that every set gets besides.
PART_TOKENS, EXTRA_PARTS = 3.3, 16
#: A signature holds parts of at least this many tokens where enough of them exist.
PART_SIZES = (3, 2, 1)
#: Of the tokens in which similar sets may differ, the part that is signed besides.
MARGIN = 8
#: Words that a task remembers the hash of.
WORDS_KEPT = 1_000_000
C1, C2, C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
ONE = np.uint64(1)
S30, S27, S31, S32 = np.uint64(30), np.uint64(27), np.uint64(31), np.uint64(32)


class Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> S30)) * C2
    x = (x ^ (x >> S27)) * C3
    return x ^ (x >> S31)


def word_list(text: str | None) -> list[bytes]:
    """Lower-cases A-Z only, cuts at the six ASCII white-space characters only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def token_set(text: str | None, k: int, hashes: Hashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    words = word_list(text)
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - k + 1, 1)
    s = w[:n]
    for j in range(1, min(k, len(words))):
        s = s * C1 + w[j : j + n]
    s = np.sort(mixed(s))
    return s[np.append(True, s[1:] != s[:-1])]


@cache
def bounds(num: int, den: int, top: int = 1 << 33) -> np.ndarray:
    """Ends of size classes: a set of class k can be similar to sets of the classes k - 1, k and k + 1 only."""
    out = [1]
    while out[-1] < top:
        out.append(max(out[-1] + 1, (out[-1] - 1) * den // num + 1))
    return np.array(out)


@cache
def parts_of(k: int, num: int, den: int) -> int:
    """Parts of space k, where sets of class k meet those of class k and larger ones of class k + 1."""
    b = bounds(num, den)
    small = int(b[k + 1]) - 1
    return int(min(small * den // num, int(b[k + 2]) - 1) / PART_TOKENS) + 1 + EXTRA_PARTS


def part_signatures(tokens: np.ndarray, num: int, den: int) -> tuple[np.ndarray, list[int]]:
    """Hashes of parts of the set, so that similar sets, unless equal, share some; and at least how many they share.

    The range of hashes is cut into parts. A set differs from any similar one in at most d tokens, so in at most d parts;
    if it has p parts of at least s tokens, p more than d, it shares p - d of these whole. s is the largest for which
    that is an eighth of d. Of two sets the one with the larger s has such parts, and the other signs them too, as it
    signs smaller ones as well: the two share at least the lesser of their p - d. A set with no more than d parts in all
    signs all of them and each of its tokens besides: beside a set with more parts the above holds, and of two such sets,
    which share a token if they are similar, both sign that. The last bit of a signature tells the parity of its space;
    the second result has what must be shared in spaces of either parity.
    """
    need = [1, 1]
    n = len(tokens)
    if not n:
        return tokens, need
    b = bounds(num, den)
    k = int(np.searchsorted(b, n, "right")) - 1
    out = []
    for at in (k - 1, k) if k else (k,):
        other = int(b[k]) - 1 if at < k else min(n * den // num, int(b[k + 2]) - 1)
        d, m = (n + other) * (den - num) // (den + num), parts_of(at, num, den)
        if d == 0:
            continue
        part = ((tokens >> S32) * np.uint64(m)) >> S32
        counts = np.bincount(part.astype(np.int64), minlength=m)
        enough = d + max(1, d // MARGIN)
        s = next((s for s in PART_SIZES if np.count_nonzero(counts >= s) >= enough), 1)
        used = np.flatnonzero(counts)
        sums = np.add.reduceat(tokens, np.concatenate(([0], np.cumsum(counts[used])[:-1])))
        big = counts[used] >= s
        space = C2 * np.array([at + 1], np.uint64)
        own = mixed(mixed(sums[big]) + used[big].astype(np.uint64) * C1 + space)
        if len(used) <= d:
            own = np.concatenate((own, mixed(mixed(tokens + C3) + space)))
        need[at % 2] = max(1, int(np.count_nonzero(big)) - d)
        out.append(own & ~ONE | np.uint64(at % 2))
    return np.concatenate(out) if out else np.empty(0, np.uint64), need


def class_key(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(tokens.tobytes())).astype(np.int64)) if len(tokens) else 0


def sets_of(k: int, num: int, den: int):
    """mapInArrow: (_id, text, th) to (_id, th, n, cls, need0, need1, sigs)."""

    def run(batches):
        hashes = Hashes()
        for batch in batches:
            n, cls, needs, sigs, ends = [], [], ([], []), [], [0]
            for text in batch.column(1).to_pylist():
                t = token_set(text, k, hashes)
                s, need = part_signatures(t, num, den)
                for x, of in zip(needs, need):
                    x.append(of)
                n.append(len(t))
                cls.append(class_key(t))
                sigs.append(s)
                ends.append(ends[-1] + len(s))
            values = np.concatenate(sigs).view(np.int64) if sigs else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), *(pa.array(x, pa.int32()) for x in needs), lists], ["_id", "th", "n", "cls", "need0", "need1", "sigs"])

    return run


def overlaps(k: int):
    """mapInArrow: (a, b, text_a, text_b) to (a, b, common, total)."""

    def run(batches):
        hashes = Hashes()
        for batch in batches:
            common, total = [], []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                p, q = token_set(x, k, hashes), token_set(y, k, hashes)
                both = len(np.intersect1d(p, q, assume_unique=True))
                common.append(both)
                total.append(len(p) + len(q) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(total, pa.int64())], ["a", "b", "common", "total"])

    return run


class Group:
    """A column block of the token-group matrix: the union of its members' tokens, and which members hold each."""

    def __init__(self, members: list[dict], k: int, hashes: Hashes):
        self.keys, self.comps = [m["cls"] for m in members], [m["comp"] for m in members]
        self.sets = [token_set(m["text"], k, hashes) for m in members]
        self.sizes = np.array([len(s) for s in self.sets])
        tokens, owners = np.concatenate(self.sets), np.repeat(np.arange(len(members)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.owners = owners[order]
        self.union, first, counts = np.unique(tokens[order], return_index=True, return_counts=True)
        self.first, self.counts, self.least = first, counts, int(self.sizes.min())

    def common_with(self, query: np.ndarray, least: float) -> np.ndarray | None:
        """Tokens that each member shares with the query; None if the union shares fewer than `least`: it stays shut."""
        at = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        at = at[self.union[at] == query]
        if len(at) < least:
            return None
        counts = self.counts[at]
        ends = np.cumsum(counts)
        rows = np.repeat(self.first[at] - ends + counts, counts) + np.arange(ends[-1]) if len(at) else at
        return np.bincount(self.owners[rows], minlength=len(self.sizes))


def opened(k: int, num: int, den: int):
    """mapInArrow: (group, queries, members), two lists of (cls, comp, text), to links (a, b) that connect components.

    Similar sets of p and q tokens share num / (num + den) of p + q at least, and none is smaller than num / den of the
    other. So a group is opened for a query only if its union shares what its smallest possible match would. Of the links found, those are returned that join components not yet joined here.
    """

    def run(batches):
        hashes, last, group = Hashes(), None, None
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for i, of in enumerate(batch.column(0).to_pylist()):
                queries = batch.column(1)[i].as_py()
                if group is None or of != last:
                    last, group = of, Group(batch.column(2)[i].as_py(), k, hashes)
                top: dict = {}

                def root(c, top=top):
                    while top.get(c, c) != c:
                        c = top[c]
                    return c

                for q in queries:
                    tokens = token_set(q["text"], k, hashes)
                    common = group.common_with(tokens, num / (num + den) * (len(tokens) + max(group.least, len(tokens) * num / den)) - 1e-6)
                    if common is None:
                        continue
                    for i in np.flatnonzero(common * den >= (group.sizes + len(tokens) - common) * num):
                        x, y = root(q["comp"]), root(group.comps[i])
                        if x != y:
                            top[x] = y
                            out[0].append(q["cls"])
                            out[1].append(group.keys[i])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["a", "b"])

    return run
