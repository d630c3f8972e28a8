"""N-gram Jaccard join by size: subsets of small sets, inverted lists for large ones.

A document's set has its distinct word shingles.  Two sets link when ``den * |intersection| >=
num * |union|``.  Sets with equal members are one set from the first step on.

Small sets list subsets: two sets of sizes s and t link exactly if they share a subset of as many
members as the threshold asks for at these sizes, so every set up to the boundary lists its subsets
of these sizes, once for each size of partner.

Large sets go by inverted lists, in three steps.  One list per shingle for the whole corpus would hold
every document with a passage that many share, so the lists that find candidates have parts of sets as
their terms: the members of a set are dealt into one part more than two linking sets of that size class
can differ by, so at least one part is the same in both.  Members that are frequent in the corpus are
left out of the parts (two sets differ no more in what is left): a set that is mostly frequent members has
parts of all of its members.  The lists are scanned for pairs of sets whose sizes allow a link, and a pair
stays if the parities of its members, counted in buckets, leave room for the threshold (they differ in no
more buckets than the sets differ in members).  What is tied by such pairs, or by a list too long to take
pairs from, is a block.
Within a block every shingle has its list of sets; the lists are scanned, the rare ones entry by entry and
the common ones in bulk, and what two sets have in common is counted.

Blocks of copies may be large, so a few sets of a block represent it first: what links with one of them
is joined, and only sets outside the largest class are scanned against the whole block.  Blocks with
very many sets do this in rounds of Spark jobs, dealt into sides.

The boundary is where the subsets of all small sets cost more than the lists would.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import drop, save, small_batches, tidy
from .components import components, forest
from .shingles import mix, set_digests, shingle_groups

_U = np.uint64
#: Sets up to this size may be listed by subsets; the boundary is at most this.
SMALL_MOST = 40
#: Subsets that one set may list at most.
SUBSETS_MOST = 300
#: Keys or members that a task combines before it hands on.
CHUNK = 1 << 19
#: Members that are frequent: in more texts than one in ``FREQUENT_PART`` of all members of all texts, so
#: there are fewer of them than this, whatever the input (they go to every task, 8 bytes each), and in
#: ``FREQUENT_LEAST`` texts at least; members that a task sees twice in ``COUNTED`` are counted.  Any
#: choice gives the same classes.
FREQUENT_PART, FREQUENT_LEAST, COUNTED = 1 << 23, 8, 1 << 20
#: Sets of a list from which on it makes a block instead of pairs.
LIST_MOST = 64
#: Sets and members that a task holds of one block, or of one side of it.
SIDE_SETS, SIDE_MEMBERS = 2048, 1 << 19
#: Sets that represent a block, and sets from which on a task asks for representatives.
REPRESENTATIVES, DENSE = 32, 96
#: Counts of pairs that are added up at once.
PAIRS = 1 << 20


class Threshold:
    """What ``den * |intersection| >= num * |union|`` means for sizes."""

    def __init__(self, num: int, den: int):
        if not 0 < num <= den:
            raise ValueError("the similarity must be above 0 and at most 1")
        self.num, self.den, self.ratio = num, den, num / den

    def overlap(self, s: int, t: int) -> int:
        """Members that linking sets of sizes s and t share at least."""
        return -(-self.num * (s + t) // (self.num + self.den))

    def largest(self, s: int) -> int:
        """Size of the largest set that can link with one of size s."""
        return s * self.den // self.num

    def smallest(self, s: int) -> int:
        return -(-s * self.num // self.den)

    @lru_cache(maxsize=4096)  # noqa: B019
    def subset_sizes(self, s: int) -> tuple[tuple[int, int], ...]:
        """(subset size, partner size) of all partners of a set of size s."""
        return tuple((self.overlap(s, t), t) for t in range(self.smallest(s), self.largest(s) + 1) if self.overlap(s, t) <= min(s, t))

    @lru_cache(maxsize=4096)  # noqa: B019
    def subsets(self, s: int) -> int:
        return sum(comb(s, c) for c, _ in self.subset_sizes(s))

    @lru_cache(maxsize=4096)  # noqa: B019
    def classes(self, s: int) -> tuple[tuple[int, int], ...]:
        """(class, parts) of all pairs that a set of size s can be in, by the size of the larger set."""
        out = []
        for c in range(self._class(s), self._class(self.largest(s)) + 1):
            top = self._top(c)
            out.append((c, (self.den - self.num) * 2 * top // (self.den + self.num) + 1))
        return tuple(out)

    @property
    def rare_least(self) -> float:
        """Part of a set that must be rare for its rare members alone to be listed: two members, about,
        for each part."""
        return min(1.0, 2.25 * 1.25 * 2 * (self.den - self.num) / (self.den + self.num))

    def bases(self, size: np.ndarray, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether sets list parts of their rare members, and of all members.

        The rare parts of two linking sets differ by 1 - similarity at most (that is how far the uniform
        distributions over them are apart), so they have one basis in common.
        """
        share = rare / size
        return share >= self.rare_least, share < self.rare_least + 1 - self.ratio + 1e-9

    def _class(self, s: int) -> int:
        c = int(log(s) / -log(self.ratio)) if self.ratio < 1 else s
        while self._top(c) < s:
            c += 1
        while c and self._top(c - 1) >= s:
            c -= 1
        return c

    def _top(self, c: int) -> int:
        """Largest size of a class."""
        return ceil(self.ratio ** -(c + 1)) - 1 if self.ratio < 1 else c


def subset_keys(members: np.ndarray, t: Threshold) -> np.ndarray:
    """Keys of the subsets of a small set; none if there are too many."""
    s, out = len(members), []
    if s > SMALL_MOST or t.subsets(s) > SUBSETS_MOST:
        return np.zeros(0, _U)
    spread = mix(members + _U(0x632BE59BD9B4E019))
    for c, partner in t.subset_sizes(s):
        rows = np.array(list(combinations(range(s), c)), np.int64)
        with np.errstate(over="ignore"):
            pair = _U(min(s, partner) * 65536 + max(s, partner))
            out.append(mix(spread[rows].sum(axis=1, dtype=_U) + mix(np.array([pair]))[0]))
    return np.concatenate(out)


def part_keys(members: np.ndarray, per: np.ndarray, size: np.ndarray, t: Threshold, basis: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(keys, set) of the parts of sets, for each class of pairs that a set can be in.

    ``members`` has the members to deal of one set after the other, ``per`` their numbers, ``size`` the
    numbers of all members of the sets.  With ``spare`` parts more than needed, ``spare + 1`` parts are
    the same in two linking sets.  A set leaves out its smallest parts, up to ``spare`` of them and whole
    sizes only, so one of the parts they share is left: small parts are in many sets, and an empty one is
    the same in all.
    """
    sizes, which = np.unique(size, return_inverse=True)
    classes = [t.classes(s) for s in sizes.tolist()]
    spread, owner, keys, owners = mix(members + _U(0x8CB92BA72F3D8DD7)), np.repeat(np.arange(len(per)), per), [], []
    for n in range(max(map(len, classes), default=0)):
        own = np.array([x[min(n, len(x) - 1)] for x in classes], np.int64)[which]
        has = np.array([len(x) > n for x in classes])[which]
        parts = own[:, 1]
        total = np.where(has, parts + np.maximum(1, parts // 4), 0)
        first = np.cumsum(total) - total
        name = (2 * own[:, 0] + basis).astype(_U)
        use = has[owner]
        part = first[owner[use]] + (mix(members[use] + name[owner[use]]) % total[owner[use]].astype(_U)).astype(np.int64)
        count, sums = np.bincount(part, minlength=int(total.sum())), np.zeros(int(total.sum()), _U)
        np.add.at(sums, part, spread[use])
        of = np.repeat(np.arange(len(per)), total)
        ordered = np.sort((of << 32) + count)
        least = np.zeros(len(per), np.int64)
        least[has] = ordered[(first + total - parts)[has]] & 0xFFFFFFFF  # fewer than spare + 1 parts are smaller
        keep = np.flatnonzero(count >= least[of])
        of = of[keep]
        keys.append(mix(sums[keep] + mix(name[of] * _U(1 << 32) + (keep - first[of]).astype(_U))))
        owners.append(of)
    return (np.concatenate(keys), np.concatenate(owners)) if keys else (np.zeros(0, _U), np.zeros(0, np.int64))


def list_keys(members: np.ndarray, per: np.ndarray, frequent: np.ndarray, t: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """(keys, set) of sets in the lists that make blocks; ``frequent`` is ascending."""
    if not len(frequent):
        return part_keys(members, per, per, t)
    owner = np.repeat(np.arange(len(per)), per)
    rare = frequent[np.minimum(np.searchsorted(frequent, members), len(frequent) - 1)] != members
    n = np.bincount(owner[rare], minlength=len(per))
    by_rare, by_all = t.bases(per, n)
    out = []
    for use, chosen, basis in ((rare & by_rare[owner], by_rare, 1), (by_all[owner], by_all, 0)):
        at = np.flatnonzero(chosen)
        key, of = part_keys(members[use], np.bincount(owner[use], minlength=len(per))[at], per[at], t, basis)
        out.append((key, at[of]))
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.int64), pa.int64())


def _pairs(found: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_signed(found[:, 0]), _signed(found[:, 1])], ["a", "b"])


def pack(x: np.ndarray) -> bytes:
    """Numbers byte by byte, highest bytes last: runs of zeros shrink in the shuffle."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def unpack(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def parities(members: np.ndarray, per: np.ndarray) -> list[bytes]:
    """Of each set, whether an odd number of members is in each of as many buckets as it has members, about."""
    size = 1 << np.ceil(np.log2(np.maximum(per, 64))).astype(np.int64)
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(per)), per)
    slot = first[owner] + (members & (size[owner] - 1).astype(_U)).astype(np.int64)
    raw = np.packbits((np.bincount(slot, minlength=int(size.sum())) & 1).astype(np.uint8)).tobytes()
    return [raw[i // 8 : (i + k) // 8] for i, k in zip(first.tolist(), size.tolist())]


def may_link(a: bytes, b: bytes, s: int, t: int, least: Threshold) -> bool:
    """Whether sets of sizes s and t with these parities can link: of buckets that are twice as many, two
    are one."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    common = least.overlap(s, t)
    return common <= min(s, t) and int(np.bitwise_count(x ^ y).sum()) <= s + t - 2 * common


def describe(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(_id, _name, n_shingles, set_id, parity) of every row, and (member, texts): members that several of a task's sets have.

    ``_name`` is a hash of the text, by which a row is found again where ids are repeated or null.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_name"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    fields = ["_id", "_name", "n_shingles", "set_id", "parity", "member", "texts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, sets, held, null = set(), [], 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            member, n = np.unique(np.concatenate(sets), return_counts=True)
            member, n = member[n > 1], n[n > 1]
            m = len(member)
            for i in range(0, m, 65_536):
                part = slice(i, i + 65_536)
                yield pa.RecordBatch.from_arrays([pa.nulls(len(n[part]), null), *[pa.nulls(len(n[part]), pa.int64())] * 3, pa.nulls(len(n[part]), pa.binary()), _signed(member[part]), _signed(n[part])], fields)

        for b in batches:
            null = b.schema.field("_id").type
            for lo, hi, members, per in shingle_groups(b.column("_text"), k):
                name, end = set_digests(members, per), np.cumsum(per)
                yield pa.RecordBatch.from_arrays([b.column("_id").slice(lo, hi - lo), b.column("_name").slice(lo, hi - lo), _signed(per), pa.array(name, mask=per == 0), pa.array(parities(members, per), pa.binary()), *[pa.nulls(hi - lo, pa.int64())] * 2], fields)
                for x, i, j in zip(name.tolist(), (end - per).tolist(), end.tolist()):
                    if i < j and x not in seen:  # copies count once
                        seen.add(x)
                        sets.append(members[i:j])
                        held += j - i
                if held >= COUNTED:
                    yield from flush()
                    seen, sets, held = set(), [], 0
        if held:
            yield from flush()

    return rows.mapInArrow(tidy(run), f"_id {kind}, _name long, n_shingles long, set_id long, parity binary, member long, texts long")


def frequent_members(found: DataFrame, members: int) -> np.ndarray:
    """Frequent shingles, ascending, from the counts that ``describe`` makes over all texts.

    Tasks pack them, 8 bytes each, so the driver has no row per shingle.
    """
    least = max(FREQUENT_LEAST, members / FREQUENT_PART)
    rows = found.filter("member is not null").groupBy("member").agg(F.sum("texts").alias("n")).filter(F.col("n") >= least).select("member")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.column(0).to_numpy().tobytes()], pa.binary())], ["members"])

    raw = b"".join(bytes(r["members"]) for r in rows.mapInArrow(packed, "members binary").collect())
    return np.sort(np.frombuffer(raw, np.int64).astype(_U))


def _shortened(key: np.ndarray, node: np.ndarray, size: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, sets, their sizes, start of each list, ties): entries by key, each once; lists of more than
    ``most`` sets are tied and keep one more than that, so that they stay too long."""
    order = np.lexsort((node, key))
    key, node, size = key[order], node[order], size[order]
    once = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
    key, node, size = key[once], node[once], size[once]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    n = np.diff(np.append(start, len(key)))
    place = np.arange(len(key)) - np.repeat(start, n)
    long = np.repeat(n > most, n)
    tie = forest(np.stack([node, np.repeat(node[start], n)], 1)[long & (place > 0)])
    keep = ~long | (place <= most)
    key, node, size = key[keep], node[keep], size[keep]
    return key, node, size, np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), tie


def lists(docs: DataFrame, text_col: str, k: int, t: Threshold, small: int, buckets: int, frequent: np.ndarray) -> DataFrame:
    """(a, b, tied): pairs of sets that have a key in common and sizes that can link, once per range of
    keys; or, ``tied``, links that connect the sets of a list that is too long for pairs.

    Entries go by ranges of keys, packed into one row per range and chunk.  Of a key that very many sets
    have, a chunk hands on a few sets and the ties of the others.
    """
    rows = docs.select(F.col(text_col).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # FREQUENT_PART numbers at most

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, sizes, held, seen = [], [], [], 0, set()
        edge = (np.arange(1, buckets, dtype=np.float64) * (2.0**64 / buckets)).astype(_U)

        def flush() -> Iterator[pa.RecordBatch]:
            key, node, size, _, tie = _shortened(np.concatenate(keys), np.concatenate(nodes), np.concatenate(sizes), LIST_MOST)
            cut = np.searchsorted(key, edge).tolist()
            out = []
            for number, (i, j) in enumerate(zip([0, *cut], [*cut, len(key)])):
                if i < j:
                    own, at, place = np.unique(node[i:j], return_index=True, return_inverse=True)
                    out.append((number, pack(np.diff(key[i:j], prepend=_U(0))), pack(place.astype(np.uint32)), pack(own), pack(size[i:j][at].astype(np.uint32)), None))
            if len(tie):
                out.append((int(tie[0, 0] % buckets), None, None, None, None, tie.tobytes()))
            for i in range(0, len(out), 1000):
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out[i : i + 1000]], pa.int32()), *[pa.array([x[c] for x in out[i : i + 1000]], pa.binary()) for c in range(1, 6)]], ["bucket", "keys", "nodes", "names", "sizes", "ties"])

        for b in batches:
            for _, _, members, per in shingle_groups(b.column("_text"), k):
                name, owner = set_digests(members, per), np.repeat(np.arange(len(per)), per)
                fresh = per > 0
                for i, x in enumerate(name.tolist()):
                    if fresh[i]:
                        fresh[i] = x not in seen
                        seen.add(x)
                near = np.flatnonzero(fresh & (per <= small))
                for i, j in zip(near.tolist(), np.cumsum(per)[near].tolist()):
                    if t.subsets(int(per[i])) > 1:
                        keys.append(subset_keys(members[j - per[i] : j], t))
                        nodes.append(np.full(len(keys[-1]), name[i]))
                        sizes.append(np.full(len(keys[-1]), per[i]))
                        held += len(keys[-1])
                far = np.flatnonzero(fresh & (per * t.den // t.num > small))  # can link with a set above the boundary
                if len(far):
                    chosen = np.zeros(len(per), bool)
                    chosen[far] = True
                    key, of = list_keys(members[chosen[owner]], per[far], shared.value, t)
                    keys.append(key)
                    nodes.append(name[far[of]])
                    sizes.append(per[far[of]])
                    held += len(key)
                if held >= CHUNK:
                    yield from flush()
                    keys, nodes, sizes, held, seen = [], [], [], 0, set()
        if held:
            yield from flush()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, nodes, sizes, held = None, [], [], [], 0

        def found(pairs: np.ndarray, tied: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([_signed(pairs[:, 0]), _signed(pairs[:, 1]), pa.array(np.full(len(pairs), tied))], ["a", "b", "tied"])

        def close() -> Iterator[pa.RecordBatch]:
            key, node, size, start, tie = _shortened(np.concatenate(keys), np.concatenate(nodes), np.concatenate(sizes), LIST_MOST)
            yield found(tie, True)
            n = np.diff(np.append(start, len(key)))
            # all pairs of each list up to LIST_MOST: every entry with those after it
            after = np.repeat(start + n, n) - np.arange(len(key)) - 1
            after[np.repeat(n > LIST_MOST, n)] = 0
            upto, lo = np.cumsum(after), 0
            while lo < len(key):
                hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS, side="right")))
                n = after[lo:hi]
                a = np.repeat(np.arange(lo, hi), n)
                b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
                fits = t.den * np.minimum(size[a], size[b]) >= t.num * np.maximum(size[a], size[b])
                yield found(np.unique(np.stack([node[a[fits]], node[b[fits]]], 1), axis=0), False)
                lo = hi

        for b in batches:
            for bucket, key, node, name, size, tie in zip(*[b.column(c) for c in ("bucket", "keys", "nodes", "names", "sizes", "ties")]):
                if tie.is_valid:
                    yield found(np.frombuffer(tie.as_py(), np.int64).reshape(-1, 2), True)
                    continue
                if bucket.as_py() != now:
                    if keys:
                        yield from close()
                    now, keys, nodes, sizes, held = bucket.as_py(), [], [], [], 0
                place = unpack(node.as_py(), np.uint32)
                keys.append(np.cumsum(unpack(key.as_py(), np.uint64), dtype=_U))
                nodes.append(unpack(name.as_py(), np.int64)[place])
                sizes.append(unpack(size.as_py(), np.uint32)[place].astype(np.int64))
                held += len(keys[-1])
                if held >= 4 * CHUNK:  # lists of copies get short again
                    key, node, size, _, tie = _shortened(np.concatenate(keys), np.concatenate(nodes), np.concatenate(sizes), LIST_MOST)
                    yield found(tie, True)
                    keys, nodes, sizes, held = [key], [node], [size], 0
        if keys:
            yield from close()

    dealt = rows.mapInArrow(tidy(local), "bucket int, keys binary, nodes binary, names binary, sizes binary, ties binary")
    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(join), "a long, b long, tied boolean")


def likely(pairs: DataFrame, sets: DataFrame, t: Threshold) -> DataFrame:
    """(a, b): pairs whose parities leave room for the threshold; ``sets`` has (set_id, n_shingles, parity)."""
    side = lambda c: sets.select(F.col("set_id").alias(c), F.struct("n_shingles", "parity").alias(f"_{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = b.column("_a"), b.column("_b")
            rows = zip(x.field("parity").to_pylist(), y.field("parity").to_pylist(), x.field("n_shingles").to_pylist(), y.field("n_shingles").to_pylist())
            keep = pa.array([may_link(*row, t) for row in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], ["a", "b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "_a", "_b").mapInArrow(tidy(run), "a long, b long")


def boundary(sizes: dict[int, int], t: Threshold) -> int:
    """The largest size that is listed by subsets, where these cost least together with the lists.

    Sets up to the boundary list their subsets; sets that can link with one above it are in the lists,
    too.  ``sizes`` has the number of sets of each size up to ``SMALL_MOST``.
    """

    def cost(b: int) -> int:
        lists = sum(k * sum(p for _, p in t.classes(s)) for s, k in sizes.items() if t.largest(s) > b)
        return sum(k * t.subsets(s) for s, k in sizes.items() if s <= b) + lists

    allowed = [b for b in range(SMALL_MOST + 1) if all(t.subsets(s) <= SUBSETS_MOST for s in range(1, b + 1))]
    return min(allowed, key=lambda b: (cost(b), b))


def count_common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Members in common of each set of ``left`` with each of ``right``, by scanning inverted lists.

    Shingles that few sets have are scanned entry by entry; lists so long that most pairs are in them
    anyway are added up in bulk, as a product of 0/1 matrices (exact: whole numbers below 2**24).
    """
    n, m = len(left), len(right)
    common = np.zeros((n, m), np.float32)
    size = [np.array([len(x) for x in s], np.int64) for s in (left, right)]
    token, inverse = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    cut = int(size[0].sum())
    a, b = inverse[:cut], inverse[cut:]
    na, nb = np.bincount(a, minlength=len(token)), np.bincount(b, minlength=len(token))
    both = (na > 0) & (nb > 0)
    oa, ob = np.repeat(np.arange(n), size[0]), np.repeat(np.arange(m), size[1])
    work = na * nb
    bulk = both & (64 * work > n * m)
    rare = both & ~bulk
    # entry by entry: lists of both sides by shingle, and all places of each list's product
    pa_, pb_ = np.flatnonzero(rare[a]), np.flatnonzero(rare[b])
    pa_, pb_ = pa_[np.argsort(a[pa_], kind="stable")], pb_[np.argsort(b[pb_], kind="stable")]
    which = np.flatnonzero(rare)
    if len(which):
        fa, fb = np.cumsum(na[which]) - na[which], np.cumsum(nb[which]) - nb[which]
        upto = np.cumsum(work[which])
        flat, lo = common.reshape(-1), 0
        while lo < len(which):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS, side="right")))
            w = work[which[lo:hi]]
            of = np.repeat(np.arange(lo, hi), w)
            at = np.arange(len(of)) - np.repeat(np.cumsum(w) - w, w)
            width = nb[which[of]]
            np.add.at(flat, oa[pa_[fa[of] + at // width]] * m + ob[pb_[fb[of] + at % width]], np.float32(1))
            lo = hi
    column, n_bulk = np.cumsum(bulk) - 1, int(bulk.sum())
    ia, ib = np.flatnonzero(bulk[a]), np.flatnonzero(bulk[b])
    ia, ib = ia[np.argsort(a[ia], kind="stable")], ib[np.argsort(b[ib], kind="stable")]
    ca, cb = column[a[ia]], column[b[ib]]
    width = max(1, min(n_bulk, PAIRS // max(n, m)))
    for lo in range(0, n_bulk, width):
        x, y = np.zeros((n, width), np.float32), np.zeros((m, width), np.float32)
        i, j = np.searchsorted(ca, [lo, lo + width])
        x[oa[ia[i:j]], ca[i:j] - lo] = 1
        i, j = np.searchsorted(cb, [lo, lo + width])
        y[ob[ib[i:j]], cb[i:j] - lo] = 1
        common += x @ y.T
    return common


def linked(left: list[np.ndarray], right: list[np.ndarray], t: Threshold) -> np.ndarray:
    """(i, j) of linking sets of ``left`` and ``right``."""
    common, out = count_common(left, right), []
    size = [np.array([len(x) for x in s], np.int64) for s in (left, right)]
    for lo in range(0, len(left), 256):
        least = -(-t.num * (size[0][lo : lo + 256, None] + size[1][None, :]) // (t.num + t.den))
        found = np.argwhere(common[lo : lo + 256] >= least)
        found[:, 0] += lo
        out.append(found)
    return np.concatenate(out)


def classes_of(sets: list[np.ndarray], t: Threshold) -> np.ndarray:
    """(i, j) links that connect the linking sets of one block.

    In a block of many sets, some represent it first; sets of the largest class then found are not
    compared with each other again.
    """
    every, outside, trees, seen = np.arange(len(sets)), np.arange(len(sets)), [], np.zeros(len(sets), bool)
    while len(outside) > DENSE:
        some = outside[:: max(1, len(outside) // REPRESENTATIVES)][:REPRESENTATIVES]
        found = linked([sets[i] for i in some], sets, t)
        trees.append(np.stack([some[found[:, 0]], found[:, 1]], 1))
        label = labels(np.concatenate(trees), len(sets))
        seen[some] = True  # compared with all
        rest = np.flatnonzero((label != np.bincount(label).argmax()) & ~seen)
        if len(rest) > len(outside) // 2:
            outside = rest
            break
        outside = rest
    if len(outside):
        for lo in range(0, len(outside), 512):
            part = outside[lo : lo + 512]
            others = every if len(outside) < len(sets) else every[lo:]
            found = linked([sets[i] for i in part], [sets[i] for i in others], t)
            trees.append(np.stack([part[found[:, 0]], others[found[:, 1]]], 1))
    found = np.concatenate(trees) if trees else np.zeros((0, 2), np.int64)
    return forest(found[found[:, 0] != found[:, 1]])


def labels(links: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of its tree for each of ``n`` nodes."""
    out = np.arange(n)
    tree = forest(links[links[:, 0] != links[:, 1]])
    out[tree[:, 0]] = tree[:, 1]
    return out


def candidates(docs: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(set_id, block, sides, _text): the text of one document of each set of ``members``."""
    texts = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_name"), F.col(text_col).alias("_text"))
    same = F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_name") == F.col("_doc_name"))
    return texts.join(members.hint("shuffle_hash"), same).select("set_id", "block", "sides", "_text")


def _block_links(texts: DataFrame, k: int, t: Threshold) -> DataFrame:
    """(a, b): links among the sets of blocks that one task can hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sets = None, {}

        def step() -> pa.RecordBatch:
            found = classes_of(list(sets.values()), t)
            return _pairs(np.array(list(sets), np.int64)[found])

        for b in batches:
            block, name = b.column("block").to_numpy(), b.column("set_id").to_numpy()
            for lo, _, members, per in shingle_groups(b.column("_text"), k):
                digest, end = set_digests(members, per), np.cumsum(per)
                for i in np.flatnonzero(digest == name[lo : lo + len(per)]).tolist():
                    if block[lo + i] != now:
                        if len(sets) > 1:
                            yield step()
                        now, sets = block[lo + i], {}
                    sets[int(digest[i])] = members[end[i] - per[i] : end[i]].copy()
        if len(sets) > 1:
            yield step()

    return texts.select("block", "set_id", "_text").repartition("block").sortWithinPartitions("block").mapInArrow(tidy(run), "a long, b long")


def _packed(texts: DataFrame, k: int) -> DataFrame:
    """(set_id, block, n, members): sets of large blocks, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            name = b.column("set_id").to_numpy()
            for lo, hi, members, per in shingle_groups(b.column("_text"), k):
                at, end = np.flatnonzero(set_digests(members, per) == name[lo:hi]), np.cumsum(per)
                raw = pa.array([members[end[i] - per[i] : end[i]].tobytes() for i in at.tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("set_id").take(pa.array(at + lo)), b.column("block").take(pa.array(at + lo)), _signed(per[at]), raw], ["set_id", "block", "n", "members"])

    return texts.select("set_id", "block", "_text").mapInArrow(tidy(run), "set_id long, block long, n long, members binary")


def _steps(rows: DataFrame, t: Threshold) -> DataFrame:
    """(a, b) links from steps of (block, lo, hi): sets of side ``lo`` with those of side ``hi``.

    ``rows`` has (block, lo, hi, side, label, set_id, members).  The first side is held, the second one
    compared in parts; sets with one label are joined already.
    """
    rows = rows.repartition("block", "lo", "hi").sortWithinPartitions("block", "lo", "hi", (F.col("side") == F.col("hi")).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, part, size = None, [], [], 0

        def compare() -> Iterator[pa.RecordBatch]:
            first = part if now and now[1] == now[2] else held
            if first and part:
                found = linked([x[2] for x in first], [x[2] for x in part], t)
                names = np.array([x[0] for x in first], np.int64)[found[:, 0]], np.array([x[0] for x in part], np.int64)[found[:, 1]]
                label = np.array([x[1] for x in first], np.int64)[found[:, 0]], np.array([x[1] for x in part], np.int64)[found[:, 1]]
                yield _pairs(forest(np.stack(names, 1)[label[0] != label[1]]))

        for b in batches:
            columns = [b.column(c).to_numpy() for c in ("block", "lo", "hi", "side", "set_id", "label")]
            for i in range(b.num_rows):
                block, lo, hi, side, name, label = (int(c[i]) for c in columns)
                if (block, lo, hi) != now:
                    yield from compare()
                    now, held, part, size = (block, lo, hi), [], [], 0
                x = (name, label, np.frombuffer(b.column("members")[i].as_py(), _U))
                if side == hi:
                    part.append(x)
                    size += len(x[2])
                    if lo != hi and (len(part) >= SIDE_SETS or size >= SIDE_MEMBERS):
                        yield from compare()
                        part, size = [], 0
                else:
                    held.append(x)
        yield from compare()

    return rows.select("block", "lo", "hi", "side", "label", "set_id", "members").mapInArrow(tidy(run), "a long, b long")


def _large_links(sets: DataFrame, t: Threshold) -> DataFrame:
    """(a, b): links that connect the linking sets of blocks of any size.

    Rounds of representatives come first, as long as many sets are left outside their block's largest
    class and each round leaves less than half of them; a round is linear in the sets.  Those left are then
    compared with all others.
    """
    found, before = None, None
    side = lambda n, m: F.greatest(F.ceil(F.lit(2.0) * n / SIDE_SETS), F.ceil(F.lit(2.0) * m / SIDE_MEMBERS), F.lit(1)).cast("int")
    deal = lambda n: F.pmod(F.xxhash64("set_id"), n).cast("int")
    outside = save(sets.select("set_id", "block", "n", F.col("set_id").alias("label")).withColumn("outside", F.lit(True)), "jaccard-labels")
    for number in range(8):
        order = W.partitionBy("block").orderBy(F.xxhash64("set_id", F.lit(number)), "set_id")
        some = outside.filter("outside").withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= REPRESENTATIVES)
        some = some.withColumn("_upto", F.sum("n").over(order)).filter((F.col("_upto") <= SIDE_MEMBERS) | (F.col("_rank") == 1)).select("set_id")
        some = save(some, "jaccard-some")
        per = outside.groupBy("block").agg(side(F.count("*"), F.sum("n")).alias("_sides"))
        named = sets.join(per, "block").withColumn("label", F.col("set_id"))
        rows = named.select("block", F.lit(-1).alias("lo"), deal(F.col("_sides")).alias("hi"), "label", "set_id", "members")
        first = named.join(some, "set_id", "left_semi").withColumn("hi", F.explode(F.sequence(F.lit(0), F.col("_sides") - 1)))
        first = first.select("block", F.lit(-1).alias("lo"), "hi", F.lit(-1).alias("side"), "label", "set_id", "members")
        new = save(_steps(first.unionByName(rows.withColumn("side", F.col("hi"))), t), "jaccard-links")
        found = new if found is None else found.unionByName(new)
        tied = components(found)
        label = sets.select("set_id", "block", "n").join(tied, F.col("set_id") == F.col("node"), "left").select("set_id", "block", "n", F.coalesce("component", "set_id").alias("label"))
        count = label.groupBy("block", "label").agg(F.count("*").alias("_k"))
        main = count.groupBy(F.col("block").alias("_block")).agg(F.max_by("label", F.struct("_k", "label")).alias("_main"))
        seen = some.withColumn("_seen", F.lit(True)) if number == 0 else seen.unionByName(some.withColumn("_seen", F.lit(True)))
        rest = label.join(main, F.col("block") == F.col("_block")).join(seen, "set_id", "left")
        outside = save(rest.select("set_id", "block", "n", "label", ((F.col("label") != F.col("_main")) & F.col("_seen").isNull()).alias("outside")), "jaccard-labels")
        left = outside.filter("outside").count()
        if left <= SIDE_SETS or (before is not None and left > before / 2):
            break
        before = left
    if not left:
        return found
    # sets outside (sides 0 and on) meet each other and all others (sides -1 and down)
    per = outside.groupBy(F.col("block").alias("_block")).agg(
        F.count_if("outside").alias("_n"), side(F.count_if("outside"), F.sum(F.when(F.col("outside"), F.col("n")).otherwise(0))).alias("_out"), side(F.count_if(~F.col("outside")), F.sum(F.when(F.col("outside"), 0).otherwise(F.col("n")))).alias("_in")
    )
    rows = outside.join(per.filter("_n > 0"), F.col("block") == F.col("_block"))
    rows = rows.withColumn("side", F.when(F.col("outside"), deal(F.col("_out"))).otherwise(-1 - deal(F.col("_in"))))
    out = F.sequence(F.lit(0), F.col("_out") - 1)
    pairs = F.when(
        F.col("outside"),
        F.concat(F.transform(out, lambda o: F.struct(F.least("side", o).alias("lo"), F.greatest("side", o).alias("hi"))), F.transform(F.sequence(F.lit(0), F.col("_in") - 1), lambda o: F.struct((-1 - o).alias("lo"), F.col("side").alias("hi")))),
    ).otherwise(F.transform(out, lambda o: F.struct(F.col("side").alias("lo"), o.alias("hi"))))
    rows = rows.withColumn("_step", F.explode(pairs)).select("set_id", "block", "label", "side", "_step.lo", "_step.hi")
    new = _steps(rows.join(sets.select("set_id", "members"), "set_id"), t)
    return found.unionByName(save(new, "jaccard-links"))


def verify(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, k: int, t: Threshold) -> DataFrame:
    """(a, b): links that connect the linking sets of each block.

    ``members`` has (set_id, block, doc, n_shingles), one document per set, whose text is read again.
    Texts are shuffled once to find them and once by block.
    """
    block = members.groupBy(F.col("block").alias("_block")).agg(F.count("*").alias("_n"), F.sum("n_shingles").alias("_m")).filter("_n > 1")
    sides = F.when((F.col("_n") <= SIDE_SETS) & (F.col("_m") <= SIDE_MEMBERS), 1).otherwise(2)
    members = members.join(block, F.col("block") == F.col("_block")).select("set_id", "block", F.col("doc._id").alias("_doc"), F.col("doc._name").alias("_doc_name"), sides.alias("sides"))
    members = save(members, "jaccard-members")
    texts = save(candidates(docs, members, id_col, text_col), "jaccard-texts")
    if texts.count() > members.count():  # rows of one id and text, or with none and one text
        whole = texts
        texts = save(whole.dropDuplicates(["set_id"]), "jaccard-texts")
        drop(whole)
    links = save(_block_links(texts.filter("sides = 1"), k, t), "jaccard-small")
    if not members.filter("sides > 1").isEmpty():
        sets = save(_packed(texts.filter("sides > 1"), k), "jaccard-large")
        links = links.unionByName(_large_links(sets, t))
        drop(sets)
    drop(texts)
    drop(members)
    return links


def jaccard_classes(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: tuple[int, int] = (80, 100)
) -> DataFrame:
    """(id, n_shingles, set_id, component_id) of every row of ``docs``.

    Rows link when their sets of distinct ``words``-word shingles have a Jaccard similarity of at
    least ``similarity`` (a fraction, compared in whole numbers); component_id is the smallest id
    reachable by links.  A text with fewer words is one shingle.  Null texts and texts without words
    have an empty set, a null set_id, and link with nothing (component_id is their id).  Repeated
    rows are copies and so link; null ids are passed over when the smallest is taken.  An empty table
    gives no rows and other columns aren't looked at.  Sets are told apart by 64-bit digests.
    """
    t = Threshold(*similarity)
    spark = docs.sparkSession
    found = save(describe(docs, id_col, text_col, words), "jaccard-rows")
    rows = found.filter(F.col("member").isNull() & F.col("n_shingles").isNotNull()).select("_id", "_name", "n_shingles", "set_id", "parity")
    histogram = {r["n"]: r for r in rows.groupBy(F.least("n_shingles", F.lit(SMALL_MOST + 1)).alias("n")).agg(F.count("*").alias("k"), F.sum("n_shingles").alias("m")).collect()}
    total = sum(r["m"] for r in histogram.values())
    frequent = frequent_members(found, total)
    per = sum(p for _, p in t.classes(1000)) / 1000  # keys for each member of a large set
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(total * per / CHUNK))
    small = boundary({n: r["k"] for n, r in histogram.items() if 0 < n <= SMALL_MOST}, t)
    sets = rows.filter(F.col("set_id").isNotNull())
    firsts = [F.first(c).alias(c) for c in ("n_shingles", "parity")]
    of_set = save(sets.groupBy("set_id").agg(F.min("_id").alias("least"), F.max(F.struct("_id", "_name")).alias("doc"), *firsts), "jaccard-sets")
    pairs = save(lists(docs, text_col, words, t, small, buckets, frequent), "jaccard-pairs")
    near = likely(pairs.filter("not tied").select("a", "b").distinct(), of_set, t)
    blocks = save(components(pairs.filter("tied").select("a", "b").unionByName(near)), "jaccard-blocks")
    drop(pairs)
    members = of_set.join(blocks, F.col("set_id") == F.col("node")).select("set_id", F.col("component").alias("block"), "doc", "n_shingles")
    found = save(components(verify(docs, members, id_col, text_col, words, t)), "jaccard-components")
    whole = of_set.join(found, F.col("set_id") == F.col("node"), "left").select("set_id", "least", F.coalesce("component", "set_id").alias("component"))
    least = whole.groupBy("component").agg(F.min("least").alias("_least"))
    of_set = whole.join(least, "component").select(F.col("set_id").alias("_set"), "_least")
    return rows.join(of_set, F.col("set_id") == F.col("_set"), "left").select(
        F.col("_id").alias(id_col), "n_shingles", "set_id", F.coalesce("_least", "_id").alias("component_id")
    )


def op5_jaccard(spark, sf_dir: str) -> DataFrame:
    """Classes of documents whose 3-word shingles have a similarity of 0.9 or more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_classes(docs, words=3, similarity=(90, 100)).select("doc_id", "n_shingles", "component_id")
