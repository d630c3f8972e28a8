"""Periodic runs of words, found in a grammar of the texts.

The word ids of a few thousand texts are compressed by Re-Pair: pairs that occur twice become
nonterminals, frequent pairs first.  A run that is not inside one half of a nonterminal crosses the
boundary between its halves, so each nonterminal is looked at once, however often its words occur:
a run of four periods or more has two whole periods on one side of the boundary, and so a square that
ends or begins there.  What no nonterminal covers, the symbols that are left of each text, is a balanced
tree of pairs, with boundaries of its own.  The runs of a nonterminal then go to all its places in the
derivation, and intervals of one period that lie in another are dropped: every run of a text is whole at
the lowest node that holds it.

Stretches are compared by hashes of the ids; what is reported has been compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.session import small_batches
from .common import free_name, tidy

#: A run has at least so many words, and so many periods (the search needs four).
WORDS, PERIODS = 6, 4
#: Words of texts that share a grammar (a longer text has its own), and tests made at once.
BATCH, TESTS = 400_000, 1 << 20
#: Compression ends with the round that replaces less than this part of the symbols.
WORTH = 0.01
SEED = 20_011

TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Nodes(NamedTuple):
    """Nodes of a derivation: the places of the text where the first half begins, the second begins and ends."""

    low: np.ndarray
    middle: np.ndarray
    high: np.ndarray


class Grammar(NamedTuple):
    """``start`` has the symbols left and ``at`` their places; rule k is symbol ``base + k``."""

    start: np.ndarray
    at: np.ndarray
    base: int
    left: np.ndarray
    right: np.ndarray
    nodes: Nodes
    rounds: list[int]


def re_pair(ids: np.ndarray, base: int) -> Grammar:
    """Grammar of ``ids``, whose symbols are below ``base``.

    A round replaces every repeated pair where no more frequent pair overlaps it.
    """
    seq, at, top = ids.astype(np.int64), np.arange(len(ids) + 1), base
    rules: list[tuple[np.ndarray, ...]] = []
    rounds = [0]
    while len(seq) > 1:
        _, pair, count = np.unique(seq[:-1] * top + seq[1:], return_inverse=True, return_counts=True)
        rank = np.empty(len(count), np.int64)
        rank[np.argsort(count, kind="stable")] = np.arange(len(count))
        rank = np.where(count[pair] > 1, rank[pair], -1)
        near = np.concatenate([[-1], rank, [-1]])
        chosen = (rank >= 0) & (rank >= near[:-2]) & (rank >= near[2:])
        # a pair that overlaps itself: every second place
        streak = np.concatenate([[False], chosen[1:] & chosen[:-1] & (rank[1:] == rank[:-1])])
        place = np.arange(len(rank))
        chosen &= (place - np.maximum.accumulate(np.where(streak, 0, place))) % 2 == 0
        chosen &= np.bincount(pair[chosen], minlength=len(count))[pair] > 1
        where = np.flatnonzero(chosen)
        if not len(where):
            break
        _, first, new = np.unique(pair[where], return_index=True, return_inverse=True)
        i = where[first]
        rules.append((seq[i], seq[i + 1], at[i], at[i + 1], at[i + 2]))
        seq[where] = top + new
        seq, at = np.delete(seq, where + 1), np.delete(at, where + 1)
        top += len(first)
        rounds.append(top - base)
        if len(where) < WORTH * len(seq):
            break
    left, right, *nodes = (np.concatenate(x) for x in zip(*rules)) if rules else [np.zeros(0, np.int64)] * 5
    return Grammar(seq, at[:-1], base, left, right, Nodes(*nodes), rounds)


def balanced(at: np.ndarray, end: np.ndarray, doc: np.ndarray) -> Nodes:
    """Nodes of a balanced tree over the symbols of each text; symbols are in order."""
    found: list[tuple[np.ndarray, ...]] = []
    while len(doc):
        number = np.arange(len(doc)) - np.searchsorted(doc, doc)
        first = number % 2 == 0
        twin = first & np.concatenate([doc[1:] == doc[:-1], [False]])
        i = np.flatnonzero(twin)
        if not len(i):
            break
        found.append((at[i], at[i + 1], end[i + 1]))
        end = end.copy()
        end[i] = end[i + 1]
        at, end, doc = at[first], end[first], doc[first]
    return Nodes(*((np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 3))


class Hashes:
    """Prefix sums of random numbers of the ids times powers, in 64 bits."""

    def __init__(self, ids: np.ndarray):
        rng = np.random.default_rng(SEED)
        power = np.full(len(ids) + 1, rng.integers(1 << 62, dtype=np.uint64) * np.uint64(2) + np.uint64(1), np.uint64)
        power[0] = 1
        self.power = np.multiply.accumulate(power)
        numbers = rng.integers(0, 1 << 63, int(ids.max(initial=0)) + 1, np.uint64)
        self.sum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers[ids] * self.power[:-1], dtype=np.uint64)])

    def same(self, i: np.ndarray, q: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether n words from i on are those from i + q on (or, rarely, have the same hash)."""
        return (self.sum[i + n] - self.sum[i]) * self.power[q] == self.sum[i + q + n] - self.sum[i + q]


def _longest(same, most: np.ndarray) -> np.ndarray:
    """Largest n up to ``most`` for which ``same(rows, n)`` holds; it holds for all smaller n."""
    low, high = np.zeros(len(most), np.int64), most.copy()
    rows = np.flatnonzero(high > 0)
    while len(rows):
        n = (low[rows] + high[rows] + 1) // 2
        yes = same(rows, n)
        low[rows[yes]] = n[yes]
        high[rows[~yes]] = n[~yes] - 1
        rows = rows[low[rows] < high[rows]]
    return low


def _periods(most: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, q) for q from 1 to each row's ``most``, about TESTS at a time."""
    ends = np.cumsum(most)
    for begin in range(0, int(ends[-1]) if len(ends) else 0, TESTS):
        end = min(begin + TESTS, int(ends[-1]))
        a, b = np.searchsorted(ends, begin, "right"), np.searchsorted(ends, end, "left")
        starts = ends[a : b + 1] - most[a : b + 1]
        low, high = np.maximum(starts, begin), np.minimum(ends[a : b + 1], end)
        row = np.repeat(np.arange(a, b + 1), high - low)
        yield row, np.arange(begin, end) - (ends - most)[row] + 1


def _exact(ids: np.ndarray, low: int, high: int, x: int, q: int) -> tuple[int, int] | None:
    """The stretch of period q in [low, high) that holds the square at x, if it is one."""
    same = ids[low : high - q] == ids[low + q : high]
    breaks = np.flatnonzero(~same) + low
    k = np.searchsorted(breaks, x)
    if k < len(breaks) and breaks[k] < x + q:
        return None
    return int(breaks[k - 1]) + 1 if k else low, int(breaks[k]) + q if k < len(breaks) else high


def crossing(ids: np.ndarray, hashes: Hashes, nodes: Nodes) -> np.ndarray:
    """(node, start, end, period) of the runs, within each node's words, that cross its boundary."""
    whole = np.flatnonzero(nodes.high - nodes.low >= WORDS)
    low, middle, high = (x[whole] for x in nodes)
    found = []
    for ends_here in (True, False):
        most = np.minimum((middle - low if ends_here else high - middle) // 2, (high - low) // PERIODS)
        for row, q in _periods(most):
            m = middle[row]
            one = ids[m - 1] == ids[m - 1 - q] if ends_here else ids[m] == ids[m + q]
            row, q, m = row[one], q[one], m[one]
            x = m - 2 * q if ends_here else m
            square = hashes.same(x, q, q)
            row, q, x = row[square], q[square], x[square]
            before = _longest(lambda r, n: hashes.same(x[r] - n, q[r], n), x - low[row])  # noqa: B023
            after = _longest(lambda r, n: hashes.same(x[r] + q[r], q[r], n), high[row] - x - 2 * q)  # noqa: B023
            start, end = x - before, x + 2 * q + after
            keep = (end - start >= np.maximum(WORDS, PERIODS * q)) & (start < middle[row]) & (end > middle[row])
            found.append(np.stack([row, start, end, q, x], 1)[keep])
    all_runs = np.concatenate(found) if found else np.zeros((0, 5), np.int64)
    checked = []
    # the smallest period of a stretch is found with its multiples, at the same node
    all_runs = all_runs[np.lexsort(all_runs.T[[3, 2, 1, 0]])]
    new = np.ones(len(all_runs), bool)
    new[1:] = (all_runs[1:, :3] != all_runs[:-1, :3]).any(axis=1)
    for row, start, end, q, x in all_runs[new].tolist():
        if not np.array_equal(ids[start : end - q], ids[start + q : end]):  # a hash was wrong
            own = _exact(ids, int(low[row]), int(high[row]), x, q)
            if own is None or own[1] - own[0] < max(WORDS, PERIODS * q):
                continue
            start, end = own
            if any(q % d == 0 and np.array_equal(ids[start : end - d], ids[start + d : end]) for d in range(1, q)):
                continue
        checked.append((int(whole[row]), start, end, q))
    return np.array(sorted(set(checked)), np.int64).reshape(-1, 4)


def derive(grammar: Grammar, runs: np.ndarray) -> np.ndarray:
    """(start, end, period) of the runs of rules at all places where their rules stand."""
    n = len(grammar.left)
    has = np.bincount(runs[:, 0], minlength=n)
    within = has > 0
    inside = lambda s: (s >= grammar.base) & within[np.maximum(s - grammar.base, 0)]
    for a, b in zip(grammar.rounds, grammar.rounds[1:]):
        within[a:b] |= inside(grammar.left[a:b]) | inside(grammar.right[a:b])
    first = np.cumsum(has) - has
    found = []
    if n:
        keep = inside(grammar.start)
        rule, place = grammar.start[keep] - grammar.base, grammar.at[keep]
        while len(rule):
            times = has[rule]
            at = np.repeat(place - grammar.nodes.low[rule], times)
            k = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first[rule], times)
            found.append(np.stack([runs[k, 1] + at, runs[k, 2] + at, runs[k, 3]], 1))
            half = place + grammar.nodes.middle[rule] - grammar.nodes.low[rule]
            symbol, place = np.concatenate([grammar.left[rule], grammar.right[rule]]), np.concatenate([place, half])
            keep = inside(symbol)
            rule, place = symbol[keep] - grammar.base, place[keep]
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def runs_of(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For each array of word ids its runs: rows (start, length, period) by start, then period."""
    if not texts:
        return []
    base = max((int(x.max(initial=-1)) for x in texts), default=-1) + 1
    ends = np.cumsum([len(x) + 1 for x in texts])
    begins = ends - [len(x) + 1 for x in texts]
    ids = np.empty(int(ends[-1]), np.int64)
    for k, (x, b) in enumerate(zip(texts, begins)):
        ids[b : b + len(x)] = x
        ids[b + len(x)] = base + k  # ends a text; no pair with it repeats
    grammar, hashes = re_pair(ids, base + len(texts)), Hashes(ids)
    text = np.flatnonzero((grammar.start < base) | (grammar.start >= base + len(texts)))
    end = np.append(grammar.at, len(ids))[text + 1]
    tree = balanced(grammar.at[text], end, np.searchsorted(ends, grammar.at[text], "right"))
    every = np.concatenate([derive(grammar, crossing(ids, hashes, grammar.nodes)), crossing(ids, hashes, tree)[:, 1:]])
    doc = np.searchsorted(ends, every[:, 0], "right")
    order = np.lexsort((-every[:, 1], every[:, 0], every[:, 2], doc))
    every, doc = every[order], doc[order]
    group = np.cumsum(np.concatenate([[0], (doc[1:] != doc[:-1]) | (every[1:, 2] != every[:-1, 2])])) if len(doc) else doc
    reach = np.maximum.accumulate(group * (len(ids) + 1) + every[:, 1])
    outer = np.ones(len(doc), bool)
    outer[1:] = reach[1:] > np.maximum(reach[:-1], group[1:] * (len(ids) + 1))
    every, doc = every[outer], doc[outer]
    rows = np.stack([every[:, 0] - begins[doc], every[:, 1] - every[:, 0], every[:, 2]], 1)
    order = np.lexsort((rows[:, 2], rows[:, 0], doc))
    return np.split(rows[order], np.searchsorted(doc[order], np.arange(1, len(texts))))


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words, but those that a run repeats after its first period."""
    if not len(runs):
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()])


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Rows and their words, in parts of about BATCH words."""
    for b in batches:
        text = b.column(b.schema.get_field_index("_text")).cast(pa.binary())
        begin, held, size = 0, [], 0
        for i in range(b.num_rows):
            words = (text[i].as_py() or b"").split()  # at the six white-space characters of ASCII
            if held and size + len(words) > BATCH:
                yield b.slice(begin, i - begin), held
                begin, held, size = i, [], 0
            held.append(words)
            size += len(words)
        if held:
            yield b.slice(begin), held


def find_runs(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``runs`` (an array of start, length, period in words) and ``collapsed`` (the text without repeats).

    Words are what stands between ASCII white space.  A run is a stretch of at least six words and four
    periods that no neighbouring word extends; it has its smallest period.  Runs are in order of start, then
    period.  ``collapsed`` has the words, joined by single spaces, that no run has after its first period.

    Null and empty texts, and texts of white space, have no runs and an empty ``collapsed``; repeated rows have
    the same result each; an empty table gives no rows; a text of any length is one piece of work, in memory
    in proportion to its words; other columns stay, and columns called ``runs`` or ``collapsed`` are replaced.
    """
    small_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c.lower() not in ("runs", "collapsed")]
    row = free_name("_row", rest)
    sent = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias(row), F.col(f"`{text_col}`").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))
        for rows, words in _grouped(batches):
            ids = pa.array([w for x in words for w in x], pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            cuts = np.cumsum([len(x) for x in words])
            found = runs_of([ids[e - len(x) : e] for x, e in zip(words, cuts)])
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum([len(x) for x in found])]), pa.int32()),
                pa.StructArray.from_arrays([pa.array(np.concatenate([x[:, c] for x in found]), pa.int64()) for c in range(3)], ["start", "length", "period"]),
            ).cast(kind)
            collapsed = pa.array([collapse(x, r) for x, r in zip(words, found)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([rows.column(0), lists, collapsed], ["_row", "runs", "collapsed"])

    inner = sent.schema[row].dataType.simpleString()
    out = sent.mapInArrow(tidy(run), f"_row {inner}, runs {TYPE}, collapsed string")
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in rest], "runs", "collapsed")


def _periodic(text: Column, h: Column) -> Column:
    """The query's rule: from word a on, the p words there come again and again."""
    g = F.floor(h / 10)

    def rule(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + (i - a) % p).cast("int"))))

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    done = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, F.array_join(rule(w), " ")))[0]  # words are made once
    return F.when(h % 10 == 0, F.coalesce(done, text)).otherwise(text)


def op13_runs(spark, sf_dir: str) -> DataFrame:
    """Runs and collapsed texts of all documents, as numbers and digests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.withColumn("text", _periodic(F.col("text"), F.crc32(F.col("doc_id").cast("string"))))
    found = find_runs(docs)
    best = F.reduce("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda m, r: F.when(m.isNull() | (r.length > m.length), r).otherwise(m))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: Every pair of equal words of a text, as far apart as a period can be; stretches of pairs at one distance are runs.
OP13_SQL = r"""
WITH c AS (
  SELECT doc_id, text, xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT),
    lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))) AS h FROM documents),
o AS (SELECT doc_id, h, h // 10 AS g, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM c),
m AS (SELECT *, len(w) AS n, g % len(w) AS a, 1 + (len(w) - g % len(w)) // (3 + g % 8) AS p FROM o),
d AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM m),
t AS (SELECT doc_id, n, unnest(w) AS x, unnest(range(len(w))) AS i FROM d),
e AS (SELECT l.doc_id, r.i - l.i AS q, l.i FROM t l JOIN t r ON l.doc_id = r.doc_id AND l.x = r.x AND r.i > l.i AND 4 * (r.i - l.i) <= l.n),
f AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM e) GROUP BY doc_id, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM f GROUP BY ALL),
b AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines, arg_min({'s': start, 'l': length, 'p': period}, (-length, start, period)) AS best FROM r GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS kept FROM t WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = t.doc_id AND t.i >= start + period AND t.i < start + length) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period, 1000 * best.l // best.p AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN k USING (doc_id)
"""
