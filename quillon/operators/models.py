"""Models: feature assembly, training with Spark ML, and factorised pair scoring."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import HashingTF, StandardScaler, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.session import saved, small_batches
from .similarity import matrix

#: Molecules and targets of a block of the grid, and neighbours that share a bound.
MOLECULES, TARGETS, NEAR = 4096, 64, 64
#: Blocks of targets that are wanted, and the most targets of a block where there are more.
TARGET_BLOCKS, MOST_TARGETS = 64, 4096
#: Molecules that are scored at once in single precision, and tasks of the grid at most.
SINGLE_ROWS, MOST_STEPS = 2048, 10_000
#: Rows of a step of a network's training, steps of a round at least, rows of a part at least, and its values at most.
STEP_ROWS, ROUND_STEPS, PART_ROWS, PART_CELLS = 128, 400, 16_384, 1 << 21


def text_features(df: DataFrame, text: str, bins: int = 256, out: str = "text_vec") -> DataFrame:
    """Hashed counts of blank-separated tokens; an empty text has the token ``<unknown>``."""
    tokens = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda x: x != "")
    df = df.withColumn("_tokens", F.when(F.size(tokens) > 0, tokens).otherwise(F.array(F.lit("<unknown>"))))
    return HashingTF(inputCol="_tokens", outputCol=out, numFeatures=bins).transform(df).drop("_tokens")


def signed_text_features(df: DataFrame, text: str, bins: int = 256, out: str = "text_vec") -> DataFrame:
    """Signed counts: one hash gives the bin and another bit the sign, so collisions cancel out.

    A text's tokens are hashed and summed by bin where the text is read, so neither texts nor tokens are shuffled: texts go by
    their digest, and each distinct one has one row of whole numbers.
    """
    value, taken = F.coalesce(F.col(text), F.lit("")), set(df.columns)
    key = next(k for k in ("_digest" + "_" * i for i in range(len(taken) + 1)) if k not in taken)
    digest = F.unhex(F.sha2(value, 256))
    tokens = F.filter(F.split(value, r"\s+"), lambda x: x != "")
    tokens = F.when(F.size(tokens) > 0, tokens).otherwise(F.array(F.lit("<unknown>")))
    hashed = df.select(digest.alias("_text"), F.transform(tokens, lambda t: F.xxhash64(t)).alias("_h"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = b.column("_h")
            at, h = np.repeat(np.arange(len(m)), m.value_lengths().to_numpy()), m.flatten().to_numpy()
            sign = np.where((h >> 40) & 1 == 0, 1, -1)
            whole = np.bincount(at * bins + h % bins, weights=sign, minlength=len(m) * bins).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("_text"), pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * bins, pa.int32()), pa.array(whole))], ["_text", "_dense"])

    small_batches(df.sparkSession)
    found = saved(hashed.mapInArrow(fill, "_text binary, _dense array<int>").dropDuplicates(["_text"]), "text-features")
    done = df.withColumn(key, digest).join(found, F.col(key) == F.col("_text")).withColumn(out, array_to_vector(F.col("_dense").cast("array<double>"))).drop("_text", "_dense", key)
    return VectorSizeHint(inputCol=out, size=bins, handleInvalid="optimistic").transform(done)


def assemble(pairs: DataFrame, left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Pairs with ``features``: each side is featurised once per key and then joined."""
    out = pairs.join(left, keys[0]).join(right, keys[1])
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="keep").transform(out)


def balanced(df: DataFrame, label: str = "label") -> DataFrame:
    """``weight``: both classes weigh the same in total."""
    n = df.groupBy(F.col(label).alias("_l")).agg(F.count("*").alias("_n"))
    total = n.agg(F.sum("_n").alias("_t"), F.count("*").alias("_k"))
    w = n.crossJoin(F.broadcast(total)).select("_l", (F.col("_t") / (F.col("_k") * F.col("_n"))).alias("weight"))
    return df.join(F.broadcast(w), F.col(label) == F.col("_l")).drop("_l")


def dealt(df: DataFrame) -> DataFrame:
    """``df`` in a part for each core at least: a small file is one split, and would be trained on by one task."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()))


def train_logistic(df: DataFrame, columns: Sequence[str], label: str = "label") -> PipelineModel:
    stages = [VectorAssembler(inputCols=list(columns), outputCol="features"), LogisticRegression(labelCol=label, weightCol="weight", regParam=1e-3, maxIter=50)]
    return Pipeline(stages=stages).fit(dealt(balanced(df, label)))


def _layers(flat: np.ndarray, sizes: Sequence[int]) -> list[np.ndarray]:
    """Weights of each layer, inputs by outputs with the bias as last row, in the order that Spark ML keeps them."""
    ends = np.cumsum([0, *[(i + 1) * o for i, o in zip(sizes, sizes[1:])]])
    return [flat[a:b].reshape(-1, o) for a, b, o in zip(ends, ends[1:], sizes[1:])]


def _outputs(layers: Sequence[np.ndarray], x: np.ndarray) -> list[np.ndarray]:
    """``x`` and what each layer makes of it: sigmoid units, at the end a softmax."""
    out = [x]
    for w in layers:
        v = out[-1] @ w[:-1] + w[-1]
        if w is layers[-1]:
            e = np.exp(v - v.max(axis=1, keepdims=True))
            out.append(e / e.sum(axis=1, keepdims=True))
        else:
            out.append(1 / (1 + np.exp(-np.clip(v, -60, 60))))
    return out


def _loss(layers: Sequence[np.ndarray], x: np.ndarray, y: np.ndarray) -> float:
    """Sum of the log losses, a few thousand rows at a time."""
    parts = [_outputs(layers, x[i : i + 4096])[-1][np.arange(len(y[i : i + 4096])), y[i : i + 4096]] for i in range(0, len(y), 4096)]
    return float(sum(-np.log(np.maximum(p, 1e-12), dtype=float).sum() for p in parts))


def _descend(layers: Sequence[np.ndarray], x: np.ndarray, y: np.ndarray, rng: np.random.Generator, rate: float) -> None:
    """Steps of Adam over all rows in random order, changing ``layers``: as many passes as make a round."""
    first, second, t = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers], 0
    for _ in range(-(-ROUND_STEPS * STEP_ROWS // len(y))):
        order = rng.permutation(len(y))
        for i in range(0, len(y), STEP_ROWS):
            some = order[i : i + STEP_ROWS]
            out, t = _outputs(layers, x[some]), t + 1
            back = out[-1].copy()
            back[np.arange(len(some)), y[some]] -= 1
            back /= len(some)
            for k in reversed(range(len(layers))):
                g = np.vstack([out[k].T @ back, back.sum(axis=0)])
                back = (back @ layers[k][:-1].T) * out[k] * (1 - out[k]) if k else None
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                layers[k] -= rate / (1 - 0.9**t) * first[k] / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)


def train_mlp(df: DataFrame, columns: Sequence[str], hidden: Sequence[int] = (256, 128), label: str = "label", seed: int = 42, *, rounds: int = 40, patience: int = 3, rate: float = 0.01) -> PipelineModel:
    """A network that stops early: it is trained as long as the loss on a tenth of the rows (by hash) falls, and the
    best weights are kept.

    Rows are dealt into parts, whose number grows with the rows.  In a round each part takes steps of Adam over all
    its rows from the same weights, and the parts' weights are averaged, so a round is one job that passes over the
    rows once (parts of few rows: a few times), where L-BFGS has a job for each single step.
    """
    sizes, held = [len(columns), *hidden, 2], F.pmod(F.xxhash64(*columns), F.lit(10)) == 0
    assembler, scaler = VectorAssembler(inputCols=list(columns), outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="features", withMean=True)
    prepare = Pipeline(stages=[assembler, scaler]).fit(df)
    n, n_held = df.agg(F.count("*"), F.count_if(held)).first()
    held = held if 0 < n_held < n else F.lit(None)  # all rows are for both
    parts = max(-(-n // max(PART_ROWS, PART_CELLS // len(columns))), min(df.sparkSession.sparkContext.defaultParallelism, n // PART_ROWS), 1)
    rows = prepare.transform(df).select(*columns, "features", F.col(label).cast("double").alias(label), held.alias("_held")).repartition(parts).sortWithinPartitions(*columns, label)
    rows = rows.select(vector_to_array("features", "float32").alias("x"), F.col(label).cast("int").alias("y"), "_held", "features", label).persist()

    def a_round(flat: np.ndarray, turn: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            got = [(b.column("x").flatten().to_numpy().reshape(-1, sizes[0]), b.column("y").to_numpy(), b.column("_held").to_pandas().to_numpy()) for b in batches if len(b)]
            if not got:
                return
            x, y, h = (np.concatenate(c) for c in zip(*got))
            judged, used = (h != False, h != True)  # noqa: E712 (null: both)
            layers = _layers(flat.copy(), sizes)
            loss = _loss(layers, x[judged], y[judged])
            if used.any():
                _descend(layers, x[used], y[used], np.random.default_rng([seed, turn, TaskContext.get().partitionId()]), rate)
            values = [[np.concatenate([w.ravel() for w in layers]).astype(float)], [float(used.sum())], [loss], [int(judged.sum())]]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["w", "n", "loss", "judged"])

        each = rows.select("x", "y", "_held").mapInArrow(run, "w array<double>, n double, loss double, judged long")
        return each.agg(Summarizer.mean(array_to_vector("w"), F.col("n")).alias("w"), (F.sum("loss") / F.sum("judged")).alias("loss")).first()

    rng = np.random.default_rng(seed)
    start = [np.vstack([rng.uniform(-1, 1, (i, o)) * (1 if o == 2 else 4) * np.sqrt(6 / (i + o)), np.zeros((1, o))]) for i, o in zip(sizes, sizes[1:])]
    flat = np.concatenate([w.ravel() for w in start]).astype(np.float32)
    best, worse = (np.inf, flat), 0
    for turn in range(rounds + 1):  # a round tells the loss of the weights that it starts from
        found = a_round(flat, turn)
        if found["loss"] < best[0] - 1e-4:
            best, worse = (found["loss"], flat), 0
        else:
            worse += 1
            if worse >= patience:
                break
        flat = found["w"].toArray().astype(np.float32)
    net = MultilayerPerceptronClassifier(layers=sizes, labelCol=label, maxIter=0, initialWeights=Vectors.dense(best[1].astype(float)))  # takes the weights as they are
    model = net.fit(rows.select("features", label).limit(1))
    rows.unpersist()
    return PipelineModel([*prepare.stages, model])


def train_forests(df: DataFrame, columns: Sequence[str], tasks: Sequence[str], trees: int = 100, depth: int = 15, seed: int = 42) -> dict[str, PipelineModel]:
    """One forest per task column; rows without that task's label are left out."""
    out = {}
    for t in tasks:
        rows = dealt(balanced(df.filter(F.col(t).isNotNull()), t))
        stages = [VectorAssembler(inputCols=list(columns), outputCol="features"), RandomForestClassifier(labelCol=t, weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed)]
        out[t] = Pipeline(stages=stages).fit(rows)
    return out


def predict(model: PipelineModel, df: DataFrame, out: str = "p") -> DataFrame:
    scored = model.transform(df)
    extra = [c for c in scored.columns if c not in df.columns]
    return scored.withColumn(out, vector_to_array("probability")[1]).drop(*extra)


def predict_tasks(models: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """``tasks``: a map from task to probability."""
    for name, m in models.items():
        df = predict(m, df, f"_p_{name}")
    pairs = [x for name in models for x in (F.lit(name), F.col(f"_p_{name}"))]
    return df.withColumn("tasks", F.create_map(*pairs)).drop(*[f"_p_{n}" for n in models])


def placed(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``df`` with ``_no``: places from 0 on in each group, in the order of a hash of the row.

    Rows are numbered within hash buckets, and buckets begin where the ones before end, so no task
    sorts a whole group.
    """
    hashed = df.withColumn("_h", F.xxhash64(F.lit("place"), *by, *columns)).withColumn("_bucket", F.shiftright("_h", 54))
    per = hashed.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1))
    starts = per.select(*by, "_bucket", F.coalesce(before, F.lit(0)).alias("_start"))
    place = F.row_number().over(W.partitionBy(*by, "_bucket").orderBy("_h", *columns))
    return hashed.withColumn("_place", place).join(starts, [*by, "_bucket"]).withColumn("_no", F.col("_start") + F.col("_place") - 1).drop("_h", "_bucket", "_place", "_start")


def partners(better: DataFrame, worse: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(by, columns, _w_columns): as many pairs of a group as its larger side has rows.

    Every row of the larger side comes once, with the row of the smaller side whose place is its own
    modulo that side's number, so every row is used and the work is linear.  Groups with rows on one
    side only have no pairs.
    """
    w = worse.select(*by, *[F.col(c).alias(f"_w_{c}") for c in columns])
    sides = [placed(better.select(*by, *columns), by, columns), placed(w, by, [f"_w_{c}" for c in columns])]
    n = [df.groupBy(*by).agg(F.count("*").alias(name)) for df, name in ((better, "_nb"), (worse, "_nw"))]
    both = n[0].join(n[1], list(by))
    a, b = (df.join(both, list(by)) for df in sides)
    small, large = F.least("_nb", "_nw"), F.col("_nb") >= F.col("_nw")
    out = [*by, *columns, *[f"_w_{c}" for c in columns]]
    keys = [*by, "_no"]
    by_better = a.filter(large).withColumn("_no", F.col("_no") % small).join(sides[1], keys).select(*out)
    by_worse = b.filter(~large).withColumn("_no", F.col("_no") % small).join(sides[0], keys).select(*out)
    return by_better.unionByName(by_worse)


def train_pairwise(better: DataFrame, worse: DataFrame, by: Sequence[str], columns: Sequence[str]) -> LogisticRegression:
    """Weights of a ranking function: a logistic model without intercept on differences.

    ``better`` and ``worse`` have ``by`` and the feature columns; ``partners`` pairs all their rows,
    and every difference comes once with either sign, so both labels occur.
    """
    d = partners(better, worse, by, columns).select(*[(F.col(c) - F.col(f"_w_{c}")).alias(c) for c in columns])
    both = d.withColumn("label", F.lit(1.0)).unionByName(d.select(*[(-F.col(c)).alias(c) for c in columns]).withColumn("label", F.lit(0.0)))
    rows = VectorAssembler(inputCols=list(columns), outputCol="features").transform(both)
    return LogisticRegression(fitIntercept=False, regParam=1e-4, maxIter=50).fit(dealt(rows))


def towers(left: int, right: int, hidden: tuple[int, int] = (32, 16), seed: int = 7) -> dict[str, np.ndarray]:
    """Weights of a two-tower network: relu, relu, logistic."""
    rng = np.random.default_rng(seed)
    g = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
    return {"left": g(left, hidden[0]), "right": g(right, hidden[0]), "b1": g(hidden[0]), "w2": g(*hidden), "b2": g(hidden[1]), "w3": g(hidden[1], 1), "b3": g(1)}


def plain_forward(x: np.ndarray, y: np.ndarray, net: dict[str, np.ndarray]) -> np.ndarray:
    """The network on one pair of feature rows, layer by layer."""
    h = np.maximum(np.concatenate([x, y]) @ np.concatenate([net["left"], net["right"]]) + net["b1"], 0)
    h = np.maximum(h @ net["w2"] + net["b2"], 0)
    return 1 / (1 + np.exp(-(h @ net["w3"] + net["b3"])))


def rule_towers(left: int, right: int, hidden: tuple[int, int] = (256, 64)) -> dict[str, np.ndarray]:
    """Weights by a rule that any engine can repeat: weight n of a layer, from 0, is sin(1 + 0.7 * n + 0.001 * n * n),
    over the root of the number of inputs; biases are cos(n) / 10."""
    def layer(rows: int, columns: int, first: int) -> np.ndarray:
        n = np.arange(rows * columns, dtype=np.float64).reshape(rows, columns) % 9973 + first
        return np.sin(1 + 0.7 * n + 0.001 * n * n) / np.sqrt(rows)

    bias = lambda n: np.cos(np.arange(n, dtype=np.float64)) / 10
    return {"left": layer(left, hidden[0], 0), "right": layer(right, hidden[0], 1), "b1": bias(hidden[0]), "w2": layer(*hidden, 2), "b2": bias(hidden[1]), "w3": layer(hidden[1], 1, 3), "b3": bias(1)}


def _sided(df: DataFrame, key: str, weights: np.ndarray, bias: np.ndarray | None, size: int, name: str) -> tuple[DataFrame, int]:
    """(block, n, ids, values), and the number of blocks: rows of ``key`` with their part of the first layer.

    Within a block rows are in order of their sum of parts, so that neighbours are alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, rows = TaskContext.get().partitionId() << 32, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal place, held, rows
            t = pa.Table.from_batches(held).combine_chunks()
            x = matrix(t.column("features").combine_chunks())
            part = np.pad(x, ((0, 0), (0, len(weights) - x.shape[1]))) @ weights + (0 if bias is None else bias)
            order = np.argsort(part.sum(axis=1), kind="stable")
            cells = [place, len(part), t.column(key).to_numpy()[order].tobytes(), part[order].tobytes()]
            place, held, rows = place + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(cells, [pa.int64(), pa.int64(), pa.binary(), pa.binary()])], ["_place", "n", "ids", "values"])

        for b in batches:
            while b.num_rows:
                part = b.slice(0, size - rows)
                held.append(part)
                rows += part.num_rows
                b = b.slice(part.num_rows)
                if rows == size:
                    yield flush()
        if rows:
            yield flush()

    plain = df.filter(F.col(key).isNotNull() & F.col("features").isNotNull()).select(F.col(key).cast("long").alias(key), F.transform("features", lambda x: F.coalesce(x.cast("double"), F.lit(0.0))).alias("features"))
    made = saved(plain.mapInArrow(run, "_place long, n long, ids binary, values binary"), name)
    number = made.select(F.col("_place").alias("_p"), (F.row_number().over(W.partitionBy(F.lit(0)).orderBy("_place")) - 1).alias("block"))  # a row per block
    return made.join(number, F.col("_place") == F.col("_p")).drop("_place", "_p"), made.count()


def _upper(low: np.ndarray, high: np.ndarray, net: dict[str, np.ndarray]) -> np.ndarray:
    """The most that the network can give for first layers between ``low`` and ``high`` before their relu."""
    low, high = np.maximum(low, 0), np.maximum(high, 0)
    plus, minus = np.maximum(net["w2"], 0), np.minimum(net["w2"], 0)
    top, bottom = np.maximum(high @ plus + low @ minus + net["b2"], 0), np.maximum(low @ plus + high @ minus + net["b2"], 0)
    return (top @ np.maximum(net["w3"], 0) + bottom @ np.minimum(net["w3"], 0) + net["b3"])[..., 0]


class Block:
    """A block of molecules with what all targets need of it: intervals of groups of neighbours, and a copy in single precision."""

    def __init__(self, left: np.ndarray, net: dict[str, np.ndarray]):
        cuts = np.arange(0, len(left), NEAR)
        self.left, self.group = left, np.arange(len(left)) // NEAR
        self.low, self.high, self.most = np.minimum.reduceat(left, cuts), np.maximum.reduceat(left, cuts), np.abs(left).max(axis=0)
        self.single = left.astype(np.float32)
        self.w2, self.b2, self.w3 = (net[c].astype(np.float32) for c in ("w2", "b2", "w3"))
        self.buffer = np.empty((min(len(left), SINGLE_ROWS), left.shape[1]), np.float32)

    def quick(self, part: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
        """Scores in single precision of ``rows``, or of all."""
        part, left, out = part.astype(np.float32), self.single if rows is None else self.single[rows], []
        for i in range(0, len(left), SINGLE_ROWS):
            some = left[i : i + SINGLE_ROWS]
            h = np.add(some, part, out=self.buffer[: len(some)])
            z = np.maximum(h, 0, out=h) @ self.w2
            z += self.b2
            out.append((np.maximum(z, 0, out=z) @ self.w3)[:, 0])
        return np.concatenate(out) if out else np.zeros(0, np.float32)

    def error(self, part: np.ndarray, net: dict[str, np.ndarray]) -> float:
        """The most that ``quick`` can be off: a rounding for each sum and product, on the sum of all values' sizes."""
        size = (self.most + np.abs(part)) @ np.abs(net["w2"]) + np.abs(net["b2"])
        return 1e-9 + 2.0**-24 * (sum(net["w2"].shape) + 16) * float(size @ np.abs(net["w3"])[:, 0])


def exact_scores(first: np.ndarray, net: dict[str, np.ndarray]) -> np.ndarray:
    """Scores of rows of first layers before their relu; equal rows have equal scores, whatever rows are beside them: products
    always have whole multiples of NEAR rows, and the last one is summed row by row."""
    h = np.zeros((-(-len(first) // NEAR) * NEAR, first.shape[1]))
    np.maximum(first, 0, out=h[: len(first)])
    return (np.maximum(h @ net["w2"] + net["b2"], 0)[: len(first)] * net["w3"][:, 0]).sum(axis=1) + net["b3"][0]


def best_of_block(left: np.ndarray | Block, ids: np.ndarray, part: np.ndarray, net: dict[str, np.ndarray], k: int, floor: float) -> tuple[np.ndarray, np.ndarray, int]:
    """(ids, scores, rows scored): molecules of a block that can be among a target's ``k`` best.

    Scores are those before the logistic function, which keeps their order.  Groups of NEAR neighbours have a bound by
    intervals; the most promising group is scored first, and then those whose bound reaches the k-th score.  They are
    scored in single precision, which only leaves out what is below the k-th score by more than its error.
    """
    block = left if isinstance(left, Block) else Block(left, net)
    bound = _upper(block.low + part, block.high + part, net) + 1e-9
    score = lambda rows: exact_scores(block.left[rows] + part, net)
    kth = lambda s: np.partition(s, len(s) - k)[len(s) - k] if len(s) >= k else -np.inf
    best = int(bound.argmax())
    first = np.arange(best * NEAR, min((best + 1) * NEAR, len(block.left)))
    floor = max(floor, kth(score(first)))
    chosen = bound >= floor
    chosen[best] = True
    rows = None if chosen.all() else np.flatnonzero(chosen[block.group])
    quick, error = block.quick(part, rows) + net["b3"][0], block.error(part, net)
    floor = max(floor, kth(quick) - error)
    some = np.flatnonzero(quick >= floor - error)
    some = some if rows is None else rows[some]
    scores = score(some)
    order = np.lexsort((ids[some], -scores))[:k]
    return ids[some[order]], scores[order], len(quick)


def pair_grid_top(molecules: DataFrame, targets: DataFrame, net: dict[str, np.ndarray], *, k: int = 100) -> DataFrame:
    """(target_id, rank, mol_id, score): each target's ``k`` best molecules of the whole grid.

    The first layer is a sum of a molecule and a target part, so either is computed once, in blocks of rows.
    Blocks of targets meet one block of molecules first, whose k-th scores are floors for all others: groups
    of molecules whose bound stays below the floor are not scored.  Every step hands on ``k`` rows per target at most,
    so the grid is never written.  A pair of blocks is a step that is sent both, so blocks of targets grow with their
    number: what is shuffled is the grid over the size of a block.  Null ids and features are left out; shorter vectors end in zeros.
    """
    small_batches(molecules.sparkSession)
    size = max(TARGETS, min(MOST_TARGETS, -(-targets.count() // TARGET_BLOCKS)))
    mols, n_mols = _sided(molecules, "mol_id", net["left"], None, MOLECULES, "grid-molecules")
    goals, n_goals = _sided(targets, "target_id", net["right"], net["b1"], size, "grid-targets")
    width = net["left"].shape[1]
    if not n_mols or not n_goals:
        return molecules.sparkSession.createDataFrame([], "target_id long, rank int, mol_id long, score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                cell = lambda c: b.column(c)[r].as_py()  # noqa: B023, E731
                ids, left = np.frombuffer(cell("ids"), np.int64), np.frombuffer(cell("values"), np.float64).reshape(-1, width)
                own, parts = np.frombuffer(cell("goal_ids"), np.int64), np.frombuffer(cell("goal_values"), np.float64).reshape(-1, width)
                floors, block = dict(cell("floors") or []), Block(left, net)
                found = [best_of_block(block, ids, p, net, k, floors.get(t, -np.inf)) for t, p in zip(own.tolist(), parts)]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, [len(f[0]) for f in found])), pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found]))], ["target_id", "mol_id", "_s"])

    goals = goals.select(F.col("block").alias("goal"), F.col("ids").alias("goal_ids"), F.col("values").alias("goal_values"))
    home = F.pmod(F.col("goal"), F.lit(n_mols)).cast("int")

    def meet(rows: DataFrame, where: Column, blocks: int) -> DataFrame:
        # dealt in turn to as many tasks as there are steps: they are few bytes for their work, and would be joined by these
        pairs = rows.withColumn("block", F.explode(where)).join(mols, "block").repartition(min(n_goals * blocks, MOST_STEPS))
        return saved(pairs.select("ids", "values", "goal_ids", "goal_values", "floors").mapInArrow(run, "target_id long, mol_id long, _s double"), "grid-found")

    none = F.lit(None).cast("map<bigint,double>")
    found = meet(goals.withColumn("floors", none), F.array(home), 1)
    if n_mols > 1:
        least = found.groupBy("target_id").agg(F.count("*").alias("_n"), F.min("_s").alias("_least")).filter(F.col("_n") == k)
        member = _members(goals)
        floors = member.join(least, "target_id").groupBy("goal").agg(F.map_from_entries(F.collect_list(F.struct("target_id", "_least"))).alias("floors"))  # a block of targets
        others = F.array_remove(F.sequence(F.lit(0), F.lit(n_mols - 1)), home)
        found = found.unionByName(meet(goals.join(floors, "goal", "left"), others, n_mols - 1))
    w = W.partitionBy("target_id").orderBy(F.col("_s").desc(), "mol_id")
    ranked = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select("target_id", "rank", "mol_id", (1 / (1 + F.exp(-F.col("_s")))).alias("score"))


def _members(goals: DataFrame) -> DataFrame:
    """(goal, target_id) of the blocks of targets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [np.frombuffer(x, np.int64) for x in b.column("goal_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column("goal").to_numpy(), [len(x) for x in ids]), pa.int32()), pa.array(np.concatenate(ids))], ["goal", "target_id"])

    return goals.select("goal", "goal_ids").mapInArrow(run, "goal int, target_id long")


def feature_cache(keys: DataFrame, existing: DataFrame, compute) -> DataFrame:
    """Cache rows: those there are, and ``compute`` of the keys that are missing (a failure keeps its
    status and isn't tried again)."""
    todo = keys.distinct().join(existing.select(*keys.columns), keys.columns, "left_anti")
    return existing.unionByName(compute(todo))
