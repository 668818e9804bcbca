"""Fit of a multilayer perceptron over blocks of rows (M6).

The objective and the steps are those of MLlib's classifier, whose model the fit returns: sigmoid layers under a softmax, the
mean over stacks of ``STACK`` rows of their mean cross-entropy, L-BFGS with a line search for the strong Wolfe conditions.
Stacks are packed once into blocks, dealt evenly to the tasks of all passes; tasks multiply matrices in numpy and add up their
blocks. The driver holds the weights and ten former steps.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STACK = 128  # the block size of the classifier
BLOCK = 4 * STACK  # rows
SHARES = 2  # tasks of a pass per core
TASK_BLOCKS = (4, 512)  # blocks of a task of a pass, at least (if there are as many) and at most
SUMS = 64  # sums of tasks that reach the driver at once; more of them are added in executors first
MEMORY = 10  # former steps
SUFFICIENT, CURVATURE = 1e-4, 0.9  # of the strong Wolfe conditions
TRIALS = 10  # of a line search, and of the search inside an interval
RECENT = 20  # objective values that the newest is compared with

Block = tuple[bytes, bytes]
Evaluated = tuple[float, np.ndarray]


def by_layer(weights: np.ndarray, layers: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Views of flat weights: per layer inputs by outputs, then the intercepts."""
    parts, at = [], 0
    for a, b in zip(layers, layers[1:]):
        parts.append((weights[at:at + a * b].reshape(a, b), weights[at + a * b:at + a * b + b]))
        at += a * b + b
    return parts


def add_gradient(total: list[tuple[np.ndarray, np.ndarray]], parts: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray,
                 y: np.ndarray) -> float:
    """Sum over the stacks of a block of their mean cross-entropy; its gradient is added to ``total``."""
    acts, share = [x], 1.0 / min(len(x), STACK)
    for w, b in parts[:-1]:
        z = acts[-1] @ w
        z += b
        np.exp(np.negative(z, out=z), out=z)
        z += 1.0
        acts.append(np.reciprocal(z, out=z))
    z = acts[-1] @ parts[-1][0] + parts[-1][1]
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    wanted = np.eye(p.shape[1])[y.astype(int)]
    loss = -float((wanted * np.log(p)).sum()) * share
    back = (p - wanted) * share
    for k in reversed(range(len(parts))):
        for sums, part in zip(total[k], (acts[k].T @ back, back.sum(axis=0))):
            sums += part
        if k:
            back = back @ parts[k][0].T
            back *= acts[k]
            back *= np.subtract(1.0, acts[k], out=acts[k])
    return loss


def packed(train: DataFrame, columns: int) -> RDD[Block]:
    """Blocks of ``features, target`` as bytes, dealt evenly. The last stack of an input partition, if smaller, is its own block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = np.empty((0, columns)), np.empty(0)

        def block(begin: int, end: int) -> pa.RecordBatch:
            cells = [np.ascontiguousarray(v[begin:end], dtype=float).tobytes() for v in (x, y)]
            return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], ["x", "y"])

        for batch in batches:
            values, target = batch.column(0).flatten(), batch.column(1)
            x = np.concatenate([x, values.to_numpy(zero_copy_only=False).reshape(-1, columns)])
            y = np.concatenate([y, target.to_numpy(zero_copy_only=False).astype(float)])
            full = len(x) - len(x) % BLOCK
            for begin in range(0, full, BLOCK):
                yield block(begin, begin + BLOCK)
            x, y = x[full:], y[full:]
        full = len(x) - len(x) % STACK
        for begin, end in ((0, full), (full, len(x))):
            if begin < end:
                yield block(begin, end)

    rows = train.select(vector_to_array("features").alias("x"), F.col("target").cast("double").alias("y"))
    spark, blocks = train.sparkSession, math.ceil(train.count() / BLOCK)
    least, most = (math.ceil(blocks / n) for n in TASK_BLOCKS)
    parts = max(1, most, min(SHARES * spark.sparkContext.defaultParallelism, least))
    dealt = rows.mapInArrow(run, "x binary, y binary").repartition(parts)
    return dealt.rdd.map(lambda r: (bytes(r["x"]), bytes(r["y"]))).persist(StorageLevel.MEMORY_AND_DISK)


def objective(blocks: RDD[Block], layers: list[int]) -> Callable[[np.ndarray], Evaluated]:
    """Mean of the stacks' losses, and its gradient, as a function of the weights: one pass over all blocks."""

    def add(a, b):
        return a[0] + b[0], a[1] + b[1], a[2] + b[2]

    def evaluate(weights: np.ndarray) -> Evaluated:
        def run(own: Iterator[Block]):
            loss, total, n = 0.0, np.zeros_like(weights), 0
            sums, parts = by_layer(total, layers), by_layer(weights, layers)
            with np.errstate(all="ignore"):  # a trial step that is far too long gives no number, and the search goes back
                for x, y in own:
                    rows = np.frombuffer(y)
                    loss += add_gradient(sums, parts, np.frombuffer(x).reshape(-1, layers[0]), rows)
                    n += math.ceil(len(rows) / STACK)
            yield loss, total, n

        loss, total, n = blocks.mapPartitions(run).treeReduce(add, 1 if blocks.getNumPartitions() <= SUMS else 2)
        with np.errstate(all="ignore"):
            return float(np.float64(loss) / n), total / n

    return evaluate


class NoStep(Exception):
    """The line search found no step along a direction."""


def _between(left: tuple, right: tuple) -> float:
    """The least point of the cubic through the values and slopes at both ends, not too near to either end."""
    (t0, v0, s0), (t1, v1, s1) = (map(np.float64, end[:3]) for end in (left, right))
    with np.errstate(all="ignore"):
        d1 = s0 + s1 - 3 * (v0 - v1) / (t0 - t1)
        d2 = np.sqrt(d1 * d1 - s0 * s1)
        t = t1 - (t1 - t0) * (s1 + d2 - d1) / (s1 - s0 + 2 * d2)
    low, high = t0 + 0.1 * (t1 - t0), t0 + 0.9 * (t1 - t0)
    return float(low if t < low else high if t > high else t)


def line_search(at: Callable[[float], tuple], start: tuple, t: float) -> tuple:
    """The first trial that meets the strong Wolfe conditions; ``at(t)`` begins with t, the value and the slope there."""
    _, value, slope = start[:3]
    if slope > 0:
        raise NoStep("the direction does not descend")

    def zoom(low, high):
        for _ in range(TRIALS):
            c = at(_between(high, low) if low[0] > high[0] else _between(low, high))
            if c[1] > value + SUFFICIENT * c[0] * slope or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= CURVATURE * abs(slope):
                return c
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise NoStep("no point of the interval will do")

    low = start
    for trial in range(TRIALS):
        c = at(t)
        if not math.isfinite(c[1]):
            t /= 2.0
            continue
        if c[1] > value + SUFFICIENT * t * slope or (c[1] >= low[1] and trial > 0):
            return zoom(low, c)
        if abs(c[2]) <= CURVATURE * abs(slope):
            return c
        if c[2] >= 0:
            return zoom(c, low)
        low = c
        t *= 1.5
    raise NoStep("no interval found")


def _direction(slope: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Minus the slope times the inverse Hessian that former steps and changes of the slope suggest, newest first."""
    out, shares = slope.copy(), []
    with np.errstate(all="ignore"):
        for step, change in steps:
            shares.append(step @ out / (step @ change))
            out -= shares[-1] * change
        if steps:
            step, change = steps[0]
            scale = step @ change / (change @ change)
            if not scale >= 0 or np.isnan(shares).any():
                raise NoStep("the former steps are of no use")
            out *= scale
        for (step, change), share in zip(reversed(steps), reversed(shares)):
            out += (share - change @ out / (step @ change)) * step
    return -out


def minimise(f: Callable[[np.ndarray], Evaluated], x: np.ndarray, iterations: int, tolerance: float) -> np.ndarray:
    """L-BFGS from ``x``. A failed search forgets the former steps once; a second one in a row ends the run."""
    value, slope = f(x)
    first, recent, steps, done, failed = value, [math.inf], [], 0, False
    while done < iterations:
        if len(recent) > 1 and abs(value - max(recent)) <= tolerance * first:
            break
        if np.linalg.norm(slope) <= max(tolerance * value, 1e-8):
            break
        try:
            way = _direction(slope, steps)

            def at(t: float) -> tuple:
                there, change = f(x + way * t)
                return t, there, float(change @ way), change

            t, new, _, changed = line_search(at, (0.0, value, float(slope @ way)), 1.0 if done else 1.0 / np.linalg.norm(way))
            if t * np.linalg.norm(slope) < 1e-10:
                raise NoStep("the step is too short")
        except NoStep:
            if failed:
                break
            failed, steps = True, []
            continue
        moved = x + way * t
        steps = [(moved - x, changed - slope), *steps][:MEMORY]
        x, value, slope, done, failed = moved, new, changed, done + 1, False
        recent = [*recent, value][-RECENT:]
    return x


def fit_perceptron(train: DataFrame, layers: list[int], iterations: int, seed: int) -> MultilayerPerceptronClassificationModel:
    """MLlib's model of ``features`` and ``target``, fitted by passes over blocks.

    A fit without a step checks the rows and draws the first weights; another one, of one row, makes the model.
    """
    learner = MultilayerPerceptronClassifier(
        featuresCol="features", labelCol="target", layers=layers, maxIter=iterations, seed=seed, blockSize=STACK)
    start = learner.copy({learner.maxIter: 0}).fit(train).weights.toArray()
    blocks = packed(train, layers[0])
    try:
        weights = minimise(objective(blocks, layers), start, iterations, learner.getTol())
    finally:
        blocks.unpersist()
    model = learner.copy({learner.maxIter: 0, learner.initialWeights: Vectors.dense(weights)}).fit(train.limit(1))
    model.clear(model.initialWeights)
    return model._set(maxIter=iterations)
