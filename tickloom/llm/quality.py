"""Quality scores by naive Bayes support vectors on byte n-gram indicators.

Each n-gram a text contains counts once, scaled by the log ratio of its frequencies in good
and bad texts, texts being scaled to unit length; a linear hinge-loss model is fitted by dual
coordinate descent, and its margin becomes a probability by a logistic curve weighted to the
classes' true shares. Fitted on at most ``PER_CLASS`` labelled texts per class, those whose
ids hash lowest; every text is scored, whole, with nothing but itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tickloom.llm import grams

PER_CLASS = 3_000
COST = 1.0
EPOCHS = 12


def _present(pairs, triples, flags) -> np.ndarray:
    flags[pairs] = True
    flags[triples] = True
    found = np.flatnonzero(flags)
    flags[found] = False
    return found


def indicators(column: pa.Array):
    flags = np.zeros(grams.CODES, bool)
    for pairs, triples in grams.per_text(column):
        yield _present(pairs, triples, flags)


def _features(batches):
    for batch in batches:
        rows = [x.astype(np.int32).tobytes() for x in indicators(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["label", "codes"])


def log_ratios(rows: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    seen = np.ones((2, grams.CODES))
    for x, y in zip(rows, label, strict=True):
        seen[y, x] += 1
    return np.log(seen[1] / seen[1].sum()) - np.log(seen[0] / seen[0].sum())


def fit(rows: list[np.ndarray], label: np.ndarray, share: float, cost: float = COST, epochs: int = EPOCHS):
    """(weights, squares, bias, slope, shift): a text's margin is the sum of its n-grams' weights
    over the root of the sum of their squares, plus the bias; slope and shift make it a logit.

    ``share`` is the true share of label 1. A single class gives a constant score.
    """
    ratio = log_ratios(rows, label)
    if len(set(label.tolist())) < 2:
        sure = 30.0 if label.any() else -30.0
        return np.zeros(grams.CODES), ratio * ratio, 0.0, 0.0, sure if len(label) else 0.0
    sign = np.where(label == 1, 1.0, -1.0)
    scaled = [_scaled(ratio, x) for x in rows]
    square = [float(v @ v) + 1.0 for v in scaled]
    weight, bias, alpha = np.zeros(grams.CODES), 0.0, np.zeros(len(rows))
    limit = np.where(label == 1, cost * len(label) / (2 * (label == 1).sum()), cost * len(label) / (2 * (label == 0).sum()))
    draw = np.random.RandomState(11)
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            x, v = rows[i], scaled[i]
            slope = sign[i] * (weight[x] @ v + bias) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), limit[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                alpha[i] = new
                weight[x] += step * v
                bias += step
    margin = np.array([weight[x] @ v for x, v in zip(rows, scaled, strict=True)]) + bias
    return weight * ratio, ratio * ratio, bias, *_curve(margin, label, share)


def _scaled(ratio, codes):
    values = ratio[codes]
    length = np.sqrt(values @ values)
    return values / length if length else values


def _curve(margin, label, share):
    """Logistic slope and shift, by Newton steps on examples weighted to the true shares."""
    importance = np.where(label == 1, share / (label == 1).sum(), (1 - share) / (label == 0).sum())
    x, at = np.stack((margin, np.ones(len(margin))), 1), np.array([2.0, 0.0])
    target = np.where(label == 1, 0.995, 0.005)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        gradient = x.T @ (importance * (p - target)) + 1e-4 * at
        bend = (x * (importance * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        at = at - np.clip(np.linalg.solve(bend, gradient), -2, 2)
    return float(max(at[0], 0.0)), float(at[1])


def _score(model):
    weight, square, bias, slope, shift = model

    def run(batches):
        for batch in batches:
            out = []
            for codes in indicators(batch.column(batch.schema.get_field_index("text"))):
                length = np.sqrt(square[codes].sum())
                margin = (weight[codes].sum() / length if length else 0.0) + bias
                out.append(1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30))))
            yield batch.append_column("quality_score", pa.array(out, pa.float64()))

    return run


def trained(docs: DataFrame, labels: DataFrame, held_out, label: str = "quality", per_class: int = PER_CLASS):
    """The model, from the labelled rows that ``held_out(id)`` leaves."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("_id")))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64(F.col("_id").cast("string")), "_id"]
    picked = [known.where(F.col("label") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    some = F.broadcast(picked[0].unionAll(picked[1]))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))  # other columns may bear any name
    texts = texts.join(some, F.col("doc_id") == F.col("_id")).select("label", "text")
    found = texts.mapInArrow(_features, "label int, codes binary").toArrow()
    y = found.column("label").to_numpy()
    x = [np.frombuffer(v.as_buffer(), np.int32) for v in found.column("codes")]
    order = sorted(range(len(x)), key=lambda i: (int(y[i]), len(x[i]), x[i].tobytes()))  # not that of arrival
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    return fit([x[i] for i in order], y[order], share)


def quality_scores(
    docs: DataFrame, labels: DataFrame, held_out, label: str = "quality", learn_from: DataFrame | None = None
) -> DataFrame:
    """``docs`` with quality_score, the probability (0 to 1) of label 1.

    ``held_out`` maps an id column to the condition that keeps a row's label from training; the
    texts to learn from are those of ``docs`` unless given in ``learn_from``.
    Null texts score as empty ones, which have the model's bias for a margin; an id with
    several labels or texts is an example for each; with labels of one class the score is
    that class, without labels 0.5. An empty table gives an empty result. Other columns are
    carried along; a column named quality_score is replaced.
    """
    model = trained(docs if learn_from is None else learn_from, labels, held_out, label)
    docs = docs.drop("quality_score")
    shape = StructType([*docs.schema.fields, StructField("quality_score", DoubleType())])
    return docs.mapInArrow(_score(model), shape)


def accepted(docs: DataFrame, labels: DataFrame, held_out, **options) -> DataFrame:
    """The rows of ``docs`` that score 0.5 or more, with all their columns."""
    return quality_scores(docs, labels, held_out, **options).where("quality_score >= 0.5").select(*docs.columns)
