"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from each whole text. The trees are fitted on a bounded sample
of labelled rows and kept as flat arrays, so that scoring walks all rows of a
batch down one level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from annoflow.llm.common import id_and_text, map_batches

FEATURES = (
    "log_bytes", "log_words", "bytes_per_word", "upper", "lower", "digit", "other_ascii", "non_ascii",
    "space", "newline", "comma", "full_stop", "bar", "exclamation", "star_dollar_percent_hash_amp",
    "angle_brace", "at_slash_colon", "quotes", "distinct_words", "distinct_lines", "longest_line",
    "entropy", "repeated_pairs", "capital_start",
)


def _classes() -> np.ndarray:
    """Class of each byte, as positions of FEATURES."""
    kind = np.full(256, FEATURES.index("other_ascii"))
    kind[128:] = FEATURES.index("non_ascii")
    for name, members in (
        ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("lower", b"abcdefghijklmnopqrstuvwxyz"),
        ("digit", b"0123456789"), ("space", b" \t"), ("newline", b"\n\r"), ("comma", b",;"),
        ("full_stop", b".?"), ("bar", b"|"), ("exclamation", b"!"), ("star_dollar_percent_hash_amp", b"*$%#&"),
        ("angle_brace", b"<>{}[]()"), ("at_slash_colon", b"@/\\:_"), ("quotes", b"'\"`"),
    ):
        kind[list(members)] = FEATURES.index(name)
    return kind


CLASS_OF_BYTE = _classes()


def statistics(text: str) -> np.ndarray:
    """The features of one text; all 0 for an empty one."""
    out = np.zeros(len(FEATURES), np.float32)
    data = text.encode()
    if not data:
        return out
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = len(data)
    out[: len(FEATURES)] = np.bincount(CLASS_OF_BYTE, weights=counts, minlength=len(FEATURES)) / size
    words = text.split()
    lines = [line for line in text.split("\n") if line]
    share = counts[counts > 0] / size
    out[0] = np.log1p(size)
    out[1] = np.log1p(len(words))
    out[2] = size / max(1, len(words))
    out[18] = len(set(words)) / max(1, len(words))
    out[19] = len(set(lines)) / max(1, len(lines))
    out[20] = np.log1p(max(map(len, lines), default=0))
    out[21] = -(share * np.log2(share)).sum()
    pairs = max(1, len(words) - 1)
    out[22] = 1 - len(set(zip(words, words[1:]))) / pairs if len(words) > 1 else 0
    out[23] = sum(w[0].isupper() for w in words) / max(1, len(words))
    return out


@dataclass
class Trees:
    """Flat trees: node ``i`` sends a row left if feature[i] <= cut[i], to child[i],
    else to child[i] + 1; a leaf has child[i] == i. ``roots`` are the first nodes."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    value: np.ndarray
    depth: int

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            for _ in range(self.depth):
                inner = self.child[at] != at
                right = rows[every, self.feature[at]] > self.cut[at]
                at = np.where(inner, self.child[at] + right, at)
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def fit(
    rows: np.ndarray, labels: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.15,
    bins: int = 64, least: int = 10, ridge: float = 1.0,
) -> Trees:
    """Boost trees on the logistic loss. Features are cut into at most ``bins``
    histogram bins at their quantiles; a leaf holds ``least`` rows or more.
    Without rows the score is 0.5 everywhere."""
    n, width = rows.shape
    share = (labels.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.empty(0) for f in range(width)]
    binned = np.stack([np.searchsorted(c, rows[:, f], side="left") for f, c in enumerate(cuts)], 1) if n else np.empty((0, width), int)
    flat = binned + np.arange(width) * bins
    total = np.full(n, base)
    feature, cut, child, value, roots = [], [], [], [], []

    def node() -> int:
        for column, first in ((feature, 0), (cut, 0.0), (value, 0.0)):
            column.append(first)
        child.append(len(child))
        return len(child) - 1

    def sums(members: np.ndarray, weights: np.ndarray | None) -> np.ndarray:
        repeated = None if weights is None else np.repeat(weights[members], width)
        return np.bincount(flat[members].ravel(), repeated, width * bins).reshape(width, bins)

    for _ in range(rounds if n else 0):
        chance = 1 / (1 + np.exp(-total))
        slope, bend = labels - chance, chance * (1 - chance)
        roots.append(node())
        open_nodes = [(roots[-1], np.arange(n))]
        for level in range(depth + 1):
            following = []
            for at, members in open_nodes:
                g, h = slope[members].sum(), bend[members].sum()
                best = (1e-6, -1, -1)
                if level < depth and len(members) >= 2 * least:
                    left_n = sums(members, None).cumsum(1)
                    left_g, left_h = sums(members, slope).cumsum(1), sums(members, bend).cumsum(1)
                    gain = left_g**2 / (left_h + ridge) + (g - left_g) ** 2 / (h - left_h + ridge) - g**2 / (h + ridge)
                    gain[(left_n < least) | (len(members) - left_n < least)] = -1
                    f, b = divmod(int(gain.argmax()), bins)
                    if b < len(cuts[f]):
                        best = max(best, (float(gain[f, b]), f, b))
                if best[1] < 0:
                    value[at] = rate * g / (h + ridge)
                    total[members] += value[at]
                    continue
                _, f, b = best
                feature[at], cut[at] = f, float(cuts[f][b])
                goes_left = binned[members, f] <= b
                left, right = node(), node()
                child[at] = left
                following += [(left, members[goes_left]), (right, members[~goes_left])]
            open_nodes = following
    return Trees(
        base, np.array(roots, int), np.array(feature, int), np.array(cut, np.float32), np.array(child, int),
        np.array(value, float), depth,
    )


def _features_of(texts: pa.Array) -> np.ndarray:
    return np.stack([statistics(t.as_py()) for t in texts])


def held_out(doc_id) -> F.Column:
    """Rows never learned from: crc32 of the ID's text leaves 0 when divided by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality",
) -> Trees:
    """Fit on at most ``sample_rows`` labelled rows: those with the smallest hash of
    their ID, so the same at every run. The statistics are computed by the
    tasks that read the texts; only they, ``sample_rows`` short vectors, come to
    the driver. Rows without an ID or label are left out; of several labels of one ID
    the smallest counts, and repeated documents are learned as often as they come,
    within the bound.
    """
    chosen = (
        labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    # at most sample_rows short rows: small enough to send to every task
    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [row.tobytes() for row in _features_of(batch.column(1))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(found, pa.binary())], names=["doc_id", "label", "features"]
        )

    key = rows.schema["doc_id"].dataType.simpleString()
    features = map_batches(rows, run, f"doc_id {key}, label int, features binary")
    kept = features.orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(sample_rows).select("label", "features")
    table = kept.toArrow()
    matrix = np.frombuffer(b"".join(table["features"].to_pylist()), np.float32).reshape(-1, len(FEATURES))
    return fit(matrix, table["label"].to_numpy().astype(float))


def score_rows(docs: DataFrame, trees: Trees, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with held_out, score and predicted (1 from ``threshold`` on) for every text, which
    replace columns of these names.

    Null and empty texts are scored like any other, on statistics that are all 0;
    repeated rows as often as they come.
    """

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(trees.scores(np.stack([statistics(t) for t in texts])))

    return (
        docs.withColumn("held_out", held_out(docs[id_col]))
        .withColumn("score", scored(F.coalesce(docs[text_col], F.lit(""))))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def score(docs: DataFrame, trees: Trees, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every text (see ``score_rows``); other columns are not read."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return score_rows(rows, trees, threshold).select("doc_id", "held_out", "score", "predicted")
