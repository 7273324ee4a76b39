"""Quality classifier: regularised quadratic discriminant over document statistics.

One pass over the whole texts gives each document a row of transformed statistics (stored, some 60 bytes a document).
The model is fitted on the driver from at most TRAIN_ROWS labelled rows outside the held-out quarter, those with the
smallest hash of doc_id: class means, class covariances shrunk towards the pooled diagonal (the shrinkage by two-fold
likelihood), Cholesky factors.  A score is the difference of the two log densities by Mahalanobis distances through the
inverse factors, made a probability by a logistic fit on the same rows.  Every row is scored from its statistics alone.

Defined results: null text counts as empty and is scored like any other; labels with null quality are left out, several
labels of one document count by their mean; without labels of both classes every score is the share of label 1 (no labels:
0.5); a null doc_id is never a training row and counts as not held out; training rows are taken and sorted by (hash of doc_id,
doc_id, statistics), so that ties and repeated rows don't matter; texts of any length are read whole; other columns, whatever
their names, are ignored (keep_good carries them along); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.llm._shared import arrow_texts, fresh, read_table, sized_broadcast, stored

#: Labelled rows that the fit takes at most.
TRAIN_ROWS = 20_000
THRESHOLD = 0.7
SHRINKAGES = (0.02, 0.05, 0.1, 0.2, 0.4)
NAMES = ("log_words", "mean_word", "unique", "upper", "bang", "symbol", "pipe", "digit", "stop", "comma", "line", "repeat", "other", "high")


def statistics(data: bytes) -> list[float]:
    """Transformed statistics of one whole text."""
    from itertools import islice
    from operator import eq

    import numpy as np

    hist = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    n = len(words)
    letters = hist[65:91].sum() + hist[97:123].sum() + hist[192:].sum()
    per = lambda *codes: float(sum(hist[c] for c in codes)) / max(1, n)
    marks = hist[33:48].sum() + hist[58:65].sum() + hist[91:97].sum() + hist[123:127].sum()
    usual = sum(hist[c] for c in b"!|#$%&*.,")
    rates = [
        float(hist[65:91].sum()) / max(1, letters), per(33), per(*b"#$%&*"), per(124), float(hist[48:58].sum()) / max(1, len(data)),
        per(46), per(44), per(10),
    ]
    unique = len(set(words)) / max(1.0, n**0.85)
    root = [float(np.sqrt(x)) for x in rates]
    return [
        float(np.log1p(n)), float(np.log1p((len(data) - hist[9:14].sum() - hist[32]) / max(1, n))), unique, *root,
        float(np.sqrt(sum(map(eq, words, islice(words, 1, None))) / max(1, n))), float(np.sqrt((marks - usual) / max(1, n))), float(np.sqrt(hist[128:].sum() / max(1, len(data)))),
    ]


def _statistics(batches):
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        data, ends = arrow_texts(batch.column(1))
        made = np.array([statistics(bytes(data[a:b])) for a, b in zip(ends[:-1], ends[1:], strict=True)], np.float32).reshape(-1, len(NAMES))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(made[:, k]) for k in range(len(NAMES)))], ["doc_id", *NAMES])


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(x, y) -> dict:
    """x: rows of statistics, y: 0 or 1.  Means, inverse Cholesky factors, log determinants, and the logistic (slope, shift)."""
    import numpy as np

    x, y = np.asarray(x, float), np.asarray(y, int)
    if len(set(y)) < 2 or min(np.bincount(y)) < 2:
        return {"share": float(y.mean()) if len(y) else 0.5}
    centre, scale = x.mean(0), x.std(0) + 1e-3
    z = (x - centre) / scale
    sets = [z[y == c] for c in (0, 1)]
    pooled = np.diag(sum(len(s) * s.var(0) for s in sets) / len(z)) + 1e-3 * np.eye(z.shape[1])

    def density(train, alpha):
        mean, cov = train.mean(0), (1 - alpha) * np.cov(train.T, bias=True) + alpha * pooled
        low = np.linalg.cholesky(cov)
        return mean, np.linalg.inv(low), 2 * np.log(np.diag(low)).sum()

    def log_density(rows, mean, inverse, det):
        return -0.5 * (((rows - mean) @ inverse.T) ** 2).sum(1) - 0.5 * det

    models = []
    for s in sets:
        halves = (s[::2], s[1::2])
        fits = lambda a: sum(log_density(halves[1 - k], *density(halves[k], a)).sum() for k in (0, 1)) if min(map(len, halves)) > 1 else a
        models.append(density(s, max(SHRINKAGES, key=fits)))  # noqa: B023
    delta = log_density(z, *models[1]) - log_density(z, *models[0])
    t = np.stack([np.arcsinh(delta / 4), np.ones(len(delta))], 1)
    w = np.array([1.0, 0.0])
    for _ in range(50):  # logistic regression by Newton, with a weak prior
        p = 1 / (1 + np.exp(-np.clip(t @ w, -40, 40)))
        grad = t.T @ (p - y) + 1e-2 * (w - [1.0, 0.0])
        w = w - np.linalg.solve((t.T * (p * (1 - p) + 1e-6)) @ t + 1e-2 * np.eye(2), grad)
    return {"centre": centre, "scale": scale, "models": models, "logistic": w}


def score(model: dict, x):
    """Probabilities of label 1."""
    import numpy as np

    if "share" in model:
        return np.full(len(x), model["share"])
    z = (np.asarray(x, float) - model["centre"]) / model["scale"]
    (m0, i0, d0), (m1, i1, d1) = model["models"]
    delta = 0.5 * ((((z - m0) @ i0.T) ** 2).sum(1) + d0 - (((z - m1) @ i1.T) ** 2).sum(1) - d1)
    slope, shift = model["logistic"]
    return 1 / (1 + np.exp(-np.clip(slope * np.arcsinh(delta / 4) + shift, -40, 40)))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per document: (doc_id, held_out, score, predicted, row statistics)."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kinds = ", ".join(f"{name} float" for name in NAMES)
    stats = stored(slim.mapInArrow(_statistics, f"doc_id long, {kinds}"), "statistics")
    marks = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    marks = marks.filter(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    rows = stats.join(F.broadcast(marks), "doc_id").orderBy("doc_id", *NAMES).limit(train_rows).collect()  # both bounded by train_rows
    model = fit([[r[n] for n in NAMES] for r in rows], [r["quality"] for r in rows])

    def scored(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x = np.stack([np.asarray(batch.column(k + 1)) for k in range(len(NAMES))], 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(model, x))], ["doc_id", "score"])

    out = stats.mapInArrow(scored, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without those whose score is below the threshold; columns as before."""
    (key,) = fresh(docs, "key")
    found = stored(quality(docs, labels, id_col, text_col), "scores")
    # an id that stands in several rows goes only if each of its rows is rejected
    bad = stored(found.groupBy(F.col("doc_id").alias(key)).agg(F.max("predicted").alias("p")).filter("p = 0").select(key), "rejected")
    return docs.join(sized_broadcast(bad, bad.count()), F.col(id_col).eqNullSafe(F.col(key)), "left_anti")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
