"""Language identification by a byte convolutional network trained in numpy.

A text is read as windows of ``WINDOW`` bytes that cover all of it. Bytes are embedded, convolved with
filters of several widths, rectified, max-pooled over the window and scored by a softmax layer; a
document's score is the mean of its windows' probabilities, weighted by their bytes.

Training uses at most ``PER_LANGUAGE`` labelled rows of each language and ``ROW_WINDOWS`` windows of
each row, both chosen by a hash (a bounded, documented sample); prediction reads every byte of every
text. The labels, one row per language, are all that grows with the number of languages.

Defined results: a NULL text, or one without a letter, is ``und`` with score 0, and so is every text if
there is no labelled text to learn from; NULL languages are never learned. Repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cindergrid.llm.words import importable, raw_bytes, slices
from cindergrid.session import work_folder

WINDOW = 256
WIDTHS = (2, 3, 4)
WIDEST = max(WIDTHS)
FILTERS = 16
EMBEDDING = 8
PER_LANGUAGE = 400
ROW_WINDOWS = 2
EPOCHS = 12
BATCH = 64
SEED = 7
#: Slots that spread the rows of one language over tasks before the best are picked.
SLOTS = 64

_LETTER = re.compile(r"[^\W\d_]")


def cut(raw: bytes, window: int = WINDOW) -> np.ndarray:
    """All bytes of a text as rows of ``window`` bytes; the last row is filled with zeros."""
    n = max(1, -(-len(raw) // window))
    out = np.zeros(n * window, np.uint8)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(n, window)


class Network:
    """Embedding, convolutions of several widths, max pooling, softmax."""

    def __init__(self, classes: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.classes = classes
        init = lambda *shape, fan: (rng.standard_normal(shape) * np.sqrt(2 / fan)).astype(np.float32)
        self.p = {"embedding": init(256, EMBEDDING, fan=EMBEDDING), "b": np.zeros(len(classes), np.float32)}
        for w in WIDTHS:
            self.p[f"conv{w}"] = init(w * EMBEDDING, FILTERS, fan=w * EMBEDDING)
            self.p[f"bias{w}"] = np.zeros(FILTERS, np.float32)
        self.p["dense"] = init(len(WIDTHS) * FILTERS, len(classes), fan=len(WIDTHS) * FILTERS)

    def _convolved(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All filters at all positions (windows, WINDOW, filters), and the grams they saw.

        One product serves all widths: a narrow filter has zeros where it does not look.
        """
        filled = np.zeros((len(x), x.shape[1] + WIDEST - 1), np.uint8)
        filled[:, : x.shape[1]] = x
        embedded = self.p["embedding"][filled]
        s = embedded.strides
        shape = (len(x), x.shape[1], WIDEST * EMBEDDING)
        grams = np.ascontiguousarray(np.lib.stride_tricks.as_strided(embedded, shape, s, writeable=False))
        filters = np.zeros((WIDEST * EMBEDDING, len(WIDTHS) * FILTERS), np.float32)
        for k, w in enumerate(WIDTHS):
            filters[: w * EMBEDDING, k * FILTERS : (k + 1) * FILTERS] = self.p[f"conv{w}"]
        return (grams.reshape(-1, WIDEST * EMBEDDING) @ filters).reshape(*shape[:2], -1), grams

    def _softmax(self, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        features = np.maximum(top + np.concatenate([self.p[f"bias{w}"] for w in WIDTHS]), 0)
        scores = features @ self.p["dense"] + self.p["b"]
        scores -= scores.max(axis=1, keepdims=True)
        chances = np.exp(scores)
        return chances / chances.sum(axis=1, keepdims=True), features

    def chances(self, x: np.ndarray) -> np.ndarray:
        """Probabilities per window, by blocks that fit the processor's cache."""
        out = []
        for a in range(0, len(x), BATCH):
            y, _ = self._convolved(x[a : a + BATCH])
            while y.shape[1] > 1:  # the maximum, by halves
                half = -(-y.shape[1] // 2)
                y = np.maximum(y[:, :half], y[:, y.shape[1] - half :])
            out.append(self._softmax(y[:, 0])[0])
        return np.concatenate(out)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        convolved, grams = self._convolved(x)
        at = convolved.argmax(axis=1)
        chances, features = self._softmax(np.take_along_axis(convolved, at[:, None, :], 1)[:, 0])
        d = chances
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        g = {"dense": features.T @ d, "b": d.sum(axis=0), "embedding": np.zeros_like(self.p["embedding"])}
        back = (d @ self.p["dense"].T) * (features > 0)
        rows = np.arange(len(x))[:, None]
        filled = np.pad(x, ((0, 0), (0, WIDEST - 1)))
        for k, w in enumerate(WIDTHS):
            own = slice(k * FILTERS, (k + 1) * FILTERS)
            dy = back[:, own]
            seen = grams[rows, at[:, own]][:, :, : w * EMBEDDING]
            g[f"conv{w}"] = np.einsum("nfe,nf->ef", seen, dy)
            g[f"bias{w}"] = dy.sum(axis=0)
            dgrams = np.einsum("nf,ef->nfe", dy, self.p[f"conv{w}"]).reshape(len(x), FILTERS, w, EMBEDDING)
            for j in range(w):
                np.add.at(g["embedding"], filled[rows, at[:, own] + j], dgrams[:, :, j])
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 3e-3, seed: int = SEED) -> None:
        """Adam over mini-batches."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(u) for k, u in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for a in range(0, len(x), BATCH):
                part = order[a : a + BATCH]
                step += 1
                for k, g in self.gradients(x[part], y[part]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def predict(self, raws: list[bytes], most: int = 2048) -> np.ndarray:
        """Probabilities per text, from all its windows."""
        total = np.zeros((len(raws), len(self.classes)))
        owners, rows, held = [], [], 0

        def flush() -> None:
            nonlocal owners, rows, held
            if rows:
                x = np.concatenate(rows)
                who = np.concatenate(owners)
                weight = np.maximum((x != 0).sum(axis=1), 1)
                np.add.at(total, who, self.chances(x) * weight[:, None])
            owners, rows, held = [], [], 0

        for i, raw in enumerate(raws):
            windows = cut(raw)
            rows.append(windows)
            owners.append(np.full(len(windows), i))
            held += len(windows)
            if held >= most:
                flush()
        flush()
        return total / np.maximum(total.sum(axis=1, keepdims=True), 1e-12)


def training_rows(docs: DataFrame, doc_id: str, text: str, lang: str, per_language: int = PER_LANGUAGE) -> DataFrame:
    """At most ``per_language`` labelled rows of each language, the lowest by hash: ``text, lang``.

    Picked in two steps, so that a language with most rows is many small groups first.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(doc_id)))
    keyed = labelled.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.xxhash64(text).alias("h"), F.xxhash64(F.col(doc_id).cast("string"), text).alias("lot")
    )
    slot = Window.partitionBy("lang", F.pmod("lot", F.lit(SLOTS))).orderBy("lot", "h")
    best = keyed.withColumn("place", F.row_number().over(slot)).where(F.col("place") <= per_language)
    per = Window.partitionBy("lang").orderBy("lot", "h")
    best = best.withColumn("place", F.row_number().over(per)).where(F.col("place") <= per_language).select("lot", "lang").distinct()
    # Stored, its size is known: Spark broadcasts it if it is small, and the texts stay where they are.
    path = work_folder(docs.sparkSession, "language-sample")
    best.write.parquet(path)
    best = docs.sparkSession.read.parquet(path)
    texts = labelled.select(F.xxhash64(F.col(doc_id).cast("string"), text).alias("lot"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    return texts.join(best, ["lot", "lang"], "left_semi").select("lot", "text", "lang")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """A network fitted on the driver; what is collected is bounded by the sample's parameters."""

    def some_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lot, raw, name in zip(batch.column(0).to_pylist(), raw_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                windows = cut(raw) if raw else np.zeros((0, WINDOW), np.uint8)
                pick = np.random.default_rng(lot & 0x7FFFFFFF).permutation(len(windows))[:ROW_WINDOWS]
                out += [(lot, name, int(k), windows[k].tobytes()) for k in pick]
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["lot", "lang", "k", "bytes"])

    importable(docs.sparkSession)
    rows = training_rows(docs, doc_id, text, lang).mapInArrow(some_windows, "lot long, lang string, k int, bytes binary").collect()
    if not rows:
        return None
    # A fixed order, so that reruns train the same network.
    rows = sorted({(r["lang"], r["lot"], r["k"], bytes(r["bytes"])) for r in rows})
    classes = sorted({r[0] for r in rows})
    x = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), WINDOW)
    network = Network(classes)
    if len(classes) > 1:
        network.fit(x, np.array([classes.index(r[0]) for r in rows]))
    return network


def predict(docs: DataFrame, network: Network | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, lang_pred, score``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for piece in slices(batch, "text"):
                names, raws = piece.column(0), raw_bytes(piece.column(1))
                known = [raw is not None and bool(_LETTER.search(raw.decode("utf-8", "replace"))) for raw in raws]
                langs, scores = ["und"] * len(raws), [0.0] * len(raws)
                if net is not None and any(known):
                    at = [i for i, k in enumerate(known) if k]
                    chances = net.predict([raws[i] for i in at])
                    for i, c in zip(at, chances, strict=True):
                        langs[i], scores[i] = net.classes[int(c.argmax())], float(min(1.0, c.max()))
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"]
                )

    schema = T.StructType([rows.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema)
