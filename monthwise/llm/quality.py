"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Every passage is encoded from its bytes (shares of byte
classes) and its words (signed hashed counts, word lengths, distinct share); a hidden layer maps the encoding, gated
attention weighs the passages, and a logistic output scores the weighted sum.  Only document labels are used.

The model is fitted on the driver, on at most ``SAMPLE`` labelled documents chosen by the hash of their id, encoded
by Spark; every document is then scored whole, where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from monthwise.llm.common import col, without
from monthwise.llm.labels import held_out_column, labelled_ids, with_labels
from monthwise.llm.words import U, pieces, word_hashes

PASSAGE = 64
PIECE_BYTES = 1 << 20  # of text encoded at once
HASHED = 64
SAMPLE = 4096
HIDDEN, GATE = 24, 12
EPOCHS, RATE, DECAY = 150, 0.02, 1e-4


def _byte_classes() -> np.ndarray:
    """Digits, upper case, lower case, blanks, controls and bytes past ASCII are one class each, marks one each."""
    out = np.zeros(256, dtype=np.int64)
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    for b in range(256):
        c = chr(b)
        out[b] = (0 if c.isdigit() and b < 128 else 1 if c.isupper() and b < 128 else 2 if c.islower() and b < 128
                  else 3 if b == 32 else 4 if b < 32 or b == 127 else 5 if b >= 128 else 6 + marks.index(b))
    return out


CLASSES = _byte_classes()
N_CLASSES = int(CLASSES.max()) + 1
WIDTH = N_CLASSES + HASHED + 4


def encode(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(document of each passage, encodings); a text without words is one passage without anything."""
    raw = [b" ".join(t.encode().split()) if t else b"" for t in texts]
    words = word_hashes(raw)
    counts = words.counts
    per_doc = np.maximum(-(-counts // PASSAGE), 1)
    first = np.concatenate(([0], np.cumsum(per_doc)))
    doc = np.repeat(np.arange(len(texts)), per_doc)
    total = int(first[-1])
    index = np.arange(len(words.hashes)) - np.repeat(words.offsets[:-1], counts)
    passage = np.repeat(first[:-1], counts) + index // PASSAGE
    n = np.bincount(passage, minlength=total).astype(np.float64)
    some = np.maximum(n, 1)[:, None]
    slot = (words.hashes >> U(32)).astype(np.int64) % HASHED
    sign = np.where(words.hashes & U(1), 1.0, -1.0)
    hashed = np.bincount(passage * HASHED + slot, weights=sign, minlength=total * HASHED).reshape(total, HASHED)
    pair = np.unique(passage.astype(U) << U(40) ^ (words.hashes >> U(24)))
    distinct = np.bincount((pair >> U(40)).astype(np.int64), minlength=total)[:total]
    lengths = np.fromiter((len(r) for r in raw), dtype=np.int64, count=len(raw))
    buf = np.frombuffer(b"".join(raw), dtype=np.uint8)
    start = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    begins = (buf == 32)
    begins[start[(lengths > 0)]] = True
    of_word = np.cumsum(begins) - 1
    of_byte = passage[of_word] if len(buf) else np.empty(0, dtype=np.int64)
    classes = np.bincount(of_byte * N_CLASSES + CLASSES[buf], minlength=total * N_CLASSES).reshape(total, N_CLASSES)
    size = np.bincount(of_byte, minlength=total).astype(np.float64)
    more = np.stack([np.log1p(n), size / some[:, 0] / 10, distinct / some[:, 0], (n == 0).astype(float)], axis=1)
    return doc, np.concatenate((np.sqrt(classes / np.maximum(size, 1)[:, None]), hashed / np.sqrt(some), more),
                               axis=1).astype(np.float32)


def _bags(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, starts, axis=0)


class GatedAttention:
    """Hidden layer, gated attention over a bag, logistic output; trained by Adam on the mean log loss."""

    def __init__(self, width: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        scale = lambda a, b: rng.normal(0, np.sqrt(1 / a), (a, b))
        self.p = {"H": scale(width, HIDDEN), "h": np.zeros(HIDDEN), "V": scale(HIDDEN, GATE), "v": np.zeros(GATE),
                  "G": scale(HIDDEN, GATE), "g": np.zeros(GATE), "a": scale(GATE, 1), "C": scale(HIDDEN, 1),
                  "c": np.zeros(1)}
        self.mean, self.deviation = np.zeros(width), np.ones(width)

    def forward(self, x: np.ndarray, doc: np.ndarray, starts: np.ndarray) -> dict:
        p = self.p
        x = np.clip((x - self.mean) / self.deviation, -8, 8)
        h = np.tanh(x @ p["H"] + p["h"])
        t, s = np.tanh(h @ p["V"] + p["v"]), 1 / (1 + np.exp(-(h @ p["G"] + p["g"])))
        e = (t * s) @ p["a"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[doc])
        w = e / _bags(e, starts)[doc]
        z = _bags(w * h, starts)
        y = 1 / (1 + np.exp(-np.clip(z @ p["C"] + p["c"], -40, 40)))
        return {"x": x, "h": h, "t": t, "s": s, "w": w, "z": z, "y": y[:, 0]}

    def gradients(self, f: dict, y: np.ndarray, doc: np.ndarray, starts: np.ndarray) -> dict:
        p = self.p
        out = ((f["y"] - y) / len(y))[:, None]
        dz = out @ p["C"].T
        dw = (f["h"] * dz[doc]).sum(1, keepdims=True)
        de = f["w"] * (dw - _bags(f["w"] * dw, starts)[doc])
        dt, ds = de @ p["a"].T * f["s"] * (1 - f["t"] ** 2), de @ p["a"].T * f["t"] * f["s"] * (1 - f["s"])
        dh = (f["w"] * dz[doc] + dt @ p["V"].T + ds @ p["G"].T) * (1 - f["h"] ** 2)
        return {"H": f["x"].T @ dh, "h": dh.sum(0), "V": f["h"].T @ dt, "v": dt.sum(0), "G": f["h"].T @ ds,
                "g": ds.sum(0), "a": (f["t"] * f["s"]).T @ de, "C": f["z"].T @ out, "c": out.sum(0)}

    def fit(self, x: np.ndarray, doc: np.ndarray, y: np.ndarray) -> GatedAttention:
        starts = np.flatnonzero(np.diff(doc, prepend=-1))
        self.mean, self.deviation = x.mean(0), x.std(0) + 1e-3
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for step in range(1, EPOCHS + 1):
            grads = self.gradients(self.forward(x, doc, starts), y, doc, starts)
            for k, v in self.p.items():
                g = grads[k] + DECAY * v * (v.ndim == 2)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                v -= RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def score(self, x: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return self.forward(x, doc, np.flatnonzero(np.diff(doc, prepend=-1)))["y"]


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text", PIECE_BYTES):
            doc, x = encode(part["text"].to_pylist())
            cuts = np.searchsorted(doc, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [part["id"], part["y"], pa.array([x[i:j].astype(np.float16).tobytes() for i, j in zip(cuts, cuts[1:])],
                                                 pa.binary())], ["id", "y", "x"])


def fit(docs: DataFrame, ids: DataFrame) -> GatedAttention:
    """Fit on at most ``SAMPLE`` labelled documents of ``docs`` (id, text)."""
    some = ids.orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    rows = (with_labels(docs, some).select("id", "y", "text").mapInArrow(_encoded, "id long, y int, x binary")
            .limit(SAMPLE).toArrow().sort_by("id"))
    model = GatedAttention(WIDTH)
    if rows.num_rows:
        bags = [np.frombuffer(b, dtype=np.float16).reshape(-1, WIDTH) for b in rows["x"].to_pylist()]
        doc = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
        model.fit(np.concatenate(bags).astype(np.float32), doc, rows["y"].to_numpy().astype(np.float64))
    else:
        model.p["C"][:] = 0
    return model


def _scored(model: GatedAttention):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", PIECE_BYTES):
                doc, x = encode(part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays([*[part[c] for c in part.schema.names],
                                                  pa.array(model.score(x, doc))], [*part.schema.names, "score"])
    return run


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", folds: int = 3, held_out: int = 1, threshold: float = 0.5,
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """Score every whole text; learn only from rows whose crc32(id as text) mod ``folds`` is not ``held_out``.

    Returns per input row: the id, ``carry`` columns, ``held_out``, ``score`` (0 to 1, higher: label 1 likelier) and
    ``predicted`` (1 from ``threshold`` on).  Null and empty texts are one passage without anything.  Null labels
    and labels without a document teach nothing; repeated label rows take their mean (0.5 counts as 1); without
    labels every score is 0.5.  A null id is scored and not held out; repeated rows are scored each.  An empty table
    gives an empty result.  Columns not named are dropped, and a result
    column takes the place of a carried one of its name.
    """
    carry = without(carry, id_col, "held_out", "score", "predicted")
    rows = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"))
    model = fit(rows, labelled_ids(labels, id_col, label_col, folds, held_out))
    carried = [f"carry{i}" for i in range(len(carry))]
    taken = docs.select(col(id_col).alias("id"), col(text_col).alias("text"),
                        *[col(c).alias(n) for c, n in zip(carry, carried) if c != text_col])
    out = taken.mapInArrow(_scored(model), StructType([*taken.schema.fields, StructField("score", DoubleType())]))
    return out.select(F.col("id").alias(id_col),
                      *[F.col("text" if c == text_col else n).alias(c) for c, n in zip(carry, carried)],
                      held_out_column("id", folds, held_out), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
