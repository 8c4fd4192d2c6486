"""Language identification by a byte convolutional network.

A text is cut into windows of ``WINDOW`` bytes. Each byte has a learned vector; filters of several widths run over the
window, the largest answer of each filter passes a rectifier, and a softmax layer gives the language of the window. A
document's log-probabilities are the sum over all of its windows (every byte counts, no prefixes), each weighted by its
length. Training is plain numpy with Adam; the gradient of max pooling reaches only the winning positions.

At work a filter is two lookups: byte pairs and their filter answers are tabled once in a task from the small weights.

The network is fitted on a bounded sample of labelled rows: ``PER_LANG`` documents a language with the smallest hash of
their id, up to ``WINDOWS_EACH`` windows a document. Everything else covers all data.

Defined cases: null text and text without a letter give ``und`` with score 0; rows with null lang are never learned
from; a table without labels gives ``und`` for all rows; with one language all other texts get it with score 1; repeated
rows are judged each; other columns pass through, and ``lang_pred``/``score`` replace columns of that name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sliced, text_bytes, worker_memory

WINDOW = 128
PER_LANG = 300
WINDOWS_EACH = 12
WIDTHS = (2, 3, 4)
FILTERS = 8
DIM = 8
LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves remainder 1: never learned from."""
    return F.crc32(doc_id.cast("string")) % 3 == 1


def cut(raw: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Bytes as rows of ``window``, the last one filled with zeros."""
    n = -(-len(raw) // window)
    out = np.zeros(n * window, np.uint8)
    out[: len(raw)] = raw
    return out.reshape(n, window)


def sample_windows(docs: DataFrame, text: str, lang: str, doc_id: str, per_lang: int = PER_LANG, each: int = WINDOWS_EACH) -> DataFrame:
    """(lang, window) rows of the bounded training sample, evenly spaced over each chosen text."""
    order = Window.partitionBy("__lang").orderBy("__h", "__id")
    narrow = docs.where(F.col(lang).isNotNull() & F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(F.col(doc_id).alias("__id"), F.col(lang).alias("__lang"), F.xxhash64(F.col(doc_id)).alias("__h"))
    # hashes are uniform: below this one lie twice the rows wanted, so only those are sorted
    share = F.least(F.lit(1.0), (2.0 * per_lang + 100) / F.count(F.lit(1)))
    limits = narrow.groupBy("__lang").agg((F.lit(-(2.0**63)) + share * F.lit(2.0**64)).alias("__limit"))
    near = narrow.join(F.broadcast(limits), "__lang").where(F.col("__h") <= F.col("__limit"))  # a row a language
    chosen = near.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= per_lang).select("__id").distinct()
    texts = docs.select(F.col(doc_id).alias("__id"), F.col(lang).alias("lang"), F.col(text).alias("text")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    picked = texts.join(F.broadcast(chosen), "__id", "left_semi").select("lang", "text")  # per_lang ids a language

    def run(batches):
        worker_memory("")
        for batch in sliced(batches, "text"):
            raw, ends = text_bytes(batch.column("text"))
            langs, rows = [], []
            for name, a, b in zip(batch.column("lang").to_pylist(), ends[:-1], ends[1:], strict=True):
                w = cut(raw[a:b])
                for i in np.unique(np.linspace(0, len(w) - 1, min(each, len(w))).astype(int)):
                    langs.append(name)
                    rows.append(w[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(rows, pa.binary())], names=["lang", "window"])

    return picked.mapInArrow(run, "lang string, window binary")


class ByteConvNet:
    """Weights, training and tabled inference."""

    def __init__(self, langs: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs = langs
        n = FILTERS * len(WIDTHS)
        self.weights = {"embed": rng.normal(0, 0.5, (256, DIM)), "out": rng.normal(0, 0.1, (n, len(langs))), "bias": np.zeros(len(langs))}
        for w in WIDTHS:
            self.weights[f"conv{w}"] = rng.normal(0, (2 / (w * DIM)) ** 0.5, (w, DIM, FILTERS))
            self.weights[f"shift{w}"] = np.zeros(FILTERS)
        self._tables = None

    def __getstate__(self):
        return {"langs": self.langs, "weights": self.weights, "_tables": None}

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 256, rate: float = 4e-3, seed: int = 7) -> ByteConvNet:
        """x: windows as bytes, y: language numbers. Classes weigh alike."""
        rng = np.random.default_rng(seed)
        share = np.bincount(y, minlength=len(self.langs))
        scale = len(y) / (len(self.langs) * np.maximum(share, 1))
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                at = order[i : i + batch]
                grads = self._gradients(x[at], y[at], scale[y[at]])
                step += 1
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.weights[k] = self.weights[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        self._tables = None
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray, scale: np.ndarray) -> dict[str, np.ndarray]:
        p = self.weights
        e = p["embed"][x]
        n, length = x.shape
        pooled, where = [], []
        for w in WIDTHS:
            z = sum(e[:, k : length - w + 1 + k] @ p[f"conv{w}"][k] for k in range(w)) + p[f"shift{w}"]
            at = z.argmax(1)
            pooled.append(np.take_along_axis(z, at[:, None], 1)[:, 0])
            where.append(at)
        flat = np.concatenate(pooled, 1)
        act = np.maximum(flat, 0)
        logits = act @ p["out"] + p["bias"]
        prob = np.exp(logits - logits.max(1, keepdims=True))
        prob /= prob.sum(1, keepdims=True)
        d = prob
        d[np.arange(n), y] -= 1
        d *= (scale / n)[:, None]
        grads = {"out": act.T @ d, "bias": d.sum(0), "embed": np.zeros_like(p["embed"])}
        back = (d @ p["out"].T) * (flat > 0)
        rows = np.arange(n)[:, None]
        for i, w in enumerate(WIDTHS):
            g = back[:, i * FILTERS : (i + 1) * FILTERS]
            grads[f"shift{w}"] = g.sum(0)
            conv = np.zeros_like(p[f"conv{w}"])
            for k in range(w):
                byte = x[rows, where[i] + k]
                conv[k] = np.einsum("nfd,nf->df", p["embed"][byte], g)
                np.add.at(grads["embed"], byte.ravel(), (g[:, :, None] * p[f"conv{w}"][k].T[None]).reshape(-1, DIM))
            grads[f"conv{w}"] = conv
        return grads

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Answers of all filters to a byte pair at their start, and of the wider ones to what follows it."""
        if self._tables is None:
            p = self.weights
            one = {w: (p["embed"] @ p[f"conv{w}"]).astype(np.float32) for w in WIDTHS}  # width x byte x filter
            pair = lambda w, k: one[w][k][:, None, :] + one[w][k + 1][None, :, :]
            head = np.concatenate([pair(w, 0) + p[f"shift{w}"].astype(np.float32) for w in WIDTHS], 2).reshape(65536, -1)
            tail = np.concatenate([np.broadcast_to(one[3][2][:, None, :], (256, 256, FILTERS)), pair(4, 2)], 2).reshape(65536, -1)
            self._tables = np.ascontiguousarray(head), np.ascontiguousarray(tail)
        return self._tables

    def log_probs(self, x: np.ndarray, block: int = 1024) -> np.ndarray:
        """Log-probabilities of each window: positions run in the outer loop, so a step touches one small block."""
        head, tail = self.tables()
        out = np.empty((len(x), len(self.langs)))
        for i in range(0, len(x), block):
            part = np.ascontiguousarray(x[i : i + block].T).astype(np.intp)
            pairs = (part[:-1] << 8) | part[1:]
            best = head[pairs[0]]
            best[:, FILTERS:] += tail[pairs[2]]
            for t in range(1, WINDOW - 1):
                z = head[pairs[t]]
                if t < WINDOW - 3:
                    z[:, FILTERS:] += tail[pairs[t + 2]]
                    np.maximum(best, z, out=best)
                    continue
                if t == WINDOW - 3:  # the filter of width 3 still fits, that of width 4 does not
                    z[:, FILTERS : 2 * FILTERS] += tail[part[-1] << 8, :FILTERS]
                fits = (2 if t == WINDOW - 3 else 1) * FILTERS
                np.maximum(best[:, :fits], z[:, :fits], out=best[:, :fits])
            logits = np.maximum(best, 0) @ self.weights["out"] + self.weights["bias"]
            logits -= logits.max(1, keepdims=True)
            out[i : i + block] = logits - np.log(np.exp(logits).sum(1, keepdims=True))
        return out


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", **kw) -> ByteConvNet | None:
    """Train on the bounded sample; None without labelled rows. Give only the rows that may be learned from."""
    rows = sample_windows(docs, text, lang, doc_id, **kw).toArrow()
    if not rows.num_rows:
        return None
    names = rows.column("lang").to_pylist()
    langs = sorted(set(names))
    w = rows.column("window").to_pylist()
    order = sorted(range(len(names)), key=lambda i: (names[i], w[i]))  # the same model whatever order rows arrive in
    x = np.frombuffer(b"".join(w[i] for i in order), np.uint8).reshape(-1, WINDOW)
    number = {n: i for i, n in enumerate(langs)}
    return ByteConvNet(langs).fit(shortened(x), np.array([number[names[i]] for i in order]))


def shortened(x: np.ndarray, seed: int = 3) -> np.ndarray:
    """Every third window cut to a random length, as short texts and last windows are."""
    rng = np.random.default_rng(seed)
    keep = np.where(np.arange(len(x)) % 3 == 0, rng.integers(6, WINDOW, len(x)), WINDOW)
    return np.where(np.arange(WINDOW) < keep[:, None], x, 0).astype(np.uint8)


def identify(docs: DataFrame, model: ByteConvNet | None, text: str = "text") -> DataFrame:
    """Add lang_pred and score (the document's probability of that language). Map-only."""
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", lang_pred string, score double"

    def run(batches):
        worker_memory("")
        for batch in sliced(batches, text, 2 << 20):
            raw, ends = text_bytes(batch.column(text))
            n = batch.num_rows
            pred, score = ["und"] * n, np.zeros(n)
            whole = raw.tobytes()
            spoken = [i for i in range(n) if model and LETTER.search(whole[ends[i] : ends[i + 1]].decode())]
            if spoken:
                lengths = np.array([ends[i + 1] - ends[i] for i in spoken])
                counts = -(-lengths // WINDOW)
                x = np.concatenate([cut(raw[ends[i] : ends[i + 1]]) for i in spoken])
                part = np.full(len(x), WINDOW, float)
                border = np.cumsum(counts)
                part[border - 1] = lengths - (counts - 1) * WINDOW
                total = np.add.reduceat(model.log_probs(x) * (part / WINDOW)[:, None], border - counts, axis=0)
                total -= total.max(1, keepdims=True)
                prob = np.exp(total)
                prob /= prob.sum(1, keepdims=True)
                best = prob.argmax(1)
                for j, i in enumerate(spoken):
                    pred[i], score[i] = model.langs[best[j]], prob[j, best[j]]
            cols = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(pred, pa.string()), pa.array(score)], names=[*keep, "lang_pred", "score"])

    return docs.select(*keep).mapInArrow(run, schema)
