"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, and learned filters slide over them with a stride.  The text is
covered by overlapping chunks of 256 bytes, each 128 after the last; every filter is
max-pooled within a chunk.  A hidden layer turns a chunk's maxima into features, and
their mean and maximum over all chunks of the document give one probability.

Training uses a bounded sample of labelled rows (``train_rows`` per class and
``train_bytes`` of text at most, chosen by a hash of the id, whole texts); the sample
is collected and the network fitted by gradient descent on the driver.  Scores cover
every byte of every document, inside Spark tasks.  The score is a probability under
the labels' own class shares; only the text's bytes enter it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorecraft.llm.staging import staged
from scorecraft.llm.batches import expand, steps, text_buffer

HALF, WIDTH, STRIDE = 128, 12, 4   # half a chunk, filter width and stride in bytes
DIM, FILTERS, HIDDEN = 6, 48, 16   # numbers per byte, filters, features per chunk
PAD = 256                          # the byte after a text's end
_PIECE = 1 << 18                   # bytes convolved at a time


def padded(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte codes with every text padded to whole half chunks (two at least, and room
    for a filter after its end), and the number of half chunks of each text."""
    size = np.diff(offsets)
    halves = np.maximum(2, -(-(size + WIDTH) // HALF))
    out = np.full(int(halves.sum()) * HALF, PAD, np.int16)
    begin = (np.cumsum(halves) - halves) * HALF
    out[expand(begin, size)] = buf
    return out, halves


def _windows(emb: np.ndarray) -> np.ndarray:
    """Rows of WIDTH consecutive byte vectors, STRIDE bytes apart."""
    n, d = emb.shape
    flat = np.concatenate([emb.ravel(), np.zeros((WIDTH - STRIDE) * d, emb.dtype)])
    s = flat.itemsize
    return np.lib.stride_tricks.as_strided(flat, (n // STRIDE, WIDTH * d), (STRIDE * d * s, s))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0.0, -x))


class Network:
    """Weights, scoring and fitting."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def start(cls, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        half = normal(WIDTH * DIM, FILTERS // 2, scale=(WIDTH * DIM) ** -0.5 * 2)
        # filters begin in opposite pairs: the sum of both maxima is a filter's range
        # over the chunk, which is small where a chunk repeats itself
        return cls({"embed": normal(257, DIM, scale=0.5), "filters": np.concatenate([half, -half], 1),
                    "bias": np.zeros(FILTERS, np.float32), "hidden": normal(FILTERS + 1, HIDDEN, scale=FILTERS ** -0.5),
                    "hidden_bias": np.zeros(HIDDEN, np.float32), "out": normal(2 * HIDDEN, scale=0.1), "out_bias": np.zeros(1, np.float32)})

    def _half_maxima(self, codes: np.ndarray, halves: np.ndarray, where: bool = False):
        """Maximum of each filter in each half chunk, and with ``where`` the window it is at."""
        per = HALF // STRIDE
        n = len(codes) // HALF
        best = np.empty((n, FILTERS), np.float32)
        at = np.empty((n, FILTERS), np.int32) if where else None
        last = np.zeros(n, bool)
        last[np.cumsum(halves) - 1] = True  # the last windows of a text would reach into the next
        step = max(1, _PIECE // HALF)
        for lo in range(0, n, step):
            hi = min(n, lo + step)
            piece = codes[lo * HALF:hi * HALF + WIDTH]
            piece = np.concatenate([piece, np.full((hi - lo) * HALF + WIDTH - len(piece), PAD, np.int16)])[:(hi - lo) * HALF + WIDTH - WIDTH % STRIDE]
            act = (_windows(self.w["embed"][piece])[:(hi - lo) * per] @ self.w["filters"]).reshape(hi - lo, per, FILTERS)
            cut = (WIDTH - 1) // STRIDE
            act[last[lo:hi], per - cut:] = -np.inf
            if where:
                at[lo:hi] = act.argmax(1)
            best[lo:hi] = act.max(1)
        return best, at

    @staticmethod
    def _pairs(halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First half of every chunk, and the document of every chunk."""
        chunks = halves - 1
        begin = np.cumsum(halves) - halves
        return expand(begin, chunks), np.repeat(np.arange(len(halves)), chunks)

    def _chunk_inputs(self, codes: np.ndarray, best: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Biased maxima of both halves, and how full of text the chunk is."""
        full = (codes.reshape(-1, HALF) != PAD).mean(1, dtype=np.float32)
        z = np.maximum(best[first], best[first + 1]) + self.w["bias"]
        return np.concatenate([z, (full[first] + full[first + 1])[:, None]], 1)

    def logits(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if len(offsets) == 1:
            return np.zeros(0)
        codes, halves = padded(buf, offsets)
        best, _ = self._half_maxima(codes, halves)
        first, _ = self._pairs(halves)
        z = self._chunk_inputs(codes, best, first)
        h = np.tanh(z @ self.w["hidden"] + self.w["hidden_bias"])
        edge = np.cumsum(halves - 1) - (halves - 1)
        feats = np.concatenate([np.add.reduceat(h, edge, axis=0) / (halves - 1)[:, None], np.maximum.reduceat(h, edge, axis=0)], 1)
        return (feats @ self.w["out"] + self.w["out_bias"]).astype(np.float64)

    def score(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(buf, offsets))

    def _gradient(self, buf: np.ndarray, offsets: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        codes, halves = padded(buf, offsets)
        best, at = self._half_maxima(codes, halves, where=True)
        first, doc = self._pairs(halves)
        chunks = halves - 1
        right = best[first + 1] > best[first]
        z = self._chunk_inputs(codes, best, first)
        h = np.tanh(z @ w["hidden"] + w["hidden_bias"])
        edge = np.cumsum(chunks) - chunks
        top = np.maximum.reduceat(h, edge, axis=0)
        feats = np.concatenate([np.add.reduceat(h, edge, axis=0) / chunks[:, None], top], 1)
        d_logit = ((_sigmoid(feats @ w["out"] + w["out_bias"]) - label) * weight / weight.sum()).astype(np.float32)
        g = {"out": feats.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
        d_feats = d_logit[:, None] * w["out"]
        d_h = (d_feats[:, :HIDDEN] / chunks[:, None])[doc] + d_feats[:, HIDDEN:][doc] * (h == top[doc])
        d_pre = d_h * (1 - h * h)
        g |= {"hidden": z.T @ d_pre, "hidden_bias": d_pre.sum(0)}
        d_z = (d_pre @ w["hidden"].T)[:, :FILTERS]
        g["bias"] = d_z.sum(0)
        half = first[:, None] + right
        window = half * (HALF // STRIDE) + np.take_along_axis(at, half, 0)
        d_filters, d_embed = np.zeros_like(w["filters"]), np.zeros_like(w["embed"])
        codes = np.concatenate([codes, np.full(WIDTH, PAD, np.int16)])
        for f in range(FILTERS):
            use = np.flatnonzero(d_z[:, f])
            if not len(use):
                continue
            d = d_z[use, f]
            bytes_ = codes[window[use, f][:, None] * STRIDE + np.arange(WIDTH)]
            d_filters[:, f] = (w["embed"][bytes_].reshape(len(use), -1) * d[:, None]).sum(0)
            # per byte value and place in the filter, then times the filter's weights
            table = np.bincount((bytes_ * WIDTH + np.arange(WIDTH)).ravel(), np.repeat(d, WIDTH), 257 * WIDTH).reshape(257, WIDTH)
            d_embed += (table @ w["filters"][:, f].reshape(WIDTH, DIM)).astype(np.float32)
        return g | {"filters": d_filters, "embed": d_embed}

    @classmethod
    def fit(cls, texts: list[bytes], labels: np.ndarray, weights: np.ndarray, updates: int = 420, batch: int = 32, rate: float = 4e-3, seed: int = 1) -> Network:
        """Adam on the weighted log loss, over and over the rows in seeded orders, with a
        falling rate."""
        net = cls.start(seed)
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in net.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in net.w.items()}
        total = updates if texts else 0
        share = float((labels * weights).sum() / max(weights.sum(), 1e-9)) if len(labels) else 0.5
        net.w["out_bias"][:] = np.log(max(share, 1e-3) / max(1 - share, 1e-3))
        order = np.zeros(0, np.int64)
        for t in range(1, total + 1):
            while len(order) < batch:
                order = np.concatenate([order, rng.permutation(len(texts))])
            pick, order = order[:batch], order[batch:]
            buf = np.frombuffer(b"".join(texts[k] for k in pick), np.uint8)
            off = np.concatenate([[0], np.cumsum([len(texts[k]) for k in pick])])
            g = net._gradient(buf, off, labels[pick].astype(np.float32), weights[pick].astype(np.float32))
            step = rate * (1 - 0.95 * t / total)
            for k, d in g.items():
                m[k] += 0.1 * (d - m[k])
                v2[k] += 0.01 * (d * d - v2[k])
                net.w[k] -= (step * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v2[k] / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
        return net


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 0 on division by 5; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def fit_quality(docs: DataFrame, labels: DataFrame, train_rows: int = 1500, train_bytes: int = 12_000_000, updates: int = 420,
                id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Network:
    """Fit on labelled documents that are not held out: of each class the ``train_rows``
    with the smallest hash of the id, and of these as many, in the same order, as hold half of
    ``train_bytes`` bytes; texts above a fiftieth of ``train_bytes`` come last in that order,
    so one very long text never takes the place of others.  Rows weigh so that the classes have
    their shares among all such labels.  Contradicting or null labels are left out."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)))
             .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("y"), F.max(label_col).alias("z")).where("y = z").select("id", "y"))
    # only ids of documents that are there count
    known = known.join(docs.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi").withColumn("h", F.xxhash64("id", F.lit(3)))
    known = known.persist()
    share = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not share:
        known.unpersist()
        return Network.fit([], np.zeros(0), np.zeros(0), updates)
    chosen = None
    for y in sorted(share):
        part = known.where(F.col("y") == y).orderBy("h", "id").limit(train_rows)
        chosen = part if chosen is None else chosen.union(part)
    # at most 2 * train_rows ids are sent out
    rows = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "id").select("id", "y", "h", "text", F.octet_length("text").alias("size"), F.xxhash64("text").alias("x")))
    # sums over sizes alone; texts above a fiftieth of the bytes come last, so that none keeps others out
    order = Window.partitionBy("y").orderBy(F.col("size") > train_bytes // 50, "h", "id", "x").rowsBetween(Window.unboundedPreceding, 0)
    fit_in = rows.select("id", "y", "h", "x", "size").withColumn("sum", F.sum("size").over(order)).where(F.col("sum") <= train_bytes // 2)
    fit_in = staged(fit_in.select("id", "x").distinct(), "train_ids")
    rows = rows.join(F.broadcast(fit_in), ["id", "x"]).select("id", "y", "h", "text").collect()
    known.unpersist()
    rows.sort(key=lambda r: (r.h, r.id, r.text))
    y = np.array([r.y for r in rows])
    n = {k: max(1, int((y == k).sum())) for k in share}
    weights = np.array([share[k] / n[k] for k in y.tolist()], float)
    return Network.fit([r.text.encode() for r in rows], y, weights / weights.mean() if len(weights) else weights, updates)


def score_quality(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: id_col (and the columns ``keep``) and score, the
    probability of label 1.

    Cases: null text scores as the empty text (padding alone); a very long text is
    covered whole, in pieces; repeated rows score alike; an empty table gives an empty
    result; without any label every score is the untrained network's; columns that are
    not asked for are not read, whatever their names."""
    shared = docs.sparkSession.sparkContext.broadcast(network.w)
    keep = [id_col, *[c for c in keep or [] if c not in (id_col, "score")]]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        net = Network(shared.value)
        for batch in steps(batches, "__text", 1 << 20):
            buf, off = text_buffer(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(net.score(buf, off))], [*keep, "score"])

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(text_col), F.lit("")).alias("__text")).mapInArrow(run, f"{schema}, score double")
