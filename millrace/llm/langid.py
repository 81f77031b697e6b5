"""Language identification by a bidirectional gated recurrent network over bytes (operator 1).

A gated recurrent unit (update and reset gate) reads the bytes of a window forwards and
another backwards; both states at a byte give that position's language probabilities.
A document's probabilities are the mean over all its positions, in windows of WINDOW
bytes that cover the whole text. The activation is a / (1 + |a|), and half of one plus
that for gates: an order cheaper than tanh and exp, with exact gradients.

The network is trained in numpy by backpropagation through time on a bounded sample: by
hash order TRAIN_DOCS documents per language, fewer where MOST_DOCS for all languages are
not enough for that, but one at least; WINDOWS_PER_DOC windows each. Every language of the
training rows is learned, whatever their number.

Defined results: null text, or text without a letter, is ``und`` with score 0; rows
without language are not learned from; with no labelled row at all every text is
``und``; null ids and repeated rows get their own rows; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .common import doc_fold, small_batches, text_bytes

HIDDEN = 8
WINDOW = 128
SEED = 1
FOLDS = 3
HELD_OUT = 1
#: Bounds of the training sample.
TRAIN_DOCS = 1200
MOST_DOCS = 240_000
#: Counts of up to so many languages are broadcast; more are joined by a shuffle, of the windows only.
BROADCAST_LANGS = 100_000
WINDOWS_PER_DOC = 3
TRAIN_WINDOW = 64
STEPS = 320
BATCH = 256
UNDETERMINED = "und"
#: Windows run side by side with up to 16 languages; fewer with more, so that their probabilities take the same room.
SIDE = 2048

_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes | None) -> bool:
    """Whether any character is a letter."""
    if not text:
        return False
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8", "replace")))


def _soft(a: np.ndarray, buf: np.ndarray) -> None:
    """a / (1 + |a|) in place."""
    np.abs(a, out=buf)
    buf += 1
    a /= buf


class Network:
    """Weights, and training."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.langs, self.hidden = langs, hidden
        k, self.p = max(len(langs), 1), {}
        for d in "fb":
            for g in "zrn":
                self.p[f"W{g}{d}"] = rng.normal(0, 0.5, (256, hidden))
                self.p[f"U{g}{d}"] = rng.normal(0, 0.6 / np.sqrt(hidden), (hidden, hidden))
            self.p[f"V{d}"] = rng.normal(0, 0.3, (hidden, k))
        self.p["c"] = np.zeros(k)
        self.p = {n: v.astype(np.float32) for n, v in self.p.items()}

    def states(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden state at each of (time, window) for direction d; ``keep`` gathers what backpropagation needs."""
        p, (steps, n) = self.p, x.shape
        out = np.empty((steps, n, self.hidden), np.float32)
        h = np.zeros((n, self.hidden), np.float32)
        z, r, c, u, buf = (np.empty_like(h) for _ in range(5))
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            xt = x[t]
            np.take(p[f"Wz{d}"], xt, axis=0, out=z, mode="clip")
            np.dot(h, p[f"Uz{d}"], out=u)
            z += u
            _soft(z, buf)
            z += 1
            z *= 0.5
            np.take(p[f"Wr{d}"], xt, axis=0, out=r, mode="clip")
            np.dot(h, p[f"Ur{d}"], out=u)
            r += u
            _soft(r, buf)
            r += 1
            r *= 0.5
            np.take(p[f"Wn{d}"], xt, axis=0, out=c, mode="clip")
            np.dot(h, p[f"Un{d}"], out=u)
            if keep is not None:
                keep.append((t, h.copy(), z.copy(), r.copy(), u.copy()))
            u *= r
            c += u
            _soft(c, buf)
            if keep is not None:
                keep[-1] += (c.copy(),)
            new = out[t]
            np.subtract(h, c, out=new)
            new *= z
            new += c
            h = new
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(language, time, window) probabilities of bytes x (time, window)."""
        k, p = len(self.langs), self.p
        logits = np.dot(p["Vf"].T, self.states(x, "f").reshape(-1, self.hidden).T)
        logits += np.dot(p["Vb"].T, self.states(x, "b").reshape(-1, self.hidden).T)
        logits += p["c"][:, None]
        np.exp(np.clip(logits, -40, 40, out=logits), out=logits)
        logits /= logits.sum(axis=0)
        return logits.reshape(k, *x.shape)

    def gradient(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean position cross-entropy and its gradient, through time."""
        p, n_pos = self.p, max(float(mask.sum()), 1.0)
        steps, n = x.shape
        kept = {d: [] for d in "fb"}
        hs = {d: self.states(x, d, kept[d]) for d in "fb"}
        logits = hs["f"] @ p["Vf"] + hs["b"] @ p["Vb"] + p["c"]
        logits -= logits.max(axis=2, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(axis=2, keepdims=True)
        each = prob[:, np.arange(n), y]
        loss = float(-(np.log(each + 1e-9) * mask).sum() / n_pos)
        dl = prob
        dl[:, np.arange(n), y] -= 1
        dl *= (mask / n_pos)[:, :, None]
        flat = dl.reshape(-1, dl.shape[2])
        g = {"c": flat.sum(axis=0)}
        for d in "fb":
            g[f"V{d}"] = hs[d].reshape(-1, self.hidden).T @ flat
            dh_out = dl @ p[f"V{d}"].T
            back = np.zeros((n, self.hidden), np.float32)
            da = {k: np.empty((steps, n, self.hidden), np.float32) for k in "zrn"}
            for k in "zrn":
                g[f"U{k}{d}"] = np.zeros((self.hidden, self.hidden), np.float32)
            for t, h, z, r, u, c in reversed(kept[d]):
                dh = back + dh_out[t]
                dz = dh * (h - c) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
                dc = dh * (1 - z) * (1 - np.abs(c)) ** 2
                dr = dc * u * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
                du = dc * r
                da["z"][t], da["r"][t], da["n"][t] = dz, dr, dc
                g[f"Uz{d}"] += h.T @ dz
                g[f"Ur{d}"] += h.T @ dr
                g[f"Un{d}"] += h.T @ du
                back = dh * z + dz @ p[f"Uz{d}"].T + dr @ p[f"Ur{d}"].T + du @ p[f"Un{d}"].T
            flat_x = x.reshape(-1)
            order = np.argsort(flat_x, kind="stable")
            seen, first = np.unique(flat_x[order], return_index=True)
            for k in "zrn":
                g[f"W{k}{d}"] = np.zeros((256, self.hidden), np.float32)
                g[f"W{k}{d}"][seen] = np.add.reduceat(da[k].reshape(-1, self.hidden)[order], first, axis=0)
        return loss, g

    def train(self, x: np.ndarray, y: np.ndarray, lengths: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = 0.03, seed: int = SEED) -> float:
        """Adam on random batches, each language alike; returns the last mean loss."""
        rng = np.random.default_rng(seed)
        m, v = ({n: np.zeros_like(a) for n, a in self.p.items()} for _ in range(2))
        by_lang = [np.flatnonzero(y == k) for k in range(len(self.langs))]
        by_lang = [rows for rows in by_lang if len(rows)]
        losses: list[float] = []
        for step in range(1, steps + 1):
            # More languages than a batch holds take turns.
            turn = by_lang if len(by_lang) <= batch else [by_lang[k] for k in rng.choice(len(by_lang), batch, replace=False)]
            rows = np.concatenate([rng.choice(r, batch // len(turn) + 1) for r in turn])
            xb = np.ascontiguousarray(x[rows].T)
            mask = (np.arange(xb.shape[0])[:, None] < lengths[rows][None, :]).astype(np.float32)
            loss, g = self.gradient(xb, y[rows], mask)
            losses.append(loss)
            norm = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
            now = rate * (1 - step / (steps + 1)) + 1e-4
            for n, a in g.items():
                a = a * min(1.0, 1.0 / (norm + 1e-9))
                m[n] = 0.9 * m[n] + 0.1 * a
                v[n] = 0.99 * v[n] + 0.01 * a * a
                self.p[n] = (self.p[n] - now * (m[n] / (1 - 0.9**step)) / (np.sqrt(v[n] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return float(np.mean(losses[-20:])) if losses else 0.0


def windows(texts: list[bytes], width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes as (time, window), the length of each window, and the first window of each text."""
    counts = np.array([-(-len(t) // width) for t in texts], np.int64)
    total = int(counts.sum())
    flat = np.zeros(total * width, np.uint8)
    lengths = np.full(total, width, np.int64)
    first = np.concatenate(([0], np.cumsum(counts)))
    for t, a, b in zip(texts, first[:-1].tolist(), first[1:].tolist()):
        flat[a * width : a * width + len(t)] = np.frombuffer(t, np.uint8)
        if b > a:
            lengths[b - 1] = len(t) - (b - a - 1) * width
    return flat.reshape(total, width), lengths, first


def position_labels(net: Network, text: bytes) -> np.ndarray:
    """Language number at every byte of a text."""
    x, lengths, _ = windows([text])
    if not len(x):
        return np.empty(0, np.int64)
    best = net.probabilities(np.ascontiguousarray(x.T.astype(np.intp))).argmax(axis=0).T
    return best[np.arange(best.shape[1])[None, :] < lengths[:, None]]


def pooled(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of position probabilities, and positions by label, for each text (rows) and language."""
    x, lengths, first = windows(texts)
    k, side = len(net.langs), max(1, SIDE * 16 // max(len(net.langs), 16))
    home = np.repeat(np.arange(len(texts)), np.diff(first))
    prob, label = np.zeros((len(texts), k)), np.zeros((len(texts), k))
    for at in range(0, len(x), side):
        part = np.ascontiguousarray(x[at : at + side].T).astype(np.intp)
        p = net.probabilities(part)
        full = lengths[at : at + side]
        if (full < WINDOW).any():
            p *= np.arange(part.shape[0])[:, None] < full[None, :]
        best = p.max(axis=0)
        # The windows of a text lie together: their sums are added to its row.
        own = home[at : at + side]
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        for i in range(k):
            prob[own[starts], i] += np.add.reduceat(p[i].sum(axis=0), starts)
            label[own[starts], i] += np.add.reduceat(((p[i] == best) & (best > 0)).sum(axis=0), starts)
    return prob, label


def sample(docs: DataFrame, per_lang: int = TRAIN_DOCS, per_doc: int = WINDOWS_PER_DOC, width: int = TRAIN_WINDOW, most: int = MOST_DOCS) -> list[tuple[str, bytes]]:
    """Training windows: spread over each of the first ``per_lang`` documents of a language by hash order, outside the held-out fold; at most about ``most`` documents in all, one of each language at least."""
    usable = docs.filter("lang is not null").filter(doc_fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    # Counts by language, of narrow columns, give the hash range that holds some more rows than are wanted.
    counts = cut(usable.groupBy("lang").agg(F.count("*").alias("n")))
    langs = counts.count()
    per_lang = max(1, min(per_lang, most // max(langs, 1)))
    share = counts.select("lang", (4.0 * max(per_lang, 32) / F.col("n") * (1 << 30)).alias("most"))
    share = F.broadcast(share) if langs <= BROADCAST_LANGS else share
    spread = [F.expr(f"substring(b, cast(greatest(octet_length(b) - {width}, 0) * {i / max(per_doc - 1, 1)} as int) + 1, {width})") for i in range(per_doc)]
    rows = usable.filter("text <> ''").select("doc_id", "lang", F.col("text").cast("binary").alias("b"), F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)).alias("h"))
    cut_down = rows.select("lang", "h", "doc_id", F.array(*spread).alias("w")).join(share, "lang").filter(F.col("h") <= F.col("most"))
    ranked = cut_down.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", "w"))).filter(F.col("n") <= per_lang)
    found = ranked.orderBy("lang", "n").select("lang", "w").toArrow()
    return [(lang, w) for lang, ws in zip(found.column("lang").to_pylist(), found.column("w").to_pylist()) for w in dict.fromkeys(ws) if w]


def fit(docs: DataFrame, steps: int = STEPS) -> Network | None:
    """A network trained on the sample of docs; None if nothing is labelled."""
    rows = sample(docs)
    if not rows:
        return None
    langs = sorted({lang for lang, _ in rows})
    net = Network(langs)
    x = np.zeros((len(rows), TRAIN_WINDOW), np.intp)
    for i, (_, w) in enumerate(rows):
        x[i, : len(w)] = np.frombuffer(w, np.uint8)
    number = {lang: k for k, lang in enumerate(langs)}
    net.train(x, np.array([number[lang] for lang, _ in rows]), np.array([len(w) for _, w in rows]), steps)
    return net


def identify(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_positions, label_share for every row of docs."""
    small_batches(docs.sparkSession)
    net = net or fit(docs)

    def run(batches):
        for batch in batches:
            texts = text_bytes(batch.column(1))
            lettered = [has_letter(t) for t in texts]
            use = [t for t, ok in zip(texts, lettered) if ok] if net else []
            lang, score, share = [UNDETERMINED] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            if use:
                prob, label = pooled(net, use)
                total = np.array([len(t) for t in use], float)
                best = prob.argmax(axis=1)
                rows = np.flatnonzero(lettered).tolist()
                for i, row in enumerate(rows):
                    lang[row] = net.langs[best[i]]
                    score[row] = float(np.clip(prob[i, best[i]] / total[i], 0, 1))
                    share[row] = float(min(label[i, best[i]] / total[i], 1.0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array([len(t or b"") for t in texts], pa.int64()), pa.array(share, pa.float64())], ["doc_id", "lang_pred", "score", "n_positions", "label_share"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, n_positions long, label_share double")
    return found.select("doc_id", (doc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score", "n_positions", "label_share")
