"""A gated recurrent language model in numpy, trained by truncated backpropagation.

The words that training documents hold OFTEN times or more, the most frequent first, are outputs
of their own, and so is the end: their number grows with the corpus up to SIDE * (SIDE - 1) - 1.
Every other word belongs to a band by its last two bytes, and each band is an output (and an
input) of the model: P(word) = P(band | what came before) times the word's
share, by count and smoothed by one, of its band. The output softmax is factored: a class of an
output, then the output within its class. Documents run in lanes, side by side; windows of
WINDOW steps are cut for backpropagation, and each lane's hidden state is carried from a window
to the next, so that a document's log-likelihood is that of the whole of it.

Training covers every training document. Documents are dealt into shards by a hash of doc_id and
content, as many as the corpus' tokens ask for, and are sorted within each; from a common start
(fitted on START_TOKENS tokens about, chosen by hash) each shard is passed over once, and the
shards' weights are averaged, by tokens. Nothing of this depends on how the input is
partitioned: scores agree but for the rounding of 32-bit sums.

Counts cover all training documents. The HEAD most frequent words go to every task; a document's
other words are counted by a join, so the tasks' memory is bounded whatever the vocabulary.

Defined results: a null or empty text is one end token; without training documents all counts
are 0 and the model is even over its outputs; repeated rows count and are scored each; a null
doc_id counts as the empty text in the split; words of equal count are ranked by their text;
other columns pass by, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.common import crc_rest, freed_stays, lower_az, one_thread, table, tidied, trimmed, written

#: Token of the end, which no word can be: words hold no white space.
END = "\n"
#: Words seen so often are outputs of their own, as far as SIDE allows: the softmax has up to
#: SIDE classes of SIDE outputs, the last class being that of the bands.
OFTEN = 50
SIDE = 48
LEAST_SIDE = 8
HIDDEN = 16
LANES = 256
WINDOW = 32
HEAD = 300_000
START_TOKENS = 300_000
START_EPOCHS = 2
START_LANES = 64
FLUSH = 400_000
#: Tokens whose documents run in lanes together.
TOGETHER = 2_000_000
#: Tokens that are numbered at once.
STEP_TOKENS = 400_000
#: Training tokens of a shard, about.
SHARD_TOKENS = 2_000_000
RATE = 0.08
CHUNK = 1024
LN10 = np.log(10.0)
f32 = np.float32


def bounded(x: np.ndarray) -> np.ndarray:
    """Logits within what float32 can exponentiate; products with ones then sum rows fast."""
    return np.clip(x, -60, 60, out=x)


class Gru:
    """Weights and their gradients; all float32."""

    NAMES = ("wx", "u", "bn", "wc", "bc", "wo", "bo")

    def __init__(self, wx, u, bn, wc, bc, wo, bo):
        self.wx, self.u, self.bn, self.wc, self.bc, self.wo, self.bo = wx, u, bn, wc, bc, wo, bo

    @classmethod
    def fresh(cls, side: int, seed: int = 7, hidden: int = HIDDEN) -> Gru:
        r = np.random.default_rng(seed)
        g = lambda *s: r.normal(0, 0.1, s).astype(f32)
        z = lambda *s: np.zeros(s, f32)
        return cls(g(side * side, 3 * hidden), g(hidden, 3 * hidden), z(hidden), g(hidden, side), z(side), g(side, hidden, side), z(side, side))

    def primed(self, share: np.ndarray) -> Gru:
        """Biases such that the outputs' shares are where training begins."""
        share = share.reshape(self.bo.shape)
        self.bc[:] = np.log(share.sum(1))
        self.bo[:] = np.log(share / share.sum(1, keepdims=True))
        return self

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def filled(self, flat: np.ndarray) -> Gru:
        out, at = [], 0
        for n in self.NAMES:
            w = getattr(self, n)
            out.append(flat[at : at + w.size].reshape(w.shape).astype(f32))
            at += w.size
        return Gru(*out)

    def run(self, tokens: np.ndarray, reset: np.ndarray, h: np.ndarray):
        """States of a window: tokens and reset are (steps, lanes), h (hidden, lanes).

        Lanes come last, so that each gate is one block of memory; what does not depend on the
        state is done for all steps at once, here and in `back`.
        """
        n, (steps, lanes) = h.shape[0], tokens.shape
        u = np.ascontiguousarray(self.u.T)
        u[: 2 * n] *= 0.5
        bn = self.bn[:, None]
        g = np.ascontiguousarray(self.wx[tokens].transpose(0, 2, 1))
        g[:, : 2 * n] *= 0.5
        hs, rz, an, c = (np.empty((steps + k, m, lanes), f32) for k, m in ((1, n), (0, 2 * n), (0, n), (0, n)))
        hs[0] = h
        ends = (reset == 0).any(1).tolist()
        for t in range(steps):
            h = hs[t] * reset[t] if ends[t] else hs[t]
            a = u @ h
            s, x, y = rz[t], c[t], hs[t + 1]
            np.add(g[t, : 2 * n], a[: 2 * n], out=s)
            np.tanh(s, out=s)
            s *= 0.5
            s += 0.5
            np.add(a[2 * n :], bn, out=an[t])
            np.multiply(s[:n], an[t], out=x)
            x += g[t, 2 * n :]
            np.tanh(x, out=x)
            np.subtract(h, x, out=y)
            y *= s[n:]
            y += x
        return hs, (rz, an, c, ends)

    def logs(self, h: np.ndarray, target: np.ndarray, gradient: dict | None = None) -> np.ndarray:
        """Natural log of each target's probability; adds gradients of the sum of -log.

        Rows are sorted by target, so that a class' rows lie together, and the bias is a weight
        of a last, constant state. The softmaxes are never divided out: what is read from them
        is scaled by row, and the targets' own terms are summed apart.
        """
        side, n = len(self.bc), len(h)
        order = np.argsort(target.astype(np.int16), kind="stable")  # 16 bits: a radix sort
        t = target[order]
        cls, within = t // side, t % side
        rows, ones = np.arange(n), np.ones(side, h.dtype)
        x = np.empty((n, h.shape[1] + 1), h.dtype)
        x[:, :-1], x[:, -1] = h[order], 1
        wc, wo = np.vstack([self.wc, self.bc]), np.concatenate([self.wo, self.bo[:, None]], 1)
        # states are within -1 and 1, which bounds the logits
        bound_c, bound_o = np.abs(wc).sum(0).max(), np.abs(wo).sum(1).max(1)
        e = x @ wc
        if bound_c > 60:
            bounded(e)
        out = e[rows, cls]
        np.exp(e, out=e)
        s = e @ ones
        out -= np.log(s)
        if gradient is not None:
            s = (1 / s)[:, None]
            g_c, g_o = (x * s).T @ e, np.zeros_like(wo)
            dh = e @ wc[:-1].T
            dh *= s
        cut = np.searchsorted(t, np.arange(side + 1) * side).tolist()
        for k in range(side):
            i, j = cut[k], cut[k + 1]
            if i == j:
                continue
            xk = x[i:j]
            e = xk @ wo[k]
            if bound_o[k] > 60:
                bounded(e)
            got = e[rows[: j - i], within[i:j]]
            np.exp(e, out=e)
            s = e @ ones
            out[i:j] += got - np.log(s)
            if gradient is not None:
                s = (1 / s)[:, None]
                g_o[k] = (xk * s).T @ e
                dh[i:j] += (e @ wo[k, :-1].T) * s
        back = np.empty_like(order)
        back[order] = rows
        if gradient is not None and n:
            first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
            of_target, c = np.add.reduceat(x, first), cls[first]
            g_o[c, :, within[first]] -= of_target
            begin = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
            g_c[:, c[begin]] -= np.add.reduceat(of_target, begin).T
            of_output = np.ascontiguousarray(wo[:, :-1].transpose(0, 2, 1))
            of_output += wc[:-1].T[:, None]
            dh -= of_output.reshape(side * side, -1)[t]
            gradient["wc"], gradient["bc"], gradient["wo"], gradient["bo"] = g_c[:-1], g_c[-1], g_o[:, :-1], g_o[:, -1]
            gradient["h"] = dh[back]
        return out[back]

    def back(self, hs: np.ndarray, reset: np.ndarray, kept, dhs: np.ndarray, gradient: dict) -> None:
        """Backpropagation through the window's steps, and no further. dhs is used up."""
        rz, an, c, ends = kept
        steps, n, lanes = dhs.shape
        r, z = rz[:, :n], rz[:, n:]
        h = hs[:-1] * reset[:, None]
        of_c = (1 - z) * (1 - c * c)
        of_z = (h - c) * z * (1 - z)
        of_r = an * r * (1 - r)
        d_g, d_a = np.empty((steps, 3 * n, lanes), f32), np.empty((steps, 3 * n, lanes), f32)
        later = 0
        for t in range(steps - 1, -1, -1):
            dh, g, a = dhs[t], d_g[t], d_a[t]
            dh += later
            np.multiply(dh, of_c[t], out=g[2 * n :])
            np.multiply(g[2 * n :], of_r[t], out=g[:n])
            np.multiply(dh, of_z[t], out=g[n : 2 * n])
            a[: 2 * n] = g[: 2 * n]
            np.multiply(g[2 * n :], r[t], out=a[2 * n :])
            later = self.u @ a
            dh *= z[t]
            later += dh
            if ends[t]:
                later *= reset[t]
        d_a = d_a.transpose(1, 0, 2).reshape(3 * n, -1)
        gradient["u"] = h.transpose(1, 0, 2).reshape(n, -1) @ d_a.T
        gradient["bn"] = d_a[2 * n :] @ np.ones(d_a.shape[1], d_a.dtype)
        gradient["g"] = d_g.transpose(0, 2, 1).reshape(-1, 3 * n)


class Lanes:
    """Documents laid end to end in lanes; lanes are ordered by length, so that those still
    running come first at every step."""

    def __init__(self, lengths: np.ndarray, lanes: int = LANES):
        order = np.argsort(-lengths, kind="stable")
        lanes = max(1, min(lanes, len(lengths), int(lengths.sum()) // 8 + 1))
        loads, members = np.zeros(lanes, np.int64), [[] for _ in range(lanes)]
        import heapq

        heap = [(0, k) for k in range(lanes)]
        for d in order:
            load, k = heapq.heappop(heap)
            members[k].append(d)
            loads[k] = load + lengths[d]
            heapq.heappush(heap, (int(loads[k]), k))
        starts = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths, out=starts[1:])
        by = np.argsort(-loads, kind="stable")
        self.steps = int(loads.max(initial=0))
        self.loads = loads[by]
        self.at = np.zeros((self.steps, lanes), np.int32)
        for column, k in enumerate(by):
            if members[k]:
                self.at[: loads[k], column] = np.concatenate([np.arange(starts[d], starts[d + 1], dtype=np.int32) for d in members[k]])
        self.first = np.zeros(int(starts[-1]), bool)
        self.first[starts[:-1]] = True

    def windows(self, size: int):
        """(places, lanes running): each window holds the lanes that run to its end, and the
        steps between are cut so that no lane ends inside one."""
        t = 0
        while t < self.steps:
            k = int(np.searchsorted(-self.loads, -t, side="left"))
            end = min(t + size, self.steps, int(self.loads[k - 1]))
            yield self.at[t:end, :k]
            t = end


def in_lanes(model: Gru, ids: list[np.ndarray], train: dict | None = None, window: int = WINDOW, lanes: int = LANES) -> np.ndarray:
    """Sum of log10 probabilities of each document (ids end with the end token, 0).

    train: Adagrad sums by weight, to learn on the way.
    """
    lengths = np.array([len(x) for x in ids], np.int64)
    if not len(ids):
        return np.zeros(0)
    flat = np.concatenate(ids)
    inputs = np.empty_like(flat)
    inputs[0], inputs[1:] = 0, flat[:-1]
    lay = Lanes(lengths, lanes)
    inputs[lay.first] = 0
    goes_on = (~lay.first).astype(f32)
    logs = np.empty(len(flat), f32)
    n = model.u.shape[0]
    h = np.zeros((n, lay.at.shape[1]), f32)
    for at in lay.windows(window):
        k = at.shape[1]
        tokens, reset = inputs[at], goes_on[at]
        hs, kept = model.run(tokens, reset, h[:, :k])
        h = hs[-1]
        states, target = hs[1:].transpose(0, 2, 1).reshape(-1, n), flat[at].ravel()
        if train is None:
            logs[at.ravel()] = model.logs(states, target)
            continue
        gradient: dict = {}
        logs[at.ravel()] = model.logs(states, target, gradient)
        model.back(hs, reset, kept, np.ascontiguousarray(gradient.pop("h").reshape(*at.shape, n).transpose(0, 2, 1)), gradient)
        learn(model, train, gradient, tokens.ravel())
    total = np.add.reduceat(logs.astype(np.float64), np.r_[0, np.cumsum(lengths)[:-1]])
    return total / LN10


def learn(model: Gru, sums: dict, gradient: dict, tokens: np.ndarray, rate: float = RATE) -> None:
    scale = f32(1 / max(len(tokens), 1) ** 0.5)
    for name in ("u", "bn", "wc", "bc", "wo", "bo"):
        g = gradient[name] * scale
        sums[name] += g * g
        getattr(model, name).__isub__(rate * g / np.sqrt(sums[name]))
    order = np.argsort(tokens.astype(np.int16), kind="stable")
    sorted_ = tokens[order]
    begin = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
    rows = sorted_[begin]
    g = np.add.reduceat(gradient["g"][order], begin) * scale
    sums["wx"][rows] += g * g
    model.wx[rows] -= rate * g / np.sqrt(sums["wx"][rows])


def adagrad(model: Gru) -> dict:
    return {n: np.full_like(getattr(model, n), 1e-2) for n in Gru.NAMES}


def packed(model: Gru, sums: dict) -> np.ndarray:
    """Weights and their Adagrad sums, end to end."""
    return np.concatenate([model.flat(), *(sums[n].ravel() for n in Gru.NAMES)])


def unpacked(like: Gru, flat: np.ndarray) -> tuple[Gru, dict]:
    half = len(flat) // 2
    sums = like.filled(flat[half:])
    return like.filled(flat[:half]), {n: getattr(sums, n) for n in Gru.NAMES}


# ---- counts


def word_counts(docs: DataFrame) -> DataFrame:
    """w, c over all documents: each task sends its words counted."""

    def run(batches):
        counts: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([strings(list(counts)), pa.array(list(counts.values()), pa.int64())], ["w", "c"])

        for b in batches:
            for text in b.column("text").to_pylist():
                counts.update(lower_az(text or "").split())
                counts[END.encode()] += 1
                if len(counts) > FLUSH:
                    yield rows()
                    counts.clear()
        if counts:
            yield rows()

    return docs.select("text").mapInArrow(run, "w string, c long").groupBy("w").agg(F.sum("c").alias("c"))


def band_of(word: bytes, bands: int) -> int:
    return zlib.crc32(word[-2:]) % bands


class Head:
    """The most frequent words with their counts, by rank; the model knows the first ones.

    bands: sum of counts and number of words of every band, as a (2, side) array.
    """

    def __init__(self, words: list[str], counts: list[int], total: int, distinct: int, bands: np.ndarray):
        # the end is output 0; the model's words are 1..model_words; then come the bands
        words_counts = [(w.encode(), c) for w, c in zip(words, counts, strict=True) if w != END]
        self.rank = {w: i + 1 for i, (w, _) in enumerate(words_counts)}
        end = dict(zip(words, counts, strict=True)).get(END, 0)
        self.log_c1 = np.log10(np.array([end, *(c for _, c in words_counts)], np.float64) + 1)
        self.total, self.distinct, self.side = total, distinct, bands.shape[1]
        self.first_band = self.side * (self.side - 1)
        self.model_words = self.first_band - 1
        known = [end, *(c for _, c in words_counts[: self.model_words])]
        self.log_base = np.log10(total + distinct + 1)
        self.has_end = end > 0
        bands = bands.copy()
        for w, c in words_counts[: self.model_words]:
            bands[:, band_of(w, self.side)] -= c, 1
        # of a band: its words, each with one more than its count, and one for all unseen ones
        self.log_band = np.log10(bands.sum(0) + 1.0)
        self.output = np.array([0, *(i + 1 if i < self.model_words else self.first_band + band_of(w, self.side) for i, (w, _) in enumerate(words_counts))], np.int16)
        self.share = np.ones(self.side * self.side)
        self.share[: len(known)] += known
        self.share[self.first_band :] += bands[0]
        self.share /= self.share.sum()

    def numbers(self, lists: list[list[bytes]]) -> tuple:
        """Of documents laid end to end, each with the end as its last token: where each begins,
        ranks (-1 beyond the head), outputs, and the words beyond the head."""
        lengths = np.fromiter(map(len, lists), np.int64, len(lists)) + 1
        starts = np.r_[0, np.cumsum(lengths)]
        words = list(chain.from_iterable(lists))
        at = np.ones(int(starts[-1]), bool)
        at[starts[1:] - 1] = False
        ranks = np.zeros(int(starts[-1]), np.int32)
        ranks[at] = np.fromiter(map(self.rank.get, words, repeat(-1)), np.int32, len(words))
        outputs = self.output[ranks]
        far = np.flatnonzero(ranks[at] < 0).tolist()
        beyond = [words[j] for j in far]
        outputs[ranks < 0] = [self.first_band + band_of(w, self.side) for w in beyond]
        return starts, ranks, outputs, beyond

    def sums(self, starts: np.ndarray, ranks: np.ndarray, outputs: np.ndarray) -> tuple:
        """By document: tokens within the head, their log10 of count + 1, and log10 of the shares
        that the model leaves to counts (but for words beyond the head)."""
        total = lambda x: np.add.reduceat(x, starts[:-1]) if len(starts) > 1 else np.zeros(0)
        near = ranks >= 0
        c1 = np.where(near, self.log_c1[ranks], 0.0)
        of_band = outputs >= self.first_band
        shares = np.where(of_band, c1, 0.0)
        shares[of_band] -= self.log_band[outputs[of_band] - self.first_band]
        return total(near.astype(np.int64)), total(c1), total(shares)


def head_of(counts: DataFrame, size: int = HEAD) -> Head:
    """At most `size` words come to the driver, and go to the tasks."""
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.count_if(F.col("c") >= OFTEN).alias("often")).first()
    side = min(SIDE, max(LEAST_SIDE, int((sums["often"] + 1) ** 0.5) + 1))
    band = F.crc32(F.substring(F.col("w").cast("binary"), -2, 2)) % side
    bands = np.zeros((2, side), np.int64)
    for r in counts.where(F.col("w") != END).groupBy(band.alias("b")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
        bands[:, r["b"]] = r["c"], r["v"]
    rows = counts.orderBy(F.desc("c"), "w").limit(size).toArrow()
    ends = counts.where(F.col("w") == END).toArrow()
    words, cs = rows.column("w").to_pylist(), rows.column("c").to_pylist()
    if END not in words and ends.num_rows:
        words, cs = [*words, END], [*cs, ends.column("c")[0].as_py()]
    return Head(words, cs, sums["n"], sums["v"], bands)


# ---- documents as numbers

NUMBERED = "doc_id long, held_out boolean, n_tokens long, known long, base double, shares double, mark long, ids binary, tail array<string>"


def strings(words: list[bytes]) -> pa.Array:
    """Arrow text of words in UTF-8, by their bytes."""
    ends = np.zeros(len(words) + 1, np.int32)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)), out=ends[1:])
    return pa.Array.from_buffers(pa.string(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(words))])


def numbered(docs: DataFrame, held_out: Column, head: Head) -> DataFrame:
    """NUMBERED and row for every document. ids: its outputs, two bytes each; mark: their hash;
    tail: its words beyond the head, as often as it has them, whose counts are to be joined."""

    def rows(doc_ids, held, lists):
        starts, ranks, outputs, beyond = head.numbers(lists)
        near, c1, shares = head.sums(starts, ranks, outputs)
        n = np.diff(starts)
        data = memoryview(outputs.tobytes())
        ids = [bytes(data[2 * i : 2 * j]) for i, j in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
        marks = [xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in ids]
        tails = np.zeros(len(lists) + 1, np.int32)
        np.cumsum(n - near, out=tails[1:])
        arrays = [doc_ids, held, pa.array(n), pa.array(near - (0 if head.has_end else 1)), pa.array(c1 - n * head.log_base), pa.array(shares), pa.array(marks, pa.int64()), pa.array(ids, pa.binary()), pa.ListArray.from_arrays(pa.array(tails), strings(beyond))]
        return pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in NUMBERED.split(", ")])

    def run(batches):
        for b in batches:
            begin, lists, held = 0, [], 0
            for i, text in enumerate(b.column("text").to_pylist()):
                lists.append(lower_az(text or "").split())
                held += len(lists[-1])
                if held > STEP_TOKENS or i == b.num_rows - 1:
                    yield rows(b.column("doc_id").slice(begin, len(lists)), b.column("held_out").slice(begin, len(lists)), lists)
                    begin, lists, held = i + 1, [], 0

    found = docs.select(F.col("doc_id").cast("long"), "text", held_out.alias("held_out")).mapInArrow(lambda b: tidied(run(b)), NUMBERED)
    return written(found.withColumn("row", F.monotonically_increasing_id()), "lm-documents")


def as_ids(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int16).astype(np.int32) for x in column.to_pylist()]


def together(ids: list[np.ndarray], tokens: int | None = None):
    """Runs of documents of about TOGETHER tokens."""
    begin, n = 0, 0
    for i, x in enumerate(ids):
        n += len(x)
        if n >= (tokens or TOGETHER) or i == len(ids) - 1:
            yield ids[begin : i + 1]
            begin, n = i + 1, 0


# ---- training

PARTS = "chunk int, sub long, shard long, n long, v array<float>"


def trained_rows(like: Gru, start: np.ndarray, epochs: int, lanes: int, subs: int, with_sums: bool):
    """Weights, with the optimiser's sums if asked for, in chunks, of one shard's pass."""

    def run(t: pa.Table) -> pa.Table:
        one_thread()
        freed_stays()
        t = t.sort_by([("mark", "ascending"), ("doc_id", "ascending")])
        (model, sums), ids, shard = unpacked(like, start), as_ids(t.column("ids")), t.column("shard")[0].as_py()
        for group in together(ids):
            for _ in range(epochs):
                in_lanes(model, group, sums, lanes=lanes)
        flat = packed(model, sums) if with_sums else model.flat()
        parts = [flat[i : i + CHUNK] for i in range(0, len(flat), CHUNK)]
        k = len(parts)
        trimmed()
        return pa.Table.from_arrays([pa.array(range(k), pa.int32()), pa.array([shard % subs] * k, pa.int64()), pa.array([shard] * k, pa.int64()), pa.array([sum(map(len, ids))] * k, pa.int64()), pa.array(parts, pa.list_(pa.float32()))], ["chunk", "sub", "shard", "n", "v"])

    return run


SUMS = "chunk int, sub long, n long, s array<double>"


def summed(weighted: bool):
    """Sums of one chunk, by tokens, in the order of the shards (or of subs)."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("shard" if weighted else "sub")
        ns, total = t.column("n").to_pylist(), 0.0
        for n, v in zip(ns, t.column("v" if weighted else "s"), strict=True):
            total = total + v.values.to_numpy().astype(np.float64) * (n if weighted else 1)
        return pa.Table.from_arrays([t.column("chunk").slice(0, 1), t.column("sub").slice(0, 1), pa.array([sum(ns)], pa.int64()), pa.array([total], pa.list_(pa.float64()))], ["chunk", "sub", "n", "s"])

    return run


def averaged(rows: DataFrame, shards: int, otherwise: np.ndarray) -> np.ndarray:
    """The shards' weights averaged by tokens: sums in two steps, then some dozen rows to the
    driver. Without any shard, `otherwise`."""
    dealt = rows.repartition(shards // 8 + 1, "chunk", "sub")
    first = dealt.groupBy("chunk", "sub").applyInArrow(summed(True), SUMS)
    parts = first.groupBy("chunk").applyInArrow(summed(False), SUMS).toArrow().sort_by("chunk")
    if not parts.num_rows:
        return otherwise
    return np.concatenate([np.asarray(v, np.float64) / n for v, n in zip(parts.column("s").to_pylist(), parts.column("n").to_pylist(), strict=True)])


def trained(rows: DataFrame, head: Head) -> Gru:
    """The model of the training rows of `numbered`."""
    fresh = Gru.fresh(head.side).primed(head.share)
    if not head.total:
        return Gru(*(np.zeros_like(getattr(fresh, n)) for n in Gru.NAMES))
    learned = rows.where("NOT held_out").select("doc_id", "mark", "ids")
    # the sample's bound is on a 64-bit hash: its size stays the same however large the corpus is
    sample = learned if head.total <= START_TOKENS else learned.where(F.xxhash64("mark", "doc_id", F.lit("start")) < int(START_TOKENS / head.total * 2**64) - 2**63)
    start = packed(fresh, adagrad(fresh))
    first = sample.withColumn("shard", F.lit(0).cast("long")).groupBy("shard").applyInArrow(trained_rows(fresh, start, START_EPOCHS, START_LANES, 1, True), PARTS)
    start = averaged(first, 1, start)
    shards = -(-head.total // SHARD_TOKENS)
    dealt = learned.withColumn("shard", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(shards))).repartition(2 * shards, "shard")
    each = dealt.groupBy("shard").applyInArrow(trained_rows(fresh, start, 1, LANES, max(1, int(shards**0.5)), False), PARTS)
    return fresh.filled(averaged(each, shards, start))


# ---- scoring


def model_scores(rows: DataFrame, model: Gru) -> DataFrame:
    """row, model: log10 of the probability of each document's outputs."""

    def run(batches):
        one_thread()
        freed_stays()
        for b in batches:
            ids = as_ids(b.column("ids"))
            out = [in_lanes(model, group) for group in together(ids)]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in b.schema.names if c != "ids"] + [pa.array(np.concatenate(out or [np.zeros(0)]))], [c for c in b.schema.names if c != "ids"] + ["model"])

    kept = rows.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "shares", "ids")
    return kept.mapInArrow(lambda b: tidied(run(b)), "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, shares double, model double")


def likelihoods(docs: DataFrame, held_out: Column, head_size: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for all documents."""
    counts = written(word_counts(docs.where(~held_out)), "lm-counts")
    head = head_of(counts, head_size)
    rows = numbered(docs, held_out, head)
    scored = model_scores(rows, trained(rows, head))
    # a word's count: its row of the table, if it is one of the training documents' words
    tail = rows.select("row", F.explode("tail").alias("w"))
    found = tail.join(counts, "w").groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("c") + F.lit(1.0))).alias("logs"))
    out = scored.join(found, "row", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(head.total).cast("long").alias("train_tokens"), (F.col("base") + logs).alias("base_score"), (F.col("model") + F.col("shares") + logs).alias("score"))


def op5_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return likelihoods(table(spark, sf_dir, "documents"), crc_rest("doc_id", 7) == 2)
