"""Toxicity by a bidirectional gated recurrent network over characters and words.

The same layer is used twice: a bidirectional GRU whose states an attention pools into one vector. Over the characters of
a word it gives the word's own vector; beside a learned vector of the word (one for all words that few texts share) that
is the input over the words of a window. The pooled state of a window gives its logit. Windows of WINDOW words overlap by
half and cover the whole text; a text's score is that of its highest window.

Training, in numpy, takes a text for toxic where one of its windows is: the chance that none is toxic is the product of
theirs (noisy or), so that labels of whole texts teach windows. Scores of the sample's whole texts are then fitted to
their labels by a logistic curve, so that a score is a chance. Training uses a bounded sample: at most TOXIC labelled texts
of label 1 and CLEAN of label 0, those with the least hashes, LETTERS characters from the middle of each, on the driver.
Scores depend on the text alone and cover all of it. Scoring runs in Arrow batches inside the row, without a shuffle;
the network (under 4 MB) goes along with the task. In a batch each distinct word is read once.

Learning rows are labelled rows of which crc32(id) modulo 4 is not 2.

Defined cases: a null text is the empty text, whose score is that of a window without words; words are runs of letters
and digits in lower case, pieces of WORD characters where they are longer; equal texts have equal scores, whatever stands
beside them in a batch (to 5 digits, to which scores are rounded); an id with several labels is learned once for each;
null ids have no label; without a toxic and a clean row to learn from every score is 0; an empty table gives no rows;
docs may have columns of any names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from weftline.llm.common import batched, beside, free, table

#: Labelled texts to learn from, and characters of each.
TOXIC, CLEAN, LETTERS = 400, 1200, 16_384
#: Words of a window and between the starts of two, characters of a piece of a word.
WINDOW, STRIDE, WORD = 24, 12, 16
#: Sizes of the vectors of characters, characters' states, words and words' states; of the attention.
CHAR, CHAR_STATE, WORD_VECTOR, STATE, LOOK = 8, 10, 12, 14, 12
#: Characters and words with vectors of their own, and the texts that must share a word for that.
CHARS, WORDS, SHARED = 256, 20_000, 4
#: Steps, texts of each label in a step, windows that a step reads of a toxic and of a clean text, width of a step, chance
#: of a word read by its characters alone, most that a clean text weighs beside a toxic one.
STEPS, BATCH, WINDOWS, CLEAN_WINDOWS, RATE, BLIND, WEIGHT = 400, 8, 36, 16, 0.01, 0.3, 6.0
#: Scores from here on are predicted toxic.
THRESHOLD = 0.3
#: Bytes of texts of one batch in a worker, windows scored at once, words remembered by it.
BYTES, AT_ONCE, REMEMBERED = 4 << 20, 1024, 100_000

_WORDS = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """The words of a text in lower case, long ones in pieces."""
    found = _WORDS.findall((text or "").lower())
    if any(len(w) > WORD for w in found):
        found = [w[k : k + WORD] for w in found for k in range(0, len(w), WORD)]
    return found


def windows_of(n: int) -> np.ndarray:
    """The first word of each window over n words; one window where there are none."""
    return np.arange(0, max(1, n - (WINDOW - STRIDE)), STRIDE)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _tanh(x: np.ndarray) -> None:
    """Makes x its hyperbolic tangent, by a fraction that is off by less than 0.0001; several times as fast as numpy's."""
    np.clip(x, -4.97, 4.97, out=x)
    square = x * x
    below = square * 28
    for k in (3150, 62370):
        below += k
        below *= square
    below += 135135
    above = square + 378
    for k in (17325, 135135):
        above *= square
        above += k
    x *= above
    x /= below


def _summed(rows: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """n rows: the sums of those rows that go to each."""
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    if len(at):
        order = np.argsort(at, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0])
        out[at[order[starts]]] = np.add.reduceat(rows[order], starts)
    return out


class Reader:
    """A bidirectional GRU with attention pooling over sequences of rows of a table of input vectors."""

    def __init__(self, weights: dict[str, np.ndarray], name: str):
        self.w, self.name = weights, name

    @staticmethod
    def made(name: str, inputs: int, state: int, look: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        made = {}
        for way in "><":
            made |= {f"{name}W{way}": normal(inputs, 3 * state, scale=inputs**-0.5), f"{name}U{way}": normal(state, 3 * state, scale=state**-0.5), f"{name}b{way}": np.zeros(3 * state, np.float32), f"{name}c{way}": np.zeros(3 * state, np.float32)}
        return made | {f"{name}A": normal(2 * state, look, scale=(2 * state) ** -0.5), f"{name}a": np.zeros(look, np.float32), f"{name}v": normal(look, scale=look**-0.5)}

    def projected(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        """What each input adds to the gates, by direction."""
        return {way: inputs @ self.w[f"{self.name}W{way}"] + self.w[f"{self.name}b{way}"] for way in "><"}

    def read(self, projected: dict[str, np.ndarray], at: np.ndarray, lengths: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """The pooled states (sequences x 2 states) of the sequences at (sequences x steps) of the given lengths."""
        n, steps = at.shape
        state = self.w[f"{self.name}U>"].shape[0]
        states = np.zeros((n, steps, 2 * state), np.float32)
        trace: dict = {">": [], "<": []}
        for side, way in enumerate("><"):
            u, c, rows = self.w[f"{self.name}U{way}"], self.w[f"{self.name}c{way}"], projected[way]
            h = np.zeros((n, state), np.float32)
            for t in range(steps) if way == ">" else range(steps - 1, -1, -1):
                x, y = rows[at[:, t]], h @ u + c
                gates = _sigmoid(x[:, : 2 * state] + y[:, : 2 * state])
                r, z = gates[:, :state], gates[:, state:]
                new = np.tanh(x[:, 2 * state :] + r * y[:, 2 * state :])
                live = (t < lengths)[:, None]
                after = np.where(live, new + z * (h - new), h)
                if keep:
                    trace[way].append((t, h, y[:, 2 * state :], r, z, new, live))
                h = after
                states[:, t, side * state : (side + 1) * state] = h
        looked = np.tanh(states @ self.w[f"{self.name}A"] + self.w[f"{self.name}a"])
        logits = looked @ self.w[f"{self.name}v"]
        logits = np.where(np.arange(steps)[None, :] < np.maximum(lengths, 1)[:, None], logits, -np.inf)
        share = np.exp(logits - logits.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        pooled = (share[:, None, :] @ states)[:, 0]
        return pooled, trace | {"states": states, "looked": looked, "share": share, "pooled": pooled}

    def halved(self, inputs: np.ndarray) -> np.ndarray:
        """(6, inputs, state): projected() as pooled() takes it, by direction and gate. The two sigmoids are hyperbolic
        tangents of half their arguments."""
        made = np.concatenate([rows.reshape(len(inputs), 3, -1) for rows in self.projected(inputs).values()], 1).transpose(1, 0, 2).copy()
        made[[0, 1, 3, 4]] *= np.float32(0.5)
        return made

    def pooled(self, halved: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What read() pools, without what back() needs: longer sequences first, so that each step takes the rows that are
        still going on as they stand."""
        order = np.argsort(-lengths, kind="stable")
        at, lengths = np.ascontiguousarray(at[order].T), lengths[order]
        steps, n = at.shape
        state = halved.shape[2]
        going = np.searchsorted(-lengths, -np.arange(steps), "left")
        states = np.zeros((steps, n, 2 * state), np.float32)
        half = np.array([0.5, 0.5, 1], np.float32)
        for side, way in enumerate("><"):
            u = (self.w[f"{self.name}U{way}"].reshape(state, 3, state) * half[:, None]).transpose(1, 0, 2).copy()
            c, rows = (self.w[f"{self.name}c{way}"].reshape(3, 1, state) * half[:, None, None]), halved[3 * side : 3 * side + 3]
            h = np.zeros((n, state), np.float32)
            for t in range(steps) if way == ">" else range(steps - 1, -1, -1):
                m = going[t]
                if not m:
                    continue
                now, x = h[:m], np.take(rows, at[t, :m], axis=1)
                y = np.matmul(now, u)
                y += c
                gates, new = y[:2], y[2]
                gates += x[:2]
                _tanh(gates)
                gates += 1
                gates *= 0.5
                new *= gates[0]
                new += x[2]
                _tanh(new)
                now -= new
                now *= gates[1]
                now += new
                states[t, :m, side * state : (side + 1) * state] = now
        looked = states.reshape(-1, 2 * state) @ self.w[f"{self.name}A"]
        looked += self.w[f"{self.name}a"]
        _tanh(looked)
        share = (looked @ self.w[f"{self.name}v"]).reshape(steps, n)
        share[np.arange(steps)[:, None] >= np.maximum(lengths, 1)[None]] = -np.inf
        share = np.exp(share - share.max(0))
        share /= share.sum(0)
        states *= share[:, :, None]
        found = np.empty((n, 2 * state), np.float32)
        found[order] = states.sum(0)
        return found

    def back(self, grad: np.ndarray, kept: dict, at: np.ndarray, inputs: np.ndarray, grads: dict[str, np.ndarray]) -> np.ndarray:
        """Adds the gradients of the weights to grads and returns that of inputs; grad is that of the pooled states."""
        states, looked, share, name = kept["states"], kept["looked"], kept["share"], self.name
        n, steps, both = states.shape
        state = both // 2
        on_share = (states @ grad[:, :, None])[:, :, 0]
        on_logits = share * (on_share - (share * on_share).sum(1, keepdims=True))
        grads[f"{name}v"] += on_logits.reshape(-1) @ looked.reshape(-1, looked.shape[2])
        on_look = on_logits[:, :, None] * self.w[f"{name}v"] * (1 - looked**2)
        grads[f"{name}A"] += np.tensordot(states, on_look, ((0, 1), (0, 1)))
        grads[f"{name}a"] += on_look.sum((0, 1))
        on_states = share[:, :, None] * grad[:, None, :] + on_look @ self.w[f"{name}A"].T
        total = np.zeros_like(inputs)
        for side, way in enumerate("><"):
            u = self.w[f"{name}U{way}"]
            flowing, rows = np.zeros((n, state), np.float32), np.zeros((n, steps, 3 * state), np.float32)
            for t, h, y, r, z, new, live in reversed(kept[way]):
                flowing = flowing + on_states[:, t, side * state : (side + 1) * state]
                d = np.where(live, flowing, 0)
                on_new = d * (1 - z) * (1 - new**2)
                on_z, on_r = d * (h - new) * z * (1 - z), on_new * y * r * (1 - r)
                rows[:, t] = np.concatenate([on_r, on_z, on_new], 1)
                on_y = np.concatenate([on_r, on_z, on_new * r], 1)
                grads[f"{name}U{way}"] += h.T @ on_y
                grads[f"{name}c{way}"] += on_y.sum(0)
                flowing = np.where(live, d * z, flowing) + on_y @ u.T
            on_rows = _summed(rows.reshape(-1, 3 * state), at.reshape(-1), len(inputs))
            grads[f"{name}W{way}"] += inputs.T @ on_rows
            grads[f"{name}b{way}"] += on_rows.sum(0)
            total += on_rows @ self.w[f"{name}W{way}"].T
        return total


class Network:
    """The weights, the characters and the words that have vectors of their own."""

    def __init__(self, chars: list[str], words: list[str], weights: dict[str, np.ndarray]):
        # Number 0 is any other character, or any other word.
        self.chars = {c: k + 1 for k, c in enumerate(chars)}
        self.words = {w: k + 1 for k, w in enumerate(words)}
        self.weights = weights
        self.over_chars, self.over_words = Reader(weights, "char"), Reader(weights, "word")

    def spelled(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(w) for w in words], np.int64)
        at = np.zeros((len(words), max(1, int(lengths.max(initial=1)))), np.int64)
        number = self.chars.get
        at[np.arange(at.shape[1])[None, :] < lengths[:, None]] = [number(c, 0) for w in words for c in w]
        return at, lengths

    def vectors(self, words: list[str]) -> np.ndarray:
        """(6, words, state): what each word adds to the gates over words."""
        rows = []
        of_chars = self.over_chars.halved(self.weights["chars"])
        order = sorted(range(len(words)), key=lambda k: len(words[k]))
        for k in range(0, len(order), AT_ONCE):
            some = [words[i] for i in order[k : k + AT_ONCE]]
            pooled = self.over_chars.pooled(of_chars, *self.spelled(some))
            own = self.weights["words"][[self.words.get(w, 0) for w in some]]
            rows.append(self.over_words.halved(np.concatenate([own, pooled], 1)))
        found = np.zeros((6, len(words), STATE), np.float32)
        if words:
            found[:, order] = np.concatenate(rows, 1)
        return found

    def logits(self, texts: list[list[str]], memory: dict[str, int], table: list[np.ndarray]) -> np.ndarray:
        """The logit of each text's highest window. memory and table hold the words met so far and their vectors."""
        if len(memory) > REMEMBERED:
            memory.clear()
            table[:] = [table[0][:, :1]]
        new = [w for w in dict.fromkeys(w for t in texts for w in t) if w not in memory]
        for k, w in enumerate(new):
            memory[w] = table[0].shape[1] + k
        table[:] = [np.concatenate([*table, self.vectors(new)], 1)]
        flat = np.zeros(sum(map(len, texts)) + WINDOW, np.int64)
        flat[: len(flat) - WINDOW] = [memory[w] for t in texts for w in t]
        starts, lengths, owner, base = [], [], [], 0
        for k, t in enumerate(texts):
            first = windows_of(len(t))
            starts.append(first + base)
            lengths.append(np.minimum(WINDOW, len(t) - first))
            owner.append(np.full(len(first), k))
            base += len(t)
        starts, lengths, owner = (np.concatenate(x) for x in (starts, lengths, owner))
        out = np.full(len(texts), -np.inf, np.float32)
        for k in range(0, len(starts), AT_ONCE):
            part = slice(k, k + AT_ONCE)
            pooled = self.over_words.pooled(table[0], flat[starts[part, None] + np.arange(WINDOW)], lengths[part])
            np.maximum.at(out, owner[part], pooled @ self.weights["out"] + self.weights["bias"][0])
        return out


def learn(texts: list[str], toxic: list[int], seed: int = 7, steps: int = STEPS) -> Network | None:
    """A network trained on labelled texts; None unless both labels are there."""
    if len(set(toxic)) < 2:
        return None
    rng = np.random.default_rng(seed)
    split, y = [words_of(t) for t in texts], np.asarray(toxic)
    letters, shared = Counter(c for t in split for w in t for c in w), Counter(w for t in split for w in set(t))
    chars = sorted(letters, key=lambda c: (-letters[c], c))[:CHARS]
    words = sorted((w for w in shared if shared[w] >= SHARED), key=lambda w: (-shared[w], w))[:WORDS]
    vectors = (rng.standard_normal((len(words) + 1, WORD_VECTOR)) * 0.1).astype(np.float32)
    # The first component starts from how much likelier a toxic text has the word.
    with_word = Counter(w for t, label in zip(split, toxic, strict=True) if label for w in set(t))
    odds = [np.log((with_word[w] + 1) / (y.sum() + 2)) - np.log((shared[w] - with_word[w] + 1) / ((1 - y).sum() + 2)) for w in words]
    vectors[1:, 0] += np.clip(odds, -3, 3)
    weights = {
        "chars": (rng.standard_normal((len(chars) + 1, CHAR)) * 0.5).astype(np.float32), "words": vectors,
        **Reader.made("char", CHAR, CHAR_STATE, LOOK, rng), **Reader.made("word", WORD_VECTOR + 2 * CHAR_STATE, STATE, LOOK, rng),
        "out": (rng.standard_normal(2 * STATE) * (2 * STATE) ** -0.5).astype(np.float32), "bias": np.full(1, -3, np.float32),
    }
    net = Network(chars, words, weights)
    first, second = ({k: np.zeros_like(w) for k, w in weights.items()} for _ in range(2))
    of_label = [np.flatnonzero(y == label) for label in (0, 1)]
    weight = min(WEIGHT, max(1.0, len(of_label[0]) / len(of_label[1])))
    queues: list[list[int]] = [[], []]
    for step in range(1, steps + 1):
        chosen = []
        for label, queue in enumerate(queues):
            while len(queue) < BATCH:
                queue += rng.permutation(of_label[label]).tolist()
            chosen += queue[:BATCH]
            del queue[:BATCH]
        grads = _gradients(net, [split[i] for i in chosen], y[chosen], np.where(y[chosen] == 1, 1, weight), rng)
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
        rate = RATE * min(1, step / 20) * (1 - step / (steps + 1))
        for name, g in grads.items():
            g = g * min(1, 5 / (norm + 1e-9))
            first[name] += 0.1 * (g - first[name])
            second[name] += 0.01 * (g**2 - second[name])
            weights[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)
    _calibrate(net, split, y)
    return net


def _calibrate(net: Network, texts: list[list[str]], toxic: np.ndarray) -> None:
    """Stretches and shifts the logits so that the highest one of a text says how likely its label is 1."""
    memory, table = {}, [np.zeros((6, 1, STATE), np.float32)]
    x = np.concatenate([net.logits(texts[k : k + 64], memory, table) for k in range(0, len(texts), 64)]).astype(np.float64)
    ones = toxic.sum()
    target = np.where(toxic == 1, (ones + 1) / (ones + 2), 1 / (len(toxic) - ones + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(slope * x + shift)
        v = (p * (1 - p)).clip(1e-6)
        # Newton's step, held near a slope of 1 by a weak prior.
        g = np.array([((target - p) * x).sum() - (slope - 1), (target - p).sum()])
        h = np.array([[(v * x * x).sum() + 1, (v * x).sum()], [(v * x).sum(), v.sum()]])
        move = np.linalg.solve(h, g).clip(-1, 1)
        slope, shift = max(0.05, slope + move[0]), shift + move[1]
        if np.abs(move).max() < 1e-6:
            break
    net.weights["out"] *= np.float32(slope)
    net.weights["bias"] = (net.weights["bias"] * slope + shift).astype(np.float32)


def _gradients(net: Network, texts: list[list[str]], toxic: np.ndarray, weight: np.ndarray, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """The gradients of the weighted mean loss of some texts."""
    w = net.weights
    parts, owner = [], []
    for k, t in enumerate(texts):
        starts, most = windows_of(len(t)), WINDOWS if toxic[k] else CLEAN_WINDOWS
        if len(starts) > most:
            at_first = rng.integers(len(starts) - most + 1)
            starts = starts[at_first : at_first + most]
        parts += [t[s : s + WINDOW] for s in starts]
        owner += [k] * len(starts)
    owner = np.array(owner)
    distinct = {t: k for k, t in enumerate(dict.fromkeys(x for p in parts for x in p))} or {"": 0}
    spelled, lengths = net.spelled(list(distinct))
    char_pooled, char_kept = net.over_chars.read(net.over_chars.projected(w["chars"]), spelled, lengths, keep=True)
    own_at = np.array([net.words.get(x, 0) for x in distinct])
    own_at = np.where(rng.random(len(own_at)) < BLIND, 0, own_at)
    inputs = np.concatenate([w["words"][own_at], char_pooled], 1)
    long = np.array([len(p) for p in parts])
    at = np.array([[distinct[x] for x in p] + [0] * (WINDOW - len(p)) for p in parts])
    pooled, kept = net.over_words.read(net.over_words.projected(inputs), at, long, keep=True)
    p = _sigmoid((pooled @ w["out"] + w["bias"][0]).astype(np.float64)).clip(1e-9, 1 - 1e-7)
    none = np.bincount(owner, np.log1p(-p), len(texts))
    on_logit = np.where(toxic[owner] == 1, -p * np.exp(none)[owner] / (-np.expm1(none)[owner]).clip(1e-9), p)
    on_logit = (on_logit * (weight / weight.sum())[owner]).astype(np.float32)
    grads = {k: np.zeros_like(x) for k, x in w.items()}
    grads["out"] += pooled.T @ on_logit
    grads["bias"] += on_logit.sum()
    on_inputs = net.over_words.back(on_logit[:, None] * w["out"], kept, at, inputs, grads)
    grads["words"] += _summed(on_inputs[:, :WORD_VECTOR], own_at, len(w["words"]))
    grads["chars"] += net.over_chars.back(np.ascontiguousarray(on_inputs[:, WORD_VECTOR:]), char_kept, spelled, w["chars"], grads)
    return grads


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[list[str], list[int]]:
    """Texts and labels to learn from: of each label the texts with the least hashes, the middle of long ones."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    marks = labels.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{label_col}`").cast("int").alias("y")).where("y IN (0, 1) AND i IS NOT NULL").distinct()
    rows = docs.where(~held_out(id_col)).select(F.col(f"`{id_col}`").alias("i"), F.xxhash64(text).alias("h"))
    found = rows.join(marks, "i").groupBy("y", "h").agg(F.min("i").alias("i"))
    chosen = [(r["i"], r["h"], r["y"]) for y, most in ((1, TOXIC), (0, CLEAN)) for r in found.where(F.col("y") == y).orderBy("h").limit(most).collect()]
    if not chosen:
        return [], []
    middle = text.substr(F.greatest(F.lit(1), ((F.length(text) - LETTERS) / 2).cast("int")), F.lit(LETTERS))
    wanted = docs.where(F.col(f"`{id_col}`").isin([i for i, _, _ in chosen])).select(F.xxhash64(text).alias("h"), middle.alias("t"))
    texts = {r["h"]: r["t"] for r in wanted.where(F.col("h").isin([h for _, h, _ in chosen])).dropDuplicates(["h"]).collect()}
    return [texts[h] for _, h, _ in chosen], [y for _, _, y in chosen]


def scored(docs: DataFrame, net: Network | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs plus score_col double, from 0 to 1."""
    rows = beside(docs, F.col(f"`{text_col}`").cast("string").alias("t"))
    name = free(score_col, docs.columns)
    if net is None:
        return docs.withColumn(name, F.lit(0.0))
    chars, words, weights = list(net.chars), list(net.words), net.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(chars, words, weights)
        memory: dict[str, int] = {}
        table = [np.zeros((6, 1, STATE), np.float32)]

        def score(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = _sigmoid(own.logits([words_of(t.as_py()) for t in batch.column("t")], memory, table).astype(np.float64))
            return pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.round(found, 5))], ["row", "s"])

        return batched(score, batches, BYTES)

    made = rows.mapInArrow(run, StructType([rows.schema["row"], StructField("s", DoubleType())]))
    return made.select("row.*", F.col("s").alias(name))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = learn(*sample(docs, table(spark, sf_dir, "labels")))
    found = scored(docs, net)
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op13_gru_toxicity": op13}
