"""Toxicity by a bidirectional gated recurrent network over words, with attention pooling, trained in numpy.

A word enters as two vectors: one of its own and the sum of those of its character trigrams, both hashed.
Two gated recurrent layers read a window of words, forwards and backwards; attention weighs their states
into one vector, and a logistic unit scores it. A text's score is the highest of its overlapping windows.
"""

from __future__ import annotations

import pickle
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turntable.llm.common import WordTable, blocks_of, map_batches, of_worker, texts_of

WINDOW = 48
STRIDE = 24
THRESHOLD = 0.3
# The sample that the network is trained on: rows of each label, none with a longer text than this.
TRAIN_TOXIC = 600
TRAIN_CLEAN = 1_800
TRAIN_CHARACTERS = 6_000

WORD_ROWS = 1 << 16
GRAM_ROWS = 1 << 15
WORD_SIZE = 6
GRAM_SIZE = 10
HIDDEN = 8
ATTENTION = 8
BATCH = 256
EPOCHS = 2
STEPS = 120  # of each half of the training, at least
OWN_ROW_TEXTS = 8
NEAR_BEST = 2.0
DECAY = 0.02
CALIBRATED_BY = 5  # one training text in so many sets the scale of the scores only
RATE = 0.01
SCORED_AT_ONCE = 2_048
CHARACTERS_AT_ONCE = 500_000

_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)  # an odd constant that spreads code points over the bits


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def word_inputs(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of each word, rows of the trigrams of all words, and where each word's trigrams begin.

    Trigrams run over the word between a mark for its begin and one for its end, so each word has one at least.
    """
    framed = "".join(f"\x02{word}\x03" for word in words)
    points = np.frombuffer(framed.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    ends = np.cumsum(sizes)
    starts = ends - sizes
    with np.errstate(over="ignore"):
        grams = (points[:-2] * _MIX ^ points[1:-1]) * _MIX ^ points[2:]
        rows = (grams * _MIX >> np.uint64(40)).astype(np.int64) % GRAM_ROWS
        # The word's own row mixes all of its characters with their places.
        place = np.arange(len(points), dtype=np.uint64) - np.repeat(starts, sizes).astype(np.uint64)
        mixed = (points + place * np.uint64(0x10001)) * _MIX
        own = np.add.reduceat(mixed ^ mixed >> np.uint64(29), starts) * _MIX
    inside = np.ones(len(points), dtype=bool)
    inside[ends - 1] = inside[ends - 2] = False
    first = np.concatenate([[0], np.cumsum(sizes - 2)[:-1]])
    return (own >> np.uint64(40)).astype(np.int64) % WORD_ROWS, rows[inside[:-2]], first


def window_starts(n: int) -> range:
    """Starts of the windows over n words; the last one ends with the text."""
    return range(0, max(1, n - WINDOW + STRIDE), STRIDE) if n else range(0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def initial(seed: int = 0) -> dict[str, np.ndarray]:
    """Parameters before training: small random weights, for each direction those of three gates side by side."""
    random = np.random.default_rng(seed)
    size = WORD_SIZE + GRAM_SIZE

    def weights(*shape: int) -> np.ndarray:
        return random.standard_normal(shape) / np.sqrt(shape[0])

    made = {
        "words": np.zeros((WORD_ROWS, WORD_SIZE)),
        "grams": 0.1 * weights(GRAM_ROWS, GRAM_SIZE) * np.sqrt(GRAM_ROWS),
        "attend": weights(2 * HIDDEN, ATTENTION),
        "attend_bias": np.zeros(ATTENTION),
        "attend_to": weights(ATTENTION, 1)[:, 0],
        "out": weights(2 * HIDDEN, 1)[:, 0],
        "out_bias": np.zeros(1),
    }
    for side in ("forth", "back"):
        made[f"{side}_in"] = weights(size, 3 * HIDDEN)
        made[f"{side}_bias"] = np.zeros(3 * HIDDEN)
        made[f"{side}_state"] = weights(HIDDEN, 3 * HIDDEN)
    return {name: value.astype(np.float32) for name, value in made.items()}


def _run(inputs: np.ndarray, state_weights: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States of one direction over (time, window, 3 * HIDDEN) inputs; padding leaves the state as it is."""
    state = np.zeros((inputs.shape[1], HIDDEN), dtype=inputs.dtype)
    states = np.empty((*inputs.shape[:2], HIDDEN), dtype=inputs.dtype)
    for t in range(len(inputs)):
        rest = state @ state_weights
        gates = _sigmoid(inputs[t, :, : 2 * HIDDEN] + rest[:, : 2 * HIDDEN])
        stay, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
        new = np.tanh(inputs[t, :, 2 * HIDDEN :] + reset * rest[:, 2 * HIDDEN :])
        moved = (state - new) * stay + new
        if keep is not None:
            keep.append((state, stay, reset, new, rest[:, 2 * HIDDEN :]))
        state = np.where(mask[t, :, None], moved, state) if mask is not None else moved
        states[t] = state
    return states


def _pool(p: dict[str, np.ndarray], states: np.ndarray, mask: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """Attention over time: the weighted state of each window, the weights, and what was looked at."""
    looked = np.tanh(states @ p["attend"] + p["attend_bias"])
    scores = looked @ p["attend_to"]
    if mask is not None:
        scores = np.where(mask, scores, scores.dtype.type(-1e9))
    weights = np.exp(scores - scores.max(axis=0))
    weights /= weights.sum(axis=0)
    return (states * weights[:, :, None]).sum(axis=0), weights, looked


def project(p: dict[str, np.ndarray], words: list[str]) -> np.ndarray:
    """What each word adds to the gates of both directions."""
    own, grams, first = word_inputs(words)
    x = np.concatenate([p["words"][own], np.add.reduceat(p["grams"][grams], first, axis=0)], axis=1)
    return np.concatenate([x @ p[f"{side}_in"] + p[f"{side}_bias"] for side in ("forth", "back")], axis=1)


def logits(p: dict[str, np.ndarray], projected: np.ndarray, windows: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
    """Log odds of windows, given as (time, window) rows of `projected`."""
    inputs = projected[windows]
    forth = _run(inputs[:, :, : 3 * HIDDEN], p["forth_state"], mask)
    back = _run(inputs[::-1, :, 3 * HIDDEN :], p["back_state"], None if mask is None else mask[::-1])[::-1]
    pooled, _, _ = _pool(p, np.concatenate([forth, back], axis=2), mask)
    return pooled @ p["out"] + p["out_bias"]


def _sum_rows(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(rows, weights=column, minlength=n) for column in values.T], axis=1).astype(values.dtype)


def gradients(
    p: dict[str, np.ndarray], vocabulary: tuple, windows: np.ndarray, mask: np.ndarray, labels: np.ndarray
) -> tuple[float, dict]:
    """Mean cross-entropy of some windows, and its gradients by all parameters; of the tables by row."""
    own, grams, first, sizes = vocabulary
    used, at = np.unique(windows, return_inverse=True)
    at = at.reshape(windows.shape)
    n_grams = sizes[used]
    offsets = np.cumsum(n_grams) - n_grams
    rows = grams[np.repeat(first[used] - offsets, n_grams) + np.arange(int(n_grams.sum()))]
    table = np.concatenate([p["words"], np.zeros((1, WORD_SIZE), dtype=p["words"].dtype)])
    x = np.concatenate([table[own[used]], np.add.reduceat(p["grams"][rows], offsets, axis=0)], axis=1)
    saved: dict[str, list] = {"forth": [], "back": []}
    states = []
    for side in ("forth", "back"):
        inputs = (x @ p[f"{side}_in"] + p[f"{side}_bias"])[at]
        turn = slice(None, None, 1 if side == "forth" else -1)
        states.append(_run(inputs[turn], p[f"{side}_state"], mask[turn], saved[side])[turn])
    both = np.concatenate(states, axis=2)
    pooled, weights, looked = _pool(p, both, mask)
    guess = _sigmoid(pooled @ p["out"] + p["out_bias"])
    loss = -np.mean(np.log(np.where(labels > 0.5, guess, 1 - guess) + 1e-9))

    g = {}
    d_logit = ((guess - labels) / len(labels)).astype(guess.dtype)
    g["out"], g["out_bias"] = pooled.T @ d_logit, d_logit.sum(keepdims=True)
    d_pooled = d_logit[:, None] * p["out"]
    d_both = weights[:, :, None] * d_pooled
    d_weights = (both * d_pooled).sum(axis=2)
    d_scores = weights * (d_weights - (weights * d_weights).sum(axis=0))
    g["attend_to"] = np.einsum("tna,tn->a", looked, d_scores)
    d_looked = d_scores[:, :, None] * p["attend_to"] * (1 - looked**2)
    g["attend"] = np.einsum("tnh,tna->ha", both, d_looked)
    g["attend_bias"] = d_looked.sum(axis=(0, 1))
    d_both = d_both + d_looked @ p["attend"].T

    d_x = np.zeros_like(x)
    for side, d_states in (("forth", d_both[:, :, :HIDDEN]), ("back", d_both[::-1, :, HIDDEN:])):
        turned = mask if side == "forth" else mask[::-1]
        places = at if side == "forth" else at[::-1]
        state_weights = p[f"{side}_state"]
        d_state = np.zeros((windows.shape[1], HIDDEN), dtype=x.dtype)
        d_inputs = np.zeros((*windows.shape, 3 * HIDDEN), dtype=x.dtype)
        d_weights_state = np.zeros_like(state_weights)
        for t in range(len(windows) - 1, -1, -1):
            before, stay, reset, new, rest_new = saved[side][t]
            d_state = d_state + d_states[t]
            live = turned[t, :, None]
            d_moved = np.where(live, d_state, 0)
            d_new = d_moved * (1 - stay) * (1 - new**2)
            d_stay = d_moved * (before - new) * stay * (1 - stay)
            d_reset = d_new * rest_new * reset * (1 - reset)
            d_rest = np.concatenate([d_stay, d_reset, d_new * reset], axis=1)
            d_inputs[t] = np.concatenate([d_stay, d_reset, d_new], axis=1)
            d_weights_state += before.T @ d_rest
            d_state = np.where(live, d_moved * stay + d_rest @ state_weights.T, d_state)
        flat = _sum_rows(places.ravel(), d_inputs.reshape(-1, 3 * HIDDEN), len(used))
        g[f"{side}_state"], g[f"{side}_in"], g[f"{side}_bias"] = d_weights_state, x.T @ flat, flat.sum(axis=0)
        d_x += flat @ p[f"{side}_in"].T
    for name, touched, values in (
        ("words", own[used], d_x[:, :WORD_SIZE]),
        ("grams", rows, np.repeat(d_x[:, WORD_SIZE:], n_grams, axis=0)),
    ):
        some, place = np.unique(touched, return_inverse=True)
        g[name] = some, _sum_rows(place, values, len(some))
    has_row = g["words"][0] < WORD_ROWS
    g["words"] = g["words"][0][has_row], g["words"][1][has_row]
    return float(loss), g


class _Adam:
    def __init__(self, p: dict[str, np.ndarray]) -> None:
        self._p, self._step = p, 0
        self._mean = {name: np.zeros_like(value) for name, value in p.items()}
        self._square = {name: np.zeros_like(value) for name, value in p.items()}

    def update(self, g: dict) -> None:
        self._step += 1
        scale = RATE * np.sqrt(1 - 0.999**self._step) / (1 - 0.9**self._step)
        for name, value in g.items():
            # Of the large tables only the rows that were looked up change.
            rows, value = value if isinstance(value, tuple) else (slice(None), value)
            mean = 0.9 * self._mean[name][rows] + 0.1 * value
            square = 0.999 * self._square[name][rows] + 0.001 * value * value
            self._mean[name][rows], self._square[name][rows] = mean, square
            moved = scale * mean / (np.sqrt(square) + 1e-8)
            if value.ndim > 1:
                moved += RATE * DECAY * self._p[name][rows]
            self._p[name][rows] -= moved.astype(np.float32)


def _stacked(ids: list[np.ndarray], owners: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of some texts, padded: (time, window) words and mask, and the text of each window."""
    pieces, of = [], []
    for words, owner in zip(ids, owners, strict=True):
        for start in window_starts(len(words)):
            pieces.append(words[start : start + WINDOW])
            of.append(owner)
    windows = np.zeros((WINDOW, len(pieces)), dtype=np.int64)
    mask = np.zeros((WINDOW, len(pieces)), dtype=bool)
    for i, piece in enumerate(pieces):
        windows[: len(piece), i] = piece
        mask[: len(piece), i] = True
    return windows, mask, np.array(of, dtype=np.int64)


def train(texts: list[str], labels: list[int], seed: int = 0) -> dict[str, np.ndarray]:
    """Parameters learnt from labelled texts. The same input in the same order gives the same parameters.

    Windows first take the label of their text. After half of the rounds, windows of toxic texts that score low
    beside the best of their text are left out, since what makes a text toxic lies elsewhere.
    Texts set aside then scale the scores.
    """
    split = [words_of(text) for text in texts]
    names = sorted({word for words in split for word in words}) or [""]
    number = {word: i for i, word in enumerate(names)}
    own, grams, first = word_inputs(names)
    met = np.bincount([number[word] for words in split for word in set(words)], minlength=len(names))
    # Rows of rarer words stay zero, as those of words not met at all: they are known by their trigrams only.
    own = np.where(met >= OWN_ROW_TEXTS, own, WORD_ROWS)
    vocabulary = own, grams, first, np.diff(np.append(first, len(grams)))
    ids = [np.array([number[word] for word in words], dtype=np.int64) for words in split]
    windows, mask, of = _stacked(ids, list(range(len(ids))))
    wanted = np.array(labels, dtype=np.float64)
    aside = np.arange(len(labels)) % CALIBRATED_BY == 0
    targets = wanted[of]
    p = initial(seed)
    if not 0 < wanted[~aside].sum() < (~aside).sum():  # one label alone teaches nothing: everything has that label
        p["out"][:] = 0
        p["out_bias"][:] = 5 if len(labels) and wanted.mean() > 0.5 else -5
        return p
    p["out_bias"][:] = -1
    adam, random = _Adam(p), np.random.default_rng(seed)
    used = np.flatnonzero(~aside[of])

    def best_of() -> tuple[np.ndarray, np.ndarray]:
        projected = project(p, names)
        parts = [slice(i, i + SCORED_AT_ONCE) for i in range(0, len(of), SCORED_AT_ONCE)]
        now = np.concatenate([logits(p, projected, windows[:, part], mask[:, part]) for part in parts])
        best = np.full(len(ids), -10.0)
        np.maximum.at(best, of, now)
        return now, best

    epochs = max(EPOCHS, -(-2 * STEPS * BATCH // len(used)))
    for epoch in range(2 * epochs):
        if epoch >= epochs:
            now, best = best_of()
            used = np.flatnonzero(~aside[of] & ((targets < 0.5) | (now >= best[of] - NEAR_BEST)))
        # Windows overlap by half: every other one, in turn, covers the texts once.
        order = random.permutation(used[(used + epoch) % 2 == 0])
        for i in range(0, len(order), BATCH):
            some = order[i : i + BATCH]
            _, g = gradients(p, vocabulary, windows[:, some], mask[:, some], targets[some])
            adam.update(g)
    _calibrate(p, best_of()[1][aside], wanted[aside])
    return p


def _calibrate(p: dict[str, np.ndarray], best: np.ndarray, labels: np.ndarray) -> None:
    """Shift the last unit so that THRESHOLD is where texts are told apart with the fewest errors.

    Of cuts with equally few errors, the one in the middle is taken.
    """
    if not 0 < labels.sum() < len(labels):
        return
    order = np.argsort(best, kind="stable")
    toxic = labels[order] > 0.5
    missed = np.concatenate([[0], np.cumsum(toxic)])
    taken = np.concatenate([np.cumsum(~toxic[::-1])[::-1], [0]])
    errors = missed + taken
    cuts = np.flatnonzero(errors == errors.min())
    cut = int(cuts[len(cuts) // 2])
    ordered = np.concatenate([[best[order[0]] - 2], best[order], [best[order[-1]] + 2]])
    p["out_bias"] = (p["out_bias"] + np.log(THRESHOLD / (1 - THRESHOLD)) - (ordered[cut] + ordered[cut + 1]) / 2)


class Scorer:
    """A trained network, with what known words add to its gates."""

    def __init__(self, model: bytes) -> None:
        self._p = {name: value.astype(np.float32) for name, value in pickle.loads(model).items()}  # noqa: S301  made by fit() on this job's driver
        self._words = WordTable(6 * HIDDEN, lambda words: project(self._p, words))

    def texts(self, texts: list[str]) -> np.ndarray:
        """The highest score of all windows of each text; 0 without words."""
        blocks = blocks_of(list(map(len, texts)), CHARACTERS_AT_ONCE)
        return np.concatenate([np.zeros(0), *(self._block([words_of(text) for text in texts[block]]) for block in blocks)])

    def _block(self, texts: list[list[str]]) -> np.ndarray:
        ids = self._words.numbers(texts)
        best = np.zeros(len(texts), dtype=np.float64)
        whole = [i for i, words in enumerate(ids) if len(words) >= WINDOW]
        for group, full in ((whole, True), ([i for i, words in enumerate(ids) if len(words) < WINDOW], False)):
            pieces, of = [], []
            for i in group:
                n = len(ids[i])
                # The last window of a longer text is moved back so that it is full.
                pieces += [ids[i][min(s, max(0, n - WINDOW)) :][:WINDOW] for s in window_starts(n)]
                of += [i] * len(window_starts(n))
                if i == group[-1] or len(pieces) >= SCORED_AT_ONCE:
                    self._best(pieces, of, full, best)
                    pieces, of = [], []
        return best

    def _best(self, pieces: list[np.ndarray], of: list[int], full: bool, best: np.ndarray) -> None:
        for at in range(0, len(pieces), SCORED_AT_ONCE):
            some, owners = pieces[at : at + SCORED_AT_ONCE], of[at : at + SCORED_AT_ONCE]
            if full:
                windows, mask = np.stack(some, axis=1), None
            else:
                windows = np.zeros((WINDOW, len(some)), dtype=np.int64)
                mask = np.zeros((WINDOW, len(some)), dtype=bool)
                for i, piece in enumerate(some):
                    windows[: len(piece), i], mask[: len(piece), i] = piece, True
            np.maximum.at(best, owners, _sigmoid(logits(self._p, self._words.rows, windows, mask).astype(np.float64)))


@dataclass(frozen=True)
class Model:
    """A trained network as it goes to the workers."""

    packed: bytes


def held_out(id_column: str = "doc_id") -> F.Column:
    """Rows that nothing is learnt from: crc32 of the id as text leaves 2 when divided by 4. False for a null id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(df: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id", label: str = "toxic") -> Model:
    """Train on a sample of the labelled rows that are not held out.

    At most TRAIN_TOXIC and TRAIN_CLEAN rows, those whose ids have the smallest hashes, of texts of at most
    TRAIN_CHARACTERS characters, come to the driver. Rows without an id, text or label are not used; an id with
    several labels has the highest; repeated rows count once. With one label or none, every text scores alike.
    """
    known = labels.where(~held_out(id_column)).groupBy(F.col(id_column).alias("_key")).agg(F.max(label).alias("_label"))
    texts = df.select(F.col(id_column).alias("_id"), F.col(text).alias("_text")).where(F.char_length("_text") <= TRAIN_CHARACTERS)
    rows = []
    for value, most in ((1, TRAIN_TOXIC), (0, TRAIN_CLEAN)):
        # Ids are chosen before texts are fetched, so that only the sample is moved.
        sizes = texts.select("_id").join(known.where(F.col("_label") == value), F.col("_id") == F.col("_key")).select("_id")
        chosen = sizes.distinct().orderBy(F.xxhash64("_id"), "_id").limit(most)
        own = texts.join(F.broadcast(chosen), "_id", "left_semi").groupBy("_id").agg(F.min("_text").alias("_text"))
        rows += [(row["_id"], row["_text"], value) for row in own.collect()]
    rows.sort(key=lambda row: str(row[0]))
    p = train([row[1] for row in rows], [row[2] for row in rows])
    return Model(pickle.dumps({name: value.astype(np.float32) for name, value in p.items()}))


def score(df: DataFrame, model: Model, output: str = "score", text: str = "text") -> DataFrame:
    """All columns of `df` and the toxicity of the whole text, from 0 to 1; 0 for a null text or one without words.

    Each row is scored by its text alone: repeated rows score alike, null ids stay, and a column named as the
    output is replaced. One pass without a shuffle; long texts are scored some windows at a time.
    """
    packed = model.packed

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array(of_worker(Scorer, packed).texts(texts_of(batch, text)), pa.float64())
        return pa.record_batch([*[batch.column(name) for name in kept], found], [*kept, output])

    kept = [name for name in df.columns if name.lower() != output.lower()]
    types = dict(df.dtypes)
    schema = ", ".join(f"`{name}` {types[name]}" for name in kept)
    return map_batches(df.select(*[F.col(f"`{name}`") for name in kept]), work, f"{schema}, `{output}` double")
