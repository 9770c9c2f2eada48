"""Languages of a text as a mixture: how much of it each language accounts for.

A word's likelihood in a language is that of its character trigrams. Expectation-maximisation finds the
shares of the languages under which the text's words are likeliest. The set of languages is chosen by
likelihood less a penalty for each language: from the best single language on, the language that
raises it most joins the set until none raises it, and then languages leave while that raises it.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turntable.llm.common import WordTable, blocks_of, map_batches, of_worker, texts_of
from turntable.llm.toxicity import GRAM_ROWS, held_out, word_inputs

# The sample that likelihoods are learnt from: rows of each language, and the first characters of so many of each.
ROWS_PER_LANGUAGE = 300
TRAIN_CHARACTERS = 6_000
ADDED = 0.1  # to the count of each trigram
ROUNDS = 10
SET_ROUNDS = 4
CHARACTERS_AT_ONCE = 1_000_000
UNKNOWN = "und"

# Letters and the marks on them; other numbers and signs are no letters.
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def letters_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


@dataclass(frozen=True)
class Model:
    """Languages in order, and the log-likelihoods of trigram rows in each, packed for the workers."""

    packed: bytes


def train(texts: list[str], languages: list[str]) -> Model:
    names = sorted(set(languages))
    counts = np.zeros((GRAM_ROWS, len(names)))
    for i, name in enumerate(names):
        words = [word for text, own in zip(texts, languages, strict=True) if own == name for word in letters_of(text)]
        if words:
            counts[:, i] = np.bincount(word_inputs(words)[1], minlength=GRAM_ROWS)
    table = np.log((counts + ADDED) / (counts.sum(axis=0) + ADDED * GRAM_ROWS))
    return Model(pickle.dumps((names, table.astype(np.float32))))


def fit(df: DataFrame, text: str = "text", language: str = "lang", id_column: str = "doc_id") -> Model:
    """Learn from rows with a language that are not held out.

    At most ROWS_PER_LANGUAGE rows of each language come to the driver: those of at most TRAIN_CHARACTERS characters first,
    then by the smallest hash of their ids; of longer texts the first TRAIN_CHARACTERS. Spark keeps so many per task
    before it shuffles ids. Rows without an id, text or language are not used.
    """
    rows = df.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"), F.col(language).alias("_lang")).where(
        ~held_out("_id") & F.col("_id").isNotNull() & F.col("_lang").isNotNull() & F.col("_text").isNotNull()
    )
    long = F.char_length("_text") > TRAIN_CHARACTERS
    first = Window.partitionBy("_lang").orderBy(long, F.xxhash64("_id"), "_id", F.xxhash64("_text"))
    cut = rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= ROWS_PER_LANGUAGE)
    sample = sorted(cut.select("_lang", F.substring("_text", 1, TRAIN_CHARACTERS)).collect())
    return train([row[1] for row in sample], [row[0] for row in sample])


class _Words:
    """Likelihoods of the words of some texts in each language, relative to their highest, and the texts' sizes."""

    def __init__(self, likely: np.ndarray, highest: np.ndarray, sizes: np.ndarray) -> None:
        self._likely, self._highest, self.sizes = likely, highest, sizes
        self._starts = np.cumsum(sizes) - sizes

    def of(self, texts: np.ndarray) -> _Words:
        if len(texts) == len(self.sizes):
            return self
        sizes = self.sizes[texts]
        rows = np.repeat(self._starts[texts] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return _Words(self._likely[rows], self._highest[rows], sizes)

    def _sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self._starts, axis=0)

    def _mixed(self, share: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", np.repeat(share, self.sizes, axis=0), self._likely) + np.float32(1e-30)

    def single(self) -> np.ndarray:
        """Log-likelihood of each text in each language alone."""
        return self._sums(np.log(self._likely.astype(np.float64) + 1e-300) + self._highest[:, None])

    def gain(self, share: np.ndarray) -> np.ndarray:
        """How much faster than it costs the others the likelihood grows with the share of each language."""
        return self._sums(self._likely / self._mixed(share)[:, None]) / self.sizes[:, None].astype(np.float32)

    def step(self, share: np.ndarray) -> np.ndarray:
        """One round of expectation and maximisation."""
        return share * self.gain(share)

    def likelihood(self, share: np.ndarray) -> np.ndarray:
        return self._sums(np.log(self._mixed(share).astype(np.float64)) + self._highest)

    def fitted(self, share: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares within some sets of languages, from those within all, and the likelihood less the penalty of each set."""
        own = np.where(member, share + np.float32(1e-3), np.float32(0))
        own /= own.sum(axis=1, keepdims=True)
        for _ in range(SET_ROUNDS):
            own = self.step(own)
        own /= own.sum(axis=1, keepdims=True)
        return own, self.likelihood(own) - penalty(member.sum(axis=1), self.sizes)


def penalty(n_languages: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Half the logarithm of the number of words for each language after the first."""
    return 0.5 * (n_languages - 1) * np.log(n_words + 1.0)


class Mixtures:
    """A model, with the likelihoods of known words."""

    def __init__(self, packed: bytes) -> None:
        self.names, table = pickle.loads(packed)  # noqa: S301  made by train() on this job's driver

        def likelihoods(words: list[str]) -> np.ndarray:
            _, grams, first = word_inputs(words)
            return np.add.reduceat(table[grams], first, axis=0)

        self._words = WordTable(len(self.names), likelihoods)

    def shares(self, texts: list[str]) -> list[list[tuple[str, float]]]:
        """For each text its languages with their shares, the largest first; none without letters."""
        out: list[list[tuple[str, float]]] = [[] for _ in texts]
        for block in blocks_of(list(map(len, texts)), CHARACTERS_AT_ONCE) if self.names else ():
            split = [(i, words) for i, text in enumerate(texts[block], block.start) if (words := letters_of(text))]
            if split:
                for (i, _), found in zip(split, self._mixtures([words for _, words in split]), strict=True):
                    out[i] = found
        return out

    def _mixtures(self, texts: list[list[str]]) -> list[list[tuple[str, float]]]:
        numbers = np.concatenate(self._words.numbers(texts))
        logs = self._words.rows[numbers]
        highest = logs.max(axis=1)
        words = _Words(np.exp(logs - highest[:, None]), highest, np.array([len(own) for own in texts]))
        share, member = self._chosen(words)
        shares = np.where(member, share, 0).tolist()
        return [
            sorted(((name, s) for name, s, there in zip(self.names, row, has, strict=True) if there), key=lambda pair: (-pair[1], pair[0]))
            for row, has in zip(shares, member.tolist(), strict=True)
        ]

    def _chosen(self, words: _Words) -> tuple[np.ndarray, np.ndarray]:
        """The set of languages of each text, and their shares."""
        n, k = len(words.sizes), len(self.names)
        every = np.full((n, k), 1 / k, dtype=np.float32)
        for _ in range(ROUNDS):
            every = words.step(every)
        alone = words.single()
        member = np.zeros((n, k), dtype=bool)
        member[np.arange(n), alone.argmax(axis=1)] = True
        share, value = member.astype(np.float32), alone.max(axis=1)

        def change(texts: np.ndarray, own: _Words, trial: np.ndarray) -> np.ndarray:
            """Take the sets of `trial` where they are better; the texts where they are."""
            shares, values = own.fitted(every[texts], trial)
            better = values > value[texts]
            changed = texts[better]
            member[changed], share[changed], value[changed] = trial[better], shares[better], values[better]
            return changed

        texts = np.arange(n)
        while len(texts := texts[member[texts].sum(axis=1) < k]):
            own = words.of(texts)
            trial = member[texts].copy()
            gain = np.where(trial, -np.inf, own.gain(share[texts]))
            trial[np.arange(len(texts)), gain.argmax(axis=1)] = True
            texts = change(texts, own, trial)
        for language in range(k):
            texts = np.flatnonzero(member[:, language] & (member.sum(axis=1) > 2))
            if len(texts):
                trial = member[texts].copy()
                trial[:, language] = False
                change(texts, words.of(texts), trial)
        return share, member


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of `df`, and lang_pred, score (its share of the text) and languages (all of the chosen set).

    A text that is null or has no letter is `und` with score 0 and no languages, as is every text if nothing
    was learnt. Each row is judged by its text alone: repeated rows are alike, null ids stay, and columns named
    as the outputs are replaced. One pass without a shuffle.
    """
    packed = model.packed
    made = ["lang_pred", "score", "languages"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = of_worker(Mixtures, packed).shares(texts_of(batch, text))
        first = pa.array([sets[0][0] if sets else UNKNOWN for sets in found], pa.string())
        share = pa.array([min(1.0, sets[0][1]) if sets else 0.0 for sets in found], pa.float64())
        kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        every = pa.array([[{"lang": name, "share": s} for name, s in sets] for sets in found], kind)
        return pa.record_batch([*[batch.column(name) for name in kept], first, share, every], [*kept, *made])

    kept = [name for name in df.columns if name.lower() not in made]
    types = dict(df.dtypes)
    schema = ", ".join(f"`{name}` {types[name]}" for name in kept)
    outputs = "lang_pred string, score double, languages array<struct<lang: string, share: double>>"
    return map_batches(df.select(*[F.col(f"`{name}`") for name in kept]), work, f"{schema}, {outputs}")
