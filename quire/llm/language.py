"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a label. A word's score for a label comes from its affixes and
character n-grams (hashed; those at a word's edge are its prefixes and suffixes) and from learned
lexicons; learned transitions tie neighbouring words together, so text that switches language
midway is labelled piece by piece. Forward-backward gives each word's label probabilities; their
mean over the text is the text's answer.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import map_text

UNDETERMINED = "und"
#: Weights for hashed n-grams, and the lengths of these.
BUCKETS = 1 << 17
LENGTHS = (2, 3, 4)
#: Words of one block; blocks of all texts of a slice are worked on side by side.
BLOCK = 64
#: Training: words of a sequence, segments of one text, passes, step size, weight decay.
SEQUENCE = 32
SEGMENTS = 30
EPOCHS = 6
RATE = 0.25
DECAY = 1e-6
LEXICON_COUNT = 3
LEXICON_SHARE = 0.8

_WORD = re.compile(r"[^\W\d_]+")
_OPEN, _CLOSE = 2, 3  # code points that no word holds


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


@dataclass
class Model:
    """Learned labels and weights."""

    labels: list[str]
    grams: np.ndarray  # (BUCKETS, labels)
    lexicon: dict[str, int]  # word to the label whose lexicon holds it
    lexical: np.ndarray  # (labels, labels): lexicon of, label
    start: np.ndarray
    moves: np.ndarray  # (labels, labels): from, to


def gram_table(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all words, and the word each belongs to."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    framed = np.full(starts[-1], _OPEN, np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    inner = np.ones(starts[-1], bool)
    inner[starts[:-1]] = inner[starts[1:] - 1] = False
    framed[inner] = codes
    framed[starts[1:] - 1] = _CLOSE
    buckets, owners = [], []
    for n in LENGTHS:
        last = len(framed) - n + 1
        if last <= 0:
            continue
        whole = owner[:last] == owner[n - 1 :]
        value = np.full(last, n, np.uint64)
        for j in range(n):
            value = value * np.uint64(0x100000001B3) ^ framed[j : last + j]
        value = (value ^ value >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
        buckets.append((value >> np.uint64(40)).astype(np.int64)[whole] % BUCKETS)
        owners.append(owner[:last][whole])
    return np.concatenate(buckets), np.concatenate(owners)


def scores_of(model: Model, words: Sequence[str]) -> np.ndarray:
    """(words, labels): what each word says for each label."""
    out = np.zeros((len(words), len(model.labels)))
    buckets, owners = gram_table(words)
    for label in range(len(model.labels)):
        out[:, label] = np.bincount(owners, model.grams[buckets, label], len(words))
    listed = np.fromiter((model.lexicon.get(w, -1) for w in words), np.int64, len(words))
    out[listed >= 0] += model.lexical[listed[listed >= 0]]
    return out


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def marginals(model: Model, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(words, labels): label probabilities of the words of texts laid end to end.

    ``lengths`` are the words of each text, none zero. Forward-backward in blocks: the product of
    a block's steps is a small matrix, blocks of all texts advance together, and a pass over the
    matrices gives what enters each block. So one very long text needs no long sequential loop.
    """
    k = len(model.labels)
    factors = np.exp(scores - scores.max(axis=1, keepdims=True))
    moves, start = np.exp(model.moves), np.exp(model.start)
    blocks = -(-lengths // BLOCK)
    first_block = np.concatenate([[0], np.cumsum(blocks)])
    text_of = np.repeat(np.arange(len(lengths)), blocks)
    number = np.arange(first_block[-1]) - first_block[text_of]
    first_word = np.concatenate([[0], np.cumsum(lengths)])[text_of] + number * BLOCK
    size = np.minimum(BLOCK, lengths[text_of] - number * BLOCK)
    at = first_word[:, None] + np.arange(BLOCK)
    real = np.arange(BLOCK) < size[:, None]
    held = np.where(real[:, :, None], factors[np.minimum(at, len(factors) - 1)], 1.0)

    products = np.broadcast_to(np.eye(k), (len(size), k, k)).copy()
    for t in range(BLOCK):
        new = products @ moves * held[:, t, None, :]
        products = np.where(real[:, t, None, None], new / new.sum(axis=(1, 2), keepdims=True), products)
    ahead = np.empty((len(size), k))  # what meets a block's first word
    leave = np.ones((len(size), k))  # what follows a block's last word
    state = np.empty((0, k))
    for step in range(int(blocks.max())):
        live = first_block[:-1][blocks > step] + step
        ahead[live] = _scaled(np.broadcast_to(start, (len(live), k))) if step == 0 else state @ moves
        # A product begins with the move into its block, which the first block does not have.
        state = _through(ahead[live], held[live], moves) if step == 0 else _scaled(np.einsum("ni,nij->nj", state, products[live]))
        state = state[blocks[blocks > step] > step + 1]
    for step in range(int(blocks.max()) - 1, 0, -1):
        live = first_block[:-1][blocks > step] + step
        leave[live - 1] = _scaled(np.einsum("nij,nj->ni", products[live], leave[live]))

    forward = np.empty_like(held)
    state = ahead
    for t in range(BLOCK):
        if t:
            state = state @ moves
        state = _scaled(state * held[:, t])
        forward[:, t] = state
    back = leave
    for t in range(BLOCK - 1, -1, -1):
        forward[:, t] = _scaled(forward[:, t] * back)
        back = np.where(real[:, t, None], _scaled((back * held[:, t]) @ moves.T), back)
    return forward[real]  # blocks lie in the order of their words


def _through(state: np.ndarray, held: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """States at the end of full first blocks."""
    for t in range(held.shape[1]):
        if t:
            state = state @ moves
        state = _scaled(state * held[:, t])
    return state


def fit(labelled: Sequence[tuple[str, str]], seed: int = 1) -> Model:
    """A model from (text, label) rows; without usable rows it has no labels.

    Sequences are runs of words, half of them joined from two texts of different labels, so that
    changes of language are seen. Adagrad on the likelihood, gradients by forward-backward.
    """
    rng = np.random.default_rng(seed)
    rows = [(words_of(text), label) for text, label in sorted(labelled)]
    rows = [(words, label) for words, label in rows if words]
    labels = sorted({label for _, label in rows})
    k = len(labels)
    model = Model(labels, np.zeros((BUCKETS, k)), {}, np.zeros((k, k)), np.zeros(k), np.zeros((k, k)))
    if k < 2:
        return model
    code = {label: i for i, label in enumerate(labels)}
    counts = Counter((word, code[label]) for words, label in rows for word in words)
    totals: Counter[str] = Counter()
    for (word, _), n in counts.items():
        totals[word] += n
    model.lexicon = {w: c for (w, c), n in counts.items() if n >= LEXICON_COUNT and n >= LEXICON_SHARE * totals[w]}

    vocabulary = {word: i for i, word in enumerate(sorted(totals))}
    names = list(vocabulary)
    runs = []
    for words, label in rows:
        ids = np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words))
        starts = np.arange(0, max(1, len(ids) - SEQUENCE + 1), SEQUENCE)
        starts = rng.choice(starts, min(SEGMENTS, len(starts)), replace=False)
        runs += [(np.resize(ids[s : s + SEQUENCE], SEQUENCE), code[label]) for s in np.sort(starts)]
    ids = np.stack([run for run, _ in runs])
    gold = np.repeat(np.array([c for _, c in runs])[:, None], SEQUENCE, axis=1)
    other = rng.permutation(len(ids))
    cut = rng.integers(1, SEQUENCE, len(ids))
    mixed = np.arange(SEQUENCE) >= cut[:, None]
    mixed[rng.random(len(ids)) < 0.5] = False
    ids, gold = np.where(mixed, ids[other], ids), np.where(mixed, gold[other], gold)

    buckets, owners = gram_table(names)
    listed = np.fromiter((model.lexicon.get(w, -1) for w in names), np.int64, len(names))
    sums = {name: np.full_like(getattr(model, name), 1e-6) for name in ("grams", "lexical", "start", "moves")}
    batch = max(64, min(1024, len(ids) // 8))
    for _ in range(EPOCHS):
        order = rng.permutation(len(ids))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            used, where = np.unique(ids[pick], return_inverse=True)
            near = np.zeros(len(names), np.int64) - 1
            near[used] = np.arange(len(used))
            mine = near[owners] >= 0
            grams, owner = buckets[mine], near[owners[mine]]
            emit = np.stack([np.bincount(owner, model.grams[grams, i], len(used)) for i in range(k)], axis=1)
            known = listed[used] >= 0
            emit[known] += model.lexical[listed[used][known]]
            gap, start, moves = _gradient(model, emit[where.reshape(len(pick), SEQUENCE)], gold[pick])
            word_gap = np.stack([np.bincount(where.ravel(), gap[..., i].ravel(), len(used)) for i in range(k)], axis=1)
            lexical = np.zeros((k, k))
            np.add.at(lexical, listed[used][known], word_gap[known])
            grads = {
                "grams": np.stack([np.bincount(grams, word_gap[owner, i], BUCKETS) for i in range(k)], axis=1),
                "lexical": lexical, "start": start, "moves": moves,
            }
            for name, grad in grads.items():
                weights = getattr(model, name)
                grad = grad / len(pick) + DECAY * weights
                sums[name] += grad**2
                weights -= RATE * grad / np.sqrt(sums[name])
    return model


def _gradient(model: Model, emit: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the negative log-likelihood of equally long sequences: by word, by start, by move."""
    n, length, k = emit.shape
    factors = np.exp(emit - emit.max(axis=2, keepdims=True))
    moves = np.exp(model.moves)
    forward, backward = np.empty_like(factors), np.ones_like(factors)
    forward[:, 0] = _scaled(np.exp(model.start) * factors[:, 0])
    for t in range(1, length):
        forward[:, t] = _scaled(forward[:, t - 1] @ moves * factors[:, t])
    for t in range(length - 2, -1, -1):
        backward[:, t] = _scaled((backward[:, t + 1] * factors[:, t + 1]) @ moves.T)
    gap = _scaled(forward * backward)
    pairs = forward[:, :-1, :, None] * moves * (factors * backward)[:, 1:, None, :]
    pairs /= pairs.sum(axis=(2, 3), keepdims=True)
    seen = np.zeros((k, k))
    np.add.at(seen, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1.0)
    np.put_along_axis(gap, gold[..., None], np.take_along_axis(gap, gold[..., None], 2) - 1.0, 2)
    return gap, gap[:, 0].sum(axis=0), pairs.sum(axis=(0, 1)) - seen


class Tagger:
    """Predicts slices of texts."""

    def __init__(self, model: Model):
        self.model = model

    def words(self, texts: list[str | None]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
        """The words of each text, their number, and the label probabilities of all of them."""
        lists = [words_of(text) for text in texts]
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        codes, known = pd.factorize(np.array(list(itertools.chain.from_iterable(lists)), object))
        if not len(codes) or not self.model.labels:
            return lists, lengths, np.zeros((len(codes), len(self.model.labels)))
        return lists, lengths, marginals(self.model, scores_of(self.model, list(known))[codes], lengths[lengths > 0])

    def languages(self, texts: list[str | None]) -> list[list]:
        """Each text's label and its mean probability."""
        lists, lengths, chances = self.words(texts)
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        some = np.flatnonzero(lengths)
        if not len(some) or not self.model.labels:
            return [names, scores]
        sums = np.add.reduceat(chances, np.concatenate([[0], np.cumsum(lengths[some])[:-1]]), axis=0)
        for i, best, row in zip(some, sums.argmax(axis=1), sums / lengths[some, None], strict=True):
            if any(map(str.isalpha, lists[i])) or any(map(str.isalpha, texts[i])):
                names[i], scores[i] = self.model.labels[best], float(min(1.0, max(0.0, row[best])))
        return [names, scores]

    def spans(self, texts: list[str | None]) -> list[list]:
        """Each text's words with their most likely labels."""
        lists, lengths, chances = self.words(texts)
        if not self.model.labels:
            return [lists, [[UNDETERMINED] * len(words) for words in lists]]
        best = np.array(self.model.labels, object)[chances.argmax(axis=1)]
        return [lists, [list(part) for part in np.split(best, np.cumsum(lengths)[:-1])]]


def sample(df: DataFrame, rows: int, text: str = "text", label: str = "lang", key: str = "doc_id") -> list[tuple[str, str]]:
    """At most ``rows`` labelled rows of each label, those with the smallest hash of their key."""
    usable = df.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(
        F.col(text).alias("text"), F.col(label).alias("label"), F.pmod(F.xxhash64(key), F.lit(1 << 40)).alias("place")
    )
    near = F.lit(False)
    for row in usable.groupBy("label").agg(F.count("*").alias("n")).collect():
        near |= (F.col("label") == row["label"]) & (F.col("place") < int((1 << 40) * min(1.0, 2 * rows / row["n"])))
    found: dict[str, list[tuple[str, str]]] = {}
    for row in sorted(usable.where(near).collect(), key=lambda r: (r["label"], r["place"], r["text"])):
        found.setdefault(row["label"], []).append((row["text"], row["label"]))
    return [pair for pairs in found.values() for pair in pairs[:rows]]


def predict(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred string, score double) of each whole text; only the text is looked at.

    ``und`` with score 0 for null, for text without a letter, or where no label was learned. Of
    labels with equal probability the alphabetically first is given. One row per input row.
    """
    shipped = df.sparkSession.sparkContext.broadcast(model)
    types = [pa.string(), pa.float64()]
    return map_text(df, lambda: Tagger(shipped.value).languages, (key, text), "lang_pred string, score double", types)


def label_words(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, words, labels): the lower-case words of each text and the language of each of them."""
    shipped = df.sparkSession.sparkContext.broadcast(model)
    types = [pa.list_(pa.string())] * 2
    return map_text(df, lambda: Tagger(shipped.value).spans, (key, text), "words array<string>, labels array<string>", types)


def held_out(key: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 on division by 3; false for a null id."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))
