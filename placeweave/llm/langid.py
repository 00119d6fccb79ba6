"""Language identification by a linear-chain conditional random field.

Words are labelled with languages. A word's score per language sums weights of
its affixes, its character trigrams and itself (hashed), and its entry in a
lexicon of the words that the training sample repeats. Learned transitions say
how likely the language changes from word to word. Forward-backward gives every
word's probabilities in its context, so short switches in mixed text are
labelled as such; a document's language is the one with the highest mean
probability over its words, which is its score.

The field is fitted on the driver by its exact likelihood, on word sequences
that are put together from pieces of about ``SAMPLE_PER_LANG`` texts per
language (taken by hash among labelled texts outside the held-out third; of those
of more than ``SAMPLE_BYTES`` bytes, an excerpt of about that size). Prediction
reads every text whole, words of more than ``LONGEST_WORD`` characters as
consecutive pieces, in one pass without a shuffle, in windows of ``WINDOW`` words with ``CONTEXT`` words of
context on both sides, so the longest text needs no more memory than others.

Defined cases: null texts and texts without a letter are ``und`` with score 0,
and so is everything where no labelled text can be learned from; words without
letters take their label from their neighbours and don't count; repeated rows
get equal results; a null id is not held out and not learned from; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeweave.functions.shipping import ship_by_value
from placeweave.session import settle

ship_by_value(__name__)

UNKNOWN = "und"
SAMPLE_PER_LANG = 700
SAMPLE_BYTES = 6_000
BUCKETS = 1 << 15
LENGTH = 20  # words of a training sequence
SEQUENCES = 6_000
PASSES = 4
LEARNING_RATE = 0.5
LEXICON_LEAST = 3
LONGEST_WORD = 32
WINDOW = 1024
CONTEXT = 32
WORDS_AT_ONCE = 500_000
WORDS_KEPT = 300_000


def has_letter(text: str) -> bool:
    """Whether any character is a letter; numbers such as U+00BD are none."""
    return any(map(str.isalpha, text))


def plain(word: str) -> str:
    """A word without what surrounds its letters, in lower case."""
    if not word.isalpha():
        low, high = 0, len(word)
        while low < high and not word[low].isalpha():
            low += 1
        while low < high and not word[high - 1].isalpha():
            high -= 1
        word = word[low:high]
    low = word.lower()
    # a capital that would become two characters stays one
    return low if len(low) <= LONGEST_WORD else "".join(c.lower()[0] for c in word)


def split_words(text: str) -> list[str]:
    """Words of a text; runs of more than ``LONGEST_WORD`` characters (scripts
    without spaces, above all) as consecutive pieces."""
    words = text.split()
    if max(map(len, words), default=0) <= LONGEST_WORD:
        return words
    return [w[k : k + LONGEST_WORD] for w in words for k in range(0, len(w), LONGEST_WORD)]


def feature_table(words: list[str]) -> np.ndarray:
    """Buckets of the features of plain words, a row each: the word itself, its
    first and last one to three letters, its trigrams with both ends marked.
    Places without a feature hold ``BUCKETS``."""

    def bucket(code: np.ndarray, kind: int) -> np.ndarray:
        code = (code + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
        code = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (code >> np.uint64(40)).astype(np.int64) % BUCKETS

    many, long = len(words), LONGEST_WORD
    letters = np.array(words, f"U{long}").view(np.uint32).reshape(many, long).astype(np.uint64)
    used = letters > 0
    length = long - np.argmax(used[:, ::-1], axis=1)
    length[~used.any(1)] = 0
    shift = np.uint64(21)
    whole = np.zeros(many, np.uint64)
    for k in range(long):
        whole = np.where(k < length, whole * np.uint64(1_000_003) + letters[:, k], whole)
    columns = [bucket(whole, 1)]
    rows = np.arange(many)
    first, last = np.zeros(many, np.uint64), np.zeros(many, np.uint64)
    for k in range(3):
        first = (first << shift) | letters[:, k]
        last = (last << shift) | letters[rows, np.maximum(length - 1 - k, 0)]
        columns += [
            np.where(length > k, bucket(first, 2 + k), BUCKETS),
            np.where(length > k, bucket(last, 5 + k), BUCKETS),
        ]
    marked = np.zeros((many, long + 2), np.uint64)
    marked[:, 1:-1] = letters
    marked[:, 0] = ord("^")
    marked[rows, length + 1] = ord("$")
    grams = (marked[:, :-2] << (shift + shift)) | (marked[:, 1:-1] << shift) | marked[:, 2:]
    inside = np.arange(long)[None, :] < length[:, None]
    return np.column_stack([*columns, np.where(inside, bucket(grams, 8), BUCKETS)])


def forward_backward(scores: np.ndarray, transitions: np.ndarray, lengths: np.ndarray):
    """Word probabilities of sequences (time x sequence x label), which come
    longest first; transitions: logarithms, from label to label."""
    steps, _, labels = scores.shape
    pairs = np.exp(transitions)
    local = np.exp(scores - scores.max(2, keepdims=True))
    active = [int(np.searchsorted(-lengths, -t, "left")) for t in range(steps)]
    forward = np.zeros_like(local)
    forward[0] = local[0] / local[0].sum(1, keepdims=True)
    for t in range(1, steps):
        n = active[t]
        f = (forward[t - 1, :n] @ pairs) * local[t, :n]
        forward[t, :n] = f / f.sum(1, keepdims=True)
    backward = np.ones_like(local)
    for t in range(steps - 2, -1, -1):
        n = active[t + 1]
        b = (local[t + 1, :n] * backward[t + 1, :n]) @ pairs.T
        backward[t, :n] = b / b.sum(1, keepdims=True)
    joint = forward * backward
    return joint / np.maximum(joint.sum(2, keepdims=True), 1e-300), forward, backward, local


class Model:
    """Languages, hashed weights, lexicon and transitions."""

    def __init__(self, languages, weights, lexicon, transitions):
        self.languages = languages
        self.weights = weights
        self.lexicon = lexicon
        self.transitions = transitions

    def scores(self, words: list[str]) -> np.ndarray:
        """Scores of plain words, a row each; 0 for words without letters."""
        found = np.zeros((len(words), len(self.languages)))
        for low in range(0, len(words), 20_000):
            part = words[low : low + 20_000]
            table = feature_table(part)
            for column in table.T:
                found[low : low + len(part)] += self.weights[column]
        for at, word in enumerate(words):
            entry = self.lexicon.get(word)
            if entry is not None:
                found[at] += entry
            elif not word:
                found[at] = 0
        return found


def lexicon_of(sample: list[tuple[str, list[str]]], languages: list[str]) -> dict[str, np.ndarray]:
    """Repeated words with how much likelier each language makes them."""
    counts = [Counter() for _ in languages]
    for language, words in sample:
        counts[languages.index(language)].update(words)
    totals = np.array([sum(c.values()) + 1.0 for c in counts])
    out = {}
    for word, n in sum(counts, Counter()).items():
        if n >= LEXICON_LEAST and word:
            share = (np.array([c[word] for c in counts]) + 0.5) / totals
            out[word] = 0.5 * (np.log(share) - np.log(share).mean())
    return out


def training_sequences(sample, languages, rng):
    """Words and labels of sequences of one to three pieces each."""
    by = [[w for l, w in sample if l == language] for language in languages]
    words, labels = [], []
    for _ in range(SEQUENCES):
        cuts = np.sort(rng.choice(np.arange(1, LENGTH), int(rng.integers(0, 3)), replace=False))
        sequence, marks = [], []
        for size in np.diff([0, *cuts, LENGTH]):
            label = int(rng.integers(len(languages)))
            text = by[label][int(rng.integers(len(by[label])))]
            start = int(rng.integers(max(1, len(text) - size)))
            piece = [text[(start + k) % len(text)] for k in range(size)]
            sequence += piece
            marks += [label] * int(size)
        words.append(sequence)
        labels.append(marks)
    return words, np.array(labels)


def fit(rows: list[tuple[str, str]]) -> Model | None:
    """The model from (lang, text) rows; None without a word to learn from."""
    sample = [(lang, [w for w in map(plain, split_words(text)) if w]) for lang, text in rows]
    sample = [(lang, words) for lang, words in sample if words]
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return None
    n = len(languages)
    rng = np.random.default_rng(11)
    words, labels = training_sequences(sample, languages, rng)
    names = sorted({w for s in words for w in s})
    place = {w: i for i, w in enumerate(names)}
    ids = np.array([[place[w] for w in s] for s in words])
    # a word's own feature is left out of training for words met once, so that
    # new words are trusted to their parts
    table = feature_table(names)
    often = np.bincount(ids.ravel(), minlength=len(names))
    table[often <= 1, 0] = BUCKETS
    widest = table.shape[1]
    lexicon = lexicon_of(sample, languages)
    given = np.array([lexicon.get(w, np.zeros(n)) for w in names])
    weights, squares = np.zeros((BUCKETS + 1, n)), np.full((BUCKETS + 1, n), 1e-2)
    transitions, moved = np.zeros((n, n)), np.full((n, n), 1e-2)
    lengths = np.full(100, LENGTH)
    for _ in range(PASSES):
        order = rng.permutation(len(ids))
        for low in range(0, len(order) - 99, 100):
            own = order[low : low + 100]
            seen = ids[own].T
            gold = labels[own].T
            scores = weights[table[seen]].sum(2) + given[seen]
            p, forward, backward, local = forward_backward(scores, transitions, lengths)
            step = p - np.eye(n)[gold]
            slope = np.zeros_like(weights)
            np.add.at(slope, table[seen].reshape(-1, widest), step.reshape(-1, 1, n))
            slope = slope / len(own) + 1e-5 * weights
            slope[BUCKETS] = 0
            squares += slope**2
            weights -= LEARNING_RATE * slope / np.sqrt(squares)
            both = forward[:-1, :, :, None] * np.exp(transitions) * (local * backward)[1:, :, None, :]
            both /= both.sum((2, 3), keepdims=True)
            turn = both.sum((0, 1))
            np.add.at(turn, (gold[:-1].ravel(), gold[1:].ravel()), -1.0)
            turn /= len(own)
            moved += turn**2
            transitions -= LEARNING_RATE * turn / np.sqrt(moved)
    return Model(languages, weights.astype(np.float32), lexicon, transitions)


class Labeller:
    """Labels texts; keeps the scores of words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((1024, len(model.languages)))
        self.letters = np.zeros(1024, bool)

    def _learn(self, words) -> None:
        fresh = words - self.rows.keys()
        if len(self.rows) + len(fresh) > WORDS_KEPT:
            self.rows = {}
            fresh = words
        size = len(self.rows) + len(fresh)
        if size > len(self.scores):
            grown = np.zeros((2 * size, self.scores.shape[1]))
            grown[: len(self.scores)] = self.scores
            self.scores = grown
            self.letters = np.concatenate([self.letters, np.zeros(len(grown) - len(self.letters), bool)])
        fresh = list(fresh)
        bare = list(map(plain, fresh))
        place = {w: i for i, w in enumerate(dict.fromkeys(bare))}
        found = self.model.scores(list(place))
        first = len(self.rows)
        self.rows.update(zip(fresh, range(first, first + len(fresh))))
        self.scores[first : first + len(fresh)] = found[[place[w] for w in bare]] if fresh else 0
        self.letters[first : first + len(fresh)] = list(map(bool, bare))

    def probabilities(self, texts: list[list[str]]):
        """Per text (words given): probabilities of its words, and which have
        letters."""
        self._learn(set().union(*texts))
        rows = [np.fromiter(map(self.rows.__getitem__, t), np.int64, len(t)) for t in texts]
        parts = []
        for text, own in enumerate(rows):
            for start in range(0, len(own), WINDOW):
                low = max(0, start - CONTEXT)
                parts.append((text, start, low, min(len(own), start + WINDOW + CONTEXT)))
        parts.sort(key=lambda p: p[2] - p[3])
        out = [np.zeros((len(own), len(self.model.languages))) for own in rows]
        at = 0
        while at < len(parts):
            tall = parts[at][3] - parts[at][2]
            group = parts[at : at + max(1, WORDS_AT_ONCE // tall)]
            at += len(group)
            lengths = np.array([p[3] - p[2] for p in group])
            scores = np.zeros((tall, len(group), len(self.model.languages)))
            for k, (text, _, low, high) in enumerate(group):
                scores[: high - low, k] = self.scores[rows[text][low:high]]
            found = forward_backward(scores, self.model.transitions, lengths)[0]
            for k, (text, start, low, high) in enumerate(group):
                end = min(start + WINDOW, len(rows[text]))
                out[text][start:end] = found[start - low : end - low, k]
        return out, [self.letters[own] for own in rows]


def _report(model: Model | None):
    def run(batches):
        labeller = None if model is None else Labeller(model)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            names, scores, switches = [UNKNOWN] * len(texts), [0.0] * len(texts), [0] * len(texts)
            known = [i for i, t in enumerate(texts) if t and has_letter(t)] if labeller else []
            at = 0
            while at < len(known):
                own, held = [], 0
                while at < len(known) and (not own or held < WORDS_AT_ONCE):
                    own.append(known[at])
                    held += len(texts[known[at]]) // 5
                    at += 1
                found, letters = labeller.probabilities([split_words(texts[i]) for i in own])
                for i, p, has in zip(own, found, letters):
                    if has.any():
                        p = p[has]
                        mean = p.mean(0)
                        best = int(mean.argmax())
                        names[i], scores[i] = model.languages[best], float(min(1.0, mean[best]))
                        label = p.argmax(1)
                        switches[i] = int((label[1:] != label[:-1]).sum())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(switches, pa.int64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "n_switches"],
            )

    return run


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def training_rows(docs: DataFrame) -> list[tuple[str, str]]:
    """About ``SAMPLE_PER_LANG`` labelled texts per language: those with the
    lowest hashes, by a limit that follows from the number of labels."""
    usable = docs.filter((remainder(F.col("doc_id")) != 1) & F.col("lang").isNotNull())
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    luck = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
    # of a long text an excerpt of about that size, from a place by its hash, less
    # the words that its ends cut
    size, letters = F.octet_length("text"), F.char_length("text")
    width = F.floor(F.lit(float(SAMPLE_BYTES)) * letters / size).cast("int")
    start = F.pmod(F.xxhash64("text", F.lit("excerpt")), F.greatest(letters - width, F.lit(1))).cast("int") + 1
    excerpt = F.regexp_replace(F.substr("text", start, width), "^\\S{1,32}\\s|\\s\\S{1,32}$", "")
    text = F.when(size <= SAMPLE_BYTES, F.col("text")).otherwise(excerpt).alias("text")
    chosen = (
        usable.filter(F.octet_length("text").isNotNull())
        .select("lang", text, luck.alias("luck"))
        .join(settle(sizes, "languages"), "lang")
        .filter(F.col("luck") * F.col("n") < SAMPLE_PER_LANG)
    )
    return sorted((r.lang, r.text) for r in chosen.select("lang", "text").collect())


def language_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, n_switches (changes of
    language from word to word)."""
    model = fit(training_rows(docs))
    out = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("held_out", T.BooleanType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("n_switches", T.LongType()),
        ]
    )
    held = F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out")
    return docs.select("doc_id", held, "text").mapInArrow(_report(model), out)


def label_words(model: Model, texts: list[str]) -> list[list[tuple[str, str]]]:
    """(word, language) of the words and pieces of each text."""
    split = [split_words(t) for t in texts]
    found, _ = Labeller(model).probabilities(split)
    return [
        [(w, model.languages[k]) for w, k in zip(words, p.argmax(1))] for words, p in zip(split, found)
    ]
