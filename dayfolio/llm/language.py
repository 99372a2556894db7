"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: ASCII bytes that are no letters become spaces; all others stay.
_TABLE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_LETTER = regex.compile(r"\p{L}")
#: Longer words are read in pieces.
_LONGEST = 30
#: Words whose result a worker remembers before it starts anew.
_REMEMBERED = 400_000


def words_of(text: str) -> list[bytes]:
    """The text's letter runs in UTF-8, lower-cased, in pieces of at most 30 bytes that end with a character."""
    words = text.lower().encode("utf-8", "replace").translate(_TABLE).split()
    if max(map(len, words), default=0) > _LONGEST:
        words = [piece for w in words for piece in _pieces(w)]
    return words


def _pieces(word: bytes) -> Iterator[bytes]:
    while len(word) > _LONGEST:
        end = _LONGEST
        while word[end] & 0xC0 == 0x80:  # a byte inside a character
            end -= 1
        yield word[:end]
        word = word[end:]
    yield word


def is_held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3 == 1


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _read(x: np.ndarray, inputs: np.ndarray, turn: np.ndarray, keep: bool = False):
    """One direction of the network over bytes x[time, word]: states after each step, and what training needs."""
    h = turn.shape[0]
    state = np.zeros((x.shape[1], h), np.float32)
    states = np.empty((*x.shape, h), np.float32)
    trace = []
    for t in range(len(x)):
        a, u = inputs[x[t]], state @ turn
        gates = _sigmoid(a[:, :2 * h] + u[:, :2 * h])
        z, r = gates[:, :h], gates[:, h:]
        new = np.tanh(a[:, 2 * h:] + r * u[:, 2 * h:])
        after = new + z * (state - new)
        if keep:
            trace.append((state, z, r, new, u[:, 2 * h:]))
        states[t] = state = after
    return states, trace


@dataclass
class Network:
    """Weights: for each direction the bytes' inputs to the gates (z, r, new) and the state's, and the labels' weights."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages: list[str], hidden: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        make = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        w = {}
        for d in ("there", "back"):
            w[f"{d}_in"] = make(256, 3 * hidden, scale=0.3)
            w[f"{d}_turn"] = make(hidden, 3 * hidden, scale=hidden**-0.5)
        w["out"] = make(2 * hidden, len(languages), scale=hidden**-0.5)
        w["bias"] = np.zeros(len(languages), np.float32)
        return cls(languages, w)

    def positions(self, x: np.ndarray, keep: bool = False):
        """Label probabilities at every position of x[time, word]."""
        w = self.weights
        there, t1 = _read(x, w["there_in"], w["there_turn"], keep)
        back, t2 = _read(x[::-1], w["back_in"], w["back_turn"], keep)
        both = np.concatenate([there, back[::-1]], axis=2)
        logits = both @ w["out"] + w["bias"]
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        return (p, both, t1, t2) if keep else p

    def gradients(self, x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted mean cross entropy over all positions, by backpropagation through time."""
        w, h = self.weights, len(self.weights["there_turn"])
        p, both, t1, t2 = self.positions(x, keep=True)
        error = p.copy()
        error[:, np.arange(x.shape[1]), label] -= 1
        error *= (weight / (weight.sum() * len(x)))[None, :, None].astype(np.float32)
        flat = error.reshape(-1, error.shape[2])
        out = {"out": both.reshape(-1, 2 * h).T @ flat, "bias": flat.sum(0)}
        into = error @ w["out"].T
        for name, xs, trace, grad in (("there", x, t1, into[:, :, :h]), ("back", x[::-1], t2, into[::-1, :, h:])):
            turn = w[f"{name}_turn"]
            d_in, d_turn = np.empty((*xs.shape, 3 * h), np.float32), np.zeros_like(turn)
            d = np.zeros((xs.shape[1], h), np.float32)
            for t in range(len(xs) - 1, -1, -1):
                state, z, r, new, u = trace[t]
                d = d + grad[t]
                dn = d * (1 - z) * (1 - new * new)
                dz = d * (state - new) * z * (1 - z)
                dr = dn * u * r * (1 - r)
                d_in[t] = np.concatenate([dz, dr, dn], axis=1)
                back = np.concatenate([dz, dr, dn * r], axis=1)
                d_turn += state.T @ back
                d = d * z + back @ turn.T
            one_hot = np.zeros((xs.size, 256), np.float32)
            one_hot[np.arange(xs.size), xs.ravel()] = 1
            out[f"{name}_in"], out[f"{name}_turn"] = one_hot.T @ d_in.reshape(-1, 3 * h), d_turn
        return out

    def word_sums(self, words: list[bytes], chunk: int = 4096) -> np.ndarray:
        """For each word the sum of its positions' probabilities; words are read between two spaces."""
        sums = np.empty((len(words), len(self.languages)), np.float32)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        for k in range(0, len(order), chunk):
            part = order[k:k + chunk]
            for length in np.unique(lengths[part]):
                same = part[lengths[part] == length]
                sums[same] = self.positions(_columns([words[i] for i in same])).sum(axis=0)
        return sums


def _columns(words: list[bytes]) -> np.ndarray:
    """Words of one length as x[time, word], a space before and after."""
    return np.frombuffer(b"".join(b" " + w + b" " for w in words), np.uint8).reshape(len(words), -1).T


def train(samples: list[tuple[str, bytes, int]], hidden: int = 12, rounds: int = 8, batch: int = 256, rate: float = 0.01, seed: int = 7) -> Network:
    """A network from (language, word, count): Adam on batches of words of one length.

    A word weighs the root of its count; each language weighs the same.
    """
    samples = sorted(samples)
    languages = sorted({s[0] for s in samples})
    label = np.array([languages.index(s[0]) for s in samples])
    weight = np.sqrt([s[2] for s in samples])
    weight /= np.bincount(label, weight)[label] / len(samples)
    lengths = np.array([len(s[1]) for s in samples])
    network, rng = Network.fresh(languages, hidden, seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in network.weights.items()}
    second, step = {k: np.zeros_like(v) for k, v in network.weights.items()}, 0
    total = rounds * sum(-(-n // batch) for n in np.unique(lengths, return_counts=True)[1])
    for _ in range(rounds):
        mixed = rng.permutation(len(samples))
        parts = [same[i:i + batch] for n in np.unique(lengths) for same in [mixed[lengths[mixed] == n]] for i in range(0, len(same), batch)]
        for k in rng.permutation(len(parts)):
            part = parts[k]
            found = network.gradients(_columns([samples[i][1] for i in part]), label[part], weight[part])
            step += 1
            for name, g in found.items():
                g = np.clip(g, -1, 1)
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                move = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
                network.weights[name] -= (rate * (1 - step / (total + 1)) * move).astype(np.float32)
    return network


def training_words(docs: DataFrame, docs_per_language: int, words_per_language: int, id_col: str = "doc_id") -> list[tuple[str, bytes, int]]:
    """(language, word, count) from a bounded sample of the labelled rows given.

    Documents are taken by the hash of their id, about ``docs_per_language`` of
    each language, and of their words ``words_per_language`` by hash. Only the
    languages' counts, which are the classes of the model, and these words go to
    the driver.
    """
    labelled = docs.filter("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    place = F.pmod(F.xxhash64(F.lit("language sample"), F.col(id_col)), F.lit(1_000_000)) / 1_000_000.0
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, docs_per_language / n)]), F.col("lang"))
    sample = labelled.filter(place < share).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(lang, w) for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True) for w in words_of(text.as_py())]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], names=["lang", "word"])

    words = sample.mapInArrow(count, "lang string, word binary").groupBy("lang", "word").agg(F.count("*").alias("n"))
    chosen = words.withColumn("_k", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("word"), "word"))).filter(F.col("_k") <= words_per_language)
    return [(r["lang"], bytes(r["word"]), r["n"]) for r in chosen.collect()]


def predict(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, n_positions) of every text.

    Each word of the text is read between two spaces in both directions and
    every position gets label probabilities; their mean over all positions of the
    document is its distribution. A word's sum is computed once and remembered.
    """
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes, places = np.empty((0, len(network.languages) if network else 0), np.float32), np.empty(0, np.int64), {}
        for batch in batches:
            texts = [x.as_py() for x in batch.column(1)]
            if len(places) > _REMEMBERED:
                places, sums, sizes = {}, sums[:0], sizes[:0]
            new: list[bytes] = []
            found: list[np.ndarray | None] = []
            for text in texts:
                if network is None or text is None or not _LETTER.search(text):
                    found.append(None)
                    continue
                words = words_of(text)
                for w in set(words).difference(places):
                    places[w] = len(places)
                    new.append(w)
                found.append(np.fromiter(map(places.__getitem__, words), np.int64, len(words)))
            if new:
                sums = np.concatenate([sums, network.word_sums(new)])
                sizes = np.concatenate([sizes, np.fromiter(map(len, new), np.int64, len(new)) + 2])
            names, scores, lengths = [], [], []
            for at in found:
                p = None if at is None else sums[at].sum(axis=0, dtype=np.float64) / (n := int(sizes[at].sum()))
                names.append("und" if p is None else network.languages[int(p.argmax())])
                scores.append(0.0 if p is None else min(1.0, float(p.max())))
                lengths.append(0 if p is None else n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(lengths, pa.int64())], names=[id_col, "lang_pred", "score", "n_positions"])

    wanted = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return wanted.mapInArrow(label, f"{id_col} long, lang_pred string, score double, n_positions long")


def identify_languages(docs: DataFrame, docs_per_language: int = 300, words_per_language: int = 6000, hidden: int = 12, rounds: int = 8) -> DataFrame:
    """Trains on a bounded sample of the rows that are not held out, then labels every whole text.

    Returns doc_id, held_out, lang_pred, score, n_positions, one row per input
    row. A null text, a text without letters, and any text when nothing was
    there to learn from get ``und`` and 0. Ties go to the first language by name.
    Repeated rows have equal answers; an empty table gives an empty result;
    other columns are ignored.
    """
    words = training_words(docs.filter(~is_held_out()).select("doc_id", "text", "lang"), docs_per_language, words_per_language)
    network = train(words, hidden, rounds) if words else None
    return predict(docs, network).withColumn("held_out", is_held_out()).select("doc_id", "held_out", "lang_pred", "score", "n_positions")
