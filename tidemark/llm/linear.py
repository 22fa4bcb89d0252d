"""Sparse logistic regression over hashed word n-grams, trained with follow-the-regularised-leader.

A text becomes a sparse vector: tokens are runs of letters and digits or runs of other signs, features
are hashed single tokens and pairs, and a value is the square root of the feature's share of all, so
that every vector has length 1 and long texts weigh as much as short ones.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

from tidemark.llm.common import WordHashes, mix64

_TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\s]+")
_PAIR, _SEEN, _SAME = np.uint64(0x51ED270B0A1F39C1), np.uint64(1), np.uint64(2)


@dataclass(frozen=True)
class Ftrl:
    """Settings of FTRL-proximal; `bits` is the size of the hashed feature space."""

    bits: int = 18
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.2
    l2: float = 0.1
    # Examples are passed over until so many updates are made, 3 times at least and 20 at most.
    updates: int = 6_000

    def passes(self, examples: int) -> int:
        return max(3, min(20, self.updates // max(examples, 1)))


def features(text: bytes, hashes: WordHashes, bits: int, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the sparse vector. The last index, `2 ** bits`, is the constant term."""
    tokens = hashes.of(_TOKEN.findall(text.lower() if lower else text))
    constant = np.array([1 << bits])
    if len(tokens) == 0:
        return constant, np.ones(1)
    pairs = mix64(tokens[:-1] * _PAIR + tokens[1:])
    # Pairs that came before in the text, or of one token twice, are features of their own kind:
    # repetition shows whichever words are repeated.
    different, first = np.unique(pairs, return_index=True)
    again = np.full(len(pairs) - len(different), mix64(_SEEN[None])[0])
    same = np.full(np.count_nonzero(tokens[:-1] == tokens[1:]), mix64(_SAME[None])[0])
    everything = np.concatenate([mix64(tokens), pairs, again, same]) >> np.uint64(64 - bits)
    index, counts = np.unique(everything.astype(np.int64), return_counts=True)
    return np.concatenate([index, constant]), np.concatenate([np.sqrt(counts / len(everything)), np.ones(1)])


def train(examples: list[tuple[np.ndarray, np.ndarray, float]], settings: Ftrl) -> np.ndarray:
    """Weights after some passes over the examples (indices, values, 0 or 1), in their order."""
    size = (1 << settings.bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    for _ in range(settings.passes(len(examples))):
        for index, value, label in examples:
            w = proximal_weights(z[index], n[index], settings, index == size - 1)
            p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
            g = (p - label) * value
            step = (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / settings.alpha
            z[index] += g - step * w
            n[index] += g * g
    return proximal_weights(z, n, settings, np.arange(size) == size - 1)


def proximal_weights(z: np.ndarray, n: np.ndarray, s: Ftrl, constant: np.ndarray) -> np.ndarray:
    l1 = np.where(constant, 0, s.l1)
    return np.where(np.abs(z) <= l1, 0, -(z - np.sign(z) * l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))


def train_classes(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, settings: Ftrl) -> np.ndarray:
    """As `train`, for several classes at once: `labels` and the weights have a column for each of them."""
    size = (1 << settings.bits) + 1
    z, n = np.zeros((size, labels.shape[1])), np.zeros((size, labels.shape[1]))
    for _ in range(settings.passes(len(examples))):
        for (index, value), label in zip(examples, labels, strict=True):
            w = proximal_weights(z[index], n[index], settings, (index == size - 1)[:, None])
            p = 1 / (1 + np.exp(-np.clip(value @ w, -35, 35)))
            g = value[:, None] * (p - label)
            step = (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / settings.alpha
            z[index] += g - step * w
            n[index] += g * g
    return proximal_weights(z, n, settings, (np.arange(size) == size - 1)[:, None])


def score(text: bytes, weights: np.ndarray, hashes: WordHashes, bits: int) -> float:
    """The sparse dot product of a text with the weights, as a probability."""
    index, value = features(text, hashes, bits)
    return float(1 / (1 + np.exp(-np.clip(weights[index] @ value, -35, 35))))
