"""A linear-chain conditional random field in numpy.

Tokens have named features; a label path scores the sum of the weights of its
(feature, label) and (label, next label) pairs. Training maximizes the
penalized log-likelihood of a small labelled table by forward-backward on
padded batches. Decoding is Viterbi, also on padded batches.

Sequences are framed by the label O on both sides. A document need not be
decoded whole: where a token's scores prove that its label on the best path is
O, whatever its neighbours are, the path falls into parts that are decoded
independently, with the same result as the whole sequence.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

OUTSIDE = "O"
PENALTY = 0.02
STEPS = 250
RATE = 0.15
# Cells (islands x tokens) that are decoded at a time.
DECODE_CELLS = 1 << 16
# Below this, a difference between sums of scores may be rounding.
SLACK = 1e-6


class Crf:
    def __init__(self, labels: Sequence[str]):
        self.labels = [OUTSIDE, *[x for x in labels if x != OUTSIDE]]
        self.index: dict[str, int] = {}
        self.weights = np.zeros((0, len(self.labels)))
        self.moves = np.zeros((len(self.labels), len(self.labels)))

    # -------------------------------------------------------------- training

    def fit(self, sequences: list[list[list[str]]], tags: list[list[str]]) -> "Crf":
        """``sequences[s][t]`` are the features of a token, ``tags[s][t]`` its label."""
        for sequence in sequences:
            for token in sequence:
                for f in token:
                    self.index.setdefault(f, len(self.index))
        n, length = len(sequences), max(map(len, sequences))
        k = len(self.labels)
        width = max(len(t) for s in sequences for t in s)
        none = len(self.index)  # padding feature with weight 0
        ids = np.full((n, length, width), none)
        gold = np.zeros((n, length), dtype=np.int64)
        mask = np.zeros((n, length), dtype=bool)
        for s, (sequence, row) in enumerate(zip(sequences, tags)):
            for t, (token, tag) in enumerate(zip(sequence, row)):
                ids[s, t, :len(token)] = [self.index[f] for f in token]
                gold[s, t] = self.labels.index(tag)
                mask[s, t] = True

        rows = np.arange(n)
        real = np.zeros((none + 1, k))
        moves_real = np.zeros((k, k))
        before = np.zeros(n, dtype=np.int64)
        for t in range(length):
            on = mask[:, t]
            np.add.at(real, (ids[on, t], gold[on, t][:, None]), 1.0)
            np.add.at(moves_real, (before[on], gold[on, t]), 1.0)
            before = np.where(on, gold[:, t], before)
        np.add.at(moves_real, (before, np.zeros(n, dtype=np.int64)), 1.0)

        params = [np.zeros((none + 1, k)), np.zeros((k, k))]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        last = mask.sum(axis=1) - 1
        for step in range(1, STEPS + 1):
            w, moves = params
            emit = w[ids].sum(axis=2)
            forward = np.empty((n, length, k))
            forward[:, 0] = moves[0] + emit[:, 0]
            for t in range(1, length):
                value = _logsum(forward[:, t - 1, :, None] + moves, axis=1) + emit[:, t]
                forward[:, t] = np.where(mask[:, t, None], value, forward[:, t - 1])
            total = _logsum(forward[rows, last] + moves[:, 0], axis=1)
            backward = np.empty((n, length, k))
            backward[:, -1] = moves[:, 0]
            for t in range(length - 2, -1, -1):
                value = _logsum(moves + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
                backward[:, t] = np.where(mask[:, t + 1, None], value, moves[:, 0])
            marginal = np.exp(forward + backward - total[:, None, None]) * mask[:, :, None]
            guess = np.zeros_like(w)
            for f in range(width):
                np.add.at(guess, ids[:, :, f].ravel(), marginal.reshape(-1, k))
            moves_guess = np.zeros((k, k))
            moves_guess[0] += marginal[:, 0].sum(axis=0)
            moves_guess[:, 0] += marginal[rows, last].sum(axis=0)
            for t in range(1, length):
                pair = forward[:, t - 1, :, None] + moves + (emit[:, t] + backward[:, t])[:, None, :]
                moves_guess += (np.exp(pair - total[:, None, None]) * mask[:, t, None, None]).sum(axis=0)
            gradients = [real - guess - PENALTY * w, moves_real - moves_guess - PENALTY * moves]
            gradients[0][none] = 0.0
            for i, g in enumerate(gradients):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.99 * second[i] + 0.01 * g * g
                params[i] = params[i] + RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
        self.weights, self.moves = params
        return self

    # -------------------------------------------------------------- decoding

    def score(self, features: list[str]) -> np.ndarray:
        """Label scores of one token; features never seen in training weigh 0."""
        known = [self.index[f] for f in features if f in self.index]
        return self.weights[known].sum(axis=0)

    def most(self, scores: np.ndarray) -> np.ndarray:
        """The most that each token, given its (tokens, labels) scores, can add
        to a path by another label than O, with the move to that label."""
        into = self.moves.max(axis=0)[1:] - self.moves[0, 0]
        return (scores[:, 1:] - scores[:, :1] + into).max(axis=1)

    def undecided(self, most: np.ndarray) -> np.ndarray:
        """The tokens of a sequence whose label on the best path may be other
        than O, from what each can add at ``most``.

        The best path gains from each of its runs of labels other than O, else
        O throughout the run were better. So a token in no stretch whose sum,
        with the move back to O, is above 0 is O.
        """
        back = (self.moves[1:, 0] - self.moves[0, 0]).max()
        sums = np.concatenate([[0.0], np.cumsum(most)])
        from_here = np.maximum.accumulate(sums[:0:-1])[::-1]
        up_to_here = np.minimum.accumulate(sums[:-1])
        return np.flatnonzero(from_here - up_to_here + back >= -SLACK)

    def decode(self, islands: list[np.ndarray]) -> list[np.ndarray]:
        """The best label numbers of each island, given its (tokens, labels) scores."""
        out: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(islands)
        order = sorted(range(len(islands)), key=lambda i: len(islands[i]))
        at = 0
        while at < len(order):
            # Sorted by length, so padding at most doubles a batch.
            end, shortest = at + 1, max(1, len(islands[order[at]]))
            while end < len(order) and (size := len(islands[order[end]])) <= 2 * shortest \
                    and size * (end + 1 - at) <= DECODE_CELLS:
                end += 1
            for i, path in zip(order[at:end], self._viterbi([islands[i] for i in order[at:end]])):
                out[i] = path
            at = end
        return out

    def _viterbi(self, batch: list[np.ndarray]) -> list[np.ndarray]:
        n, length, k = len(batch), max(map(len, batch)), len(self.labels)
        if length == 0:
            return [np.empty(0, dtype=np.int64)] * n
        sizes = np.array([len(b) for b in batch])
        emit = np.zeros((n, length, k))
        for i, b in enumerate(batch):
            emit[i, :len(b)] = b
        best = self.moves[0] + emit[:, 0]
        came = np.zeros((n, length, k), dtype=np.int8)
        for t in range(1, length):
            through = best[:, :, None] + self.moves
            came[:, t] = through.argmax(axis=1)
            on = (t < sizes)[:, None]
            best = np.where(on, through.max(axis=1) + emit[:, t], best)
        label = (best + self.moves[:, 0]).argmax(axis=1)
        path = np.zeros((n, length), dtype=np.int64)
        rows = np.arange(n)
        for t in range(length - 1, -1, -1):
            on = t < sizes
            path[on, t] = label[on]
            if t:
                label = np.where(on, came[rows, t, label], label)
        return [path[i, :s] for i, s in enumerate(sizes)]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))
